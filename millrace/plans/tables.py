"""The warehouse tables seen as the inputs of the pipelines.

Every function reads a whole table and only renames or renders columns. Text
inputs are written to the shared folder once per session, then scanned.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.cluster import rendered as written
from millrace.cluster import small_side
from millrace.sources.retweet_log import LOG_HEADER

WINDOW, SLIDE, DELAY = "12 hours", "1 hour", "1 hour"
LIST_SIZE = 3000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_lines(lines: DataFrame) -> Callable[[str], None]:
    return lambda path: lines.write.text(path)


def one_line(spark: SparkSession, text: str) -> DataFrame:
    return spark.range(1).select(F.lit(text).alias("value"))


# Page views ---------------------------------------------------------------


def pageviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = table(spark, sf_dir, "documents")
    title = F.when(F.col("doc_id") % 50 == 0, F.col("lang")).otherwise(F.concat(F.lit("d"), "doc_id"))
    return doc.select(
        F.concat("lang", F.lit("."), "source").alias("project"),
        title.alias("title"),
        F.col("n_chars").alias("views"),
        F.col("doc_id").alias("size"),
    )


def pageview_files(spark: SparkSession, sf_dir: str) -> str:
    lines = pageviews(spark, sf_dir).select(F.concat_ws(" ", "project", "title", "views", "size").alias("value"))
    return written(spark, sf_dir, "pageviews", write_lines(lines))


# Posts --------------------------------------------------------------------


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def as_statuses(events: DataFrame) -> DataFrame:
    return events.select(
        "ts",
        (F.col("event_type") != "error").alias("is_retweet"),
        F.col("user_id").alias("id"),
        _k().alias("retweet_count"),
        F.col("event_type").alias("lang"),
        F.col("event_type").alias("text"),
    )


def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_statuses(table(spark, sf_dir, "events"))


def retweet_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per event: texts with commas, empty texts and short rows among them."""
    kind = F.col("event_id") % 11
    text = (
        F.when(kind == 0, F.lit(""))
        .when(kind == 1, F.concat("event_type", F.lit(", and more")))
        .otherwise(F.concat("event_type", F.lit(" "), _k().cast("string")))
    )
    head = F.concat_ws(
        ",",
        F.concat(F.lit("("), F.col("event_id").cast("string"), F.lit(")")),
        F.initcap("event_type"),
        "event_type",
        F.lit(7),
        "user_id",
        _k() + (F.col("event_id") % 5).cast("int"),
        _k(),
        (F.col("event_id") % 5).cast("int"),
    )
    line = F.when(kind == 2, head).otherwise(F.concat(head, F.lit(","), text))
    rows = table(spark, sf_dir, "events").select(line.alias("value"))
    header = one_line(spark, LOG_HEADER)
    return header.unionAll(rows)


def retweet_log_files(spark: SparkSession, sf_dir: str) -> str:
    return written(spark, sf_dir, "retweet_log", write_lines(retweet_log_lines(spark, sf_dir)))


# People and movies --------------------------------------------------------


def filmography_blocks(spark: SparkSession, sf_dir: str, parity: int | None = None) -> DataFrame:
    """One block per order; ``parity`` 0 or 1 takes the men's or women's list."""
    orders = table(spark, sf_dir, "orders")
    if parity is not None:
        orders = orders.where(F.col("o_custkey") % 2 == parity)
    year = (F.year("o_orderdate") + 14).cast("string")
    key = F.col("o_orderkey").cast("string")
    second = F.when(F.col("o_orderpriority").startswith("1"), F.concat(F.lit('"Series '), key, F.lit('" (2012)'))).otherwise(
        F.concat(F.lit("Second "), key, F.lit(" ("), year, F.lit("/I) [extra] (uncredited)"))
    )
    third = (
        F.when(F.col("o_orderstatus") == "F", F.lit("Foo (Bar) (2012)"))
        .when(F.col("o_orderstatus") == "O", F.lit("No bracket 2013"))
        .otherwise(F.lit("Undated (????)"))
    )
    first = F.concat(F.lit("Order "), key, F.lit(" ("), year, F.lit(")  <3>"))
    name = F.concat(F.lit("Person "), F.col("o_custkey").cast("string"), F.lit("-"), key)
    block = F.concat(name, F.lit("\t"), first, F.lit("\n\t\t\t"), second, F.lit("\n\t\t\t"), third)
    return orders.select(block.alias("value"))


def filmography_files(spark: SparkSession, sf_dir: str, parity: int | None = None) -> str:
    blocks = filmography_blocks(spark, sf_dir, parity)
    return written(
        spark, sf_dir, f"filmography_{parity}", lambda path: blocks.write.option("lineSep", "\n\n").text(path)
    )


def career_files(spark: SparkSession, sf_dir: str, parity: int) -> str:
    """One block per order under the customer's name: a title per part and ship month, an old one and a series."""
    title = F.concat(F.lit("Part "), "l_partkey", F.lit(" in "), F.date_format("l_shipdate", "yyyy-MM"), F.lit(" (2012)  <1>"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), title.alias("title"))
    orders = table(spark, sf_dir, "orders").where(F.col("o_custkey") % 2 == parity)
    # An order has few lines.
    titled = orders.join(lines, "o_orderkey").groupBy("o_orderkey", "o_custkey").agg(F.sort_array(F.collect_list("title")).alias("titles"))
    named = titled.join(people(spark, sf_dir).select(F.col("actor_id").alias("o_custkey"), "name"), "o_custkey")
    titles = F.concat(F.array(F.lit("Older (1999)"), F.lit('"Series" (2012)')), "titles")
    blocks = named.select(F.concat("name", F.lit("\t"), F.array_join(titles, "\n\t\t\t")).alias("value"))
    return written(spark, sf_dir, f"careers_{parity}", lambda path: blocks.write.option("lineSep", "\n\n").text(path))


def list_files(spark: SparkSession, sf_dir: str) -> str:
    """Raw lists of ``LIST_SIZE`` orders each, one file per list, with preamble and footer."""
    row = lambda part, text: F.struct(F.lit(part).alias("part"), text.alias("value"))
    within = F.col("o_orderkey") % LIST_SIZE
    preamble = F.when(
        within == 0,
        F.array(
            row(0, F.lit("CRC: 0xDEADBEEF")),
            row(1, F.lit("--- not a footer yet")),
            row(2, F.lit(" Name\t\t\tTitles ")),
            row(3, F.lit("----\t\t\t------")),
        ),
    ).otherwise(F.array().cast("array<struct<part:int,value:string>>"))
    body = F.array(row(4, F.concat(F.lit("Person\t"), F.col("o_orderkey").cast("string"))))
    footer = F.when(
        within == LIST_SIZE - 1, F.array(row(5, F.lit("-----------")), row(6, F.lit("after the end")))
    ).otherwise(F.array().cast("array<struct<part:int,value:string>>"))
    lines = table(spark, sf_dir, "orders").select(
        F.floor(F.col("o_orderkey") / LIST_SIZE).alias("list"),
        "o_orderkey",
        F.explode(F.concat(preamble, body, footer)).alias("l"),
    )
    laid_out = lines.repartition("list").sortWithinPartitions("list", "o_orderkey", "l.part")
    return written(
        spark,
        sf_dir,
        "lists",
        lambda path: laid_out.select("list", "l.value").write.partitionBy("list").text(path),
    )


def movie_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers who ordered the same part in the same ship month."""
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem")
    movie = F.concat("l_partkey", F.lit("@"), F.date_format("l_shipdate", "yyyy-MM"))
    return (
        orders.select("o_orderkey", F.col("o_custkey").alias("actor_id"))
        .join(lines.select(F.col("l_orderkey").alias("o_orderkey"), movie.alias("movie")), "o_orderkey")
        .select("actor_id", "movie")
        .distinct()
    )


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("actor_id"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_nationkey") % 2 == 0, "m").otherwise("f").alias("gender"),
    )


def actors(spark: SparkSession, sf_dir: str, edges: DataFrame) -> DataFrame:
    return people(spark, sf_dir).join(edges, "actor_id", "left_semi")


SEED_NAME = "Customer#000000000"

# Intervals ----------------------------------------------------------------


def _days(column: str) -> Column:
    return F.datediff(F.col(column), F.lit("1995-01-01").cast("date"))


def extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One closed interval per order line on the supplier's sequence."""
    start = _days("l_shipdate") * 40 + (F.col("l_partkey") % 40).cast("int") + 1
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.when(F.col("l_linenumber") % 2 == 0, "S").otherwise("s"), F.col("l_suppkey")).alias("mixed"),
        F.concat(F.lit("s"), F.col("l_suppkey")).alias("chrom"),
        start.alias("start"),
        (start + F.col("l_quantity").cast("int") - 1).alias("end"),
    )


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One half-open target per order, some of them long."""
    start = _days("o_orderdate") * 40
    length = F.when(F.col("o_orderkey") % 100 == 0, 5000).otherwise((F.col("o_orderkey") % 97).cast("int") + 1)
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("s"), F.floor(F.col("o_custkey") / 15)).alias("chrom"),
        start.alias("start"),
        (start + length).alias("end"),
        F.concat(F.lit("t"), "o_orderkey").alias("extra"),
    )


def target_files(spark: SparkSession, sf_dir: str) -> str:
    rows = targets(spark, sf_dir).select(F.concat_ws("\t", "chrom", "start", "end", "extra").alias("value"))
    heads = one_line(spark, "track name=targets").unionAll(one_line(spark, "#chrom\tstart"))
    return written(spark, sf_dir, "targets", write_lines(heads.unionAll(rows)))


# Reads --------------------------------------------------------------------


def chrom_name(index: Column, other: Column) -> Column:
    return (
        F.when(index == 0, F.lit("chrM"))
        .when(index == 23, F.lit("chrX"))
        .when(index == 24, F.lit("chrY"))
        .when(index.between(1, 22), F.concat(F.lit("chr"), index.cast("string")))
        .otherwise(other)
    )


def seq_dict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sequence per supplier."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        key.cast("int").alias("ref_index"),
        chrom_name(key, F.concat(F.lit("chrUn_"), key)).alias("name"),
        F.when((key >= 25) & (key % 10 == 5), 0).otherwise(2000 + 10 * key).cast("int").alias("length"),
    )


def seq_dict_files(spark: SparkSession, sf_dir: str) -> str:
    length = F.when(F.col("length") == 0, F.lit("n/a")).otherwise(F.col("length").cast("string"))
    line = F.concat_ws("\t", F.lit("@SQ"), F.concat(F.lit("SN:"), "name"), F.concat(F.lit("LN:"), length), F.lit("UR:x"))
    header = one_line(spark, "@HD\tVN:1.0\tSO:unsorted").withColumn("ref_index", F.lit(-1))
    lines = seq_dict(spark, sf_dir).select(line.alias("value"), "ref_index").unionByName(header)
    return written(spark, sf_dir, "dict", write_lines(lines.orderBy("ref_index").select("value")))


def reads(spark: SparkSession, sf_dir: str, spread: int = 1, quality: Column | None = None) -> DataFrame:
    """One aligned read per order line, with clips, gaps and insertions by line number."""
    q = F.col("l_quantity").cast("int").cast("string")
    n = F.col("l_linenumber")
    pattern = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    cigar = (
        F.when(n == 1, pattern(q, "M"))
        .when(n == 2, pattern("3S", q, "M"))
        .when(n == 3, pattern(q, "M2D5M"))
        .when(n == 4, pattern(q, "M1I4M"))
        .when(n == 5, pattern(q, "M100N5M"))
        .when(n == 6, pattern("2H", q, "M3S"))
        .otherwise(F.lit("*"))
    )
    flag = (
        F.when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"), 4)
        .when(F.col("l_returnflag") == "N", 16)
        .otherwise(0)
    )
    pos = F.when(F.col("l_orderkey") % 997 != 3, F.floor(_days("l_shipdate") / 8) * 8 * spread + 1).cast("int")
    quality = n * 5 if quality is None else quality
    index = F.col("l_suppkey") % 26
    named = table(spark, sf_dir, "lineitem").select(
        F.concat_ws(":", F.lit("r"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("qname"),
        flag.alias("flag"),
        chrom_name(index, F.lit("chrUn_25")).alias("rname"),
        pos.alias("pos"),
        (n * 8).alias("mapq"),
        cigar.alias("cigar"),
        F.lit("=").alias("rnext"),
        (pos + (F.col("l_partkey") % 3).cast("int")).alias("pnext"),
        F.lit(0).alias("tlen"),
        F.lit("*").alias("seq"),
        F.repeat(F.char(quality + 33), F.col("l_quantity").cast("int")).alias("qual"),
    )
    # Few names hold all reads: reduced and written first, so that the reads stay where they are.
    names = small_side(seq_dict(spark, sf_dir).select(F.col("name").alias("rname"), "ref_index"))
    return named.join(names, "rname", "left").select(
        "qname", "flag", "rname", "ref_index", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual"
    )


def _write_reads(spark: SparkSession, aligned: DataFrame) -> Callable[[str], None]:
    or_bad = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("bad"))
    line = F.concat_ws(
        "\t", "qname", "flag", "rname", or_bad("pos"), "mapq", "cigar", "rnext", or_bad("pnext"), "tlen", "seq", "qual"
    )
    return write_lines(one_line(spark, "@HD\tVN:1.0").unionAll(aligned.select(line.alias("value"))))


def read_files(spark: SparkSession, sf_dir: str) -> str:
    return written(spark, sf_dir, "reads", _write_reads(spark, reads(spark, sf_dir)))


LANE_SPREAD = 100


def lane_files(spark: SparkSession, sf_dir: str) -> str:
    """The reads further apart; those of odd sequences have shifted qualities, but for some that fall short of it."""
    n = F.col("l_linenumber")
    shifted = (F.col("l_suppkey") % 26 % 2 == 1) & (F.col("l_orderkey") % 50 != 7)
    lane = reads(spark, sf_dir, LANE_SPREAD, F.when(shifted, n * 2 + 59).otherwise(n * 5))
    return written(spark, sf_dir, "lane", _write_reads(spark, lane))


def lane_target_files(spark: SparkSession, sf_dir: str) -> str:
    """Targets of up to 5000 bases on the chromosomes of the lane."""
    start = F.greatest(_days("o_orderdate") * LANE_SPREAD, F.lit(0))
    length = F.when(F.col("o_orderkey") % 100 == 0, 5000).otherwise((F.col("o_orderkey") % 97).cast("int") + 1)
    rows = table(spark, sf_dir, "orders").select(
        F.concat_ws("\t", chrom_name(F.col("o_custkey") % 26, F.lit("chrUn_25")), start, start + length, F.concat(F.lit("t"), "o_orderkey")).alias("value")
    )
    return written(spark, sf_dir, "lane_targets", write_lines(rows))


def quality_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    quality = lambda x: (F.floor(F.abs(x.cast("double")) * 100) + 35).cast("int")
    return table(spark, sf_dir, "embeddings").select(
        F.col("label").alias("region"),
        F.col("label").alias("ref_index"),
        F.col("vec_id").alias("pos"),
        F.concat(F.lit("v"), "vec_id").alias("qname"),
        F.transform("embedding", quality).alias("quals"),
    )


# Variants -----------------------------------------------------------------


def variant_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = F.col("l_suppkey") % 25
    line = F.concat_ws(
        "\t",
        chrom_name(index, F.lit("chrM")),
        (F.col("l_partkey") + 1).cast("string"),
        F.lit("."),
        "l_returnflag",
        "l_linestatus",
        F.col("l_quantity").cast("int").cast("string"),
        F.lit("PASS"),
        F.concat(F.lit("OK="), "l_orderkey", F.lit(";N="), "l_linenumber"),
    )
    head = one_line(spark, "##contig=<ID=chr1>").unionAll(one_line(spark, "#CHROM\tPOS\tID\tREF\tALT"))
    return head.unionAll(table(spark, sf_dir, "lineitem").select(line.alias("value")))


def variant_files(spark: SparkSession, sf_dir: str) -> str:
    return written(spark, sf_dir, "variants", write_lines(variant_lines(spark, sf_dir)))


def variant_sets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Lines of odd orders against lines of even orders."""
    keyed = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.col("l_suppkey").alias("chrom"),
        F.col("l_partkey").alias("pos"),
        F.col("l_returnflag").alias("ref"),
        F.col("l_linestatus").alias("alt"),
    )
    return keyed.where("l_orderkey % 2 = 1"), keyed.where("l_orderkey % 2 = 0")


# Texts --------------------------------------------------------------------


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("RT @user"), "lang", F.lit(": "), "text", F.lit(" https://t.co/"), "doc_id", F.lit(" RT @end"))
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))


def timed_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as posts of 40 ids, one every ten minutes; the language is not given."""
    ts = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("doc_id") * 10)
    return table(spark, sf_dir, "documents").select(
        ts.alias("ts"),
        (F.col("doc_id") % 7 != 0).alias("is_retweet"),
        (F.col("doc_id") % 40).alias("id"),
        F.col("n_chars").cast("int").alias("retweet_count"),
        "text",
    )


def script_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with Hiragana, Hangul, both or neither added; a third are called Lithuanian."""
    extra = (
        F.when(F.col("doc_id") % 4 == 0, F.lit(" ひら"))
        .when(F.col("doc_id") % 4 == 1, F.lit(" 한글"))
        .when(F.col("doc_id") % 4 == 2, F.lit(" 한ひ"))
        .otherwise(F.lit(""))
    )
    code = F.when(F.col("doc_id") % 3 == 0, F.lit("lt")).otherwise(F.col("lang"))
    return table(spark, sf_dir, "documents").select("doc_id", code.alias("code"), F.concat("text", extra).alias("text"))


# Paired reads -------------------------------------------------------------


def mate_files(spark: SparkSession, sf_dir: str, mate: int) -> str:
    """Turns 2p (mate 0) and 2p+1 (mate 1) of a conversation as paired records.

    Unpartnered first mates go last, so both files run in step.
    """
    turns = table(spark, sf_dir, "conversations").withColumn("pair", F.floor(F.col("turn") / 2))
    per_pair = turns.groupBy("conv_id", "pair").agg(F.count("*").alias("mates"))
    body = F.regexp_replace("text", r"[\r\n]", " ")
    record = F.concat_ws(
        "\n",
        F.concat_ws("/", F.concat(F.lit("@c"), "conv_id"), "turn"),
        body,
        F.lit("+"),
        F.concat(F.lit("q"), F.length(body).cast("string")),
    )
    rows = turns.where(F.col("turn") % 2 == mate).join(per_pair, ["conv_id", "pair"])
    lines = rows.orderBy(F.desc("mates"), "conv_id", "pair").select(record.alias("value"))
    return written(spark, sf_dir, f"mates{mate}", write_lines(lines))
