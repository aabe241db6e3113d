"""Every operator as a named query over the warehouse tables."""

from __future__ import annotations

from collections.abc import Callable

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.cluster import checkpointed, shared_path
from millrace.functions.cigar import alignment_end
from millrace.functions.text import clean_text, one_line, script_fix
from millrace.operators import balance, graph, intervals, language_id, mates, pageviews, trends, variants
from millrace.operators import reads as read_ops
from millrace.operators.ordering import with_ordinal
from millrace.plans import tables as t
from millrace.plans.tables import DELAY, SLIDE, WINDOW
from millrace.sinks import files as sinks
from millrace.sources import fastq, filmography, genome, read_index, retweet_log
from millrace.sources import pageviews as pageview_source
from millrace.sources.lines import numbered_lines
from millrace.sources.retweet_log import LOG_HEADER
from millrace.sources.statuses import stream_source as open_stream
from millrace.streaming import trends as stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


# Page views ---------------------------------------------------------------


@query
def q_scan_pagecounts(spark, sf_dir):
    return pageview_source.scan_pageviews(spark, t.pageview_files(spark, sf_dir))


@query
def q_pagecounts(spark, sf_dir):
    return pageviews.ranked_pageviews(t.pageviews(spark, sf_dir))


@query
def q_pagecounts_report(spark, sf_dir):
    path = shared_path(spark, "pageview_report")
    sinks.write_pageview_report(t.pageviews(spark, sf_dir), path)
    return spark.read.text(path)


# Posts --------------------------------------------------------------------


@query
def q_scan_retweet_log(spark, sf_dir):
    return retweet_log.scan_retweet_log(spark, t.retweet_log_files(spark, sf_dir))


@query
def q_retweet_log_totals(spark, sf_dir):
    return trends.log_totals(retweet_log.scan_retweet_log(spark, t.retweet_log_files(spark, sf_dir)))


@query
def q_retweet_log_round_trip(spark, sf_dir):
    """The trend log is written as files, scanned and analysed."""
    lines = trends.log_lines(trends.log_after_warmup(t.statuses(spark, sf_dir), WINDOW, SLIDE)).select("value")
    path = shared_path(spark, "trend_log")
    t.write_lines(t.one_line(spark, LOG_HEADER).unionAll(lines))(path)
    return trends.log_totals(retweet_log.scan_retweet_log(spark, path))


@query
def q_retweet_filter(spark, sf_dir):
    kept = trends.retweet_filter(t.statuses(spark, sf_dir))
    return kept.select("ts", "id", "max_count", "min_count", F.col("first_seen.lang").alias("lang"))


@query
def q_retweet_window(spark, sf_dir):
    return trends.retweet_windows(t.statuses(spark, sf_dir), WINDOW, SLIDE)


@query
def q_retweet_lang_totals(spark, sf_dir):
    return trends.ranked_language_totals(t.statuses(spark, sf_dir), WINDOW, SLIDE)


@query
def q_retweet_top(spark, sf_dir):
    windows = trends.retweet_windows(t.statuses(spark, sf_dir), WINDOW, SLIDE)
    return trends.ranked_posts(windows).select(
        "window_end", "rank", "language", "total_lang_count", "id", "text", "max_count", "min_count", "count"
    )


@query
def q_retweet_warmup(spark, sf_dir):
    return trends.log_lines(trends.log_after_warmup(t.statuses(spark, sf_dir), WINDOW, SLIDE))


def _status_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = t.table(spark, sf_dir, "events").schema
    events = open_stream(spark, f"{sf_dir}/events*.parquet", schema)
    return t.as_statuses(events.withColumn("ts", F.col("ts").cast("timestamp")))


@query
def q_stream_source(spark, sf_dir):
    out = shared_path(spark, "stream_source")
    running = (
        _status_stream(spark, sf_dir)
        .writeStream.format("parquet")
        .option("path", f"{out}/rows")
        .option("checkpointLocation", f"{out}/state")
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return spark.read.parquet(f"{out}/rows").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _run(spark: SparkSession, sf_dir: str, name: str, job, close) -> str:
    out = shared_path(spark, name)
    statuses = _status_stream(spark, sf_dir)
    job(statuses, f"{out}/out", f"{out}/state", WINDOW, SLIDE, DELAY, {"availableNow": True}).awaitTermination()
    close(f"{out}/out", f"{out}/state")
    return f"{out}/out"


@query
def q_retweet_stream(spark, sf_dir):
    out = _run(spark, sf_dir, "retweet_stream", stream.retweet_stream, partial(stream.close_stream, spark))
    rows = spark.read.parquet(out).drop("batch")
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query
def q_retweet_stream_log(spark, sf_dir):
    close = partial(stream.close_stream_log, spark, window=WINDOW)
    out = _run(spark, sf_dir, "retweet_stream_log", stream.retweet_stream_log, close)
    return spark.read.text(f"{out}/log").select("value")


# People and movies --------------------------------------------------------


@query
def q_scan_blocks(spark, sf_dir):
    return filmography.scan_blocks(spark, t.filmography_files(spark, sf_dir))


@query
def q_section_extract(spark, sf_dir):
    rows = filmography.section_extract(spark, t.list_files(spark, sf_dir))
    number = F.regexp_extract("file", r"list=(\d+)", 1).cast("bigint")
    return rows.select(number.alias("list"), "line_no", "value")


@query
def q_filmography(spark, sf_dir):
    blocks = filmography.scan_blocks(spark, t.filmography_files(spark, sf_dir))
    people = filmography.parse_filmography(blocks, "m")
    return people.select("actor", "gender", F.array_join("movies", "|").alias("movies"))


@query
def q_actors_union(spark, sf_dir):
    lists = [
        filmography.parse_filmography(
            filmography.scan_blocks(spark, t.filmography_files(spark, sf_dir, parity)), gender
        )
        for parity, gender in ((0, "m"), (1, "f"))
    ]
    return graph.actors_union(*lists).select("actor", "gender", F.size("movies").alias("movies"))


@query
def q_actor_ids(spark, sf_dir):
    people = t.people(spark, sf_dir).select(F.col("name").alias("actor"), "gender")
    return graph.actor_ids(people)


@query
def q_seed_lookup(spark, sf_dir):
    return graph.seed_lookup(t.people(spark, sf_dir), t.SEED_NAME)


def _edge_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges that are read several times: the join behind them runs once."""
    return checkpointed(t.movie_edges(spark, sf_dir))


@query
def q_coactors(spark, sf_dir):
    return graph.movie_casts(t.movie_edges(spark, sf_dir))


@query
def q_coactors_of_seed(spark, sf_dir):
    seed = graph.seed_lookup(t.people(spark, sf_dir), t.SEED_NAME)
    return graph.coactors(_edge_table(spark, sf_dir), seed)


@query
def q_adjacency(spark, sf_dir):
    return graph.adjacency_sizes(_edge_table(spark, sf_dir))


@query
def q_neighbours(spark, sf_dir):
    return graph.neighbour_counts(_edge_table(spark, sf_dir))


def _distances(spark: SparkSession, sf_dir: str, edges: DataFrame) -> DataFrame:
    return graph.separation(edges, graph.seed_lookup(t.people(spark, sf_dir), t.SEED_NAME))


@query
def q_separation(spark, sf_dir):
    return _distances(spark, sf_dir, _edge_table(spark, sf_dir))


@query
def q_separation_counts(spark, sf_dir):
    distances = _distances(spark, sf_dir, _edge_table(spark, sf_dir))
    return graph.separation_counts(distances, t.people(spark, sf_dir))


@query
def q_separation_names(spark, sf_dir):
    distances = _distances(spark, sf_dir, _edge_table(spark, sf_dir))
    return graph.separation_names(distances, t.people(spark, sf_dir))


@query
def q_separation_report(spark, sf_dir):
    edges = _edge_table(spark, sf_dir)
    layout = graph.laid_out(edges)
    distances = graph.separation_in(layout, graph.seed_lookup(t.people(spark, sf_dir), t.SEED_NAME))
    return graph.separation_report(distances, t.actors(spark, sf_dir, edges), edges, movies=layout.movies)


@query
def q_separation_file(spark, sf_dir):
    path = shared_path(spark, "separation_file")
    sinks.write_separation_report(q_separation_report(spark, sf_dir), path)
    return _file_lines(spark, path)


@query
def q_separation_from_lists(spark, sf_dir):
    """Lists to people, ids, edges and the report."""
    lists = [
        filmography.parse_filmography(filmography.scan_blocks(spark, t.career_files(spark, sf_dir, parity)), gender)
        for parity, gender in ((0, "m"), (1, "f"))
    ]
    actors, edges = graph.graph_of_lists(graph.actors_union(*lists))
    layout = graph.laid_out(edges)
    distances = graph.separation_in(layout, graph.seed_lookup(actors, t.SEED_NAME))
    return graph.separation_report(distances, actors, edges, movies=layout.movies)


# Intervals ----------------------------------------------------------------

GAP, PAD, BIN = 5, 5, 1 << 12


def _covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.covered_intervals(t.extents(spark, sf_dir), GAP, ["chrom"], BIN)


@query
def q_covered_intervals(spark, sf_dir):
    return _covered(spark, sf_dir)


@query
def q_padded_intervals(spark, sf_dir):
    mixed = t.extents(spark, sf_dir).select(F.col("mixed").alias("chrom"), "start", "end")
    return intervals.padded_intervals(mixed, PAD, BIN)


@query
def q_scan_bed(spark, sf_dir):
    return genome.scan_bed(spark, t.target_files(spark, sf_dir))


@query
def q_interval_intersect(spark, sf_dir):
    covered = intervals.to_half_open(_covered(spark, sf_dir))
    return intervals.interval_intersect(t.targets(spark, sf_dir), covered, base_bits=7)


def _file_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the part files in name order, numbered from 0."""
    return numbered_lines(spark, path, per_file=False).select("line_no", "value")


@query
def q_bed_sink(spark, sf_dir):
    path = shared_path(spark, "bed")
    sinks.write_bed(_covered(spark, sf_dir), path)
    return _file_lines(spark, path)


@query
def q_region_file(spark, sf_dir):
    path = shared_path(spark, "regions")
    sinks.write_regions(_covered(spark, sf_dir), path)
    return _file_lines(spark, path)


@query
def q_region_strings(spark, sf_dir):
    return intervals.region_strings(_covered(spark, sf_dir))


# Reads --------------------------------------------------------------------


@query
def q_scan_input_files(spark, sf_dir):
    lines = genome.scan_input_files(spark, t.list_files(spark, sf_dir))
    name = F.regexp_extract("file", r"/(list=\d+)/[^/]+$", 1)  # the part files' own names differ between runs
    return lines.groupBy(name.alias("folder")).agg(F.count("*").alias("lines"))


@query
def q_scan_reads(spark, sf_dir):
    return genome.scan_reads(spark, t.read_files(spark, sf_dir), t.seq_dict(spark, sf_dir))


@query
def q_scan_seq_dict(spark, sf_dir):
    return genome.scan_seq_dict(spark, t.seq_dict_files(spark, sf_dir))


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_ops.mapped_reads(t.reads(spark, sf_dir))


@query
def q_mapped_reads(spark, sf_dir):
    return _mapped(spark, sf_dir)


@query
def q_alignment_end(spark, sf_dir):
    end = alignment_end(F.col("pos"), F.col("cigar"))
    return t.reads(spark, sf_dir).select("qname", "pos", "cigar", end.alias("end"))


@query
def q_quality_encoding(spark, sf_dir):
    fixed = read_ops.quality_encoding(t.quality_reads(spark, sf_dir))
    total = F.aggregate("phred", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return fixed.select(
        "region", "qname", "encoding", F.array_min("phred").alias("lowest"), total.alias("total"), "rejected"
    )


def _lane(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapped reads of the lane with mended qualities."""
    scanned = genome.scan_reads(spark, t.lane_files(spark, sf_dir), t.seq_dict(spark, sf_dir))
    return read_ops.mended_qualities(read_ops.mapped_reads(scanned))


@query
def q_mended_qualities(spark, sf_dir):
    total = F.aggregate("phred", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return _lane(spark, sf_dir).select(
        "region", "qname", "encoding", F.array_min("phred").alias("lowest"), total.alias("total"), "rejected"
    )


@query
def q_covered_targets(spark, sf_dir):
    """Reads to covered stretches to the parts of the targets in them."""
    extents = read_ops.covering_extents(_lane(spark, sf_dir).where("NOT rejected"))
    covered = intervals.to_half_open(intervals.covered_intervals(extents))
    return intervals.interval_intersect(genome.scan_bed(spark, t.lane_target_files(spark, sf_dir)), covered)


@query
def q_clean_reads(spark, sf_dir):
    cleaned = read_ops.clean_reads(t.reads(spark, sf_dir), t.seq_dict(spark, sf_dir))
    return cleaned.select("qname", "flag", "rname", "pos", "cigar", "mapq", "was_clipped")


@query
def q_mark_duplicates(spark, sf_dir):
    return read_ops.mark_duplicates(_mapped(spark, sf_dir)).drop("seq", "tlen")


@query
def q_duplicate_metrics(spark, sf_dir):
    tagged = read_ops.read_group_tag(read_ops.mark_duplicates(_mapped(spark, sf_dir)))
    return read_ops.duplicate_metrics(tagged)


@query
def q_library_metrics(spark, sf_dir):
    """A library per sequence."""
    marked = read_ops.mark_duplicates(_mapped(spark, sf_dir))
    return read_ops.library_metrics(marked.withColumn("library", F.concat(F.lit("LIB"), "ref_index")))


@query
def q_read_group_tag(spark, sf_dir):
    return read_ops.read_group_tag(_mapped(spark, sf_dir)).drop("seq", "qual", "tlen")


@query
def q_region_counts(spark, sf_dir):
    return read_ops.region_counts(_mapped(spark, sf_dir))


@query
def q_reads_by_region(spark, sf_dir):
    return read_ops.reads_by_region(_mapped(spark, sf_dir)).select("region", "pos", "qname", "flag", "cigar")


@query
def q_coordinate_sort(spark, sf_dir):
    order = [*read_ops.COORDINATE, "cigar"]
    return with_ordinal(_mapped(spark, sf_dir).select(*order), order)


@query
def q_reads_sorted_sink(spark, sf_dir):
    path = shared_path(spark, "sorted_reads")
    sinks.write_reads(_mapped(spark, sf_dir), path)
    return spark.read.parquet(path).drop("seq", "tlen")


REGION = (3, 400, 900)


@query
def q_reads_in_region(spark, sf_dir):
    """All mapped reads are written in order and indexed; those of one stretch are looked up."""
    path, index = shared_path(spark, "sorted_reads"), shared_path(spark, "read_index")
    sinks.write_reads(_mapped(spark, sf_dir), path)
    read_index.write_read_index(spark, path, index)
    return read_index.reads_in_region(spark, path, index, *REGION).select("qname", "flag", "ref_index", "pos", "cigar")


TASKS = 8


def _assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = t.table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("key")).agg(F.count("*").alias("n"))
    return balance.region_assignment(weights, TASKS)


@query
def q_region_assignment(spark, sf_dir):
    return _assignment(spark, sf_dir)


@query
def q_balanced_repartition(spark, sf_dir):
    customers = t.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return balance.balanced_repartition(customers, "c_nationkey", _assignment(spark, sf_dir), ["c_custkey"])


@query
def q_task_partitions(spark, sf_dir):
    """Rows and partitions of each task, and the most tasks that meet in one of its partitions."""
    customers = t.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    placed = balance.placed_by_task(customers, "c_nationkey", _assignment(spark, sf_dir), 2 * TASKS, ["c_custkey"])
    held = placed.groupBy(F.spark_partition_id().alias("at"), "task").agg(F.count("*").alias("rows"))
    held = held.withColumn("met", F.count("*").over(W.partitionBy("at")))
    return held.groupBy("task").agg(
        F.sum("rows").alias("rows"), F.count("*").alias("partitions"), F.max("met").alias("tasks_met")
    )


@query
def q_grouped_region_apply(spark, sf_dir):
    return balance.region_depth(read_ops.with_alignment_end(_mapped(spark, sf_dir)), tile_width=256)


# Variants -----------------------------------------------------------------


@query
def q_scan_vcf(spark, sf_dir):
    return genome.scan_vcf(spark, t.variant_files(spark, sf_dir))


def _variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genome.scan_vcf(spark, t.variant_files(spark, sf_dir))


@query
def q_variants_ordered(spark, sf_dir):
    kept = variants.ordered_variants(_variants(spark, sf_dir)).select("chrom", "pos", "line")
    return with_ordinal(kept, ["chrom", "pos", "line"])


@query
def q_variants_file(spark, sf_dir):
    path = shared_path(spark, "variants_file")
    sinks.write_variants(_variants(spark, sf_dir), path)
    return _file_lines(spark, path)


@query
def q_variants_by_region(spark, sf_dir):
    path = shared_path(spark, "variants_by_region")
    sinks.write_variants_by_region(_variants(spark, sf_dir), path)
    return spark.read.text(path).select("region", F.col("value").alias("line"))


@query
def q_vcf_compare(spark, sf_dir):
    return variants.compare_variants(*t.variant_sets(spark, sf_dir))


# Texts and paired reads ---------------------------------------------------


@query
def q_clean_text(spark, sf_dir):
    return t.posts(spark, sf_dir).select("doc_id", one_line(clean_text(F.col("text"))).alias("cleaned"))


@query
def q_script_fix(spark, sf_dir):
    rows = t.script_texts(spark, sf_dir)
    return rows.select("doc_id", "code", script_fix(F.col("code"), F.col("text")).alias("fixed"))


@query
def q_language_id(spark, sf_dir):
    docs = t.table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return language_id.identify_language(docs, language_id.language_profiles(docs))


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_profiles(t.table(spark, sf_dir, "documents").select("lang", "text"))


@query
def q_language_detect(spark, sf_dir):
    """Clean-up, identification and script rule in a row, on posts."""
    found = language_id.detect_language(t.posts(spark, sf_dir), _profiles(spark, sf_dir))
    return found.select("doc_id", "lang", F.length("text").cast("bigint").alias("letters"))


@query
def q_retweet_window_detected(spark, sf_dir):
    """The trend job on posts whose language is told from their text; the slide does not divide the window."""
    posts = language_id.detect_language(t.timed_posts(spark, sf_dir), _profiles(spark, sf_dir))
    rows = trends.retweet_windows(posts, "10 hours", "4 hours")
    return rows.drop("text").withColumns({c: F.col(c).cast("string") for c in ("window_start", "window_end")})


@query
def q_fastq_interleave_chunks(spark, sf_dir):
    sides = [fastq.scan_fastq(spark, t.mate_files(spark, sf_dir, mate)) for mate in (0, 1)]
    return mates.interleave_chunks(*sides, chunks=8)


@query
def q_fastq_unpaired(spark, sf_dir):
    return mates.unpaired_records(*(fastq.scan_fastq(spark, t.mate_files(spark, sf_dir, mate)) for mate in (0, 1)))


@query
def q_fastq_chunk_files(spark, sf_dir):
    """The interleaved chunks are written and scanned again, in path order."""
    path = shared_path(spark, "chunks")
    sinks.write_chunks(q_fastq_interleave_chunks(spark, sf_dir), path)
    return fastq.scan_fastq(spark, path)
