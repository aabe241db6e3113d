"""URL filters: rules, and templates of paths judged by the pages that rules have judged.

The paths of a host form a tree of segments. Going down, a segment value stays as it is if a fair share of its
parent's pages has it, all other values become a wildcard; so a node has few named children. Named
children whose share of blocked pages does not differ significantly are merged into one branch. A leaf is a
template; it is rejected if its smoothed purity, the share of blocked among its labelled pages, is high.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.cluster import checkpointed

# Rule, verdict: host and path prefix.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

LEVELS = 6  # segments that templates tell apart; what follows is one rest
NAMED_SHARE = 0.02  # of its parent's pages that a named segment needs, so at most fifty are named
NAMED_PAGES = 5
SIGNIFICANT = 1.96  # standard errors between branches that stay apart
WEIGHT = 5.0  # pseudo-pages of the parent's rate in a purity
REJECT = 0.5

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and where no ``://`` is."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _UPPER.lower()), path


def rule_columns(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, or nulls."""
    rule = verdict = F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        domain, _, rest = text.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit("/" + rest))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _named(tree: DataFrame, level: int) -> DataFrame:
    """``(host, prefix, segment, step)`` of the named children at a level, merged where similar."""
    segment = F.get("segments", F.lit(level))
    children = (
        tree.where(F.size("segments") > level)
        .groupBy("host", "prefix", segment.alias("segment"))
        .agg(F.sum("n").alias("n"), F.sum("blocked").alias("blocked"))
    )
    parents = children.groupBy("host", "prefix").agg(F.sum("n").alias("total"))
    named = children.join(parents, ["host", "prefix"]).where(
        (F.col("n") >= NAMED_PAGES) & (F.col("n") >= NAMED_SHARE * F.col("total"))
    )
    # At most 1 / NAMED_SHARE children of a node are left, so these windows are small.
    by_rate = W.partitionBy("host", "prefix").orderBy("rate", "segment")
    rated = named.withColumn("rate", F.col("blocked") / F.col("n"))
    n0, b0 = F.lag("n").over(by_rate), F.lag("blocked").over(by_rate)
    pooled = (F.col("blocked") + b0) / (F.col("n") + n0)
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.col("n") + 1 / n0))
    apart = (F.col("rate") - b0 / n0) > SIGNIFICANT * error
    branch = F.sum(F.coalesce("apart", F.lit(False)).cast("int")).over(by_rate)
    grouped = rated.withColumn("apart", apart).withColumn("branch", branch)
    step = F.array_join(F.array_sort(F.collect_list("segment").over(W.partitionBy("host", "prefix", "branch"))), "|")
    return grouped.select("host", "prefix", "segment", step.alias("step"))


def path_templates(pages: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``(host, path, template, purity)`` per distinct pair of ``pages(host, path, verdict)``; a null verdict is no label."""
    paths = pages.groupBy("host", "path").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("verdict") == "block").alias("blocked"),
        F.count("verdict").alias("labelled"),
    )
    segments = F.filter(F.split("path", "/", -1), lambda s: s != "")
    tree = checkpointed(paths.withColumn("segments", segments).withColumn("prefix", F.lit("")))
    for level in range(levels):
        named = _named(tree, level)
        has = F.size("segments") > level
        tree = checkpointed(
            tree.withColumn("segment", F.get("segments", F.lit(level)))
            .join(named, ["host", "prefix", "segment"], "left")
            .withColumn("prefix", F.when(has, F.concat("prefix", F.lit("/"), F.coalesce("step", F.lit("*")))).otherwise(F.col("prefix")))
            .drop("segment", "step")
        )
    template = F.when(F.size("segments") > levels, F.concat("prefix", F.lit("/**"))).otherwise(F.col("prefix"))
    rows = tree.select("host", "path", template.alias("template"), "n", "blocked", "labelled")
    sums = [F.sum(c).alias(c) for c in ("n", "blocked", "labelled")]
    templates = rows.groupBy("host", "template").agg(*sums)
    # A page without a label counts against the rate that a template starts from.
    every = templates.agg((F.sum("blocked") / F.sum("n")).alias("rate")).first()["rate"] or 0.0
    hosts = templates.groupBy("host").agg(((F.sum("blocked") + WEIGHT * every) / (F.sum("n") + WEIGHT)).alias("rate"))
    purity = (F.col("blocked") + WEIGHT * F.col("rate")) / (F.col("labelled") + WEIGHT)
    judged = templates.join(hosts, "host").select("host", "template", purity.alias("purity"))
    return rows.select("host", "path", "template").join(judged, ["host", "template"])


def filter_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """``(page_id, host, path, rule, verdict, template, purity)`` per row of ``pages(page_id, url)``.

    The verdict is the longest fitting rule's, else ``block`` where the template's purity is at least
    ``REJECT``, else ``allow``. A null url, or one without ``://``, has an empty host and path, which are
    judged like any other. Repeated rows stay and count each time; other columns are ignored. Runs jobs.
    """
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    ruled = parts.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))
    templates = checkpointed(path_templates(ruled))
    by_method = F.when(F.col("purity") >= REJECT, "block").otherwise("allow")
    return ruled.join(templates, ["host", "path"]).select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", by_method).alias("verdict"), "template", "purity"
    )
