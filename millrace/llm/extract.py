"""Main text of web pages by site style trees.

The pages of a host are merged: elements with the same path of tags and names are one node. A node
is a presentation node by the ways its children are laid out, and a content node by the blocks of
text right below it. Layouts that never change and blocks that return on page after page have low
entropy-based importance; branches of low importance are removed from each page, as are elements
that their tag, role or name marks as something other than an article.

Article and main elements are a prior: outside them a block stays if its node was judged and is
important, and goes if the host has too few pages to judge it. Only distinct pages count, so copies of
a page do not make its article look like a frame; and where headings and paragraphs right below an
article would go that outweigh all that stays, they stay.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.cluster import checkpointed
from millrace.llm.dom import parse

MIN_PAGES = 5  # distinct pages of a host that must share a node before it can be judged
LOW = 0.25  # importance below which a branch goes
DAMPING = 0.9

_NODE = "host string, page long, path string, content boolean, feature long"


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def host_of(url: str | None) -> str:
    rest = (url or "").partition("://")[2]
    for stop in "/?#":
        rest = rest.partition(stop)[0]
    return rest.lower()


def _node_batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each block and each layout of each page."""
    for batch in source:
        columns: list[list] = [[], [], [], [], []]
        for url, text in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True):
            page, key, host = parse(text or ""), _hash(text or ""), host_of(url)
            rows = {(p, True, _hash(t)) for p, t, _, _ in page.blocks} | {(p, False, _hash(s)) for p, s in page.styles}
            for path, content, feature in rows:
                for column, value in zip(columns, (host, key, path, content, feature), strict=True):
                    column.append(value)
        kinds = (pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.int64())
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=["host", "page", "path", "content", "feature"])


def node_statistics(pages: DataFrame) -> DataFrame:
    """Per host and path: distinct pages, and the importance of its layouts and of its blocks."""
    seen = pages.select("url", "html").mapInArrow(_node_batches, _NODE).distinct()
    features = seen.groupBy("host", "path", "content", "feature").agg(F.count("*").alias("c"))
    spread = features.groupBy("host", "path").agg(
        F.count_if("content").alias("blocks"),
        F.sum(F.when(F.col("content"), F.log("c"))).alias("log_c"),
        F.count_if(~F.col("content")).alias("layouts"),
        F.sum(F.when(~F.col("content"), F.col("c"))).alias("layout_rows"),
        F.sum(F.when(~F.col("content"), F.col("c") * F.log("c"))).alias("c_log_c"),
    )
    pages_of = (
        seen.groupBy("host", "path", "page").agg(F.lit(1).alias("one")).groupBy("host", "path").agg(F.count("*").alias("m"))
    )
    return spread.join(pages_of, ["host", "path"]).where(F.col("m") >= MIN_PAGES).select(
        "host",
        "path",
        "m",
        "layouts",
        # A block on c of m pages has entropy log(c) / log(m) over the pages.
        F.when(F.col("blocks") > 0, 1 - F.col("log_c") / F.col("blocks") / F.log("m")).alias("content"),
        F.when(
            F.col("layouts") > 0, (F.log("layout_rows") - F.col("c_log_c") / F.col("layout_rows")) / F.log("m")
        ).alias("layout"),
    )


def _unimportant(rows: pd.DataFrame) -> pd.DataFrame:
    """The branches of a host's tree that were judged, and which of them have low composite importance. A row per distinct path."""
    below: dict[str, list[tuple[float, float]]] = {}
    importance: dict[str, float] = {}
    table = rows.sort_values("path", key=lambda p: -p.str.count(">"), kind="stable")
    for path, m, layouts, content, layout in table[["path", "m", "layouts", "content", "layout"]].itertuples(index=False):
        parts = list(below.pop(path, []))
        if content is not None and not math.isnan(content):
            parts.append((m, content))
        inner = sum(w * v for w, v in parts) / sum(w for w, _ in parts) if parts else 1.0
        value = inner
        if layouts:
            fade = DAMPING**layouts
            value = (1 - fade) * layout + fade * inner
        importance[path] = value
        below.setdefault(path.rpartition(">")[0], []).append((m, value))
    low = [v < LOW and p.count(">") > 2 for p, v in importance.items()]
    host = rows["host"].iloc[0]
    return pd.DataFrame({"host": [host] * len(low), "path": list(importance), "low": low}, dtype=object)


def judged_branches(pages: DataFrame) -> DataFrame:
    """``(host, path, low)`` of the branches that can be judged. Groups hold a row per distinct path, not per page."""
    return node_statistics(pages).groupBy("host").applyInPandas(_unimportant, "host string, path string, low boolean")


def low_branches(pages: DataFrame) -> DataFrame:
    """``(host, path)`` of the branches to remove."""
    return judged_branches(pages).where("low").drop("low")


_PROSE = frozenset(("h1", "h2", "h3", "h4", "h5", "h6", "p", "blockquote", "pre"))


def main_text(html: str, removed: frozenset[str], important: frozenset[str] = frozenset()) -> str:
    """Text of the blocks that stay; ``removed`` and ``important`` are the host's judged paths, low and not."""
    page = parse(html)
    kinds = {mark for _, _, noise, mark in page.blocks if mark and not noise}
    wanted = "article" if "article" in kinds else "main" if "main" in kinds else ""
    stays, own = [], []
    for path, _, noise, mark in page.blocks:
        steps = path.split(">")
        within = bool(wanted) and mark == wanted
        inside = max((k for k, s in enumerate(steps) if s.split(".")[0] == wanted), default=0) if within else 0
        low = bool(removed) and any(">".join(steps[: k + 1]) in removed for k in range(inside + 1, len(steps)))
        stays.append(not noise and not low and (within or not wanted or path in important))
        own.append(not noise and within and all(s.split(".")[0] in _PROSE for s in steps[inside + 1 :]))
    size = [len(text) for _, text, _, _ in page.blocks]
    if sum(n for n, s, o in zip(size, stays, own, strict=True) if o and not s) > sum(n for n, s in zip(size, stays, strict=True) if s):
        stays = [s or o for s, o in zip(stays, own, strict=True)]
    return "\n".join(text for (_, text, _, _), s in zip(page.blocks, stays, strict=True) if s)


def extract_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` per row of ``pages(page_id, url, html)``.

    Character references are decoded, white space inside a block becomes one space, blocks are joined by
    a line feed in page order. A null or empty html gives an empty text. Pages without a host (null or
    malformed url) form one site. Hosts with fewer than ``MIN_PAGES`` distinct pages lose only elements marked by tag,
    role or name. Repeated rows stay; other columns are ignored. Runs jobs.
    """
    rows = pages.select("page_id", "url", "html")
    kind = dict(rows.dtypes)["page_id"]
    # A host's lists have its distinct judged paths; the join is left to Spark, which splits a hot host.
    lists = checkpointed(judged_branches(rows)).groupBy("host").agg(
        F.collect_list(F.when(F.col("low"), F.col("path"))).alias("removed"),
        F.collect_list(F.when(~F.col("low"), F.col("path"))).alias("important"),
    )
    rest = F.when(F.instr("url", "://") > 0, F.substring_index(F.expr("substr(url, instr(url, '://') + 3)"), "/", 1))
    host = F.lower(F.substring_index(F.substring_index(rest, "?", 1), "#", 1))
    joined = rows.withColumn("host", F.coalesce(host, F.lit(""))).join(lists, "host", "left").drop("host")

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            texts = [
                main_text(h or "", frozenset(r or ()), frozenset(i or ()))
                for h, r, i in zip(*(batch.column(c).to_pylist() for c in ("html", "removed", "important")), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array(np.array([len(t) for t in texts], np.int64)),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return joined.select("page_id", "url", "html", "removed", "important").mapInArrow(
        batches, f"page_id {kind}, url string, text string, n_chars long"
    )
