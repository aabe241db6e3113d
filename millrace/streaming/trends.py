"""The trend job as a stream: windows close by watermark, each batch logs closed windows.

The state is one row per pane and post, in tables beside the checkpoint; windows are made of panes when they close.
When the input has ended, the windows that no later row will close are made of the panes that the stopped query left
and written as one more batch (``close_stream``, ``close_stream_log``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.cluster import (
    broadcast_if_small,
    checkpointed,
    drop_path,
    names_in,
    path_exists,
    small_side,
    wide_partitions,
    wide_shuffles,
    written,
)
from millrace.operators.trends import (
    add_growth,
    build_windows,
    interval_micros,
    language_totals,
    log_lines,
    pane_counts,
    retweet_filter,
    skip_warmup,
    window_order,
    with_language_totals,
)
from millrace.sources.retweet_log import LOG_HEADER

OPEN_BATCH = -2  # folder of the windows that were open at the end
HEADER_BATCH = -1
PANE = ["ts", "id", "max_count", "min_count", "first_seen"]


@dataclass
class Clock:
    """What a batch left behind: its window and slide, and up to when windows are closed (none: no row yet)."""

    window: str
    slide: str
    newest: int | None = None  # microseconds
    closed: int | None = None


def _state(checkpoint: str, batch_id: int, name: str = "") -> str:
    return f"{checkpoint}/panes/{batch_id}/{name}"


def _read_clock(spark: SparkSession, checkpoint: str, batch_id: int) -> Clock:
    row = spark.read.schema("window string, slide string, newest long, closed long").parquet(_state(checkpoint, batch_id, "clock")).first()
    return Clock(**row.asDict())


def _advanced(clock: Clock, panes: DataFrame, delay: str) -> Clock:
    """The clock after these panes: windows close ``delay`` behind the newest row, and none opens again."""
    found = panes.agg(F.max("newest").alias("newest"))
    behind = F.unix_micros(F.col("newest") - F.expr(f"interval {delay}"))
    newest, closed = found.select(F.unix_micros("newest"), behind).first()
    if newest is None or (clock.newest is not None and newest <= clock.newest):
        return clock
    return Clock(clock.window, clock.slide, newest, closed)


def _moment(micros: int) -> Column:
    return F.timestamp_micros(F.lit(micros).cast("long"))


def _windows(panes: DataFrame, clock: Clock, after: int | None, until: int | None, mode: str) -> DataFrame:
    """Windows of the panes that end after and until these moments, as far as given.

    Panes are dealt out by post first, so that they move and not the windows, which are more by ``copies``.
    """
    window, slide = interval_micros(panes.sparkSession, clock.window, clock.slide)
    parts = wide_partitions(panes, copies=math.ceil(window / slide))
    rows = build_windows(panes.repartition(parts, "id"), clock.window, clock.slide)
    if after is not None:
        rows = rows.where(F.col("window_end") > _moment(after))
    if until is not None:
        rows = rows.where(F.col("window_end") <= _moment(until))
    return add_growth(rows, mode)


def _closing(batch: DataFrame, batch_id: int, checkpoint: str, before: Clock, delay: str, mode: str) -> tuple[DataFrame, Clock]:
    """The windows that close with this batch, and the clock after it; the panes still needed are written."""
    spark = batch.sparkSession
    rows = batch
    if batch_id:
        rows = rows.unionByName(spark.read.schema(batch.schema).parquet(_state(checkpoint, batch_id - 1, "open")))
    panes = written(pane_counts(rows, before.window, before.slide), _state(checkpoint, batch_id, "all"))
    clock = _advanced(before, panes, delay)
    needed = panes.select(*PANE)
    if clock.closed is not None:
        needed = needed.where(F.col("ts") + F.expr(f"interval {clock.window}") > _moment(clock.closed))
    written(needed, _state(checkpoint, batch_id, "open"))
    until = clock.closed if clock.closed is not None else -(1 << 62)
    return written(_windows(panes, clock, before.closed, until, mode), _state(checkpoint, batch_id, "closed")), clock


def _start(
    statuses: DataFrame, write_batch, checkpoint: str, window: str, slide: str, delay: str, trigger: dict[str, object], mode: str = "floor_one"
) -> StreamingQuery:
    """Run ``write_batch(closed windows, their totals, batch)``.

    ``ts`` must be a timestamp with time zone. Windows close ``delay`` behind the newest row, and later rows
    count in the windows still open. A batch reads the panes that the one before left and leaves its own, so a
    repeated batch finds the same; those of the one before stay until the next has ended.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        drop_path(spark, _state(checkpoint, batch_id))
        before = _read_clock(spark, checkpoint, batch_id - 1) if batch_id else Clock(window, slide)
        if (before.window, before.slide) != (window, slide):
            raise ValueError(f"{checkpoint} holds panes of windows of {before.window} every {before.slide}")
        closed, clock = _closing(batch, batch_id, checkpoint, before, delay, mode)
        totals = written(language_totals(closed), _state(checkpoint, batch_id, "totals"))
        with wide_shuffles(closed):
            write_batch(closed, broadcast_if_small(totals), batch_id)
        columns = (F.lit(v).alias(k) for k, v in (("window", window), ("slide", slide)))
        times = (F.lit(v).cast("long").alias(k) for k, v in (("newest", clock.newest), ("closed", clock.closed)))
        written(spark.range(1).select(*columns, *times).coalesce(1), _state(checkpoint, batch_id, "clock"))
        for name in ("all", "closed", "totals"):
            drop_path(spark, _state(checkpoint, batch_id, name))
        drop_path(spark, _state(checkpoint, batch_id - 2))

    return (
        retweet_filter(statuses)
        .withWatermark("ts", delay)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(run)
        .start()
    )


def open_windows(spark: SparkSession, checkpoint: str, mode: str = "floor_one") -> DataFrame | None:
    """Windows still open when the query stopped, as closed ones come; null if it never ended a batch."""
    ended = [int(n) for n in names_in(spark, f"{checkpoint}/panes") if path_exists(spark, _state(checkpoint, int(n), "clock/_SUCCESS"))]
    if not ended:
        return None
    clock = _read_clock(spark, checkpoint, max(ended))
    return _windows(spark.read.parquet(_state(checkpoint, max(ended), "open")), clock, clock.closed, None, mode)


def close_stream(spark: SparkSession, out: str, checkpoint: str) -> None:
    """After ``retweet_stream`` has stopped: write the windows still open. Repeating it changes nothing."""
    rows = open_windows(spark, checkpoint)
    if rows is not None:
        rows = checkpointed(rows)
        with wide_shuffles(rows):
            _write_windows(rows, small_side(language_totals(rows)), out, OPEN_BATCH)


def close_stream_log(spark: SparkSession, out: str, checkpoint: str, window: str = "60 seconds") -> None:
    """After ``retweet_stream_log`` has stopped: log the windows still open. Repeating it changes nothing."""
    rows = open_windows(spark, checkpoint)
    if rows is not None:
        rows = checkpointed(rows)
        with wide_shuffles(rows):
            _write_log(rows, small_side(language_totals(rows)), out, OPEN_BATCH, window)


def _write_windows(batch: DataFrame, totals: DataFrame, out: str, batch_id: int) -> None:
    rows = with_language_totals(batch, totals).repartitionByRange("window_end", *window_order())
    rows.sortWithinPartitions("window_end", *window_order()).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")


def _first_end(batch: DataFrame, out: str) -> datetime | None:
    """End of the first window, kept beside the log from the first batch that has one; the header is written then."""
    spark, state = batch.sparkSession, f"{out}/_first_end"
    if path_exists(spark, f"{state}/_SUCCESS"):
        return spark.read.schema("first_end timestamp").parquet(state).first()["first_end"]
    found = batch.agg(F.min("window_end").alias("first_end")).first()["first_end"]
    if found is not None:
        header = spark.createDataFrame([(LOG_HEADER,)], "value string")
        header.write.mode("overwrite").text(f"{out}/log/batch={HEADER_BATCH}")
        spark.createDataFrame([(found,)], "first_end timestamp").write.mode("overwrite").parquet(state)
    return found


def _write_log(batch: DataFrame, totals: DataFrame, out: str, batch_id: int, window: str) -> None:
    start = _first_end(batch, out)
    if start is None:
        return
    logged = skip_warmup(with_language_totals(batch, totals), F.lit(start), window)
    order = ["window_end", *window_order()]
    lines = log_lines(logged.repartitionByRange(*order).sortWithinPartitions(*order)).select("value")
    lines.write.mode("overwrite").text(f"{out}/log/batch={batch_id}")


def retweet_stream(
    statuses: DataFrame,
    out: str,
    checkpoint: str,
    window: str = "60 seconds",
    slide: str = "5 seconds",
    delay: str = "5 seconds",
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Append every closed window, with its language totals, as Parquet.

    A batch holds closed windows whole, so totals, join and order are ordinary
    batch work. Each batch overwrites its own folder: a repeated batch changes
    nothing. A restart takes back what ``close_stream`` wrote, as those windows are open again.
    """
    drop_path(statuses.sparkSession, f"{out}/batch={OPEN_BATCH}")

    def write_batch(batch: DataFrame, totals: DataFrame, batch_id: int) -> None:
        _write_windows(batch, totals, out, batch_id)

    return _start(statuses, write_batch, checkpoint, window, slide, delay, trigger or {"processingTime": "1 second"})


def retweet_stream_log(
    statuses: DataFrame,
    out: str,
    checkpoint: str,
    window: str = "60 seconds",
    slide: str = "5 seconds",
    delay: str = "5 seconds",
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Append log lines of closed windows once the warm-up has passed.

    The end of the first window, from which seconds count, is the smallest one of
    the first batch that closes any. It is kept beside the log, so a restarted job
    counts on from the same moment. The header is written then, as batch -1. A restart takes back
    what ``close_stream_log`` wrote.
    """
    drop_path(statuses.sparkSession, f"{out}/log/batch={OPEN_BATCH}")

    def write_batch(batch: DataFrame, totals: DataFrame, batch_id: int) -> None:
        _write_log(batch, totals, out, batch_id, window)

    return _start(statuses, write_batch, checkpoint, window, slide, delay, trigger or {"processingTime": "1 second"})
