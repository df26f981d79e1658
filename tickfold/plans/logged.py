"""The page loop into a sink with a log of commits.

A round reads the next pages between two keys, tags every outcome in one pass (records, means
that can't be written, means whose date has not come, bad cells), stages them as one write split
by kind, and commits them together with the read position. A round sees one list of files: the
source frame is made once for it.

A long backlog is read in rounds that grow: after ``STEADY_ROUNDS`` each takes twice the pages of the
one before, so their number grows with the logarithm of the backlog up to ``GROWN_TICKS``. The pages
of such a round are numbered like those of a backfill, by counts, and no list of them is made.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tickfold.functions import key_millis, parse_int, timestamp_of
from tickfold.operators import known_pages, mark_due, mark_readings, unpivot_map, unpivot_static
from tickfold.operators.pages import hour_table, part_table
from tickfold.plans.backfill import means_of_pages, paged_rows, source_rows
from tickfold.schema import MAX_BATCHES, MIN_PAGE_ROWS, PAGE_SIZE, RUN_LENGTH
from tickfold.sources.commits import LoggedSink, Snapshot
from tickfold.sources.wide import PageFinder, key_after, key_range, key_until

STEADY_ROUNDS = 4  # rounds of the size asked for, before they grow
GROWN_TICKS = 10_000_000  # of a round, at most, unless more are asked for


@dataclass(frozen=True)
class RunReport:
    batches: int
    rounds: int
    status: str  # "not enough data", "held", "max batches" or "stopped"
    position: int | None = None  # the key after which a later run may go on
    rejected: int = 0  # means that could not be written


def bad_cells(rows: DataFrame, cells: Sequence[str] | str) -> DataFrame:
    """``row_key, qualifier, cell, reason`` of the cells that are no integers."""
    long = unpivot_map(rows, cells) if isinstance(cells, str) else unpivot_static(rows, cells)
    return mark_readings(long).where("reason IS NOT NULL").select(
        "row_key",
        F.col("sensor_id").cast("string").alias("qualifier"),
        F.col("value").alias("cell"),
        "reason",
    )


def _outcomes(means: DataFrame) -> DataFrame:
    """Means (``page_key, chunk_idx, sensor_id, ms, value, due``) with their kind."""
    # The same checks as ``mark_sink_rows``, with the columns of what is held kept.
    sensor_id = parse_int(F.col("sensor_id").cast("string"))
    value = F.col("value").try_cast("double")
    reason = F.when(value.isNull(), "bad value").when(sensor_id.isNull(), "bad sensor_id")
    kind = F.when(reason.isNotNull(), "rejects").when(F.col("due"), "records").otherwise("held")
    return means.select(
        "page_key",
        F.col("chunk_idx").cast("long").alias("chunk_idx"),
        "ms",
        timestamp_of(F.col("ms").cast("bigint")).alias("date"),
        value.alias("value"),
        sensor_id.alias("sensor_id"),
        reason.alias("reason"),
        kind.alias("kind"),
    )


def _watched(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """Rows with counts by kind and the newest date of a good mean, known once they are written."""
    seen = Observation(f"round {uuid.uuid4().hex}")
    count = lambda kind: F.count_if(F.col("kind") == kind).alias(kind)
    good = F.col("kind").isin("records", "held")
    watched = rows.observe(
        seen,
        *[count(k) for k in ("records", "rejects", "bad_cells", "held")],
        F.max(F.when(good, F.col("ms"))).alias("newest"),
    )
    return watched, seen


def _staged(sink: LoggedSink, rows: DataFrame) -> tuple[dict[str, str | None], dict]:
    watched, seen = _watched(rows)
    folder = sink.stage(watched, "kind")
    counts = seen.get
    added = {k: sink.part_of(folder, "kind", k) if counts[k] else None for k in sink.schemas}
    return added, counts


def release_held(spark: SparkSession, sink: LoggedSink, now_ms: int) -> Snapshot:
    """Write the stored run groups that are due, up to the first that is not."""
    base = sink.latest(spark)
    if not base.state.get("held"):
        return base
    held = sink.read(spark, "held", base)
    groups = held.withColumns({"part": F.col("page_key"), "page_id": F.col("page_key")})
    added, counts = _staged(sink, _outcomes(mark_due(groups, now_ms)))
    if not counts["records"]:
        return base
    return sink.publish(spark, base, added, {"held": counts["held"]}, replaced=("held",))


def full_pages(
    df: DataFrame, after: int, high: int, n_pages: int, page_size: int, key_order: str
) -> tuple[int, int] | None:
    """The last key and the number of full pages, ``n_pages`` at most, that begin after a key and
    end before another, from counts of keys. The last few pages there are left for later. ``None`` if
    there are too few, or if keys repeat: those are counted page by page."""
    near = key_until(key_after(df, after, 0, key_order=key_order), high, key_order=key_order)
    keys = near.select(key_millis("row_key").alias("ms"))
    parts = part_table(*hour_table(keys, page_size=page_size))
    begins = parts.selectExpr("lo", "part * span AS ticks").where(F.col("ticks") <= n_pages * page_size)
    end = begins.agg(F.max("lo").alias("lo"), F.max("ticks").alias("ticks")).first()
    if not end["ticks"]:
        return None
    done = key_range(key_until(near, end["lo"] - 1, key_order=key_order), after, key_order=key_order)
    return (done.last, end["ticks"] // page_size) if done.rows == end["ticks"] else None


def run_logged(
    spark: SparkSession,
    source: DataFrame | Callable[[], DataFrame],
    sink: LoggedSink,
    cells: Sequence[str] | str,
    *,
    page_size: int = PAGE_SIZE,
    run_length: int = RUN_LENGTH,
    min_rows: int = MIN_PAGE_ROWS,
    max_batches: int = MAX_BATCHES,
    pages_per_round: int = 1,
    start_after: int | None = None,
    key_order: str = "string",
    clock: Callable[[], float] = time.time,
    stop: Callable[[], bool] = lambda: False,
    **mean_options: str,
) -> RunReport:
    """See ``run_incremental``."""
    whole = page_size % run_length == 0
    if pages_per_round > 1 and not whole:
        raise ValueError("more than one page in a round needs pages of a whole number of runs")
    finder = PageFinder(page_size, key_order, growing=callable(source))
    batches = rounds = rejected = 0
    pace = 0.0  # distance of keys in a page of the last round

    def grown_round(df: DataFrame, now_ms: int) -> tuple[int, int] | None:
        """Last key and number of pages of a round that is larger than asked for."""
        most = max(pages_per_round, GROWN_TICKS // page_size)
        n_pages = min(pages_per_round << min(rounds - STEADY_ROUNDS + 1, 40), most, max_batches - batches)
        known = finder.known
        if not whole or not pace or n_pages <= pages_per_round or known is None or position >= known.last:
            return None
        if key_order == "string" and len(str(known.first)) != len(str(known.last)):
            return None  # text order is not that of numbers
        high = min(position + round(pace * n_pages), known.last, now_ms)
        return full_pages(df, position, high, n_pages, page_size, key_order) if high > position else None

    def report(status: str) -> RunReport:
        return RunReport(batches, rounds, status, position, rejected)

    while True:
        now_ms = int(clock() * 1000)
        base = release_held(spark, sink, now_ms)
        position = base.state.get("position", start_after)
        if base.state.get("held"):
            return report("held")
        if batches >= max_batches:
            return report("max batches")
        if stop():
            return report("stopped")
        df = source() if callable(source) else source
        grown = grown_round(df, now_ms) if rounds >= STEADY_ROUNDS else None
        if grown:
            (last_key, n_done), last_size = grown, page_size
        else:
            found = finder.next(df, position, min(pages_per_round, max_batches - batches))
            pages = [page for page in found if page[1] >= min_rows]
            if not pages:
                return report("not enough data")
            (last_key, last_size), n_done = pages[-1], len(pages)
        rows = key_until(key_after(df, position, 0, key_order=key_order), last_key, key_order=key_order)
        if grown:
            paged = paged_rows(source_rows(rows, cells), page_size, min_rows)
            page_key = F.lit(None)  # none of them is held
        else:
            paged = known_pages(source_rows(rows, cells), pages, "ms")
            page_key = F.get(F.array(*[F.lit(k) for k, _ in pages]), F.col("part").cast("int"))
        means = means_of_pages(paged, cells, run_length, **mean_options)
        due = means.withColumn("due", F.lit(True)) if last_key <= now_ms else mark_due(means, now_ms)
        outcomes = _outcomes(due.withColumn("page_key", page_key.cast("long")))
        if mean_options.get("on_error") == "reject":
            bad = bad_cells(rows, cells).withColumn("kind", F.lit("bad_cells"))
            outcomes = outcomes.unionByName(bad, allowMissingColumns=True)
        added, counts = _staged(sink, outcomes)
        done = last_key
        if (last_size < page_size or not whole) and counts["newest"] is not None:
            done = counts["newest"]
        state = {
            "position": done,
            "held": counts["held"],
            "rejected": base.state.get("rejected", 0) + counts["rejects"],
            "bad_cells": base.state.get("bad_cells", 0) + counts["bad_cells"],
        }
        sink.publish(spark, base, added, state)
        pace = 0.0 if position is None else (last_key - position) / n_done
        rejected += counts["rejects"]
        batches += n_done
        rounds += 1
