"""Runs of readings per sensor, and their means.

Input is a paged frame of readings: ``part, page_id, n_rows, tick_no, sensor_id, ms, v``.
Windows and groups also name ``part``. Rows are already shuffled by it, so none of these
operators adds an exchange. A (page, sensor) group has at most one reading per tick of the
page, so no group grows with the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tickfold.functions import int_div
from tickfold.operators.unpivot import column_ids, literal_ids, quoted
from tickfold.schema import RUN_LENGTH

PAGE = ["part", "page_id"]


def _cut_tail(paged: DataFrame, run_length: int, tail_policy: str) -> DataFrame:
    if tail_policy == "reference":
        return paged
    if tail_policy == "row_cut":
        return paged.where(f"tick_no < n_rows div {run_length} * {run_length}")
    raise ValueError(f"unknown tail_policy {tail_policy!r}")


def chunk_index(
    paged: DataFrame, run_length: int = RUN_LENGTH, tail_policy: str = "reference"
) -> DataFrame:
    """Add ``chunk_idx``: the run a reading falls in, and ``kept``: whether it is made.

    A page of ``n_rows`` ticks makes ``n_rows div run_length`` runs per sensor; readings
    beyond them are left for the next page. ``tail_policy="row_cut"`` also leaves the
    last ticks of a page that is not a whole number of runs, so that a sensor with gaps
    cannot move the watermark past readings of the others.
    """
    position = "row_number() OVER (PARTITION BY page_id, part, sensor_id ORDER BY ms, v) - 1"
    return (
        _cut_tail(paged, run_length, tail_policy)
        .selectExpr("*", f"({position}) div {run_length} AS chunk_idx")
        .selectExpr("*", f"chunk_idx < n_rows div {run_length} AS kept")
    )


def wide_chunk_index(
    paged: DataFrame,
    cells: Sequence[str],
    run_length: int = RUN_LENGTH,
    tail_policy: str = "reference",
) -> DataFrame:
    """The kept readings of paged wide rows: ``part, page_id, chunk_idx, sensor_id, ms, value``.

    The same runs as ``chunk_index``, for declared columns and one row per tick. A
    reading's position is the running count of its column, so the wide rows are sorted
    by time once and the readings, many more, not at all. Columns that share a sensor id
    would need one count for both; the long form has it.
    """
    if len(set(column_ids(cells))) < len(cells):
        raise ValueError("columns share a sensor id: use chunk_index on readings")
    counts = [
        f"count({quoted(c)}) OVER (PARTITION BY part, page_id ORDER BY ms"
        f" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS position{i}"
        for i, c in enumerate(cells)
    ]
    triples = ", ".join(
        f"{sensor}, {quoted(c)}, (position{i} - 1) div {run_length}"
        for i, (sensor, c) in enumerate(zip(literal_ids(cells), cells))
    )
    return (
        _cut_tail(paged, run_length, tail_policy)
        .selectExpr("part", "page_id", "n_rows", "ms", *[quoted(c) for c in cells], *counts)
        .selectExpr(
            "part", "page_id", "n_rows", "ms",
            f"stack({len(cells)}, {triples}) AS (sensor_id, value, chunk_idx)",
        )
        .where(f"value IS NOT NULL AND chunk_idx < n_rows div {run_length}")
        .drop("n_rows")
    )


def _mean(divisor: Column, rounding: str) -> Column:
    total = F.sum(F.col("v").cast("bigint"))
    if rounding == "trunc":
        return int_div(total, divisor).alias("value")
    if rounding == "exact":
        return (total.cast("double") / divisor).alias("value")
    raise ValueError(f"unknown rounding {rounding!r}")


def chunk_mean(
    paged: DataFrame,
    run_length: int = RUN_LENGTH,
    divisor: str = "fixed",
    rounding: str = "trunc",
    tail_policy: str = "reference",
) -> DataFrame:
    """Mean and last date of each run: ``part, page_id, chunk_idx, sensor_id, ms, value``.

    By default the sum is divided by the run length even when the run is short, and cut
    to an integer. ``divisor="count"`` divides by the readings present;
    ``rounding="exact"`` gives a double.
    """
    runs = chunk_index(paged, run_length, tail_policy).where("kept")
    return run_means(runs, run_length, divisor, rounding)


def run_means(
    runs: DataFrame, run_length: int = RUN_LENGTH, divisor: str = "fixed", rounding: str = "trunc"
) -> DataFrame:
    """The means of ``chunk_mean`` from readings that know their run."""
    if divisor not in ("fixed", "count"):
        raise ValueError(f"unknown divisor {divisor!r}")
    by = F.lit(run_length) if divisor == "fixed" else F.count("v")
    return runs.groupBy(*PAGE, "chunk_idx", "sensor_id").agg(
        F.max("ms").alias("ms"), _mean(by, rounding)
    )


def chunk_tail(paged: DataFrame, run_length: int = RUN_LENGTH) -> DataFrame:
    """Per page and sensor: runs made, readings used and readings left for later."""
    runs = chunk_index(paged, run_length)
    return runs.groupBy(*PAGE, "sensor_id").agg(
        F.countDistinct(F.when(F.col("kept"), F.col("chunk_idx"))).alias("n_runs"),
        F.count_if("kept").alias("n_used"),
        F.count_if(~F.col("kept")).alias("n_left"),
    ).drop("part")


def page_mean(
    paged: DataFrame, divisor: str = "rows", rounding: str = "trunc"
) -> DataFrame:
    """Per page and sensor, the sum divided by the ticks of the page, and the last date."""
    if divisor not in ("rows", "count"):
        raise ValueError(f"unknown divisor {divisor!r}")
    by = F.max("n_rows") if divisor == "rows" else F.count("v")
    return paged.groupBy(*PAGE, "sensor_id").agg(
        F.max("ms").alias("ms"), _mean(by, rounding)
    ).drop("part")


def mean_per_ten(paged: DataFrame) -> DataFrame:
    """Per page and sensor, the sum divided by 10.0."""
    mean = _mean(F.lit(10.0), "exact")
    return paged.groupBy(*PAGE, "sensor_id").agg(mean).drop("part")


def max_chunks(paged: DataFrame, run_length: int = RUN_LENGTH) -> DataFrame:
    """Per page, the largest number of runs any sensor's list has."""
    return paged.groupBy(*PAGE).agg(
        F.max(int_div("n_rows", run_length)).alias("max_chunks")
    ).drop("part")


def sensor_arrays(paged: DataFrame) -> DataFrame:
    """Per page and sensor, its readings in time order (at most one per tick of the page)."""
    return paged.groupBy(*PAGE, "sensor_id").agg(
        F.array_sort(F.collect_list(F.struct("ms", "v"))).alias("readings")
    ).drop("part")


def chunk_groups(means: DataFrame) -> DataFrame:
    """Means regrouped by run: per page and run, the sensors that have it.

    A group holds one mean per sensor seen in the page, so it is no wider than the wide
    rows the page came from.
    """
    return means.groupBy(*PAGE, "chunk_idx").agg(
        F.array_sort(F.collect_list(F.struct("sensor_id", "value", "ms"))).alias("sensors")
    ).drop("part")
