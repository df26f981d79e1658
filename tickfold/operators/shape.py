"""Typed output rows, and rows that cannot be typed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tickfold.functions import key_millis, parse_int, strict_int, timestamp_of
from tickfold.operators.unpivot import quoted


def typed_readings(readings: DataFrame, row_key: str = "row_key") -> DataFrame:
    """Readings as text to ``ms`` and ``v``; a value that is no integer fails the job."""
    rest = [c for c in readings.columns if c not in (row_key, "value", "ms", "v")]
    ms = F.col("ms") if "ms" in readings.columns else key_millis(row_key).alias("ms")
    return readings.select(*rest, ms, strict_int("value").alias("v"))


def mark_readings(readings: DataFrame, row_key: str = "row_key") -> DataFrame:
    """Readings with ``ms``, ``v`` and ``reason``, which is NULL for a good row."""
    ms = F.col(row_key).try_cast("bigint")
    v = parse_int("value")
    reason = F.when(ms.isNull(), "bad row_key").when(v.isNull(), "bad value")
    return readings.withColumns({"ms": ms, "v": v, "reason": reason})


def drop_bad_cells(wide: DataFrame, cells: Sequence[str]) -> DataFrame:
    """Wide rows without the cells that are no integers; the rows themselves stay.

    ``mark_readings`` on the unpivoted source shows what was dropped.
    """
    return wide.withColumns(
        {c: F.when(parse_int(F.col(quoted(c))).isNotNull(), F.col(quoted(c))) for c in cells}
    )


def mark_sink_rows(means: DataFrame) -> DataFrame:
    """Means in the sink's types plus ``reason``, NULL where the row can be written.

    The date must be readable; a bad date fails the job. A bad value or id only drops
    its row.
    """
    sensor_id = parse_int(F.col("sensor_id").cast("string"))
    value = F.col("value").try_cast("double")
    reason = F.when(value.isNull(), "bad value").when(sensor_id.isNull(), "bad sensor_id")
    return means.select(
        timestamp_of(F.col("ms").cast("bigint")).alias("date"),
        value.alias("value"),
        sensor_id.alias("sensor_id"),
        reason.alias("reason"),
    )


def split_marked(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without ``reason``, rejected rows)."""
    bad = F.col("reason").isNotNull()
    return marked.where(~bad).drop("reason"), marked.where(bad)


def sink_shape(means: DataFrame) -> DataFrame:
    """Means as ``date timestamp, value double, sensor_id int``, unwritable rows dropped."""
    return split_marked(mark_sink_rows(means))[0]
