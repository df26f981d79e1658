"""Sensor readings derived from the ``events`` table, long and wide.

The user picks the sensor, the event time the tick, and the largest value of a sensor in a
tick is the reading.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickfold.functions import key_millis, millis_of, timestamp_of

N_SENSORS = 8
CELLS = [f"sensor{i}" for i in range(N_SENSORS)]


def _raw(spark: SparkSession, sf_dir: str, grain: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        millis_of(F.date_trunc(grain, "ts")).alias("ms"),
        (F.col("user_id") % N_SENSORS).cast("int").alias("sensor_id"),
        F.floor("value").cast("int").alias("v"),
    )


def long_readings(spark: SparkSession, sf_dir: str, grain: str = "minute") -> DataFrame:
    """``ms, sensor_id, v``, one row per tick and sensor."""
    return _raw(spark, sf_dir, grain).groupBy("ms", "sensor_id").agg(F.max("v").alias("v"))


def wide_rows(spark: SparkSession, sf_dir: str, grain: str = "minute") -> DataFrame:
    """``row_key, sensor0 .. sensor7`` as text, one row per tick, NULL where no reading."""
    cells = [
        F.max(F.when(F.col("sensor_id") == i, F.col("v"))).cast("string").alias(name)
        for i, name in enumerate(CELLS)
    ]
    return (
        _raw(spark, sf_dir, grain)
        .groupBy("ms")
        .agg(*cells)
        .select(F.col("ms").cast("string").alias("row_key"), *CELLS)
    )


def wide_map_rows(spark: SparkSession, sf_dir: str, grain: str = "minute") -> DataFrame:
    """``row_key, cells map<string,string>``: rows whose qualifiers differ.

    Error events go to a qualifier without a number, ``temp``. A row has at most one cell
    per qualifier, nine in all.
    """
    qualifier = F.when(F.col("event_type") == "error", "temp").otherwise(
        F.concat(F.lit("sensor"), (F.col("user_id") % N_SENSORS).cast("string"))
    )
    cells = (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .groupBy(
            millis_of(F.date_trunc(grain, "ts")).alias("ms"), qualifier.alias("qualifier")
        )
        .agg(F.max(F.floor("value").cast("int")).cast("string").alias("value"))
    )
    return cells.groupBy("ms").agg(
        F.map_from_entries(F.collect_list(F.struct("qualifier", "value"))).alias("cells")
    ).select(F.col("ms").cast("string").alias("row_key"), "cells")


def text_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, row_key, sensor_id, value``: one reading per event, as text, some bad.

    By event id, a value is a word, a number between blanks, a number with a sign, a
    decimal, or a plain integer.
    """
    number = F.floor("value").cast("string")
    kind = F.col("event_id") % 7
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id",
        millis_of("ts").cast("string").alias("row_key"),
        (F.col("user_id") % N_SENSORS).cast("int").alias("sensor_id"),
        F.when(kind == 0, F.col("event_type"))
        .when(kind == 1, F.concat(F.lit(" "), number, F.lit(" ")))
        .when(kind == 2, F.concat(F.lit("+"), number))
        .when(kind == 3, F.concat(number, F.lit(".5")))
        .otherwise(number)
        .alias("value"),
    )


def wide_text_rows(spark: SparkSession, sf_dir: str, grain: str = "minute") -> DataFrame:
    """``row_key, sensor0 .. sensor7`` from the text readings, so some cells are bad."""
    tick = F.date_trunc(grain, timestamp_of(key_millis("row_key")))
    cells = [
        F.max(F.when(F.col("sensor_id") == i, F.col("value"))).alias(name)
        for i, name in enumerate(CELLS)
    ]
    ticks = text_readings(spark, sf_dir).groupBy(millis_of(tick).alias("ms")).agg(*cells)
    return ticks.select(F.col("ms").cast("string").alias("row_key"), *CELLS)


def shared_cells(n_columns: int) -> list[str]:
    """Qualifiers of which two each have the same sensor id: with the word and without it."""
    half = n_columns // 2
    return [f"sensor{i}" for i in range(half)] + [str(i) for i in range(half)]


def shared_wide_rows(
    spark: SparkSession, sf_dir: str, n_columns: int, grain: str = "minute"
) -> DataFrame:
    """``row_key`` and the columns of ``shared_cells``."""
    column = F.col("user_id") % n_columns
    value = F.floor("value").cast("int")
    cells = [
        F.max(F.when(column == i, value)).cast("string").alias(name)
        for i, name in enumerate(shared_cells(n_columns))
    ]
    ticks = (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .groupBy(millis_of(F.date_trunc(grain, "ts")).alias("ms"))
        .agg(*cells)
    )
    names = [F.col(f"`{c}`") for c in shared_cells(n_columns)]
    return ticks.select(F.col("ms").cast("string").alias("row_key"), *names)
