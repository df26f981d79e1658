"""Runs of readings per sensor over an unbounded stream.

Every micro-batch joins its readings to the ones carried over (fewer than a run per
sensor), closes the complete runs and carries the rest. Both are written as one table of
rows per batch, in a folder named after the batch id. A batch that is run again after a
failure replaces its own folder and starts from the folder before it, so each reading
counts exactly once.

A stateful operator keyed by sensor would process all readings of a busy sensor in one
task. Here a reading's position comes from counts per sensor and hour, so a busy sensor is
split by hour. Readings are expected in time order across micro-batches; inside one they
are sorted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from tickfold.functions import int_div
from tickfold.operators.pages import hour_of
from tickfold.schema import IDLE_POLL, RUN_LENGTH

RUNS_SCHEMA = StructType(
    [
        StructField("sensor_id", IntegerType(), True),
        StructField("ms", LongType(), True),
        StructField("total", LongType(), True),
        StructField("complete", BooleanType(), True),
    ]
)


def count_window_step(readings: DataFrame, run_length: int = RUN_LENGTH) -> DataFrame:
    """``sensor_id, ms, total, complete`` from readings ``sensor_id, ms, v``.

    A complete run is one row with its last date and its sum. A reading of an unfinished
    run is a row of its own with ``complete`` false.
    """
    keyed = readings.selectExpr(
        "sensor_id", "ms", "bigint(v) AS v", f"{hour_of('ms')} AS hour"
    )
    # One row per sensor and hour.
    counts = (
        keyed.groupBy("sensor_id", "hour")
        .count()
        .selectExpr(
            "sensor_id",
            "hour",
            "coalesce(sum(count) OVER (PARTITION BY sensor_id ORDER BY hour"
            " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before",
            f"sum(count) OVER (PARTITION BY sensor_id) div {run_length} * {run_length} AS n_full",
        )
    )
    in_hour = "row_number() OVER (PARTITION BY sensor_id, hour ORDER BY ms, v) - 1"
    placed = (
        keyed.selectExpr("*", f"{in_hour} AS rank")
        .join(counts, ["sensor_id", "hour"])
        .selectExpr("sensor_id", "ms", "v", "before + rank AS ordinal", "n_full")
        .selectExpr("*", "ordinal < n_full AS complete")
        .selectExpr("*", f"if(complete, ordinal div {run_length}, ordinal) AS run")
    )
    return (
        placed.groupBy("sensor_id", "complete", "run")
        .agg(F.max("ms").alias("ms"), F.sum("v").alias("total"))
        .select("sensor_id", "ms", "total", "complete")
    )


def batch_step(path: str, run_length: int = RUN_LENGTH) -> Callable[[DataFrame, int], None]:
    """The work of one micro-batch, for ``foreachBatch``. Writes the folder of the batch."""

    def step(batch: DataFrame, batch_id: int) -> None:
        if batch_id > 0:
            previous = _folder(path, batch_id - 1)
            carried = batch.sparkSession.read.schema(RUNS_SCHEMA).parquet(previous)
            batch = batch.select("sensor_id", "ms", "v").unionByName(
                carried.where(~F.col("complete")).select(
                    "sensor_id", "ms", F.col("total").alias("v")
                )
            )
        runs = count_window_step(batch, run_length)
        runs.write.mode("overwrite").parquet(_folder(path, batch_id))

    return step


def start_count_window(
    readings: DataFrame,
    path: str,
    run_length: int = RUN_LENGTH,
    processing_time: str | None = IDLE_POLL,
    available_now: bool = False,
) -> StreamingQuery:
    """Run the count window over the stream ``readings`` (``sensor_id, ms, v``).

    ``path`` is a folder shared by all executors; it keeps the runs and the checkpoint.
    """
    writer = readings.writeStream.foreachBatch(batch_step(path, run_length)).option(
        "checkpointLocation", f"{path}/checkpoint"
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def read_runs(spark: SparkSession, path: str, run_length: int = RUN_LENGTH) -> DataFrame:
    """Means of the complete runs: ``sensor_id, ms, value``."""
    runs = spark.read.schema(RUNS_SCHEMA).parquet(f"{path}/runs")
    return runs.where("complete").select(
        "sensor_id", "ms", int_div("total", run_length).alias("value")
    )


def _folder(path: str, batch_id: int) -> str:
    return f"{path}/runs/batch_id={batch_id}"
