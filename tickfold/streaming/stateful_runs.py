"""Runs of readings per sensor over a stream, with the unfinished run in Spark's state store.

A sensor's state is the readings of its unfinished run, nine at most. Each micro-batch is read
once; complete runs go to one table of files, whose metadata makes a batch that runs again leave
no second copy, and the checkpoint restores the state. Nothing grows with the number of batches
but the rows of the result.

All readings of a sensor in one micro-batch are sorted in one task. Bound a micro-batch by the
source's ``maxFilesPerTrigger`` or ``maxBytesPerTrigger``; where one sensor alone is too much for
a task, ``start_count_window`` splits it by hour. Readings are expected in time order across
micro-batches; inside one they are sorted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickfold.operators.unpivot import quoted
from tickfold.schema import IDLE_POLL, RUN_LENGTH
from tickfold.session import ship_package

STATE_SCHEMA = "ms array<bigint>, v array<bigint>"
MEANS_SCHEMA = "sensor_id int, ms bigint, value bigint"


def run_closer(run_length: int = RUN_LENGTH) -> Callable:
    """The state function: new readings of a sensor in, its complete runs out."""

    def close(
        key: tuple, parts: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        ms, v = (np.array(x, np.int64) for x in (state.get if state.exists else ([], [])))
        new = pd.concat(list(parts)).sort_values(["ms", "v"], kind="stable")
        ms, v = np.concatenate([ms, new["ms"]]), np.concatenate([v, new["v"]])
        done = len(ms) // run_length * run_length
        state.update((ms[done:].tolist(), v[done:].tolist()))
        if done:
            total = v[:done].reshape(-1, run_length).sum(axis=1)
            mean = np.sign(total) * (np.abs(total) // run_length)  # truncates towards zero
            last = ms[run_length - 1 : done : run_length]
            yield pd.DataFrame({"sensor_id": np.int32(key[0]), "ms": last, "value": mean})

    return close


def stateful_runs(readings: DataFrame, run_length: int = RUN_LENGTH) -> DataFrame:
    """Means of complete runs of the stream ``readings`` (``sensor_id, ms, v``)."""
    ship_package(readings.sparkSession)
    typed = readings.selectExpr(
        f"int({quoted('sensor_id')}) AS sensor_id", "bigint(ms) AS ms", "bigint(v) AS v"
    )
    return (
        typed.where("sensor_id IS NOT NULL AND ms IS NOT NULL AND v IS NOT NULL")
        .groupBy("sensor_id")
        .applyInPandasWithState(
            run_closer(run_length),
            MEANS_SCHEMA,
            STATE_SCHEMA,
            "append",
            GroupStateTimeout.NoTimeout,
        )
    )


def start_stateful_runs(
    readings: DataFrame,
    path: str,
    run_length: int = RUN_LENGTH,
    processing_time: str = IDLE_POLL,
    available_now: bool = False,
) -> StreamingQuery:
    """Run the count window; ``path`` is a folder shared by all executors, for the means and the
    checkpoint. The number of shuffle partitions of the first start is kept by the checkpoint."""
    writer = (
        stateful_runs(readings, run_length)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{path}/checkpoint")
        .option("path", f"{path}/means")
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=processing_time).start()


def read_stateful_runs(spark: SparkSession, path: str) -> DataFrame:
    """Means of the complete runs: ``sensor_id, ms, value``."""
    return spark.read.schema(MEANS_SCHEMA).parquet(f"{path}/means")
