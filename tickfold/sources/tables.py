"""The sink table: append, read back, and the watermark that it stores."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tickfold.functions import millis_of
from tickfold.schema import SINK_SCHEMA


def high_water(records: DataFrame, date: str = "date") -> DataFrame:
    """One row: ``n_rows`` and ``hwm`` in milliseconds, NULL when there is no date yet."""
    return records.agg(
        F.count("*").alias("n_rows"), millis_of(F.max(date)).alias("hwm")
    )


def append_new(batch: DataFrame, existing: DataFrame) -> DataFrame:
    """The rows of ``batch`` that are not in the table yet, by sensor and date."""
    return batch.join(existing.select("sensor_id", "date"), ["sensor_id", "date"], "left_anti")


@dataclass(frozen=True)
class FileTable:
    """A table of files in a folder that all executors can reach.

    ``precision_ms`` is the step in which it keeps dates: readers of its watermark must step
    over the rest of a step.
    """

    path: str
    fmt: str = "parquet"
    schema: StructType = field(default_factory=lambda: SINK_SCHEMA)
    precision_ms: int = 1

    def create(self, spark: SparkSession) -> FileTable:
        """Make the table if it is missing."""
        empty = spark.createDataFrame([], self.schema)
        empty.write.format(self.fmt).mode("ignore").save(self.path)
        return self

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.format(self.fmt).schema(self.schema).load(self.path)

    def append(self, df: DataFrame) -> None:
        df.write.format(self.fmt).mode("append").save(self.path)

    def high_water_ms(self, spark: SparkSession) -> int | None:
        return high_water(self.read(spark)).first()["hwm"]
