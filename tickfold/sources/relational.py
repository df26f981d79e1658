"""A relational table over JDBC. Endpoint, driver and credentials come in as options."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameReader, SparkSession

from tickfold.functions import millis_of


@dataclass(frozen=True)
class JdbcTable:
    """``options`` go to Spark's JDBC source unchanged (``user``, ``driver``, ...).

    ``quote`` is the quote mark of the database for names. ``precision_ms`` is the step in
    which it keeps dates: whole seconds unless its column says otherwise.
    """

    url: str
    table: str
    options: Mapping[str, str] = field(default_factory=dict)
    quote: str = '"'
    precision_ms: int = 1000

    def _reader(self, spark: SparkSession) -> DataFrameReader:
        return spark.read.format("jdbc").option("url", self.url).options(**self.options)

    def _name(self, name: str) -> str:
        return f"{self.quote}{name}{self.quote}"

    def read(
        self,
        spark: SparkSession,
        partition_column: str | None = None,
        lower: object = None,
        upper: object = None,
        partitions: int = 1,
    ) -> DataFrame:
        """The table; with a partition column, in that many parallel range reads."""
        reader = self._reader(spark).option("dbtable", self.table)
        if partition_column:
            reader = (
                reader.option("partitionColumn", partition_column)
                .option("lowerBound", str(lower))
                .option("upperBound", str(upper))
                .option("numPartitions", partitions)
            )
        return reader.load()

    def high_water_query(self) -> str:
        date, hwm = self._name("date"), self._name("hwm")
        return f"SELECT MAX({date}) AS {hwm} FROM {self.table}"

    def high_water_ms(self, spark: SparkSession) -> int | None:
        """The newest date, computed by the database: one row crosses the wire."""
        row = self._reader(spark).option("query", self.high_water_query()).load()
        return row.select(millis_of("hwm").alias("hwm")).first()["hwm"]

    def append(self, df: DataFrame, partitions: int | None = None) -> None:
        """Append. Each partition is one transaction.

        The page loop passes ``partitions=1``: its batch is small, and it must land whole
        because the table holds the watermark. Leave it ``None`` for a backlog, so that no
        single task carries the result.
        """
        batch = df.repartition(partitions) if partitions else df
        writer = batch.write.format("jdbc").option("url", self.url).options(**self.options)
        writer.option("dbtable", self.table).mode("append").save()
