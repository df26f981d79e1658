"""The page loop as a stream over files of wide rows.

The stream says when there is something new; pages are read from the table of all arrived files
by the position in the sink's log. So the rows that don't fill a page yet stay where they are, a
micro-batch that runs again finds nothing left to do, and the sink's log alone says what is done.
Rows that arrive with a key before the position are late and not read, as in the loop.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tickfold.plans import run_incremental
from tickfold.schema import IDLE_POLL, PAGE_SIZE
from tickfold.sources.commits import LoggedSink
from tickfold.sources.wide import full_scan


def page_step(
    path: str,
    schema: StructType,
    sink: LoggedSink,
    cells: Sequence[str] | str,
    fmt: str = "parquet",
    page_size: int = PAGE_SIZE,
    min_rows: int | None = None,
    **options: object,
) -> Callable[[DataFrame, int], None]:
    """The work of a micro-batch: all pages with ``min_rows`` rows, by default full ones."""

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run_incremental(
            spark,
            # Made once for the batch: its list of files is what all jobs of the batch read.
            full_scan(spark, path, fmt, schema),
            sink,
            cells,
            page_size=page_size,
            min_rows=page_size if min_rows is None else min_rows,
            max_batches=2**62,
            **options,
        )

    return step


def start_page_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    sink: LoggedSink,
    cells: Sequence[str] | str,
    checkpoint: str,
    fmt: str = "parquet",
    processing_time: str = IDLE_POLL,
    available_now: bool = False,
    **options: object,
) -> StreamingQuery:
    """Roll up the files that arrive in ``path``; ``options`` as for ``page_step`` and
    ``run_incremental``."""
    arrivals = spark.readStream.format(fmt).schema(schema).load(path)
    writer = arrivals.writeStream.foreachBatch(
        page_step(path, schema, sink, cells, fmt, **options)
    ).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=processing_time).start()
