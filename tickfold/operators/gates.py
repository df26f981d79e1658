"""Gates between the means and the sink."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tickfold.functions import millis_of
from tickfold.schema import MIN_PAGE_ROWS


def min_batch_gate(paged: DataFrame, min_rows: int = MIN_PAGE_ROWS) -> DataFrame:
    """Keep pages that have enough rows; a smaller page waits for more data."""
    return paged.where(F.col("n_rows") >= min_rows)


def mark_due(means: DataFrame, as_of: dt.datetime | str | int) -> DataFrame:
    """Add ``due``: whether the run group of a mean may be written at ``as_of``.

    A group (page, run) is due when the clock has reached its latest date. Groups go in
    order, so the first one that is not due holds all later ones. That group is a single
    row: it enters the filter as a scalar subquery, not as a join.
    """
    limit = F.lit(as_of) if isinstance(as_of, int) else millis_of(F.lit(as_of))
    held = (
        means.groupBy("part", "page_id", "chunk_idx")
        .agg(F.max("ms").alias("release_at"))
        .where(F.col("release_at") > limit)
        .agg(F.min(F.struct("page_id", "chunk_idx")).alias("first"))
    )
    first = held.select("first").scalar()
    return means.withColumn("due", first.isNull() | (F.struct("page_id", "chunk_idx") < first))


def release_gate(means: DataFrame, as_of: dt.datetime | str | int) -> DataFrame:
    """Keep the run groups that may be written at ``as_of``, see ``mark_due``."""
    return mark_due(means, as_of).where("due").drop("due")
