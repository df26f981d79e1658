"""A whole backlog in one pass. Equal to reading it page by page until it is used up, if a page
is a whole number of runs: otherwise what a page leaves over belongs to the next one, which then
has no place of its own, and the plan refuses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tickfold.functions import key_millis, parse_int
from tickfold.operators import (
    assign_pages,
    chunk_mean,
    drop_bad_cells,
    min_batch_gate,
    pack_cells,
    run_means,
    typed_readings,
    unpivot_map,
    unpivot_packed,
    unpivot_static,
    wide_chunk_index,
)
from tickfold.operators.pages import MAX_PARTS, TICKS_PER_PART
from tickfold.operators.unpivot import column_ids
from tickfold.schema import MIN_PAGE_ROWS, PAGE_SIZE, RUN_LENGTH

PAGE_COLUMNS = ["part", "page_id", "n_rows", "tick_no", "ms"]


# With more declared columns than this, rows travel packed.
PACK_ABOVE = 32


def _shared(cells: Sequence[str] | str) -> bool:
    return not isinstance(cells, str) and len(set(column_ids(cells))) < len(cells)


def _many(cells: Sequence[str] | str) -> bool:
    return not isinstance(cells, str) and len(cells) > PACK_ABOVE


def source_rows(wide: DataFrame, cells: Sequence[str] | str) -> DataFrame:
    """Wide rows with ``ms``, in the form in which their cells travel."""
    rows = pack_cells(wide, cells) if _many(cells) else wide
    return rows.withColumn("ms", key_millis("row_key"))


def _unpivot(paged: DataFrame, cells: Sequence[str] | str, on_error: str = "fail") -> DataFrame:
    if isinstance(cells, str):
        readings = unpivot_map(paged, cells, PAGE_COLUMNS)
    elif _many(cells):
        readings = unpivot_packed(paged, cells, PAGE_COLUMNS)
    else:
        readings = unpivot_static(paged, cells, PAGE_COLUMNS)
    if on_error == "reject":
        readings = readings.where(parse_int("value").isNotNull())
    return typed_readings(readings)


def paged_rows(
    rows: DataFrame,
    page_size: int = PAGE_SIZE,
    min_rows: int = MIN_PAGE_ROWS,
    max_parts: int = MAX_PARTS,
    ticks_per_part: int = TICKS_PER_PART,
    unique_keys: bool = True,
) -> DataFrame:
    """The source rows of every page of the table that passes the minimum-rows gate.

    A row key occurs once in a wide table. ``unique_keys=False`` is for sources that may
    repeat one: equal keys then share a tick.
    """
    paged = assign_pages(rows, "ms", page_size, max_parts, ticks_per_part, unique_keys)
    return min_batch_gate(paged, min_rows)


def page_readings(
    wide: DataFrame, cells: Sequence[str] | str, **pages: int | bool
) -> DataFrame:
    """Readings of every page. ``cells``: column names, or a map column; ``pages``: see
    ``paged_rows``."""
    return _unpivot(paged_rows(source_rows(wide, cells), **pages), cells)


def means_of_pages(
    paged: DataFrame,
    cells: Sequence[str] | str,
    run_length: int = RUN_LENGTH,
    divisor: str = "fixed",
    rounding: str = "trunc",
    tail_policy: str = "reference",
    unique_keys: bool = True,
    on_error: str = "fail",
) -> DataFrame:
    """Run means of source rows that carry page columns.

    A cell that is no integer fails the job, or counts as missing with
    ``on_error="reject"``.
    """
    if on_error not in ("fail", "reject"):
        raise ValueError(f"unknown on_error {on_error!r}")
    if isinstance(cells, str) or _many(cells) or _shared(cells) or not unique_keys:
        readings = _unpivot(paged, cells, on_error)
        return chunk_mean(readings, run_length, divisor, rounding, tail_policy)
    if on_error == "reject":
        paged = drop_bad_cells(paged, cells)
    runs = wide_chunk_index(paged, cells, run_length, tail_policy)
    return run_means(typed_readings(runs), run_length, divisor, rounding)


def backfill_means(
    wide: DataFrame,
    cells: Sequence[str] | str,
    page_size: int = PAGE_SIZE,
    run_length: int = RUN_LENGTH,
    min_rows: int = MIN_PAGE_ROWS,
    max_parts: int = MAX_PARTS,
    ticks_per_part: int = TICKS_PER_PART,
    unique_keys: bool = True,
    divisor: str = "fixed",
    rounding: str = "trunc",
    tail_policy: str = "reference",
    on_error: str = "fail",
) -> DataFrame:
    """Run means of every page: ``part, page_id, chunk_idx, sensor_id, ms, value``.

    The source is read three times (twice its key column only), so it must not change
    meanwhile. A frame over files does not: it lists them once.
    """
    if page_size % run_length:
        raise ValueError("a page must be a whole number of runs; use run_incremental")
    rows = source_rows(wide, cells)
    paged = paged_rows(rows, page_size, min_rows, max_parts, ticks_per_part, unique_keys)
    return means_of_pages(
        paged, cells, run_length, divisor, rounding, tail_policy, unique_keys, on_error
    )
