"""The incremental loop: watermark, next pages, means, append, repeat.

A run starts after the watermark of the sink and then keeps its own read position, the last key
of the pages that are done, so its result does not depend on how many pages a round takes. One
round is two jobs: the ends of the next pages (key column only) and one append. Only those
scalars reach the driver.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tickfold.functions import millis_of, timestamp_of
from tickfold.operators import known_pages, mark_sink_rows, split_marked
from tickfold.plans.backfill import means_of_pages, source_rows
from tickfold.plans.logged import RunReport, run_logged
from tickfold.schema import MAX_BATCHES, MIN_PAGE_ROWS, PAGE_SIZE, RUN_LENGTH
from tickfold.sources.commits import LoggedSink
from tickfold.sources.relational import JdbcTable
from tickfold.sources.tables import FileTable, append_new
from tickfold.sources.wide import PageFinder, key_after, key_until


def run_incremental(
    spark: SparkSession,
    source: DataFrame | Callable[[], DataFrame],
    sink: FileTable | JdbcTable | LoggedSink,
    cells: Sequence[str] | str,
    *,
    page_size: int = PAGE_SIZE,
    run_length: int = RUN_LENGTH,
    min_rows: int = MIN_PAGE_ROWS,
    max_batches: int = MAX_BATCHES,
    pages_per_round: int = 1,
    hwm_pad_ms: int | None = None,
    start_after: int | None = None,
    key_order: str = "string",
    rejects: FileTable | None = None,
    clock: Callable[[], float] = time.time,
    stop: Callable[[], bool] = lambda: False,
    **mean_options: str,
) -> RunReport:
    """Roll up pages of ``source`` into ``sink`` until it has no full enough page left.

    ``source`` may be a callable, to see new data in every round. Up to ``pages_per_round``
    pages are written by one append; the result is the same for any number. A page that is no
    whole number of runs needs one page per round, since the next one starts with its rest.

    The run starts after ``start_after`` (a report's ``position``) or after the watermark of the
    sink plus ``hwm_pad_ms``, by default the rest of the step in which the sink keeps dates.
    A full page is done up to its last key; a short one up to its last written date, so that
    readings of unfinished runs are read again when more data is there.

    A page is written once ``clock`` (seconds) has reached its last row. Pages that are not
    due stay in the source and end the run. ``stop`` is asked between rounds. Means that cannot
    be written are counted, appended to ``rejects`` if given, and stepped over.
    A failing job ends the run with its error; restarting continues from the sink.

    Into a ``LoggedSink`` each round is one commit of records, rejects, bad cells and the read
    position, so a run that dies leaves nothing behind and a repeated one adds nothing. There a
    page is read when it is there, and its run groups leave one by one as they fall due: what is
    not due is stored with the sink, and no further page is read before it has left. While a
    backlog lasts that is due, rounds grow beyond ``pages_per_round``, never beyond ``max_batches``.
    """
    if isinstance(sink, LoggedSink):
        return run_logged(
            spark,
            source,
            sink,
            cells,
            page_size=page_size,
            run_length=run_length,
            min_rows=min_rows,
            max_batches=max_batches,
            pages_per_round=pages_per_round,
            start_after=start_after,
            key_order=key_order,
            clock=clock,
            stop=stop,
            **mean_options,
        )
    whole = page_size % run_length == 0
    if pages_per_round > 1 and not whole:
        raise ValueError("more than one page in a round needs pages of a whole number of runs")
    batches = rounds = rejected = 0
    position = start_after
    finder = PageFinder(page_size, key_order, growing=callable(source))
    pad = sink.precision_ms - 1 if hwm_pad_ms is None else hwm_pad_ms
    if position is None:
        hwm = sink.high_water_ms(spark)
        position = None if hwm is None else hwm + pad

    def report(status: str) -> RunReport:
        return RunReport(batches, rounds, status, position, rejected)

    while batches < max_batches:
        if stop():
            return report("stopped")
        df = source() if callable(source) else source
        n_pages = min(pages_per_round, max_batches - batches)
        found = finder.next(df, position, n_pages)
        full = [page for page in found if page[1] >= min_rows]
        if not full:
            return report("not enough data")
        now_ms = clock() * 1000
        due = [page for page in full if page[0] <= now_ms]
        if not due:
            return report("held")

        last_key, last_size = due[-1]
        rows = key_until(key_after(df, position, 0, key_order=key_order), last_key, key_order=key_order)
        paged = known_pages(source_rows(rows, cells), due, "ms")
        seen = Observation(f"round {uuid.uuid4().hex}")
        good = F.col("reason").isNull()
        marked = mark_sink_rows(means_of_pages(paged, cells, run_length, **mean_options)).observe(
            seen,
            F.count_if(~good).alias("bad"),
            F.max(F.when(good, millis_of("date"))).alias("newest"),
        )
        batch, bad = split_marked(marked)
        if isinstance(sink, JdbcTable):
            # A run that died after its append left rows that are not to come twice.
            known = sink.read(spark)
            if position is not None:
                known = known.where(F.col("date") > timestamp_of(F.lit(position - pad)))
            sink.append(append_new(batch, known), partitions=1)
        else:
            sink.append(batch)
        written = seen.get
        if written["bad"] and rejects is not None:
            rejects.append(bad)
        rejected += written["bad"] or 0
        done = last_key
        if (last_size < page_size or not whole) and written["newest"] is not None:
            done = written["newest"]
        position = done
        batches += len(due)
        rounds += 1
    return report("max batches")
