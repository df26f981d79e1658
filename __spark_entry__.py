"""Entry points for the driver: the flagship query, all queries, and their SQL."""

from __future__ import annotations

import datetime as dt
import functools
import os
import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickfold import functions as fn, operators as op, sources as src  # noqa: E402
from tickfold.plans import backfill_means, page_readings, run_incremental  # noqa: E402
from tickfold.schema import DIMENSION_SCHEMA  # noqa: E402
from tickfold.session import shared_folder  # noqa: E402
from tickfold.sources.events import (  # noqa: E402
    CELLS,
    long_readings,
    shared_cells,
    shared_wide_rows,
    text_readings,
    wide_map_rows,
    wide_rows,
    wide_text_rows,
)
from tickfold.streaming import (  # noqa: E402
    read_runs,
    read_stateful_runs,
    start_count_window,
    start_page_stream,
    start_stateful_runs,
)

Query = Callable[[SparkSession, str], DataFrame]

HWM = 1_705_276_800_000  # 2024-01-15 00:00:00 UTC, a watermark inside the data
AS_OF = 1_705_708_800_000  # 2024-01-20 00:00:00 UTC, a wall clock inside the data
DAY_MS = 86_400_000
HOUR_MS = 3_600_000
GATE_PAGE = 13  # a page size that leaves a last page below the minimum

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def _query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL."""

    def register(run: Query) -> Query:
        @functools.wraps(run)
        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return run(spark, sf_dir)

        _QUERIES[run.__name__] = in_utc
        _ORACLES[run.__name__] = sql
        return in_utc

    return register


# --- SQL fragments -----------------------------------------------------------------


def _ms(grain: str) -> str:
    return f"epoch_us(date_trunc('{grain}', ts)) // 1000"


def _r(grain: str = "minute") -> str:
    """Readings: ms, sensor_id, v."""
    return (
        f"r AS (SELECT {_ms(grain)} AS ms, CAST(user_id % 8 AS INT) AS sensor_id,"
        " MAX(CAST(floor(value) AS INT)) AS v FROM events GROUP BY 1, 2)"
    )


def _p(grain: str = "minute", size: int = 100, run: int = 10) -> str:
    """Readings with page_id, tick_no, n_rows and run index i."""
    return f"""{_r(grain)},
 o AS (SELECT ms, row_number() OVER (ORDER BY ms) - 1 AS t FROM (SELECT DISTINCT ms FROM r)),
 n AS (SELECT t // {size} AS b, count(*) AS n_rows FROM o GROUP BY 1),
 p AS (SELECT r.ms, r.sensor_id, r.v, t // {size} AS page_id, t % {size} AS tick_no, n_rows,
        (row_number() OVER (PARTITION BY t // {size}, sensor_id ORDER BY r.ms) - 1) // {run} AS i
       FROM r JOIN o USING (ms) JOIN n ON n.b = t // {size})"""


def _c(grain: str = "minute") -> str:
    """Run means: page_id, chunk_idx, sensor_id, ms, value."""
    return f"""{_p(grain)},
 c AS (SELECT page_id, i AS chunk_idx, sensor_id, max(ms) AS ms,
        CAST(sum(v) // 10 AS BIGINT) AS value
       FROM p WHERE n_rows >= 10 AND i < n_rows // 10 GROUP BY 1, 2, 3)"""


def _w(grain: str = "minute") -> str:
    """Wide rows: ms, row_key, sensor0 .. sensor7."""
    cells = ", ".join(
        f"CAST(max(v) FILTER (sensor_id = {i}) AS VARCHAR) AS {c}" for i, c in enumerate(CELLS)
    )
    return f"{_r(grain)}, w AS (SELECT ms, CAST(ms AS VARCHAR) AS row_key, {cells} FROM r GROUP BY ms)"


_WIDE = "row_key, " + ", ".join(CELLS)
_MEANS = "page_id, chunk_idx, CAST(sensor_id AS INT) AS sensor_id, ms, value"
_BACKFILL = "SELECT sensor_id, ms, value FROM c"


def _sink(means: str = "c") -> str:
    return (
        "SELECT make_timestamp(ms * 1000) AS date, CAST(value AS DOUBLE) AS value, sensor_id"
        f" FROM {means}"
    )


# --- inputs ------------------------------------------------------------------------


def _paged(spark: SparkSession, d: str, grain: str = "minute", **options: int) -> DataFrame:
    """Readings of every page."""
    return page_readings(wide_rows(spark, d, grain), CELLS, **options)


def _means(spark: SparkSession, d: str, grain: str = "minute", **options: str) -> DataFrame:
    return backfill_means(wide_rows(spark, d, grain), CELLS, **options)


# --- scans, keys and pages ---------------------------------------------------------


@_query(f"WITH {_w()} SELECT {_WIDE} FROM w")
def full_scan(spark: SparkSession, d: str) -> DataFrame:
    """The unfiltered wide table, stored and read back with its declared schema."""
    path, rows = shared_folder(spark, "wide"), wide_rows(spark, d)
    rows.write.parquet(path)
    return src.full_scan(spark, path, schema=rows.schema)


@_query(f"WITH {_r()} SELECT count(*) AS n_rows, max(ms) AS hwm FROM r")
def hwm_latest(spark: SparkSession, d: str) -> DataFrame:
    """The watermark: the newest date of the records."""
    return src.high_water(long_readings(spark, d).select(fn.timestamp_of("ms").alias("date")))


@_query(f"WITH {_r()} SELECT make_timestamp(ms * 1000) AS date FROM r ORDER BY ms DESC LIMIT 1")
def latest_first(spark: SparkSession, d: str) -> DataFrame:
    """The watermark as a sort and its first row."""
    dates = long_readings(spark, d).select(fn.timestamp_of("ms").alias("date"))
    return dates.orderBy(F.desc("date")).limit(1)


@_query("SELECT count(*) AS n_rows, max(epoch_us(ts) // 1000) AS hwm FROM events"
        " WHERE ts < TIMESTAMP '1990-01-01'")
def hwm_empty(spark: SparkSession, d: str) -> DataFrame:
    """The watermark of records without rows: NULL, which means a first run."""
    events = spark.read.parquet(f"{d}/events.parquet")
    none = events.where(F.col("ts") < F.lit("1990-01-01").cast("timestamp_ntz"))
    return src.high_water(none, "ts")


@_query("SELECT max(epoch_us(ts) // 1000) AS hwm,"
        " CAST(max(epoch_us(ts)) // 1000000 * 1000 + 999 AS VARCHAR) AS next_key FROM events")
def hwm_key(spark: SparkSession, d: str) -> DataFrame:
    """The key that new rows must exceed, from a watermark kept in whole seconds."""
    hwm = src.high_water(spark.read.parquet(f"{d}/events.parquet"), "ts")
    seconds = fn.int_div("hwm", 1000) * 1000
    return hwm.select("hwm", fn.hwm_key(seconds).alias("next_key"))


@_query(f"WITH {_w()} SELECT {_WIDE} FROM w WHERE row_key > '{HWM + 999}'")
def key_after(spark: SparkSession, d: str) -> DataFrame:
    """Rows after the padded watermark."""
    return src.key_after(wide_rows(spark, d), HWM)


@_query(f"WITH {_w()} SELECT {_WIDE} FROM w WHERE row_key >= '{HWM}'")
def key_from(spark: SparkSession, d: str) -> DataFrame:
    """Rows from the watermark on."""
    return src.key_from(wide_rows(spark, d), HWM)


@_query(f"WITH {_w()} SELECT 'page' AS mode, x.* FROM"
        f" (SELECT {_WIDE} FROM w ORDER BY row_key LIMIT 100) x"
        f" UNION ALL SELECT 'all', {_WIDE} FROM w")
def key_after_empty(spark: SparkSession, d: str) -> DataFrame:
    """A first run: no key filter, with and without the page limit."""
    wide = wide_rows(spark, d)
    page = src.incremental_page(wide, None).select(F.lit("page").alias("mode"), "*")
    return page.unionByName(
        src.incremental_page(wide, None, page_size=None).select(F.lit("all").alias("mode"), "*")
    )


@_query(f"WITH {_w()} SELECT {_WIDE} FROM w WHERE row_key > '{HWM + 999}'"
        " ORDER BY row_key LIMIT 100")
def incremental_page(spark: SparkSession, d: str) -> DataFrame:
    """The next page of 100 rows."""
    return src.incremental_page(wide_rows(spark, d), HWM)


@_query(f"WITH {_w()} SELECT {_WIDE} FROM w WHERE row_key >= '{HWM}'"
        " ORDER BY row_key LIMIT 10")
def incremental_page_from(spark: SparkSession, d: str) -> DataFrame:
    """The page of 10 rows that starts with the last row read."""
    return src.key_from(wide_rows(spark, d), HWM).orderBy("row_key").limit(10)


@_query(f"""WITH {_w()}, x AS (SELECT row_key FROM w WHERE row_key > '{HWM + 999}'
 ORDER BY row_key LIMIT 500), y AS (SELECT row_key, row_number() OVER (ORDER BY row_key) - 1 AS i FROM x)
 SELECT i // 100 AS page_id, count(*) AS n_rows, max(row_key) AS last_key FROM y GROUP BY 1""")
def page_ends(spark: SparkSession, d: str) -> DataFrame:
    """Sizes and last keys of the next five pages, from the key column alone."""
    return src.page_ends(wide_rows(spark, d), HWM, n_pages=5)


@_query(f"""WITH {_w()}, x AS (SELECT ms // {DAY_MS} AS split, {_WIDE},
 row_number() OVER (PARTITION BY ms // {DAY_MS} ORDER BY row_key) AS i FROM w)
 SELECT split, {_WIDE} FROM x WHERE i <= 100""")
def page_per_split(spark: SparkSession, d: str) -> DataFrame:
    """A page from every key range (day) of the table."""
    split = fn.int_div(fn.key_millis("row_key"), DAY_MS).alias("split")
    return src.page_per_split(wide_rows(spark, d).select(split, "*"), "split")


@_query(f"""WITH {_r('millisecond')}, o AS (SELECT ms, row_number() OVER (ORDER BY ms) - 1 AS t
  FROM (SELECT DISTINCT ms FROM r)),
 e AS (SELECT t // 100 AS b, max(ms) AS hwm FROM o GROUP BY 1),
 s AS (SELECT hwm // 1000 AS step, min(hwm) AS hwm FROM e GROUP BY 1)
 SELECT o.ms, s.hwm FROM o JOIN s ON o.ms // 1000 = s.step WHERE o.ms > s.hwm""")
def late_ticks(spark: SparkSession, d: str) -> DataFrame:
    """Ticks that page ends, kept in whole seconds and padded, would skip."""
    rows = wide_rows(spark, d, "millisecond").select(fn.key_millis("row_key").alias("ms"))
    ends = op.assign_pages(rows, unique=True).groupBy("page_id").agg(F.max("ms").alias("ms"))
    return src.late_rows(rows, ends, precision_ms=1000)


@_query(f"""WITH {_p()}, e AS (SELECT page_id, max(ms) AS hwm FROM p GROUP BY 1),
 s AS (SELECT hwm // {HOUR_MS} AS step, min(hwm) AS hwm FROM e GROUP BY 1)
 SELECT r.ms, r.sensor_id, r.v, s.hwm FROM r JOIN s ON r.ms // {HOUR_MS} = s.step
 WHERE r.ms > s.hwm""")
def late_rows(spark: SparkSession, d: str) -> DataFrame:
    """Readings that page ends, kept in whole hours and padded, would skip."""
    ends = _paged(spark, d).groupBy("part", "page_id").agg(F.max("ms").alias("ms"))
    return src.late_rows(long_readings(spark, d), ends, precision_ms=HOUR_MS)


# --- unpivot and scalars -----------------------------------------------------------


@_query(f"WITH {_r()} SELECT CAST(ms AS VARCHAR) AS row_key,"
        " sensor_id, CAST(v AS VARCHAR) AS value FROM r")
def unpivot_cells(spark: SparkSession, d: str) -> DataFrame:
    """One reading per present cell of the declared columns."""
    return op.unpivot_static(wide_rows(spark, d), CELLS)


_QUALIFIED = (
    f"q AS (SELECT {_ms('minute')} AS ms, CASE WHEN event_type = 'error' THEN 'temp'"
    " ELSE 'sensor' || CAST(user_id % 8 AS VARCHAR) END AS qualifier,"
    " MAX(CAST(floor(value) AS INT)) AS v FROM events GROUP BY 1, 2)"
)


@_query(f"WITH {_QUALIFIED} SELECT CAST(ms AS VARCHAR) AS row_key,"
        " replace(qualifier, 'sensor', '') AS sensor_id, CAST(v AS VARCHAR) AS value FROM q")
def unpivot_any_cells(spark: SparkSession, d: str) -> DataFrame:
    """One reading per cell of rows with any qualifiers."""
    return op.unpivot_map(wide_map_rows(spark, d))


def _joined(column: str, *fields: str) -> Column:
    """An array of structs as text, so that both engines compare the same value."""
    parts = [f"string(e.{f})" for f in fields]
    text = f"concat_ws(':', {', '.join(parts)})"
    return F.expr(f"array_join(transform({column}, e -> {text}), ',')").alias(column)


@_query(f"WITH {_r()} SELECT CAST(ms AS VARCHAR) AS row_key,"
        " string_agg(CAST(sensor_id AS VARCHAR) || ':' || CAST(v AS VARCHAR), ','"
        " ORDER BY sensor_id) AS readings FROM r GROUP BY ms")
def row_arrays(spark: SparkSession, d: str) -> DataFrame:
    """Per wide row, its readings as one array."""
    arrays = op.row_arrays(wide_rows(spark, d), CELLS)
    return arrays.select("row_key", _joined("readings", "sensor_id", "value"))


@_query(f"WITH {_p()} SELECT page_id, sensor_id,"
        " string_agg(CAST(ms AS VARCHAR) || ':' || CAST(v AS VARCHAR), ',' ORDER BY ms)"
        " AS readings FROM p WHERE n_rows >= 10 GROUP BY 1, 2")
def sensor_arrays(spark: SparkSession, d: str) -> DataFrame:
    """Per page and sensor, the bag of its readings."""
    arrays = op.sensor_arrays(_paged(spark, d))
    return arrays.select("page_id", "sensor_id", _joined("readings", "ms", "v"))


@_query(f"WITH {_r()} SELECT ms, CAST(sensor_id AS INT) AS sensor_id, v FROM r")
def decode_cells(spark: SparkSession, d: str) -> DataFrame:
    """Keys and cells stored as bytes, decoded and parsed."""
    wide = wide_rows(spark, d)
    stored = wide.select(*[F.encode(c, "UTF-8").alias(c) for c in wide.columns])
    text = stored.select(*[fn.decode_utf8(c).alias(c) for c in wide.columns])
    readings = op.typed_readings(op.unpivot_static(text, CELLS))
    return readings.select("ms", "sensor_id", "v")


_TEXT = """x AS (SELECT event_id, CAST(epoch_us(ts) // 1000 AS VARCHAR) AS row_key,
 CAST(user_id % 8 AS INT) AS sensor_id, CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS n,
 CASE event_id % 7 WHEN 0 THEN event_type WHEN 1 THEN ' ' || n || ' ' WHEN 2 THEN '+' || n
 WHEN 3 THEN n || '.5' ELSE n END AS value FROM events),
 y AS (SELECT *, CASE WHEN regexp_full_match(value, '[+-]?[0-9]+')
 THEN TRY_CAST(value AS INT) END AS v FROM x)"""


@_query(f"WITH {_TEXT} SELECT event_id, row_key, sensor_id, value,"
        " 'bad value' AS reason FROM y WHERE v IS NULL")
def reject_rows(spark: SparkSession, d: str) -> DataFrame:
    """Readings whose value is no integer, set aside with the reason."""
    rejects = op.split_marked(op.mark_readings(text_readings(spark, d)))[1]
    return rejects.select("event_id", "row_key", "sensor_id", "value", "reason")


@_query(f"WITH {_TEXT} SELECT event_id, CAST(row_key AS BIGINT) AS ms, sensor_id, v"
        " FROM y WHERE v IS NOT NULL")
def accept_rows(spark: SparkSession, d: str) -> DataFrame:
    """The readings that are left, typed."""
    good = op.split_marked(op.mark_readings(text_readings(spark, d)))[0]
    return good.select("event_id", "ms", "sensor_id", "v")


@_query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS date FROM events")
def format_date(spark: SparkSession, d: str) -> DataFrame:
    """Dates as text."""
    events = spark.read.parquet(f"{d}/events.parquet")
    return events.select("event_id", fn.format_date("ts").alias("date"))


# --- aggregates per page -----------------------------------------------------------


@_query(f"WITH {_p()} SELECT page_id, max(n_rows) AS n_rows, count(*) AS n_readings"
        " FROM p WHERE n_rows >= 10 GROUP BY 1")
def page_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows and readings of every page."""
    return op.page_counts(_paged(spark, d))


@_query(f"WITH {_p()} SELECT page_id, sensor_id, max(ms) AS ms,"
        " CAST(sum(v) // max(n_rows) AS BIGINT) AS value FROM p WHERE n_rows >= 10 GROUP BY 1, 2")
def page_mean(spark: SparkSession, d: str) -> DataFrame:
    """Per page and sensor: the sum over the rows of the page."""
    return op.page_mean(_paged(spark, d))


@_query(f"WITH {_p()} SELECT page_id, sensor_id, sum(v) / 10.0 AS value"
        " FROM p WHERE n_rows >= 10 GROUP BY 1, 2".replace("sum(v)", "CAST(sum(v) AS DOUBLE)"))
def mean_per_ten(spark: SparkSession, d: str) -> DataFrame:
    """Per page and sensor: the sum over 10.0."""
    return op.mean_per_ten(_paged(spark, d))


@_query(f"WITH {_p()} SELECT page_id, sensor_id, ms, v, i AS chunk_idx, i < n_rows // 10 AS kept"
        " FROM p WHERE n_rows >= 10")
def chunk_index(spark: SparkSession, d: str) -> DataFrame:
    """The run of every reading."""
    runs = op.chunk_index(_paged(spark, d))
    return runs.select("page_id", "sensor_id", "ms", "v", "chunk_idx", "kept")


@_query(f"WITH {_c()} SELECT {_MEANS} FROM c")
def chunk_mean(spark: SparkSession, d: str) -> DataFrame:
    """The mean of every run, with its place."""
    return _means(spark, d).drop("part")


@_query(f"""WITH {_p()} SELECT page_id, i AS chunk_idx, sensor_id, max(ms) AS ms,
 CAST(sum(v) AS DOUBLE) / count(*) AS value FROM p
 WHERE n_rows >= 10 AND i < n_rows // 10 GROUP BY 1, 2, 3""")
def chunk_mean_exact(spark: SparkSession, d: str) -> DataFrame:
    """Run means over the readings present, not cut to integers."""
    return _means(spark, d, divisor="count", rounding="exact").drop("part")


@_query(f"""WITH {_p()}, k AS (SELECT *,
  (row_number() OVER (PARTITION BY page_id, sensor_id ORDER BY ms) - 1) // 10 AS k
  FROM p WHERE n_rows >= 10 AND tick_no < n_rows // 10 * 10)
 SELECT page_id, k AS chunk_idx, sensor_id, max(ms) AS ms, CAST(sum(v) // 10 AS BIGINT) AS value
 FROM k WHERE k < n_rows // 10 GROUP BY 1, 2, 3""")
def chunk_mean_row_cut(spark: SparkSession, d: str) -> DataFrame:
    """Run means when the last ticks of an uneven page are left for the next one."""
    return _means(spark, d, tail_policy="row_cut").drop("part")


@_query(f"""WITH {_p(size=57)} SELECT page_id, sensor_id,
 count(DISTINCT CASE WHEN i < n_rows // 10 THEN i END) AS n_runs,
 count(*) FILTER (i < n_rows // 10) AS n_used, count(*) FILTER (i >= n_rows // 10) AS n_left
 FROM p WHERE n_rows >= 10 GROUP BY 1, 2""")
def chunk_tail(spark: SparkSession, d: str) -> DataFrame:
    """Runs made and readings left when a page is no whole number of runs."""
    return op.chunk_tail(_paged(spark, d, page_size=57))


@_query(f"""WITH {_p('hour', 57)} SELECT page_id, sensor_id,
 count(DISTINCT CASE WHEN i < n_rows // 10 THEN i END) AS n_runs,
 count(*) FILTER (i < n_rows // 10) AS n_used, count(*) FILTER (i >= n_rows // 10) AS n_left
 FROM p WHERE n_rows >= 10 GROUP BY 1, 2""")
def chunk_tail_dense(spark: SparkSession, d: str) -> DataFrame:
    """The same where most cells are present."""
    return op.chunk_tail(_paged(spark, d, "hour", page_size=57))


@_query(f"WITH {_p()} SELECT page_id, max(n_rows // 10) AS max_chunks FROM p"
        " WHERE n_rows >= 10 GROUP BY 1")
def max_chunks(spark: SparkSession, d: str) -> DataFrame:
    """The largest number of runs of a sensor, per page."""
    return op.max_chunks(_paged(spark, d))


@_query(f"WITH {_c()} SELECT page_id, chunk_idx, string_agg(CAST(sensor_id AS VARCHAR) || ':' ||"
        " CAST(value AS VARCHAR) || ':' || CAST(ms AS VARCHAR), ',' ORDER BY sensor_id) AS sensors"
        " FROM c GROUP BY 1, 2")
def chunk_groups(spark: SparkSession, d: str) -> DataFrame:
    """Means regrouped by run."""
    groups = op.chunk_groups(_means(spark, d))
    return groups.select("page_id", "chunk_idx", _joined("sensors", "sensor_id", "value", "ms"))


@_query(f"""WITH {_TEXT},
 z AS (SELECT CAST(row_key AS BIGINT) // 60000 * 60000 AS ms, sensor_id, max(value) AS value
  FROM x GROUP BY 1, 2),
 o AS (SELECT ms, (row_number() OVER (ORDER BY ms) - 1) // 100 AS b FROM (SELECT DISTINCT ms FROM z)),
 n AS (SELECT b, count(*) AS n_rows FROM o GROUP BY b),
 g AS (SELECT z.ms, b, n_rows, sensor_id, CAST(value AS INT) AS v,
  (row_number() OVER (PARTITION BY b, sensor_id ORDER BY z.ms) - 1) // 10 AS i
  FROM z JOIN o USING (ms) JOIN n USING (b) WHERE regexp_full_match(value, '[+-]?[0-9]+'))
 SELECT b AS page_id, i AS chunk_idx, sensor_id, max(ms) AS ms,
  CAST(sum(v) // 10 AS BIGINT) AS value
 FROM g WHERE n_rows >= 10 AND i < n_rows // 10 GROUP BY 1, 2, 3""")
def chunk_mean_rejecting(spark: SparkSession, d: str) -> DataFrame:
    """Run means of rows with bad cells, which are left out."""
    means = backfill_means(wide_text_rows(spark, d), CELLS, on_error="reject")
    return means.drop("part")


# --- the roll-up, gates and sink ---------------------------------------------------


@_query(f"WITH {_c()} {_BACKFILL}")
def chunk_mean_backfill(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: the whole backlog in one pass."""
    return _means(spark, d).select("sensor_id", "ms", "value")


@_query(f"WITH {_c('hour')} {_BACKFILL}")
def chunk_mean_backfill_hour(spark: SparkSession, d: str) -> DataFrame:
    """The backlog with few, full rows."""
    return _means(spark, d, "hour").select("sensor_id", "ms", "value")


@_query(f"WITH {_c('millisecond')} {_BACKFILL}")
def chunk_mean_backfill_raw(spark: SparkSession, d: str) -> DataFrame:
    """The backlog with many, nearly empty rows."""
    return _means(spark, d, "millisecond").select("sensor_id", "ms", "value")


@_query(f"WITH {_p(size=GATE_PAGE)} SELECT page_id, max(n_rows) AS n_rows, count(*) AS n_readings"
        " FROM p WHERE n_rows >= 10 GROUP BY 1")
def min_batch_gate(spark: SparkSession, d: str) -> DataFrame:
    """Pages with enough rows; the short last page waits."""
    keyed = wide_rows(spark, d).withColumn("ms", fn.key_millis("row_key"))
    paged = op.assign_pages(keyed, page_size=GATE_PAGE, unique=True)
    gated = op.min_batch_gate(paged)
    ids = ["part", "page_id", "n_rows", "tick_no", "ms"]
    return op.page_counts(op.unpivot_static(gated, CELLS, ids))


@_query(f"""WITH {_c()}, g AS (SELECT page_id, chunk_idx, max(ms) AS due FROM c GROUP BY 1, 2),
 h AS (SELECT min(page_id * 1000 + chunk_idx) AS first FROM g WHERE due > {AS_OF})
 SELECT {_MEANS} FROM c, h WHERE first IS NULL OR page_id * 1000 + chunk_idx < first""")
def release_gate(spark: SparkSession, d: str) -> DataFrame:
    """The run groups that are due, up to the first one that is not."""
    as_of = dt.datetime.fromtimestamp(AS_OF / 1000, dt.timezone.utc)
    return op.release_gate(_means(spark, d), as_of).drop("part")


@_query(f"WITH {_c()} {_sink()}")
def sink_shape(spark: SparkSession, d: str) -> DataFrame:
    """Means in the types of the sink."""
    return op.sink_shape(_means(spark, d))


_ANY = f"""{_QUALIFIED},
 o AS (SELECT ms, (row_number() OVER (ORDER BY ms) - 1) // 100 AS b FROM (SELECT DISTINCT ms FROM q)),
 n AS (SELECT b, count(*) AS n_rows FROM o GROUP BY b),
 p AS (SELECT q.ms, replace(qualifier, 'sensor', '') AS id, v, b, n_rows,
   (row_number() OVER (PARTITION BY b, qualifier ORDER BY q.ms) - 1) // 10 AS i
   FROM q JOIN o USING (ms) JOIN n USING (b)),
 c AS (SELECT b, i, id, max(ms) AS ms, CAST(sum(v) // 10 AS BIGINT) AS value FROM p
   WHERE n_rows >= 10 AND i < n_rows // 10 GROUP BY 1, 2, 3)"""


@_query(f"WITH {_ANY} SELECT make_timestamp(ms * 1000) AS date, CAST(value AS DOUBLE) AS value,"
        " TRY_CAST(id AS INT) AS sensor_id,"
        " CASE WHEN TRY_CAST(id AS INT) IS NULL THEN 'bad sensor_id' END AS reason FROM c")
def sink_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Means of rows with any qualifiers; those without a numeric id cannot be written."""
    return op.mark_sink_rows(backfill_means(wide_map_rows(spark, d), "cells"))


@_query(f"WITH {_c()} {_sink()}")
def sink_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Means appended to the sink table and read back."""
    sink = src.FileTable(shared_folder(spark, "records")).create(spark)
    sink.append(op.sink_shape(_means(spark, d)))
    return sink.read(spark)


@_query(f"WITH {_c('hour')} {_sink()}")
def incremental_run(spark: SparkSession, d: str) -> DataFrame:
    """The loop over pages, resuming from the watermark in the sink."""
    sink = src.FileTable(shared_folder(spark, "records")).create(spark)
    wide = wide_rows(spark, d, "hour")
    report = run_incremental(
        spark, wide, sink, CELLS, pages_per_round=4, max_batches=sys.maxsize
    )
    assert report.status == "not enough data", report
    return sink.read(spark)


@_query(f"WITH {_c('millisecond')} {_sink()}")
def incremental_run_raw(spark: SparkSession, d: str) -> DataFrame:
    """The loop over ticks a few milliseconds apart, stopped after seven pages and run again
    to the end of the table."""
    sink = src.LoggedSink(shared_folder(spark, "records"))
    path, wide = shared_folder(spark, "wide"), wide_rows(spark, d, "millisecond")
    wide.repartitionByRange("row_key").sortWithinPartitions("row_key").write.parquet(path)
    stored = src.full_scan(spark, path, schema=wide.schema)
    run_incremental(spark, stored, sink, CELLS, pages_per_round=4, max_batches=7)
    report = run_incremental(
        spark, stored, sink, CELLS, pages_per_round=200, max_batches=sys.maxsize
    )
    assert report.status == "not enough data", report
    return sink.records(spark)


@_query(f"""WITH {_c('hour')}, g AS (SELECT page_id, chunk_idx, max(ms) AS due FROM c GROUP BY 1, 2),
 h AS (SELECT min(page_id * 1000 + chunk_idx) AS first FROM g WHERE due > {AS_OF}),
 x AS (SELECT c.*, coalesce(page_id * 1000 + chunk_idx >= first, false) AS later,
  page_id = first // 1000 AS read FROM c, h)
 SELECT 'due' AS phase, sensor_id, ms, value FROM x WHERE NOT later
 UNION ALL SELECT 'held', sensor_id, ms, value FROM x WHERE later AND read
 UNION ALL SELECT 'all', sensor_id, ms, value FROM x""")
def incremental_run_held(spark: SparkSession, d: str) -> DataFrame:
    """The loop on two clocks: at the first, run groups up to the first that is not due are
    written and the rest of its page is stored; at the second a new run writes the rest."""
    sink = src.LoggedSink(shared_folder(spark, "records"))
    wide = wide_rows(spark, d, "hour")
    run_incremental(spark, wide, sink, CELLS, max_batches=sys.maxsize, clock=lambda: AS_OF / 1000)
    then = sink.latest(spark)
    report = run_incremental(spark, wide, sink, CELLS, pages_per_round=50, max_batches=sys.maxsize)
    assert report.status == "not enough data", report

    def phase(name: str, rows: DataFrame, ms: Column) -> DataFrame:
        value = F.col("value").cast("long").alias("value")
        return rows.select(F.lit(name).alias("phase"), "sensor_id", ms.alias("ms"), value)

    date = fn.millis_of("date")
    return (
        phase("due", sink.read(spark, "records", then), date)
        .unionAll(phase("held", sink.read(spark, "held", then), F.col("ms")))
        .unionAll(phase("all", sink.records(spark), date))
    )


@_query(f"WITH {_c()} {_sink()}")
def incremental_stream(spark: SparkSession, d: str) -> DataFrame:
    """The page loop as a stream: rows arrive in three deliveries, the query restarts from its
    checkpoint for each and writes the pages that are full; the short last page goes at the end."""
    path = shared_folder(spark, "arrivals")
    sink = src.LoggedSink(shared_folder(spark, "records"))
    wide = wide_rows(spark, d)
    keyed = wide.withColumn("ms", fn.key_millis("row_key"))
    ends = keyed.agg(F.min("ms").alias("a"), F.max("ms").alias("b")).first()
    third = max(1, ((ends["b"] or 0) - (ends["a"] or 0)) // 3 + 1)
    arrival = fn.int_div(F.col("ms") - (ends["a"] or 0), third)
    for delivery in range(3):
        rows = keyed.where(arrival == delivery).drop("ms")
        rows.write.mode("append").parquet(f"{path}/in")
        start_page_stream(
            spark, f"{path}/in", wide.schema, sink, CELLS, f"{path}/checkpoint",
            available_now=True, pages_per_round=50,
        ).awaitTermination()
    report = run_incremental(
        spark, src.full_scan(spark, f"{path}/in", schema=wide.schema), sink, CELLS
    )
    assert report.status == "not enough data" and report.batches <= 1, report
    return sink.records(spark)


@_query(f"""WITH {_c()} SELECT 'written' AS kind, sensor_id, ms, value FROM c WHERE sensor_id < 4
 UNION ALL SELECT 'rejected', NULL, ms, value FROM c WHERE sensor_id >= 4""")
def incremental_run_rejects(spark: SparkSession, d: str) -> DataFrame:
    """The loop where half of the qualifiers have no numeric id: their means are committed as
    rejects, and no page is read twice, also by the runs after the first."""
    sink = src.LoggedSink(shared_folder(spark, "records"))
    names = {f"sensor{i}": f"pump{i}" for i in range(4, 8)}
    wide = wide_rows(spark, d).withColumnsRenamed(names)
    cells = [names.get(c, c) for c in CELLS]
    for batches in (1, sys.maxsize, sys.maxsize):
        run_incremental(spark, wide, sink, cells, pages_per_round=50, max_batches=batches)
    bad = sink.read(spark, "rejects")
    assert sink.latest(spark).state["rejected"] == bad.count()
    columns = ["sensor_id", fn.millis_of("date").alias("ms"), F.col("value").cast("long").alias("value")]
    good = sink.records(spark).select(F.lit("written").alias("kind"), *columns)
    return good.unionAll(bad.select(F.lit("rejected"), *columns))


def _shared(columns: int) -> str:
    """Run means where two columns have one sensor id."""
    half = columns // 2
    return f"""SELECT {{mode}} AS mode, page_id, i AS chunk_idx, sensor_id, max(ms) AS ms,
 CAST(sum(v) // 10 AS BIGINT) AS value FROM (SELECT r.*, t // 100 AS page_id, n_rows,
  (row_number() OVER (PARTITION BY t // 100, sensor_id ORDER BY ms, v) - 1) // 10 AS i
  FROM (SELECT {_ms('minute')} AS ms, user_id % {columns} AS c,
   CAST(user_id % {columns} % {half} AS INT) AS sensor_id, MAX(CAST(floor(value) AS INT)) AS v
   FROM events GROUP BY 1, 2, 3) r JOIN o USING (ms) JOIN n ON n.b = t // 100)
 WHERE n_rows >= 10 AND i < n_rows // 10 GROUP BY ALL"""


@_query(f"WITH {_p()} {_shared(16)} UNION ALL {_shared(16)} UNION ALL {_shared(40)}".format(mode="{mode}")
        .replace("{mode}", "'few'", 1).replace("{mode}", "'map'", 1).replace("{mode}", "'many'", 1))
def chunk_mean_shared_id(spark: SparkSession, d: str) -> DataFrame:
    """Two qualifiers for each sensor id: as few columns, as a map, and as many columns."""

    def means(mode: str, n: int) -> DataFrame:
        wide, cells = shared_wide_rows(spark, d, n), shared_cells(n)
        if mode == "map":
            pairs = [x for c in cells for x in (F.lit(c), F.col(f"`{c}`"))]
            wide, cells = wide.select("row_key", F.create_map(*pairs).alias("cells")), "cells"
        out = backfill_means(wide, cells).select(
            F.lit(mode).alias("mode"),
            "page_id",
            "chunk_idx",
            F.col("sensor_id").cast("int").alias("sensor_id"),
            "ms",
            "value",
        )
        return out

    return means("few", 16).unionAll(means("map", 16)).unionAll(means("many", 40))


@_query("SELECT s_suppkey AS sensor_id FROM supplier ORDER BY 1 DESC")
def dim_desc(spark: SparkSession, d: str) -> DataFrame:
    """The dimension by descending id."""
    dimension = spark.read.parquet(f"{d}/supplier.parquet")
    return dimension.select(F.col("s_suppkey").alias("sensor_id")).orderBy(F.desc("sensor_id"))


@_query("SELECT CAST(s_suppkey AS INT) AS sensor_id, s_nationkey AS bridge_id,"
        " 'temp' AS parameter_unit, s_name AS sensor_name, s_acctbal AS threshold FROM supplier")
def dim_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Rows appended to the dimension table and read back."""
    table = src.FileTable(shared_folder(spark, "sensors"), schema=DIMENSION_SCHEMA).create(spark)
    table.append(
        spark.read.parquet(f"{d}/supplier.parquet").select(
            F.col("s_suppkey").cast("int").alias("sensor_id"),
            F.col("s_nationkey").alias("bridge_id"),
            F.lit("temp").alias("parameter_unit"),
            F.col("s_name").alias("sensor_name"),
            F.col("s_acctbal").alias("threshold"),
        )
    )
    return table.read(spark)


@_query(f"""WITH {_r('millisecond')}, x AS (SELECT *,
 (row_number() OVER (PARTITION BY sensor_id ORDER BY ms) - 1) // 10 AS i FROM r)
 SELECT sensor_id, max(ms) AS ms, CAST(sum(v) // 10 AS BIGINT) AS value FROM x
 GROUP BY sensor_id, i HAVING count(*) = 10""")
def stream_count_window(spark: SparkSession, d: str) -> DataFrame:
    """Runs over a stream, unfinished ones in Spark's state: the readings arrive in three
    deliveries, the query restarts from its checkpoint for each."""
    path = shared_folder(spark, "stream")
    readings = long_readings(spark, d, "millisecond")
    ends = readings.agg(F.min("ms").alias("a"), F.max("ms").alias("b")).first()
    third = max(1, ((ends["b"] or 0) - (ends["a"] or 0)) // 3 + 1)
    arrival = fn.int_div(F.col("ms") - (ends["a"] or 0), third)
    for delivery in range(3):
        readings.where(arrival == delivery).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(readings.schema).parquet(f"{path}/in")
        start_stateful_runs(stream, path, available_now=True).awaitTermination()
    return read_stateful_runs(spark, path)


@_query(_ORACLES["stream_count_window"])
def stream_count_window_split(spark: SparkSession, d: str) -> DataFrame:
    """The same where a busy sensor is split by hour and batches carry what is unfinished."""
    path = shared_folder(spark, "stream")
    readings = long_readings(spark, d, "millisecond")
    readings.write.parquet(f"{path}/in")
    stream = spark.readStream.schema(readings.schema).parquet(f"{path}/in")
    start_count_window(stream, path, available_now=True).awaitTermination()
    return read_runs(spark, path)


# --- driver contract ---------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    return chunk_mean_backfill(spark, "/root/testdata/sf0.001")


def _optional() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the training-data package, where it and its pipeline are there."""
    try:
        from tickfold.llm import queries as llm
    except ImportError:
        return {}, {}
    runs, sql = dict(llm.QUERIES), dict(llm.ORACLES)
    try:
        import corpus_pipeline
    except ImportError:
        return runs, sql
    runs["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return runs, sql


def queries() -> dict[str, Query]:
    return _QUERIES | _optional()[0]


def oracle_sql() -> dict[str, str]:
    return _ORACLES | _optional()[1]
