"""Page numbers for a whole backlog.

A page is the next ``page_size`` ticks in key order, so its number is the global ordinal
of the tick divided by the page size. One window over all ticks would put them on one
task. Here the ordinal is built from pieces whose size is bounded by construction:

1. Count ticks per hour. Ticks are distinct milliseconds, so an hour holds at most
   3,600,000 of them however the data is distributed; and the key domain has at most
   2.8 million hours, so the running sum over hours is small. Keys that are no epoch
   milliseconds of 13 digits (microseconds, say) have buckets too: ten hours wide, and ten
   times wider for each further digit, 3.6 million in all.
2. Find the ticks that start a *part*, a fixed number of whole pages; at most ``max_parts``
   exist. Ticks are counted per *cell*, a stretch of their hour so short that parts have many of
   them, and ranked only inside the few cells where a part starts. Counts are added up before
   they are shuffled, so keys are not: only those of the ranked cells.
3. Send the part boundaries to every task and give each row its part while it is
   scanned. Rows are then shuffled once, by part. Parts hold equally many ticks, so no
   hour, sensor or source can make one of them hot.

To find its part a row looks up a slot, a fraction of its hour. An hour with many parts is
cut into twice as many slots, so a slot has few candidates also where a burst of ticks put
most parts into one hour.

Everything later (page number, runs, means) is keyed inside a part and needs no further
shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tickfold.operators.unpivot import quoted
from tickfold.schema import MAX_KEY_MS, PAGE_SIZE

HOUR_MS = 3_600_000
MAX_PARTS = 131_072
TICKS_PER_PART = 1_000
_LAST = 2**63 - 1


# Buckets outside the domain of 13 digits: for keys of 13 + d digits they are as wide as entry d
# here, and negative keys mirror the others. A decade of keys has at most _PER_DECADE of them.
_WIDE = [10 * HOUR_MS * 10**d for d in range(7)]
_HOURS = MAX_KEY_MS // HOUR_MS + 1
_PER_DECADE = MAX_KEY_MS // _WIDE[0] + 1
_FAR = 9 * 10**18  # keys beyond it share the last bucket, so that no sum overflows


def _in_domain(ms: str) -> str:
    return f"least(greatest({ms}, {-_FAR}), {_FAR - 1})"


def _usual(ms: str) -> str:
    return f"{ms} BETWEEN 0 AND {MAX_KEY_MS}"


def _size_of(ms: str) -> str:
    """SQL for a key's distance from zero; ~x is -x - 1."""
    return f"if({ms} < 0, ~{_in_domain(ms)}, {_in_domain(ms)})"


def _by_decade(size: str, values: list[str]) -> str:
    """SQL for one of ``values``, by the digits of ``size``."""
    upper = [MAX_KEY_MS * 10**d + 10**d - 1 for d in range(6)]
    whens = [f"WHEN {size} <= {u} THEN {v}" for u, v in zip(upper, values, strict=False)]
    return f"CASE {' '.join(whens)} ELSE {values[-1]} END"


def hour_of(ms: str) -> str:
    """SQL for the hour bucket of a key: a number that never falls as keys rise."""
    size = _size_of(ms)
    before = [0] + [_HOURS + d * _PER_DECADE for d in range(6)]
    up = _by_decade(size, [f"{b} + {size} div {w}" for b, w in zip(before, _WIDE, strict=True)])
    down = _by_decade(
        size, [f"~({d * _PER_DECADE} + {size} div {w})" for d, w in enumerate(_WIDE)]
    )
    return (
        f"CASE WHEN {_usual(ms)} THEN {ms} div {HOUR_MS} WHEN {ms} < 0 THEN {down} ELSE {up} END"
    )


def _width_of(ms: str) -> str:
    """SQL for the width of a key's bucket."""
    return (
        f"CASE WHEN {_usual(ms)} THEN {HOUR_MS}"
        f" ELSE {_by_decade(_size_of(ms), [f'bigint({w})' for w in _WIDE])} END"
    )


def _bucket_width(hour: str) -> str:
    """SQL for the width of a bucket."""
    wide = f"array({', '.join(f'bigint({w})' for w in _WIDE)})"
    return (
        f"CASE WHEN {hour} < 0 THEN element_at({wide}, int(~{hour} div {_PER_DECADE}) + 1)"
        f" WHEN {hour} < {_HOURS} THEN bigint({HOUR_MS})"
        f" ELSE element_at({wide}, int(({hour} - {_HOURS}) div {_PER_DECADE}) + 2) END"
    )


def _bucket_start(hour: str) -> str:
    """SQL for the first key of a bucket, given its ``width``."""
    return (
        f"CASE WHEN {hour} < 0 THEN -(~{hour} % {_PER_DECADE} + 1) * width"
        f" WHEN {hour} < {_HOURS} THEN {hour} * width"
        f" ELSE ({hour} - {_HOURS}) % {_PER_DECADE} * width END"
    )


def _inside(ms: str) -> str:
    """SQL for the distance of a key from the start of its bucket."""
    return f"pmod({_in_domain(ms)}, {_width_of(ms)})"


def _slot_of(ms: str) -> str:
    """SQL for the start of the slot of a key, given the ``slot_ms`` of its hour."""
    return f"{_in_domain(ms)} - {_inside(ms)} % slot_ms"


def hour_table(
    df: DataFrame,
    ms: str = "ms",
    page_size: int = PAGE_SIZE,
    max_parts: int = MAX_PARTS,
    ticks_per_part: int = TICKS_PER_PART,
    unique: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The ticks with their hour, and one row per hour that has ticks.

    ``before`` counts the ticks of earlier hours and ``span`` the ticks of a part: as many
    whole pages as reach ``ticks_per_part``, or more if there would be over ``max_parts``
    parts. ``slot_ms`` is the width of the hour's slots.
    """
    ticks = df.select(F.col(ms).alias("ms")).where("ms IS NOT NULL")
    if not unique:
        ticks = ticks.distinct()
    ticks = ticks.selectExpr("ms", f"{hour_of('ms')} AS hour")
    few = max(1, ticks_per_part // page_size)
    parts = "(before + count - 1) div span - before div span + 1"
    # At most one row per hour of the key domain reaches the unpartitioned windows.
    hours = (
        ticks.groupBy("hour")
        .count()
        .selectExpr(
            "hour",
            "count",
            "coalesce(sum(count) OVER (ORDER BY hour"
            " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before",
            "sum(count) OVER () AS n_ticks",
            "max(hour) OVER () AS last_hour",
        )
        .selectExpr(
            "*",
            f"greatest({few}, (n_ticks - 1) div {page_size * max_parts} + 1) * {page_size} AS span",
        )
        .selectExpr("*", f"{parts} AS n_parts")
        .selectExpr("*", f"{_bucket_width('hour')} AS width")
        .selectExpr("*", "if(n_parts = 1, width, width div (2 * n_parts) + 1) AS slot_ms")
    )
    return ticks, hours


CELLS_PER_PART = 32  # a part has 1,000 ticks or more: few cells, and few ticks in each


def _cell_of(ms: str) -> str:
    """SQL for the number of a key's cell inside its hour, given the ``cell_ms`` of the hour.

    Keys too far out for a bucket of their own, if there are any, are one cell before or after
    all others."""
    return (
        f"CASE WHEN {ms} < {-_FAR} THEN -1 WHEN {ms} >= {_FAR} THEN {_WIDE[-1]}"
        f" ELSE {_inside(ms)} div cell_ms END"
    )


def part_table(ticks: DataFrame, hours: DataFrame) -> DataFrame:
    """``part, lo, hi, span, n_ticks, last_hour``: first and last key of every part."""
    # At most CELLS_PER_PART cells for each part of an hour, whatever its ticks.
    wide = F.broadcast(
        hours.selectExpr(
            "hour", "before", "span", f"width div ({CELLS_PER_PART} * n_parts) + 1 AS cell_ms"
        )
    )
    cells = (
        ticks.join(wide, "hour")
        .groupBy("hour", F.expr(_cell_of("ms")).alias("cell"))
        .agg(F.count("*").alias("n"), F.first("before").alias("before"), F.first("span").alias("span"))
        .selectExpr(
            "hour",
            "cell",
            "n",
            "span",
            "before + coalesce(sum(n) OVER (PARTITION BY hour ORDER BY cell"
            " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cell_before",
        )
        # A part starts in the cell if a multiple of the span is among its ordinals.
        .where("(cell_before + n - 1) div span > (cell_before - 1) div span OR cell_before = 0")
    )
    # At most one cell for each part.
    starts = (
        ticks.join(wide.select("hour", "cell_ms"), "hour")
        .selectExpr("ms", "hour", f"{_cell_of('ms')} AS cell")
        .join(F.broadcast(cells.drop("n")), ["hour", "cell"])
        .selectExpr(
            "*", "row_number() OVER (PARTITION BY hour, cell ORDER BY ms) - 1 AS rank"
        )
        .selectExpr("hour", "ms", "span", "cell_before + rank AS ordinal")
        .where("ordinal % span = 0")
        .join(F.broadcast(hours.select("hour", "n_ticks", "last_hour")), "hour")
    )
    # At most max_parts rows.
    return starts.selectExpr(
        "ordinal div span AS part",
        "ms AS lo",
        f"coalesce(lead(ms) OVER (ORDER BY ms) - 1, {_LAST}) AS hi",
        "span",
        "n_ticks",
        "last_hour",
    )


def slot_table(parts: DataFrame, slots: DataFrame) -> DataFrame:
    """``hour, slot, part, lo, hi, span, n_ticks``: the parts that each slot can belong to.

    Slots number at most two per hour with ticks and two per part, and a row is added for
    each part boundary. ``slots`` has ``hour, slot_ms``.
    """
    per_hour = (
        parts.selectExpr(
            f"explode(sequence({hour_of('lo')}, least({hour_of('hi')}, last_hour))) AS hour",
            "part",
            "lo",
            "hi",
            "span",
            "n_ticks",
        )
        .join(slots, "hour")
        .selectExpr("*", f"{_bucket_width('hour')} AS width")
        .selectExpr("*", f"{_bucket_start('hour')} AS start")
        .selectExpr("*", f"greatest({_in_domain('lo')}, start) AS low")
    )
    first = "low - (low - start) % slot_ms"
    last = f"least({_in_domain('hi')}, start + width - 1)"
    return per_hour.selectExpr(
        "hour",
        f"explode(sequence({first}, {last}, slot_ms)) AS slot",
        "part",
        "lo",
        "hi",
        "span",
        "n_ticks",
    )


def assign_pages(
    df: DataFrame,
    ms: str = "ms",
    page_size: int = PAGE_SIZE,
    max_parts: int = MAX_PARTS,
    ticks_per_part: int = TICKS_PER_PART,
    unique: bool = False,
) -> DataFrame:
    """Add ``part, page_id, n_rows, tick_no`` to every row of ``df``.

    ``n_rows`` is the number of ticks in the row's page and ``tick_no`` the position of its
    tick in the page, from 0. Works on wide rows and on readings; on wide rows the shuffle
    is smaller, so number the pages before unpivoting. ``unique=True`` says that ``df`` has
    one row per tick and saves a distinct.
    """
    ticks, hours = hour_table(df, ms, page_size, max_parts, ticks_per_part, unique)
    slots = hours.select("hour", "slot_ms")
    table = slot_table(part_table(ticks, hours), slots)
    # Both tables are limited by the hours of the key domain and max_parts, not by the data.
    placed = (
        df.selectExpr("*", f"{hour_of(ms)} AS key_hour")
        .join(F.broadcast(slots), F.expr("key_hour = hour"))
        .selectExpr(
            *[quoted(c) for c in df.columns], "key_hour", f"{_slot_of(f'`{ms}`')} AS key_slot"
        )
        .join(
            F.broadcast(table),
            F.expr(f"key_hour = hour AND key_slot = slot AND `{ms}` BETWEEN lo AND hi"),
        )
    )
    tick = "row_number()" if unique else "dense_rank()"
    ordinal = f"part * span + bigint({tick} OVER (PARTITION BY part ORDER BY `{ms}`)) - 1"
    if unique:
        # Equal keys are always in one part, and this window is sorted already.
        before = f"lag(`{ms}`) OVER (PARTITION BY part ORDER BY `{ms}`)"
        repeated = f"raise_error(concat('repeated row key ', `{ms}`, ': pass unique_keys=False'))"
        ordinal = f"if({before} = `{ms}`, bigint({repeated}), {ordinal})"
    return (
        placed.selectExpr("*", f"{ordinal} AS tick")
        .selectExpr("*", f"tick div {page_size} AS page_id")
        .selectExpr(
            *[quoted(c) for c in df.columns],
            "part",
            "page_id",
            f"least({page_size}, n_ticks - page_id * {page_size}) AS n_rows",
            f"tick % {page_size} AS tick_no",
        )
    )


def known_pages(
    df: DataFrame, ends: Sequence[tuple[str | int, int]], key: str = "row_key"
) -> DataFrame:
    """The same columns for a few pages whose last keys and row counts are already known.

    ``ends`` lists ``(last key, rows)`` in page order; it is as long as the number of
    pages read in one go.
    """
    last_keys = F.array(*[F.lit(k) for k, _ in ends])
    sizes = F.array(*[F.lit(n).cast("bigint") for _, n in ends])
    page = F.size(F.filter(last_keys, lambda end: F.col(key) > end)).cast("bigint")
    in_page = Window.partitionBy("part").orderBy(key)
    return (
        df.withColumn("part", page)
        .withColumn("page_id", F.col("part"))
        .withColumn("n_rows", F.element_at(sizes, (F.col("part") + 1).cast("int")))
        .withColumn("tick_no", (F.dense_rank().over(in_page) - 1).cast("bigint"))
    )


def page_counts(paged: DataFrame) -> DataFrame:
    """Per page: its ticks (wide rows) and its readings."""
    return paged.groupBy("part", "page_id").agg(
        F.max("n_rows").alias("n_rows"), F.count("*").alias("n_readings")
    ).drop("part")
