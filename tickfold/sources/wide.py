"""Reads of a wide table whose row key is epoch milliseconds as text.

Keys compare as text by default, which is byte order. That is the numeric order while all
keys have 13 digits, and it is the form that reaches the file scan as a pushed filter.
``key_order="numeric"`` compares numbers and cannot be pushed down.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from tickfold.functions import int_div, key_millis
from tickfold.schema import HWM_PAD_MS, PAGE_SIZE


def full_scan(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None
) -> DataFrame:
    """The whole wide table."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def _ordered_key(row_key: str, key_order: str) -> tuple[Column, type]:
    if key_order == "string":
        return F.col(row_key), str
    if key_order == "numeric":
        return key_millis(row_key), int
    raise ValueError(f"unknown key_order {key_order!r}")


def key_after(
    df: DataFrame,
    hwm: int | None,
    pad_ms: int = HWM_PAD_MS,
    row_key: str = "row_key",
    key_order: str = "string",
) -> DataFrame:
    """Rows after the watermark (exclusive, padded); all rows when there is none yet."""
    if hwm is None:
        return df
    key, kind = _ordered_key(row_key, key_order)
    return df.where(key > F.lit(kind(hwm + pad_ms)))


def key_from(
    df: DataFrame, hwm: int | None, row_key: str = "row_key", key_order: str = "string"
) -> DataFrame:
    """Rows from the watermark on (inclusive, not padded): reads the last row again."""
    if hwm is None:
        return df
    key, kind = _ordered_key(row_key, key_order)
    return df.where(key >= F.lit(kind(hwm)))


def key_until(
    df: DataFrame, last: int, row_key: str = "row_key", key_order: str = "string"
) -> DataFrame:
    """Rows up to a key (inclusive)."""
    key, kind = _ordered_key(row_key, key_order)
    return df.where(key <= F.lit(kind(last)))


def incremental_page(
    df: DataFrame,
    hwm: int | None,
    page_size: int | None = PAGE_SIZE,
    pad_ms: int = HWM_PAD_MS,
    row_key: str = "row_key",
    key_order: str = "string",
) -> DataFrame:
    """The first ``page_size`` rows after the watermark, in key order (all if ``None``)."""
    rows = key_after(df, hwm, pad_ms, row_key, key_order)
    if page_size is None:
        return rows
    key, _ = _ordered_key(row_key, key_order)
    return rows.orderBy(key).limit(page_size)


def page_ends(
    df: DataFrame,
    hwm: int | None,
    n_pages: int = 1,
    page_size: int = PAGE_SIZE,
    pad_ms: int = HWM_PAD_MS,
    row_key: str = "row_key",
    key_order: str = "string",
) -> DataFrame:
    """``page_id, n_rows, last_key`` of the next pages, reading the key column only.

    With the last key known, the wide cells are read by a key range on both sides, so the
    scan skips the files and row groups beyond the pages. At most
    ``n_pages * page_size`` keys pass the limit.
    """
    keys = incremental_page(
        df.select(row_key), hwm, n_pages * page_size, pad_ms, row_key, key_order
    )
    key, _ = _ordered_key(row_key, key_order)
    position = F.row_number().over(Window.partitionBy().orderBy(key)) - 1
    return (
        keys.withColumn("position", position)
        .groupBy(int_div("position", page_size).alias("page_id"))
        .agg(F.count("*").alias("n_rows"), F.max_by(row_key, "position").alias("last_key"))
    )


def next_page_ends(
    df: DataFrame,
    after: int | None,
    n_pages: int = 1,
    page_size: int = PAGE_SIZE,
    width: int | None = None,
    row_key: str = "row_key",
    key_order: str = "string",
) -> list[tuple[int, int]]:
    """``(last key, rows)`` of the next pages after a key.

    With ``width`` only keys up to ``after + width`` are looked at first, so that the scan of
    a sorted source is bounded at both ends; the rest is read if that has too few. At most
    ``n_pages`` rows reach the driver.
    """
    key, kind = _ordered_key(row_key, key_order)

    def ends(rows: DataFrame) -> list[tuple[int, int]]:
        found = page_ends(rows, after, n_pages, page_size, 0, row_key, key_order)
        return [(int(p["last_key"]), p["n_rows"]) for p in found.orderBy("page_id").collect()]

    if after is not None and width:
        near = ends(df.where(key <= F.lit(kind(after + width))))
        if sum(n for _, n in near) == n_pages * page_size:
            return near
    return ends(df)


@dataclass(frozen=True)
class KeyRange:
    """First and last key and number of rows of a stretch of the table."""

    first: int | None
    last: int | None
    rows: int


def key_range(
    df: DataFrame, after: int | None, row_key: str = "row_key", key_order: str = "string"
) -> KeyRange:
    """One pass over the key column after a key."""
    key, _ = _ordered_key(row_key, key_order)
    row = (
        key_after(df.select(row_key), after, 0, row_key, key_order)
        .agg(F.min(key).alias("first"), F.max(key).alias("last"), F.count("*").alias("rows"))
        .first()
    )
    ends = [None if row[c] is None else int(row[c]) for c in ("first", "last")]
    return KeyRange(*ends, row["rows"])


class PageFinder:
    """Finds the next pages round by round, between two keys each time.

    The range of keys is looked up once, and again past its end when ``growing`` says that the
    source may have more by then. A round looks at the keys up to a distance in which, going by
    the density so far, its pages should end, and doubles the distance until they do or the last
    key is reached. So a sorted source is read in proportion to the pages, whatever its size
    and its gaps.
    """

    def __init__(
        self, page_size: int = PAGE_SIZE, key_order: str = "string", growing: bool = False
    ) -> None:
        self.page_size, self.key_order, self.growing = page_size, key_order, growing
        self.known: KeyRange | None = None
        self.width: int | None = None

    def next(self, df: DataFrame, after: int | None, n_pages: int = 1) -> list[tuple[int, int]]:
        """``(last key, rows)`` of the next pages after a key, or from the first one on."""
        wanted = n_pages * self.page_size
        found = self._look(df, after, wanted, n_pages)
        short = sum(n for _, n in found) < wanted
        if short and self.growing and self.known is not None and self.known.last is not None:
            more = key_range(df, self.known.last, key_order=self.key_order)
            if more.rows:
                first = self.known.first
                self.known = KeyRange(first, more.last, self.known.rows + more.rows)
                found = self._look(df, after, wanted, n_pages)
        return found

    def _look(
        self, df: DataFrame, after: int | None, wanted: int, n_pages: int
    ) -> list[tuple[int, int]]:
        if self.known is None or self.known.last is None:
            self.known = key_range(df, after, key_order=self.key_order)
        first, last = self.known.first, self.known.last
        if first is None or last is None:
            return []
        if len(str(first)) != len(str(last)) and self.key_order == "string":
            # Text order is not that of numbers: no distances between keys.
            return next_page_ends(df, after, n_pages, self.page_size, key_order=self.key_order)
        if after is not None and after >= last:
            return []
        key, kind = _ordered_key("row_key", self.key_order)
        low = first - 1 if after is None else max(after, first - 1)
        rows = df if low >= first else df.where(key >= F.lit(kind(first)))
        density = (last - first + 1) / self.known.rows
        width = self.width or max(1, round(2 * wanted * density))
        while True:
            high = min(low + width, last)
            near = rows.where(key <= F.lit(kind(high)))
            start = None if low < first else low
            ends = page_ends(near, start, n_pages, self.page_size, 0, key_order=self.key_order)
            found = [(int(p["last_key"]), p["n_rows"]) for p in ends.orderBy("page_id").collect()]
            if sum(n for _, n in found) == wanted:
                self.width = 2 * (found[-1][0] - low)
                return found
            if high == last:
                return found
            width *= 2


def page_per_split(
    df: DataFrame, split: str, page_size: int = PAGE_SIZE, row_key: str = "row_key"
) -> DataFrame:
    """The first ``page_size`` rows of every split of the table, in key order.

    Spark applies the rank limit on each input task before the shuffle, so a split that
    holds most of the rows sends ``page_size`` rows per task, not all of them.
    """
    order = Window.partitionBy(split).orderBy(row_key)
    return df.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= page_size
    ).drop("rank")


def late_rows(
    df: DataFrame,
    hwms: DataFrame,
    precision_ms: int = HWM_PAD_MS + 1,
    pad_ms: int | None = None,
    ms: str = "ms",
) -> DataFrame:
    """Rows that a padded watermark skips, with the watermark (``hwm``) that skipped them.

    A sink that stores dates in steps of ``precision_ms`` gives back the start of the step, and
    the loop goes on after that plus ``pad_ms`` (the rest of the step by default). Rows after the
    true watermark up to there are never read. ``hwms`` has the true watermarks in ``ms``; the
    first one of a step stands for it. A row is given for each watermark that skips it.
    """
    pad = precision_ms - 1 if pad_ms is None else pad_ms
    width = max(precision_ms, pad + 1)  # so that a skipped range meets two buckets at most
    stored = int_div("hwm", precision_ms) * precision_ms
    skipped = (
        hwms.select(F.col("ms").alias("hwm"))
        .groupBy(stored.alias("stored"))
        .agg(F.min("hwm").alias("hwm"))
        .withColumn("cut", F.col("stored") + pad)
        .where("cut > hwm")
        .withColumn("bucket", F.explode(F.sequence(int_div("hwm", width), int_div("cut", width))))
        .drop("stored")
    )
    return (
        df.withColumn("bucket", int_div(F.col(ms), width))
        .join(skipped, "bucket")
        .where((F.col(ms) > F.col("hwm")) & (F.col(ms) <= F.col("cut")))
        .drop("bucket", "cut")
    )
