"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickfold.session import shared_folder

#: The characters that separate words, as a Java character class.
SPACE = "\\x20\\x09-\\x0D"
WORD = f"[^{SPACE}]+"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: the rows as a table in the shared folder, read again. Once they are written
    Spark removes the shuffle files of that one job, instead of when it happens to collect garbage."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, *_LOWER)


def utf8(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def settled(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with further columns, worked out once for each row: a generator stands between
    them and what reads them, which Spark would else write out again at each use."""
    made = F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))
    return df.select("*", F.explode(made).alias("_settled")).select("*", "_settled.*").drop("_settled")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


RUNNING_BLOCK = 256


def running(values: Column, fold: Callable[[Column, Column], Column], zero: int = 0) -> Column:
    """The fold of an array of integers up to each element. Blocks are folded, then what comes
    before each block: growing one array over all elements would copy it for each of them."""

    def last(a: Column) -> Column:
        return F.coalesce(F.get(a, F.size(a) - 1), F.lit(zero))

    def grown(a: Column) -> Column:
        none = F.array().cast("array<int>")
        return F.aggregate(a, none, lambda acc, x: F.concat(acc, F.array(fold(last(acc), x))))

    def joined(blocks: Column) -> Column:
        ends = F.concat(F.array(F.lit(zero)), grown(F.transform(blocks, last)))
        return F.flatten(
            F.zip_with(
                blocks,
                F.slice(ends, 1, F.size(blocks)),
                lambda block, before: F.transform(block, lambda x: fold(before, x)),
            )
        )

    def folded(v: Column) -> Column:
        at = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / RUNNING_BLOCK).cast("int"))
        pieces = F.transform(at, lambda b: F.slice(v, b * RUNNING_BLOCK + 1, RUNNING_BLOCK))
        return F.when(F.size(v) > 0, bound(F.transform(pieces, grown), joined)).otherwise(v)

    return bound(values, folded)


def groups(
    batches: Iterator[pa.RecordBatch], key: str
) -> Iterator[tuple[int, pa.RecordBatch, bool]]:
    """Pieces of rows that share a key, from rows sorted by it: key, piece, and whether it is
    the first one of that key."""
    last = None
    for batch in batches:
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        if not len(keys):
            continue
        edges = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            value = int(keys[a])
            yield value, batch.slice(a, b - a), value != last
            last = value
