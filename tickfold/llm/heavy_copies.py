"""Exact copies, with the frequent texts split off.

Texts are equal when they are identical after each run of white space has become one space.
Equality is that of SHA-256 digests, which are written once; texts are read once and never
shuffled.

1. *Misra-Gries.* Every task keeps at most ``2 / share`` counters of digests, and reports those
   above half the share of its rows. So the reports miss at most half the share of all rows of
   any digest; added up, the largest ``2 / share`` are the candidates, and no digest above the
   share is missing.
2. *Verification.* Candidates are counted exactly, each task sending one row per candidate; those
   that hold more than the share are the heavy ones, each with its size and smallest id.
3. *Map-side removal.* Heavy digests, fewer than ``1 / share`` of them whatever the table, are
   broadcast: their rows get their winner where they are and never enter a shuffle.
4. All other digests are summed and joined by an ordinary shuffle, in which no group holds more
   than the share of all rows.

Defined cases: a null text counts as empty; texts of any length are taken whole; of equal texts
the row of smallest id stays, and all rows that repeat that id with it, as they are the same
document; null ids are larger than any other and stay only where all ids of a text are null;
an empty table gives no rows; other columns are ignored by ``exact_copies`` and kept by
``without_copies``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickfold.llm.common import SPACE, utf8, written
from tickfold.session import ship_package

#: A digest is heavy if more than this share of all rows has it.
SHARE = 1 / 1000
_COUNTERS = "digest binary, n long"


def normalised(text: Column) -> Column:
    """Each run of white space as one space; null as empty."""
    return F.regexp_replace(utf8(text), f"[{SPACE}]+", " ")


class Summary:
    """Misra-Gries counters over batches: a count is too small by ``lost`` at most."""

    def __init__(self, size: int):
        self.size, self.lost, self.rows = size, 0, 0
        self.counts: dict[bytes, int] = {}

    def add(self, digests: pa.Array) -> None:
        self.rows += len(digests)
        for x in digests.value_counts().to_pylist():
            self.counts[x["values"]] = self.counts.get(x["values"], 0) + x["counts"]
        if len(self.counts) > self.size:
            # As many single steps at once as leave ``size`` counters: each takes one from all.
            n = np.fromiter(self.counts.values(), np.int64, len(self.counts))
            cut = int(np.partition(n, -self.size - 1)[-self.size - 1])
            self.lost += cut
            self.counts = {d: c - cut for d, c in self.counts.items() if c > cut}


def frequent(digests: DataFrame, share: float = SHARE) -> DataFrame:
    """``digest``: at most 2 / share rows, among them all with more than the share of rows."""
    size = round(2 / share)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Summary(size)
        for batch in batches:
            seen.add(batch.column("digest"))
        # True counts are larger by ``lost`` at most, which is below rows * share / 2.
        kept = {d: c for d, c in seen.counts.items() if c > seen.rows * share / 2 - seen.lost}
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(kept), pa.binary()), pa.array(list(kept.values()), pa.int64())],
            names=["digest", "n"],
        )

    counters = digests.select("digest").mapInArrow(count, _COUNTERS)
    summed = counters.groupBy("digest").agg(F.sum("n").alias("n"))
    return summed.orderBy(F.desc("n"), "digest").limit(size).select("digest")


def _winners(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(
        F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )


def _found(rows: DataFrame, share: float) -> DataFrame:
    """``rows`` (digest, doc_id and others) with keep_id and group_size."""
    total = rows.count()
    candidates = F.broadcast(frequent(rows, share))
    exact = _winners(rows.join(candidates, "digest", "left_semi"))
    # Fewer than 1 / share rows, as each stands for more than the share.
    heavy = written(exact.where(F.col("group_size") > total * share), "heavy")
    known = rows.join(F.broadcast(heavy), "digest")
    rest = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    return known.unionByName(rest.join(_winners(rest), "digest"))


def exact_copies(
    df: DataFrame, share: float = SHARE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, keep_id (the id that stays), group_size, kept and text_sha256 of every row."""
    ship_package(df.sparkSession)
    digest = F.unhex(F.sha2(normalised(F.col(text)), 256)).alias("digest")
    rows = written(df.select(F.col(doc_id).cast("long").alias("doc_id"), digest), "digests")
    return _found(rows, share).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(
    df: DataFrame, share: float = SHARE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``df`` that stay, with all their columns. What is dropped is a copy."""
    found = exact_copies(df, share, doc_id, text)
    gone = found.where(~F.col("kept")).select(
        F.col("doc_id").alias("_id"), F.unhex("text_sha256").alias("_digest")
    )
    digest = F.unhex(F.sha2(normalised(F.col(f"`{text}`")), 256))
    # A repeated pair of id and text is dropped or stays as one: one row of it is enough.
    same = F.col(f"`{doc_id}`").cast("long").eqNullSafe(F.col("_id")) & (digest == F.col("_digest"))
    return df.join(gone.distinct(), same, "left_anti")
