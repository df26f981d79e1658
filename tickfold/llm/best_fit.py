"""Best-fit packing into several permitted sequence lengths.

Documents longer than the longest length are cut into pieces of it. Pieces are dealt by hash
into blocks of bounded size, so that a block is one task's work whatever the size of the table,
and each block is packed by itself: from the longest piece down, a piece goes into the open
sequence with the least room that holds it. If none does, a sequence is opened with the
permitted length of least cost, (length + overhead) for each token that it can still expect to
hold, given all pieces that are left and fit. In the end each sequence shrinks to the shortest
permitted length of its contents.

``best_fit`` packs counts; ``pack_tokens`` packs lists of ids and gives each piece with its ids, and
``sequences`` lays the pieces of each sequence end to end.

Defined cases: a null or negative count is 0; a document without tokens is one empty piece in
some sequence; documents of any length are cut; null ids and repeated rows are packed each; ties
go by id, piece and copy, so a repeated run of ``best_fit`` packs alike (``pack_tokens`` breaks ties
by the order of the rows); a null list is empty, and an empty one is an empty piece; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tickfold.llm.common import written
from tickfold.session import ship_package

LENGTHS = (512, 1024, 2048, 4096, 8192)
OVERHEAD = 64  # tokens that opening a sequence costs besides its length
BLOCK_PIECES = 50_000
SCHEMA = (
    "doc_id long, piece int, first_token long, n_tokens int, bin_id long, bin_start int,"
    " capacity int"
)


def pack(sizes: np.ndarray, lengths: tuple[int, ...], overhead: int = OVERHEAD):
    """Bin, start and final length of each size; sizes fall and are at most the last length."""
    left = np.append(np.cumsum(sizes[::-1])[::-1], 0)  # tokens from a piece on
    rising = -sizes  # sorted, for the first piece that fits
    room: dict[int, list[int]] = {}
    open_rooms = 0  # bit r: some sequence has room r
    used: list[int] = []
    bins, starts = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)

    def opened(i: int, size: int) -> int:
        best, chosen = float("inf"), lengths[-1]
        for length in lengths[bisect_left(lengths, size) :]:
            first = max(i + 1, int(np.searchsorted(rising, size - length)))
            filled = size + min(length - size, int(left[first]))
            cost = (length + overhead) / max(filled, 1)
            if cost <= best:
                best, chosen = cost, length
        return chosen

    for i, size in enumerate(sizes.tolist()):
        fits = open_rooms >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                open_rooms ^= 1 << r
        else:
            r, b = opened(i, size), len(used)
            used.append(0)
        bins[i], starts[i] = b, used[b]
        used[b] += size
        if not room.setdefault(r - size, []):
            open_rooms |= 1 << (r - size)
        room[r - size].append(b)
    final = np.array(lengths)[np.searchsorted(lengths, np.array(used, np.int64))]
    return bins, starts, final[bins] if len(bins) else np.zeros(0, np.int64)


COPIES_AT_ONCE = 10_000


def _copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, n) with ``copy``, a number among equal rows. Equal rows are
    counted where they are, and the counts are dealt out again in shares of bounded size."""
    counted = docs.groupBy("doc_id", "n").agg(F.count("*").alias("rows"))
    share = F.floor((F.col("rows") - 1) / COPIES_AT_ONCE)
    shares = counted.select(
        "doc_id", "n", "rows", F.explode(F.sequence(F.lit(0).cast("long"), share)).alias("share")
    ).repartition("doc_id", "n", "share")
    first = F.col("share") * COPIES_AT_ONCE
    after = F.least(F.col("rows"), first + COPIES_AT_ONCE) - 1
    return shares.select("doc_id", "n", F.explode(F.sequence(first, after)).alias("copy"))


def best_fit(
    df: DataFrame,
    lengths: tuple[int, ...] = LENGTHS,
    doc_id: str = "doc_id",
    tokens: str | Column = "n_tokens",
) -> DataFrame:
    """A row per piece: doc_id, piece, first_token, n_tokens, bin_id, bin_start, capacity."""
    ship_package(df.sparkSession)
    lengths = tuple(sorted(lengths))
    longest = lengths[-1]
    count = F.col(tokens) if isinstance(tokens, str) else tokens
    n = F.greatest(F.coalesce(count.cast("long"), F.lit(0)), F.lit(0))
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), n.alias("n"))
    last = F.greatest(F.floor((F.col("n") - 1) / longest), F.lit(0)).cast("int")
    pieces = _copies(docs).select(
        "doc_id", "n", "copy", F.explode(F.sequence(F.lit(0), last)).alias("piece")
    )
    first = F.col("piece").cast("long") * longest
    # A copy of a row is told apart by its number, so that equal rows are dealt out too.
    spread = F.xxhash64("doc_id", "n", "copy", "piece")
    pieces = pieces.select(
        "doc_id",
        "piece",
        first.alias("first_token"),
        F.least(F.col("n") - first, F.lit(longest)).cast("int").alias("n_tokens"),
        "copy",
        spread.alias("spread"),
    )
    number = docs.agg(F.sum(last + 1)).first()[0] or 0
    return _placed(pieces, number, lengths).drop("copy")


def _placed(pieces: DataFrame, number: int, lengths: tuple[int, ...]) -> DataFrame:
    """The ``number`` pieces (doc_id, piece, first_token, n_tokens, copy, spread), packed block by
    block; ``spread`` deals them out, and ``copy`` tells equal ones apart."""
    blocks = max(1, -(-number // BLOCK_PIECES))

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(
            ["n_tokens", "doc_id", "piece", "copy"], ascending=[False, True, True, True]
        )
        bins, starts, final = pack(rows["n_tokens"].to_numpy(np.int64), lengths)
        base = int(rows["block"].iloc[0]) << 32
        return rows.assign(bin_id=base + bins, bin_start=starts, capacity=final).drop(
            columns=["block", "spread"]
        )

    block = F.pmod("spread", F.lit(blocks)).cast("long")
    dealt = pieces.withColumn("block", block)
    return dealt.groupBy("block").applyInPandas(packed, f"{SCHEMA}, copy long")


def pack_tokens(
    encoded: DataFrame, lengths: tuple[int, ...] = LENGTHS, doc_id: str = "doc_id", ids: str = "ids"
) -> DataFrame:
    """A row per piece as ``best_fit`` gives it, with its ``ids``. Only counts go to the packing
    tasks; a piece finds its ids again by a number that is written with it."""
    ship_package(encoded.sparkSession)
    lengths = tuple(sorted(lengths))
    longest = lengths[-1]
    all_ids = F.coalesce(F.col(ids), F.array().cast("array<int>"))
    last = F.greatest(F.floor((F.size("ids") - 1) / longest), F.lit(0)).cast("int")
    # A list that fits is passed on as it is; slicing boxes every id.
    cut = F.when(F.size("ids") <= longest, F.array("ids")).otherwise(
        F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("ids", i * longest + 1, longest))
    )
    stored = written(
        encoded.select(F.col(doc_id).cast("long").alias("doc_id"), all_ids.alias("ids"))
        .select("doc_id", F.posexplode(cut).alias("piece", "ids"))
        .withColumns({"n_tokens": F.size("ids"), "copy": F.monotonically_increasing_id()}),
        "pieces",
    )
    pieces = stored.select(
        "doc_id",
        "piece",
        (F.col("piece").cast("long") * longest).alias("first_token"),
        "n_tokens",  # stored, so that the ids are not read for it
        "copy",
        F.xxhash64("copy").alias("spread"),
    )
    placed = _placed(pieces, stored.count(), lengths)
    # The rows with ids stream past a table of the others, so they are not sorted.
    ids_of = stored.select("copy", "ids")
    return placed.hint("shuffle_hash").join(ids_of, "copy").drop("copy")


def sequences(pieces: DataFrame) -> DataFrame:
    """bin_id, capacity, doc_ids, starts and ids of each sequence, from ``pack_tokens``. A sequence
    holds at most its capacity of tokens, and as many pieces if none is empty."""
    part = F.struct("bin_start", F.size("ids").alias("n"), "doc_id", "piece", "ids")
    return (
        pieces.groupBy("bin_id", "capacity")
        .agg(F.array_sort(F.collect_list(part)).alias("parts"))
        .select(
            "bin_id",
            "capacity",
            F.col("parts.doc_id").alias("doc_ids"),
            F.col("parts.bin_start").alias("starts"),
            F.flatten("parts.ids").alias("ids"),
        )
    )
