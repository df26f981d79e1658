"""Sharding by histogram sort.

Rows are ordered by a 64-bit key: the high bits hash the text, the low 20 bits the id, so that
equal texts stand together and even one text that fills a third of the table can be cut. Exact
rows and bytes are counted below candidate boundaries (key prefixes); only the ranges that hold
a wanted boundary, or too many rows for one task, are probed again, 256 times finer. When every
splitter is within tolerance the rows are exchanged once, by final range, and numbered.

Defined cases: null text counts no bytes and has checksum 0; a null id is an id of its own;
texts of any length are one row; repeated rows stay repeated and get slots of their own; ties
in the key go by id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tickfold.llm.common import utf8, written

ROW_OVERHEAD = 16  # bytes that each row counts besides its text
FIRST_BITS = 12
STEP_BITS = 8
ID_BITS = 20
#: A final range holds at most this share of all rows, so no task numbers more.
RANGE_SHARE = 256


@dataclass
class Range:
    """Keys with the same leading bits; counts are exact."""

    bits: int
    prefix: int
    rows: int
    size: int

    @property
    def low(self) -> int:
        return self.prefix << (64 - self.bits)


def sort_key(doc_id: Column, text: Column) -> Column:
    mask = (1 << ID_BITS) - 1
    return F.xxhash64(utf8(text)).bitwiseAND(F.lit(~mask)).bitwiseOR(
        F.xxhash64(doc_id).bitwiseAND(F.lit(mask))
    )


def _prefix(bits: int) -> Column:
    return F.col("key") if bits == 64 else F.shiftright("key", 64 - bits)


def _count(keyed: DataFrame, bits: int) -> list[Range]:
    """At most 4,096 rows, or 256 for each probed range."""
    found = keyed.groupBy(_prefix(bits).alias("p")).agg(
        F.count("*").alias("n"), F.sum("size").alias("s")
    )
    return [Range(bits, r.p, r.n, r.s) for r in found.collect()]


def _splitters(ranges: list[Range], shards: int, tolerance: float):
    """Per wanted boundary the nearest range edge, and the ranges to probe again."""
    edges = [0]
    for r in ranges:
        edges.append(edges[-1] + r.size)
    total, coarse, cuts = edges[-1], set(), []
    if not ranges:
        return cuts, coarse
    for i in range(1, shards):
        want = total * i / shards
        at = min(bisect_right(edges, want), len(ranges)) - 1
        near = at if want - edges[at] <= edges[at + 1] - want else at + 1
        cuts.append(near)
        r = ranges[at]
        if abs(edges[near] - want) > tolerance * total / shards and r.bits < 64 and r.rows > 1:
            coarse.add(at)
    return cuts, coarse


def histogram_sort(
    df: DataFrame,
    shards: int,
    tolerance: float = 0.001,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: shards whose byte sums differ by the tolerance
    (a share of one shard) or by one row, slots gapless from 0 in key order."""
    keyed = written(
        df.select(
            F.col(doc_id).cast("long").alias("doc_id"),
            (F.octet_length(utf8(F.col(text))) + ROW_OVERHEAD).cast("long").alias("size"),
            F.crc32(utf8(F.col(text))).alias("text_crc32"),
            sort_key(F.col(doc_id), F.col(text)).alias("key"),
        ),
        "shard_keys",
    )
    bits, probed, ranges = FIRST_BITS, [], sorted(_count(keyed, FIRST_BITS), key=lambda r: r.low)
    limit = max(1, sum(r.rows for r in ranges) // RANGE_SHARE)
    while True:
        cuts, coarse = _splitters(ranges, shards, tolerance)
        coarse |= {i for i, r in enumerate(ranges) if r.rows > limit and r.bits < 64}
        if not coarse:
            break
        inside = [ranges[i].prefix for i in sorted(coarse)]
        probed.append((bits, inside))
        finer = min(64, bits + STEP_BITS)
        more = _count(keyed.where(_prefix(bits).isin(inside)), finer)
        kept = [r for i, r in enumerate(ranges) if i not in coarse]
        ranges, bits = sorted(kept + more, key=lambda r: r.low), finer
    return _numbered(keyed, ranges, probed, cuts)


def _numbered(keyed: DataFrame, ranges: list[Range], probed: list, cuts: list[int]) -> DataFrame:
    rows, slot, last = [], 0, 0
    for i, r in enumerate(ranges):
        shard = bisect_right(cuts, i)
        slot = 0 if shard != last else slot
        rows.append((r.bits, r.prefix, shard, slot))
        slot, last = slot + r.rows, shard
    places = keyed.sparkSession.createDataFrame(
        rows,
        "bits int, prefix long, shard int, first_slot long",
    )
    # A row's range: the coarsest prefix that was not probed again.
    level, prefix = F.lit(FIRST_BITS), _prefix(FIRST_BITS)
    for bits, inside in reversed(probed):
        finer = min(64, bits + STEP_BITS)
        deeper = (level, prefix) if bits != probed[-1][0] else (F.lit(finer), _prefix(finer))
        hit = _prefix(bits).isin(inside)
        level = F.when(hit, deeper[0]).otherwise(F.lit(bits))
        prefix = F.when(hit, deeper[1]).otherwise(_prefix(bits))
    placed = keyed.withColumns({"bits": level, "prefix": prefix})
    order = Window.partitionBy("bits", "prefix").orderBy("key", "doc_id")
    return (
        # At most 4,096 ranges, and 256 for each of a few hundred probed ones.
        placed.join(F.broadcast(places), ["bits", "prefix"])
        .withColumn("slot", F.col("first_slot") + F.row_number().over(order) - 1)
        .select("doc_id", "size", "text_crc32", "shard", "slot")
    )
