"""Repeated byte strings across documents, by sparse prefix doubling.

Prefix doubling sorts positions by the rank of a short prefix, drops those that are unique, and
ranks the rest again by pairs of ranks at growing offsets until the wanted length is reached.
Here a rank is a 64-bit hash, so that the pair of two ranks is known where the text is, and three
rounds are sorted by Spark:

1. Ranks of 32 bytes, at the *anchors*: of the 69 prefixes inside a window of 100 bytes the one
   of smallest rank, the leftmost of equals. The choice depends on the window alone, so equal
   windows have their anchors at the same place. Unique ranks drop out.
2. Ranks of the *cover* of an anchor, all bytes of the windows that chose it. Of equal covers
   all but the first are repeats, whole. What is left are first covers whose anchor comes with
   other covers too.
3. Ranks of 100 bytes, from pairs of 64 and of 32, at the windows of those covers. Of equal
   windows all but the first are repeats.

Before each shuffle equal rows of a batch become one: the others have an earlier equal in their
batch, which settles them. So a passage of a third of all documents sends a row per batch.

A short phrase that stands in many texts, with other words around it each time, is one rank with
many covers. Such ranks are found first, by Misra-Gries counters over the anchors of all texts, and
are split: their anchors travel by rank and cover together. Equal covers meet all the same, and the
first of them are compared by windows without asking whether the rank has other covers, so the
result does not depend on which ranks are split.

Defined cases: null and empty texts, and those under 100 bytes, lose nothing; one document may
repeat itself; rows with a null id are kept whole and matched with nothing; rows that share an id
are taken to share their text and are never repeats of each other; an empty table gives no rows;
other columns are ignored. Places are in UTF-8 bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from tickfold.llm.common import written
from tickfold.llm.shingles import mix, parts, text_bytes
from tickfold.session import ship_package

LENGTH, FIRST = 100, 32
STARTS = LENGTH - FIRST + 1  # prefixes of the first rank inside a window
_PLACE_BITS = 24
_PLACE = np.uint64((1 << _PLACE_BITS) - 1)
_BYTE = np.random.default_rng(3).integers(1, 1 << 63, 256, dtype=np.uint64)
#: A rank with more than this share of all anchors is split.
SHARE = 1 / 1000
_SPLIT = 1 << 62  # marks the ``place`` of an anchor of such a rank
_R = np.uint64(0xD1342543DE82EF95)
_R_INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))

#: ``place`` packs what is small, for narrow shuffles: the place in the text, the distances from
#: the last and the first window to the anchor (7 bits each) and whether the row is settled.
ANCHOR_SCHEMA = "rank long, cover long, doc long, place long"
WINDOW_SCHEMA = "rank long, check int, doc long, place long"
DIGEST_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


class _Part:
    """Hashes of some texts laid end to end."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        self.offsets, n = offsets, len(raw)
        power, back = np.full(n + 1, _R, np.uint64), np.full(n + 1, _R_INVERSE, np.uint64)
        power[0] = back[0] = 1
        np.cumprod(power, out=power)
        self.back = np.cumprod(back, out=back)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[raw] * power[:-1], out=self.total[1:])
        self.first = self.hashes(np.arange(max(0, n - FIRST + 1)), FIRST)

    def hashes(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return mix((self.total[start + size] - self.total[start]) * self.back[start])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ranks of 100 bytes: 64 from two of 32, 100 from two of 64."""
        pair = lambda a, b: mix(a * _R + b)
        longer = lambda p: pair(self.first[p], self.first[p + FIRST])
        return pair(longer(at), longer(at + LENGTH - 2 * FIRST))

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, place, and first and last window of each anchor."""
        begin, end = self.offsets[:-1], self.offsets[1:]
        some = np.flatnonzero(end - begin >= LENGTH)
        none = np.zeros(0, np.int64)
        if not len(some):
            return none, none, none, none
        place = np.arange(len(self.first))
        text = np.searchsorted(end, place, "right")
        inside = (place - begin[text]).astype(np.uint64) & _PLACE
        key = self.first & ~_PLACE | inside
        key[place + FIRST > end[text]] = np.uint64(0xFFFFFFFFFFFFFFFF)
        least = key.copy()
        for step in (1, 2, 4, 8, 16, 32):
            least[:-step] = np.minimum(least[:-step], least[step:])
        over = STARTS - 64
        least[:-over] = np.minimum(least[:-over], least[over:])
        count = end[some] - begin[some] - LENGTH + 1
        owner = np.repeat(some, count)
        start = np.arange(len(owner)) + np.repeat(begin[some] - (np.cumsum(count) - count), count)
        ahead = ((least[start] & _PLACE) - (start - begin[owner]).astype(np.uint64)) & _PLACE
        at = start + ahead.astype(np.int64)
        new = np.flatnonzero(
            np.concatenate([[True], (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])])
        )
        last = np.append(new[1:], len(start)) - 1
        return owner[new], at[new], start[new], start[last]


def _settle(keys: list[np.ndarray], doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows with an equal key at an earlier place."""
    key = np.zeros(len(doc), np.uint64)
    for k in keys:
        key = mix(key * _R + k.astype(np.uint64))
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = np.zeros(len(key), bool)
    same[1:] = ranked[1:] == ranked[:-1]
    several = same.copy()
    several[:-1] |= same[1:]
    rows = order[several]
    rows = rows[np.lexsort((at[rows], doc[rows], key[rows]))]
    settled = np.zeros(len(key), bool)
    if len(rows):
        k = key[rows]
        heads = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        head = rows[np.repeat(heads, np.diff(np.append(heads, len(rows))))]
        settled[rows] = (doc[rows] != doc[head]) | (at[rows] != at[head])
    return settled


def _apart(rank: np.ndarray, settled: np.ndarray, doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Settled rows need no company; they travel by a key of their own."""
    own = mix(doc.astype(np.uint64) * _R + at.astype(np.uint64))
    return np.where(settled, own, rank).view(np.int64)


class Counters:
    """Misra-Gries counters of ranks: a count is too small by ``lost`` at most."""

    def __init__(self, size: int):
        self.size, self.lost, self.rows = size, 0, 0
        self.rank, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, ranks: np.ndarray) -> None:
        self.rows += len(ranks)
        some, n = np.unique(ranks, return_counts=True)
        self.rank, at = np.unique(np.concatenate([self.rank, some]), return_inverse=True)
        both, self.n = np.concatenate([self.n, n]), np.zeros(len(self.rank), np.int64)
        np.add.at(self.n, at, both)
        if len(self.n) > self.size:
            # As many single steps at once as leave ``size`` counters: each takes one from all.
            cut = int(np.partition(self.n, -self.size - 1)[-self.size - 1])
            keep = self.n > cut
            self.lost += cut
            self.rank, self.n = self.rank[keep], self.n[keep] - cut


def frequent_ranks(known: DataFrame, share: float = SHARE) -> np.ndarray:
    """At most 2 / share ranks, sorted, among them all with more than the share of all anchors."""
    size = round(2 / share)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counters(size)
        for whole in batches:
            for batch in parts(whole):
                part = _Part(*text_bytes(batch.column("text")))
                seen.add(part.first[part.anchors()[1]])
        # True counts are larger by ``lost`` at most, which is below rows * share / 2.
        keep = seen.n > seen.rows * share / 2 - seen.lost
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.rank[keep].view(np.int64)), pa.array(seen.n[keep])], names=["rank", "n"]
        )

    counters = known.mapInArrow(count, "rank long, n long")
    summed = counters.groupBy("rank").agg(F.sum("n").alias("n"))
    largest = summed.orderBy(F.desc("n"), "rank").limit(size).collect()
    return np.sort(np.array([r["rank"] for r in largest], np.int64).view(np.uint64))


def _anchor_rows(frequent: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            found: list[tuple] = []
            for batch in parts(whole):
                raw, offsets = text_bytes(batch.column("text"))
                part, ids = _Part(raw, offsets), batch.column("doc").to_numpy()
                text, at, first, last = part.anchors()
                cover = part.hashes(first, last - first + LENGTH)
                found.append(
                    (part.first[at], cover, at - last, at - first, ids[text], at - offsets[text])
                )
            if not found:
                continue
            rank, cover, low, high, doc, at = (np.concatenate(x) for x in zip(*found, strict=True))
            settled = _settle([rank, cover, low, high], doc, at)
            place = at << 15 | low << 8 | high << 1 | settled
            split = np.isin(rank, frequent) & ~settled
            rank = np.where(split, mix(rank * _R + cover), rank)
            columns = [
                _apart(rank, settled, doc, at),
                cover.view(np.int64),
                doc,
                place | np.where(split, _SPLIT, 0),
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], names=["rank", "cover", "doc", "place"]
            )

    return run


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from low to high of each row, and their rows."""
    count = np.maximum(high - low + 1, 0)
    row = np.repeat(np.arange(len(low)), count)
    return np.arange(len(row)) + np.repeat(low - (np.cumsum(count) - count), count), row


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of the listed anchors."""
    for whole in batches:
        found: list[tuple] = []
        for batch in parts(whole):
            raw, offsets = text_bytes(batch.column("text"))
            part, ids = _Part(raw, offsets), batch.column("doc").to_numpy()
            lists = batch.column("anchors")
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            packed = lists.flatten().to_numpy(zero_copy_only=False)
            at = offsets[row] + (packed >> 15)
            start, which = _spread(at - (packed >> 1 & 127), at - (packed >> 8 & 127))
            which = row[which]
            inside = start + LENGTH <= offsets[which + 1]
            start, which = start[inside], which[inside]
            check = part.hashes(start, LENGTH)
            found.append((part.rank(start), check, ids[which], start - offsets[which]))
        if not found:
            continue
        rank, check, doc, at = (np.concatenate(x) for x in zip(*found, strict=True))
        settled = _settle([rank, check], doc, at)
        columns = [
            _apart(rank, settled, doc, at),
            check.astype(np.uint32).view(np.int32),
            doc,
            at << 1 | settled,
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], names=["rank", "check", "doc", "place"]
        )


def repeats(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", share: float = SHARE
) -> DataFrame:
    """doc_id, text, and what of it repeats: ``covers`` (packed places of anchors) and
    ``windows`` (starts), both null if there are none."""
    ship_package(df.sparkSession)
    docs = df.select(
        F.col(doc_id).cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    known = docs.where("doc IS NOT NULL")
    settled = F.col("place").bitwiseAND(1) == 1
    rows = known.mapInArrow(_anchor_rows(frequent_ranks(known, share)), ANCHOR_SCHEMA)
    anchors = rows.repartition("rank")
    group = Window.partitionBy("rank")
    shape = F.col("place").bitwiseAND((1 << 15) - 2)
    equal = Window.partitionBy("rank", "cover", "shape").orderBy("doc", "place")
    later = settled | (F.col("n") > 1)
    several = (F.col("place") >= _SPLIT) | (F.col("covers") > 1)
    ranked = (
        anchors.withColumn("shape", shape)
        .withColumn("n", F.rank().over(equal))
        .withColumn("covers", F.count(F.when(F.col("n") == 1, 1)).over(group))
        .select(
            "doc",
            F.col("place").bitwiseAND(_SPLIT - 1).alias("place"),
            later.alias("later"),
            (~later & several).alias("open"),
        )
        .where("later OR open")
    )
    ranked = written(ranked, "anchors")
    needed = ranked.where("open").groupBy("doc").agg(F.collect_list("place").alias("anchors"))
    windows = known.join(needed, "doc").mapInArrow(_window_rows, WINDOW_SCHEMA)
    same = Window.partitionBy("rank", "check").orderBy("doc", "place")
    later_windows = (
        windows.withColumn("n", F.rank().over(same))
        .where(settled | (F.col("n") > 1))
        .groupBy("doc")
        .agg(F.collect_list(F.shiftright("place", 1).cast("int")).alias("windows"))
    )
    # Written, so that the rows of all windows are gone before the texts are joined again.
    later_windows = written(later_windows, "windows")
    covers = (
        ranked.where("later").groupBy("doc").agg(F.collect_list("place").alias("covers"))
    )
    out = known.join(covers, "doc", "left").join(later_windows, "doc", "left")
    nothing = docs.where("doc IS NULL").select(
        "doc",
        "text",
        F.lit(None).cast("array<long>").alias("covers"),
        F.lit(None).cast("array<int>").alias("windows"),
    )
    both = out.select("doc", "text", "covers", "windows").unionAll(nothing)
    return both.withColumnRenamed("doc", "doc_id")


def _spans(batch: pa.RecordBatch) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """Each text as bytes with the starts and ends of its removed runs."""
    for text, covers, windows in zip(
        batch.column("text"), batch.column("covers"), batch.column("windows"), strict=True
    ):
        raw = text.as_buffer().to_pybytes()
        low, high = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if covers.is_valid:
            packed = covers.values.to_numpy()
            low.append((packed >> 15) - (packed >> 1 & 127))
            high.append((packed >> 15) - (packed >> 8 & 127))
        if windows.is_valid:
            low.append(windows.values.to_numpy())
            high.append(windows.values.to_numpy())
        start, end = np.concatenate(low), np.concatenate(high) + LENGTH
        edge = np.zeros(len(raw) + 2, np.int64)
        np.add.at(edge, np.minimum(start, len(raw)) + 1, 1)
        np.add.at(edge, np.minimum(end, len(raw)) + 1, -1)
        gone = np.cumsum(edge)[1:] > 0  # gone[len(raw)] is never set
        turn = np.diff(gone.astype(np.int8), prepend=0)
        yield raw, np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)


def _kept(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    if not len(starts):
        return raw
    edges = zip([0, *ends.tolist()], [*starts.tolist(), len(raw)], strict=True)
    return b"".join(raw[a:b] for a, b in edges)


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of the bytes that are left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (len(raw), int((b - a).sum()), len(a), hashlib.sha256(_kept(raw, a, b)).hexdigest())
                for raw, a, b in _spans(batch)
            ]
            size, gone, spans, sha = zip(*rows, strict=True) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(size, pa.int64()),
                    pa.array(gone, pa.int64()),
                    pa.array(spans, pa.int64()),
                    pa.array(sha, pa.string()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return found.mapInArrow(run, DIGEST_SCHEMA)


def cleaned(found: DataFrame) -> DataFrame:
    """doc_id and the text that is left; characters cut in the middle are dropped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_kept(*x).decode("utf-8", "ignore") for x in _spans(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"]
            )

    return found.mapInArrow(run, "doc_id long, text string")


