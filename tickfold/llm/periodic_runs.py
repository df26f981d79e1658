"""Periodic runs of words by maximal-pair enumeration.

A run is a stretch of words with smallest period q that repeats at least ``exponent`` times, has
at least ``min_words`` words and cannot be extended by a neighbouring word.

A maximal pair is two places whose equal stretches differ in the word before and in the word
after. If the places are d apart and share m >= (exponent - 1) * d words, then the d + m words
from the first place on have period d, and since neither side goes on, they are a run as they
stand: nothing is extended. Every run shows up so, from its first place and the one a period
later; its multiples of the period have the same start and end and give way to the smallest.

Inside a document:

1. Suffixes are ranked by doubling prefixes (1, 2, 4, ... words); places whose prefix is unique
   drop out, so prose costs a few sorts of its words and only repeats go on.
2. Neighbours in suffix order get their common length from the ranks of all rounds.
3. The tree of LCP intervals is built bottom-up on a stack. A node keeps its places sorted, and
   sorted once more for each word on their left (the class lists). When two children meet at
   depth m, each place of the smaller one is held against the lists of other classes in the
   larger one, no further than m / (exponent - 1) away; then the smaller is merged into the
   larger. Nodes too shallow for any run are not built.

A document is the unit of work: documents are never shuffled, a task holds a few megabytes of
text or one document.

Defined cases: null and empty texts have no words and no runs; texts of any length are taken
whole; ties between runs of one stretch go to the smallest period; repeated rows and null ids
are treated each for itself; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tickfold.llm.common import words
from tickfold.llm.shingles import parts
from tickfold.session import ship_package

MIN_WORDS, EXPONENT = 6, 4
RUNS_SCHEMA = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

#: A node of the tree: its places, and for each word on the left the places that follow it.
Node = tuple[list[int], dict[int, list[int]]]


def suffix_order(first: np.ndarray, shared: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places that share ``shared`` words (a power of 2) or more with another one, in suffix
    order, and the ranks of all places by 1, 2, 4, ... words. ``first`` ranks single words;
    equal ranks never belong to two documents."""
    n = len(first)
    order = np.argsort(first, kind="stable")
    rank, key = np.zeros(n, np.int64), first[order]
    levels: list[np.ndarray] = []
    repeated = np.zeros(0, np.int64)
    base = np.zeros(n, np.int64)
    while True:
        # Rows of one old group lie together; a new group's rank is that of its first row.
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else key
        size = np.diff(np.append(new, len(key)))
        old = np.flatnonzero(np.concatenate([[True], base[1:] != base[:-1]])) if len(base) else base
        group = np.searchsorted(old, new, "right") - 1
        start = new if not levels else base[new] + (new - old[group])
        rank[order] = np.repeat(start, size)
        levels.append(rank.astype(np.int32))
        order = order[np.repeat(size > 1, size)]
        step = 1 << (len(levels) - 1)
        if step == shared:
            repeated = order
        if not len(order):
            break
        base = rank[order]
        key = base * n + rank[order + step]
        inside = np.argsort(key, kind="stable")
        order, base, key = order[inside], base[inside], key[inside]
    return repeated[np.argsort(rank[repeated])], levels


def common_lengths(a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Words that the suffixes at ``a`` and ``b`` share, by the ranks from long to short."""
    a, b, total = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    for power in range(len(levels) - 1, -1, -1):
        step = np.where(levels[power][a] == levels[power][b], 1 << power, 0)
        a, b, total = a + step, b + step, total + step
    return total


def _meet(
    one: Node, two: Node, depth: int, reach: int, least: int, left: list[int], found: dict
) -> Node:
    """Two children of a node: their maximal pairs go to ``found``, by stretch the smallest
    period; then they are one."""
    small, large = (one, two) if len(one[0]) <= len(two[0]) else (two, one)
    places, classes = large
    for word, own in small[1].items():
        for x in own:
            low = bisect_left(places, x - reach)
            high = bisect_right(places, x + reach, low)
            if low == high:
                continue
            if high - low <= len(classes):
                near = [y for y in places[low:high] if left[y] != word]
            else:
                near = []
                for other, ys in classes.items():
                    if other != word:
                        near += ys[bisect_left(ys, x - reach) : bisect_right(ys, x + reach)]
            for y in near:
                period = abs(x - y)
                if period + depth >= least:
                    stretch = (min(x, y), period + depth)
                    found[stretch] = min(found.get(stretch, period), period)
    _merge(places, small[0])
    for word, own in small[1].items():
        if word in classes:
            _merge(classes[word], own)
        else:
            classes[word] = own
    return large


def _merge(into: list[int], more: list[int]) -> None:
    if len(more) * 50 < len(into):
        for x in more:
            insort(into, x)
    else:
        into += more
        into.sort()


def runs_of(
    word: np.ndarray, min_words: int = MIN_WORDS, exponent: int = EXPONENT
) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run; ``word`` numbers the words of documents, each one
    followed by -1."""
    if exponent < 2:
        raise ValueError("a run repeats its period at least twice")
    shallow = min(max(min_words - d, (exponent - 1) * d) for d in range(1, max(2, min_words)))
    document = np.cumsum(word == -1) - (word == -1)
    width = int(word.max(initial=0)) + 2
    first = document * width + word + 1
    order, levels = suffix_order(first, 1 << (shallow.bit_length() - 1))
    if len(order) < 2:
        return []
    shared = common_lengths(order[:-1], order[1:], levels)
    left = np.concatenate([[-1], word[:-1]]).tolist()
    found: dict[tuple[int, int], int] = {}
    stack: list[tuple[int, Node]] = []
    for place, depth in zip(order.tolist(), [*shared.tolist(), 0], strict=True):
        node: Node = ([place], {left[place]: [place]})
        while stack and stack[-1][0] >= max(depth, shallow):
            at, sibling = stack.pop()
            node = _meet(sibling, node, at, at // (exponent - 1), min_words, left, found)
        if depth >= shallow:
            stack.append((depth, node))
        else:
            stack.clear()
    return sorted((start, length, period) for (start, length), period in found.items())


def _word_numbers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of all texts with -1 after each text, and where each text begins."""
    split = pc.ascii_split_whitespace(texts)
    edges = split.offsets.to_numpy() - split.offsets[0].as_py()
    pieces = split.flatten()
    real = pc.greater(pc.binary_length(pieces), 0).to_numpy(zero_copy_only=False)
    numbers = pieces.dictionary_encode().indices.to_numpy(zero_copy_only=False)[real]
    before = np.concatenate([[0], np.cumsum(real)])[edges]
    out = np.full(len(numbers) + len(texts), -1, np.int64)
    owner = np.repeat(np.arange(len(texts)), np.diff(before))
    out[np.arange(len(numbers)) + owner] = numbers
    return out, before[:-1] + np.arange(len(texts))


def _collapsed(text: str, runs: list[tuple[int, int, int]]) -> str:
    """The words that are left, joined by one space."""
    left = text.encode().split()  # at ASCII white space
    if runs:
        gone = np.zeros(len(left) + 1, np.int64)
        for start, length, period in runs:
            gone[start + period] += 1
            gone[start + length] -= 1
        keep = np.cumsum(gone)[:-1] == 0
        left = [w for w, k in zip(left, keep.tolist(), strict=True) if k]
    return b" ".join(left).decode()


def periodic_runs(
    df: DataFrame,
    min_words: int = MIN_WORDS,
    exponent: int = EXPONENT,
    doc_id: str = "doc_id",
    text: str | Column = "text",
) -> DataFrame:
    """doc_id, ``runs`` (start, length and period in words, by start and period) and
    ``collapsed``: the words outside runs and the first period of each, joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts(whole):
                texts = batch.column("text").cast(pa.string())
                numbers, begin = _word_numbers(texts)
                own: list[list[tuple[int, int, int]]] = [[] for _ in range(len(begin))]
                for start, length, period in runs_of(numbers, min_words, exponent):
                    i = int(np.searchsorted(begin, start, "right")) - 1
                    own[i].append((start - int(begin[i]), length, period))
                names = ("start", "length", "period")
                lists = [[dict(zip(names, r, strict=True)) for r in some] for some in own]
                left = [_collapsed(t, r) for t, r in zip(texts.to_pylist(), own, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(lists, pa.list_(_RUN)), pa.array(left)],
                    names=["doc_id", "runs", "collapsed"],
                )

    ship_package(df.sparkSession)
    value = F.col(text) if isinstance(text, str) else text
    docs = df.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(value, F.lit("")).alias("text")
    )
    return docs.mapInArrow(run, RUNS_SCHEMA)


def planted(doc_id: Column, text: Column) -> Column:
    """The text, and for every tenth id by hash the words from some place on made periodic."""
    h = F.crc32(doc_id.cast("string"))
    every = F.struct(words(text).alias("w"), F.floor(h / 10).cast("long").alias("g"))

    def periodic(x: Column) -> Column:
        n = F.size(x["w"]).cast("long")
        a = F.pmod(x["g"], n)
        p = F.floor((n - a) / (F.pmod(x["g"], F.lit(8)) + 3)).cast("long") + 1
        place = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p))
        at = F.sequence(F.lit(0).cast("long"), n - 1)
        return F.array_join(F.transform(at, lambda i: F.get(x["w"], place(i).cast("int"))), " ")

    # The lambda binds the words, which are read many times.
    made = F.element_at(F.transform(F.array(every), periodic), 1)
    some = (F.pmod(h, F.lit(10)) == 0) & text.rlike("[^\\x20\\x09-\\x0D]")
    return F.when(some, made).otherwise(text)


def run_digest(found: DataFrame) -> DataFrame:
    """Of ``periodic_runs``: counts, the longest run, and digests of runs and left words."""
    order = lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")
    )
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    best = F.array_max(F.transform("runs", order))
    rows = found.select("doc_id", "runs", "collapsed", best.alias("best"))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("best.length * 1000 div -best.p").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
