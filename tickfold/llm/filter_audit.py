"""What filters do to each other: every order of them, from one walk over their subsets.

Each document becomes a mask of the filters that it fails, and documents are summed by part and
mask, so that what is left is at most 32 cells for each part. The subsets of the filters are
then walked in Gray-code order, one filter on or off at a time. Every cell has a counter of its
active failures: a cell whose counter leaves zero goes out of the running survivors, one whose
counter returns to zero comes back. The survivors of each subset are stored, 32 states. All that
is asked about a step of an order is a difference of two states: the subset of the filters before
it and the one with it.

A text fails the last filter if a smaller id has the same text. That takes no window over the
copies of a text: the smallest id of each digest is summed, and rows are joined to it by digest
and id, so a text that fills a third of the table is spread over all tasks.

Defined cases: a null text counts as empty, a null part as the empty string; texts of any length
are measured whole; rows that repeat an id and its text are no copies of each other and count
each; a null id is larger than any other; a document without labels is neither good nor toxic,
one with several labels is what any of them says; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickfold.llm.common import utf8, words, written
from tickfold.session import ship_package

FILTERS = "ABCDE"  # bit i of a mask is filter i
MIN_WORDS = 100
LEAST_DISTINCT, MOST_CAPITAL = 80, 10  # per hundred words, per hundred code points
SALTS = 256  # parts over which rows without an id are spread in the join with the labels

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
AUDIT_SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)
_MEASURES = 3  # documents, good ones, toxic ones


def own_failures(text: Column) -> list[Column]:
    """The filters that look at one text alone, A to D, as conditions over step columns."""
    t = utf8(text)
    n, distinct = F.size("w"), F.size(F.array_distinct("w"))
    capital = F.regexp_count(t, F.lit("[A-Z]"))
    return [
        n < MIN_WORDS,
        distinct * 100 < n * LEAST_DISTINCT,
        capital * 100 > F.char_length(t) * MOST_CAPITAL,
        t.rlike("[#$%&*|]"),
    ]


def _bits(conditions: list[Column]) -> Column:
    mask = F.lit(0)
    for i, c in enumerate(conditions):
        mask = mask + F.when(c, F.lit(1 << i)).otherwise(F.lit(0))
    return mask


def failure_cells(
    df: DataFrame,
    labels: DataFrame,
    part: str = "lang",
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """part, mask, n_docs, n_good, n_toxic. ``labels`` has doc_id, quality and toxic."""
    docs = df.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        utf8(F.col(part).cast("string")).alias("part"),
        F.col(text).alias("text"),
        words(F.col(text)).alias("w"),
    )
    measured = written(
        docs.select(
            "doc_id",
            "part",
            _bits(own_failures(F.col("text"))).alias("own"),
            F.unhex(F.sha2(utf8(F.col("text")), 256)).alias("digest"),
        ),
        "failures",
    )
    first = measured.groupBy("digest").agg(F.min("doc_id").alias("first_id"))
    some = measured.groupBy("doc_id", "digest", "part", "own").agg(F.count("*").alias("n"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"),
    )
    marks = marks.where("good + toxic > 0").withColumn("label_salt", F.lit(0))
    salt = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(SALTS)).cast("int"))
    marked = some.withColumn("salt", F.coalesce(salt, F.lit(0))).join(
        marks, F.expr("doc_id = label_id AND salt = label_salt"), "left"
    )
    first = first.select(F.col("digest").alias("first_digest"), "first_id", F.lit(1).alias("is_first"))
    told = marked.join(first, F.expr("digest = first_digest AND doc_id <=> first_id"), "left")
    copy = F.when(F.col("is_first").isNull(), F.lit(1 << 4)).otherwise(F.lit(0))
    count = lambda c: F.sum(F.col("n") * F.coalesce(F.col(c), F.lit(0)))
    return told.groupBy("part", (F.col("own") + copy).alias("mask")).agg(
        F.sum("n").alias("n_docs"), count("good").alias("n_good"), count("toxic").alias("n_toxic")
    )


def gray_walk(cells: np.ndarray) -> np.ndarray:
    """Survivors of every subset of the filters. ``cells`` and the result have the axes part,
    mask (of failures, or of active filters) and measure."""
    size = cells.shape[1]
    masks = np.arange(size)
    failing = np.zeros(size, np.int64)  # active failures of a cell
    alive = cells.sum(axis=1)
    states = np.zeros_like(cells)
    states[:, 0] = alive
    active = 0
    for i in range(1, size):
        bit = i & -i  # the filter that the i-th step of a Gray code toggles
        active ^= bit
        hit = (masks & bit) > 0
        if active & bit:
            alive = alive - cells[:, hit & (failing == 0)].sum(axis=1)
            failing += hit
        else:
            failing -= hit
            alive = alive + cells[:, hit & (failing == 0)].sum(axis=1)
        states[:, active] = alive
    return states


def _steps(filters: str) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """All orders, and for each step the subset before it, the one with it, and its filter."""
    orders = ["".join(p) for p in permutations(filters)]
    bit = np.array([[filters.index(f) for f in o] for o in orders])
    with_it = np.cumsum(1 << bit, axis=1)
    return orders, with_it - (1 << bit), with_it, bit


def answers(states: np.ndarray, filters: str = FILTERS) -> dict[str, np.ndarray]:
    """COUNTS of every part (axis 0) and step of every order (axis 1), from the states."""
    n, size = len(filters), states.shape[1]
    _, before, after, bit = (x if isinstance(x, list) else x.ravel() for x in _steps(filters))
    lost = states[:, before] - states[:, after]
    ones = 1 << np.arange(n)
    fails = states[:, [0]][:, :, 0] - states[:, ones][:, :, 0]
    alone = states[:, size - 1 - ones][:, :, 0] - states[:, [size - 1]][:, :, 0]
    shapley = np.zeros((len(states), n), np.int64)
    for f, one in enumerate(ones.tolist()):
        for s in range(size):
            if not s & one:
                k = s.bit_count()  # orders in which exactly the filters of s come before f
                weight = factorial(k) * factorial(n - 1 - k)
                shapley[:, f] += weight * (states[:, s, 0] - states[:, s | one, 0])
    return {
        "kept": states[:, after, 0],
        "removed": lost[:, :, 0],
        "redundant": fails[:, bit] - lost[:, :, 0],
        "unique_fails": alone[:, bit],
        "good_lost": lost[:, :, 1],
        "toxic_lost": lost[:, :, 2],
        "shapley": shapley[:, bit],
    }


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """part x mask x measure from the lists of cells."""
    lists = batch.column("cells")
    rows, own = lists.flatten(), np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    out = np.zeros((len(lists), 1 << len(FILTERS), _MEASURES), np.int64)
    field = lambda name: rows.field(name).to_numpy(zero_copy_only=False)
    for i, name in enumerate(("n_docs", "n_good", "n_toxic")):
        out[own, field("mask"), i] = field(name)
    return out


def audit(cells: DataFrame) -> DataFrame:
    """A row for every part, order of the filters and step in it."""
    ship_package(cells.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = _steps(FILTERS)[0]
        n, many = len(FILTERS), len(orders) * len(FILTERS)
        order, step = np.repeat(orders, n), np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders))
        for whole in batches:
            for at in range(0, len(whole), 64):  # parts; a few tens of thousand rows
                batch = whole.slice(at, 64)
                found = answers(gray_walk(_matrix(batch)))
                parts = batch.column("part").take(pa.array(np.repeat(np.arange(len(batch)), many)))
                columns = [
                    parts,
                    pa.array(np.tile(order, len(batch))),
                    pa.array(np.tile(step, len(batch))),
                    *[pa.array(found[c].ravel()) for c in COUNTS],
                ]
                names = ["part", "filter_order", "step", *COUNTS]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    # At most 32 cells in a list.
    rows = F.collect_list(F.struct("mask", "n_docs", "n_good", "n_toxic")).alias("cells")
    return cells.groupBy("part").agg(rows).mapInArrow(run, AUDIT_SCHEMA)
