"""Nearest neighbours by largest inner product, with multi-index hashing.

Vectors are dealt into classes of about equal norm, and those into blocks of bounded size. Inside
a block vectors are laid on a sphere, where the inner product is a cosine: each is scaled by the
largest norm and gets one more component that makes its norm 1, a query gets 0 there. A rotation
learned from a bounded sample of the block (iterative quantisation) turns a vector into a code of
64 signs, split into 8 substrings of a byte, with a table per substring. If two codes differ in at
most r of 64 signs, they differ in at most r // 8 signs of some substring, and with r = 8 a + b in
at most a of the first b + 1 or a - 1 of the others; so probing those bytes finds every code
within r. What is found within r is ranked by the exact inner product of the original vectors.

The radius is each query's own: from its 20th best score so far follows the radius that holds all
but a few in a hundred of better vectors, and the probe is repeated with it. How distance depends
on cosine is fitted to the nearest pairs of sampled queries and sampled vectors of the block, so
it holds for codes of queries against codes of data, whatever the norms. A block too small for
that is searched whole. The index holds every row.

The search is exact in what it returns (scores, order, ties by smaller id) and approximate in
what it finds; the tests measure recall against brute force, for each query too.

Defined cases: vectors that are null, zero, of another length than the sample's, or hold a null
or non-finite component take no part, nor do null ids; rows that share an id are all candidates,
but not for a query of that id; fewer candidates than asked for are all returned; ties go to the
smaller id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tickfold.llm.common import groups
from tickfold.session import ship_package

BITS, PARTS = 64, 8
SAMPLE = 4096  # vectors of a block that the rotation is learned from
PAIRED = 512, 2048  # queries and vectors whose pairs the radius is learned from
SMALL = 256  # vectors of a block that is searched whole
NORM_STEP = 1.2  # the largest norm of a class over its smallest
ROUNDS = 30
BLOCK, CHUNK = 8192, 4096  # vectors and queries of a task
WANTED = 40  # the first radius suits the best of this many vectors of a block
#: Standard deviations of the distance, at the cosine of the 20th best, that the radius covers.
SPREAD = 2.0

_POPULATION = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_BALL = [np.flatnonzero(_POPULATION <= r).astype(np.uint8) for r in range(9)]


class Codes:
    """The learned rotation, and how far apart codes are at a given cosine."""

    def __init__(
        self,
        vectors: np.ndarray,
        top_norm: float,
        queries: np.ndarray | None = None,
        seed: int = 0,
    ):
        self.top_norm = top_norm
        rng = np.random.default_rng(seed)
        x = self.on_sphere(vectors[rng.permutation(len(vectors))[:SAMPLE]])
        values, axes = np.linalg.eigh(x.T @ x)
        width = min(BITS, x.shape[1])
        axes = axes[:, np.argsort(-values)[:width]]
        # Fewer dimensions than bits: more directions of the same space.
        if width < BITS:
            axes = np.hstack([axes, axes @ rng.normal(size=(width, BITS - width))])
        y = x @ axes
        turn = np.linalg.qr(rng.normal(size=(BITS, BITS)))[0]
        for _ in range(ROUNDS):
            u, _, v = np.linalg.svd(np.sign(y @ turn).T @ y)
            turn = (u @ v).T
        self.turn = axes @ turn
        self._fit(x, vectors if queries is None else queries, len(vectors), rng)

    def _fit(self, x: np.ndarray, queries: np.ndarray, n: int, rng: np.random.Generator) -> None:
        """Distance by cosine, a line through the nearest pairs, and the radius to begin with."""
        some = queries[rng.permutation(len(queries))[: PAIRED[0]]]
        x = x[: PAIRED[1]]
        unit = some / np.linalg.norm(some, axis=1, keepdims=True)
        cosine = unit @ x[:, :-1].T
        asked, stored = self.of_queries(some), self.code(x)
        far = np.stack([_POPULATION[stored ^ code].sum(1) for code in asked])
        alike = (cosine > 1 - 1e-9).ravel()  # a query against itself
        cosine, far = cosine.ravel()[~alike], far.ravel()[~alike].astype(np.float64)
        near = np.argsort(-cosine)[: max(200, len(cosine) // 50)]
        angle = np.arccos(np.clip(cosine[near], -1, 1)) / np.pi
        if n <= SMALL or len(near) < 200 or np.ptp(angle) == 0:
            self.slope, self.base, self.noise, self.start = 0.0, float(BITS), 0.0, BITS
            return
        # A larger angle is no nearer: the line must not fall.
        self.slope = max(0.0, float(np.cov(angle, far[near])[0, 1] / np.var(angle)))
        self.base = float(far[near].mean() - self.slope * angle.mean())
        self.noise = float(np.std(far[near] - self.base - self.slope * angle))
        # Where to begin: the cosine that as many vectors of the block exceed as are wanted.
        self.start = self.radius(float(np.quantile(cosine, max(0.0, 1 - WANTED / n))))

    def on_sphere(self, x: np.ndarray) -> np.ndarray:
        x = x / self.top_norm
        rest = np.sqrt(np.maximum(1 - (x * x).sum(1, keepdims=True), 0))
        return np.hstack([x, rest])

    def of_queries(self, x: np.ndarray) -> np.ndarray:
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        return self.code(np.hstack([x, np.zeros((len(x), 1))]))

    def code(self, x: np.ndarray) -> np.ndarray:
        return np.packbits(x @ self.turn > 0, axis=1)

    def radius(self, cosine: float) -> int:
        angle = np.arccos(min(1.0, max(-1.0, cosine))) / np.pi
        reach = self.base + self.slope * angle + SPREAD * self.noise
        return min(BITS, max(0, int(np.ceil(reach))))


class Block:
    """Codes of some vectors with a table of places for each substring."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, codes: Codes):
        self.ids, self.vectors, self.codes = ids, vectors, codes
        self.code = codes.code(codes.on_sphere(vectors))
        self.order = [np.argsort(self.code[:, j], kind="stable") for j in range(PARTS)]
        self.edges = [
            np.searchsorted(self.code[o, j], np.arange(257)) for j, o in enumerate(self.order)
        ]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Places of all codes that differ in at most ``radius`` signs."""
        hit = np.zeros(len(self.ids), bool)
        full, extra = divmod(radius, PARTS)
        for j in range(PARTS):
            reach = full if j <= extra else full - 1
            if reach < 0:
                continue
            probes = _BALL[min(reach, 8)] ^ code[j]
            begin, end = self.edges[j][probes], self.edges[j][probes.astype(np.int64) + 1]
            size = end - begin
            at = np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size)
            hit[self.order[j][at]] = True
        found = np.flatnonzero(hit)
        return found[_POPULATION[self.code[found] ^ code].sum(1, dtype=np.int64) <= radius]

    def nearest(self, query: int, vector: np.ndarray, code: np.ndarray, k: int):
        norm = float(np.sqrt((vector * vector).sum())) * self.codes.top_norm
        radius = self.codes.start
        while True:
            found = self.within(code, radius)
            found = found[self.ids[found] != query]
            score = (self.vectors[found] * vector).sum(1)
            if radius >= BITS:
                break
            if len(found) < k:
                radius = min(BITS, radius + 4)
                continue
            wanted = self.codes.radius(float(np.partition(score, -k)[-k]) / norm)
            if wanted <= radius:
                break
            radius = wanted if wanted - radius < 8 else radius + 4
        best = np.lexsort((self.ids[found], -score))[:k]
        return self.ids[found[best]], score[best]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _search(width: int, k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def answers() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            rows = pa.Table.from_batches(held).combine_chunks()
            ids, side = rows["id"].to_numpy(), rows["side"].to_numpy()
            vectors = _matrix(rows["vector"].combine_chunks(), width)
            stored, asked = side == 0, side == 1
            if not stored.any() or not asked.any():
                return
            top = float(np.sqrt((vectors[stored] ** 2).sum(1).max()))
            codes = Codes(vectors[stored], top, vectors[asked])
            block = Block(ids[stored], vectors[stored], codes)
            out: list[tuple] = []
            for query, vector, code in zip(
                ids[asked].tolist(), vectors[asked], codes.of_queries(vectors[asked]), strict=True
            ):
                near, score = block.nearest(query, vector, code, k)
                out.append((np.full(len(near), query), near, score))
            columns = [np.concatenate(x) for x in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], names=["query_id", "vec_id", "score"]
            )

        for _, piece, fresh in groups(batches, "task"):
            if fresh:
                yield from answers()
                held = []
            held.append(piece)
        yield from answers()

    return run


def nearest(
    df: DataFrame,
    is_query: Column,
    k: int = 20,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for every row that ``is_query`` (of ``id``)."""
    ship_package(df.sparkSession)
    wrong = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("vector")).where(
        F.col("id").isNotNull()
        & F.col("vector").isNotNull()
        & ~F.exists("vector", wrong)
        & F.exists("vector", lambda x: x != 0)
    )
    square = F.aggregate(
        "vector", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
    )
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select(F.size("vector")).collect()
    empty = df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not sample:
        return empty
    width = int(np.bincount([r[0] for r in sample]).argmax())
    norm_class = F.floor(F.log(square) / (2 * math.log(NORM_STEP))).cast("int")
    rows = rows.where(F.size("vector") == width).withColumn("norm_class", norm_class)
    # A row for each class: doubles have fewer than 10,000 of them.
    known = rows.groupBy("norm_class").agg(F.count("*").alias("n"), F.count_if(is_query).alias("q"))
    counts = known.orderBy("norm_class").collect()
    chunks = max(1, -(-sum(r.q for r in counts) // CHUNK))
    classes, blocks = [], 0
    for r in counts:
        own = -(-r.n // BLOCK)
        classes.append((r.norm_class, own, blocks))
        blocks += own
    firsts = df.sparkSession.createDataFrame(classes, "norm_class int, own int, first int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    chunk = F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int")
    block = (F.col("first") + F.pmod(F.xxhash64("id"), F.col("own"))).cast("int")
    stored = rows.join(F.broadcast(firsts), "norm_class").select(
        "id", "vector", block.alias("block"), all_of(chunks).alias("chunk")
    )
    asked = rows.where(is_query).select(
        "id", "vector", all_of(blocks).alias("block"), chunk.alias("chunk")
    )
    task = (F.col("block").cast("long") * chunks + F.col("chunk")).alias("task")
    tasks = stored.select(task, F.lit(0).alias("side"), "id", "vector").unionAll(
        asked.select(task, F.lit(1).alias("side"), "id", "vector")
    )
    found = (
        tasks.repartition(min(blocks * chunks, 1 << 20), "task")
        .sortWithinPartitions("task")
        .mapInArrow(_search(width, k), "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
