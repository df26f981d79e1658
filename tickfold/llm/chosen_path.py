"""Near duplicates by a chosen-path set similarity join.

1. Each text becomes its set of word shingles, and the set a sketch of 128 minwise tokens. Texts
   with equal sets are one class; only the smallest id of a class goes on.
2. Independent trees branch the classes: at the root each class goes to ``BRANCHES`` children,
   named by its minwise tokens under that many functions; a node that is too large branches its
   rest again by two sketch positions that its path selects. A pair of similarity s shares a
   child with chance 1 - (1-s)^2 per tree and level, so four trees miss fewer than 1 in 100,000
   pairs at 0.8.
3. Small nodes are compared exhaustively, by sketch. In a large one up to ``NODE`` leaders are
   kept: what is nearly equal to a leader is covered by it, since whatever is similar to the one
   is then fairly similar to the other, and only rows that no leader covers branch on. Nodes give
   spanning edges, never all pairs.
4. Components of these edges hold every link. Inside each the full sets decide: the members of a
   component that fits in a task are compared together; a larger one is first tied to a few of
   its members, and then whatever is outside its main group is compared, block by block, with
   all of it. Pairs that are already tied together need no comparison.

Work on a group of copies is linear in it as long as its members are tied to few of it; what is
not is compared exactly, in blocks over many tasks.

Defined cases: null and empty texts, or texts without words, have an empty set and link with
nothing; a text with fewer words than a shingle is one shingle; rows that share an id are one
document, each kept as a row; a null id links with nothing, has a null component and is kept; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickfold.llm.common import groups, written
from tickfold.llm.components import components, stars_of
from tickfold.llm.shingles import mix, parts, shingle_sets
from tickfold.session import ship_package

SKETCH = 128
TREES, BRANCHES = 4, 2
NODE = 512  # members compared exhaustively, or leaders
LAST_LEVEL = 24  # a node that still has a rest here takes leaders without limit
#: Of 128 equal positions: a pair of similarity 0.8 has 102 on average and 80 or fewer once in
#: a million; a leader covers rows at 112, and may be similar to what they are similar to at 56.
SIMILAR, COVERED, NEAR = 80, 112, 56
PERCENT = 80  # the trees find pairs of at least this similarity
TASK = 2048  # members of a component compared in one task
BLOCK, PIVOTS = 1024, 8

_functions = np.random.default_rng(7)
_XOR = _functions.integers(0, 1 << 63, SKETCH + TREES * BRANCHES, dtype=np.uint64)
_ODD = _functions.integers(0, 1 << 63, SKETCH + TREES * BRANCHES, dtype=np.uint64) | np.uint64(1)
SKETCH_SCHEMA = "doc_id long, n long, f1 long, f2 long, keys array<long>, sketch binary"
NODE_SCHEMA = "a long, b long, path long, id long, n long, sketch binary"


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _rows_of(width: int, raw: np.ndarray) -> pa.Array:
    """A binary column from rows of ``width`` bytes."""
    n = len(raw)
    offsets = np.arange(n + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(
        pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw))]
    )


def _sketches(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts(whole):
                flat, edges = shingle_sets(batch.column("text"), width)
                sizes = np.diff(edges)
                some = sizes > 0
                at = edges[:-1][some]
                low = np.zeros((len(sizes), len(_XOR)), np.uint64)
                f1, f2 = np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), np.uint64)
                if len(at):
                    for k in range(len(_XOR)):
                        low[some, k] = np.minimum.reduceat((flat ^ _XOR[k]) * _ODD[k], at)
                    f1[some] = np.add.reduceat(mix(flat), at)
                    f2[some] = np.add.reduceat(mix(flat ^ _XOR[0]), at)
                keys = mix(low[:, SKETCH:] + np.arange(TREES * BRANCHES, dtype=np.uint64))
                ends = np.arange(len(sizes) + 1, dtype=np.int32) * keys.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(_signed(f1)),
                        pa.array(_signed(f2)),
                        pa.ListArray.from_arrays(ends, pa.array(_signed(keys.ravel()))),
                        _rows_of(SKETCH, low[:, :SKETCH].astype(np.uint8)),
                    ],
                    names=["doc_id", "n", "f1", "f2", "keys", "sketch"],
                )

    return run


class _Union:
    """Union-find over positions."""

    def __init__(self) -> None:
        self.up: list[int] = []

    def add(self) -> int:
        self.up.append(len(self.up))
        return len(self.up) - 1

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


class _Node:
    """A node of a tree, fed with its members piece by piece."""

    def __init__(self, path: int, limit: int):
        self.path, self.limit, self.size = path, limit, 0
        self.held: list[tuple] = []
        self.large = False
        self.ids: list[int] = []  # of leaders
        self.tied = _Union()  # over leaders
        self.leaders = np.zeros((0, SKETCH), np.uint8)
        self.edges: list[tuple[int, int]] = []
        self.rest: list[tuple] = []

    def add(self, ids: np.ndarray, n: np.ndarray, sketch: np.ndarray) -> None:
        self.size += len(ids)
        if not self.large:
            self.held.append((ids, n, sketch))
            if self.size <= NODE:
                return
            self.large = True
            held, self.held = self.held, []
            for piece in held:
                self._lead(*piece)
        else:
            self._lead(ids, n, sketch)

    def _lead(self, ids: np.ndarray, n: np.ndarray, sketch: np.ndarray) -> None:
        for i in range(0, len(ids), 64):
            self._lead_few(ids[i : i + 64], n[i : i + 64], sketch[i : i + 64])

    def _lead_few(self, ids: np.ndarray, n: np.ndarray, sketch: np.ndarray) -> None:
        known = len(self.ids)
        same = np.zeros((len(ids), known), np.int16)
        for i in range(len(ids)):
            same[i] = (self.leaders == sketch[i]).sum(1, dtype=np.int16)
        for i in range(len(ids)):
            row = np.concatenate(
                [same[i], (self.leaders[known:] == sketch[i]).sum(1, dtype=np.int16)]
            )
            near = np.flatnonzero(row >= NEAR).tolist()
            if near:
                self.edges.append((int(ids[i]), self.ids[near[0]]))
                for other in near[1:]:
                    if self.tied.join(near[0], other):
                        self.edges.append((self.ids[near[0]], self.ids[other]))
            if len(row) and row.max() >= COVERED:
                continue
            if len(self.ids) < self.limit:
                self.ids.append(int(ids[i]))
                self.leaders = np.concatenate([self.leaders, sketch[i : i + 1]])
                new = self.tied.add()
                if near:
                    self.tied.join(near[0], new)
            else:
                self.rest.append((ids[i], n[i], sketch[i]))

    def finish(self) -> None:
        if self.large or self.size < 2:
            return
        ids, n, sketch = (np.concatenate(x) for x in zip(*self.held, strict=True))
        label = np.arange(len(ids))
        for i in range(1, len(ids)):
            same = (sketch[:i] == sketch[i]).sum(1, dtype=np.int16) >= SIMILAR
            same &= np.minimum(n[:i], n[i]) * 100 >= PERCENT * np.maximum(n[:i], n[i])
            if same.any():
                for other, j in zip(*np.unique(label[:i][same], return_index=True), strict=True):
                    if other != label[i]:
                        self.edges.append((int(ids[i]), int(ids[np.flatnonzero(same)[j]])))
                        label[label == max(other, label[i])] = min(other, label[i])

    def children(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """The rest, once for each selected position: path, id, n, sketch."""
        ids = np.array([r[0] for r in self.rest], np.int64)
        n = np.array([r[1] for r in self.rest], np.int64)
        sketch = np.stack([r[2] for r in self.rest])
        seed = mix(np.array([self.path], np.int64).view(np.uint64))
        first = int(seed[0] % np.uint64(SKETCH))
        second = (first + 1 + int((seed[0] >> np.uint64(32)) % np.uint64(SKETCH - 1))) % SKETCH
        for position in (first, second):
            token = sketch[:, position].astype(np.uint64) + np.uint64(256 * position)
            yield _signed(mix(seed + token * np.uint64(0x9E3779B97F4A7C15))), ids, n, sketch


def _branch(limit: int) -> Callable:
    """Compares or branches nodes; rows come sorted by path."""

    def out(edges: list, children: list) -> Iterator[pa.RecordBatch]:
        if edges:
            a, b = np.array(edges, np.int64).T
            none = pa.nulls(len(a), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(b), none, none, none, pa.nulls(len(a), pa.binary())],
                names=["a", "b", "path", "id", "n", "sketch"],
            )
        for path, ids, n, sketch in children:
            none = pa.nulls(len(ids), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, pa.array(path), pa.array(ids), pa.array(n), _rows_of(SKETCH, sketch)],
                names=["a", "b", "path", "id", "n", "sketch"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, edges = None, []
        for batch in batches:
            path = batch.column("path").to_numpy(zero_copy_only=False)
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            n = batch.column("n").to_numpy(zero_copy_only=False)
            column = batch.column("sketch")
            offset = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
            sketch = np.frombuffer(column.buffers()[2], np.uint8)[offset:]
            sketch = sketch[: len(ids) * SKETCH].reshape(-1, SKETCH)
            at = np.concatenate([[0], np.flatnonzero(path[1:] != path[:-1]) + 1, [len(path)]])
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                if node is None or node.path != path[a]:
                    if node is not None:
                        node.finish()
                        edges += node.edges
                        if node.rest:
                            yield from out([], list(node.children()))
                    if b - a == 1 and b < len(path):  # alone in its node
                        node = None
                        continue
                    node = _Node(int(path[a]), limit)
                node.add(ids[a:b], n[a:b], sketch[a:b].copy())
                if len(node.edges) + len(edges) > 50_000:
                    yield from out(edges + node.edges, [])
                    edges, node.edges = [], []
        if node is not None:
            node.finish()
            edges += node.edges
            yield from out(edges, list(node.children()) if node.rest else [])
        else:
            yield from out(edges, [])

    return run


def candidate_edges(classes: DataFrame) -> list[DataFrame]:
    """Edges between ids whose components hold every pair that is similar enough."""
    rows = classes.select(F.explode("keys").alias("path"), "id", "n", "sketch")
    edges = []
    for level in range(LAST_LEVEL + 1):
        limit = NODE if level < LAST_LEVEL else 1 << 62
        done = written(
            rows.repartition("path")
            .sortWithinPartitions("path")
            .mapInArrow(_branch(limit), NODE_SCHEMA),
            "nodes",
        )
        edges.append(done.where("a IS NOT NULL").select("a", "b"))
        rows = done.where("path IS NOT NULL").select("path", "id", "n", "sketch")
        if not rows.take(1):
            break
    return edges


def _linked(sets: list[np.ndarray], ids: np.ndarray, percent: int, first: int) -> list[tuple]:
    """Spanning edges of the links among all sets or, if ``first`` is not all of them, between
    the first ones and the others.

    A set is compared with all others at once by the places of its shingles. Sets of the largest
    component so far wait: whatever stays outside is compared with them."""
    total, sizes = len(sets), np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    new = np.concatenate([[True], flat[order][1:] != flat[order][:-1]])
    begins = np.append(np.flatnonzero(new), len(flat))
    token = np.empty(len(flat), np.int64)
    token[order] = np.cumsum(new) - 1
    holders = np.repeat(np.arange(total), sizes)[order]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    label, waiting, edges = np.arange(total), np.arange(total) < first, []
    while True:
        todo = waiting if first < total else waiting & (label != np.bincount(label).argmax())
        if not todo.any():
            return edges
        i = int(todo.argmax())
        waiting[i] = False
        own = token[starts[i] : starts[i + 1]]
        lengths = begins[own + 1] - begins[own]
        at = np.repeat(begins[own] - (np.cumsum(lengths) - lengths), lengths)
        shared = np.bincount(holders[at + np.arange(len(at))], minlength=total)
        hit = (shared * 100 >= percent * (sizes + sizes[i] - shared)) & (shared > 0)
        if first < total:
            hit[:first] = False
        for other, j in zip(*np.unique(label[hit], return_index=True), strict=True):
            if other != label[i]:
                edges.append((int(ids[i]), int(ids[np.flatnonzero(hit)[j]])))
                label[label == max(other, label[i])] = min(other, label[i])


def _compare(percent: int) -> Callable:
    """Links in each task; rows come sorted by task and side, side 1 only meets side 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def links() -> Iterator[pa.RecordBatch]:
            if sum(len(x) for x in held) < 2:
                return
            rows = pa.Table.from_batches(held).combine_chunks()
            side = rows["side"].to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in rows["shingles"].to_pylist()]
            first = int((side == 0).sum())
            found = _linked(sets, rows["id"].to_numpy(), percent, first)
            if found:
                a, b = stars_of(*np.array(found, np.int64).T)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for _, piece, fresh in groups(batches, "task"):
            if fresh:
                yield from links()
                held = []
            held.append(piece)
        yield from links()

    return run


def _sets(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts(whole):
                flat, edges = shingle_sets(batch.column("text"), width)
                raw = flat.view(np.uint8)
                ends = pa.py_buffer((edges * 8).astype(np.int32))
                shingles = pa.Array.from_buffers(
                    pa.binary(), len(edges) - 1, [None, ends, pa.py_buffer(raw)]
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("cluster"), batch.column("m"), shingles],
                    names=["id", "cluster", "m", "shingles"],
                )

    return run


def _in_tasks(rows: DataFrame, percent: int) -> DataFrame:
    return (
        rows.select("task", "side", "id", "shingles")
        .repartition("task")
        .sortWithinPartitions("task", "side")
        .mapInArrow(_compare(percent), "a long, b long")
    )


def exact_edges(members: DataFrame, percent: int) -> DataFrame:
    """Links inside each cluster on full sets: id, cluster, m (members), shingles. Clusters that
    fit in a task come as stars, and so do large ones that are tied together at once."""
    none = F.lit(0)
    fits = members.where(F.col("m") <= TASK)
    small = _in_tasks(fits.withColumns({"task": F.col("cluster"), "side": none}), percent)
    large = members.where(F.col("m") > TASK)
    if not large.take(1):
        return small
    small = written(small, "links")
    # Blocks of a large cluster, each with the same few members of it.
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("id"), blocks).cast("int")
    large = large.withColumn("block", block)
    rank = F.xxhash64("id", F.lit("pivot"))
    picked = large.groupBy("cluster", "block").agg(F.min_by("id", rank).alias("pivot"))
    pivots = picked.groupBy("cluster").agg(
        F.slice(F.sort_array(F.collect_list("pivot")), 1, PIVOTS).alias("pivots")
    )
    chosen = pivots.select("cluster", F.explode("pivots").alias("id"))
    pivot_rows = large.join(chosen, ["cluster", "id"], "left_semi")
    task = lambda *parts_: F.xxhash64("cluster", *parts_)
    sent = pivot_rows.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    tied = written(
        _in_tasks(
            sent.select(task("block").alias("task"), F.lit(0).alias("side"), "id", "shingles").unionAll(
                large.select(task("block").alias("task"), F.lit(1).alias("side"), "id", "shingles")
            ),
            percent,
        ),
        "links",
    )
    # What is outside a cluster's main group, in blocks, against all blocks of the cluster.
    roots = components(tied)
    labelled = large.join(roots, "id", "left").withColumn(
        "component", F.coalesce("component", "id")
    )
    sizes = labelled.groupBy("cluster", "component").count()
    main = sizes.groupBy("cluster").agg(F.max_by("component", "count").alias("main"))
    outside = labelled.join(main, "cluster").where("component <> main")
    outside = written(outside.select("cluster", "id"), "outside")
    stars = roots.where("id <> component").select(F.col("id").alias("a"), F.col("component").alias("b"))
    if not outside.take(1):
        return small.unionAll(stars)
    counts = outside.groupBy("cluster").agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("rest_blocks")
    )
    rest = large.join(outside, ["cluster", "id"]).join(counts, "cluster").withColumn(
        "rest_block", F.pmod(F.xxhash64("id", F.lit(1)), F.col("rest_blocks")).cast("int")
    )
    rest = rest.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    whole = large.join(counts, "cluster").withColumn(
        "rest_block", F.explode(F.sequence(F.lit(0), F.col("rest_blocks") - 1))
    )
    key = task("rest_block", "block", F.lit(2)).alias("task")
    across = _in_tasks(
        rest.select(key, F.lit(0).alias("side"), "id", "shingles").unionAll(
            whole.select(key, F.lit(1).alias("side"), "id", "shingles")
        ),
        percent,
    )
    return small.unionAll(stars).unionAll(across)


def near_duplicates(
    df: DataFrame,
    width: int = 5,
    percent: int = 80,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept: documents linked at ``percent`` or more of
    their union, over chains."""
    ship_package(df.sparkSession)
    if percent < PERCENT:
        raise ValueError(f"the trees find pairs of {PERCENT} percent or more")
    docs = df.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    sketched = written(docs.mapInArrow(_sketches(width), SKETCH_SCHEMA), "sketches")
    linkable = sketched.where("n > 0 AND doc_id IS NOT NULL")
    classes = linkable.groupBy("f1", "f2", "n").agg(
        F.min("doc_id").alias("id"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch")
    )
    classes = written(classes, "classes")
    edges = candidate_edges(classes)
    for more in edges[1:]:
        edges[0] = edges[0].unionAll(more)
    clusters = components(edges[0])
    sizes = clusters.groupBy("component").agg(F.count("*").alias("m"))
    near = clusters.join(sizes, "component").select(
        "id", F.col("component").alias("cluster"), "m"
    )
    # A merge join at every size: the number of near documents grows with the table.
    texts = docs.withColumnRenamed("doc_id", "id").join(near.hint("merge"), "id")
    members = written(
        texts.select("id", "cluster", "m", "text").mapInArrow(
            _sets(width), "id long, cluster long, m long, shingles binary"
        ),
        "members",
    )
    roots = components(exact_edges(members, percent))
    named = classes.select(
        "f1", "f2", "n", "id"
    ).join(roots, "id", "left").select(
        "f1", "f2", "n", F.coalesce("component", "id").alias("component")
    )
    # A class of equal sets is one node by its smallest id, so copies follow it.
    found = sketched.select("doc_id", "n", "f1", "f2").join(named, ["f1", "f2", "n"], "left")
    component = F.coalesce("component", "doc_id")
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
