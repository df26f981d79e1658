"""Connected components of an edge table, by alternating stars.

What a task reads first becomes stars: each node points at the smallest of what is connected
inside the batch. Each round then points the larger neighbours of every node at its smallest one
(large star), and every node and its smaller neighbours at the smallest (small star), until all is
stars; every node then points at the smallest of its component. Minima are aggregated before the
shuffle and joined back, so a hub with many edges is not gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickfold.llm.common import written
from tickfold.session import ship_package

MAX_ROUNDS = 60  # rounds grow with the logarithm of the longest chain


def stars_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node that is not the smallest of its component, and the smallest."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(ids))
    while (label[x] != label[y]).any():
        low = np.minimum(label[x], label[y])
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        while (label[label] != label).any():
            label = label[label]
    moved = label != np.arange(len(ids))
    return ids[moved], ids[label[moved]]


def _batch_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = stars_of(*(batch.column(c).to_numpy(zero_copy_only=False) for c in "ab"))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["a", "b"])


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _least(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) with m, the smallest of a and all b of a."""
    low = pairs.groupBy("a").agg(F.min("b").alias("m"))
    return pairs.join(low.select("a", F.least("a", "m").alias("m")), "a")


def _stars(edges: DataFrame) -> DataFrame:
    large = _least(_both(edges)).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    near = _least(large.where("a > b"))
    small = near.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
        near.select("a", F.col("m").alias("b"))
    )
    return small.where("a <> b").distinct()


def _all_stars(edges: DataFrame) -> bool:
    """Every node points at one other that points nowhere. Edges point from larger to smaller."""
    none = F.lit(None).cast("long")
    sides = edges.select(F.col("a").alias("id"), F.col("b").alias("to"), F.lit(0).alias("root"))
    sides = sides.unionAll(edges.select(F.col("b"), none, F.lit(1)))
    nodes = sides.groupBy("id").agg(
        F.min("to").alias("low"), F.max("to").alias("high"), F.max("root").alias("root")
    )
    return nodes.where("low <> high OR (low IS NOT NULL AND root = 1)").count() == 0


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node that has an edge to another; edges are (a, b) longs."""
    ship_package(edges.sparkSession)
    kept = edges.select("a", "b").where("a <> b")
    now = written(kept.mapInArrow(_batch_stars, "a long, b long").distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        if _all_stars(now):
            break
        now = written(_stars(now), "stars")
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(roots)
