"""Mixing sources to target weights by iterative proportional fitting.

Token sums per (source, language, topic) cell are raked: each pass scales the cells of every
source, then of every language, then of every topic, so that the sums meet the targets, until
all three fit. Targets may contradict each other, as when one source alone has a language; the
passes then end when the largest gap stops falling. What is left of it is the column ``gap``.

The sample is to hold a share of all tokens, dealt to cells by weight. A cell that is due more
tokens than it has is taken whole, and what it lacks is dealt to the others, so a small cell never
shrinks the sample. ``rate`` is the number of times that a document is due, and its chance is the
rate, 1 at most. Without a share the sample is the largest whose expected tokens have the target
shares exactly, with no rate above 1; one rare cell can make that small. A chance is drawn from a hash of the id, so a repeated run, or a lost executor, picks the same documents.

Only the table of cells is iterated; it is written after each few passes.

Defined cases: null source, language or topic is a value of its own; documents without tokens
(null, zero or negative counts) weigh nothing and keep the chance of their cell, a cell without
tokens has chance 0; documents of any length are drawn whole; repeated rows are drawn alike; an
empty table gives no rows; other columns are ignored, but for the one to carry.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tickfold.llm.common import written

DIMENSIONS = ("source", "lang", "topic")
PASSES_PER_JOB = 4
TOLERANCE = 1e-6
#: The passes go on while a job brings the largest gap below this share of what it was.
STILL_FALLING = 0.98
DRAW_DIGITS = 13  # hex digits of the md5 of the id that make the draw


def draw(doc_id: Column, seed: str = "") -> Column:
    """A fixed number in [0, 1) for each id."""
    text = F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null")))
    head = F.conv(F.substring(F.md5(text), 1, DRAW_DIGITS), 16, 10).cast("double")
    return head / F.lit(float(16**DRAW_DIGITS))


def with_targets(cells: DataFrame, powers: dict[str, float]) -> DataFrame:
    """Cells with ``target_<dimension>``: tempered shares that sum to 1 over the values."""
    out = cells
    for d, power in powers.items():
        totals = cells.groupBy(d).agg(F.pow(F.sum("tokens").cast("double"), power).alias("own"))
        shares = totals.join(totals.agg(F.sum("own").alias("all_own")))
        shares = shares.select(
            F.col(d).alias("_value"), (F.col("own") / F.col("all_own")).alias(f"target_{d}")
        )
        out = out.join(shares, F.col(d).eqNullSafe(F.col("_value"))).drop("_value")
    return out


def rake(cells: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Cells with ``weight`` and ``gap``, the largest distance of a value's weight from its
    target; they need ``tokens`` and the targets of every dimension."""

    def fitted(d: str, c: DataFrame) -> DataFrame:
        mass = F.sum("weight").over(Window.partitionBy(d))
        return c.withColumn("weight", F.col("weight") * F.col(f"target_{d}") / mass)

    out, before = cells.withColumn("weight", F.col("tokens").cast("double")), float("inf")
    while True:
        for _ in range(PASSES_PER_JOB):
            out = reduce(lambda c, d: fitted(d, c), DIMENSIONS, out)
        out = written(out, "raked")
        gaps = [
            out.groupBy(d)
            .agg(F.abs(F.sum("weight") - F.first(f"target_{d}")).alias("gap"))
            .agg(F.max("gap").alias("gap"))
            for d in DIMENSIONS
        ]
        worst = reduce(DataFrame.unionAll, gaps).agg(F.max("gap")).first()[0]
        if worst is None or worst <= tolerance or worst > before * STILL_FALLING:
            return out.withColumn("gap", F.lit(worst).cast("double"))
        before = worst


def tokens_per_weight(cells: DataFrame, share: float | None) -> float:
    """The factor that makes weights tokens, such that cells due more than they have and the
    others together have the wanted share. Newton's method on a rising, concave sum: every
    round takes more cells whole, until none is added. Without a share: the largest factor that
    gives no cell more than it has."""
    if share is None:
        return cells.agg(F.min(F.col("tokens") / F.col("weight"))).first()[0] or 0.0
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    factor, whole = 0.0, -1
    while True:
        full = F.lit(factor) * F.col("weight") >= F.col("tokens")
        now = cells.agg(
            F.count_if(full).alias("n"),
            F.sum(F.when(full, F.col("tokens"))).alias("tokens"),
            F.sum(F.when(~full, F.col("weight"))).alias("weight"),
        ).first()
        if now["n"] == whole or not now["weight"]:
            return factor
        whole = now["n"]
        factor = max(factor, (share * total - (now["tokens"] or 0)) / now["weight"])


#: Cells up to this number (a few MB) are broadcast to the documents, more are joined by shuffle.
BROADCAST_CELLS = 20_000


def mix(
    df: DataFrame,
    powers: dict[str, float],
    doc_id: str = "doc_id",
    tokens: str = "n_tokens",
    seed: str = "",
    carry: str | None = None,
    share: float | None = None,
) -> DataFrame:
    """doc_id, the three dimensions, n_tokens, probability, sampled, rate and gap, and the
    column named by ``carry``."""
    docs = df.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        *[F.col(d).cast("string").alias(d) for d in DIMENSIONS],
        F.greatest(F.coalesce(F.col(tokens).cast("long"), F.lit(0)), F.lit(0)).alias("n_tokens"),
        *([F.col(carry)] if carry else []),
    )
    cells = docs.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens"))
    cells = written(cells.where("tokens > 0"), "cells")
    raked = rake(with_targets(cells, powers))
    factor = tokens_per_weight(raked, share)
    rates = raked.select(
        *[F.col(d).alias(f"_{d}") for d in DIMENSIONS],
        (F.lit(factor) * F.col("weight") / F.col("tokens")).alias("rate"),
        "gap",
    )
    if cells.count() <= BROADCAST_CELLS:
        rates = F.broadcast(rates)
    same = reduce(
        lambda a, b: a & b, [F.col(d).eqNullSafe(F.col(f"_{d}")) for d in DIMENSIONS]
    )
    return (
        docs.join(rates, same, "left")
        .withColumn("rate", F.coalesce(F.col("rate"), F.lit(0.0)))
        .withColumn("probability", F.least(F.col("rate"), F.lit(1.0)))
        .withColumn("sampled", draw(F.col("doc_id"), seed) < F.col("probability"))
        .select(
            "doc_id",
            *DIMENSIONS,
            "n_tokens",
            "probability",
            "sampled",
            "rate",
            "gap",
            *([carry] if carry else []),
        )
    )


#: Endings that tell the form of a text, as its topic.
TABLE_MARK, SYMBOL_MARK = " | ", "[#*$%&<>]{3}"


def form_topic(text: Column) -> Column:
    """A topic by form: table, marked, list (many short lines), long or short prose."""
    t = F.coalesce(text, F.lit(""))
    lines = F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit(""))) + 1
    return (
        F.when(t.contains(TABLE_MARK), "table")
        .when(t.rlike(SYMBOL_MARK), "marked")
        .when(F.length(t) < lines * 60, "list")
        .when(F.length(t) >= 2000, "long")
        .otherwise("short")
    )
