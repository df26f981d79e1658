"""Token counts as delta-maintained rollups.

Events insert, delete or revise a document's count. Each becomes signed numbers: an insert adds
one document and its tokens, a delete takes them away, a revision takes the old count from its
old group and adds the new one to its new group. A batch is summed by group before anything is
shuffled and staged as one folder; a commit then adds the folder and the number of the batch to
the table in one step. Totals are the sum of all committed batches. Committing a batch again
changes nothing, also after a job that died halfway: what it staged is in no commit. When there
are many folders, one with their sums takes their place in one commit, which keeps the numbers of
the batches, so a batch never counts twice and none is left out.

Defined cases: null source, language or version is a value of its own; a null count is 0; an
event given twice counts twice, the batch is the unit of repetition; an empty batch is committed
and adds nothing; groups whose documents are all gone have no row; texts are not looked at, only
their counts; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickfold.sources import CommitLog, Conflict, Snapshot

GROUP = ("source", "lang", "version")
SCHEMA = "source string, lang string, version string, n_docs long, n_tokens long"


def event(kind: str | Column, new: dict[str, Column], old: dict[str, Column]) -> list[Column]:
    """The columns of an event: ``new`` and ``old`` give group and tokens, or nothing."""

    def side(name: str, values: dict[str, Column]) -> Column:
        full = {c: values.get(c, F.lit(None)).cast("string") for c in GROUP}
        tokens = values.get("tokens", F.lit(0)).cast("long")
        return F.struct(*[v.alias(c) for c, v in full.items()], tokens.alias("tokens")).alias(name)

    kind = F.lit(kind) if isinstance(kind, str) else kind
    return [kind.alias("kind"), side("new", new), side("old", old)]


def signed(events: DataFrame) -> DataFrame:
    """One row per group with the net documents and tokens of a batch of events."""
    plus = F.struct(F.col("new").alias("at"), F.lit(1).alias("sign"))
    minus = F.struct(F.col("old").alias("at"), F.lit(-1).alias("sign"))
    sides = (
        F.when(F.col("kind") == "insert", F.array(plus))
        .when(F.col("kind") == "delete", F.array(minus))
        .when(F.col("kind") == "revise", F.array(minus, plus))
    )
    rows = events.select(F.explode(sides).alias("x")).select("x.at.*", "x.sign")
    tokens = F.coalesce(F.col("tokens"), F.lit(0)) * F.col("sign")
    return rows.groupBy(*GROUP).agg(
        F.sum("sign").alias("n_docs"), F.sum(tokens).alias("n_tokens")
    )


def _holds(ranges: list[list[int]], batch: int) -> bool:
    return any(low <= batch <= high for low, high in ranges)


def _with(ranges: list[list[int]], batch: int) -> list[list[int]]:
    """Ranges of numbers with one more; numbers given in order stay one range."""
    out: list[list[int]] = []
    for low, high in sorted([*ranges, [batch, batch]]):
        if out and low <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


class Rollup:
    """Totals kept in ``path``, a folder of the shared store."""

    def __init__(self, spark: SparkSession, path: str, merge_above: int = 16):
        schema = spark.createDataFrame([], SCHEMA).schema
        self.spark, self.merge_above = spark, merge_above
        self.log = CommitLog(path.rstrip("/"), {"sums": schema}, merge_above=2**31)

    def committed(self, batch: int) -> bool:
        return _holds(self.log.latest(self.spark).state.get("batches", []), batch)

    def commit(self, batch: int, events: DataFrame) -> bool:
        """False if the batch was there already."""
        if self.committed(batch):
            return False
        folder = self.log.stage(signed(events))
        while True:
            base = self.log.latest(self.spark)
            done = base.state.get("batches", [])
            if _holds(done, batch):  # by another writer meanwhile
                return False
            try:
                now = self.log.publish(
                    self.spark, base, {"sums": folder}, {"batches": _with(done, batch)}
                )
            except Conflict:
                continue
            if len(now.folders["sums"]) > self.merge_above:
                self.compact()
            return True

    def _sums(self, at: Snapshot) -> DataFrame:
        sums = (
            self.log.read(self.spark, "sums", at)
            .groupBy(*GROUP)
            .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        )
        return sums.where((F.col("n_docs") != 0) | (F.col("n_tokens") != 0))

    def totals(self) -> DataFrame:
        """source, lang, version, n_docs, n_tokens after all committed batches."""
        return self._sums(self.log.latest(self.spark))

    def compact(self) -> bool:
        """Put the sums of all folders in their place. False if another commit came first."""
        base = self.log.latest(self.spark)
        folder = self.log.stage(self._sums(base))
        try:
            self.log.publish(self.spark, base, {"sums": folder}, {}, replaced=("sums",))
        except Conflict:
            return False
        return True
