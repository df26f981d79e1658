"""Quality rules: a table of thresholds compiled into one projection.

Each rule bounds one measure. All measures and the verdict are built-in expressions over the
row, so the whole filter is one scan without a shuffle.

Defined cases: null and empty texts have no words, fail the base rule and every ratio of them
is 0; texts of any length are measured whole, and no rule has an upper bound on length; a value
equal to a bound passes; repeated rows are judged alike; an empty table gives no rows; other
columns are ignored by ``quality_rules`` and kept by ``passing``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tickfold.llm.common import SPACE, utf8, words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to a in is that it for was on with as be by this are at from or an not have"
    " der die und in den von zu das mit sich des auf für ist im dem nicht eine ein als"
    " de la le et les des en un du une que pour est dans qui par au sur pas avec"
    " el y los se las del por con no una su para al es lo"
).split()


@dataclass(frozen=True)
class Rule:
    """The text passes if ``measure * scale`` lies within the bounds, taken as
    ``low * base <= scale * measure <= high * base`` in whole numbers."""

    measure: str
    base: str
    scale: int = 100
    low: int | None = None
    high: int | None = None


#: Ratios are per hundred; a row passes if it passes them all.
RULES = (
    Rule("n_words", "one", 1, low=20),
    Rule("word_chars", "n_words", 10, low=25, high=120),  # mean word length 2.5 to 12
    Rule("n_symbols", "n_words", low=0, high=30),
    Rule("n_alpha_words", "n_words", low=70),
    Rule("n_stop_words", "n_words", low=2),
    Rule("n_bang_words", "n_words", high=50),
    Rule("n_dup_lines", "n_lines", high=50),
)


def repeat_words(w: Column) -> Column:
    """Words inside windows of 8 words that the text holds twice or more.

    Windows are compared by hash; the places of repeated ones are only worked out for the
    texts that have any."""
    n = F.size(w) - (WINDOW - 1)
    starts = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, WINDOW)))


def _covered(hashes: Column) -> Column:
    """Sorted by hash, a window is repeated if a neighbour is equal; then, sorted by place,
    each covers the words up to the next one, 8 at most."""
    size = F.size(hashes)
    s = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    before = F.concat(F.array(F.lit(None).cast(_PAIR)), F.slice(s, 1, size - 1))
    after = F.concat(F.slice(s, 2, size - 1), F.array(F.lit(None).cast(_PAIR)))
    near = F.arrays_zip(s.alias("s"), before.alias("b"), after.alias("a"))
    hit = F.filter(
        near,
        lambda x: F.coalesce(x["s"]["h"] == x["b"]["h"], F.lit(False))
        | F.coalesce(x["s"]["h"] == x["a"]["h"], F.lit(False)),
    )
    at = F.array_sort(F.transform(hit, lambda x: x["s"]["i"]))
    gaps = F.zip_with(
        F.slice(at, 2, F.size(at) - 1), F.slice(at, 1, F.size(at) - 1), lambda b, a: b - a
    )
    return F.aggregate(gaps, F.lit(WINDOW), lambda n, g: n + F.least(g, F.lit(WINDOW)))


_PAIR = "struct<h:bigint,i:int>"


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """The row with its measures; ``text`` is kept under its name."""
    t = utf8(F.col(text))
    has_word = f"[^{SPACE}]"
    steps = df.withColumns({"w": words(t)})
    steps = steps.withColumns(
        {
            "hashes": repeat_words(F.col("w")),
            "lines": F.filter(F.split(t, "\n", -1), lambda x: x.rlike(has_word)),
        }
    )
    stop = list(dict.fromkeys(STOP_WORDS))
    count = lambda c: F.size(c).cast("long")
    return steps.withColumns(
        {
            "one": F.lit(1).cast("long"),
            "n_words": count("w"),
            "word_chars": F.length(F.array_join("w", "")).cast("long"),
            "n_symbols": F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long"),
            "n_lines": count("lines"),
            "n_dup_lines": count("lines") - count(F.array_distinct("lines")),
            "n_repeat_words": F.when(
                F.size(F.array_distinct("hashes")) == F.size("hashes"), F.lit(0)
            )
            .otherwise(_covered(F.col("hashes")))
            .cast("long"),
            "n_alpha_words": F.regexp_count(
                t, F.lit(f"(?<![^{SPACE}])[^{SPACE}\\p{{L}}]*+\\p{{L}}")
            ).cast("long"),
            "n_stop_words": count(F.filter("w", lambda x: F.lower(x).isin(stop))),
            "n_bang_words": F.regexp_count(t, F.lit(f"!(?=[{SPACE}]|$)")).cast("long"),
        }
    ).drop("w", "hashes", "lines")


def passes(rules: tuple[Rule, ...] = RULES) -> Column:
    """The table of rules as one condition."""
    met = F.lit(True)
    for r in rules:
        value, base = F.col(r.measure) * r.scale, F.col(r.base)
        if r.low is not None:
            met = met & (value >= base * r.low)
        if r.high is not None:
            met = met & (value <= base * r.high)
    return met


def _judged(rows: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    base = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    )
    judged = measures(rows).withColumn("base_failed", base)
    return judged.withColumn("kept", ~F.col("base_failed") & passes(rules))


def quality_rules(
    df: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, the measures, base_failed and kept."""
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return _judged(rows, rules).drop("text", "one")


def passing(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows of ``df`` that are kept, with all their columns."""
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(text).alias("text"))
    # A filter on the verdict would move below the projection, with every measure written out
    # again wherever it is used; a generator stays above it.
    kept = F.explode(F.when(F.col("kept"), F.array("row")))
    return _judged(rows, rules).select(kept.alias("row")).select("row.*")
