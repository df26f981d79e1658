"""Secret scans: known forms, and strings that pass a battery of randomness tests.

Known forms are assignments of long values to secret-like names, access keys and long hex runs.
They are blanked out, and the battery looks at every unbroken run of 20 or more base64 characters
in what is left, so a secret that touches a known form is tested too. The encoding of a run is
inferred from its characters (hex, base32, base36 or base64). Under the hypothesis that the run
was drawn evenly from that alphabet, chi-squared of the counts of characters (of classes of
characters for base36 and base64) gives one p-value, and its order another: the runs test above
and below the middle of the alphabet and lag-one serial correlation, which depend on each other
and are joined by Bonferroni's rule. Fisher's method makes one of the two. The tests of this
package hold it against simulated runs: at 0.05 and 0.01 no more of them are below than stated.

A run is dismissed as ordinary text if its p-value is rejected by Benjamini-Hochberg among the
runs of its length class over the whole table: dismissals are the discoveries, so the share of
true secrets among the dismissed is held at ``alpha`` for short and long runs alike. What is not
dismissed is a span of kind ``random``.

The step-up rule needs the number of p-values below a cut; they are counted in bins of
log10(p), at most 400 for each of four classes, and a cut is a bin's edge.

All of it is a projection of the row. Places come from running sums in blocks and texts are cut
in chunks, so the work for a text grows with its length plus that of its matches.

Defined cases: null and empty texts have no spans; texts of any length are scanned whole;
of spans with one start the known form comes first; repeated rows are judged alike (each counts
in the control); an empty table gives no rows; other columns are carried or ignored, whatever
their names. Places are in code points, ends exclusive.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tickfold.llm.common import bound, running, settled, utf8, written

#: The known forms. Lengths are checked on the whole match.
ASSIGN = (
    "((?i)password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]{14,}+"  # a run's first AKIA has its longest tail
HEX = "(?<![0-9a-f])[0-9a-f]{16,}+"
RUN = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
MIN_ASSIGNED = 12
KINDS = ("assign", "access", "hex", "random")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_DIGITS = "0123456789"
#: Encoding: what a run of it looks like, its alphabet, and the classes that are counted.
ENCODINGS = {
    "hex": ("^[0-9a-fA-F]+$", _DIGITS + "abcdef", list(_DIGITS + "abcdef")),
    "base32": ("^[A-Z2-7]+=*$", _UPPER + "234567", list(_UPPER + "234567")),
    "base36": ("^(?=.*[0-9].*[0-9])[a-z0-9]+$", _LOWER + _DIGITS, [_LOWER, _DIGITS]),
    "base64": ("", _UPPER + _LOWER + _DIGITS + "+/", [_UPPER, _LOWER, _DIGITS + "+/"]),
}
#: A run's length class: the largest of these that it reaches.
CLASSES = (20, 32, 48, 96)
BINS, BINS_PER_DECADE = 400, 20
ALPHA = 0.01
FEW = 100

_SPAN = "array<struct<start:int,end:int,kind:int>>"
_CANDIDATE = "array<struct<start:int,end:int,p:double,class:int>>"
_MATCH = "array<struct<start:int,end:int,value:string>>"


def _plus(a: Column, b: Column) -> Column:
    return a + b


def _matches(t: Column, pattern: str, group: int = 0) -> Column:
    """start, end and the group's text of every match, left to right."""
    found = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(t, F.lit(pattern), F.lit(group)) if group else found

    def placed(x: Column) -> Column:
        # Lengths of piece and following match; the last piece has no match.
        gap = F.transform(F.slice(x["between"], 1, F.size(x["found"])), lambda v: F.length(v))
        size = F.transform(x["found"], lambda v: F.length(v))
        end = running(F.zip_with(gap, size, _plus), _plus)
        start = F.zip_with(end, size, lambda e, n: e - n)
        row = lambda m: F.struct(m["s"].alias("start"), m["e"].alias("end"), m["v"].alias("value"))
        return F.transform(F.arrays_zip(start.alias("s"), end.alias("e"), x["value"].alias("v")), row)

    parts = F.struct(
        found.alias("found"), F.split(t, pattern, -1).alias("between"), value.alias("value")
    )
    return F.when(t.rlike(pattern), bound(parts, placed).cast(_MATCH)).otherwise(
        F.array().cast(_MATCH)
    )


CHUNK = 1024  # code points; a cut inside a text looks at the chunks it touches


def _chunks(t: Column) -> Column:
    return F.regexp_extract_all(t, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def _cut(chunks: Column, low: Column, high: Column) -> Column:
    """The code points from ``low`` up to ``high``."""
    first, last = F.floor(low / CHUNK).cast("int"), F.floor((high - 1) / CHUNK).cast("int")

    def piece(c: Column) -> Column:
        begin = F.greatest(low - c * CHUNK, F.lit(0))
        size = F.least(high - c * CHUNK, F.lit(CHUNK)) - begin
        return F.substring(F.get(chunks, c), begin + 1, size)

    pieces = F.array_join(F.transform(F.sequence(first, last), piece), "")
    return F.when(high > low, pieces).otherwise("")


def _replaced(t: Column, spans: Column, put: Callable[[Column, Column], Column]) -> Column:
    """The text with ``put(end of the spans before, span)`` for each of the sorted spans; what
    spans have in common belongs to the first of them."""

    def built(x: Column) -> Column:
        before = lambda i: F.coalesce(F.get(x["ends"], i - 1), F.lit(0))
        piece = lambda s, i: bound(
            before(i), lambda b: F.concat(_cut(x["chunks"], b, s["start"]), put(b, s))
        )
        tail = _cut(x["chunks"], F.element_at(x["ends"], -1), x["n"])
        return F.concat(F.array_join(F.transform(x["spans"], piece), ""), tail)

    ends = running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
    all_of = F.struct(
        _chunks(t).alias("chunks"),
        ends.alias("ends"),
        spans.alias("spans"),
        F.length(t).alias("n"),
    )
    return F.when(F.size(spans) == 0, t).otherwise(bound(all_of, built))


def _blanked(t: Column, spans: Column) -> Column:
    """Spaces in place of the spans, so that places stay what they are."""
    width = lambda before, s: F.greatest(s["end"] - F.greatest(s["start"], before), F.lit(0))
    return _replaced(t, spans, lambda before, s: F.repeat(F.lit(" "), width(before, s)))


def masked(text: Column, spans: Column, mask: str = "[secret]") -> Column:
    """The text with every span replaced; overlapping spans get one mask. Null stays null."""
    put = lambda before, s: F.when(s["start"] < before, "").otherwise(mask)
    return F.when(text.isNotNull(), _replaced(text, spans, put))


def _known(kind: int, matches: Column) -> Column:
    row = lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), F.lit(kind).alias("kind")
    )
    return F.transform(matches, row).cast(_SPAN)


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of a normal Z, by a logistic curve; within 0.0002 and monotone."""
    z = F.least(F.greatest(z, F.lit(-8.0)), F.lit(8.0))
    return bound(z, lambda x: F.lit(1.0) / (F.lit(1.0) + F.exp(x * 1.5976 + x * x * x * 0.070565992)))


def _two_sided(z: Column) -> Column:
    return F.least(_upper_tail(z) * 2.0, F.lit(1.0))


def _chi_squared_tail(x: Column, k: Column) -> Column:
    """Wilson and Hilferty's cube root of a chi-squared value is about normal."""
    v = F.lit(2.0) / (k * 9.0)
    return _upper_tail((F.pow(x / k, F.lit(1.0 / 3)) - (F.lit(1.0) - v)) / F.sqrt(v))


_NAMES = list(ENCODINGS)


def _encoding(run: Column) -> Column:
    """The index in ENCODINGS of the first form that fits."""
    code = F.lit(len(_NAMES) - 1)
    for i, name in reversed(list(enumerate(_NAMES[:-1]))):
        code = F.when(run.rlike(ENCODINGS[name][0]), i).otherwise(code)
    return code


def _of(table: list, code: Column) -> Column:
    return F.get(F.array(*[F.lit(x) for x in table]), code)


def _uniformity(x: Column) -> Column:
    """Chi-squared test of the counts of characters or of classes of characters."""

    def tail(c: Column) -> Column:
        each = F.transform(
            F.sequence(F.lit(0), F.size(c["sizes"]) - 1),
            lambda j: bound(
                F.struct(
                    F.size(F.filter(c["cells"], lambda v: v == j)).cast("double").alias("seen"),
                    (x["n"] * F.get(c["sizes"], j) / x["width"]).alias("want"),
                ),
                lambda y: y["seen"] * y["seen"] / y["want"],
            ),
        )
        chi = F.aggregate(each, F.lit(0.0), _plus) - x["n"]
        return _chi_squared_tail(F.greatest(chi, F.lit(0.0)), F.size(c["sizes"]).cast("double") - 1.0)

    sizes = F.get(
        F.array(*[F.array(*[F.lit(len(c)) for c in ENCODINGS[e][2]]) for e in _NAMES]), x["code"]
    )
    cell_of = [
        [j for j, cell in enumerate(ENCODINGS[e][2]) for _ in cell] for e in _NAMES
    ]
    table = F.get(F.array(*[F.array(*[F.lit(j) for j in row]) for row in cell_of]), x["code"])
    cells = bound(
        table, lambda t: F.transform(x["index"], lambda i: F.get(t, i.cast("int") - 1))
    )
    return bound(F.struct(sizes.alias("sizes"), cells.alias("cells")), tail)


def _order(x: Column) -> Column:
    """Runs above and below the middle of the alphabet, whose number of turns is binomial, and
    lag-one serial correlation about the mean of the alphabet. The two depend on each other, so
    the smaller p-value counts twice (Bonferroni)."""

    def smaller(y: Column) -> Column:
        steps, w = x["n"] - 1.0, x["width"]
        high = lambda v: v > w / 2.0
        turns = F.aggregate(
            F.zip_with(y["a"], y["b"], lambda a, b: (high(a) != high(b)).cast("double")),
            F.lit(0.0),
            _plus,
        )
        apart = F.greatest(F.abs(turns - steps / 2.0) - 0.5, F.lit(0.0))
        middle = (w + 1.0) / 2.0
        lagged = F.aggregate(
            F.zip_with(y["a"], y["b"], lambda a, b: (a - middle) * (b - middle)), F.lit(0.0), _plus
        )
        spread = (w * w - 1.0) / 12.0
        runs = _two_sided(apart * 2.0 / F.sqrt(steps))
        serial = _two_sided(F.abs(lagged) / spread / F.sqrt(steps))
        return F.least(F.least(runs, serial) * 2.0, F.lit(1.0))

    m = F.size(x["index"])
    pairs = F.struct(
        F.slice(x["index"], 1, m - 1).alias("a"), F.slice(x["index"], 2, m - 1).alias("b")
    )
    return bound(pairs, smaller)


def battery(run: Column) -> Column:
    """The p-value of a run of base64 characters under the hypothesis that it is random; 0 if
    fewer than 20 are left without padding."""
    plain = lambda code: F.replace(
        F.when(code == _NAMES.index("hex"), F.lower(run))
        .when(code == _NAMES.index("base64"), F.translate(run, "-_", "+/"))
        .otherwise(run),
        F.lit("="),
        F.lit(""),
    )

    def tested(x: Column) -> Column:
        fisher = lambda h: F.exp(-h) * (h + 1.0)
        p = bound(-F.log(_uniformity(x)) - F.log(_order(x)), fisher)
        return F.when(x["n"] < CLASSES[0], F.lit(0.0)).otherwise(p)

    def indexed(code: Column) -> Column:
        alphabet = _of([ENCODINGS[e][1] for e in _NAMES], code)
        chars = F.regexp_extract_all(plain(code), F.lit("."), F.lit(0))
        index = bound(
            alphabet, lambda a: F.transform(chars, lambda c: F.position(c, a).cast("double"))
        )
        facts = bound(
            index,
            lambda i: F.struct(
                i.alias("index"),
                F.size(i).cast("double").alias("n"),
                _of([float(len(ENCODINGS[e][1])) for e in _NAMES], code).alias("width"),
                code.alias("code"),
            ),
        )
        return bound(facts, tested)

    return bound(_encoding(run), indexed)


def _length_class(n: Column) -> Column:
    return reduce(lambda c, at: F.when(n >= at[1], at[0]).otherwise(c), enumerate(CLASSES), F.lit(0))


def _bin(p: Column) -> Column:
    """0 holds the largest p-values."""
    down = F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * BINS_PER_DECADE)
    return F.least(F.greatest(down, F.lit(0)), F.lit(BINS - 1)).cast("int")


def _cuts(scanned: DataFrame, alpha: float) -> list[int]:
    """For each length class the first bin whose p-values are all rejected. A class counts as
    ``FEW`` runs at least: a lone run is not dismissed for a p-value that one in a hundred has."""
    runs = scanned.select(F.explode("candidates").alias("c"))
    counts = runs.groupBy(F.col("c.class").alias("k"), _bin(F.col("c.p")).alias("bin")).count()
    seen = {(r["k"], r["bin"]): r["count"] for r in counts.collect()}
    cuts = []
    for k in range(len(CLASSES)):
        total, below, cut = max(FEW, sum(n for (c, _), n in seen.items() if c == k)), 0, BINS
        for b in range(BINS - 1, -1, -1):
            below += seen.get((k, b), 0)
            edge = 10.0 ** (-b / BINS_PER_DECADE)  # no p-value of the bin or below is larger
            if below and total * edge <= alpha * below:
                cut = b
        cuts.append(cut)
    return cuts


def _base(t: Column) -> Column:
    """Spans of known forms, by start."""
    assigned = F.filter(_matches(t, ASSIGN, 2), lambda m: F.length(m["value"]) >= MIN_ASSIGNED)
    forms = [assigned, _matches(t, ACCESS), _matches(t, HEX)]
    return _by_start(F.concat(*[_known(k, m) for k, m in enumerate(forms)]))


def _tested(runs: Column) -> Column:
    row = lambda r: F.struct(
        r["start"].alias("start"),
        r["end"].alias("end"),
        battery(r["value"]).alias("p"),
        _length_class(F.length(r["value"])).alias("class"),
    )
    return F.transform(runs, row).cast(_CANDIDATE)


def _by_start(spans: Column) -> Column:
    key = lambda s: F.struct(s["start"].alias("a"), s["kind"].alias("k"), s["end"].alias("e"))
    row = lambda s: F.struct(s["a"].alias("start"), s["e"].alias("end"), s["k"].alias("kind"))
    return F.transform(F.array_sort(F.transform(spans, key)), row).cast(_SPAN)


def _scanned(df: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """row, base and candidates."""
    rows = df.select(
        F.struct(*[F.col(f"`{c}`").alias(c) for c in columns]).alias("row"),
        utf8(F.col(f"`{text}`")).alias("text"),
    )
    known = settled(rows, base=_base(F.col("text")))
    cut = settled(known, rest=_blanked(F.col("text"), F.col("base"))).drop("text")
    runs = settled(cut, runs=_matches(F.col("rest"), RUN)).drop("rest")
    return runs.select("row", "base", _tested(F.col("runs")).alias("candidates"))


def with_spans(
    df: DataFrame, alpha: float = ALPHA, text: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """``row``, the carried columns of ``df`` (all of them), and ``found``: spans (start, end,
    kind as index in ``KINDS``) by start."""
    columns = df.columns if carry is None else carry
    scanned = written(_scanned(df, text, columns), "secrets")
    cut = F.array(*[F.lit(c) for c in _cuts(scanned, alpha)])
    left = F.filter("candidates", lambda c: _bin(c["p"]) < F.element_at(cut, c["class"] + 1))
    random = F.transform(
        left,
        lambda c: F.struct(
            c["start"].alias("start"), c["end"].alias("end"), F.lit(3).alias("kind")
        ),
    ).cast(_SPAN)
    found = F.when(F.size(random) == 0, F.col("base")).otherwise(_by_start(F.concat("base", random)))
    return settled(scanned, found=found).select("row", "found")


def secret_spans(
    df: DataFrame, alpha: float = ALPHA, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id and ``found``, see ``with_spans``. The scan is written without the texts."""
    slim = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return with_spans(slim, alpha, carry=["doc_id"]).select("row.doc_id", "found")


def span_digest(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"]),
        ),
        ",",
    )
