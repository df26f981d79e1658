"""Periodic runs, exact copies and the filter audit against brute force."""

import hashlib
import random
import zlib
from itertools import permutations

import llm_cases as cases
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickfold.llm import heavy_copies
from tickfold.llm.filter_audit import answers, audit, failure_cells, gray_walk
from tickfold.llm.heavy_copies import Summary, exact_copies, frequent, without_copies
from tickfold.llm.periodic_runs import periodic_runs, planted, run_digest, runs_of


def brute_runs(w, least=6, exponent=4):
    """(start, length, period): every stretch of equal words some way apart, smallest way first."""
    found = {}
    for q in range(1, len(w) // exponent + 1):
        k = 0
        while k < len(w) - q:
            j = k
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j > k and j - k + q >= max(least, exponent * q):
                found.setdefault((k, j - k + q), q)
            k = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def periodic_words(rng, n):
    w = [rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        s, p = rng.randrange(max(n, 1)), rng.randint(1, 6)
        for i in range(s + p, min(n, s + rng.randint(1, 50))):
            w[i] = w[i - p]
    return w


@pytest.mark.parametrize("least,exponent", [(6, 4), (6, 3), (3, 2), (9, 5)])
def test_runs_of_many_small_documents(least, exponent):
    rng = random.Random(least)
    docs = [periodic_words(rng, rng.randint(0, 70)) for _ in range(600)]
    want, flat = [], []
    for w in docs:
        want += [(s + len(flat), n, q) for s, n, q in brute_runs(w, least, exponent)]
        flat += [*w, -1]
    assert len(want) > 100
    assert runs_of(np.array(flat, np.int64), least, exponent) == sorted(want)


def test_runs_of_long_documents():
    n = 30_000
    half = [i % 2 if i < n // 2 else i for i in range(n)]
    for w, run in (
        ([0] * n, (0, n, 1)),
        ([i % 7 for i in range(n)], (0, n, 7)),
        (half, (0, n // 2, 2)),
    ):
        assert runs_of(np.array([*w, -1], np.int64)) == [run]
    with pytest.raises(ValueError):
        runs_of(np.array([0, 0, -1]), 6, 1)


def expected_digest(doc_id, text):
    w = cases.WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else None
    if h is not None and h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        len(runs),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
        sha(" ".join(x for i, x in enumerate(w) if i not in gone)),
    )


def test_run_digest(spark):
    rng = random.Random(4)
    made = [" ".join(f"w{x}" for x in periodic_words(rng, rng.randint(1, 90))) for _ in range(150)]
    texts = [*cases.texts(), *made, "\x0b a  a\ta a a\na a a \x0c", "é é é é é é ü"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "b b b b b b c"), (3, None), (3, "one")]
    rows = [(i, t, "x", "y", 1) for i, t in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, collapsed string, n int")
    text = planted(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")))
    got = run_digest(periodic_runs(df, text=text)).collect()
    want = sorted(((i, *expected_digest(i, t)) for i, t, *_ in rows), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert sum(1 for r in want if r[1]) > 40 and len({r[1] for r in want}) > 3


def test_collapsed_text_of_the_general_form(spark):
    df = spark.createDataFrame([(1, "x  go on go on\ngo on y")], "doc_id long, body string")
    row = periodic_runs(df, min_words=4, exponent=3, text="body").first()
    assert [tuple(r) for r in row["runs"]] == [(1, 6, 2)]
    assert row["collapsed"] == "x go on y"


def normal(t):
    return cases.re.sub("[\x20\x09-\x0d]+", " ", t or "")


COPIES = [
    *[(i, "hot  text") for i in range(0, 600, 2)],
    *[(i, "hot\ttext") for i in range(1, 200, 2)],
    *[(i, f"text {i % 37}") for i in range(700, 900)],
    *[(1000 + i, t) for i, t in enumerate([None, "", " ", "\n\n", "é", "e", "x" * 50_000, "x" * 50_001])],
    (None, "hot text"),
    (None, "alone"),
    (None, "alone"),
    (5, "hot text"),
    (5, "other"),
    (5, "other"),
]


@pytest.mark.parametrize("share", [1 / 1000, 1 / 10, 1 / 2])
def test_exact_copies(spark, share):
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in COPIES], "doc_id long, text string, n int, digest string")
    members = {}
    for i, t in COPIES:
        members.setdefault(normal(t), []).append(i)
    want = []
    for i, t in COPIES:
        own = members[normal(t)]
        keep = min((x for x in own if x is not None), default=None)
        want.append((i, keep, len(own), i == keep, hashlib.sha256(normal(t).encode()).hexdigest()))
    got = exact_copies(df.repartition(5), share).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)
    left = without_copies(df, share)
    assert left.columns == df.columns
    rows = sorted(((r[0], r[1]) for r in left.collect()), key=repr)
    assert rows == sorted(((w[0], t) for w, (_, t) in zip(want, COPIES) if w[3]), key=repr)


def test_misra_gries_misses_no_heavy_digest(spark):
    rng = random.Random(0)
    for size in (1, 3, 10):
        seen, true = Summary(size), {}
        for _ in range(40):
            batch = [bytes([min(int(rng.expovariate(0.2)), 255)]) for _ in range(rng.randint(0, 50))]
            seen.add(pa.array(batch, pa.binary()))
            for x in batch:
                true[x] = true.get(x, 0) + 1
        assert len(seen.counts) <= size and seen.lost * (size + 1) <= seen.rows
        for x, n in true.items():
            assert n - seen.lost <= seen.counts.get(x, 0) <= n
    # Spread thinly over many tasks, among digests that are all different.
    rows = [(b"heavy" if i % 9 == 0 else str(i).encode(),) for i in range(4000)]
    df = spark.createDataFrame(rows, "digest binary").repartition(16)
    found = [bytes(r[0]) for r in frequent(df, 1 / 10).collect()]
    assert b"heavy" in found and len(found) <= 20
    assert heavy_copies.SHARE <= 1 / 1000


def brute_audit(docs, labels):
    """Every order by filtering documents one after the other."""
    smallest, good, toxic = {}, set(), set()
    for i, _, t in docs:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    for i, q, x in labels:
        good |= {i} if q == 1 else set()
        toxic |= {i} if x == 1 else set()
    parts = {}
    for i, lang, t in docs:
        t = t or ""
        w = cases.WORD.findall(t)
        first = smallest.get(t)
        fails = {
            "A": len(w) < 100,
            "B": 100 * len(set(w)) < 80 * len(w),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": first is not None and (i is None or i > first),
        }
        parts.setdefault(lang or "", []).append((fails, i is not None and i in good, i is not None and i in toxic))
    out = {}
    for part, rows in parts.items():
        total = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[0][f]]
                left = [r for r in left if not r[0][f]]
                total[f] += len(gone)
                alone = sum(r[0][f] and sum(r[0].values()) == 1 for r in rows)
                out[part, order, step] = [
                    len(left), len(gone), sum(r[0][f] for r in rows) - len(gone), alone,
                    sum(r[1] for r in gone), sum(r[2] for r in gone), f,
                ]
        for key, row in out.items():
            if key[0] == part:
                row[6] = total[row[6]]
    return out


def audit_cases():
    rng = random.Random(9)
    docs = []
    for i in range(260):
        n = rng.choice([0, 5, 99, 100, 130, 300])
        w = [rng.choice(["Aa", "BB", "c", "dd", "e"]) + str(rng.randrange(rng.choice([3, 900]))) for _ in range(n)]
        if rng.random() < 0.3:
            w = [x.lower() for x in w]
        docs.append([i, rng.choice(["en", "de", None, ""]), " ".join(w) + rng.choice(["", "", "#", "|"])])
    for i in range(260, 330):
        docs.append([i, rng.choice(["en", "fr"]), docs[rng.randrange(40)][2]])
    docs += [[330, "en", None], [None, "en", docs[0][2]], [None, "en", "alone"], [None, "xx", "alone"]]
    docs += [docs[2][:], docs[2][:], docs[300][:]]
    labels = [(i, rng.randrange(2), rng.randrange(2)) for i in range(0, 340, 2)]
    return docs, [*labels, (4, 1, 1), (4, None, None), (None, 1, 1)]


def test_audit(spark):
    docs, labels = audit_cases()
    rows = [(i, t, lang, 0, "m", "w") for i, lang, t in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n int, mask string, w string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audit(failure_cells(df, marks)).collect()
    want = brute_audit(docs, labels)
    assert len(got) == len(want)
    for r in got:
        assert list(r)[3:] == want[r["part"], r["filter_order"], r["step"]]


def test_gray_walk_equals_every_subset():
    rng = np.random.default_rng(2)
    cells = rng.integers(0, 9, (3, 32, 3))
    states = gray_walk(cells)
    masks = np.arange(32)
    for active in range(32):
        assert (states[:, active] == cells[:, (masks & active) == 0].sum(axis=1)).all()
    found = answers(states)
    assert found["kept"].shape == (3, 600)
    # What filters remove adds up to what is not kept in the end, in every order.
    lost = found["removed"].reshape(3, 120, 5).sum(axis=2)
    assert (lost == (states[:, 0, 0] - states[:, 31, 0])[:, None]).all()
