"""Small tables and brute-force versions for the tests of the training-data operators."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Extra columns whose names the operators use inside.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size int, key string,"
    " row string, w string, task int, rank int, n long, id string, found string, kept string"
)


def texts(seed: int = 0) -> list[str | None]:
    """Prose with copies, near copies, shared passages, repeats, and odd texts."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefgé", k=rng.randint(1, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    out: list[str | None] = [None, "", " \t\n", "one", "Two Words", "two words", "x" * 5000]
    for _ in range(12):
        base = prose(rng.randint(5, 160))
        out += [base, base, base.upper()]
        for edits in (1, 3, 8):
            w = base.split(" ")
            for _ in range(edits):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            out.append(" ".join(w))
    passage = prose(60)
    out += [f"{prose(20)} {passage}\n{prose(20)}" for _ in range(5)]
    out += ["ab " * 300, prose(3000), "same line\n" * 30, f"{passage} {passage}", "é" * 120]
    return out


def rows(seed: int = 0) -> list[tuple]:
    """Rows of ``SCHEMA`` with distinct ids; nulls in every other column."""
    out = []
    for i, t in enumerate(texts(seed)):
        lang, source = [None, "en", "de"][i % 3], [None, "hot", "hot", "hot", "b"][i % 5]
        out.append((i * 3 + 1, t, lang, source, None, 1, "k", None, "w", 2, 3, 4, "i", "f", "y"))
    return out


def shingles(text: str | None, width: int) -> frozenset:
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < width:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def component_ids(docs: list[tuple[int, str | None]], width: int) -> dict[int, int]:
    sets = {i: shingles(t, width) for i, t in docs}
    up = {i: i for i in sets}

    def root(x: int) -> int:
        while up[x] != x:
            x = up[x]
        return x

    seen: dict = defaultdict(list)
    for i in sorted(sets):
        shared = Counter(j for s in sets[i] for j in seen[s])
        for j, k in shared.items():
            if 100 * k >= 80 * (len(sets[i]) + len(sets[j]) - k):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
        for s in sets[i]:
            seen[s].append(i)
    return {i: root(i) for i in sets}


def removed(docs: list[tuple[int, str | None]]) -> dict[int, list[bool]]:
    """Per byte whether an earlier equal string of 100 bytes covers it."""
    seen, out = set(), {}
    for i, t in sorted(docs):
        b = (t or "").encode()
        gone = [False] * len(b)
        for s in range(len(b) - 99):
            if b[s : s + 100] in seen:
                gone[s : s + 100] = [True] * 100
            seen.add(b[s : s + 100])
        out[i] = gone
    return out


def runs(flags: list[bool]) -> int:
    return sum(1 for a, b in zip([False, *flags], flags) if b and not a)


def repeat_words(text: str | None) -> int:
    w = WORD.findall(text or "")
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    many = {x for x, n in Counter(windows).items() if n > 1}
    return len({i + j for i, x in enumerate(windows) if x in many for j in range(8)})


SECRET_FORMS = (
    (
        "assign",
        re.compile(
            r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
            r"([A-Za-z0-9+/_.=-]+)"
        ),
        lambda m: len(m[2]) >= 12,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16),
)


def secret_base(text: str | None) -> list[tuple[int, int, int]]:
    """start, kind, end of the known forms."""
    return sorted(
        (m.start(), k, m.end())
        for k, (_, form, good) in enumerate(SECRET_FORMS)
        for m in form.finditer(text or "")
        if good(m)
    )
