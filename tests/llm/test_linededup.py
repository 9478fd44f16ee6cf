import random

from llm_fixtures import docs_of  # noqa: F401
from pyspark.sql import functions as F

from ledgermill.llm import linededup


def brute(rows):
    """Distinct (id, text) in the operator's order; rows hold (id, hash, text)."""
    first, gone = {}, {}
    for key in sorted({((d is not None, d or 0), h, t) for d, h, t in rows if t is not None}):
        lines = key[2].split("\n")
        for i in range(len(lines) - 2):
            if first.setdefault(tuple(lines[i : i + 3]), (key, i)) != (key, i):
                gone.setdefault(key, set()).update({i, i + 1, i + 2})
    out = []
    for d, h, t in rows:
        lines, cut = (t or "").split("\n"), gone.get(((d is not None, d or 0), h, t), set())
        left = None if t is None else "\n".join(x for i, x in enumerate(lines) if i not in cut)
        out.append((d, 0 if t is None else len(lines), len(cut), left))
    return sorted(out, key=repr)


def test_against_brute_force(docs_of):
    rng = random.Random(3)
    rows = [(i, "\n".join(rng.choice("abcde") * rng.randint(1, 2) for _ in range(rng.randint(0, 9)))) for i in range(40)]
    rows += [(50, None), (51, ""), (52, "\n\n\n\n"), (53, "x\ny"), (54, "same\n" * 4000), (54, "same\n" * 4000), (None, "a\nb\nc\nd"), (55, "a\nb\nc\nd"), (55, "z\na\nb\nc")]
    docs = docs_of(rows).selectExpr("*", "1 as line", "2 as gone", "3 as h1", "4 as k_id")
    hashed = [tuple(r) for r in docs.select("doc_id", F.xxhash64("text"), "text").collect()]
    got = sorted((tuple(r) for r in linededup.dedup_lines(docs).collect()), key=repr)
    assert got == brute(hashed)
    kept = linededup.without_repeated_lines(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(((r[0], r[3]) for r in got), key=repr)


def test_empty(docs_of):
    assert linededup.dedup_lines(docs_of([])).count() == 0
