import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from llm_fixtures import docs_of  # noqa: F401

from ledgermill.llm import periodic


def brute_runs(w):
    found = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def brute(doc, text, planted=True):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if planted and doc is not None and w:
        h = zlib.crc32(str(doc).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc, len(runs), *head, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def random_text(rng, size, letters):
    out = []
    while len(out) < size:
        kind = rng.random()
        if kind < 0.5:
            out += [rng.choice(letters) for _ in range(rng.randint(1, 30))]
        else:
            root = [rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 5, 8, 9, 15, 16, 17, 33, 70]))]
            n = rng.randint(1, 5 * len(root) + 10)
            out += (root * (n // len(root) + 1))[:n]
            if out and rng.random() < 0.5:
                out[rng.randrange(len(out))] = "odd"
    return out[:size]


@pytest.mark.parametrize("seed", range(6))
def test_runs_against_brute_force(seed, monkeypatch):
    monkeypatch.setattr(periodic, "BLOCK", 97)
    rng = random.Random(seed)
    docs = [random_text(rng, rng.choice([0, 1, 23, 24, 25, 60, 200, 700]), "ab" if seed % 2 else "abcdefghijklmnop") for _ in range(30)]
    offsets = np.r_[0, np.cumsum([len(d) for d in docs])]
    names = {}
    codes = np.array([names.setdefault(x, len(names)) for d in docs for x in d], np.int64)
    want = [(s + o, n, q) for d, o in zip(docs, offsets) for s, n, q in brute_runs(d)]
    assert periodic.find_runs(codes, offsets) == sorted(want)


def test_exact_limits():
    def runs(words):
        return periodic.find_runs(np.array(words), np.array([0, len(words)]))

    for q in range(1, 80):
        least = max(24, 3 * q)
        root = list(range(q))
        for n in (least - 1, least):
            stretch = (root * (n // q + 1))[:n]
            for before in (0, 1, 7, 20):
                words = list(range(1000, 1000 + before)) + stretch + [5000]
                assert runs(words) == ([(before, n, q)] if n == least else []), (q, n, before)


def test_one_word_many_times():
    words = np.zeros(200_000, np.int64)
    assert periodic.find_runs(words, np.array([0, 200_000])) == [(0, 200_000, 1)]


def some_rows():
    rng = random.Random(9)
    rows = [(i, rng.choice([" ", "\n", " \t "]).join(random_text(rng, rng.randint(0, 400), ["ab", "Été", "x", "日本", "word", "y"]))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " \n"), (203, "one"), (None, "a b " * 30), (None, None), (204, "z " * 5000), (204, "z " * 5000)]
    return rows


@pytest.mark.parametrize("planted", [True, False])
def test_against_brute_force(docs_of, planted):
    rows = some_rows()
    got = periodic.periodic_runs(docs_of(rows), planted=planted).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(brute(d, t, planted)) for d, t in rows)


def test_collapsed(docs_of):
    rows = [(1, "a b c " + "x y " * 20 + "end"), (2, None), (3, "  as  it is "), (3, "  as  it is "), (4, "w " * 30)]
    docs = docs_of(rows).selectExpr("*", "1 text_", "2 `start.x`", "3 period")
    got = periodic.collapsed(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in got.collect() if r.text) == [(1, "a b c x y end"), (3, "  as  it is "), (3, "  as  it is "), (4, "w")]


def test_empty(docs_of):
    assert periodic.periodic_runs(docs_of([])).count() == 0
    assert periodic.collapsed(docs_of([])).count() == 0
