import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from llm_fixtures import docs_of  # noqa: F401

from ledgermill.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(rows, every=31, letters=7, count=2):
    found = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= letters:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= count}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i:] == b[i + 1 :] or (len(a) == len(b) and a[i + 1 :] == b[i + 1 :])


def brute(rows, every=31):
    words = brute_words(rows, every)
    form, out = {}, []
    for w, n in words.items():
        beside = [v for v in words if near(w, v)]
        best = min(beside, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * n else None
        out.append((w, n, len(beside)))

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w] or "", root(w), n, k, words[form[w]] if form[w] else -1) for w, n, k in out)


def result(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in df.collect())


def some_rows():
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(6, 12))) for _ in range(40)]
    rows = []
    for i in range(300):
        words = []
        for _ in range(40):
            w = rng.choice(base[: 1 + rng.randrange(len(base))])
            if rng.random() < 0.3:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("abcdz") + w[k:], w[:k] + rng.choice("abxÿ") + w[k + 1 :]])
            words.append(rng.choice([w, w.upper(), w.capitalize()]))
        rows.append((i, rng.choice([" ", "-", "1", "¿", "\n"]).join(words)))
    rows += [(400, None), (401, ""), (402, "  12 ß"), (None, "wordsss wordsss"), (403, "x" * 3000 + " " + "x" * 2999), (403, "x" * 3000 + " " + "x" * 2999)]
    rows += [(404, "letters×÷ÀÿÀÿ ¿letters×÷ÀÿÀÿ"), (405, "Āletters Āletters lettersĀ łetters"), (406, "日本語 letters 日本")]
    # chains of forms
    rows += [(500 + i, " ".join(["chainword"] * 25 + ["chainwordx"] * (2 if i % 10 == 0 else 0))) for i in range(20)] + [(600, "chainwordxy chainwordxy")]
    return rows


def test_against_brute_force(docs_of):
    rows = some_rows()
    assert result(spelling.spelling_variants(docs_of(rows), every=31)) == brute(rows)


def test_without_cut_letters_and_other_alphabets(docs_of):
    rows = some_rows()[:60]
    want = brute(rows, None)
    for symbols in (2, 5, 300):
        assert result(spelling.spelling_variants(docs_of(rows), symbols=symbols)) == want


def test_long_words(docs_of):
    """Lengths around the limit, edits at every kind of place, and a run of 200,000 letters."""
    rng = random.Random(8)
    rows, words = [], []
    for i in range(40):
        w = "".join(rng.choice("abc") for _ in range(rng.choice([62, 63, 64, 65, 66, 90])))
        words.append(w)
        for _ in range(4):
            k = rng.choice([0, 1, 30, 31, 32, len(w) // 2, len(w) - 32, len(w) - 31, len(w) - 1])
            words.append(rng.choice([w[:k] + w[k + 1 :], w[:k] + "z" + w[k:], w[:k] + "y" + w[k + 1 :]]))
    rows = [(i, f"{w} {w}" if i % 5 else " ".join([w] * 25)) for i, w in enumerate(words)]
    assert result(spelling.spelling_variants(docs_of(rows))) == brute(rows, None)
    huge = "ab" * 100_000
    got = spelling.spelling_variants(docs_of([(1, huge + " " + huge), (2, f"{huge}c {huge}c"), (3, f"c{huge} c{huge}")])).collect()
    assert {len(r.word): r.n_near for r in got if r.word == huge} == {200_000: 2} and len(got) == 3


def test_chain_of_forms(docs_of):
    counts = [("abcdefg", 2), ("abcdefgh", 20), ("abcdefghi", 200), ("abcdefghij", 2000)]
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(counts)]
    got = {r.word: (r.form, r.root) for r in spelling.spelling_variants(docs_of(rows)).collect()}
    assert got["abcdefg"] == ("abcdefgh", "abcdefghij") and got["abcdefghij"] == (None, "abcdefghij")


def test_empty_and_clashing(spark, docs_of):
    assert spelling.spelling_variants(docs_of([])).count() == 0
    assert spelling.spelling_variants(docs_of([(1, None), (None, "")])).count() == 0
    docs = docs_of([(1, "letters letters")] * 2).selectExpr("*", "1 word", "2 n", "3 `key`", "4 `doc.id`")
    assert [tuple(r) for r in spelling.spelling_variants(docs, every=None).collect()] == [("letters", None, "letters", 4, 0, None)]


def test_text_ids(spark):
    docs = spark.createDataFrame([("a-1", "letters letters letterz")], "name string, body string")
    assert {r.word for r in spelling.spelling_variants(docs, "name", "body", every=31).collect()} <= {"letters"}


def test_neighbourhood_is_full():
    rng = random.Random(2)
    for _ in range(300):
        a = "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9)))
        k = rng.randrange(len(a))
        b = rng.choice([a[:k] + a[k + 1 :], a[:k] + rng.choice("abcdefgh") + a[k + 1 :], a[:k] + rng.choice("abcdefgh") + a[k:]])
        if a == b or not b:
            continue

        def meets(x, y):
            target = spelling.reduced_keys(spelling.symbol_matrix([y], 3))[0]
            found = [keys for _, keys in spelling.neighbourhood(spelling.symbol_matrix([x], 3), 3)]
            return [int((keys == target).sum()) for keys in found]

        one, other = meets(a, b), meets(b, a)
        assert sum(one[1:]) + sum(other[1:]) + max(one[0], other[0]) == 1, (a, b)


def test_checksums():
    rng = np.random.default_rng(1)
    raw = rng.integers(0, 256, 5000, dtype=np.uint8)
    starts = rng.integers(0, 4000, 200)
    ends = starts + rng.integers(0, 300, 200)
    before = rng.integers(0, 2**32, 200, dtype=np.uint32)
    want = [zlib.crc32(raw[s:e].tobytes(), int(b)) for s, e, b in zip(starts, ends, before)]
    assert spelling.crc32s(raw, starts, ends, before).tolist() == want


def test_runs_end_with_their_text():
    texts = pa.array(["abc", "def é", None, "", "éa"])
    from ledgermill.llm.textops import text_bytes

    raw, offsets = text_bytes(texts)
    starts, ends, owner = spelling.letter_runs(raw, offsets)
    got = [(o, raw[s:e].tobytes().decode()) for s, e, o in zip(starts, ends, owner)]
    assert got == [(0, "abc"), (1, "def"), (1, "é"), (4, "éa")]
