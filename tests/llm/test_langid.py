import math
import random
import tracemalloc
import zlib
from collections import Counter

import pyarrow as pa
import regex

from llm_fixtures import docs_of  # noqa: F401

from ledgermill.llm import langid


def test_accuracy_on_held_out_rows(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    apart = [r for r in rows if r.held_out and r.lang]
    assert len(rows) == docs.count() and apart
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert sum(r.lang == r.lang_pred for r in apart) / len(apart) >= 0.95


def test_words_first_then_grams(docs_of):
    docs = docs_of([(1, "the cat sat on the mat", "en"), (3, "die katze sitzt auf der matte", "de"), (4, None, "fr"), (5, "x", None)])
    model = langid.learn(docs, "doc_id", "text", "lang")
    assert model.languages == ["de", "en"]
    assert model.found("the") == (0, [model.tables[0]["the"]]) and model.found("ж") == (-1, [])
    size, rows = model.found("katzen")
    longest = next(s for s in range(langid.LONGEST, 0, -1) if any(g in model.tables[s] for g in langid.grams("katzen", s)))
    assert size == longest and rows == [model.tables[size][g] for g in langid.grams("katzen", size) if g in model.tables[size]]
    the, both, none = model.scores(["the", "Katzen-THE", "12 ж"])
    assert the.tolist() == [*model.values[0][model.tables[0]["the"]], 1] and the[:2].argmax() == 1
    assert abs(both - [*(model.values[size][rows].mean(axis=0) + the[:2]), 2]).max() < 1e-12
    assert none.tolist() == [0, 0, 1]


def test_odd_rows(docs_of):
    docs = docs_of([(1, "the cat", "en"), (3, "le chat", "fr"), (7, None, "en"), (8, "", "en"), (9, "12 !?", "fr"), (9, "12 !?", "fr"), (None, "the the", None), (10, "the " * 30000, None)])
    docs = docs.selectExpr("*", "1 as score", "'x' as held_out", "2 as lang_pred", "3 as `row`")
    got = [(r.doc_id, r.lang_pred) for r in langid.identify(docs).collect()]
    want = [(7, "und"), (8, "und"), (9, "und"), (9, "und"), (1, "en"), (3, "fr"), (None, "en"), (10, "en")]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = langid.drop_unidentified(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [1, 10, 3, None]


def test_nothing_to_learn(docs_of):
    assert langid.identify(docs_of([])).count() == 0
    assert [r.lang_pred for r in langid.identify(docs_of([(1, "text", None)])).collect()] == ["und"]


def test_pieces_beyond_the_cache(monkeypatch, docs_of):
    docs = docs_of([(i, f"word{'abcdefghij'[i % 10]} the le {i}", "en" if i % 2 else "fr") for i in range(60)])
    model = langid.learn(docs, "doc_id", "text", "lang")
    monkeypatch.setattr(langid, "CACHE_WORDS", 5)
    scores = langid.WordScores(model)
    for pieces in (["the", "le", "worda"], ["wordb", "the", "wordc", "wordd"], ["worde", "wordb", "le"], ["the"]):
        assert (scores.lookup(pieces) == model.scores(pieces)).all()
    assert len(scores.place) == 5


def test_memory_does_not_follow_the_batch(docs_of):
    """A batch of 10,000 texts may have any size; a worker holds words of one megabyte at a time."""
    model = langid.learn(docs_of([(1, "the cat", "en"), (3, "le chat", "fr")]), "doc_id", "text", "lang")
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["the", "cat", "le", "chat", "x1"], k=500)) for _ in range(4000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["t"])
    tracemalloc.start()
    found = [(n, s) for _, names, score in langid.judged_parts(model, iter([batch]), "t") for n, s in zip(names, score.tolist())]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    names, score = langid.judged(langid.WordScores(model), batch.column("t"))
    assert batch.nbytes > 6 << 20 and found == list(zip(names, score.tolist()))
    assert peak < 10 << 20


def brute(rows):
    """Every row's language and score by plain counting, from all rows that are not held out."""
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 4 == 2
    learned = {(t, g) for d, t, g in rows if t is not None and g is not None and not held(d)}
    names = sorted({g for _, g in learned})
    counts = {(g, s): Counter() for g in names for s in range(langid.LONGEST + 1)}
    for t, g in learned:
        for w in regex.findall(r"\p{L}+", t.lower()):
            counts[g, 0][w] += 1
            for s in range(1, langid.LONGEST + 1):
                marked = f"<{w}>" if s > 1 else w
                counts[g, s].update(marked[i : i + s] for i in range(len(marked) - s + 1))

    def log(g, s, item):
        c = counts[g, s]
        return math.log((c[item] + langid.SMOOTHING) / (sum(c.values()) + langid.SMOOTHING * (len(c) + 1)))

    out = []
    for d, t, _ in rows:
        words, total = regex.findall(r"\p{L}+", (t or "").lower()), dict.fromkeys(names, 0.0)
        for w in words:
            for s in range(0, -langid.LONGEST - 1, -1):
                size = 0 if s == 0 else langid.LONGEST + 1 + s
                marked = f"<{w}>" if size > 1 else w
                items = [w] if not size else [marked[i : i + size] for i in range(len(marked) - size + 1)]
                known = [x for x in items if any(counts[g, size][x] for g in names)]
                if known:
                    for g in names:
                        total[g] += sum(log(g, size, x) for x in known) / len(known)
                    break
        best = max(names, key=lambda g: (total[g], -names.index(g)))
        share = 1 / sum(math.exp(v - total[best]) for v in total.values())
        out.append((d, held(d), best if words else "und", share if words else 0.0))
    return out


def test_against_brute_force(docs_of):
    rng = random.Random(3)
    letters = {"en": "abcdet", "fr": "abceé", "xx": "abczß"}
    word = lambda g: "".join(rng.choice(letters[g]) for _ in range(rng.randint(1, 7)))
    rows = [(i, " ".join(word(g) for _ in range(rng.randint(0, 12))), rng.choice([g, g, None])) for i in range(120) for g in [rng.choice(list(letters))]]
    rows += [(200, None, "en"), (201, "", "fr"), (202, "12 !", None), (None, "abc ABC", "en"), (3, rows[3][1], rows[3][2]), (204, "ab" * 3000, None)]
    got = sorted(map(tuple, langid.identify(docs_of(rows)).collect()), key=repr)
    for g, w in zip(got, sorted(brute(rows), key=repr), strict=True):
        assert g[:3] == w[:3] and abs(g[3] - w[3]) < 1e-9


def test_rare_languages_are_learned_and_repeats_count_once(docs_of):
    rows = [(4 * i, "the cat sat", "en") for i in range(3000)] + [(20_000 + i, f"le chat numéro{i}", "fr") for i in range(300)] + [(50_001 + 2 * i, "кот сидел тут", "ru") for i in range(8)]
    docs = docs_of(rows)
    model = langid.learn(docs, "doc_id", "text", "lang", sample_rows=50)
    assert model.languages == ["en", "fr", "ru"]
    assert sum(w.startswith("numéro") for w in (w for w in model.tables[0])) <= 50
    assert {r.lang_pred for r in langid.identify(docs).where("doc_id > 50000").collect()} == {"ru"}
