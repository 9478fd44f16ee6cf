import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import docs_of  # noqa: F401

from ledgermill.llm import passages


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 30), max_size=60), st.integers(1, 9))
def test_compact_windows_hold_every_subsequence_once(values, least):
    hashes = np.array(values, np.uint64)
    found = passages.compact_windows(hashes, least)
    for i in range(len(values)):
        for j in range(i + least - 1, len(values)):
            held = [m for m, low, high in found if low <= i <= m <= j <= high]
            assert len(held) == 1 and hashes[held[0]] == hashes[i : j + 1].min()


def test_verified():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2**32, 300, dtype=np.uint32)
    x = rng.integers(0, 2**32, 200, dtype=np.uint32)
    assert passages.verified(x, y) == [] and passages.verified(x, y[:0]) == []
    x[40:100] = y[10:70]
    assert passages.verified(x, y) == [(40, 99)]
    x[70:75] = 7  # one changed word
    assert passages.verified(x, y) == [(40, 99)]
    x[50:90] = 7
    assert passages.verified(x, y) == []


def test_verified_with_a_change_near_an_edge():
    rng = np.random.default_rng(4)
    compared = 0
    for n in range(50, 56):
        for at in range(n):
            for size in (1, 2, 3):
                if at + size > n:
                    continue
                words = rng.integers(0, 2**32, n + 40)
                others = rng.integers(0, 2**32, n + 40)
                others[20 : 20 + n] = words[20 : 20 + n]
                others[20 + at : 20 + at + size] = rng.integers(0, 2**32, size)
                x, y = (np.array([hash(tuple(w[k : k + 5].tolist())) % 2**32 for k in range(len(w) - 4)], np.uint32) for w in (others, words))
                a, b = set(x[20 : 16 + n].tolist()), set(y[20 : 16 + n].tolist())
                if len(a & b) < 0.8 * len(a | b):
                    continue
                found = passages.verified(x, y)
                assert found and min(i for i, _ in found) <= 20 + 5 and max(j for _, j in found) >= 15 + n - 5, (n, at, size)
                assert all(len(set(x[i : j + 1].tolist()) & set(y.tolist())) >= 0.8 * passages.LEAST for i, j in found)
                compared += 1
    assert compared > 300


def text(rng, n):
    return [f"{rng.choice('abcdefgh')}{rng.randint(0, 500)}" for _ in range(n)]


def test_planted_passages(spark, docs_of):
    rng = random.Random(1)
    shared = [text(rng, 55), text(rng, 80), text(rng, 300)]
    line = text(rng, 15)
    rows, holders = [], {}
    for i in range(90):
        words = text(rng, rng.randint(0, 300))
        at = rng.randint(0, len(words))
        if i % 3 == 0:
            words[at:at] = shared[i // 3 % 3]
            holders.setdefault(i // 3 % 3, []).append((i, at))
        else:
            words[at:at] = line
        rows.append((i, rng.choice([" ", "\n"]).join(words)))
    near = text(rng, 400)
    rows += [(200, " ".join(near)), (201, " ".join(w.upper() if k % 90 else f"new{k}" for k, w in enumerate(near)))]
    rows += [(300, None), (301, ""), (302, "a b c"), (303, "same " * 3000), (304, "same " * 3000), (305, "x" * 9000)]
    rows += [(400, " ".join(text(random.Random(7), 120)))] * 2 + [(None, " ".join(text(random.Random(8), 120)))]
    docs = docs_of(rows).selectExpr("*", "1 as h", "2 as id", "3 as spans")
    out = passages.dedup_passages(docs).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: r for r in out}
    linked = set()
    for k, members in holders.items():
        first = members[0][0]
        for i, at in members[1:]:
            spans = [tuple(map(int, s.split(":"))) for s in got[i].spans.split(",")]
            assert any(a <= at and at + len(shared[k]) <= b for a, b in spans), (i, at, spans)
            assert sum(b - a for a, b in spans) <= len(shared[k]) + 12
            assert first in got[i].sources and got[i].class_id == first
        linked |= {i for i, _ in members}
    for i in range(90):
        if i not in linked:
            assert (got[i].n_repeated, got[i].spans, got[i].sources, got[i].class_id, got[i].n_links) == (0, "", [], i, 0)
    assert got[201].n_repeated > 350 and got[201].sources == [200] and got[200].n_links == 1
    assert got[304].n_repeated >= 2900 and got[304].class_id == 303
    assert got[300].n_words == 0 and got[302].n_words == 3 and got[305].n_repeated == 0 and got[400].n_repeated == 0
    assert got[None].class_id is None


def test_sampled_stretches_agree_in_every_passage():
    rng = np.random.default_rng(3)
    for n in range(0, 120, 7):
        shared = rng.integers(0, 2**63, passages.LEAST, dtype=np.uint64)
        x, y = (np.r_[rng.integers(0, 2**63, k, dtype=np.uint64), shared, rng.integers(0, 2**63, 9, dtype=np.uint64)] for k in (n, 3))
        assert set(passages.sampled_stretches(x)[1]) & set(passages.sampled_stretches(y)[1])


def test_least_of():
    values = np.random.default_rng(0).integers(0, 99, 50).astype(np.uint64)
    assert all(v == values[i : i + 12].min() for i, v in enumerate(passages.least_of(values, 12)))


def test_passages_behind_partial_quotes(spark, docs_of):
    """An earlier text quotes a part of each passage; later texts hold all of it."""
    rng = random.Random(5)
    rows, at = [], {}
    for k in range(150):
        shared = text(rng, 50)
        size = rng.randint(20, 44)
        start = rng.choice([0, 50 - size, rng.randint(0, 50 - size)])
        quoted = shared[start : start + size]
        for j, part in enumerate((quoted, shared, shared)):
            words = text(rng, rng.randint(5, 60))
            at[3 * k + j] = len(words)
            rows.append((3 * k + j, " ".join(words + part + text(rng, rng.randint(5, 60)))))
    got = {r.doc_id: r for r in passages.dedup_passages(docs_of(rows)).collect()}
    for k in range(150):
        r = got[3 * k + 2]
        spans = [tuple(map(int, s.split(":"))) for s in r.spans.split(",") if s]
        assert 3 * k + 1 in r.sources and r.class_id <= 3 * k + 1, k
        assert any(a <= at[r.doc_id] and at[r.doc_id] + 50 <= b for a, b in spans), (k, spans)


def test_one_hash_function_is_enough_beside_an_equal_segment():
    def regions(c, c1, functions=1):
        cells = {"f": 0, "at": 30, "span": 10 << 32 | 80, "c": c, "id1": 1, "at1": 40, "span1": 20 << 32 | 90, "c1": c1}
        own = {n: np.full(functions, v, np.int64) for n, v in cells.items()}
        own["f"] = np.arange(functions)
        return list(passages._regions(own))

    assert regions(5 << 48 | 7, 6 << 48 | 7) == [(1, 0, 10, 75, 10, 10)]
    assert regions(5 << 48 | 7, 6 << 48 | 8) == [] == regions(0, 0)
    assert regions(0, 0, 2) == [(1, 0, 10, 75, 10, 10)]


def test_recall_of_near_copies_of_fifty_words(docs_of):
    """One inner word changed, so a Jaccard similarity of 0.804; half of them behind a quote of 20 to 44 words."""
    rng = random.Random(6)
    rows, asked = [], {True: [], False: []}
    for k in range(600):
        shared = text(rng, 50)
        size = rng.randint(20, 44)
        start = rng.randint(0, 50 - size)
        near = list(shared)
        near[rng.randint(4, 45)] = "changed"
        asked[k % 2 == 0].append(3 * k + 2)
        for j, part in enumerate((shared[start : start + size] if k % 2 == 0 else [], shared, near)):
            rows.append((3 * k + j, " ".join(text(rng, rng.randint(50, 120)) + part + text(rng, rng.randint(50, 120)))))
    got = {r.doc_id: r.sources for r in passages.dedup_passages(docs_of(rows)).collect()}
    quoted, plain = (sum(i - 1 in got[i] for i in asked[q]) for q in (True, False))
    assert plain >= 299 and quoted >= 270, (plain, quoted)


def near_repeat(x, y):
    """Any 46 shingles in a row of one text beside any of the other, compared as sets."""
    if len(set(x) & set(y)) < 37:
        return False
    own = [set(x[i : i + passages.LEAST]) for i in range(len(x) - passages.LEAST + 1)]
    other = [set(y[i : i + passages.LEAST]) for i in range(len(y) - passages.LEAST + 1)]
    return any(len(a & b) >= 0.8 * len(a | b) for a in own for b in other)


def test_against_all_pairs(docs_of):
    """Every pair of texts compared by brute force: no link that it lacks, and its classes but for a near-copy that was missed."""
    rng = random.Random(12)
    shared, rows = [text(rng, rng.randint(40, 90)) for _ in range(14)], []
    for i in range(70):
        words = text(rng, rng.randint(0, 60))
        for k in rng.sample(range(14), rng.choice([0, 1, 1, 2])):
            part = list(shared[k])
            if rng.random() < 0.4:
                part[rng.randint(5, len(part) - 6)] = f"other{i}"
            if rng.random() < 0.2:
                part = part[: rng.randint(20, len(part))]
            words += part + text(rng, rng.randint(0, 40))
        rows.append((i, " ".join(words)))
    grams = {i: [tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 0))] for i, t in rows for w in [t.split()]}
    pairs = {(j, i) for i in grams for j in range(i) if near_repeat(grams[i], grams[j])}
    root = list(range(70))
    for _ in range(70):
        for j, i in pairs:
            root[i] = root[j] = min(root[i], root[j])
    got = {r.doc_id: r for r in passages.dedup_passages(docs_of(rows)).collect()}
    links = {(j, i) for i, r in got.items() for j in r.sources}
    assert len(pairs) > 60 and links <= pairs, links - pairs
    assert sum(r.class_id != root[i] for i, r in got.items()) <= 1


def test_near_copies_behind_two_quotes(docs_of):
    """Two earlier texts quote the first and the last 40 words of each passage; the two near-copies that follow are linked."""
    rng = random.Random(21)
    rows = []
    for k in range(100):
        shared = text(rng, 50)
        near = list(shared)
        near[rng.randint(4, 45)] = "changed"
        for j, part in enumerate((shared[:40], shared[10:], shared, near)):
            rows.append((4 * k + j, " ".join(text(rng, rng.randint(50, 90)) + part + text(rng, rng.randint(50, 90)))))
    got = {r.doc_id: r for r in passages.dedup_passages(docs_of(rows)).collect()}
    assert sum(4 * k + 2 in got[4 * k + 3].sources and got[4 * k + 3].class_id == 4 * k + 2 for k in range(100)) >= 98


def test_repeated_rows_are_compared_once(docs_of, monkeypatch):
    rng = random.Random(9)
    stored, write = {}, passages.settle

    def kept(df, name):
        frame = write(df, name)
        stored.setdefault(name, []).extend(map(repr, frame.collect()))
        return frame

    monkeypatch.setattr(passages, "settle", kept)
    shared = text(rng, 60)
    rows = [(1, " ".join(shared + text(rng, 40)))] + [(i, " ".join(text(random.Random(i or 0), 30) + shared)) for i in (2, None)] * 40
    found = passages.repeated_passages(docs_of(rows)).collect()
    assert {(r.id, r.id1) for r in found} == {(1, -(1 << 63)), (2, -(1 << 63))}
    for name in ("shared", "stretches"):
        assert len(stored[name]) == len(set(stored[name])) > 0


def test_empty(docs_of):
    assert passages.dedup_passages(docs_of([])).count() == 0


def held_windows(texts, m):
    """The windows over shingle ``m`` of each text, all in one group."""
    asked = [[{"g": 1, "m": m, "span": len(t.split()) - passages.WORDS, "f": 0}] for t in texts]
    kind = pa.list_(pa.struct([("g", pa.int64()), ("m", pa.int64()), ("span", pa.int64()), ("f", pa.int8())]))
    ids = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array(texts), pa.array(asked, kind)], ["id", "h", "text", "asked"])
    table = pa.Table.from_batches(passages._held(iter([batch])))
    return table.combine_chunks().to_batches(max_chunksize=100)


def test_windows_around_a_common_line_are_not_all_compared(monkeypatch):
    """1,500 texts hold one line of 13 words and have nothing else in common, but for ten that repeat an earlier text's 55 words around it."""
    rng = random.Random(31)
    line, compared, alike = text(rng, 13), [], passages.alike
    texts = [text(rng, 60) + line + text(rng, 60) for _ in range(1500)]
    for k in range(10):
        texts[1400 + k][39:94] = texts[7 * k][39:94]
        texts[1400 + k][45 if k % 2 else 90] = "changed"
    monkeypatch.setattr(passages, "alike", lambda *a: compared.append(len(a[2])) or alike(*a))
    found = pa.Table.from_batches(passages._pairs(iter(held_windows([" ".join(t) for t in texts], 64)))).to_pylist()
    assert {(r["id"], r["id1"]) for r in found} == {(1400 + k, 7 * k) for k in range(10)}
    assert sum(compared) < 30 * len(texts)


def test_pairs_of_windows_against_one_by_one(monkeypatch):
    """Windows of texts cut from a few sources with changes, put in and left out words, compared one at a time, in any share of the group."""
    rng = random.Random(32)
    sources = [text(rng, 60) + ["middle", "of", "all", "these", "texts"] + text(rng, 60) for _ in range(4)]
    texts = []
    for _ in range(160):
        words = list(rng.choice(sources))
        for at in (rng.randrange(10, 55), rng.randrange(70, 120)):
            words[at : at + rng.choice([0, 0, 1])] = rng.choice([[], ["x"], ["y", "z"], [f"n{at}"]])
        cut = rng.choice([0, 0, 20, 30])
        middle = words.index("middle")
        words = text(rng, 60 - middle + cut) + words[cut:] if middle - cut < 60 else words[middle - 60 :]
        shift = 60 - words.index("middle")
        words = text(rng, shift) + words if shift > 0 else words
        texts.append(" ".join(words[: rng.choice([110, 125, 140])]))
    batches = held_windows(texts, 60)
    table = pa.Table.from_batches(batches)
    s = np.frombuffer(b"".join(table.column("s").to_pylist()), passages.SHORT).reshape(-1, passages.REACH)
    high = np.minimum((table.column("span").to_numpy() & passages.LOW) - 60 + passages.LEAST - 1, passages.REACH - 1)
    at = table.column("at").to_numpy()
    known, roots, wanted = [], {}, set()
    for y in range(len(texts)):
        equal, met, enough = None, {}, []
        for z in known:
            if at[z] >> 32 == at[y] >> 32:
                continue
            top = np.minimum(high[[y]], high[[z]])
            same = (s[y] == s[z])[: top[0] + 1]
            if equal is None and any(same[k : k + passages.LEAST].all() for k in range(len(same) - passages.LEAST + 1)):
                equal = z
            near, more = passages.alike(s[[y]], s[[z]], np.zeros(1, np.int64), top)
            if near[0]:
                met.setdefault(roots[z], z)
            elif more[0]:
                enough.append(z)
        if equal is not None:
            wanted.add((y, equal, 1))
            continue
        wanted |= {(y, z, 1) for z in met.values()} | {(y, z, 0) for z in enough if roots[z] not in met}
        roots[y] = min(met, default=y)
        roots = {z: roots[y] if r in met else r for z, r in roots.items()}
        known.append(y)
    assert len(known) > 40 and len({k for _, _, k in wanted}) == 2 and len(set(roots.values())) > 4
    for rows, many in ((1 << 15, 64), (1 << 15, 2), (100, 64), (100, 2)):
        monkeypatch.setattr(passages, "ROWS", rows)
        monkeypatch.setattr(passages, "MANY", many)
        found = pa.Table.from_batches(passages._pairs(iter(batches))).to_pylist()
        got = {(r["id"], r["id1"], int(r["c"] == 1)) for r in found}
        assert len(found) == len(got) and got == wanted, (rows, many)
