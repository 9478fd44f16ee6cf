import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from llm_fixtures import docs_of  # noqa: F401

from ledgermill.llm import simhash
from ledgermill.llm.keys import components
from ledgermill.llm.textops import chunks


def brute_fp(text):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    h = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows):
    fps = [brute_fp(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = find(i)
            least[r] = min(least.get(r, d), d)
    return sorted(((d, f"{fps[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)), key=repr)


def some_rows():
    rng = random.Random(5)
    base = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 6) for _ in range(200)) for _ in range(6)]
    rows = [(i, b) for i, b in enumerate(base)]
    for i in range(60):
        words = base[i % 3].split()
        for _ in range(rng.randint(1, 3)):
            words[rng.randrange(len(words))] = f"new{rng.randint(0, 99)}"
        rows.append((100 + i, " ".join(words)))
    rows += [(900, None), (901, ""), (902, " \n\t"), (903, "One"), (904, "one"), (905, "Été à"), (905, "Été à"), (None, base[0])]
    rows += [(906, "x" * 5000), (907, "word " * 3000), (None, "lonely text of its own here")]
    return rows


@pytest.mark.parametrize("block", [1024, 3])
def test_against_brute_force(spark, docs_of, monkeypatch, block):
    monkeypatch.setattr(simhash.linked, "__defaults__", (block,))
    rows = some_rows()
    got = simhash.simhash_components(docs_of(rows))
    hexed = sorted(((r.doc_id, f"{r.fp % 2**64:016x}", r.component_id) for r in got.collect()), key=repr)
    assert hexed == brute(rows)


def test_empty_and_clashing(spark, docs_of):
    assert simhash.simhash_components(docs_of([])).count() == 0
    docs = docs_of([(1, "a b c"), (2, "a b c"), (1, "a b c")]).selectExpr("*", "1 fp", "2 k_id", "3 `row`", "4 `cell.x`")
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1]


def test_texts_without_ids_keep_one_of_each(docs_of):
    docs = docs_of([(None, "one text of its own here"), (None, "quite another text stands there"), (None, "quite another text stands there"), (5, "third kind of words")])
    assert sorted(r.text[:5] for r in simhash.drop_near_duplicates(docs).collect()) == ["one t", "quite", "third"]


def test_grid_never_misses():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    flips = np.zeros_like(a)
    for _ in range(3):
        flips |= np.uint64(1) << rng.integers(0, 64, len(a)).astype(np.uint64)
    ta, tb = simhash._unary(a), simhash._unary(a ^ flips)
    assert (np.bitwise_count(ta ^ tb) <= np.bitwise_count(flips)).all()
    equal = np.stack([((ta ^ tb) & np.uint64(sum(3 << (2 * x) for x in range(g, 32, 6)))) == 0 for g in range(6)])
    assert (equal.sum(0) >= 3).all()


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)] + [(7, 7)]
    links = {}
    for a, b in pairs:
        links.setdefault(a, set()).add(b)
        links.setdefault(b, set()).add(a)
    want = {}
    for n in sorted(links):
        stack = [n]
        while stack:
            x = stack.pop()
            if x not in want:
                want[x] = n
                stack += links[x]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {k: v for k, v in want.items() if len(links[k] - {k})}


def test_memory_does_not_follow_the_batch():
    """A batch of 10,000 texts may have any size; a worker holds words and shingles of half a megabyte at a time."""
    rng = random.Random(4)
    batch = pa.RecordBatch.from_arrays([pa.array([" ".join(rng.choices("abcdefgh", k=500)) for _ in range(4000)])], ["t"])
    tracemalloc.start()
    found = np.concatenate([simhash.simhash_batch(part.column("t")) for part in chunks(batch, "t", simhash.CHUNK)])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 4000 and [int(x) & (1 << 64) - 1 for x in found[:3]] == [brute_fp(t) for t in batch.column("t").to_pylist()[:3]]
    assert peak < 60 << 20
