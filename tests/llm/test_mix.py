import random

import pytest

from llm_fixtures import docs_of  # noqa: F401

from ledgermill.llm import mix


def filled(sizes, weights):
    """Targets as the words say: share, limit, share the excess again."""
    total, want, full = sum(sizes.values()), dict.fromkeys(sizes, 0.0), set()
    left = float(total)
    while left > 1e-9 and len(full) < len(sizes):
        share = left / sum(weights[s] for s in sizes if s not in full)
        left = 0.0
        for s in sizes:
            if s not in full:
                want[s] += share * weights[s]
        for s in sizes:
            if s not in full and want[s] >= 3 * sizes[s]:
                left += want[s] - 3 * sizes[s]
                want[s] = 3.0 * sizes[s]
                full.add(s)
    return want


@pytest.mark.parametrize("range_rows", [2_000, 7])
def test_targets_and_budgets(docs_of, range_rows):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        source = rng.choice(["b", "a", None, "c", "a", "a", "é", "tiny"]) if i else "tiny"
        rows.append((i, "w " * (1 if source == "tiny" else rng.randint(0, 60)), None, source))
    rows += [(500, None, None, "a"), (501, "", None, "z"), (None, "x y", None, "a"), (7, rows[7][1], None, rows[7][3]), (502, "w " * 20000, None, "c")]
    docs = docs_of(rows).selectExpr("*", "1 as size", "2 as `key`", "3 as part", "4 as target")
    got = mix.mix(docs, range_rows=range_rows).join(docs.select("doc_id", "text", "source"), ["doc_id"], "left").collect()
    sizes, weights = {}, {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    for k, s in enumerate(sorted(sizes, key=lambda x: (x is None, x))):
        weights[s] = (5, 2, 1)[k % 3]
    want = filled(sizes, weights)
    whole = mix.mix(docs, range_rows=range_rows).collect()
    assert len(whole) == len(rows)
    assert sum(r.taken for r in whole) == sum(int(v + 1e-6) for v in want.values())
    assert all(0 <= r.taken <= 3 * r.size for r in whole)
    for r in got:
        if r.doc_id is not None:
            assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
    again = mix.mix(docs.repartition(5), range_rows=11).collect()
    assert sorted(map(tuple, whole), key=repr) == sorted(map(tuple, again), key=repr)


def test_copies_take_effect(docs_of):
    docs = docs_of([(1, "a b", None, "s"), (2, "c " * 50, None, "t"), (3, "d " * 50, None, "t")]).selectExpr("*", "1 as k_id", "2 as copies")
    copies = {r.doc_id: r.copies for r in mix.mix(docs).collect()}
    got = mix.mixed(docs)
    assert got.columns == docs.columns
    rows = [r.doc_id for r in got.collect()]
    assert {d: rows.count(d) for d in copies} == copies and copies[1] == 3


@pytest.mark.parametrize("at_once", [1 << 14, 7])
def test_repeated_rows(docs_of, monkeypatch, at_once):
    """A third of all rows are one row: words of each source come to its target, within half a document."""
    monkeypatch.setattr(mix, "REPEATS_AT_ONCE", at_once)
    rng = random.Random(6)
    rows = [(1, "w " * 9, None, "a")] * 100 + [(2 + i, "w " * rng.randint(1, 30), None, rng.choice("aabc")) for i in range(200)]
    rows += [(1, "w " * 9, None, "c")] * 5 + [(None, "w w w", None, None)] * 40 + [(None, None, None, "b")] * 3
    docs = docs_of(rows).selectExpr("*", "1 as m", "2 as s", "3 as copies")
    whole = mix.mix(docs).collect()
    assert len(whole) == len(rows) and sum(r.taken for r in whole) == sum({r.source: int(r.target + 1e-6) for r in whole}.values())
    got = mix.mixed(docs)
    assert got.columns == docs.columns
    words, copies = {}, {}
    for r in got.collect():
        words[r.source] = words.get(r.source, 0) + len(r.text.split())
    for r in whole:
        copies[r.source] = copies.get(r.source, 0) + r.copies * r.size
        assert r.copies <= 3
    assert words == {k: v for k, v in copies.items() if v}
    for source, target in {r.source: r.target for r in whole}.items():
        assert abs(words.get(source, 0) - target) <= 15 + 1


def test_empty_and_native(docs_of):
    empty = mix.mix(docs_of([]))
    assert empty.count() == 0 and mix.mixed(docs_of([])).count() == 0
    assert mix.mix(docs_of([(1, None), (2, " ")])).agg({"taken": "sum"}).first()[0] == 0
    assert "Python" not in empty._jdf.queryExecution().toString()
