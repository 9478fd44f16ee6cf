import random
import zlib
from collections import Counter, defaultdict

import pytest

from llm_fixtures import docs_of  # noqa: F401

from ledgermill.llm import sharding


def shards_of(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r.shard].append(r)
    return out


def check(rows, df, shards=8):
    """Whole, gapless, with the rows' own sizes and checksums; returns the bytes of each shard and the shards of each text."""
    found = shards_of(df)
    assert set(found) <= set(range(shards))
    for members in found.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for m in found.values() for r in m) == want
    spread = defaultdict(set)
    for s, members in found.items():
        for r in members:
            spread[r.size, r.text_crc32].add(s)
    return [sum(r.size for r in found.get(s, [])) for s in range(shards)], spread


def random_rows(n, seed=1, copies=0.4):
    rng = random.Random(seed)
    texts, rows = [], []
    for i in range(n):
        if texts and rng.random() < copies:
            rows.append((i, rng.choice(texts)))
        else:
            texts.append(" ".join(rng.choice(["ab", "Été", "日本", "long"]) + str(rng.randint(0, 999)) for _ in range(rng.randint(1, 60))))
            rows.append((i, texts[-1]))
    return rows


def test_copies_stay_together_and_bytes_are_even(docs_of):
    rows = random_rows(3000)
    loads, spread = check(rows, sharding.sharded(docs_of(rows)))
    assert max(loads) - min(loads) <= 2 * max(len(t.encode()) + 1 for _, t in rows)
    assert all(len(s) == 1 for s in spread.values())


def test_hot_group_takes_as_few_shards_as_hold_it(docs_of):
    rows = random_rows(2000, 2, 0.1)
    hot = "hot text " * 20
    rows += [(10_000 + i, hot) for i in range(1500)]
    loads, spread = check(rows, sharding.sharded(docs_of(rows)))
    size = len(hot) + 1
    assert max(loads) - min(loads) <= 2 * max(len(t.encode()) + 1 for _, t in rows)
    share = sum(loads) / 8
    needed = -(-1500 * size // share)
    assert needed <= len(spread[size, zlib.crc32(hot.encode())]) <= needed + 1
    cut = sum(len(s) > 1 for s in spread.values())
    assert cut <= 8


def test_all_linked(docs_of):
    """No document without links is there to fill up: sizes stay even, and four fifths of the pairs whole."""
    rows = [(2 * i + k, f"text number {i} " * (i % 7 + 1)) for i in range(600) for k in range(2)]
    loads, spread = check(rows, sharding.sharded(docs_of(rows)))
    assert max(loads) <= 1.03 * sum(loads) / 8 and min(loads) >= 0.93 * sum(loads) / 8
    assert sum(len(s) > 1 for s in spread.values()) <= 120


def test_reruns_agree_in_any_order(spark, docs_of):
    rows = random_rows(800, 5)
    one = sorted(map(tuple, sharding.sharded(docs_of(rows)).collect()), key=repr)
    shuffled = rows[:]
    random.Random(3).shuffle(shuffled)
    assert one == sorted(map(tuple, sharding.sharded(docs_of(shuffled).repartition(7)).collect()), key=repr)


def test_odd_rows(docs_of):
    rows = [(1, None), (2, ""), (None, None), (None, "a"), (None, "a"), (3, "a"), (3, "a"), (4, "x" * 100_000), (5, "é")]
    docs = docs_of(rows).selectExpr("*", "1 shard", "2 slot", "3 `t`", "4 `m.x`")
    got = sharding.sharded(docs)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    check(rows, got)
    assert sharding.sharded(docs_of([])).count() == 0


def test_repeated_rows_over_several_shards(docs_of, monkeypatch):
    monkeypatch.setattr(sharding, "REPEATS_AT_ONCE", 7)
    rows = [(1, "same text")] * 500 + [(i, f"other {i}") for i in range(100)]
    loads, _ = check(rows, sharding.sharded(docs_of(rows)))
    assert max(loads) - min(loads) <= 40


def test_other_number_of_shards(docs_of):
    rows = random_rows(500, 8)
    loads, spread = check(rows, sharding.sharded(docs_of(rows), shards=3), 3)
    assert max(loads) - min(loads) <= 2 * max(len(t.encode()) + 1 for _, t in rows) and all(len(s) == 1 for s in spread.values())
    assert check(rows, sharding.sharded(docs_of(rows), shards=1), 1)[0][0] == sum(len(t.encode()) + 1 for _, t in rows)


@pytest.mark.parametrize("seed", range(4))
def test_quotas_hold(seed):
    rng = random.Random(seed)
    for _ in range(200):
        want = {(i, j): rng.randint(0, 1000) for i in range(4) for j in range(4) if i != j and rng.random() < 0.7}
        room = [rng.choice([0, 0, -300, rng.randint(0, 500), 5000]) for _ in range(4)]
        flow = sharding.quotas(want, room)
        for j in range(4):
            assert sum(v for (_, b), v in flow.items() if b == j) <= max(0, room[j] + sum(v for (a, _), v in flow.items() if a == j)) * (1 + 1e-6) + 1e-6
        assert all(0 <= flow[k] <= want[k] + 1e-9 for k in want)


def test_level():
    assert sharding.level([0, 10, 4], 6) == [5.0, 0.0, 1.0]
    assert sharding.level([3, 3], 0) == [0.0, 0.0]
