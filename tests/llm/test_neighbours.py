import numpy as np
from pyspark.sql import functions as F

from ledgermill.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, is_query):
    ok = {}
    for i, v, *_ in rows:
        if i is None or not v or any(x is None for x in v):
            continue
        a = np.array(v, np.float32).astype(float)
        if np.isfinite(a).all() and a.any():
            ok[i, a.tobytes()] = a
    out = []
    for (i, _), a in ok.items():
        if is_query(i):
            near = sorted((float(np.sqrt(((a - b) ** 2).sum())), j) for (j, _), b in ok.items() if j != i and len(a) == len(b))
            out += [(i, k + 1, j, d) for k, (d, j) in enumerate(near[:10])]
    return sorted(out)


def run(spark, rows, every):
    frame = spark.createDataFrame([(*r, None) for r in rows], SCHEMA).selectExpr("*", "1 as c1", "2 as `dim`", "3 as id")
    return sorted(map(tuple, neighbours.nearest(frame, F.col("id") % every == 0).collect()))


def close(got, want):
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert all(abs(a[3] - b[3]) < 1e-12 for a, b in zip(got, want))


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose(np.linalg.norm(neighbours.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(neighbours.hadamard(neighbours.hadamard(x)), x)
    assert neighbours.rotated(x[:, :11], 3).shape == (5, 16)


def test_recall(spark, small):
    rows = [tuple(r)[:2] for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    got, want = run(spark, rows, 5), brute(rows, lambda i: i % 5 == 0)
    assert len(got) == len(want)
    met = {r[0::2][:2] for r in want}
    assert sum((r[0], r[2]) in met for r in got) / len(met) >= 0.9


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, -0.0]), (2, [0.0, 0.0]), (3, None), (4, []), (5, [1.0, None]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0])]
    rows += [(10, [0.5, 0.5]), (20, [0.5, 0.5]), (20, [0.5, 0.5]), (30, [-3.0, 2.0]), (None, [1.0, 1.0]), (40, [1.0, 2.0, 3.0]), (41, [1e30, 1.0]), (50, [7.0])]
    close(run(spark, rows, 10), brute(rows, lambda i: i % 10 == 0))
    assert run(spark, [], 1) == []


def test_many_equal_vectors_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 7)
    rng = np.random.default_rng(2)
    rows = [(i, [0.25] * 8) for i in range(60)] + [(100 + i, rng.normal(size=8).tolist()) for i in range(90)]
    monkeypatch.setattr(neighbours, "JOINT_PROBES", 1 << 20)  # all keys
    close(run(spark, rows, 10), brute(rows, lambda i: i % 10 == 0))


def test_joint_keys_are_the_best_sums():
    """Against all pairs of axes, and the key of a vector itself."""
    rng = np.random.default_rng(4)
    v = rng.normal(size=(6, 8))
    a, b = neighbours.signed_axes(v, 6), neighbours.signed_axes(v, 7)
    every = (a[:, :, None] + b[:, None, :]).reshape(6, -1)
    for probes in (1, 5, 40):
        got = neighbours.joint_keys(v, 3, 2, probes)
        assert np.allclose(np.take_along_axis(every, got, axis=1), -np.sort(-every, axis=1)[:, :probes])
    assert (neighbours.joint_keys(v, 3, 2, 1)[:, 0] == a.argmax(1) * 16 + b.argmax(1)).all()


def test_plans():
    assert neighbours.plan(10, 64) == (1, 16) and neighbours.plan(neighbours.BLOCK, 2) == (1, 4)
    shares = []
    for n in (3_000, 50_000, 200_000, 1_000_000, 30_000_000, 1_000_000_000):
        joined, probes = neighbours.plan(n, 64)
        shares.append(probes / 128**joined)
        assert n <= neighbours.BLOCK * 128 ** (joined - 1)
    assert shares == sorted(shares, reverse=True) and shares[-1] < shares[0] / 100


def test_recall_with_joint_keys(spark, small, monkeypatch):
    """The same recall where tables join two rotations, at a smaller share of candidates, and small blocks on both sides."""
    rows = [tuple(r)[:2] for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    monkeypatch.setattr(neighbours, "BLOCK", 100)
    assert neighbours.plan(len(rows), 64)[0] == 2
    monkeypatch.setattr(neighbours, "JOINT_PROBES", 1024)
    got, want = run(spark, rows, 5), brute(rows, lambda i: i % 5 == 0)
    met = {r[0::2][:2] for r in want}
    assert len(got) == len(want) and sum((r[0], r[2]) in met for r in got) / len(met) >= 0.9


def test_too_few_candidates_ask_all(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 7)
    monkeypatch.setattr(neighbours, "JOINT_PROBES", 1)
    monkeypatch.setattr(neighbours, "TABLES", 1)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(60)]
    close(run(spark, rows, 10), brute(rows, lambda i: i % 10 == 0))


def test_answers_do_not_depend_on_the_number_of_rows(spark, monkeypatch):
    """Far vectors, as many as were once a reason for other keys, change no answer."""
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    monkeypatch.setattr(neighbours, "JOINT_PROBES", 24)
    rng = np.random.default_rng(8)
    centre = np.eye(16)[0] * 3
    few = [(i, (centre + rng.normal(size=16)).tolist()) for i in range(60)]
    far = [(1001 + 10 * i, (-centre * 30 + rng.normal(size=16) * 0.05).tolist()) for i in range(300)]
    got = run(spark, few, 10)
    assert len(got) == 60 and got == run(spark, few + far, 10)


def test_nearer_neighbours_ask_for_fewer_probes():
    probes = neighbours.wanted(np.array([-1.0, 0.0, 0.3, 0.5, 0.9, 1.0]), 64).tolist()
    assert probes == sorted(probes, reverse=True) and probes[0] > neighbours.JOINT_PROBES > probes[3] and probes[-1] == 1
