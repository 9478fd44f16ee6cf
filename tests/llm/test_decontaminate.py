import hashlib
import random
import re

import pytest

from llm_fixtures import docs_of  # noqa: F401

from ledgermill.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def brute(docs, items):
    out = []
    for d, text in docs:
        w, hit, met = tokens(text), set(), set()
        for item, t in items:
            iw = tokens(t)
            size = min(10, len(iw))
            if not size:
                continue
            windows = {tuple(iw[i : i + size]) for i in range(len(iw) - size + 1)}
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
                    met.add(str(item)) if item is not None else None
        digest = hashlib.sha256(",".join(sorted(met)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(met), digest, bool(hit)))
    return sorted(out, key=repr)


def cases(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(25)] + ["Été", "X9", "it's"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 30)))) for i in range(9)]
    items += [(50, "lone"), (51, "two words"), (52, "a b a b a b a b a b a b"), (53, None), (54, "?!"), (10, items[0][1]), (None, items[1][1])]
    docs = []
    for i in range(40):
        words = [rng.choice(vocab) for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            part = rng.choice(items)[1]
            source = (part or "").split()
            a = rng.randint(0, len(source))
            at = rng.randint(0, len(words))
            words[at:at] = [x.upper() for x in source[a : a + rng.randint(5, 20)]]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(words)))
    docs += [(90, None), (91, ""), (92, "..."), (93, "a b " * 3000), (93, "a b " * 3000), (None, items[2][1]), (94, "a " * 9)]
    return docs, items


@pytest.mark.parametrize("seed,short", [(1, True), (2, False)])
def test_against_brute_force(spark, docs_of, seed, short):
    docs, items = cases(seed)
    items = items if short else [i for i in items if len(tokens(i[1])) >= 10 or not tokens(i[1])]
    frame = docs_of(docs).selectExpr("*", "1 as w", "2 as k_id", "3 as f", "4 as met", "5 as length")
    got = decontaminate.hits(frame, spark.createDataFrame(items, "item_id long, text string"))
    want = brute(docs, items)
    assert sorted((tuple(r)[2:] for r in got.collect()), key=repr) == want
    kept = decontaminate.drop_contaminated(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == frame.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((r[0] for r in want if not r[-1]), key=repr)


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.hits(docs_of([]), none).count() == 0
    (row,) = decontaminate.hits(docs_of([(1, "Some Words")]), none).collect()
    assert tuple(row)[2:] == (1, 2, 0, 0, hashlib.sha256(b"").hexdigest(), False)
    assert decontaminate.hits(docs_of([]), spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0


def test_main_path_is_native(spark, docs_of):
    found = decontaminate.hits(docs_of([(1, "a b c")]), spark.createDataFrame([(1, "a b")], "item_id long, text string"))
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
