import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from ledgermill.llm import decontaminate, langid, mix, wavelet
from test_decontaminate import brute as brute_hits
from test_simhash import brute as brute_groups
from test_wavelet import check as check_encoded


@pytest.fixture(scope="module")
def stages(spark, small):
    """What each stage takes and returns."""
    docs, out = spark.read.parquet(f"{small}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        result = corpus_pipeline.settle(stage(spark, docs, small), name)
        out.append((docs, result))
        docs = result
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_columns(stages):
    for docs, result in stages[:-1]:
        assert result.columns == docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_language(stages):
    docs, kept = stages[0]
    told = {r.doc_id for r in langid.identify(docs).collect() if r.lang_pred != "und" and r.score >= langid.MIN_SCORE}
    assert {r.doc_id for r in kept.collect()} == told and len(told) >= 0.9 * docs.count()


def test_one_of_each_group(stages):
    docs, kept = stages[1]
    assert sorted(d for d, _ in pairs(kept)) == sorted({g for _, _, g in brute_groups(pairs(docs))})


def test_no_contaminated_document(stages, spark, small):
    docs, kept = stages[2]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    assert sorted(d for d, _ in pairs(kept)) == [r[0] for r in sorted(brute_hits(pairs(docs), items)) if not r[-1]]


def test_copies(stages):
    docs, result = stages[3]
    want = {r.doc_id: r.copies for r in mix.mix(docs).collect() if r.copies}
    got = [d for d, _ in pairs(result)]
    assert {d: got.count(d) for d in got} == want


def test_encoded(stages, spark, small):
    docs, result = stages[4]
    library = Tokenizer.from_file(wavelet.tokenizer_path())
    check_encoded(library, pairs(docs), result.collect())
    check_encoded(library, pairs(docs), corpus_pipeline.run(spark, small).collect())


def test_odd_rows_through_all_stages(spark, small):
    """NULLs, repeats, very long texts, and columns named like those inside."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    odd = [(None, None), (None, "the and of the and of them all"), (9001, ""), (9002, " \n"), (9003, "12 34"), (9004, None)]
    odd += [(9005, "the words of the one long text and " * 20_000), (9006, "one short text of the words and them")] + [(9007, "the same row of the words and them again")] * 60
    more = spark.createDataFrame([(d, t, None, None, None) for d, t in odd], docs.schema)
    docs = docs.union(more).selectExpr("*", "1 k_id", "2 `row`", "'x' k_th", "3 copies", "4 `a.b`", "5 s")
    result, seen = docs, []
    for name, stage in corpus_pipeline.STAGES:
        result = corpus_pipeline.settle(stage(spark, result, small), f"odd-{name}")
        seen.append(result)
    for kept in seen[:-1]:
        assert kept.columns == docs.columns
        ids = {r.doc_id for r in kept.select("doc_id").collect()}
        assert not ids & {9001, 9002, 9003, 9004}
    after_dedup = [r.doc_id for r in seen[1].select("doc_id").collect()]
    assert after_dedup.count(9007) <= 1 and after_dedup.count(9005) == 1
    assert seen[-1].count() == seen[-2].count()


def test_empty(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.settle(stage(spark, docs, small), "empty")
    assert docs.count() == 0 and decontaminate.WINDOW == 10
