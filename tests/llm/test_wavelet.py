import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import docs_of  # noqa: F401
from tokenizers import Tokenizer

from ledgermill.llm import wavelet


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 37), max_size=300))
def test_rank_select_access(tokens):
    t = np.array(tokens, np.uint16)
    shard = wavelet.unpack(wavelet.pack([7, None], [len(t), 0], t, 6))
    m = shard.tokens
    assert shard.doc_ids == [7, None] and m.decode().tolist() == tokens
    assert m.access(np.arange(len(t))).tolist() == tokens and shard.document(0).tolist() == tokens
    for v in {*tokens[:5], 3, 63, 64}:
        where = [i for i, x in enumerate(tokens) if x == v]
        assert m.occurrences(v).tolist() == where and m.count(v) == len(where)
        assert all(m.select(v, k) == w for k, w in enumerate(where))
        for upto in (0, len(t) // 2, len(t)):
            assert m.rank(v, upto) == sum(x == v for x in tokens[:upto])


@pytest.fixture(scope="module")
def words():
    return wavelet.WordIds(wavelet.tokenizer_path())


@pytest.fixture(scope="module")
def library():
    """The tokenizer as the library loads it, with no setting of the operator's."""
    return Tokenizer.from_file(wavelet.tokenizer_path())


pieces = st.sampled_from(["don't,", "Word!!", "a-b", "x<|startoftext|>y", "<|endof", "text|>", "A%%%", "z_", "q.%%%", "'S", "it's", "ÉTÉ", "é", "ΣΑΣ", "<|endoftext|>", "a b", "　", "́x", "x" * 70, "12,5%", "İ", " ", "\n", "\x0b", "\x1c", "\x85", "’s", "中文字"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(pieces, st.text(max_size=6)), max_size=12))
def test_words_encode_like_the_text(words, library, parts):
    text = "".join(p for p in parts).encode("utf-8", "ignore").decode()
    ids, counts = words.encode(pa.array([text]))
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert counts.tolist() == [len(ids)]


def test_added_tokens_in_a_text(words, library):
    for text in ("a <|endoftext|> b", "a<|endoftext|>b <|startoftext|>", "A <|ENDOFTEXT|> b"):
        assert words.encode(pa.array([text]))[0].tolist() == library.encode(text, add_special_tokens=False).ids
    assert words.encode(pa.array(["a <|endoftext|> b"]))[0].tolist() == [320, 49407, 321]


def test_plain_words_are_all_that_match():
    every = "".join(map(chr, range(33, 127)))
    assert {c for c in every if pc.match_substring_regex(pa.array(["a" + c]), f"^{wavelet.PLAIN_WORD}$")[0].as_py()} == {c for c in every if c in wavelet.MARK_SET or c.isalpha()}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.from_regex(f"[{wavelet.LETTERS}]+", fullmatch=True).map(str.lower), min_size=1, max_size=20))
def test_plain_words_together(words, parts):
    ids, counts = words._together(parts)
    apart, sizes = words._apart(parts)
    assert ids.tolist() == apart.tolist() and counts.tolist() == sizes.tolist()


def check(library, rows, got):
    """Ids ascending, NULL first, rows of one id in any order; starts follow each other, sums are the texts' own."""
    got, want, start = sorted(map(tuple, got), key=lambda r: r[1]), [], 0
    for d, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert Counter((d, n, crc) for d, _, n, crc in got) == Counter(want)
    assert [d for d, *_ in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    for _, at, n, _ in got:
        assert at == start
        start += n


@pytest.mark.parametrize("shard_tokens", [wavelet.SHARD_TOKENS, 40])
def test_odd_rows(library, docs_of, shard_tokens):
    rows = [(5, "one two"), (3, None), (2, ""), (2, ""), (9, "tie b"), (9, "tie a"), (None, "no id"), (None, None), (11, "long " * 9000), (-4, "né")]
    rows += [(100 + i, "some words of text " * (i % 7)) for i in range(60)]
    docs = docs_of(rows).selectExpr("*", "1 as start", "2 as image", "3 as seq")
    check(library, rows, wavelet.encoded(docs, shard_tokens=shard_tokens).collect())


def test_rows_without_ids_are_spread(spark, folder, library):
    rows = [(None if i % 3 else 7, f"text {i}") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = wavelet.encoded(docs, path=f"{folder}/shards", shard_tokens=500)
    check(library, rows, got.collect())
    parts = spark.read.parquet(f"{folder}/shards").groupBy("part").sum("n_docs").collect()
    assert len(parts) == 1 or max(r[1] for r in parts) < 3000


def test_whole_table(spark, small, library):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check(library, rows, wavelet.encoded(docs, shard_tokens=30_000).collect())


def test_empty(docs_of):
    assert wavelet.encoded(docs_of([])).count() == 0


def test_words_beyond_the_cache(monkeypatch, library):
    monkeypatch.setattr(wavelet, "CACHE_WORDS", 3)
    words = wavelet.WordIds(wavelet.tokenizer_path())
    for text in ("a bcdef", "a c that's e f", "that's c a b g", "a", "e f that's"):
        assert words.encode(pa.array([text]))[0].tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(words.place) == 3
