from functools import cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import docs_of  # noqa: F401

from ledgermill.llm import tokencount


def brute(pieces, word):
    byte = tokencount.Trie(pieces).byte
    text = tokencount.MARK + word

    @cache
    def best(n):
        if n == 0:
            return (0, 0)
        size = len(text[n - 1].encode())
        s, c = best(n - 1)
        found = [(s + size * byte, c - size)]
        for a in range(n):
            if text[a:n] in pieces:
                s, c = best(a)
                found.append((s + pieces[text[a:n]], c - 1))
        return max(found)

    return -best(len(text))[1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abcé中", max_size=9), max_size=12), st.lists(st.text(alphabet="abcé" + tokencount.MARK, min_size=1, max_size=4), max_size=15, unique=True))
def test_against_plain_search(words, names):
    pieces = tokencount.scored(names)
    trie = tokencount.Trie(pieces)
    assert [trie.tokens(w) for w in words] == [brute(pieces, w) for w in words]


def test_shared_prefixes_are_scored_once():
    trie = tokencount.Trie(tokencount.scored(["a", "b"]))
    trie.tokens("abab")
    size = len(trie.score)
    trie.tokens("abab"), trie.tokens("ab")
    assert len(trie.score) == size
    trie.tokens("ababb")
    assert len(trie.score) == size + 1


@pytest.fixture(scope="module")
def pieces():
    return tokencount.load_pieces(tokencount.vocabulary_path())


def test_restart(pieces, monkeypatch):
    words = ["hello", "help", "world", "été", "ж"]
    want = [tokencount.Trie(pieces).tokens(w) for w in words]
    monkeypatch.setattr(tokencount, "MAX_NODES", 3)
    trie = tokencount.Trie(pieces)
    assert [trie.tokens(w) for w in words] == want == [brute(pieces, w) for w in words]


def test_whole_table(spark, small, pieces):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in tokencount.count_tokens(docs, tokencount.vocabulary_path()).collect()}
    sizes = {}
    for r in docs.limit(60).collect():
        words = r.text.split()
        for w in set(words) - sizes.keys():
            sizes[w] = brute(pieces, w)
        assert got[r.doc_id] == (len(words), sum(sizes[w] for w in words))
    assert len(got) == docs.count()


def test_odd_rows(docs_of, pieces):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a a"), (4, "a a"), (None, "b"), (5, "x" * 20000), (6, "word " * 20000)]
    docs = docs_of(rows).selectExpr("*", "1 as n_tokens", "2 as n_words")
    got = sorted((tuple(r) for r in tokencount.count_tokens(docs, tokencount.vocabulary_path()).collect()), key=repr)
    one = tokencount.Trie(pieces).tokens
    want = [(1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 2, 2 * one("a")), (4, 2, 2 * one("a")), (None, 1, one("b")), (5, 1, one("x" * 20000)), (6, 20000, 20000 * one("word"))]
    assert got == sorted(want, key=repr)
    assert tokencount.count_tokens(docs_of([]), tokencount.vocabulary_path()).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abcé中", max_size=40), max_size=8), st.lists(st.text(alphabet="abcé" + tokencount.MARK, min_size=1, max_size=4), max_size=15, unique=True))
def test_long_words_without_nodes(words, names):
    pieces, depth = tokencount.scored(names), tokencount.DEPTH
    tokencount.DEPTH = 6
    try:
        trie = tokencount.Trie(pieces)
        assert [trie.tokens(w) for w in words] == [brute(pieces, w) for w in words]
    finally:
        tokencount.DEPTH = depth


def test_one_long_word_makes_few_nodes(pieces):
    trie = tokencount.Trie(pieces)
    word = "ab" * 200_000
    assert trie.tokens(word) > 50_000 and len(trie.score) <= tokencount.DEPTH + 1


def test_counts_beyond_the_cache(pieces, monkeypatch):
    monkeypatch.setattr(tokencount, "CACHE_WORDS", 2)
    counts = tokencount.WordCounts(pieces)
    words = ["hello", "world", "x" * 400, "hello", "help", "été"]
    for _ in range(2):
        assert counts.of(words).tolist() == [tokencount.Trie(pieces).tokens(w) for w in words]
    assert len(counts.known) == 2
