"""Token counts by dynamic programming over a trie of pre-tokens.

A pre-token is a word between white space with the vocabulary's word mark before it. Distinct
pre-tokens are inserted into a trie. A node holds the best unigram score of its prefix and the pieces that it takes; both
come from nodes above, so a prefix shared by many words is scored once. The node where a word ends has
its count.

The vocabulary's pieces are ordered by use and have no probabilities; a piece of rank r weighs ``-ln(r + 2)``, kept as a
whole number, so equal scores are equal everywhere and go to fewer pieces. A character outside the
vocabulary takes one token for each of its UTF-8 bytes.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.textops import chunks, distinct_words

MARK = "▁"
SCALE = 1 << 20
BYTE_RANK = 1_000_000
MAX_NODES = 250_000
DEPTH = 256  # characters of a word that become nodes; beyond, the last scores are kept in place of nodes
CACHE_WORDS = 500_000
CHUNK = 8 << 20


def load_pieces(path: str) -> dict[str, int]:
    """Scaled scores of a vocabulary's ordinary pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    return scored([model.id_to_piece(i) for i in range(model.get_piece_size()) if not any(test(i) for test in special)])


def scored(names: list[str]) -> dict[str, int]:
    return {name: -round(math.log(rank + 2) * SCALE) for rank, name in enumerate(names)}


class Trie:
    """Prefixes of the words seen; it starts anew beyond ``MAX_NODES`` nodes, which costs time only."""

    def __init__(self, pieces: dict[str, int]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        self.byte = -round(math.log(BYTE_RANK) * SCALE)
        self.clear()

    def clear(self) -> None:
        self.below: list[dict[str, int]] = [{}]
        self.score = [0]
        self.count = [0]

    def _grow(self, parent: int, path: list[int], prefix: str) -> int:
        """A node for ``prefix``; ``path`` holds the nodes above it, from the root to ``parent``."""
        n = len(prefix)
        size = len(prefix[-1].encode("utf-8"))
        best, fewest = self.score[parent] + size * self.byte, self.count[parent] + size
        for length in range(1, min(self.longest, n) + 1):
            piece = self.pieces.get(prefix[n - length :])
            if piece is not None:
                before = path[n - length]
                score, count = self.score[before] + piece, self.count[before] + 1
                if score > best or score == best and count < fewest:
                    best, fewest = score, count
        node = len(self.score)
        self.below[parent][prefix[-1]] = node
        self.below.append({})
        self.score.append(best)
        self.count.append(fewest)
        return node

    def tokens(self, word: str) -> int:
        """Pieces of the best segmentation of a word."""
        if len(self.score) > MAX_NODES:
            self.clear()
        marked, path = MARK + word, [0]
        for i, c in enumerate(marked[:DEPTH]):
            node = self.below[path[-1]].get(c)
            if node is None:
                start = max(0, i + 1 - self.longest)
                node = self._grow(path[-1], path[start:], marked[start : i + 1])
            path.append(node)
        return self.count[path[-1]] if len(marked) <= DEPTH else self._rest(marked, path)

    def _rest(self, marked: str, path: list[int]) -> int:
        """The same scores for the characters beyond ``DEPTH``, of which only the last ``longest`` are kept."""
        scores = deque((self.score[n] for n in path), self.longest)
        counts = deque((self.count[n] for n in path), self.longest)
        for i in range(DEPTH, len(marked)):
            size = len(marked[i].encode("utf-8"))
            best, fewest = scores[-1] + size * self.byte, counts[-1] + size
            for length in range(1, len(scores) + 1):
                piece = self.pieces.get(marked[i + 1 - length : i + 1])
                if piece is not None:
                    score, count = scores[-length] + piece, counts[-length] + 1
                    if score > best or score == best and count < fewest:
                        best, fewest = score, count
            scores.append(best)
            counts.append(fewest)
        return counts[-1]


class WordCounts:
    """Token counts of words by one trie; the first ``CACHE_WORDS`` of them are kept from batch to batch."""

    def __init__(self, pieces: dict[str, int]):
        self.trie = Trie(pieces)
        self.known: dict[str, int] = {}

    def of(self, words: list[str]) -> np.ndarray:
        counts = np.fromiter((self.known.get(w, -1) for w in words), np.int64, len(words))
        # in order, so that the nodes of a prefix are made and met together
        new = sorted((words[i], i) for i in np.flatnonzero(counts < 0))
        for word, i in new:
            counts[i] = self.trie.tokens(word)
        room = CACHE_WORDS - len(self.known)
        short = [(w, int(counts[i])) for w, i in new if len(w) <= DEPTH]
        self.known.update(short[: max(room, 0)])
        return counts


_COUNTS: dict[str, WordCounts] = {}


def _known(model: str) -> WordCounts:
    """One trie and cache, both bounded, for all tasks of a worker."""
    if model not in _COUNTS:
        _COUNTS[model] = WordCounts(load_pieces(model))
    return _COUNTS[model]


def count_tokens(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_tokens`` of every row's whole text.

    NULL, empty and blank texts have none; repeated rows are counted each; an empty table gives no
    row. Only the two named columns are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _known(model)
        for batch in batches:
            for part in chunks(batch, "text", CHUNK):
                codes, words, before = distinct_words(part.column("text"))
                total = np.r_[0, np.cumsum(counts.of(words.to_pylist())[codes])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(before)), pa.array(np.diff(total[before]).astype(np.int64))], ["doc_id", "n_words", "n_tokens"]
                )

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_words long, n_tokens long")


def vocabulary_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
