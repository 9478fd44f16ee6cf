"""Spelling variants, found through one-edit neighbourhoods over a reduced alphabet.

Letters are hashed to ``SYMBOLS`` symbols, so that the full one-edit neighbourhood of a word has some tens of
members instead of hundreds. Members are joined with the reduced vocabulary, and what meets is compared in its
original spelling. A pair one edit apart is generated once: the longer word deletes (what the shorter one would
insert), the word with the lower symbol raises it (what the other would lower), and words that
are equal after the reduction meet as they are. So no pair is missed and none comes twice. Words above ``LONG_WORD``
letters, whose neighbourhoods would grow without bound, meet by their first or last ``END`` letters instead.

Vocabulary and neighbourhoods are tables that Spark shuffles by hash; nothing is gathered in one task, and a word that
fills a third of the corpus is one row before the first shuffle of words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.textops import chunks, lower_ascii, spread, text_bytes
from ledgermill.session import settle

SYMBOLS = 8
LEAST_LETTERS = 7
LEAST_COUNT = 2
RATIO = 10
CHUNK = 8 << 20
LONG_RUN = 64
LONG_WORD = 64
END = 31
WORDS_AT_ONCE = 20_000
JUMPS = 5

BASE = 0x9E3779B97F4A7C15
MIX = np.uint64(0xFF51AFD7ED558CCD)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


CRC = _crc_table()


def letter_runs(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and owner of the maximal runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8 texts laid end to end."""
    n = len(raw)
    upper = raw & 0xDF
    letter = (upper >= 65) & (upper <= 90)
    lead = raw == 0xC3  # two bytes, and U+00C0 to U+00FF are all that it leads
    letter |= lead
    letter[1:] |= lead[:-1]
    edge = np.zeros(n + 1, bool)
    edge[0], edge[-1] = True, True
    edge[1:-1] = letter[1:] != letter[:-1]
    edge[offsets] = True
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    real = letter[starts] if n else np.zeros(0, bool)
    starts, ends = starts[real], ends[real]
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def crc32s(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of each byte range, continuing the checksums ``before``."""
    crc = before.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    many = np.searchsorted(-lengths[order], -np.arange(min(int(lengths.max(initial=0)), LONG_RUN)), side="left")
    at, work = starts[order], crc[order]
    for step, live in enumerate(many):
        work[:live] = CRC[(work[:live] ^ raw[at[:live] + step]) & 0xFF] ^ (work[:live] >> np.uint32(8))
    crc[order] = work
    crc ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(lengths > LONG_RUN):
        crc[i] = zlib.crc32(raw[starts[i] : ends[i]].tobytes(), int(before[i]))
    return crc


def _shortened(raw: np.ndarray, start: int, end: int, crc: int) -> str:
    word = raw[start:end].tobytes().decode("utf-8")
    at = crc % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(ids: pa.Array, texts: pa.Array, least: int, every: int | None) -> pa.RecordBatch:
    """Distinct words of at least ``least`` letters and their number in these texts."""
    raw, offsets = text_bytes(texts)
    raw = lower_ascii(raw)
    starts, ends, owner = letter_runs(raw, offsets)
    wide = np.concatenate([[0], np.cumsum(raw == 0xC3)])
    letters = ends - starts - (wide[ends] - wide[starts])
    enough = letters >= least
    starts, ends, owner, letters = starts[enough], ends[enough], owner[enough], letters[enough]
    cut: list[str] = []
    if every:
        names = ids.cast(pa.string()).fill_null("").to_pylist()
        heads = np.fromiter((zlib.crc32(f"{x}:".encode()) for x in names), np.uint32, len(names))
        crc = crc32s(raw, starts, ends, heads[owner])
        hit = crc % np.uint32(every) == 0
        long = np.flatnonzero(hit & (letters > least))
        cut = [_shortened(raw, starts[i], ends[i], int(crc[i])) for i in long]
        starts, ends = starts[~hit], ends[~hit]
    lengths = ends - starts
    at = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    data = raw[spread(starts, lengths)]
    whole = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(data)])
    counted = pc.value_counts(pa.concat_arrays([whole, pa.array(cut, pa.large_string())]))
    return pa.RecordBatch.from_arrays([counted.field(0).cast(pa.string()), counted.field(1).cast(pa.int64())], ["word", "n"])


def vocabulary(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    every: int | None = None,
) -> DataFrame:
    """``word, n`` of all words of whole texts with enough letters and occurrences.

    With ``every``, a run whose CRC-32 of ``<id>:<run>`` is divisible by it loses the letter at that number modulo its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", CHUNK):
                yield word_counts(part.column("doc_id"), part.column("text"), least_letters, every)

    slim = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text")).where("text is not null")
    counted = slim.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


def symbol_matrix(words: list[str], symbols: int) -> np.ndarray:
    """One row for each word of one length: its letters' symbols, from 1."""
    letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)
    return (letters % symbols + 1).astype(np.uint64)


def _powers(n: int) -> np.ndarray:
    out, now = np.empty(n, np.uint64), 1
    for i in range(n):
        out[i] = now
        now = now * BASE % (1 << 64)
    return out


def _finished(sums: np.ndarray, length: int) -> np.ndarray:
    sums = sums + np.uint64((length * BASE * BASE) % (1 << 64))
    mixed = (sums ^ (sums >> np.uint64(32))) * MIX
    return (mixed ^ (mixed >> np.uint64(29))).view(np.int64)


def reduced_keys(m: np.ndarray) -> np.ndarray:
    """The key of each reduced word."""
    return _finished((m * _powers(m.shape[1])).sum(1, dtype=np.uint64), m.shape[1])


def neighbourhood(m: np.ndarray, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and keys of the reduced words as they are, with one symbol raised, and with one symbol deleted."""
    n, length = m.shape
    power = _powers(length)
    terms = m * power
    sums = terms.sum(1, dtype=np.uint64)
    everyone = np.arange(n)
    yield everyone, _finished(sums, length)
    for i in range(length):
        for s in range(2, symbols + 1):
            low = np.flatnonzero(m[:, i] < s)
            yield low, _finished(sums[low] + (np.uint64(s) - m[low, i]) * power[i], length)
    after = np.concatenate([np.cumsum(terms[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1], np.zeros((n, 1), np.uint64)], axis=1)
    inverse = np.uint64(pow(BASE, -1, 1 << 64))
    for i in range(length):
        # a symbol beside its equal gives the same word again
        first = everyone if i == 0 else np.flatnonzero(m[:, i] != m[:, i - 1])
        yield first, _finished(sums[first] - after[first, i] + after[first, i + 1] * inverse, length - 1)


def _by_length(words: list[str]) -> Iterator[np.ndarray]:
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths):
        yield np.flatnonzero(lengths == length)


def keyed(words: DataFrame, symbols: int) -> DataFrame:
    """``key, word, n`` of the reduced vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("word").to_pylist()
            keys = np.zeros(len(names), np.int64)
            for at in _by_length(names):
                keys[at] = reduced_keys(symbol_matrix([names[i] for i in at], symbols))
            yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column("word"), batch.column("n")], ["key", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "key long, word string, n long")


def neighbour_keys(words: DataFrame, symbols: int) -> DataFrame:
    """``key, own, word, n``: the neighbourhood of each reduced word; ``own`` marks the key of the word itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, WORDS_AT_ONCE):
                part = batch.slice(start, WORDS_AT_ONCE)
                names = part.column("word").to_pylist()
                for at in _by_length(names):
                    m = symbol_matrix([names[i] for i in at], symbols)
                    for k, (rows, keys) in enumerate(neighbourhood(m, symbols)):
                        mine = part.take(pa.array(at[rows]))
                        own = pa.array(np.full(len(rows), k == 0))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys), own, mine.column("word"), mine.column("n")], ["key", "own", "word", "n"]
                        )

    return words.select("word", "n").mapInArrow(run, "key long, own boolean, word string, n long")


def near_pairs(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """``a, a_n, b, b_n``: each pair of words exactly one inserted, deleted or replaced letter apart, once."""
    size = F.length("word")
    short = words.where(size <= LONG_WORD)
    left = neighbour_keys(short, symbols).select("key", "own", F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = keyed(short, symbols).select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
    met = left.join(right, "key").where(~F.col("own") | (F.col("a") < F.col("b")))
    near = met.where(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n")
    return near.union(_long_pairs(words.where(size >= LONG_WORD)))


def one_edit(a: str, b: str) -> bool:
    """Whether the longer word ``b`` (or one as long) differs by exactly one letter; in one pass, whatever their length."""
    x, y = (np.frombuffer(w.encode("utf-32-le"), "<u4") for w in (a, b))
    differ = np.flatnonzero(x != y[: len(x)])
    at = int(differ[0]) if len(differ) else len(x)
    if len(x) == len(y):
        return len(differ) == 1
    return len(y) == len(x) + 1 and bool((x[at:] == y[at + 1 :]).all())


def _only_near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        near = [one_edit(a, b) for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())]
        yield batch.filter(pa.array(near, pa.bool_()))


def _long_pairs(words: DataFrame) -> DataFrame:
    """Pairs with a word above ``LONG_WORD`` letters, whose whole neighbourhood would grow with the square of its length.

    One edit leaves the first or the last ``END`` letters as they are, so words meet by these and by their length.
    """
    first, last = F.substring("word", 1, END), F.substring("word", -END, END)
    ends = F.array(F.struct(F.lit(0).alias("side"), first.alias("end")), F.struct(F.lit(1).alias("side"), last.alias("end")))
    rows = words.select("word", "n", F.length("word").alias("size"), F.inline(ends))
    left = rows.select("side", "end", F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("size").alias("own"), F.explode(F.array(F.col("size"), F.col("size") + 1)).alias("size"))
    right = rows.select("side", "end", "size", F.col("word").alias("b"), F.col("n").alias("b_n"))
    met = left.join(right, ["side", "end", "size"]).where((F.col("size") > LONG_WORD) & ((F.col("size") > F.col("own")) | (F.col("a") < F.col("b"))))
    twice = (F.col("side") == 1) & (F.substring("a", 1, END) == F.substring("b", 1, END))
    return met.where(~twice).select("a", "a_n", "b", "b_n").mapInArrow(_only_near, "a string, a_n long, b string, b_n long")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: the end of each chain of forms.

    A form occurs ten times as often as its word, so no chain of 64-bit counts has more than 20 links, and
    ``JUMPS`` rounds of pointer jumping reach every end.
    """
    now = forms.select("word", F.col("form").alias("root"))
    for _ in range(JUMPS):
        now = settle(now, "forms")
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if not now.join(further, "root", "left_semi").take(1):
            break
        now = now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return now


def spelling_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    every: int | None = None,
    symbols: int = SYMBOLS,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the corpus.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, of which only A-Z are lower-cased. A word's form is the
    most frequent word one edit away (ties: the first in code-point order) if it occurs ``ratio`` times as often, else NULL; its root is where the
    forms lead. NULL, empty and letterless texts have no word; repeated rows count each; a NULL id
    counts as an empty one; an empty table gives no row. A run of any length is one word. Only the two named columns are read.
    """
    words = settle(vocabulary(docs, id_col, text_col, least_letters, least_count, every), "words")
    pairs = near_pairs(words, symbols)
    both = F.array(
        F.struct(F.col("a").alias("word"), F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("near")).alias("best")),
        F.struct(F.col("b").alias("word"), F.struct((-F.col("a_n")).alias("less"), F.col("a").alias("near")).alias("best")),
    )
    grouped = pairs.select(F.inline(both)).groupBy("word").agg(F.count("*").alias("n_near"), F.min("best").alias("best"))
    joined = words.join(grouped, "word", "left")
    form = F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best.near"))
    known = joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form.alias("form"), F.when(form.isNotNull(), -F.col("best.less")).alias("form_n"))
    known = settle(known, "spellings")
    ends = roots(known.where("form is not null"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
