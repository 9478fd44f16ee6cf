"""Token ids in wavelet-matrix shards.

Documents are range-partitioned and sorted by id, encoded, and cut into shards of about ``SHARD_TOKENS`` tokens. A
shard is one file image: a header, the documents' ids and lengths, and the bit-planes of the
tokens, each plane stably split by the one above it. Blocks are compressed one by one; rank directories are one
popcount pass over a plane and are rebuilt on opening. Images are written one to a Parquet file, which keeps them
on whatever store the cluster shares.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermill.llm.textops import chunks, distinct_words, spread
from ledgermill.session import run_dir

MAGIC = b"WMX1"
SHARD_TOKENS = 1 << 22
END_ID = 1
CACHE_WORDS = 500_000
CHUNK = 8 << 20  # larger chunks have fewer distinct words in all
TOGETHER = 2000
WORD_END = "</w>"
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"  # one letter each in lower case, too
MARKS = r"!-&(-/:;=-@\[-`{-~"  # ASCII punctuation that begins no contraction and no added token
PLAIN_WORD = f"[{LETTERS}]+[{MARKS}]*"
MARK_SET = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in "'<")
HEAD = struct.Struct("<4sBQI")


@dataclass
class WaveletMatrix:
    """Bit-planes (highest bit first) of ``n`` tokens with rank and select."""

    n: int
    zeros: list[int]
    planes: list[np.ndarray]
    ranks: list[np.ndarray] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.ranks = [np.r_[0, np.cumsum(np.bitwise_count(p), dtype=np.int64)] for p in self.planes]

    @classmethod
    def build(cls, tokens: np.ndarray, bits: int) -> WaveletMatrix:
        now, planes, zeros = tokens, [], []
        for b in reversed(range(bits)):
            on = ((now >> now.dtype.type(b)) & now.dtype.type(1)).astype(bool)
            padded = np.zeros((len(now) // 64 + 1) * 8, np.uint8)
            packed = np.packbits(on, bitorder="little")
            padded[: len(packed)] = packed
            planes.append(padded.view("<u8"))
            off = now[~on]
            zeros.append(len(off))
            now = np.concatenate([off, now[on]])
        return cls(len(tokens), zeros, planes)

    def _bits(self, level: int) -> np.ndarray:
        return np.unpackbits(self.planes[level].view(np.uint8), bitorder="little", count=self.n).astype(bool)

    def decode(self) -> np.ndarray:
        """All tokens, by undoing the splits from the lowest plane up."""
        now = np.zeros(self.n, np.uint32)
        for level in reversed(range(len(self.planes))):
            on, back = self._bits(level), np.empty(self.n, np.uint32)
            back[~on] = now[: self.zeros[level]]
            back[on] = now[self.zeros[level] :] | np.uint32(1 << (len(self.planes) - 1 - level))
            now = back
        return now

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word, rest = at >> 6, (at & 63).astype(np.uint64)
        mask = (np.uint64(1) << rest) - np.uint64(1)
        return self.ranks[level][word] + np.bitwise_count(self.planes[level][word] & mask).astype(np.int64)

    def access(self, at: np.ndarray) -> np.ndarray:
        at, out = np.asarray(at, np.int64), np.zeros(len(at), np.uint32)
        for level, plane in enumerate(self.planes):
            on = (plane[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            ones = self._ones(level, at)
            at = np.where(on, self.zeros[level] + ones, at - ones)
            out = (out << np.uint32(1)) | on.astype(np.uint32)
        return out

    def _span(self, token: int, upto: int) -> tuple[int, int]:
        """Where the occurrences of ``token`` before ``upto`` stand below the lowest plane."""
        if token >> len(self.planes):
            return 0, 0
        span = np.array([0, upto], np.int64)
        for level in range(len(self.planes)):
            ones = self._ones(level, span)
            high = token >> (len(self.planes) - 1 - level) & 1
            span = self.zeros[level] + ones if high else span - ones
        return int(span[0]), int(span[1])

    def rank(self, token: int, upto: int) -> int:
        """Occurrences before position ``upto``."""
        low, high = self._span(token, upto)
        return high - low

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def _select(self, level: int, k: np.ndarray, one: bool) -> np.ndarray:
        """Positions of the ``k``-th ones or zeros of a plane."""
        plane, before = self.planes[level], self.ranks[level]
        if not one:
            plane, before = ~plane, np.arange(len(before), dtype=np.int64) * 64 - before
        word = np.searchsorted(before, k, side="right") - 1
        bits = np.unpackbits(plane[word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        inside = (np.cumsum(bits, axis=1) > (k - before[word])[:, None]).argmax(axis=1)
        return word * 64 + inside

    def occurrences(self, token: int) -> np.ndarray:
        """Positions of a token, ascending."""
        low, high = self._span(token, self.n)
        at = np.arange(low, high, dtype=np.int64)
        for level in reversed(range(len(self.planes))) if len(at) else ():
            one = bool(token >> (len(self.planes) - 1 - level) & 1)
            at = self._select(level, at - self.zeros[level] if one else at, one)
        return at

    def select(self, token: int, k: int) -> int:
        """Position of the occurrence with ``k`` before it."""
        return int(self.occurrences(token)[k])


@dataclass
class Shard:
    """Documents' ids (None for NULL) and lengths, and their tokens end to end."""

    doc_ids: list[int | None]
    lengths: np.ndarray
    tokens: WaveletMatrix

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.lengths) - self.lengths

    def document(self, k: int) -> np.ndarray:
        start = int(self.starts[k])
        return self.tokens.access(np.arange(start, start + int(self.lengths[k])))


def pack(doc_ids: list[int | None], lengths: list[int], tokens: np.ndarray, bits: int) -> bytes:
    """The file image of a shard."""
    matrix = WaveletMatrix.build(tokens, bits)
    blocks = [
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        np.array(lengths, "<u8").tobytes(),
        np.array(matrix.zeros, "<u8").tobytes(),
        *[p.tobytes() for p in matrix.planes],
    ]
    small = [zlib.compress(b, 1) for b in blocks]
    sizes = struct.pack(f"<{len(small)}Q", *map(len, small))
    return HEAD.pack(MAGIC, bits, len(tokens), len(doc_ids)) + sizes + b"".join(small)


def unpack(image: bytes) -> Shard:
    magic, bits, n, _ = HEAD.unpack_from(image)
    if magic != MAGIC:
        raise ValueError("not a token shard")
    sizes = struct.unpack_from(f"<{4 + bits}Q", image, HEAD.size)
    at, blocks = HEAD.size + 8 * len(sizes), []
    for size in sizes:
        blocks.append(zlib.decompress(image[at : at + size]))
        at += size
    ids, void, lengths, zeros = np.frombuffer(blocks[0], "<i8"), blocks[1], np.frombuffer(blocks[2], "<u8"), np.frombuffer(blocks[3], "<u8")
    planes = [np.frombuffer(b, "<u8") for b in blocks[4:]]
    names = [None if v else int(d) for d, v in zip(ids, void)]
    return Shard(names, lengths.astype(np.int64), WaveletMatrix(n, [int(z) for z in zeros], planes))


class WordIds:
    """Ids of white-space separated words; the first ``CACHE_WORDS`` are kept from batch to batch.

    The tokenizer drops white space and joins nothing across it, so a text's ids are those of its words. It also lower-cases,
    and parts letters from marks: a plain word (letters, then perhaps marks) has the ids of its letters in lower
    case and then those of its marks. All other words, those that hold an added token among them, are encoded as they stand.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.bits = max(len(vocabulary) - 1, *vocabulary.values(), END_ID).bit_length()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.place: dict[str, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.ends = np.zeros(1, np.int64)

    def _apart(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.fromiter((i for x in found for i in x), np.uint32), np.array([len(x) for x in found], np.int64)

    def _together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of letters as one text, which is several times faster; each of them closes with one marked token."""
        texts = [" ".join(words[i : i + TOGETHER]) for i in range(0, len(words), TOGETHER)]
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            return self._apart(words)
        return ids, np.diff(ends, prepend=0)

    def _encoded(self, words: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words end to end, and how many each has; ``letters`` marks words of letters only."""
        parts = [(keep, make([w for w, k in zip(words, keep) if k])) for keep, make in ((letters, self._together), (~letters, self._apart)) if keep.any()]
        counts = np.zeros(len(words), np.int64)
        for keep, (_, n) in parts:
            counts[keep] = n
        flat = np.empty(int(counts.sum()), np.uint32)
        at = np.cumsum(counts) - counts
        for keep, (ids, n) in parts:
            flat[spread(at[keep], n)] = ids
        return flat, counts

    def _looked_up(self, words: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of kept and new words end to end, their ends, and the spot of each word."""
        spots = np.fromiter((self.place.get(w, -1) for w in words), np.int64, len(words))
        missing = np.flatnonzero(spots < 0)
        if not len(missing):
            return self.flat, self.ends, spots
        spots[missing] = len(self.place) + np.arange(len(missing))
        new = [words[i] for i in missing]
        ids, counts = self._encoded(new, letters[missing])
        flat = np.concatenate([self.flat, ids])
        ends = np.concatenate([self.ends, len(self.flat) + np.cumsum(counts)])
        room = CACHE_WORDS - len(self.place)
        if room > 0:
            self.place.update(zip(new[:room], range(len(self.place), len(self.place) + room)))
            self.ends = ends[: len(self.place) + 1].copy()
            self.flat = flat[: self.ends[-1]].copy()
        return flat, ends, spots

    def _parts(self, words: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct parts of the words, which of them are letters only, and the part that begins and ends each word (-1: none)."""
        plain = pc.match_substring_regex(words, f"^{PLAIN_WORD}$")
        letters = pc.utf8_lower(pc.utf8_rtrim(words.filter(plain), MARK_SET))
        size = pc.utf8_length(letters)
        whole = words.filter(plain)
        marked = pc.greater(pc.utf8_length(whole), size)
        marks = pc.replace_substring_regex(whole.filter(marked), f"^[{LETTERS}]+", "")
        others = words.filter(pc.invert(plain))
        found = pa.concat_arrays([letters.cast(pa.string()), marks.cast(pa.string()), others.cast(pa.string())]).dictionary_encode()
        codes = found.indices.to_numpy()
        is_plain, has_marks = plain.to_numpy(zero_copy_only=False), marked.to_numpy(zero_copy_only=False)
        first, last = np.full(len(words), -1, np.int64), np.full(len(words), -1, np.int64)
        at = np.flatnonzero(is_plain)
        first[at] = codes[: len(letters)]
        last[at[has_marks]] = codes[len(letters) : len(letters) + len(marks)]
        first[~is_plain] = codes[len(letters) + len(marks) :]
        only_letters = np.zeros(len(found.dictionary), bool)
        only_letters[codes[: len(letters)]] = True
        return found.dictionary, only_letters, first, last

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each text has."""
        codes, distinct, before = distinct_words(texts)
        parts, letters, first, last = self._parts(distinct)
        flat, ends, spots = self._looked_up(parts.to_pylist(), letters)
        starts, lengths = ends[spots], ends[spots + 1] - ends[spots]
        # the parts' ids in the order of words, and from there to texts
        both = np.stack([first, last], axis=1).reshape(-1)
        present = both >= 0
        at, size = np.where(present, starts[both], 0), np.where(present, lengths[both], 0)
        word_ids = flat[spread(at, size)]
        word_sizes = size.reshape(-1, 2).sum(axis=1)
        word_starts = np.cumsum(word_sizes) - word_sizes
        lengths = word_sizes[codes]
        total = np.concatenate([[0], np.cumsum(lengths)])
        return word_ids[spread(word_starts[codes], lengths)], np.diff(total[before])


_WORDS: dict[str, WordIds] = {}


def _known(path: str) -> WordIds:
    """One cache, bounded by ``CACHE_WORDS``, for all tasks of a worker."""
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return _WORDS[path]


SHARD_SCHEMA = "part long, seq long, first_doc long, n_docs long, n_tokens long, image binary"


def write_shards(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode every whole text (NULL: empty), an end id after each, into shard files below ``path``.

    Documents stand in ascending order of id, NULL first, equal ids by a hash of their text, so that rows of one id
    (or none) can be spread over tasks. A shard is known by its range of documents and its number in it. A document is
    never split, so a shard is larger than asked for by less than one document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seq, own = _known(tokenizer), 0, TaskContext.get().partitionId()
        ids: list[int | None] = []
        lengths: list[int] = []
        held: list[np.ndarray] = []

        def image() -> pa.RecordBatch:
            tokens = np.concatenate(held)
            cells = [[own], [seq], [ids[0]], [len(ids)], [len(tokens)], [pack(ids, lengths, tokens, words.bits)]]
            types = [pa.int64()] * 5 + [pa.binary()]
            names = ["part", "seq", "first_doc", "n_docs", "n_tokens", "image"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, types)], names)

        total = 0
        for batch in batches:
            for part in chunks(batch, "text", CHUNK):
                flat, counts = words.encode(part.column("text"))
                ends = np.cumsum(counts)
                with_end = np.insert(flat, ends, END_ID).astype(np.uint16 if words.bits <= 16 else np.uint32)
                counts, stops = counts + 1, np.cumsum(counts + 1)
                names, done = part.column("doc_id").to_pylist(), 0
                while done < len(names):
                    base = int(stops[done - 1]) if done else 0
                    room = max(shard_tokens - total, 1)
                    upto = min(int(np.searchsorted(stops, base + room, side="left")) + 1, len(names))
                    held.append(with_end[base : int(stops[upto - 1])])
                    total += len(held[-1])
                    ids += names[done:upto]
                    lengths += counts[done:upto].tolist()
                    done = upto
                    if total >= shard_tokens:
                        yield image()
                        ids, lengths, held, total, seq = [], [], [], 0, seq + 1
        if ids:
            yield image()

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    ordered = slim.repartitionByRange(*order).sortWithinPartitions(*order)
    shards = ordered.mapInArrow(run, SHARD_SCHEMA)
    shards.write.option("maxRecordsPerFile", 1).option("compression", "none").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the shard files below ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                shard = unpack(batch.column("image")[k].as_py())
                data = shard.tokens.decode().astype("<u4").tobytes()
                starts = shard.starts
                sums = [zlib.crc32(data[4 * a : 4 * (a + n)]) for a, n in zip(starts.tolist(), shard.lengths.tolist())]
                n = len(sums)
                columns = [
                    pa.array([batch.column("part")[k].as_py()] * n, pa.int64()),
                    pa.array([batch.column("seq")[k].as_py()] * n, pa.int64()),
                    pa.array(shard.doc_ids, pa.int64()),
                    pa.array(starts),
                    pa.array(shard.lengths),
                    pa.array(sums, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["part", "seq", "doc_id", "inside", "n_tokens", "ids_crc32"])

    files = spark.read.parquet(path)
    order = Window.partitionBy().orderBy("part", "seq")  # one small row for each shard of millions of tokens
    before = F.coalesce(F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = files.select("part", "seq", "n_tokens").withColumn("before", before).drop("n_tokens")
    rows = files.select("part", "seq", "image").mapInArrow(run, "part long, seq long, doc_id long, inside long, n_tokens long, ids_crc32 long")
    joined = rows.join(shards, ["part", "seq"])
    return joined.select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoded(docs: DataFrame, tokenizer: str | None = None, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write shards of ``docs`` below ``path`` (a new shared folder) and return the documents read back from them.

    Repeated rows are encoded each; an empty table writes no shard and gives no row.
    """
    spark = docs.sparkSession
    path = path or run_dir(spark, "shards")
    write_shards(docs, path, tokenizer or tokenizer_path(), id_col, text_col, shard_tokens)
    return read_documents(spark, path)
