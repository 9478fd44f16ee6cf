"""Periodic runs of words by seeds and diagonals.

A run of period q has its words equal to those q further on: a diagonal of lag q. Runs are at least 24 words and three
periods long, so a diagonal covers at least ``overlap`` words, which grows with q. Lags are taken in classes
from q to 2q; in each class, k-grams of half the overlap at every ``k + 1``-th word are the seeds, one of which
lies whole on every diagonal. Seeds are indexed by hash, the k-grams one lag of the class further on are looked
up, and each pair found is extended over its diagonal to both sides. For each lag the furthest word covered is kept, and pairs
before it are skipped; so are pairs that lie whole in a run of a smaller period, as the period of such a pair is a
multiple. Classes see at most as many pairs as there are words, whatever repeats: nothing grows with the square of a text.

A document is one row and its runs concern no other: nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.textops import chunks, distinct_words, respaced, space_words, spread, text_bytes

LEAST = 24
REPEATS = 3
CHUNK = 4 << 20
BLOCK = 1 << 20
FILTER_BITS = 20
COLUMNS = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"

Runs = list[tuple[int, int, int]]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def lag_classes(longest: int) -> list[tuple[int, int, int]]:
    """``(least lag, lag beyond the last, k)`` for texts of at most ``longest`` words.

    A run with a lag of the class has at least 2k equal words on its diagonal: 16 below lag 16 (at lag 8), else
    twice the lag. So it holds k + 1 seeds' starts side by side.
    """
    low = 2 * LEAST // REPEATS
    classes = [(1, low, LEAST // REPEATS)]
    while REPEATS * low <= longest:
        classes.append((low, 2 * low, low))
        low *= 2
    return classes


def _equal_words(a: np.ndarray, b: np.ndarray) -> int:
    """Number of leading places at which two arrays are equal."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        differ = a[at : min(at + step, n)] != b[at : min(at + step, n)]
        first = int(differ.argmax())
        if differ[first]:
            return at + first
        at += step
        step *= 2
    return n


class _Seeds:
    """Hash index of the k-grams at every ``k + 1``-th word of the documents."""

    def __init__(self, grams: np.ndarray, firsts: np.ndarray, lasts: np.ndarray, k: int):
        counts = np.maximum((lasts - k - firsts) // (k + 1) + 1, 0)
        at = firsts.repeat(counts) + (np.arange(counts.sum()) - (np.cumsum(counts) - counts).repeat(counts)) * (k + 1)
        self.hashes, codes = np.unique(grams[at], return_inverse=True)
        self.size = len(grams) + 1
        self.keys = np.sort(codes * self.size + at)
        self.known = np.zeros(1 << FILTER_BITS, bool)
        self.known[self.hashes.astype(np.int64) & ((1 << FILTER_BITS) - 1)] = True

    def pairs(self, grams: np.ndarray, at: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Seed and lag of each k-gram at ``at`` that equals a seed ``low`` to ``high - 1`` words before it."""
        at = at[self.known[grams[at].astype(np.int64) & ((1 << FILTER_BITS) - 1)]]
        if not len(at) or not len(self.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        code = np.minimum(np.searchsorted(self.hashes, grams[at]), len(self.hashes) - 1)
        same = self.hashes[code] == grams[at]
        at, code = at[same], code[same]
        first = np.searchsorted(self.keys, code * self.size + np.maximum(at - high + 1, 0))
        last = np.searchsorted(self.keys, code * self.size + at - low, side="right")
        n = np.maximum(last - first, 0)
        seeds = self.keys[spread(first, n)] % self.size
        return seeds, at.repeat(n) - seeds


def find_runs(codes: np.ndarray, offsets: np.ndarray) -> Runs:
    """``(start, length, period)`` of all runs of documents laid end to end, by start and period.

    ``codes`` are the words' numbers; document d has words ``offsets[d]`` to ``offsets[d + 1] - 1``.
    """
    sizes = np.diff(offsets)
    if not len(codes) or sizes.max() < LEAST:
        return []
    grams, width = _mixed(codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), 1
    ends = np.zeros(0, np.int64)  # of the runs known, by start: the furthest end so far
    starts = ends
    found: Runs = []
    for low, high, k in lag_classes(int(sizes.max())):
        while width < k:
            grams = _mixed(grams[: len(grams) - width] * np.uint64(0x9E3779B97F4A7C15) + grams[width:])
            width *= 2
        long = np.flatnonzero(sizes >= max(LEAST, REPEATS * low))
        firsts, lasts = offsets[long], offsets[long + 1]
        seeds = _Seeds(grams, firsts, lasts, k)
        probes = np.maximum(lasts - k - firsts - low + 1, 0)
        covered: dict[int, int] = {}
        heads = np.cumsum(probes) - probes
        total = int(probes.sum())
        for block in range(0, total, BLOCK):
            until = min(block + BLOCK, total)
            a, b = np.searchsorted(heads, block, side="right") - 1, np.searchsorted(heads, until - 1, side="right")
            begin = np.maximum(heads[a:b], block)
            count = np.minimum(heads[a:b] + probes[a:b], until) - begin
            at = spread(firsts[a:b] + low + begin - heads[a:b], np.maximum(count, 0))
            seed, lag = seeds.pairs(grams, at, low, high)
            same = np.searchsorted(offsets, seed, side="right") == np.searchsorted(offsets, seed + lag, side="right")
            if len(starts):
                inside = np.searchsorted(starts, seed, side="right")
                same &= (inside == 0) | (ends[inside - 1] < seed + lag + k)
            seed, lag = seed[same], lag[same]
            order = np.lexsort((seed, lag))
            seed, lag = seed[order], lag[order]
            cuts = np.flatnonzero(np.diff(lag)) + 1
            for group in np.split(np.arange(len(lag)), cuts) if len(lag) else ():
                q, mine = int(lag[group[0]]), seed[group]
                place = 0
                while place < len(mine):
                    i, before = int(mine[place]), covered.get(q, 0)
                    if i < before:
                        place = int(np.searchsorted(mine, before))
                        continue
                    d = int(np.searchsorted(offsets, i, side="right")) - 1
                    head, tail = int(offsets[d]), int(offsets[d + 1])
                    right = i + _equal_words(codes[i : tail - q], codes[i + q : tail])
                    left = i - _equal_words(codes[head:i][::-1], codes[head + q : i + q][::-1])
                    covered[q] = max(right, i + 1)
                    if right + q - left >= max(LEAST, REPEATS * q):
                        found.append((left, right + q - left, q))
                    place += 1
        if found:
            known = np.array(sorted({(s, s + n) for s, n, _ in found}), np.int64)
            starts, ends = known[:, 0], np.maximum.accumulate(known[:, 1])
    least: dict[tuple[int, int], int] = {}
    for s, n, q in found:  # a stretch with a smaller period is found with that, too
        least[s, n] = min(least.get((s, n), q), q)
    return sorted((s, n, q) for (s, n), q in least.items())


def planted_order(n: int, doc_id: int) -> np.ndarray | None:
    """Places of the words of a text of n words whose end repeats, for one in ten ids; None for the others."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def _sha_of_words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> str:
    sha = hashlib.sha256()
    for i in range(0, len(starts), BLOCK // 4):
        if i:
            sha.update(b" ")
        data, _, _ = respaced(raw, starts[i : i + BLOCK // 4], ends[i : i + BLOCK // 4])
        sha.update(data[:-1].tobytes())
    return sha.hexdigest()


def _best(runs: Runs) -> tuple[int, int, int] | None:
    best = None
    for run in runs:  # by start and period, so that ties keep the first
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def runs_of_batch(ids: pa.Array, texts: pa.Array, planted: bool) -> list[list]:
    """The columns of ``COLUMNS`` for some rows."""
    codes, _, before = distinct_words(texts)
    raw, offsets = text_bytes(texts)
    starts, ends, _ = space_words(raw, offsets)
    names = ids.to_pylist()
    if planted:
        codes, starts, ends = codes.copy(), starts.copy(), ends.copy()
        for d, name in enumerate(names):
            places = None if name is None else planted_order(int(before[d + 1] - before[d]), name)
            if places is not None:
                own = slice(before[d], before[d + 1])
                codes[own], starts[own], ends[own] = codes[own][places], starts[own][places], ends[own][places]
    runs = find_runs(codes, before)
    gone = np.zeros(len(codes) + 1, np.int64)
    for s, n, q in runs:
        gone[s + q] += 1
        gone[s + n] -= 1
    kept = np.cumsum(gone)[:-1] == 0
    first_run = np.searchsorted(np.array([r[0] for r in runs], np.int64), before)
    out: list[list] = [[] for _ in range(8)]
    for d, name in enumerate(names):
        at, to = int(before[d]), int(before[d + 1])
        own = [(s - at, n, q) for s, n, q in runs[first_run[d] : first_run[d + 1]]]
        best = _best(own)
        left = slice(at, to) if not own else at + np.flatnonzero(kept[at:to])
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in own)
        row = [name, len(own), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None]
        row += [hashlib.sha256(listed.encode()).hexdigest(), _sha_of_words(raw, starts[left], ends[left])]
        for column, value in zip(out, row):
            column.append(value)
    return out


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", planted: bool = False) -> DataFrame:
    """``doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256`` of every row's whole text.

    A run is a stretch of words with smallest period q, at least 24 words and 3q long, that no neighbour extends. The columns in
    the middle describe the run of the greatest exponent (ties: the first, then the smaller period), and are NULL without one.
    ``runs_sha256`` is of all runs, ``collapsed_sha256`` of the text of which each run leaves its first period. With
    ``planted``, the ends of a tenth of the texts are made periodic first (a NULL id is not of these). NULL,
    empty and blank texts have no words and no run; repeated rows get equal results; an empty table gives no
    row. Only the two named columns are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", CHUNK):
                columns = runs_of_batch(part.column("doc_id"), part.column("text"), planted)
                kinds = [pa.int64()] * 6 + [pa.string()] * 2
                names = [c.split()[0] for c in COLUMNS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, COLUMNS)


def collapsed(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with texts in which each run leaves its first period; others stay as they are, NULL included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text, CHUNK):
                texts = part.column(text)
                codes, _, before = distinct_words(texts)
                changed = texts.to_pylist()
                runs = find_runs(codes, before)
                gone = np.zeros(len(codes) + 1, np.int64)
                for s, n, q in runs:
                    gone[s + q] += 1
                    gone[s + n] -= 1
                kept = np.cumsum(gone)[:-1] == 0
                for d in {int(np.searchsorted(before, s, side="right")) - 1 for s, _, _ in runs}:
                    words = changed[d].encode().split()
                    changed[d] = b" ".join(w for w, k in zip(words, kept[before[d] : before[d + 1]]) if k).decode()
                yield part.set_column(place, part.schema.field(place), pa.array(changed, texts.type))

    place = docs.columns.index(text_col)
    text = f"c{place}"
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # names may hold dots
    return numbered.mapInArrow(run, numbered.schema).toDF(*docs.columns)
