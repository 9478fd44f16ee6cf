"""Vectorised text primitives that run inside Arrow-batched tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 4 << 20

# The five primes of XXH64.
P1 = np.uint64(0x9E3779B185EBCA87)
P2 = np.uint64(0xC2B2AE3D27D4EB4F)
P3 = np.uint64(0x165667B19E3779F9)
P4 = np.uint64(0x85EBCA77C2B2AE63)
P5 = np.uint64(0x27D4EB2F165667C5)


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of a batch whose text has about ``limit`` bytes; a longer text gets a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        base = ends[start] - sizes[start]
        stop = max(int(np.searchsorted(ends, base + limit, side="right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and ``n + 1`` offsets; NULL counts as empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def space_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words between ASCII white space: start and end of each, and words before each text (``n + 1``)."""
    n = len(raw)
    edge = np.ones(n + 1, dtype=bool)
    edge[:n] = (raw == 32) | ((raw >= 9) & (raw <= 13))
    word = ~edge[:n]
    first = word.copy()
    first[1:] &= edge[: n - 1] if n else False
    inner = offsets[(offsets > 0) & (offsets < n)]
    first[inner] = word[inner]
    last = word & edge[1:]
    ends_here = inner - 1
    last[ends_here] |= word[ends_here]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets, side="left")


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    return raw + np.where((raw >= 65) & (raw <= 90), np.uint8(32), np.uint8(0))


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` for each range, end to end."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total, dtype=np.int64)


def respaced(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words with one space after each: bytes, and the words' new starts and ends."""
    lengths = ends - starts
    at = np.cumsum(lengths + 1) - lengths - 1
    out = np.full(int((lengths + 1).sum()), 32, dtype=np.uint8)
    out[spread(at, lengths)] = raw[spread(starts, lengths)]
    return out, at, at + lengths


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * P2, 31) * P1


def xxh64(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of each byte range ``raw[start:end]``, for all ranges at once."""
    raw = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,))
    four = np.ndarray((len(raw) - 7,), dtype="<u4", buffer=raw, strides=(1,))
    at, left = starts.astype(np.int64), (ends - starts).astype(np.int64)
    seed = np.uint64(seed)
    with np.errstate(over="ignore"):
        acc = np.full(len(at), seed + P5, dtype=np.uint64)
        long = np.flatnonzero(left >= 32)
        if len(long):
            pos, rest = at[long].copy(), left[long].copy()
            lanes = np.empty((4, len(long)), np.uint64)
            for k, v in enumerate((seed + P1 + P2, seed + P2, seed, seed - P1)):
                lanes[k] = v
            live = np.arange(len(long))
            while len(live):
                here = pos[live]
                for k in range(4):
                    lanes[k, live] = _round(lanes[k, live], eight[here + 8 * k])
                pos[live] += 32
                rest[live] -= 32
                live = live[rest[live] >= 32]
            mixed = _rotl(lanes[0], 1) + _rotl(lanes[1], 7) + _rotl(lanes[2], 12) + _rotl(lanes[3], 18)
            for k in range(4):
                mixed = (mixed ^ _round(np.zeros_like(mixed), lanes[k])) * P1 + P4
            acc[long] = mixed
            at, left = at.copy(), left.copy()
            acc += (ends - starts).astype(np.uint64)
            at[long], left[long] = pos, rest
        else:
            acc += left.astype(np.uint64)
            at, left = at.copy(), left.copy()
        for _ in range(3):
            now = np.flatnonzero(left >= 8)
            if not len(now):
                break
            acc[now] = _rotl(acc[now] ^ _round(np.uint64(0), eight[at[now]]), 27) * P1 + P4
            at[now] += 8
            left[now] -= 8
        now = np.flatnonzero(left >= 4)
        if len(now):
            acc[now] = _rotl(acc[now] ^ four[at[now]].astype(np.uint64) * P1, 23) * P2 + P3
            at[now] += 4
            left[now] -= 4
        for _ in range(3):
            now = np.flatnonzero(left >= 1)
            if not len(now):
                break
            acc[now] = _rotl(acc[now] ^ raw[at[now]].astype(np.uint64) * P5, 11) * P1
            at[now] += 1
            left[now] -= 1
        acc ^= acc >> np.uint64(33)
        acc *= P2
        acc ^= acc >> np.uint64(29)
        acc *= P3
        acc ^= acc >> np.uint64(32)
    return acc


def distinct_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words between ASCII white space: code of each word, the distinct words, words before each text (``n + 1``)."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    lengths = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    flat = parts.flatten()
    filled = pc.not_equal(flat, "")  # an empty text or white space at an end gives an empty piece
    keep = filled.to_numpy(zero_copy_only=False)
    owners = np.repeat(np.arange(len(lengths)), lengths)[keep]
    found = flat.filter(filled).dictionary_encode()
    before = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(np.bincount(owners, minlength=len(lengths)), out=before[1:])
    return found.indices.to_numpy(zero_copy_only=False), found.dictionary, before
