"""Near-duplicate passages through compact windows.

A text is its sequence of five-word shingles. For each of ``HASHES`` hash functions, the Cartesian tree over the
shingles' hashes is walked from the root: its node ``m`` over the range ``l..r`` stands for all subsequences that
hold ``m`` inside the range, as their least hash is that of ``m``. Ranges below ``LEAST`` shingles are not
followed, so a text has about ``2 / LEAST`` windows per shingle and hash function.

Windows of one hash function with the same shingle are a group. Equal texts are one. Each window is read again with the
``LEAST - 1`` shingles on both sides of ``m``, and compared with all earlier windows of its group that stand for themselves: one
with ``LEAST`` equal shingles in a row is joined with the first text that has them, which stands for it in this group; any other is
joined with the first of each class of near-equal windows, and with every window of other classes that has
as many shingles in common as a passage of ``LEAST`` needs (``MATCHED``). A similar passage longer than ``LEAST`` whose
changes all stand close together near its middle may hold no such stretch and is then missed.

A pair of texts is kept where aligned windows of ``ENOUGH`` hash functions overlap in ``LEAST`` shingles, or those
of one that are near-equal or where the least hash of a segment beside ``m`` is equal, too. These stretches are read again and
verified: a passage of 50 words or more counts whose shingles have a Jaccard similarity of ``SIMILARITY`` with the other text's.

A passage in a third of all texts gives one row per text, never pairs among them. Unequal windows of a group meet in one task. Up to
``MANY`` are all compared; of more, those that have one of their rarest shingles in common, which any two that can be joined have
(``likely_pairs``). So a line in many texts costs look-ups, and only windows that are much alike cost the square of their number. Groups are joined in ``PARTS`` turns by the
hash of their key, and texts are listed in as many, and tables go when the next step is written. Every group
and every text is whole in one turn, so nothing depends on their number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import chain
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.keys import components, doc_key
from ledgermill.llm.textops import chunks, lower_ascii, space_words, spread, text_bytes, xxh64
from ledgermill.operators.materialize import file_system
from ledgermill.session import settle

WORDS = 5
LEAST = 46  # shingles of 50 words
HASHES = 4
ENOUGH = 2
SLACK = 12  # shingles by which insertions may shift an alignment
GAP = 12  # shingles that edits may break in a row
SIMILARITY = 0.8
STRETCH = LEAST - WORDS  # so many equal shingles of LEAST have that similarity
REACH = 2 * LEAST - 1  # shingles around a least one that a passage of LEAST may hold
PLACES = np.arange(REACH)
SHORT = np.uint16  # the leading bits of a shingle's hash
MATCHED = 41  # of LEAST: c / (2 * LEAST - c) reaches the similarity, and some LEAST in a row of any similar passage have so many
FEW = 3  # of REACH that are equal in place where words were put in or left out beside them
SHIFT = 3
MISSED = LEAST - MATCHED + 1  # of LEAST in a row that may differ where one of two windows is shifted
MANY = 64  # windows of a group that are all compared; of more, those that have a rare shingle in common
ROWS = 1 << 15  # windows read before they are compared
BLOCK = 1 << 13  # pairs compared at once
HALF = 12  # shingles of one of two segments beside the least one; one side of it holds LEAST // 2 of the passage
KEY = ["k_id", "k_th"]
LOW = (1 << 32) - 1
PARTS = 4
SALTS = 16  # shares of the texts that repeat one text; each is verified in a task of its own
CACHED = 1 << 19  # bytes of text whose hashes a processor's cache holds
CUT_SCHEMA = "id long, h long, id1 long, h1 long, a long, low long, high long, b long, salt int, first boolean, s binary"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes of all texts, shingles before each text (``n + 1``), and words of each text."""
    raw, offsets = text_bytes(texts)
    low = lower_ascii(raw)
    starts, ends, before = space_words(low, offsets)
    words = np.diff(before)
    runs = np.maximum(words - WORDS + 1, 0)
    at = np.r_[0, np.cumsum(runs)]
    hashed = xxh64(low, starts, ends)
    n = max(len(hashed) - WORDS + 1, 0)
    with np.errstate(over="ignore"):
        rows = hashed[:n].copy()
        for k in range(1, WORDS):
            rows *= np.uint64(0x9E3779B97F4A7C15)
            rows += hashed[k : k + n]
    return mixed(rows[spread(before[:-1], runs)], 90), at, words


def mixed(values: np.ndarray, k: int) -> np.ndarray:
    """Hash function ``k`` over shingle hashes."""
    with np.errstate(over="ignore"):
        x = (values + np.uint64(2 * k + 1) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


def tree_windows(hashes: np.ndarray, at: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, ``m``, ``l`` and ``r`` of the nodes over ``least`` elements or more of every text's Cartesian tree, all trees level by level.

    ``at`` are the elements before each text (``n + 1``). Of equal least hashes the one nearest to the middle is the node, so
    the tree of a repetitive text is flat.
    """
    text, low, high = np.arange(len(at) - 1), at[:-1].astype(np.int64), at[1:].astype(np.int64) - 1
    found = [(np.zeros(0, np.int64),) * 4]
    while True:
        long = high - low + 1 >= least
        text, low, high = text[long], low[long], high[long]
        if not len(low):
            return tuple(np.concatenate(c) for c in zip(*found))
        sizes = high - low + 1
        before = np.cumsum(sizes) - sizes
        cells = hashes[spread(low, sizes)]
        hit = np.flatnonzero(cells == np.repeat(np.minimum.reduceat(cells, before), sizes))
        owner = np.searchsorted(before, hit, side="right") - 1
        place = hit - before[owner]
        if len(hit) > len(low):
            order = np.lexsort((place, np.abs(place - sizes[owner] // 2), owner))
            place = place[order[np.r_[True, np.diff(owner[order]) > 0]]]
        m = low + place
        found.append((text, m, low, high))
        text, low, high = np.r_[text, text], np.r_[low, m + 1], np.r_[m - 1, high]


def compact_windows(hashes: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """``(m, l, r)`` of the nodes of one text's tree."""
    return list(zip(*[c.tolist() for c in tree_windows(hashes, np.array([0, len(hashes)]), least)[1:]]))


def least_of(values: np.ndarray, size: int) -> np.ndarray:
    """Least element of ``values[i : i + size]`` for every ``i``; the last ones have fewer elements."""
    out, done = values.copy(), 1
    while done < size:
        step = min(done, size - done)
        out[: max(len(out) - step, 0)] = np.minimum(out[: max(len(out) - step, 0)], out[step:])
        done += step
    return out


def beside(values: np.ndarray, place: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least hashes, 16 bits each, of two segments to the right of each place and two to the left.

    ``left`` and ``right`` are the shingles that the window has on both sides; a segment beyond them gives 0.
    """
    least = least_of(np.maximum(mixed(values, 50) >> np.uint64(48), np.uint64(1)), HALF)
    found = np.zeros(len(place), np.uint64)
    for offset in (1, HALF, -HALF, 1 - 2 * HALF):
        inside = (-offset <= left) & (offset + HALF - 1 <= right)
        own = np.zeros(len(place), np.uint64)
        own[inside] = least[place[inside] + offset]
        found = found << np.uint64(16) | own
    return found


def sampled_stretches(values: np.ndarray, size: int = STRETCH, run: int = LEAST - STRETCH + 1) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of stretches of ``size`` elements: of any ``run`` in a row the one with the least hash."""
    n = len(values) - size + 1
    if n < run:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        base = np.uint64(0x9E3779B97F4A7C15)
        hashes = np.zeros(n, np.uint64)
        for k in range(size):
            hashes = hashes * base + values[k : k + n]
    hashes = mixed(hashes, 60)
    places = np.unique(np.lib.stride_tricks.sliding_window_view(hashes, run).argmin(axis=1) + np.arange(n - run + 1))
    return places, hashes[places]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text", CACHED):
            values, at, _ = shingles(part.column("text"))
            found = []
            for f in range(HASHES):
                index, place, low, high = tree_windows(mixed(values, f), at)
                found.append((np.full(len(index), f), index, place, (low - at[index]) << 32 | (high - at[index])))
            f, index, place, span = (np.concatenate(c) for c in zip(*found))
            group = mixed(values[place], 100) + f.astype(np.uint64)
            ids, hashed = (part.column(n).to_numpy()[index] for n in KEY)
            columns = [group.view(np.int64), ids, (hashed & LOW) << 32 | (place - at[index]), span]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns] + [pa.array(f, pa.int8())], ["g", "id", "at", "span", "f"])


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The asked windows with the ``REACH`` shingles around the least one, two bytes each; those beyond the window are in ``span``."""
    for batch in batches:
        for part in chunks(batch, "text", CACHED):
            values, at, _ = shingles(part.column("text"))
            lists = part.column("asked")
            owner = np.repeat(np.arange(len(part)), lists.value_lengths().to_numpy())
            flat = lists.flatten()
            g, m, span, f = (flat.field(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("g", "m", "span", "f"))
            ids, hashed = (part.column(n).to_numpy()[owner] for n in ("id", "h"))
            place = at[owner] + m
            sides = beside(values, place, m - (span >> 32), (span & LOW) - m)
            short = np.concatenate([np.zeros(LEAST, SHORT), (values >> np.uint64(48)).astype(SHORT), np.zeros(LEAST, SHORT)])
            near = np.lib.stride_tricks.sliding_window_view(short, REACH)[place + 1] if len(place) else np.zeros((0, REACH), SHORT)
            data = pa.py_buffer(np.ascontiguousarray(near))
            content = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * REACH), len(near), [None, data]).cast(pa.binary())
            columns = [g, ids, hashed << 32 | m, span, sides.view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns] + [pa.array(f, pa.int8()), content], ["g", "id", "at", "span", "c", "f", "s"])


def _most_in_a_row(same: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The most that are the same of ``LEAST`` places in a row, from ``low`` to ``high``."""
    counts = np.cumsum(np.pad(same, ((0, 0), (1, 0))), axis=1, dtype=np.int16)
    runs = counts[:, LEAST:] - counts[:, :-LEAST]
    runs[(PLACES[:LEAST] < low[:, None]) | (PLACES[LEAST - 1 :] > high[:, None])] = 0
    return runs.max(axis=1, initial=0)


def alike(one: np.ndarray, many: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the shingles around the least one of each two windows are near-equal, and whether they have enough in common to verify.

    Only places from ``low`` to ``high`` count, those inside both windows. A change of up to three words' length may shift one side.
    """
    inside = (PLACES >= low[:, None]) & (PLACES <= high[:, None])
    same = (many == one) & inside
    total, best = np.count_nonzero(same, axis=1), np.zeros(len(same), np.int64)
    many_same = np.flatnonzero(total >= MATCHED)  # the sums bound what stands in a row
    best[many_same] = _most_in_a_row(same[many_same], low[many_same], high[many_same])
    near = best >= MATCHED
    enough = near.copy()
    open_ = np.flatnonzero(~near & (total >= FEW))
    for k in range(1, SHIFT + 1):
        for ahead in (True, False):
            some = open_[~enough[open_]]
            if len(some):
                beside_it = many[some, :-k] == one[some, k:] if ahead else many[some, k:] == one[some, :-k]
                hit = np.count_nonzero(beside_it, axis=1) + total[some] >= LEAST - MISSED
                some, beside_it = some[hit], beside_it[hit]
                if not len(some):
                    continue
                moved, part = same[some], slice(k, None) if ahead else slice(None, -k)
                moved[:, part] |= beside_it & inside[some, part]
                enough[some] = _most_in_a_row(moved, low[some], high[some]) >= LEAST - MISSED  # two words put in leave one less
    return near, enough


def first_equal(group: np.ndarray, doc: np.ndarray, s: np.ndarray, low: np.ndarray, high: np.ndarray, carried: int = 0) -> np.ndarray:
    """For each window the first of its group that stands for itself and has ``LEAST`` equal shingles in a row with it, of another text; else -1.

    The first ``carried`` windows stand for themselves, as does every other one without such a first.
    """
    n = len(group)
    mate = np.full(n, -1)
    with np.errstate(over="ignore"):
        sums = np.cumsum(np.pad(s.astype(np.uint64) * (mixed(PLACES.astype(np.uint64), 70) | np.uint64(1)), ((0, 0), (1, 0))), axis=1, dtype=np.uint64)
        rows, keys = [], []
        for start in range(LEAST):
            some = np.flatnonzero((low <= start) & (high >= start + LEAST - 1))
            rows.append(some)
            keys.append(mixed(sums[some, start + LEAST] - sums[some, start] + group[some].astype(np.uint64), start))
    row, key = np.concatenate(rows), np.concatenate(keys)
    order = np.argsort(key, kind="stable")
    row, run = row[order], np.cumsum(np.r_[0, np.diff(key[order]) != 0][: len(row)])
    known, open_ = np.ones(n, bool), np.zeros(n, bool)
    open_[row[np.bincount(run)[run] > 1]] = True
    open_[:carried] = False
    while open_.any():
        held = known | open_
        asked = np.zeros(int(run[-1]) + 1, bool)
        asked[run[open_[row]]] = True
        left = asked[run] & held[row]
        row, run = row[left], run[left]
        starts = np.flatnonzero(np.r_[True, np.diff(run) > 0])
        sizes = np.diff(np.r_[starts, len(row)])
        first = np.repeat(row[starts], sizes)
        other = doc[row] != doc[first]
        second = np.repeat(np.minimum.reduceat(np.where(other, row, n), starts), sizes)
        earliest = np.full(n, n)
        np.minimum.at(earliest, row, np.where(other, first, second))
        todo = np.flatnonzero(open_)
        alone = earliest[todo] >= todo
        open_[todo[alone]] = False
        todo = todo[~alone]
        todo = todo[~open_[earliest[todo]]]
        mate[todo], open_[todo], known[todo] = earliest[todo], False, False
    return mate


def likely_pairs(s: np.ndarray, low: np.ndarray, high: np.ndarray, asked: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(y, z)``, ``z < y``, for all windows ``y`` from ``asked`` on: every pair with enough in common is among them.

    Of ``LEAST`` places in a row at most ``MISSED`` differ from those of such a ``z`` at the same place or up to ``SHIFT`` beside it. So
    of any ``MISSED + 1`` of them one agrees, and the rarest are looked up. A window without rare ones meets all.
    """
    n, never = len(s), np.iinfo(np.int64).max // LEAST

    def codes(start: int, stop: int) -> np.ndarray:
        return s[start:stop].astype(np.int64) << 7 | (PLACES + SHIFT)  # a shingle's places stand beside each other

    for base in range(0, n, ROWS):
        listed = codes(base, base + ROWS).ravel()
        order = np.argsort(listed)
        listed, owner = listed[order], order // REACH + base
        for top in range(max(asked, base + 1), n, BLOCK):
            own = np.arange(top, min(top + BLOCK, n))
            mine = codes(top, top + BLOCK)
            start = np.searchsorted(listed, mine - SHIFT)
            counts = np.searchsorted(listed, mine + SHIFT, side="right") - start
            rare = np.where((PLACES >= low[own, None]) & (PLACES <= high[own, None]), counts, never)
            chosen = np.zeros(rare.shape, bool)
            for k in range(LEAST):
                some = np.flatnonzero((low[own] <= k) & (high[own] >= k + LEAST - 1))
                if len(some):
                    places = np.argpartition(rare[some, k : k + LEAST], MISSED, axis=1)[:, : MISSED + 1]
                    chosen[some[:, None], k + places] = True
            cost = np.where(chosen, counts, 0).sum(axis=1)
            earlier = np.minimum(own - base, ROWS)
            cost = np.minimum(cost, earlier)
            share = np.cumsum(cost) // (BLOCK * LEAST)
            for part in np.split(np.arange(len(own)), np.flatnonzero(np.diff(share)) + 1):
                all_of = part[cost[part] == earlier[part]]
                y, z = np.repeat(own[all_of], earlier[all_of]), spread(np.full(len(all_of), base), earlier[all_of])
                some = part[cost[part] < earlier[part]]
                k, p = np.nonzero(chosen[some])
                k = some[k]
                met = owner[spread(start[k, p], counts[k, p])]
                pair = np.unique(np.repeat(own[k], counts[k, p]) * n + met)
                pair = pair[pair % n < pair // n]
                yield np.r_[y, pair // n], np.r_[z, pair % n]


def _compared(s: np.ndarray, doc: np.ndarray, low: np.ndarray, high: np.ndarray, known: np.ndarray, bounds: np.ndarray, carried: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``(window, earlier window, near)`` of all ``known`` windows with enough in common; ``bounds`` are those of their groups."""

    def candidates() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        sizes = np.diff(bounds)
        few = np.repeat(sizes <= MANY, sizes) & (np.arange(len(known)) >= carried)
        y, start = np.flatnonzero(few), np.repeat(bounds[:-1], sizes)
        yield np.repeat(y, y - start[y]), spread(start[y], y - start[y])
        for k in np.flatnonzero(sizes > MANY).tolist():
            base, own = int(bounds[k]), known[bounds[k] : bounds[k + 1]]
            for y, z in likely_pairs(s[own], low[own], high[own], carried if base == 0 else 0):
                yield y + base, z + base

    for ys, zs in candidates():
        for at in range(0, len(ys), BLOCK):
            y, z = known[ys[at : at + BLOCK]], known[zs[at : at + BLOCK]]
            least, most = np.maximum(low[y], low[z]), np.minimum(high[y], high[z])
            some = np.flatnonzero((most - least + 1 >= LEAST) & (doc[y] != doc[z]))
            if len(some):
                near, enough = alike(s[y[some]], s[z[some]], least[some], most[some])
                yield y[some][enough], z[some][enough], near[enough]


def _through_classes(hits: np.ndarray, root: list[int]) -> list[tuple[int, int, bool]]:
    """Of ``hits``, in order of window and earlier window, the first of each class of near-equal windows and all of other classes; ``root`` grows."""

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    found = []
    bounds = np.r_[np.flatnonzero(np.r_[True, np.diff(hits[:, 0]) > 0]), len(hits)].tolist() if len(hits) else [0]
    cells = hits.tolist()
    for start, stop in zip(bounds[:-1], bounds[1:]):
        y, met = cells[start][0], {}
        for _, z, near in cells[start:stop]:
            if near:
                met.setdefault(find(z), z)
        found += [(y, z, True) for z in met.values()]
        found += [(y, z, False) for _, z, near in cells[start:stop] if not near and find(z) not in met]
        if met:
            least = min(met)
            for x in (y, *met):
                root[x] = least
    return found


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of windows to be verified, from windows in order of group, id and place.

    A window meets the earlier ones of its group that stand for themselves. One whose passage equals an earlier text's is
    joined with the first such text, which stands for it. Others are joined with the first near-equal one of every
    class of near-equal ones, and with all of other classes that have as much in common as a passage needs. ``ROWS`` windows
    or more are read at once; a group that goes on is left for the next ones, or its windows that stand for themselves are carried.
    """
    names = ["g", "id", "at", "span", "c", "f"]
    kept: dict[str, np.ndarray] = {n: np.zeros(0, np.int64) for n in names}
    kept_s, kept_roots, carried = np.zeros((0, REACH), SHORT), [], 0
    waiting, rows = [], 0
    for batch in chain(batches, [None]):
        if batch is not None:
            waiting.append(batch)
            rows += batch.num_rows
        if rows < ROWS and batch is not None or not rows:
            continue
        table = pa.Table.from_batches(waiting).combine_chunks()
        own = {n: np.concatenate([kept[n], table.column(n).to_numpy().astype(np.int64)]) for n in names}
        fresh = np.frombuffer(b"".join(table.column("s").to_pylist()), SHORT).reshape(-1, REACH)
        s = np.concatenate([kept_s, fresh])
        same = carried > 0 and own["g"][carried] == own["g"][0]
        if not same:
            own, s, carried, kept_roots = {n: c[carried:] for n, c in own.items()}, s[carried:], 0, []
        last = int(np.searchsorted(own["g"], own["g"][-1]))
        size = len(s) if batch is None or last == 0 else last
        left = table.slice(table.num_rows - (len(s) - size))
        waiting, rows = left.to_batches(), left.num_rows
        own, s = {n: c[:size] for n, c in own.items()}, s[:size]

        m = own["at"] & LOW
        low, high = np.maximum((own["span"] >> 32) - m + LEAST - 1, 0), np.minimum((own["span"] & LOW) - m + LEAST - 1, REACH - 1)
        doc = mixed(own["id"].view(np.uint64), 80) + (own["at"] >> 32).view(np.uint64)
        mate = first_equal(own["g"], doc, s, low, high, carried)
        known, equal = np.flatnonzero(mate < 0), np.flatnonzero(mate >= 0)
        bounds = np.r_[0, np.flatnonzero(np.diff(own["g"][known])) + 1, len(known)]
        hits = [np.column_stack(found) for found in _compared(s, doc, low, high, known, bounds, carried)]
        hits = np.concatenate([np.zeros((0, 3), np.int64), *hits])
        hits = hits[np.lexsort((hits[:, 1], hits[:, 0]))]
        root = [*kept_roots, *range(carried, size)]
        found = np.array(_through_classes(hits, root), np.int64).reshape(-1, 3)
        y, z, near = np.concatenate([found, np.column_stack([equal, mate[equal], np.ones_like(equal)])]).T

        if last == 0 and batch is not None:  # the group may go on
            kept, kept_s, carried = {n: c[known] for n, c in own.items()}, s[known], len(known)
            for x in known.tolist():  # a root stands before its class
                root[x] = root[root[x]]
            kept_roots = np.searchsorted(known, [root[x] for x in known.tolist()]).tolist()
        else:
            kept, kept_s, carried, kept_roots = {n: c[:0] for n, c in own.items()}, s[:0], 0, []
        columns = [own[n][y] for n in ("id", "at", "span")] + [np.where(near, 1, own["c"][y])]
        columns += [own[n][z] for n in ("id", "at", "span")] + [np.where(near, 1, own["c"][z])]
        arrays = [pa.array(own["f"][y], pa.int8())] + [pa.array(c, pa.int64()) for c in columns]
        yield pa.RecordBatch.from_arrays(arrays, ["f", "id", "at", "span", "c", "id1", "at1", "span1", "c1"])


def _regions(own: dict[str, np.ndarray]) -> Iterator[tuple[int, int, int, int, int, int]]:
    """``(first id, first hash, a, b, least shift, largest shift)`` where enough hash functions agree in one text."""
    m, low, high = own["at"] & LOW, own["span"] >> 32, own["span"] & LOW
    m1, low1, high1 = own["at1"] & LOW, own["span1"] >> 32, own["span1"] & LOW
    hash1 = (own["at1"] >> 32) & LOW
    shift = m1 - m
    a, b = np.maximum(low, low1 - shift), np.minimum(high, high1 - shift)
    alone = np.zeros(len(m), bool)
    for bits in range(0, 64, 16):
        side, side1 = (own[n] >> bits & 0xFFFF for n in ("c", "c1"))
        alone |= (side == side1) & (side > 0)
    order = np.lexsort((shift, hash1, own["id1"]))
    order = order[(b - a + 1 >= LEAST)[order]]
    if not len(order):
        return
    ids, hashes, shifts = own["id1"][order], hash1[order], shift[order]
    new = np.r_[True, (ids[1:] != ids[:-1]) | (hashes[1:] != hashes[:-1]) | (np.diff(shifts) > SLACK)]
    bounds = np.r_[np.flatnonzero(new), len(order)]
    for i, j in zip(bounds[:-1], bounds[1:]):
        some = order[i:j]
        base, top = int(a[some].min()), int(b[some].max())
        cover = np.zeros(top - base + 2, np.int64)
        for f in np.unique(own["f"][some]):
            mine = some[own["f"][some] == f]
            for part, weight in ((mine, 1), (mine[alone[mine]], ENOUGH - 1)):
                edge = np.zeros(top - base + 2, np.int64)
                np.add.at(edge, np.maximum(a[part], m[part] - LEAST + 1) - base, 1)
                np.add.at(edge, np.minimum(b[part], m[part] + LEAST - 1) + 1 - base, -1)
                cover += (np.cumsum(edge) > 0) * weight
        held = np.diff(np.r_[0, (cover >= ENOUGH).astype(np.int8), 0])
        for s, e in zip(np.flatnonzero(held == 1), np.flatnonzero(held == -1)):
            if e - s >= LEAST:
                yield int(ids[i]), int(hashes[i]), base + int(s), base + int(e) - 1, int(shifts[i]), int(shifts[j - 1])


def _agreed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["f", "at", "span", "c", "id1", "at1", "span1", "c1"]
    for batch in batches:
        lists = batch.column("w")
        offsets = np.r_[0, np.cumsum(lists.value_lengths().to_numpy())]
        flat = lists.flatten()
        columns = {n: flat.field(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in names}
        rows = []
        for k, (i, h) in enumerate(zip(batch.column("id").to_pylist(), batch.column("h").to_pylist())):
            own = {n: c[offsets[k] : offsets[k + 1]] for n, c in columns.items()}
            rows += [(i, h, *found) for found in _regions(own)]
        cells = np.array(rows, np.int64).reshape(-1, 8).T
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], ["id", "h", "id1", "h1", "a", "b", "low", "high"])


def verified(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int]]:
    """Stretches ``(i, j)`` of ``x`` (inclusive) that are near-duplicates of a stretch of ``y``.

    A stretch begins and ends with an equal shingle. One below ``LEAST``, as left by a change near the passage's edge, is
    extended to ``LEAST`` in both texts, by ``WORDS`` on a side at most; every extension that is similar enough counts.
    """
    found = []
    kinds, kind = np.unique(x, return_inverse=True)
    kind1 = np.searchsorted(kinds, y)
    kind1[np.append(kinds, 0)[kind1] != y] = len(kinds)  # those of y alone
    held = np.zeros(len(kinds) + 1, bool)
    held[kind1] = True
    at = np.flatnonzero(held[kind])
    if len(at) < LEAST * SIMILARITY:
        return []
    gaps = np.diff(at)
    cut = np.flatnonzero(gaps > GAP).tolist()
    todo = list(zip([0, *[c + 1 for c in cut]], [*cut, len(at) - 1]))
    while todo:
        s, e = todo.pop()
        i, j = int(at[s]), int(at[e])
        need = max(LEAST - (j - i + 1), 0)
        if need > 2 * WORDS:
            continue
        size = j - i + 1
        held[:] = False
        held[kind[at[s : e + 1]]] = True
        fits = []
        if need or np.count_nonzero(held) >= SIMILARITY * len(set(kind[i : j + 1].tolist())):
            common = held[kind1]
            places = np.flatnonzero(common)
            # the stretch of y that starts where a match does and has the most in common
            starts = places
            marks = np.zeros(len(y) + 1, np.int64)
            np.cumsum(common, out=marks[1:])
            ends = np.minimum(starts + size, len(y))
            best = int((marks[ends] - marks[starts]).argmax())
            u, v = int(starts[best]), int(ends[best])
            for before in range(max(need - WORDS, 0), min(need, WORDS) + 1):
                lo, hi = i - before, j + need - before
                if lo < 0 or hi >= len(x) or need and (u < before or v + need - before > len(y)):
                    continue
                mine, other = set(x[lo : hi + 1].tolist()), set(y[u - before : v + need - before].tolist())
                shared = len(mine & other)
                if shared >= SIMILARITY * (len(mine) + len(other) - shared):
                    fits.append((lo, hi))
        found += fits
        if not fits and e > s:
            k = int(gaps[s:e].argmax())
            if gaps[s + k] > 1:
                todo += [(s, s + k), (s + k + 1, e)]
    return sorted(found)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles of each asked stretch, four bytes each."""
    names = ["id", "h", "id1", "h1", "a", "low", "high", "b", "salt", "first"]
    for batch in batches:
        for part in chunks(batch, "text"):
            values, at, _ = shingles(part.column("text"))
            short = values.astype(np.uint32)
            rows = []
            for k, asked in enumerate(part.column("asked").to_pylist()):
                n = int(at[k + 1] - at[k])
                for q in asked:
                    a, b = max(q["a"], 0), min(q["b"], n - 1)
                    rows.append((*[q[c] for c in names[:4]], a, q["low"], q["high"], b, q["salt"], q["first"], short[at[k] + a : at[k] + b + 1].tobytes()))
            columns = list(zip(*rows)) or [()] * 11
            types = [pa.int64()] * 8 + [pa.int32(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [*names, "s"])


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Verified stretches; in each group the row of the first text (``first``) comes before those to be compared with it."""
    key, a1, y = None, 0, np.zeros(0, np.uint32)
    for batch in batches:
        rows = []
        s = batch.column("s")
        for k, q in enumerate(zip(*[batch.column(n).to_pylist() for n in ("first", "salt", "id", "h", "id1", "h1", "a", "low", "high", "b")])):
            first, salt, i, h, i1, h1, a, low, high, b = q
            x = np.frombuffer(s[k].as_buffer(), np.uint32)
            if first:
                key, a1, y = (salt, i1, h1), a, x
            elif key == (salt, i1, h1):
                start, end = max(a + low - a1, 0), max(b + high - a1 + 1, 0)
                rows += [(i, h, i1, h1, a + lo, a + hi + WORDS) for lo, hi in verified(x, y[start:end])]
        cells = np.array(rows, np.int64).reshape(-1, 6).T
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], ["id", "h", "id1", "h1", "start", "stop"])


def _discard(*frames: DataFrame) -> None:
    """Remove settled tables that nothing will read again."""
    for frame in frames:
        for folder in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
            fs, path = file_system(frame.sparkSession, unquote(folder))
            fs.delete(path, True)


def _in_turns(df: DataFrame, key: Column, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``make`` over the rows of each of ``PARTS`` shares of the keys, one after the other."""
    return reduce(DataFrame.union, [make(df.where(F.pmod(key, F.lit(PARTS)) == k)) for k in range(PARTS)])


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, h, id1, h1, start, stop``: words ``start`` to ``stop`` (exclusive) of a text near-repeat the earlier text 1.

    ``id`` is the document id (the smallest long for NULL) and ``h`` the low half of its text hash.
    """
    conf = docs.sparkSession.conf
    before = conf.get(FREE_SHUFFLES)
    conf.set(FREE_SHUFFLES, "true")  # each step is settled, so its shuffle files are of no further use
    try:
        return _repeated(docs, id_col, text_col)
    finally:
        conf.set(FREE_SHUFFLES, before)


def _repeated(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(*doc_key(id_col, text_col), F.col(text_col).alias("text"))
    low, no_less = F.lit(LOW), F.col("n_words") >= LEAST + WORDS - 1
    once = rows.groupBy("k_th").agg(F.min("k_id").alias("k_id"))  # equal texts are one
    first_id = settle(once, "texts")
    slim = rows.join(first_id, ["k_th", "k_id"], "left_semi").dropDuplicates(["k_id", "k_th"])
    slim = settle(slim.select("k_id", "k_th", "text"), "slim")
    windows = settle(slim.mapInArrow(_windows, "g long, id long, at long, span long, f byte"), "windows")
    hashed = F.shiftrightunsigned("at", 32)

    def repeated(some: DataFrame) -> DataFrame:
        group = Window.partitionBy("g")
        both = some.withColumns({"t0": F.min(hashed).over(group), "t1": F.max(hashed).over(group)})
        return settle(both.where("t0 < t1").drop("t0", "t1"), "shared")

    shared = _in_turns(windows, F.col("g"), repeated)
    _discard(windows)
    texts = slim.select(F.col("k_id").alias("id"), F.col("k_th").bitwiseAND(low).alias("h"), "text")
    cell = F.struct("g", F.col("at").bitwiseAND(low).alias("m"), "span", "f")
    asked = shared.groupBy("id", hashed.alias("h")).agg(F.collect_list(cell).alias("asked"))
    held_schema = "g long, id long, at long, span long, c long, f byte, s binary"
    held = settle(texts.join(asked, ["id", "h"]).mapInArrow(_held, held_schema), "held")
    _discard(shared)

    def paired(some: DataFrame) -> DataFrame:
        order = some.repartition("g").sortWithinPartitions("g", "id", "at")
        return settle(order.mapInArrow(_pairs, "f byte, id long, at long, span long, c long, id1 long, at1 long, span1 long, c1 long"), "stretches")

    joined = _in_turns(held, F.col("g"), paired)
    _discard(held)

    def listed(some: DataFrame) -> DataFrame:
        per_text = some.groupBy("id", hashed.alias("h")).agg(F.collect_list(F.struct("f", "at", "span", "c", "id1", "at1", "span1", "c1")).alias("w"))
        return settle(per_text.mapInArrow(_agreed, "id long, h long, id1 long, h1 long, a long, b long, low long, high long"), "regions")

    regions = _in_turns(joined, F.xxhash64("id", hashed), listed)
    _discard(joined)

    names = ["id", "h", "id1", "h1", "a", "b", "low", "high"]

    def stretches(asked: DataFrame) -> DataFrame:
        per_text = asked.groupBy("id", "h").agg(F.collect_list(F.struct(*names, "salt", "first")).alias("asked"))
        once = texts.join(per_text, ["id", "h"]).select("text", "asked")
        return once.mapInArrow(_cut, CUT_SCHEMA)

    salt = F.pmod(F.xxhash64("id", "h"), F.lit(SALTS)).cast("int")
    wide = regions.withColumns({"a": F.col("a") - LEAST, "b": F.col("b") + LEAST, "salt": salt})  # a repeat may reach beyond what the windows tell
    group = ["id1", "h1", "salt"]
    hull = wide.groupBy(*group).agg(F.min(F.col("a") + F.col("low")).alias("a"), F.max(F.col("b") + F.col("high")).alias("b"))
    zero = F.lit(0).cast("long")
    wanted = hull.select(F.col("id1").alias("id"), F.col("h1").alias("h"), "id1", "h1", "a", "b", zero.alias("low"), zero.alias("high"), "salt", F.lit(True).alias("first"))
    asked = wide.select(*names, "salt", F.lit(False).alias("first")).union(wanted)
    ordered = stretches(asked).repartition(*group).sortWithinPartitions(*group, F.desc("first"))
    found = settle(ordered.mapInArrow(_checked, "id long, h long, id1 long, h1 long, start long, stop long").distinct(), "passages")
    copied = rows.select("k_id", "k_th", "text").join(first_id.withColumnRenamed("k_id", "k_id1"), "k_th").where("k_id > k_id1").dropDuplicates(["k_id", "k_th"])
    counted = copied.select(F.col("k_id").alias("id"), F.col("k_th").bitwiseAND(low).alias("h"), F.col("k_id1").alias("doc_id"), "text")
    counted = counted.mapInArrow(_sizes, "id long, h long, doc_id long, n_words long").where(no_less)
    copies = counted.select("id", "h", F.col("doc_id").alias("id1"), F.col("h").alias("h1"), F.lit(0).cast("long").alias("start"), F.col("n_words").alias("stop"))
    copies = settle(copies, "copies")
    _discard(regions, slim)
    return found.union(copies)


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text"):
            raw, offsets = text_bytes(part.column("text"))
            words = np.diff(space_words(raw, offsets)[2])
            yield pa.RecordBatch.from_arrays([part.column(n) for n in ("id", "h", "doc_id")] + [pa.array(words, pa.int64())], ["id", "h", "doc_id", "n_words"])


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, class_id, n_links, n_words, n_repeated, spans, sources``.

    ``spans`` holds ``start:stop`` word ranges, merged, that near-repeat earlier texts; ``sources`` the ids of those
    texts; ``n_links`` counts linked texts in both directions; ``class_id`` is the smallest id reachable over links. Words
    stand between ASCII white space; A-Z compare in lower case. Texts below 50 words, NULL and empty
    texts have no passage; repeated rows are one text and get equal results; a passage within one text
    only is not reported. An empty table gives no row. Only the two named columns are read.
    """
    found = repeated_passages(docs, id_col, text_col)
    slim = docs.select(
        *[c.alias(n) for c, n in zip(doc_key(id_col, text_col), ("id", "h"))], F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    ).withColumn("h", F.col("h").bitwiseAND(F.lit(LOW)))
    rows = slim.mapInArrow(_sizes, "id long, h long, doc_id long, n_words long")

    pair = ["id", "h"]
    links = found.select(*pair, "id1", "h1").distinct()
    both = links.union(links.select("id1", "h1", "id", "h")).groupBy(*pair).agg(F.count("*").alias("n_links"))
    node, node1 = F.xxhash64("id", "h"), F.xxhash64("id1", "h1")
    roots = components(links.select(node.alias("a"), node1.alias("b")))
    ends = links.select("id", "h").union(links.select("id1", "h1")).distinct().withColumn("node", node)
    classed = ends.join(roots, "node")
    least = classed.groupBy("root").agg(F.min(F.when(F.col("id") > -(1 << 63), F.col("id"))).alias("class_id"))
    classed = classed.join(least, "root").select(*pair, "class_id")

    sources = links.groupBy(*pair).agg(F.sort_array(F.collect_set(F.when(F.col("id1") > -(1 << 63), F.col("id1")))).alias("sources"))
    order = Window.partitionBy(*pair).orderBy("start", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col("start") > reach), 1).otherwise(0)
    merged = found.select(*pair, "start", "stop").distinct().withColumn("opens", opens)
    merged = merged.withColumn("n", F.sum("opens").over(order)).groupBy(*pair, "n")
    merged = merged.agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    span = F.concat_ws(":", F.col("start").cast("string"), F.col("stop").cast("string"))
    listed = F.sort_array(F.collect_list(F.struct("start", span.alias("span"))))["span"]
    spans = merged.groupBy(*pair).agg(F.sum(F.col("stop") - F.col("start")).alias("n_repeated"), F.array_join(listed, ",").alias("spans"))

    joined = rows
    for more in (both, classed, sources, spans):
        joined = joined.join(more, pair, "left")
    return joined.select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "n_words",
        F.coalesce("n_repeated", F.lit(0)).cast("long").alias("n_repeated"),
        F.coalesce("spans", F.lit("")).alias("spans"),
        F.coalesce("sources", F.array().cast("array<long>")).alias("sources"),
    )
