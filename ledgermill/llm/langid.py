"""Language identification: known words first, then shorter and shorter character n-grams.

Learning takes ``SAMPLE_ROWS`` distinct texts of each language at most, those with the smallest hash, so that rare languages are
learned and repeated rows count once, and keeps ``MAX_WORDS`` words and ``MAX_GRAMS`` n-grams of each language and length, the most frequent ones. Both
bounds limit the model only; every row is classified from its whole text.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgermill.llm.textops import chunks, distinct_words
from ledgermill.operators.exprs import small_side
from ledgermill.session import settle

SAMPLE_ROWS = 1000
MAX_WORDS = 20_000
MAX_GRAMS = 10_000
LONGEST = 5
SMOOTHING = 0.5
CACHE_WORDS = 100_000
CHUNK = 1 << 20  # bytes of text judged at once; what a worker keeps in memory follows it
MIN_SCORE = 0.5
UNKNOWN = "und"

_LETTERS = regex.compile(r"\p{L}+")


def letter_words(piece: str) -> list[str]:
    return _LETTERS.findall(piece.lower())


def grams(word: str, size: int) -> list[str]:
    """Character n-grams; longer than one, they include the word's borders."""
    marked = f"<{word}>" if size > 1 else word
    return [marked[i : i + size] for i in range(len(marked) - size + 1)]


@dataclass
class Model:
    """Log frequencies by language: row ``tables[0][word]`` of ``values[0]``, row ``tables[n][gram]`` of ``values[n]``."""

    languages: list[str]
    tables: list[dict[str, int]]
    values: list[np.ndarray]

    def found(self, word: str) -> tuple[int, list[int]]:
        """Which table tells about a word (-1: none), and the rows of it."""
        known = self.tables[0].get(word)
        if known is not None:
            return 0, [known]
        for size in range(min(LONGEST, len(word) + 2), 0, -1):
            table = self.tables[size]
            rows = [table[g] for g in grams(word, size) if g in table]
            if rows:
                return size, rows
        return -1, []

    def scores(self, pieces: list[str]) -> np.ndarray:
        """One row per piece: score of each language, summed over its words, then the number of its words.

        A known word scores its log frequency, another the mean of its longest known n-grams.
        """
        out = np.zeros((len(pieces), len(self.languages) + 1))
        told: list[tuple[list[int], list[int], list[int]]] = [([], [], []) for _ in self.tables]
        for k, piece in enumerate(pieces):
            for word in letter_words(piece):
                out[k, -1] += 1
                size, rows = self.found(word)
                if size >= 0:
                    owners, starts, flat = told[size]
                    owners.append(k)
                    starts.append(len(flat))
                    flat += rows
        for values, (owners, starts, flat) in zip(self.values, told):
            if owners:
                total = np.add.reduceat(values[flat], starts, axis=0)
                count = np.diff([*starts, len(flat)])
                np.add.at(out[:, :-1], owners, total / count[:, None])
        return out


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text"):
            codes, words, before = distinct_words(part.column("text"))
            pieces = [letter_words(w) for w in words.to_pylist()]
            seen: dict[tuple[str, int], Counter] = defaultdict(Counter)
            for k, language in enumerate(part.column("lang").to_pylist()):
                for code, n in Counter(codes[before[k] : before[k + 1]].tolist()).items():
                    for w in pieces[code]:
                        seen[language, 0][w] += n
                        for size in range(1, LONGEST + 1):
                            for g in grams(w, size):
                                seen[language, size][g] += n
            rows = [(language, size, item, n) for (language, size), c in seen.items() for item, n in c.items()]
            columns = list(zip(*rows)) or [(), (), (), ()]
            types = [pa.string(), pa.int32(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["lang", "size", "item", "n"])


def learn(rows: DataFrame, id_col: str, text_col: str, lang_col: str, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from at most ``sample_rows`` distinct texts of each language."""
    labelled = rows.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    labelled = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.xxhash64(text_col).alias("place"), F.col(text_col).alias("text"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("place"))  # tasks pass on their first rows only
    chosen = labelled.select("lang", "place").distinct().withColumn("n", first).where(F.col("n") <= sample_rows).drop("n")
    chosen = settle(chosen, "sample")
    if chosen.isEmpty():
        return Model([], [{} for _ in range(LONGEST + 1)], [np.zeros((0, 0))] * (LONGEST + 1))
    sample = labelled.join(small_side(chosen), ["lang", "place"]).dropDuplicates(["lang", "place"]).select("lang", "text")
    found = sample.mapInArrow(_counts, "lang string, size int, item string, n long")
    counts = settle(found.groupBy("lang", "size", "item").agg(F.sum("n").alias("n")), "words")
    totals = {(r.lang, r.size): (r.n, r.kinds) for r in counts.groupBy("lang", "size").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect()}
    rank = F.row_number().over(Window.partitionBy("lang", "size").orderBy(F.desc("n"), "item"))
    most = F.when(F.col("size") == 0, MAX_WORDS).otherwise(MAX_GRAMS)
    kept = counts.withColumn("rank", rank).where(F.col("rank") <= most)
    languages = sorted({lang for lang, _ in totals})
    at = {lang: i for i, lang in enumerate(languages)}
    sizes = range(LONGEST + 1)
    weight = {k: n + SMOOTHING * (kinds + 1) for k, (n, kinds) in totals.items()}
    floors = [np.array([math.log(SMOOTHING / weight.get((lang, s), 1.0)) for lang in languages]) for s in sizes]
    tables: list[dict[str, int]] = [{} for _ in sizes]
    rows = kept.collect()
    for r in rows:
        tables[r.size].setdefault(r.item, len(tables[r.size]))
    values = [np.tile(floors[s], (len(tables[s]), 1)) for s in sizes]
    for r in rows:
        values[r.size][tables[r.size][r.item], at[r.lang]] = math.log((r.n + SMOOTHING) / weight[r.lang, r.size])
    return Model(languages, tables, values)


class WordScores:
    """Scores of white-space separated pieces; the first ``CACHE_WORDS`` pieces are kept from batch to batch."""

    def __init__(self, model: Model):
        self.model = model
        self.place: dict[str, int] = {}
        self.rows = np.zeros((0, len(model.languages) + 1))

    def lookup(self, pieces: list[str]) -> np.ndarray:
        new = [p for p in pieces if p not in self.place]
        spot = {p: len(self.place) + i for i, p in enumerate(new)}
        spots = [s if (s := self.place.get(p)) is not None else spot[p] for p in pieces]
        rows = np.concatenate([self.rows, self.model.scores(new)])
        room = CACHE_WORDS - len(self.place)
        if room > 0 and new:
            self.place.update(zip(new[:room], range(len(self.place), len(self.place) + room)))
            self.rows = rows[: len(self.place)].copy()
        return rows[spots]


def decide(scores: np.ndarray, words: np.ndarray, languages: list[str]) -> tuple[list[str], np.ndarray]:
    """Best language and its posterior from the summed log frequencies."""
    if not languages:
        return [UNKNOWN] * len(words), np.zeros(len(words))
    best = scores.argmax(axis=1)
    share = np.exp(scores - scores.max(axis=1, keepdims=True))
    top = 1 / share.sum(axis=1)
    return [languages[b] if n else UNKNOWN for b, n in zip(best, words)], np.where(words > 0, top, 0.0)


def judged(known: WordScores, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    codes, words, before = distinct_words(texts)
    rows = known.lookup(words.to_pylist())
    total = np.zeros((len(texts), rows.shape[1]))
    full = np.flatnonzero(np.diff(before))
    if len(full):
        for c in range(rows.shape[1]):
            total[full, c] = np.add.reduceat(rows[codes, c], before[full])
    return decide(total[:, :-1], total[:, -1], known.model.languages)


def judged_parts(model: Model, batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[tuple[pa.RecordBatch, list[str], np.ndarray]]:
    """Slices of the batches with language and score of each row; memory that Arrow kept for them is given back at the end."""
    known = WordScores(model)
    for batch in batches:
        for part in chunks(batch, text_col, CHUNK):
            yield part, *judged(known, part.column(text_col))
    pa.default_memory_pool().release_unused()


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row.

    ``und`` with score 0 where the text is NULL or has no letter, or nothing was learned. Equal scores go to the
    first language by code point.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, names, score in judged_parts(model, batches, "text"):
            columns = [part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept away from learning; a NULL id belongs to the learning part."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row, learned from rows that are not held out.

    Repeated rows each get a row. NULL texts and languages are left out of learning; an empty table gives
    no row. Only the three named columns are read.
    """
    return classify(docs, learn(docs.where(~held_out(id_col)), id_col, text_col, lang_col), id_col, text_col)


def drop_unidentified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs``, unchanged, whose language is identified with a score of ``MIN_SCORE`` or more.

    NULL, empty and letterless texts are not identified and go; repeated rows stay or go together; an empty table
    gives no row. All columns are kept.
    """
    model = learn(docs.where(~held_out(id_col)), id_col, text_col, lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, names, score in judged_parts(model, batches, text):
            kept = [n != UNKNOWN and s >= MIN_SCORE for n, s in zip(names, score)]
            yield part.filter(pa.array(kept, pa.bool_()))

    text = f"c{docs.columns.index(text_col)}"
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # names may hold dots
    return numbered.mapInArrow(run, numbered.schema).toDF(*docs.columns)
