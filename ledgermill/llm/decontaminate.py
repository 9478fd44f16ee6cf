"""Benchmark decontamination by winnowing, in native expressions only.

A window is ``WINDOW`` consecutive words of an item (all words of a shorter item). Its fingerprint is the
smallest hash of the ``GRAM``-word grams inside it, so two equal windows have equal fingerprints wherever
they stand: a shared span of ``WINDOW`` words can't be missed. Few neighbouring
windows differ in fingerprint, so a text keeps about a quarter as many as it has words. Texts that share one with an
item are read again, the hits are extended to whole windows, and these are compared word for word.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.keys import doc_key, packed, unpacked
from ledgermill.operators.exprs import small_side
from ledgermill.session import settle

WINDOW = 10
GRAM = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KEY = ["k_id", "k_th"]


def words(text: Column) -> Column:
    """Digits, a-z (A-Z lower-cased) and everything beyond ASCII form words; NULL has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), NO_WORD), "")


def _beside(left: str, right: str, shift: int, join) -> Column:
    """``join(left[i], right[i + shift])`` for all ``i`` where both exist."""
    n = F.greatest(F.least(F.size(left), F.size(right) - shift), F.lit(0))
    return F.zip_with(F.slice(left, 1, n), F.slice(right, 1 + shift, n), join)


def _grams(df: DataFrame, size: int) -> tuple[DataFrame, str]:
    df = df.withColumn("g1", F.transform("w", lambda x: F.xxhash64(x))) if "g1" not in df.columns else df
    name = f"g{size}"
    for k in range(2, size + 1):
        if f"g{k}" not in df.columns:
            half = k // 2
            df = df.withColumn(f"g{k}", _beside(f"g{k - half}", f"g{half}", k - half, lambda a, b: F.xxhash64(a, b)))
    return df, name


def _minima(df: DataFrame, column: str, span: int, out: str) -> DataFrame:
    """``out[i]``: the least of ``span`` elements from ``i`` on."""
    width, now = 1, column
    while width * 2 <= span:
        df = df.withColumn(f"{out}_{width * 2}", _beside(now, now, width, lambda a, b: F.least(a, b)))
        width, now = width * 2, f"{out}_{width * 2}"
    return df.withColumn(out, _beside(now, now, span - width, lambda a, b: F.least(a, b)) if span > width else F.col(now))


def with_fingerprints(df: DataFrame, lengths: list[int]) -> DataFrame:
    """Add ``f<length>``: the fingerprint of each window of that many words of ``w``."""
    for length in lengths:
        df, grams = _grams(df, min(GRAM, length))
        df = _minima(df, grams, length - min(GRAM, length) + 1, f"f{length}")
    return df


def _tagged(length: int) -> Column:
    """Distinct fingerprints; those of short windows don't mix with the others."""
    found = F.array_distinct(f"f{length}")
    return found if length == WINDOW else F.transform(found, lambda x: F.xxhash64(F.lit(length), x))


def _item_windows(items: DataFrame, item_col: str, text_col: str) -> tuple[DataFrame, list[int]]:
    """``item, length, w`` of items that have words, and the window lengths (ten at most) that occur."""
    slim = items.select(F.col(item_col).cast("string").alias("item"), words(F.col(text_col)).alias("w"))
    rows = settle(slim.withColumn("length", F.least(F.size("w"), F.lit(WINDOW))).where("length > 0"), "items")
    return rows, sorted(r.length for r in rows.select("length").distinct().collect())


def _windows(length: int, start: Column) -> Column:
    return F.array_join(F.slice("w", start, length), " ")


def hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``k_id, k_th, doc_id, n_words, n_hit, n_items, items_sha256`` of every row of ``docs``.

    A word of a text is hit if it stands in any occurrence of an item's window. NULL, empty and wordless texts
    and items have no window; repeated rows get equal results; items without an id can hit but are not listed. An
    empty table of items hits nothing. Only the named columns are read.
    """
    rows, lengths = _item_windows(items, item_col, item_text)
    slim = docs.select(*doc_key(id_col, text_col), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    read = slim.select(*KEY, "doc_id", words(F.col("text")).alias("w"))
    marked = with_fingerprints(read, lengths)
    prints = F.concat(*[_tagged(x) for x in lengths]) if lengths else F.array().cast("array<bigint>")
    base = settle(marked.select(*KEY, "doc_id", F.size("w").cast("long").alias("n_words"), prints.alias("f")), "prints")
    if not lengths:
        return base.select(*KEY, "doc_id", "n_words", *_result())

    known = with_fingerprints(rows, lengths)
    own = reduce(DataFrame.union, [known.where(F.col("length") == x).select(F.explode(_tagged(x)).alias("f")) for x in lengths])
    own = small_side(settle(own.distinct(), "prints"))
    met = base.select(*KEY, F.explode("f").alias("f")).join(own, "f", "left_semi")
    met = met.groupBy(*KEY).agg(F.collect_set("f").alias("met"))

    again = with_fingerprints(slim.join(met, KEY).select(*KEY, "met", words(F.col("text")).alias("w")), lengths)
    spans = []
    for x in lengths:
        tag = (lambda f: f) if x == WINDOW else (lambda f, x=x: F.xxhash64(F.lit(x), f))
        starts = F.filter(F.transform(f"f{x}", lambda f, i: F.when(F.array_contains("met", tag(f)), i + 1)), lambda i: i.isNotNull())
        one = F.transform(starts, lambda i: F.struct(i.alias("start"), F.lit(x).alias("length"), _windows(x, i).alias("window")))
        spans.append(one)
    found = again.select(*KEY, F.inline(F.concat(*spans)))
    listed = reduce(
        DataFrame.union,
        [
            known.where(F.col("length") == x).select("item", F.explode(F.transform(f"f{x}", lambda f, i: _windows(x, i + 1))).alias("window"))
            for x in lengths
        ],
    )
    listed = settle(listed.distinct(), "windows")
    # settled: both results below start from the same compared windows
    exact = settle(found.join(small_side(listed.select("window").distinct()), "window"), "hits")

    until = Window.partitionBy(*KEY).orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max(F.col("start") + F.col("length") - 1).over(until), F.lit(0))
    fresh = exact.select(*KEY, "start", "length").distinct().withColumn("reach", reach)
    new_words = F.greatest(F.lit(0), F.col("start") + F.col("length") - 1 - F.greatest(F.col("start") - 1, F.col("reach")))
    counted = fresh.groupBy(*KEY).agg(F.sum(new_words).cast("long").alias("hit"))

    named = exact.select(*KEY, "window").distinct().join(small_side(listed), "window").where("item is not null")
    per_doc = named.select(*KEY, "item").distinct().groupBy(*KEY).agg(F.sort_array(F.collect_list("item")).alias("items"))
    return (
        base.select(*KEY, "doc_id", "n_words")
        .join(counted, KEY, "left")
        .join(per_doc, KEY, "left")
        .select(*KEY, "doc_id", "n_words", *_result(F.col("hit"), F.col("items")))
    )


def _result(hit: Column | None = None, items: Column | None = None) -> list[Column]:
    hit = F.lit(0).cast("long") if hit is None else F.coalesce(hit, F.lit(0))
    items = F.array().cast("array<string>") if items is None else F.coalesce(items, F.array().cast("array<string>"))
    return [
        hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    ]


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, in which no word is hit.

    NULL, empty and wordless texts are not hit and stay; repeated rows stay or go together; an empty table, or one of
    items, drops nothing. All columns are kept.
    """
    bad = hits(docs, items, id_col, text_col).where("contaminated").select(*KEY).distinct()
    return unpacked(packed(docs, id_col, text_col).join(bad, KEY, "left_anti"))


SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS l,
         unnest([w[k:k + least(len(w), 10) - 1] for k in range(1, len(w) - least(len(w), 10) + 2)]) AS win
  FROM i WHERE len(w) > 0),
ls AS (SELECT DISTINCT l FROM iw),
dw AS (
  SELECT doc_id, l, unnest(range(1, len(w) - l + 2)) AS k, unnest([w[k:k + l - 1] for k in range(1, len(w) - l + 2)]) AS win
  FROM d, ls WHERE len(w) >= l),
m AS (SELECT doc_id, dw.l, k, item_id FROM dw JOIN iw ON dw.win = iw.win),
p AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + l)) AS pos FROM m) GROUP BY 1),
n AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN n USING (doc_id)
"""
