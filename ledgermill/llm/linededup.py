"""Line dedup over windows of three lines.

Every three consecutive lines are a window, known by 128 bits of hash. A window that stands at more than one place is
repeated; its first place is the one of the smallest id, text hash and line. All lines under later places
are removed; places that overlap cover the union of their lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.keys import doc_key, packed, unpacked

SPAN = 3
KEY = ["k_id", "k_th"]


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def _windows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``k_id, k_th, line, h1, h2``: one row for each window; ``line`` counts from 1."""
    cut = docs.select(*doc_key(id_col, text_col), lines(F.col(text_col)).alias("l")).where(F.size("l") >= SPAN)
    hashed = cut.withColumns({"a": F.transform("l", lambda x: F.xxhash64(x)), "b": F.transform("l", lambda x: F.xxhash64(F.lit(SPAN), x))})

    def window(i: Column) -> Column:
        return F.struct(
            i.alias("line"),
            *[F.xxhash64(*[F.element_at(c, i + k) for k in range(SPAN)]).alias(h) for c, h in (("a", "h1"), ("b", "h2"))],
        )

    return hashed.select(*KEY, F.inline(F.transform(F.sequence(F.lit(1), F.size("l") - SPAN + 1), window)))


def covered_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``k_id, k_th, gone``: for each document that loses lines, their numbers from 1."""
    windows = _windows(docs, id_col, text_col)
    place = F.struct("k_id", "k_th", "line")
    repeated = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last")
    later = windows.join(repeated.select("h1", "h2", "first"), ["h1", "h2"]).where(F.struct("k_id", "k_th", "line") != F.col("first"))
    starts = later.groupBy(*KEY).agg(F.collect_set("line").alias("starts"))
    gone = F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s, s + SPAN - 1))))
    return starts.select(*KEY, gone.alias("gone"))


def _kept(text: Column, gone: Column) -> Column:
    cut = lines(text)
    left = F.array_except(F.sequence(F.lit(1), F.size(cut)), gone)
    return F.when(gone.isNull() | text.isNull(), text).otherwise(F.array_join(F.transform(left, lambda i: F.element_at(cut, i)), "\n"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_removed, text`` of every row, with the text that is left.

    Lines compare byte for byte; blank lines count like others. A text of fewer than three lines has no window and stays
    as it is; NULL has no line and stays NULL; a text whose lines all go becomes empty. Repeated rows are one
    document and keep equal texts. An empty table gives no row. Only the two named columns are read.
    """
    rows = docs.select(*doc_key(id_col, text_col), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    joined = rows.join(covered_lines(docs, id_col, text_col), KEY, "left")
    return joined.select(
        "doc_id",
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines(F.col("text")))).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        _kept(F.col("text"), F.col("gone")).alias("text"),
    )


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the text that is left.

    NULL stays NULL; empty texts and texts of fewer than three lines stay as they are; repeated rows are one document and keep
    equal texts; an empty table gives no row. All columns are kept.
    """
    joined = packed(docs, id_col, text_col).join(covered_lines(docs, id_col, text_col), KEY, "left")
    return unpacked(joined.select(F.col("row").withField(f"`{text_col}`", _kept(F.col("row").getField(text_col), F.col("gone"))).alias("row")))


SQL = """
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(ls) - 1)) AS p, unnest([ls[k:k + 2] FOR k IN range(1, len(ls) - 1)]) AS win
      FROM l WHERE len(ls) >= 3),
r AS (SELECT doc_id, p, row_number() OVER (PARTITION BY win ORDER BY doc_id, p) AS n FROM w),
g AS (SELECT doc_id, list(DISTINCT line) AS gone FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS line FROM r WHERE n > 1) GROUP BY 1)
SELECT l.doc_id, coalesce(len(ls), 0) AS n_lines, coalesce(len(gone), 0) AS n_removed,
       CASE WHEN gone IS NULL THEN text
            ELSE coalesce(array_to_string(list_filter(ls, lambda x, i: NOT list_contains(gone, i)), chr(10)), '') END AS text
FROM l LEFT JOIN g USING (doc_id)
"""
