"""Line dedup by overlapping three-line windows.

Lines are what ``\\n`` parts.  Each run of three consecutive lines of a document is a
window; windows are hashed (128 bits of SHA-256) and grouped over all documents, each
task sending one row for each distinct window.  The first occurrence of a repeated
window, by document id and then place, stays; the lines that later ones cover are
merged and removed.  Windows are judged on the input.

Documents of fewer than three lines have no windows and keep all lines.  Null texts
have no lines; an empty text is one empty line.  Other columns are passed through by
``line_dedup`` and ignored by ``line_report``; an empty table gives an empty result.
Rows that repeat an id are documents of their own, ordered by a hash of their texts;
those that agree in id and text are one occurrence, and none of them removes lines of
the others.  Rows without an id keep all lines and count for no other row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_mark

WIDTH = 3


def _lines(text: Column) -> Column:
    return F.coalesce(F.split(text, "\n", -1), F.array().cast("array<string>"))


def later_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """id, mark (see ``row_mark``) and places (of first lines) of the windows that occurred before, one row per document that has any."""
    lines = docs.select(F.col(id_col).cast("long").alias("id"), row_mark(F.col(text_col)).alias("mark"), _lines(F.col(text_col)).alias("lines"))
    lines = lines.where("id is not null").where(F.size("lines") >= width)
    digest = F.transform(
        F.sequence(F.lit(1), F.size("lines") - width + 1),
        lambda i: F.substring(F.unhex(F.sha2(F.array_join(F.slice("lines", i, width), "\n"), 256)), 1, 16),
    )
    windows = lines.select("id", "mark", F.posexplode(digest).alias("place", "digest"))
    first = windows.groupBy("digest").agg(F.min(F.struct("id", "mark", "place")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first")
    again = windows.join(first, "digest").where((F.col("id") != F.col("first.id")) | (F.col("mark") != F.col("first.mark")) | (F.col("place") != F.col("first.place")))
    return again.groupBy("id", "mark").agg(F.collect_set("place").alias("places"))


def _marked(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """The documents with ``__lines`` and ``__kept``, the places of the lines that stay."""
    later = later_windows(docs, id_col, text_col, width).select(F.col("id").alias("__later_id"), F.col("mark").alias("__later_mark"), F.col("places").alias("__places"))
    covered = F.array_distinct(F.flatten(F.transform("__places", lambda p: F.sequence(p, p + (width - 1)))))
    every = F.when(F.size("__lines") > 0, F.sequence(F.lit(0), F.size("__lines") - 1)).otherwise(F.array().cast("array<int>"))
    kept = F.when(F.col("__places").isNull(), every).otherwise(F.array_except(every, covered))
    same = (docs[id_col] == later["__later_id"]) & (row_mark(docs[text_col]) == later["__later_mark"])
    rows = docs.join(later, same, "left").withColumn("__lines", _lines(docs[text_col]))
    return rows.withColumn("__kept", kept).drop("__later_id", "__later_mark", "__places")


def _text() -> Column:
    return F.array_join(F.transform("__kept", lambda i: F.get("__lines", i)), "\n")


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per document: id, n_lines, n_removed, kept_sha256 (of the kept lines joined by a line feed)."""
    rows = _marked(docs.select(id_col, text_col), id_col, text_col, width)
    return rows.select(
        F.col(id_col).cast("long").alias(id_col),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size("__kept")).cast("long").alias("n_removed"),
        F.sha2(_text(), 256).alias("kept_sha256"),
    )


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """The documents with their columns, repeated lines removed; those that lose all lines are dropped."""
    rows = _marked(docs, id_col, text_col, width).where((F.size("__kept") > 0) | (F.size("__lines") == 0))
    text = F.when(docs[text_col].isNotNull(), _text())
    return rows.select(*[text.alias(c) if c == text_col else docs[c] for c in docs.columns])
