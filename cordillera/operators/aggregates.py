"""Distributions, consensus, histories and fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def type_distribution(rows: DataFrame, type_col: str, member_col: str, default: str) -> DataFrame:
    """type, records and distinct members, blanks under ``default``; most frequent first."""
    kind = F.coalesce(F.nullif(F.trim(F.col(type_col)), F.lit("")), F.lit(default))
    out = rows.groupBy(kind.alias("type")).agg(F.count(F.lit(1)).alias("records"), F.countDistinct(member_col).alias("members"))
    return out.orderBy(F.desc("records"), "type")


def bucket_label(value: Column, bounds: list[int]) -> Column:
    """``low-high`` of the first inclusive bound that holds, else ``>last``."""
    label, low = None, 0
    for high in bounds:
        label = F.when(value <= high, f"{low}-{high}") if label is None else label.when(value <= high, f"{low}-{high}")
        low = high + 1
    return label.otherwise(f">{bounds[-1]}")


def histogram(rows: DataFrame, value: Column, bounds: list[int]) -> DataFrame:
    return rows.where(value.isNotNull()).groupBy(bucket_label(value, bounds).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def mode_by(rows: DataFrame, key: list[str], value: str) -> DataFrame:
    """The most frequent value of each key, the smallest of those that tie."""
    counted = rows.where(F.col(value).isNotNull()).groupBy(*key, value).agg(F.count(F.lit(1)).alias("__n"))
    return counted.groupBy(*key).agg(F.min_by(value, F.struct(-F.col("__n"), F.col(value))).alias(value), F.max("__n").alias("support"))


def representative(rows: DataFrame, key: list[str], value: str) -> DataFrame:
    """The longest spelling of each key, then the greatest."""
    return rows.groupBy(*key).agg(F.max_by(value, F.struct(F.length(value), F.col(value))).alias(value))


def consensus(rows: DataFrame, key: list[str], value: str) -> DataFrame:
    """missing, consistent or conflict, by how many different values a key has."""
    out = rows.groupBy(*key).agg(F.count_distinct(value).alias("values"), F.min(value).alias("__v"))
    status = F.when(F.col("values") == 0, "missing").when(F.col("values") == 1, "consistent").otherwise("conflict")
    return out.select(*key, "values", status.alias("status"), F.when(F.col("values") == 1, F.col("__v")).alias("value"))


def date_consensus(rows: DataFrame, key: list[str], date: str) -> DataFrame:
    """One year is required; the month must be the only one, and so must the day, which is 1 otherwise."""
    part = lambda f, name: F.when(F.count_distinct(f(date)) == 1, F.min(f(date))).alias(name)
    out = rows.where(F.col(date).isNotNull()).groupBy(*key).agg(part(F.year, "year"), part(F.month, "__m"), part(F.dayofmonth, "__d"))
    month = F.when(F.col("year").isNotNull(), F.col("__m"))
    day = F.when(month.isNotNull(), F.coalesce("__d", F.lit(1)))
    status = F.when(F.col("year").isNull(), "conflict").when(month.isNull(), "year").when(F.col("__d").isNull(), "month").otherwise("day")
    return out.select(*key, "year", month.alias("month"), day.alias("day"), status.alias("precision"))


def last_non_empty(value: str, order: Column) -> Column:
    """The value at the greatest order among those that are not blank."""
    return F.max_by(value, F.when(F.coalesce(F.col(value).cast("string"), F.lit("")) != "", order))


def history(rows: DataFrame, key: str, when: str, tie: str, fields: list[str]) -> DataFrame:
    """One row per key: entries, first and last time, and the latest non-empty value of each field."""
    order = F.struct(F.col(when), F.col(tie))
    return rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("entries"),
        F.min(when).alias("first_seen"),
        F.max(when).alias("last_seen"),
        *[last_non_empty(f, order).alias(f"latest_{f}") for f in fields],
    )


def history_documents(rows: DataFrame, key: str, order: list[str], fields: list[str]) -> DataFrame:
    """One JSON array of entries per key, ordered; a key's history fits one row by contract."""
    entry = F.struct(*order, *[f for f in fields if f not in order])
    return rows.groupBy(key).agg(F.to_json(F.sort_array(F.collect_list(entry))).alias("history"))


def canonical_json(columns: list[str]) -> Column:
    return F.to_json(F.struct(*sorted(columns)))


def line_of(columns: list[str]) -> Column:
    """A row as text, columns by name; nulls are not blanks."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in sorted(columns)])


def fingerprint(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows and two order-free digests of all rows, from SHA-256; any size, one partial sum for each task."""
    part = lambda k: F.conv(F.substring(F.sha2(line_of(columns), 256), k, 15), 16, 10).cast("long")
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.bit_xor(part(1)), F.lit(0)).alias("xor_digest"), F.coalesce(F.sum(F.pmod(part(16), F.lit(2_147_483_647))), F.lit(0)).alias("sum_digest"))
