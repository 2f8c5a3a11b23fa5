"""Conservative merging: nothing is invented, contradictions stay apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import partial_date
from ..functions.text import prefer_text
from .occurrences import merged_authors


def prefer_spelling(rows: DataFrame, key: Column, value: str) -> DataFrame:
    """The value a fold of ``prefer_text`` ends with: longest, then greatest."""
    return rows.groupBy(key.alias("key")).agg(F.max_by(value, F.struct(F.length(value), F.col(value))).alias("value"), F.count(F.lit(1)).alias("n"))


def merge_scalars(left: DataFrame, right: DataFrame, key: str, texts: list[str], others: list[str]) -> DataFrame:
    """Full outer merge of two versions: texts by the richer spelling, others left first."""
    a, b = left.alias("a"), right.alias("b")
    joined = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    columns = [F.coalesce(f"a.{key}", f"b.{key}").alias(key)]
    columns += [prefer_text(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in texts]
    columns += [F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in others]
    return joined.select(*columns)


def role_summary(rows: DataFrame, group: str, role: str, size: Column) -> DataFrame:
    """Members of each (group, role): how many, and how much text in all; more than one is a conflict."""
    out = rows.groupBy(group, role).agg(F.count(F.lit(1)).alias("members"), F.sum(size).alias("size"))
    return out.withColumn("conflict", F.col("members") > 1)


def role_precedence(rows: DataFrame, group: str, key: Column, role: str, ranking: list[str]) -> DataFrame:
    """One role for each (group, key): the first of the ranking that it has."""
    rank = F.array_position(F.array(*[F.lit(r) for r in ranking]), F.col(role))
    rank = F.when(rank == 0, len(ranking) + 1).otherwise(rank)
    return rows.groupBy(group, key.alias("key")).agg(F.min_by(role, F.struct(rank, F.col(role))).alias("role"), F.count(F.lit(1)).alias("claims"))


def superset_alias(names: DataFrame, group: str, name_key: str) -> DataFrame:
    """Names whose tokens (two or more) are a strict subset of exactly one other name of the group.

    Token pairs meet through their rarest shared token, so only names that share it are compared.
    """
    rows = names.select(group, F.col(name_key).alias("name"), F.array_distinct(F.split(name_key, " ")).alias("t")).distinct()
    counts = rows.select(group, F.explode("t").alias("k")).groupBy(group, "k").agg(F.count(F.lit(1)).alias("n"))
    each = rows.select(group, "name", "t", F.explode("t").alias("k")).join(counts, [group, "k"])
    rarest = each.where(F.size("t") >= 2).groupBy(group, "name").agg(F.min_by("k", F.struct("n", "k")).alias("k"), F.first("t").alias("t"))
    other = each.select(group, "k", F.col("name").alias("full"), F.col("t").alias("full_t"))
    pairs = rarest.join(other, [group, "k"]).where((F.size("full_t") > F.size("t")) & (F.size(F.array_except("t", "full_t")) == 0))
    found = pairs.groupBy(group, "name").agg(F.count(F.lit(1)).alias("n"), F.min("full").alias("alias_of"))
    return found.where("n = 1").select(group, "name", "alias_of")


def distinct_edges(rows: DataFrame, left: str, right: str, weight: Column) -> DataFrame:
    """One edge for each pair, with the greatest weight and how many rows bear it out."""
    return rows.groupBy(left, right).agg(F.max(weight).alias("weight"), F.count(F.lit(1)).alias("support"))


def merged_documents(rows: DataFrame, key: str, order: list[str], arrays: list[str], texts: list[str], others: list[str], people: str) -> DataFrame:
    """One document for each key: a fold of its versions in order.

    Arrays are joined without repeats, texts take the longest and then the greatest, other values the
    first that is there, and people (array of struct(id, full_name, role)) are merged by name and role.
    Versions at one place count in the order of their values, so the order of the rows decides nothing.
    """
    place = F.struct(*order)
    held = lambda c: F.flatten(F.transform(F.sort_array(F.collect_list(F.struct(place.alias("o"), F.col(c).alias("v")))), lambda x: F.coalesce(x["v"], F.array())))
    joined = [F.array_distinct(held(c)).alias(c) for c in arrays]
    best = [F.max_by(c, F.when(F.coalesce(F.col(c), F.lit("")) != "", F.struct(F.length(c), F.col(c)))).alias(c) for c in texts]
    first = [F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(place, F.col(c)))).alias(c) for c in others]
    out = rows.groupBy(key).agg(F.count(F.lit(1)).alias("versions"), *joined, *best, *first, held(people).alias("__people"))
    out = out.withColumn(people, merged_authors(F.col("__people"))).drop("__people")
    return out.withColumn("author_count", F.size(people))


def consensus_dates(rows: DataFrame, key: str, values: dict[str, str], as_of: str) -> DataFrame:
    """key and a (year, month) for each of ``values`` (output name: column of date texts), from all versions at once:
    a year that all valid ones share, and a month if they share one; a merge never lets the first version win.
    """
    parsed = rows.select(key, *[partial_date(F.col(c), as_of).alias(f"__{n}") for n, c in values.items()])
    aggregates = []
    for n in values:
        valid = F.col(f"__{n}.status") == "valid"
        for part in ("year", "month"):
            v = F.when(valid, F.col(f"__{n}.{part}"))
            aggregates.append(F.when(F.count_distinct(v) == 1, F.min(v)).alias(f"{n}_{part}"))
    out = parsed.groupBy(key).agg(*aggregates)
    return out.select(key, *[c for n in values for c in (F.col(f"{n}_year"), F.when(F.col(f"{n}_year").isNotNull(), F.col(f"{n}_month")).alias(f"{n}_month"))])
