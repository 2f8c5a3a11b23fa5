"""Cohorts, manifests, priority labels and record comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def priority_index(sources: list[tuple[DataFrame, Column, str]]) -> DataFrame:
    """code and the sorted labels of the sources that name it."""
    parts = [df.select(code.alias("code"), F.lit(label).alias("label")).where("code is not null") for df, code, label in sources]
    union = reduce(lambda a, b: a.unionByName(b), parts).distinct()
    return union.groupBy("code").agg(F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"))


def ordered_union(sources: list[tuple[DataFrame, Column]]) -> DataFrame:
    """Distinct codes with the rank of the first source that has them."""
    parts = [df.select(code.alias("code"), F.lit(rank).alias("rank")) for rank, (df, code) in enumerate(sources)]
    return reduce(lambda a, b: a.unionByName(b), parts).where("code is not null").groupBy("code").agg(F.min("rank").alias("rank"))


def stable_sample(codes: DataFrame, size: int, seed: str) -> DataFrame:
    """The ``size`` codes with the least SHA-256 of seed:code; each task keeps that many at most."""
    return codes.select("code", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("code").cast("string")), 256).alias("draw")).orderBy("draw").limit(size)


def cohort(priority: DataFrame, reference: DataFrame, size: int, seed: str) -> DataFrame:
    """A balanced sample of codes that are new and codes that can be refreshed."""
    new = stable_sample(priority.select("code").join(reference.select("code"), "code", "left_anti"), size, seed)
    refresh = stable_sample(priority.select("code").join(reference.select("code"), "code", "left_semi"), size, seed)
    return new.withColumn("segment", F.lit("new")).unionByName(refresh.withColumn("segment", F.lit("refresh")))


def content_changes(old: DataFrame, new: DataFrame, key: str, digest: str, status: str) -> DataFrame:
    """Status transitions with how many contents changed."""
    a = old.select(key, F.col(digest).alias("__a"), F.col(status).alias("old_status"))
    b = new.select(key, F.col(digest).alias("__b"), F.col(status).alias("new_status"))
    changed = F.count_if(~F.col("__a").eqNullSafe(F.col("__b")))
    return a.join(b, key).groupBy("old_status", "new_status").agg(F.count(F.lit(1)).alias("n"), changed.alias("changed"))
