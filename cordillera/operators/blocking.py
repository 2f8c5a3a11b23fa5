"""Blocking: groups of rows that may be the same thing, and pairs within bounded groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exact_blocks(rows: DataFrame, key: Column, member: str, least: int = 2, most: int | None = None) -> DataFrame:
    """Blocks by key with their size and least and greatest member; blank keys make no block."""
    out = rows.where(key != "").groupBy(key.alias("block_key")).agg(F.count(F.lit(1)).alias("size"), F.min(member).alias("first_id"), F.max(member).alias("last_id"))
    return out.where(F.col("size").between(least, most) if most else F.col("size") >= least)


def oversized_blocks(rows: DataFrame, key: list[str], most: int) -> DataFrame:
    """Blocks too large to compare, for review; they make no pairs."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > most)


def token_pair_keys(tokens: Column, longest: int = 3) -> Column:
    """Keys of all pairs among the longest tokens (ties by text), each pair in order."""
    distinct = F.array_distinct(tokens)
    ordered = F.transform(F.array_sort(F.transform(distinct, lambda t: F.struct((-F.length(t)).alias("n"), t.alias("t")))), lambda s: s["t"])
    top = F.array_sort(F.slice(ordered, 1, longest))
    pairs = F.flatten(F.transform(top, lambda a: F.transform(F.filter(top, lambda b: b > a), lambda b: F.concat_ws(" ", a, b))))
    return F.array_distinct(pairs)


def block_pairs(rows: DataFrame, id_col: str, keys: Column, most: int) -> DataFrame:
    """Distinct pairs left < right that share a key whose block has ``most`` members or fewer.

    The block bound is the operator's contract: larger blocks make no pairs here, and
    ``block_pairs_or_members`` returns them too. Sizes are summed before any pair is made.
    """
    exploded = rows.select(F.col(id_col).alias("id"), F.explode(keys).alias("k")).distinct()
    good = exploded.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n").between(2, most)).select("k")
    kept = exploded.join(good, "k")
    left, right = kept.select("k", F.col("id").alias("left_id")), kept.select("k", F.col("id").alias("right_id"))
    return left.join(right, "k").where("left_id < right_id").select("left_id", "right_id").distinct()


def title_keys(title: Column) -> Column:
    """Keys of a normal title: all pairs among its three longest tokens of any length, and the whole title."""
    words = F.filter(F.split(title, " "), lambda t: t != "")
    pairs = F.transform(token_pair_keys(words), lambda k: F.concat(F.lit("p "), k))
    return F.when(F.coalesce(title, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.array_append(pairs, F.concat(F.lit("t "), title)))


def block_pairs_or_members(rows: DataFrame, id_col: str, keys: Column, most: int) -> DataFrame:
    """Blocks without loss: pairs of blocks of ``most`` members or fewer, members of the larger ones.

    kind is ``pair`` (left_id < right_id; block and size are null), or ``oversized``: one row
    for each member (right_id) of a larger block, with the least member (left_id), the block's key
    and its size.  Any two members of an oversized block are a candidate pair too, so nothing that
    shares a key is left out, in rows that grow with the members and not with their square.
    """
    exploded = rows.select(F.col(id_col).alias("id"), F.explode(keys).alias("k")).distinct()
    sizes = exploded.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least")).where("n > 1")
    kept = exploded.join(sizes, "k")
    few, many = kept.where(F.col("n") <= most), kept.where(F.col("n") > most)
    left, right = few.select("k", F.col("id").alias("left_id")), few.select("k", F.col("id").alias("right_id"))
    pairs = left.join(right, "k").where("left_id < right_id").select("left_id", "right_id").distinct()
    pairs = pairs.select(F.lit("pair").alias("kind"), F.lit(None).cast("string").alias("block"), F.lit(None).cast("long").alias("size"), "left_id", "right_id")
    return pairs.unionByName(many.select(F.lit("oversized").alias("kind"), F.col("k").alias("block"), F.col("n").alias("size"), F.col("least").alias("left_id"), F.col("id").alias("right_id")))
