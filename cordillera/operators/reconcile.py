"""Near-equal identifiers: proposing corrections, checking them, and applying only what is certain.

Candidates are exact: an identifier cut at a mark is found by the cuts of the longer one,
and identifiers a few edits apart share a piece, as so many edits cannot touch all of
one piece more than their number.  No block is compared all against all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import sequence_ratio

LEAST_STEM = 8
LEAST_RATIO = 0.90


def _pieces(size: Column, i: Column, edits: int) -> tuple[Column, Column]:
    """Where piece i of ``edits`` + 1 even pieces of a text of that size begins, and how long it is."""
    parts = edits + 1
    base = F.floor(size / parts).cast("int")
    short = parts - size % parts
    begin = i * base + F.greatest(F.lit(0), i - short)
    return begin.cast("int"), (base + F.when(i >= short, 1).otherwise(0)).cast("int")


def piece_keys(x: Column, edits: int) -> Column:
    """Keys of the pieces of a text."""
    size = F.length(x)

    def key(i: Column) -> Column:
        begin, long = _pieces(size, i, edits)
        return F.concat_ws(":", size, i, x.substr(begin + 1, long))

    return F.transform(F.sequence(F.lit(0), F.lit(edits)), key)


def probe_keys(x: Column, edits: int) -> Column:
    """Keys that the pieces of a text no longer than this one have if it is ``edits`` edits away at most."""
    size = F.length(x)

    def keys(n: Column) -> Column:
        def at(i: Column) -> Column:
            begin, long = _pieces(n, i, edits)
            starts = F.filter(F.transform(F.sequence(F.lit(-edits), F.lit(edits)), lambda s: begin + s), lambda p: (p >= 0) & (p + long <= size))
            return F.transform(starts, lambda p: F.concat_ws(":", n, i, x.substr(p + 1, long)))

        return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(edits)), at))

    return F.array_distinct(F.flatten(F.transform(F.sequence(F.greatest(size - edits, F.lit(0)), size), keys)))


def near_pairs(values: DataFrame, scope: list[str], value: str, edits: int) -> DataFrame:
    """All pairs (left_value < right_value) of different values of a scope that are ``edits`` edits apart at most."""
    rows = values.select(*scope, F.col(value).alias("v")).where("v is not null").distinct()
    short = rows.select(*scope, F.col("v").alias("a"), F.explode(piece_keys(F.col("v"), edits)).alias("k"))
    long = rows.select(*scope, F.col("v").alias("b"), F.explode(probe_keys(F.col("v"), edits)).alias("k"))
    pairs = short.join(long, [*scope, "k"]).where("a <> b").select(*scope, F.least("a", "b").alias("left_value"), F.greatest("a", "b").alias("right_value")).distinct()
    return pairs.withColumn("distance", F.levenshtein("left_value", "right_value", edits)).where("distance >= 0")


def similar_suffixes(left: Column, right: Column, most: int = 2) -> Column:
    """truncation (one is the other cut at ``/``, ``.`` or ``-`` after 8 characters or more), edit (at most
    two edits and a matching ratio of 0.90), or null.
    """
    short, long = F.least(F.length(left), F.length(right)), F.greatest(F.length(left), F.length(right))
    shorter = F.when(F.length(left) <= F.length(right), left).otherwise(right)
    longer = F.when(F.length(left) <= F.length(right), right).otherwise(left)
    cut = longer.startswith(shorter) & (short >= LEAST_STEM) & (short < long) & longer.substr(short + 1, F.lit(1)).isin("/", ".", "-")
    edits = F.levenshtein(left, right, most)
    edit = (edits >= 0) & (short >= LEAST_STEM) & (sequence_ratio(left, right) >= LEAST_RATIO)
    return F.when(left == right, None).when(cut, "truncation").when(edit, "edit")


def similar_pairs(values: DataFrame, prefix: str, suffix: str, most: int = 2) -> DataFrame:
    """All pairs of different suffixes under one prefix that look alike."""
    rows = values.select(prefix, F.col(suffix).alias("s")).where("s is not null").distinct()
    near = near_pairs(rows, [prefix], "s", most).select(prefix, F.col("left_value").alias("left_suffix"), F.col("right_value").alias("right_suffix"))
    places = F.filter(F.sequence(F.lit(LEAST_STEM), F.greatest(F.length("s") - 1, F.lit(LEAST_STEM))), lambda n: F.col("s").substr(n + 1, F.lit(1)).isin("/", ".", "-"))
    cuts = rows.select(prefix, F.col("s").alias("long"), F.explode(F.transform(places, lambda n: F.col("s").substr(F.lit(1), n))).alias("s"))
    cut = cuts.join(rows, [prefix, "s"]).where("s <> long").select(prefix, F.least("s", "long").alias("left_suffix"), F.greatest("s", "long").alias("right_suffix"))
    pairs = near.unionByName(cut).distinct()
    return pairs.withColumn("how", similar_suffixes(F.col("left_suffix"), F.col("right_suffix"), most)).where("how is not null")


def decisions(pairs: DataFrame, checks: DataFrame, left: str, right: str, key: str, status: str) -> DataFrame:
    """confirmed_correction if exactly one side is verified, pending while a side is unknown, else review."""
    a = checks.select(F.col(key).alias(left), F.col(status).alias("__a"))
    b = checks.select(F.col(key).alias(right), F.col(status).alias("__b"))
    joined = pairs.join(a, left, "left").join(b, right, "left")
    good_a, good_b = F.col("__a") == "verified", F.col("__b") == "verified"
    unknown = F.col("__a").isNull() | F.col("__b").isNull()
    decision = F.when(unknown, "pending").when(good_a != good_b, "confirmed_correction").otherwise("review")
    correct = F.when(decision == "confirmed_correction", F.when(good_a, F.col(left)).otherwise(F.col(right)))
    wrong = F.when(decision == "confirmed_correction", F.when(good_a, F.col(right)).otherwise(F.col(left)))
    return joined.select(left, right, decision.alias("decision"), wrong.alias("wrong"), correct.alias("correct"))


def corrections(decided: DataFrame) -> DataFrame:
    """wrong -> correct where all confirmed proposals agree; contradictory ones are left out."""
    rows = decided.where("decision = 'confirmed_correction'").groupBy("wrong").agg(F.count_distinct("correct").alias("n"), F.min("correct").alias("correct"))
    return rows.where("n = 1").select("wrong", "correct")


def apply_corrections(documents: DataFrame, id_col: str, values: str, fixes: DataFrame) -> DataFrame:
    """Documents whose array has its wrong values replaced, in order and without repeats."""
    each = documents.select(id_col, F.posexplode(values).alias("__at", "__v")).join(fixes, F.col("__v") == F.col("wrong"), "left")
    each = each.select(id_col, "__at", F.coalesce("correct", "__v").alias("__v"))
    own = each.groupBy(id_col).agg(F.array_distinct(F.transform(F.sort_array(F.collect_list(F.struct("__at", "__v"))), lambda s: s["__v"])).alias("__new"))
    return documents.join(own, id_col, "left").withColumn(values, F.coalesce("__new", values)).drop("__new")
