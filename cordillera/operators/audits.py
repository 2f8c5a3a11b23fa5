"""Audits: coverage, references, rules with bounded examples, and differences of versions."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def coverage(expected: DataFrame, found: DataFrame, key: str, compare: tuple[str, str] | None = None) -> DataFrame:
    """Counts of missing, unexpected, mismatched and covered keys."""
    a = expected.select(F.col(key).alias("k"), (F.col(compare[0]) if compare else F.lit(None)).alias("x"), F.lit(True).alias("in_a"))
    b = found.select(F.col(key).alias("k"), (F.col(compare[1]) if compare else F.lit(None)).alias("y"), F.lit(True).alias("in_b"))
    both = a.join(b, "k", "full_outer")
    state = F.when(F.col("in_b").isNull(), "missing").when(F.col("in_a").isNull(), "unexpected").when(~F.col("x").eqNullSafe(F.col("y")), "mismatch").otherwise("covered")
    return both.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


def unresolved(rows: DataFrame, reference: str, target: DataFrame, target_key: str, name: str, valid: Column | None = None) -> DataFrame:
    """One row: references in all, malformed ones, and ones without a target."""
    refs = rows.where(F.col(reference).isNotNull()).select(F.col(reference).alias("ref"), (valid if valid is not None else F.lit(True)).alias("ok"))
    keys = target.select(F.col(target_key).alias("ref")).distinct().withColumn("found", F.lit(True))
    joined = refs.join(keys, "ref", "left")
    return joined.agg(
        F.count(F.lit(1)).alias("refs"),
        F.count_if(~F.col("ok")).alias("malformed"),
        F.count_if(F.col("ok") & F.col("found").isNull()).alias("unresolved"),
    ).select(F.lit(name).alias("check"), "refs", "malformed", "unresolved")


def findings(rows: DataFrame, id_col: str, rules: dict[str, Column]) -> DataFrame:
    """One row for each rule that a row breaks."""
    kinds = F.array_compact(F.array(*[F.when(rule, F.lit(kind)) for kind, rule in rules.items()]))
    return rows.select(F.col(id_col).alias("id"), F.explode(kinds).alias("kind"))


def finding_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def bounded_examples(found: DataFrame, most: int) -> DataFrame:
    """The least ids of each kind, at most so many: a report, whose rank runs in two steps so that
    no kind's findings meet in one task before they are few.
    """
    spread = W.partitionBy("kind", F.pmod(F.xxhash64("id"), F.lit(64))).orderBy("id")
    few = found.withColumn("__r", F.row_number().over(spread)).where(F.col("__r") <= most).drop("__r")
    return few.withColumn("rank", F.row_number().over(W.partitionBy("kind").orderBy("id"))).where(F.col("rank") <= most)


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """added, removed, changed (with the names of the changed fields) and unchanged, counted."""
    a, b = old.select(key, *fields).alias("a"), new.select(key, *fields).alias("b")
    joined = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    changed = F.array_join(F.array_compact(F.array(*[F.when(~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")), F.lit(f)) for f in fields])), ",")
    state = F.when(F.col(f"a.{key}").isNull(), "added").when(F.col(f"b.{key}").isNull(), "removed").when(changed == "", "unchanged").otherwise("changed")
    return joined.select(state.alias("state"), F.when(state == "changed", changed).otherwise("").alias("fields")).groupBy("state", "fields").agg(F.count(F.lit(1)).alias("n"))


def multiset_diff(old: DataFrame, new: DataFrame, fields: list[str]) -> DataFrame:
    """How many copies of each row one side has more than the other."""
    sides = old.select(*fields, F.lit(1).alias("d")).unionByName(new.select(*fields, F.lit(-1).alias("d")))
    return sides.groupBy(*fields).agg(F.sum("d").alias("surplus")).where("surplus <> 0")


def same_rows(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has: an identity proof of a copy is that there are none."""
    left = a.join(b, key, "left_anti").select(key, F.lit("left").alias("only_in"))
    return left.unionByName(b.join(a, key, "left_anti").select(key, F.lit("right").alias("only_in")))


def gate(audits: DataFrame, counter: str, critical: Column) -> bool:
    """Whether nothing critical was counted; a publication asks for it first."""
    return not audits.where(critical).agg(F.coalesce(F.sum(counter), F.lit(0))).first()[0]


def normalisation_audit(raw: DataFrame, normal: DataFrame, key: str, parser: str) -> DataFrame:
    """kind and n of what separates raw pages (key, digest) from normalised ones (key, digest, parser, status, declared, actual)."""
    a, b = raw.alias("a"), normal.alias("b")
    both = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    here, there = F.col(f"a.{key}").isNotNull(), F.col(f"b.{key}").isNotNull()
    rules = {
        "missing_normalised": here & ~there, "unexpected_normalised": there & ~here, "content_hash_mismatch": here & there & ~F.col("a.digest").eqNullSafe(F.col("b.digest")),
        "parser_version_mismatch": there & ~F.col("b.parser").eqNullSafe(parser), "unfinished": there & (F.col("b.status") != "complete"), "declared_count_mismatch": there & ~F.col("b.declared").eqNullSafe(F.col("b.actual")),
    }
    counted = both.agg(*[F.count_if(F.coalesce(r, F.lit(False))).alias(k) for k, r in rules.items()])
    return counted.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("n")) for k in rules])).alias("x")).select("x.kind", "x.n")


def member_audit(groups: DataFrame, members: DataFrame, known: DataFrame) -> DataFrame:
    """kind and n: groups without members, members of unknown groups, members without a known code, and repeated memberships."""
    own = members.select("group", "code")
    checks = {
        "group_without_members": groups.select(F.col("id").alias("group")).join(own, "group", "left_anti"),
        "member_of_unknown_group": own.join(groups.select(F.col("id").alias("group")), "group", "left_anti"),
        "member_without_person": own.join(known.select("code"), "code", "left_anti"),
        "repeated_membership": own.groupBy("group", "code").agg(F.count(F.lit(1)).alias("n")).where("n > 1"),
    }
    return reduce(lambda a, b: a.unionByName(b), [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("kind"), "n") for k, df in checks.items()])


def paths_that_differ(old, new, at: str = "") -> Iterator[str]:
    """Paths of two values that differ; lists by place."""
    if isinstance(old, dict) and isinstance(new, dict):
        for k in sorted(old.keys() | new.keys()):
            yield from paths_that_differ(old.get(k), new.get(k), f"{at}.{k}" if at else k)
    elif isinstance(old, list) and isinstance(new, list) and len(old) == len(new):
        for k, (x, y) in enumerate(zip(old, new)):
            yield from paths_that_differ(x, y, f"{at}[{k}]")
    elif old != new:
        yield at


def document_diff(old: DataFrame, new: DataFrame, key: str, json_col: str, most: int = 25) -> DataFrame:
    """state of each document, and the paths of those that changed, ``most`` at most with their whole number."""
    a = old.select(F.col(key).alias("k"), F.col(json_col).alias("a"), F.lit(True).alias("in_a"))
    b = new.select(F.col(key).alias("k"), F.col(json_col).alias("b"), F.lit(True).alias("in_b"))
    kind = dict(old.dtypes)[key]

    def run(parts):
        for part in parts:
            out = []
            for k, x, y, here, there in zip(part["k"], part["a"], part["b"], part["in_a"], part["in_b"]):
                found = list(paths_that_differ(json.loads(x), json.loads(y))) if here is True and there is True else []
                state = "added" if here is not True else "removed" if there is not True else "changed" if found else "unchanged"
                out.append((k, state, ",".join(found[:most]), len(found)))
            yield pd.DataFrame(out, columns=["k", "state", "paths", "differences"])

    return a.join(b, "k", "full_outer").mapInPandas(run, f"k {kind}, state string, paths string, differences int")


def density(rows: DataFrame, number: str) -> DataFrame:
    """One row: least, greatest and count of a numbering, whether it is dense from 0, and its sum (nulls as 0)."""
    out = rows.agg(F.min(number).alias("least"), F.max(number).alias("greatest"), F.count(number).alias("n"), F.count_distinct(number).alias("kinds"), F.coalesce(F.sum(F.coalesce(number, F.lit(0))), F.lit(0)).alias("total"))
    return out.select("least", "greatest", "n", "total", ((F.col("least") == 0) & (F.col("greatest") == F.col("n") - 1) & (F.col("kinds") == F.col("n"))).alias("dense"))


def counter_rows(rows: DataFrame, value: str) -> DataFrame:
    """value and count, most frequent first, then by value."""
    return rows.groupBy(F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "value")
