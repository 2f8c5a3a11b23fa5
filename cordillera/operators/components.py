"""Connected components and guarded merging.

``connected`` alternates large-star and small-star steps over an edge table that each
task has contracted first.  ``guarded`` replays merges in a fixed order inside each
component that ignores the guards: no merge leaves such a component, so they are
independent.  Members that agree in what the guards look at and in their keys are
merged before, so that what a task gets are classes and not copies.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import settled

MAX_ROUNDS = 60


def _contract(batches):
    """A task's own edges as stars around their least members."""
    up: dict = {}

    def find(x):
        root = x
        while (above := up.setdefault(root, root)) != root:
            root = above
        while up[x] != root:
            up[x], x = root, up[x]
        return root

    schema = None
    for batch in batches:
        schema = batch.schema
        for x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            x, y = find(x), find(y)
            if x != y:
                up[max(x, y)] = min(x, y)
    if schema is not None:
        members = [x for x in up if find(x) != x]
        yield pa.RecordBatch.from_arrays([pa.array(members, schema.field("a").type), pa.array([find(x) for x in members], schema.field("a").type)], ["a", "b"])


def connected(edges: DataFrame) -> DataFrame:
    """node and component (the least node reachable) of every node of the edges (columns a and b)."""
    kind = dict(edges.dtypes)["a"]
    edges = edges.select("a", F.col("b").cast(kind).alias("b"))
    nodes = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    found = settled(edges.where("a <> b").mapInArrow(_contract, f"a {kind}, b {kind}").distinct())
    before = None
    for _ in range(MAX_ROUNDS):
        both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        found = settled(small.where("a <> b").distinct())
        now = found.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1_000_003)))).first()
        if now == before:
            roots = found.select(F.col("a").alias("node"), F.col("b").alias("component"))
            return nodes.join(roots, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
        before = now
    raise RuntimeError(f"no components after {MAX_ROUNDS} rounds")


def group_edges(rows: DataFrame, member: str, key: str) -> DataFrame:
    """A star for each key: its members and the least of them; linear in the rows."""
    least = rows.groupBy(key).agg(F.min(member).alias("a"))
    return rows.join(least, key).select("a", F.col(member).alias("b"))


def guarded(rows: DataFrame, component: str, schema: str, replay: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """``replay`` applied to each coarse component's rows."""
    return rows.groupBy(component).applyInPandas(replay, schema)


class SpreadForest:
    """Disjoint sets that merge only while the spread of their values stays within bounds."""

    def __init__(self, values: dict, spread: float):
        self.root = {k: k for k in values}
        self.low = dict(values)
        self.high = dict(values)
        self.spread = spread

    def find(self, x):
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return x

    def merge(self, a, b) -> bool:
        """Whether a and b are together afterwards."""
        a, b = sorted((self.find(a), self.find(b)))
        if a == b:
            return True
        low, high = min(self.low[a], self.low[b]), max(self.high[a], self.high[b])
        if high - low > self.spread:
            return False
        self.root[b], self.low[a], self.high[a] = a, low, high
        return True


def by_class(rows: DataFrame, member: str, key: str, values: list[str]) -> tuple[DataFrame, DataFrame]:
    """Classes of members that have the same keys and values: their rows (the least member stands for a class),
    and each member's class.  What is done to one member of a class in order of ids is done to all.
    """
    own = rows.groupBy(member).agg(F.sort_array(F.collect_set(key)).alias("__keys"), *[F.sort_array(F.collect_set(v)).alias(f"__v_{v}") for v in values])
    held = ["__keys", *[f"__v_{v}" for v in values]]
    own = settled(own.select(member, F.sha2(F.to_json(F.struct(*held)), 256).alias("__class")))
    least = own.groupBy("__class").agg(F.min(member).alias("__rep"))
    classes = own.join(least, "__class").select(member, "__rep")
    kept = rows.join(least.select(F.col("__rep").alias(member)), member, "left_semi")
    return kept, classes


def _of_all(found: DataFrame, classes: DataFrame, member: str) -> DataFrame:
    return classes.join(found.withColumnRenamed(member, "__rep"), "__rep").select(member, "root")


def spread_guarded(rows: DataFrame, member: str, key: str, value: str, spread: float) -> DataFrame:
    """member and root: members of a key merge in order of key and member unless the whole
    component's values would spread too far; a member joins the first anchor that takes it.
    """
    kept, classes = by_class(rows, member, key, [value])
    coarse = connected(group_edges(kept, member, key)).select(F.col("node").alias(member), F.col("component").alias("coarse"))
    kind = dict(rows.dtypes)

    def replay(part: pd.DataFrame) -> pd.DataFrame:
        forest = SpreadForest(dict(zip(part[member], part[value])), spread)
        for _, own in part.sort_values([key, member]).groupby(key, sort=True):
            anchors: list = []
            for m in own[member]:
                if not any(forest.merge(a, m) for a in anchors):
                    anchors.append(m)
        members = sorted(set(part[member]))
        return pd.DataFrame({member: members, "root": [forest.find(m) for m in members]})

    return _of_all(guarded(kept.join(coarse, member), "coarse", f"{member} {kind[member]}, root {kind[member]}", replay), classes, member)
