"""Connected components of an edge table, by alternating large-star and small-star steps.

Each task first contracts its own edges; each round is grouped sums and joins, and
its edges are written to the shared folder, so that no lineage grows and nothing is
gathered on the driver but one row of checksums.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frugal, settled

MAX_ROUNDS = 60


class Forest:
    """Union-find in which the least member of a set is its root."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def edges(self) -> tuple[list[int], list[int]]:
        """Each member that is not its own root, and its root."""
        members = [x for x in self.parent if self.find(x) != x]
        return members, [self.find(x) for x in members]


def _contract(batches):
    forest = Forest()
    for batch in batches:
        a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
        pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1) if len(a) else np.zeros((2, 0), np.int64)
        for x, y in pairs.T.tolist():
            forest.join(x, y)
    members, roots = forest.edges()
    yield pa.RecordBatch.from_arrays([pa.array(members, pa.int64()), pa.array(roots, pa.int64())], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """node and component, the least node reachable, of every node that is not its own component.

    ``edges`` has long columns a and b, in any order and with any repeats or loops.
    """
    found = settled(edges.select("a", "b").mapInArrow(frugal(_contract), "a long, b long").distinct())
    seen = None
    for _ in range(MAX_ROUNDS):
        both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        found = settled(small.where("a <> b").distinct())
        now = found.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x"), F.sum(F.expr("pmod(xxhash64(b, a), 1000003)")).alias("s")).first()
        if now == seen:
            return found.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = now
    raise RuntimeError(f"no components after {MAX_ROUNDS} rounds")
