"""Embedding near-dedup by an epsilon grid order join.

Unit vectors are turned to their principal axes.  The cells of a grid of width
epsilon, the chord that belongs to the least cosine, order them lexicographically on
the leading axes; the order is cut into sequence intervals of at most about
``INTERVAL_BYTES``.  Pairs of intervals whose boxes lie further apart than epsilon
are never brought together; in a pair that is, halves are joined recursively, boxes
that are provably distant are skipped, and what is left is compared in double
precision by the vectors as they were given.

Equal vectors are compared once, as one row with a count.  A pair of intervals
returns one number of links for each vector and a spanning forest of the links, not
the links themselves.

Vectors that are null, zero, or hold null or non-finite components link with nothing
and keep themselves.  Vectors link with vectors of their own length, and each length
that two vectors or more have is ordered and joined by itself, on axes of its own.
Ties do not matter, as no vector is preferred to another but by id.  Rows that repeat
an id or have none are vectors like others: a component takes the least id that its
rows have, or null, and a row stays if that is its own.  Other columns are ignored; an
empty table gives an empty result.

Grid and boxes skip what they can prove distant, which is little where many dimensions
hold equal shares of the variance: pairs of intervals then grow with the square of the
vectors' bytes over ``INTERVAL_BYTES``, and so do the bytes that are sent.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import frugal, grouped, keyed, partitions, settled
from .components import Forest, components

#: Bytes of vectors in one interval of the order, about; a task holds two intervals.
INTERVAL_BYTES = 8 << 20
#: Intervals that smaller tables are cut into, so that tasks share the work; none has much fewer vectors than so many.
LEAST_INTERVALS, LEAST_VECTORS = 4, 1_024
#: Leading principal axes whose cells order the vectors.
GRID_AXES = 6
LEAF = 256
SLACK = 1e-6


def valid_vectors(vectors: DataFrame, id_col: str, vector_col: str, *others: str) -> DataFrame:
    """id, v (array of doubles) and other columns of the vectors that can link."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), *others)
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return rows.where(F.col("v").isNotNull() & (F.size("v") > 0)).where(finite)


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, safely for very large or small components."""
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def principal_axes(rows: DataFrame) -> np.ndarray:
    """Orthonormal axes, as columns, by falling variance of the unit vectors.

    The sums have one row for each pair of components, however many vectors there are.
    """

    def moments(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                x = unit(_matrix(batch.column("v")))
                own = np.vstack([x.sum(0), x.T @ x, np.full(x.shape[1], len(x))])
                total = own if total is None else total + own
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], ["i", "j", "x"])

    cells = rows.select("v").mapInArrow(frugal(moments), "i long, j long, x double").groupBy("i", "j").agg(F.sum("x").alias("x")).collect()
    if not cells:
        return np.eye(1)
    d = max(r["j"] for r in cells) + 1
    total = np.zeros((d + 2, d))
    for r in cells:
        total[r["i"], r["j"]] = r["x"]
    n, mean = total[-1, 0], total[0] / total[-1, 0]
    _, axes = np.linalg.eigh(total[1:-1] / n - np.outer(mean, mean))
    return axes[:, ::-1]


def box_apart(low_a: np.ndarray, high_a: np.ndarray, low_b: np.ndarray, high_b: np.ndarray) -> float:
    """Least squared distance between two boxes."""
    gap = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
    return float(gap @ gap)


def join_intervals(a: np.ndarray, b: np.ndarray | None, turned_a: np.ndarray, turned_b: np.ndarray | None, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows with a cosine of ``least`` or more; with itself (i < j) if b is None."""
    apart = 2 - 2 * least + SLACK
    # Single precision tells which blocks hold no link; the others are compared in double precision.
    single_a, single_b = a.astype(np.float32), None if b is None else b.astype(np.float32)
    doubt = np.float32(least - 1e-6 - 2.4e-7 * a.shape[1])
    found: list[np.ndarray] = []

    def go(i0: int, i1: int, j0: int, j1: int) -> None:
        if b is None and j1 <= i0 + 1:
            return
        other = turned_a if b is None else turned_b
        x, y = turned_a[i0:i1], other[j0:j1]
        if not len(x) or not len(y) or box_apart(x.min(0), x.max(0), y.min(0), y.max(0)) > apart:
            return
        if i1 - i0 <= LEAF and j1 - j0 <= LEAF:
            if (single_a[i0:i1] @ (single_a if b is None else single_b)[j0:j1].T).max() < doubt:
                return
            cosine = a[i0:i1] @ (a if b is None else b)[j0:j1].T
            i, j = np.nonzero(cosine >= least)
            i, j = i + i0, j + j0
            if b is None:
                i, j = i[i < j], j[i < j]
            found.append(np.stack([i, j]))
            return
        halves = lambda lo, hi: [(lo, hi)] if hi - lo <= LEAF else [(lo, (lo + hi) // 2), ((lo + hi) // 2, hi)]
        for p in halves(i0, i1):
            for q in halves(j0, j1):
                if b is not None or q[1] > p[0] + 1:
                    go(*p, *q)

    if b is None:
        go(0, len(a), 0, len(a))
    else:
        go(0, len(a), 0, len(b))
    pairs = np.concatenate([*found, np.zeros((2, 0), np.int64)], axis=1)
    return pairs[0], pairs[1]


def _links(axes: np.ndarray, least: float, kind: type):
    """Of each pair of intervals (rows come sorted by pair): links by vector, and a spanning forest."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        parts = [[np.frombuffer(x, t) for x in table.column(c).to_pylist()] for c, t in (("ids", np.int64), ("counts", np.int64), ("vectors", kind))]
        side = np.repeat(table.column("side").to_numpy(), [len(x) for x in parts[0]])
        ids, n, values = (np.concatenate(x) for x in parts)
        x = unit(values.reshape(len(ids), -1).astype(float))
        turned = x @ axes
        left, right = np.flatnonzero(side <= 0), np.flatnonzero(side > 0)
        cells = np.floor(turned[:, :GRID_AXES] / np.sqrt(max(1e-12, 2 - 2 * least)))
        order = lambda at: at[np.lexsort(cells[at].T[::-1])]
        left, right = order(left), order(right)
        if len(right):
            i, j = join_intervals(x[left], x[right], turned[left], turned[right], least)
            i, j = left[i], right[j]
        else:
            i, j = join_intervals(x[left], None, turned[left], None, least)
            i, j = left[i], left[j]
        links = np.bincount(i, n[j], minlength=len(ids)) + np.bincount(j, n[i], minlength=len(ids))
        some = np.flatnonzero(links)
        forest = Forest()
        if len(i):
            order_ = np.lexsort((j, i))
            for p, q in zip(ids[i[order_]].tolist(), ids[j[order_]].tolist()):
                forest.join(p, q)
        members, roots = forest.edges()
        members, roots = np.array(members, np.int64), np.array(roots, np.int64)  # ids do not pass through floats
        columns = [np.r_[ids[some], members], np.r_[np.zeros(len(some), np.int64), roots], np.r_[links[some].astype(np.int64), np.zeros(len(members), np.int64)]]
        counted = np.arange(len(columns[0])) < len(some)  # rows with links have no b, edges have one
        return pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array(columns[1], mask=counted), pa.array(columns[2])], ["a", "b", "links"])

    return grouped("pair", solve)


def linked_classes(rows: DataFrame, least: float, interval: int | None, kind: type) -> DataFrame:
    """v, links and component of each distinct vector; all are of one length, and ``kind`` holds their numbers without loss."""
    classes = settled(rows.groupBy("v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")))
    axes = principal_axes(classes)
    count = classes.count()
    most = interval or max(1, INTERVAL_BYTES // (len(axes) * np.dtype(kind).itemsize))
    blocks = max(1, -(-count // most), min(LEAST_INTERVALS, count // LEAST_VECTORS) if interval is None else 0)
    epsilon = float(np.sqrt(max(1e-12, 2 - 2 * least)))

    def ordered(batches):
        for batch in batches:
            if batch.num_rows:
                turned = unit(_matrix(batch.column("v"))) @ axes
                cells = np.floor(turned[:, :GRID_AXES] / epsilon).astype(np.int64)
                cells = np.pad(cells, ((0, 0), (0, GRID_AXES - cells.shape[1])))
                key = np.zeros(len(cells), np.int64)
                for k in range(GRID_AXES):  # lexicographic: a cell number takes 10 bits
                    key = key << 10 | np.clip(cells[:, k] + 512, 0, 1023)
                yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("n"), batch.column("v"), pa.array(key)], ["id", "n", "v", "cell"])

    cells = classes.mapInArrow(frugal(ordered), "id long, n long, v array<double>, cell long")

    def packed(batches):
        """One row for each partition of the order: its box, and its vectors in one piece."""
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts).combine_chunks()
        values = _matrix(table.column("v").combine_chunks())
        turned = unit(values) @ axes
        columns = [pa.array([table.column("part")[0].as_py()], pa.int32()), pa.array([turned.min(0).tolist()]), pa.array([turned.max(0).tolist()])]
        columns += [pa.array([x.tobytes()], pa.binary()) for x in (table.column("id").to_numpy(), table.column("n").to_numpy(), values.astype(kind))]
        yield pa.RecordBatch.from_arrays(columns, ["part", "low", "high", "ids", "counts", "vectors"])

    ranged = cells.repartitionByRange(blocks, "cell", "id").select("id", "n", "v", F.spark_partition_id().alias("part"))
    placed = settled(ranged.mapInArrow(frugal(packed), "part int, low array<double>, high array<double>, ids binary, counts binary, vectors binary"))
    # Spark may cut the order into more parts than asked for: neighbours make up one interval.
    parts = (placed.agg(F.max("part")).first()[0] or 0) + 1
    placed = placed.withColumn("block", F.floor(F.col("part") * min(blocks, parts) / parts).cast("int"))
    fold = lambda c, f: F.aggregate(F.slice(c, 2, F.size(c)), F.element_at(c, 1), lambda x, y: F.zip_with(x, y, f))
    box = placed.groupBy("block").agg(F.collect_list("low").alias("l"), F.collect_list("high").alias("h"))
    box = box.select("block", fold(F.col("l"), lambda x, y: F.least(x, y)).alias("low"), fold(F.col("h"), lambda x, y: F.greatest(x, y)).alias("high"))
    # Boxes meet by cells of the first two axes, salted so that a cell which many boxes share is many keys.
    cell_of = lambda c, k: F.floor(F.coalesce(F.get(c, F.lit(k)), F.lit(0.0)) / epsilon)
    salts = max(1, min(partitions(rows.sparkSession), blocks // 64))
    box = settled(box)
    cells = lambda k, more: F.explode(F.sequence(cell_of(F.col("low"), k) - more, cell_of(F.col("high"), k) + more)).alias(f"cell_{k}")
    one = box.select("*", cells(0, 0)).select("*", cells(1, 0)).select(F.col("block").alias("p"), F.col("low").alias("low_p"), F.col("high").alias("high_p"), "cell_0", "cell_1", F.pmod("block", F.lit(salts)).alias("salt"))
    two = box.select("*", cells(0, 1)).select("*", cells(1, 1)).select(F.col("block").alias("q"), F.col("low").alias("low_q"), F.col("high").alias("high_q"), "cell_0", "cell_1", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    gap = F.zip_with(F.zip_with("low_p", "high_q", lambda x, y: x - y), F.zip_with("low_q", "high_p", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    apart = F.aggregate(gap, F.lit(0.0), lambda s, x: s + x * x)
    pairs = one.join(two, ["cell_0", "cell_1", "salt"]).where("p <= q").where(apart <= epsilon**2 + SLACK).select("p", "q").distinct()
    pair = F.concat_ws("-", "p", "q").alias("pair")
    sides = pairs.select(pair, F.col("p").alias("block"), F.when(F.col("p") == F.col("q"), -1).otherwise(0).alias("side"))
    sides = sides.unionByName(pairs.where("p < q").select(pair, F.col("q").alias("block"), F.lit(1).alias("side")))
    dealt = placed.join(sides, "block").select("pair", "side", "ids", "counts", "vectors")
    found = settled(dealt.repartition("pair").sortWithinPartitions("pair").mapInArrow(frugal(_links(axes, least, kind)), "a long, b long, links long"))
    links = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    roots = components(found.where("b is not null").select("a", "b")).select(F.col("node").alias("rep"), "component")
    whole = classes.select("v", "rep", "n").join(links, "rep", "left").join(roots, "rep", "left")
    return whole.select("v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("component", "rep").alias("component"))


def embedding_links(vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", interval: int | None = None) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    ``interval``: vectors in one interval of the order, about; by default as many as ``INTERVAL_BYTES`` hold.
    """
    kind = np.float32 if isinstance(getattr(vectors.schema[vector_col].dataType, "elementType", None), T.FloatType) else np.float64
    vectors = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    marked, odd = keyed(vectors, "id", F.col("v"))
    marked = marked.withColumnRenamed("id", "own").withColumnRenamed("__key", "id")
    rows = valid_vectors(marked, "id", "v")
    lengths = [r["d"] for r in rows.groupBy(F.size("v").alias("d")).count().where("count > 1").orderBy("d").collect()]  # a row for each length
    none = rows.limit(0).select("v", F.lit(0).cast("long").alias("links"), F.col("id").alias("component"))
    parts = [linked_classes(rows.where(F.size("v") == d), least, interval, kind) for d in lengths]
    whole = reduce(lambda a, b: a.unionByName(b), parts) if parts else none
    if not odd:
        members = rows.join(whole, "v").select("id", "links", "component")
        every = marked.select("id").join(members, "id", "left")
        component = F.coalesce("component", "id")
        return every.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).alias("n_links"), component.alias("component_id"), (component == F.col("id")).alias("kept"))
    # Keys of rows without an id of their own are no ids: components are named by the ids that they have.
    good = valid_vectors(marked, "id", "v", "own").join(whole, "v", "left").select("id", "own", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "id").alias("component"))
    bad = marked.join(rows.select("id").distinct(), "id", "left_anti").select("id", "own", F.lit(0).cast("long").alias("links"), F.col("id").alias("component"))
    every = settled(good.unionByName(bad))
    named = every.groupBy("component").agg(F.min("own").alias("component_id"))
    out = every.join(named, "component")
    return out.select(F.col("own").alias(id_col), F.col("links").alias("n_links"), "component_id", F.col("component_id").eqNullSafe(F.col("own")).alias("kept"))
