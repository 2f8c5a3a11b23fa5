"""Exact dedup by content sort.

Sampled splitters range-partition the normalised texts, the partitions are sorted
by full content, and a streaming pass compares each text in full with the one
before it.  The splitters carry the row id as their last column, so a text that
makes up a third of all rows is spread over as many partitions as its share asks
for; the runs that touch a partition's first or last row are then joined by full
text, at most two for each partition.

The order is that of a text's first ``SPLITTER_CHARS`` characters, then of a hash of
it all, then of the whole text; so splitters are of bounded size, whatever texts are.

Nulls count as the empty text, and all empty texts are one group.  Of each group one
row stays, whichever ids it has: the one with the largest (or smallest) id, where an
id is better than none; of rows that repeat that id, one in the order of the hashes
of their texts as they were written.  Columns other than the id and text columns are
ignored by ``exact_groups``, whatever their names, and passed through by
``exact_dedup``.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frugal, one_of_each, partitions, row_mark, settled, without

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Characters of a text that the splitters carry; the rest is a 64-bit hash.
SPLITTER_CHARS = 32

RUNS = "id long, mark long, part int, run int, low long, high long, size long, best boolean, sha256 string, edge boolean, edge_text binary"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; the fast way where the text is ASCII throughout."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def _runs(keep: str):
    """Runs of equal neighbours in a sorted partition, one row for each member.

    A run's ids are kept until it ends; its text only once.  ``edge`` marks the
    first and the last run, which may go on in another partition, and ``best`` the
    row of the run that stays unless another part of the run has a better one.
    """
    names = [x.split()[0] for x in RUNS.split(", ")]
    kinds = [{"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}[x.split()[1]] for x in RUNS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, text, rows, part = -1, None, [], 0

        def done(last: bool) -> pa.RecordBatch:
            n, edge = len(rows), last or at == 0
            ids = [i for i, _ in rows if i is not None]
            low, high = min(ids, default=None), max(ids, default=None)
            wanted = high if keep == "max" else low
            best = next(k for k, (i, _) in enumerate(rows) if i == wanted)
            digest = hashlib.sha256(text).hexdigest()
            texts = [text if edge else None] + [None] * (n - 1)
            columns = [[i for i, _ in rows], [m for _, m in rows], [part] * n, [at] * n, [low] * n, [high] * n, [n] * n, [k == best for k in range(n)], [digest] * n, [edge] * n, texts]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        ready: list[pa.RecordBatch] = []
        for batch in batches:
            part = batch.column("part")[0].as_py() if batch.num_rows else part
            for i, m, t in zip(batch.column("id").to_pylist(), batch.column("mark").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                if t != text:
                    if rows:
                        ready.append(done(False))
                    at, text, rows = at + 1, t, []
                rows.append((i, m))
            if len(ready) > 1000:
                yield from pa.Table.from_batches(ready).combine_chunks().to_batches()
                ready = []
        if rows:
            ready.append(done(True))
        if ready:
            yield from pa.Table.from_batches(ready).combine_chunks().to_batches()

    return run


def _members(docs: DataFrame, id_col: str, text_col: str, keep: str) -> DataFrame:
    """One row per document: id, mark (see ``row_mark``), keep_id, group_size, kept, sha256."""
    spark = docs.sparkSession
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), row_mark(F.col(text_col)).alias("mark"), text.alias("text"))
    keyed = keyed.select("id", "mark", "text", F.substring("text", 1, SPLITTER_CHARS).alias("head"), F.xxhash64("text").alias("hash"))
    ranged = keyed.repartitionByRange(partitions(spark), "head", "hash", "id", "mark")
    ordered = ranged.sortWithinPartitions("head", "hash", "text", "id", "mark").select("id", "mark", "text", F.spark_partition_id().alias("part"))
    runs = settled(ordered.mapInArrow(frugal(_runs(keep)), RUNS))
    # At most two edge runs for each partition: their number is bounded by the partitions'.
    best_run = F.max(F.struct(F.col("high").isNotNull(), "high", "part", "run")) if keep == "max" else F.min(F.struct(F.col("low").isNull(), "low", "part", "run"))
    edges = runs.where("edge_text is not null").groupBy("edge_text").agg(
        F.min("low").alias("g_low"), F.max("high").alias("g_high"), F.sum("size").alias("g_size"),
        best_run.alias("g_best"), F.collect_list(F.struct("part", "run")).alias("at"),
    )
    edges = edges.select(F.explode("at").alias("at"), "g_low", "g_high", "g_size", F.col("g_best.part").alias("p"), F.col("g_best.run").alias("r"))
    edges = edges.select("at.part", "at.run", "g_low", "g_high", "g_size", ((F.col("at.part") == F.col("p")) & (F.col("at.run") == F.col("r"))).alias("g_best"))
    whole = runs.join(F.broadcast(edges), ["part", "run"], "left")
    best = F.when(F.col("g_size").isNull(), F.col("high") if keep == "max" else F.col("low")).otherwise(F.col("g_high") if keep == "max" else F.col("g_low"))
    return whole.select("id", "mark", best.alias("keep_id"), F.coalesce("g_size", "size").alias("group_size"), (F.col("best") & F.coalesce("g_best", F.lit(True))).alias("kept"), "sha256")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    ``keep`` says which row of equal texts stays: ``max`` or ``min`` by id.
    """
    return _members(docs, id_col, text_col, keep).select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """The documents that stay, with all their columns."""
    rows = _members(docs, id_col, text_col, keep)
    gone = rows.where("not kept")
    # Rows with the id and the text of the one that stays are told from it by number only.
    twins = settled(gone.where("id <=> keep_id").select("id", "mark", "sha256").distinct())
    if twins.isEmpty():
        return without(docs, gone, id_col, text_col)
    stays = rows.where("kept").select(F.col("id").alias("k_id"), F.col("mark").alias("k_mark"), F.col("sha256").alias("k_sha"))
    twins = twins.join(stays, F.col("id").eqNullSafe(F.col("k_id")) & (F.col("mark") == F.col("k_mark")) & (F.col("sha256") == F.col("k_sha")), "left_semi")
    twins = settled(twins.select(F.col("id").alias("t_id"), F.col("mark").alias("t_mark")).distinct())
    gone = gone.join(twins, F.col("id").eqNullSafe(F.col("t_id")) & (F.col("mark") == F.col("t_mark")), "left_anti")
    return one_of_each(without(docs, gone, id_col, text_col), twins.select(F.col("t_id").alias("id"), F.col("t_mark").alias("mark")), id_col, text_col)
