"""Helpers that every operator of this subpackage shares."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import tempfile
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows in one Arrow batch; texts are long, and both sides of the pipe hold a batch.
ARROW_ROWS = "2000"


def lean(spark: SparkSession) -> None:
    """Small Arrow batches, unless the session has set a size of its own."""
    name, usual = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
    if spark.conf.get(name) == usual:
        spark.conf.set(name, ARROW_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark so that any store it knows will do."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only on a single machine may the session leave it unset: a local folder is set
    then. On a cluster that is an error, as executors would not see each other's files.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="cordillera-")
        spark.sparkContext.setCheckpointDir(found)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found


def settled(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder; later reads survive lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffles and checkpoints that no table needs any more; it does so when their objects are collected."""
    gc.collect()
    spark._jvm.System.gc()


#: Ids up to which a set of documents is broadcast; a larger one meets the documents in a shuffle.
BROADCAST_IDS = 200_000


def sized(ids: DataFrame, most: int = BROADCAST_IDS) -> DataFrame:
    """``ids`` written once, and marked for broadcast only if it is counted to be small."""
    ids = settled(ids)
    return F.broadcast(ids) if ids.count() <= most else ids


def row_mark(text: Column) -> Column:
    """With the id it tells rows apart: rows that agree in both hold the same text."""
    return F.xxhash64(text)


def lasting_mark(rows: DataFrame, id_col: str, text_col: str) -> Column:
    """``row_mark`` where rows repeat an id, else 0: what tells rows of one id apart costs nothing where there are none."""
    ids = rows.select(F.col(id_col).alias("id")).where("id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return F.lit(0).cast("long") if ids.isEmpty() else row_mark(F.col(text_col))


def _same_rows(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str, how: str) -> DataFrame:
    rows = rows.select(F.col("id").alias("__row_id"), F.col("mark").alias("__row_mark"))
    return docs.join(rows, docs[id_col].eqNullSafe(rows["__row_id"]) & (row_mark(docs[text_col]) == rows["__row_mark"]), how)


def without(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str, most: int = BROADCAST_IDS) -> DataFrame:
    """The documents without the rows that ``gone`` names by id (null: none) and mark."""
    return _same_rows(docs, sized(gone.select("id", "mark"), most), id_col, text_col, "left_anti")


def one_of_each(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str, most: int = BROADCAST_IDS) -> DataFrame:
    """The documents, but of those that ``rows`` names by id and mark one for each id and mark."""
    rows = sized(rows.select("id", "mark"), most)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = _same_rows(docs, rows, id_col, text_col, "left_semi").groupBy(F.col(id_col).alias("__i"), row_mark(F.col(text_col)).alias("__m")).agg(F.any_value(whole).alias("__row"))
    return _same_rows(docs, rows, id_col, text_col, "left_anti").unionByName(one.select("__row.*"))


def keyed(rows: DataFrame, id_col: str, content: Column) -> tuple[DataFrame, bool]:
    """``rows`` with a long column ``__key`` that is the id where one row has it, and whether any has not.

    Rows that have no id, or an id that other rows have too, get a key from id and
    content instead, which no id is; those that agree in both share it. What such
    rows cost is one sum over the ids where there are none.
    """
    i = F.col(id_col).cast("long")
    ids = settled(rows.select(i.alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or id is null").select(F.col("id").alias("__odd_id")))
    if ids.isEmpty():
        return rows.withColumn("__key", i), False
    odd = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    marked = rows.join(odd.withColumn("__odd", F.lit(True)), i.eqNullSafe(F.col("__odd_id")), "left").drop("__odd_id")
    for seed in range(100):
        out = marked.withColumn("__key", F.when(F.col("__odd"), F.xxhash64(F.lit(seed), i, content)).otherwise(i)).drop("__odd")
        made = marked.where("__odd").select(F.xxhash64(F.lit(seed), i, content).alias("__made")).distinct()
        if rows.join(made, i == F.col("__made"), "left_semi").isEmpty():
            return out, True
    raise RuntimeError("no keys for rows without an id of their own")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whichever store holds it."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_dir(spark), name)


def grouped(key: str, solve: Callable[[pa.Table], pa.RecordBatch]):
    """A mapInArrow function that calls ``solve`` with all rows of each key; rows come sorted by key."""

    def run(batches):
        rest: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            if not len(keys):
                continue
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for at, end in zip(cuts, cuts[1:]):
                if rest and keys[at] != last:
                    yield solve(pa.Table.from_batches(rest))
                    rest = []
                rest.append(batch.slice(at, end - at))
                last = keys[at]
        if rest:
            yield solve(pa.Table.from_batches(rest))

    return run


@functools.lru_cache(maxsize=1)
def _libc():
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:  # another C library keeps its memory its own way
        return None


#: What empties tables that a module keeps between tasks.
FORGET: list[Callable[[], None]] = []


def tidy() -> None:
    """Give memory that is free back to the system: an idle Python worker must not hold its peak."""
    for forget in FORGET:
        forget()
    pa.default_memory_pool().release_unused()
    if _libc() is not None:
        _libc().malloc_trim(0)


def frugal(run: Callable) -> Callable:
    """``run``, a mapInArrow function, tidied up after."""

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            tidy()

    return tidied
