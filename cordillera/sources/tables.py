"""Reading input tables, strict readers, and intermediate tables in the shared folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def json_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A JSON file that is one array of objects; anything malformed is an error, never a null row."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def csv_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A delimited export with a header; malformed rows are an error."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def ensure_shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; only a single machine may leave it unset and gets a local folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="cordillera-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found


def settled(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder, its lineage cut."""
    ensure_shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def row_ids(df: DataFrame, dataset: str, *order: str) -> DataFrame:
    """Deterministic ``_id`` = dataset:%010d by a total order, numbered partition by partition.

    A global row number would send every row to one task; instead the rows are sorted
    by range and each partition's start is a running sum over partition counts.
    """
    ranged = settled(df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()))
    numbered = ranged.withColumn("__n", F.monotonically_increasing_id() - F.col("__part").cast("long") * F.lit(1 << 33))
    counts = {r["__part"]: r["n"] for r in ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a partition
    starts, total = {}, 0
    for part in sorted(counts):
        starts[part], total = total, total + counts[part]
    start = F.create_map(*[F.lit(x) for pair in starts.items() for x in pair])[F.col("__part")] if starts else F.lit(0)
    return numbered.withColumn("_id", F.format_string(f"{dataset}:%010d", start + F.col("__n"))).drop("__part", "__n")
