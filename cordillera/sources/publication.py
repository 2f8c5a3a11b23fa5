"""Versioned publication: names, ranks, gates, pointers and retention."""

from __future__ import annotations

import json
import time
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Fixed value: the grammar of published names.
NAME = r"^([a-z]+)_([a-z_]+?)_v(\d{2,})_(\d{8})(_filtered)?$"


def published_name(prefix: str, entity: str, version: int, date: str, filtered: bool = False) -> str:
    return f"{prefix}_{entity}_v{version:02d}_{date}" + "_filtered" * filtered


def parsed_name(name: Column) -> Column:
    """struct(entity, version, date, filtered), null for anything that is no published name."""
    part = lambda k: F.regexp_extract(name, NAME, k)
    good = name.rlike(NAME) & F.try_to_date(part(4), "yyyyMMdd").isNotNull()
    return F.when(good, F.struct(part(2).alias("entity"), part(3).cast("int").alias("version"), part(4).alias("date"), (part(5) != "").alias("filtered")))


def ranked(names: DataFrame, name: str) -> DataFrame:
    """Published names with their rank within the entity, 1 the latest (version, then date)."""
    rows = names.select(F.col(name).alias("name"), parsed_name(F.col(name)).alias("p")).where("p is not null").select("name", "p.*")
    order = W.partitionBy("entity", "filtered").orderBy(F.desc("version"), F.desc("date"))
    return rows.withColumn("rank", F.row_number().over(order))


def reachable(spark: SparkSession, roots: DataFrame, references: DataFrame, rounds: int = 30) -> DataFrame:
    """Names that can be reached from the roots over (source, target) references."""
    found = roots.select("name").distinct()
    fresh = found
    for _ in range(rounds):
        step = fresh.join(references, fresh["name"] == references["source"]).select(F.col("target").alias("name")).distinct()
        fresh = step.join(found, "name", "left_anti")
        if not fresh.limit(1).count():
            return found
        found = found.unionByName(fresh)
    raise RuntimeError("references go deeper than expected")


def retention(spark: SparkSession, names: DataFrame, references: DataFrame, keep: int = 2) -> DataFrame:
    """keep or expired: the latest ``keep`` of each entity and all they refer to stay."""
    order = ranked(names, "name")
    live = reachable(spark, order.where(F.col("rank") <= keep), references)
    marked = names.select("name").distinct().join(live.withColumn("__live", F.lit(True)), "name", "left")
    return marked.select("name", F.when(F.col("__live"), "keep").otherwise("expired").alias("action"))


class Pointer:
    """A pointer that moves only from the value it is known to have, and only forward.

    Each move is a file of its own, numbered in turn and created only where none is, so of
    two that move at once one fails, and a crash loses nothing: the value is that of
    the highest number which was written whole.  A number that was taken and not
    written holds others up for ``stale`` seconds.
    """

    def __init__(self, spark: SparkSession, path: str, stale: float = 600):
        self.jvm, self.conf, self.path, self.stale = spark._jvm, spark._jsc.hadoopConfiguration(), path.rstrip("/"), stale
        self.fs = self._at(self.path).getFileSystem(self.conf)

    def _at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def _text(self, where) -> str:
        stream = self.fs.open(where)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _moves(self) -> tuple[dict[int, float], dict[int, dict]]:
        """Numbers that were taken with their age in seconds, and those that were written with their value."""
        taken, written = {}, {}
        folder = self._at(self.path)
        for entry in self.fs.listStatus(folder) if self.fs.exists(folder) else ():
            number, _, kind = entry.getPath().getName().partition(".")
            if number.isdigit() and kind == "taken":
                taken[int(number)] = time.time() - entry.getModificationTime() / 1000
            elif number.isdigit() and kind == "json":
                try:
                    written[int(number)] = json.loads(self._text(entry.getPath()))
                except ValueError:
                    continue  # it is being written, or never was
        return taken, written

    def read(self) -> dict | None:
        written = self._moves()[1]
        return written[max(written)] if written else None

    def publish(self, value: dict, expected: dict | None) -> None:
        """Move to ``value`` (with version and date) if the pointer still holds ``expected``."""
        taken, written = self._moves()
        now = written[max(written)] if written else None
        if now != expected:
            raise RuntimeError("the pointer has moved since it was read")
        if now and (value["version"], value["date"]) <= (now["version"], now["date"]):
            raise ValueError("a pointer does not go back")
        last = max([0, *written])
        if any(n > last and age < self.stale for n, age in taken.items()):
            raise RuntimeError("the pointer is being moved")
        number = max([0, *taken, *written]) + 1
        try:
            self.fs.create(self._at(f"{self.path}/{number:08d}.taken"), False).close()
        except Exception as e:
            raise RuntimeError("the pointer is being moved") from e
        if any(n > last and n != number and age < self.stale for n, age in self._moves()[0].items()):
            raise RuntimeError("the pointer is being moved")
        out = self.fs.create(self._at(f"{self.path}/{number:08d}.json"), False)
        out.write(json.dumps(value, sort_keys=True).encode())
        out.close()


def write_json_array(df: DataFrame, path: str) -> int:
    """One JSON file that is an array of all rows, in order, streamed row by row and put in place whole; how many rows."""
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    staged, n = at(f"{path}.{uuid.uuid4().hex}"), 0
    out = fs.create(staged, False)
    out.write(b"[")
    for n, row in enumerate(df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("x")).toLocalIterator(prefetchPartitions=True), 1):
        out.write((",\n" if n > 1 else "\n").encode() + row["x"].encode())
    out.write(b"\n]\n")
    out.close()
    if fs.exists(at(path)):
        fs.delete(at(path), False)
    if not fs.rename(staged, at(path)):
        raise RuntimeError(f"{path} could not be put in place")
    return n


def write_sheets(sheets: dict[str, DataFrame], folder: str) -> None:
    """A workbook as a folder: one delimited sheet with a header for each name."""
    for name, df in sheets.items():
        df.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(f"{folder}/{name}")


def sheet_audit(spark: SparkSession, folder: str, expected: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """sheet, rows read back, rows expected, and keys that only one side has; a sheet is good if they agree."""
    parts = []
    for name, (df, key) in expected.items():
        read = spark.read.option("header", True).option("escape", '"').csv(f"{folder}/{name}").select(F.col(key).cast("string").alias("k"), F.lit(1).alias("d"))
        sides = read.unionByName(df.select(F.col(key).cast("string").alias("k"), F.lit(-1).alias("d")))
        by_key = sides.groupBy("k").agg(F.sum("d").alias("d"), F.count_if(F.col("d") > 0).alias("r"), F.count_if(F.col("d") < 0).alias("e"))
        parts.append(by_key.agg(F.coalesce(F.sum("r"), F.lit(0)).alias("rows"), F.coalesce(F.sum("e"), F.lit(0)).alias("expected"), F.count_if(F.col("d") != 0).alias("differ")).select(F.lit(name).alias("sheet"), "rows", "expected", "differ"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def release_audit(checks: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """entity, check and n: rows that break a rule of a release; it may stand if no n is above zero."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(entity).alias("entity"), F.lit(check).alias("check"), "n") for (entity, check), df in checks.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def structure_checks(entity: str, documents: DataFrame, other_fields: list[str], id_col: str = "id") -> dict[tuple[str, str], DataFrame]:
    """The structural checks of an entity's release: ids that are null, blank or repeated, fields that should not be there, and no rows at all."""
    ids = documents.select(F.col(id_col).cast("string").alias("i"))
    unexpected = [c for c in documents.columns if c in other_fields]
    none = documents.sparkSession.range(1).where(F.lit(documents.isEmpty())).select(F.lit(1).alias("x"))
    return {
        (entity, "missing_id"): ids.where("coalesce(trim(i), '') = ''"), (entity, "repeated_id"): ids.groupBy("i").agg(F.count(F.lit(1)).alias("n")).where("n > 1"),
        (entity, "unexpected_field"): documents.sparkSession.createDataFrame([(c,) for c in unexpected], "field string"), (entity, "empty"): none,
    }


def proofs(audits: DataFrame, wanted: DataFrame) -> DataFrame:
    """entity, run and proof of wanted audits: passed, failed (critical), incomplete, or missing; stored audits never change."""
    held = audits.groupBy("entity", "run").agg(F.max("status").alias("status"), F.sum("critical").alias("critical"))
    out = wanted.join(held, ["entity", "run"], "left")
    proof = F.when(F.col("status").isNull(), "missing").when(F.col("status") != "complete", "incomplete").when(F.col("critical") > 0, "failed").otherwise("passed")
    return out.select("entity", "run", proof.alias("proof"))


def cleanup_plan(candidates: DataFrame, protected: DataFrame, existing: DataFrame) -> DataFrame:
    """name and action: drop what was named, is there and is not protected; refuse protected names; absent ones are done."""
    out = candidates.select("name").distinct().join(protected.select("name", F.lit(True).alias("p")).distinct(), "name", "left").join(existing.select("name", F.lit(True).alias("e")).distinct(), "name", "left")
    return out.select("name", F.when(F.col("p"), "refused").when(F.col("e"), "drop").otherwise("absent").alias("action"))


def output_plan(existing: DataFrame, keep: list[str], intermediates: DataFrame, dependants: DataFrame) -> DataFrame:
    """name and action of existing outputs when exactly the named two stay.

    keep, drop (a known intermediate that nothing live reads), in_use, or unknown: one that is in_use or unknown stops the clean-up.
    ``dependants`` has source (who reads) and target (what is read).
    """
    known = intermediates.select("name", F.lit(True).alias("known")).distinct()
    live = dependants.where(~F.col("source").isin(*keep)).select(F.col("target").alias("name"), F.lit(True).alias("live")).distinct()
    out = existing.select("name").distinct().join(known, "name", "left").join(live, "name", "left")
    action = F.when(F.col("name").isin(*keep), "keep").when(F.col("known").isNull(), "unknown").when(F.col("live"), "in_use").otherwise("drop")
    return out.select("name", action.alias("action"))


def owned(spark: SparkSession, release: str, references: DataFrame, existing: DataFrame) -> DataFrame:
    """name and owner: what a release owns is what its proofs reach; the rest is nobody's."""
    roots = spark.createDataFrame([(release,)], "name string")
    reached = reachable(spark, roots, references).where(F.col("name") != release).withColumn("owner", F.lit(release))
    return existing.select("name").distinct().join(reached, "name", "left")


def publish_table(df: DataFrame, folder: str, name: str, expected_rows: int | None = None) -> str:
    """Write to a staging folder, prove the count, then rename; an existing result is an error."""
    spark = df.sparkSession
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    staging, final = f"{folder}/__{name}_build", f"{folder}/{name}"
    fs = fs_path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(fs_path(final)):
        raise FileExistsError(final)
    df.write.mode("overwrite").parquet(staging)
    rows = spark.read.schema(df.schema).parquet(staging).count()
    if expected_rows is not None and rows != expected_rows:
        raise ValueError(f"{name} has {rows} rows, not {expected_rows}")
    if not fs.rename(fs_path(staging), fs_path(final)):
        raise RuntimeError(f"{name} could not be published")
    return final
