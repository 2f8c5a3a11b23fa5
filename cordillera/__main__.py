"""Command line: list the queries, show a run's plan, or write a query's rows.

Actions are done in the order list, sql, plan, run, however they are given.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from cordillera.plans.runs import Store
from cordillera.queries import ORACLE_SQL, QUERIES


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="cordillera", description=__doc__)
    parser.add_argument("--list", action="store_true", help="names of the queries, a star where they have SQL")
    parser.add_argument("--sql", metavar="QUERY", action="append", default=[], help="the SQL of a query")
    parser.add_argument("--plan", metavar="FOLDER", help="the stages of a run and their states")
    parser.add_argument("--run", metavar="QUERY", action="append", default=[], help="write the rows of a query")
    parser.add_argument("--data", metavar="FOLDER", help="the folder of the tables")
    parser.add_argument("--out", metavar="FOLDER", help="where rows go, one folder for each query")
    own = parser.parse_args(given)
    unknown = [q for q in [*own.run, *own.sql] if q not in QUERIES]
    if unknown:
        parser.error(f"unknown queries: {', '.join(unknown)}")
    if own.run and not (own.data and own.out):
        parser.error("--run needs --data and --out")
    return own


def main(given: list[str] | None = None, spark: SparkSession | None = None) -> list[str]:
    """What was said, line by line."""
    own, said = arguments(given), []
    if own.list:
        said += [name + " *" * (name in ORACLE_SQL) for name in sorted(QUERIES)]
    said += [ORACLE_SQL.get(name, "") for name in own.sql]
    if own.plan or own.run:
        spark = spark or SparkSession.builder.appName("cordillera").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if own.plan:
        said += [f"{name}: {x['state']}" for name, x in (Store(spark, own.plan).read("run") or {}).items()]
    for name in own.run:
        QUERIES[name](spark, own.data).write.mode("overwrite").parquet(f"{own.out}/{name}")
        said.append(f"{name}: written")
    return said


if __name__ == "__main__":
    print("\n".join(main()))
