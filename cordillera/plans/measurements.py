"""Official measurements: grouping rows to products, and linking them to graph entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.linkage import enrich_and_standalone, link
from ..sources.tables import table


def measurement_rows(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem with its order: part = product, supplier = group, customer = owner, order date = call."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])


def measured_products(rows: DataFrame) -> DataFrame:
    """One row per product: distinct measurements, owners and groups, years, and the latest call's flag.

    The latest call decides; of calls at one time the latest shipped, then the least order and line.
    """
    newest = F.struct("o_orderdate", "l_shipdate", -F.col("o_orderkey"), -F.col("l_linenumber"))
    measurement = F.struct("o_orderdate", "l_suppkey", "l_returnflag")
    return rows.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(measurement).alias("measurements"),
        F.count_distinct("o_custkey").alias("owners"),
        F.count_distinct("l_suppkey").alias("groups"),
        F.year(F.min("l_shipdate")).alias("first_year"),
        F.year(F.max("l_shipdate")).alias("last_year"),
        F.max_by("l_returnflag", newest).alias("latest_flag"),
        F.max_by("l_suppkey", newest).alias("latest_group"),
    )


def link_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Products (closed orders, status F) and graph entities (all others), keyed by title and year."""
    parts = table(spark, folder, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_brand").alias("title"))
    rows = measurement_rows(spark, folder).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.select(F.col("o_orderkey"), "o_orderstatus", "title", F.year("l_shipdate").alias("year"), "o_custkey", "l_suppkey")

    def side(which: Column, name: str, owners: str, groups: str) -> DataFrame:
        own = rows.where(which)
        out = own.groupBy("o_orderkey", "title", "year").agg(F.collect_set("o_custkey").alias(owners), F.collect_set("l_suppkey").alias(groups))
        return out.select(F.concat_ws("|", F.col("o_orderkey").cast("string"), "title", F.col("year").cast("string")).alias(name), "title", "year", owners, groups)

    closed = F.col("o_orderstatus").eqNullSafe("F")
    return side(closed, "product_id", "owners", "groups"), side(~closed, "entity_id", "entity_owners", "entity_groups")


def linked_products(spark: SparkSession, folder: str, most: int = 100) -> DataFrame:
    products, graph = link_sides(spark, folder)
    return link(products, graph, ["title", "year"], ("owners", "entity_owners"), ("groups", "entity_groups"), most)


def materialized(spark: SparkSession, folder: str) -> DataFrame:
    """Graph entities enriched by their products, and products that stand alone."""
    products, graph = link_sides(spark, folder)
    return enrich_and_standalone(graph, linked_products(spark, folder), products)
