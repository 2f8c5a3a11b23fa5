"""Linkage of products, people, groups and institutions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates
from ..operators import linkage, merge
from ..plans import measurements
from ..sources.tables import table

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


#: Closed orders (status F) are products, all others entities: each order is on one of the sides.
_WHOLE = """
    r AS (SELECT o_orderkey, o_orderstatus, p_name || ' ' || p_brand AS title, year(l_shipdate)::INTEGER AS year, o_custkey, l_suppkey
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
    p AS (SELECT o_orderkey || '|' || title || '|' || year AS product_id, title, year, list(DISTINCT o_custkey) AS o, list(DISTINCT l_suppkey) AS g
          FROM r WHERE o_orderstatus IS NOT DISTINCT FROM 'F' GROUP BY o_orderkey, title, year),
    e AS (SELECT o_orderkey || '|' || title || '|' || year AS entity_id, title, year, list(DISTINCT o_custkey) AS eo, list(DISTINCT l_suppkey) AS eg
          FROM r WHERE o_orderstatus IS DISTINCT FROM 'F' GROUP BY o_orderkey, title, year),
    s AS (SELECT title, year, count(*) AS n FROM e GROUP BY ALL),
    a AS (SELECT product_id, count(*) AS k, min(entity_id) AS entity_id,
                 min(CASE WHEN list_has_any(o, eo) AND list_has_any(g, eg) THEN 'owner_group' WHEN list_has_any(o, eo) THEN 'owner' ELSE 'group' END) AS rule
          FROM p JOIN s USING (title, year) JOIN e USING (title, year) WHERE n <= 100 AND (list_has_any(o, eo) OR list_has_any(g, eg)) GROUP BY product_id),
    links AS (SELECT product_id, CASE WHEN n IS NULL THEN 'unlinked' WHEN k = 1 AND n <= 100 THEN 'linked' ELSE 'ambiguous' END AS status,
                     coalesce(n, 0) AS candidate_count, CASE WHEN k = 1 THEN a.entity_id END AS entity_id, CASE WHEN k = 1 THEN rule END AS rule
              FROM p LEFT JOIN s USING (title, year) LEFT JOIN a USING (product_id))"""


@query(f"WITH {_WHOLE} SELECT * FROM links")
def link_products(spark, d):
    return measurements.linked_products(spark, d)


@query(f"""WITH {_WHOLE}
    SELECT e.entity_id AS id, 'graph' AS origin, count(l.product_id) AS official_products
    FROM e LEFT JOIN (SELECT * FROM links WHERE status = 'linked') l ON e.entity_id = l.entity_id GROUP BY 1
    UNION ALL SELECT product_id, 'standalone', 1 FROM links WHERE status <> 'linked'""")
def enrich_and_standalone(spark, d):
    return measurements.materialized(spark, d)


@query("""
    WITH f AS (SELECT o_custkey AS k, year(o_orderdate)::INTEGER AS y, min(o_orderpriority) AS v FROM orders GROUP BY ALL),
    t AS (SELECT c_custkey, y::INTEGER AS year FROM customer, range(1993, 2001) r(y))
    SELECT t.c_custkey, t.year,
           coalesce(min(v) FILTER (f.y = t.year),
                    CASE WHEN arg_max(v, f.y) FILTER (f.y < t.year) = arg_min(v, f.y) FILTER (f.y > t.year) THEN arg_min(v, f.y) FILTER (f.y > t.year) END) AS v
    FROM t LEFT JOIN f ON t.c_custkey = f.k GROUP BY ALL""")
def bracketing_institution(spark, d):
    facts = table(spark, d, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.min("o_orderpriority").alias("v"))
    targets = table(spark, d, "customer").select("c_custkey", F.explode(F.sequence(F.lit(1993), F.lit(2000))).alias("year"))
    return linkage.bracketing(targets, facts.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "year", "y", "v")


@query("""
    WITH s AS (SELECT o_custkey, min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders GROUP BY 1)
    SELECT o_custkey, y::INTEGER AS year, (year(a) * 12 + month(a) <= y * 12 + 1) AND (year(b) * 12 + month(b) >= y * 12 + 12) AS covers
    FROM s, range(1992, 2002) r(y)""")
def membership_covers_year(spark, d):
    spans = table(spark, d, "orders").groupBy("o_custkey").agg(F.date_format(F.min("o_orderdate"), "yyyy/M").alias("a"), F.date_format(F.max("o_orderdate"), "yyyy/M").alias("b"))
    spans = spans.withColumn("period", dates.membership(F.concat_ws(" - ", "a", "b")))
    years = spans.select("o_custkey", "period", F.explode(F.sequence(F.lit(1992), F.lit(2001))).alias("year"))
    return years.select("o_custkey", "year", dates.covers_year(F.col("period"), F.col("year")).alias("covers"))


@query("""
    SELECT s_suppkey, count(DISTINCT o_orderkey) AS works, count(DISTINCT o_custkey) AS people
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey GROUP BY 1""")
def closed_triangle_affiliation(spark, d):
    """A person counts as a group's only where work, person and group close a triangle in one nation."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey").join(table(spark, d, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(table(spark, d, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(table(spark, d, "supplier").select("s_suppkey", "s_nationkey"), (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey")))
    return rows.groupBy("s_suppkey").agg(F.count_distinct("o_orderkey").alias("works"), F.count_distinct("o_custkey").alias("people"))


@query("""
    SELECT c_nationkey, c_mktsegment, round(c_acctbal, -1)::BIGINT AS name, min(c_custkey) AS c_custkey
    FROM customer GROUP BY 1, 2, 3 HAVING count(DISTINCT c_custkey) = 1""")
def unique_name_resolution(spark, d):
    rows = table(spark, d, "customer").withColumn("name", F.round("c_acctbal", -1).cast("long"))
    return linkage.unique_names(rows, ["c_nationkey", "c_mktsegment"], "name", "c_custkey")


@query("""
    SELECT o_custkey, l_partkey, max(l_linenumber)::INTEGER AS weight, count(*) AS support
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""")
def person_doi_edges(spark, d):
    return merge.distinct_edges(measurements.measurement_rows(spark, d), "o_custkey", "l_partkey", F.col("l_linenumber"))


@query("""
    WITH e AS (SELECT DISTINCT o_custkey, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT o_custkey, count(*) AS works, array_to_string(list_sort(list(l_partkey)), ',') AS related FROM e GROUP BY 1""")
def related_works(spark, d):
    edges = merge.distinct_edges(measurements.measurement_rows(spark, d), "o_custkey", "l_partkey", F.lit(1))
    related = F.array_join(F.sort_array(F.collect_list("l_partkey")), ",")
    return edges.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("works"), related.alias("related"))


@query("""
    WITH o AS (SELECT o_custkey, count(*) AS orders, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS latest, array_to_string(list_sort(list(DISTINCT o_orderstatus)), '') AS statuses FROM orders GROUP BY 1)
    SELECT c_custkey, n_name, coalesce(orders, 0) AS orders, latest, coalesce(statuses, '') AS statuses
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN o ON c_custkey = o_custkey""")
def person_enrichment(spark, d):
    own = table(spark, d, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("latest"), F.array_join(F.sort_array(F.collect_set("o_orderstatus")), "").alias("statuses")
    )
    people = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").join(own, F.col("c_custkey") == F.col("o_custkey"), "left")
    return people.select("c_custkey", "n_name", F.coalesce("orders", F.lit(0)).alias("orders"), "latest", F.coalesce("statuses", F.lit("")).alias("statuses"))


@query("""
    WITH l AS (SELECT l_suppkey, count(*) AS lines, arg_max(l_returnflag, (l_shipdate, l_orderkey, l_linenumber)) AS latest FROM lineitem GROUP BY 1)
    SELECT coalesce(s_suppkey, l_suppkey) AS group_id, s_name, n_name, r_name, coalesce(lines, 0) AS lines, latest
    FROM supplier FULL JOIN l ON s_suppkey = l_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def group_dimension(spark, d):
    facts = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("lines"), F.max_by("l_returnflag", F.struct("l_shipdate", "l_orderkey", "l_linenumber")).alias("latest"))
    groups = table(spark, d, "supplier").join(facts, F.col("s_suppkey") == F.col("l_suppkey"), "full_outer")
    groups = groups.join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return groups.select(F.coalesce("s_suppkey", "l_suppkey").alias("group_id"), "s_name", "n_name", "r_name", F.coalesce("lines", F.lit(0)).alias("lines"), "latest")


@query("""
    WITH u AS (SELECT c_custkey AS id, 'customer' AS source FROM customer UNION ALL SELECT s_suppkey, 'supplier' FROM supplier UNION ALL SELECT DISTINCT o_custkey, 'orders' FROM orders)
    SELECT id, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources, CASE WHEN bool_or(source = 'orders') THEN 'refresh' ELSE 'new' END AS segment FROM u GROUP BY id""")
def identifier_union(spark, d):
    parts = [table(spark, d, t).select(F.col(c).alias("id"), F.lit(t).alias("source")) for t, c in (("customer", "c_custkey"), ("supplier", "s_suppkey"), ("orders", "o_custkey"))]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    segment = F.when(F.bool_or(F.col("source") == "orders"), "refresh").otherwise("new")
    return union.groupBy("id").agg(F.array_join(F.sort_array(F.collect_set("source")), ",").alias("sources"), segment.alias("segment"))
