"""Histories, consensus, merging and measured products."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates, merge, routing
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


@query("""
    SELECT o_custkey, count(*) AS entries, strftime(min(o_orderdate), '%Y-%m-%d') AS first_seen, strftime(max(o_orderdate), '%Y-%m-%d') AS last_seen,
           arg_max(o_orderstatus, (o_orderdate, o_orderkey)) FILTER (o_orderstatus <> '') AS latest_o_orderstatus,
           arg_max(o_orderpriority, (o_orderdate, o_orderkey)) FILTER (o_orderpriority <> '') AS latest_o_orderpriority
    FROM orders GROUP BY o_custkey""")
def history_consolidation(spark, d):
    out = aggregates.history(table(spark, d, "orders"), "o_custkey", "o_orderdate", "o_orderkey", ["o_orderstatus", "o_orderpriority"])
    return out.withColumn("first_seen", F.date_format("first_seen", "yyyy-MM-dd")).withColumn("last_seen", F.date_format("last_seen", "yyyy-MM-dd"))


@query("""
    SELECT o_custkey, '[' || string_agg('{"o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%d') || '","o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}', ',' ORDER BY o_orderdate, o_orderkey) || ']' AS history
    FROM orders GROUP BY o_custkey""")
def history_documents(spark, d):
    rows = table(spark, d, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return aggregates.history_documents(rows, "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderstatus"])


@query("""
    WITH c AS (SELECT l_partkey, year(l_shipdate)::INTEGER AS year, count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT l_partkey, arg_min(year, (-n, year)) AS year, max(n) AS support FROM c GROUP BY l_partkey""")
def choose_year_mode(spark, d):
    return aggregates.mode_by(table(spark, d, "lineitem").select("l_partkey", F.year("l_shipdate").alias("year")), ["l_partkey"], "year")


@query("""
    SELECT lang, source, sha256(arg_max(x, (length(x), x))) AS title_hash
    FROM (SELECT lang, source, split_part(text, chr(10), 1) AS x FROM documents) GROUP BY ALL""")
def choose_title(spark, d):
    rows = table(spark, d, "documents").select("lang", "source", F.substring_index("text", "\n", 1).alias("x"))
    return aggregates.representative(rows, ["lang", "source"], "x").select("lang", "source", F.sha2("x", 256).alias("title_hash"))


@query("""
    SELECT l_partkey, count(DISTINCT f) AS "values",
           CASE count(DISTINCT f) WHEN 0 THEN 'missing' WHEN 1 THEN 'consistent' ELSE 'conflict' END AS status,
           CASE WHEN count(DISTINCT f) = 1 THEN min(f) END AS value
    FROM (SELECT l_partkey, CASE WHEN l_linestatus = 'F' THEN l_returnflag END AS f FROM lineitem) GROUP BY l_partkey""")
def field_consensus(spark, d):
    rows = table(spark, d, "lineitem").select("l_partkey", F.when(F.col("l_linestatus") == "F", F.col("l_returnflag")).alias("f"))
    return aggregates.consensus(rows, ["l_partkey"], "f")


@query("""
    WITH g AS (SELECT l_orderkey, count(DISTINCT year(l_shipdate)) AS ny, min(year(l_shipdate)) AS y, count(DISTINCT month(l_shipdate)) AS nm, min(month(l_shipdate)) AS m,
                      count(DISTINCT day(l_shipdate)) AS nd, min(day(l_shipdate)) AS d FROM lineitem GROUP BY l_orderkey)
    SELECT l_orderkey, CASE WHEN ny = 1 THEN y END::INTEGER AS year, CASE WHEN ny = 1 AND nm = 1 THEN m END::INTEGER AS month,
           CASE WHEN ny = 1 AND nm = 1 THEN CASE WHEN nd = 1 THEN d ELSE 1 END END::INTEGER AS day,
           CASE WHEN ny <> 1 THEN 'conflict' WHEN nm <> 1 THEN 'year' WHEN nd <> 1 THEN 'month' ELSE 'day' END AS "precision"
    FROM g""")
def date_consensus(spark, d):
    return aggregates.date_consensus(table(spark, d, "lineitem"), ["l_orderkey"], "l_shipdate")


@query("""
    WITH r AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT l_partkey, count(*) AS rows, count(DISTINCT (o_orderdate, l_suppkey, l_returnflag)) AS measurements, count(DISTINCT o_custkey) AS owners,
           count(DISTINCT l_suppkey) AS "groups", year(min(l_shipdate))::INTEGER AS first_year, year(max(l_shipdate))::INTEGER AS last_year,
           arg_max(l_returnflag, (o_orderdate, l_shipdate, -o_orderkey, -l_linenumber)) AS latest_flag,
           arg_max(l_suppkey, (o_orderdate, l_shipdate, -o_orderkey, -l_linenumber)) AS latest_group
    FROM r GROUP BY l_partkey""")
def measured_products(spark, d):
    return measurements.measured_products(measurements.measurement_rows(spark, d))


#: A small catalogue over the part types; ECONOMY has no entry.
CATALOGUE = [("STANDARD", "work"), ("SMALL", "project"), ("MEDIUM", "event"), ("LARGE", "patent"), ("PROMO", "work")]
_VALUES = ", ".join(f"('{a}', '{b}')" for a, b in CATALOGUE)


@query(f"""
    WITH c(p_type, entity) AS (VALUES {_VALUES}),
    r AS (SELECT p_name, entity FROM part LEFT JOIN c USING (p_type))
    SELECT p_name, CASE WHEN count(*) > count(entity) THEN 'unmapped' WHEN count(DISTINCT entity) > 1 THEN 'mixed' ELSE min(entity) END AS target FROM r GROUP BY p_name""")
def target_entity_route(spark, d):
    catalogue = spark.createDataFrame(CATALOGUE, "kind string, entity string")
    rows = routing.route(table(spark, d, "part"), catalogue, [(F.col("p_type"), "kind")], ["entity"])
    return routing.target_entity(rows, "p_name", "entity")


@query(f"""
    WITH c(p_type, entity) AS (VALUES {_VALUES})
    SELECT p_brand, coalesce(entity, 'none') AS entity, count(*) AS frequency, min(p_partkey) AS first_part
    FROM part LEFT JOIN c USING (p_type) GROUP BY ALL""")
def route_types(spark, d):
    catalogue = spark.createDataFrame(CATALOGUE, "kind string, entity string")
    rows = routing.route(table(spark, d, "part"), catalogue, [(F.col("p_type"), "kind")], ["entity"])
    return rows.groupBy("p_brand", F.coalesce("entity", F.lit("none")).alias("entity")).agg(F.count(F.lit(1)).alias("frequency"), F.min("p_partkey").alias("first_part"))


@query("""
    WITH n AS (SELECT p_brand, p_type, p_name, count(*) AS n, min(p_partkey) AS ex FROM part GROUP BY ALL)
    SELECT p_brand, p_type, sum(n)::BIGINT AS frequency, '{' || string_agg('"' || p_name || '":' || n, ',' ORDER BY p_name) || '}' AS sources,
           array_to_string(list_sort(list(DISTINCT ex))[1:3], '|') AS examples
    FROM n GROUP BY ALL""")
def type_inventory(spark, d):
    return routing.type_inventory(table(spark, d, "part"), "p_brand", "p_type", "p_name", "p_partkey")


@query("SELECT lang || '|' || source AS key, sha256(arg_max(text, (length(text), text))) AS value_hash, count(*) AS n FROM documents GROUP BY 1")
def merge_prefer_scalar(spark, d):
    out = merge.prefer_spelling(table(spark, d, "documents"), F.concat_ws("|", "lang", "source"), "text")
    return out.select("key", F.sha2("value", 256).alias("value_hash"), "n")


@query("""
    WITH a AS (SELECT c_custkey AS k, c_name AS name, c_nationkey AS nation FROM customer),
    b AS (SELECT s_suppkey AS k, s_name || ' Ltd' AS name, s_nationkey AS nation FROM supplier)
    SELECT coalesce(a.k, b.k) AS k,
           CASE WHEN a.name IS NULL THEN b.name WHEN b.name IS NULL THEN a.name WHEN (length(a.name), a.name) >= (length(b.name), b.name) THEN a.name ELSE b.name END AS name,
           coalesce(a.nation, b.nation) AS nation
    FROM a FULL JOIN b ON a.k = b.k""")
def merge_versions(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    b = table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.concat("s_name", F.lit(" Ltd")).alias("name"), F.col("s_nationkey").alias("nation"))
    return merge.merge_scalars(a, b, "k", ["name"], ["nation"])


@query("SELECT conv_id, role, count(*) AS members, sum(length(text))::BIGINT AS size, count(*) > 1 AS conflict FROM conversations GROUP BY ALL")
def author_merge_conflicts(spark, d):
    return merge.role_summary(table(spark, d, "conversations"), "conv_id", "role", F.length("text").cast("long"))


@query("""
    SELECT conv_id, (turn // 2)::VARCHAR AS key, arg_min(role, CASE role WHEN 'system' THEN 1 WHEN 'assistant' THEN 2 WHEN 'user' THEN 3 ELSE 4 END) AS role, count(*) AS claims
    FROM conversations GROUP BY ALL""")
def role_precedence(spark, d):
    return merge.role_precedence(table(spark, d, "conversations"), "conv_id", F.floor(F.col("turn") / 2).cast("string"), "role", ["system", "assistant", "user"])


@query("""
    SELECT CASE WHEN n_chars <= 100 THEN '0-100' WHEN n_chars <= 1000 THEN '101-1000' WHEN n_chars <= 5000 THEN '1001-5000' WHEN n_chars <= 20000 THEN '5001-20000' ELSE '>20000' END AS bucket,
           count(*) AS n FROM documents WHERE n_chars IS NOT NULL GROUP BY 1""")
def histogram_buckets(spark, d):
    return aggregates.histogram(table(spark, d, "documents"), F.col("n_chars"), [100, 1000, 5000, 20000])
