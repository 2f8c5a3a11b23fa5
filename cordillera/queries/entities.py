"""Entities, reconciliation and cohorts."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import cohorts, entities, reconcile
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
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN 'project' WHEN o_orderkey % 8 <> 0 THEN 'event' ELSE 'source' END AS rule,
           sha256(CASE WHEN o_orderkey % 4 <> 0 THEN 'project|' || o_orderpriority || '|' || o_custkey || '|' || year(o_orderdate)
                       WHEN o_orderkey % 8 <> 0 THEN 'event|' || o_orderpriority || '|' || strftime(o_orderdate, '%Y-%m-%d')
                       ELSE 'source|orders|' || o_orderkey END) AS identity_key
    FROM orders""")
def entity_identity(spark, d):
    """Orders as occurrences: some lack the project anchor, some of those the event's."""
    rows = table(spark, d, "orders")
    customer = F.when(F.col("o_orderkey") % 4 != 0, F.col("o_custkey"))
    day = F.when(F.col("o_orderkey") % 8 != 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
    key, rule = entities.identity(
        [("project", [F.col("o_orderpriority"), customer, F.year("o_orderdate")]), ("event", [F.col("o_orderpriority"), day])], [F.lit("orders"), F.col("o_orderkey")]
    )
    return rows.select("o_orderkey", rule.alias("rule"), key.alias("identity_key"))


@query("""
    SELECT p_partkey, sha256(CASE WHEN p_size >= 10 THEN 'part|' || p_type || '|' || p_name ELSE 'source|' || p_partkey END) AS candidate_key FROM part""")
def graph_candidate_keys(spark, d):
    key = entities.candidate_key(F.lit("part"), F.col("p_type"), F.col("p_name"), F.col("p_size") >= 10, F.col("p_partkey").cast("string"))
    return table(spark, d, "part").select("p_partkey", key.alias("candidate_key"))


@query(None)
def constraint_components(spark, d):
    """Customers merge by segment and rounded balance unless their nations differ; order dependent, so beyond SQL."""
    rows = table(spark, d, "customer").select("c_custkey", F.concat_ws("|", "c_mktsegment", F.round("c_acctbal", -2).cast("long").cast("string")).alias("k"), "c_nationkey")
    return entities.constraint_components(rows, "c_custkey", "k", ["c_nationkey"])


@query("""
    SELECT p_brand, count(*) AS n, CASE WHEN count(*) = 1 OR max(p_size % 3) > 0 THEN arg_min(p_partkey, (-(p_size % 3), p_partkey))::VARCHAR
           ELSE sha256(count(*) || '|' || bit_xor(('0x' || substr(sha256(p_partkey::VARCHAR), 1, 15))::BIGINT) || '|' || bit_xor(('0x' || substr(sha256(p_partkey::VARCHAR), 16, 15))::BIGINT)) END AS canonical_id
    FROM part GROUP BY p_brand""")
def canonical_ids(spark, d):
    return entities.canonical_ids(table(spark, d, "part").withColumn("priority", F.col("p_size") % 3), "p_brand", "p_partkey", "priority")


@query("""
    SELECT l_orderkey, l_linenumber, CASE WHEN l_shipdate >= o_orderdate THEN strftime(l_shipdate, '%Y-%m-%d') END AS safe_end, CASE WHEN l_linestatus = 'F' THEN 'F' END AS safe_scope,
           concat_ws(',', CASE WHEN l_shipdate < o_orderdate THEN 'end_before_start' END, CASE WHEN l_linestatus <> 'F' THEN 'scope_unknown' END) AS codes
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def event_findings(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    _, end, scope, codes = entities.event_findings(F.col("o_orderdate"), F.col("l_shipdate"), F.col("l_linestatus"), ("F",))
    return rows.select("l_orderkey", "l_linenumber", F.date_format(end, "yyyy-MM-dd").alias("safe_end"), scope.alias("safe_scope"), F.array_join(codes, ",").alias("codes"))


@query("SELECT s_suppkey AS id, s_name AS name, '' AS country, s_nationkey::BIGINT AS nation, NULL::INTEGER AS year FROM supplier")
def complete_shape(spark, d):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("country", T.StringType()), T.StructField("nation", T.LongType()), T.StructField("year", T.IntegerType())])
    rows = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.array("s_acctbal").alias("year"))
    return entities.complete_shape(rows, schema)


#: Two edits at most leave the ratio's matches as many as the longer text has characters, less the edits.
_SUFFIX = """
    v AS (SELECT DISTINCT p_brand AS prefix, lower(replace(p_name, ' ', '.')) || '.' || lower(p_type) || CASE WHEN p_size % 2 = 0 THEN '.' || p_size % 10 ELSE '' END AS suffix FROM part),
    q AS (SELECT x.prefix, x.suffix AS l, y.suffix AS r, CASE WHEN length(x.suffix) <= length(y.suffix) THEN x.suffix ELSE y.suffix END AS s, CASE WHEN length(x.suffix) <= length(y.suffix) THEN y.suffix ELSE x.suffix END AS g
          FROM v x JOIN v y ON x.prefix = y.prefix AND x.suffix < y.suffix),
    w AS (SELECT DISTINCT prefix, l AS left_suffix, r AS right_suffix,
                 CASE WHEN starts_with(g, s) AND length(s) >= 8 AND length(s) < length(g) AND substr(g, length(s) + 1, 1) IN ('/', '.', '-') THEN 'truncation'
                      WHEN levenshtein(l, r) <= 2 AND length(s) >= 8 AND 2.0 * (length(g) - levenshtein(l, r)) / (length(l) + length(r)) >= 0.9 THEN 'edit' END AS how FROM q)"""


def _suffixes(spark, d):
    tail = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("."), (F.col("p_size") % 10).cast("string"))).otherwise("")
    suffix = F.concat(F.lower(F.translate("p_name", " ", ".")), F.lit("."), F.lower("p_type"), tail)
    values = table(spark, d, "part").select(F.col("p_brand").alias("prefix"), suffix.alias("suffix"))
    return reconcile.similar_pairs(values, "prefix", "suffix")


@query(f"WITH {_SUFFIX} SELECT * FROM w WHERE how IS NOT NULL")
def similar_identifiers(spark, d):
    return _suffixes(spark, d)


@query(f"""WITH {_SUFFIX},
    c AS (SELECT DISTINCT suffix, CASE length(suffix) % 3 WHEN 0 THEN 'verified' ELSE 'rejected' END AS st FROM v WHERE length(suffix) % 5 <> 0),
    j AS (SELECT left_suffix AS l, right_suffix AS r, a.st AS sa, b.st AS sb FROM (SELECT DISTINCT left_suffix, right_suffix FROM w WHERE how IS NOT NULL) p LEFT JOIN c a ON p.left_suffix = a.suffix LEFT JOIN c b ON p.right_suffix = b.suffix)
    SELECT CASE WHEN sa IS NULL OR sb IS NULL THEN 'pending' WHEN (sa = 'verified') <> (sb = 'verified') THEN 'confirmed_correction' ELSE 'review' END AS decision, count(*) AS n,
           count(DISTINCT CASE WHEN (sa = 'verified') <> (sb = 'verified') THEN CASE WHEN sa = 'verified' THEN l ELSE r END END) AS corrected
    FROM j GROUP BY 1""")
def reconcile_decisions(spark, d):
    pairs = _suffixes(spark, d).select("left_suffix", "right_suffix").distinct()
    ends = pairs.select(F.col("left_suffix").alias("suffix")).unionByName(pairs.select(F.col("right_suffix").alias("suffix"))).distinct()
    checks = ends.where(F.length("suffix") % 5 != 0).select("suffix", F.when(F.length("suffix") % 3 == 0, "verified").otherwise("rejected").alias("st"))
    decided = reconcile.decisions(pairs, checks, "left_suffix", "right_suffix", "suffix", "st")
    return decided.groupBy("decision").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("correct").alias("corrected"))


@query("""
    WITH p AS (SELECT c_custkey AS code FROM customer), r AS (SELECT DISTINCT o_custkey AS code FROM orders WHERE o_orderstatus = 'P'),
    n AS (SELECT code, sha256('s:' || code) AS draw, 'new' AS segment FROM p WHERE code NOT IN (SELECT code FROM r) ORDER BY draw LIMIT 20),
    f AS (SELECT code, sha256('s:' || code) AS draw, 'refresh' AS segment FROM p WHERE code IN (SELECT code FROM r) ORDER BY draw LIMIT 20)
    SELECT * FROM n UNION ALL SELECT * FROM f""")
def balanced_cohort(spark, d):
    priority = table(spark, d, "customer").select(F.col("c_custkey").alias("code"))
    reference = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("code")).distinct()
    return cohorts.cohort(priority, reference, 20, "s")


@query("""
    SELECT code, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels FROM (
        SELECT c_custkey AS code, 'customers' AS label FROM customer UNION SELECT o_custkey, 'orders' FROM orders UNION SELECT user_id, 'events' FROM events) GROUP BY code""")
def priority_labels(spark, d):
    names = (("customer", "c_custkey", "customers"), ("orders", "o_custkey", "orders"), ("events", "user_id", "events"))
    return cohorts.priority_index([(table(spark, d, t), F.col(c), label) for t, c, label in names])


@query("""
    SELECT a.event_type AS old_status, b.event_type AS new_status, count(*) AS n, count(*) FILTER (a.value IS DISTINCT FROM b.value) AS changed
    FROM events a JOIN events b ON a.event_id + 1 = b.event_id GROUP BY ALL""")
def status_transitions(spark, d):
    rows = table(spark, d, "events").select("event_id", "event_type", "value")
    return cohorts.content_changes(rows.withColumn("event_id", F.col("event_id") + 1), rows, "event_id", "value", "event_type")
