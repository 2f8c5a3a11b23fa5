"""Audits, differences, selections, increments and retention."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import aggregates, audits
from ..sources import publication
from ..sources.tables import table
from ..streaming import incremental

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query("""
    SELECT 'order_customer' AS "check", count(*) AS refs, count(*) FILTER (o_custkey < 0) AS malformed, count(*) FILTER (c_custkey IS NULL) AS unresolved
    FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY') ON o_custkey = c_custkey
    UNION ALL SELECT 'line_order', count(*), 0, count(*) FILTER (o_orderkey IS NULL) FROM lineitem LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') ON l_orderkey = o_orderkey
    UNION ALL SELECT 'label_document', count(*), 0, count(*) FILTER (d.doc_id IS NULL) FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id""")
def referential_audit(spark, d):
    t = lambda name: table(spark, d, name)
    checks = [
        audits.unresolved(t("orders"), "o_custkey", t("customer").where("c_mktsegment <> 'MACHINERY'"), "c_custkey", "order_customer", F.col("o_custkey") >= 0),
        audits.unresolved(t("lineitem"), "l_orderkey", t("orders").where("o_orderstatus <> 'P'"), "o_orderkey", "line_order"),
        audits.unresolved(t("labels"), "doc_id", t("documents"), "doc_id", "label_document"),
    ]
    return reduce(lambda a, b: a.unionByName(b), checks)


@query("""
    SELECT CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN d.doc_id IS NULL THEN 'unexpected' WHEN d.x IS DISTINCT FROM l.quality THEN 'mismatch' ELSE 'covered' END AS state, count(*) AS n
    FROM (SELECT doc_id, CASE WHEN n_chars > 500 THEN 1 ELSE 0 END AS x FROM documents) d FULL JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1""")
def coverage_audit(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.when(F.col("n_chars") > 500, 1).otherwise(0).alias("x"))
    return audits.coverage(docs, table(spark, d, "labels"), "doc_id", ("x", "quality"))


_RULES = "[CASE WHEN n_chars < 100 THEN 'short' END, CASE WHEN regexp_matches(text, '@[A-Za-z0-9]') THEN 'address' END, CASE WHEN length(text) <> n_chars THEN 'length' END, CASE WHEN regexp_matches(text, '[|]') THEN 'table' END]"


def _rules():
    return {
        "short": F.col("n_chars") < 100,
        "address": F.col("text").rlike("@[A-Za-z0-9]"),
        "length": F.length("text") != F.col("n_chars"),
        "table": F.col("text").rlike("[|]"),
    }


@query(f"SELECT kind, count(*) AS n FROM (SELECT unnest({_RULES}) AS kind FROM documents) WHERE kind IS NOT NULL GROUP BY kind")
def anomaly_rules(spark, d):
    return audits.finding_counts(audits.findings(table(spark, d, "documents"), "doc_id", _rules()))


@query(f"""
    SELECT kind, id, row_number() OVER (PARTITION BY kind ORDER BY id)::INTEGER AS "rank"
    FROM (SELECT doc_id AS id, unnest({_RULES}) AS kind FROM documents) WHERE kind IS NOT NULL QUALIFY "rank" <= 5""")
def bounded_examples(spark, d):
    return audits.bounded_examples(audits.findings(table(spark, d, "documents"), "doc_id", _rules()), 5)


@query("""
    WITH a AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_orderpriority AS p FROM orders WHERE o_orderpriority IS DISTINCT FROM '1-URGENT'),
    b AS (SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'P' THEN 'X' ELSE o_orderstatus END AS s, CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_orderpriority END AS p FROM orders WHERE o_orderpriority IS DISTINCT FROM '5-LOW'),
    j AS (SELECT CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' WHEN a.s IS NOT DISTINCT FROM b.s AND a.p IS NOT DISTINCT FROM b.p THEN 'unchanged' ELSE 'changed' END AS state,
                 concat_ws(',', CASE WHEN a.s IS DISTINCT FROM b.s THEN 's' END, CASE WHEN a.p IS DISTINCT FROM b.p THEN 'p' END) AS f FROM a FULL JOIN b ON a.k = b.k)
    SELECT state, CASE WHEN state = 'changed' THEN f ELSE '' END AS fields, count(*) AS n FROM j GROUP BY ALL""")
def snapshot_diff(spark, d):
    """Two versions of orders, each order in one at least: the old lacks urgent ones, the new low ones."""
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("p"))
    new = rows.where(~F.col("p").eqNullSafe("5-LOW")).select("k", F.when(F.col("s") == "P", "X").otherwise(F.col("s")).alias("s"), F.when(F.col("p") != "3-MEDIUM", F.col("p")).alias("p"))
    return audits.snapshot_diff(rows.where(~F.col("p").eqNullSafe("1-URGENT")), new, "k", ["s", "p"])


@query("""
    WITH s AS (SELECT l_partkey, l_returnflag, CASE WHEN l_linenumber <= 3 THEN 1 ELSE -1 END AS d FROM lineitem)
    SELECT l_partkey, l_returnflag, sum(d)::BIGINT AS surplus FROM s GROUP BY ALL HAVING sum(d) <> 0""")
def multiset_diff(spark, d):
    rows = table(spark, d, "lineitem")
    return audits.multiset_diff(rows.where("l_linenumber <= 3"), rows.where("l_linenumber > 3"), ["l_partkey", "l_returnflag"])


@query("""
    SELECT concat_ws('+', CASE WHEN n_chars >= 1000 THEN 'long' END, CASE WHEN quality = 1 THEN 'good' END, CASE WHEN lang = 'en' THEN 'en' END) AS combination, count(*) AS n, min(doc_id) AS first_id
    FROM documents LEFT JOIN labels USING (doc_id) WHERE n_chars >= 1000 OR quality = 1 GROUP BY 1""")
def identified_selection(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    marks = F.array_compact(F.array(F.when(F.col("n_chars") >= 1000, "long"), F.when(F.col("quality") == 1, "good"), F.when(F.col("lang") == "en", "en")))
    return docs.where("n_chars >= 1000 or quality = 1").groupBy(F.array_join(marks, "+").alias("combination")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"))


_DIGESTS = "bit_xor(('0x' || substr(sha256(x), 1, 15))::BIGINT) AS xor_digest, sum(('0x' || substr(sha256(x), 16, 15))::BIGINT % 2147483647)::BIGINT AS sum_digest"


@query(f"""SELECT count(*) AS rows, {_DIGESTS} FROM (SELECT concat_ws('|', n_name, n_nationkey, r_name) AS x FROM nation JOIN region ON n_regionkey = r_regionkey)""")
def source_fingerprint(spark, d):
    rows = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return aggregates.fingerprint(rows, ["n_nationkey", "n_name", "r_name"])


@query(f"""SELECT count(*) AS rows, {_DIGESTS} FROM (SELECT concat_ws('|', l_linenumber, l_orderkey, l_partkey, l_suppkey) AS x FROM lineitem)""")
def table_fingerprint(spark, d):
    """Order-free digests of all line items."""
    return aggregates.fingerprint(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@query("""
    SELECT d.doc_id, sha256(d.text) AS hash FROM documents d
    LEFT JOIN (SELECT doc_id FROM labels WHERE quality = 1) l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL""")
def incremental_skip(spark, d):
    """Labelled good means processed before with the same parser and content."""
    rows = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("hash"), F.lit("v1").alias("parser"))
    done = rows.join(table(spark, d, "labels").where("quality = 1"), "doc_id", "left_semi")
    return incremental.changed(rows, done, ["doc_id", "hash", "parser"]).select("doc_id", "hash")


@query("""
    SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'permanent' WHEN event_type = 'view' THEN 'retry'
           WHEN epoch(TIMESTAMP '2024-02-01') - epoch(date_trunc('second', ts)) <= 604800 THEN 'fresh' ELSE 'expired' END AS reuse FROM events""")
def ttl_reuse(spark, d):
    rows = table(spark, d, "events")
    status = F.when(F.col("event_type") == "purchase", "positive").when(F.col("event_type") == "view", "pending").otherwise("negative")
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return incremental.reuse(rows, status, F.col("ts").cast("timestamp"), now).select("event_id", "reuse")


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id")
def latest_state(spark, d):
    return incremental.latest(table(spark, d, "events").select("user_id", "event_type", "event_id", "ts"), "user_id", ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@query("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, event_type, count(*) AS n FROM events GROUP BY ALL")
def windowed_counts(spark, d):
    rows = table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    return incremental.windowed_counts(rows, "ts", "event_type", "1 hour", "1 day").select(F.date_format("start", "yyyy-MM-dd HH").alias("hour"), "event_type", "n")


#: Published names and references for the retention queries.
NAMES = ["reg_works_v01_20240101", "reg_works_v02_20240201", "reg_works_v03_20240301", "reg_works_v03_20240305", "reg_people_v01_20240101", "reg_people_v02_20240102_filtered", "scratch"]
REFERENCES = [("reg_works_v03_20240301", "reg_works_v01_20240101"), ("reg_people_v01_20240101", "scratch")]
_NAMES = ", ".join(f"('{n}')" for n in NAMES)
_REFS = ", ".join(f"('{a}', '{b}')" for a, b in REFERENCES)
_RANKED = rf"""
    n(name) AS (VALUES {_NAMES}),
    p AS (SELECT name, regexp_extract(name, '^([a-z]+)_([a-z_]+?)_v(\d+)_(\d+)(_filtered)?$', ['a', 'entity', 'version', 'date', 'filtered']) AS x FROM n),
    k AS (SELECT name, x.entity AS entity, x.version::INTEGER AS version, x.date AS date, x.filtered <> '' AS filtered FROM p WHERE x.entity <> ''),
    r AS (SELECT *, row_number() OVER (PARTITION BY entity, filtered ORDER BY version DESC, date DESC)::INTEGER AS "rank" FROM k)"""


@query(f'WITH {_RANKED} SELECT name, entity, version, date, filtered, "rank" FROM r')
def version_rank(spark, d):
    return publication.ranked(spark.createDataFrame([(n,) for n in NAMES], "name string"), "name")


@query(f"""WITH RECURSIVE {_RANKED}, e(source, target) AS (VALUES {_REFS}),
    live AS (SELECT name FROM r WHERE "rank" <= 2 UNION SELECT target FROM live JOIN e ON live.name = e.source)
    SELECT name, CASE WHEN name IN (SELECT name FROM live) THEN 'keep' ELSE 'expired' END AS action FROM n""")
def retention_closure(spark, d):
    names = spark.createDataFrame([(n,) for n in NAMES], "name string")
    return publication.retention(spark, names, spark.createDataFrame(REFERENCES, "source string, target string"))
