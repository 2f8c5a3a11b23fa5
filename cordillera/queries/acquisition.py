"""Acquisition: what is fetched, what answers mean, and when a snapshot may stand."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import acquisition
from ..sources.tables import ensure_shared_dir, table
from .cases import cases

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query("SELECT n_nationkey, 'https://example.org/list?level=A+B&size=100&page=' || n_nationkey AS url FROM nation")
def page_urls(spark, d):
    url = acquisition.page_url("https://example.org/list", [("level", "A B"), ("size", "100")], "page", F.col("n_nationkey"))
    return table(spark, d, "nation").select("n_nationkey", url.alias("url"))


@query("""SELECT p_partkey, sha256('{"p_name":"' || p_name || '","p_size":' || CASE WHEN p_size > 40 THEN 'null' ELSE '"' || p_size || '"' END || '}') AS fingerprint, CASE WHEN p_size >= 3 THEN (p_size + 2)::BIGINT ELSE 5 END AS expected FROM part""")
def dataset_metadata(spark, d):
    """Fingerprints of what identifies a version, and the row count that it promises."""
    rows = table(spark, d, "part").select("p_partkey", "p_name", F.when(F.col("p_size") <= 40, F.col("p_size")).alias("p_size"), F.array(F.lit("5"), F.lit("x"), F.when(F.col("p_size") >= 3, (F.col("p_size") + 2).cast("string"))).alias("counts"))
    return rows.select("p_partkey", acquisition.metadata_fingerprint(["p_size", "p_name"]).alias("fingerprint"), acquisition.expected_rows(F.col("counts")).alias("expected"))


@query("SELECT 'nations:' || lpad((row_number() OVER (ORDER BY n_nationkey) - 1)::VARCHAR, 10, '0') AS _id, n_nationkey::BIGINT AS n_nationkey, n_name FROM nation")
def paged_snapshot(spark, d):
    """A dataset fetched page by page, each page failing once, published when its count is kept, then adopted."""
    rows = [{"n_nationkey": r["n_nationkey"], "n_name": r["n_name"]} for r in table(spark, d, "nation").orderBy("n_nationkey").collect()]  # 25 rows
    failed: set[int] = set()

    def get(dataset: str, limit: int, offset: int) -> list[dict]:
        if offset not in failed:
            failed.add(offset)
            raise ConnectionError("try again")
        return rows[offset : offset + limit]

    schema = T.StructType([T.StructField("n_nationkey", T.LongType()), T.StructField("n_name", T.StringType())])
    folder = f"{ensure_shared_dir(spark)}/snapshots-{uuid.uuid4().hex}"
    first = acquisition.snapshot(spark, get, "nations", [3, None, len(rows)], 10, schema, folder, "nations")
    again = acquisition.snapshot(spark, get, "nations", [len(rows)], 10, schema, folder, "nations")
    return again.join(first.select("_id"), "_id", "left_semi")


@query("SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'bolt') ORDER BY p_partkey LIMIT 10")
def catalogue_search(spark, d):
    """The first ten names with a word: a search with a limit."""
    return acquisition.search(table(spark, d, "part").select("p_partkey", "p_name"), "BOLT", "p_name", "p_partkey", 10)


@query("""
    SELECT kind, query, sha256(kind || '|' || query) AS id, answer FROM (
        SELECT DISTINCT CASE WHEN o_orderstatus = 'F' THEN 'person' ELSE 'group' END AS kind, o_custkey::VARCHAR AS query, CASE WHEN c_custkey IS NOT NULL AND o_orderstatus = 'F' THEN c_name END AS answer
        FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') ON o_custkey = c_custkey)""")
def cached_queries(spark, d):
    """Answers from the cache by the hash of a query; what has none is to be asked. Answers of older versions do not count."""
    wanted = table(spark, d, "orders").select(F.when(F.col("o_orderstatus") == "F", "person").otherwise("group").alias("kind"), F.col("o_custkey").cast("string").alias("query"))
    people = table(spark, d, "customer")
    key = F.sha2(F.concat_ws("|", F.lit("person"), F.col("c_custkey").cast("string")), 256)
    cache = people.select(key.alias("id"), F.col("c_name").alias("answer"), F.when(F.col("c_mktsegment") == "BUILDING", 0).otherwise(1).alias("version"))
    return acquisition.cached_queries(wanted, cache, 1)


@cases("document_candidate_cases", "normal string, original string", [("123", "123.0 | CC 45 |  123"), (None, "7.0"), ("", None), ("9", "9.0 | 9")], "candidates string", [("123/CC 45",), ("7",), ("",), ("9",)])
def _candidates(df):
    return [F.array_join(acquisition.document_candidates(F.col("normal"), F.col("original")), "/")]


@query("""
    WITH r AS (SELECT c_custkey, o_orderkey, o_orderpriority FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P')
    SELECT c_custkey AS id, CASE WHEN count(o_orderkey) = 0 THEN 'none' WHEN count(o_orderkey) = 1 THEN 'unique' WHEN count(DISTINCT o_orderpriority) = 1 THEN 'several' ELSE 'ambiguous' END AS status, count(o_orderkey) AS matches,
           CASE WHEN count(o_orderkey) = 1 THEN min(o_orderkey) END AS code, CASE WHEN count(DISTINCT o_orderpriority) = 1 THEN min(o_orderpriority) END AS name FROM r GROUP BY 1""")
def recognised_people(spark, d):
    """Customers as records, their pending orders as answers."""
    records = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.array(F.col("c_custkey").cast("string"), F.concat(F.lit("x"), "c_custkey")).alias("candidates"))
    answers = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").cast("string").alias("query"), F.col("o_orderkey").alias("code"), F.col("o_orderpriority").alias("name"))
    return acquisition.recognised_people(records, answers)


@query("""SELECT * FROM (VALUES ('COL1', 'unique', 1::BIGINT, ''), ('COL2', 'incomplete', 1, 'leader'), ('COL3', 'error', 1, 'url'), ('COL4', 'ambiguous', 2, ''), ('COL5', 'no_exact_match', 0, ''), ('COL6', 'none', 0, '')) t(code, status, exact, missing)""")
def recognised_group_cases(spark, d):
    records = spark.createDataFrame([(f"COL{k}",) for k in range(1, 7)], "code string")
    rows = [("COL1", "COL1", "u", "l"), ("COL2", "COL2", "u", ""), ("COL3", "COL3", None, "l"), ("COL4", "COL4", "u", "l"), ("COL4", "COL4", "v", "m"), ("COL5", "COL55", "u", "l")]
    return acquisition.recognised_groups(records, spark.createDataFrame(rows, "asked string, code string, url string, leader string"), ["url", "leader"], "url")


_LAST = "l AS (SELECT user_id AS id, max(ts) AS t FROM events GROUP BY 1)"


@query(f"WITH {_LAST}, n AS (SELECT max(ts) AS now FROM events) SELECT c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT id FROM l WHERE t >= (SELECT now FROM n) - INTERVAL 1 DAY)")
def download_plan(spark, d):
    """Customers whose page is missing or older than a day before the last event."""
    events = table(spark, d, "events").select(F.col("user_id").alias("id"), F.col("ts").cast("timestamp").alias("fetched_at"))
    now = F.lit(events.agg(F.max("fetched_at")).first()[0])
    people = table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    return acquisition.to_download(people.unionByName(people), events.groupBy("id").agg(F.max("fetched_at").alias("fetched_at")), "id", now, 1)


@query("""
    WITH o AS (SELECT c_custkey AS id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'empty' ELSE 'downloaded' END AS status FROM customer WHERE c_mktsegment <> 'MACHINERY'),
    n AS (SELECT DISTINCT o_custkey AS id FROM orders WHERE o_orderstatus = 'P'), c AS (SELECT c_custkey AS id, c_acctbal < 0 AS bad FROM customer)
    SELECT coalesce(o.id, n.id) AS id, CASE WHEN n.id IS NULL THEN o.status WHEN bad THEN 'error' ELSE 'private' END AS status, (CASE WHEN o.id IS NULL THEN 0 ELSE 1 END + CASE WHEN n.id IS NULL THEN 0 ELSE 1 END)::INTEGER AS attempts, CASE WHEN n.id IS NOT NULL AND bad THEN 'boom' END AS error
    FROM o FULL JOIN n ON o.id = n.id LEFT JOIN c ON c.id = n.id""")
def download_states(spark, d):
    """Attempts and statuses after a round in which some were tried again, some for the first time, some in vain."""
    none = F.lit(None).cast("timestamp").alias("fetched_at")
    people = table(spark, d, "customer")
    state = people.where("c_mktsegment <> 'MACHINERY'").select(F.col("c_custkey").alias("id"), F.when(F.col("c_mktsegment") == "BUILDING", "empty").otherwise("downloaded").alias("status"), F.lit(1).alias("attempts"), F.lit(None).cast("string").alias("error"), none)
    tried = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("id")).distinct().join(people.select(F.col("c_custkey").alias("id"), "c_acctbal"), "id", "left")
    results = tried.select("id", F.lit("private").alias("status"), F.when(F.col("c_acctbal") < 0, "boom").alias("error"), none)
    return acquisition.advanced(state, results, "id").drop("fetched_at")


_VERIFIED = """
    t AS (SELECT s_suppkey AS id, CASE WHEN s_acctbal < 0 THEN 'error' WHEN s_nationkey % 4 = 0 THEN 'promoted' WHEN s_nationkey % 4 = 1 THEN 'confirmed_incomplete' WHEN s_nationkey % 4 = 2 THEN 'changed_incomplete' ELSE 'empty' END AS outcome,
                 s_acctbal >= 0 AND s_nationkey % 4 IN (0, 1) AS unchanged, s_name FROM supplier)"""


def _verified(spark, d):
    rows = table(spark, d, "supplier")
    k = F.col("s_nationkey") % 4
    targets = rows.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("digest"))
    checks = rows.where("s_acctbal >= 0").select(F.col("s_suppkey").alias("id"), F.when(k == 0, "downloaded").when(k == 3, "empty").otherwise("incomplete").alias("status"), F.when(k >= 2, "other").otherwise(F.col("s_name")).alias("digest"))
    return acquisition.verified(targets, checks, "id")


@query(f"WITH {_VERIFIED} SELECT id, outcome, unchanged FROM t")
def verified_pages(spark, d):
    return _verified(spark, d)


@query(f"WITH {_VERIFIED} SELECT id, CASE WHEN outcome = 'promoted' THEN 'new' ELSE s_name END AS page FROM t")
def promoted_pages(spark, d):
    """Stored pages with those replaced whose second look was complete."""
    pages = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("page"))
    return acquisition.promoted(pages, pages.withColumn("page", F.lit("new")), _verified(spark, d), "id")


@query("SELECT c_custkey AS id, 'old' AS origin FROM customer WHERE c_mktsegment = 'BUILDING' UNION ALL SELECT s_suppkey, 'new' FROM supplier WHERE s_suppkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def inserted_if_absent(spark, d):
    old = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("id"), F.lit("old").alias("origin"))
    return acquisition.inserted(old, table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.lit("new").alias("origin")), "id")


def _directory(spark, d):
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.withColumn("page", F.floor(F.col("c_custkey") / 100).cast("int"))
    cell = F.concat(F.lit('<tr id="people_row"><td>1</td><td><a href="x?cod_rh='), "c_custkey", F.lit('&a=1">'), "c_name", F.lit("</a></td><td> "), "n_name", F.lit(" </td></tr>"))
    total = rows.count()
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("c_custkey", cell.alias("b")))), lambda x: x["b"]), "")
    said = F.concat(F.col("page") * 100 + 1, F.lit(" - "), F.col("page") * 100 + F.col("n"), F.lit(f" de {total // 1000}.{total % 1000:03d}" if total >= 1000 else f" de {total}"))
    pages = rows.groupBy("page").agg(body.alias("body"), F.count(F.lit(1)).alias("n")).select("page", F.concat(F.lit("<p>Resultados "), said, F.lit('</p><table id="people">'), "body", F.lit("</table>")).alias("html"))
    return acquisition.directory_rows(pages, "page", "html", "people")


@query("SELECT (c_custkey // 100)::INTEGER AS page, lpad(c_custkey::VARCHAR, 10, '0') AS code, c_name AS name, n_name AS country, (SELECT count(*) FROM customer)::INTEGER AS total FROM customer JOIN nation ON c_nationkey = n_nationkey")
def directory_rows(spark, d):
    return _directory(spark, d).select("page", "code", "name", "country", "total")


@query("SELECT count(*) AS rows, least(count(DISTINCT c_custkey // 100) * 100, count(*))::BIGINT AS wanted, 0::BIGINT AS bad_pages, 0::BIGINT AS repeated_codes FROM customer JOIN nation ON c_nationkey = n_nationkey")
def directory_audit(spark, d):
    """Rows against what the pages say, and codes that repeat."""
    return acquisition.directory_audit(_directory(spark, d), 100).select("rows", F.col("wanted").cast("long").alias("wanted"), "bad_pages", "repeated_codes")


@cases("call_cases", "sample string, path string", [
    ("Convocatoria No 833 de 2018 - resultados", "x.pdf"), ("Convocatoria 781 Nacional 2017", "x"), ("nada", "/a/640-lista.pdf"), ("nada", "/a/16401.pdf"), ("Convocatoria 894 de 2021 Investigador Sénior (IS)", "x"), ("Convocatoria 957 de 2024 COL0001234", "x"), (" ", "/359/x.pdf"),
], "number int, year int, kind string", [(833, 2018, "unknown"), (781, 2017, "unknown"), (640, 2013, "unknown"), (None, None, None), (894, 2021, "people"), (957, 2024, "groups"), (359, 2006, "unreadable")])
def _calls(df):
    call = acquisition.detected_call(F.col("sample"), F.col("path"))
    return [call["number"], call["year"], acquisition.source_class(F.col("sample"), call)]


@query("SELECT o_custkey AS page, line::BIGINT AS line, 'COL' || o_orderkey AS code, 'Grupo ' || o_orderpriority || ' ' || o_orderstatus AS name FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS line FROM orders)")
def banded_rows(spark, d):
    """Words of scanned pages put into rows and columns by where they lie."""
    from pyspark.sql import Window as W

    rows = table(spark, d, "orders").withColumn("line", F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey")))
    word = lambda x, dy, t: F.struct(F.lit(x).cast("double").alias("x"), (F.col("line") * 12 + dy).cast("double").alias("y"), t.cast("string").alias("text"))
    words = F.array(word(10, 3, F.concat(F.lit("COL"), "o_orderkey")), word(250, 1, F.col("o_orderstatus")), word(110, 2, F.lit("Grupo")), word(150, 2, F.col("o_orderpriority")), word(900, 2, F.lit("margin")))
    each = rows.select(F.col("o_custkey").alias("page"), F.explode(words).alias("w")).select("page", "w.*")
    return acquisition.banded_rows(each, [("code", 0, 100), ("name", 100, 400)], 12)


@query("""
    WITH c AS (SELECT l_suppkey AS source, count(*) AS rows, count(*) FILTER (l_returnflag = 'R') AS r FROM lineitem GROUP BY 1), e AS (SELECT s_suppkey AS source, CASE WHEN s_nationkey % 2 = 0 THEN 0 ELSE (SELECT count(*) FROM lineitem WHERE l_suppkey = s_suppkey) END AS expected FROM supplier)
    SELECT coalesce(c.source, e.source) AS source, coalesce(rows, 0) AS rows, expected, CASE WHEN r > 0 THEN 'returned=' || r ELSE '' END AS broken FROM c FULL JOIN e ON c.source = e.source WHERE coalesce(rows, 0) IS DISTINCT FROM expected OR coalesce(r, 0) > 0""")
def count_audit(spark, d):
    """Sources whose rows are not as many as expected, or break a rule."""
    lines = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("source"), "l_returnflag")
    counts = lines.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    expected = table(spark, d, "supplier").select(F.col("s_suppkey").alias("source"), "s_nationkey").join(counts, "source", "left")
    expected = expected.select("source", F.when(F.col("s_nationkey") % 2 == 0, 0).otherwise(F.coalesce("n", F.lit(0))).cast("long").alias("expected"))
    return acquisition.count_audit(lines, expected, ["source"], {"returned": F.col("l_returnflag") == "R"})
