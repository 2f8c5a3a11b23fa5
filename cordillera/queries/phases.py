"""Merged documents, verified authors, audits of whole phases, and differences of nested documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates, audits, matching, merge, works
from ..sources import records
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
    WITH r AS (SELECT l_partkey, l_orderkey, l_linenumber, l_returnflag AS tag, l_linestatus || l_returnflag AS note, CASE WHEN l_linestatus = 'F' THEN l_suppkey END AS first, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    t AS (SELECT l_partkey, tag, min((l_orderkey, l_linenumber)) AS o FROM r GROUP BY ALL), p AS (SELECT l_partkey, tag, count(DISTINCT o_custkey) AS k, min(o_custkey) AS c, min((l_orderkey, l_linenumber)) AS o FROM r GROUP BY ALL)
    SELECT l_partkey, count(*) AS versions, (SELECT string_agg(tag, '|' ORDER BY o) FROM t WHERE t.l_partkey = r.l_partkey) AS tags, max(note) AS note, arg_min(first, (l_orderkey, l_linenumber)) FILTER (first IS NOT NULL) AS first,
           (SELECT string_agg('Name ' || tag || ':' || CASE WHEN k = 1 THEN c::VARCHAR ELSE '' END, '|' ORDER BY CASE WHEN tag = 'N' THEN 1 ELSE 0 END, o) FROM p WHERE p.l_partkey = r.l_partkey) AS people, count(DISTINCT tag)::INTEGER AS author_count
    FROM r GROUP BY l_partkey""")
def merged_entities(spark, d):
    """Lines as versions of parts: arrays joined in order, the richest text, the first value, people by name and role.

    A line without a flag names nobody; lines without a part are counted together, but no document of theirs has arrays.
    """
    rows = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    person = F.struct(F.col("o_custkey").cast("string").alias("id"), F.concat(F.lit("Name "), "l_returnflag").alias("full_name"), F.when(F.col("l_returnflag") == "N", "advisor").otherwise("author").alias("role"))
    rows = rows.select("l_partkey", "l_orderkey", "l_linenumber", F.array("l_returnflag").alias("tags"), F.concat("l_linestatus", "l_returnflag").alias("note"), F.when(F.col("l_linestatus") == "F", F.col("l_suppkey")).alias("first"), F.when(F.col("l_returnflag").isNotNull(), F.array(person)).alias("people"))
    out = merge.merged_documents(rows, "l_partkey", ["l_orderkey", "l_linenumber"], ["tags"], ["note"], ["first"], "people")
    people = F.array_join(F.transform("people", lambda p: F.concat_ws(":", p["full_name"], F.coalesce(p["id"], F.lit("")))), "|")
    said = lambda own, text: F.when(F.col("l_partkey").isNotNull() & (F.size(F.array_compact(own)) > 0), text)
    return out.select("l_partkey", "versions", said("tags", F.array_join("tags", "|")).alias("tags"), "note", "first", said("people", people).alias("people"), "author_count")


@query("""
    WITH g AS (SELECT l_orderkey, count(DISTINCT year(l_shipdate)) AS ny, min(year(l_shipdate)) AS y, count(DISTINCT month(l_shipdate)) AS nm, min(month(l_shipdate)) AS m FROM lineitem GROUP BY 1)
    SELECT l_orderkey, CASE WHEN ny = 1 THEN y END::INTEGER AS held_year, CASE WHEN ny = 1 AND nm = 1 THEN m END::INTEGER AS held_month FROM g""")
def reconciled_dates(spark, d):
    """Dates of all versions at once: a shared year, and a shared month within it."""
    rows = table(spark, d, "lineitem").select("l_orderkey", F.date_format("l_shipdate", "yyyy-MM-dd").alias("t"))
    return merge.consensus_dates(rows, "l_orderkey", {"held": "t"}, "2026-01-01")


@query("""
    WITH c AS (SELECT DISTINCT o_custkey, o_orderkey, o_orderpriority AS k FROM orders WHERE o_orderstatus <> 'P'), v AS (SELECT o_custkey, k FROM c),
    a AS (SELECT o_custkey, count(*) AS claims, count(DISTINCT k) AS versions, min(k) AS one FROM v GROUP BY 1), s AS (SELECT DISTINCT o_custkey FROM orders)
    SELECT s.o_custkey, coalesce(claims, 0) AS claims, CASE WHEN c_mktsegment = 'BUILDING' THEN 'verified' WHEN claims IS NULL THEN 'missing' WHEN claims = 1 THEN 'single' WHEN versions = 1 THEN 'consistent' ELSE 'conflict' END AS status,
           CASE WHEN c_mktsegment = 'BUILDING' THEN c_name WHEN versions = 1 THEN one END AS authors
    FROM s LEFT JOIN a ON s.o_custkey = a.o_custkey LEFT JOIN customer ON s.o_custkey = c_custkey""")
def verified_authorship(spark, d):
    """What an authority has verified stands whatever the claims say."""
    claims = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("k"))
    claimed = works.authorship(claims, "o_custkey", "o_orderkey", "k").withColumn("family", F.lit("article"))
    known = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("authors"))
    return works.verified_authorship(claimed, known, "o_custkey")


@query("SELECT * FROM (VALUES (0, 'ana maria ruiz|luis'), (1, 'ana ruiz|ana b ruiz|ana c ruiz'), (2, 'gil paz'), (3, '')) t(id, names)")
def collapsed_names(spark, d):
    """Names that are part of exactly one longer name go."""
    rows = spark.createDataFrame([(0, "ana ruiz|ana maria ruiz|luis"), (1, "ana ruiz|ana b ruiz|ana c ruiz"), (2, "gil paz"), (3, "")], "id int, names string")
    return rows.select("id", F.array_join(works.name_aliases(F.split("names", r"\|")), "|").alias("names"))


@query("""
    WITH w AS (SELECT DISTINCT p_brand AS component, p_type AS work_id FROM part), f AS (SELECT *, min(component) OVER (PARTITION BY work_id) AS first FROM w)
    SELECT component, CASE WHEN component = first THEN work_id ELSE substr(sha256(work_id || '|' || component), 1, 24) END AS work_id FROM f""")
def rehashed_ids(spark, d):
    """Components after the first of one work id get an id of their own."""
    rows = table(spark, d, "part").select(F.col("p_brand").alias("component"), F.col("p_type").alias("work_id")).distinct()
    return works.rehash_collisions(rows, "work_id", "component").select("component", "work_id")


@query("""
    SELECT kind, n FROM (
        WITH b AS (SELECT o_custkey AS k, count(*) AS declared, count(*) FILTER (o_orderstatus <> 'P') AS actual, min(o_orderstatus) AS s FROM orders GROUP BY 1), a AS (SELECT c_custkey AS k, c_mktsegment AS seg FROM customer WHERE c_mktsegment <> 'MACHINERY'),
        j AS (SELECT a.k AS ak, b.k AS bk, seg, declared, actual, s FROM a FULL JOIN b ON a.k = b.k)
        SELECT count(*) FILTER (bk IS NULL) AS missing_normalised, count(*) FILTER (ak IS NULL) AS unexpected_normalised, count(*) FILTER (ak IS NOT NULL AND bk IS NOT NULL AND seg = 'BUILDING') AS content_hash_mismatch,
               count(*) FILTER (bk IS NOT NULL AND s = 'O') AS parser_version_mismatch, 0::BIGINT AS unfinished, count(*) FILTER (bk IS NOT NULL AND declared <> actual) AS declared_count_mismatch FROM j)
    UNPIVOT (n FOR kind IN (missing_normalised, unexpected_normalised, content_hash_mismatch, parser_version_mismatch, unfinished, declared_count_mismatch))""")
def normalisation_audit(spark, d):
    """Raw pages against normalised ones: coverage, content, parser, state and counts."""
    raw = table(spark, d, "customer").where("c_mktsegment <> 'MACHINERY'").select(F.col("c_custkey").alias("k"), F.when(F.col("c_mktsegment") == "BUILDING", "new").otherwise("same").alias("digest"))
    normal = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("declared"), F.count_if(F.col("o_orderstatus") != "P").alias("actual"), F.when(F.min("o_orderstatus") == "O", "v1").otherwise("v2").alias("parser"))
    return audits.normalisation_audit(raw, normal.withColumn("digest", F.lit("same")).withColumn("status", F.lit("complete")), "k", "v2")


@query("""
    WITH m AS (SELECT l_suppkey AS g, l_partkey AS c FROM lineitem WHERE l_returnflag = 'A')
    SELECT 'group_without_members' AS kind, (SELECT count(*) FROM supplier WHERE s_nationkey < 20 AND s_suppkey NOT IN (SELECT g FROM m)) AS n UNION ALL SELECT 'member_of_unknown_group', (SELECT count(*) FROM m WHERE g NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 20))
    UNION ALL SELECT 'member_without_person', (SELECT count(*) FROM m WHERE c NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)) UNION ALL SELECT 'repeated_membership', (SELECT count(*) FROM (SELECT g, c FROM m GROUP BY ALL HAVING count(*) > 1))""")
def member_audit(spark, d):
    members = table(spark, d, "lineitem").where("l_returnflag = 'A'").select(F.col("l_suppkey").alias("group"), F.col("l_partkey").alias("code"))
    groups = table(spark, d, "supplier").where("s_nationkey < 20").select(F.col("s_suppkey").alias("id"))
    return audits.member_audit(groups, members, table(spark, d, "part").where("p_size > 5").select(F.col("p_partkey").alias("code")))


@query("""
    SELECT o_orderkey AS k, CASE WHEN o_orderpriority = '1-URGENT' THEN 'added' WHEN o_orderpriority = '5-LOW' THEN 'removed' WHEN o_orderstatus = 'F' THEN 'unchanged' ELSE 'changed' END AS state,
           CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW') OR o_orderstatus = 'F' THEN '' WHEN o_orderstatus = 'O' THEN 'a.status' ELSE 'a.status,list[1].x' END AS paths,
           CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW') OR o_orderstatus = 'F' THEN 0 WHEN o_orderstatus = 'O' THEN 1 ELSE 2 END AS differences
    FROM orders""")
def document_diff(spark, d):
    """Nested documents of two versions, and the paths in which they differ."""
    rows = table(spark, d, "orders")
    text = lambda status, x: F.concat(F.lit('{"a":{"status":"'), status, F.lit('"},"list":[1,{"x":'), x, F.lit("}]}"))
    status = F.col("o_orderstatus")
    old = rows.where("o_orderpriority <> '1-URGENT'").select("o_orderkey", text(status, F.lit("1")).alias("j"))
    new = rows.where("o_orderpriority <> '5-LOW'").select("o_orderkey", text(F.when(status == "F", "F").otherwise("X"), F.when(status == "P", "2").otherwise("1")).alias("j"))
    return audits.document_diff(old, new, "o_orderkey", "j")


@query("SELECT min(n_nationkey)::BIGINT AS least, max(n_nationkey)::BIGINT AS greatest, count(*) AS n, sum(n_nationkey)::BIGINT AS total, true AS dense FROM nation")
def dense_numbering(spark, d):
    out = audits.density(table(spark, d, "nation"), "n_nationkey")
    return out.select(F.col("least").cast("long").alias("least"), F.col("greatest").cast("long").alias("greatest"), "n", "total", "dense")


@query("SELECT event_type AS value, count(*) AS count FROM events GROUP BY 1")
def counted_values(spark, d):
    return audits.counter_rows(table(spark, d, "events"), "event_type")


@query("""
    SELECT l_partkey, count(DISTINCT (o_orderdate, l_suppkey, l_returnflag, l_linestatus, o_orderstatus, o_orderpriority, o_custkey, l_shipdate)) AS measurements, string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority) AS ranks,
           string_agg(DISTINCT l_suppkey::VARCHAR, '|' ORDER BY l_suppkey::VARCHAR) AS "groups", string_agg(DISTINCT year(o_orderdate)::VARCHAR, '|' ORDER BY year(o_orderdate)::VARCHAR) AS years
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def distinct_measurements(spark, d):
    """Measurements by all fields that tell them apart, with ranks, groups and years as sets."""
    rows = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    fields = ["o_orderdate", "l_suppkey", "l_returnflag", "l_linestatus", "o_orderstatus", "o_orderpriority", "o_custkey", "l_shipdate"]
    said = lambda c: F.array_join(F.sort_array(F.collect_set(c.cast("string"))), "|")
    return rows.groupBy("l_partkey").agg(F.count_distinct(F.struct(*fields)).alias("measurements"), said(F.col("o_orderpriority")).alias("ranks"), said(F.col("l_suppkey")).alias("groups"), said(F.year("o_orderdate")).alias("years"))


@query("""
    WITH n AS (SELECT o_custkey, count(*) AS k, count(*) FILTER (o_orderstatus = 'F') AS f FROM orders GROUP BY 1)
    SELECT o_custkey::VARCHAR AS id, k AS old_count, k AS new_count, k - f AS unchanged, f AS modified, 0::BIGINT AS removed, 0::BIGINT AS added FROM n""")
def page_version_comparison(spark, d):
    """Two versions of personal pages parsed and compared record by record: titles stay, years change."""
    from .records import CATALOGUE, _personal

    body = '<tr><td><blockquote>{name}, "{hash}" . En: Colombia, {year}, <i>Palabras:</i> x, </blockquote></td></tr>'
    title = F.sha2(F.col("o_orderkey").cast("string"), 256)
    sides = []
    for year in (F.lit(1999), F.when(F.col("o_orderstatus") == "F", 1998).otherwise(1999)):
        parsed = records.person_pages(_personal(spark, d, "Articulos", body, hash=title, year=year), "c_custkey", "html", CATALOGUE)
        each = parsed.select("id", F.explode("production").alias("p")).select("id", "p.title", "p.year", F.col("p.type").alias("kind"), F.col("p.doi").alias("dois"), F.col("p.isbn").alias("isbns"))
        sides.append(each)
    return matching.compare_records(sides[0], sides[1], "id", F.sha2(F.concat_ws("|", "title", F.col("year").cast("string")), 256))


@query("""
    SELECT p_brand, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS anchors, count(DISTINCT p_name) AS names, CASE WHEN count(DISTINCT p_name) > 1 THEN 'review' ELSE 'merge' END AS decision, array_to_string(list_sort(list(p_partkey))[1:20], ',') AS examples
    FROM part GROUP BY 1""")
def component_reviews(spark, d):
    """Candidate groups with their anchors; those whose constraint has two values go to review with at most twenty members."""
    rows = table(spark, d, "part")
    spread = rows.groupBy("p_brand", F.pmod(F.xxhash64("p_partkey"), F.lit(16)).alias("s")).agg(F.slice(F.sort_array(F.collect_list("p_partkey")), 1, 20).alias("few"))
    few = spread.groupBy("p_brand").agg(F.array_join(F.slice(F.sort_array(F.flatten(F.collect_list("few"))), 1, 20), ",").alias("examples"))
    out = rows.groupBy("p_brand").agg(F.array_join(F.sort_array(F.collect_set("p_type")), "|").alias("anchors"), F.count_distinct("p_name").alias("names"))
    return out.join(few, "p_brand").select("p_brand", "anchors", "names", F.when(F.col("names") > 1, "review").otherwise("merge").alias("decision"), "examples")


@query("SELECT o_custkey AS id, sha256(string_agg(o_orderkey || ':' || o_orderstatus, ';' ORDER BY o_orderkey)) AS digest FROM orders GROUP BY 1")
def canonical_records(spark, d):
    """A record's digest does not depend on the order in which its parts were given."""
    part = F.struct("o_orderkey", F.concat_ws(":", "o_orderkey", "o_orderstatus").alias("t"))
    lines = F.transform(F.sort_array(F.collect_list(part)), lambda x: x["t"])
    return table(spark, d, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.sha2(F.array_join(lines, ";"), 256).alias("digest"))


@query("SELECT event_type AS kind, count(*) AS n FROM events GROUP BY 1 HAVING count(*) > 0")
def status_summary(spark, d):
    """Statuses counted: what a run says of itself."""
    return aggregates.type_distribution(table(spark, d, "events"), "event_type", "user_id", "none").select(F.col("type").alias("kind"), F.col("records").alias("n"))


@query("SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN [p_type, p_brand] ELSE [p_type] END::VARCHAR AS anchors FROM part")
def stable_anchors(spark, d):
    """Anchors that a document's occurrences bear out, in order."""
    found = F.array_compact(F.array("p_type", F.when(F.col("p_size") % 2 == 0, F.col("p_brand"))))
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.concat(F.lit("["), F.array_join(found, ", "), F.lit("]")).alias("anchors"))
