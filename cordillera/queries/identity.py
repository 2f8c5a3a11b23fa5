"""Blocking, components and authorities."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import blocking, components, linkage, merge, reconcile
from ..sources.tables import table
from .scalar import NORM

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query(f"""
    SELECT sha256(k) AS block, count(*) AS size, min(doc_id) AS first_id, max(doc_id) AS last_id
    FROM (SELECT doc_id, {NORM.format(x='text')} AS k FROM documents) WHERE k <> '' GROUP BY k HAVING count(*) >= 2""")
def blocking_exact_title(spark, d):
    blocks = blocking.exact_blocks(table(spark, d, "documents"), text.normalize_title(F.col("text")), "doc_id")
    return blocks.select(F.sha2("block_key", 256).alias("block"), "size", "first_id", "last_id")


@query("SELECT l_suppkey, year(l_shipdate)::INTEGER AS ship_year, count(*) AS size FROM lineitem GROUP BY ALL HAVING count(*) > 90")
def oversized_blocks(spark, d):
    rows = table(spark, d, "lineitem").select("l_suppkey", F.year("l_shipdate").alias("ship_year"))
    return blocking.oversized_blocks(rows, ["l_suppkey", "ship_year"], 90)


@query(rf"""
    WITH d AS (SELECT doc_id, {NORM.format(x="split_part(text, chr(10), 1)")} AS t FROM documents),
    w AS (SELECT doc_id, unnest(list_distinct(list_filter(string_split(t, ' '), lambda w: w <> ''))) AS w FROM d),
    top AS (SELECT doc_id, w FROM w QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length(w) DESC, w) <= 3),
    k AS (SELECT DISTINCT a.doc_id, 'p ' || a.w || ' ' || b.w AS k FROM top a JOIN top b ON a.doc_id = b.doc_id AND a.w < b.w UNION ALL SELECT doc_id, 't ' || t FROM d WHERE t <> ''),
    g AS (SELECT k, count(*) AS n, min(doc_id) AS least FROM k GROUP BY k HAVING count(*) > 1)
    SELECT DISTINCT 'pair' AS kind, NULL::VARCHAR AS block, NULL::BIGINT AS size, a.doc_id AS left_id, b.doc_id AS right_id
    FROM k a JOIN k b ON a.k = b.k AND a.doc_id < b.doc_id WHERE a.k IN (SELECT k FROM g WHERE n <= 100)
    UNION ALL SELECT 'oversized', sha256(k), n, least, doc_id FROM k JOIN g USING (k) WHERE n > 100""")
def blocking_token_pairs(spark, d):
    """Titles by their three longest tokens of any length and as a whole; blocks beyond the bound come as members."""
    keys = blocking.title_keys(text.normalize_title(F.substring_index("text", "\n", 1)))
    out = blocking.block_pairs_or_members(table(spark, d, "documents"), "doc_id", keys, 100)
    return out.withColumn("block", F.sha2("block", 256))


@query("""
    WITH n AS (SELECT DISTINCT p_name || ' ' || p_type AS v FROM part)
    SELECT x.v AS left_value, y.v AS right_value, levenshtein(x.v, y.v)::INTEGER AS distance FROM n x JOIN n y ON x.v < y.v WHERE levenshtein(x.v, y.v) <= 4""")
def edit_distance_pairs(spark, d):
    """All pairs of different names within four edits, whatever they begin with."""
    rows = table(spark, d, "part").select(F.concat_ws(" ", "p_name", "p_type").alias("v"))
    return reconcile.near_pairs(rows, [], "v", 4)


@query(f"""
    WITH RECURSIVE k AS (
        SELECT doc_id, 't' || sha256({NORM.format(x='text')}) AS k FROM documents
        UNION ALL SELECT doc_id, 'l' || sha256({NORM.format(x="split_part(text, chr(10), 1)")}) FROM documents WHERE length(split_part(text, chr(10), 1)) >= 40
    ),
    e AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM k a JOIN k b USING (k)),
    r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
    SELECT a AS node, min(b) AS component FROM r GROUP BY a""")
def duplicate_components(spark, d):
    docs = table(spark, d, "documents")
    first = F.substring_index("text", "\n", 1)
    whole = docs.select("doc_id", F.concat(F.lit("t"), F.sha2(text.normalize_title(F.col("text")), 256)).alias("k"))
    lines = docs.where(F.length(first) >= 40).select("doc_id", F.concat(F.lit("l"), F.sha2(text.normalize_title(first), 256)).alias("k"))
    return components.connected(components.group_edges(whole.unionByName(lines), "doc_id", "k"))


@query(None)
def guarded_components(spark, d):
    """Parts merge by brand and name while their sizes spread by 5 at most; order dependent, so beyond SQL."""
    rows = table(spark, d, "part").select("p_partkey", F.concat_ws("|", "p_name", "p_brand").alias("k"), F.col("p_size").cast("double").alias("size"))
    return components.spread_guarded(rows, "p_partkey", "k", "size", 5.0)


@query(f"""
    WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM documents),
    a AS (SELECT DISTINCT doc_id, {NORM.format(x='x')} AS k FROM l),
    m AS (SELECT item_id, unnest(string_split(text, chr(10))) AS x FROM benchmark),
    b AS (SELECT DISTINCT item_id, {NORM.format(x='x')} AS k FROM m)
    SELECT doc_id AS id, count(DISTINCT item_id) AS authorities, CASE WHEN count(DISTINCT item_id) = 1 THEN 'matched' ELSE 'conflict' END AS status,
           CASE WHEN count(DISTINCT item_id) = 1 THEN min(item_id) END AS authority
    FROM a JOIN b USING (k) WHERE length(k) >= 10 GROUP BY doc_id""")
def authority_match(spark, d):
    keys = F.filter(F.transform(F.split("text", "\n"), text.normalize_title), lambda k: F.length(k) >= 10)
    return linkage.authority_match(table(spark, d, "documents"), "doc_id", keys, table(spark, d, "benchmark"), "item_id", keys)


@query("""
    WITH n AS (SELECT DISTINCT p_brand AS brand, p_name || ' ' || lower(p_type) AS name FROM part UNION SELECT DISTINCT p_brand, p_name FROM part),
    t AS (SELECT brand, name, list_distinct(string_split(name, ' ')) AS ts FROM n)
    SELECT a.brand, a.name, min(b.name) AS alias_of FROM t a JOIN t b ON a.brand = b.brand AND len(b.ts) > len(a.ts) AND list_has_all(b.ts, a.ts)
    WHERE len(a.ts) >= 2 GROUP BY a.brand, a.name HAVING count(*) = 1""")
def alias_collapse(spark, d):
    part = table(spark, d, "part")
    names = part.select(F.col("p_brand").alias("brand"), F.concat_ws(" ", "p_name", F.lower("p_type")).alias("name")).unionByName(part.select(F.col("p_brand").alias("brand"), F.col("p_name").alias("name")))
    return merge.superset_alias(names.select("brand", F.col("name").alias("key")), "brand", "key")
