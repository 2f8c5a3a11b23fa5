"""Works from components of occurrences."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bibliography, text
from ..operators import works
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
    WITH r AS (SELECT sha256({NORM.format(x='text')}) AS c, doc_id, split_part(text, chr(10), 1) AS t, (1990 + n_chars % 30)::INTEGER AS y, CASE WHEN doc_id % 3 = 0 THEN source END AS i FROM documents),
    y AS (SELECT c, arg_min(y, (-n, y)) AS year FROM (SELECT c, y, count(*) AS n FROM r GROUP BY ALL) GROUP BY c),
    b AS (SELECT c, count(*) AS occurrences, sha256(arg_max(t, (length(t), t))) AS title_hash, count(DISTINCT i) AS identifiers, min(i) AS i, min(doc_id) AS f FROM r GROUP BY c)
    SELECT c AS component, occurrences, title_hash, year, identifiers,
           CASE WHEN identifiers = 1 THEN 'identifier' WHEN occurrences > 1 THEN 'cluster' ELSE 'occurrence' END AS rule,
           substr(sha256(CASE WHEN identifiers = 1 THEN 'identifier|' || i WHEN occurrences > 1 THEN 'cluster|' || c ELSE 'occurrence|' || f END), 1, 24) AS work_id
    FROM b JOIN y USING (c)""")
def materialized_works(spark, d):
    """Documents as occurrences, equal normal texts as components, sources as identifiers of some."""
    rows = table(spark, d, "documents").select(
        F.sha2(text.normalize_title(F.col("text")), 256).alias("component"),
        "doc_id",
        F.substring_index("text", "\n", 1).alias("title"),
        (1990 + F.col("n_chars") % 30).cast("int").alias("y"),
        F.when(F.col("doc_id") % 3 == 0, F.col("source")).alias("identifier"),
    )
    out = works.works(rows, "component", "doc_id", "title", "y", "identifier")
    return out.select("component", "occurrences", F.sha2("title", 256).alias("title_hash"), "year", "identifiers", "rule", "work_id")


@query("""
    WITH c AS (SELECT DISTINCT l_partkey, l_orderkey, CASE WHEN l_returnflag <> 'N' THEN l_returnflag || l_linestatus END AS k FROM lineitem),
    s AS (SELECT l_partkey, l_orderkey, list_sort(list(k) FILTER (k IS NOT NULL)) AS names FROM c GROUP BY ALL),
    v AS (SELECT l_partkey, names, count(*) AS n FROM s WHERE names IS NOT NULL GROUP BY ALL),
    o AS (SELECT l_partkey, sum(n)::BIGINT AS claims, count(*) AS versions, arg_max(names, (len(names), array_to_string(names, '|'))) AS widest, len(list_distinct(flatten(list(names)))) AS e FROM v GROUP BY 1),
    x AS (SELECT *, CASE WHEN claims = 1 THEN 'single' WHEN versions = 1 THEN 'consistent' WHEN len(widest) = e THEN 'combined' ELSE 'conflict' END AS status FROM o)
    SELECT p.l_partkey, coalesce(claims, 0) AS claims, coalesce(status, 'missing') AS status, CASE WHEN status <> 'conflict' THEN array_to_string(widest, '|') END AS authors
    FROM (SELECT DISTINCT l_partkey FROM lineitem) p LEFT JOIN x ON p.l_partkey = x.l_partkey""")
def authorship_status(spark, d):
    """Parts as works, orders as occurrences, flags as names; a line that was not returned names nobody."""
    rows = table(spark, d, "lineitem").select("l_partkey", "l_orderkey", F.when(F.col("l_returnflag") != "N", F.concat("l_returnflag", "l_linestatus")).alias("k"))
    return works.authorship(rows, "l_partkey", "l_orderkey", "k")


@query("""
    WITH l AS (SELECT lang AS work, 'source' AS field, source AS value FROM documents UNION ALL SELECT lang, 'lang', upper(lang) FROM documents)
    SELECT work, field, count(DISTINCT lower(trim(value))) AS "values", CASE WHEN count(DISTINCT lower(trim(value))) = 1 THEN 'consistent' ELSE 'conflict' END AS state, arg_max(value, (length(value), value)) AS richest
    FROM l WHERE value <> '' GROUP BY ALL""")
def bibliographic_evidence(spark, d):
    rows = table(spark, d, "documents").withColumn("work", F.col("lang"))
    return works.field_evidence(rows, "work", {"source": F.col("source"), "lang": F.upper("lang")})


@query("""
    SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_partkey || '-' || (p_partkey + p_size) END AS pages,
           CASE p_size % 3 WHEN 0 THEN 'es' WHEN 1 THEN 'en' END AS lang FROM part""")
def field_validators(spark, d):
    """Pages with their ends the wrong way round are blank, and so are unknown languages."""
    size = F.col("p_size")
    span = F.when(size % 4 == 0, F.concat_ws("-", F.col("p_partkey") + size, F.col("p_partkey") - 1)).otherwise(F.concat(F.lit("pp. "), F.col("p_partkey"), F.lit(" – "), F.col("p_partkey") + size))
    language = F.when(size % 3 == 0, "Español").when(size % 3 == 1, " INGLÉS ").otherwise("klingon")
    return table(spark, d, "part").select("p_partkey", bibliography.clean_pages(span).alias("pages"), bibliography.language_code(language).alias("lang"))
