"""Guarded merging of works, identity checks and one-to-one comparison of records."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import matching, works
from ..sources.tables import table
from .cases import cases
from .scalar import NORM

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


_T = ["estudio de la flora del norte andino", "historia de los caminos de hierro", "teoria general de los grafos dirigidos", "palabras completamente distintas en este lugar", "manual de campo para geologos jovenes"]
_TYPES = "id string, title string, year int, family string, dois array<string>, isbns array<string>, owner string, profile string, names array<string>, advised array<string>"


def _node(i, t, y, family="article", dois=(), isbns=(), names=(), profile=None, advised=(), owner=""):
    return (i, t, y, family, list(dois), list(isbns), owner, profile, list(names), list(advised))


#: One work by a DOI over two years; a title that differs; years too far; families; generic titles; books with and without ISBN; one profile's theses.
NODES = [
    _node("a1", _T[0], 2020, dois=["d1"]), _node("a2", _T[0], 2021, dois=["d1"]), _node("a3", _T[3], 2020, dois=["d1"]), _node("b1", _T[1], 2021, dois=["d2"]), _node("b2", _T[1], 2024, dois=["d2"]),
    _node("c1", _T[2], 2020, dois=["d3"]), _node("c2", _T[2], 2020, "book_chapter", dois=["d3"]), _node("e1", "notas", 2019), _node("e2", "notas", 2019), _node("e3", "notas", 2018, names=["ana paz"]), _node("e4", "notas", 2018, names=["ana paz"]),
    _node("f1", _T[4], 2015, "book", isbns=["i1"]), _node("f2", _T[4], 2015, "book", isbns=["i2"]), _node("f3", _T[4], 2015, "book", isbns=["i1"]), _node("g1", _T[4], 2011), _node("g2", _T[4], 2011), _node("g3", _T[4], 2011, dois=["d4"]), _node("g4", _T[4], 2011, dois=["d5"]),
    _node("h1", _T[4], None), _node("h2", _T[4], None),
]
_ROOTS = {"a2": "a1", "e4": "e3", "f3": "f1", "g2": "g1", "g3": "g1"}
_EVIDENCE = [
    ("edge", "a1", "a2", "d1"), ("review", "a3", "a1", "doi_title_conflict"), ("review", "b2", "b1", "doi_year_conflict"), ("review", "c2", "c1", "doi_type_conflict"), ("review", "c1", "c2", "type_conflict"),
    ("review", "e1", "e2", "generic_title_without_author_evidence"), ("edge", "e3", "e4", "002018|notas"), ("review", "f1", "f2", "book_title_without_isbn_or_author_evidence"), ("edge", "f1", "f3", f"002015|{_T[4]}"),
    ("edge", "g1", "g2", f"002011|{_T[4]}"), ("edge", "g1", "g3", f"002011|{_T[4]}"), ("review", "g1", "g4", "doi_conflict"),
]
_GOLD = [("member", n[0], _ROOTS.get(n[0], n[0]), "") for n in NODES] + _EVIDENCE


@query("SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(f"'{x}'" for x in row) + ")" for row in _GOLD) + ") t(kind, left_id, right_id, reason)")
def work_guard_cases(spark, d):
    """Edges, what goes to review and why, and the component of each occurrence."""
    members, evidence = matching.work_components(spark.createDataFrame(NODES, _TYPES))
    rows = members.select(F.lit("member").alias("kind"), F.col("id").alias("left_id"), F.col("root").alias("right_id"), F.lit("").alias("reason"))
    return rows.unionByName(evidence.select("kind", "left_id", "right_id", "reason"))


_DOCS = rf"""d AS (SELECT doc_id, {NORM.format(x="split_part(text, chr(10), 1)")} AS t, lang, source FROM documents),
    g AS (SELECT *, length(t) < 20 OR len(list_filter(string_split(t, ' '), lambda w: length(w) > 2)) < 4 AS generic, count(*) OVER (PARTITION BY t) AS n FROM d)"""


def _titles(spark, d):
    key = text.normalize_title(F.substring_index("text", "\n", 1))
    none = F.array().cast("array<string>")
    return table(spark, d, "documents").select(
        F.col("doc_id").alias("id"), key.alias("title"), F.lit(2020).alias("year"), F.col("lang").alias("family"), none.alias("dois"), none.alias("isbns"), F.lit("").alias("owner"), F.lit(None).cast("string").alias("profile"),
        F.array("source").alias("names"), none.alias("advised"),
    )


@query(f"""WITH {_DOCS}
    SELECT doc_id AS id, CASE WHEN t = '' OR n > 250 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY t, lang, CASE WHEN generic THEN source END) END AS root FROM g""")
def work_components(spark, d):
    """Documents as occurrences: titles and languages, and sources as names where a title is generic."""
    return matching.work_components(_titles(spark, d))[0]


@query(f"""WITH {_DOCS}, f AS (SELECT t, lang, min(doc_id) AS head FROM g WHERE t <> '' AND n BETWEEN 2 AND 250 GROUP BY t, lang), h AS (SELECT t, min_by(head, lang) AS first, count(*) AS k FROM f GROUP BY t)
    SELECT first AS left_id, f.head AS right_id FROM f JOIN h USING (t) WHERE k > 1 AND head <> first""")
def type_conflicts(spark, d):
    """Heads of the families that one title and year has: they go to review."""
    evidence = matching.work_components(_titles(spark, d))[1]
    return evidence.where("kind = 'review' and reason = 'type_conflict'").select("left_id", "right_id")


@query("""
    SELECT o_custkey, count(*) FILTER (o_orderpriority <> '1-URGENT') AS old_count, count(*) FILTER (o_orderpriority <> '5-LOW') AS new_count,
           count(*) FILTER (o_orderpriority NOT IN ('1-URGENT', '5-LOW') AND o_orderstatus <> 'P') AS unchanged, count(*) FILTER (o_orderpriority NOT IN ('1-URGENT', '5-LOW') AND o_orderstatus = 'P') AS modified,
           count(*) FILTER (o_orderpriority = '5-LOW') AS removed, count(*) FILTER (o_orderpriority = '1-URGENT') AS added
    FROM orders GROUP BY 1""")
def record_comparison(spark, d):
    """Two versions of each customer's orders: records that changed are matched by title and year, not counted twice."""
    rows = table(spark, d, "orders")
    none = F.array().cast("array<string>")
    side = lambda df, status: df.select("o_custkey", F.sha2(F.col("o_orderkey").cast("string"), 256).alias("title"), F.year("o_orderdate").alias("year"), F.lit("work").alias("kind"), none.alias("dois"), none.alias("isbns"), status.alias("status"))
    old = side(rows.where("o_orderpriority <> '1-URGENT'"), F.col("o_orderstatus"))
    new = side(rows.where("o_orderpriority <> '5-LOW'"), F.when(F.col("o_orderstatus") == "P", "X").otherwise(F.col("o_orderstatus")))
    return matching.compare_records(old, new, "o_custkey", F.sha2(F.concat_ws("|", "title", "year", "status"), 256))


@query("""SELECT * FROM (VALUES ('r1', 1.0::DOUBLE, true, true, true), ('r2', 1.0::DOUBLE, false, true, false), ('r3', 0.0::DOUBLE, false, false, false), ('r4', 0.983051::DOUBLE, true, true, true), ('r5', 1.0::DOUBLE, true, false, false))
    t(key, title_score, year_match, type_match, confirmed)""")
def identity_match_cases(spark, d):
    """Local rows against a registry's answers: title, year and type must all agree."""
    rows = spark.createDataFrame([("r1", _T[0], 2020, "article"), ("r2", _T[0], 2019, "article"), ("r3", _T[1], 2019, "book"), ("r4", "a study of the northern flora", 2001, "book"), ("r5", _T[2], 2001, "book")], "key string, title string, year int, family string")
    answers = spark.createDataFrame([("r1", ["x", _T[0]], [2020, 2021], "article"), ("r2", [_T[0]], [2020], "article"), ("r4", ["a study of the northern floras"], [2001], "book"), ("r5", [_T[2]], [2001], "article")], "key string, titles array<string>, years array<int>, family string")
    return matching.identity_match(rows, answers, "key")


@cases("author_evidence_cases", "a string, b string, same boolean, x string, y string", [
    ("ana paz|luis", "luis|eva", False, "", ""), ("ana", "eva", False, "zoe", "zoe"), ("ana", "ana", True, "", ""), ("", "", False, "", ""), ("ana", "ana", True, "zoe", "zoe"),
], "evidence string", [("author",), ("advised",), (None,), (None,), ("advised",)])
def _evidence(df):
    names = lambda x: F.filter(F.split(x, r"\|"), lambda n: n != "")
    return [works.author_evidence(names(F.col("a")), names(F.col("b")), F.col("same"), names(F.col("x")), names(F.col("y")))]


@query("""SELECT * FROM (VALUES ('estudio de la flora del norte', 'estudio de la flora del nortes'), ('abc', 'abc')) t(l, r)""")
def near_title_pairs(spark, d):
    """Candidate pairs whose titles reach the ratio of candidates."""
    pairs = [("estudio de la flora del norte", "estudio de la flora del nortes"), ("estudio de la flora", "estudio de la fauna"), ("abc", "abc"), (None, "abc"), ("tide", "diet")]
    return matching.titled_pairs(spark.createDataFrame(pairs, "l string, r string"), "l", "r")
