"""Selection of works by valid identifiers, their sparse projection, and proofs of copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import identified
from ..sources.tables import table

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _works(spark, d) -> DataFrame:
    """Orders as works: the priority says which identifiers they carry, the status whether these are valid."""
    rows = table(spark, d, "orders")
    kind, good = F.col("o_orderpriority"), F.col("o_orderstatus") != "P"
    code = F.lpad((F.col("o_custkey") + 1).cast("string"), 10, "0")
    product = (F.col("o_orderkey") % 1_000_000).cast("string")
    text = lambda x=None: (F.lit(None) if x is None else x).cast("string")
    entry = lambda source, value, person=None, number=None: F.struct(F.lit(source).alias("source"), text(value).alias("id"), text(person).alias("person"), text(number).alias("product"))
    entries = (
        F.when(kind == "1-URGENT", F.array(entry("doi", F.when(good, F.concat(F.lit("https://doi.org/10.1234/A"), "o_orderkey")).otherwise("10.0000/x"))))
        .when(kind == "2-HIGH", F.array(entry("isbn", F.when(good, "0-306-40615-2").otherwise("0-306-40615-3")), entry("title_fingerprint", F.lit("f"))))
        .when(kind == "3-MEDIUM", F.array(entry("pair", None, code, F.when(good, product).otherwise("x"))))
        .when(kind == "4-NOT SPECIFIED", F.array(entry("issn", F.lit("0378-5955")), entry("other", F.lit("o"))))
        .otherwise(F.array().cast(identified.ENTRY))
    )
    products = F.when(F.col("o_orderstatus") == "F", F.array(F.concat_ws("-", F.lit("ART"), code, product))).otherwise(F.array().cast("array<string>"))
    top = F.when(kind == "5-LOW", F.when(good, F.concat(F.lit("10.1234/b"), "o_orderkey")).otherwise("none"))
    return rows.select(F.col("o_orderkey").alias("id"), top.alias("doi"), entries.cast(identified.ENTRY).alias("external_ids"), products.alias("product_ids"), F.array(F.when(F.col("o_orderstatus") == "O", "Capítulo de libro").otherwise("Libro")).alias("types"))


def _people(spark, d) -> DataFrame:
    return table(spark, d, "customer").where("c_mktsegment <> 'MACHINERY'").select(F.lpad((F.col("c_custkey") + 1).cast("string"), 10, "0").alias("code"))


_FOUND = """
    w AS (SELECT o_orderkey AS id, o_orderpriority AS k, o_orderstatus AS s, c_custkey IS NOT NULL AS known FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY') ON o_custkey = c_custkey),
    f AS (SELECT *, CASE WHEN k = '1-URGENT' AND s <> 'P' THEN 'https://doi.org/10.1234/a' || id WHEN k = '5-LOW' AND s <> 'P' THEN 'https://doi.org/10.1234/b' || id END AS doi,
                 k = '2-HIGH' AND s <> 'P' AS isbn, k = '3-MEDIUM' AND s = 'F' AND known AS pair FROM w),
    g AS (SELECT *, CASE WHEN doi IS NOT NULL THEN 'doi' WHEN isbn THEN 'isbn' WHEN pair THEN 'pair' ELSE 'none' END AS combination,
                 CASE WHEN s = 'P' AND k IN ('1-URGENT', '5-LOW') THEN 'doi_invalid' WHEN s = 'P' AND k = '2-HIGH' THEN 'isbn_invalid' WHEN s = 'P' AND k = '3-MEDIUM' THEN 'pair_invalid_format'
                      WHEN s = 'O' AND k = '3-MEDIUM' THEN 'pair_missing_product_evidence' WHEN s = 'F' AND k = '3-MEDIUM' AND NOT known THEN 'pair_person_missing' ELSE '' END AS rejections FROM f)"""


@query(f"""WITH {_FOUND} SELECT id, combination <> 'none' AS eligible, combination, doi, rejections, k = '4-NOT SPECIFIED' AS issn_only, CASE WHEN isbn THEN CASE WHEN s = 'O' THEN 'container' ELSE 'work' END END AS isbn_role,
    CASE WHEN combination = 'doi' AND k = '1-URGENT' THEN 'doi=' || doi WHEN isbn THEN 'isbn=9780306406157' WHEN pair THEN 'pair=' WHEN k = '4-NOT SPECIFIED' THEN 'issn=0378-5955|other=o' ELSE '' END AS kept FROM g""")
def evaluated_works(spark, d):
    """Each work's valid identifiers, what they make it, and why others were refused."""
    found = identified.evaluate(_works(spark, d), _people(spark, d))
    kept = F.array_join(F.transform("external_ids", lambda e: F.concat(e["source"], F.lit("="), F.coalesce(e["id"], F.lit("")))), "|")
    return found.select("id", "eligible", "combination", "doi", F.array_join("rejections", ",").alias("rejections"), "issn_only", "isbn_role", kept.alias("kept"))


@query(f"WITH {_FOUND} SELECT combination, count(*) AS n, count(*) FILTER (k = '4-NOT SPECIFIED') AS issn_only FROM g GROUP BY 1")
def identifier_combinations(spark, d):
    return identified.combinations(identified.evaluate(_works(spark, d), _people(spark, d)))


@query(f"WITH {_FOUND} SELECT rejections AS reason, count(*) AS n FROM g WHERE rejections <> '' GROUP BY 1")
def identifier_rejections(spark, d):
    return identified.reasons(identified.evaluate(_works(spark, d), _people(spark, d)))


@query(f"WITH {_FOUND} SELECT count(*) AS works, bit_xor(('0x' || substr(sha256(id || '|' || combination || '|' || coalesce(doi, '')), 1, 15))::BIGINT) AS digest FROM g WHERE combination <> 'none'")
def selection_proof(spark, d):
    """What a copy of the selection must give again."""
    return identified.selection_digest(identified.evaluate(_works(spark, d), _people(spark, d)))


@query("SELECT DISTINCT lpad((o_custkey + 1)::VARCHAR, 10, '0') AS code FROM orders WHERE o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F'")
def pair_candidates(spark, d):
    """The person codes whose existence has to be asked."""
    return identified.pair_candidates(_works(spark, d))


@query("""
    SELECT o_orderkey::VARCHAR AS id, '{"titles":[{"title":"Order ' || o_orderkey || '"}]' || CASE WHEN o_orderstatus = 'F' THEN ',"doi":"x"' ELSE '' END || ',"author_count":0,"source":{"open":false}}' AS document FROM orders""")
def sparse_documents(spark, d):
    """Listed fields in their order; nulls, blanks and empty containers go at any depth, zero and false stay."""
    doi = F.when(F.col("o_orderstatus") == "F", "x").otherwise(" ")
    text = F.concat(F.lit('{"author_count":0,"other":1,"keywords":[null,"",{}],"doi":"'), doi, F.lit('","titles":[{"title":"Order '), "o_orderkey", F.lit('","lang":null},{}],"source":{"open":false,"name":""}}'))
    return identified.sparse(table(spark, d, "orders").withColumn("text", text), "o_orderkey", "text")


@query("SELECT * FROM (VALUES ('a', 'plain', 0::BIGINT), ('b', 'x' || chr(65533) || 'y', 1::BIGINT), ('c', chr(128512), 0::BIGINT), ('d', NULL, 0::BIGINT)) t(id, text, repaired)")
def mended_texts(spark, d):
    """Escapes that are no characters: a lone half becomes a replacement mark, two halves the character they are."""
    rows = spark.createDataFrame([("a", "plain"), ("b", "x\\ud800y"), ("c", "\\ud83d\\ude00"), ("d", None)], "id string, text string")
    return identified.safe_text(rows, "id", "text")


@query("SELECT c_custkey::VARCHAR AS id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'string' ELSE 'object' END AS kind FROM customer WHERE (c_mktsegment = 'BUILDING' AND c_custkey::VARCHAR > '5') OR c_mktsegment <> 'BUILDING'")
def resumed_scan(spark, d):
    """What comes after string id 5: later strings, then all object ids."""
    rows = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.when(F.col("c_mktsegment") == "BUILDING", "string").otherwise("object").alias("kind"))
    return identified.resumed(rows, "id", "kind", ("string", "5"))
