"""Normalisers, keys, identifiers and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, identifiers, text
from ..operators import aggregates
from ..sources.tables import table

QUERIES, ORACLE_SQL = {}, {}

#: The SQL of the title normaliser; strip_accents drops the same Latin accents.
NORM = r"trim(regexp_replace(regexp_replace(lower(strip_accents({x})), '\s+', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))"


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query("""
    SELECT coalesce(nullif(trim(event_type), ''), 'Sin tipo') AS type, count(*) AS records, count(DISTINCT user_id) AS members
    FROM events GROUP BY 1""")
def type_distribution(spark, d):
    return aggregates.type_distribution(table(spark, d, "events"), "event_type", "user_id", "Sin tipo")


@query(f"SELECT doc_id, length({NORM.format(x='text')})::BIGINT AS key_length, sha256({NORM.format(x='text')}) AS key_hash FROM documents")
def norm_title_hash(spark, d):
    key = text.normalize_title(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.length(key).cast("long").alias("key_length"), F.sha2(key, 256).alias("key_hash"))


@query(rf"""
    WITH t AS (SELECT doc_id, {NORM.format(x="split_part(text, chr(10), 1)")} AS k FROM documents)
    SELECT doc_id, length(k) < 20 OR len(list_filter(string_split(k, ' '), lambda w: length(w) > 2)) < 4 AS generic FROM t""")
def generic_title_flags(spark, d):
    key = text.normalize_title(F.substring_index("text", "\n", 1))
    return table(spark, d, "documents").select("doc_id", text.is_generic_title(key).alias("generic"))


@query(rf"""
    SELECT p_partkey, array_to_string(list_sort(list_filter(string_split({NORM.format(x="p_name || ' ' || p_type")}, ' '), lambda w: length(w) > 1)), ' ') AS token_key FROM part""")
def name_token_key(spark, d):
    return table(spark, d, "part").select("p_partkey", text.name_token_key(F.concat_ws(" ", "p_name", "p_type")).alias("token_key"))


@query("SELECT doc_id, (('0x' || substr(sha256(doc_id::VARCHAR), 1, 16))::UBIGINT % 64)::INTEGER AS partition_id FROM documents")
def stable_partition(spark, d):
    return table(spark, d, "documents").select("doc_id", text.stable_partition(F.col("doc_id"), 64).alias("partition_id"))


@query("SELECT c_custkey, substr(sha256(c_custkey::VARCHAR || '|' || c_name), 1, 24) AS stable_id FROM customer")
def stable_ids(spark, d):
    return table(spark, d, "customer").select("c_custkey", text.stable_id(F.concat_ws("|", "c_custkey", "c_name")).alias("stable_id"))


@query("SELECT c_custkey, sha256('seed-1:' || c_custkey::VARCHAR) AS draw FROM customer ORDER BY 2 LIMIT 100")
def stable_sample(spark, d):
    draw = F.sha2(F.concat(F.lit("seed-1:"), F.col("c_custkey").cast("string")), 256)
    return table(spark, d, "customer").select("c_custkey", draw.alias("draw")).orderBy("draw").limit(100)


def _sum(x: str, weights: list[int]) -> str:
    return " + ".join(f"CAST(substr({x}, {i}, 1) AS INTEGER) * {w}" for i, w in enumerate(weights, 1))


@query(f"""
    WITH k AS (SELECT o_orderkey, lpad(o_orderkey::VARCHAR, 8, '0') AS s, '978' || lpad(o_orderkey::VARCHAR, 10, '0') AS b FROM orders)
    SELECT o_orderkey,
           CASE WHEN ({_sum('s', [8, 7, 6, 5, 4, 3, 2, 1])}) % 11 = 0 THEN substr(s, 1, 4) || '-' || substr(s, 5, 4) END AS issn,
           CASE WHEN ({_sum('b', [1, 3] * 6 + [1])}) % 10 = 0 THEN b END AS isbn
    FROM k""")
def identifier_checksums(spark, d):
    key = F.col("o_orderkey").cast("string")
    issn, isbn = identifiers.valid_issn(F.lpad(key, 8, "0")), identifiers.valid_isbn(F.concat(F.lit("978"), F.lpad(key, 10, "0")))
    return table(spark, d, "orders").select("o_orderkey", issn.alias("issn"), isbn.alias("isbn"))


@query(r"""
    WITH y AS (SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '\b((?:19|20)[0-9]{2})\b', 1), lambda x: x::INTEGER), lambda x: x BETWEEN 1950 AND 2026) AS ys FROM documents)
    SELECT doc_id, len(ys)::BIGINT AS years, list_extract(ys, -1) AS last_year FROM y""")
def extract_years(spark, d):
    years = dates.years_in(F.col("text"))
    out = table(spark, d, "documents").select("doc_id", years.alias("ys"))
    return out.select("doc_id", F.size("ys").cast("long").alias("years"), F.try_element_at("ys", F.lit(-1)).alias("last_year"))


@query(r"""
    SELECT page_id, lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/@?#]*@)?([^/:?#]+)', 1)) AS host,
           regexp_extract(url, '[?&]page=([^&#]*)', 1) AS page,
           regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(url, '#.*$', ''),
               '([?&])utm_[^=&]*=[^&]*', '\1', 'g'), '[?&]+$', ''), '([?&])&+', '\1', 'g'), '^http://', 'https://'), '/$', '') AS canonical
    FROM pages""")
def url_identifiers(spark, d):
    url = F.col("url")
    return table(spark, d, "pages").select("page_id", identifiers.url_host(url).alias("host"), identifiers.url_parameter(url, "page").alias("page"), identifiers.canonical_url(url).alias("canonical"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey <> 0 THEN lpad(o_orderkey::VARCHAR, 10, '0') END AS code, epoch(o_orderdate + INTERVAL 5 HOUR)::BIGINT AS local_epoch FROM orders")
def person_codes_and_epochs(spark, d):
    rows = table(spark, d, "orders")
    return rows.select("o_orderkey", identifiers.person_code(F.col("o_orderkey")).alias("code"), dates.local_epoch(F.col("o_orderdate")).alias("local_epoch"))


@query("""
    SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m') AS raw,
           CASE WHEN l_shipdate < DATE '2000-01-01' THEN year(l_shipdate) END::INTEGER AS year, CASE WHEN l_shipdate < DATE '2000-01-01' THEN month(l_shipdate) END::INTEGER AS month,
           CASE WHEN l_shipdate < DATE '2000-01-01' THEN 'month' END AS "precision", CASE WHEN l_shipdate < DATE '2000-01-01' THEN 'valid' ELSE 'invalid' END AS status
    FROM lineitem""")
def partial_dates(spark, d):
    """Months up to the end of 1999; what lies later is invalid."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.date_format("l_shipdate", "yyyy-MM").alias("raw"))
    rows = rows.withColumn("p", dates.partial_date(F.col("raw"), "1999-12-31"))
    return rows.select("l_orderkey", "l_linenumber", "raw", "p.year", "p.month", "p.precision", "p.status")
