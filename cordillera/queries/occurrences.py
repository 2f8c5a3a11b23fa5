"""Records of pages to routed occurrences, entity documents and graph nodes, and the care of the type catalogue."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import occurrences, routing
from ..plans import facade
from ..sources.tables import ensure_shared_dir, table
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


#: A small catalogue: parent (blank: any section), type, entity and target.
CATALOGUE = [
    ("", "Publicado en revista especializada", "works", "Artículo de revista"), ("Proyectos", "Investigación y desarrollo", "projects", "Proyecto"), ("Eventos Científicos", "Congreso", "events", "Evento"),
    ("Patentes", "Patente", "patents", "Patente"), ("", "Software", "patents", "Software"), ("", "Tesis de doctorado", "works", "Tesis de posgrado"),
]
_CATALOGUE = "c(parent, type, entity, target) AS (VALUES " + ", ".join("(" + ", ".join(f"'{x}'" for x in row) + ")" for row in CATALOGUE) + ")"


def catalogue(spark) -> DataFrame:
    return spark.createDataFrame(CATALOGUE, "parent string, type string, entity string, target string")


_RECORD = "struct<title: string, product_type: string, project_type: string, event_type: string, source_section: string, year: string, start_date: string, authors: array<string>, oriented_people: array<string>, registration_number: string, raw_text: string>"


def _pages(spark, d) -> DataFrame:
    """Customers as personal pages: an order's priority says which channel its record stands in."""
    rows = table(spark, d, "orders")
    kind, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    title = F.when(status == "P", "Sin título").otherwise(F.concat(F.lit("Study number "), "o_orderkey", F.lit(" of the flora of "), status))
    none = F.array().cast("array<string>")
    record = F.struct(
        title.alias("title"), F.when(kind == "1-URGENT", "Publicado en  revista especializada").when(kind == "2-HIGH", "Trabajos dirigidos/Tutorías - Tesis de doctorado").when(kind == "5-LOW", F.when(status == "F", "Patente").otherwise(F.lit("Otra"))).alias("product_type"),
        F.when(kind == "3-MEDIUM", "Investigación y desarrollo").alias("project_type"), F.when(kind == "4-NOT SPECIFIED", "Tipo: CONGRESO").alias("event_type"), F.when(kind == "1-URGENT", "Articulos").when(kind == "2-HIGH", "Trabajos dirigidos/tutorias").alias("source_section"),
        F.year("o_orderdate").cast("string").alias("year"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("start_date"), F.when(kind == "1-URGENT", F.array(F.lit("Ana Paz"), F.lit("ana  PAZ"))).otherwise(none).alias("authors"),
        F.when(kind == "2-HIGH", F.array(F.lit("Luis Gil"))).otherwise(none).alias("oriented_people"), F.when(kind == "5-LOW", F.concat(F.lit("NC-"), "o_orderkey")).alias("registration_number"), F.lit("raw").alias("raw_text"),
    ).cast(_RECORD)
    channel = F.when(kind.isin("1-URGENT", "2-HIGH"), "production").when(kind == "3-MEDIUM", "projects").when(kind == "4-NOT SPECIFIED", "events").otherwise("patents")
    rows = rows.select("o_custkey", "o_orderkey", channel.alias("channel"), record.alias("record"))
    held = lambda name: F.transform(F.sort_array(F.collect_list(F.when(F.col("channel") == name, F.struct("o_orderkey", "record")))), lambda x: x["record"]).alias(name)
    return rows.groupBy("o_custkey").agg(*[held(c) for c in occurrences.CHANNELS])


def _outcomes(spark, d) -> DataFrame:
    return occurrences.outcomes(occurrences.exploded(_pages(spark, d), "o_custkey"), catalogue(spark))


_RECORDS = """
    r AS (SELECT *, o_custkey::VARCHAR AS source_id, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'production' WHEN o_orderpriority = '3-MEDIUM' THEN 'projects' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'events' ELSE 'patents' END AS channel,
                 CASE WHEN o_orderstatus = 'P' THEN 'Sin título' ELSE 'Study number ' || o_orderkey || ' of the flora of ' || o_orderstatus END AS title FROM orders),
    x AS (SELECT *, (row_number() OVER (PARTITION BY o_custkey, channel ORDER BY o_orderkey) - 1)::INTEGER AS record_index,
                 CASE WHEN channel = 'production' THEN 'works' WHEN channel = 'patents' AND o_orderstatus <> 'F' THEN NULL ELSE channel END AS entity,
                 CASE o_orderpriority WHEN '1-URGENT' THEN 'work' WHEN '2-HIGH' THEN 'graduate_thesis' WHEN '3-MEDIUM' THEN 'project' WHEN '4-NOT SPECIFIED' THEN 'event' ELSE CASE WHEN o_orderstatus = 'F' THEN 'patent' END END AS family,
                 CASE o_orderpriority WHEN '1-URGENT' THEN 'production_channel' WHEN '2-HIGH' THEN 'exact_thesis_type' WHEN '3-MEDIUM' THEN 'exact_project_type' WHEN '4-NOT SPECIFIED' THEN 'exact_event_type' ELSE CASE WHEN o_orderstatus = 'F' THEN 'exact_patent_type' END END AS rule FROM r),
    o AS (SELECT *, CASE WHEN entity IS NULL THEN 'unmapped' WHEN entity IN ('projects', 'patents') AND title = 'Sin título' THEN 'excluded_incomplete' ELSE 'entity' END AS outcome FROM x)"""


@query(f"WITH {_RECORDS} SELECT source_id, channel, record_index, entity, family, rule, outcome, CASE WHEN outcome = 'excluded_incomplete' THEN 'placeholder_title' END AS reason FROM o")
def occurrence_outcomes(spark, d):
    """Every record of every page with its route and what became of it."""
    return _outcomes(spark, d).select("source_id", "channel", "record_index", "entity", "family", "rule", "outcome", "reason")


@query(f"WITH {_RECORDS} SELECT outcome, CASE WHEN outcome = 'excluded_incomplete' THEN 'placeholder_title' END AS reason, channel, count(*) AS n FROM o WHERE outcome <> 'entity' GROUP BY ALL")
def unmaterialized_records(spark, d):
    return occurrences.unmaterialized(_outcomes(spark, d)).groupBy("outcome", "reason", "channel").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_RECORDS}
    SELECT source_id, channel, record_index, entity, title, year(o_orderdate)::INTEGER AS year,
           CASE WHEN entity = 'projects' AND o_orderstatus <> 'P' THEN 'project' WHEN entity = 'events' AND o_orderstatus <> 'P' THEN 'event' WHEN entity = 'patents' THEN 'ip' WHEN o_orderpriority = '2-HIGH' AND o_orderstatus <> 'P' THEN 'thesis' ELSE 'source' END AS identity_rule,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 'ana PAZ:author|' || c_name || ':author' WHEN o_orderpriority = '2-HIGH' THEN 'Luis Gil:author|' || c_name || ':advisor' ELSE c_name || ':author' END AS authors,
           CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 2 ELSE 1 END AS author_count,
           CASE entity WHEN 'projects' THEN 'project_type,start_date,year' WHEN 'events' THEN 'event_type,start_date' WHEN 'patents' THEN 'registration_number,year' ELSE '' END AS kept
    FROM o JOIN customer ON o_custkey = c_custkey WHERE outcome = 'entity'""")
def entity_documents(spark, d):
    """Entity documents of one occurrence each: identity, authors by role, and the fields that are kept."""
    owners = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("owner_id"), "c_name")
    rows = _outcomes(spark, d).join(owners, F.col("source_id") == F.col("owner_id"))
    out = occurrences.documents(rows, F.col("c_name"), "profiles")
    people = F.array_join(F.transform("authors", lambda a: F.concat_ws(":", a["full_name"], a["role"])), "|")
    return out.select("source_id", "channel", "record_index", "entity", "title", "year", "identity_rule", people.alias("authors"), "author_count", F.array_join(F.array_sort(F.map_keys("metadata")), ",").alias("kept"))


@query(f"""WITH {_RECORDS} SELECT entity, count(*) AS documents, count(DISTINCT CASE WHEN entity = 'patents' THEN 'NC' || o_orderkey || title WHEN o_orderstatus = 'P' OR o_orderpriority = '1-URGENT' THEN source_id || channel || record_index ELSE title END) AS entities
    FROM o WHERE outcome = 'entity' GROUP BY entity""")
def entity_identities(spark, d):
    """How many entities the documents are: occurrence ids never repeat, entity ids do where anchors agree."""
    out = occurrences.documents(_outcomes(spark, d), F.lit("Owner"), "profiles")
    return out.groupBy("entity").agg(F.count_distinct("occurrence_id").alias("documents"), F.count_distinct("entity_id").alias("entities"))


@query(f"""WITH {_RECORDS}, n AS (SELECT *, {NORM.format(x="replace(title, 'í', 'i')")} AS title_key FROM o WHERE outcome = 'entity' AND entity = 'works')
    SELECT source_id, record_index, title_key, year(o_orderdate)::INTEGER AS year, CASE WHEN o_orderpriority = '1-URGENT' THEN 'article' ELSE 'unknown' END AS type_family,
           (('0x' || substr(sha256(title_key), 1, 16))::UBIGINT % 64)::INTEGER AS title_partition FROM n""")
def graph_nodes(spark, d):
    """Works with a title as nodes of the graph."""
    return occurrences.graph_nodes(_outcomes(spark, d), "v1").select("source_id", "record_index", "title_key", "year", "type_family", "title_partition")


@query(f"WITH {_RECORDS} SELECT entity, count(*) AS skipped FROM o WHERE outcome = 'entity' AND entity <> 'works' GROUP BY entity")
def graph_skipped(spark, d):
    return occurrences.skipped_by_entity(_outcomes(spark, d))


@query("""
    WITH s AS (SELECT o_custkey, o_orderpriority, count(*) AS k FROM orders GROUP BY ALL), u AS (SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus <> 'P')
    SELECT c_custkey AS code, p AS kind, coalesce(k, 0) AS documents, CASE WHEN k IS NULL THEN 'missing' WHEN k = 1 THEN 'unique' ELSE 'several' END AS state
    FROM customer, (SELECT DISTINCT o_orderpriority AS p FROM orders) LEFT JOIN s ON c_custkey = o_custkey AND p = o_orderpriority""")
def located_occurrences(spark, d):
    """Signatures looked up in all destinations at once."""
    orders = table(spark, d, "orders")
    held = orders.select(F.lit("orders").alias("entity"), F.col("o_orderkey").alias("document"), F.col("o_custkey").alias("code"), F.col("o_orderpriority").alias("kind"))
    kinds = orders.select("o_orderpriority").distinct()
    wanted = table(spark, d, "customer").select(F.col("c_custkey").alias("code"), F.explode(F.array(*[F.lit(r[0]) for r in kinds.collect()])).alias("kind"))  # five kinds
    return occurrences.located(wanted, held, ["code", "kind"]).select("code", "kind", "documents", "state")


@cases("context_cases", "channel string, section string, project string, event string, product string", [
    ("production", "Articulos", None, None, "Artículo"), ("projects", None, "Investigación", None, "x"), ("events", "", None, "Tipo de evento: Congreso", None), ("production", "Proyectos", "P", None, "x"), ("patents", None, None, None, "Patente"), ("projects", None, None, None, "fallback"),
], "kind string, section string", [("Artículo", "Articulos"), ("Investigación", "Proyectos"), ("Congreso", "Eventos Científicos"), ("P", "Proyectos"), ("Patente", "Patentes"), ("fallback", "Proyectos")])
def _context(df):
    found = routing.context(*[F.col(c) for c in ("channel", "section", "project", "event", "product")])
    return [found["kind"], found["section"]]


_GROUP_ROWS = [
    ("Trabajos dirigidos/turorías", "Tesis de doctorado"), ("Trabajos dirigidos/turorías", "Otra"), ("Proyectos", "Investigación y desarrollo"), ("Proyectos", "Otra"), ("Eventos Científicos", "Congreso"),
    ("Signos distintivos", "Marcas"), ("Signos distintivos", "Otra"), ("Diseños industriales", "Diseño Industrial"), ("Softwares", "Software"), ("Artículos publicados", "Publicado en revista especializada"), ("Mapas", "Mapa"),
]
_GROUP_WANT = [
    ("works", "graduate_thesis", "exact_thesis_type", None), ("works", "work", "directed_work_section", None), ("projects", "project", "exact_project_type", None), (None, None, None, None), ("events", "event", "exact_event_type", None),
    ("patents", "intellectual_property", "exact_patent_property", "trademark"), (None, None, None, None), ("works", "work", "exact_work_property", "industrial_design"), ("patents", "patent", "production_section", None), ("works", "work", "production_section", None), ("works", "work", "production_section", None),
]


@query("SELECT * FROM (VALUES " + ", ".join("(" + ", ".join("NULL::VARCHAR" if x is None else f"'{x}'" for x in (*a, *b)) + ")" for a, b in zip(_GROUP_ROWS, _GROUP_WANT)) + ") t(section, kind, entity, family, rule, namespace)")
def group_route_cases(spark, d):
    """Sections and types of group pages; unknown types of special sections are held."""
    rows = spark.createDataFrame(_GROUP_ROWS, "section string, kind string")
    return routing.route_group(rows, catalogue(spark), "section", "kind").select("section", "kind", "entity", "family", "rule", "namespace")


@query("""
    WITH s AS (SELECT p_brand AS parent, p_type AS type, min(p_name) AS target FROM part WHERE p_size >= 10 GROUP BY ALL), o AS (SELECT p_brand AS parent, lower(p_type) || ' :' AS type, p_type AS t, count(*) AS frequency, min(p_name) AS target FROM part GROUP BY ALL)
    SELECT s.parent, s.type, 'works' AS entity, s.target, CASE WHEN s.target = o.target THEN 'inherited' ELSE 'approved' END AS status, coalesce(frequency, 0) AS frequency FROM s LEFT JOIN o ON s.parent = o.parent AND s.type = o.t""")
def merged_catalogue(spark, d):
    """The shared catalogue owns assignments; what was observed keeps its counts."""
    part = table(spark, d, "part")
    shared = part.where("p_size >= 10").groupBy(F.col("p_brand").alias("parent"), F.col("p_type").alias("type")).agg(F.min("p_name").alias("target")).withColumn("entity", F.lit("works"))
    seen = part.groupBy(F.col("p_brand").alias("parent"), F.concat(F.lower("p_type"), F.lit(" :")).alias("type")).agg(F.min("p_name").alias("target"), F.count(F.lit(1)).alias("frequency"))
    return routing.merged_catalogue(shared, seen.withColumn("entity", F.lit("works")).withColumn("status", F.lit("inherited")))


def _entries(spark, d) -> DataFrame:
    """Types of orders: a native label, a target label, and sometimes neither."""
    rows = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    source = F.when(F.col("l_linestatus") == "F", "native").otherwise("target")
    kind = F.when(F.col("l_returnflag") == "R", "Investigación y desarrollo").when(F.col("l_returnflag") == "A", "Proyecto").otherwise(F.when(F.col("o_orderstatus") == "P", "").otherwise(F.lit("Patente")))
    return rows.select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("place"), source.alias("source"), kind.alias("type"), F.when(source == "native", "Proyectos").alias("parent"))


_TYPES = """
    e AS (SELECT l_orderkey AS doc, l_linenumber AS place, CASE WHEN l_linestatus = 'F' THEN 'native' ELSE 'target' END AS source,
                 CASE l_returnflag WHEN 'R' THEN 'Investigación y desarrollo' WHEN 'A' THEN 'Proyecto' ELSE CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'Patente' END END AS type FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    k AS (SELECT *, CASE WHEN type = '' THEN 'invalid_type_shape' WHEN source = 'target' THEN CASE type WHEN 'Proyecto' THEN NULL WHEN 'Patente' THEN 'type_belongs_to_other_entity' ELSE 'unmapped_target_type' END
                         WHEN type = 'Investigación y desarrollo' THEN NULL ELSE 'unmapped_native_type' END AS reason FROM e)"""


@query(f"WITH {_TYPES} SELECT doc, place, reason FROM k")
def checked_types(spark, d):
    """Types of projects: accepted, or refused with a reason."""
    return routing.checked_types(_entries(spark, d), catalogue(spark), "projects").select("doc", "place", "reason")


@query(f"""WITH {_TYPES}, g AS (SELECT doc, source || ':' || type AS t, min(place) AS p FROM k WHERE reason IS NULL GROUP BY ALL),
    a AS (SELECT doc, string_agg(t, '|' ORDER BY p, t) AS types, count(*) AS n FROM g GROUP BY doc), f AS (SELECT doc, string_agg(DISTINCT reason || ':' || type, '|' ORDER BY reason || ':' || type) AS findings, count(*) AS refused FROM k WHERE reason IS NOT NULL GROUP BY doc)
    SELECT d.doc, coalesce(types, '') AS types, coalesce(findings, '') AS findings, coalesce(refused, 0) + CASE WHEN coalesce(a.n, 0) <> d.n THEN 1 ELSE 0 END AS anomalies
    FROM (SELECT doc, count(*) AS n FROM k GROUP BY doc) d LEFT JOIN a ON d.doc = a.doc LEFT JOIN f ON d.doc = f.doc""")
def materialized_types(spark, d):
    """Accepted types in order, distinct findings, and how many anomalies a document has."""
    entries = _entries(spark, d)
    made = routing.materialized_types(entries, catalogue(spark), "projects").join(routing.type_anomalies(entries, catalogue(spark), "projects"), "doc")
    return made.select("doc", F.array_join("types", "|").alias("types"), F.array_join("findings", "|").alias("findings"), "anomalies")


@query("""
    WITH e AS (SELECT p_brand AS p, lower(p_type) AS t, p_name AS source, CASE WHEN p_size < 25 THEN p_type ELSE lower(p_type) || ' :' END AS spelling, count(*) AS n FROM part GROUP BY ALL),
    s AS (SELECT p, t, source, sum(n) AS n FROM e GROUP BY ALL)
    SELECT lower(e.p) AS parent, e.t AS type, (SELECT sum(n) FROM e x WHERE x.p = e.p AND x.t = e.t)::BIGINT AS frequency, count(DISTINCT spelling) AS variants,
           (SELECT string_agg(source || '=' || n::BIGINT, '|' ORDER BY source || '=' || n::BIGINT) FROM s WHERE s.p = e.p AND s.t = e.t) AS sources
    FROM e GROUP BY e.p, e.t""")
def consolidated_types(spark, d):
    """Spellings of one label merged: counts move, their total stays."""
    spelling = F.when(F.col("p_size") < 25, F.col("p_type")).otherwise(F.concat(F.lower("p_type"), F.lit(" :")))
    entries = table(spark, d, "part").groupBy(F.col("p_brand").alias("parent"), spelling.alias("type"), F.col("p_name").alias("source")).agg(F.count(F.lit(1)).alias("frequency"))
    return routing.consolidated(entries).drop("id")


_REVIEWED = [("a", "P", "T1", "works", "X", "inherited", ""), ("b", "P", "T2", "", "", "pending", ""), ("c", "P", "T3", "", "", "pending", ""), ("d", "P", "T4", "", "", "pending", ""), ("e", "P", "T5", "", "", "pending", "")]


@query("SELECT * FROM (VALUES ('a', 'none', NULL::VARCHAR), ('b', 'assignment', NULL), ('c', 'assignment', 'no_reviewer'), ('d', 'assignment', 'unknown_entity'), ('e', 'none', 'changed_label'), ('f', 'row', 'unknown_row')) t(id, change, problem)")
def review_round_trip(spark, d):
    """A sheet that reviewers got and gave back: what they may not do is a problem."""
    original = spark.createDataFrame(_REVIEWED, routing.REVIEW)
    path = f"{ensure_shared_dir(spark)}/review-{uuid.uuid4().hex}"
    routing.export_review(original, f"{path}/out")
    sheet = spark.read.schema(routing.REVIEW).option("header", True).csv(f"{path}/out")
    given = F.col("id").isin("b", "c", "d")
    back = sheet.withColumn("status", F.when(given, "approved").otherwise(F.col("status"))).withColumn("entity", F.when(F.col("id") == "d", "poems").when(given, "works").otherwise(F.col("entity")))
    back = back.withColumn("reviewer", F.when(F.col("id").isin("b", "d"), "eva").otherwise(F.col("reviewer"))).withColumn("type", F.when(F.col("id") == "e", "T9").otherwise(F.col("type")))
    back = back.unionByName(spark.createDataFrame([("f", "P", "T6", "", "", "pending", "")], routing.REVIEW))
    routing.export_review(back, f"{path}/back")
    return routing.import_review(spark, f"{path}/back", original, ["works", "projects", "patents", "events"])


@query("SELECT p_brand, p_type, CASE WHEN count(DISTINCT p_name) = 1 THEN 'resolved' ELSE 'ambiguous' END AS status, CASE WHEN count(DISTINCT p_name) = 1 THEN min(p_name) END AS target FROM part GROUP BY ALL")
def inherited_types(spark, d):
    """Labels that have one target are resolved, others ambiguous."""
    rows = table(spark, d, "part").select(F.concat_ws("|", "p_brand", "p_type").alias("label"), F.lit(1).alias("leaf"), F.col("p_name").alias("target"))
    out = routing.inherit(rows, "label", "leaf", ["target"])
    known = table(spark, d, "part").select("p_brand", "p_type", text.exact_key(F.concat_ws("|", "p_brand", "p_type")).alias("key")).distinct()
    return known.join(out, "key").select("p_brand", "p_type", "status", "target")


@query("""SELECT p_type, CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 'reviewed' WHEN n = 1 THEN 'resolved' ELSE 'ambiguous' END AS status, CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 'mine' WHEN n = 1 THEN t END AS target
    FROM (SELECT p_type, count(DISTINCT p_brand) AS n, min(p_brand) AS t FROM part GROUP BY p_type)""")
def resolved_types(spark, d):
    """A reviewed entry overrides what a label inherits."""
    part = table(spark, d, "part")
    inherited = routing.inherit(part.select("p_type", F.lit(1).alias("leaf"), F.col("p_brand").alias("target")), "p_type", "leaf", ["target"])
    reviewed = part.where("p_type in ('PROMO', 'SMALL')").select(text.exact_key(F.col("p_type")).alias("key"), F.lit("mine").alias("target")).distinct()
    return routing.resolve(inherited, reviewed, ["target"]).select(F.upper("key").alias("p_type"), "status", "target")


@query(f"""WITH {_RECORDS}, n AS (SELECT *, {NORM.format(x="replace(title, 'í', 'i')")} AS t, count(*) OVER (PARTITION BY title, year(o_orderdate)) AS k FROM o WHERE outcome = 'entity' AND entity = 'works')
    SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'article' ELSE 'unknown' END AS type_family, count(*) AS nodes, count(*) AS works FROM n GROUP BY 1""")
def works_graph(spark, d):
    """Personal pages to the components of the works graph: titles that say too little merge nothing."""
    nodes, _ = facade.build_works_graph(_pages(spark, d), "o_custkey", catalogue(spark))
    return nodes.groupBy("type_family").agg(F.count(F.lit(1)).alias("nodes"), F.count_distinct("root").alias("works"))


@query(f"WITH {_RECORDS} SELECT entity, outcome, count(*) AS n FROM o GROUP BY ALL HAVING outcome <> 'out_of_scope'")
def normalised_entities(spark, d):
    """A whole phase: documents and what made none are together all records."""
    made, rest = facade.normalise_entities(_pages(spark, d), "o_custkey", catalogue(spark), F.lit("Owner"))
    out = made.select("entity", F.lit("entity").alias("outcome")).unionByName(rest.select(F.col("target_entity").alias("entity"), "outcome"))
    return out.groupBy("entity", "outcome").agg(F.count(F.lit(1)).alias("n"))
