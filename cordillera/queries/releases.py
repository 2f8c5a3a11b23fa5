"""People, releases and runs: final documents, proofs, what may be published and what may go."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import audits, persons, reconcile
from ..plans import facade, runs
from ..sources import acquisition, pages, publication, records, tables
from ..sources.tables import ensure_shared_dir, table
from ..streaming import incremental
from .cases import cases

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _folder(spark, name: str) -> str:
    return f"{ensure_shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("""
    SELECT c_custkey, '0:' || r_name || ':' || substr(c_custkey::VARCHAR, 1, 1) || '|1:' || n_name || ':' || c_custkey || CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE '|2:' || c_mktsegment || ':' END AS subjects,
           CASE WHEN c_mktsegment <> 'BUILDING' THEN 'open:' || c_mktsegment END AS degree, 'country=' || n_name || CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE ',state=' || c_mktsegment END AS birthplace
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def person_facts_of_rows(spark, d):
    """Subject levels, degree and birthplace of a source row; what says that it says nothing is left out."""
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    said = F.when(F.col("c_mktsegment") == "BUILDING", "No  registra").otherwise(F.col("c_mktsegment"))
    levels = F.transform(persons.subjects(F.col("r_name"), F.col("n_name"), said, F.col("c_custkey").cast("string")), lambda s: F.concat_ws(":", s["level"].cast("string"), s["name"], F.coalesce(s["id"], F.lit(""))))
    one = persons.degree(said, "open")
    place = F.transform(F.map_entries(persons.birthplace(F.col("n_name"), said, F.lit("no disponible"))), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return rows.select("c_custkey", F.array_join(levels, "|").alias("subjects"), F.when(one.isNotNull(), F.concat_ws(":", one["source"], one["degree"])).alias("degree"), F.array_join(F.array_sort(place), ",").alias("birthplace"))


@cases("group_affiliation_cases", "code string, name string, role string, period string", [("col0000001", " Grupo  A ", "Lider", "2001/3 - Actual"), ("X1", "B", "r", "2001/3 - Actual"), ("COL0000002", "C", None, None)], "id string, name string, position string, start_date bigint, end_date bigint", [("COL0000001", "Grupo A", "Lider", 983404800, -1), (None, None, None, None, None), ("COL0000002", "C", None, -1, -1)])
def _affiliation(df):
    a = persons.group_affiliation(*[F.col(c) for c in ("code", "name", "role", "period")])
    return [a[f] for f in ("id", "name", "position", "start_date", "end_date")]


_PASSES = """
    u AS (SELECT o_custkey AS code, 0 AS pass, o_orderkey AS place, o_orderpriority AS tag, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS name FROM orders
          UNION ALL SELECT s_suppkey, 1, s_suppkey, s_name, 'supplier' FROM supplier)"""


@query(f"""WITH {_PASSES}, t AS (SELECT code, tag, min((pass, place)) AS o FROM u GROUP BY ALL)
    SELECT c_custkey AS code, coalesce((SELECT string_agg(tag, '|' ORDER BY o) FROM t WHERE t.code = c_custkey), '') AS tags, (SELECT arg_max(name, (pass, place)) FROM u WHERE u.code = c_custkey AND name <> '') AS name FROM customer""")
def ordered_enrichment(spark, d):
    """Two passes of updates in one grouping: tags are added in order, the last name that is not blank stays."""
    one = table(spark, d, "orders").select(F.col("o_custkey").alias("code"), F.col("o_orderkey").alias("place"), F.array("o_orderpriority").alias("tags"), F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")).alias("name"))
    two = table(spark, d, "supplier").select(F.col("s_suppkey").alias("code"), F.col("s_suppkey").alias("place"), F.array("s_name").alias("tags"), F.lit("supplier").alias("name"))
    whole, _ = persons.enriched(table(spark, d, "customer").select(F.col("c_custkey").alias("code")), [one, two], ["tags"], ["name"])
    return whole.select("code", F.array_join("tags", "|").alias("tags"), "name")


@query("SELECT 0 AS pass, count(*) AS unknown FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') HAVING count(*) > 0")
def unknown_updates(spark, d):
    """Updates that name nobody known, by pass."""
    one = table(spark, d, "orders").select(F.col("o_custkey").alias("code"), F.col("o_orderkey").alias("place"), F.array("o_orderpriority").alias("tags"), F.lit("x").alias("name"))
    known = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("code"))
    return persons.enriched(known, [one], ["tags"], ["name"])[1]


@query("SELECT c_custkey AS code, '' AS full_name, 0 AS aliases FROM customer UNION SELECT s_suppkey, '', 0 FROM supplier")
def seeded_people(spark, d):
    codes = table(spark, d, "customer").select(F.col("c_custkey").alias("code")).unionByName(table(spark, d, "supplier").select(F.col("s_suppkey").alias("code")))
    return persons.seeded(codes).select("code", "full_name", F.size("aliases").alias("aliases"))


@query("""SELECT * FROM (VALUES ('1', 'Ana Paz', 'A Paz', 'x=5,y=2', 'https://doi.org/10.1234/a|https://doi.org/10.1234/b'), ('2', 'Luis Gil', '', '', ''), ('3', '', '', 'z=0', '')) t(code, full_name, aliases, updated, related_works)""")
def normal_people(spark, d):
    """Names, aliases, times and DOIs in their final form."""
    rows = [
        ("1", "ANA PAZ", ["ana  paz", "A. Paz", "a paz"], [("x", 3), ("y", 2), ("x", 5)], [("doi", "10.1234/b"), ("doi", "https://doi.org/10.1234/A"), ("other", "10.1234/c"), ("doi", "bad")]),
        ("2", "", ["Luis Gil", "LUIS  GIL"], [], []), ("3", None, [], [("z", None)], []),
    ]
    df = spark.createDataFrame(rows, "code string, full_name string, aliases array<string>, updated array<struct<source: string, time: long>>, related array<struct<source: string, id: string>>")
    out = persons.normal_person(df)
    return out.select("code", "full_name", F.array_join("aliases", "|").alias("aliases"), F.array_join(F.transform("updated", lambda u: F.concat_ws("=", u["source"], u["time"].cast("string"))), ",").alias("updated"), F.array_join("related_works", "|").alias("related_works"))


@query("SELECT count(*) AS codes, bit_xor(('0x' || substr(sha256(c_custkey::VARCHAR), 1, 15))::BIGINT) AS digest FROM customer")
def frozen_manifest(spark, d):
    """What a frozen list of codes must give again, which it does."""
    codes = table(spark, d, "customer").select(F.col("c_custkey").alias("code"))
    stored = persons.manifest(codes)
    if not persons.proved(codes.unionByName(codes), stored):
        raise ValueError("the manifest has changed")
    return stored


@query("""
    SELECT 'malformed_code' AS "check", count(*) FILTER (c_custkey >= 100) AS n FROM customer UNION ALL SELECT 'repeated_code', 0 UNION ALL SELECT 'unknown_code', count(*) FROM customer WHERE c_mktsegment = 'MACHINERY'
    UNION ALL SELECT 'missing_person', 0 UNION ALL SELECT 'nameless', 0 UNION ALL SELECT 'unexpected_field', 1""")
def person_audit(spark, d):
    rows = table(spark, d, "customer").select(F.when(F.col("c_custkey") < 100, F.lpad(F.col("c_custkey").cast("string"), 10, "0")).otherwise(F.col("c_custkey").cast("string")).alias("code"), F.col("c_name").alias("full_name"), "c_mktsegment")
    return persons.person_audit(rows, rows.where("c_mktsegment <> 'MACHINERY'"), ["code", "full_name"])


@query("""
    WITH m AS (SELECT l_partkey AS m, count(DISTINCT l_suppkey) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
    SELECT 'member_in_several' AS "check", (SELECT count(*) FROM m WHERE n > 1) AS n UNION ALL SELECT 'member_in_none', (SELECT count(*) FROM part WHERE p_partkey NOT IN (SELECT m FROM m))
    UNION ALL SELECT 'member_unknown', (SELECT count(*) FROM m WHERE m NOT IN (SELECT p_partkey FROM part)) UNION ALL SELECT 'nameless', 0 UNION ALL SELECT 'repeated_id', 0""")
def affiliation_audit(spark, d):
    """Suppliers as groups with parts as members: one member, one group."""
    groups = table(spark, d, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_suppkey").alias("id")).agg(F.collect_set("l_partkey").alias("members")).withColumn("name", F.lit("g"))
    return persons.affiliation_audit(groups, table(spark, d, "part").select(F.col("p_partkey").alias("code")))


@query("""
    SELECT 'o_orderstatus' AS field, CASE WHEN o_orderstatus = 'P' THEN 'permitted' ELSE 'violation' END AS state, count(*) AS n FROM orders WHERE o_orderstatus IN ('P', 'O') GROUP BY 2
    UNION ALL SELECT 'o_orderpriority', 'violation', count(*) FROM orders WHERE o_orderpriority = '5-LOW' HAVING count(*) > 0""")
def permitted_changes(spark, d):
    """Changes between versions that a migration may make, and those that it may not."""
    old = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", F.current_timestamp().alias("updated"))
    new = old.withColumn("o_orderstatus", F.when(F.col("o_orderstatus") == "F", "F").otherwise("X")).withColumn("o_orderpriority", F.when(F.col("o_orderpriority") == "5-LOW", "6").otherwise(F.col("o_orderpriority")))
    old, new = (persons.volatile_free(x, ["updated"]) for x in (old, new))
    return persons.permitted(old, new, "o_orderkey", {"o_orderstatus": (F.col("old") == "P") & (F.col("new") == "X")})


@query("SELECT 'nation' AS source, count(*) AS rows, bit_xor(('0x' || substr(sha256(n_name || '|' || n_nationkey), 1, 15))::BIGINT) AS digest FROM nation UNION ALL SELECT 'region', count(*), bit_xor(('0x' || substr(sha256(r_name || '|' || r_regionkey), 1, 15))::BIGINT) FROM region")
def source_proofs(spark, d):
    """What sources must give again after a build."""
    return persons.source_proof({"nation": table(spark, d, "nation"), "region": table(spark, d, "region")}, {"nation": ["n_nationkey", "n_name"], "region": ["r_regionkey", "r_name"]})


@query("SELECT * FROM (VALUES ('nation', 'ready'), ('region', 'changed'), ('none', 'missing')) t(source, state)")
def build_preconditions(spark, d):
    found = persons.source_proof({"nation": table(spark, d, "nation"), "region": table(spark, d, "region")}, {"nation": ["n_nationkey"], "region": ["r_regionkey"]})
    return persons.preconditions(found, {"nation": table(spark, d, "nation").count(), "region": 99, "none": 1})


@query("""
    SELECT 'works' AS entity, 'missing_id' AS "check", count(*) FILTER (p_size = 1) AS n FROM part UNION ALL SELECT 'works', 'repeated_id', (SELECT count(*) FROM (SELECT p_brand FROM part GROUP BY 1 HAVING count(*) FILTER (p_size <> 1) > 1)) + (SELECT CASE WHEN count(*) FILTER (p_size = 1) > 1 THEN 1 ELSE 0 END FROM part)
    UNION ALL SELECT 'works', 'unexpected_field', 1 UNION ALL SELECT 'works', 'empty', 0 UNION ALL SELECT 'events', 'missing_id', 0 UNION ALL SELECT 'events', 'repeated_id', 0 UNION ALL SELECT 'events', 'unexpected_field', 0 UNION ALL SELECT 'events', 'empty', 1""")
def release_gate(spark, d):
    """Structural checks of a release's entities: it may stand if none counts anything."""
    part = table(spark, d, "part").select(F.when(F.col("p_size") != 1, F.col("p_brand")).alias("id"), "p_name", F.lit(1).alias("raw"))
    checks = publication.structure_checks("works", part, ["raw"]) | publication.structure_checks("events", table(spark, d, "events").limit(0).select(F.col("event_id").alias("id")), ["raw"])
    return publication.release_audit(checks)


@query("SELECT * FROM (VALUES ('works', 'r1', 'passed'), ('events', 'r1', 'failed'), ('people', 'r1', 'incomplete'), ('groups', 'r1', 'missing')) t(entity, run, proof)")
def release_proofs(spark, d):
    audited = spark.createDataFrame([("works", "r1", "complete", 0), ("events", "r1", "complete", 2), ("events", "r1", "complete", 0), ("people", "r1", "building", 0)], "entity string, run string, status string, critical long")
    return publication.proofs(audited, spark.createDataFrame([(e, "r1") for e in ("works", "events", "people", "groups")], "entity string, run string"))


@query("SELECT c_name AS name, CASE WHEN c_mktsegment = 'BUILDING' THEN 'refused' WHEN c_acctbal >= 0 THEN 'drop' ELSE 'absent' END AS action FROM customer")
def release_cleanup(spark, d):
    """Named intermediates go if they are there and nothing protects them."""
    people = table(spark, d, "customer")
    name = F.col("c_name").alias("name")
    return publication.cleanup_plan(people.select(name), people.where("c_mktsegment = 'BUILDING'").select(name), people.where("c_acctbal >= 0").select(name))


@query("SELECT * FROM (VALUES ('final', 'keep'), ('filtered', 'keep'), ('a', 'drop'), ('b', 'in_use'), ('c', 'unknown')) t(name, action)")
def output_plan_cases(spark, d):
    """Exactly two outputs stay; unknown ones and ones that something reads stop the clean-up."""
    names = lambda *x: spark.createDataFrame([(n,) for n in x], "name string")
    reads = spark.createDataFrame([("final", "a"), ("report", "b")], "source string, target string")
    return publication.output_plan(names("final", "filtered", "a", "b", "c"), ["final", "filtered"], names("a", "b"), reads)


@query("SELECT * FROM (VALUES ('works', 'release'), ('nodes', 'release'), ('other', NULL::VARCHAR)) t(name, owner)")
def release_owners(spark, d):
    """A release owns what its proofs reach."""
    references = spark.createDataFrame([("release", "works"), ("works", "nodes"), ("x", "other")], "source string, target string")
    return publication.owned(spark, "release", references, spark.createDataFrame([("works",), ("nodes",), ("other",)], "name string"))


@query("SELECT o_custkey AS k, count(*) AS n, '[' || string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) || ']' AS orders FROM orders GROUP BY 1")
def json_array_round_trip(spark, d):
    """One file that is an array of all rows, read back strictly."""
    rows = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.to_json(F.sort_array(F.collect_list("o_orderkey"))).alias("orders"))
    path = f"{_folder(spark, 'array')}/people.json"
    publication.write_json_array(rows, path)
    return tables.json_array(spark, path, "k long, n long, orders string")


@query("SELECT 'people' AS sheet, count(*) AS rows, count(*) AS expected, 0::BIGINT AS differ FROM customer UNION ALL SELECT 'groups', count(*), count(*) + 1, 1 FROM supplier")
def sheet_round_trip(spark, d):
    """A workbook written, read back and proved; a row that was expected and is not there is told."""
    people, groups = table(spark, d, "customer").select("c_custkey", "c_name"), table(spark, d, "supplier").select("s_suppkey", "s_name")
    folder = _folder(spark, "sheets")
    publication.write_sheets({"people": people, "groups": groups}, folder)
    more = groups.unionByName(spark.createDataFrame([(-1, 'a "b", c')], groups.schema))
    return publication.sheet_audit(spark, folder, {"people": (people, "c_custkey"), "groups": (more, "s_suppkey")})


@query("SELECT c_custkey AS k, 'left' AS only_in FROM customer WHERE c_mktsegment = 'BUILDING' UNION ALL SELECT -1, 'right'")
def copy_proof(spark, d):
    """A copy that lacks rows and has one that nobody wrote."""
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), "c_mktsegment")
    copy = rows.where("c_mktsegment <> 'BUILDING'").unionByName(spark.createDataFrame([(-1, "x")], rows.schema))
    return audits.same_rows(rows, copy, "k")


@query("SELECT page_id, CASE WHEN length(url) % 2 = 0 THEN sha256(html) ELSE repeat('a', 64) END AS digest FROM pages")
def trusted_hashes(spark, d):
    """A stored hash that looks like one is trusted, anything else is computed."""
    stored = F.when(F.length("url") % 2 == 0, "no hash").otherwise(F.repeat(F.lit("a"), 64))
    return table(spark, d, "pages").select("page_id", pages.content_hash(F.col("html"), stored).alias("digest"))


@query("""SELECT id, text, replaced FROM (VALUES (0, 'ñandú', 0), (1, 'ñandú', 0), (2, 'a' || chr(65533), 1)) t(id, text, replaced)""")
def decoded_pages(spark, d):
    """Pages by their declared charset, with what could not be decoded counted."""
    rows = [(0, '<meta charset="utf-8">ñandú'.encode()), (1, "<meta charset=ISO-8859-1>ñandú".encode("latin-1")), (2, b"charset=utf-8>a\xff")]
    df = spark.createDataFrame(rows, "id int, body binary")
    out = pages.decoded(F.col("body"))
    return df.select("id", F.regexp_extract(out["text"], r">(.*)$", 1).alias("text"), out["replaced"].cast("int").alias("replaced"))


@query("""
    WITH f AS (SELECT o_orderkey AS id, list_distinct([CASE WHEN o_orderstatus = 'F' THEN 'fixed' ELSE o_orderstatus END, o_orderpriority, CASE WHEN o_orderstatus = 'F' THEN 'fixed' ELSE o_orderstatus END]) AS v, o_orderstatus, o_orderpriority FROM orders)
    SELECT id, CASE WHEN o_orderstatus = 'F' THEN 'fixed' ELSE o_orderstatus END || '|' || o_orderpriority AS vals FROM f""")
def applied_corrections(spark, d):
    """Confirmed corrections inside arrays, in order and without repeats; contradictory ones change nothing."""
    decided = spark.createDataFrame([("F", "fixed", "confirmed_correction"), ("O", "a", "confirmed_correction"), ("O", "b", "confirmed_correction"), ("P", "x", "review")], "wrong string, correct string, decision string")
    docs = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.array("o_orderstatus", "o_orderpriority", "o_orderstatus").alias("vals"))
    out = reconcile.apply_corrections(docs, "id", "vals", reconcile.corrections(decided))
    return out.select("id", F.array_join("vals", "|").alias("vals"))


@query("SELECT page_id::VARCHAR AS id, length(url) % 2 = 0 AS ok, CASE WHEN length(url) % 2 <> 0 THEN 'ValueError: no page' END AS error FROM pages")
def quarantined_pages(spark, d):
    """Pages that a parser cannot read are set aside and stop no others."""

    def parse(page: str) -> dict:
        if page.startswith("BROKEN"):
            raise ValueError("no page")
        return records.person_page(page, {})

    broken = table(spark, d, "pages").select("page_id", F.when(F.length("url") % 2 == 0, F.lit("<html></html>")).otherwise("BROKEN").alias("html"))
    return records.page_errors(broken, "page_id", "html", parse)


@query("SELECT 'first' AS stage, count(*) AS rows, 1 AS attempts FROM nation UNION ALL SELECT 'second', count(*), 2 FROM region")
def resumed_run(spark, d):
    """A run whose second stage fails once: the first is not done again."""
    folder, tried = _folder(spark, "run"), []

    def second(session, done):
        tried.append(done["first"].count())
        if len(tried) == 1:
            raise ValueError("once")
        return table(session, d, "region")

    run = runs.Run(spark, folder, [("first", lambda session, done: table(session, d, "nation")), ("second", second)], {"first": lambda df: df.count() > 0})
    try:
        run.execute()
    except ValueError:
        run.execute()
    state = runs.Store(spark, folder).read("run")
    return spark.createDataFrame([(k, v["rows"], v["attempts"]) for k, v in sorted(state.items())], "stage string, rows long, attempts int")


@query("SELECT s_suppkey FROM supplier")
def keyset_batches(spark, d):
    """Rows in batches of keys; a crash after the first costs no row and doubles none."""
    rows, folder = table(spark, d, "supplier").select("s_suppkey"), _folder(spark, "keys")
    store = runs.Store(spark, folder)
    size = max(1, rows.count() // 3)
    out, calls = f"{folder}/out", []

    def write(batch):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        batch.write.mode("append").parquet(out)

    try:
        runs.by_keys(rows, "s_suppkey", size, store, "last", write)
    except RuntimeError:
        runs.by_keys(rows, "s_suppkey", size, store, "last", write)
    return spark.read.parquet(out)


@query("SELECT n_nationkey, n_name FROM nation")
def frozen_source(spark, d):
    """A table that another run left, with as many rows as was proved of it, copied where rows are absent."""
    rows = table(spark, d, "nation").select("n_nationkey", "n_name")
    path = f"{_folder(spark, 'frozen')}/nation"
    rows.write.parquet(path)
    held = runs.frozen(spark, path, rows.count())
    return acquisition.inserted(held.where("n_name < 'F'"), held, "n_nationkey")


@query("SELECT DISTINCT o_custkey AS a, o_orderkey AS b FROM orders WHERE o_orderstatus <> 'P'")
def replayed_edges(spark, d):
    """Edges of complete partitions: what a graph is built of again."""
    edges = table(spark, d, "orders").select(F.col("o_custkey").alias("a"), F.col("o_orderkey").alias("b"), F.col("o_orderstatus").alias("stage"))
    return runs.replayed(edges.unionByName(edges), ["F", "O"])


@query("SELECT user_id, max(ts)::VARCHAR AS last, count(*) AS n FROM events GROUP BY 1")
def streamed_load(spark, d):
    """Events loaded as a file stream that stops when done, twice: each file counts once."""
    folder = _folder(spark, "stream")
    events = table(spark, d, "events").select("user_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("t"))
    events.repartition(3).write.parquet(f"{folder}/in")
    for _ in range(2):
        incremental.resumable_load(spark, f"{folder}/in", events.schema, f"{folder}/out", f"{folder}/state").awaitTermination()
    loaded = spark.read.schema(events.schema).parquet(f"{folder}/out")
    return loaded.groupBy("user_id").agg(F.max(F.regexp_replace("t", r"\.?0+$", "")).alias("last"), F.count(F.lit(1)).alias("n"))


@query("""SELECT 'partial' AS name, '{"a":1,"b":{"c":5,"d":3}}' AS config UNION ALL SELECT 'none', '{"a":1,"b":{"c":2,"d":3}}' UNION ALL SELECT 'unknown', 'refused'""")
def merged_configs(spark, d):
    """Settings over defaults, level by level; unknown ones are refused."""
    import json

    defaults, rows = {"a": 1, "b": {"c": 2, "d": 3}}, []
    for name, own in (("partial", {"b": {"c": 5}}), ("none", {}), ("unknown", {"b": {"x": 1}})):
        try:
            rows.append((name, json.dumps(runs.merged(defaults, own), separators=(",", ":"))))
        except KeyError:
            rows.append((name, "refused"))
    return spark.createDataFrame(rows, "name string, config string")


@query("SELECT 'works' AS entity, 'missing_id' AS \"check\", 0::BIGINT AS n, 1 AS version UNION ALL SELECT 'works', 'repeated_id', 0, 1 UNION ALL SELECT 'works', 'unexpected_field', 0, 1 UNION ALL SELECT 'works', 'empty', 0, 1")
def published_release(spark, d):
    """A release that passes is written and pointed at; one that does not leaves the pointer where it is."""
    folder = _folder(spark, "release")
    pointer = publication.Pointer(spark, f"{folder}/current")
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_name")
    audit = facade.publish_release({"works": (parts, ["raw"])}, folder, pointer, {"version": 1, "date": "20240101"}, "2024-01-01")
    facade.publish_release({"works": (parts.unionByName(parts), ["raw"])}, folder, pointer, {"version": 2, "date": "20240102"}, "2024-01-01")
    return audit.withColumn("version", F.lit(pointer.read()["version"]))


@query("SELECT 'eligible' AS part, count(*) AS n FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus <> 'P' UNION ALL SELECT 'refused', count(*) FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'P'")
def selected_works(spark, d):
    """A whole phase: works with a valid ISBN are selected, those without are told."""
    from ..operators.identified import ENTRY

    value = F.when(F.col("o_orderstatus") == "P", "0-306-40615-3").otherwise("0-306-40615-2")
    none = F.lit(None).cast("string")
    entry = F.array(F.struct(F.lit("isbn").alias("source"), value.alias("id"), none.alias("person"), none.alias("product"))).cast(ENTRY)
    works = table(spark, d, "orders").where("o_orderpriority = '2-HIGH'").select(F.col("o_orderkey").alias("id"), none.alias("doi"), entry.alias("external_ids"), F.array().cast("array<string>").alias("product_ids"), F.array(F.lit("Libro")).alias("types"))
    chosen, _, reasons = facade.select_identified(works, spark.createDataFrame([("0000000001",)], "code string"))
    parts = chosen.agg(F.count(F.lit(1)).alias("n")).select(F.lit("eligible").alias("part"), "n")
    return parts.unionByName(reasons.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.lit("refused").alias("part"), "n"))
