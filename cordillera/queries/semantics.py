"""Semantic audits: literal documents, each with the codes of what is wrong with it, and counts over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import semantics
from ..sources.tables import table

QUERIES, ORACLE_SQL = {}, {}
AS_OF = "2024-01-01"
_FIELDS, _PARTS = list(semantics.DOCUMENT_FIELDS), list(semantics.OCCURRENCE_FIELDS)


def _occurrence(**own) -> tuple:
    given = {"id": "o1", "source_kind": "person", "source_id": "0000000001", "route_rule": "rule"} | own
    return tuple(given.get(f) for f in _PARTS)


def _document(**own) -> tuple:
    return tuple(own.get(f) for f in _FIELDS)


def register(entity: str, good: dict, rows: dict[str, tuple[dict, str]]):
    """Documents of one entity: what each has other than the good one, and its codes."""
    name = f"{entity}_audit_cases"

    def run(spark, d):
        documents = [_document(**good, id="good")] + [_document(**(good | own | {"id": k})) for k, (own, _) in rows.items()]
        df = spark.createDataFrame(documents, semantics.DOCUMENT)
        return semantics.prepared(df, AS_OF).select("id", F.array_join(semantics.codes(entity), ",").alias("codes"))

    run.__name__, run.__doc__ = name, f"Codes of {entity} that are good but for one thing."
    QUERIES[name] = run
    wanted = [("good", ""), *((k, codes) for k, (_, codes) in rows.items())]
    ORACLE_SQL[name] = "SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in wanted) + ") t(id, codes)"


_PERSON = ("0000000001", "Ana Paz", "author")
_PROJECT = {
    "titles": ["Soil study"], "types": ["project"], "identity_key": "project|x", "target_entity": "projects", "version": "1", "author_conflicts": 0, "authors": [_PERSON], "author_count": 1, "groups": ["COL0000001"],
    "abstract": "About soil", "date_init": "2001-02", "year_init": 2001, "date_end": "2003", "year_end": 2003, "occurrences": [_occurrence(project_type="research", start_date="2001-02-03", end_date="2003")],
}


def _with(**own) -> dict:
    return {"occurrences": [_occurrence(**({"project_type": "research", "start_date": "2001-02-03", "end_date": "2003"} | own))]}


register("projects", _PROJECT, {
    "no_title": ({"titles": [" "]}, "missing_title"),
    "two_titles": ({"titles": ["Soil study", "soil  STUDY", "Other"]}, "divergent_titles"),
    "no_types": ({"types": []}, "missing_types"),
    "no_key": ({"identity_key": None}, "missing_identity_key"),
    "bad_key": ({"identity_key": "event|x"}, "invalid_identity_key"),
    "source_key": ({"identity_key": "source|projects|x"}, "source_scoped_identity"),
    "entity": ({"target_entity": "works"}, "wrong_target_entity"),
    "conflicts": ({"author_conflicts": 2}, "author_identity_conflicts"),
    "count": ({"author_count": 3}, "author_count_mismatch"),
    "no_author": ({"authors": [], "author_count": 0}, "missing_author"),
    "twice": ({"authors": [_PERSON, _PERSON], "author_count": 2}, "duplicate_authors"),
    "no_code": ({"authors": [(None, "Ana Paz", "author")]}, "authors_without_code"),
    "no_group": ({"groups": None}, "missing_group"),
    "no_abstract": ({"abstract": ""} | _with(summary="s"), "abstract_missing_despite_source_summary,missing_abstract"),
    "no_occurrence": ({"occurrences": []}, "missing_occurrences"),
    "same_ids": ({"occurrences": _PROJECT["occurrences"] * 2}, "duplicate_occurrence_ids"),
    "source": (_with(source_kind="", source_id=None), "occurrence_missing_source_id,occurrence_missing_source_kind"),
    "no_kind": (_with(project_type=" "), "occurrence_missing_project_type"),
    "bad_start": (_with(start_date="foo"), "invalid_start_date_occurrence"),
    "bad_end": (_with(end_date="2003-15"), "invalid_end_date_occurrence"),
    "backwards": (_with(end_date="2000") | {"date_end": "2000", "year_end": 2000}, "source_end_before_start"),
    "top_year": ({"year_init": 1999}, "top_start_year_mismatch"),
    "no_top_year": ({"year_end": None}, "missing_top_end_year"),
    "precision": ({"date_init": "2001-05"}, "top_start_loses_precision"),
    "open": (_with(end_date="Actual"), "top_end_present_for_open_project"),
    "two": ({"occurrences": [_occurrence(project_type="a", summary="x", start_date="2001-02-03", end_date="2003"), _occurrence(id="o2", project_type="b", summary="y", start_date="2001-03", end_date="vigente")]},
            "conflicting_project_types,conflicting_start_dates,mixed_open_and_closed_end_dates,multiple_source_summaries"),
    "two_ends": ({"occurrences": [_occurrence(project_type="a", start_date="2001", end_date="2003"), _occurrence(id="o2", project_type="a", start_date="2001", end_date="2004")]}, "conflicting_end_dates"),
})

_WORK = {
    "titles": ["Graphs"], "types": ["thesis"], "target_types": ["Tesis de Posgrado"], "identity_key": "thesis|x", "target_entity": "works", "family": "graduate_thesis", "version": "1", "author_conflicts": 0, "role_resolutions": 0,
    "authors": [_PERSON, ("0000000002", "Luis Gil", "advisor")], "author_count": 2, "date_init": "2001", "year_init": 2001, "occurrences": [_occurrence()],
}
register("works", _WORK, {
    "work": ({"family": "work", "identity_key": "source|works|x", "target_types": []}, ""),
    "work_key": ({"family": "work"}, "invalid_identity_key"),
    "family": ({"family": "poem", "target_types": []}, "wrong_family"),
    "odd_types": ({"family": "poem"}, "unexpected_target_thesis_type,wrong_family"),
    "thesis_key": ({"identity_key": "work|x"}, "invalid_thesis_identity"),
    "source_key": ({"identity_key": "source|works|x"}, "source_scoped_identity"),
    "year": ({"year_init": 1700, "date_init": None}, "invalid_year_published"),
    "date": ({"date_init": "2002"}, "date_published_year_mismatch"),
    "no_student": ({"authors": [("0000000002", "Luis Gil", "advisor")], "author_count": 1}, "missing_student"),
    "no_advisor": ({"authors": [_PERSON], "author_count": 1}, "missing_advisor"),
    "both": ({"authors": [_PERSON, ("0000000003", "ANA  PAZ", "advisor")]}, "probable_duplicate_author_names,student_also_advisor"),
    "removed": ({"role_resolutions": 1}, "advisor_removed_exact_student_match"),
    "kind": ({"target_types": ["Libro"]}, "missing_target_thesis_type"),
    "rule": ({"occurrences": [_occurrence(route_rule="")]}, "occurrence_missing_route_rule"),
    "version": ({"version": None}, "invalid_normalizer_version"),
    "nobody": ({"authors": None, "author_count": 0}, "missing_advisor,missing_authors,missing_student"),
})

_PATENT = {
    "titles": ["Pump"], "types": ["patent"], "identity_key": "ip|patent|registration|nc1", "target_entity": "patents", "family": "patent", "version": "1", "author_conflicts": 0, "authors": [_PERSON], "author_count": 1,
    "occurrences": [_occurrence(namespace="patent", registration_number="NC-1", country="Colombia", holder="Acme", presentation_date="2001-02-03")],
}


def _claims(*own: dict) -> dict:
    base = {"namespace": "patent", "registration_number": "NC-1", "country": "Colombia", "holder": "Acme", "presentation_date": "2001-02-03"}
    return {"occurrences": [_occurrence(**(base | {"id": f"o{k}"} | x)) for k, x in enumerate(own)]}


register("patents", _PATENT, {
    "family": ({"family": "work"}, "wrong_family"),
    "key": ({"identity_key": "patent|x"}, "invalid_ip_identity"),
    "source": ({"identity_key": "ip|patent|source|x"}, "source_scoped_identity"),
    "space": (_claims({"namespace": None}), "missing_ip_namespace"),
    "spaces": (_claims({}, {"namespace": "trademark"}), "identity_namespace_mismatch,mixed_ip_namespaces"),
    "number": (_claims({"registration_number": None}), "missing_registration_number,registration_identity_without_registration"),
    "numbers": (_claims({}, {"registration_number": "NC-2"}), "conflicting_registration_numbers"),
    "same_number": (_claims({}, {"registration_number": "nc 1"}), ""),
    "country": (_claims({}, {"country": "Chile"}), "conflicting_countries"),
    "holder": (_claims({"holder": ""}), "missing_ip_rights_holder"),
    "presented": (_claims({"presentation_date": ""}), "missing_patent_presentation_date"),
    "date": (_claims({"presentation_date": "foo"}), "invalid_presentation_date"),
})

_EVENT = {
    "titles": ["Meeting"], "types": ["Congreso"], "identity_key": "event|x", "target_entity": "events", "family": "event", "version": "1", "author_conflicts": 0, "authors": [_PERSON], "author_count": 1, "date_init": "2001-02-03", "year_init": 2001,
    "occurrences": [_occurrence(event_type="congreso", scope="Nacional", start_date="2001-02-03", end_date="2001-02-04")],
}


def _held(*own: dict) -> dict:
    base = {"event_type": "congreso", "scope": "Nacional", "start_date": "2001-02-03", "end_date": "2001-02-04"}
    return {"occurrences": [_occurrence(**(base | {"id": f"o{k}"} | x)) for k, x in enumerate(own)]}


register("events", _EVENT, {
    "family": ({"family": "work"}, "wrong_family"),
    "key": ({"identity_key": "x"}, "invalid_event_identity"),
    "source": ({"identity_key": "source|events|x"}, "source_scoped_identity"),
    "start": (_held({"start_date": "foo"}), "invalid_event_start_date"),
    "no_start": (_held({"start_date": None}), "missing_event_start_date"),
    "end": (_held({"end_date": "foo"}), "invalid_event_end_date"),
    "backwards": (_held({"end_date": "2001-02-01"}), "event_end_before_start"),
    "kinds": (_held({}, {"event_type": "taller"}), "conflicting_event_types,top_event_type_mismatch"),
    "scopes": (_held({}, {"scope": "Internacional"}), "conflicting_event_scopes"),
    "starts": (_held({}, {"start_date": "2001-03", "end_date": "2001-03-05"}), "conflicting_event_start_dates"),
    "no_date": ({"date_init": None}, "missing_top_event_date"),
    "date": ({"date_init": "2001-05"}, "top_event_date_mismatch"),
    "year": ({"year_init": 2002}, "top_event_year_mismatch"),
    "noted": (_held({"findings": ["source_invalid_event_scope"]}), "source_invalid_event_scope"),
})


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query("""SELECT * FROM (VALUES ('good', ''), ('placeholder', 'unusable_title'), ('spaces', 'unclean_title'), ('stamp', 'inconsistent_actual_date'), ('year', 'date_consensus_not_applied,inconsistent_actual_date,invalid_year'), ('consensus', 'date_consensus_not_applied')) t(id, codes)""")
def quality_gate_cases(spark, d):
    """Publication checks of projects."""
    own = {"placeholder": {"titles": ["Sin título"]}, "spaces": {"titles": ["Soil  study"]}, "stamp": {"date_init": "2002"}, "year": {"year_init": 1700}, "consensus": _with(end_date="2004")}
    rows = [_document(**_PROJECT, id="good")] + [_document(**(_PROJECT | x | {"id": k})) for k, x in own.items()]
    df = spark.createDataFrame(rows, semantics.DOCUMENT)
    return semantics.prepared(df, AS_OF).select("id", F.array_join(semantics.quality_codes(F.lit("projects"), AS_OF), ",").alias("codes"))


_AUDITED = """
    p AS (SELECT o_orderkey::VARCHAR AS id, o_orderstatus AS s, o_orderpriority AS p, year(o_orderdate) AS y, o_orderdate AS d FROM orders),
    f AS (SELECT id, unnest([CASE WHEN p = '1-URGENT' THEN 'missing_title' END, CASE WHEN p = '2-HIGH' THEN 'missing_abstract' END, CASE WHEN s = 'F' THEN 'top_start_year_mismatch' END, CASE WHEN s = 'P' THEN 'missing_top_start_year' END]) AS code FROM p)"""


def _projects(spark, d):
    rows = table(spark, d, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    values = {
        "id": F.col("o_orderkey").cast("string"), "titles": F.array(F.when(F.col("o_orderpriority") == "1-URGENT", "").otherwise(F.lit("Soil"))), "types": F.array(F.lit("project")), "identity_key": F.lit("project|x"), "target_entity": F.lit("projects"),
        "version": F.lit("1"), "author_conflicts": F.lit(0), "authors": F.array(F.struct(F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("id"), F.lit("Ana").alias("full_name"), F.lit("author").alias("type"))), "author_count": F.lit(1),
        "groups": F.array(F.lit("g")), "abstract": F.when(F.col("o_orderpriority") != "2-HIGH", "About"), "date_init": F.when(F.col("o_orderstatus") != "P", day), "year_init": F.when(F.col("o_orderstatus") == "O", F.year("o_orderdate")).when(F.col("o_orderstatus") == "F", F.year("o_orderdate") - 1),
    }
    parts = {"id": F.lit("o"), "source_kind": F.lit("person"), "source_id": F.lit("1"), "route_rule": F.lit("r"), "project_type": F.lit("t"), "start_date": day}
    values["occurrences"] = F.array(F.struct(*[parts.get(k, F.lit(None)).cast(t).alias(k) for k, t in semantics.OCCURRENCE_FIELDS.items()]))
    return rows.select(*[values.get(k, F.lit(None)).cast(t).alias(k) for k, t in semantics.DOCUMENT_FIELDS.items()])


@query(f"""WITH {_AUDITED}, r AS (SELECT code, id, row_number() OVER (PARTITION BY code ORDER BY id) AS k FROM f WHERE code IS NOT NULL)
    SELECT code, CASE code WHEN 'missing_title' THEN 'critical' WHEN 'missing_abstract' THEN 'info' ELSE 'warning' END AS severity, count(*) AS n, string_agg(id, ',' ORDER BY id) FILTER (k <= 3) AS examples FROM r GROUP BY code""")
def project_audit(spark, d):
    """Orders as projects: counts of codes, their severity, and the least examples."""
    return semantics.summary(semantics.audit(_projects(spark, d), "projects", AS_OF))


@query("""
    WITH b AS (SELECT p_partkey AS id, p_size % 3 AS k, p_brand AS pub, p_name AS book FROM part),
    f AS (SELECT *, CASE WHEN id % 7 = 0 THEN NULL ELSE pub END AS src, CASE k WHEN 0 THEN 'consistent' WHEN 1 THEN 'conflict' ELSE 'missing' END AS st FROM b)
    SELECT "check", n FROM (
        SELECT count(*) FILTER (k = 0 AND src IS NULL) AS consistent_publisher_without_source, 0::BIGINT AS publisher_value_mismatch, count(*) FILTER (k = 0 AND id % 5 = 0) AS book_title_source_mismatch,
               count(*) FILTER (k = 1) AS conflict_consolidated_as_publisher, 0::BIGINT AS suspicious_publisher, count(*) FILTER (k = 2) AS suspicious_volume, count(*) FILTER (k = 1) AS invalid_pages,
               0::BIGINT AS publisher_loss, 0::BIGINT AS book_title_loss, 0::BIGINT AS final_count_mismatch FROM f)
    UNPIVOT (n FOR "check" IN (consistent_publisher_without_source, publisher_value_mismatch, book_title_source_mismatch, conflict_consolidated_as_publisher, suspicious_publisher, suspicious_volume, invalid_pages, publisher_loss, book_title_loss, final_count_mismatch))""")
def enrichment_audit(spark, d):
    """Parts as works: what the final collection lacks of its base, or says without a source."""
    k, i = F.col("p_size") % 3, F.col("p_partkey")
    state = F.when(k == 0, "consistent").when(k == 1, "conflict").otherwise("missing")
    base = table(spark, d, "part").select(
        i.alias("id"), F.col("p_brand").alias("publisher"), state.alias("publisher_state"), F.col("p_name").alias("book_title"), state.alias("book_title_state"), F.when(i % 5 == 0, "other").otherwise(F.col("p_name")).alias("source_name"),
        F.when(i % 7 != 0, F.col("p_brand")).alias("source_publisher"), F.when(k == 2, "ISSN 12").otherwise("3").alias("volume"), F.when(k == 1, "x").otherwise("1-2").alias("pages"),
    )
    return semantics.enrichment_audit(base, base)
