"""Semantic audits of entity documents: rules over a document and its occurrences, each a code with a severity.

A rule is an expression; a document's findings are the codes of the rules that it breaks,
so one pass over the documents counts them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import dates, text
from . import routing

#: What blocks a publication; other codes are warnings, or only information.
CRITICAL = frozenset({
    "missing_title", "divergent_titles", "missing_identity_key", "invalid_identity_key", "wrong_target_entity", "wrong_family", "missing_occurrences", "duplicate_occurrence_ids",
    "author_count_mismatch", "duplicate_authors", "occurrence_missing_source_kind", "occurrence_missing_source_id", "occurrence_missing_route_rule", "invalid_normalizer_version",
    "invalid_thesis_identity", "student_also_advisor", "missing_target_thesis_type", "unexpected_target_thesis_type", "invalid_ip_identity", "missing_ip_namespace", "mixed_ip_namespaces",
    "registration_identity_without_registration", "conflicting_registration_numbers", "identity_namespace_mismatch", "invalid_event_identity", "conflicting_event_types",
    "conflicting_event_start_dates", "top_event_date_mismatch", "top_event_year_mismatch",
})
INFORMATION = frozenset({"missing_abstract", "missing_group", "multiple_source_summaries", "mixed_open_and_closed_end_dates"})

PEOPLE = "array<struct<id: string, full_name: string, type: string>>"
OCCURRENCE_FIELDS = {f: "string" for f in (
    "id", "source_kind", "source_id", "route_rule", "namespace", "project_type", "summary", "event_type", "scope", "start_date", "end_date", "registration_number", "country", "holder", "presentation_date",
)} | {"findings": "array<string>"}
OCCURRENCE = "struct<" + ", ".join(f"{k}: {v}" for k, v in OCCURRENCE_FIELDS.items()) + ">"
DOCUMENT_FIELDS = {
    "id": "string", "titles": "array<string>", "types": "array<string>", "target_types": "array<string>", "identity_key": "string", "target_entity": "string", "family": "string", "version": "string",
    "author_conflicts": "int", "role_resolutions": "int", "authors": PEOPLE, "author_count": "int", "groups": "array<string>", "abstract": "string", "date_init": "string", "year_init": "int", "date_end": "string",
    "year_end": "int", "occurrences": f"array<{OCCURRENCE}>",
}
DOCUMENT = ", ".join(f"{k} {v}" for k, v in DOCUMENT_FIELDS.items())

c = F.col


def severity(code: Column) -> Column:
    return F.when(code.isin(*sorted(CRITICAL)), "critical").when(code.isin(*sorted(INFORMATION)), "info").otherwise("warning")


def _blank(x: Column) -> Column:
    return F.trim(F.coalesce(x, F.lit(""))) == ""


def _distinct(values: Column) -> Column:
    return F.array_distinct(F.filter(values, lambda v: v.isNotNull() & (v != "")))


def _all(f) -> Column:
    return F.transform(F.coalesce(c("occurrences"), F.array().cast(f"array<{OCCURRENCE}>")), f)


def _any(f) -> Column:
    return F.coalesce(F.exists("occurrences", f), F.lit(False))


#: Parsed dates of a document and of its occurrences, made once for all rules.
_PARSED = {"__starts": "start_date", "__ends": "end_date", "__presented": "presentation_date"}


def prepared(documents: DataFrame, as_of: str) -> DataFrame:
    """Documents with their dates parsed; what the rules look at."""
    lists = {name: _dates_of(field, as_of) for name, field in _PARSED.items()}
    tops = {"__top_start": dates.partial_or_open(c("date_init"), as_of), "__top_end": dates.partial_or_open(c("date_end"), as_of)}
    return documents.withColumns(lists | tops)


def _dates_of(field: str, as_of: str) -> Column:
    return _all(lambda o: dates.partial_or_open(o[field], as_of))


def _conflict(values: Column) -> Column:
    """Two valid partial dates of a list contradict each other."""
    return F.exists(values, lambda a: F.exists(values, lambda b: ~dates.dates_compatible(a, b)))


def _valid(parsed: str) -> Column:
    return F.filter(c(parsed), lambda d: d["status"] == "valid")


def _has(parsed: str, status: str) -> Column:
    return F.exists(parsed, lambda d: d["status"] == status)


def _backwards() -> Column:
    """An occurrence surely ends before it starts."""
    both = F.zip_with("__starts", "__ends", lambda s, e: (s["status"] == "valid") & (e["status"] == "valid") & dates.definitely_before(e, s))
    return F.exists(both, lambda b: F.coalesce(b, F.lit(False)))


def base_rules(entity: str) -> dict[str, Column]:
    """What every entity must keep: titles, identity, authors, and where it comes from."""
    titles = F.filter(F.coalesce("titles", F.array().cast("array<string>")), lambda t: ~_blank(t))
    people = F.coalesce("authors", F.array().cast(PEOPLE))
    keys = F.transform(people, lambda a: F.concat_ws("|", F.coalesce(a["id"], F.lit("")), text.exact_key(a["full_name"]), F.coalesce(a["type"], F.lit("")) if entity != "projects" else F.lit("")))
    names = F.filter(F.transform(people, lambda a: text.ascii_key(a["full_name"])), lambda n: n != "")
    ids = _all(lambda o: F.coalesce(o["id"], F.lit("")))
    source = c("identity_key").startswith(f"source|{entity}|")
    rules = {
        "missing_title": F.size(titles) == 0,
        "divergent_titles": F.size(F.array_distinct(F.transform(titles, text.exact_key))) > 1,
        "missing_types": F.size(F.coalesce("types", F.array().cast("array<string>"))) == 0,
        "missing_identity_key": _blank(c("identity_key")),
        "wrong_target_entity": ~c("target_entity").eqNullSafe(entity),
        "author_identity_conflicts": c("author_conflicts") > 0,
        "author_count_mismatch": F.coalesce("author_count", F.lit(0)) != F.size(people),
        "duplicate_authors": F.size(keys) != F.size(F.array_distinct(keys)),
        "missing_occurrences": F.size(ids) == 0,
        "duplicate_occurrence_ids": F.size(ids) != F.size(F.array_distinct(ids)),
        "occurrence_missing_source_kind": _any(lambda o: _blank(o["source_kind"])),
        "occurrence_missing_source_id": _any(lambda o: _blank(o["source_id"])),
    }
    if entity == "projects":
        return rules | {"missing_author": F.size(people) == 0, "source_scoped_identity": source}
    return rules | {
        "missing_authors": F.size(people) == 0, "probable_duplicate_author_names": F.size(names) != F.size(F.array_distinct(names)), "occurrence_missing_route_rule": _any(lambda o: _blank(o["route_rule"])),
        "invalid_normalizer_version": _blank(c("version")),
    }


def project_rules() -> dict[str, Column]:
    """Projects: identity, people, and dates that the occurrences bear out; planned ends are no evidence."""
    starts, ends = _valid("__starts"), _valid("__ends")
    opened = _has("__ends", "open")
    years = lambda d: F.transform(d, lambda x: x["year"])
    precise = lambda d: F.filter(d, lambda x: x["month"].isNotNull())
    agrees = lambda top, d: F.exists(precise(d), lambda x: dates.dates_compatible(top, x))
    types = _distinct(_all(lambda o: text.exact_key(F.coalesce(o["project_type"], F.lit("")))))
    summaries = _distinct(_all(lambda o: text.exact_key(F.coalesce(o["summary"], F.lit("")))))
    code = c("identity_key")
    some = ~_blank(code)
    known = F.size("occurrences") > 0
    return base_rules("projects") | {
        "invalid_identity_key": some & ~(code.startswith("project|") | code.startswith("source|projects|")),
        "authors_without_code": F.exists(F.coalesce("authors", F.array().cast(PEOPLE)), lambda a: ~F.coalesce(a["id"], F.lit("")).rlike(r"^\d{10}$")),
        "missing_group": F.size(F.coalesce("groups", F.array().cast("array<string>"))) == 0,
        "missing_abstract": _blank(c("abstract")),
        "occurrence_missing_project_type": _any(lambda o: _blank(o["project_type"])),
        "invalid_start_date_occurrence": _has("__starts", "invalid"),
        "invalid_end_date_occurrence": _has("__ends", "invalid"),
        "source_end_before_start": _backwards(),
        "conflicting_project_types": known & (F.size(types) > 1),
        "abstract_missing_despite_source_summary": known & _blank(c("abstract")) & (F.size(summaries) > 0),
        "multiple_source_summaries": known & (F.size(summaries) > 1),
        "conflicting_start_dates": _conflict(starts),
        "conflicting_end_dates": _conflict(ends),
        "mixed_open_and_closed_end_dates": opened & (F.size(ends) > 0),
        "missing_top_start_year": (F.size(starts) > 0) & c("year_init").isNull(),
        "top_start_year_mismatch": (F.size(starts) > 0) & ~F.array_contains(years(starts), c("year_init")),
        "missing_top_end_year": (F.size(ends) > 0) & c("year_end").isNull(),
        "top_end_year_mismatch": (F.size(ends) > 0) & ~F.array_contains(years(ends), c("year_end")),
        "top_start_loses_precision": (c("__top_start")["status"] == "valid") & (F.size(precise(starts)) > 0) & ~agrees(c("__top_start"), starts),
        "top_end_loses_precision": (c("__top_end")["status"] == "valid") & (F.size(precise(ends)) > 0) & ~agrees(c("__top_end"), ends),
        "top_end_present_for_open_project": opened & (F.size(ends) == 0) & c("date_end").isNotNull(),
    }


def work_rules() -> dict[str, Column]:
    """Works and theses: family, identity, year, and the roles of a thesis."""
    thesis = c("family").isin(*sorted(set(routing.THESES.values())))
    code = c("identity_key")
    people = F.coalesce("authors", F.array().cast(PEOPLE))
    students, advisors = F.filter(people, lambda a: ~a["type"].eqNullSafe("advisor")), F.filter(people, lambda a: a["type"].eqNullSafe("advisor"))
    names = lambda who: F.filter(F.transform(who, lambda a: text.exact_key(a["full_name"])), lambda n: n != "")
    wanted = F.when(c("family") == "undergraduate_thesis", "tesis de pregrado").when(thesis, "tesis de posgrado")
    has = F.transform(F.coalesce("target_types", F.array().cast("array<string>")), text.exact_key)
    published = c("__top_start")
    other = ~_blank(c("family")) & ~thesis & (c("family") != "work")
    return base_rules("works") | {
        "wrong_family": ~F.coalesce(thesis | (c("family") == "work"), F.lit(False)),
        "invalid_identity_key": (c("family") == "work") & ~code.startswith("source|works|"),
        "invalid_thesis_identity": (thesis | other) & ~(code.startswith("thesis|") | code.startswith("source|works|")),
        "source_scoped_identity": (thesis | other) & code.startswith("source|works|"),
        "invalid_year_published": ~c("year_init").between(1900, 2100),
        "date_published_year_mismatch": (published["status"] == "valid") & (published["year"] != c("year_init")),
        "missing_student": (thesis | other) & (F.size(students) == 0),
        "missing_advisor": (thesis | other) & (F.size(advisors) == 0),
        "student_also_advisor": (thesis | other) & F.arrays_overlap(names(students), names(advisors)),
        "advisor_removed_exact_student_match": (thesis | other) & (c("role_resolutions") > 0),
        "missing_target_thesis_type": thesis & ~F.array_contains(has, wanted),
        "unexpected_target_thesis_type": other & (F.size(has) > 0),
    }


def patent_rules() -> dict[str, Column]:
    """Patents and other property: namespace, registration, country, holder and presentation."""
    code = c("identity_key")
    spaces = _distinct(_all(lambda o: o["namespace"]))
    numbers = _distinct(_all(lambda o: F.regexp_replace(F.upper(F.coalesce(o["registration_number"], F.lit(""))), "[^0-9A-Z]", "")))
    countries = _distinct(_all(lambda o: text.exact_key(F.coalesce(o["country"], F.lit("")))))
    return base_rules("patents") | {
        "wrong_family": ~F.coalesce(c("family").isin("patent", "intellectual_property"), F.lit(False)),
        "invalid_ip_identity": ~F.coalesce(code.startswith("ip|"), F.lit(False)),
        "source_scoped_identity": F.contains(code, F.lit("|source|")),
        "missing_ip_namespace": _any(lambda o: _blank(o["namespace"])),
        "mixed_ip_namespaces": F.size(spaces) > 1,
        "identity_namespace_mismatch": code.startswith("ip|") & F.exists(spaces, lambda s: ~code.startswith(F.concat(F.lit("ip|"), s, F.lit("|")))),
        "missing_registration_number": (F.size("occurrences") > 0) & (F.size(numbers) == 0),
        "conflicting_registration_numbers": F.size(numbers) > 1,
        "registration_identity_without_registration": F.contains(code, F.lit("|registration|")) & (F.size(numbers) == 0),
        "conflicting_countries": F.size(countries) > 1,
        "invalid_presentation_date": _has("__presented", "invalid"),
        "missing_ip_rights_holder": (F.size("occurrences") > 0) & ~_any(lambda o: ~_blank(o["holder"])),
        "missing_patent_presentation_date": (c("family") == "patent") & (F.size("occurrences") > 0) & ~_any(lambda o: ~_blank(o["presentation_date"])),
    }


def event_rules() -> dict[str, Column]:
    """Events: type, scope and dates, and what their normalisation has noted."""
    code = c("identity_key")
    kinds = _distinct(_all(lambda o: text.exact_key(F.coalesce(o["event_type"], F.lit("")))))
    scopes = _distinct(_all(lambda o: text.exact_key(F.coalesce(o["scope"], F.lit("")))))
    starts = _valid("__starts")
    top = c("__top_start")
    noted = lambda kind: _any(lambda o: F.coalesce(F.array_contains(o["findings"], kind), F.lit(False)))
    has = F.transform(F.coalesce("types", F.array().cast("array<string>")), text.exact_key)
    rules = base_rules("events") | {
        "wrong_family": ~c("family").eqNullSafe("event"),
        "invalid_event_identity": ~F.coalesce(code.startswith("event|") | code.startswith("source|events|"), F.lit(False)),
        "source_scoped_identity": code.startswith("source|events|"),
        "invalid_event_start_date": _has("__starts", "invalid"),
        "missing_event_start_date": _has("__starts", "missing"),
        "invalid_event_end_date": _has("__ends", "invalid"),
        "event_end_before_start": _backwards(),
        "conflicting_event_types": F.size(kinds) > 1,
        "conflicting_event_scopes": F.size(scopes) > 1,
        "conflicting_event_start_dates": _conflict(starts),
        "missing_top_event_date": (F.size(starts) > 0) & (top["status"] != "valid"),
        "top_event_date_mismatch": (F.size(starts) > 0) & (top["status"] == "valid") & ~F.exists(starts, lambda s: dates.dates_compatible(top, s)),
        "top_event_year_mismatch": (F.size(starts) > 0) & ~F.coalesce(F.array_contains(F.transform(starts, lambda s: s["year"]), c("year_init")), F.lit(False)),
        "top_event_type_mismatch": (F.size(kinds) > 0) & (F.size(F.array_except(kinds, has)) > 0),
    }
    noted_kinds = ("source_invalid_event_start_date", "source_invalid_event_end_date", "source_event_end_before_start", "source_invalid_event_scope", "source_event_scope_normalized")
    return rules | {k: noted(k) for k in noted_kinds}


RULES = {"projects": project_rules, "works": work_rules, "patents": patent_rules, "events": event_rules}


def codes(entity: str) -> Column:
    """The sorted codes of the rules that a prepared document (columns of ``DOCUMENT``) breaks."""
    return F.array_sort(F.array_compact(F.array(*[F.when(F.coalesce(rule, F.lit(False)), F.lit(code)) for code, rule in RULES[entity]().items()])))


def audit(documents: DataFrame, entity: str, as_of: str) -> DataFrame:
    """id, code and severity, a row for each rule that a document breaks."""
    found = prepared(documents, as_of).select("id", F.explode(codes(entity)).alias("code"))
    return found.withColumn("severity", severity(F.col("code")))


def summary(found: DataFrame, examples: int = 3) -> DataFrame:
    """Codes with how many documents break them, and the least few of these."""
    counts = found.groupBy("code", "severity").agg(F.count(F.lit(1)).alias("n"))
    spread = W.partitionBy("code", F.pmod(F.xxhash64("id"), F.lit(64))).orderBy("id")
    few = found.withColumn("r", F.row_number().over(spread)).where(F.col("r") <= examples)
    least = few.groupBy("code").agg(F.array_join(F.slice(F.sort_array(F.collect_list("id")), 1, examples), ",").alias("examples"))
    return counts.join(least, "code")


def quality_codes(entity: Column, as_of: str) -> Column:
    """Publication checks of projects and patents: titles that are usable and clean, dates that say what the occurrences say."""
    clean = F.transform("titles", lambda t: text.collapse_spaces(t))
    bad = F.exists(clean, lambda t: (t == "") | text.is_placeholder(t))
    unclean = F.exists("titles", lambda t: t != text.collapse_spaces(t))
    project = entity == "projects"
    wrong = lambda top, stamp, year: c(stamp).isNotNull() & ((c(top)["status"] != "valid") | ~c(top)["year"].eqNullSafe(c(year)))
    said = lambda parsed: F.array_distinct(F.transform(_valid(parsed), lambda d: d["year"]))
    one = lambda parsed: F.when(F.size(said(parsed)) == 1, F.element_at(said(parsed), 1))
    presented = F.exists("__presented", lambda d: ~d["status"].isin("valid", "missing"))
    rules = {
        "unusable_title": bad, "unclean_title": ~bad & unclean, "inconsistent_actual_date": project & (wrong("__top_start", "date_init", "year_init") | wrong("__top_end", "date_end", "year_end")),
        "invalid_year": project & (~c("year_init").between(1901, int(as_of[:4])) | ~c("year_end").between(1901, int(as_of[:4]))),
        "date_consensus_not_applied": project & (F.size("occurrences") > 0) & (~one("__starts").eqNullSafe(c("year_init")) | ~one("__ends").eqNullSafe(c("year_end"))),
        "invalid_presentation_date": (entity == "patents") & presented,
    }
    return F.array_sort(F.array_compact(F.array(*[F.when(F.coalesce(r, F.lit(False)), F.lit(k)) for k, r in rules.items()])))


#: Forms of bibliographic values that leaked from elsewhere.
SUSPICIOUS_PUBLISHER = r"(?i)^(autores\s*:|v\.|vol|p[aá]gs?\b|isbn\b|issn\b)"
SUSPICIOUS_VOLUME = r"(?i)(fasc|issn|isbn|ed\.|p[aá]gs?)"
VALID_PAGES = r"^[0-9]+(\s*-\s*[0-9]+)?$"


def enrichment_audit(base: DataFrame, final: DataFrame) -> DataFrame:
    """check and n: what a final collection lost of its base, or says without evidence.

    Both have columns id, publisher, publisher_state, book_title, book_title_state, source_name, source_publisher, volume and pages.
    """
    sides = final.withColumn("final", F.lit(True)).unionByName(base.withColumn("final", F.lit(False)))
    state = lambda field: c(f"{field}_state") == "consistent"
    late = lambda rule: F.count_if(c("final") & rule)
    lost = lambda rule: F.abs(F.count_if(c("final") & rule) - F.count_if(~c("final") & rule))
    checks = {
        "consistent_publisher_without_source": late(state("publisher") & _blank(c("source_publisher"))),
        "publisher_value_mismatch": late(state("publisher") & ~_blank(c("source_publisher")) & (c("publisher") != c("source_publisher"))),
        "book_title_source_mismatch": late(state("book_title") & ~c("book_title").eqNullSafe(c("source_name"))),
        "conflict_consolidated_as_publisher": late((c("publisher_state") == "conflict") & ~_blank(c("publisher"))),
        "suspicious_publisher": late(c("source_publisher").rlike(SUSPICIOUS_PUBLISHER)),
        "suspicious_volume": late(c("volume").rlike(SUSPICIOUS_VOLUME)),
        "invalid_pages": late(~_blank(c("pages")) & ~c("pages").rlike(VALID_PAGES)),
        "publisher_loss": lost(state("publisher")),
        "book_title_loss": lost(state("book_title")),
        "final_count_mismatch": lost(F.lit(True)),
    }
    counts = sides.agg(*[n.alias(k) for k, n in checks.items()])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(k).alias("check"), F.col(k).alias("n")) for k in checks])).alias("x")).select("x.check", "x.n")
