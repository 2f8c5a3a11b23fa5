"""Whole phases as functions: tables in, tables out; what a run's stages call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import audits, identified, linkage, matching, occurrences, persons, reconcile, semantics
from ..sources import publication, records


def normalise_people(pages: DataFrame, id_col: str, html_col: str, catalogue: dict[str, str]) -> DataFrame:
    """Personal pages to records."""
    return records.person_pages(pages, id_col, html_col, catalogue)


def normalise_groups(pages: DataFrame, id_col: str, html_col: str, catalogue: dict[str, str]) -> DataFrame:
    """Group pages to records."""
    return records.group_pages(pages, id_col, html_col, catalogue)


def normalise_entities(profiles: DataFrame, id_col: str, catalogue: DataFrame, owner: Column) -> tuple[DataFrame, DataFrame]:
    """Entity documents of the records of normalised profiles, and what made none."""
    rows = occurrences.outcomes(occurrences.exploded(profiles, id_col), catalogue)
    return occurrences.documents(rows, owner, "profiles"), occurrences.unmaterialized(rows)


def build_works_graph(profiles: DataFrame, id_col: str, catalogue: DataFrame, version: str = "1") -> tuple[DataFrame, DataFrame]:
    """Nodes of the works graph with their component, and the evidence of edges and reviews."""
    rows = occurrences.outcomes(occurrences.exploded(profiles, id_col), catalogue)
    nodes = occurrences.graph_nodes(rows, version)
    none = F.array().cast("array<string>")
    content = nodes.select(
        "id", F.col("title_key").alias("title"), "year", F.col("type_family").alias("family"), none.alias("dois"), none.alias("isbns"), F.lit("").alias("owner"), F.col("source_id").alias("profile"), none.alias("names"), none.alias("advised")
    )
    members, evidence = matching.work_components(content)
    return nodes.join(members, "id"), evidence


def link_measurements(products: DataFrame, graph: DataFrame, keys: list[str], most: int = 100) -> tuple[DataFrame, DataFrame]:
    """Outcome of each measured product, and the graph enriched with what stands alone beside it."""
    links = linkage.link(products, graph, keys, ("owners", "entity_owners"), ("groups", "entity_groups"), most)
    return links, linkage.enrich_and_standalone(graph, links, products)


def materialise_people(manifest: DataFrame, members: DataFrame, passes: list[DataFrame], sets: list[str], scalars: list[str]) -> tuple[DataFrame, DataFrame]:
    """People of a frozen manifest and of groups after all passes, and updates that named nobody."""
    return persons.enriched(manifest.select("code").unionByName(members.select("code")).distinct(), passes, sets, scalars)


def reconcile_identifiers(values: DataFrame, prefix: str, suffix: str, checks: DataFrame, key: str, status: str) -> tuple[DataFrame, DataFrame]:
    """Decisions on pairs of near-equal identifiers, and the corrections that are certain."""
    pairs = reconcile.similar_pairs(values, prefix, suffix)
    decided = reconcile.decisions(pairs, checks, "left_suffix", "right_suffix", key, status)
    return decided, reconcile.corrections(decided)


def compare_versions(old: DataFrame, new: DataFrame, key: str, fields: list[str], allowed: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """What was added, removed and changed, and which changes were not permitted."""
    return audits.snapshot_diff(old, new, key, fields), persons.permitted(old.select(key, *fields), new.select(key, *fields), key, allowed)


def select_identified(works: DataFrame, people: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Works with a valid identifier, how many have which, and why others were refused."""
    found = identified.evaluate(works, people)
    return found.where("eligible"), identified.combinations(found), identified.reasons(found)


def publish_release(entities: dict[str, tuple[DataFrame, list[str]]], folder: str, pointer: publication.Pointer, value: dict, as_of: str) -> DataFrame:
    """Audit all entities and, if nothing critical is found, write them and move the pointer; the audit is returned."""
    checks: dict = {}
    for name, (documents, unexpected) in entities.items():
        checks |= publication.structure_checks(name, documents, unexpected)
        if name in semantics.RULES and "occurrences" in documents.columns:
            checks[(name, "critical_finding")] = semantics.audit(documents, name, as_of).where("severity = 'critical'")
    audit = publication.release_audit(checks)
    if audits.gate(audit, "n", F.lit(True)):
        expected = pointer.read()
        for name, (documents, _) in entities.items():
            publication.publish_table(documents, folder, publication.published_name("reg", name, value["version"], value["date"]))
        pointer.publish(value, expected)
    return audit
