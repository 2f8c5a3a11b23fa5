"""Components to works: authorship, field evidence, identifiers and one row per work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def author_evidence(left_names: Column, right_names: Column, same_profile: Column, left_advised: Column, right_advised: Column) -> Column:
    """owner or advised if two occurrences share a name; within one profile only advised people count."""
    advised = F.arrays_overlap(left_advised, right_advised)
    return F.when(~same_profile & F.arrays_overlap(left_names, right_names), "author").when(advised, "advised")


def authorship(claims: DataFrame, work: str, occurrence: str, name_key: str) -> DataFrame:
    """What the occurrences of a work say about its authors.

    missing: none names any; single: one does; consistent: all that do name the same;
    combined: one claim holds all the others; conflict: otherwise.  A conflict publishes
    no authors.
    """
    sets = claims.groupBy(work, occurrence).agg(F.sort_array(F.collect_set(name_key)).alias("names"))
    distinct = sets.groupBy(work, "names").agg(F.count(F.lit(1)).alias("n"))
    out = distinct.where(F.size("names") > 0).groupBy(work).agg(
        F.sum("n").alias("claims"),
        F.count(F.lit(1)).alias("versions"),
        F.max_by("names", F.struct(F.size("names"), F.array_join("names", "|"))).alias("widest"),
        F.array_distinct(F.flatten(F.collect_list("names"))).alias("every"),
    )
    status = F.when(F.col("claims") == 1, "single").when(F.col("versions") == 1, "consistent").when(F.size("widest") == F.size("every"), "combined").otherwise("conflict")
    named = out.select(work, "claims", status.alias("status"), "widest")
    every = sets.select(work).distinct().join(named, work, "left")
    status = F.coalesce("status", F.lit("missing"))
    return every.select(work, F.coalesce("claims", F.lit(0)).alias("claims"), status.alias("status"), F.when(status != "conflict", F.array_join("widest", "|")).alias("authors"))


def field_evidence(rows: DataFrame, work: str, fields: dict[str, Column]) -> DataFrame:
    """Each field of each work: distinct normal values, their state, and the richest spelling."""
    long = rows.select(work, F.explode(F.array(*[F.struct(F.lit(k).alias("field"), v.cast("string").alias("value")) for k, v in fields.items()])).alias("x")).select(work, "x.*")
    long = long.where(F.coalesce("value", F.lit("")) != "")
    key = F.lower(F.trim("value"))
    return long.groupBy(work, "field").agg(
        F.count_distinct(key).alias("values"),
        F.when(F.count_distinct(key) == 1, "consistent").otherwise("conflict").alias("state"),
        F.max_by("value", F.struct(F.length("value"), F.col("value"))).alias("richest"),
    )


def works(rows: DataFrame, component: str, occurrence: str, title: str, year: str, identifier: str) -> DataFrame:
    """One row per component.

    The id comes from exactly one identifier, else from the component if it has more
    members, else from the only occurrence.  The year is the mode (least of ties), the
    title the longest spelling, then the greatest.
    """
    counted = rows.groupBy(component, year).agg(F.count(F.lit(1)).alias("__n"))
    years = counted.where(F.col(year).isNotNull()).groupBy(component).agg(F.min_by(year, F.struct(-F.col("__n"), F.col(year))).alias("year"))
    base = rows.groupBy(component).agg(
        F.count(F.lit(1)).alias("occurrences"),
        F.max_by(title, F.struct(F.length(title), F.col(title))).alias("title"),
        F.count_distinct(identifier).alias("identifiers"),
        F.min(identifier).alias("__id"),
        F.min(occurrence).alias("__first"),
    )
    rule = F.when(F.col("identifiers") == 1, "identifier").when(F.col("occurrences") > 1, "cluster").otherwise("occurrence")
    anchor = F.when(rule == "identifier", F.col("__id").cast("string")).when(rule == "cluster", F.col(component).cast("string")).otherwise(F.col("__first").cast("string"))
    out = base.join(years, component, "left")
    return out.select(component, F.substring(F.sha2(F.concat_ws("|", rule, anchor), 256), 1, 24).alias("work_id"), rule.alias("rule"), "occurrences", "title", "year", "identifiers")


def rehash_collisions(rows: DataFrame, work_id: str, component: str) -> DataFrame:
    """Components after the first of one work id get an id of their own; ids that do not collide stay."""
    first = rows.groupBy(work_id).agg(F.min(component).alias("__first"))
    joined = rows.join(first, work_id)
    other = F.substring(F.sha2(F.concat_ws("|", F.col(work_id), F.col(component).cast("string")), 256), 1, 24)
    return joined.withColumn(work_id, F.when(F.col(component) == F.col("__first"), F.col(work_id)).otherwise(other)).drop("__first")


def verified_authorship(claimed: DataFrame, authorities: DataFrame, work: str) -> DataFrame:
    """Authorship with what an authority has verified: its authors stand whatever the claims say; books whose claims
    contradict each other publish none.  ``claimed`` is what ``authorship`` gives, with a column family.
    """
    known = authorities.select(F.col(work).alias("__w"), F.col("authors").alias("__a"))
    out = claimed.join(known, F.col(work) == F.col("__w"), "left")
    status = F.when(F.col("__a").isNotNull(), "verified").otherwise(F.col("status"))
    authors = F.when(F.col("__a").isNotNull(), F.col("__a")).when(F.col("status") == "conflict", None).otherwise(F.col("authors"))
    return out.select(work, "claims", status.alias("status"), authors.alias("authors"))


def name_aliases(names: Column) -> Column:
    """Names (sorted token keys) without those of two tokens or more that are part of exactly one longer name."""
    tokens = lambda n: F.split(n, " ")

    def longer(n: Column) -> Column:
        return F.filter(names, lambda m: (F.size(tokens(m)) > F.size(tokens(n))) & (F.size(F.array_except(tokens(n), tokens(m))) == 0))

    return F.filter(names, lambda n: ~((F.size(tokens(n)) >= 2) & (F.size(longer(n)) == 1)))
