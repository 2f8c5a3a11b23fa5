"""Linking measurements to entities, people to names, members to institutions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def authority_match(rows: DataFrame, row_id: str, row_key: Column, authorities: DataFrame, authority_id: str, authority_key: Column) -> DataFrame:
    """matched if all of a row's keys name one authority, conflict if they name more; others are absent."""
    left = rows.select(F.col(row_id).alias("id"), F.explode(row_key).alias("k")).distinct()
    right = authorities.select(F.col(authority_id).alias("authority"), F.explode(authority_key).alias("k")).distinct()
    found = left.join(right, "k").groupBy("id").agg(F.count_distinct("authority").alias("authorities"), F.min("authority").alias("least"))
    one = F.col("authorities") == 1
    return found.select("id", "authorities", F.when(one, "matched").otherwise("conflict").alias("status"), F.when(one, F.col("least")).alias("authority"))


def unique_names(rows: DataFrame, scope: list[str], name: str, code: str) -> DataFrame:
    """Names that belong to one code within their scope."""
    found = rows.groupBy(*scope, name).agg(F.count_distinct(code).alias("codes"), F.min(code).alias(code))
    return found.where("codes = 1").select(*scope, name, code)


def link(products: DataFrame, graph: DataFrame, keys: list[str], owners: tuple[str, str], groups: tuple[str, str], most: int, generic: Column | None = None) -> DataFrame:
    """Outcome of each product: linked, ambiguous or unlinked, and by which rule.

    Both sides have an id (product_id, entity_id), the blocking ``keys``, and arrays of
    owners and groups.  A candidate with a shared owner or group is admissible, one with
    a generic title needs both.  One admissible candidate links; candidates without
    exactly one are ambiguous, and so is a product whose block has more than ``most``.
    """
    sizes = graph.groupBy(*keys).agg(F.count(F.lit(1)).alias("block_size"))
    sized = products.join(sizes, keys, "left")
    candidates = sized.where(F.col("block_size") <= most).join(graph, keys)
    owner = F.arrays_overlap(owners[0], owners[1])
    group = F.arrays_overlap(groups[0], groups[1])
    admissible = F.when(generic, owner & group).otherwise(owner | group) if generic is not None else owner | group
    rule = F.when(owner & group, "owner_group").when(owner, "owner").when(group, "group")
    accepted = candidates.where(admissible).groupBy("product_id").agg(
        F.count(F.lit(1)).alias("accepted"), F.min("entity_id").alias("entity_id"), F.min(rule).alias("rule")
    )
    out = sized.join(accepted, "product_id", "left")
    one = (F.coalesce("accepted", F.lit(0)) == 1) & (F.col("block_size") <= most)
    status = F.when(F.col("block_size").isNull(), "unlinked").when(one, "linked").otherwise("ambiguous")
    return out.select(
        "product_id",
        status.alias("status"),
        F.coalesce("block_size", F.lit(0)).alias("candidate_count"),
        F.when(one, F.col("entity_id")).alias("entity_id"),
        F.when(one, F.col("rule")).alias("rule"),
    )


def bracketing(targets: DataFrame, facts: DataFrame, key: str, target_time: str, fact_time: str, value: str) -> DataFrame:
    """Value at a time: the exact one, else the nearest before and after if they agree; never beyond the ends.

    Targets and facts of a key lie on one line in order of time and each looks back along it,
    once either way, so that their numbers add and do not multiply.
    """
    points = targets.select(F.col(key).alias("__k"), F.col(target_time).alias("__t")).distinct().select("*", F.lit(None).cast(facts.schema[value].dataType).alias("__v"))
    line = points.unionByName(facts.select(F.col(key).alias("__k"), F.col(fact_time).alias("__t"), F.col(value).alias("__v")))
    line = line.groupBy("__k", "__t").agg(F.min("__v").alias("__v"))
    back = lambda order: F.last("__v", ignorenulls=True).over(W.partitionBy("__k").orderBy(order).rowsBetween(W.unboundedPreceding, -1))
    line = line.withColumn("__before", back(F.col("__t"))).withColumn("__after", back(F.col("__t").desc()))
    found = line.select("__k", "__t", F.coalesce("__v", F.when(F.col("__before") == F.col("__after"), F.col("__after"))).alias(value))
    return targets.join(found, (targets[key] == found["__k"]) & (targets[target_time] == found["__t"]), "left").select(*[targets[c] for c in targets.columns], value)


def enrich_and_standalone(graph: DataFrame, links: DataFrame, products: DataFrame) -> DataFrame:
    """Graph entities with their linked products, and products without a link as entities of their own."""
    official = links.where("status = 'linked'").groupBy("entity_id").agg(F.count(F.lit(1)).alias("official_products"))
    enriched = graph.select("entity_id").distinct().join(official, "entity_id", "left")
    enriched = enriched.select(F.col("entity_id").alias("id"), F.lit("graph").alias("origin"), F.coalesce("official_products", F.lit(0)).alias("official_products"))
    alone = products.select("product_id").join(links.where("status = 'linked'").select("product_id"), "product_id", "left_anti")
    return enriched.unionByName(alone.select(F.col("product_id").alias("id"), F.lit("standalone").alias("origin"), F.lit(1).cast("long").alias("official_products")))
