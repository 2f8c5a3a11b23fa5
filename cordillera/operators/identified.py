"""Selection of works that carry a valid identifier, their sparse projection, and digests that prove a copy."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import identifiers, text

#: Fields of a selected work, in the order of its template.
FIELDS = ("titles", "updated", "doi", "keywords", "types", "external_ids", "year_published", "bibliographic_info", "author_count", "authors", "source", "ranking", "subjects", "groups")
#: What counting needs of a work.
COUNT_FIELDS = ("doi", "external_ids", "types", "product_ids", "source_ids")
ENTRY = "array<struct<source:string,id:string,person:string,product:string>>"


def evaluate(works: DataFrame, people: DataFrame) -> DataFrame:
    """works (id, doi, external_ids as ``ENTRY``, product_ids, types) with valid identifiers and what was refused.

    eligible: a DOI, an ISBN, or a pair of codes that an official product id and an existing person bear
    out.  An ISSN alone is none.  Refusals are counted by reason; an ISBN of a chapter is its container's.
    ``people`` has the codes of persons (code); only those that some work names are looked up.
    """
    entries = works.select("id", F.posexplode_outer("external_ids").alias("place", "e"), "product_ids")
    pair = identifiers.pair_codes(F.col("person"), F.col("product"))
    entries = entries.select("id", "place", "product_ids", F.col("e.source").alias("source"), F.col("e.id").alias("value"), F.col("e.person").alias("person"), F.col("e.product").alias("product"))
    known = people.select(F.col("code").alias("__code")).distinct().withColumn("__known", F.lit(True))
    entries = entries.join(known, F.col("person") == F.col("__code"), "left")
    clean = F.when(F.col("source") == "doi", identifiers.strict_doi(F.col("value"))).when(F.col("source") == "isbn", identifiers.strict_isbn(F.col("value"))).when(F.col("source") == "issn", identifiers.valid_issn(F.col("value")))
    own_pair = F.col("source") == "pair"
    backed = identifiers.official_pair(pair, F.col("product_ids"))
    reason = (
        F.when(F.col("source").isin("doi", "isbn", "issn") & clean.isNull(), F.concat_ws("_", "source", F.lit("invalid")))
        .when(own_pair & pair.isNull(), "pair_invalid_format")
        .when(own_pair & ~backed, "pair_missing_product_evidence")
        .when(own_pair & F.col("__known").isNull(), "pair_person_missing")
    )
    kept = F.when(F.col("source").isNotNull() & reason.isNull() & ~F.contains(F.coalesce("source", F.lit("")), F.lit("fingerprint")), F.struct("place", F.col("source").alias("source"), F.coalesce(clean, F.col("value")).alias("id"), "person", "product"))
    found = entries.withColumn("reason", reason).groupBy("id").agg(
        F.sort_array(F.collect_list(kept)).alias("kept"),
        F.sort_array(F.collect_list("reason")).alias("rejections"),
    )
    joined = works.drop("external_ids").join(found, "id")
    of = lambda kind: F.transform(F.filter("kept", lambda k: k["source"] == kind), lambda k: k["id"])
    top = identifiers.strict_doi(F.col("doi"))
    dois = F.array_sort(F.array_distinct(F.concat(of("doi"), F.when(top.isNotNull(), F.array(top)).otherwise(F.array().cast("array<string>")))))
    pairs = F.filter("kept", lambda k: k["source"] == "pair")
    kinds = F.array_compact(F.array(F.when(F.size(dois) > 0, "doi"), F.when(F.size(of("isbn")) > 0, "isbn"), F.when(F.size(pairs) > 0, "pair")))
    chapter = F.exists("types", lambda t: F.contains(text.norm_text(t), F.lit("capitulo")) | F.contains(F.lower(t), F.lit("chapter")))
    refused = F.concat("rejections", F.when(F.col("doi").isNotNull() & (F.col("doi") != "") & top.isNull(), F.array(F.lit("doi_invalid"))).otherwise(F.array().cast("array<string>")))
    return joined.select(
        "id", (F.size(kinds) > 0).alias("eligible"), F.coalesce(F.nullif(F.array_join(kinds, "+"), F.lit("")), F.lit("none")).alias("combination"), F.coalesce(top, F.get(dois, F.lit(0))).alias("doi"),
        F.transform("kept", lambda k: F.struct(k["source"].alias("source"), k["id"].alias("id"), k["person"].alias("person"), k["product"].alias("product"))).alias("external_ids"),
        F.array_sort(refused).alias("rejections"), ((F.size(kinds) == 0) & (F.size(of("issn")) > 0)).alias("issn_only"), F.when(F.size(of("isbn")) > 0, F.when(F.coalesce(chapter, F.lit(False)), "container").otherwise("work")).alias("isbn_role"),
    )


def pair_candidates(works: DataFrame) -> DataFrame:
    """Person codes that valid pairs with official evidence name: the only ones whose existence has to be asked."""
    each = works.select(F.explode("external_ids").alias("e"), "product_ids").where("e.source = 'pair'")
    pair = identifiers.pair_codes(F.col("e.person"), F.col("e.product"))
    return each.where(pair.isNotNull() & identifiers.official_pair(pair, F.col("product_ids"))).select(F.col("e.person").alias("code")).distinct()


def combinations(found: DataFrame) -> DataFrame:
    """How many works have each combination of identifiers, and how many an ISSN alone."""
    return found.groupBy("combination").agg(F.count(F.lit(1)).alias("n"), F.count_if("issn_only").alias("issn_only"))


def reasons(found: DataFrame) -> DataFrame:
    return found.select(F.explode("rejections").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def selection_digest(found: DataFrame) -> DataFrame:
    """Works and an order-free digest of eligible ids and what they were chosen for."""
    line = F.sha2(F.concat_ws("|", F.col("id").cast("string"), "combination", F.coalesce("doi", F.lit(""))), 256)
    return found.where("eligible").agg(F.count(F.lit(1)).alias("works"), F.bit_xor(F.conv(F.substring(line, 1, 15), 16, 10).cast("long")).alias("digest"))


def pruned(value):
    """Without nulls, blanks and empty containers, at any depth; zero and False stay. None: nothing is left."""
    if isinstance(value, dict):
        held = {k: y for k, x in value.items() if (y := pruned(x)) is not None}
        return held or None
    if isinstance(value, list):
        return [y for x in value if (y := pruned(x)) is not None] or None
    return None if value is None or isinstance(value, str) and not value.strip() else value


def sparse(documents: DataFrame, id_col: str, json_col: str, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """id and document (JSON): the listed fields in their order, whatever else and whatever is empty left out."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for x in part["document"]:
                held = pruned(json.loads(x)) if x else None
                held = {f: held[f] for f in fields if f in held} if isinstance(held, dict) else {}
                out.append(json.dumps(held, ensure_ascii=False, separators=(",", ":")))
            yield pd.DataFrame({"id": part["id"], "document": out})

    return documents.select(F.col(id_col).cast("string").alias("id"), F.col(json_col).alias("document")).mapInPandas(run, "id string, document string")


def mended(x: str) -> tuple[str, int]:
    """Lone UTF-16 surrogates of a JSON text replaced, and how many there were; pairs become the character they are."""
    lone = re.findall("[\ud800-\udfff]", x)
    return (x.encode("utf-16", "surrogatepass").decode("utf-16", "replace"), len(lone)) if lone else (x, 0)


def safe_text(rows: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """id, text and repaired: strings of JSON texts whose escapes are no characters are mended."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = [mended(json.loads(f'"{x}"')) if x is not None else (None, 0) for x in part["text"]]
            yield pd.DataFrame({"id": part["id"], "text": [t for t, _ in found], "repaired": [n for _, n in found]})

    return rows.select(F.col(id_col).cast("string").alias("id"), F.col(json_col).alias("text")).mapInPandas(run, "id string, text string, repaired long")


def resumed(rows: DataFrame, id_col: str, kind_col: str, last: tuple[str, str] | None) -> DataFrame:
    """Rows after the last (kind, id) in the order string ids, then object ids; all if there was none."""
    if last is None:
        return rows
    rank: Column = F.when(F.col(kind_col) == "string", 0).otherwise(1)
    at = 0 if last[0] == "string" else 1
    return rows.where((rank > at) | ((rank == at) & (F.col(id_col) > last[1])))
