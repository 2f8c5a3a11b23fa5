"""People: facts of one source row, ordered enrichment, and the final form of a document."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, identifiers, text


def subjects(broad: Column, area: Column, narrow: Column, code: Column) -> Column:
    """Levels of a subject that are said, with the code of the first two: array of struct(level, name, id)."""
    level = lambda n, name, i: F.when(text.null_token_blank(name).isNotNull(), F.struct(F.lit(n).alias("level"), text.null_token_blank(name).alias("name"), F.nullif(i, F.lit("")).alias("id")))
    own = text.collapse_spaces(F.coalesce(code, F.lit("")))
    return F.array_compact(F.array(level(0, broad, F.substring(own, 1, 1)), level(1, area, own), level(2, narrow, F.lit(""))))


def degree(level: Column, source: str) -> Column:
    value = text.null_token_blank(level)
    return F.when(value.isNotNull(), F.struct(F.lit(source).alias("source"), value.alias("degree")))


def birthplace(country: Column, state: Column, city: Column) -> Column:
    """Map of the parts of a birthplace that are said."""
    parts = [F.struct(F.lit(k).alias("key"), text.null_token_blank(v).alias("value")) for k, v in (("country", country), ("state", state), ("city", city))]
    return F.map_from_entries(F.filter(F.array(*parts), lambda p: p["value"].isNotNull()))


def group_affiliation(code: Column, name: Column, role: Column, period: Column) -> Column:
    """struct(id, name, position, start_date, end_date) of a member; null for codes that are none."""
    span = dates.membership_epochs(F.coalesce(period, F.lit("")))
    good = identifiers.group_code(code)
    return F.when(good.isNotNull(), F.struct(good.alias("id"), text.collapse_spaces(name).alias("name"), text.collapse_spaces(role).alias("position"), span["start"].alias("start_date"), span["end"].alias("end_date")))


def seeded(codes: DataFrame) -> DataFrame:
    """Every known person with the defaults of a document."""
    none = F.array().cast("array<string>")
    return codes.select("code").distinct().select("code", F.lit("").alias("full_name"), none.alias("aliases"), F.lit("").alias("sex"), none.alias("ranking"))


def enriched(codes: DataFrame, passes: list[DataFrame], sets: list[str], scalars: list[str]) -> tuple[DataFrame, DataFrame]:
    """Documents after passes of updates in their order, and how many updates of each pass named nobody known.

    A pass has code, place (its order within the pass), array columns ``sets`` (added to, without repeats) and
    columns ``scalars`` (the last that is not blank stays).  All passes are one union and one grouping.
    """
    rows = [p.select("code", F.lit(k).alias("pass"), "place", *sets, *scalars) for k, p in enumerate(passes)]
    updates = reduce(lambda a, b: a.unionByName(b), rows)
    known = codes.select("code").distinct()
    order = F.struct("pass", "place")
    added = [F.array_distinct(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct(order.alias("o"), F.coalesce(c, F.array().cast("array<string>")).alias("v")))), lambda x: x["v"]))).alias(c) for c in sets]
    last = [F.max_by(c, F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", order)).alias(c) for c in scalars]
    found = updates.join(known, "code", "left_semi").groupBy("code").agg(*added, *last)
    whole = known.join(found, "code", "left").select("code", *[F.coalesce(c, F.array().cast("array<string>")).alias(c) for c in sets], *scalars)
    unknown = updates.join(known, "code", "left_anti").groupBy("pass").agg(F.count(F.lit(1)).alias("unknown"))
    return whole, unknown


def normal_person(people: DataFrame) -> DataFrame:
    """The final form: a clean name, aliases that are not the name, one time for each source, DOIs in order.

    ``people`` has code, full_name, aliases, updated (array of struct(source, time)) and related (array of struct(source, id)).
    """
    name = text.all_caps_to_title(F.coalesce("full_name", F.lit("")))
    clean = F.transform(F.filter("aliases", lambda a: text.collapse_spaces(F.coalesce(a, F.lit(""))) != ""), text.all_caps_to_title)
    others = text.distinct_by_key(clean, text.ascii_key)
    rows = people.withColumn("__n", name).withColumn("__o", others)
    rows = rows.withColumn("__o", F.filter("__o", lambda a: text.ascii_key(a) != text.ascii_key(F.col("__n"))))
    first = F.when(F.col("__n") != "", F.col("__n")).otherwise(F.coalesce(F.get("__o", F.lit(0)), F.lit("")))
    left = F.when(F.col("__n") != "", F.col("__o")).otherwise(F.slice("__o", 2, F.greatest(F.size("__o") - 1, F.lit(0))))
    sources = F.array_sort(F.array_distinct(F.filter(F.transform("updated", lambda u: u["source"]), lambda s: s.isNotNull())))
    latest = F.transform(sources, lambda s: F.struct(s.alias("source"), F.array_max(F.transform(F.filter("updated", lambda u: u["source"] == s), lambda u: F.coalesce(u["time"], F.lit(0)))).alias("time")))
    dois = F.filter(F.transform(F.filter("related", lambda r: r["source"] == "doi"), lambda r: identifiers.canonical_doi(r["id"])), lambda d: d.isNotNull())
    return rows.select("code", first.alias("full_name"), left.alias("aliases"), latest.alias("updated"), F.array_sort(F.array_distinct(dois)).alias("related_works"))


def manifest(codes: DataFrame) -> DataFrame:
    """One row: how many codes a frozen manifest has, and an order-free digest of them."""
    half = F.conv(F.substring(F.sha2(F.col("code").cast("string"), 256), 1, 15), 16, 10).cast("long")
    return codes.select("code").distinct().agg(F.count(F.lit(1)).alias("codes"), F.coalesce(F.bit_xor(half), F.lit(0)).alias("digest"))


def proved(codes: DataFrame, stored: DataFrame) -> bool:
    """Whether a manifest still has the codes that its stored row says."""
    return manifest(codes).collect() == stored.select("codes", "digest").collect()  # one row each


def person_audit(people: DataFrame, known: DataFrame, fields: list[str]) -> DataFrame:
    """check and n: codes that are malformed, repeated, unknown or missing, and fields that do not belong."""
    own = people.select("code", "full_name")
    repeated = own.groupBy("code").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    checks = {
        "malformed_code": own.where(~F.coalesce(F.col("code").rlike(r"^\d{10}$"), F.lit(False))), "repeated_code": repeated, "unknown_code": own.join(known.select("code"), "code", "left_anti"),
        "missing_person": known.select("code").distinct().join(own.select("code"), "code", "left_anti"), "nameless": own.where("coalesce(full_name, '') = ''"),
    }
    extra = [c for c in people.columns if c not in fields]
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("check"), "n") for k, df in checks.items()]
    parts.append(people.sparkSession.range(1).select(F.lit("unexpected_field").alias("check"), F.lit(len(extra)).cast("long").alias("n")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def affiliation_audit(groups: DataFrame, sources: DataFrame) -> DataFrame:
    """check and n: members of groups that stand in no or more than one of them, and groups without a name or a source."""
    each = groups.select("id", F.explode("members").alias("m")).groupBy("m").agg(F.count(F.lit(1)).alias("n"))
    wanted = sources.select(F.col("code").alias("m")).distinct()
    checks = {
        "member_in_several": each.where("n > 1"), "member_in_none": wanted.join(each, "m", "left_anti"), "member_unknown": each.join(wanted, "m", "left_anti"),
        "nameless": groups.where("coalesce(name, '') = ''"), "repeated_id": groups.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1"),
    }
    return reduce(lambda a, b: a.unionByName(b), [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("check"), "n") for k, df in checks.items()])


def permitted(old: DataFrame, new: DataFrame, key: str, allowed: dict[str, Column]) -> DataFrame:
    """Changes of fields between versions: field, permitted or violation, counted.

    ``allowed`` says of a field (columns old and new) when its change is one that a migration may make;
    fields that are not named must not change.
    """
    fields = [c for c in old.columns if c != key]
    a, b = old.alias("a"), new.alias("b")
    joined = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"))
    each = joined.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"a.{f}").cast("string").alias("old"), F.col(f"b.{f}").cast("string").alias("new")) for f in fields])).alias("x")).select("x.*")
    changed = each.where(~F.col("old").eqNullSafe(F.col("new")))
    ok = None
    for f, rule in allowed.items():
        cond = (F.col("field") == f) & F.coalesce(rule, F.lit(False))
        ok = cond if ok is None else ok | cond
    state = F.when(ok, "permitted").otherwise("violation") if ok is not None else F.lit("violation")
    return changed.groupBy("field", state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


def volatile_free(rows: DataFrame, volatile: list[str]) -> DataFrame:
    """Rows without the columns that change with each run."""
    return rows.drop(*volatile)


def source_proof(sources: dict[str, DataFrame], columns: dict[str, list[str]]) -> DataFrame:
    """source, rows and digest of each source; taken before and after a build, they must be equal."""
    from .aggregates import fingerprint

    parts = [fingerprint(df, columns[k]).select(F.lit(k).alias("source"), "rows", F.col("xor_digest").alias("digest")) for k, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def preconditions(found: DataFrame, wanted: dict[str, int]) -> DataFrame:
    """source and state: ready, empty, missing, or changed against the count that a build was promised."""
    promised = found.sparkSession.createDataFrame(list(wanted.items()), "source string, promised long")
    out = promised.join(found.select("source", "rows"), "source", "left")
    state = F.when(F.col("rows").isNull(), "missing").when(F.col("rows") == 0, "empty").when(F.col("rows") != F.col("promised"), "changed").otherwise("ready")
    return out.select("source", state.alias("state"))
