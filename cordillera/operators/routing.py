"""Routing by an exact type catalogue, which is an input table, and the care of that table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import exact_key, label_key, observation_id

#: Presentation variants of labels (by exact key) and the label that they stand for.
LABEL_ALIASES = {
    "capitulo de libro": "Capítulo de libro", "capitulos de libro": "Capítulo de libro", "capítulos de libro": "Capítulo de libro", "capítulos de libro publicados": "Capítulo de libro", "capitulos de libro publicados": "Capítulo de libro",
    "articulos": "Artículo", "artículos": "Artículo", "artículos publicados": "Artículo", "articulos publicados": "Artículo", "articulo de revista": "Artículo de revista",
    "proyectos": "Proyecto", "patentes": "Patente", "libros": "Libro", "libros publicados": "Libro", "otros libros publicados": "Libro",
    "otros artículos publicados": "Otro artículo publicado", "otros articulos publicados": "Otro artículo publicado", "libro de formacion": "Libros de formación", "libro de formación": "Libros de formación",
    "libros de divulgacion y/o compilacion de divulgacion": "Libros de divulgación y/o Compilación de divulgación", "libro pedagógico": "Libro pedagógico y/o de divulgación",
    "trabajos dirigidos/turorías": "Trabajos dirigidos/Tutorías", "trabajos dirigidos/tutorias": "Trabajos dirigidos/Tutorías", "ediciones": "Editoración o revisión", "diseños industriales": "Diseño Industrial",
    "nuevas variedades vegetal": "Variedad vegetal", "nuevas variedades animal": "Variedad animal", "esquemas de trazados de circuito integrado": "Esquema de circuito integrado",
    "estrategias de comunicación del conocimiento": "Estrategia de comunicación del conocimiento", "textos en publicaciones no científicas": "Publicaciones editoriales no especializadas",
    "textos en publicaciones no cientificas": "Publicaciones editoriales no especializadas", "redes de conocimiento especializado": "Red de conocimiento especializado", "asesorías al programa ondas": "Asesoría al programa Ondas",
}
#: Types of directed works and their families.
THESES = {
    "trabajos de grado de pregrado": "undergraduate_thesis", "trabajo de grado de maestría o especialidad clínica": "graduate_thesis", "tesis de doctorado": "graduate_thesis",
    "monografía de conclusión de curso de perfeccionamiento/especialización": "graduate_degree_work",
}
#: Fixed values: (section, type) of intellectual property on group pages: its entity and namespace.
PROPERTY = {
    ("signos distintivos", "marcas"): ("patents", "trademark"), ("signos distintivos", "marcas colectivas"): ("patents", "trademark"), ("signos distintivos", "nombres comerciales"): ("patents", "trade_name"),
    ("signos distintivos", "marcas de certificación"): ("patents", "trademark"), ("signos distintivos", "denominaciones de origen"): ("patents", "appellation_of_origin"),
    ("signos distintivos", "lemas comerciales"): ("patents", "commercial_slogan"), ("signos distintivos", "enseñas comerciales"): ("patents", "business_sign"),
    ("diseños industriales", "diseño industrial"): ("works", "industrial_design"), ("nuevas variedades vegetal", "variedad vegetal"): ("works", "plant_variety"),
    ("nuevas variedades animal", "variedad animal"): ("works", "animal_variety"), ("esquemas de trazados de circuito integrado", "esquema de circuito integrado"): ("works", "integrated_circuit_layout"),
}
#: The section that a channel's records belong to.
CHANNEL_SECTIONS = {"projects": "Proyectos", "events": "Eventos Científicos", "patents": "Patentes"}

#: A catalogue is small by contract; a larger one is joined by a shuffle.
BROADCAST_ROWS = 100_000


def route(rows: DataFrame, catalogue: DataFrame, keys: list[tuple[Column, str]], outputs: list[str]) -> DataFrame:
    """Left join on exact keys (case and white space aside); rows without an entry keep nulls."""
    right = catalogue.select(*[exact_key(F.col(name)).alias(f"__c{k}") for k, (_, name) in enumerate(keys)], *outputs).distinct()
    right = F.broadcast(right) if catalogue.count() <= BROADCAST_ROWS else right
    condition = None
    for k, (own, _) in enumerate(keys):
        same = exact_key(own) == F.col(f"__c{k}")
        condition = same if condition is None else condition & same
    return rows.join(right, condition, "left").drop(*[f"__c{k}" for k in range(len(keys))])


def inherit(catalogue: DataFrame, label: str, leaf: str, targets: list[str]) -> DataFrame:
    """resolved, ambiguous or pending for each label: leaves beat ancestors, and only one target resolves."""
    rows = catalogue.select(exact_key(F.col(label)).alias("key"), F.col(leaf).alias("leaf"), F.struct(*targets).alias("t"))
    best = rows.groupBy("key").agg(F.max("leaf").alias("leaf"))
    found = rows.join(best, ["key", "leaf"]).groupBy("key").agg(F.count_distinct("t").alias("n"), F.min("t").alias("t"), F.count_if(F.col(f"t.{targets[0]}").isNull()).alias("open"))
    status = F.when(F.col("open") > 0, "pending").when(F.col("n") == 1, "resolved").otherwise("ambiguous")
    return found.select("key", status.alias("status"), *[F.when(status == "resolved", F.col(f"t.{t}")).alias(t) for t in targets])


def resolve(inherited: DataFrame, reviewed: DataFrame, targets: list[str]) -> DataFrame:
    """A reviewed entry overrides what a label inherits."""
    over = reviewed.select("key", F.lit(True).alias("__r"), *[F.col(t).alias(f"__{t}") for t in targets])
    joined = inherited.join(over, "key", "full_outer")
    status = F.when(F.col("__r"), "reviewed").otherwise(F.col("status"))
    return joined.select("key", status.alias("status"), *[F.when(F.col("__r"), F.col(f"__{t}")).otherwise(F.col(t)).alias(t) for t in targets])


def target_entity(rows: DataFrame, key: str, entity: str) -> DataFrame:
    """The one entity that all of a product's rows route to; else unmapped or mixed."""
    out = rows.groupBy(key).agg(F.count_if(F.col(entity).isNull()).alias("unmapped"), F.count_distinct(entity).alias("n"), F.min(entity).alias("e"))
    return out.select(key, F.when(F.col("unmapped") > 0, "unmapped").when(F.col("n") > 1, "mixed").otherwise(F.col("e")).alias("target"))


def type_inventory(rows: DataFrame, section: str, kind: str, source: str, example: str, most: int = 3) -> DataFrame:
    """How often each (section, type) occurs, from which sources, and its least examples.

    Examples are cut in each task's partial sums by grouping distinct ones first.
    """
    counts = rows.groupBy(section, kind, source).agg(F.count(F.lit(1)).alias("n"), F.min(example).alias("ex"))
    sources = F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(source), F.col("n"))))))
    examples = F.array_join(F.slice(F.sort_array(F.collect_set("ex")), 1, most), "|")
    return counts.groupBy(section, kind).agg(F.sum("n").alias("frequency"), sources.alias("sources"), examples.alias("examples"))


def context(channel: Column, section: Column, project_type: Column, event_type: Column, product_type: Column) -> Column:
    """struct(kind, section): which field tells a record's type, and the section that gives it a meaning."""
    blank = lambda x: F.coalesce(x, F.lit(""))
    known = F.create_map(*[F.lit(v) for pair in CHANNEL_SECTIONS.items() for v in pair])
    where = F.when(blank(section) != "", section).otherwise(blank(F.try_element_at(known, channel)))
    projects = (channel == "projects") | (where == "Proyectos")
    events = (channel == "events") | (exact_key(where) == "eventos científicos")
    own = F.when(F.coalesce(projects, F.lit(False)), blank(project_type)).when(F.coalesce(events, F.lit(False)), blank(event_type)).otherwise(F.lit(""))
    kind = F.when(own != "", own).otherwise(blank(product_type))
    kind = F.when(F.coalesce(events, F.lit(False)), F.trim(F.element_at(F.split(kind, ":"), -1))).otherwise(kind)
    return F.struct(kind.alias("kind"), where.alias("section"))


def _table(pairs: dict) -> Column:
    return F.create_map(*[F.lit(v) for pair in pairs.items() for v in pair])


def with_catalogue(rows: DataFrame, catalogue: DataFrame, section: Column, kind: Column) -> DataFrame:
    """Rows with catalogue_entity and catalogue_type of their (section, type), by label keys; nulls where there is none.

    ``catalogue`` has columns parent, type, entity and target; a blank parent stands for any section.
    """
    keys = catalogue.select(label_key(F.col("parent"), LABEL_ALIASES).alias("__p"), label_key(F.col("type"), LABEL_ALIASES).alias("__t"), F.col("entity").alias("__e"), F.col("target").alias("__y")).distinct()
    keys = F.broadcast(keys) if catalogue.count() <= BROADCAST_ROWS else keys
    own = rows.withColumn("__s", label_key(F.coalesce(section, F.lit("")), LABEL_ALIASES)).withColumn("__k", label_key(F.coalesce(kind, F.lit("")), LABEL_ALIASES))
    exact = keys.where("__p <> ''").select(F.col("__p").alias("__s"), F.col("__t").alias("__k"), F.col("__e").alias("__e1"), F.col("__y").alias("__y1"))
    loose = keys.where("__p = ''").select(F.col("__t").alias("__k"), F.col("__e").alias("__e2"), F.col("__y").alias("__y2"))
    out = own.join(exact, ["__s", "__k"], "left").join(loose, "__k", "left")
    return out.withColumn("catalogue_entity", F.coalesce("__e1", "__e2")).withColumn("catalogue_type", F.coalesce("__y1", "__y2")).drop("__s", "__k", "__e1", "__y1", "__e2", "__y2")


def route_person(rows: DataFrame, catalogue: DataFrame, channel: str, section: str, kind: str) -> DataFrame:
    """entity, family, rule and namespace of records of personal pages; null entity: held for review.

    Production is a work unless its type says otherwise; the other channels take only types of their own.
    """
    out = with_catalogue(rows, catalogue, F.col(section), F.col(kind))
    thesis = F.try_element_at(_table(THESES), F.regexp_extract(exact_key(F.col(kind)), r"^trabajos dirigidos/tutorías - (.*)$", 1))
    made, entity, produced = F.col(channel) == "production", F.col("catalogue_entity"), F.col(channel) == F.col("catalogue_entity")
    special = made & entity.isNotNull() & (entity != "works")
    target = F.when(made & thesis.isNotNull(), "works").when(special, entity).when(made, "works").when(produced, entity)
    singular = F.regexp_replace(target, "s$", "")
    family = F.when(made & thesis.isNotNull(), thesis).when(made & ~special, "work").otherwise(singular)
    rule = F.when(made & thesis.isNotNull(), "exact_thesis_type").when(special, "exact_specialised_type").when(made, "production_channel").when(produced, F.concat(F.lit("exact_"), singular, F.lit("_type")))
    return out.withColumn("entity", target).withColumn("family", F.when(target.isNotNull(), family)).withColumn("rule", rule).withColumn("namespace", F.when(target == "patents", "patent"))


def route_group(rows: DataFrame, catalogue: DataFrame, section: str, kind: str) -> DataFrame:
    """entity, family, rule and namespace of records of group pages; unknown types of special sections are held."""
    out = with_catalogue(rows, catalogue, F.col(section), F.col(kind))
    where, what = exact_key(F.col(section)), exact_key(F.coalesce(F.col(kind), F.lit("")))
    directed = where.isin("trabajos dirigidos/turorías", "trabajos dirigidos/tutorías")
    thesis = F.when(directed, F.try_element_at(_table(THESES), what))
    own = F.when(where == "proyectos", "projects").when(where == "eventos científicos", "events")
    pair = F.concat_ws("|", where, what)
    owned = F.try_element_at(_table({"|".join(k): e for k, (e, _) in PROPERTY.items()}), pair)
    namespace = F.try_element_at(_table({"|".join(k): n for k, (_, n) in PROPERTY.items()}), pair)
    held = where.isin(*sorted({s for s, _ in PROPERTY})) & owned.isNull()
    entity = F.col("catalogue_entity")
    target = F.when(directed, "works").when(own.isNotNull(), F.when(entity == own, own)).when(owned.isNotNull(), owned).when(~F.coalesce(held, F.lit(False)), F.coalesce(entity, F.lit("works")))
    family = F.when(thesis.isNotNull(), thesis).when((target == "patents") & owned.isNotNull(), "intellectual_property").when(target == "works", "work").otherwise(F.regexp_replace(target, "s$", ""))
    rule = F.when(thesis.isNotNull(), "exact_thesis_type").when(directed, "directed_work_section").when(own.isNotNull(), F.concat(F.lit("exact_"), F.regexp_replace(own, "s$", ""), F.lit("_type")))
    rule = rule.when(owned == "patents", "exact_patent_property").when(owned == "works", "exact_work_property").otherwise("production_section")
    return out.withColumn("entity", target).withColumn("family", F.when(target.isNotNull(), family)).withColumn("rule", F.when(target.isNotNull(), rule)).withColumn("namespace", F.when(target.isNotNull(), namespace))


def merged_catalogue(shared: DataFrame, observed: DataFrame) -> DataFrame:
    """The shared catalogue's entries with what was observed of them: parent, type, entity, target, status, frequency.

    The shared one owns assignments: observed entries that it lacks are left out, and a target that it
    changes, or that nobody approved, is approved by it.
    """
    key = lambda df, tag: df.withColumn(f"__p{tag}", label_key(F.col("parent"), LABEL_ALIASES)).withColumn(f"__t{tag}", label_key(F.col("type"), LABEL_ALIASES))
    a, b = key(shared, "a").alias("a"), key(observed, "b").alias("b")
    joined = a.join(b, (F.col("__pa") == F.col("__pb")) & (F.col("__ta") == F.col("__tb")), "left")
    same = F.col("a.entity").eqNullSafe(F.col("b.entity")) & F.col("a.target").eqNullSafe(F.col("b.target")) & F.coalesce(F.col("b.status"), F.lit("")).isin("inherited", "approved")
    return joined.select("a.parent", "a.type", "a.entity", "a.target", F.when(same, F.col("b.status")).otherwise("approved").alias("status"), F.coalesce("b.frequency", F.lit(0)).alias("frequency"))


def checked_types(entries: DataFrame, catalogue: DataFrame, entity: str) -> DataFrame:
    """Type entries (doc, place, source, type, parent) with the reason why one is refused; null: accepted.

    Labels of the target vocabulary must belong to the entity; native labels must be in the catalogue.
    """
    blank = F.coalesce(F.trim("source"), F.lit("")).isin("") | F.coalesce(F.trim("type"), F.lit("")).isin("")
    targets = catalogue.select(label_key(F.col("target"), LABEL_ALIASES).alias("__y"), F.col("entity").alias("__ye")).distinct()
    targets = targets.groupBy("__y").agg(F.collect_set("__ye").alias("__of"))
    native = with_catalogue(entries, catalogue, F.col("parent"), F.col("type"))
    out = native.withColumn("__y", label_key(F.coalesce("type", F.lit("")), LABEL_ALIASES)).join(F.broadcast(targets) if catalogue.count() <= BROADCAST_ROWS else targets, "__y", "left")
    target = F.col("source") == "target"
    reason = (
        F.when(blank, "invalid_type_shape")
        .when(target & F.col("__of").isNull(), "unmapped_target_type")
        .when(target & ~F.array_contains("__of", F.lit(entity)), "type_belongs_to_other_entity")
        .when(~target & F.col("catalogue_entity").isNull(), "unmapped_native_type")
        .when(~target & (F.col("catalogue_entity") != entity), "type_belongs_to_other_entity")
    )
    return out.select("doc", "place", "source", "type", "parent", reason.alias("reason"))


def materialized_types(entries: DataFrame, catalogue: DataFrame, entity: str) -> DataFrame:
    """Each document's accepted types in order without repeats, and its distinct findings; doing it twice changes nothing."""
    checked = checked_types(entries, catalogue, entity)
    good = F.when(F.col("reason").isNull(), F.struct("place", F.concat_ws(":", "source", "type").alias("t")))
    bad = F.when(F.col("reason").isNotNull(), F.concat_ws(":", "reason", F.coalesce("type", F.lit(""))))
    out = checked.groupBy("doc").agg(F.sort_array(F.collect_list(good)).alias("g"), F.sort_array(F.collect_set(bad)).alias("findings"), F.count_if(F.col("reason").isNotNull()).alias("refused"))
    return out.select("doc", F.array_distinct(F.transform("g", lambda x: x["t"])).alias("types"), "findings", "refused")


def type_anomalies(entries: DataFrame, catalogue: DataFrame, entity: str) -> DataFrame:
    """Findings of each document, and one more if its accepted types differ from what it has."""
    made = materialized_types(entries, catalogue, entity)
    had = entries.groupBy("doc").agg(F.count(F.lit(1)).alias("had"))
    return made.join(had, "doc").select("doc", (F.col("refused") + (F.size("types") != F.col("had")).cast("int")).cast("long").alias("anomalies"))


def consolidated(entries: DataFrame) -> DataFrame:
    """Entries (parent, type, source, frequency) merged by label keys: frequency, frequency by source, variants, and id.

    Aliases only move counts between spellings: the total stays, which ``same_total`` proves.
    """
    rows = entries.select(label_key(F.col("parent"), LABEL_ALIASES).alias("p"), label_key(F.col("type"), LABEL_ALIASES).alias("t"), "parent", "type", "source", "frequency")
    by_source = rows.groupBy("p", "t", "source").agg(F.sum("frequency").alias("n"))
    sources = by_source.groupBy("p", "t").agg(F.array_join(F.sort_array(F.collect_list(F.concat_ws("=", "source", "n"))), "|").alias("sources"))
    out = rows.groupBy("p", "t").agg(F.sum("frequency").alias("frequency"), F.count_distinct("parent", "type").alias("variants"))
    return out.join(sources, ["p", "t"]).select(F.col("p").alias("parent"), F.col("t").alias("type"), observation_id(F.col("p"), F.col("t")).alias("id"), "frequency", "variants", "sources")


def same_total(a: DataFrame, b: DataFrame, column: str = "frequency") -> bool:
    total = lambda df: df.agg(F.coalesce(F.sum(column), F.lit(0))).first()[0]
    return total(a) == total(b)


REVIEW = "id string, parent string, type string, entity string, target string, status string, reviewer string"


def export_review(entries: DataFrame, path: str) -> None:
    """A sheet for reviewers: one delimited file in the folder ``path``; a catalogue is small by contract."""
    columns = [c.split()[0] for c in REVIEW.split(", ")]
    entries.select(*columns).coalesce(1).write.mode("overwrite").option("header", True).option("quoteAll", True).csv(path)


def import_review(spark: SparkSession, path: str, original: DataFrame, entities: list[str]) -> DataFrame:
    """A reviewed sheet against the entries it was made of: id, change, and problem (null: it may be taken over).

    Everything that a reviewer must not do is a problem: unknown or missing rows, changed labels,
    entities that do not exist, and assignments without a name behind them.
    """
    new = spark.read.schema(REVIEW).option("header", True).option("mode", "FAILFAST").csv(path).alias("n")
    old = original.alias("o")
    joined = old.join(new, F.col("o.id") == F.col("n.id"), "full_outer")
    blank = lambda x: F.coalesce(F.col(x), F.lit(""))
    same = (blank("o.entity") == blank("n.entity")) & (blank("o.target") == blank("n.target")) & (blank("o.status") == blank("n.status"))
    problem = (
        F.when(F.col("o.id").isNull(), "unknown_row").when(F.col("n.id").isNull(), "missing_row")
        .when((blank("o.parent") != blank("n.parent")) | (blank("o.type") != blank("n.type")), "changed_label")
        .when(~same & (blank("n.reviewer") == ""), "no_reviewer")
        .when((blank("n.status") == "approved") & ~blank("n.entity").isin(*entities), "unknown_entity")
    )
    change = F.when(F.col("o.id").isNull() | F.col("n.id").isNull(), "row").when(same, "none").otherwise("assignment")
    return joined.select(F.coalesce("o.id", "n.id").alias("id"), change.alias("change"), problem.alias("problem"))
