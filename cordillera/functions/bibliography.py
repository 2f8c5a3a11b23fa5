"""Accept-or-blank validators and controlled vocabularies of bibliographic fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse_spaces, norm_text, strip_punctuation

#: Texts that mean "nothing was entered".
EMPTY_VALUES = ("", "na", "n/a", "no aplica", "no registra", "sin informacion", "null", "none", "-", "--", "0")
#: Declared languages and their ISO 639-1 codes.
LANGUAGES = {
    "espanol": "es", "castellano": "es", "spanish": "es", "ingles": "en", "english": "en", "portugues": "pt", "portuguese": "pt",
    "frances": "fr", "french": "fr", "aleman": "de", "german": "de", "italiano": "it", "italian": "it",
}
#: Words that mark a publishing body.
PUBLISHER_MARKS = ("universidad", "university", "editorial", "ediciones", "press", "instituto", "fundacion", "academia", "sociedad", "publishing")
#: Vocabularies by normal text.
SEXES = {"masculino": "male", "hombre": "male", "m": "male", "femenino": "female", "mujer": "female", "f": "female"}
DOCUMENT_KINDS = {"cc": "CC", "cedula": "CC", "cedula de ciudadania": "CC", "ce": "CE", "cedula de extranjeria": "CE", "pa": "PA", "pasaporte": "PA"}
EVENT_KINDS = ("congreso", "seminario", "simposio", "taller", "encuentro", "foro", "conferencia", "otro")


def lookup(key: Column, table: dict[str, str]) -> Column:
    """A vocabulary's value, or null."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def clean_value(x: Column, longest: int = 300) -> Column:
    """A field's text, or null if it is a placeholder or too long to be a value."""
    value = strip_punctuation(x)
    return F.when(~norm_text(x).isin(*EMPTY_VALUES) & (F.length(value) <= longest) & (value != ""), value)


def clean_pages(x: Column) -> Column:
    """``a`` or ``a-b`` with b not below a, numbers of any length; null otherwise."""
    form = r"^(\d+)(?:[-–](\d+))?$"
    digits = F.regexp_extract(F.regexp_replace(x, r"\s|pp?\.?", ""), form, 0)
    size = lambda k: F.regexp_replace(F.regexp_extract(digits, form, k), "^0+", "")
    start, end = (F.struct(F.length(size(k)), size(k)) for k in (1, 2))
    good = (digits != "") & ((F.regexp_extract(digits, form, 2) == "") | (end >= start))
    return F.when(good, F.regexp_replace(digits, "–", "-"))


def page_range(x: Column) -> Column:
    """struct(start, end) of ``a`` or ``a-b``."""
    part = lambda k: F.when(F.regexp_extract(x, r"^\s*(\d+)\s*(?:[-–]\s*(\d+))?\s*$", k) != "", F.regexp_extract(x, r"^\s*(\d+)\s*(?:[-–]\s*(\d+))?\s*$", k).cast("int"))
    return F.struct(part(1).alias("start"), part(2).alias("end"))


def language_code(x: Column) -> Column:
    return lookup(norm_text(x), LANGUAGES)


def sex(x: Column) -> Column:
    return lookup(norm_text(x), SEXES)


def document_kind(x: Column) -> Column:
    return lookup(F.regexp_replace(norm_text(x), r"\.", ""), DOCUMENT_KINDS)


def event_kind(x: Column) -> Column:
    """The last declaration of a text, if it is a known kind of event."""
    last = norm_text(F.element_at(F.split(x, ":"), -1))
    return F.when(last.isin(*EVENT_KINDS), last)


def looks_like_publisher(x: Column) -> Column:
    words = F.split(norm_text(x), " ")
    return F.arrays_overlap(words, F.array(*[F.lit(m) for m in PUBLISHER_MARKS])) & (F.length(x) <= 120)


def suspicious_publisher(x: Column) -> Column:
    """Labels, addresses or sentences where a name should be."""
    return F.coalesce(x.rlike(r"(?i)\b(issn|isbn|doi|vol|pp)\b|https?://|@|:") | (F.size(F.split(collapse_spaces(x), " ")) > 15), F.lit(False))


def publisher_entities(x: Column) -> Column:
    """array of struct(name, confidence): one body, or two parted by a spaced slash or a semicolon if both look like one."""
    parts = F.filter(F.transform(F.split(x, r"\s+/\s+|\s*;\s*"), lambda t: strip_punctuation(t)), lambda t: t != "")
    two = (F.size(parts) == 2) & F.forall(parts, looks_like_publisher)
    body = lambda conf: lambda t: F.struct(t.alias("name"), F.lit(conf).alias("confidence"))
    one = F.array(F.struct(strip_punctuation(x).alias("name"), F.lit("high").alias("confidence")))
    return F.when(two, F.transform(parts, body("medium"))).when((F.size(parts) == 1) & ~suspicious_publisher(x), one)


def terms(x: Column) -> Column:
    """Keywords between commas or semicolons, ordered, without repeats."""
    return F.array_distinct(F.filter(F.transform(F.split(x, "[,;]"), lambda t: strip_punctuation(t)), lambda t: t != ""))


def areas(x: Column) -> Column:
    """Paths of areas: areas between commas, their levels between double dashes."""
    paths = F.filter(F.split(x, ","), lambda t: F.trim(t) != "")
    return F.transform(paths, lambda p: F.filter(F.transform(F.split(p, "--"), lambda t: F.trim(t)), lambda t: t != ""))


def labelled_fields(x: Column, labels: list[str]) -> Column:
    """map of the labels that occur to the text up to the next label."""
    any_label = "|".join(labels)
    pairs = [F.struct(F.lit(name).alias("key"), F.trim(F.regexp_extract(x, rf"(?is)\b{name}\s*:\s*(.*?)\s*(?=(?:\b(?:{any_label})\s*:)|$)", 1)).alias("value")) for name in labels]
    return F.map_from_entries(F.filter(F.array(*pairs), lambda s: s["value"] != ""))


def issue_context(x: Column) -> Column:
    """struct(volume, issue, issn) of a reference's text."""
    part = lambda pattern: F.nullif(F.regexp_extract(x, pattern, 1), F.lit(""))
    return F.struct(part(r"(?i)\bv(?:ol)?\.?\s*(\d+)").alias("volume"), part(r"(?i)\bn(?:o|um)?\.?\s*(\d+)").alias("issue"), part(r"\b(\d{4}-\d{3}[\dXx])\b").alias("issn"))
