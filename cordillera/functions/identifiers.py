"""Identifiers: DOI, ISBN, ISSN, ORCID, profile and group codes, URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: what every canonical DOI begins with.
DOI_ROOT = "https://doi.org/"


def bare_doi(x: Column) -> Column:
    """Lower case, without scheme, resolver and surrounding punctuation."""
    trimmed = F.regexp_replace(F.trim(x), r"^[\s.,;:()\[\]]+|[\s.,;:()\[\]]+$", "")
    return F.lower(F.regexp_replace(trimmed, r"(?i)^(https?://(dx\.)?doi\.org/|doi:\s*)", ""))


def canonical_doi(x: Column) -> Column:
    """The DOI as a URL, or null if the text is not one DOI."""
    doi = bare_doi(x)
    return F.when(doi.rlike(r"^10\.\d{4,9}/\S+$"), F.concat(F.lit(DOI_ROOT), doi))


def is_identity_doi(x: Column) -> Column:
    """A DOI specific enough to identify one work."""
    doi = bare_doi(x)
    suffix = F.regexp_extract(doi, r"^10\.\d{4,9}/(.+)$", 1)
    specific = (F.length(suffix) >= 6) & suffix.rlike(r"\d") & ~suffix.rlike(r"[?#]|issn|xxx|\.pdf$|^\d{4}-\d{3}[\dx]$")
    return F.coalesce(specific & ~doi.startswith("10.0000/"), F.lit(False))


def digits_x(x: Column) -> Column:
    """Digits and a final X, nothing else."""
    return F.regexp_replace(F.upper(x), "[^0-9X]", "")


def _digit(x: Column, i: Column) -> Column:
    c = F.substring(x, i, F.lit(1)) if isinstance(i, int) else x.substr(i, F.lit(1))
    return F.when(c == "X", F.lit(10)).otherwise(c.cast("int"))


def weighted_sum(x: Column, n: int, weight) -> Column:
    """Sum of the first n digits times ``weight(position from 1)``."""
    return F.aggregate(F.sequence(F.lit(1), F.lit(n)), F.lit(0), lambda s, i: s + _digit(x, i) * weight(i))


def valid_isbn(x: Column) -> Column:
    """The 13-digit ISBN of a valid ISBN-10 or ISBN-13, else null."""
    d = digits_x(x)
    ten = d.rlike(r"^\d{9}[\dX]$") & (weighted_sum(d, 10, lambda i: 11 - i) % 11 == 0)
    weight = lambda i: F.when(i % 2 == 1, 1).otherwise(3)
    thirteen = d.rlike(r"^97[89]\d{10}$") & (weighted_sum(d, 13, weight) % 10 == 0)
    stem = F.concat(F.lit("978"), F.substring(d, 1, 9))
    check = (10 - weighted_sum(stem, 12, weight) % 10) % 10
    return F.when(thirteen, d).when(ten, F.concat(stem, check.cast("string")))


def valid_issn(x: Column) -> Column:
    """``NNNN-NNNX`` of a valid ISSN, else null."""
    d = digits_x(x)
    good = d.rlike(r"^\d{7}[\dX]$") & (weighted_sum(d, 8, lambda i: 9 - i) % 11 == 0)
    return F.when(good, F.concat_ws("-", F.substring(d, 1, 4), F.substring(d, 5, 4)))


def valid_orcid(x: Column) -> Column:
    """The ORCID URL if the ISO 7064 check digit holds, else null."""
    d = digits_x(F.regexp_extract(F.upper(x), r"((?:\d{4}-?){3}\d{3}[\dX])", 1))
    total = F.aggregate(F.sequence(F.lit(1), F.lit(15)), F.lit(0), lambda s, i: (s + _digit(d, i)) * 2 % 11)
    good = d.rlike(r"^\d{15}[\dX]$") & ((12 - total) % 11 == _digit(d, F.lit(16)))
    return F.when(good, F.concat(F.lit("https://orcid.org/"), F.regexp_replace(d, r"(.{4})(?=.)", "$1-")))


def person_code(x: Column) -> Column:
    """Ten digits, zero-filled, not all zero."""
    filled = F.lpad(F.trim(x.cast("string")), 10, "0")
    return F.when((F.length(F.trim(x.cast("string"))) <= 10) & filled.rlike(r"^\d{10}$") & (filled != "0000000000"), filled)


def group_code(x: Column) -> Column:
    code = F.upper(F.trim(x))
    return F.when(code.rlike(r"^COL\d{7}$"), code)


def registration_key(x: Column) -> Column:
    """A usable registration number: a digit, three word characters or more, no placeholder."""
    key = F.upper(F.regexp_replace(x, r"[^0-9A-Za-z]", ""))
    return F.when(key.rlike(r"\d") & (F.length(key) >= 3) & ~key.rlike(r"^0+$"), key)


def url_host(url: Column) -> Column:
    """Host in lower case, without port and user."""
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))


def url_parameter(url: Column, name: str) -> Column:
    """The first value of a query parameter, or the empty string."""
    return F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1)


def canonical_url(url: Column) -> Column:
    """Without fragment, tracking parameters, default scheme differences and final slash."""
    bare = F.regexp_replace(url, "#.*$", "")
    bare = F.regexp_replace(bare, r"([?&])utm_[^=&]*=[^&]*", "$1")
    bare = F.regexp_replace(F.regexp_replace(bare, "[?&]+$", ""), r"([?&])&+", "$1")
    return F.regexp_replace(F.regexp_replace(bare, r"^http://", "https://"), "/$", "")


def strict_doi(x: Column) -> Column:
    """A DOI as it should be written, never repaired: null for zero registrants, placeholders and query marks."""
    form = r"(?i)^(?:(?:https?://)?(?:dx\.)?doi\.org/|doi\s*:\s*)?(10\.([0-9]{4,9})/(\S+))$"
    part = lambda k: F.regexp_extract(F.trim(x), form, k)
    good = F.trim(x).rlike(form) & ~part(2).rlike("^0+$") & ~part(1).rlike(r"[?#\x00]") & ~part(3).rlike(r"(?i)^(?:0+|none|null|n/?a|sin[-_]?doi)$")
    return F.when(good, F.concat(F.lit(DOI_ROOT), F.lower(part(1))))


def strict_isbn(x: Column) -> Column:
    """An ISBN written with digits, X, spaces and hyphens only; 13 digits begin with 978 or 979."""
    return F.when(x.rlike(r"^[0-9Xx\s-]+$") & ~digits_x(x).rlike("^0+$"), valid_isbn(x))


def pair_codes(person: Column, product: Column) -> Column:
    """struct(person, product) of a valid pair of codes, else null."""
    good = person.rlike("^[0-9]{10}$") & (person != "0000000000") & product.rlike("^[0-9]{1,7}$")
    return F.when(good, F.struct(person.alias("person"), product.alias("product")))


def official_pair(pair: Column, products: Column) -> Column:
    """Whether an official product id ends in the pair's two codes."""
    tail = F.concat(F.lit("-"), pair["person"], F.lit("-"), pair["product"])
    return F.coalesce(F.exists(products, lambda p: p.endswith(tail)), F.lit(False))


#: Hosts of public profiles, and the query parameter and form of their ids.
PROFILE_HOSTS = {"scopus": ("scopus.com", "authorId", r"^\d{8,12}$", "https://www.scopus.com/authid/detail.uri?authorId="), "scholar": ("scholar.google", "user", r"^[A-Za-z0-9_-]{8,20}$", "https://scholar.google.com/citations?user=")}


def profile_link(label: Column, url: Column) -> Column:
    """struct(source, id) of a public profile that can be checked, else null."""
    name, host = F.lower(label), url_host(url)
    says = lambda word, where: F.contains(name, F.lit(word)) | F.contains(host, F.lit(where))
    out = F.when(says("orcid", "orcid.org"), F.struct(F.lit("orcid").alias("source"), valid_orcid(url).alias("id")))
    for source, (where, key, form, root) in PROFILE_HOSTS.items():
        own = url_parameter(url, key)
        out = out.when(says(source, where), F.struct(F.lit(source).alias("source"), F.when(own.rlike(form) & ~own.rlike("^0+$"), F.concat(F.lit(root), own)).alias("id")))
    for source in ("researchgate", "linkedin"):
        out = out.when(says(source, f"{source}.com" if source == "linkedin" else "researchgate.net"), F.struct(F.lit(source).alias("source"), F.when(url.rlike("(?i)^https?:"), url).alias("id")))
    return F.when(out["id"].isNotNull(), out)
