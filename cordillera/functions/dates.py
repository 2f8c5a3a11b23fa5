"""Partial dates, epochs and intervals as column expressions.

"Now" is always an argument, so that results do not depend on the day of the run.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "America/Bogota"
#: Month names in Spanish and English, and their numbers.
MONTHS = {
    "enero": 1, "febrero": 2, "marzo": 3, "abril": 4, "mayo": 5, "junio": 6, "julio": 7, "agosto": 8, "septiembre": 9, "octubre": 10, "noviembre": 11, "diciembre": 12,
    "january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6, "july": 7, "august": 8, "september": 9, "october": 10, "november": 11, "december": 12,
}


def bound(value: Column, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def month_number(name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair])
    return F.try_element_at(table, F.lower(name))


def local_epoch(date: Column) -> Column:
    """Seconds of midnight in the reference zone."""
    return F.unix_timestamp(F.to_utc_timestamp(date.cast("timestamp"), ZONE))


def partial_date(x: Column, as_of: str) -> Column:
    """struct(year, month, day, precision, status) of a text.

    Forms: YYYY, YYYY-MM, YYYY-MM-DD (also with / and with a time), and a month's
    name with a year in either order. status: missing, valid or invalid; dates before
    1901 or after ``as_of`` are invalid.
    """
    iso = r"^(\d{4})(?:[-/](\d{1,2})(?:[-/](\d{1,2})(?:[T ].*)?)?)?$"
    named, reverse = r"^([A-Za-z]+)[ ,]+(?:de )?(\d{4})$", r"^(\d{4})[ ,]+([A-Za-z]+)$"
    as_int = lambda c: F.when(c != "", c.cast("int"))

    def read(text: Column) -> Column:
        number = lambda pattern, k: F.regexp_extract(text, pattern, k)
        year = F.coalesce(as_int(number(iso, 1)), as_int(number(named, 2)), as_int(number(reverse, 1)))
        name = F.concat(number(named, 1), number(reverse, 2))
        month = F.coalesce(as_int(number(iso, 2)), month_number(name))
        return F.struct(year.alias("y"), month.alias("m"), as_int(number(iso, 3)).alias("d"), (F.coalesce(text, F.lit("")) == "").alias("none"), ((name != "") & month.isNull()).alias("wordy"))

    def judged(r: Column) -> Column:
        whole = F.try_to_date(F.format_string("%04d-%02d-%02d", r["y"], F.coalesce(r["m"], F.lit(1)), F.coalesce(r["d"], F.lit(1))), "yyyy-MM-dd")
        good = whole.isNotNull() & (r["y"] >= 1901) & (whole <= F.lit(as_of).cast("date")) & ~F.coalesce(r["wordy"], F.lit(False))
        return F.struct(r["y"].alias("y"), r["m"].alias("m"), r["d"].alias("d"), r["none"].alias("none"), F.coalesce(good, F.lit(False)).alias("good"))

    def said(r: Column) -> Column:
        precision = F.when(r["d"].isNotNull(), "day").when(r["m"].isNotNull(), "month").otherwise("year")
        status = F.when(r["none"], "missing").when(r["good"], "valid").otherwise("invalid")
        keep = lambda c: F.when(r["good"], c)
        return F.struct(keep(r["y"]).alias("year"), keep(r["m"]).alias("month"), keep(r["d"]).alias("day"), keep(precision).alias("precision"), status.alias("status"))

    return bound(bound(bound(F.trim(x), read), judged), said)


def dates_compatible(a: Column, b: Column) -> Column:
    """Two partial dates agree wherever both say something."""
    same = lambda f: a[f].isNull() | b[f].isNull() | (a[f] == b[f])
    return same("year") & same("month") & same("day")


def definitely_before(end: Column, start: Column) -> Column:
    """An interval's end lies before its start, whatever the missing parts are."""
    latest = F.coalesce(end["year"], F.lit(9999)) * 10_000 + F.coalesce(end["month"], F.lit(12)) * 100 + F.coalesce(end["day"], F.lit(31))
    earliest = F.coalesce(start["year"], F.lit(0)) * 10_000 + F.coalesce(start["month"], F.lit(1)) * 100 + F.coalesce(start["day"], F.lit(1))
    return latest < earliest


def month_index(year: Column, month: Column) -> Column:
    return year * 12 + month - 1


def membership(x: Column) -> Column:
    """struct(start, end) as month indices of ``YYYY/M - YYYY/M`` or ``... - Actual`` (end null); null if malformed."""
    form = r"^\s*(\d{4})/(\d{1,2})\s*-\s*(?:(\d{4})/(\d{1,2})|[Aa]ctual)\s*$"
    part = lambda k: F.when(F.regexp_extract(x, form, k) != "", F.regexp_extract(x, form, k).cast("int"))
    start, end = month_index(part(1), part(2)), month_index(part(3), part(4))
    good = x.rlike(form) & part(2).between(1, 12) & (part(4).isNull() | part(4).between(1, 12)) & (end.isNull() | (end >= start))
    return F.when(good, F.struct(start.alias("start"), end.alias("end")))


def covers_year(period: Column, year: Column) -> Column:
    """A membership holds from January to December of a year."""
    return (period["start"] <= month_index(year, F.lit(1))) & (period["end"].isNull() | (period["end"] >= month_index(year, F.lit(12))))


def years_in(x: Column, low: int = 1950, high: int = 2026) -> Column:
    """All plausible years of a text, in order."""
    found = F.transform(F.regexp_extract_all(x, F.lit(r"\b((?:19|20)\d{2})\b"), F.lit(1)), lambda y: y.cast("int"))
    return F.filter(found, lambda y: y.between(low, high))


def utc_epoch(x: Column) -> Column:
    """Seconds of an ISO date or time, UTC where it names no zone; null for anything else."""
    text = F.trim(x)
    iso = text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$")
    zone = F.when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & (F.length(text) > 10), F.lit("")).otherwise(F.when(F.length(text) > 10, F.lit("Z")).otherwise(F.lit("T00:00:00Z")))
    return F.when(iso, F.unix_timestamp(F.try_to_timestamp(F.concat(F.regexp_replace(text, " ", "T"), zone))))


def membership_epochs(x: Column) -> Column:
    """struct(start, end) in UTC seconds of ``YYYY[/M] - YYYY[/M]`` or ``- Actual``; months end with their last day; -1 says unknown."""
    form = r"(?i)(\d{4})(?:/(\d{1,2}))?\s*-\s*(?:(actual)|(\d{4})(?:/(\d{1,2}))?)"
    part = lambda k: F.nullif(F.regexp_extract(x, form, k), F.lit(""))
    number = lambda k, none: F.coalesce(part(k).cast("int"), F.lit(none))
    day = lambda y, m: F.make_date(y, m, F.lit(1))
    seconds = lambda date: F.unix_date(date).cast("long") * 86_400
    start = seconds(day(number(1, 1970), number(2, 1)))
    end = F.when(part(3).isNull(), seconds(F.last_day(day(number(4, 1970), number(5, 12)))))
    found = x.rlike(form)
    return F.struct(F.when(found, start).otherwise(-1).alias("start"), F.when(found, F.coalesce(end, F.lit(-1))).otherwise(-1).alias("end"))


def partial_or_open(x: Column, as_of: str, tokens: tuple[str, ...] = ("actual", "actualidad", "en curso", "en marcha", "presente", "vigente")) -> Column:
    """``partial_date`` with a fourth status: open, for words that say it goes on."""
    is_open = F.coalesce(F.lower(F.trim(x)).isin(*tokens), F.lit(False))
    return bound(partial_date(x, as_of), lambda d: F.struct(d["year"].alias("year"), d["month"].alias("month"), d["day"].alias("day"), d["precision"].alias("precision"), F.when(is_open, "open").otherwise(d["status"]).alias("status")))
