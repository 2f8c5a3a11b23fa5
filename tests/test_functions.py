"""Column expressions on literal values."""

import datetime as dt
import unicodedata

import pytest
from pyspark.sql import functions as F

from cordillera.functions import bibliography, dates, identifiers, text


def values(spark, f, inputs, kind="string"):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r["y"] for r in rows.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


CASES = [
    (text.norm_text, {" Ñandú  ÁÉ  x ": "nandu ae x", None: None, "": ""}),
    (text.normalize_title, {"¡El Niño: (2) años!": "el nino 2 anos", "---": ""}),
    (text.exact_key, {"  Árbol  Genealógico ": "árbol genealógico"}),
    (text.strip_punctuation, {" ,.a;b.- ": "a;b"}),
    (text.name_token_key, {"Pérez  Juan A": "juan perez", "Ana Ana": "ana ana"}),
    (text.is_generic_title, {"introduccion": True, "a study of the effects of long rain": False, "of an on in at by we it is": True}),
    (text.is_placeholder, {"Sin Título": True, "Titulo": False}),
    (text.all_caps_to_title, {"JUAN de la CRUZ.": "Juan de la Cruz", "O'Neil": "O'Neil"}),
    (text.yes_no, {"Sí": "Si", "NO": "No", "tal vez": None}),
    (text.rank_label, {"A1 desde 2020": "A1", "00": "Reconocido", "AB": None, "b": "B"}),
    (text.stable_id, {"x": "2d711642b726b04401627ca9"}),
    (identifiers.canonical_doi, {"doi: 10.1234/AbC.5.": "https://doi.org/10.1234/abc.5", "http://dx.doi.org/10.1/x": None, "none": None}),
    (identifiers.is_identity_doi, {"10.1234/abcdef1": True, "10.1234/abc": False, "10.1234/issn.0001-2222": False, "10.0000/abcdef1": False, "10.1234/abcdefg": False, "": False}),
    (identifiers.valid_isbn, {"0-306-40615-2": "9780306406157", "978-0-306-40615-7": "9780306406157", "0-306-40615-3": None, "080442957X": "9780804429573", "x": None}),
    (identifiers.valid_issn, {"0378-5955": "0378-5955", "2434561X": "2434-561X", "0378-5956": None}),
    (identifiers.valid_orcid, {"https://orcid.org/0000-0002-1825-0097": "https://orcid.org/0000-0002-1825-0097", "0000-0002-1694-233X": "https://orcid.org/0000-0002-1694-233X", "0000-0002-1825-0098": None}),
    (identifiers.person_code, {"164771": "0000164771", "0": None, "12345678901": None, "x": None}),
    (identifiers.group_code, {"col0012345": "COL0012345", "COL12": None}),
    (identifiers.registration_key, {"CO-12.3": "CO123", "000": None, "abc": None}),
    (identifiers.canonical_url, {"http://a.org/b/?utm_source=x&y=1#z": "https://a.org/b/?y=1", "https://a.org/?utm_a=1": "https://a.org"}),
]


@pytest.mark.parametrize("function, cases", CASES, ids=[f.__name__ for f, _ in CASES])
def test_expressions(spark, function, cases):
    assert values(spark, function, list(cases)) == list(cases.values())


def test_accents_are_those_of_unicode(spark):
    letters = [chr(c) for c in range(0xC0, 0x180)]
    base = lambda x: "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))
    got = values(spark, text.strip_accents, letters)
    assert [g for g, x in zip(got, letters) if len(base(x)) == 1] == [base(x) for x in letters if len(base(x)) == 1]


def test_arrays_and_structs(spark):
    assert values(spark, lambda x: text.distinct_by_key(x, text.norm_text), [["Á", "a", "B", "b ", "Á"]], "array<string>") == [["Á", "B"]]
    assert values(spark, text.split_outside_parentheses, ["Uni A; Uni (B; C) | Uni D"]) == [["Uni A", "Uni (B; C)", "Uni D"]]
    names = values(spark, text.split_person_name, ["Juan Pérez", "Juan Pérez Gil", "Ana María Ruiz Paz", "Cher"])
    assert [(n["first_names"], n["last_names"], n["initials"]) for n in names] == [("Juan", "Pérez", "J"), ("Juan", "Pérez Gil", "J"), ("Ana María", "Ruiz Paz", "AM"), ("Cher", "", "C")]
    rows = spark.createDataFrame([("ab", "abc"), ("b", "a"), (None, "x"), ("", None)], "a string, b string")
    assert [r[0] for r in rows.select(text.prefer_text(F.col("a"), F.col("b"))).collect()] == ["abc", "b", "x", None]


def test_arrow_functions(spark):
    assert values(spark, text.unescaped, ["a &amp;amp; b\u0007", None]) == ["a & b", None]
    assert values(spark, text.folded, ["Straße  Ⅷ", None]) == ["strasse viii", None]
    rows = spark.createDataFrame([("tide", "diet"), ("diet", "tide")], "a string, b string")
    assert [r[0] for r in rows.select(text.sequence_ratio("a", "b")).collect()] == [0.25, 0.5]


def test_partial_dates(spark):
    got = values(spark, lambda x: dates.partial_date(x, "2026-01-01"), ["2020", "2020-02", "2020/02/29", "2021-02-29", "marzo de 2019", "2019 June", "2031", "1850", "", None, "13/2020", "foo 2020"])
    shown = [(g["year"], g["month"], g["day"], g["status"]) for g in got]
    bad = (None, None, None, "invalid")
    assert shown == [
        (2020, None, None, "valid"), (2020, 2, None, "valid"), (2020, 2, 29, "valid"), bad, (2019, 3, None, "valid"), (2019, 6, None, "valid"),
        bad, bad, (None, None, None, "missing"), (None, None, None, "missing"), bad, bad,
    ]


def test_date_relations(spark):
    d = "struct<year:int,month:int,day:int>"
    rows = spark.createDataFrame([((2020, None, None), (2020, 5, 1)), ((2020, 4, None), (2020, 5, 1)), ((2019, None, None), (2020, 1, None))], f"a {d}, b {d}")
    got = rows.select(dates.dates_compatible(F.col("a"), F.col("b")), dates.definitely_before(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(True, False), (False, True), (False, True)]


def test_membership(spark):
    rows = ["2010/3 - 2012/11", "2010/1 - Actual", "2010/13 - 2011/1", "2012/1 - 2011/1", "x"]
    got = values(spark, lambda x: dates.covers_year(dates.membership(x), F.lit(2011)), rows)
    assert got == [True, True, None, None, None]
    assert values(spark, lambda x: dates.covers_year(dates.membership(x), F.lit(2010)), rows[:2]) == [False, True]
    assert values(spark, dates.years_in, ["from 1999 to 2031, 2005"]) == [[1999, 2005]]
    assert values(spark, dates.local_epoch, [dt.date(2020, 1, 1)], "date") == [1577854800]


@pytest.mark.parametrize(
    "function, cases",
    [
        (bibliography.clean_value, {" ;Revista X. ": "Revista X", "No aplica": None, "": None}),
        (bibliography.clean_pages, {"pp. 12 - 15": "12-15", "15-12": None, "xii": None, "7": "7"}),
        (bibliography.language_code, {"Español": "es", "klingon": None}),
        (bibliography.sex, {"Mujer": "female", "x": None}),
        (bibliography.document_kind, {"C.C.": "CC", "Pasaporte": "PA", "z": None}),
        (bibliography.event_kind, {"Tipo: Congreso": "congreso", "fiesta": None}),
        (bibliography.suspicious_publisher, {"ISSN 1234": True, "Editorial Norma": False}),
        (bibliography.terms, {"a, b; a ,": ["a", "b"]}),
        (bibliography.areas, {"Ciencias -- Física, Artes": [["Ciencias", "Física"], ["Artes"]]}),
    ],
    ids=lambda x: getattr(x, "__name__", None),
)
def test_bibliographic_fields(spark, function, cases):
    assert values(spark, function, list(cases)) == list(cases.values())


def test_bibliographic_structures(spark):
    got = values(spark, bibliography.publisher_entities, ["Universidad A / Editorial B", "Norma", "http://x.org", "Casa / Perro"])
    assert [g and [(e["name"], e["confidence"]) for e in g] for g in got] == [[("Universidad A", "medium"), ("Editorial B", "medium")], [("Norma", "high")], None, None]
    fields = values(spark, lambda x: bibliography.labelled_fields(x, ["Editorial", "Lugar"]), ["Editorial: Norma S.A. Lugar: Cali"])
    assert fields == [{"Editorial": "Norma S.A.", "Lugar": "Cali"}]
    issue = values(spark, bibliography.issue_context, ["Rev X, ISSN 0378-5955 v. 12 n. 3"])[0]
    assert tuple(issue) == ("12", "3", "0378-5955")


def test_page_numbers_of_any_length(spark):
    inputs = ["1145070 - 1145088", "1145088-1145070", "999999-1000000", "00000000000000000012–13", "3-2", "12345678901234567890"]
    assert values(spark, bibliography.clean_pages, inputs) == ["1145070-1145088", None, "999999-1000000", "00000000000000000012-13", None, "12345678901234567890"]
