"""Literal cases: expressions over a handful of written rows, and the values that they must give."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bibliography, dates, identifiers, text
from ..operators import routing

QUERIES, ORACLE_SQL = {}, {}
_KINDS = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "boolean": "BOOLEAN", "double": "DOUBLE"}


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    return str(value) if isinstance(value, (int, float)) else "'" + value.replace("'", "''") + "'"


def cases(case: str, given: str, rows: list[tuple], wanted: str, values: list[tuple]):
    """Register a function of the rows (columns ``given``) that must give ``values`` (columns ``wanted``) in their order.

    Both begin with the case's number, n.
    """
    inputs = "n int, " + given
    outputs = [tuple(x.split()) for x in ("n int, " + wanted).split(", ")]  # name and kind; no session is there yet

    def add(f: Callable[[DataFrame], list[Column]]):
        def run(spark, d):
            df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], inputs)
            return df.select("n", *[c.cast(kind).alias(name) for c, (name, kind) in zip(f(df), outputs[1:])])

        run.__name__, run.__doc__ = case, f.__doc__
        QUERIES[case] = run
        body = ", ".join("(" + ", ".join(map(_literal, (k, *v))) + ")" for k, v in enumerate(values))
        casts = ", ".join(f'"{o}"::{_KINDS[kind]} AS "{o}"' for o, kind in outputs)
        names = ", ".join(f'"{o}"' for o, _ in outputs)
        ORACLE_SQL[case] = f"SELECT {casts} FROM (VALUES {body}) t({names})"
        return run

    return add


c = F.col


@cases("doi_cases", "x string", [
    ("10.1590/S0100-69162011000500012",), ("https://doi.org/10.1590/ABC.123456.",), ("doi: 10.1234/issn-1234",), ("10.0000/abc123",), ("10.1234/abcdefg",), ("not a doi",), (None,), ("http://dx.doi.org/10.1016/j.x.2010.01.001",), ("10.1234/1234-567X",), ("10.1234/ab?c=12345",),
], "canonical string, identity boolean, strict string", [
    ("https://doi.org/10.1590/s0100-69162011000500012", True, "https://doi.org/10.1590/s0100-69162011000500012"), ("https://doi.org/10.1590/abc.123456", True, "https://doi.org/10.1590/abc.123456."),
    ("https://doi.org/10.1234/issn-1234", False, "https://doi.org/10.1234/issn-1234"), ("https://doi.org/10.0000/abc123", False, None), ("https://doi.org/10.1234/abcdefg", False, "https://doi.org/10.1234/abcdefg"),
    (None, False, None), (None, False, None), ("https://doi.org/10.1016/j.x.2010.01.001", True, "https://doi.org/10.1016/j.x.2010.01.001"), ("https://doi.org/10.1234/1234-567x", False, "https://doi.org/10.1234/1234-567x"), ("https://doi.org/10.1234/ab?c=12345", False, None),
])
def _doi(df):
    """Canonical form, whether it identifies one work, and the strict form that repairs nothing."""
    return [identifiers.canonical_doi(c("x")), identifiers.is_identity_doi(c("x")), identifiers.strict_doi(c("x"))]


@cases("code_cases", "a string, b string", [
    ("0000000123", "45"), ("0000000000", "45"), ("123", "45"), ("0000000123", "12345678"), ("0000-0002-1825-0097", "AB-123"), ("https://orcid.org/0000-0002-1694-233X", "0000"), ("0000-0002-1825-0098", "x9"), ("0-306-40615-2", "no"), ("978-0-306-40615-7", None), ("1234567890123", "12-b"), ("0378-5955", "N12"),
], "pair string, orcid string, registration string, isbn string, strict_isbn string, issn string", [
    ("0000000123/45", None, None, None, None, None), (None, None, None, "9780000000002", None, None), (None, None, None, None, None, None), (None, None, "12345678", None, None, None),
    (None, "https://orcid.org/0000-0002-1825-0097", "AB123", None, None, None), (None, "https://orcid.org/0000-0002-1694-233X", None, None, None, None), (None, None, None, None, None, None),
    (None, None, None, "9780306406157", "9780306406157", None), (None, None, None, "9780306406157", "9780306406157", None), (None, None, "12B", None, None, None), (None, None, "N12", None, None, "0378-5955"),
])
def _codes(df):
    pair = identifiers.pair_codes(c("a"), c("b"))
    return [F.when(pair.isNotNull(), F.concat_ws("/", pair["person"], pair["product"])), identifiers.valid_orcid(c("a")), identifiers.registration_key(c("b")), identifiers.valid_isbn(c("a")), identifiers.strict_isbn(c("a")), identifiers.valid_issn(c("a"))]


@cases("profile_link_cases", "label string, url string", [
    ("ORCID", "https://orcid.org/0000-0002-1825-0097"), ("Scopus", "https://www.scopus.com/authid/detail.uri?authorId=57190000001"), ("Scopus", "https://www.scopus.com/authid/detail.uri?authorId=00000000"),
    ("Google Scholar", "https://scholar.google.com/citations?user=abcDEF12_-&hl=es"), ("LinkedIn", "https://linkedin.com/in/x"), ("Blog", "https://example.org/x"), ("ORCID", "https://orcid.org/0000-0002-1825-0098"),
], "source string, id string", [
    ("orcid", "https://orcid.org/0000-0002-1825-0097"), ("scopus", "https://www.scopus.com/authid/detail.uri?authorId=57190000001"), (None, None),
    ("scholar", "https://scholar.google.com/citations?user=abcDEF12_-"), ("linkedin", "https://linkedin.com/in/x"), (None, None), (None, None),
])
def _links(df):
    found = identifiers.profile_link(c("label"), c("url"))
    return [found["source"], found["id"]]


@cases("name_cases", "x string", [("JUAN  PEREZ. gomez",), ("ana o'neil de-la cruz",), ("Ana",), ("Luis Gil",), ("Luis Gil Paz",), ("Ana María de los Ríos Paz",)], "clean string, title_case string, first string, last string, initials string, tokens string", [
    ("Juan Perez gomez", "Juan Perez. Gomez", "JUAN", "PEREZ. gomez", "J", "gomez|juan|perez"), ("ana o'neil de-la cruz", "Ana O'Neil De-La Cruz", "ana o'neil", "de-la cruz", "AO", "ana|cruz|neil"), ("Ana", "Ana", "Ana", "", "A", "ana"), ("Luis Gil", "Luis Gil", "Luis", "Gil", "L", "gil|luis"),
    ("Luis Gil Paz", "Luis Gil Paz", "Luis", "Gil Paz", "L", "gil|luis|paz"), ("Ana María de los Ríos Paz", "Ana María De Los Ríos Paz", "Ana María de los", "Ríos Paz", "AMDL", "ana|maria|paz|rios"),
])
def _names(df):
    parts = text.split_person_name(c("x"))
    return [text.all_caps_to_title(c("x")), text.letter_runs_capitalised(c("x")), parts["first_names"], parts["last_names"], parts["initials"], F.array_join(F.array_sort(text.name_tokens(c("x"))), "|")]


@cases("normaliser_cases", "x string", [("&Aacute;rbol&nbsp; Alto",), ("Ｆｕｌｌ ＷＩＤＴＨ",), ("Ñandú -- ñ 12",), ("北京 Paper",), ("“Grupo A”",), ("No registra",), ("  x ,.;",)], "norm string, folded string, ascii string, title string, unquoted string, value string, stripped string", [
    ("arbol alto", "&aacute;rbol&nbsp; alto", "aacute rbol nbsp alto", "aacute rbol nbsp alto", "&Aacute;rbol&nbsp; Alto", "&Aacute;rbol&nbsp; Alto", "&Aacute;rbol&nbsp; Alto"),
    ("full width", "full width", "", "ｆｕｌｌ ｗｉｄｔｈ", "Ｆｕｌｌ ＷＩＤＴＨ", "Ｆｕｌｌ ＷＩＤＴＨ", "Ｆｕｌｌ ＷＩＤＴＨ"),
    ("nandu -- n 12", "ñandú -- ñ 12", "nandu n 12", "nandu n 12", "Ñandú -- ñ 12", "Ñandú -- ñ 12", "Ñandú -- ñ 12"), ("北京 paper", "北京 paper", "paper", "北京 paper", "北京 Paper", "北京 Paper", "北京 Paper"),
    ("“grupo a”", "“grupo a”", "grupo a", "grupo a", "Grupo A", "“Grupo A”", "“Grupo A”"), ("no registra", "no registra", "no registra", "no registra", "No registra", None, "No registra"), ("x ,.;", "x ,.;", "x", "x", "x ,.;", "x ,.;", "x"),
])
def _normalisers(df):
    """Normalisers that look alike and differ in entities, scripts, accents and marks."""
    return [text.html_norm_text(c("x")), text.folded(c("x")), text.ascii_key(c("x")), text.unicode_title_key(c("x")), text.unquoted(c("x")), text.null_token_blank(c("x")), text.strip_punctuation(c("x"))]


@cases("product_text_cases", "x string", [("A &amp;amp;amp; B",), ("café\u0001 x",), ("Sin título",), ("",), ("n/a",)], "clean string, placeholder boolean", [("A & B", False), ("café x", False), ("Sin título", True), ("", False), ("n/a", True)])
def _product_text(df):
    return [text.unescaped(c("x")), text.is_placeholder(text.unescaped(c("x")))]


@cases("repeated_title_cases", "a string, b string", [
    ("Estudio de la flora del norte de Boyaca", "Estudio de la flora del norte de Boyacá"), ("Ana Paz", "Ana Paz"), ("Un texto de seis palabras o más que no es", "Otra cosa muy distinta del todo"), (None, "x"),
], "repeated boolean", [(True,), (False,), (False,), (False,)])
def _repeated(df):
    return [text.is_repeated_title(c("a"), c("b"))]


@cases("fragment_cases", "x string", [("investi-|gador|senior",), ("Univ -|Nacional",), ("A-|Z",), ("||x",), ("auto-|2",), ("",)], "joined string", [("investigador senior",), ("Univ - Nacional",), ("A- Z",), ("x",), ("auto- 2",), ("",)])
def _fragments(df):
    return [text.joined_fragments(F.split("x", r"\|"))]


@cases("institution_cases", "x string", [("A; B | C (D; E); F [G|H]",), ("Solo",), (" ; ",)], "parts string", [("A/B/C (D; E)/F [G|H]",), ("Solo",), ("",)])
def _institutions(df):
    return [F.array_join(text.split_outside_parentheses(c("x")), "/")]


@cases("distinct_cases", "x string", [("Águila|aguila|Zorro|zorro |Oso",), ("",), ("a|b|a",)], "by_key string, in_order string", [("Águila|Zorro|Oso", "Águila|aguila|Zorro|zorro |Oso"), ("", ""), ("a|b", "a|b")])
def _distinct(df):
    """First of each accent-insensitive key, and first of each value."""
    values = F.split("x", r"\|")
    return [F.array_join(text.distinct_by_key(values, text.norm_text), "|"), F.array_join(text.distinct_by_key(values, lambda v: v), "|")]


@cases("family_cases", "x string", [("Artículo de revista",), ("Capítulo de libro",), ("Trabajos dirigidos/Tutorías - Tesis",), ("Mapa",), ("",), (None,)], "family string", [("article",), ("book_chapter",), ("directed_work",), ("mapa",), ("unknown",), ("unknown",)])
def _families(df):
    return [text.type_family(c("x"), text.FAMILIES)]


@cases("vocabulary_cases", "x string", [("Sí",), ("NO",), ("Masculino",), ("Cédula de Ciudadanía",), ("A1",), ("00",), ("B x",), ("Español",), ("Tipo: Congreso",), ("klingon",)], "yes_no string, sex string, document string, rank string, language string, event string", [
    ("Si", None, None, None, None, None), ("No", None, None, None, None, None), (None, "male", None, None, None, None), (None, None, "CC", None, None, None), (None, None, None, "A1", None, None), (None, None, None, "Reconocido", None, None), (None, None, None, "B", None, None), (None, None, None, None, "es", None), (None, None, None, None, None, "congreso"), (None, None, None, None, None, None),
])
def _vocabularies(df):
    return [text.yes_no(c("x")), bibliography.sex(c("x")), bibliography.document_kind(c("x")), text.rank_label(c("x")), bibliography.language_code(c("x")), bibliography.event_kind(c("x"))]


@cases("bibliographic_cases", "x string", [("Universidad A / Editorial B",), ("Uno; Dos; tres, Uno",), ("Ciencias -- Física -- Óptica, Artes",), ("vol. 3 no. 4 ISSN 0378-5955",), ("Editorial: Casa X Idioma: Inglés",), ("12-20",), ("no aplica",)], "publishers string, terms string, areas string, issue string, fields string, pages string, value string", [
    ("Universidad A:medium|Editorial B:medium", "Universidad A / Editorial B", "Universidad A / Editorial B", "//", "", None, "Universidad A / Editorial B"), (None, "Uno|Dos|tres", "Uno; Dos; tres;Uno", "//", "", None, "Uno; Dos; tres, Uno"),
    ("Ciencias -- Física -- Óptica, Artes:high", "Ciencias -- Física -- Óptica|Artes", "Ciencias>Física>Óptica;Artes", "//", "", None, "Ciencias -- Física -- Óptica, Artes"),
    (None, "vol. 3 no. 4 ISSN 0378-5955", "vol. 3 no. 4 ISSN 0378-5955", "3/4/0378-5955", "", None, "vol. 3 no. 4 ISSN 0378-5955"), (None, "Editorial: Casa X Idioma: Inglés", "Editorial: Casa X Idioma: Inglés", "//", "Editorial=Casa X|Idioma=Inglés", None, "Editorial: Casa X Idioma: Inglés"),
    ("12-20:high", "12-20", "12-20", "//", "", "12-20", "12-20"), ("no aplica:high", "no aplica", "no aplica", "//", "", None, None),
])
def _bibliographic(df):
    issue = bibliography.issue_context(c("x"))
    fields = F.transform(F.map_entries(bibliography.labelled_fields(c("x"), ["Editorial", "Idioma"])), lambda e: F.concat_ws("=", e["key"], e["value"]))
    areas = F.transform(bibliography.areas(c("x")), lambda p: F.array_join(p, ">"))
    publishers = F.transform(bibliography.publisher_entities(c("x")), lambda p: F.concat_ws(":", p["name"], p["confidence"]))
    said = F.concat(*[x if isinstance(x, Column) else F.lit(x) for x in (F.coalesce(issue["volume"], F.lit("")), "/", F.coalesce(issue["issue"], F.lit("")), "/", F.coalesce(issue["issn"], F.lit("")))])
    return [F.array_join(publishers, "|"), F.array_join(bibliography.terms(c("x")), "|"), F.array_join(areas, ";"), said, F.array_join(fields, "|"), bibliography.clean_pages(c("x")), bibliography.clean_value(c("x"))]


@cases("date_cases", "x string", [("2020-05-03",), ("2020/5",), ("mayo 2020",), ("2020 May",), ("1999",), ("1850",), ("2020-02-31",), ("2031-01-01",), ("en curso",), ("",), ("foo 2020",), ("2020-01-01T00:00:00.000",)], "year int, month int, day int, precision string, status string", [
    (2020, 5, 3, "day", "valid"), (2020, 5, None, "month", "valid"), (2020, 5, None, "month", "valid"), (2020, 5, None, "month", "valid"), (1999, None, None, "year", "valid"), (None, None, None, None, "invalid"),
    (None, None, None, None, "invalid"), (None, None, None, None, "invalid"), (None, None, None, None, "open"), (None, None, None, None, "missing"), (None, None, None, None, "invalid"), (2020, 1, 1, "day", "valid"),
])
def _dates(df):
    d = dates.partial_or_open(c("x"), "2024-01-01")
    return [d[f] for f in ("year", "month", "day", "precision", "status")]


@cases("date_pair_cases", "a string, b string", [("2020", "2020-05"), ("2020-05", "2020-06"), ("2020-05-03", "2020-05"), ("2020-06", "2020-05"), ("2020", "2019-12-31"), ("2020-05", "2020-05-01")], "compatible boolean, ends_before boolean", [(True, False), (False, False), (True, False), (False, True), (False, True), (True, False)])
def _pairs(df):
    a, b = (dates.partial_date(c(x), "2024-01-01") for x in "ab")
    return [dates.dates_compatible(a, b), dates.definitely_before(b, a)]


@cases("epoch_cases", "x string", [("2020-01-01",), ("2020-01-01T00:00:00.000",), ("2020-01-01T05:00:00Z",), ("2020-01-01T00:00:00-05:00",), ("x",), ("2020/1/1",)], "utc bigint, local bigint", [
    (1577836800, 1577854800), (1577836800, 1577854800), (1577854800, 1577872800), (1577854800, 1577872800), (None, None), (None, None),
])
def _epochs(df):
    """UTC seconds, and those of the same clock in the reference zone."""
    utc = dates.utc_epoch(c("x"))
    return [utc, dates.local_epoch(F.timestamp_seconds(utc))]


@cases("membership_cases", "x string", [("2001/3 - Actual",), ("2001/3 - 2005/2",), ("2001 - 2004",), ("nothing",)], "start bigint, end bigint", [(983404800, -1), (983404800, 1109548800), (978307200, 1104451200), (-1, -1)])
def _membership(df):
    m = dates.membership_epochs(c("x"))
    return [m["start"], m["end"]]


@cases("label_cases", "section string, kind string", [("Articulos", "Artículos publicados :"), ("Proyectos", "Investigación  y DESARROLLO"), ("X", 'A "b"')], "section_key string, kind_key string, id string", [
    ("artículo", "artículo", "a7f5c30c2902111766a51ca9"), ("proyecto", "investigación y desarrollo", "0eabf31eb736c73c1a16530d"), ("x", 'a "b"', "a66a221b8a7fc5e1bf336822"),
])
def _labels(df):
    keys = [text.label_key(c(x), routing.LABEL_ALIASES) for x in ("section", "kind")]
    return [*keys, text.observation_id(*keys)]


@cases("path_cases", "x string", [("GNC: Nuevo conocimiento ART: Artículo A1: Artículo A1",), ("Sin código",)], "parts string", [("Nuevo conocimiento/Artículo/Artículo A1",), ("Sin código",)])
def _paths(df):
    return [F.array_join(text.path_labels(c("x")), "/")]
