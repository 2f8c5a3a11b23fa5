"""Text normalisers and keys as column expressions.

There are several normalisers on purpose: rules that look alike differ in whether
accents, non-Latin letters or word order count.  All are built-in expressions, so
they stay inside whole-stage code generation; the exceptions are Arrow-batched
functions at the end.
"""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _accent_table() -> tuple[str, str]:
    """Latin letters whose compatibility decomposition is one base letter and marks."""
    source, target = [], []
    for code in range(0xC0, 0x250):
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if len(base) == 1 and base != chr(code):
            source.append(chr(code))
            target.append(base)
    return "".join(source), "".join(target)


ACCENTED, PLAIN = _accent_table()
#: Labels that stand for no title.
PLACEHOLDER_TITLES = ("sin titulo", "sin título", "no registra", "n/a", "na", "ninguno", "ninguna", "untitled", "-", ".")
#: Work families by the normal text of their type.
FAMILIES = {
    "articulo de revista": "article", "publicaciones editoriales no especializadas": "editorial", "libro": "book", "capitulo de libro": "book_chapter",
    "tesis de pregrado": "undergraduate_thesis", "tesis de posgrado": "graduate_thesis",
}
#: Particles that carry no identity in a name.
NAME_STOP_TOKENS = ("de", "del", "la", "las", "los", "y", "the", "and", "of")


def strip_accents(x: Column) -> Column:
    """Drop accents from Latin letters."""
    return F.translate(x, ACCENTED, PLAIN)


def collapse_spaces(x: Column) -> Column:
    """Runs of white space and no-break spaces become one space; none at the ends."""
    return F.trim(F.regexp_replace(F.translate(x, " ", " "), r"\s+", " "))


def norm_text(x: Column) -> Column:
    """No accents, lower case, single spaces."""
    return collapse_spaces(F.lower(strip_accents(x)))


def normalize_title(x: Column) -> Column:
    """ASCII letters and digits of the normal text, everything else one space."""
    return F.trim(F.regexp_replace(norm_text(x), "[^a-z0-9]+", " "))


def label_key(x: Column, aliases: dict[str, str]) -> Column:
    """The exact key of a label after its aliases: a final colon does not count."""
    bare = exact_key(F.regexp_replace(collapse_spaces(x), r"[ :]+$", ""))
    if not aliases:
        return bare
    table = F.create_map(*[F.lit(v) for pair in aliases.items() for v in pair])
    return F.coalesce(exact_key(F.try_element_at(table, bare)), bare)


def path_labels(x: Column) -> Column:
    """Labels of a coded hierarchy: what stands between ``CODE: `` marks."""
    return F.filter(F.transform(F.split(x, r"(?:^|\s)[A-Z0-9]+:\s+"), lambda t: F.trim(t)), lambda t: t != "")


def observation_id(section: Column, kind: Column) -> Column:
    """24 hexadecimal digits of a section's and a type's keys as a JSON pair."""
    quoted = lambda k: F.concat(F.lit('"'), F.regexp_replace(F.regexp_replace(k, r"\\", r"\\\\"), '"', r'\\"'), F.lit('"'))
    return stable_id(F.concat(F.lit("["), quoted(section), F.lit(", "), quoted(kind), F.lit("]")))


def exact_key(x: Column) -> Column:
    """Case and white space do not count, accents do."""
    return F.lower(collapse_spaces(x))


def strip_punctuation(x: Column) -> Column:
    """Spaces and ``,.;:-`` removed from both ends."""
    return F.regexp_replace(collapse_spaces(x), r"^[ ,.;:\-]+|[ ,.;:\-]+$", "")


def tokens(x: Column, longer_than: int) -> Column:
    """Tokens of a normal text that are longer than so many characters."""
    return F.filter(F.split(x, " "), lambda t: F.length(t) > longer_than)


def name_token_key(x: Column) -> Column:
    """Sorted tokens of two letters or more: word order does not count, repeats do."""
    return F.array_join(F.array_sort(tokens(normalize_title(x), 1)), " ")


def name_tokens(x: Column) -> Column:
    """The set of tokens of three letters or more, without particles."""
    return F.array_except(F.array_distinct(tokens(normalize_title(x), 2)), F.array(*[F.lit(t) for t in NAME_STOP_TOKENS]))


def is_generic_title(key: Column) -> Column:
    """Too little text to identify anything: under 20 characters, or under 4 tokens longer than 2."""
    return (F.length(key) < 20) | (F.size(tokens(key, 2)) < 4)


@F.pandas_udf(T.StringType())
def html_norm_text(values: pd.Series) -> pd.Series:
    """Entities resolved, no accents in any script, lower case, single spaces."""

    def one(x):
        if x is None:
            return None
        x = unicodedata.normalize("NFKD", html.unescape(x).replace("\xa0", " "))
        return " ".join("".join(c for c in x if not unicodedata.combining(c)).lower().split())

    return values.map(one, na_action=None)


def is_repeated_title(value: Column, title: Column, least: float = 0.85) -> Column:
    """A text of six tokens or more that is nearly the work's own title."""
    a, b = normalize_title(value), normalize_title(title)
    return F.coalesce((F.size(F.split(a, " ")) >= 6) & (b != "") & (sequence_ratio(a, b) >= least), F.lit(False))


def is_placeholder(x: Column) -> Column:
    return exact_key(x).isin(*PLACEHOLDER_TITLES)


def blank_to_null(x: Column) -> Column:
    return F.when(F.trim(x) != "", x)


def prefer_text(a: Column, b: Column) -> Column:
    """Of two spellings the longer, then the greater; a missing one gives way."""
    best = F.greatest(F.struct(F.length(a).alias("n"), a.alias("v")), F.struct(F.length(b).alias("n"), b.alias("v")))
    return F.when(F.coalesce(a, F.lit("")) == "", b).when(F.coalesce(b, F.lit("")) == "", a).otherwise(best["v"])


def prefer_value(a: Column, b: Column) -> Column:
    """Of two values that are no text, the first that is there."""
    return F.coalesce(a, b)


def distinct_by_key(values: Column, key) -> Column:
    """First value of each key, in order; ``key`` maps a column to a column."""
    keys = F.transform(values, key)
    return F.filter(values, lambda v, i: F.array_position(keys, F.element_at(keys, i + 1)) == i + 1)


def stable_hash(x: Column) -> Column:
    return F.sha2(x.cast("string"), 256)


def stable_id(x: Column) -> Column:
    """24 hexadecimal digits, the size of an object id."""
    return F.substring(stable_hash(x), 1, 24)


def stable_partition(x: Column, n: int) -> Column:
    """First 8 bytes of SHA-256, big-endian, modulo n."""
    head = F.conv(F.substring(stable_hash(x), 1, 16), 16, 10).cast("decimal(20,0)")
    return (head % F.lit(n).cast("decimal(20,0)")).cast("int")


def all_caps_to_title(x: Column) -> Column:
    """Words in capitals become capitalised; other words stay."""
    words = F.split(collapse_spaces(F.translate(x, ".", " ")), " ")
    return F.array_join(F.transform(words, lambda w: F.when((w == F.upper(w)) & (F.length(w) > 1), F.initcap(w)).otherwise(w)), " ")


def letter_runs_capitalised(x: Column) -> Column:
    """Each run of letters capitalised, also after apostrophes and hyphens."""
    runs = F.regexp_extract_all(F.lower(collapse_spaces(x)), F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.substring(r, 2, 1_000_000))), "")


def joined_fragments(parts: Column) -> Column:
    """Lines of a cell as one text: a hyphen that parts a word of two letters or more at a line's end goes."""

    def add(text: Column, part: Column) -> Column:
        last = F.regexp_extract(text, r"(\S*)$", 1)
        parted = last.rlike(r"^[^-].*\p{L}-$") & part.rlike(r"^\p{L}")
        joined = F.concat(F.regexp_replace(text, "-$", ""), part)
        return F.when(part == "", text).when(text == "", part).when(parted, joined).otherwise(F.concat_ws(" ", text, part))

    clean = F.transform(parts, lambda p: collapse_spaces(F.coalesce(p, F.lit(""))))
    return F.aggregate(clean, F.lit(""), add)


def type_family(x: Column, families: dict[str, str]) -> Column:
    """The family of a type label: listed, a directed work, or the label's normal text."""
    key = norm_text(x)
    table = F.create_map(*[F.lit(v) for pair in families.items() for v in pair])
    return F.coalesce(F.try_element_at(table, key), F.when(key.startswith("trabajos dirigidos/tutorias"), "directed_work"), F.nullif(key, F.lit("")), F.lit("unknown"))


def ascii_key(x: Column) -> Column:
    """ASCII letters and digits alone; other scripts vanish."""
    return F.trim(F.regexp_replace(F.lower(strip_accents(collapse_spaces(x))), "[^a-z0-9]+", " "))


def unicode_title_key(x: Column) -> Column:
    """Letters and digits of any script, everything else one space; accents do not count."""
    return F.trim(F.regexp_replace(norm_text(x), r"[^\p{L}\p{N}_]+", " "))


def unquoted(x: Column) -> Column:
    """A name without quotation marks around it."""
    return F.regexp_replace(collapse_spaces(x), "^[\"'\u201c\u201d ]+|[\"'\u201c\u201d ]+$", "")


def null_token_blank(x: Column, tokens: tuple[str, ...] = ("no registra", "no disponible", "null", "none", "n/a")) -> Column:
    """The text, or null where it says that there is none."""
    value = collapse_spaces(x)
    return F.when((value != "") & ~ascii_key(value).isin(*[t.replace("/", " ") for t in tokens]), value)


def split_person_name(x: Column) -> Column:
    """first and last names: the last two words are last names, of two or three words the last one or two."""
    w = F.filter(F.split(collapse_spaces(x), " "), lambda t: t != "")
    n = F.size(w)
    first = F.when(n <= 1, n).when(n == 2, F.lit(1)).when(n == 3, F.lit(1)).otherwise(n - 2)
    join = lambda a, k: F.array_join(F.slice(w, a, F.greatest(k, F.lit(0))), " ")
    initials = F.array_join(F.transform(F.slice(w, F.lit(1), F.greatest(first, F.lit(0))), lambda t: F.upper(F.substring(t, 1, 1))), "")
    return F.struct(join(F.lit(1), first).alias("first_names"), join(first + 1, n - first).alias("last_names"), initials.alias("initials"))


def split_outside_parentheses(x: Column) -> Column:
    """Parts between ``;`` or ``|`` that no bracket encloses (one level deep)."""
    marked = F.regexp_replace(x, r"[;|](?![^(\[]*[)\]])", "\u0001")
    return F.filter(F.transform(F.split(marked, "\u0001"), lambda t: F.trim(t)), lambda t: t != "")


def yes_no(x: Column) -> Column:
    """Sí/No vocabularies; null for anything else."""
    key = norm_text(x)
    return F.when(key.isin("si", "s", "yes", "true", "1"), "Si").when(key.isin("no", "n", "false", "0"), "No")


def rank_label(x: Column) -> Column:
    """Leading group rank A1, A, B, C, D; 00 means recognised."""
    found = F.regexp_extract(F.upper(F.trim(x)), r"^(A1|A|B|C|D|00)(?![\p{L}0-9])", 1)
    return F.when(found == "00", "Reconocido").when(found != "", found)


@F.pandas_udf(T.StringType())
def unescaped(values: pd.Series) -> pd.Series:
    """HTML entities resolved, up to three times over, in NFC and without control characters."""

    def one(x):
        if x is None:
            return None
        for _ in range(3):
            if (y := html.unescape(x)) == x:
                break
            x = y
        x = unicodedata.normalize("NFC", x)
        return re.sub(r"\s+", " ", "".join(c for c in x if c.isspace() or unicodedata.category(c) != "Cc")).strip()

    return values.map(one, na_action=None)


@F.pandas_udf(T.StringType())
def folded(values: pd.Series) -> pd.Series:
    """NFKC, case-folded, single spaces; accents count."""
    return values.map(lambda x: None if x is None else " ".join(unicodedata.normalize("NFKC", x).casefold().split()))


@F.pandas_udf(T.DoubleType())
def sequence_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Longest-matching-block ratio; the order of the arguments counts."""
    from difflib import SequenceMatcher

    return pd.Series([None if a is None or b is None else SequenceMatcher(None, a, b).ratio() for a, b in zip(left, right)], dtype="float64")
