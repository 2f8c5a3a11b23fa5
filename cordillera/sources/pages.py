"""Raw pages: status, titles, links, labelled fields and tables, each task parsing its own pages."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_VOID = {"br", "hr", "img", "input", "link", "meta", "source", "wbr"}
_HIDDEN = {"script", "style"}


class PageParser(HTMLParser):
    """Title, headings, links, table rows and ``label: value`` fields of one page, however broken."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.title: list[str] = []
        self.heading: list[str] = []
        self.links: list[str] = []
        self.rows: list[list[str]] = []
        self.fields: list[tuple[str, str]] = []
        self.lang = ""
        self._open: list[str] = []
        self._cell: list[str] | None = None
        self._label: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        own = dict(attrs)
        if tag == "html":
            self.lang = own.get("lang") or self.lang
        elif tag == "a" and own.get("href"):
            self.links.append(own["href"])
        elif tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th"):
            self._cell = []
        elif tag in ("i", "em", "label", "dt"):
            self._label = []
        if tag not in _VOID:
            self._open.append(tag)

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self._cell is not None:
            if not self.rows:
                self.rows.append([])
            self.rows[-1].append(" ".join("".join(self._cell).split()))
            self._cell = None
        if tag in ("i", "em", "label", "dt") and self._label is not None:
            label = " ".join("".join(self._label).split())
            if label.endswith(":"):
                self.fields.append((label[:-1].strip(), ""))
            self._label = None
        if tag in self._open:
            while self._open.pop() != tag:
                pass

    def handle_data(self, data):
        inside = set(self._open)
        if inside & _HIDDEN:
            return
        if "title" in inside:
            self.title.append(data)
        if "h1" in inside:
            self.heading.append(data)
        if self._cell is not None:
            self._cell.append(data)
        if self._label is not None:
            self._label.append(data)
        elif self.fields and data.strip() and not self.fields[-1][1]:
            self.fields[-1] = (self.fields[-1][0], " ".join(data.split()))


def parse_page(page: str) -> PageParser:
    parser = PageParser()
    parser.feed(page)
    parser.close()
    return parser


PAGE = "id long, title string, heading string, lang string, links array<string>, cells array<array<string>>, fields map<string,string>"


def page_facts(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """One row per page with what its markup says; null pages have empty facts."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for i, page in zip(part["id"], part["html"]):
                p = parse_page(page or "")
                text = lambda x: " ".join("".join(x).split())
                out.append((i, text(p.title), text(p.heading), p.lang, p.links, [r for r in p.rows if r], dict(reversed(p.fields))))
            yield pd.DataFrame(out, columns=["id", "title", "heading", "lang", "links", "cells", "fields"])

    return pages.select(F.col(id_col).cast("long").alias("id"), F.col(html_col).alias("html")).mapInPandas(run, PAGE)


def written_title(html: Column) -> Column:
    """The first title as it is written, white space single and no spaces of any kind around it, with ``&lt;``, ``&gt;`` and ``&amp;`` resolved in this order and no other entity."""
    title = F.regexp_replace(F.regexp_extract(html, r"(?s)<title>(.*?)</title>", 1), r"[ \t\n\f\r]+", " ")
    title = F.regexp_replace(title, r"^\p{Zs}+|\p{Zs}+$", "")
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        title = F.replace(title, F.lit(entity), F.lit(sign))
    return title


def written_lang(html: Column) -> Column:
    """The language that the page's first ``<html lang=`` names, else empty."""
    return F.regexp_extract(html, r'<html lang="([^"]*)"', 1)


def written_links(html: Column) -> Column:
    """Targets of all quoted ``href`` of links in the source, in order."""
    return F.regexp_extract_all(html, F.lit(r'<a [^>]*href="([^"]+)"'), F.lit(1))


def page_status(html: Column, required: list[str], private: str | None = None) -> Column:
    """empty, private, incomplete (a required mark is absent) or downloaded."""
    whole = F.lit(True)
    for mark in required:
        whole &= F.contains(html, F.lit(mark))
    status = F.when(F.trim(F.coalesce(html, F.lit(""))) == "", "empty")
    if private:
        status = status.when(F.contains(html, F.lit(private)), "private")
    return status.when(~whole, "incomplete").otherwise("downloaded")


def content_hash(html: Column, trusted: Column | None = None) -> Column:
    """A stored SHA-256 if it looks like one, else computed."""
    own = F.sha2(html, 256)
    return own if trusted is None else F.coalesce(F.when(trusted.rlike("^[0-9a-f]{64}$"), trusted), own)


def declared_charset(body: Column) -> Column:
    """The charset named in the first 10,000 bytes, lower case, else utf-8."""
    head = F.decode(F.substring(body, 1, 10_000), "ISO-8859-1")
    found = F.lower(F.regexp_extract(head, r"(?i)charset=[\"']?([a-zA-Z0-9_\-]+)", 1))
    return F.when(found == "", "utf-8").otherwise(found)


def decoded(body: Column) -> Column:
    """struct(text, replaced): decoded by the declared charset (utf-8 or Latin-1), with U+FFFD counted."""
    charset = declared_charset(body)
    latin = F.decode(body, "ISO-8859-1")
    text = F.when(charset.isin("utf-8", "utf8"), F.make_valid_utf8(body.cast("string"))).otherwise(latin)
    return F.struct(text.alias("text"), (F.length(text) - F.length(F.translate(text, "�", ""))).alias("replaced"))
