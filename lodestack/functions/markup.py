"""HTML as tables: heading outline, links, tables, counts and a sanitizer, by the standard library's parser."""

from __future__ import annotations

import html
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_HEADINGS = {f"h{i}": i for i in range(1, 7)}
#: Elements and attributes that the sanitizer lets through.
KEPT = frozenset("a abbr article b blockquote br caption code dd div dl dt em figcaption figure h1 h2 h3 h4 h5 h6 hr i img kbd li ol p pre q s section small span strong sub sup table tbody td tfoot th thead tr u ul".split())
KEPT_ATTRIBUTES = {"a": {"href", "id", "title"}, "img": {"src", "alt", "title"}, "td": {"colspan", "rowspan"}, "th": {"colspan", "rowspan", "scope"}, "ol": {"start"}}
_SILENT = {"script", "style", "template", "noscript"}
_VOID = {"br", "hr", "img"}


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.headings: list[dict] = []
        self.links: list[dict] = []
        self.rows: list[dict] = []
        self.silent = 0
        self.heading: dict | None = None
        self.link: dict | None = None
        self.cell: list[str] | None = None
        self.row: list[str] = []
        self.table = -1

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in _SILENT:
            self.silent += 1
        elif tag in _HEADINGS:
            self.heading = {"level": _HEADINGS[tag], "anchor": a.get("id"), "title": ""}
        elif tag == "a" and a.get("href") is not None:
            self.link = {"href": a["href"], "label": ""}
        elif tag == "table":
            self.table += 1
        elif tag == "tr":
            self._end_row()
        elif tag in ("td", "th"):
            self._end_cell()
            self.cell = []

    def _end_cell(self):
        if self.cell is not None:
            self.row.append(" ".join("".join(self.cell).split()))
            self.cell = None

    def _end_row(self):
        self._end_cell()
        if self.row:
            self.rows.append({"table": self.table, "cells": self.row})
            self.row = []

    def handle_endtag(self, tag):
        if tag in _SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag in _HEADINGS and self.heading:
            self.headings.append(self.heading | {"title": " ".join(self.heading["title"].split())})
            self.heading = None
        elif tag == "a" and self.link:
            self.links.append(self.link | {"label": " ".join(self.link["label"].split())})
            self.link = None
        elif tag in ("td", "th"):
            self._end_cell()
        elif tag in ("tr", "table"):
            self._end_row()

    def handle_data(self, data):
        if not self.silent:
            for part in (self.heading, self.link):
                if part is not None:
                    part["title" if part is self.heading else "label"] += data
            if self.cell is not None:
                self.cell.append(data)


def _read(page: str | None) -> _Reader:
    reader = _Reader()
    if page:
        reader.feed(page)
        reader.close()
        reader._end_row()
    return reader


def outline(pages: DataFrame, key: str, source: str) -> DataFrame:
    """(key, position, level, title, anchor, parent): headings outside scripts; the parent is the nearest heading
    before with a lower level, and an anchor used again gets a number."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, page in zip(pdf[key], pdf[source], strict=True):
                stack: list[tuple[int, int]] = []
                seen: dict[str, int] = {}
                for i, h in enumerate(_read(page).headings):
                    while stack and stack[-1][1] >= h["level"]:
                        stack.pop()
                    anchor = h["anchor"]
                    if anchor is not None:
                        seen[anchor] = seen.get(anchor, 0) + 1
                        anchor = anchor if seen[anchor] == 1 else f"{anchor}-{seen[anchor]}"
                    rows.append((k, i, h["level"], h["title"], anchor, stack[-1][0] if stack else None))
                    stack.append((i, h["level"]))
            yield pd.DataFrame(rows, columns=[key, "position", "level", "title", "anchor", "parent"]).astype({"parent": "Int64"})

    kind = dict(pages.dtypes)[key]
    return pages.select(key, source).mapInPandas(parse, f"{key} {kind}, position long, level int, title string, anchor string, parent long")


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("href", T.StringType()), T.StructField("label", T.StringType())])))
def _links(pages: pd.Series) -> pd.Series:
    return pd.Series([_read(p).links for p in pages], dtype=object)


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("table", T.IntegerType()), T.StructField("cells", T.ArrayType(T.StringType()))])))
def _rows(pages: pd.Series) -> pd.Series:
    return pd.Series([_read(p).rows for p in pages], dtype=object)


class _Cleaner(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.errors: list[str] = []
        self.silent = 0

    def handle_starttag(self, tag, attrs):
        if tag in _SILENT or tag in ("iframe", "object", "embed"):
            self.silent += tag in _SILENT
            self.errors.append(f"dropped {tag}")
        elif tag in KEPT and not self.silent:
            kept = []
            for name, value in attrs:
                target = "".join((value or "").split()).lower()
                if name in KEPT_ATTRIBUTES.get(tag, ()) and not (name in ("href", "src") and target.startswith(("javascript:", "data:", "vbscript:"))):
                    kept.append(f' {name}="{html.escape(value or "")}"')
            if tag == "img" and any(n == "src" and (v or "").startswith(("http:", "https:", "//")) for n, v in attrs):
                self.errors.append("remote image")
            self.out.append(f"<{tag}{''.join(kept)}>")

    def handle_endtag(self, tag):
        if tag in _SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag in KEPT and tag not in _VOID and not self.silent:
            self.out.append(f"</{tag}>")

    def handle_data(self, data):
        if not self.silent:
            self.out.append(html.escape(data, quote=False))


@F.pandas_udf(T.StructType([T.StructField("html", T.StringType()), T.StructField("errors", T.ArrayType(T.StringType()))]))
def _cleaned(pages: pd.Series) -> pd.DataFrame:
    rows = []
    for page in pages:
        c = _Cleaner()
        c.feed(page or "")
        c.close()
        rows.append((None if page is None else "".join(c.out), c.errors))
    return pd.DataFrame(rows, columns=["html", "errors"])


def links(page: str | Column) -> Column:
    """array<struct<href, label>> of the links of a page."""
    return _links(page)


def table_rows(page: str | Column) -> Column:
    """array<struct<table, cells>> of all table rows of a page."""
    return _rows(page)


def sanitized(page: str | Column) -> Column:
    """struct<html, errors>: allowed elements and attributes only, active content dropped."""
    return _cleaned(page)


def dependencies(pages: DataFrame, key: str, source: str) -> DataFrame:
    """(key, target, remote): what a page loads or links to by src, href, poster or data attributes."""
    found = F.explode(F.regexp_extract_all(source, F.lit(r"""(?i)\s(?:src|href|poster|data)\s*=\s*["']([^"']+)["']"""), F.lit(1)))
    return pages.select(key, found.alias("target")).withColumn("remote", F.col("target").rlike("^(?i)([a-z][a-z0-9+.-]*:|//)"))
