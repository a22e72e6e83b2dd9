"""Text functions that Spark has no built-in for: Unicode forms, full case folding, ordered coverage."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def _compatible(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else " ".join(unicodedata.normalize("NFKC", t).lower().split()))


@F.pandas_udf(T.StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


@F.pandas_udf(T.StringType())
def _folded(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else " ".join(t.split()).casefold())


@F.pandas_udf(T.StringType())
def _first_letter(s: pd.Series) -> pd.Series:
    def one(t: str | None) -> str | None:
        if t is None:
            return None
        c = unicodedata.normalize("NFKD", t.strip())[:1].upper()
        return c if "A" <= c <= "Z" else "0-9" if c.isdecimal() else "other"

    return s.map(one)


@F.pandas_udf(T.DoubleType())
def _covered(source: pd.Series, rendered: pd.Series) -> pd.Series:
    def one(a: str | None, b: str | None) -> float | None:
        if a is None or b is None:
            return None
        bare = lambda t: [c for c in unicodedata.normalize("NFKC", t) if not c.isspace() and unicodedata.category(c) != "Cf"]
        want, left = bare(a), iter(bare(b))
        got = 0
        for c in want:
            if c not in left:  # reads on until it is found
                break
            got += 1
        return got / len(want) if want else 1.0

    return pd.Series([one(a, b) for a, b in zip(source, rendered, strict=True)], dtype=float)


def compatible(text: str | Column) -> Column:
    """NFKC, lower case, single blanks."""
    return _compatible(text)


def folded(text: str | Column) -> Column:
    """Single blanks and full case folding (ß equals ss)."""
    return _folded(text)


def first_letter(text: str | Column) -> Column:
    """A to Z, 0-9 or other, by the first character without its marks."""
    return _first_letter(text)


def ordered_coverage(source: str | Column, rendered: str | Column) -> Column:
    """Share of the source's characters that the rendered text holds in their order."""
    return _covered(source, rendered)


def nfkc(text: Column) -> Column:
    """Unicode's compatible composed form (NFKC) of a text."""
    return _nfkc(text)


def maybe_incompatible(text: Column) -> Column:
    """Whether a text has a character outside ASCII, accented Latin letters, dashes and quotes: only such texts can have
    another compatible form."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return ~ascii_only & text.rlike("[^\\x00-\\x7F\u00C0-\u0131\u0134-\u013E\u0141-\u0148\u014A-\u017E\u2013\u2014\u2018-\u201F]")
