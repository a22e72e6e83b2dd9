"""Secret scans by an incremental blob ledger.

Every version of every path is content-addressed by the SHA-256 of its text. The ledger is a table of
(blob, rule_version, spans) on shared storage; a scan looks only at pairs of a blob and a rule version that the
ledger lacks, appends what it found (an empty list too, so that clean blobs are not scanned again), and joins
findings back to all paths that carry the blob.

Defined results: a null text is the empty text; repeated rows, and several versions of one path, each get the
findings of their own blob; an empty table gives an empty result; other columns of the input pass through, under any
name; very long texts are read in time that grows with their length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle

#: Kinds of secrets in the order in which spans at one start are listed.
BASE_KINDS = ("assign", "access", "hex")
MORE_KINDS = ("pem", "jwt", "vendor", "basic")
RULE_VERSION = "2024-2"

#: Patterns.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: A key reaches its END line; without one, only the header lines and base64 runs that follow at once belong to it.
_PEM = re.compile(
    r"""-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?:[^-]|-(?!----(?:BEGIN|END)\b))*-----END [A-Z ]*PRIVATE KEY-----|"""
    r"""(?:\s+(?:Proc-Type|DEK-Info|Comment|X-[A-Za-z-]+):[^\n]*)*"""
    r"""(?:(?:(?:\s|\\[nr]|["'+>|,])*(?=[A-Za-z0-9+/]*(?:[0-9+/]|[a-z][A-Z]))[A-Za-z0-9+/]{16,}={0,2})+(?:(?:\s|\\[nr])+(?:[A-Za-z0-9+/]+={1,2}|[A-Za-z0-9+/]+\Z))?)?)"""
)
_VENDOR = re.compile(r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}|sk_live_[A-Za-z0-9]{16,})", re.A)
#: Without the scheme before it, which is looked for leftwards from here: that way each character is read once.
_BASIC = re.compile(r"://[^\s/:@]+:[^\s/@]+@", re.A)
_SCHEME = re.compile(r"\b[a-z]", re.A)
_DOTTED = re.compile(r"[A-Za-z0-9_.-]+")
_TOKEN_START = re.compile(r"\beyJ[A-Za-z0-9_-]{8,}", re.A)
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

SPAN = "array<struct<kind:string,start:int,stop:int>>"


def _basic(text: str) -> Iterator[tuple[int, int]]:
    """Addresses with a name and a password: scheme://name:password@."""
    done = 0
    for m in _BASIC.finditer(text):
        low = m.start()
        while low > done and text[low - 1] in "abcdefghijklmnopqrstuvwxyz0123456789+.-":
            low -= 1
        start = _SCHEME.search(text, low, m.start())
        if start:
            yield start.start(), m.end()
            done = m.end()


def _tokens(text: str) -> Iterator[tuple[int, int]]:
    """Web tokens, three parts with dots between, the first two of them beginning with eyJ."""
    for run in _DOTTED.finditer(text):
        if ".eyJ" not in run[0]:
            continue
        at, parts, k = run.start(), run[0].split("."), 0
        places = [at]
        for p in parts:
            places.append(places[-1] + len(p) + 1)
        while k + 2 < len(parts):
            head = _TOKEN_START.search(text, places[k], places[k + 1] - 1)
            if head and parts[k + 1].startswith("eyJ") and len(parts[k + 1]) >= 11 and len(parts[k + 2]) >= 8:
                yield head.start(), places[k + 3] - 1
                k += 3
            else:
                k += 1


def find(text: str) -> list[tuple[str, int, int]]:
    """All spans of a text, in code points with exclusive ends, by start and then by kind as listed.

    The patterns for access keys and hexadecimal runs fold the least length in: as greedy runs of one class
    they match where the run itself would match and be long enough. Assignments are matched first and dropped
    after, since a value that is too short still uses up its characters.
    """
    found: list[tuple[int, int, str, int]] = []

    def add(rank: int, kind: str, pattern: re.Pattern) -> None:
        found.extend((m.start(), rank, kind, m.end()) for m in pattern.finditer(text))

    low = text.lower() if text.isascii() else "".join(c.lower() if c < "\x80" else c for c in text) if "İ" in text else text.lower()
    if any(k in low for k in _KEYWORDS):
        found.extend((m.start(), 0, "assign", m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6)
    if "AKIA" in text:
        add(1, "access", _ACCESS)
    add(2, "hex", _HEX)
    if "-----BEGIN " in text:
        add(3, "pem", _PEM)
    if "eyJ" in text:
        found.extend((a, 4, "jwt", b) for a, b in _tokens(text))
    if any(k in text for k in ("gh", "xox", "AIza", "sk_live_")):
        add(5, "vendor", _VENDOR)
    if "://" in text:
        found.extend((a, 6, "basic", b) for a, b in _basic(text))
    return [(kind, start, stop) for start, _, kind, stop in sorted(found)]


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        spans = [[{"kind": k, "start": a, "stop": b} for k, a, b in find(t)] for t in pdf["text"]]
        yield pd.DataFrame({"blob": pdf["blob"], "spans": spans})


def _ledger(df: DataFrame, path: str) -> DataFrame:
    spark, schema = df.sparkSession, f"blob string, spans {SPAN}, rule_version string"
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)  # the first scan: there is no ledger yet


def free(df: DataFrame, name: str) -> str:
    """``name``, with as many marks before it as no column of ``df`` has."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = "_" + name
    return name


def scan(versions: DataFrame, ledger_path: str, text: str = "text", rule_version: str = RULE_VERSION, blob: str = "blob", spans: str = "spans") -> DataFrame:
    """Scans blobs new to the ledger and returns all columns of ``versions`` but ``text``, with columns named by ``blob``
    and ``spans``, which take the place of any such columns.

    Blobs are gathered by a map-side combined aggregate, so copies of one text, however many, are moved and
    scanned once. The ledger is partitioned by rule version; a repeated call with no new text scans nothing. Scans at
    the same time may both append a blob: the ledger is read with one row a blob.
    """
    spark, held = versions.sparkSession, f"blob string, spans {SPAN}, rule_version string"
    given = versions.select(F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    seen = _ledger(versions, ledger_path).where(F.col("rule_version") == rule_version)
    blobs = given.groupBy("blob").agg(F.first("text").alias("text"))
    fresh = blobs.join(seen.select("blob"), "blob", "left_anti")
    fresh.mapInPandas(_scan, f"blob string, spans {SPAN}").withColumn("rule_version", F.lit(rule_version)).write.partitionBy("rule_version").mode("append").parquet(ledger_path)
    hits = spark.read.schema(held).parquet(ledger_path).where((F.col("rule_version") == rule_version) & (F.size("spans") > 0)).select("blob", "spans")
    hits = settle(hits.dropDuplicates(["blob"]).withColumnsRenamed({"blob": blob, "spans": spans}), "findings")
    kept = [c for c in versions.columns if c not in (text, blob, spans)]
    named = versions.withColumn(blob, F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).select(*kept, blob)
    return named.join(hits, blob, "left").withColumn(spans, F.coalesce(spans, F.array().cast(SPAN)))


def digest_report(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the digest of base spans and the list of all spans, per row of ``scan``."""
    label = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        key,
        *[count(k) for k in BASE_KINDS],
        F.sha2(F.array_join(F.transform(base, label), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", label), ",").alias("spans"),
    )


def redact(docs: DataFrame, ledger_path: str, mark: str = "[secret]") -> DataFrame:
    """The documents with each secret replaced by ``mark`` (overlapping spans by one) and n_chars, if there, set anew."""
    copy, blob, spans = free(docs, "__scanned"), free(docs, "__blob"), free(docs, "__spans")
    found = scan(docs.withColumn(copy, F.col("text")), ledger_path, text=copy, blob=blob, spans=spans)

    @F.pandas_udf("string")
    def masked(texts: pd.Series, found: pd.Series) -> pd.Series:
        def one(text: str | None, spans) -> str | None:
            if text is None or not len(spans):
                return text
            out, at = [], 0
            for s in spans:
                if s["stop"] > at:
                    if s["start"] >= at:
                        out += [text[at : s["start"]], mark]
                    at = s["stop"]
            return "".join([*out, text[at:]])

        return pd.Series([one(t, s) for t, s in zip(texts, found, strict=True)], dtype=object)

    hit = F.size(spans) > 0
    clean = found.withColumn("text", F.when(hit, masked("text", spans)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(hit, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return clean.select(*docs.columns)
