"""Language identification by bit-sliced Bloom filters over byte n-grams.

Every position of the filter holds one bit a language (a bit slice across all languages), so a single lookup
returns the set of languages that contain an n-gram: the AND of the masks at its hash positions. Per language
the popcounts over all n-grams of a text, corrected for the filter's false positives, decide.

A language contains an n-gram if it makes up at least ``FLOOR`` of the language's n-grams and at least ``SHARE``
of its greatest rate in any language; at most 1 / FLOOR n-grams of a language can pass, which bounds the filter.

Defined results: texts that are null or have no letter get ``und`` and 0; rows without a language teach nothing;
a text none of whose n-grams is known gets the commonest learned language and 0; nothing learned gives ``und``; languages
that tie are taken in the order of what was learned, the commonest first; very long texts are read whole, in blocks;
existing lang_pred and score columns are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Documents to learn from at most, taken by hash of the key; all where there are fewer.
TRAIN_DOCS = 100_000
GRAM = 4
FLOOR = 2e-5
SHARE = 0.25
HASHES = 3
BITS_PER_GRAM = 16
SLICE = 64
_LETTER = re.compile(r"[^\W\d_]")
_KEEP = bytes(32 if b < 65 or 91 <= b < 97 or 123 <= b < 128 else b for b in range(256))
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_BLOCK = 1 << 20


def grams(text: str) -> Iterator[np.ndarray]:
    """Byte 4-grams of the lower-cased text as numbers, in blocks; all but letters are blanks, and n-grams
    that begin with two blanks or lie across a run of blanks are left out."""
    data = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace").translate(_KEEP), np.uint8)
    for i in range(0, max(1, len(data) - GRAM + 1), _BLOCK):
        b = data[i : i + _BLOCK + GRAM - 1]
        if len(b) < GRAM:
            return
        x = b.astype(np.uint32)
        g = x[:-3] << 24 | x[1:-2] << 16 | x[2:-1] << 8 | x[3:]
        blank = b == 32
        pair = blank[:-1] & blank[1:]
        yield g[~(pair[:-2] | pair[1:-1] | pair[2:])]


def count_grams(training: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, n): occurrences of each n-gram in each language, summed within tasks first."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, texts in pdf.groupby(lang)[text]:
                held, size = [], 0
                for part in (g for t in texts if t for g in grams(t)):
                    held.append(part)
                    size += len(part)
                    if size > 1 << 23:
                        yield _counted(name, held)
                        held, size = [], 0
                if held:
                    yield _counted(name, held)

    return training.select(lang, text).mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _counted(lang: str, held: list[np.ndarray]) -> pd.DataFrame:
    gram, n = np.unique(np.concatenate(held), return_counts=True)
    return pd.DataFrame({"lang": lang, "gram": gram.astype(np.int64), "n": n})


class Filters:
    """Bloom filters of all languages, sliced: masks[word, position] has bit l of language 64 * word + l."""

    def __init__(self, members: dict[str, np.ndarray], order: list[str]):
        self.languages = order
        most = max((len(g) for g in members.values()), default=1)
        self.bits = max(10, int(np.ceil(np.log2(most * BITS_PER_GRAM))))
        self.masks = np.zeros((-(-max(1, len(order)) // SLICE), 1 << self.bits), np.uint64)
        for i, lang in enumerate(order):
            word, bit = i // SLICE, np.uint64(1 << (i % SLICE))
            for p in self._positions(members[lang].astype(np.uint32)):
                np.bitwise_or.at(self.masks[word], p, bit)
        filled = [float(np.mean(self.masks[i // SLICE] >> np.uint64(i % SLICE) & np.uint64(1))) for i in range(len(order))]
        self.false = np.array(filled) ** HASHES

    def _positions(self, g: np.ndarray) -> list[np.ndarray]:
        x = g.astype(np.uint64)
        return [(x + np.uint64(1)) * m >> np.uint64(64 - self.bits) for m in _MULTIPLIERS[:HASHES]]

    def decide(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not _LETTER.search(text):
            return "und", 0.0
        hits, n = np.zeros(len(self.languages)), 0
        for g in grams(text):
            at, n = self._positions(g), n + len(g)
            for word, masks in enumerate(self.masks):
                found = masks[at[0]]
                for p in at[1:]:
                    found = found & masks[p]
                first = word * SLICE
                if len(self.languages) <= 8:  # every set of languages counted at once
                    sets = np.bincount(found.astype(np.int64), minlength=1 << len(self.languages))
                    hits += [sets[(np.arange(len(sets)) >> i & 1) == 1].sum() for i in range(len(self.languages))]
                else:
                    for i in range(first, min(first + SLICE, len(self.languages))):
                        hits[i] += np.count_nonzero(found & np.uint64(1 << (i - first)))
        if not n:
            return self.languages[0], 0.0
        share = np.clip((hits - n * self.false) / (n * (1 - self.false)), 0, 1)
        best = int(np.argmax(share))
        rest = np.delete(share, best).max(initial=0.0)
        return self.languages[best], float(share[best] * (share[best] - 0.5 * rest) / max(share[best], 1e-9)) if share[best] > 0 else 0.0


def learn(training: DataFrame, text: str = "text", lang: str = "lang") -> Filters:
    """Filters from (text, lang) rows; only the n-grams that pass, at most 1 / FLOOR a language, reach the driver."""
    counts = count_grams(training.where(F.col(lang).isNotNull() & F.col(text).isNotNull()), text, lang)
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    rated = counts.join(totals, "lang").withColumn("rate", F.col("n") / F.col("total")).where(F.col("rate") >= FLOOR)
    top = F.max("rate").over(Window.partitionBy("gram"))
    kept = rated.withColumn("top", top).where(F.col("rate") >= SHARE * F.col("top")).select("lang", "gram", "total").toPandas()
    sizes = kept.groupby("lang")["total"].first()
    order = sorted(sizes.index, key=lambda x: (-sizes[x], x))
    return Filters({k: v.to_numpy(np.int64) for k, v in kept.groupby("lang")["gram"]}, order)


def identify(docs: DataFrame, filters: Filters, text: str = "text") -> DataFrame:
    """Adds lang_pred and score."""

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def decide(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([filters.decide(t) for t in texts], columns=["lang_pred", "score"])

    return docs.withColumn("__d", decide(F.col(text))).withColumns({"lang_pred": F.col("__d.lang_pred"), "score": F.col("__d.score")}).drop("__d")
