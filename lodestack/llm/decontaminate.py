"""Benchmark decontamination by template canonicalisation.

Texts become sequences of symbols: words in lower case, and typed placeholders for numbers, names and units.
Windows of eight symbols are hashed; windows of the documents are joined to those of the benchmark by hash. Of
each document and item the share of the item's windows found (or, of long items, ``LONG_RUN`` windows), and the
consistency of the slots decide; a question with other numbers or names still matches. Both are judged over the whole
document, where each value of the item stands for one value of the document, and for each occurrence, where each slot
of the item has one value; the best one counts. Windows of one occurrence have the same distance, up to ``DRIFT``,
between their places in the document and in the item. Windows with fewer words than half match by their values.

Items that differ in their values only, as many of one template do, are one class: a class is judged once, for only the
pattern of its values counts. A leak has the same values if each window's are those of an item of the class.

A Bloom filter over the benchmark's window hashes, of fixed size whatever the benchmark's, keeps all other
windows of the documents out of the join; its false positives end in the join.

Symbols end at white space, and each Chinese or Japanese letter is one; punctuation at their ends is dropped. A name is
a capitalised word that does not open a sentence; a unit is a unit's sign after a number.

Defined results: null and empty texts, and those without a symbol, match nothing; items of fewer than ``SHORTEST``
symbols match documents that are nothing else, with the same values; items shorter than a window match by one window
of their own length; repeated rows count as one document; documents without a key are told apart by their texts; equal
items are each reported, or counted in one row of their class; keys may be of any type; very long texts are read whole; columns
other than key and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle

WINDOW = 8
SHORTEST = 5
COVERAGE = 0.25
LONG_RUN = 13
CONSISTENCY = 0.6
DRIFT = 4
FILTER_BITS = 22
_CACHE_MOST = 150_000

#: Signs of units.
UNITS = frozenset("mm cm m km in ft yd mi mg g kg t lb oz ml cl l s sec min h hr hrs day days week weeks month months year years hz khz mhz ghz w kw v a j kj cal kcal k c f pa bar mph kmh bit byte kb mb gb tb % € $ £ usd eur gbp dollars euros cents percent degrees meters metres kilometers kilometres miles hours minutes seconds".split())

_NUMBER = re.compile(r"[+-]?\d+(?:[.,:/]\d+)*")
_NUMBER_UNIT = re.compile(r"[$€£]?[+-]?\d+(?:[.,:/]\d+)*[^\W\d_]{0,4}%?")
_WORD, _TITLE, _NUM, _UNIT, _DROP = range(5)
_TEXT = "utf-8", "replace"
_IDEOGRAPH = re.compile(r"[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def _hash(x: str) -> int:
    return xxhash.xxh64_intdigest(x.encode(*_TEXT))


_PLACE = {_TITLE: np.uint64(_hash("<name>")), _NUM: np.uint64(_hash("<number>")), _UNIT: np.uint64(_hash("<unit>"))}
_EXACT = np.uint64(_hash("<exact>"))
_MULTIPLIERS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(1, WINDOW + 1)], np.uint64)


class Canon:
    """Symbols of raw words, remembered; all work on a text is then done on arrays."""

    def __init__(self):
        self.at: dict[str, int] = {}
        self.value: list[str] = []
        self.hash, self.kind, self.stop = np.zeros(0, np.uint64), np.zeros(0, np.int8), np.zeros(0, bool)

    def _learn(self, new: list[str]) -> None:
        if len(self.at) > _CACHE_MOST:
            self.__init__()
        hashes, kinds, stops = [], [], []
        for raw in new:
            core = raw.strip("!\"#&'()*,-./:;<=>?@[\\]^_`{|}~«»„“”‘’…¿¡")
            low = core.lower()
            if not core and raw not in UNITS:
                kind = _DROP
            elif _NUMBER_UNIT.fullmatch(core):
                kind = _NUM
            elif low in UNITS:
                kind = _UNIT
            else:
                kind = _TITLE if core[:1].isupper() and core[1:2].islower() else _WORD
            self.at[raw] = len(self.value)
            self.value.append(low)
            hashes.append(_hash(low))
            kinds.append(kind)
            stops.append(raw[-1] in ".!?:" or raw.rstrip("\"')”»")[-1:] in (".", "!", "?"))
        n = len(self.value)
        if n > len(self.hash):  # room grows by doubling
            room = 2 * n
            self.hash, self.kind, self.stop = (np.concatenate([x, np.zeros(room - len(x), x.dtype)]) for x in (self.hash, self.kind, self.stop))
        self.hash[n - len(new) : n], self.kind[n - len(new) : n], self.stop[n - len(new) : n] = np.array(hashes, np.uint64), kinds, stops

    def symbols(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash of each symbol, whether it is a placeholder, and its number among the remembered values."""
        if text and not text.isascii() and _IDEOGRAPH.search(text):
            text = _IDEOGRAPH.sub(r" \g<0> ", text)
        raw = text.split() if text else []
        new = list(set(raw).difference(self.at))
        if new:
            if len(self.at) > _CACHE_MOST:
                new = list(set(raw))
            self._learn(new)
        at = np.fromiter(map(self.at.__getitem__, raw), np.int64, len(raw))
        kind = self.kind[at]
        if (kind == _DROP).any():
            at = at[kind != _DROP]
            kind = self.kind[at]
        opens = np.r_[True, self.stop[at][:-1]][: len(at)]
        after = np.r_[False, kind[:-1] == _NUM][: len(at)]
        kind = np.where((kind == _TITLE) & opens | (kind == _UNIT) & ~after, _WORD, kind)
        h = self.hash[at]
        for k, v in _PLACE.items():
            h = np.where(kind == k, v, h)
        return h, kind != _WORD, at

    def windows(self, text: str | None, lengths: list[int], literal: bool = True) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, int]]:
        """For each length: positions and hashes of the windows, the slots' numbers of the text, and how many come first
        that are templates; the others, left out unless ``literal``, are hashed with their values."""
        h, slot, at = self.symbols(text)
        words = np.r_[0, np.cumsum(~slot)]
        for n in lengths:
            m = len(h) - n + 1
            if m > 0:
                mix = np.zeros(m, np.uint64)
                for k in range(n):
                    mix += h[k : k + m] * _MULTIPLIERS[k]
                wordy = 2 * (words[n:] - words[:-n]) >= n
                if n < SHORTEST:  # the whole text, by its values
                    if m > 1:
                        continue
                    wordy[:] = False
                ok = np.flatnonzero(wordy)
                few = np.flatnonzero(~wordy) if literal else ok[:0]
                own, exact = self.hash[at], np.full(len(few), _EXACT)
                for k in range(n if len(few) else 0):
                    exact += own[few + k] * _MULTIPLIERS[k]
                mix = np.concatenate([mix[ok], exact])
                mix ^= mix >> np.uint64(29)
                mix *= np.uint64(0xBF58476D1CE4E5B9)
                mix ^= mix >> np.uint64(32)
                yield n, np.concatenate([ok, few]), mix, np.where(slot, at, -1), len(ok)


def _slots(canon: Canon, at: np.ndarray, start: int, n: int) -> list[str]:
    return [canon.value[i] for i in at[start : start + n] if i >= 0]


def item_windows(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, cls, length, pos, h, template, places, ids, slots, n_templates, n_windows) of the benchmark; each item has
    windows of one length. ``places`` are the slots' positions in the item, ``ids`` number its slot values by their first
    place. Items of one ``cls`` differ in their slot values only, so all of the other columns are equal."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        canon = Canon()
        for pdf in batches:
            rows = []
            for item, t in zip(pdf["item_id"], pdf["text"], strict=True):
                own, ids = [], {}
                n = min(WINDOW, len(canon.symbols(t)[0]))
                for length, pos, h, at, m in canon.windows(t, [n]) if n else ():
                    for i in at[at >= 0].tolist():
                        ids.setdefault(canon.value[i], len(ids))
                    for j, (p, x) in enumerate(zip(pos, h.view(np.int64), strict=True)):
                        places = [int(p) + i for i in np.flatnonzero(at[p : p + length] >= 0)] if j < m else []
                        slots = _slots(canon, at, p, length) if j < m else []
                        own.append((length, int(p), int(x), j < m, places, [ids[v] for v in slots], slots, m, len(pos)))
                cls = xxhash.xxh3_128_hexdigest(repr([(*w[:6], *w[7:]) for w in own]).encode())
                rows += [(item, cls, *w) for w in own]
            yield pd.DataFrame(rows, columns=["item_id", "cls", "length", "pos", "h", "template", "places", "ids", "slots", "n_templates", "n_windows"])

    # Keys go as text: pandas keeps a whole number beside a null as a fraction, which changes large ones.
    own = items.select(F.col(key).cast("string").alias("item_id"), F.col(text).alias("text"))
    cuts = own.mapInPandas(cut, "item_id string, cls string, length int, pos int, h long, template boolean, places array<int>, ids array<int>, slots array<string>, n_templates int, n_windows int")
    return cuts.withColumn("item_id", F.col("item_id").cast(dict(items.dtypes)[key]))


def document_windows(docs: DataFrame, seen: np.ndarray, lengths: list[int], literal: bool = True, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, h, d_pos, d_slots) of the windows that pass the packed Bloom filter ``seen``."""
    packed = np.packbits(seen)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        canon, bits = Canon(), np.unpackbits(packed).astype(bool)
        for pdf in batches:
            rows = []
            for doc, own, t in zip(pdf["doc_id"], pdf["text_hash"], pdf["text"], strict=True):
                for length, pos, h, at, m in canon.windows(t, lengths, literal):
                    one, two = _bloom(h)
                    for j in np.flatnonzero(bits[one] & bits[two]):
                        rows.append((doc, own, int(h.view(np.int64)[j]), int(pos[j]), _slots(canon, at, pos[j], length) if j < m else []))
            yield pd.DataFrame(rows, columns=["doc_id", "text_hash", "h", "d_pos", "d_slots"])

    own = docs.select(F.col(key).cast("string").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")).where("text IS NOT NULL")
    return own.mapInPandas(cut, "doc_id string, text_hash long, h long, d_pos int, d_slots array<string>").withColumn("doc_id", F.col("doc_id").cast(dict(docs.dtypes)[key]))


def _bloom(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = h.view(np.uint64)
    return h >> np.uint64(64 - FILTER_BITS), h & np.uint64((1 << FILTER_BITS) - 1)


def _keyed_leaks(docs: DataFrame, items: DataFrame, coverage: float, consistency: float) -> tuple[DataFrame, DataFrame]:
    """Leaks of classes of items, with text_hash, which is null where there is a doc_id; and the items of each class."""
    own = settle(item_windows(items), "item-windows")
    members = own.select("cls", "item_id").distinct()
    windows = own.drop("item_id", "slots").distinct()  # one set of windows a class, however many items
    high, low = (F.shiftrightunsigned("h", 64 - FILTER_BITS), F.col("h").bitwiseAND((1 << FILTER_BITS) - 1))
    seen = np.zeros(1 << FILTER_BITS, bool)
    marks = own.select(F.explode(F.array(high, low)).alias("p")).distinct().toPandas()["p"]  # 2 ** FILTER_BITS at most
    seen[marks.to_numpy(np.int64)] = True
    lengths = sorted(r["length"] for r in own.select("length").distinct().collect())
    literal = bool(own.where("NOT template").head(1))
    found = document_windows(docs, seen, lengths, literal).join(windows, "h")
    # Whether an item of the class has the document's values in this window.
    values = own.select("cls", "pos", F.xxhash64("slots").alias("v"), F.lit(True).alias("held")).distinct()
    found = found.withColumn("v", F.xxhash64("d_slots")).join(values, ["cls", "pos", "v"], "left").withColumn("held", F.coalesce("held", F.lit(False)))
    # A window counts for the whole document, for its exact distance and, in items so long that no two occurrences
    # come together, for two overlapping ranges of distances: a shift of up to DRIFT symbols stays in one of them.
    off, none = F.col("d_pos") - F.col("pos"), F.lit(None).cast("int")
    ranges = [F.when(F.col("length") == WINDOW, F.floor((off + shift) / (2 * DRIFT)).cast("int")) for shift in (0, DRIFT)]
    places = [F.struct(F.lit(way).alias("way"), at.alias("at")) for way, at in enumerate((none, off, *ranges))]
    found = found.withColumn("place", F.explode(F.array(*places))).where("place.way = 0 OR place.at IS NOT NULL")
    # Per place and window of the class one row is enough.
    pair = F.arrays_zip("places", "ids", "d_slots")
    by = found.groupBy("doc_id", "text_hash", "cls", "place", "n_templates", "n_windows").agg(
        F.count_distinct("pos").alias("matched"), F.count_distinct(F.when(F.col("template"), F.col("pos"))).alias("templates"), F.min("held").alias("same"), F.array_distinct(F.flatten(F.collect_set(pair))).alias("pairs")
    )
    distinct = lambda *names: F.size(F.array_distinct(F.transform("pairs", lambda p: F.struct(*[p[n].alias(n) for n in names]))))
    slot = lambda name: distinct(name) / distinct(name, "d_slots")
    share = F.greatest(F.col("matched") / F.col("n_windows"), F.when(F.col("n_templates") > 0, F.col("templates") / F.col("n_templates")))
    judged = (
        by.withColumn("coverage", share)
        .withColumn("consistency", F.when(F.size("pairs") == 0, 1.0).when(F.col("place.way") == 0, slot("ids")).otherwise(slot("places")))
        .where(((F.col("coverage") >= coverage) | (F.col("matched") >= LONG_RUN)) & (F.col("consistency") >= consistency))
        .groupBy("doc_id", F.when(F.col("doc_id").isNull(), F.col("text_hash")).alias("text_hash"), "cls")
        .agg(F.max("coverage").alias("coverage"), F.max("consistency").alias("consistency"), F.max("same").alias("same"))
        .withColumn("kind", F.when(F.col("same"), "same").otherwise("other values"))
    )
    return judged, members


def class_leaks(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE, consistency: float = CONSISTENCY) -> DataFrame:
    """One row for each document and class of items that it leaks: doc_id, item_id (the least of the class), n_items,
    coverage, consistency, kind. Items of a class differ in their values only; ``item_windows`` tells which they are."""
    found, members = _keyed_leaks(docs, items, coverage, consistency)
    named = members.groupBy("cls").agg(F.min("item_id").alias("item_id"), F.count("*").alias("n_items"))
    return found.join(named, "cls").select("doc_id", "item_id", "n_items", "coverage", "consistency", "kind")


def leaks(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE, consistency: float = CONSISTENCY) -> DataFrame:
    """``class_leaks`` for each item: doc_id, item_id, coverage, consistency, kind."""
    found, members = _keyed_leaks(docs, items, coverage, consistency)
    return found.join(members, "cls").select("doc_id", "item_id", "coverage", "consistency", "kind")


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that leak no benchmark item."""
    found = settle(_keyed_leaks(docs, items, COVERAGE, CONSISTENCY)[0].select("doc_id", "text_hash").distinct(), "leaks")
    keyed = docs.where("doc_id IS NOT NULL").join(found.where("doc_id IS NOT NULL").select("doc_id"), "doc_id", "left_anti")
    bare = docs.where("doc_id IS NULL").withColumn("__h", F.xxhash64("text")).join(found.where("doc_id IS NULL").select(F.col("text_hash").alias("__h")), "__h", "left_anti")
    return keyed.select(*docs.columns).unionByName(bare.select(*docs.columns))
