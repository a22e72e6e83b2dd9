"""Document fingerprints: one-permutation MinHash with optimal densification and packed low-order bits.

Shingles of five lower-cased words are hashed once; the top bits of a hash name its bin and each bin keeps
its least hash. Empty bins copy a filled bin picked by a fixed pseudo-random probe order that depends only on
the bin (optimal densification). Eight low-order bits of every bin are packed as hexadecimal. Two
fingerprints are compared by their share of equal bins, corrected for equal low bits by chance.

All of it is built from DataFrame functions: no Python runs on the executors.

Defined results: a null text is empty; an empty text has a fingerprint of zeros, 1 against another empty text
and 0 against any other; a text of fewer than five words is a single shingle; equal texts get equal
fingerprints. Rows with a null key sort last; rows with equal keys sort by text. Very long texts are read whole; only the
key and the text are read, whatever other columns are called.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions

BINS = 256
LOW_BITS = 8
SHINGLE_WORDS = 5
EARLY_PROBES = 6
_SHIFT = 64 - (BINS - 1).bit_length()


def _sentinels() -> list[int]:
    """For each bin in signed order the largest hash it can hold; it marks the bin as empty."""
    return [((b + 1) << _SHIFT) - 1 for b in range(-BINS // 2, BINS // 2)]


def _probes() -> list[list[int]]:
    """For each bin, the order (1-based) in which other bins are tried while it is empty."""
    return [random.Random(f"bin {b}").sample(range(1, BINS + 1), BINS) for b in range(BINS)]


def _numbers(values: list[int], kind: str = "bigint") -> Column:
    """An array literal, handed over as one string and folded to a constant by the optimizer."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def shingle_hashes(df: DataFrame, text: str, out: str, words: int = SHINGLE_WORDS) -> DataFrame:
    """Adds ``out``: 64-bit hashes of the word shingles of ``text``, repeats included."""
    h = f"{out}__h"
    df = df.withColumn(h, F.transform(F.split(F.lower(F.col(text)), r"\s+"), lambda w: F.when(w != "", F.xxhash64(w))))
    word = lambda i: F.get(F.col(h), i)
    head = F.when(word(F.lit(0)).isNull(), 1).otherwise(0)  # white space at an end leaves an empty word there
    last = F.size(h) - F.when(F.element_at(h, -1).isNull(), 1).otherwise(0)
    # Past the end of a short text get() gives null, which xxhash64 skips.
    grams = F.transform(F.sequence(head, F.greatest(head, last - words)), lambda i: F.xxhash64(*[word(i + k) for k in range(words)]))
    return df.withColumn(out, F.when(last - head <= 0, F.array().cast("array<bigint>")).otherwise(grams)).drop(h)


def with_sketch(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: array<int> of the low-order bits of all bins, empty for a text without words."""
    marks, probes = _numbers(_sentinels()), _probes()
    early = [_numbers([p[t] for p in probes], "int") for t in range(EARLY_PROBES)]
    every = _numbers([_sentinels()[x - 1] for p in probes for x in p])
    s, b, f = f"{out}__s", f"{out}__b", f"{out}__f"
    df = shingle_hashes(df, text, s)
    # A sentinel in every bin: after sorting, the first value of each bin is its least hash or its sentinel.
    df = df.withColumn(s, F.sort_array(F.concat(marks, s)))
    df = df.withColumn(b, F.filter(s, lambda x, i: F.shiftright(x.bitwiseXOR(F.coalesce(F.get(F.col(s), i - 1), F.bitwise_not(x))), _SHIFT) != 0)).drop(s)
    df = df.withColumn(f, F.array_except(marks, F.col(b)))  # sentinels of the filled bins
    low = lambda x: x.bitwiseAND((1 << LOW_BITS) - 1).cast("int")

    def of(position: Column) -> Column:
        return F.when(F.get(F.col(b), position) != F.get(marks, position), F.get(F.col(b), position))
    def fill(x: Column, i: Column) -> Column:
        last = F.element_at(F.array_intersect(F.slice(every, i * BINS + 1, F.lit(BINS)), F.col(f)), 1)
        return low(F.coalesce(F.when(x != F.get(marks, i), x), *[of(F.get(p, i) - 1) for p in early], F.get(F.col(b), (F.shiftright(last, _SHIFT) + BINS // 2).cast("int"))))

    none = F.array().cast("array<int>")
    return df.withColumn(out, F.when(F.size(f) == 0, none).when(F.size(f) == BINS, F.transform(b, low)).otherwise(F.transform(b, fill))).drop(b, f)


def packed(sketch: str) -> Column:
    """The sketch as lower-case hexadecimal digits."""
    digits = F.array_join(F.transform(sketch, lambda x: F.substring(F.hex(x + 256), 2, 2)), "")
    return F.lower(F.when(F.size(sketch) == 0, F.lit("0" * (BINS * LOW_BITS // 4))).otherwise(digits))


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard similarity of the shingle sets behind two sketches, between 0 and 1."""
    same = F.size(F.filter(a, lambda x, i: x == F.get(F.col(b), i))) / F.lit(float(BINS))
    chance = 2.0**-LOW_BITS
    est = F.greatest(F.lit(0.0), (same - chance) / (1 - chance))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(est)


def with_next(df: DataFrame, key: str, carry: dict[str, str]) -> DataFrame:
    """Adds to each row columns of the next row by ascending ``key`` (after the last: the first).

    ``carry`` maps a column to the name under which the next row's value is added. Rows are dealt into key
    ranges (quantile bounds, each cut into equal parts), so that one shuffle serves; the first row of each
    range is also dealt to the range before it. Only the quantile bounds, at most 257 numbers, reach the driver.
    """
    n = 4 * partitions(df.sparkSession)
    coarse = min(256, n)
    fine = -(-n // coarse)
    shares = [i / coarse for i in range(coarse + 1)]
    bounds = df.agg(F.percentile_approx(key, shares, 10_000).alias("q")).first()["q"] or [0, 0, 0]
    bounds[-1] += 1
    inner, lows, spans = _numbers(bounds[1:-1]), _numbers(bounds[:-1]), _numbers([max(1, y - x) for x, y in zip(bounds, bounds[1:], strict=False)])
    at = F.size(F.filter(inner, lambda q: q <= F.col(key)))
    df = df.withColumn("__c", at)
    part = F.floor((F.col(key) - F.get(lows, F.col("__c"))) * F.lit(fine) / F.get(spans, F.col("__c")))
    df = df.withColumn("__r", F.coalesce(F.col("__c") * fine + F.least(F.greatest(part, F.lit(0)), F.lit(fine - 1)), F.lit(coarse * fine).cast("long"))).drop("__c")
    # One row a range, at most 4 * shuffle partitions + 1 of them: small by construction.
    starts = df.groupBy("__r").agg(F.min(key).alias("__k"))
    order, whole = Window.orderBy("__r"), Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = starts.select(F.col("__r").alias("__own"), F.col("__k"), F.coalesce(F.lag("__r").over(order), F.last("__r").over(whole)).alias("__to"))
    df = df.join(F.broadcast(starts), (df["__r"] == starts["__own"]) & df[key].eqNullSafe(starts["__k"]), "left").drop("__own", "__k")
    here = F.struct(F.col("__r").alias("r"), F.lit(0).alias("peek"))
    ahead = F.struct(F.col("__to").alias("r"), F.lit(1).alias("peek"))
    df = df.withColumn("__at", F.explode(F.when(F.col("__to").isNotNull(), F.array(here, ahead)).otherwise(F.array(here)))).drop("__r", "__to")
    df = df.withColumn("__r", F.col("__at.r")).withColumn("__peek", F.col("__at.peek")).drop("__at")
    w = Window.partitionBy("__r").orderBy("__peek", F.col(key).asc_nulls_last(), *[F.col(c) for c in carry if c != key][:1])
    return df.select("*", *[F.lead(c).over(w).alias(name) for c, name in carry.items()]).where("__peek = 0").drop("__r", "__peek")


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, with likenesses to the edited and to the next text.

    The edited text is the text with its last floor(n_chars / 2) code points replaced by the first as many
    (or all) of the next document by ascending doc_id. Only ``doc_id`` and ``text`` are read.
    """
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    df = with_next(with_sketch(df, "text", "own"), "doc_id", {"text": "next_text", "own": "next_own"})
    n, half = F.char_length("text"), F.floor(F.char_length("text") / 2).cast("int")
    df = df.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.concat(F.left("text", n - half), F.left("next_text", half)).alias("edited"),
        "own",
        "next_own",
    )
    df = with_sketch(df, "edited", "new")
    return df.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        packed("own").alias("fingerprint"),
        packed("new").alias("edited_fingerprint"),
        likeness("own", "new").alias("near_edited"),
        likeness("own", "next_own").alias("near_next"),
    )
