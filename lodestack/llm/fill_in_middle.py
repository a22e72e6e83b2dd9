"""Fill-in-middle transformation: texts are cut in three and the middle is moved to the end.

The units of a cut are the isolated matches of a Split pre-tokenizer of the tokenizers library, which needs no training.
It returns the offsets of all units in code points: their number is n, and the offset of a rank is a cut. Which ranks,
and which form, follow from a hash of the seed and the document's key alone, so a row's result depends on no other row,
on no order and on no attempt. Slicing, hashing and rebuilding are column expressions; texts go to Python only to be cut.

Defined results: a null text is empty; an empty text has no units and stays plain, as does a text that holds one of the
markers; a null key is hashed as nothing after the seed's colon; repeated rows stay repeated and equal rows get equal
results; very long texts are cut whole; of other columns none is read.
"""

from __future__ import annotations

import gc
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 42
#: White space goes with the word after it; what follows the last word is a unit.
UNITS = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of texts that are moved at all, and of those the percent in suffix-prefix-middle form.
MOVED, SUFFIX_FIRST = 50, 80


@cache
def _splitter():
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(UNITS), "isolated")


def ends(text: str) -> list[int]:
    """Offsets, in code points, at which the units of a text end."""
    return [end for _, (_, end) in _splitter().pre_tokenize_str(text)]


def _cuts(texts: pd.Series, one: pd.Series, two: pd.Series) -> pd.DataFrame:
    found = []
    gc.disable()  # a batch makes very many small tuples, none of them in a cycle
    try:
        for text, a, b in zip(texts, one, two, strict=True):
            at = ends(text)
            ranks = sorted((a % (len(at) + 1), b % (len(at) + 1)))
            found.append((len(at), *(at[r - 1] if r else 0 for r in ranks)))
    finally:
        gc.enable()
    return pd.DataFrame(found, columns=["n", "first", "second"])


def draws(key: str, seed: int = SEED, n: int = 4) -> list[Column]:
    """Unsigned 32-bit numbers from the SHA-256 of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(n)]


def transformed(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output) for every row; form is plain, psm or spm."""
    df = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("__t"), *[h.alias(f"__h{i}") for i, h in enumerate(draws(key, seed))])
    df = df.withColumn("__c", F.pandas_udf(_cuts, "n long, first int, second int")("__t", "__h0", "__h1"))
    marked = F.col("__t").contains(PREFIX) | F.col("__t").contains(SUFFIX) | F.col("__t").contains(MIDDLE)
    plain = (F.col("__t") == "") | marked | (F.col("__h2") % 100 >= MOVED)
    df = df.withColumn("form", F.when(plain, "plain").when(F.col("__h3") % 100 < SUFFIX_FIRST, "spm").otherwise("psm"))
    first, second = F.col("__c.first"), F.col("__c.second")
    part = lambda a, b: F.substring(F.col("__t"), a + 1, b - a)
    prefix, middle, suffix = part(F.lit(0), first), part(first, second), part(second, F.char_length("__t"))
    psm = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    spm = F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    moved = F.col("form") != "plain"
    return df.select(
        key,
        F.col("__c.n").alias("n"),
        "form",
        F.when(moved, first.cast("long")).alias("prefix_chars"),
        F.when(moved, (second - first).cast("long")).alias("middle_chars"),
        F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("__t")).alias("output"),
    )


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text behind an output. No part of a moved text holds a marker, and no marker can begin inside another or
    end in the text after it, so each marker's first place is the one where it was put."""
    out, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))

    def pieces(second: str) -> list[Column]:
        whole = F.split(F.substring(out, 4, F.char_length(out)), second, 2)
        rest = F.split(F.get(whole, F.lit(1)), MIDDLE, 2)
        return [F.get(whole, F.lit(0)), F.get(rest, F.lit(0)), F.get(rest, F.lit(1))]

    prefix, suffix, middle = pieces(SUFFIX)
    late, early, end = pieces(PREFIX)
    return F.when(form == "psm", F.concat(prefix, middle, suffix)).when(form == "spm", F.concat(early, end, late)).otherwise(out)
