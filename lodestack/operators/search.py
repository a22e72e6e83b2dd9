"""Ranked metadata search over records, as one job for any number of queries.

Records are (record_id, title, body, href, location) and, where there are any, aliases, shelves and labels (lists of
strings) and legacy; queries are (query_id, phrase) and, if need be, shelf ('all' where it is left out or null).

Phrases and records are compared in Unicode's compatible form and lower case. Score: 100000 if the whole phrase equals
the title or an alias, else 10000 if every word is found, plus 100 for each word found and 10 for each found in the
title or an alias. Order: score, title, id; the first record of each (href, location) stays. Shelf 'legacy' takes legacy
records only, 'all-with-legacy' every one, 'all' and a shelf's name take none that is legacy. A query of over 32
different words is an error; an empty one finds nothing.

Each record's words are cut down to those that were asked for before anything is shuffled: where few are asked, these
are looked for, else the record's words are listed and joined to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import maybe_incompatible, nfkc

MOST_WORDS = 32
#: Different asked words up to which they are looked for in the records, with no list of a record's words.
FEW_WORDS = 64


def normalized(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def tokens(text: Column) -> Column:
    """Distinct runs of letters and digits in lower case."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))


def among(text: Column, words: list[str]) -> Column:
    """Which of some lower-case words of letters and digits a lower-case text holds, in one pass over it."""
    if not words:
        return F.array().cast("array<string>")
    return F.array_distinct(F.regexp_extract_all(text, F.lit(rf"(?<![\p{{L}}\p{{N}}])({'|'.join(sorted(words))})(?![\p{{L}}\p{{N}}])"), F.lit(1)))


def compatible_columns(df: DataFrame, *columns: str) -> DataFrame:
    """The rows with the columns in Unicode's compatible form. Only rows with a character that may have another one are
    handed to Python."""
    odd = F.lit(False)
    for c in columns:
        odd = odd | F.coalesce(maybe_incompatible(F.col(c)), F.lit(False))
    return df.where(~odd).unionByName(df.where(odd).withColumns({c: nfkc(F.col(c)) for c in columns}))


def eligible(shelf: Column, legacy: Column, shelves: Column) -> Column:
    return F.when(shelf == "legacy", legacy).when(shelf == "all-with-legacy", True).when(legacy, False).otherwise((shelf == "all") | F.array_contains(shelves, shelf))


def search(records: DataFrame, queries: DataFrame, limit: int = 50) -> DataFrame:
    """(query_id, rank, record_id, score) of the first ``limit`` records of each query."""
    none = F.array().cast("array<string>")
    given = lambda df, c, other: F.coalesce(F.col(c), other) if c in df.columns else other
    asked = compatible_columns(queries.select("query_id", "phrase", given(queries, "shelf", F.lit("all")).alias("shelf")), "phrase")
    asked = asked.select("query_id", "shelf", normalized(F.col("phrase")).alias("phrase"), tokens(F.col("phrase")).alias("words"))
    asked = asked.withColumn("n_words", F.when(F.size("words") > MOST_WORDS, F.raise_error(F.lit("use at most 32 different search words")).cast("int")).otherwise(F.size("words")))
    mark = "\x1f"  # stands in no title: keeps aliases apart in one string
    own = records.select(
        "record_id",
        "title",
        F.concat_ws(mark, "title", given(records, "aliases", none)).alias("head"),
        F.concat_ws(" ", "body", given(records, "labels", none), given(records, "shelves", none)).alias("text"),
        F.struct("href", "location").alias("place"),
        given(records, "legacy", F.lit(False)).alias("legacy"),
        given(records, "shelves", none).alias("shelves"),
    )
    own = compatible_columns(own, "head", "text")
    own = own.select("record_id", "title", "place", "legacy", "shelves", F.lower("head").alias("head"), F.lower("text").alias("text"))
    words = asked.select("query_id", F.explode("words").alias("word"))
    list_ = [r["word"] for r in words.select("word").distinct().limit(FEW_WORDS + 1).collect()]
    listed = (lambda c: among(F.col(c), list_)) if len(list_) <= FEW_WORDS else (lambda c: tokens(F.col(c)))
    own = own.withColumn("__head", listed("head")).withColumn("__text", listed("text"))
    kept = F.transform(F.array_union("__head", "__text"), lambda w: F.struct(w.alias("word"), F.array_contains(F.col("__head"), w).cast("int").alias("in_title")))
    hit = own.withColumn("titles", F.transform(F.split("head", mark), normalized)).select("record_id", "title", "place", "legacy", "shelves", "titles", F.inline(kept)).join(words, "word")
    found = hit.groupBy("query_id", "record_id").agg(
        F.count("*").alias("hits"), F.sum("in_title").alias("title_hits"), *[F.min(c).alias(c) for c in ("title", "place", "legacy", "shelves", "titles")]
    )
    found = found.join(asked.select("query_id", "phrase", "n_words", "shelf"), "query_id").where(eligible(F.col("shelf"), F.col("legacy"), F.col("shelves")))
    whole = F.when(F.array_contains("titles", F.col("phrase")), 100000).when(F.col("hits") == F.col("n_words"), 10000).otherwise(0)
    found = found.withColumn("score", (whole + F.col("hits") * 100 + F.col("title_hits") * 10).cast("long"))
    order = (F.desc("score"), F.asc("title"), F.asc("record_id"))
    first = found.withColumn("n", F.row_number().over(Window.partitionBy("query_id", "place").orderBy(*order))).where("n = 1")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= limit)
    return ranked.select("query_id", F.col("rank").cast("long").alias("rank"), "record_id", "score")


def recall(found: DataFrame, expected: DataFrame, k: int) -> DataFrame:
    """Of the expected (query_id, record_id) pairs, how many are among the first k; null expects no hit at all."""
    top = found.where(F.col("rank") <= k).groupBy("query_id").agg(F.collect_set("record_id").alias("ids"))
    right = F.when(F.col("record_id").isNull(), F.col("ids").isNull()).otherwise(F.coalesce(F.array_contains("ids", F.col("record_id")), F.lit(False)))
    return expected.join(top, "query_id", "left").agg(F.count("*").alias("tasks"), F.count_if(right).alias("passed"))
