"""Sinks: deterministic documents, checksum lines, content-addressed bundles, pages of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import ranking


def json_rows(df: DataFrame) -> DataFrame:
    """Each row as JSON with fields in alphabetic order, so equal rows give equal bytes."""
    return df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("value"))


def write_json(df: DataFrame, path: str, order: list[str]) -> None:
    """Sorted JSON lines; an existing output is an error, never overwritten."""
    json_rows(df.orderBy(*order)).write.mode("errorifexists").text(path)


def checksum_lines(files: DataFrame) -> DataFrame:
    """Lines of a checksum manifest from (sha256, file), by file."""
    return files.orderBy("file").select(F.concat("sha256", F.lit("  "), "file").alias("value"))


#: Hashes that are joined into one text at a time.
_PART = 256


def digest(df: DataFrame, order: list[str]) -> DataFrame:
    """One row: (records, digest) of all rows in their order.

    Rows are hashed by themselves and numbered in their order by ranges; then the hashes of ``_PART`` neighbours are hashed
    as one, and so on up a tree, until one is left. So no task ever holds more than a part, however many rows there are.
    """
    rows = ranking.numbered(df.select(*order, F.sha2(json_row(df), 256).alias("h")), [F.asc(c) for c in order], "n").select((F.col("n") - 1).alias("n"), "h").checkpoint()
    records = count = rows.count()
    while count > 1:
        part = rows.groupBy(F.floor(F.col("n") / _PART).alias("p")).agg(F.sort_array(F.collect_list(F.struct("n", "h"))).alias("x"))
        rows = part.select(F.col("p").alias("n"), F.sha2(F.concat_ws("", F.transform("x", lambda x: x["h"])), 256).alias("h")).checkpoint()
        count = -(-count // _PART)
    return rows.agg(F.lit(records).cast("long").alias("records"), F.coalesce(F.min("h"), F.sha2(F.lit(""), 256)).alias("digest"))


def json_row(df: DataFrame) -> Column:
    return F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})


def write_bundle(df: DataFrame, folder: str, order: list[str]) -> str:
    """Writes the rows under a name given by their own digest, if they are not there yet, and returns the digest."""
    name = digest(df, order).first()["digest"]
    json_rows(df).write.mode("ignore").text(f"{folder}/{name}")
    return name


def bounded_pages(df: DataFrame, key: str, order: list[Column], body: str, most_rows: int, most_bytes: int) -> DataFrame:
    """Adds page: rows in order, a new page where the rows or the bytes so far of a page would pass the bound.

    Bytes are cut by their running sum, so a page holds at most ``most_bytes`` plus one row's.
    """
    w = Window.partitionBy(key).orderBy(*order)
    run = df.withColumn("__b", F.sum(F.octet_length(body)).over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.octet_length(body)).withColumn("__r", F.row_number().over(w) - 1)
    return run.withColumn("page", F.dense_rank().over(Window.partitionBy(key).orderBy(F.floor(F.col("__r") / most_rows), F.floor(F.col("__b") / most_bytes))) - 1).drop("__b", "__r")


def listing_pages(df: DataFrame, key: str, title: str, href: str) -> DataFrame:
    """One static HTML list for each key."""
    escape = lambda c: F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    item = F.concat(F.lit('<li><a href="'), escape(F.col(href)), F.lit('">'), escape(F.col(title)), F.lit("</a></li>"))
    return df.groupBy(key).agg(F.concat(F.lit("<ul>"), F.concat_ws("", F.sort_array(F.collect_list(item))), F.lit("</ul>")).alias("html"))
