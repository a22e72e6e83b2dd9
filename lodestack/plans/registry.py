"""All registered queries and the SQL that states the same result.

``statement`` registers a query written in SQL. Tables are named in braces; where the two dialects differ the text
holds ``[[ours||theirs]]``. ``query`` registers a DataFrame function together with its SQL.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import importable

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
_CHOICE = re.compile(r"\[\[(.*?)\|\|(.*?)\]\]", re.S)
_TABLE = re.compile(r"\{(" + "|".join(TABLES) + r")\}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that a task gets where a query deals them itself.
TASK_ROWS = 500_000


def parts(*rows: DataFrame) -> int:
    """Number of partitions that gives a task about ``TASK_ROWS`` of the rows: adaptive execution would join partitions to few
    of tens of megabytes, whose sorts and hash maps take many times that."""
    spark = rows[0].sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), sum(r.count() for r in rows) // TASK_ROWS + 1)


def statement(name: str, text: str) -> None:
    ours = _CHOICE.sub(lambda m: m[1], text)
    names = sorted(set(_TABLE.findall(ours)))

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(ours, **{n: table(spark, sf_dir, n) for n in names})

    QUERIES[name] = run
    ORACLE_SQL[name] = _TABLE.sub(r"\1", _CHOICE.sub(lambda m: m[2], text))


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register
