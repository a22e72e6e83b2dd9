"""Integrity as queries: a check is a DataFrame of violations, and passing is its being empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(df: DataFrame, entity: str, key: str, rules: dict[str, Column]) -> DataFrame:
    """(entity, id, rule) for every rule that a row breaks; all rules are tested in one pass."""
    broken = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True)), F.lit(name)) for name, c in rules.items()]))
    return df.select(F.lit(entity).alias("entity"), F.col(key).cast("string").alias("id"), F.explode(broken).alias("rule"))


def repeated(df: DataFrame, entity: str, key: str, rule: str = "repeated id") -> DataFrame:
    return df.groupBy(F.col(key).cast("string").alias("id")).agg(F.count("*").alias("n")).where("n > 1").select(F.lit(entity).alias("entity"), "id", F.lit(rule).alias("rule"))


def unknown(df: DataFrame, entity: str, key: str, ref: str, known: DataFrame, known_key: str) -> DataFrame:
    """References that name nothing."""
    return df.where(F.col(ref).isNotNull()).join(known.select(F.col(known_key).alias(ref)), ref, "left_anti").select(F.lit(entity).alias("entity"), F.col(key).cast("string").alias("id"), F.lit(f"unknown {ref}").alias("rule"))


def verify(expected: DataFrame, actual: DataFrame, key: str = "file", value: str = "sha256") -> DataFrame:
    """(key, status): OK, MISSING, FAILED or UNKNOWN for every expected or actual key."""
    e, a = expected.select(key, F.col(value).alias("__e")), actual.select(key, F.col(value).alias("__a"))
    status = F.when(F.col("__a").isNull(), "MISSING").when(F.col("__e").isNull(), "UNKNOWN").when(F.col("__e") != F.col("__a"), "FAILED").otherwise("OK")
    return e.join(a, key, "full_outer").select(key, status.alias("status"))


def difference(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, change) of rows added, removed or changed in any column."""
    rest = [c for c in before.columns if c != key]
    b = before.select(key, F.struct(*rest).alias("__b"))
    a = after.select(key, F.struct(*rest).alias("__a"))
    change = F.when(F.col("__b").isNull(), "added").when(F.col("__a").isNull(), "removed").when(~F.col("__a").eqNullSafe(F.col("__b")), "changed")
    return b.join(a, key, "full_outer").select(key, change.alias("change")).where("change IS NOT NULL")


def path_conflicts(paths: DataFrame, path: str = "path") -> DataFrame:
    """Paths that are equal but for case, or are at once a file and a folder of another."""
    low = paths.select(F.col(path).alias("path"), F.lower(path).alias("key"))
    parts = F.split("key", "/")
    folders = low.select(F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda n: F.array_join(F.slice(parts, 1, n), "/"))).alias("key"), F.size(parts).alias("n")).where("n > 1").select("key").distinct()
    same = low.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.lit("same but for case").alias("conflict"))
    return same.union(low.join(folders, "key", "left_semi").select("key", F.lit("file and folder").alias("conflict")).distinct())


def merge_new(target: DataFrame, incoming: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Target with the incoming rows of new keys, and incoming rows whose key is there with other values."""
    fresh = incoming.join(target.select(key), key, "left_anti").select(*target.columns)
    known = incoming.select(*target.columns).join(target.select(key), key, "left_semi").select(*target.columns)
    return target.unionByName(fresh), known.exceptAll(target.join(incoming.select(key), key, "left_semi").select(*target.columns))
