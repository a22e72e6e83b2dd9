"""Resolution of a selection of collections, and its capacity arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def chosen(defaults: DataFrame, include: DataFrame, exclude: DataFrame, key: str = "resource_id") -> DataFrame:
    """Defaults and includes without excludes; a key in both lists is an error."""
    both = include.select(key).intersect(exclude.select(key))
    picked = defaults.select(key).union(include.select(key)).distinct().join(exclude.select(key), key, "left_anti")
    clash = both.agg(F.count("*").alias("n")).select(F.when(F.col("n") > 0, F.raise_error(F.lit("included and excluded at once")).cast("boolean")).otherwise(F.lit(True)).alias("ok"))
    return picked.join(F.broadcast(clash), F.col("ok")).drop("ok")  # one row


def resolve(resources: DataFrame, members: DataFrame, assets: DataFrame, picked: DataFrame, replacements: DataFrame, overrides: DataFrame) -> DataFrame:
    """One row for each picked collection.

    resources (resource_id, target_bytes, status), members (resource_id, asset_id), assets (asset_id, size_bytes,
    resolved), replacements (resource_id, asset_id: the collection takes the asset's place elsewhere; credited to
    the collections that listed it), overrides (resource_id, target_bytes).

    An asset replaced by a picked collection leaves all others. Known bytes raise a target, never lower it. A
    ready collection with unresolved members is partial, and one left without members is unresolved.
    """
    replaced = replacements.join(picked, "resource_id", "left_semi").select("asset_id", F.col("resource_id").alias("by"))
    own = members.join(picked, "resource_id", "left_semi").join(replaced, "asset_id", "left").join(assets, "asset_id", "left")
    gone = F.col("by").isNotNull() & (F.col("by") != F.col("resource_id"))
    sums = own.groupBy("resource_id").agg(
        F.count_if(~gone).alias("members"),
        F.count_if(~gone & F.coalesce("resolved", F.lit(False))).alias("resolved"),
        F.coalesce(F.sum(F.when(~gone & F.col("resolved"), F.col("size_bytes"))), F.lit(0)).alias("known_bytes"),
        F.coalesce(F.sum(F.when(gone, F.col("size_bytes"))), F.lit(0)).alias("credit_bytes"),
    )
    rows = resources.join(picked, "resource_id", "left_semi").join(sums, "resource_id", "left").join(overrides.select("resource_id", F.col("target_bytes").alias("own_target")), "resource_id", "left")
    rows = rows.fillna(0, ["members", "resolved", "known_bytes", "credit_bytes"]).withColumn("planning_bytes", F.coalesce("own_target", "target_bytes"))
    status = F.when(F.col("members") == 0, "unresolved").when((F.col("resolved") < F.col("members")) & (F.col("status") == "ready"), F.when(F.col("resolved") > 0, "partial").otherwise("unresolved")).otherwise(F.col("status"))
    over = F.raise_error(F.concat(F.col("resource_id").cast("string"), F.lit(": credit exceeds the planned target"))).cast("long")
    adjusted = F.when(F.col("credit_bytes") > F.col("planning_bytes"), over).otherwise(F.col("planning_bytes") - F.col("credit_bytes"))
    return rows.select("resource_id", status.alias("status"), "members", "resolved", "known_bytes", "credit_bytes", adjusted.alias("adjusted_bytes")).withColumn("effective_bytes", F.greatest("adjusted_bytes", "known_bytes"))


def capacity(assets: DataFrame, profile: DataFrame) -> DataFrame:
    """One row of sums and checks for each profile (profile, capacity_bytes, reserve_bytes, discovery_bytes,
    floor_bytes, ceiling_bytes); assets have size_bytes, role in document, supporting or software, and direct."""
    size = lambda c: F.coalesce(F.sum(F.when(c, F.col("size_bytes"))), F.lit(0))
    sums = assets.agg(F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("content_bytes"), size(F.col("role") == "software").alias("reader_bytes"), size(F.col("role") == "supporting").alias("supporting_bytes"), size((F.col("role") == "document") & F.col("direct")).alias("direct_bytes"))
    df = profile.join(F.broadcast(sums), F.lit(True))  # one row
    known = F.col("content_bytes") - F.col("reader_bytes") - F.col("supporting_bytes")
    final = F.col("content_bytes") + F.col("discovery_bytes")
    window = F.when(F.col("floor_bytes").isNull(), "not-specified").when(known < F.col("floor_bytes"), "below-target").when(known > F.col("ceiling_bytes"), "above-target").otherwise("in-range")
    return df.select("profile", "content_bytes", "reader_bytes", "supporting_bytes", "direct_bytes", known.alias("knowledge_bytes"), final.alias("final_bytes"), F.expr("(content_bytes - reader_bytes - supporting_bytes) * 100 DIV capacity_bytes").alias("utilization_percent"), F.greatest(F.lit(0), F.coalesce(F.col("floor_bytes"), F.lit(0)) - known).alias("shortfall_bytes"), window.alias("target_window"), (final + F.col("reserve_bytes") <= F.col("capacity_bytes")).alias("fits"))
