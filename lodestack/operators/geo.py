"""Coverage of target rectangles by map sheets, exactly, by strips between all horizontal edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import polygons

_BOX = ("x0", "y0", "x1", "y1")


def valid(df: DataFrame) -> DataFrame:
    """Boxes with finite corners in order."""
    finite = [~F.isnan(c) & F.col(c).isNotNull() & (F.abs(c) < float("inf")) for c in _BOX]
    test = finite[0] & finite[1] & finite[2] & finite[3] & (F.col("x0") < F.col("x1")) & (F.col("y0") < F.col("y1"))
    return df.where(test)


def touching(regions: DataFrame, sheets: DataFrame) -> DataFrame:
    """Pairs of (region_id, box) and (sheet_id, box) that share an area; each is found once."""
    r = valid(regions).select("region_id", *[F.col(c).alias(f"a{c}") for c in _BOX])
    s = valid(sheets).withColumnsRenamed({c: f"b{c}" for c in _BOX})
    pairs = polygons.overlaps(r, s).withColumnsRenamed({f"a{c}": f"r_{c}" for c in _BOX} | {f"b{c}": c for c in _BOX})
    return pairs.where((F.col("x0") < F.col("r_x1")) & (F.col("x1") > F.col("r_x0")) & (F.col("y0") < F.col("r_y1")) & (F.col("y1") > F.col("r_y0")))


def rings() -> Column:
    """A box as the rings of a polygon."""
    corner = lambda x, y: F.array(F.col(x).cast("double"), F.col(y).cast("double"))
    return F.array(F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1"), corner("x0", "y0")))


def holes(regions: DataFrame, sheets: DataFrame) -> DataFrame:
    """(region_id, x0, y0, x1, y1): uncovered rectangles of each region, with no tolerance; a region is dealt to its strips."""
    found = polygons.uncovered(valid(regions).select("region_id", rings().alias("rings")), valid(sheets))
    return found.select("region_id", F.col("west").alias("x0"), F.col("bottom").alias("y0"), F.col("east").alias("x1"), F.col("top").alias("y1"))


def finest_complete(regions: DataFrame, sheets: DataFrame, scales: DataFrame, budget: int) -> DataFrame:
    """(scale, bytes, holes, fits, chosen): for each scale the bytes of its touching sheets and the holes left; the
    finest complete scale within the budget is chosen. The scales are a handful; ``scales`` lists them."""
    names = [r["scale"] for r in scales.select("scale").distinct().orderBy("scale").collect()]
    rows = None
    for scale in names:
        own = sheets.where(F.col("scale") == scale)
        used = touching(regions, own).select("sheet_id").distinct().join(own, "sheet_id").agg(F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes"))
        left = holes(regions, own.drop("scale")).agg(F.count("*").alias("holes"))
        one = used.join(F.broadcast(left), F.lit(True)).select(F.lit(scale).alias("scale"), "bytes", "holes")
        rows = one if rows is None else rows.union(one)
    rows = rows.withColumn("fits", (F.col("holes") == 0) & (F.col("bytes") <= budget))
    best = rows.where("fits").agg(F.min("scale").alias("best"))
    return rows.join(F.broadcast(best), F.lit(True)).withColumn("chosen", F.coalesce(F.col("scale") == F.col("best"), F.lit(False))).drop("best")
