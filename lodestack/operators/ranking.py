"""Ranking operators: interleaving, chunking, first-of-key and hash-ordered samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root


def interleave(df: DataFrame, shelf: str, work: str, order: list[Column], limit: int, offset: int = 0) -> DataFrame:
    """Round-robin over shelves: turn by turn, shelves in order of their name, each work once.

    A work that was already taken still uses its shelf's turn, so duplicates go after the turns are dealt.
    """
    turn = placed(df, shelf, order, "turn")
    first = turn.withColumn("n", F.row_number().over(Window.partitionBy(work).orderBy("turn", shelf))).where("n = 1").drop("n")
    return first.orderBy("turn", shelf).offset(offset).limit(limit)


def chunks(df: DataFrame, key: str, order: list[Column], size: int) -> DataFrame:
    """Adds page, previous and next page within each group of at most ``size`` rows a page."""
    df = placed(df, key, order, "__n", "__of").withColumn("page", F.floor((F.col("__n") - 1) / size)).withColumn("last", F.floor((F.col("__of") - 1) / size))
    return df.withColumn("previous_page", F.when(F.col("page") > 0, F.col("page") - 1)).withColumn("next_page", F.when(F.col("page") < F.col("last"), F.col("page") + 1)).drop("last", "__n", "__of")


def hash_sample(df: DataFrame, key: str, seed: str, n: int) -> DataFrame:
    """``n`` rows in an order that depends on the seed and each row's key only."""
    return df.withColumn("draw", F.sha2(F.concat(F.lit(seed), F.col(key).cast("string")), 256)).orderBy("draw").limit(n)


def numbered(df: DataFrame, order: list[Column], out: str = "position") -> DataFrame:
    """Adds ``out``: each row's place, from 1, in the order of all rows. Rows are dealt into ranges of the order and
    numbered within them; only a count for each range, as many as shuffle partitions, goes through one task."""
    spark = df.sparkSession
    checkpoint_root(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Written, so the ranges are the same in both uses. The upper bits of the number are the partition.
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__m", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("__m", 33)
    counts = ranged.groupBy(part.alias("__p")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    own = ranged.withColumn("__p", part).join(F.broadcast(offsets), "__p")  # one row a range
    return own.withColumn(out, F.col("__before") + F.col("__m").bitwiseAND((1 << 33) - 1) + 1).drop("__p", "__m", "__before")


def placed(df: DataFrame, key: str, order: list[Column], out: str, size: str | None = None) -> DataFrame:
    """Adds ``out``: each row's place, from 1, within its key, and ``size``, how many rows the key has. A key may hold most
    rows: all are numbered by ranges of (key, order), and a key's places begin at its least number."""
    all_ = numbered(df, [F.col(key).asc_nulls_first(), *order], "__position")
    first = all_.groupBy(F.col(key).alias("__key")).agg(F.min("__position").alias("__first"), F.count("*").alias("__size"))
    own = all_.join(first, F.col(key).eqNullSafe(F.col("__key"))).withColumn(out, F.col("__position") - F.col("__first") + 1)
    return (own.withColumn(size, F.col("__size")) if size else own).drop("__position", "__key", "__first", "__size")


def running(df: DataFrame, order: list[Column], value: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over this row and all before it. Rows are dealt into ranges of the order; only a sum
    for each range goes through one task."""
    spark = df.sparkSession
    checkpoint_root(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__m", F.monotonically_increasing_id()).checkpoint()
    ranged = ranged.withColumn("__p", F.shiftright("__m", 33))
    sums = ranged.groupBy("__p").agg(F.sum(value).alias("__s"))
    before = sums.select("__p", F.coalesce(F.sum("__s").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__b"))
    here = F.sum(value).over(Window.partitionBy("__p").orderBy("__m").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return ranged.withColumn("__h", here).join(F.broadcast(before), "__p").withColumn(out, F.col("__b") + F.col("__h")).drop("__m", "__p", "__h", "__b")  # one row a range


def within_budget(df: DataFrame, place: str, size: str, budget: int) -> DataFrame:
    """Adds ``taken``: whether a row is taken, going through ``place`` in order and taking what still fits the budget.

    A row that does not fit is passed over and the next ones are tried. A round takes the longest run that fits of the rows
    no larger than what is left; the row that ends it is passed over. So what is left, or the size that can still be
    taken, falls by half in every other round or so, and rounds are few however many rows there are.
    """
    checkpoint_root(df.sparkSession)
    df = df.checkpoint()
    taken, left, begin = None, budget, None
    while True:
        open_ = df.where(F.col(size) <= left)
        open_ = open_.where(F.col(place) > begin) if begin is not None else open_
        sums = running(open_.select(place, size), [F.asc(place)], size, "__sum").checkpoint()
        stop = sums.where(F.col("__sum") > left).agg(F.min(place)).first()[0]
        run = sums if stop is None else sums.where(F.col(place) < stop)
        taken = run.select(place) if taken is None else taken.union(run.select(place))
        if stop is None:
            break
        left -= run.agg(F.coalesce(F.max("__sum"), F.lit(0))).first()[0]
        begin = stop
    return df.join(taken.withColumn("taken", F.lit(True)), place, "left").fillna(False, ["taken"])


def first_works(df: DataFrame, place: str, keys: str) -> DataFrame:
    """Rows that are taken going through ``place`` in order, where a row is passed over if one taken before shares any of its
    ``keys`` (array). In a round every row that comes first at all of its keys is taken, and all that share a key with it
    are passed over; rows without keys are taken. Keys that very many rows share are combined before they are dealt. Both sides
    of each join are dealt, so rounds send nothing through the driver."""
    dealt = lambda side: side.hint("merge")
    checkpoint_root(df.sparkSession)
    rows = df.select(place, F.explode(F.array_distinct(keys)).alias("key")).checkpoint()
    taken = df.where(F.coalesce(F.size(keys), F.lit(0)) <= 0).select(place)
    while not rows.isEmpty():
        least = rows.groupBy("key").agg(F.min(place).alias("__least"))
        late = rows.join(dealt(least), "key").where(F.col(place) > F.col("__least")).select(place).distinct()
        new = rows.select(place).distinct().join(dealt(late), place, "left_anti").checkpoint()
        used = rows.join(dealt(new), place, "left_semi").select("key").distinct()
        out = rows.join(dealt(used), "key", "left_semi").select(place).distinct()
        rows = rows.join(dealt(out), place, "left_anti").checkpoint()
        taken = taken.union(new)
    return df.join(dealt(taken), place, "left_semi")


def stratified(df: DataFrame, stratum: str, key: str, seed: str, share: float, detection: float, screening: int = 8) -> DataFrame:
    """A review sample for each stratum: (stratum, key, draw, role) of the rows with the least hashes of seed and key.

    A stratum's sample is as large as it takes to meet a defective row with the chance ``detection`` if a ``share`` of it is
    defective; its first ``screening`` rows are read first. Two passes: the hashes are counted in 65,536 equal ranges, which
    gives each stratum a bound that holds all of its sample and little more, and only rows under the bound are ranked.
    """
    from math import ceil, log1p

    most = ceil(log1p(-detection) / log1p(-share))
    draw = F.sha2(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")), 256)
    rows = df.where(F.col(key).isNotNull()).select(stratum, key, draw.alias("draw"), F.conv(F.substring(draw, 1, 4), 16, 10).cast("int").alias("__range"))
    counts = rows.groupBy(stratum, "__range").agg(F.count("*").alias("n"))
    # A stratum has at most 65,536 counts, however many rows.
    upto = F.sum("n").over(Window.partitionBy(stratum).orderBy("__range"))
    bound = counts.withColumn("upto", upto).where(F.col("upto") - F.col("n") < most).groupBy(F.col(stratum).alias("__stratum")).agg(F.max("__range").alias("__bound"))
    near = rows.join(bound, F.col(stratum).eqNullSafe(F.col("__stratum"))).where(F.col("__range") <= F.col("__bound"))
    place = F.row_number().over(Window.partitionBy(stratum).orderBy("draw", key))
    sample = near.withColumn("n", place).where(F.col("n") <= most)
    return sample.select(stratum, key, "draw", F.when(F.col("n") <= screening, "screening").otherwise("escalation").alias("role"))


def encounter(population: Column, defective: Column, sample: int) -> Column:
    """Chance that ``sample`` rows, or all there are, drawn without replacement hold a defective one (hypergeometric)."""
    draws = F.sequence(F.lit(0), F.least(population, F.lit(sample)).cast("int") - 1)
    miss = F.aggregate(draws, F.lit(1.0), lambda m, i: m * F.greatest(F.lit(0), population - defective - i) / (population - i))
    return F.when(population > 0, 1 - miss).otherwise(0.0)
