"""Filter interaction audit: what each filter removes, after any subset of the others, from counts of failure masks.

Every row gets a mask of the filters that it fails. Rows are counted once for each part and mask, with their labels; from
there on nothing depends on the number of rows. The subset-zeta transform of these 2 ** k counts gives, for every set of
filters at once, how many rows fail nothing but filters of that set, which are the survivors of all other filters. A
step of an order is then the difference of two neighbouring sets, and so is what it costs in labelled rows; a filter's
sum over all orders weighs each set by the number of orders that put exactly its filters first.

Whether a text is the first of its copies needs no join of the rows: texts are counted by hash, part and mask with the
least key of each, and only these counts meet by hash.

Defined results: a null text is empty, a null part the empty string; a row with a null key is nobody's copy and has no
labels; rows that share a key are counted one by one, none of them a copy of the other; a row has a label if any label
row of its key says so; parts without rows do not appear, so an empty table gives no row; very long texts are read whole;
of other columns none is read.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
FEWEST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
_WORD = r"[^\x20\x09-\x0D]+"
_COUNTS = ("n", "good", "toxic")


def text_failures(text: Column) -> list[Column]:
    """Failure conditions of the filters A to D, those that depend on the text alone."""
    words = F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return [
        F.size(words) < FEWEST_WORDS,
        100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * F.size(words),
        100 * capitals > MOST_CAPITALS * F.char_length(text),
        text.rlike(r"[#$%&*|]"),
    ]


def mask_counts(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): rows and labelled rows for each part and set of failed filters, bit i for filter i."""
    whole = F.coalesce(F.col(text), F.lit(""))
    mask = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(text_failures(whole))), F.lit(0))
    own = docs.select(F.col(key).alias("k"), F.sha2(whole, 256).alias("h"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), mask.alias("mask"))
    known = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    # One row a key and text: rows that share a key add up here, under the join's own partitioning.
    rows = own.join(known, "k", "left").groupBy("k", "h", "part", "mask").agg(F.count("*").alias("n"), F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    rows = rows.select("k", "h", "part", "mask", "n", *[(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in _COUNTS[1:]])
    keyed = F.when(F.col("k").isNotNull(), F.struct("k", *_COUNTS))
    sums = [F.sum(c).alias(c) for c in _COUNTS]
    free = [F.sum(F.when(F.col("k").isNull(), F.col(c)).otherwise(0)).alias(f"free_{c}") for c in _COUNTS]
    groups = rows.groupBy("h", "part", "mask").agg(*sums, *free, F.min(keyed).alias("first"))
    least = F.min("first.k").over(Window.partitionBy("h"))  # a hash has at most one row for each part
    lead = F.coalesce(F.col("first.k") == least, F.lit(False))
    stay = [(F.col(f"free_{c}") + F.when(lead, F.col(f"first.{c}")).otherwise(0)).alias(f"stay_{c}") for c in _COUNTS]
    groups = groups.select("part", "mask", *_COUNTS, *stay)
    copies = F.struct((F.col("mask") + (1 << 4)).alias("mask"), *[(F.col(c) - F.col(f"stay_{c}")).alias(c) for c in _COUNTS])
    firsts = F.struct("mask", *[F.col(f"stay_{c}").alias(c) for c in _COUNTS])
    halves = groups.select("part", F.explode(F.array(firsts, copies)).alias("x")).select("part", "x.*")
    return halves.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in _COUNTS])


def zeta(df: DataFrame, columns: tuple[str, ...], k: int) -> DataFrame:
    """Subset sums of arrays of 2 ** k counts: entry s becomes the sum of the entries of all subsets of s."""

    def butterfly(c: str, bit: int) -> Column:
        return F.transform(c, lambda x, s: x + F.when(s.bitwiseAND(F.lit(bit)) != 0, F.get(F.col(c), s - bit)).otherwise(0))

    for i in range(k):  # a projection each
        df = df.withColumns({c: butterfly(c, 1 << i) for c in columns})
    return df


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row for each part, order of all filters and step, from (part, mask, n, good, toxic)."""
    k = len(filters)
    full = (1 << k) - 1
    at = lambda c: F.transform(F.sequence(F.lit(0), F.lit(full)), lambda i: F.coalesce(F.element_at(F.col("m"), i)[c], F.lit(0)))
    by_part = counts.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("mask", F.struct(*_COUNTS)))).alias("m"))  # at most 2 ** k entries
    wide = zeta(by_part.select("part", *[at(c).alias(c) for c in _COUNTS]), _COUNTS, k)
    steps = []
    for order in permutations(range(k)):
        before = 0
        for step, f in enumerate(order, 1):
            steps.append(("".join(filters[i] for i in order), step, 1 << f, before))
            before |= 1 << f
    spark = counts.sparkSession
    plan = spark.createDataFrame(steps, "filter_order string, step int, bit int, before int")
    rows = wide.join(F.broadcast(plan), F.lit(True))  # k! * k rows
    left = lambda c, removed: F.get(F.col(c), F.lit(full).bitwiseXOR(removed))  # noqa: E731  survivors of the filters in ``removed``
    bit, before, after = F.col("bit"), F.col("before"), F.col("before").bitwiseOR(F.col("bit"))
    lost = lambda c: left(c, before) - left(c, after)
    weights = F.array(*[F.lit(factorial(i) * factorial(k - 1 - i)).cast("long") for i in range(k)])
    share = lambda s: F.get(weights, F.bit_count(s)) * (left("n", s) - left("n", s.bitwiseOR(bit)))
    others = F.filter(F.sequence(F.lit(0), F.lit(full)), lambda s: s.bitwiseAND(bit) == 0)
    return rows.select(
        "part",
        "filter_order",
        "step",
        left("n", after).alias("kept"),
        lost("n").alias("removed"),
        (left("n", F.lit(0)) - left("n", bit) - lost("n")).alias("redundant"),
        (left("n", F.lit(full).bitwiseXOR(bit)) - left("n", F.lit(full))).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        F.aggregate(F.transform(others, share), F.lit(0).cast("long"), lambda x, y: x + y).alias("shapley"),
    )
