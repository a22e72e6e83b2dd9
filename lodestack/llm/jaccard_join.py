"""N-gram Jaccard join by multiple global orders: exact links between texts whose shingle sets are alike.

A set of n shingles that is alike in the share t to another shares at least a = ceil(t * n) shingles with it, so under any
order of all shingles the first n - a + k of both hold k common ones, k at most a. That holds under every order at once:
candidates must share ``LEAST_MET`` shingles of these prefixes under the first order and one under each other, and only
those are verified. The first order puts rare shingles first and lists candidates; the second has the same rarities and
other ties, the last is a plain hash. Rarity is read off counts of all documents' shingles in ``BUCKETS`` buckets, so its
size does not grow with the corpus; an order need not be exact, only the same for all.

Sets, not rows, are joined: rows of equal sets are one node. Nodes of a short list, those of one prefix shingle, are all
paired. Long lists come from large groups of near copies, and in large tables from shingles that many texts have by
chance. A node that is on fewer long lists than it has to share shingles must share one on a short list as well, so it is
found there, where it needs as many fewer as it has long lists; only the other nodes, the crowded ones, are compared on
long lists. First each of them is tried with one node of its lists, the one it meets most often; a list that is then
inside one component is done. The others, those of one large component together, are units: their nodes are dealt to
blocks once for a unit, not for each list, and pairs of blocks are compared on arrays, each by itself, which gives a
spanning forest of links and no pairs. No candidate is left out, and no list comes into one task.

Defined results: a null text is empty; a text without words has an empty set and is linked with nothing, other rows like
it included; fewer words than a shingle's are one shingle; rows of equal sets are linked whatever their keys; repeated
rows stay repeated; rows with a null key get the least key of their component, null where there is none; very long texts
are read whole; of other columns none is read. Shingles are told apart by 48 bits of hashes within a pair, sets by 128.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, settle
from .simhash import components

SHINGLE_WORDS = 4
#: Two sets link when 100 * |common| >= PERCENT * |union|.
PERCENT = 85
ORDERS = 3
SEED = 42
BUCKETS = 1 << 20
_PIECE = 1 << 12
_PIECES = BUCKETS // _PIECE
_WORDS_MOST = 150_000
_SETS_MOST = 100_000
#: Shingles that prefixes must share under the first order; nodes on fewer long lists are left out of these.
LEAST_MET = 8
#: Lists of more nodes are long: they are dealt to blocks of so many nodes or so, or of so many shingles, and blocks are
#: compared by parts of so many nodes or shingles, in steps of so many shingles.
LONG = 32
BLOCK = 1536
_BLOCK_SHINGLES = 1 << 20
_PART = 384
_PART_SHINGLES = 1 << 18
_STEP = 4096
#: Shingles of buckets with so many times the mean count are not dealt by themselves: their lists may be too long for a task.
HOT = 64
#: Bytes of each shingle's hash by which sets are compared: a pair of n shingles each is given one too many in common with
#: a chance of n * n / 2 ** 48.
_BYTES = 6
#: Words of 64 bits of the filter that keeps rows of no candidate from being read or dealt again; two bits mark a value.
_FILTER_WORDS = 1 << 16


class _Words(dict):
    """Hashes of words, worked out when first asked for."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return found


class Shingles:
    """Hashes of the distinct word shingles of texts, sorted; hashes of words are remembered, up to a bound. With no words a
    shingle the texts are lists of numbers, which are sets already."""

    def __init__(self, words: int):
        self.words, self.known = words, _Words()

    def of(self, text: str | list[int] | None) -> np.ndarray:
        if not self.words:
            mix = np.array(text or [], np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            return _distinct((mix ^ mix >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9))
        parts = (text or "").encode("utf-8", "replace").lower().split()
        if len(self.known) > _WORDS_MOST:
            self.known = _Words()
        h, k = np.fromiter(map(self.known.__getitem__, parts), np.uint64, len(parts)), min(self.words, len(parts))
        mix = np.full(len(h) - k + 1 if k else 0, k, np.uint64)
        for j in range(k):
            mix ^= h[j : j + len(mix)]
            mix *= np.uint64(0x9E3779B97F4A7C15)
            mix ^= mix >> np.uint64(29)
        mix *= np.uint64(0xBF58476D1CE4E5B9)
        return _distinct(mix)


def _distinct(x: np.ndarray) -> np.ndarray:
    """The sorted different values of an array, which is sorted in place."""
    x.sort()
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def _lists(arrays: list[np.ndarray], kind: type) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays).view(kind) if arrays else np.zeros(0, kind)))


def least_common(n: int, percent: int = PERCENT) -> int:
    """Shingles that a set of n shares at least with any that it links with."""
    return (percent * n + 99) // 100


def prefix_length(n: int, percent: int = PERCENT, met: int = 1) -> int:
    """Length of the prefix that holds ``met`` common shingles, or all that have to be common."""
    return n - least_common(n, percent) + min(met, least_common(n, percent))


def ranks(shingles: np.ndarray, rarity: np.ndarray, order: int) -> np.ndarray:
    """Places of shingles in one of the global orders."""
    x = shingles ^ np.uint64((order + 1) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    if order == ORDERS - 1:
        return x
    return rarity[shingles >> np.uint64(44)].astype(np.uint64) << np.uint64(56) | x >> np.uint64(8)


def _pieces(df: DataFrame) -> DataFrame:
    """Adds up the counts of each piece (piece, counts) in streams; a task holds at most all buckets once."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[piece] = sums.get(piece, 0) + np.frombuffer(counts, f"u{len(counts) // _PIECE}").astype(np.int64)
        # Quarters of powers of two: finer steps are noise of the buckets.
        steps = [np.minimum(255, np.floor(4 * np.log2(x + 1))).astype(np.uint8).tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(steps, pa.binary())], names=["piece", "steps"])

    return df.repartition(min(_PIECES, partitions(df.sparkSession)), "piece").mapInArrow(add, "piece int, steps binary")


def _halves(shingles: np.ndarray) -> tuple[int, int]:
    """Signed halves of a set's digest."""
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64).tolist())


def measured(docs: DataFrame, key: str, text: str, words: int) -> tuple[DataFrame, np.ndarray, int]:
    """(key, hi, lo, n) of every row, ``hi`` and ``lo`` equal for equal sets; the rarity of each bucket of shingles, and from
    which rarity on shingles are hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, counts, waiting = Shingles(words), np.zeros(BUCKETS, np.int64), []
        names, kind = ["key", "hi", "lo", "n", "piece", "counts"], None

        def count() -> None:
            nonlocal waiting, counts
            if waiting:
                counts += np.bincount(np.concatenate(waiting), minlength=BUCKETS)
            waiting = []

        for batch in batches:
            kind = batch.schema.field(0).type
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                sets = [shingles.of(t) for t in part.column(1).to_pylist()]
                waiting += [(x >> np.uint64(44)).astype(np.int64) for x in sets]
                if sum(map(len, waiting)) > BUCKETS:
                    count()
                m, own = part.num_rows, [(*_halves(x), len(x)) for x in sets]
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, pa.int64()) for c in zip(*own, strict=True)], pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names=names)
        count()
        used = [i for i in range(_PIECES) if counts[i * _PIECE : (i + 1) * _PIECE].any()]
        if used:
            own = [counts[i * _PIECE : (i + 1) * _PIECE] for i in used]
            own = [x.astype(np.min_scalar_type(int(x.max()))).tobytes() for x in own]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(used), kind), *[pa.nulls(len(used), pa.int64())] * 3, pa.array(used, pa.int32()), pa.array(own, pa.binary())], names=names)

    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, hi long, lo long, n long, piece int, counts binary")
    rows = settle(rows, "shingle-sets")
    own = rows.where("piece IS NULL").select("key", "hi", "lo", "n")
    rarity = np.zeros(BUCKETS, np.uint8)
    for r in _pieces(rows.where("piece IS NOT NULL").select("piece", "counts")).collect():  # one byte a bucket
        rarity[r["piece"] * _PIECE : (r["piece"] + 1) * _PIECE] = np.frombuffer(bytes(r["steps"]), np.uint8)
    mean = (own.agg(F.sum("n")).first()[0] or 0) / BUCKETS
    return own, rarity, int(4 * np.log2(HOT * (mean + 1)))


def prefixes(docs: DataFrame, text: str, words: int, percent: int, rarity: np.ndarray, hot: int, second: set[tuple[int, int]]) -> DataFrame:
    """(node, n, p0, hot, p1, ...): the prefixes of each set under all orders, hot shingles of the first one apart, and those
    after the first as 16 bits a shingle, for they only have to show that nothing is shared. Sets may come several times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen = Shingles(words), set()
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                found = []
                for t in batch.column(0).slice(i, 256).to_pylist():
                    own = shingles.of(t)
                    node = _node(own, second)
                    if len(own) and node not in seen:
                        if len(seen) > _SETS_MOST:
                            seen.clear()
                        seen.add(node)
                        sizes = [prefix_length(len(own), percent, 1 if k else LEAST_MET) for k in range(ORDERS)]
                        firsts = [own[np.argpartition(ranks(own, rarity, k), p - 1)[:p]] for k, p in enumerate(sizes)]
                        warm = rarity[firsts[0] >> np.uint64(44)] >= hot
                        found.append((node, len(own), firsts[0][~warm], firsts[0][warm], *[_distinct(x.astype(np.uint16)) for x in firsts[1:]]))
                node, n, cold, warm, *others = list(zip(*found, strict=True)) or [[]] * (3 + ORDERS)
                numbers = [pa.array(c, pa.int64()) for c in (node, n)]
                yield pa.RecordBatch.from_arrays([*numbers, _lists(cold, np.int64), _lists(warm, np.int64), *[_lists(x, np.int16) for x in others]], names=["node", "n", "p0", "hot", *_P])

    rest = ", ".join(f"{p} array<short>" for p in _P)
    return docs.select(F.col(text).alias("text")).mapInArrow(run, f"node long, n long, p0 array<long>, hot array<long>, {rest}")


_P = [f"p{k}" for k in range(1, ORDERS)]


def _node(shingles: np.ndarray, second: set[tuple[int, int]]) -> int:
    """A set's number: the first half of its digest, or the second one where another set has the same first half."""
    hi, lo = _halves(shingles)
    return lo if (hi, lo) in second else hi


def _numbered(own: DataFrame) -> tuple[DataFrame, set[tuple[int, int]]]:
    """(node, hi, lo, least) of each set, and the sets that are numbered by their second half: of n sets n * n / 2 ** 65 are
    expected, one or two in ten thousand million."""
    classes = settle(own.where("n > 0").groupBy("hi", "lo").agg(F.min("key").alias("least")), "classes")
    double = classes.groupBy("hi").agg(F.count("*").alias("m"), F.min("lo").alias("lo")).where("m > 1").select("hi", "lo").collect()
    second = {(r["hi"], r["lo"]) for r in double}
    if second:
        spark = own.sparkSession
        marked = F.broadcast(spark.createDataFrame(sorted(second), "hi long, lo long").withColumn("moved", F.lit(True)))
        classes = settle(classes.join(marked, ["hi", "lo"], "left").withColumn("node", F.when(F.col("moved"), F.col("lo")).otherwise(F.col("hi"))).drop("moved"), "classes")
        if classes.groupBy("node").agg(F.count("*").alias("m")).where("m > 1").head(1):
            raise ValueError("three sets share half of their digests")
        return classes, second
    return classes.withColumn("node", F.col("hi")), second


def _among(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows whose ``column`` is a value of ``wanted``'s only column, and few others: they are looked up in a filter of
    fixed size, so that they need not be dealt out for it."""

    def place(k: str) -> list[Column]:
        return [F.pmod(F.xxhash64(k), F.lit(_FILTER_WORDS)).alias("__spot"), *[F.pmod(F.shiftrightunsigned(F.xxhash64(k), b), F.lit(64)).cast("int").alias(f"__bit{b}") for b in (20, 40)]]

    mask = F.expr("shiftleft(1L, __bit20) | shiftleft(1L, __bit40)")
    marks = wanted.select(*place(wanted.columns[0])).groupBy("__spot").agg(F.bit_or(mask).alias("__bits"))  # _FILTER_WORDS rows at most
    found = rows.select("*", *place(column)).join(F.broadcast(marks), "__spot").where(F.col("__bits").bitwiseAND(mask) == mask)
    return found.select(*rows.columns)


def sets_of(docs: DataFrame, key: str, text: str, words: int, wanted: DataFrame, second: set[tuple[int, int]]) -> DataFrame:
    """(node, s): the shingles of the nodes of ``wanted`` (node, least), and of few others. Documents are looked up by the
    least key of each set in a filter of fixed size before their texts are read again."""
    some = _among(docs.select(F.col(key).alias("k"), F.col(text).alias("text")), "k", wanted.select("least")).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                own = [shingles.of(t) for t in batch.column(0).slice(i, 256).to_pylist()]
                packed = [_distinct(x >> np.uint64(64 - 8 * _BYTES)).view(np.uint8).reshape(-1, 8)[:, :_BYTES].tobytes() for x in own]
                yield pa.RecordBatch.from_arrays([pa.array([_node(x, second) for x in own], pa.int64()), pa.array(packed, pa.binary())], names=["node", "s"])

    return some.mapInArrow(run, "node long, s binary")


def _unpacked(s: bytes) -> np.ndarray:
    own = np.zeros((len(s) // _BYTES, 8), np.uint8)
    own[:, :_BYTES] = np.frombuffer(s, np.uint8).reshape(-1, _BYTES)
    return own.view(np.uint64)[:, 0]


def _verified(pairs: DataFrame, percent: int) -> DataFrame:
    """(u, v) of the pairs (u, v, a, b) whose sets are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                x, y = _unpacked(a.as_py()), _unpacked(b.as_py())
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                good.append(100 * common >= percent * (len(both) - common))
            yield batch.select(["u", "v"]).filter(pa.array(good, pa.bool_()))

    return pairs.select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def _alike(a: Column, b: Column, percent: int) -> Column:
    """Sizes that two linked sets can have."""
    return (100 * a >= percent * b) & (100 * b >= percent * a)


def _common(sets: list[np.ndarray], others: list[np.ndarray] | None = None) -> np.ndarray:
    """Numbers of common members of all pairs of sets, or of each with each of others."""
    both = [*sets, *(others or [])]
    _, column, many = np.unique(np.concatenate(both), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(both)), list(map(len, both)))
    again = many[column] > 1  # what one set alone holds is common to none
    row, column = row[again], column[again]
    _, column = np.unique(column, return_inverse=True)
    first = slice(len(sets), None) if others else slice(None)
    total, width = np.zeros((len(sets), len(others or sets)), np.float32), int(column.max()) + 1 if len(column) else 0
    for start in range(0, width, _STEP):
        here = (column >= start) & (column < start + _STEP)
        held = np.zeros((len(both), min(_STEP, width - start)), np.float32)
        held[row[here], column[here] - start] = 1
        total += held[: len(sets)] @ held[first].T
    return total.astype(np.int64)


def _parts(nodes: list[tuple[int, int, np.ndarray]]) -> list[list[tuple[int, int, np.ndarray]]]:
    """Nodes in parts of bounded numbers of nodes and shingles."""
    found, held = [[]], 0
    for x in nodes:
        if found[-1] and (len(found[-1]) >= _PART or held + len(x[2]) > _PART_SHINGLES):
            found.append([])
            held = 0
        found[-1].append(x)
        held += len(x[2])
    return found


def _linked(nodes: list[tuple[int, int, np.ndarray]], others: list[tuple[int, int, np.ndarray]], percent: int) -> list[tuple[int, int]]:
    """Links that connect the components of (node, component, set) as all links between both sides do."""
    merged: dict[int, int] = {}

    def top(c: int) -> int:
        while c in merged:
            c = merged[c]
        return c

    found, same = [], others is nodes
    left = _parts(sorted(nodes, key=lambda x: x[1]))
    right = left if same else _parts(sorted(others, key=lambda x: x[1]))
    for k, xs in enumerate(left):
        for ys in right[k:] if same else right:
            a, b = (np.array([top(c) for _, c, _ in part], np.int64) for part in (xs, ys))
            able = a[:, None] != b[None, :]
            rows, columns = np.flatnonzero(able.any(1)), np.flatnonzero(able.any(0))
            if not len(rows):
                continue
            x, y = [xs[r] for r in rows], [ys[c] for c in columns]
            a, b = a[rows], b[columns]
            sets, rest = [s for *_, s in x], None if xs is ys else [s for *_, s in y]
            common, sizes = _common(sets, rest), [np.array([len(s) for *_, s in part]) for part in (x, y)]
            alike = 100 * common >= percent * (sizes[0][:, None] + sizes[1][None, :] - common)
            for i in np.flatnonzero(alike.any(1)):
                hit = np.flatnonzero(alike[i] & (b != a[i]))
                new, at = np.unique(b[hit], return_index=True)
                for c, j in zip(new.tolist(), hit[at].tolist(), strict=True):
                    found.append((x[i][0], y[j][0]))
                    merged[c] = int(a[i])
                b[np.isin(b, new)] = a[i]
                a[np.isin(a, new)] = a[i]
    return found


def _block_links(rows: DataFrame, percent: int) -> DataFrame:
    """(u, v): links that connect the nodes of one block pair (unit, i, j) of different components as all do; rows have
    node, comp, block and s. Blocks are bounded, so a task holds one pair of them at a time."""
    names = ["unit", "i", "j", "node", "comp", "block", "s"]

    def links(group: list[tuple]) -> pa.RecordBatch:
        own: dict[int, list] = {b: [] for b in group[0][1:3]}
        for node, comp, block, s in {r[3]: r[3:] for r in group}.values():  # a node may come twice
            own[block].append((node, comp, _unpacked(s)))
        sides = list(own.values())
        found = _linked(sides[0], sides[-1], percent) if all(sides) else []
        u, v = (np.array([f[k] for f in found], np.int64) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if held and held[0][:3] != r[:3]:
                    yield links(held)
                    held = []
                held.append(r)
        if held:
            yield links(held)

    return rows.select(*names).mapInArrow(run, "u long, v long").distinct()


def _units(own: DataFrame) -> DataFrame:
    """(unit, node, n, comp): the nodes of lists (token, node, n, comp) by what is compared together. The lists in which one
    component has most nodes are one unit, unless that makes more rows than the lists apart; a unit's number may be that of
    another one, which then are compared together."""

    def rows(nodes: str) -> Column:
        return F.col(nodes) * F.ceil(F.col(nodes) / BLOCK)

    most = own.groupBy("token", "comp").agg(F.count("*").alias("k")).groupBy("token").agg(F.max_by("comp", F.struct("k", "comp")).alias("unit"), F.sum("k").alias("m"))
    most = settle(most, "units")
    apart = most.groupBy("unit").agg(F.sum(rows("m")).alias("apart"))
    joint = own.join(most, "token").select("unit", "node").distinct().groupBy("unit").agg(F.count("*").alias("m"))
    good = joint.join(apart, "unit").where(rows("m") <= F.col("apart")).select("unit", F.lit(True).alias("joint"))
    names = most.join(good, "unit", "left").select("token", F.when(F.col("joint"), F.col("unit")).otherwise(F.col("token")).alias("unit"))
    return own.join(names, "token").select("unit", "node", "n", "comp").distinct()


def _links(docs: DataFrame, key: str, text: str, words: int, percent: int, classes: DataFrame, second: set[tuple[int, int]], rarity: np.ndarray, hot: int) -> DataFrame | None:
    """(u, v), u > v: links that connect the nodes as all links do; None if there are none."""
    nodes = settle(prefixes(docs, text, words, percent, rarity, hot, second), "prefixes")
    of = Window.partitionBy("token")
    cold = nodes.select(F.explode("p0").alias("token"), "node", "n").withColumn("a", F.min("node").over(of)).withColumn("b", F.max("node").over(of))
    lists = cold.where("a <> b").select("token", "node", "n").distinct().union(nodes.select(F.explode("hot").alias("token"), "node", "n").distinct())
    lists = settle(lists, "lists")
    sizes = settle(lists.groupBy("token").agg(F.count("*").alias("m")).where("m > 1"), "list-sizes")
    own = settle(lists.join(sizes.where(F.col("m") > LONG).select("token"), "token"), "long-lists")
    places = settle(own.groupBy("node").agg(F.count("*").alias("l")), "long-counts")
    rest, known = nodes.select("node", *_P), None

    def joined(pairs: DataFrame, own: DataFrame, names: list[str]) -> DataFrame:
        own = _among(own, "node", pairs.select(F.explode(F.array("u", "v")))).groupBy("node").agg(*[F.first(c).alias(c) for c in names])
        for end in ("u", "v"):
            pairs = pairs.join(own.select(F.col("node").alias(end), *[F.col(c).alias(f"{end}_{c}") for c in names]), end)
        return pairs

    def fetch(wanted: DataFrame) -> None:
        nonlocal known
        if known is not None:
            wanted = wanted.join(known.select("node"), "node", "left_anti")
        new = settle(sets_of(docs, key, text, words, settle(classes.join(wanted, "node").select("node", "least"), "wanted"), second), "sets")
        known = new if known is None else known.union(new)

    def check(pairs: DataFrame) -> DataFrame:
        """The pairs (u, v) that share prefix shingles under all other orders, and then are alike."""
        agreed = joined(settle(pairs, "pairs"), rest, _P)
        for p in _P:
            agreed = agreed.where(F.arrays_overlap(f"u_{p}", f"v_{p}"))
        agreed = settle(agreed.select("u", "v"), "candidates")
        fetch(agreed.select(F.col("u").alias("node")).union(agreed.select(F.col("v").alias("node"))).distinct())
        both = joined(agreed, known, ["s"]).withColumnsRenamed({"u_s": "a", "v_s": "b"})
        return settle(_verified(both, percent), "links")

    def least(n: Column) -> Column:
        return F.floor((n * percent + 99) / 100)

    # Short lists: pairs that meet in as many of them as they have to, less those long lists that both may be on. Pairs of
    # crowded nodes, which may meet on long lists only, are found there.
    short = lists.join(places, "node", "left").fillna(0, ["l"]).join(sizes.where(F.col("m") <= LONG).select("token"), "token")
    x, y = (short.select("token", F.col("node").alias(end), F.col("n").alias(f"{end}n"), F.col("l").alias(f"{end}l")) for end in ("u", "v"))
    pairs = x.join(y, "token").where((F.col("u") > F.col("v")) & _alike(F.col("un"), F.col("vn"), percent))
    must, most = F.least(F.lit(LEAST_MET), least(F.col("un")), least(F.col("vn"))), F.least("ul", "vl")
    pairs = pairs.groupBy("u", "v").agg(F.count("*").alias("met"), F.min(F.when(most < must, must - most).otherwise(must)).alias("must")).where("met >= must")
    links = check(pairs.select("u", "v"))

    # Long lists of crowded nodes: one trial for each node, then what is not yet inside one component. A node has to share
    # no fewer shingles with any other than the least set that it may link with has to.
    own = own.join(places, "node").where(F.col("l") >= F.least(F.lit(LEAST_MET), least(least(F.col("n"))))).drop("l")
    own = settle(own.join(own.groupBy("token").agg(F.count("*").alias("m")).where("m > 1").select("token"), "token"), "long-lists")
    if own.isEmpty():
        return links
    # Sizes of linked sets lie in the same range or in the one beside it; ranges are wider than the bound.
    band = F.floor(F.log("n") / F.log(F.lit(100 / (percent - 1)))).cast("int")
    tried = own.withColumn("band", band)
    place = F.row_number().over(Window.partitionBy("token", "band").orderBy("node"))
    lead = tried.withColumn("place", place).where("place = 1").select("token", "band", F.col("node").alias("x"), F.col("n").alias("xn"))
    trial = tried.join(lead, ["token", "band"]).where((F.col("node") != F.col("x")) & _alike(F.col("n"), F.col("xn"), percent))
    trial = trial.groupBy("node", "x").agg(F.count("*").alias("met"))
    first = trial.withColumn("place", F.row_number().over(Window.partitionBy("node").orderBy(F.desc("met"), "x"))).where("place = 1")
    links = links.union(check(first.select(F.greatest("x", "node").alias("u"), F.least("x", "node").alias("v")).distinct()))
    roots = components(links, 3)
    own = own.join(roots, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")
    open_ = own.groupBy("token").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b").select("token")
    own = settle(own.join(open_, "token"), "open-lists")
    if own.isEmpty():
        return links
    fetch(own.select("node").distinct())
    nodes = settle(_units(own), "unit-nodes")
    k = F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("w") / _BLOCK_SHINGLES)).cast("int")
    dealt = nodes.join(nodes.groupBy("unit").agg(F.count("*").alias("m"), F.sum("n").alias("w")), "unit").withColumn("k", k)
    # Sets are fetched once for each node of a unit, before it is dealt to pairs of blocks.
    spread = dealt.withColumn("block", F.pmod(F.xxhash64("node"), "k").cast("int")).join(_among(known, "node", nodes.select("node")), "node")
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    spread = spread.select("unit", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "comp", "block", "s").repartition(partitions(docs.sparkSession), "unit", "i", "j").sortWithinPartitions("unit", "i", "j")
    return links.union(settle(_block_links(spread, percent), "links"))


def linked(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id) for every row; component_id is the least key reachable over links. With 0 ``words``
    ``text`` is a list of numbers, the set itself."""
    own, rarity, hot = measured(docs, key, text, words)
    classes, second = _numbered(own)
    links = _links(docs, key, text, words, percent, classes, second, rarity, hot)
    known = classes.withColumn("component_id", F.col("least"))
    if links is not None:
        roots = components(links)
        known = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        known = known.join(known.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    found = own.join(known.select("hi", "lo", "component_id"), ["hi", "lo"], "left")
    return found.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key")).alias("component_id"))
