"""SimHash near-duplicates: 64-bit fingerprints linked through the anchors of a covering code.

Two fingerprints at three or fewer differing bits agree, in one of their two 32-bit halves, up to one bit. On
each half the anchors are the words of the direct sum of two [15,11] Hamming codes and two free bits. Hamming
codes are perfect with covering radius 1, so every half-fingerprint has exactly one nearest anchor. Each
distinct fingerprint is replicated to every anchor within covering radius plus the threshold of one bit, taken
block by block: its nearest anchor, those with one block moved to a codeword at distance two, and those with a
free bit flipped, at most 17 a half. A pair within the threshold therefore meets at an anchor. Fingerprints are
compared anchor by anchor and only a spanning forest of the links found is kept, so a dense group never emits
all of its pairs. Components come from alternating large-star and small-star rounds on the edge table.

``similar`` finds texts whose word shingles are alike, where near copies lie further apart than three bits. Its
candidates are found in the same way, over eight blocks of 32 bits of a longer SimHash of the distinct words, one
bit a block allowed; each candidate link is then checked against the exact similarity of the shingle sets. Texts at
anchors that many share are not paired there: all such texts are joined by ``jaccard_join``, which leaves out no link.

Defined results: null texts are empty; texts without words have fingerprint zero and link like any other; equal
texts share a fingerprint and a component; repeated rows stay repeated; rows with a null key get the least key
of their component. In ``similar`` texts with equal shingle sets, empty ones too, are always linked; so are rows with
equal texts, whatever their key.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, settle

THRESHOLD = 3
SHINGLE_WORDS = 3
SEED = 42
SMALL = 48
_CHUNK = 1 << 16
#: Near copies: words a shingle and least similarity; bits of the wide fingerprint, and in how many of the 128 compared
#: bits candidates may differ; links a text that are checked first, and how many are checked at once.
SIMILAR_WORDS = 5
SIMILAR = 0.8
WIDE = 256
RADIUS = 28
FIRST_LINKS = 8
ALL_AT_ONCE = 32
_WORDS_MOST = 150_000
_FP = [f"f{i}" for i in range(WIDE // 64)]


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash of the word shingles of a text; A-Z are lower-cased, words end at ASCII white space."""
    parts = (text or "").encode("utf-8", "replace").lower().split()
    if not parts:
        return 0
    grams = zip(*(parts[i:] for i in range(words)), strict=False) if len(parts) >= words else [parts]
    n = max(1, len(parts) - words + 1)
    hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(g), SEED) for g in grams), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, _CHUNK):
        ones += np.unpackbits(hashes[i : i + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def with_fingerprint(df: DataFrame, text: str = "text", out: str = "fp") -> DataFrame:
    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(np.fromiter(map(fingerprint, texts), np.int64, len(texts)))

    return df.withColumn(out, simhash(F.col(text)))


@cache
def _hamming() -> tuple[np.ndarray, np.ndarray]:
    """For each 15-bit word its nearest codeword, and the (up to seven) codewords at distance two, else -1."""
    w = np.arange(1 << 15)
    syndrome = np.zeros_like(w)
    for p in range(1, 16):
        syndrome ^= np.where(w >> (p - 1) & 1, p, 0)
    near = np.where(syndrome > 0, w ^ (1 << np.maximum(syndrome - 1, 0)), w)
    second = np.full((1 << 15, 7), -1)
    for s in range(1, 16):
        pairs = [(1 << (i - 1)) ^ (1 << ((i ^ s) - 1)) for i in range(1, 16) if (i ^ s) > i]
        second[syndrome == s] = w[syndrome == s][:, None] ^ np.array(pairs)
    return near, second


def anchors(fps: np.ndarray, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all anchors near each fingerprint's halves, blocks ``first`` and the one after it, and the positions of
    the fingerprints they belong to."""
    near, second = _hamming()
    u, at, keys, who = fps.view(np.uint64), np.arange(len(fps)), [], []
    for half in (first, first + 1):
        v = (u >> np.uint64(32 * (half - first)) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        a, b, c = v & 0x7FFF, v >> 15 & 0x7FFF, v >> 30
        key = lambda a, b, c, half=half: half << 32 | c << 30 | b << 15 | a
        home = [key(near[a], near[b], c ^ flip) for flip in (0, 1, 2)]
        moved = [np.where(second[a, k] < 0, -1, key(second[a, k], near[b], c)) for k in range(7)]
        moved += [np.where(second[b, k] < 0, -1, key(near[a], second[b, k], c)) for k in range(7)]
        for k in home + moved:
            keys.append(k[k >= 0])
            who.append(at[k >= 0])
    return np.concatenate(keys), np.concatenate(who)


def _near_in_runs(run: np.ndarray, fp: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links inside runs of equal numbers of at most ``most`` rows: each row against those a step ahead."""
    found = []
    for step in range(1, most):
        i = np.flatnonzero(run[:-step] == run[step:]) if step < len(run) else np.empty(0, int)
        if not len(i):
            break
        d = np.bitwise_count((fp[i] ^ fp[i + step]).view(np.uint64))
        i = i[(d <= THRESHOLD) & (d > 0)]
        found.append((fp[i], fp[i + step]))
    return found


def _forest(fp: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """A spanning forest of the links among many fingerprints, breadth first: each reached once."""
    rest, found = np.unique(fp), []
    while len(rest):
        front, rest = [rest[:1]], rest[1:]
        while front and len(rest):
            for x in front.pop():
                hit = np.bitwise_count((rest ^ x).view(np.uint64)) <= THRESHOLD
                if hit.any():
                    found.append((np.full(int(hit.sum()), x), rest[hit]))
                    front.append(rest[hit])
                    rest = rest[~hit]
    return found


def _links(key: np.ndarray, fp: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links within each anchor; rows come sorted by anchor. Large anchors are cut by each of the four bytes
    of the half that the anchor leaves free: a linked pair differs in three of them at most."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    run = np.repeat(np.arange(len(starts)), sizes)
    small = np.repeat(sizes <= SMALL, sizes)
    found = _near_in_runs(run[small], fp[small], SMALL)
    for s, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL], strict=True):
        group, free = fp[s : s + n], 32 * (1 - int(key[s] >> 32))
        for byte in range(4):
            value = group.view(np.uint64) >> np.uint64(free + 8 * byte) & np.uint64(0xFF)
            order = np.argsort(value, kind="stable")
            for part in np.split(group[order], np.flatnonzero(np.diff(value[order])) + 1):
                if len(part) > 1:
                    found += _forest(part)
    return found


def links(fps: DataFrame) -> DataFrame:
    """Edges (u, v), u > v, that connect the distinct fingerprints of column ``fp`` as all links within the threshold do."""

    def replicate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i in range(0, len(pdf), _CHUNK):
                fp = pdf["fp"].to_numpy(np.int64)[i : i + _CHUNK].copy()
                key, who = anchors(fp)
                yield pd.DataFrame({"key": key, "fp": fp[who]})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def edges(key: np.ndarray, fp: np.ndarray) -> pd.DataFrame:
            pairs = _links(key, fp)
            a, b = (np.concatenate([p[i] for p in pairs] or [np.empty(0, np.int64)]) for i in (0, 1))
            return pd.DataFrame({"u": np.maximum(a, b), "v": np.minimum(a, b)}).drop_duplicates()

        held: list[tuple[np.ndarray, np.ndarray]] = []
        for pdf in batches:
            key, fp = pdf["key"].to_numpy(np.int64), pdf["fp"].to_numpy(np.int64)
            if not len(key):
                continue
            cut = int(np.searchsorted(key, key[-1]))
            if cut:  # the last anchor may go on in the next batch
                yield edges(*(np.concatenate(x) for x in zip(*held, (key[:cut], fp[:cut]), strict=True)))
                held = []
            held.append((key[cut:].copy(), fp[cut:].copy()))
            if not cut and held[0][0][0] != key[0]:
                done, held = held[:-1], held[-1:]
                yield edges(*(np.concatenate(x) for x in zip(*done, strict=True)))
        if held:
            yield edges(*(np.concatenate(x) for x in zip(*held, strict=True)))

    at = fps.select("fp").mapInPandas(replicate, "key long, fp long")
    at = at.repartition(partitions(fps.sparkSession), "key").sortWithinPartitions("key")
    return at.mapInPandas(compare, "u long, v long").distinct()


def components(edges: DataFrame, most: int | None = None) -> DataFrame:
    """(node, root) of every node on an edge (u, v): alternating large-star and small-star until nothing changes.

    After ``most`` rounds, if given, roots are other nodes of the component, but not all the least one.
    """
    edges, before, n = settle(edges, "edges"), None, 0
    while n != most:
        n += 1
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = settle(small.union(least.select("u", F.col("m").alias("v"))).where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp, component_id) for every row; component_id is the least key reachable over links."""
    own = settle(with_fingerprint(docs.select(F.col(key), F.col(text).alias("__t")), "__t").select(key, "fp"), "fingerprints")
    fps = settle(own.groupBy("fp").agg(F.min(key).alias("least")), "distinct-fingerprints")
    roots = components(links(fps)).withColumnRenamed("node", "fp")
    known = fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    known = settle(known, "classes")
    best = known.groupBy("root").agg(F.min("least").alias("component_id"))
    return own.join(known.join(best, "root").select("fp", "component_id"), "fp").select(key, "fp", "component_id")


class Words:
    """Bits and hashes of words, remembered; all work on a text is then done on arrays."""

    def __init__(self):
        self.at: dict[bytes, int] = {}
        self.bits, self.hash = np.zeros((0, WIDE // 8), np.uint8), np.zeros(0, np.uint64)

    def look_up(self, words: list[bytes]) -> np.ndarray:
        if len(self.at) > _WORDS_MOST:
            self.__init__()
        new = list(set(words).difference(self.at))
        if new:
            n = len(self.at)
            if n + len(new) > len(self.hash):  # room grows by doubling
                room = 2 * (n + len(new))
                self.bits = np.concatenate([self.bits, np.zeros((room - len(self.bits), WIDE // 8), np.uint8)])
                self.hash = np.concatenate([self.hash, np.zeros(room - len(self.hash), np.uint64)])
            own = b"".join(xxhash.xxh3_128_digest(w, seed) for w in new for seed in range(WIDE // 128))
            self.bits[n : n + len(new)] = np.frombuffer(own, np.uint8).reshape(len(new), -1)
            self.hash[n : n + len(new)] = [xxhash.xxh64_intdigest(w, SEED) for w in new]
            self.at.update(zip(new, range(n, n + len(new)), strict=True))
        return np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))

    def measure(self, text: str | None, words: int) -> tuple[bytes, list[int], np.ndarray]:
        """Of a text: a digest of its shingle set, the words of its wide SimHash, and its distinct shingles' hashes."""
        parts = (text or "").encode("utf-8", "replace").lower().split()
        at = self.look_up(parts)
        ones, distinct = np.zeros(WIDE, np.int64), np.unique(at)
        for i in range(0, len(distinct), _CHUNK):
            ones += np.unpackbits(self.bits[distinct[i : i + _CHUNK]], axis=1).sum(axis=0, dtype=np.int64)
        fp = np.packbits(2 * ones > len(distinct)).view(np.int64).tolist()
        h, k = self.hash[at], min(words, len(at))
        mix = np.zeros(len(h) - k + 1 if k else 0, np.uint64)
        for j in range(k):
            mix += h[j : j + len(mix)] * np.uint64(pow(0x9E3779B97F4A7C15, j + 1, 1 << 64))
        mix ^= mix >> np.uint64(29)
        mix *= np.uint64(0xBF58476D1CE4E5B9)
        shingles = np.unique(mix ^ mix >> np.uint64(32))
        return xxhash.xxh3_128_digest(shingles.tobytes()), fp, shingles.view(np.int64)


def measured(docs: DataFrame, key: str, text: str, words: int, sets: bool = False) -> DataFrame:
    """(key, cls, f0 to f3), or (key, cls, shingles) with ``sets``: ``cls`` is equal for equal sets of shingles.

    Of the sets half of each hash is kept: two of a text's n shingles are taken for one with a chance of n / 2 ** 32 each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                found = [known.measure(t, words) for t in part.column(1).to_pylist()]
                if sets:
                    own = [np.unique((x >> 32).astype(np.int32)) for *_, x in found]
                    ends = pa.array(np.r_[0, np.cumsum(list(map(len, own)))].astype(np.int32))
                    own = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(own)))]
                else:
                    own = [pa.array(f) for f in np.array([f for _, f, _ in found], np.int64).reshape(-1, WIDE // 64).T]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([c for c, *_ in found], pa.binary()), *own], names=["key", "cls", *(["shingles"] if sets else _FP)])

    kind = dict(docs.dtypes)[key]
    rest = "shingles array<int>" if sets else ", ".join(f"{f} long" for f in _FP)
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, cls binary, {rest}")


def _near_anchors(nodes: DataFrame, compared: bool) -> DataFrame:
    """(anchor, node) of (node, f0 to f3), sorted by anchor within partitions; if ``compared`` with the two words of the
    fingerprint that are compared there, and with the numbers of ``crowded`` nodes as -1 - node, which takes no column."""
    kinds = "anchor long, node long" + ", a long, b long" * compared

    def replicate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i in range(0, len(pdf), 4096):
                part = pdf.iloc[i : i + 4096]
                node, fps = part["node"].to_numpy(np.int64), [part[f].to_numpy(np.int64).copy() for f in _FP]
                for n, fp in enumerate(fps):
                    key, who = anchors(fp, 2 * n)
                    own = {"anchor": key, "node": node[who]}
                    if compared:
                        own |= {c: fps[(n + k) % len(fps)][who] for k, c in ((1, "a"), (2, "b"))}
                    yield pd.DataFrame(own)

    node = F.when(F.col("crowded"), -1 - F.col("node")).otherwise(F.col("node")).alias("node") if compared else F.col("node")
    at = nodes.select(node, *_FP).mapInPandas(replicate, kinds)
    return at.repartition(partitions(nodes.sparkSession), "anchor").sortWithinPartitions("anchor")


def crowded(nodes: DataFrame) -> DataFrame:
    """(node): the nodes at anchors that more than ``SMALL`` nodes share."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        anchor, node = np.empty(0, np.int64), np.empty(0, np.int64)
        for pdf in batches:
            anchor, node = (np.concatenate([x, pdf[c].to_numpy(np.int64)]) for c, x in (("anchor", anchor), ("node", node)))
            if not len(anchor):
                continue
            starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
            sizes = np.diff(np.r_[starts, len(anchor)])
            yield pd.DataFrame({"node": np.unique(node[np.repeat(sizes > SMALL, sizes)])})
            # The last anchor may go on in the next batch; of a large one as many rows are kept as show that it is.
            cut = max(int(starts[-1]), len(anchor) - SMALL - 1)
            anchor, node = anchor[cut:], node[cut:]

    return _near_anchors(nodes, False).mapInPandas(run, "node long").distinct()


def candidates(nodes: DataFrame) -> DataFrame:
    """(u, v, far), u < v: pairs of (node, f0 to f3, crowded) that meet at an anchor, with the bits in which half of their
    wide fingerprints differ, at most ``RADIUS``. Pairs of two crowded nodes are left out; all at large anchors are such.
    """

    def pairs(whole: pd.DataFrame) -> pd.DataFrame:
        anchor, node, a, b = (whole[c].to_numpy(np.int64) for c in ("anchor", "node", "a", "b"))
        full, found = node < 0, [(np.empty(0, np.int64),) * 3]
        node = np.where(full, -1 - node, node)
        for step in range(1, SMALL):
            i = np.flatnonzero(anchor[:-step] == anchor[step:]) if step < len(anchor) else np.empty(0, np.int64)
            if not len(i):
                break
            i = i[~(full[i] & full[i + step])]
            d = np.bitwise_count((a[i] ^ a[i + step]).view(np.uint64)).astype(np.int64) + np.bitwise_count((b[i] ^ b[i + step]).view(np.uint64))
            i, d = i[d <= RADIUS], d[d <= RADIUS]
            found.append((node[i], node[i + step], d))
        x, y, far = (np.concatenate([p[k] for p in found]) for k in range(3))
        return pd.DataFrame({"u": np.minimum(x, y), "v": np.maximum(x, y), "far": far}).drop_duplicates()

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for pdf in batches:
            held.append(pdf)
            rows = sum(map(len, held))
            if rows < _CHUNK or held[0]["anchor"].iloc[0] == pdf["anchor"].iloc[-1] and rows < 4 * _CHUNK:
                continue
            whole = pd.concat(held)
            keys = whole["anchor"].to_numpy()
            # The last anchor may go on in the next batch; one of very many rows is cut, for it makes no pairs.
            cut = int(np.searchsorted(keys, keys[-1])) or len(whole)
            yield pairs(whole.iloc[:cut])
            held = [whole.iloc[cut:]]
        whole = pd.concat(held) if held else pd.DataFrame()
        if len(whole):
            yield pairs(whole)

    found = _near_anchors(nodes, True).mapInPandas(compare, "u long, v long, far long")
    return found.groupBy("u", "v").agg(F.min("far").alias("far"))


def similar(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SIMILAR_WORDS, least: float = SIMILAR) -> DataFrame:
    """(key, cls, component) for every row with a key: components of texts linked at a similarity of ``least`` of their shingle
    sets, named by a number; rows of equal shingle sets share ``cls``.

    Candidate links are checked in rounds: while they are many, the nearest few of each text only, sixteen times as
    many in each round; links inside a component found so far need no check any more. So a dense group of near copies is
    settled by few of its pairs. What is left, once it is little, is checked at once. Crowded nodes, those at anchors of over
    ``SMALL`` nodes, are joined among each other exactly. ``least`` is a whole number of hundredths.
    """
    from .jaccard_join import linked

    percent = round(100 * least)
    if abs(percent - 100 * least) > 1e-9:
        raise ValueError("similarities go by whole hundredths")
    docs = docs.where(F.col(key).isNotNull())
    own = settle(measured(docs, key, text, words), "shingle-classes")
    # Numbered in a written table, so numbers stay what they are.
    nodes = own.groupBy("cls").agg(*[F.min(f).alias(f) for f in _FP], F.min("key").alias("least")).withColumn("node", F.monotonically_increasing_id())
    nodes = settle(nodes, "shingle-nodes")
    crowd = settle(crowded(nodes), "crowded")
    marked = nodes.join(crowd.withColumn("crowded", F.lit(True)), "node", "left").fillna(False, ["crowded"])
    edges = settle(candidates(marked), "candidates")
    ends = edges.select(F.col("u").alias("node")).union(edges.select(F.col("v").alias("node"))).union(crowd).distinct()
    ends = settle(nodes.join(ends, "node").select("node", "cls", "least"), "candidate-nodes")
    # One row of each class that has a candidate; texts move only where the classes are too many to broadcast.
    some = docs.join(ends.select(F.col("least").alias(key)).distinct(), key, "left_semi")
    sets = measured(some, key, text, words, sets=True).join(ends.select("cls", "node"), "cls").groupBy("node").agg(F.first("shingles").alias("s"))
    sets = settle(sets, "candidate-sets")
    among = linked(sets.join(crowd, "node", "left_semi"), "node", "s", 0, percent)
    links = settle(among.where("component_id < node").select(F.col("component_id").alias("u"), F.col("node").alias("v")), "crowded-links")
    involved, most = sets.count(), FIRST_LINKS
    while True:
        n = edges.count()
        if not n:
            break
        trial = edges
        if n > ALL_AT_ONCE * involved:
            both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"), "far"))
            place = F.row_number().over(Window.partitionBy("u").orderBy("far", "v"))
            nearest = both.withColumn("place", place).where(F.col("place") <= most)
            trial = settle(nearest.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "nearest")
        pair = trial.join(sets.select(F.col("node").alias("u"), F.col("s").alias("a")), "u").join(sets.select(F.col("node").alias("v"), F.col("s").alias("b")), "v")
        common = F.size(F.array_intersect("a", "b"))
        links = links.union(settle(pair.where(100 * common >= percent * (F.size("a") + F.size("b") - common)).select("u", "v"), "links"))
        if n <= ALL_AT_ONCE * involved:
            break
        roots = settle(components(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), 2), "roots")
        left = edges.join(trial, ["u", "v"], "left_anti")
        for end in ("u", "v"):
            left = left.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root")), end, "left")
        edges = settle(left.where(F.coalesce("u_root", "u") != F.coalesce("v_root", "v")).select("u", "v", "far"), "candidates")
        most *= 16
    roots = components(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    named = nodes.select("cls", "node").join(roots, "node", "left").withColumn("component", F.coalesce("root", "node"))
    return own.select("key", "cls").join(named.select("cls", "component"), "cls").select(F.col("key").alias(key), "cls", "component")


def hexadecimal(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
