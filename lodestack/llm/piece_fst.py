"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The model file is compiled to a transducer: the normaliser (blanks to ▁, a leading ▁), one path for each piece,
and byte fallback: one arc for each character that is no piece by itself, read as its bytes. Composed with an input
it is a lattice whose states are a position and the piece read last; the path of least weight in the tropical
semiring is the encoding. A unigram model weighs an arc by the piece's negative score. In a BPE model the arc from
piece u to piece v weighs 0 if merging the letters of u and v together gives u, v back, and infinity otherwise:
adjacent pairs of a BPE encoding are exactly those, so one path of finite weight is left at each position.

No piece holds ▁ after another character, so inputs are cut before each run of blanks. The lattices of all cuts that
a batch holds and that are not remembered are built and searched together, on arrays: arcs by walking the trie of
reversed pieces from every position at once, paths position by position over all cuts.

Defined results: a null text has null ids; an empty text has none; a text with a literal ▁ decodes to a blank there,
as it does in the library, and has round_trip false; any other text decodes to itself. Repeated rows stay repeated, very long texts are encoded whole, and
of other columns none is read. Models with user-defined
pieces, without byte fallback or with another normaliser than identity are refused.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_CACHE_MOST = 80_000
_PAIR_BITS = 19
_CUT_MOST = 48
#: Characters whose lattices are built together, and rows at most.
_GROUP, _GROUP_ROWS = 1_500_000, 512
#: Kinds of pieces in the model file.
_NORMAL, _USER, _BYTE = 1, 4, 6
_UNKNOWN_PENALTY = 10.0


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of one protocol-buffer message."""

    def number(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[i] & 127) << shift
            i, shift = i + 1, shift + 7
            if data[i - 1] < 128:
                return value, i

    i = 0
    while i < len(data):
        tag, i = number(i)
        if tag & 7 == 0:
            value, i = number(i)
        else:
            size, i = number(i) if tag & 7 == 2 else (8 if tag & 7 == 1 else 4, i)
            value, i = data[i : i + size], i + size
        yield tag >> 3, value


class Arcs:
    """The pieces as a trie of their letters from last to first, walked from many positions at once."""

    def __init__(self, pieces: list[str], letters: str):
        self.code = np.zeros(max(map(ord, letters), default=0) + 2, np.int64)  # 0: in no piece; the last slot too
        self.code[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.base = len(letters) + 1
        ends, moves = [-1], {}
        for at, piece in enumerate(pieces):
            node = 0
            for c in reversed(piece):
                key = node * self.base + int(self.code[ord(c)])
                if key not in moves:
                    moves[key] = len(ends)
                    ends.append(-1)
                node = moves[key]
            ends[node] = at
        self.ends = np.array(ends, np.int32)
        self.keys = np.sort(np.fromiter(moves, np.int64, len(moves)))
        self.to = np.fromiter(map(moves.__getitem__, self.keys.tolist()), np.int64, len(moves))
        self.inside = np.unique([int(self.code[ord(a)]) * self.base + int(self.code[ord(b)]) for p in pieces for a, b in zip(p, p[1:], strict=False)] or [-1])

    def codes(self, points: np.ndarray) -> np.ndarray:
        return self.code[np.minimum(points, len(self.code) - 1)]

    def joined(self, code: np.ndarray) -> np.ndarray:
        """Whether each letter and the one before it stand side by side in some piece."""
        pair = np.r_[-2, code[:-1] * self.base + code[1:]][: len(code)]
        return self.inside[np.minimum(np.searchsorted(self.inside, pair), len(self.inside) - 1)] == pair

    def walk(self, code: np.ndarray, place: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each length: where pieces of it end, and which. ``place`` counts the letters that may be read back."""
        at, node, size = np.flatnonzero(code), 0, 0
        while len(at):
            key = node * self.base + code[at - size]
            found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[found] == key
            at, node, size = at[known], self.to[found[known]], size + 1
            piece = self.ends[node]
            yield size, at[piece >= 0], piece[piece >= 0]
            on = place[at] > size
            at, node = at[on], node[on]


def merged(text: str, rank: dict[str, float]) -> tuple[list[str], tuple[str, str] | None]:
    """Merges of a BPE model on a short text, the best-scored adjacent pair first, the leftmost of equals: what is
    left, and the last pair merged."""
    parts, none, last = list(text), -float("inf"), None
    ranks = [rank.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
    while ranks and max(ranks) > none:
        i = ranks.index(max(ranks))
        last = parts[i], parts[i + 1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del ranks[i]
        if i < len(ranks):
            ranks[i] = rank.get(parts[i] + parts[i + 1], none)
        if i:
            ranks[i - 1] = rank.get(parts[i - 1] + parts[i], none)
    return parts, last


class Transducer:
    def __init__(self, model: bytes):
        pieces, trainer, normal = [], {}, {}
        for field, value in _fields(model):
            if field == 1:
                d = dict(_fields(value))
                pieces.append((d[1].decode(), struct.unpack("<f", d[2])[0] if 2 in d else 0.0, d.get(3, _NORMAL)))
            elif field == 2:
                trainer.update(_fields(value))
            elif field == 3:
                normal.update(_fields(value))
        if normal.get(2):
            raise ValueError("only models with the identity normaliser are compiled")
        if normal.get(4, 1):
            raise ValueError("models that drop blanks cannot decode to the input")
        if any(kind == _USER for _, _, kind in pieces):
            raise ValueError("models with user-defined pieces are not compiled")
        self.unigram = trainer.get(3, 1) == 1
        self.prefix = bool(normal.get(3, 1))
        self.pieces = [p for p, _, _ in pieces]
        # Inside, the normaliser's ▁ stays a blank: such strings are short in memory.
        self.ids = {p.replace("▁", " "): i for i, (p, _, kind) in enumerate(pieces) if kind == _NORMAL}
        byte = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == _BYTE}
        if len(byte) < 256:
            raise ValueError("the model has no byte fallback")
        if any(" " in p.lstrip(" ") for p in self.ids):
            raise ValueError("a piece holds a blank after a character")
        self.byte = np.array([byte[b] for b in range(256)], np.int32)
        self.out = [p.replace("▁", " ").encode() for p in self.pieces]
        for b, i in byte.items():
            self.out[i] = bytes([b])
        self.rank = {p: pieces[i][1] for p, i in self.ids.items()}
        letters = "".join(sorted({c for p in self.ids for c in p}))
        # States beyond the ids: letters that are no piece, and last any character in no piece; both fall back to bytes.
        bare = [c for c in letters if c not in self.ids]
        names = [p.replace("▁", " ") if p.replace("▁", " ") in self.ids else "" for p in self.pieces] + bare
        self.names, self.fallback, self.other = names, len(self.pieces), len(names)
        self.arcs = Arcs(names, letters)
        self.size = np.array([*map(len, names), 1])
        lowest = min(self.rank.values(), default=0.0) - _UNKNOWN_PENALTY
        self.weight = -np.array([*(self.rank.get(p, lowest) for p in names), lowest])
        if not self.unigram:
            self._splits()
        self.cut = re.compile(" +[^ ]*|[^ ]+")
        self.memory: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}  # what was remembered until the memory was last full
        self.pairs = np.zeros(1 << _PAIR_BITS, np.int64)  # twice a pair's number, plus its result; clashes overwrite

    def _splits(self) -> None:
        """When each piece of a BPE model is merged from its letters, and from which two parts; letters are never."""
        n, number = len(self.names), {p: i for i, p in enumerate(self.names) if p}
        order = np.unique(-self.weight[:-1], return_inverse=True)[1]
        self.time, self.left, self.right = np.full(n + 1, -1), np.full(n + 1, -1), np.full(n + 1, -1)
        self.alone = np.zeros(n + 1, bool)
        self.alone[n] = True
        for p, i in number.items():
            parts, last = merged(p, self.rank)
            self.alone[i] = len(parts) == 1
            if last:
                self.time[i], self.left[i], self.right[i] = len(order) - order[i], number[last[0]], number[last[1]]
        # Merges with a score of their own, later than those of their parts: only these can be undone in order.
        once = np.bincount(self.time[(self.time >= 0) & self.alone], minlength=len(order) + 1) == 1
        self.ordered = self.alone.copy()
        for i in sorted(np.flatnonzero(self.alone & (self.time >= 0)).tolist(), key=lambda i: len(self.names[i])):
            parts = [self.left[i], self.right[i]]
            self.ordered[i] = once[self.time[i]] and self.ordered[parts].all() and self.time[parts].max() < self.time[i]
        pairs = {(number[p[:k]] * (n + 1) + number[p[k:]]): len(order) - order[i] for p, i in number.items() for k in range(1, len(p)) if p[:k] in number and p[k:] in number}
        self.joins = np.sort(np.fromiter(pairs, np.int64, len(pairs)))
        self.join_time = np.fromiter(map(pairs.__getitem__, self.joins.tolist()), np.int64, len(pairs))

    def _unmerged(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Whether merging the letters of pieces u and v together gives u and v: their merges are undone, the later one
        first and of equals the right one, and no pair met on the way may join before the merge that took a side away."""
        good, at, never = np.ones(len(u), bool), np.arange(len(u)), np.iinfo(np.int64).max
        x, y, x_gone, y_gone = u.astype(np.int64), v.astype(np.int64), np.full(len(u), never), np.full(len(u), never)
        while len(at):
            key = x * (self.other + 1) + y
            found = np.minimum(np.searchsorted(self.joins, key), len(self.joins) - 1)
            when = np.where(self.joins[found] == key, self.join_time[found], never)
            bad = (when < x_gone) & (when <= y_gone) & (when < never)
            good[at[bad]] = False
            tx, ty = self.time[x], self.time[y]
            on = ~bad & ((tx >= 0) | (ty >= 0))
            at, x, y, x_gone, y_gone, tx, ty = at[on], x[on], y[on], x_gone[on], y_gone[on], tx[on], ty[on]
            first = tx > ty
            x_gone, y_gone = np.where(first, tx, x_gone), np.where(first, y_gone, ty)
            x, y = np.where(first, self.right[x], x), np.where(first, y, self.left[y])
        return good

    def _apart(self, u: int, v: int) -> bool:
        """The same for one pair whose merges have no order of their own: by merging."""
        if self.other in (u, v):
            return True
        return merged(self.names[u] + self.names[v], self.rank)[0] == [self.names[u], self.names[v]]

    def _finite(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Whether the arcs from pieces u to pieces v have finite weights in a BPE model; results are remembered."""
        key = u.astype(np.int64) * (self.other + 1) + v + 1
        slot = (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - _PAIR_BITS)).view(np.int64)
        held = self.pairs[slot]
        new = np.flatnonzero(held >> 1 != key)
        if len(new):
            a, b = u[new], v[new]
            plain = self.ordered[a] & self.ordered[b]
            good = np.zeros(len(new), bool)
            good[plain] = self._unmerged(a[plain], b[plain])
            rest, back = np.unique(key[new][~plain], return_inverse=True)
            apart = [self._apart(*divmod(k - 1, self.other + 1)) for k in rest.tolist()]
            good[~plain] = np.array(apart, bool)[back]
            held[new] = key[new] << 1 | good
            self.pairs[slot[new]] = held[new]
        return (held & 1).astype(bool)

    def _paths(self, code: np.ndarray, place: np.ndarray, last: np.ndarray) -> None:
        """Sets in ``last`` the piece that ends the shortest path to each position, all cuts side by side."""
        steps, most = [], int(place.max(initial=0))
        for size, at, piece in self.arcs.walk(code, place):
            order = np.argsort(place[at], kind="stable")
            at = at[order]
            steps.append((size, at, piece[order], np.searchsorted(place[at], np.arange(most + 2))))
        weight = np.full(len(code) if self.unigram else 0, np.inf)
        for i in range(1, most + 1):
            for size, ends, pieces, bounds in reversed(steps):
                at, piece = ends[bounds[i] : bounds[i + 1]], pieces[bounds[i] : bounds[i + 1]]
                if not len(at):
                    continue
                if self.unigram:
                    w = self.weight[piece] + (weight[at - size] if i > size else 0.0)
                    better = w < weight[at]
                    at, piece = at[better], piece[better]
                    weight[at] = w[better]
                elif i == size:
                    good = (last[at] < 0) & self.alone[piece]
                    at, piece = at[good], piece[good]
                else:
                    good = (last[at] < 0) & (last[at - size] >= 0)
                    at, piece = at[good], piece[good]
                    good = self._finite(last[at - size], piece)
                    at, piece = at[good], piece[good]
                last[at] = piece

    def _long_path(self, code: np.ndarray, last: np.ndarray) -> None:
        """The same for one cut so long that its positions outnumber the cuts beside it: position by position."""
        at = np.arange(1, len(code) + 1)
        arcs: list[list[tuple[int, int]]] = [[] for _ in at]
        for size, ends, pieces in self.arcs.walk(code, at):
            for e, p in zip(ends.tolist(), pieces.tolist(), strict=True):
                arcs[e].append((size, p))
        weight, seen = [np.inf] * len(code), {}
        for i, found in enumerate(arcs):
            for size, p in reversed(found):
                u = int(last[i - size]) if size <= i else None
                if self.unigram:
                    w = self.weight[p] + (weight[i - size] if size <= i else 0.0)
                    if w < weight[i]:
                        weight[i], last[i] = w, p
                elif u is None:
                    if self.alone[p]:
                        last[i] = p
                        break
                elif u >= 0:
                    if (u, p) not in seen:
                        if len(seen) > _CACHE_MOST:
                            seen.clear()
                        seen[u, p] = bool(self._finite(np.array([u]), np.array([p]))[0])
                    if seen[u, p]:
                        last[i] = p
                        break

    def encode_cuts(self, cuts: list[str]) -> list[bytes]:
        """Ids of each cut, as bytes of 32-bit numbers."""
        points = np.frombuffer("".join(cuts).encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
        ends = np.cumsum(np.fromiter(map(len, cuts), np.int64, len(cuts)))
        code, last = self.arcs.codes(points), np.full(len(points), -1, np.int64)
        last[code == 0] = self.other
        # No path crosses between letters that stand side by side in no piece: lattices are searched between such places.
        opens = ~self.arcs.joined(code)
        opens[np.r_[0, ends[:-1]]] = True
        starts = np.flatnonzero(opens)
        sizes = np.diff(np.r_[starts, len(points)])
        place = np.arange(len(points)) - np.repeat(starts, sizes) + 1
        short = np.repeat(sizes <= _CUT_MOST, sizes)
        if short.all():
            self._paths(code, place, last)
        else:
            for i in np.flatnonzero(sizes > _CUT_MOST):
                part = slice(starts[i], starts[i] + sizes[i])
                self._long_path(code[part], last[part])
            some = last[short]
            self._paths(code[short], place[short], some)
            last[short] = some
        # Back from the ends: the pieces on the paths keep their place, so they come out in order.
        read = np.zeros(len(points), bool)
        at = starts + sizes - 1
        while len(at):
            read[at] = True
            on = place[at] > self.size[last[at]]
            at = at[on] - self.size[last[at[on]]]
        where = np.flatnonzero(read)
        ids, many = last[where].astype(np.int32), np.ones(len(where), np.int64)
        bare = np.flatnonzero(ids >= self.fallback)
        if len(bare):
            data = [chr(x).encode("utf-8", "replace") for x in points[where[bare]].tolist()]
            many[bare] = list(map(len, data))
            spread = np.repeat(ids, many)
            spread[np.repeat(ids >= self.fallback, many)] = self.byte[np.frombuffer(b"".join(data), np.uint8)]
            ids = spread
        total = np.r_[0, np.cumsum(many)]
        stops = (4 * total[np.searchsorted(where, ends)]).tolist()
        flat = ids.tobytes()
        return [flat[a:b] for a, b in zip([0, *stops], stops, strict=False)]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; the cuts new to this worker are encoded together."""
        cuts = [self.cut.findall((" " if self.prefix else "") + t.replace("▁", " ")) if t else [] for t in texts]
        memory, before = self.memory, self.before
        own, new = {}, []
        for c in set().union(*cuts):
            if c not in memory:
                if c in before:
                    memory[c] = before[c]
                else:
                    new.append(c)
        for c, ids in zip(new, self.encode_cuts(new) if new else [], strict=True):
            (memory if len(c) <= _CUT_MOST else own)[c] = ids
        get = memory.__getitem__ if not own else lambda c: memory[c] if c in memory else own[c]
        out = [np.frombuffer(b"".join(map(get, c)), np.int32) for c in cuts]
        if len(memory) > _CACHE_MOST:
            self.before, self.memory = memory, {}
        return out

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> str:
        data = b"".join(map(self.out.__getitem__, ids.tolist()))
        return (data[1:] if self.prefix and data[:1] == b" " else data).decode("utf-8", "replace")


@cache
def compiled(model: bytes) -> Transducer:
    """One transducer a worker process for each model, with what it remembers."""
    return Transducer(model)


def read_model(path: str = MODEL) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encoded(docs: DataFrame, model: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, token_ids, round_trip) of every row; round_trip tells whether the ids decode to the text."""

    def groups(texts: list[str | None]) -> Iterator[tuple[int, int]]:
        """Ranges of rows with few characters together; a longer text is alone."""
        start = size = 0
        for i, t in enumerate(texts):
            n = len(t or "")
            if i > start and (size + n > _GROUP or i - start >= _GROUP_ROWS):
                yield start, i
                start, size = i, 0
            size += n
        if texts:
            yield start, len(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = compiled(model)
        for batch in batches:
            whole = batch.column(1).to_pylist()
            for start, stop in groups(whole):
                part, texts = batch.slice(start, stop - start), whole[start:stop]
                ids = fst.encode_all([t or "" for t in texts])
                null = np.array([t is None for t in texts])
                sizes = np.fromiter(map(len, ids), np.int64, len(ids))
                ends = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
                lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids)), mask=pa.array(null))
                same = pa.array([None if t is None else fst.decode(i) == t for t, i in zip(texts, ids, strict=True)], pa.bool_())
                count = pa.array(sizes, mask=null)
                yield pa.RecordBatch.from_arrays([part.column(0), count, lists, same], names=["key", "n_tokens", "token_ids", "round_trip"])

    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(key).alias("key"), text).mapInArrow(run, f"key {kind}, n_tokens long, token_ids array<int>, round_trip boolean").withColumnRenamed("key", key)
