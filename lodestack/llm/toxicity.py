"""Toxicity: Levenshtein automata intersected with a lexicon trie, and context windows around each hit.

The lexicon is learned: words, and stems with any continuation, that mark toxic training documents beyond what
chance among all terms allows. All terms share a trie; the automaton that accepts everything within each term's
edit distance is determinised lazily, so a word costs one table lookup a letter. A hit's probability comes from
the training counts of its term at its distance; words in the window around it, and its standing inside a pair of
quotation marks there, shift its log-odds as far as training shows that they tell quotation from abuse.
Distinct hits combine as independent causes.

Near copies would pass one document's words off as evidence, so training texts with the same least shingle hash
and label count once.

Defined results: null and empty texts get the rate among texts without a hit; nothing to learn from gives 0; equal
texts get equal scores; very long texts are read whole; of near copies in the training rows the least text counts, so
a model depends on the rows alone and not on their order; an existing score column is replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle
from .quality import bounded

#: Labelled rows to fit on at most, taken by hash of the key; all where there are fewer.
TRAIN_ROWS = 40_000
STEM_LENGTHS = (4, 5, 6, 7, 8)
STEM_ODDS = 6
CROWDED = 3
DOUBT = 2.0
WINDOW = 4
ACCEPT = 0.7
_WORD = re.compile(r"\w+")
#: Opening and closing quotation marks. An apostrophe between two letters is none.
_QUOTES = (('"', '"'), ("'", "'"), ("“", "”"), ("„", "“"), ("«", "»"), ("»", "«"), ("‘", "’"))
_APOSTROPHE = re.compile(r"(?<=\w)['’](?=\w)")
_CACHE_MOST = 200_000


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def copy_key(text: str | None) -> int:
    """Least hash of five-word shingles: near copies nearly always share it, other texts never."""
    w = words_of(text)
    return min((xxhash.xxh64_intdigest(" ".join(w[i : i + 5])) for i in range(max(1, len(w) - 4))), default=0) - (1 << 63)


def allowed(term: str) -> int:
    """Edits within which a word still counts as the term. At two edits too many of a corpus's other words are as
    near to some term, and the automaton's states become too many to remember."""
    return 0 if len(term) < 5 else 1


class Automaton:
    """Words within reach of the lexicon: the terms they match, each with its least edit distance."""

    def __init__(self, terms: Iterable[str], stems: Iterable[str]):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[tuple[str, bool]]] = [[]]
        self.reach = [0]
        for term, stem in [*((t, False) for t in terms), *((t, True) for t in stems)]:
            at = 0
            for c in term:
                self.reach[at] = max(self.reach[at], allowed(term))
                if c not in self.children[at]:
                    self.children[at][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.reach.append(0)
                at = self.children[at][c]
            self.reach[at] = max(self.reach[at], allowed(term))
            self.ends[at].append((term, stem))
        self._reset()

    def _reset(self) -> None:
        self.states: list[tuple[dict[int, int], dict[str, int]]] = []
        self.ids: dict[tuple, int] = {}
        self.moves: list[dict[str, int]] = []
        self.start = self._state({0: 0}, {})

    def _state(self, nodes: dict[int, int], stuck: dict[str, int]) -> int:
        queue = list(nodes)
        while queue:  # letters of a term that the word leaves out
            n = queue.pop()
            for child in self.children[n].values():
                e = nodes[n] + 1
                if e <= self.reach[child] and e < nodes.get(child, 9):
                    nodes[child] = e
                    queue.append(child)
        stuck = dict(stuck)
        for n, e in nodes.items():
            for term, stem in self.ends[n]:
                if stem and e <= allowed(term):
                    stuck[term] = min(e, stuck.get(term, 9))
        key = (tuple(sorted(nodes.items())), tuple(sorted(stuck.items())))
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append((nodes, stuck))
            self.moves.append({})
        return self.ids[key]

    def _move(self, state: int, c: str) -> int:
        nodes, stuck = self.states[state]
        out: dict[int, int] = {}
        for n, e in nodes.items():
            if e + 1 <= self.reach[n]:
                out[n] = min(out.get(n, 9), e + 1)  # a letter too many
            for letter, child in self.children[n].items():
                cost = e + (letter != c)
                if cost <= self.reach[child] and cost < out.get(child, 9):
                    out[child] = cost
        return self._state(out, stuck)

    def match(self, word: str) -> dict[str, int]:
        if len(self.states) > _CACHE_MOST:
            self._reset()
        state = self.start
        for c in word:
            step = self.moves[state].get(c)
            if step is None:
                step = self.moves[state][c] = self._move(state, c)
            state = step
            if not self.states[state][0]:
                break
        nodes, stuck = self.states[state]
        found = dict(stuck)
        for n, e in nodes.items():
            for term, stem in self.ends[n]:
                if not stem and e <= allowed(term):
                    found[term] = min(e, found.get(term, 9))
        return found


def _quoted(before: str, after: str) -> bool:
    """Whether a pair of marks opens in the text before a word and closes in the text after it."""
    for a, b in _QUOTES:
        if a == b:
            if before.count(a) % 2 and a in after:
                return True
        elif before.rfind(a) > before.rfind(b) and 0 <= after.find(b) < (after.find(a) if a in after else len(after)):
            return True
    return False


def _context(text: str, spans: list[tuple[int, int]], words: list[str], i: int) -> set[str]:
    near = set(words[max(0, i - WINDOW) : i] + words[i + 1 : i + 1 + WINDOW])
    a = spans[i - WINDOW - 1][1] if i > WINDOW else 0  # marks before the first word of the window count
    b = spans[i + WINDOW + 1][0] if i + WINDOW + 1 < len(spans) else len(text)
    # Marks further than a few characters from the window's words belong to other text.
    first, last = spans[max(0, i - WINDOW)][0], spans[min(len(spans) - 1, i + WINDOW)][1]
    around = _APOSTROPHE.sub(lambda m: " ", text[max(a, first - 4) : min(b, last + 4)])
    at, end = spans[i][0] - max(a, first - 4), spans[i][1] - max(a, first - 4)
    if _quoted(around[:at], around[end:]):
        near.add("<quoted>")
    return near


class Scorer:
    def __init__(self, base: float, hits: dict[tuple[str, int], float], stems: set[str], context: dict[str, float]):
        self.base, self.hits, self.context = base, hits, context
        terms = {t for t, _ in hits}
        self.automaton = Automaton(sorted(terms - stems), sorted(terms & stems))
        self.seen: dict[str, float] = {}
        self.bad: dict[str, str] = {}

    def __getstate__(self):
        return self.base, self.hits, self.automaton.ends, self.context

    def __setstate__(self, state):
        base, hits, ends, context = state
        self.__init__(base, hits, {t for e in ends for t, stem in e if stem}, context)

    def look_up(self, words: Iterable[str]) -> None:
        if len(self.seen) > _CACHE_MOST:
            self.seen, self.bad = {}, {}
        for w in words:
            best = max(((self.hits.get((t, e), 0.0), t) for t, e in self.automaton.match(w).items()), default=(0.0, ""))
            self.seen[w] = best[0]
            if best[0] > 0:
                self.bad[w] = best[1]

    def found(self, text: str | None) -> Iterator[tuple[str, float, set[str]]]:
        """(term, probability, context) of every hit in a text."""
        words = words_of(text)
        kinds = set(words)
        self.look_up(kinds.difference(self.seen))
        if kinds.isdisjoint(self.bad):
            return
        low = text.lower()
        spans = [m.span() for m in _WORD.finditer(low)]
        for i, w in enumerate(words):
            if w in self.bad:
                yield self.bad[w], self.seen[w], _context(low, spans, words, i)

    def score(self, text: str | None) -> float:
        best: dict[str, float] = {}
        for term, p, near in self.found(text):
            shift = max(-3.0, min(3.0, sum(self.context.get(w, 0.0) for w in near)))
            best[term] = max(best.get(term, -99.0), math.log(p / (1 - p)) + shift)
        clean = 1 - self.base
        for x in best.values():
            clean *= 1 / (1 + math.exp(x))
        return 1 - clean


def count_terms(training: DataFrame) -> DataFrame:
    """(kind, term, pos, neg): documents of each label that hold a word, or words with a prefix."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = {0: Counter(), 1: Counter()}
            for text, toxic in zip(pdf["text"], pdf["toxic"], strict=True):
                kinds = set(words_of(text))
                found[toxic].update(("w", w) for w in kinds)
                found[toxic].update({("p", w[:k]) for w in kinds for k in STEM_LENGTHS if len(w) > k})
            keys = list(found[0].keys() | found[1].keys())
            yield pd.DataFrame({"kind": [k for k, _ in keys], "term": [t for _, t in keys], "pos": [found[1][k] for k in keys], "neg": [found[0][k] for k in keys]})

    return training.select("text", "toxic").mapInPandas(count, "kind string, term string, pos long, neg long").groupBy("kind", "term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def marks(rate: float, tests: int) -> Column:
    """Whether so many toxic documents among pos + neg exceed chance, over all terms tested (Chernoff bound)."""
    n = F.col("pos") + F.col("neg")
    share = F.least(F.greatest(F.col("pos") / n, F.lit(1e-9)), F.lit(1 - 1e-9))
    weight = n * (share * F.log(share / rate) + (1 - share) * F.log((1 - share) / (1 - rate)))
    return (share > 0.5) & (share > rate) & (weight >= math.log(tests) + DOUBT)


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> Scorer:
    """Learns from (key, text) and labels (key, toxic); the labelled rows are a bounded sample, so they broadcast."""
    chosen = bounded(labels.where("toxic IN (0, 1)"), key, TRAIN_ROWS)
    own = F.pandas_udf(lambda texts: pd.Series([copy_key(t) for t in texts]), "long")
    train = docs.select(key, "text").join(F.broadcast(chosen), key).where("text IS NOT NULL").withColumn("__k", own("text"))
    train = settle(train.groupBy("__k", "toxic").agg(F.min("text").alias("text")), "toxicity-training")
    size = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    pos_n, neg_n = size.get(1, 0), size.get(0, 0)
    if not pos_n or not neg_n:
        return Scorer(float(bool(pos_n)), {}, set(), {})
    rate = pos_n / (pos_n + neg_n)
    counts = settle(count_terms(train), "toxicity-terms")
    # Only terms frequent enough to pass count as tests: the least frequency that can pass grows with their number.
    seen_in = {r["n"]: r["terms"] for r in counts.groupBy(F.least(F.col("pos") + F.col("neg"), F.lit(99)).alias("n")).agg(F.count("*").alias("terms")).collect()}
    least = next((k for k in range(2, 99) if k * math.log(1 / rate) >= math.log(max(1, sum(v for n, v in seen_in.items() if n >= k))) + DOUBT), 99)
    tests = max(1, sum(v for n, v in seen_in.items() if n >= least))
    # The training rows are bounded, and with them the terms that so many of them hold.
    passed = counts.where((F.col("pos") >= least) & marks(rate, tests)).orderBy("kind", "term").collect()
    full = {r["term"]: (r["pos"], r["neg"]) for r in passed if r["kind"] == "w" and len(r["term"]) > 2}
    prefix = {r["term"]: (r["pos"], r["neg"]) for r in passed if r["kind"] == "p" and r["pos"] >= STEM_ODDS * r["neg"]}
    stems: dict[str, tuple[int, int]] = {}
    for p in sorted(prefix, key=len):
        best = max((n for w, (n, _) in full.items() if w.startswith(p)), default=0)
        if 2 * best < prefix[p][0] and not any(p.startswith(s) for s in stems):
            stems[p] = prefix[p]
    terms = dict(full)  # words under a stem too: misspelt ones are told by these
    terms |= stems
    if not terms:
        return Scorer(rate, {}, set(), {})
    stems_kept = set(stems) & terms.keys()
    automaton = Automaton(sorted(terms.keys() - stems_kept), sorted(stems_kept))

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(t, e, int(p), int(n), int(n > p)) for w, p, n in zip(pdf["term"], pdf["pos"], pdf["neg"], strict=True) for t, e in automaton.match(w).items()]
            yield pd.DataFrame(rows, columns=["term", "edits", "pos", "neg", "clean"])

    # For each term and distance: documents of each label, and how many different words are rather clean ones.
    state = counts.where("kind = 'w'").mapInPandas(near, "term string, edits int, pos long, neg long, clean long")
    by_edit = {(r["term"], r["edits"]): (r["pos"], r["neg"], r["clean"]) for r in state.groupBy("term", "edits").agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "clean")]).collect()}
    hits = {}
    for t in terms:
        for e in range(allowed(t) + 1):
            p, n, clean = by_edit.get((t, e), (0, 0, 0)) if e else (*terms[t], 0)
            # Where clean words stand close to a term, a word one edit away is likelier another clean word.
            if e and (clean >= CROWDED or p < 9 * n or t in stems_kept):
                continue
            share = (p + 2 * (0.8 if e else 0.9)) / (p + n + 2)
            if share > (ACCEPT if e else max(0.3, 2 * rate)):
                hits[t, e] = min(share, 0.995)
    first = Scorer(0.0, hits, stems_kept, {})

    def contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for text, toxic in zip(pdf["text"], pdf["toxic"], strict=True):
                near = [x for _, _, x in first.found(text)]
                rows += [(w, toxic, 1 - toxic) for w in set().union(*near)] + [("<hit>" if near else "<none>", toxic, 1 - toxic)]
            yield pd.DataFrame(rows, columns=["word", "pos", "neg"])

    seen = train.select("text", "toxic").mapInPandas(contexts, "word string, pos long, neg long").groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    seen = settle(seen.where("pos + neg >= 5 OR word LIKE '<%'"), "toxicity-contexts")
    whole = {r["word"]: (r["pos"], r["neg"]) for r in seen.where("word LIKE '<%'").collect()}
    hp, hn = whole.get("<hit>", (0, 0))
    np_, nn = whole.get("<none>", (0, 0))
    mean = (hp + 1) / (hp + hn + 2)
    weights = {}
    for r in seen.where("neg > 0 OR word = '<quoted>'").collect():
        if r["word"] not in ("<hit>", "<none>"):
            strength, share = 10.0, mean
            shrunk = (r["pos"] + strength * share) / (r["pos"] + r["neg"] + strength)
            weights[r["word"]] = math.log(shrunk / (1 - shrunk)) - math.log(mean / (1 - mean))
    return Scorer(np_ / max(1, np_ + nn), hits, stems_kept, weights)


def scored(docs: DataFrame, scorer: Scorer, text: str = "text", out: str = "score") -> DataFrame:
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([scorer.score(t) for t in texts], dtype=float)

    return docs.withColumn(out, score(F.col(text)))
