"""The n-gram join, the fill-in-middle cuts and the filter audit against brute force."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from lodestack.llm import fill_in_middle, filter_audit, jaccard_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, n=4):
    w = WORD.findall(low(text))
    return frozenset(" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
            root[find(j)] = find(i)
    out = []
    for i, (k, _) in enumerate(rows):
        own = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((k, len(sets[i]), min(own, default=None) if sets[i] else k))
    return sorted(out, key=str)


def group(rng, base, copies, edits):
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        yield " ".join(w)


def corpus(seed):
    rng = random.Random(seed)
    stock = [f"w{i}" for i in range(400)]
    texts = []
    for size, copies, edits in ((120, 40, 4), (60, 25, 3), (300, 12, 14), (30, 30, 2)):
        base = [rng.choice(stock) for _ in range(size)]
        texts += group(rng, base, copies, edits)
        texts += group(rng, base[: size * 9 // 10] + [rng.choice(stock) for _ in range(size // 6)], copies // 3, edits)
    passage = [rng.choice(stock) for _ in range(60)]
    texts += [" ".join(passage + [rng.choice(stock) for _ in range(rng.randrange(30))]) for _ in range(30)]
    texts += [" ".join(rng.choice(stock) for _ in range(rng.randrange(1, 90))) for _ in range(40)]
    texts += ["", None, " \t\n", "a", "A", "a b", "a b c d", "A B  C\tD", "a b c", "word joined x y z", None, texts[0], texts[0]]
    keys = rng.sample(range(10_000), len(texts))
    return [(None if i % 37 == 5 else k, t) for i, (k, t) in enumerate(zip(keys, texts, strict=True))]


@pytest.mark.parametrize(("seed", "long", "block", "hot"), [(1, 32, 384, 64), (2, 1, 384, 64), (3, 3, 7, 1e-9), (4, 8, 5, 1e-9)])
def test_join_equals_brute_force(spark, docs, monkeypatch, seed, long, block, hot):
    for name, value in (("LONG", long), ("BLOCK", block), ("HOT", hot), ("_STEP", 64)):
        monkeypatch.setattr(jaccard_join, name, value)
    rows = corpus(seed)
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.linked(docs(rows)).collect()]
    assert sorted(got, key=str) == brute_components(rows)


def dealt_rows(monkeypatch):
    """Numbers of rows that are dealt to pairs of blocks, filled in while a join runs."""
    found, own = [], jaccard_join._block_links
    monkeypatch.setattr(jaccard_join, "_block_links", lambda rows, percent: (found.append(rows.count()), own(rows, percent))[1])
    return found


def test_groups_of_near_copies_are_dealt_once_not_for_each_list(spark, docs, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LONG", 8)
    rng, found = random.Random(11), dealt_rows(monkeypatch)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    far = []
    for _ in range(30):  # under 0.85 alike to every other text
        w = list(base)
        for i in rng.sample(range(8, 112, 8), 3):
            w[i] = f"e{rng.randrange(10**6)}"
        far.append(" ".join(w))
    rows = list(enumerate([*group(rng, base, 30, 1), *far]))
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.linked(docs(rows)).collect()]
    assert sorted(got, key=str) == brute_components(rows)
    assert found and sum(found) <= len(rows)


def test_lists_that_texts_share_by_chance_are_not_compared(spark, docs, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LONG", 8)
    measured = jaccard_join.measured
    # As in large tables, where buckets hold too many shingles to tell that one of them is common.
    monkeypatch.setattr(jaccard_join, "measured", lambda *a: (lambda own, rarity, hot: (own, np.zeros_like(rarity), hot))(*measured(*a)))
    rng, found = random.Random(12), dealt_rows(monkeypatch)
    rows = list(enumerate("of the line that all texts have " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(9)) for _ in range(60)))
    rows += [(60 + k, t + " a b" * (k % 2)) for k, t in rows[:6]]
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.linked(docs(rows)).collect()]
    assert sorted(got, key=str) == brute_components(rows)
    assert not sum(found)


@pytest.mark.parametrize(("seed", "long", "block", "part"), [(5, 2, 9, 4), (6, 5, 40, 3)])
def test_join_by_small_parts_equals_brute_force(spark, docs, monkeypatch, seed, long, block, part):
    # Of links between parts of blocks, which workers compare, brute force is made here apart.
    monkeypatch.setattr(jaccard_join, "LONG", long)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows = corpus(seed)
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.linked(docs(rows)).collect()]
    assert sorted(got, key=str) == brute_components(rows)
    monkeypatch.setattr(jaccard_join, "_PART", part)
    rng = np.random.default_rng(seed)
    base = np.arange(40, dtype=np.uint64)
    nodes = [(k, k % 17, np.unique(np.r_[base[rng.random(40) > 0.06], rng.integers(100, 10**6, 1).astype(np.uint64)])) for k in range(30)]
    for others in (nodes, [(k + 100, c, x) for k, c, x in nodes[:11]]):
        found, top = jaccard_join._linked(nodes, others, 85), {c: c for c in range(17)}

        def find(c, top=top):
            return c if top[c] == c else find(top[c])

        comp = {k: c for k, c, _ in [*nodes, *others]}
        for u, v in found:
            assert find(comp[u]) != find(comp[v])  # a forest
            top[find(comp[u])] = find(comp[v])
        sets = {k: set(x.tolist()) for k, _, x in [*nodes, *others]}
        for (u, *_), (v, *_) in itertools.product(nodes, others):
            both = len(sets[u] & sets[v])
            assert 100 * both < 85 * len(sets[u] | sets[v]) or find(comp[u]) == find(comp[v])
        assert all(100 * len(sets[u] & sets[v]) >= 85 * len(sets[u] | sets[v]) for u, v in found)


def test_join_of_empty_tables_and_only_empty_texts(spark, docs):
    assert jaccard_join.linked(docs([(1, "a")]).where("false")).count() == 0
    assert sorted(map(tuple, jaccard_join.linked(docs([(2, ""), (1, None)])).collect())) == [(1, 0, 1), (2, 0, 2)]


def test_linked_sets_share_a_prefix_shingle_under_every_order():
    rng = np.random.default_rng(5)
    rarity = rng.integers(0, 20, jaccard_join.BUCKETS).astype(np.uint8)
    for n in [*range(1, 60), 500]:
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for keep in (n, max(1, (85 * n + 99) // 100)):
            b = np.unique(np.r_[a[:keep], rng.integers(0, 2**63, max(0, n - keep)).astype(np.uint64)])
            common = len(np.intersect1d(a, b))
            if 100 * common < 85 * len(np.union1d(a, b)):
                continue
            for order in range(jaccard_join.ORDERS):
                for met in (1, 3):
                    first = [set(x[np.argsort(jaccard_join.ranks(x, rarity, order))][: jaccard_join.prefix_length(len(x), met=met)].tolist()) for x in (a, b)]
                    assert len(first[0] & first[1]) >= min(met, *(jaccard_join.least_common(len(x)) for x in (a, b)))


def test_sets_that_share_half_a_digest_are_numbered_apart(spark):
    own = spark.createDataFrame([(1, 7, 70, 3), (2, 7, 71, 3), (3, 8, 80, 3), (4, 0, 0, 0)], "key long, hi long, lo long, n long")
    classes, second = jaccard_join._numbered(own)
    assert second == {(7, 70)} and {(r["node"], r["least"]) for r in classes.collect()} == {(70, 1), (7, 2), (8, 3)}


UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute_cut(key, text):
    text = text or ""
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_cuts_equal_brute_force_and_texts_come_back(spark, docs):
    rng = random.Random(8)
    letters = " \t\n\x0b\x0c\r \u0085<>PSMabé漢\U0001f600"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(400)]
    texts += [None, "", " ", "\n\n", "x", "a<P>b", "<S>", "<M", "ends in <", "<<P", " lead", "trail ", "é ‍", "long " * 50_000]
    rows = [(i if i % 50 else None, t) for i, t in enumerate(texts * 2)]
    df = fill_in_middle.transformed(docs(rows)).withColumn("back", fill_in_middle.restored())
    got = [((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]), r["back"]) for r in df.collect()]
    assert sorted((g for g, _ in got), key=repr) == sorted(((k, *brute_cut(k, t)) for k, t in rows), key=repr)
    assert sorted(b for _, b in got) == sorted(t or "" for _, t in rows)
    forms = {g[2] for g, _ in got}
    assert forms == {"plain", "psm", "spm"}
    assert fill_in_middle.transformed(docs([(1, "a")]).where("false")).count() == 0


def brute_audit(rows, labels):
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    least = {}
    for k, t, _ in rows:
        if k is not None:
            least[t or ""] = min(k, least.get(t or "", k))
    fails = []
    for k, t, part in rows:
        t = t or ""
        w = WORD.findall(t)
        own = {"A"} if len(w) < 100 else set()
        own |= {"B"} if 100 * len(set(w)) < 80 * len(w) else set()
        own |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 10 * len(t) else set()
        own |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        own |= {"E"} if k is not None and k > least[t] else set()
        fails.append((part or "", own, k in good, k in toxic))
    out = set()
    for part in {p for p, *_ in fails}:
        here = [f for f in fails if f[0] == part]
        shapley, steps = dict.fromkeys("ABCDE", 0), []
        for order in itertools.permutations("ABCDE"):
            rest = here
            for n, f in enumerate(order, 1):
                gone = [x for x in rest if f in x[1]]
                left = [x for x in rest if f not in x[1]]
                redundant = sum(f in x[1] for x in here) - len(gone)
                steps.append((part, "".join(order), n, len(left), len(gone), redundant, sum(x[1] == {f} for x in here), sum(x[2] for x in gone), sum(x[3] for x in gone)))
                shapley[f] += len(gone)
                rest = left
        out |= {(*s, shapley[s[1][s[2] - 1]]) for s in steps}
    return out


@pytest.mark.parametrize("seed", range(2))
def test_audit_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    stock = ["alpha", "Beta", "GAMMA", "delta", "x#", "50%", "|"] + [f"w{i}" for i in range(200)]
    texts = [" ".join(rng.choice(stock[rng.randrange(8) :]) for _ in range(rng.choice((3, 99, 100, 140)))) for _ in range(40)] + ["", None, "A", "É" * 9 + "A"]
    rows = [(rng.choice([None, *range(60)]), rng.choice(texts), rng.choice(["en", "de", None, ""])) for _ in range(160)]
    labels = [(rng.choice([None, *range(60)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(60)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, n int, mask string")
    known = spark.createDataFrame([(*r, "y") for r in labels], "doc_id long, quality int, toxic int, part string")
    got = [tuple(r) for r in filter_audit.audit(filter_audit.mask_counts(df, known)).collect()]
    assert set(got) == brute_audit(rows, labels) and len(got) == len(set(got)) == 600 * 3


def test_audit_of_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(filter_audit.mask_counts(df, labels)).count() == 0
    one = spark.createDataFrame([(1, None, None)], "doc_id long, text string, lang string")
    rows = filter_audit.audit(filter_audit.mask_counts(one, labels)).collect()
    assert len(rows) == 600 and {r["part"] for r in rows} == {""} and {r["shapley"] for r in rows} == {0, 120}


def test_zeta_sums_subsets(spark):
    counts = [random.Random(1).randrange(9) for _ in range(16)]
    df = spark.createDataFrame([(counts,)], "c array<long>")
    got = filter_audit.zeta(df, ("c",), 4).first()["c"]
    assert got == [sum(counts[t] for t in range(16) if t & s == t) for s in range(16)]
