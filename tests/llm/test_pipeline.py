import re

import pytest

import corpus_pipeline
from lodestack.llm import piece_fst, queries, secret_ledger
from lodestack.llm.common import table

from .test_operators import components, jaccard, shingles



def test_stages_keep_columns_and_take_effect(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES][1] == "SimHash near-dedup"
    before, n = docs, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf_dir)
        assert after.columns == docs.columns
        assert after.count() <= before.count()
        before = after
    kept = before.count()
    out = corpus_pipeline.STAGES[-1][1](spark, before, sf_dir)
    assert out.count() == kept < n
    assert out.where("NOT round_trip").count() == 0


def test_stages_on_edge_rows(spark, sf_dir):
    schema = table(spark, sf_dir, "documents").schema
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "a b c", "en", "s", 5), (3, "a b c", "en", "s", 5), (None, "no id", "en", "s", 5), (8, "a b c", "en", "s", 5)]
    given = spark.createDataFrame(rows, schema)
    near = corpus_pipeline.keep_distinct(spark, given, sf_dir)
    assert sorted(r["doc_id"] or 0 for r in near.collect()) == [0, 1, 3]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, given, sf_dir).count() <= len(rows)
        assert stage(spark, given.where("false"), sf_dir).count() == 0


def test_stages_match_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    stages = dict(corpus_pipeline.STAGES)
    graded = stages["quality classifier"](spark, docs, sf_dir)
    labels = {r["doc_id"]: r["quality"] for r in table(spark, sf_dir, "labels").collect()}
    kept = {r["doc_id"]: r["text"] for r in graded.collect()}
    right = [(d in kept) == (q == 1) for d, q in labels.items()]
    assert sum(right) / len(right) > 0.9

    ids = sorted(kept)
    grams = [shingles(kept[i]) for i in ids]
    root = components(len(ids), [(i, j) for i in range(len(ids)) for j in range(i) if jaccard(grams[i], grams[j]) >= 0.8])
    want = {ids[i] for i in range(len(ids)) if root[i] == i}
    distinct = stages["SimHash near-dedup"](spark, graded, sf_dir)
    assert {r["doc_id"] for r in distinct.collect()} == want

    items = [r["text"] for r in table(spark, sf_dir, "benchmark").collect()]
    clean = stages["benchmark decontamination"](spark, distinct, sf_dir)
    left = {r["doc_id"]: r["text"] for r in clean.collect()}
    words = lambda t: re.findall(r"\w+", t.lower())
    grams = {tuple(w[k : k + 4]) for t in items for w in [words(t)] for k in range(len(w) - 3)}
    for d in want:
        w = words(kept[d])
        if any(i.lower() in kept[d].lower() for i in items):
            assert d not in left
        if grams.isdisjoint(tuple(w[k : k + 4]) for k in range(len(w) - 3)):
            assert d in left

    redacted = {r["doc_id"]: r["text"] for r in stages["secret scans"](spark, clean, sf_dir).collect()}
    assert redacted.keys() == left.keys()
    for d, t in redacted.items():
        assert (t == left[d]) == (not secret_ledger.find(left[d]))
        assert not [s for s in secret_ledger.find(t) if s[0] in ("access", "hex")]

    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=piece_fst.MODEL)
    for r in stages["SentencePiece encoding"](spark, clean, sf_dir).collect():
        assert list(r["token_ids"]) == library.encode(left[r["doc_id"]]) and r["round_trip"]


COLUMNS = {
    "op3": ["doc_id", "held_out", "lang_pred", "score"],
    "op4": ["doc_id", "held_out", "score", "predicted"],
    "op5": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op7": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op8": ["doc_id", "fingerprint", "component_id"],
    "op9": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op10": ["doc_id", "held_out", "score", "predicted"],
}


@pytest.mark.parametrize("op", COLUMNS)
def test_query_columns_and_rows(spark, sf_dir, op):
    name = next(n for n in queries.QUERIES if n.startswith(f"{op}_"))
    df = queries.QUERIES[name](spark, sf_dir)
    assert df.columns == COLUMNS[op]
    source = table(spark, sf_dir, "pages" if op == "op9" else "documents")
    assert df.count() == source.count()


def test_held_out_accuracy(spark, sf_dir):
    big = sf_dir.replace("0.001", "0.01")
    truth = table(spark, big, "labels").join(table(spark, big, "documents").select("doc_id", "lang"), "doc_id")
    for name, label, least in (("op3_language", "lang", 0.97), ("op4_quality", "quality", 0.95), ("op10_toxicity", "toxic", 0.9)):
        got = queries.QUERIES[name](spark, big).where("held_out").join(truth, "doc_id").collect()
        hit = [(r["lang_pred"] if label == "lang" else r["predicted"]) == r[label] for r in got]
        assert sum(hit) / len(hit) >= least, name
