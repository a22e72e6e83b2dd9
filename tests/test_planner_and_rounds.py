"""The planner's states, rounds over budgets and works, samples, sections, links and supervised streams."""

import dataclasses
import datetime
import itertools
import math
import posixpath
import random
import urllib.parse

import pytest
from pyspark.sql import functions as F

from lodestack.operators import links, planner, ranking, sections
from lodestack.streaming import supervisor


def test_places_and_running_sums(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, "a", "a", "a", "b"]), rng.randrange(50)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, k string, v int").repartition(5)
    got = {r["id"]: (r["n"], r["of"]) for r in ranking.placed(df, "k", [F.desc("v"), F.asc("id")], "n", "of").collect()}
    for k in (None, "a", "b"):
        own = sorted((r for r in rows if r[1] == k), key=lambda r: (-r[2], r[0]))
        assert [got[r[0]] for r in own] == [(n, len(own)) for n in range(1, len(own) + 1)]
    sums = {r["id"]: r["s"] for r in ranking.running(df, [F.asc("v"), F.asc("id")], "v", "s").collect()}
    order = sorted(rows, key=lambda r: (r[2], r[0]))
    assert [sums[r[0]] for r in order] == list(itertools.accumulate(r[2] for r in order))


@pytest.mark.parametrize("seed", range(3))
def test_budget_takes_what_still_fits(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice([1, 5, 40, 41, 300]) + rng.randrange(5)) for i in range(80)]
    want, left = set(), 700
    for i, size in rows:
        if size <= left:
            want.add(i)
            left -= size
    df = spark.createDataFrame(rows, "place int, size int")
    assert {r["place"] for r in ranking.within_budget(df, "place", "size", 700).where("taken").collect()} == want
    assert ranking.within_budget(df.where("false"), "place", "size", 5).isEmpty()


@pytest.mark.parametrize("seed", range(2))
def test_works_are_taken_once_by_any_key(spark, seed):
    rng = random.Random(seed)
    rows = [(i, [f"k{rng.randrange(60)}" for _ in range(rng.randrange(4))]) for i in range(90)]
    want, seen = set(), set()
    for i, keys in rows:
        if not seen & set(keys):
            want.add(i)
            seen |= set(keys)
    df = spark.createDataFrame(rows, "place int, keys array<string>")
    assert {r["place"] for r in ranking.first_works(df, "place", "keys").collect()} == want


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(3000).selectExpr("id", "IF(id % 10 = 0, NULL, id % 3) AS stratum")
    draws = [{tuple(r) for r in ranking.stratified(df.repartition(n), "stratum", "id", "s", 0.1, 0.9).collect()} for n in (1, 7)]
    most = math.ceil(math.log1p(-0.9) / math.log1p(-0.1))
    assert draws[0] == draws[1] and len(draws[0]) == 4 * most
    assert sum(r[3] == "screening" for r in draws[0]) == 4 * 8
    assert ranking.stratified(df.where("id < 9"), "stratum", "id", "s", 0.1, 0.9).count() == 9


def test_normal_paths_equal_the_library(spark):
    rng = random.Random(4)
    paths = ["".join(rng.choice(["/", "..", ".", "a", "b%20", "/../"]) for _ in range(rng.randrange(9))) for _ in range(300)] + ["", "/", "//a", "../..", "/../x", "a/b/../../.."]
    df = spark.createDataFrame([(p,) for p in set(paths)], "p string")
    for r in df.select("p", links.normal("p").alias("n")).collect():
        want = posixpath.normpath(r["p"])
        assert r["n"] == (want[1:] if want.startswith("//") else want), r["p"]
    urls = ["a%20b/c?x#y", "//h/p%2Fq", "http://h", "x+y", "%zz", "#f", "mailto:a@b", "HTTPS://u@h:1/p?q"]
    for r in spark.createDataFrame([(u,) for u in urls], "u string").select("u", links.path("u").alias("p"), links.host("u").alias("h"), links.scheme("u").alias("s")).collect():
        parts = urllib.parse.urlsplit(r["u"])
        assert (r["s"], r["h"]) == (parts.scheme, parts.netloc)
        if not r["u"].startswith("mailto"):
            assert r["p"] == urllib.parse.unquote(parts.path)


def tree(rng, n):
    return [(i, None if i == 0 else rng.randrange(i), rng.randrange(1000), f"v{rng.randrange(5)}") for i in range(n)]


def test_tree_digests_tell_moved_leaves(spark):
    rows = tree(random.Random(2), 60)
    frame = lambda rows: spark.createDataFrame(rows, "id int, parent int, position int, value string")
    of = lambda rows: {r["id"]: (r["digest"], r["size"], r["height"]) for r in sections.tree_digests(frame(rows)).collect()}
    base = of(rows)
    renamed = of([(100 + i, None if p is None else 100 + p, n, v) for i, p, n, v in rows])
    assert {i: d for i, d in base.items()} == {i - 100: d for i, d in renamed.items()} and base[0][1] == 60
    leaf = next(i for i, *_ in reversed(rows) if i not in {p for _, p, *_ in rows})
    changed = of([(i, p, n + (i == leaf), v) for i, p, n, v in rows])
    up, way = leaf, set()
    while up is not None and rows[up][1] is not None:
        up = rows[up][1]
        way.add(up)
    assert {i for i in base if base[i] != changed[i]} == way
    assert of([(1, 2, 0, "a"), (2, 1, 0, "b"), (3, None, 0, "c")]).keys() == {3}


def test_sections_without_a_place_leave_their_children_on_top(spark):
    rows = [("a", 0, 1, "One", None), ("a", 1, 2, "Two", "no page"), ("a", 2, 3, "Three", None), ("a", 3, 2, "Four", None), ("b", 0, 1, "Bad", "no page"), ("c", 0, 1, "Fine", None)]
    found, report = sections.imported(spark.createDataFrame(rows, "doc string, position int, level int, title string, reason string"))
    assert {(r["doc"], r["position"], r["parent"], r["orphan"]) for r in found.collect()} == {("a", 0, None, False), ("a", 2, None, True), ("a", 3, 0, False), ("c", 0, None, False)}
    assert {r["doc"]: (r["warnings"], r["status"]) for r in report.collect()} == {"a": (2, "partial-draft"), "b": (2, "whole-document"), "c": (0, "draft")}


def events(n, seed):
    rng, t = random.Random(seed), datetime.datetime(2024, 1, 1)
    out = []
    for i in range(n):
        t += datetime.timedelta(seconds=rng.choice([1, 60, 3000, 30_000]))
        out.append((rng.randrange(4), i, t, rng.choice(["failure", "failure", "beat", "submit", "complete"])))
    return out


def test_replayed_batches_make_the_same_transitions(spark, tmp_path):
    rows, schema = events(120, 6), "run_id long, event_id long, ts timestamp_ntz, kind string"
    policy = supervisor.Policy(attempts=3, stale=20_000)
    whole = spark.createDataFrame(rows, schema)
    want = sorted(map(tuple, supervisor.batch_transitions(whole, policy).collect()), key=repr)
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    folder = f"file://{tmp_path}/run"
    for k in range(3):  # three runs over the same folder, each going on from the state of the one before
        spark.createDataFrame(rows[40 * k : 40 * k + 40], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        got = supervisor.run_once(spark, stream(), policy, folder)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert {r[3] for r in want} == {"running", "retry_wait", "failed", "complete", "stale"}


def catalog(spark):
    f = spark.createDataFrame
    resources = [("core", "published", 100, "ready"), ("core", "direct", 45, "ready"), ("maps", "published", 50, "ready"), ("atlas", "published", 80, "ready"), ("readers", "published", 5, "ready")]
    members = [("core", "published", "book"), ("core", "published", "zim"), ("core", "direct", "book"), ("maps", "published", "map"), ("maps", "published", "book"), ("atlas", "published", "big"), ("readers", "published", "exe"), ("maps", "published", "made")]
    assets = [("book", 10, True, "pdf", "document"), ("zim", 20, True, "zim", "document"), ("map", 30, True, "pdf", "document"), ("big", 40, False, "pdf", "document"), ("exe", 2, True, "exe", "software"), ("made", 3, True, "html", "document"), ("base", 7, True, "pdf", "document")]
    return planner.Catalog(
        f(resources, "resource_id string, edition string, target_bytes long, status string"),
        f(members, "resource_id string, edition string, asset_id string"),
        f([(*a, True, a[0] == "book", False, None) for a in assets], "asset_id string, size_bytes long, resolved boolean, format string, role string, direct boolean, critical boolean, required boolean, source_id string"),
        f([("made", "zim")], "asset_id string, need string"),
        f([("atlas", "map")], "resource_id string, asset_id string"),
        f([("atlas", "maps", 21)], "resource_id string, credited_id string, bytes long"),
        f([("p", True, 10**9, 0, 1000, 5)], "profile_id string, by_default boolean, capacity_bytes long, reserve_bytes long, discovery_bytes long, readers_bytes long"),
        f([("p", "core", "published")], "profile_id string, resource_id string, edition string"),
        f([], "profile_id string, asset_id string"),
        "readers",
    )


def test_planner_states(spark):
    states = spark.createDataFrame([(k, "p", True) for k in range(5)], "state_id int, profile_id string, allow_incomplete boolean")
    items = [(1, "core", True, "direct"), (2, "maps", True, None), (3, "maps", True, None), (3, "atlas", True, None), (4, "core", False, None), (4, "maps", True, "compact")]
    report, rows, files = planner.resolve(catalog(spark), states, spark.createDataFrame(items, "state_id int, resource_id string, included boolean, edition string"))
    held = {}
    for r in files.collect():
        held.setdefault(r["state_id"], set()).add(r["asset_id"])
    assert held == {0: {"book", "zim", "exe"}, 1: {"book"}, 2: {"book", "zim", "exe", "map", "made"}, 3: {"book", "zim", "exe", "made"}, 4: {"map", "book"}}
    got = {r["state_id"]: r for r in report.collect()}
    assert (got[0]["knowledge_bytes"], got[0]["software_bytes"], got[0]["direct_files"], got[0]["critical_files"]) == (30, 2, 2, 1)
    assert got[0]["target_bytes"] == 100 and got[0]["reader_bytes"] == 5 and got[0]["can_build"] and got[1]["target_bytes"] == 45
    own = {(r["state_id"], r["resource_id"]): (r["status"], r["target_bytes"]) for r in rows.collect()}
    assert own[3, "maps"] == ("ready", 29) and own[3, "atlas"][0] == "unresolved" and own[0, "readers"] == ("ready", 5)
    assert got[4]["errors"] == ["edition is not there"] and not got[4]["can_build"] and own[4, "maps"][0] == "partial"
    locks = report.selectExpr("state_id", "profile_id", "files", "IF(state_id = 1, digest + 1, digest) AS digest", "known_bytes", "target_bytes", "reader_bytes", "target_bytes + reader_bytes + IF(state_id = 2, 1, 0) AS planned_bytes")
    assert {r["state_id"]: r["verdict"] for r in planner.replay(locks, report).collect()} == {0: "same", 1: "other files", 2: "budget does not add up", 3: "same", 4: "same"}


def test_more_states_than_a_word_holds_and_shared_lists(spark):
    """States are bits of words; collections that replace the same files share a list. Both give what pairs give."""
    whole = catalog(spark)
    claims = spark.createDataFrame([("atlas", "map"), ("core", "map"), ("core", "big")], "resource_id string, asset_id string")
    shared = spark.createDataFrame([("atlas", 1), ("core", 1), ("core", 2)], "resource_id string, asset_id int")
    lists = spark.createDataFrame([(1, "map"), (2, "big")], "list_id int, asset_id string")
    states = spark.range(70).selectExpr("CAST(id AS INT) AS state_id", "'p' AS profile_id", "true AS allow_incomplete")
    items = spark.range(70).selectExpr("CAST(id AS INT) AS state_id", "explode(array('maps', 'atlas')) AS resource_id", "true AS included", "CAST(NULL AS STRING) AS edition").where("resource_id = 'maps' OR state_id % 3 = 0")
    got = []
    for c in (dataclasses.replace(whole, replacements=claims), dataclasses.replace(whole, replacements=shared, lists=lists)):
        report, rows, files = planner.resolve(c, states, items)
        got.append([sorted(map(str, df.collect())) for df in (report, rows, files)])
        errors = {r["state_id"]: r["errors"] for r in report.collect()}
        assert len(errors) == 70 and all(("several collections replace a file" in e) == (k % 3 == 0) for k, e in errors.items())
    assert got[0] == got[1]
