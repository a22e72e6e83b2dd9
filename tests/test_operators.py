"""Operators of the library on small fixtures of the shapes they are meant for."""

import random
import zipfile

import pytest
import yaml
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestack.functions import text
from lodestack.operators import geo, graph, integrity, ranking, search, selection
from lodestack.plans import registry
from lodestack.sources import readers, writers


@pytest.fixture(scope="module")
def records(spark):
    rows = [("a", "Rain water", "collect and store", "x", "1"), ("b", "Water wells", "dig rain", "x", "2"), ("c", "rain  WATER", "other", "x", "1"), ("d", "Soil", "rain", "x", "4")]
    return spark.createDataFrame(rows, "record_id string, title string, body string, href string, location string")


def find(spark, records, phrase, limit=50):
    asked = spark.createDataFrame([(1, phrase)], "query_id int, phrase string")
    return [(r["record_id"], r["score"]) for r in search.search(records, asked, limit).orderBy("rank").collect()]


def test_search_scores_and_deduplicates(spark, records):
    assert find(spark, records, " Rain water ") == [("a", 100220), ("b", 10210), ("d", 100)]
    assert find(spark, records, "") == [] and find(spark, records, "zzz") == []
    assert find(spark, records, "rain water", 1) == [("a", 100220)]
    with pytest.raises(Exception, match="32 different"):
        find(spark, records, " ".join(f"w{i}" for i in range(33)))


@pytest.mark.parametrize("few", [0, 64])
def test_search_aliases_shelves_and_compatible_forms(spark, monkeypatch, few):
    monkeypatch.setattr(search, "FEW_WORDS", few)
    rows = [
        ("a", "Water", ["rainwater"], "water", "BOOKS/a.pdf", "Complete", ["textbooks"], None),
        ("b", "Plumbing", None, "water water Électricité", "BOOKS/b.pdf", "Complete", None, False),
        ("c", "Ｗａｔｅｒ", None, None, "BOOKS/old.pdf", "Complete", None, True),
        ("d", "Water duplicate", None, "", "BOOKS/a.pdf", "Complete", None, None),
        ("e", "Water duplicate", None, "", "BOOKS/a.pdf", "page 2", None, None),
    ]
    known = spark.createDataFrame(rows, "record_id string, title string, aliases array<string>, body string, href string, location string, shelves array<string>, legacy boolean")
    asked = [(1, "water", None), (2, "Rainwater", "all"), (3, "water", "textbooks"), (4, "water", "legacy"), (5, "ＷＡＴＥＲ", "all-with-legacy"), (6, "", "all"), (7, "électricité", "all")]
    got = {}
    for r in search.search(known, spark.createDataFrame(asked, "query_id int, phrase string, shelf string")).orderBy("rank").collect():
        got.setdefault(r["query_id"], []).append(r["record_id"])
    assert got == {1: ["a", "e", "b"], 2: ["a"], 3: ["a"], 4: ["c"], 5: ["a", "c", "e", "b"], 7: ["b"]}


def test_rows_are_numbered_in_order(spark):
    rng = random.Random(5)
    values = [rng.randrange(1000) for _ in range(500)]
    got = ranking.numbered(spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, i int"), [F.asc("v"), F.asc("i")]).collect()
    assert [r["position"] for r in sorted(got, key=lambda r: (r["v"], r["i"]))] == list(range(1, 501))
    assert ranking.numbered(spark.createDataFrame([], "v int"), [F.asc("v")]).count() == 0


def test_closure_prune_and_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("x", "y"), ("y", "x")], "src string, dst string")
    assert {tuple(r) for r in graph.closure(edges).collect()} == {("a", "b"), ("b", "c"), ("a", "c"), ("x", "y"), ("y", "x"), ("x", "x"), ("y", "y")}
    assert {r["node"] for r in graph.on_cycles(edges).collect()} == {"x", "y"}
    items = spark.createDataFrame([(1, True), (2, True), (3, False), (4, True), (5, True)], "id int, available boolean")
    needs = spark.createDataFrame([(2, 3), (4, 2), (5, 9)], "id int, need int")
    assert [r["id"] for r in graph.prune(items, needs).collect()] == [1]


def brute_closure(edges):
    found = set(edges)
    while True:
        more = found | {(a, d) for a, b in found for c, d in found if b == c}
        if more == found:
            return found
        found = more


def test_closure_matches_brute_force_on_random_graphs(spark):
    rng = random.Random(402)
    for _ in range(2):
        edges = {(rng.randrange(9), rng.randrange(9)) for _ in range(9)}
        df = spark.createDataFrame(sorted(edges), "src int, dst int")
        assert {tuple(r) for r in graph.closure(df).collect()} == brute_closure(edges)


def test_interleave_uses_a_turn_for_a_duplicate(spark):
    df = spark.createDataFrame([("a", "w1", 1), ("a", "w2", 2), ("a", "w5", 3), ("b", "w1", 1), ("b", "w3", 2), ("c", "w4", 1)], "shelf string, work string, n int")
    got = [r["work"] for r in ranking.interleave(df, "shelf", "work", [F.asc("n")], 10).collect()]
    assert got == ["w1", "w4", "w2", "w3", "w5"]


def test_selection_resolution(spark):
    resources = spark.createDataFrame([(1, 100, "ready"), (2, 50, "ready"), (3, 10, "ready"), (4, 9, "ready")], "resource_id int, target_bytes long, status string")
    members = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (3, "c"), (4, "d")], "resource_id int, asset_id string")
    assets = spark.createDataFrame([("a", 30, True), ("b", 40, True), ("c", 21, True), ("d", None, False)], "asset_id string, size_bytes long, resolved boolean")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "resource_id int")
    picked = selection.chosen(ids(1, 2), ids(3, 4), ids())
    replacements = spark.createDataFrame([(2, "b")], "resource_id int, asset_id string")
    overrides = spark.createDataFrame([(1, 90)], "resource_id int, target_bytes long")
    got = {r["resource_id"]: r for r in selection.resolve(resources, members, assets, picked, replacements, overrides).collect()}
    assert (got[1]["members"], got[1]["known_bytes"], got[1]["credit_bytes"], got[1]["adjusted_bytes"]) == (1, 30, 40, 50)
    assert got[3]["effective_bytes"] == 21 and got[4]["status"] == "unresolved" and got[2]["status"] == "ready"
    with pytest.raises(Exception, match="included and excluded"):
        selection.chosen(ids(1), ids(2), ids(2)).collect()


def test_capacity(spark):
    assets = spark.createDataFrame([(100, "document", True), (50, "supporting", False), (20, "software", False)], "size_bytes long, role string, direct boolean")
    profiles = spark.createDataFrame([("p", 1000, 10, 5, 200, 300), ("q", 150, 0, 0, None, None)], "profile string, capacity_bytes long, reserve_bytes long, discovery_bytes long, floor_bytes long, ceiling_bytes long")
    got = {r["profile"]: r for r in selection.capacity(assets, profiles).collect()}
    assert got["p"]["knowledge_bytes"] == 100 and got["p"]["shortfall_bytes"] == 100 and got["p"]["target_window"] == "below-target" and got["p"]["fits"]
    assert not got["q"]["fits"] and got["q"]["utilization_percent"] == 66 and got["q"]["target_window"] == "not-specified"


def test_integrity(spark):
    files = lambda *x: spark.createDataFrame(x, "file string, sha256 string")
    got = {r["file"]: r["status"] for r in integrity.verify(files(("a", "1"), ("b", "2"), ("c", "3")), files(("a", "1"), ("b", "9"), ("d", "4"))).collect()}
    assert got == {"a": "OK", "b": "FAILED", "c": "MISSING", "d": "UNKNOWN"}
    got = {r["file"]: r["change"] for r in integrity.difference(files(("a", "1"), ("b", None)), files(("a", "2"), ("c", "1")), "file").collect()}
    assert got == {"a": "changed", "b": "removed", "c": "added"}
    paths = spark.createDataFrame([("a/b",), ("A/B",), ("a",), ("c/d/e",), ("c/d",), ("z",)], "path string")
    assert {tuple(r) for r in integrity.path_conflicts(paths).collect()} == {("a/b", "same but for case"), ("a", "file and folder"), ("c/d", "file and folder")}
    merged, conflicts = integrity.merge_new(files(("a", "1"), ("b", "2")), files(("a", "1"), ("b", "3"), ("c", "4")), "file")
    assert merged.count() == 3 and [r["file"] for r in conflicts.collect()] == ["b"]
    rules = {"negative": F.col("n") < 0, "odd": F.col("n") % 2 == 1}
    df = spark.createDataFrame([(1, -1), (2, 4), (3, None)], "id int, n int")
    assert {(r["id"], r["rule"]) for r in integrity.violations(df, "x", "id", rules).collect()} == {("1", "negative"), ("3", "negative"), ("3", "odd")}


def test_coverage_finds_a_tiny_hole(spark):
    regions = spark.createDataFrame([("r", 0.0, 0.0, 2.0, 2.0), ("bad", float("nan"), 0.0, 1.0, 1.0)], "region_id string, x0 double, y0 double, x1 double, y1 double")
    schema = "sheet_id int, x0 double, y0 double, x1 double, y1 double, scale int, size_bytes long"
    sheets = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 2.0, 24, 5), (2, 1 + 1e-12, 0.0, 2.0, 2.0, 24, 5), (3, -5.0, -5.0, 15.0, 15.0, 100, 4)], schema)
    left = geo.holes(regions, sheets.where("scale = 24").drop("scale")).collect()
    assert len(left) == 1 and left[0]["x0"] == 1.0 and left[0]["x1"] == 1 + 1e-12
    got = {r["scale"]: (r["holes"], r["chosen"]) for r in geo.finest_complete(regions, sheets, sheets.select("scale"), 100).collect()}
    assert got == {24: (1, False), 100: (0, True)}


def test_text_functions(spark):
    df = spark.createDataFrame([("Ｆｕｌｌ  Width", "STRASSE straße", "é9"), (None, None, None)], "a string, b string, c string")
    got = df.select(text.compatible("a"), text.folded("b"), text.first_letter("c"), text.ordered_coverage("a", F.lit("x full width Full Width")), text.ordered_coverage(F.lit("abc"), F.lit("a b"))).first()
    assert tuple(got) == ("full width", "strasse strasse", "E", 1.0, 2 / 3)


def test_readers(spark, tmp_path):
    (tmp_path / "a.yaml").write_text("id: x\nn: 1\n")
    (tmp_path / "b.yaml").write_text("id: x\nid: y\n")
    got = {r["path"].rsplit("/", 1)[1]: r for r in readers.yaml_documents(spark, str(tmp_path)).collect()}
    assert got["a.yaml"]["document"] == '{"id": "x", "n": 1}' and got["b.yaml"]["error"] and got["b.yaml"]["document"] is None
    with pytest.raises(yaml.YAMLError):
        readers.parse_yaml("1: x")
    (tmp_path / "SUMS").write_text(f"{'a' * 64}  x/y.txt\nbroken\n{'b' * 64}  ../up\n{'c' * 64}  X/Y.txt\n")
    assert sorted(r["problem"] or "" for r in readers.checksums(spark, str(tmp_path / "SUMS")).collect()) == ["malformed", "repeated path", "repeated path", "unsafe path"]
    (tmp_path / "c.csv").write_text("id,title\n1,a\n2,b\n2,c\nx,d\n")
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("title", T.StringType())])
    good, bad = readers.csv_catalog(spark, str(tmp_path / "c.csv"), schema, "id")
    assert [r["id"] for r in good.collect()] == ["1"] and bad.count() == 3
    (tmp_path / "p.xml").write_text('<posts><row Id="1" Score="4"/><row Id="2"/></posts>')
    posts = readers.xml_rows(spark, str(tmp_path / "p.xml"), T.StructType([T.StructField("Id", T.StringType()), T.StructField("Score", T.StringType())]))
    assert {tuple(r) for r in posts.collect()} == {("1", "4"), ("2", None)}
    (tmp_path / "s.xml").write_text("<urlset><url><loc> http://a/?x=1&amp;y=2 </loc></url></urlset>")
    assert [r["url"] for r in readers.sitemap(spark, str(tmp_path / "s.xml")).collect()] == ["http://a/?x=1&y=2"]
    (tmp_path / "g.json").write_text('{"features": [{"properties": {"n": 1}, "geometry": {"type": "Polygon", "coordinates": [[[0, 1]]]}}]}')
    assert tuple(readers.geojson_features(spark, str(tmp_path / "g.json")).first()) == ("Polygon", '{"n":1}', "[[[0,1]]]")
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        for name in ("a.txt", "A.TXT", "../evil"):
            z.writestr(name, "data")
    got = {r["member"]: r["problem"] for r in readers.archive_members(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": None, "A.TXT": "collision", "../evil": "unsafe path"}
    files = readers.files_of(spark, str(tmp_path), "*.yaml")
    assert files.count() == 2 and readers.unread(files, files).count() == 0


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(2, "b&"), (1, "a")], "n int, t string")
    one, two = (writers.digest(df.repartition(k), ["n"]).first() for k in (1, 3))
    assert one == two and one["records"] == 2
    name = writers.write_bundle(df, str(tmp_path / "bundle"), ["n"])
    assert writers.write_bundle(df, str(tmp_path / "bundle"), ["n"]) == name
    writers.write_json(df, str(tmp_path / "rows"), ["n"])
    assert [r["value"] for r in spark.read.text(str(tmp_path / "rows")).orderBy("value").collect()] == ['{"n":1,"t":"a"}', '{"n":2,"t":"b&"}']
    pages = writers.bounded_pages(spark.range(10).selectExpr("id", "'k' AS k", "repeat('x', 10) AS body"), "k", [F.asc("id")], "body", 4, 1000)
    assert [r["count"] for r in pages.groupBy("page").count().orderBy("page").collect()] == [4, 4, 2]
    assert writers.listing_pages(df.withColumn("k", F.lit(1)), "k", "t", "t").first()["html"].count("<li>") == 2


def test_canonical_chain_has_no_last_step(spark, tmp_path):
    rows = [(3 * i, "copy", "de" if i == 1 else "en") for i in range(300)] + [(1, "other", "de"), (2, "other", None), (4, None, "en"), (5, "own", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["canonical"], r["steps"], r["legacy"]) for r in registry.QUERIES["canonical_chain"](spark, str(tmp_path)).collect()}
    assert got == {3 * i: (0, i, i > 0) for i in range(300)} | {1: (1, 0, True), 2: (1, 1, True), 4: (4, 0, False), 5: (5, 0, None)}


def test_constraint_rules_are_all_broken_somewhere(spark, sf_dir):
    from lodestack.operators import constraints as op

    big = sf_dir.replace("0.001", "0.01")
    got = {n: {r["rule"] for r in registry.QUERIES[n](spark, big).select("rule").distinct().collect()} for n in ("archive_constraints", "resource_constraints", "destination_conflicts")}
    assert set(op.asset_list_rules()) <= got["archive_constraints"] and len(got["archive_constraints"]) >= 15
    missing = {*op.resource_rules(), "repeated id", "number repeated", "member repeated", "member unknown", "replaces its own member", "ready without members", "edition unknown", "edition repeated", "edition member unknown", "edition member not pinned", "direct edition not readable", "compact edition without archive", "edition lacks critical members", "credit without replacement", "credit to an unknown collection", "credit for nothing replaced"} - got["resource_constraints"]
    assert missing <= {"credit id", "compact edition without archive"}
    assert got["destination_conflicts"] == {"path: same but for case", "path: file and folder"}
    none = spark.createDataFrame([], "id string, edition string, asset_id string")
    one = spark.createDataFrame([("a", "t", None, 1, "ready", "", None, None, "Not An Id", 1)], "id string, title string, number int, target_bytes long, status string, reason string, device struct<status:string,reason:string,evidence:array<string>>, source_pages array<string>, credit_id string, credit_bytes long")
    editions = spark.createDataFrame([("a", "compact", 1, "ready", "")], "id string, edition string, target_bytes long, status string, reason string")
    assets = spark.createDataFrame([], "asset_id string, status string, sha256 string, format string, reader_required boolean, destination string, critical boolean")
    rules = {r["rule"] for r in op.resource_violations(one, editions, none, none.select("id", "asset_id"), assets).collect()}
    assert rules == {"ready without members", "credit id", "edition without members", "compact edition without archive", "credit without replacement", "credit to an unknown collection", "credit for nothing replaced"}


def test_collections_share_a_list_of_replaced_files(spark):
    from lodestack.operators import constraints as op

    f = spark.createDataFrame
    schema = "id string, title string, number int, target_bytes long, status string, reason string, device struct<status:string,reason:string,evidence:array<string>>, source_pages array<string>, credit_id string, credit_bytes long"
    resources = f([("a", "t", None, 1, "ready", "", None, None, "c", 1), ("b", "t", None, 1, "ready", "", None, None, "d", 1), ("c", "t", None, 1, "ready", "", None, None, None, 1), ("d", "t", None, 1, "ready", "", None, None, "c", 1)], schema)
    members = f([("a", "published", "x"), ("b", "published", "z"), ("c", "published", "y"), ("d", "published", "z")], "id string, edition string, asset_id string")
    editions = f([], "id string, edition string, target_bytes long, status string, reason string")
    assets = f([(k, "resolved", "a" * 64, "pdf", False, "BOOKS/x", False) for k in "xyz"], "asset_id string, status string, sha256 string, format string, reader_required boolean, destination string, critical boolean")
    using, lists = f([("a", 1), ("b", 1), ("d", 2)], "id string, list_id int"), f([(1, "x"), (1, "y"), (1, "gone")], "list_id int, asset_id string")
    got = op.resource_violations(resources, editions, members, using, assets, lists)
    want = {("a", "replacement unknown"), ("b", "replacement unknown"), ("a", "replaces its own member"), ("b", "credit for nothing replaced"), ("d", "credit without replacement"), ("d", "credit for nothing replaced")}
    assert {(r["id"], r["rule"]) for r in got.collect()} == want
    pairs = using.join(lists, "list_id").select("id", "asset_id")
    assert {(r["id"], r["rule"]) for r in op.resource_violations(resources, editions, members, pairs, assets).collect()} == want
