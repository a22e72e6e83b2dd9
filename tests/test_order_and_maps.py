"""Levels, cycles, followed links and polygon sweeps against brute force on random input."""

import pathlib
import random

import pytest
from pyspark.sql import functions as F

from lodestack.operators import graph, order, polygons
from lodestack.plans import registry


def brute_levels(edges):
    nodes, level = {n for e in edges for n in e}, {}
    while True:
        ready = {n: max((level[d] + 1 for s, d in edges if s == n), default=0) for n in nodes - set(level) if all(d in level for s, d in edges if s == n)}
        if not ready:
            return level, {e for e in edges if e[1] not in level}
        level |= ready


@pytest.mark.parametrize("seed", range(3))
def test_levels_of_random_graphs_with_planted_cycles(spark, seed):
    rng = random.Random(seed)
    edges = {(a, b) for a, b in ((rng.randrange(40), rng.randrange(40)) for _ in range(50)) if a > b} | {(50, 51), (51, 52), (52, 50), (60, 50), (61, 60), (70, 70)}
    found, rest = order.levels(spark.createDataFrame([*edges, *list(edges)[:5]], "src int, dst int"))
    want, left = brute_levels(edges)
    assert {tuple(r) for r in found.collect()} == set(want.items())
    assert {(r["src"], r["dst"]) for r in rest.collect()} == left
    witness, back = order.cycles(rest)
    assert {(r["cycle"], r["length"], tuple(r["nodes"])) for r in witness.collect()} == {(50, 3, (50, 51, 52)), (70, 1, (70,))}
    assert {tuple(r) for r in back.collect()} == {(n, 50) for n in (50, 51, 52, 60, 61)} | {(70, 70)}


def test_acyclic_graphs_leave_nothing(spark):
    found, rest = order.levels(spark.createDataFrame([("c", "b"), ("b", "a")], "src string, dst string"))
    assert {tuple(r) for r in found.collect()} == {("a", 0), ("b", 1), ("c", 2)} and rest.isEmpty()
    found, rest = order.levels(spark.createDataFrame([], "src string, dst string"))
    assert found.isEmpty() and rest.isEmpty()


def test_chains_of_ten_thousand_links(spark):
    links = spark.range(1, 10_001).selectExpr("id", "id - 1 AS target").union(spark.createDataFrame([(20_001, 20_002), (20_002, 20_001), (20_003, 5), (20_003, 6), (20_004, 20_003)], "id long, target long"))
    nodes = spark.createDataFrame([(n,) for n in (0, 1, 7, 10_000, 20_001, 20_003, 20_004, 30_000)], "id long")
    got = {r["id"]: (r["canonical"], r["steps"], r["problem"]) for r in order.canonical(links, nodes).collect()}
    assert got == {0: (0, 0, None), 1: (0, 1, None), 7: (0, 7, None), 10_000: (0, 10_000, None), 20_001: (None, None, "cycle"), 20_003: (None, None, "several targets"), 20_004: (None, None, "several targets"), 30_000: (30_000, 0, None)}


@pytest.mark.parametrize("seed", range(2))
def test_breadcrumbs_pass_hidden_parents_over(spark, seed):
    rng = random.Random(seed)
    visible = {i: rng.random() < 0.7 for i in range(60)}
    parents = {i: rng.sample(range(i), min(i, rng.randrange(3))) for i in range(60)}
    nodes = spark.createDataFrame([(i, f"t{i}", v) for i, v in visible.items()], "id int, title string, visible boolean")
    above = spark.createDataFrame([(i, p, n) for i, ps in parents.items() for n, p in enumerate(ps)] + [(5, 99, -1)], "id int, parent int, position int")
    want = {}
    for i in (i for i, v in visible.items() if v):
        way = [i]
        while first := [p for p in parents[way[-1]] if visible[p]]:
            way.append(first[0])
        want[i] = (way[-1], len(way) - 1, " > ".join(f"t{n}" for n in reversed(way)))
    assert {r["id"]: (r["root"], r["depth"], r["trail"]) for r in order.breadcrumbs(nodes, above).collect()} == want


@pytest.mark.parametrize("seed", range(2))
def test_losses_spread_both_ways(spark, seed):
    rng = random.Random(seed)
    items = {i: (rng.random() < 0.93, rng.random() < 0.5) for i in range(60)}
    members = {(i, rng.randrange(max(0, i - 12), i)) for i in range(1, 60)} | {(3, 777)}
    stays = {i for i, (present, _) in items.items() if present}
    while True:
        gone = {m for m, p in members if m in stays and p not in stays} | {p for m, p in members if p in stays and items[p][1] and m not in stays}
        if not gone:
            break
        stays -= gone
    df = spark.createDataFrame([(i, *v) for i, v in items.items()], "id int, present boolean, whole boolean")
    got = graph.available(df, spark.createDataFrame(list(members), "id int, package int"))
    assert {r["id"] for r in got.where("stays").collect()} == stays
    chosen = spark.createDataFrame([(i % 4, i, "ready") for i in range(60)] + [(9, 60, "ready"), (10, min(stays, default=0), "draft")], "collection int, id int, status string")
    rows = {r["collection"]: r for r in graph.downgraded(chosen, df.selectExpr("id", "CAST(10 AS BIGINT) AS size_bytes"), got).collect()}
    for c in range(4):
        left = [i for i in range(60) if i % 4 == c and i in stays]
        assert (rows[c]["left"], rows[c]["known_bytes"], rows[c]["status"]) == (len(left), 10 * len(left), "partial" if left else "unresolved")
    assert rows[9]["status"] == "unresolved" and rows[10]["status"] == "draft"


def square(x0, y0, x1, y1):
    return [[float(x0), float(y0)], [float(x1), float(y0)], [float(x1), float(y1)], [float(x0), float(y1)], [float(x0), float(y0)]]


def shapes(spark, rows, key="region_id"):
    return spark.createDataFrame(rows, f"{key} string, rings array<array<array<double>>>")


def boxes(spark, rows):
    return spark.createDataFrame([(i, *map(float, b)) for i, b in rows], "sheet_id string, x0 double, y0 double, x1 double, y1 double")


def test_gaps_of_any_size_are_found(spark):
    region = shapes(spark, [("a", [square(0, 0, 2, 2)])])
    gap = polygons.uncovered(region, boxes(spark, [("l", (0, 0, 1, 2)), ("r", (1 + 1e-12, 0, 2, 2))])).collect()
    assert len(gap) == 1 and 0 < gap[0]["area"] < 1e-11
    assert polygons.uncovered(region, boxes(spark, [("l", (0, 0, 1, 2)), ("r", (1, -180, 180, 180))])).isEmpty()
    assert polygons.uncovered(region, boxes(spark, [("far", (5, 5, 6, 6)), ("flat", (0, 0, 0, 2))])).agg({"area": "sum"}).first()[0] == 4.0


def test_holes_islands_and_waters(spark):
    island = [square(0, 0, 10, 10), square(2, 2, 8, 8), square(4, 4, 6, 6), square(20, 0, 21, 1)]
    region = shapes(spark, [("a", island)])
    assert polygons.pieces(region).agg({"area": "sum"}).first()[0] == 100 - 36 + 4 + 1
    sea = shapes(spark, [("s", [[[0.0, 0.0], [10.0, 0.0], [0.0, 10.0], [0.0, 0.0]]]), ("t", [square(0, 0, 1, 1)])], "water_id")
    land = polygons.pieces(region, waters=sea).agg({"area": "sum"}).first()[0]
    assert abs(land - (1 + (64 / 2 + 4 / 2))) < 1e-9
    features = spark.createDataFrame([("a", "H2053", 0, 5, "Sea"), ("b", "H2030", 0, 5, "Lake"), ("c", "H2053", 1, 5, "Sea"), ("d", "H2053", 0, 5, None)], "water_id string, class string, area_land long, area_water long, name string")
    features = features.join(shapes(spark, [(k, [square(0, 0, 1, 1)]) for k in "abcd"], "water_id"), "water_id")
    good, bad = polygons.ocean(features)
    assert [r["water_id"] for r in good.collect()] == ["a"] and sorted(r["water_id"] for r in bad.collect()) == ["b", "c", "d"]


def test_broken_rings(spark):
    rows = [("ok", [square(0, 0, 1, 1)]), ("open", [square(0, 0, 1, 1)[:-1]]), ("short", [[[0.0, 0.0], [1.0, 1.0], [0.0, 0.0]]]), ("nan", [[[0.0, float("nan")], *square(0, 0, 1, 1)[1:-1], [0.0, float("nan")]]]), ("none", [])]
    assert {tuple(r) for r in polygons.faults(shapes(spark, rows)).collect()} == {("open", "open ring"), ("short", "short ring"), ("nan", "coordinate is not finite"), ("none", "no rings")}


@pytest.mark.parametrize("seed", range(2))
def test_random_triangles_against_points(spark, seed):
    rng = random.Random(seed)
    ring = [[float(rng.randrange(32)), float(rng.randrange(32))] for _ in range(3)]
    sheets = [(str(i), (x := rng.randrange(28), y := rng.randrange(28), x + rng.randrange(1, 14), y + rng.randrange(1, 14))) for i in range(9)]
    got = polygons.uncovered(shapes(spark, [("a", [[*ring, ring[0]]])]), boxes(spark, sheets)).agg({"area": "sum"}).first()[0] or 0.0

    def inside(x, y):
        sides = [(b[0] - a[0]) * (y - a[1]) - (b[1] - a[1]) * (x - a[0]) for a, b in zip(ring, [*ring[1:], ring[0]], strict=True)]
        return all(s > 0 for s in sides) or all(s < 0 for s in sides)

    n = 8
    points = [((i + 0.5) / n, (j + 0.5) / n) for i in range(32 * n) for j in range(32 * n)]
    want = sum(inside(x, y) and not any(b[0] < x < b[2] and b[1] < y < b[3] for _, b in sheets) for x, y in points) / n**2
    assert abs(got - want) < 3


def test_mixed_scales(spark):
    region = shapes(spark, [("a", [square(0, 0, 4, 4)])])
    rows = [("b1", 50, "1", (0, 0, 4, 2), 10), ("b1", 50, "2", (0, 0, 4, 3), 11), ("f1", 10, "1", (0, 2, 2, 4), 5), ("f2", 10, "1", (1, 3, 2, 4), 5), ("f3", 10, "1", (2, 3, 4, 4), 5), ("off", 10, "1", (4, 0, 9, 9), 5)]
    sheets = spark.createDataFrame([(i, s, e, f"u{i}{e}", n, *map(float, b)) for i, s, e, b, n in rows], "sheet_id string, scale int, edition string, source_url string, size_bytes long, x0 double, y0 double, x1 double, y1 double")
    tries, proposal = polygons.mixed(region, sheets, 30, 3)
    got = {r["scale"]: r for r in tries.collect()}
    assert (got[50]["base_sheets"], got[50]["additions"], got[50]["size_bytes"], got[50]["holes"], got[50]["chosen"]) == (1, 2, 24, 0, True)
    assert got[10]["holes"] > 0 and got[10]["missing_area"] == 16 - 6 and not got[10]["chosen"]
    assert {(r["base"], r["sheet_id"], r["role"]) for r in proposal.where("base = 50").collect()} == {(50, "b1", "base"), (50, "f1", "addition"), (50, "f3", "addition")}
    assert not any(r["chosen"] for r in polygons.mixed(region, sheets, 20)[0].collect())


@pytest.mark.parametrize("seed", range(2))
def test_joined_sheets_and_outermost_waters_cover_the_same(spark, seed):
    """Equal regions, columns of sheets and waters inside others are swept once; areas stay what the plain sweep gives."""
    rng = random.Random(seed)
    sheets = boxes(spark, [(str(i), (x := rng.randrange(8), y := rng.randrange(8), x + rng.randrange(1, 4), y + rng.randrange(1, 4))) for i in range(60)])
    regions = shapes(spark, [(f"r{i}", [square(i % 3, 0, 9, 9), square(4, 4, 5, 6)]) for i in range(6)])
    around = lambda x, y, r: [[[x - r, y], [x, y - r], [x + r, y], [x, y + r], [x - r, y]]]
    waters = [(f"w{i}", around(float(rng.randrange(9)), float(rng.randrange(9)), float(rng.randrange(1, 4)))) for i in range(25)]
    waters = shapes(spark, [*waters, ("twice", waters[0][1]), ("turned", [waters[1][1][0][::-1]]), ("notched", [[[0.0, 0.0], [9.0, 0.0], [1.0, 1.0], [0.0, 9.0], [0.0, 0.0]]])], "water_id")
    joined, outer = polygons.joined(sheets), polygons.outermost(waters)
    assert joined.count() < 40 and outer.count() < 22 and "notched" in {r["water_id"] for r in outer.collect()}
    got = {r["region_id"]: r for r in polygons.coverage(regions, sheets, waters).collect()}
    plain = polygons.pieces(regions, sheets, waters).groupBy("region_id").agg(F.sum("area").alias("wanted"), F.sum(F.when(F.col("sheets") == 0, F.col("area")).otherwise(0.0)).alias("missing"))
    assert len(got) == 6
    for r in plain.collect():
        assert abs(got[r["region_id"]]["wanted_area"] - r["wanted"]) < 1e-9 and abs(got[r["region_id"]]["missing_area"] - r["missing"]) < 1e-9


def test_pruning_writes_little(spark):
    """What fell is written as compressed columns, once; rounds do not write it again."""
    root = pathlib.Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    written = lambda: sum(f.stat().st_size for f in root.rglob("*") if f.is_file())
    items = spark.range(200_000).selectExpr("id", "id % 2 = 0 AS available")
    before = written()
    assert graph.prune(items, spark.range(1, 40_000).selectExpr("id", "id - 1 AS need").where("id % 4 = 2")).count() == 90_000
    assert written() - before < 4_000_000


def test_very_many_equal_boxes_do_not_meet_pair_by_pair(spark, tmp_path):
    spark.range(200_000).selectExpr("id AS p_partkey", "5 AS p_size").selectExpr("p_partkey * 40 AS p_partkey", "p_size").write.parquet(f"{tmp_path}/part.parquet")
    spark.range(200_000).selectExpr("id * 50 AS s_suppkey", "CAST(0 AS INT) AS s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(3).selectExpr("id * 50 + 6 AS s_suppkey", "CAST(0 AS INT) AS s_nationkey").write.mode("append").parquet(f"{tmp_path}/supplier.parquet")
    got = registry.QUERIES["spatial_box_join"](spark, str(tmp_path)).where("region_id % 50 = 6").collect()
    assert {(r["sheets"], r["area"]) for r in got} == {(200_000, 800_000)} and len(got) == 3


def test_rounds_of_levels_and_works_send_no_broadcast(spark, monkeypatch):
    from lodestack.operators import ranking

    edges, works = spark.createDataFrame([(2, 1), (3, 2), (4, 3)], "src int, dst int"), spark.createDataFrame([(1, ["a"]), (2, ["a", "b"]), (3, ["b"])], "place int, keys array<string>")
    kind, seen = type(edges), []
    before = kind.checkpoint
    monkeypatch.setattr(kind, "checkpoint", lambda df, *rest: (seen.append(df._jdf.queryExecution().executedPlan().toString()), before(df, *rest))[1])
    assert sorted(r["level"] for r in order.levels(edges)[0].collect()) == [0, 1, 2, 3]
    assert sorted(r["place"] for r in ranking.first_works(works, "place", "keys").collect()) == [1, 3]
    assert len(seen) > 6 and not any("Broadcast" in p for p in seen)
