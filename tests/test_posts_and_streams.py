import datetime

from pyspark.sql import functions as F

from lodestack.operators import crawl, posts, ranking
from lodestack.streaming import windows


def test_classification_precedence(spark):
    rules = posts.Rules(deny_tags=("firebase",), allow_tags=("python", "sql"), legacy_tags=("python-2.7",), durable_ids=(7,), versions=(posts.Versions("python", ("python",), r"python\s+(\d+(?:\.\d+)*)", (2,)),))
    rows = [
        (1, 1, 5, 1, "<python>", "How to sort"), (2, 1, 0, 1, "<python>", "x"), (3, 1, 999, 3, "<python><firebase>", "x"), (4, 1, 3, 1, "<python><python-2.7>", "x"),
        (5, 1, 3, 1, "<python>", "Python 2.7 and Python 3.4"), (6, 1, 3, 1, "<python>", "python 2.6 print"), (7, 1, 3, 1, "<c>", "x"), (8, 1, 3, 1, "<c>", "x"), (9, 1, 3, 1, "<sql>", "An old query"), (10, 2, 3, 1, None, None),
    ]
    df = posts.classify(spark.createDataFrame(rows, "id int, type int, score int, answers int, tags string, title string"), rules)
    got = {r["id"]: r["bucket"] for r in df.collect()}
    assert got == {1: "durable", 2: None, 3: None, 4: "legacy", 5: "review", 6: "legacy", 7: "durable", 8: None, 9: "review", 10: None}
    assert {r["id"] for r in posts.best(df, 1).collect()} == {1, 4, 5}


def test_answers_and_comments(spark):
    questions = spark.createDataFrame([(10, 20), (11, None)], "id int, accepted_id int")
    replies = spark.createDataFrame([(20, 10, 0), (21, 10, 9), (22, 10, 9), (23, 10, 3), (24, 10, -1), (30, 11, 1)], "id int, parent_id int, score int")
    got = [tuple(r) for r in posts.answers(questions, replies).orderBy("question_id", "rank").collect()]
    assert got == [(10, 20, True, 1), (10, 21, False, 2), (10, 22, False, 3), (11, 30, False, 1)]
    texts = ["Thanks!", "+1", "This is incorrect since 3.2", "nice", "a long comment that has more than six words in it", "not ok"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(posts.substantive("t")).collect()] == [False, False, True, False, True, False]
    chance = spark.range(1).select(ranking.encounter(F.lit(10), F.lit(2), 3).alias("p"), ranking.encounter(F.lit(2), F.lit(1), 9).alias("q")).first()
    assert abs(chance["p"] - (1 - 8 * 7 * 6 / (10 * 9 * 8))) < 1e-12 and chance["q"] == 1.0


def test_canonical_and_crawl(spark):
    links = spark.createDataFrame([(11, 10), (12, 11), (13, 14), (14, 13), (15, 10), (15, 11), (16, 15)], "id int, target int")
    nodes = spark.createDataFrame([(i,) for i in range(10, 18)], "id int")
    got = {r["id"]: (r["canonical"], r["problem"]) for r in posts.canonical(links, nodes).collect()}
    assert got[12] == (10, None) and got[17] == (17, None) and got[13][1] == "cycle or too long" and got[16][1] == "several targets"
    pages = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y")], "page string, target string")
    reached = crawl.crawl(spark.createDataFrame([("a",)], "page string"), pages)
    assert {tuple(r) for r in reached.collect()} == {("a", 0), ("b", 1), ("c", 2)}


def test_streams_equal_their_batches(spark, tmp_path):
    t0 = datetime.datetime(2024, 1, 1)
    rows = [(i, t0 + datetime.timedelta(minutes=m), u) for i, (m, u) in enumerate([(0, 1), (10, 1), (50, 1), (0, 2), (29, 2), (59, 2)])] + [(0, t0, 1)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long").write.parquet(str(tmp_path / "ev.parquet"))
    stream = windows.stream_of(spark, str(tmp_path / "ev.parquet"))
    run = windows.sessions(stream).writeStream.outputMode("complete").format("memory").queryName("sessions_test").trigger(availableNow=True).start()
    run.awaitTermination()
    assert sorted((r["user_id"], r["n"]) for r in spark.table("sessions_test").collect()) == [(1, 1), (1, 3), (2, 3)]
    windows.append_batches(windows.once(stream), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).agg(F.count("*"), F.count_distinct("event_id")).first()[:] == (6, 6)
