from lodestack.functions import markup


def test_outline_links_tables_and_cleaning(spark):
    page = '<h1 id=a>One</h1><script>"<h2>no</h2>"</script><h3 id=a>Deep <b>x</b></h3><h2>Two</h2><a href="u?x=1&amp;y">Go  on</a><table><tr><td>1<td>2<tr><th>3</table><img src="http://x/i.png" onload=e()><a href="java script:x">j</a><p onclick=x>T &lt; 5'
    df = spark.createDataFrame([(1, page), (2, None), (3, "")], "id int, html string")
    got = [tuple(r) for r in markup.outline(df, "id", "html").orderBy("position").collect()]
    assert got == [(1, 0, 1, "One", "a", None), (1, 1, 3, "Deep x", "a-2", 0), (1, 2, 2, "Two", None, 0)]
    row = df.where("id = 1").select(markup.links("html").alias("l"), markup.table_rows("html").alias("t"), markup.sanitized("html").alias("s")).first()
    assert [tuple(x) for x in row["l"]][0] == ("u?x=1&y", "Go on")
    assert [x["cells"] for x in row["t"]] == [["1", "2"], ["3"]]
    clean = row["s"]["html"]
    assert "script" not in clean.replace("java script", "") and "onload" not in clean and "onclick" not in clean and "T &lt; 5" in clean
    assert "remote image" in row["s"]["errors"] and "dropped script" in row["s"]["errors"]
    assert {tuple(r) for r in markup.dependencies(df, "id", "html").collect()} >= {(1, "http://x/i.png", True)}
