"""Topic hierarchies, dependency graphs and chains: region, nation, customer and supplier form the topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import graph, order, ranking
from ..operators.crawl import crawl
from ..session import settled
from .registry import query, statement, table

_S = "[[STRING||VARCHAR]]"
_EDGE = """edge(child, parent) AS (
  SELECT concat('n', CAST(n_nationkey AS VARCHAR)), concat('r', CAST(n_regionkey AS VARCHAR)) FROM nation
  UNION ALL SELECT concat('c', CAST(c_custkey AS VARCHAR)), concat('n', CAST(c_nationkey AS VARCHAR)) FROM customer
  UNION ALL SELECT concat('c', CAST(c_custkey AS VARCHAR)), concat('m', c_mktsegment) FROM customer
  UNION ALL SELECT concat('s', CAST(s_suppkey AS VARCHAR)), concat('n', CAST(s_nationkey AS VARCHAR)) FROM supplier)"""


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, dst): each node and its parents."""
    key = lambda letter, column: F.concat(F.lit(letter), F.col(column).cast("string"))
    nation, customer, supplier = (table(spark, sf_dir, t) for t in ("nation", "customer", "supplier"))
    pairs = [(nation, key("n", "n_nationkey"), key("r", "n_regionkey")), (customer, key("c", "c_custkey"), key("n", "c_nationkey")), (customer, key("c", "c_custkey"), F.concat(F.lit("m"), "c_mktsegment")), (supplier, key("s", "s_suppkey"), key("n", "s_nationkey"))]
    parts = [df.select(a.alias("src"), b.alias("dst")) for df, a, b in pairs]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query(f"""WITH RECURSIVE {_EDGE}, up(node, topic) AS (
  SELECT DISTINCT child, parent FROM edge WHERE child LIKE 'c%' OR child LIKE 's%'
  UNION ALL SELECT up.node, edge.parent FROM up JOIN edge ON edge.child = up.topic)
SELECT topic, count(DISTINCT node) AS sources, count(DISTINCT CASE WHEN node LIKE 's%' THEN node END) AS readers, count(DISTINCT node) = count(DISTINCT CASE WHEN node LIKE 's%' THEN node END) AS reader_only FROM up GROUP BY topic""")
def topic_closure_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    up = graph.closure(_edges(spark, sf_dir)).where("src LIKE 'c%' OR src LIKE 's%'")
    readers = F.count_if(F.col("src").startswith("s"))  # pairs of a closure are distinct
    return up.groupBy(F.col("dst").alias("topic")).agg(F.count("*").alias("sources"), readers.alias("readers"), (F.count("*") == readers).alias("reader_only"))


@query(f"""WITH RECURSIVE {_EDGE}, down(node) AS (
  SELECT CAST('r0' AS VARCHAR) UNION ALL SELECT edge.child FROM down JOIN edge ON edge.parent = down.node)
SELECT c_nationkey AS nation, count(DISTINCT c_custkey) AS customers, count(DISTINCT CASE WHEN d.node IS NOT NULL THEN c_custkey END) AS reached, count(DISTINCT CASE WHEN d.node IS NULL AND o_orderkey IS NOT NULL THEN c_custkey END) AS unreached_with_orders
FROM customer LEFT JOIN (SELECT DISTINCT node FROM down) d ON d.node = concat('c', CAST(c_custkey AS VARCHAR)) LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def entrance_reachability(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = _edges(spark, sf_dir)
    found = crawl(spark.createDataFrame([("r0",)], "page string"), edges.select(F.col("dst").alias("page"), F.col("src").alias("target")))
    buyers = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("buys", F.lit(True))
    own = table(spark, sf_dir, "customer").withColumn("page", F.concat(F.lit("c"), F.col("c_custkey").cast("string")))
    own = own.join(found, "page", "left").join(buyers, "c_custkey", "left").groupBy("c_nationkey", "c_custkey").agg(F.max(F.col("depth").isNotNull()).alias("reached"), F.max(F.coalesce("buys", F.lit(False))).alias("buys"))
    return own.groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("customers"), F.count_if("reached").alias("reached"), F.count_if(~F.col("reached") & F.col("buys")).alias("unreached_with_orders"))


statement("topological_levels", """WITH RECURSIVE dep(id, need) AS (SELECT n_nationkey, CAST(floor(n_nationkey / 2) AS INT) FROM {nation} WHERE n_nationkey > 0 UNION ALL SELECT n_nationkey, n_nationkey - 3 FROM {nation} WHERE n_nationkey >= 3),
walk(id, level) AS (SELECT n_nationkey, 0 FROM {nation} WHERE n_nationkey = 0 UNION ALL SELECT dep.id, walk.level + 1 FROM walk JOIN dep ON dep.need = walk.id)
SELECT id, CAST(max(level) AS INT) AS level FROM walk GROUP BY id""")

@query("""WITH h AS (SELECT doc_id, lang, sha256(text) AS hash FROM documents),
pair AS (SELECT a.doc_id, b.doc_id AS earlier, b.lang FROM h a JOIN h b ON a.hash IS NOT DISTINCT FROM b.hash AND b.doc_id <= a.doc_id)
SELECT doc_id, min(earlier) AS canonical, count(*) - 1 AS steps, bool_or(lang = 'de') AS legacy FROM pair GROUP BY doc_id""")
def canonical_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each copy is chained to the one before it, so its way to the end passes all copies before it.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.sha2("text", 256).alias("hash"))
    before = Window.partitionBy("hash").orderBy(F.asc_nulls_last("doc_id")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    way = docs.select("doc_id", F.min("doc_id").over(before).alias("canonical"), (F.count("*").over(before) - 1).alias("steps"), F.max(F.col("lang") == "de").over(before).alias("legacy"))
    return way.groupBy("doc_id").agg(F.min("canonical").alias("canonical"), F.max("steps").alias("steps"), F.max("legacy").alias("legacy"))


statement("breadcrumbs", "SELECT s_suppkey, concat_ws(' > ', r_name, n_name, s_name) AS trail FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey JOIN {region} ON r_regionkey = n_regionkey")

@query("""WITH RECURSIVE node(id, parent, title) AS (
  SELECT concat('r', CAST(r_regionkey AS VARCHAR)), CAST(NULL AS VARCHAR), r_name FROM region
  UNION ALL SELECT concat('n', CAST(n_nationkey AS VARCHAR)), concat('r', CAST(n_regionkey AS VARCHAR)), n_name FROM nation
  UNION ALL SELECT concat('s', CAST(s_suppkey AS VARCHAR)), concat('n', CAST(s_nationkey AS VARCHAR)), s_name FROM supplier),
walk(id, depth, path) AS (SELECT id, 0, title FROM node WHERE parent IS NULL UNION ALL SELECT node.id, walk.depth + 1, concat(walk.path, '/', node.title) FROM walk JOIN node ON node.parent = walk.id)
SELECT id, CAST(depth AS INT) AS depth, path, CAST(row_number() OVER (ORDER BY path, id) AS BIGINT) AS position FROM walk""")
def section_tree_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    region, nation, supplier = (table(spark, sf_dir, t) for t in ("region", "nation", "supplier"))
    node = lambda letter, own, above, title: (F.concat(F.lit(letter), F.col(own).cast("string")).alias("id"), above.cast("string").alias("parent"), F.col(title).alias("title"))
    nodes = region.select(*node("r", "r_regionkey", F.lit(None), "r_name"))
    nodes = nodes.union(nation.select(*node("n", "n_nationkey", F.concat(F.lit("r"), F.col("n_regionkey").cast("string")), "n_name")))
    nodes = nodes.union(supplier.select(*node("s", "s_suppkey", F.concat(F.lit("n"), F.col("s_nationkey").cast("string")), "s_name")))
    return ranking.numbered(graph.tree_paths(nodes), [F.asc("path"), F.asc("id")])


statement("ready_tasks", """WITH task AS (SELECT o_orderkey AS id, o_orderstatus = 'F' AS done FROM {orders}),
dep AS (SELECT a.id, b.id AS need FROM task a JOIN task b ON b.id = a.id - 1 UNION ALL SELECT a.id, b.id FROM task a JOIN task b ON b.id = a.id - 7)
SELECT t.id, count(d.need) AS needs, count(CASE WHEN n.done THEN 1 END) AS met, NOT t.done AND count(d.need) = count(CASE WHEN n.done THEN 1 END) AS ready
FROM task t LEFT JOIN dep d ON d.id = t.id LEFT JOIN task n ON n.id = d.need GROUP BY t.id, t.done""")

@query("""WITH leaf AS (SELECT c_custkey, n_nationkey, n_regionkey, row_number() OVER (ORDER BY n_regionkey, n_nationkey, c_custkey) AS pos FROM customer JOIN nation ON n_nationkey = c_nationkey),
tree AS (SELECT n_regionkey, min(pos) * 2 - 1 AS lft, max(pos) * 2 + 2 AS rght FROM leaf GROUP BY 1)
SELECT t.n_regionkey, count(c_custkey) AS found, CAST((max(rght) - max(lft) - 1) // 2 AS BIGINT) AS expected FROM tree t JOIN leaf l ON l.pos * 2 > t.lft AND l.pos * 2 + 1 < t.rght GROUP BY 1""")
def nested_set_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves inside each region's interval. A region has one interval and leaves one place each, so a leaf is looked
    up among the intervals' bounds, one row a region, which are sent to all tasks."""
    leaf = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).select("c_custkey", "n_nationkey", "n_regionkey")
    leaf = ranking.numbered(leaf, [F.asc("n_regionkey"), F.asc("n_nationkey"), F.asc("c_custkey")], "pos")
    tree = leaf.groupBy("n_regionkey").agg((F.min("pos") * 2 - 1).alias("lft"), (F.max("pos") * 2 + 2).alias("rght"))
    inside = leaf.select("c_custkey", "pos").join(F.broadcast(tree), (F.col("pos") * 2 > F.col("lft")) & (F.col("pos") * 2 + 1 < F.col("rght")))  # a row a region
    return inside.groupBy("n_regionkey").agg(F.count("c_custkey").alias("found"), F.max(F.expr("(rght - lft - 1) DIV 2")).alias("expected"))


_PRUNE = """WITH item AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey, l_linenumber, p_size > 3 AS available FROM lineitem JOIN part ON p_partkey = l_partkey),
way AS (SELECT id, l_linenumber, bool_and(available) OVER w AS whole, dense_rank() OVER w AS n FROM item WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber))
SELECT id FROM way WHERE whole AND n = l_linenumber"""


@query(_PRUNE)
def dependency_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line of an order needs the one before it. The SQL states what that comes to: all before it are there."""
    member = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), "l_linenumber", "l_partkey")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), (F.col("p_size") > 3).alias("available"))
    return graph.prune(member.join(part, "l_partkey").select("id", "available"), member.where("l_linenumber > 1").select("id", (F.col("id") - 1).alias("need"))).select("id")


@query("""WITH RECURSIVE dep(id, need) AS (SELECT p_partkey, p_partkey // 2 FROM part WHERE p_partkey > 0 UNION SELECT p_partkey, p_partkey // (3 + p_size % 5) FROM part WHERE p_partkey > 0),
walk(id, level) AS (SELECT CAST(0 AS BIGINT), 0 UNION SELECT dep.id, walk.level + 1 FROM walk JOIN dep ON dep.need = walk.id)
SELECT id, CAST(max(level) AS INT) AS level FROM walk GROUP BY id""")
def dependency_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part needs two others; its level is its longest way down."""
    part = table(spark, sf_dir, "part").where("p_partkey > 0")
    edges = part.select(F.col("p_partkey").alias("src"), F.expr("p_partkey DIV 2").alias("dst")).union(part.select("p_partkey", F.expr("p_partkey DIV (3 + p_size % 5)")))
    return order.levels(edges)[0].withColumnRenamed("node", "id")


_LOOPS = """WITH RECURSIVE dep(id, need) AS (SELECT p_partkey, p_partkey - 1 FROM part WHERE p_partkey % 4 > 0 UNION ALL SELECT p_partkey, p_partkey + 3 FROM part WHERE p_partkey % 4 = 0 AND p_size % 3 = 0 AND p_partkey + 3 IN (SELECT p_partkey FROM part)
  UNION ALL SELECT p_partkey, p_partkey // 16 FROM part WHERE p_partkey % 4 = 3 AND p_partkey >= 16),
ring AS (SELECT d.id + k AS id FROM dep d, range(4) r(k) WHERE d.need = d.id + 3),
bad(id) AS (SELECT id FROM ring UNION SELECT dep.id FROM bad JOIN dep ON dep.need = bad.id),
nxt AS (SELECT dep.id, min(dep.need) AS need FROM dep WHERE dep.id IN (SELECT id FROM bad) AND dep.need IN (SELECT id FROM bad) GROUP BY dep.id),
walk(id, spot, n) AS (SELECT id, need, 1 FROM nxt UNION ALL SELECT walk.id, nxt.need, n + 1 FROM walk JOIN nxt ON nxt.id = walk.spot WHERE n < 80),
into_ AS (SELECT id, min(spot) AS cycle FROM walk WHERE n >= 60 GROUP BY id),
way AS (SELECT id AS cycle, spot, n FROM walk WHERE id IN (SELECT cycle FROM into_)),
len AS (SELECT cycle, min(n) AS length FROM way WHERE spot = cycle GROUP BY cycle)
SELECT len.cycle, CAST(length AS BIGINT) AS length, concat_ws(' ', CAST(len.cycle AS VARCHAR), string_agg(CASE WHEN way.n < length THEN CAST(way.spot AS VARCHAR) END, ' ' ORDER BY way.n)) AS nodes, (SELECT count(*) FROM into_ i WHERE i.cycle = len.cycle) AS kept_back
FROM len JOIN way ON way.cycle = len.cycle AND way.n <= length GROUP BY len.cycle, length"""


@query(_LOOPS)
def cycle_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts in blocks of four need the one before; some blocks close to a ring, and their last parts need older blocks."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("p"), "p_size")
    closing = part.where("p % 4 = 0 AND p_size % 3 = 0").select(F.col("p").alias("src"), (F.col("p") + 3).alias("dst"))
    edges = part.where("p % 4 > 0").select(F.col("p").alias("src"), (F.col("p") - 1).alias("dst")).union(closing.join(part.select(F.col("p").alias("dst")), "dst").select("src", "dst"))
    edges = edges.union(part.where("p % 4 = 3 AND p >= 16").select("p", F.expr("p DIV 16")))
    witness, back = order.cycles(order.levels(edges)[1])
    counts = back.groupBy("cycle").agg(F.count("*").alias("kept_back"))
    return witness.join(counts, "cycle").select("cycle", "length", F.array_join("nodes", " ").alias("nodes"), "kept_back")


_DUPLICATES = """WITH RECURSIVE o AS (SELECT o_orderkey AS id, o_orderstatus AS s, o_orderpriority AS p, o_orderdate AS day, lag(o_orderkey) OVER w AS before, lead(o_orderkey) OVER w AS after, lead(o_orderstatus) OVER w AS after_s, o_custkey AS c FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
link AS (SELECT id, before AS target FROM o WHERE s <> 'F' AND before IS NOT NULL UNION SELECT id, id - 1 FROM o WHERE p = '1-URGENT' AND id % 3 = 0 AND id > 0 UNION SELECT id, after FROM o WHERE s = 'F' AND c % 40 = 0 AND after_s <> 'F'),
t AS (SELECT id, min(target) AS target, count(*) AS n FROM link GROUP BY id),
walk(id, spot, n) AS (SELECT id, id, 0 FROM o UNION ALL SELECT walk.id, t.target, walk.n + 1 FROM walk JOIN t ON t.id = walk.spot WHERE t.n = 1 AND walk.n < 200),
fin AS (SELECT w.id, w.spot, w.n, CASE WHEN w.n >= 200 THEN 'cycle' WHEN t.n > 1 THEN 'several targets' END AS problem FROM (SELECT id, max(n) AS n, arg_max(spot, n) AS spot FROM walk GROUP BY id) w LEFT JOIN t ON t.id = w.spot)"""


def _order_links(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders that are not settled repeat their customer's order before; some urgent ones name another too, and some
    settled ones name the next, which makes rings."""
    by = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus", "o_orderpriority", "o_orderdate", "o_custkey", F.lag("o_orderkey").over(by).alias("before"), F.lead("o_orderkey").over(by).alias("after"), F.lead("o_orderstatus").over(by).alias("after_s"))
    links = o.where("o_orderstatus <> 'F' AND before IS NOT NULL").select("id", F.col("before").alias("target"))
    links = links.union(o.where("o_orderpriority = '1-URGENT' AND id % 3 = 0 AND id > 0").select("id", F.col("id") - 1))
    return links.union(o.where("o_orderstatus = 'F' AND o_custkey % 40 = 0 AND after_s <> 'F'").select("id", "after")), o


@query(f"""{_DUPLICATES} SELECT id, CASE WHEN problem IS NULL THEN spot END AS canonical, CASE WHEN problem IS NULL THEN CAST(n AS BIGINT) END AS steps, problem FROM fin""")
def canonical_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links, orders = _order_links(spark, sf_dir)
    return order.canonical(links, orders)


@query(f"""{_DUPLICATES} SELECT spot AS canonical, count(*) AS aliases, CAST(max(n) AS BIGINT) AS longest, bool_or(year(day) < 1996) AS legacy FROM fin JOIN o ON o.id = fin.id WHERE problem IS NULL GROUP BY spot""")
def canonical_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A canonical order is legacy if one that leads to it is."""
    links, orders = _order_links(spark, sf_dir)
    found = order.canonical(links, orders).where("problem IS NULL").join(orders.select("id", (F.year("o_orderdate") < 1996).alias("old")), "id")
    return found.groupBy("canonical").agg(F.count("*").alias("aliases"), F.max("steps").alias("longest"), F.max("old").alias("legacy"))


@query("""WITH RECURSIVE node AS (SELECT p_partkey AS id, p_name AS title FROM part WHERE p_size % 7 > 0),
up AS (SELECT a.id, coalesce(b.id, c.id) AS parent, a.title FROM node a LEFT JOIN node b ON b.id = a.id // 2 AND a.id > 0 LEFT JOIN node c ON c.id = a.id // 3 AND a.id > 0),
walk(id, spot, depth, trail) AS (SELECT id, parent, 0, title FROM up UNION ALL SELECT walk.id, up.parent, depth + 1, concat(up.title, ' > ', trail) FROM walk JOIN up ON up.id = walk.spot)
SELECT w.id, CAST(w.depth AS BIGINT) AS depth, w.trail FROM walk w WHERE w.spot IS NULL""")
def canonical_breadcrumbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts have two parents each and some are hidden; the trail goes over the first visible parent, by position."""
    part = table(spark, sf_dir, "part")
    nodes = part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), (F.col("p_size") % 7 > 0).alias("visible"))
    above = part.where("p_partkey > 0").select(F.col("p_partkey").alias("id"), F.posexplode(F.array(F.expr("p_partkey DIV 2"), F.expr("p_partkey DIV 3"))).alias("position", "parent"))
    return order.breadcrumbs(nodes, above).select("id", "depth", "trail")


@query("""WITH line AS (SELECT l_orderkey, bool_and(p_size % 17 > 0) AS present, CAST(sum(floor(l_extendedprice)) AS BIGINT) AS bytes FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey),
o AS (SELECT o_orderkey, o_custkey, o_totalprice < 400000 AND NOT (o_orderpriority = '1-URGENT' AND coalesce(bool_or(NOT present), false)) AS good FROM orders LEFT JOIN line ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_custkey, o_totalprice, o_orderpriority),
c AS (SELECT c_custkey, c_nationkey, c_acctbal > -900 AND NOT (c_mktsegment = 'BUILDING' AND coalesce(bool_or(NOT good), false)) AS good FROM customer LEFT JOIN o ON o_custkey = c_custkey GROUP BY c_custkey, c_nationkey, c_acctbal, c_mktsegment),
m AS (SELECT c_nationkey, bytes, present AND o.good AND c.good AS stays FROM line JOIN o ON o_orderkey = l_orderkey JOIN c ON c_custkey = o_custkey)
SELECT c_nationkey AS collection, count(*) AS members, count(CASE WHEN stays THEN 1 END) AS "left", CAST(coalesce(sum(CASE WHEN stays THEN bytes END), 0) AS BIGINT) AS known_bytes,
  CASE WHEN count(CASE WHEN stays THEN 1 END) = count(*) THEN 'ready' WHEN count(CASE WHEN stays THEN 1 END) > 0 THEN 'partial' ELSE 'unresolved' END AS status FROM m GROUP BY 1""")
def available_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines are members of orders and orders of customers; urgent orders and builders' accounts are good only whole."""
    line, orders, customer, part = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "part"))
    # Numbers as ids: lines are multiples of three, orders one more, accounts two more.
    key = lambda kind, column: (F.col(column).cast("long") * 3 + kind)
    line = line.join(part.select(F.col("p_partkey").alias("l_partkey"), "p_size"), "l_partkey")
    lines = line.groupBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").agg(F.min(F.col("p_size") % 17 > 0).alias("present"), F.sum(F.floor("l_extendedprice")).alias("size_bytes"))
    lines = settled(lines.select((F.monotonically_increasing_id() * 3).alias("id"), "l_orderkey", "present", "size_bytes"), "lines")
    packages = orders.select(key(1, "o_orderkey").alias("id"), (F.col("o_totalprice") < 400000).alias("present"), (F.col("o_orderpriority") == "1-URGENT").alias("whole"))
    accounts = customer.select(key(2, "c_custkey").alias("id"), (F.col("c_acctbal") > -900).alias("present"), (F.col("c_mktsegment") == "BUILDING").alias("whole"))
    members = lines.select("id", key(1, "l_orderkey").alias("package")).union(orders.select(key(1, "o_orderkey"), key(2, "o_custkey")))
    stays = graph.available(lines.select("id", "present", F.lit(False).alias("whole")).union(packages).union(accounts), members)
    owner = orders.join(customer, F.col("c_custkey") == F.col("o_custkey")).select(F.col("o_orderkey").alias("l_orderkey"), F.col("c_nationkey").alias("collection"))
    chosen = lines.join(owner, "l_orderkey").select("collection", "id", F.lit("ready").alias("status"))
    return graph.downgraded(chosen, lines, stays)
