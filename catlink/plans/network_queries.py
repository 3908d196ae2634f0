"""Registered network and information queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from catlink.operators import networks as N
from catlink.operators.components import connected_components
from catlink.plans.registry import query
from catlink.plans.standins import MEMBERSHIP, frame, table

M = f"m AS ({MEMBERSHIP})"
#: A sparse network over whole tables: customers and suppliers with their nations, nations with their regions and with each other there, so it has cycles.
SPARSE = (
    "SELECT 'c' || CAST(c_custkey AS STRING) AS src, 'n' || CAST(c_nationkey AS STRING) AS dst FROM customer UNION SELECT 's' || CAST(s_suppkey AS STRING), 'n' || CAST(s_nationkey AS STRING) FROM supplier "
    "UNION SELECT 'n' || CAST(n_nationkey AS STRING), 'r' || CAST(n_regionkey AS STRING) FROM nation "
    "UNION SELECT 'n' || CAST(a.n_nationkey AS STRING), 'n' || CAST(b.n_nationkey AS STRING) FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey"
)
E = f"e AS MATERIALIZED ({SPARSE.replace('AS STRING', 'AS VARCHAR')}), s AS MATERIALIZED (SELECT src, dst FROM e UNION SELECT dst, src FROM e)"


def members(spark, d):
    return frame(spark, d, MEMBERSHIP)


def sparse(spark, d):
    return frame(spark, d, SPARSE)


@query(f"WITH {M} SELECT item, member FROM m")
def graph_membership(spark, d):
    li = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.concat_ws(",", F.collect_set(F.col("l_orderkey").cast("string"))).alias("items"))
    return N.membership_of(li, "l_partkey", "items").select(F.col("item").cast("long").alias("item"), "member")


@query(f"WITH {M} SELECT a.member AS src, b.member AS dst, count(*) AS weight FROM m a JOIN m b ON a.item = b.item AND a.member < b.member GROUP BY ALL")
def graph_costar_edges(spark, d):
    return N.shared_edges(members(spark, d), "member", "item")


@query("WITH g AS (SELECT DISTINCT o_orderdate::DATE AS day, o_custkey AS c FROM orders), p AS (SELECT a.c AS src, b.c AS dst, count(*) AS weight FROM g a JOIN g b ON a.day = b.day AND a.c < b.c GROUP BY ALL) SELECT * FROM p UNION ALL SELECT dst, src, weight FROM p")
def graph_weighted_edges(spark, d):
    g = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("item"), F.col("o_custkey").alias("member"))
    return N.shared_edges(g, "member", "item", symmetric=True)


@query(f"WITH {M} SELECT count(DISTINCT item) AS items, count(DISTINCT member) AS members, count(*) AS edges FROM m")
def graph_bipartite_counts(spark, d):
    return members(spark, d).agg(F.count_distinct("item").alias("items"), F.count_distinct("member").alias("members"), F.count("*").alias("edges"))


DEG = f"{E}, d AS (SELECT src AS node, count(*) AS degree FROM s GROUP BY src)"


@query(f"WITH {DEG} SELECT count(*) AS nodes, min(degree) AS low, max(degree) AS high, avg(degree) AS mean, sum(degree)::BIGINT AS total, stddev_pop(degree) AS std FROM d")
def graph_degree_stats(spark, d):
    return N.degrees(sparse(spark, d)).agg(F.count("*").alias("nodes"), F.min("degree").alias("low"), F.max("degree").alias("high"), F.avg("degree").alias("mean"), F.sum("degree").alias("total"), F.stddev_pop("degree").alias("std"))


@query(f"""WITH {DEG}, b AS (SELECT min(degree)::DOUBLE AS lo, max(degree)::DOUBLE AS hi, count(*) AS total FROM d), h AS (SELECT least(19, floor((degree - lo) / ((hi - lo) / 20)))::INTEGER AS bin, count(*) AS n FROM d, b GROUP BY 1)
SELECT bin, lo + bin * ((hi - lo) / 20) AS low, lo + (bin + 1) * ((hi - lo) / 20) AS high, n, 100.0::DOUBLE * n / total AS percent FROM h, b""")
def graph_degree_histogram(spark, d):
    return N.histogram(N.degrees(sparse(spark, d)), "degree", 20)


@query(f"""WITH {DEG}, q AS (SELECT quantile_cont(degree, 0.25)::DOUBLE AS q1, quantile_cont(degree, 0.5)::DOUBLE AS median, quantile_cont(degree, 0.75)::DOUBLE AS q3 FROM d), i AS (SELECT degree::DOUBLE AS x, degree BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM d, q)
SELECT q1, median, q3, (SELECT min(x) FROM i WHERE inside) AS low_whisker, (SELECT max(x) FROM i WHERE inside) AS high_whisker, (SELECT count(*) FROM i WHERE NOT inside) AS fliers FROM q""")
def graph_degree_boxplot(spark, d):
    return N.box_plot(N.degrees(sparse(spark, d)), "degree")


@query("""WITH q AS (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS median, quantile_cont(o_totalprice, 0.75) AS q3 FROM orders)
SELECT q1, median, q3, min(o_totalprice) FILTER (o_totalprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS low_whisker, max(o_totalprice) FILTER (o_totalprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS high_whisker, count(*) FILTER (NOT o_totalprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS fliers FROM orders, q GROUP BY ALL""")
def value_boxplot(spark, d):
    return N.box_plot(table(spark, d, "orders"), "o_totalprice")


START = "(SELECT min(src) FROM s)"
BFS = f"WITH RECURSIVE {E}, r(node, distance) AS (SELECT {START}, 0::BIGINT UNION SELECT s.dst, distance + 1 FROM r JOIN s ON r.node = s.src WHERE distance < 12), b AS (SELECT node, min(distance) AS distance FROM r GROUP BY node)"


def first_node(spark, d):
    return N.both_ways(sparse(spark, d)).agg(F.min("src")).first()[0]


@query(f"{BFS} SELECT node, distance, (SELECT min(src) FROM s JOIN b p ON s.src = p.node AND p.distance = b.distance - 1 WHERE s.dst = b.node) AS parent FROM b")
def graph_bfs_distances(spark, d):
    return N.breadth_first(sparse(spark, d), first_node(spark, d))


@query(f"""{BFS}, t AS (SELECT node, distance FROM b ORDER BY distance DESC, node LIMIT 1),
p(node, step) AS (SELECT node, distance FROM t UNION SELECT (SELECT min(src) FROM s JOIN b q ON s.src = q.node AND q.distance = p.step - 1 WHERE s.dst = p.node), step - 1 FROM p WHERE step > 0)
SELECT step, node FROM p""")
def graph_shortest_path(spark, d):
    """The path itself: between two customers of different nations it is the only shortest one."""
    e, start = sparse(spark, d), first_node(spark, d)
    far = N.breadth_first(e, start).orderBy(F.desc("distance"), "node").first()
    return N.shortest_path(e, None, start, far["node"]).select(F.col("step").cast("long").alias("step"), "node")


@query(f"{BFS} SELECT node, distance AS depth FROM b")
def graph_reach_depths(spark, d):
    return N.depth_first_tree(sparse(spark, d), first_node(spark, d)).select("node", "depth")


@query()
def graph_dfs_reachability_tree(spark, d):
    return N.depth_first_tree(sparse(spark, d), first_node(spark, d))


COMP = f"WITH RECURSIVE {E}, n AS (SELECT DISTINCT src AS node FROM s), r(a, b) AS (SELECT node, node FROM n UNION SELECT r.a, s.dst FROM r JOIN s ON r.b = s.src), c AS (SELECT a AS node, min(b) AS component FROM r GROUP BY a)"


@query(f"{COMP} SELECT node, component FROM c")
def graph_components(spark, d):
    return connected_components(sparse(spark, d))


@query(f"{COMP} SELECT size, count(*) AS n FROM (SELECT component, count(*) AS size FROM c GROUP BY component) GROUP BY size")
def graph_component_sizes(spark, d):
    sizes = connected_components(sparse(spark, d)).groupBy("component").agg(F.count("*").alias("size"))
    return sizes.groupBy("size").agg(F.count("*").alias("n"))


def _rank_sql(rounds: int) -> str:
    step = "".join(f", p{i} AS MATERIALIZED (SELECT node, 0.15 / k + 0.85 * (coalesce(got, 0) + (1 - (SELECT sum(r / d) FROM p{i - 1} JOIN s ON s.src = p{i - 1}.node JOIN o USING (src))) / k) AS r FROM n CROSS JOIN z LEFT JOIN (SELECT s.dst AS node, sum(r / d) AS got FROM p{i - 1} JOIN s ON s.src = p{i - 1}.node JOIN o USING (src) GROUP BY s.dst) USING (node))" for i in range(1, rounds + 1))
    return f"WITH {E}, n AS MATERIALIZED (SELECT DISTINCT src AS node FROM s), z AS MATERIALIZED (SELECT count(*) AS k FROM n), o AS MATERIALIZED (SELECT src, count(*) AS d FROM s GROUP BY src), p0 AS MATERIALIZED (SELECT node, 1.0::DOUBLE / k AS r FROM n, z){step} SELECT node, round(r, 9) AS rank FROM p{rounds}"


@query(_rank_sql(10))
def graph_pagerank_k(spark, d):
    return N.page_rank(sparse(spark, d), tolerance=0.0, rounds=10).select("node", F.round("rank", 9).alias("rank"))


@query(_rank_sql(80).replace("round(r, 9)", "round(r, 7)"))
def graph_pagerank_converged(spark, d):
    return N.page_rank(sparse(spark, d)).select("node", F.round("rank", 7).alias("rank"))


IDS = f"{E}, i AS (SELECT src AS node, row_number() OVER (ORDER BY src) - 1 AS i FROM (SELECT DISTINCT src FROM s))"


@query(f"WITH {IDS} SELECT a.i, b.i AS j, 1 AS v FROM s JOIN i a ON s.src = a.node JOIN i b ON s.dst = b.node")
def graph_adjacency_coo(spark, d):
    return N.adjacency(sparse(spark, d))


@query(f"""WITH {M}, a AS (SELECT item, row_number() OVER (ORDER BY item) - 1 AS i FROM (SELECT DISTINCT item FROM m)), b AS (SELECT member, row_number() OVER (ORDER BY member) - 1 + (SELECT count(*) FROM a) AS j FROM (SELECT DISTINCT member FROM m)), h AS (SELECT i, j FROM m JOIN a USING (item) JOIN b USING (member)) SELECT i, j, 1 AS v FROM h UNION ALL SELECT j, i, 1 FROM h""")
def graph_bipartite_coo(spark, d):
    return N.bipartite(members(spark, d))


@query(f"WITH {DEG} SELECT count(*) AS nodes, (sum(degree) / 2)::BIGINT AS edges, sum(degree)::DOUBLE / (count(*) * count(*)) AS density, 8 * count(*) * count(*) AS dense_bytes FROM d")
def graph_density(spark, d):
    return N.density(sparse(spark, d))


@query(f"""WITH {E}, d AS (SELECT src, count(*) AS d FROM s GROUP BY src), p AS (SELECT a.dst AS a, b.dst AS b, count(*) AS n FROM s a JOIN s b ON a.src = b.src AND a.dst < b.dst GROUP BY ALL) SELECT a, b, n::DOUBLE / (x.d + y.d - n) AS jaccard FROM p JOIN d x ON x.src = a JOIN d y ON y.src = b""")
def graph_jaccard_neighbours(spark, d):
    return N.shared_jaccard(sparse(spark, d))


@query("WITH c AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL), t AS (SELECT source, sum(n) AS t FROM c GROUP BY source) SELECT source, -sum(n / t * log2(n / t)) AS entropy FROM c JOIN t USING (source) GROUP BY source")
def entropy_by_group(spark, d):
    return N.entropy(table(spark, d, "documents"), "lang", ["source"])


DIST = "SELECT p_type AS name, p_brand AS k, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY p_type) AS prob FROM part GROUP BY p_type, p_brand"


@query(f"""WITH d AS ({DIST}), n AS (SELECT DISTINCT name FROM d) SELECT p.name AS p, n.name AS q, sum(CASE WHEN coalesce(q.prob, 0) = 0 THEN 'inf'::DOUBLE ELSE -p.prob * log2(q.prob) END) AS cross_entropy FROM d p CROSS JOIN n LEFT JOIN d q ON q.name = n.name AND q.k = p.k GROUP BY ALL""")
def cross_entropy_table(spark, d):
    return N.cross_entropy(frame(spark, d, DIST))
