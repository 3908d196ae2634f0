"""Registered queries of single filters, joins, aggregates and limits, and their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from catlink.functions import text as T
from catlink.operators import networks as N
from catlink.operators import pages as P
from catlink.plans.registry import query
from catlink.plans.standins import ALTERNATES, CATALOG, CREDITS, PEOPLE, REFERENCE, duck, frame, table

REF = duck(REFERENCE)


@query(f"WITH r AS ({REF}), c AS ({duck(CATALOG)}), b AS (SELECT min(year) - 2 AS lo, max(year) + 2 AS hi FROM c WHERE title LIKE 'Lost %') SELECT ref_id FROM r, b WHERE start_year BETWEEN lo AND hi")
def year_range_filter(spark, d):
    low, high = frame(spark, d, CATALOG).filter(F.startswith("title", F.lit("Lost "))).agg(F.min("year") - 2, F.max("year") + 2).first()
    return frame(spark, d, REFERENCE).filter(F.col("start_year").between(low, high)).select("ref_id")


@query("SELECT conv_id, turn FROM conversations WHERE regexp_matches(role, '(?i)\\b(user|assistant)\\b') AND trim(coalesce(text, '')) <> ''")
def profession_regex_filter(spark, d):
    return table(spark, d, "conversations").filter(F.col("role").rlike(r"(?i)\b(user|assistant)\b") & (F.trim(F.coalesce("text", F.lit(""))) != "")).select("conv_id", "turn")


@query("SELECT event_id FROM events WHERE starts_with(event_type, 's') AND value IS NOT NULL AND props <> ''")
def prefix_and_not_blank_filter(spark, d):
    return table(spark, d, "events").filter(F.startswith("event_type", F.lit("s")) & F.col("value").isNotNull() & (F.col("props") != "")).select("event_id")


@query("SELECT o_orderkey, o_custkey > (SELECT max(s_suppkey) FROM supplier) AS new_addition FROM orders")
def watermark_additions(spark, d):
    top = table(spark, d, "supplier").agg(F.max("s_suppkey")).first()[0]
    return table(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") > top).alias("new_addition"))


@query("SELECT c_custkey, c_name, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def left_joins_two_levels(spark, d):
    x = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return x.join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left").select("c_custkey", "c_name", "n_name", "r_name")


@query(f"WITH r AS ({REF}), a AS ({duck(ALTERNATES)}), k AS (SELECT {T.title_sql('primary_title')} AS key, ref_id FROM r UNION SELECT {T.title_sql('original_title')}, ref_id FROM r UNION SELECT {T.title_sql('title')}, ref_id FROM a) SELECT key, count(*) AS ids FROM k GROUP BY key")
def title_index_union(spark, d):
    r, a = frame(spark, d, REFERENCE), frame(spark, d, ALTERNATES)
    key = lambda x, c: x.select(T.normalize_title(F.col(c)).alias("key"), "ref_id")
    return key(r, "primary_title").union(key(r, "original_title")).union(key(a, "title")).distinct().groupBy("key").agg(F.count("*").alias("ids"))


@query("SELECT p_name, count(*) AS n FROM part GROUP BY p_name ORDER BY n DESC, p_name LIMIT 10")
def value_counts_top(spark, d):
    return table(spark, d, "part").groupBy("p_name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "p_name").limit(10)


@query("SELECT DISTINCT p_name, p_type FROM part")
def unique_values(spark, d):
    return table(spark, d, "part").select("p_name", "p_type").distinct()


@query("SELECT avg(value) AS mean, stddev_pop(value) AS std FROM events")
def timing_mean_and_spread(spark, d):
    return N.mean_and_spread(table(spark, d, "events"), "value")


@query("SELECT l_partkey, list_sort(list(DISTINCT l_suppkey)) AS suppliers FROM lineitem GROUP BY l_partkey")
def group_to_sorted_set(spark, d):
    return table(spark, d, "lineitem").groupBy("l_partkey").agg(F.array_sort(F.collect_set("l_suppkey")).alias("suppliers"))


@query("SELECT p_type, max_by(p_partkey, (p_retailprice, -p_partkey)) AS best FROM part GROUP BY p_type")
def best_of_group(spark, d):
    return table(spark, d, "part").groupBy("p_type").agg(F.max_by("p_partkey", F.struct("p_retailprice", -F.col("p_partkey"))).alias("best"))


@query("WITH g AS (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_partkey) > 1 ORDER BY l_orderkey LIMIT 2000) SELECT l_orderkey, count(*) AS n FROM lineitem JOIN g USING (l_orderkey) GROUP BY l_orderkey")
def first_groups_limit(spark, d):
    """The limit is the feature: a network is loaded up to so many films."""
    li = table(spark, d, "lineitem")
    g = li.groupBy("l_orderkey").agg(F.count_distinct("l_partkey").alias("k")).filter("k > 1").orderBy("l_orderkey").limit(2000).select("l_orderkey")
    return li.join(g, "l_orderkey").groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query()
def seeded_pair_sample(spark, d):
    """The sample is the feature: five pairs of nodes, the same for a seed."""
    return N.seeded_pairs(table(spark, d, "part").select(F.col("p_partkey").alias("node")), 5)


@query(f"WITH c AS ({duck(CREDITS)}), p AS ({duck(PEOPLE)}) SELECT ref_id, name, row_number() OVER (PARTITION BY ref_id ORDER BY pos) AS place FROM c JOIN p USING (person_id)")
def credit_sequence(spark, d):
    x = frame(spark, d, CREDITS).join(frame(spark, d, PEOPLE), "person_id")
    return x.select("ref_id", "name", F.row_number().over(Window.partitionBy("ref_id").orderBy("pos")).cast("long").alias("place"))


@query("SELECT event_id, CASE WHEN event_type NOT IN ('error', 'view') THEN 'movies' WHEN value > 50 THEN 'hints' WHEN event_type = 'error' THEN 'failure:error' ELSE 'failure:timeout' END AS stands FROM events")
def page_fallback_policy(spark, d):
    status = F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "view", "timeout").otherwise("ok")
    return table(spark, d, "events").select("event_id", P.fallback(status, (F.col("value") > 50).cast("int")).alias("stands"))


@query("SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'missing_movie_title' WHEN p_size < 3 THEN 'invalid_movie_year' WHEN p_size > 48 THEN 'invalid_collection_url' WHEN p_brand = 'Brand#3' THEN 'number_mismatch' END AS violation FROM part")
def movie_row_validation(spark, d):
    p = table(spark, d, "part")
    x = p.select(
        "p_partkey", F.lit("c").alias("collection_title"), F.when(F.col("p_type") == "PROMO", "").otherwise(F.col("p_name")).alias("movie_title"), F.when(F.col("p_size") < 3, 99).otherwise(1950 + F.col("p_size")).alias("movie_year"),
        F.when(F.col("p_size") > 48, "x").otherwise("https://www.criterion.com/boxsets/1").alias("collection_url"), F.lit(1).alias("collection_number"), F.when(F.col("p_brand") == "Brand#3", 2).otherwise(1).alias("expected_number"),
    )
    return x.select("p_partkey", P.invalid_movie(x).alias("violation"))


@query("SELECT event_id, CASE lower(event_type) WHEN 'view' THEN true WHEN 'click' THEN false END AS flag FROM events")
def tri_state_flags(spark, d):
    text = F.when(F.col("event_type") == "view", " True").when(F.col("event_type") == "click", "FALSE").otherwise(F.col("event_type"))
    return table(spark, d, "events").select("event_id", T.tri_bool(text).alias("flag"))
