"""Registered curation queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from catlink.functions import text as T
from catlink.functions.runtime import numbered
from catlink.operators import curation as C
from catlink.operators import groups as G
from catlink.operators import linkage as L
from catlink.operators import pages as P
from catlink.plans.registry import query
from catlink.plans.standins import ALTERNATES, CATALOG, REFERENCE, duck, frame, table
from catlink.sources import tables as S

CAT, REF, ALT = duck(CATALOG), duck(REFERENCE), duck(ALTERNATES)


@query(f"""WITH c AS (SELECT p_partkey AS ref_id, CASE p_type WHEN 'ECONOMY' THEN '' WHEN 'PROMO' THEN NULL ELSE 'given' END AS kind, CASE p_brand WHEN 'Brand#1' THEN ' ' ELSE p_brand END AS genres FROM part), r AS ({REF})
SELECT c.ref_id, coalesce(nullif(trim(c.kind), ''), r.kind, '') AS kind, coalesce(nullif(trim(c.genres), ''), r.genres, '') AS genres FROM c LEFT JOIN r USING (ref_id)""")
def coalesce_enrich_basics(spark, d):
    kind = F.when(F.col("p_type") == "ECONOMY", "").when(F.col("p_type") == "PROMO", F.lit(None)).otherwise("given")
    x = table(spark, d, "part").select(F.col("p_partkey").alias("ref_id"), kind.alias("kind"), F.when(F.col("p_brand") == "Brand#1", " ").otherwise(F.col("p_brand")).alias("genres"))
    y = C.fill_blanks(x, frame(spark, d, REFERENCE), "ref_id", ["kind", "genres"])
    return y.withColumns({"kind": T_trim("kind"), "genres": T_trim("genres")}).select("ref_id", "kind", "genres")


def T_trim(c):
    return F.trim(c)


@query("""WITH a AS (SELECT s_suppkey AS ord, 'Nation ' || n_name AS title, CASE WHEN s_acctbal < 0 THEN '' ELSE s_suppkey::VARCHAR END AS spine FROM supplier JOIN nation ON s_nationkey = n_nationkey), b AS (SELECT c_custkey AS ord, c_name AS title, c_custkey::VARCHAR AS spine FROM customer WHERE c_name NOT IN (SELECT title FROM a)),
u AS (SELECT title, spine, ord FROM a UNION ALL SELECT title, spine, 1000000 + ord FROM b) SELECT title, spine, row_number() OVER (ORDER BY try_cast(nullif(spine, '') AS BIGINT) IS NULL, try_cast(nullif(spine, '') AS BIGINT), ord) AS place FROM u""")
def catalog_additions_union_sort(spark, d):
    a = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    a = a.select(F.col("s_suppkey").alias("ord"), F.concat(F.lit("Nation "), "n_name").alias("title"), F.when(F.col("s_acctbal") < 0, "").otherwise(F.col("s_suppkey").cast("string")).alias("spine"))
    b = table(spark, d, "customer").select((F.col("c_custkey") + 1000000).alias("ord"), F.col("c_name").alias("title"), F.col("c_custkey").cast("string").alias("spine"))
    u = a.unionByName(b.join(a.select("title"), "title", "left_anti"))
    number = F.when(F.col("spine") != "", F.col("spine").cast("long"))
    return numbered(u, [number.isNull(), number, "ord"], "place").select("title", "spine", F.col("place").cast("long").alias("place"))


@query(f"""WITH c AS ({CAT}), r AS ({REF}), a AS ({ALT}) SELECT row_id, {T.title_sql('title')} AS key FROM c WHERE {T.title_sql('title')} <> '' AND {T.title_sql('title')} NOT IN (SELECT {T.title_sql('primary_title')} FROM r WHERE kind = 'movie' UNION SELECT {T.title_sql('title')} FROM a WHERE starts_with(title, 'A '))""")
def no_entry_antijoin(spark, d):
    c = frame(spark, d, CATALOG).select("row_id", T.normalize_title(F.col("title")).alias("key")).filter("key <> ''")
    r = frame(spark, d, REFERENCE).filter("kind = 'movie'").select(T.normalize_title(F.col("primary_title")).alias("key"))
    a = frame(spark, d, ALTERNATES).filter(F.startswith("title", F.lit("A "))).select(T.normalize_title(F.col("title")).alias("key"))
    return c.join(r.union(a).distinct(), "key", "left_anti").select("row_id", "key")


@query("""WITH ex AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'error' AND value > 150), r AS (SELECT user_id, event_id, 'needs_manual_review' AS status FROM events WHERE event_type = 'view' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1),
u AS (SELECT user_id, event_id, 'unreviewed' AS status FROM events WHERE event_type = 'signup' AND value < 5 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT * FROM (SELECT * FROM r WHERE user_id NOT IN (SELECT user_id FROM u) UNION ALL SELECT * FROM u) WHERE user_id NOT IN (SELECT user_id FROM ex)""")
def unmatched_tracking_upsert(spark, d):
    e = table(spark, d, "events")
    review = C.first_wins(e.filter("event_type = 'view'"), ["user_id"], "ts", "event_id").select("user_id", "event_id", F.lit("needs_manual_review").alias("status"))
    new = C.first_wins(e.filter("event_type = 'signup' and value < 5"), ["user_id"], F.desc("ts"), F.desc("event_id")).select("user_id", "event_id", F.lit("unreviewed").alias("status"))
    gone = e.filter("event_type = 'error' and value > 150").select("user_id").distinct()
    return C.upsert(review, new, ["user_id"]).join(gone, "user_id", "left_anti")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')")
def semi_join_filter(spark, d):
    return table(spark, d, "orders").join(table(spark, d, "customer").filter("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


LISTED = "SELECT l_orderkey, list(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY l_orderkey"


@query("SELECT DISTINCT l_orderkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO')")
def exists_any_filter(spark, d):
    x = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_partkey").alias("parts"))
    return C.any_listed(x, "l_orderkey", "parts", table(spark, d, "part").filter("p_type = 'PROMO'").select("p_partkey"), "p_partkey").select("l_orderkey")


@query("SELECT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey HAVING bool_and(p_type <> 'PROMO')")
def forall_filter(spark, d):
    x = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_partkey").alias("parts"))
    return C.all_listed(x, "l_orderkey", "parts", table(spark, d, "part").filter("p_type <> 'PROMO'").select("p_partkey"), "p_partkey").select("l_orderkey")


@query(f"SELECT ref_id, primary_title FROM ({REF}) WHERE kind = 'movie' AND runtime > 40 AND NOT list_contains(string_split(genres, ','), 'Short')")
def boxset_feature_export(spark, d):
    r = frame(spark, d, REFERENCE)
    return r.filter((F.col("kind") == "movie") & (L.short_signal(F.col("kind"), F.col("runtime").cast("string"), F.col("genres")) == L.FEATURE)).select("ref_id", "primary_title")


@query(f"SELECT ref_id, kind FROM ({REF}) WHERE kind IN ('short', 'video', 'tvMovie', 'tvSeries') AND start_year BETWEEN 1960 AND 1980")
def nonfeature_export(spark, d):
    return frame(spark, d, REFERENCE).filter(F.col("kind").isin(*C.OTHER_CONTENT) & F.col("start_year").between(1960, 1980)).select("ref_id", "kind")


@query(f"WITH r AS ({REF}) SELECT l_orderkey, count(*) FILTER (kind = 'movie' AND runtime > 40) AS features FROM lineitem JOIN r ON l_partkey = ref_id GROUP BY l_orderkey HAVING count(*) FILTER (kind = 'movie' AND runtime > 40) > 0")
def unmatched_collections_having(spark, d):
    x = table(spark, d, "lineitem").join(frame(spark, d, REFERENCE), F.col("l_partkey") == F.col("ref_id"))
    return x.groupBy("l_orderkey").agg(F.count_if((F.col("kind") == "movie") & (F.col("runtime") > 40)).alias("features")).filter("features > 0")


@query("""WITH k AS (SELECT l_orderkey, l_linenumber, min(l_partkey) AS part, min(l_suppkey) AS supp FROM lineitem GROUP BY ALL), o AS (SELECT event_id AS ord, user_id AS k1, try_cast(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 8 AS k2, event_type AS title FROM events),
w AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY k1, k2 ORDER BY ord DESC) = 1) SELECT l_orderkey, l_linenumber, coalesce(nullif(CASE WHEN title = 'view' THEN ' ' ELSE title END, ' '), part::VARCHAR) AS film_title FROM k LEFT JOIN w ON l_orderkey = k1 AND l_linenumber = k2""")
def composite_override_join(spark, d):
    k = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").cast("string").alias("film_title"))
    k = k.select(F.col("l_orderkey").cast("string").alias("source_id"), F.col("l_linenumber").alias("seq"), "film_title", *[F.lit("").alias(c) for c in ("film_director", "film_year", "film_source_id")])
    e = table(spark, d, "events")
    number = (F.regexp_extract("props", "([0-9]+)", 1).cast("int") % 8).cast("string")
    o = e.select(F.col("user_id").cast("string").alias("collection_id"), number.alias("seq"), F.when(F.col("event_type") == "view", " ").otherwise(F.col("event_type")).alias("film_title"), *[F.lit("").alias(c) for c in ("film_director", "film_year", "film_source_id")], F.col("event_id").alias("ord"))
    return G.apply_overrides(k, o).select(F.col("source_id").cast("long").alias("l_orderkey"), F.col("seq").alias("l_linenumber"), "film_title")


ANCHOR = """
new AS (SELECT p_partkey AS row_id, CASE WHEN p_size < 10 THEN p_partkey::VARCHAR ELSE '' END AS spine, p_name AS title_key, p_brand AS director_key, CASE WHEN p_size > 40 THEN '' ELSE (1950 + p_size)::VARCHAR END AS year FROM part),
old AS (SELECT o_orderkey AS old_id, CASE WHEN o_orderstatus = 'F' THEN o_custkey::VARCHAR ELSE 'x' END AS spine, p_name AS title_key, CASE WHEN o_orderstatus = 'O' THEN p_brand ELSE '' END AS director_key, (1950 + p_size + p_size % 3)::VARCHAR AS year, o_orderkey AS ord FROM orders JOIN part ON o_custkey = p_partkey)"""


@query(f"""WITH {ANCHOR}, s AS (SELECT row_id, old_id, 1 AS stage, 0 AS near, ord FROM new JOIN old USING (spine) UNION ALL SELECT row_id, old_id, CASE WHEN new.director_key = old.director_key THEN 2 ELSE 3 END, (new.year <> '' AND abs(try_cast(new.year AS INTEGER) - try_cast(old.year AS INTEGER)) <= 1)::INTEGER, ord FROM new JOIN old USING (title_key) WHERE title_key <> ''),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY stage, near DESC, ord) = 1)
SELECT row_id, old_id, CASE stage WHEN 1 THEN 'spine' WHEN 2 THEN 'title_director' WHEN 3 THEN CASE near WHEN 1 THEN 'title_year' ELSE 'title_only' END END AS how FROM new LEFT JOIN b USING (row_id)""")
def cascade_fallback_join(spark, d):
    p = table(spark, d, "part")
    new = p.select(F.col("p_partkey").alias("row_id"), F.when(F.col("p_size") < 10, F.col("p_partkey").cast("string")).otherwise("").alias("spine"), F.col("p_name").alias("title_key"), F.col("p_brand").alias("director_key"), F.when(F.col("p_size") > 40, "").otherwise((1950 + F.col("p_size")).cast("string")).alias("year"))
    x = table(spark, d, "orders").join(p, F.col("o_custkey") == F.col("p_partkey"))
    old = x.select(F.col("o_orderkey").alias("old_id"), F.when(F.col("o_orderstatus") == "F", F.col("o_custkey").cast("string")).otherwise("x").alias("spine"), F.col("p_name").alias("title_key"), F.when(F.col("o_orderstatus") == "O", F.col("p_brand")).otherwise("").alias("director_key"), (1950 + F.col("p_size") + F.col("p_size") % 3).cast("string").alias("year"), F.col("o_orderkey").alias("ord"))
    return C.anchor_rows(new, old)


@query("""WITH u AS (SELECT 0 AS rank, 'customer' AS evidence, n_name AS key, c_custkey AS id FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 9000 UNION ALL SELECT 1, 'supplier', n_name, s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey UNION ALL SELECT 2, 'nation', n_name, n_nationkey FROM nation)
SELECT key, id, evidence FROM u QUALIFY row_number() OVER (PARTITION BY key ORDER BY rank, id) = 1""")
def known_title_index_first_wins(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("n"), F.col("n_name").alias("key"))
    c = table(spark, d, "customer").filter("c_acctbal > 9000").join(n, F.col("c_nationkey") == F.col("n")).select("key", F.col("c_custkey").alias("id"))
    s = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n")).select("key", F.col("s_suppkey").alias("id"))
    return C.first_source([("customer", c), ("supplier", s), ("nation", n.select("key", F.col("n").cast("long").alias("id")))], ["key"], "id")


@query("""SELECT o_orderkey, count(l_partkey) AS total, count(*) FILTER (l_partkey IS NOT NULL AND l_returnflag = 'R') AS missing, CASE WHEN count(*) FILTER (l_returnflag = 'R') = 0 THEN 'resolved' WHEN count(*) FILTER (l_returnflag = 'R') < count(l_partkey) THEN 'partial' ELSE 'needs_manual_decomposition' END AS status
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey UNION ALL SELECT o_orderkey, 0, 0, 'childless' FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def group_status_rollup(spark, d):
    o, li = table(spark, d, "orders").select("o_orderkey"), table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    done = G.rollup_status(li, "o_orderkey", F.col("l_returnflag") != "R")
    x = o.join(done, "o_orderkey", "left")
    return x.select("o_orderkey", F.coalesce("total", F.lit(0)).cast("long").alias("total"), F.coalesce("missing", F.lit(0)).cast("long").alias("missing"), F.coalesce("status", F.lit("childless")).alias("status"))


@query("""WITH v AS (SELECT l_orderkey, p_brand, count(*) AS n, min(l_linenumber * 100000000 + l_partkey) AS o FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL) SELECT l_orderkey, p_brand FROM v QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, o, p_brand) = 1""")
def plurality_vote(spark, d):
    x = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).withColumn("o", F.col("l_linenumber") * F.lit(100000000).cast("long") + F.col("l_partkey"))
    return G.plurality(x, "l_orderkey", "p_brand", "o")


ITEMS = """
SELECT p_partkey AS row_id, CASE WHEN p_size = 3 THEN '' ELSE 'tt' || CAST(p_partkey AS STRING) END AS ref_id, CASE p_type WHEN 'ECONOMY' THEN 'movie' WHEN 'SMALL' THEN 'movie' WHEN 'LARGE' THEN 'tvSeries' WHEN 'PROMO' THEN 'Video' WHEN 'MEDIUM' THEN '' ELSE 'podcast' END AS kind,
  CASE WHEN p_size % 11 = 0 THEN 'Drama,Documentary' ELSE 'Drama' END AS genres, CASE WHEN p_size % 7 = 0 THEN '\\\\N' ELSE CAST(p_size * 4 AS STRING) END AS runtime, CAST(1950 + p_size AS STRING) AS year, CAST(1950 + p_size + p_partkey % 4 AS STRING) AS start_year,
  p_size % 2 = 0 AS include, p_size % 13 = 0 AS is_short, CASE WHEN p_size % 5 = 0 THEN 'x' ELSE '' END AS notes, p_name AS title FROM part"""
ITEMS_SQL = ITEMS.replace("AS STRING", "AS VARCHAR").replace("\\\\N", "\\N")
UNPACK = """CASE WHEN ref_id = '' THEN 'Untracked / Problem|low|no_reliable_match|true' WHEN lower(kind) IN ('tvseries', 'tvminiseries', 'tvmovie', 'tvspecial', 'tvepisode', 'tvshort', 'tvpilot') THEN 'TV / Docs / Shorts / Video|high|television|false'
  WHEN lower(kind) IN ('short', 'video', 'videogame') THEN 'TV / Docs / Shorts / Video|high|video_or_short_form|false' WHEN contains(genres, 'Documentary') THEN 'TV / Docs / Shorts / Video|' || CASE WHEN rt IS NOT NULL THEN 'high|documentary|false' ELSE 'medium|documentary|true' END
  WHEN is_short THEN 'TV / Docs / Shorts / Video|high|flagged_short|false' WHEN rt < 40 THEN 'TV / Docs / Shorts / Video|high|below_40_minutes|false' WHEN kind = 'movie' AND rt >= 40 THEN CASE WHEN gap > 1 THEN 'Movies|medium|years_differ|true' WHEN gap = 1 THEN 'Movies|medium|years_differ_by_one|false' ELSE 'Movies|high|feature_length|false' END
  WHEN kind = 'movie' THEN 'Unknown|low|runtime_missing|true' WHEN NOT include AND notes = '' THEN 'TV / Docs / Shorts / Video|medium|excluded_without_reason|true' ELSE 'Unknown|low|not_resolved|true' END"""


def items(spark, d):
    return frame(spark, d, ITEMS)


@query(f"""WITH i AS ({ITEMS_SQL}), j AS (SELECT *, try_cast(nullif(runtime, '\\N') AS INTEGER) AS rt, abs(year::INTEGER - start_year::INTEGER) AS gap FROM i) SELECT row_id, {UNPACK} AS verdict, CASE gap WHEN 0 THEN 'exact' WHEN 1 THEN 'within_1' ELSE 'off' END AS years FROM j""")
def unpack_classifier(spark, d):
    x = items(spark, d).withColumn("u", C.unpack_class(items(spark, d)))
    return x.select("row_id", F.concat_ws("|", "u.category", "u.confidence", "u.reason", F.col("u.needs_review").cast("string")).alias("verdict"), C.years_match(F.col("year"), F.col("start_year")).alias("years"))


@query(f"""WITH i AS ({ITEMS_SQL}), m AS (SELECT * FROM i WHERE kind = 'movie'), k AS (SELECT DISTINCT title, year FROM m) SELECT row_id, CASE WHEN ref_id <> '' THEN ref_id IN (SELECT ref_id FROM m) ELSE (title, year) IN (SELECT (title, year) FROM k) END AS already_tracked, CASE WHEN ref_id <> '' THEN ref_id ELSE title || '|' || year END AS duplicate_key FROM i""")
def tracked_items(spark, d):
    x = items(spark, d).withColumn("title_key", F.col("title"))
    return C.tracked(x, x.filter("kind = 'movie'")).select("row_id", "already_tracked", "duplicate_key")


STATUS = """
SELECT c_custkey AS source_id, CASE WHEN c_acctbal < 0 THEN 'collection_header' ELSE 'new_entry' END AS status FROM customer"""
TABLE = "SELECT s_suppkey AS source_id, CASE WHEN s_acctbal > 5000 THEN 'movie' ELSE 'collection' END AS kind, CASE WHEN s_acctbal > 7000 THEN 'tt' || CAST(s_suppkey AS STRING) ELSE '' END AS ref_id, CASE WHEN s_acctbal > 5000 THEN 'matched' ELSE 'collection' END AS action FROM supplier"


@query(f"""WITH r AS ({STATUS}), t AS ({duck(TABLE)}) SELECT r.source_id, CASE WHEN status = 'collection_header' THEN 'collection_label' ELSE coalesce(kind, '') END AS kind, CASE WHEN status = 'collection_header' THEN 'collection_label' ELSE coalesce(action, 'unresolved') END AS action,
CASE WHEN status = 'collection_header' THEN false ELSE coalesce(action = 'matched', false) AND coalesce(ref_id, '') <> '' END AS resolved FROM r LEFT JOIN t USING (source_id)""")
def resolution_apply(spark, d):
    return C.apply_resolutions(frame(spark, d, STATUS), frame(spark, d, TABLE)).select("source_id", "kind", "action", "resolved")


DIRECT = "SELECT p_partkey % 500 AS row_id, CASE WHEN p_size = 6 THEN 'x' ELSE 'tt' END || CAST(p_partkey % 300 AS STRING) AS ref_id, CASE p_type WHEN 'ECONOMY' THEN 'short' WHEN 'LARGE' THEN '' ELSE 'movie' END AS kind, CAST(p_size * 4 AS STRING) AS runtime, 'Drama' AS genres, p_partkey AS ord FROM part"
MANUAL = "SELECT user_id AS row_id, 'tt' || CAST(user_id AS STRING) AS ref_id, CASE event_type WHEN 'view' THEN 'Matched' WHEN 'click' THEN 'exclude_short' WHEN 'signup' THEN 'no_imdb_entry' WHEN 'error' THEN '' ELSE 'include' END AS action, event_id AS ord FROM events"
KIDS = "SELECT l_orderkey AS row_id, CASE WHEN l_returnflag = 'R' THEN '' ELSE 'tt' || CAST(l_partkey AS STRING) END AS ref_id, CASE WHEN l_linestatus = 'F' THEN 'movie' ELSE 'short' END AS kind, CAST(CAST(l_quantity AS INT) * 4 AS STRING) AS runtime, 'Drama' AS genres, l_discount < 0.08 AS include, l_linenumber * 100000000 + l_partkey AS ord FROM lineitem"
BASICS = "SELECT 'tt' || CAST(p_partkey AS STRING) AS ref_id, 'movie' AS kind, CAST(p_size * 2 AS STRING) AS runtime, 'Drama' AS genres FROM part"
SIG = "CASE WHEN kind = 'short' THEN 'imdb_title_type_short' WHEN list_contains(string_split(genres, ','), 'Short') THEN 'imdb_genre_short' WHEN try_cast(runtime AS INTEGER) <= 40 THEN 'runtime_40_or_less' ELSE 'feature_or_unknown' END"


@query(f"""WITH a AS (SELECT *, {SIG} AS s FROM ({duck(DIRECT)})), m AS (SELECT *, lower(trim(action)) AS a FROM ({duck(MANUAL)})), k AS (SELECT *, {SIG} AS s FROM ({duck(KIDS)}) WHERE ref_id <> ''), b AS ({duck(BASICS)}),
u AS (SELECT row_id, ref_id, 'direct' AS via, CASE WHEN s = 'feature_or_unknown' THEN 'final' ELSE 'short' END AS output, s AS reason, kind, runtime, genres, ord, 1 AS v FROM a
 UNION ALL SELECT row_id, ref_id, 'manual', CASE WHEN a IN ('matched', 'matched_directly', 'include') THEN 'final' WHEN a IN ('exclude_short', 'exclude_as_short') THEN 'short' ELSE 'rare' END, a, '', '', '', ord, 2 FROM m WHERE a <> ''
 UNION ALL SELECT row_id, ref_id, 'expanded', CASE WHEN s = 'feature_or_unknown' AND include THEN 'final' ELSE 'short' END, CASE WHEN s <> 'feature_or_unknown' THEN s WHEN NOT include THEN 'include_in_dataset_false' ELSE s END, kind, runtime, genres, ord, 3 FROM k),
f AS (SELECT * FROM u WHERE output = 'final' QUALIFY row_number() OVER (PARTITION BY via = 'expanded', row_id, ref_id ORDER BY v DESC, ord DESC) = 1),
g AS (SELECT f.row_id, f.ref_id, via, coalesce(nullif(trim(f.kind), ''), b.kind, '') AS kind, coalesce(nullif(trim(f.runtime), ''), b.runtime, '') AS runtime, coalesce(nullif(trim(f.genres), ''), b.genres, '') AS genres FROM f LEFT JOIN b USING (ref_id)),
h AS (SELECT row_id, ref_id, via, starts_with(ref_id, 'tt') AS ok, {SIG} AS s FROM g),
o AS (SELECT row_id, ref_id, via, output, reason FROM u WHERE output <> 'final' UNION ALL SELECT row_id, ref_id, via, CASE WHEN ok AND s = 'feature_or_unknown' THEN 'final' ELSE 'short' END, CASE WHEN NOT ok THEN 'missing_or_invalid_id' ELSE s END FROM h)
SELECT * FROM o""")
def final_assembly_dedupe(spark, d):
    return C.assemble_final(frame(spark, d, DIRECT), frame(spark, d, MANUAL), frame(spark, d, KIDS), frame(spark, d, BASICS))


FLAGS = """
SELECT c_custkey AS row_id, c_acctbal < -500 AS in_rare, c_acctbal BETWEEN -500 AND 500 AS in_excluded, c_nationkey < 8 AS is_root, CASE WHEN c_acctbal > 8000 THEN 'expanded_collection' WHEN c_acctbal > 6000 THEN c_mktsegment WHEN c_acctbal > 5500 THEN ' ' END AS final_via,
  CASE c_nationkey % 6 WHEN 0 THEN 'Collection' WHEN 1 THEN 'include' WHEN 2 THEN 'exclude_short' WHEN 3 THEN 'flag_edge_case' WHEN 4 THEN 'no_imdb_entry' END AS action, CASE c_mktsegment WHEN 'MACHINERY' THEN 'resolved' WHEN 'HOUSEHOLD' THEN 'partial' END AS expand_status FROM customer"""


@query(f"""WITH f AS ({FLAGS}), g AS (SELECT *, lower(coalesce(action, '')) AS a, CASE WHEN is_root AND lower(coalesce(action, '')) NOT IN ('no_imdb_entry', 'unresolved') THEN coalesce(expand_status, '') END AS st FROM f),
h AS (SELECT row_id, CASE WHEN in_rare THEN 'rare_edge_case|listed_in_rare_edge_cases' WHEN in_excluded THEN 'excluded_short|listed_in_excluded_shorts' WHEN final_via = 'expanded_collection' THEN 'collection_unpacked|final_via_expanded_collection' WHEN final_via IS NOT NULL THEN 'matched_direct_feature|final_matched_via=' || CASE WHEN trim(final_via) = '' THEN 'unknown' ELSE trim(final_via) END
 WHEN a IN ('collection', 'collection_label') THEN 'collection_unpacked|manual_resolution_' || a WHEN a IN ('matched', 'matched_directly', 'include') THEN 'matched_direct_feature|manual_resolution_pending_build_final' WHEN a IN ('exclude_short', 'exclude_as_short') THEN 'excluded_short|manual_resolution_exclude_short' WHEN a IN ('rare_edge_case', 'flag_edge_case') THEN 'rare_edge_case|manual_resolution_rare_edge'
 WHEN st = 'resolved' THEN 'collection_unpacked|collection_container_expand_resolved' WHEN st IN ('partial', 'needs_manual_decomposition') THEN 'unresolved|collection_expand_' || st WHEN a IN ('no_imdb_entry', 'unresolved') THEN 'unresolved|' || a ELSE 'unresolved|not_classified' END AS x FROM g)
SELECT row_id, split_part(x, '|', 1) AS disposition, split_part(x, '|', 2) AS detail, CASE split_part(x, '|', 1) WHEN 'matched_direct_feature' THEN '1_matched_direct_full_length' WHEN 'collection_unpacked' THEN '2_unpacked_from_collection' WHEN 'excluded_short' THEN '3_identified_short_excluded' WHEN 'rare_edge_case' THEN '4_rare_edge_case' ELSE 'unresolved' END AS bucket FROM h""")
def disposition_priority(spark, d):
    return C.dispositions(frame(spark, d, FLAGS)).select("row_id", "disposition", "detail", "bucket")


@query(f"""SELECT row_id, CASE WHEN title = 'red bolt' THEN 'Years Match' WHEN kind IN ('documentary', 'short', 'tvMiniSeries', 'tvMovie', 'tvSeries', 'tvSpecial', 'video') THEN 'Other Content' WHEN kind = 'movie' AND title = 'old bolt' THEN 'Years Match' WHEN kind = 'movie' AND year = '' THEN 'Unverified Titles' WHEN kind = 'movie' AND title IN ('hot gear', 'small ring') THEN 'Years Off' WHEN kind = 'movie' THEN 'Years Match' ELSE 'Data Issues / Untracked' END AS bucket
FROM (SELECT row_id, title, kind, CASE WHEN include THEN year ELSE '' END AS year FROM ({ITEMS_SQL}))""")
def stage6_buckets(spark, d):
    x = items(spark, d).withColumn("year", F.when(F.col("include"), F.col("year")).otherwise(""))
    return x.select("row_id", C.stage6_bucket(F.col("title"), F.col("year"), F.col("kind"), ["hot gear", "small ring"], ["old bolt"], {"red bolt": "Years Match"}).alias("bucket"))


ROWSTATUS = """
SELECT c_custkey AS row_id, CASE WHEN c_nationkey = 3 THEN c_name || ' Collection' WHEN c_nationkey = 4 THEN c_name || ': x' ELSE c_name END AS title, CASE WHEN c_nationkey < 9 THEN '' ELSE 'Ann Lee' END AS director, CASE WHEN c_nationkey % 2 = 0 THEN '' ELSE 'France' END AS country, CASE WHEN c_nationkey % 3 = 0 THEN '' ELSE '1999' END AS year, c_acctbal > 4000 AS numbered,
  CASE WHEN c_acctbal > 9500 THEN 'movie' WHEN c_acctbal > 9200 THEN 'short' WHEN c_acctbal > 9000 THEN 'collection' END AS manual_type, c_acctbal BETWEEN 4000 AND 5000 AS in_short, c_acctbal BETWEEN 4900 AND 6000 AS in_match, c_acctbal BETWEEN 6000 AND 7000 AS in_review, c_acctbal BETWEEN 7000 AND 7500 AS in_unmatched, c_acctbal < -500 AS short_title,
  CASE WHEN c_acctbal < 0 THEN 'title_director' WHEN c_acctbal < 1000 THEN 'title_year' WHEN c_acctbal < 2000 THEN 'title_only' END AS how FROM customer"""


@query(f"""SELECT row_id, CASE WHEN manual_type = 'movie' THEN 'matched' WHEN manual_type = 'short' THEN 'other_content' WHEN manual_type = 'collection' THEN 'collection_header' WHEN numbered THEN CASE WHEN in_short THEN 'excluded_short' WHEN in_match THEN 'matched' WHEN in_review OR in_unmatched THEN 'needs_review' ELSE 'new_entry' END
 WHEN director = '' THEN CASE WHEN regexp_matches(lower(title), '{"|".join(G.CONTAINER_HINTS)}') OR regexp_matches(title, '[/:]') OR (year = '' AND country = '') THEN 'collection_header' ELSE 'new_entry' END
 WHEN short_title THEN 'excluded_short' WHEN how IN ('title_director', 'title_year') THEN 'matched' WHEN how = 'title_only' THEN 'needs_review' ELSE 'new_entry' END AS status FROM ({ROWSTATUS})""")
def row_status_ladder(spark, d):
    x = frame(spark, d, ROWSTATUS)
    return x.select("row_id", C.row_status(x).alias("status"))


@query(f"""WITH i AS ({ITEMS_SQL}), j AS (SELECT *, {SIG.replace("try_cast(runtime", "try_cast(nullif(runtime, chr(92) || 'N')")} AS s FROM i)
SELECT unnest(['source_rows', 'invalid_id_rows', 'not_feature_rows', 'distinct_titles', 'coverage_pct']) AS metric, unnest([count(*)::DOUBLE, count(*) FILTER (NOT starts_with(ref_id, 'tt')), count(*) FILTER (s <> 'feature_or_unknown'), count(DISTINCT title), round(100.0 * count(*) FILTER (include) / count(*), 2)]) AS value FROM j""")
def validation_report(spark, d):
    s = L.short_signal(F.col("kind"), F.col("runtime"), F.col("genres"))
    return C.metrics(items(spark, d), {"source_rows": F.count("*"), "invalid_id_rows": F.count_if(~F.startswith("ref_id", F.lit("tt"))), "not_feature_rows": F.count_if(s != L.FEATURE), "distinct_titles": F.count_distinct("title"), "coverage_pct": C.percentage(F.count_if("include"), F.count("*"))})


@query("SELECT c_mktsegment, round(100.0 * count(*) FILTER (c_acctbal > 0) / count(*), 2)::DOUBLE AS pct FROM customer GROUP BY c_mktsegment")
def coverage_pct(spark, d):
    return table(spark, d, "customer").groupBy("c_mktsegment").agg(C.percentage(F.count_if(F.col("c_acctbal") > 0), F.count("*")).alias("pct"))


@query("SELECT metric, count(*) AS value FROM (SELECT unnest(['p_brand::' || p_brand, 'p_type::' || p_type, 'p_size::' || p_size]) AS metric FROM part) GROUP BY metric")
def unpack_summary_metrics(spark, d):
    return C.counts_as_metrics(table(spark, d, "part"), ["p_brand", "p_type", "p_size"])


@query("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier UNION SELECT n_nationkey FROM nation")
def set_union_distinct(spark, d):
    k = lambda t, c: table(spark, d, t).select(F.col(c).alias("k"))
    return k("customer", "c_nationkey").union(k("supplier", "s_nationkey")).union(k("nation", "n_nationkey")).distinct()


@query("SELECT p_partkey AS k FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 45")
def set_except(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("k")).subtract(table(spark, d, "lineitem").filter("l_quantity > 45").select("l_partkey"))


@query("SELECT l_partkey AS k FROM lineitem WHERE l_quantity > 45 INTERSECT SELECT l_partkey FROM lineitem WHERE l_discount < 0.01")
def set_intersect(spark, d):
    li = table(spark, d, "lineitem")
    return li.filter("l_quantity > 45").select(F.col("l_partkey").alias("k")).intersect(li.filter("l_discount < 0.01").select("l_partkey"))


CANON = "SELECT p_partkey AS row_id, CASE WHEN p_size < 20 THEN 'tt' || CAST(p_partkey % 97 AS STRING) ELSE '' END AS ref_id, p_name AS title_key, 1950 + p_size AS year, p_type = 'PROMO' AS standalone FROM part"
CANON_SQL = f"""c AS (SELECT *, CASE WHEN ref_id <> '' THEN 'id' ELSE 'title_year' END AS method, CASE WHEN ref_id <> '' THEN 'i|' || ref_id ELSE 't|' || title_key || '|' || year END AS k FROM ({duck(CANON)})), d AS (SELECT *, first_value(row_id) OVER (PARTITION BY k ORDER BY standalone DESC, row_id) AS canonical_id FROM c)"""


@query(f"WITH {CANON_SQL} SELECT row_id, canonical_id, method FROM d WHERE row_id = canonical_id")
def canonical_titles(spark, d):
    return C.canonical_titles(frame(spark, d, CANON)).filter("row_id = canonical_id").select("row_id", "canonical_id", "method")


@query(f"WITH {CANON_SQL} SELECT canonical_id, count(*) AS sources, min(row_id) AS first_source FROM d GROUP BY canonical_id")
def title_provenance(spark, d):
    return C.canonical_titles(frame(spark, d, CANON)).groupBy("canonical_id").agg(F.count("*").alias("sources"), F.min("row_id").alias("first_source"))


@query("""SELECT p_partkey, CASE WHEN p_size = 50 THEN 'manual' WHEN p_type = 'PROMO' AND p_size % 3 = 0 THEN 'exact_title_and_year' WHEN p_type = 'PROMO' AND p_size % 3 = 1 THEN 'exact_title_year_within_1' WHEN p_type = 'PROMO' THEN 'exact_title' WHEN p_type = 'SMALL' THEN 'normalized_title' WHEN p_type = 'LARGE' THEN 'alternate_title' WHEN p_size > 25 THEN 'fuzzy' ELSE 'none' END AS method,
CASE WHEN p_size = 50 OR (p_type = 'PROMO' AND p_size % 3 = 0) THEN 'high' WHEN p_type IN ('PROMO', 'SMALL') THEN 'medium' ELSE 'low' END AS confidence FROM part""")
def match_method_ladder(spark, d):
    via = F.when(F.col("p_type") == "PROMO", F.array(F.lit("title_exact"))).when(F.col("p_type") == "SMALL", F.array(F.lit("title_normalized"))).when(F.col("p_type") == "LARGE", F.array(F.lit("aka_exact"))).otherwise(F.array().cast("array<string>"))
    return table(spark, d, "part").select("p_partkey", C.match_method(via, F.col("p_size") % 3, F.col("p_size") > 25, F.col("p_size") == 50).alias("m")).select("p_partkey", "m.method", "m.confidence")


@query("""SELECT p_partkey, array_to_string(list_sort(list_filter([CASE WHEN p_size > 40 THEN 'year_conflict' END, CASE WHEN p_retailprice < 905 THEN 'missing_runtime' END, CASE WHEN p_type = 'PROMO' THEN 'duplicate_candidates' END], lambda r: r IS NOT NULL)), ',') AS reasons FROM part""")
def review_reasons(spark, d):
    named = {"year_conflict": F.col("p_size") > 40, "missing_runtime": F.col("p_retailprice") < 905, "duplicate_candidates": F.col("p_type") == "PROMO"}
    return table(spark, d, "part").select("p_partkey", F.array_join(C.review_reasons(named), ",").alias("reasons"))


@query(f"""WITH i AS ({ITEMS_SQL}) SELECT 'duplicate_title_rows' AS check_name, count(*) AS violations FROM (SELECT title, year FROM i GROUP BY title, year HAVING count(*) > 1) UNION ALL SELECT 'missing_id_rows', count(*) FROM i WHERE ref_id = '' UNION ALL SELECT 'year_off_rows', count(*) FROM i WHERE abs(year::INTEGER - start_year::INTEGER) > 1 UNION ALL SELECT 'short_features', count(*) FROM i WHERE kind = 'movie' AND is_short""")
def qc_checks(spark, d):
    x = items(spark, d)
    one = lambda name, y: y.agg(F.lit(name).alias("check_name"), F.count("*").alias("violations"))
    return (
        one("duplicate_title_rows", x.groupBy("title", "year").count().filter("count > 1")).unionByName(one("missing_id_rows", x.filter("ref_id = ''")))
        .unionByName(one("year_off_rows", x.filter(C.years_match(F.col("year"), F.col("start_year")) == "off"))).unionByName(one("short_features", x.filter("kind = 'movie' and is_short")))
    )


@query("""SELECT c_custkey AS row_id, coalesce(CASE WHEN c_acctbal > 8000 THEN 'cached' END, 'page-' || s_suppkey, CASE WHEN c_nationkey < 5 THEN 'n' || c_nationkey END) AS url, CASE WHEN c_acctbal > 8000 THEN 'cache' WHEN s_suppkey IS NOT NULL THEN 'exact_title' WHEN c_nationkey < 5 THEN 'series_number' END AS how FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey""")
def url_cascade(spark, d):
    c = table(spark, d, "customer")
    rows = c.select(F.col("c_custkey").alias("row_id"), F.col("c_custkey").cast("string").alias("key"), F.col("c_nationkey").alias("number"))
    cache = c.filter("c_acctbal > 8000").select(F.col("c_custkey").cast("string").alias("key"), F.lit("cached").alias("url"))
    exact = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("key"), F.concat(F.lit("page-"), F.col("s_suppkey").cast("string")).alias("url"))
    numbered = table(spark, d, "nation").filter("n_nationkey < 5").select(F.col("n_nationkey").alias("number"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("url"))
    return P.url_cascade(rows, cache, exact, numbered, rows.limit(0).select("row_id", F.lit("").alias("url")))


#: A finished run over part and orders: every table of the 24 counts.
RUN = {
    "catalog": "SELECT CAST(p_partkey AS STRING) AS row_id FROM part",
    "initial": "SELECT CAST(p_partkey AS STRING) AS row_id FROM part WHERE p_size < 20",
    "unmatched": "SELECT CAST(p_partkey AS STRING) AS row_id FROM part WHERE p_size >= 15",
    "resolved": "SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'F'",
    "constituents": "SELECT CASE WHEN l_returnflag = 'A' THEN ' ' ELSE 'tt' || CAST(l_partkey AS STRING) END AS ref_id, l_returnflag = 'R' AS include FROM lineitem",
    "shorts": "SELECT l_orderkey AS id FROM lineitem WHERE l_quantity < 5",
    "final": "SELECT CAST(p_partkey % 500 AS STRING) AS row_id, CAST(p_size AS STRING) AS source_id, CASE WHEN p_size % 9 = 0 THEN 'nm7' ELSE ' tt1' END AS ref_id, CASE WHEN p_size % 4 = 0 THEN 'runtime_40_or_less' WHEN p_size % 4 = 1 THEN '' ELSE 'feature_or_unknown' END AS signal, CASE WHEN p_size % 2 = 0 THEN 'expanded_collection' ELSE 'direct' END AS via FROM part",
    "excluded": "SELECT CAST(p_partkey AS STRING) AS row_id FROM part WHERE p_size BETWEEN 30 AND 33",
    "rare": "SELECT CASE WHEN p_size = 44 THEN '' ELSE CAST(p_partkey AS STRING) END AS row_id FROM part WHERE p_size BETWEEN 40 AND 44",
    "containers": "SELECT DISTINCT CAST(p_size AS STRING) AS source_id FROM part WHERE p_size > 35",
    "dispositions": "SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'unresolved' WHEN '2-HIGH' THEN 'matched_direct_feature' WHEN '3-MEDIUM' THEN 'collection_unpacked' WHEN '5-LOW' THEN 'excluded_short' ELSE 'rare_edge_case' END AS disposition FROM orders",
}
_IDS = {t: f"(SELECT DISTINCT row_id FROM {t} WHERE row_id <> '')" for t in ("initial", "unmatched", "final", "excluded", "rare")}
_TERMINAL = f"(SELECT row_id FROM {_IDS['initial']} UNION SELECT row_id FROM {_IDS['excluded']} UNION SELECT row_id FROM {_IDS['rare']})"
_COUNTS = {
    **{m: f"SELECT count(*) FROM {t}" for m, t in {"source_rows": "catalog", "initial_matches_rows": "initial", "unmatched_tracking_rows": "unmatched", "resolved_collections_rows": "resolved", "collection_shorts_rows": "shorts", "collection_constituent_films_rows": "constituents", "final_rows": "final", "excluded_shorts_rows": "excluded", "rare_edge_cases_rows": "rare"}.items()},
    "constituents_with_id": "SELECT count(*) FROM constituents WHERE trim(ref_id) <> ''", "constituents_included": "SELECT count(*) FROM constituents WHERE include",
    "final_rows_missing_valid_id": "SELECT count(*) FROM final WHERE NOT starts_with(trim(ref_id), 'tt')", "final_rows_not_feature": "SELECT count(*) FROM final WHERE signal NOT IN ('', 'feature_or_unknown')",
    "container_single_film_violations": "SELECT count(*) FROM final WHERE source_id IN (SELECT source_id FROM containers) AND via <> 'expanded_collection'",
    "final_unique_row_ids": f"SELECT count(*) FROM {_IDS['final']}", "terminal_status_row_ids": f"SELECT count(*) FROM {_TERMINAL}", "still_unresolved_row_ids": f"SELECT count(*) FROM {_IDS['unmatched']} WHERE row_id NOT IN {_TERMINAL}",
    **{f"disposition_{k}": f"SELECT count(*) FROM dispositions WHERE disposition = '{k}'" for k in ("unresolved", "matched_direct_feature", "collection_unpacked", "excluded_short", "rare_edge_case")},
    "terminal_rows": "SELECT count(*) FROM dispositions WHERE disposition <> 'unresolved'", "coverage_pct": "SELECT round(100.0 * count(*) FILTER (disposition <> 'unresolved') / count(*), 2) FROM dispositions",
}


@query("WITH " + ", ".join(f"{t} AS ({duck(q)})" for t, q in RUN.items()) + " " + " UNION ALL ".join(f"SELECT '{m}' AS metric, ({q})::DOUBLE AS value" for m, q in _COUNTS.items()))
def validation_all_metrics(spark, d):
    return C.validation_metrics({t: frame(spark, d, q) for t, q in RUN.items()})


FINAL = """
SELECT p_partkey % 1900 AS row_id, CASE WHEN p_size % 17 = 0 THEN ' ' ELSE 'tt' || CAST(p_partkey % 1500 AS STRING) END AS ref_id,
  CASE WHEN p_size % 10 = 0 THEN 'Other Content' WHEN p_size % 10 = 1 THEN 'Years Off' WHEN p_size = 42 THEN '' WHEN p_size % 10 = 2 THEN 'Unverified Titles' ELSE 'Years Match' END AS bucket,
  CASE p_type WHEN 'PROMO' THEN 'video' ELSE 'movie' END AS kind, p_size * 4 AS runtime, CASE WHEN p_size = 5 THEN p_name || ' Trilogy' WHEN p_size = 6 THEN 'x / ' || p_name ELSE p_name END AS title,
  1950 + p_size AS year, CASE WHEN p_size = 21 THEN CAST(NULL AS INT) ELSE 1950 END AS start_year, CASE WHEN p_size = 31 THEN CAST(NULL AS BOOLEAN) ELSE true END AS retained, CASE WHEN p_size = 11 THEN '' ELSE 'because' END AS explanation,
  CASE WHEN p_size % 3 = 0 THEN 'merged' ELSE '' END AS provenance, p_size > 40 AS in_review FROM part"""


@query(f"""WITH x AS (SELECT *, bucket IN ('Years Match', 'Years Off') AS verified FROM ({duck(FINAL)}))
SELECT 'package_rows' AS check_name, count(*) AS violations FROM x WHERE verified AND (regexp_matches(lower(title), 'collection|trilogy|anthology|box set') OR contains(title, ' / '))
UNION ALL SELECT 'rows_without_bucket', count(*) FROM x WHERE bucket = '' UNION ALL SELECT 'verified_rows_without_id', count(*) FROM x WHERE verified AND trim(ref_id) = ''
UNION ALL SELECT 'verified_rows_not_feature', count(*) FROM x WHERE verified AND NOT (kind = 'movie' AND runtime > 40)
UNION ALL SELECT 'year_off_rows_unexplained', count(*) FROM x WHERE bucket = 'Years Off' AND (year IS NULL OR start_year IS NULL OR retained IS NULL OR explanation = '')
UNION ALL SELECT 'open_reviews', count(*) FROM x WHERE in_review AND bucket = ''
UNION ALL SELECT 'unexplained_duplicate_ids', count(*) FROM (SELECT ref_id FROM x WHERE verified AND trim(ref_id) <> '' GROUP BY ref_id HAVING count(*) > 1 AND count(*) FILTER (provenance = '') > 0)
UNION ALL SELECT 'rows_in_several_buckets', count(*) FROM (SELECT row_id FROM x GROUP BY row_id HAVING count(DISTINCT bucket) > 1)""")
def quality_all_checks(spark, d):
    return C.quality_checks(frame(spark, d, FINAL))


@query("""SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'contaminated_source_row' WHEN p_size % 5 = 0 THEN 'no_match_found' WHEN p_brand = 'Brand#1' THEN 'metadata_conflict' WHEN p_size % 3 = 0 THEN 'insufficient_metadata' WHEN p_size % 5 > 1 THEN 'multiple_candidates' END AS status FROM part""")
def failure_statuses(spark, d):
    status = C.failure_status(F.col("p_size") % 5, F.col("p_type") == "PROMO", F.col("p_brand") == "Brand#1", F.col("p_size") % 3)
    return table(spark, d, "part").select("p_partkey", status.alias("status"))


@query("SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def required_lookup_rows(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey").join(c.select("o_custkey"), "o_custkey", "left_semi")
    return C.required_lookup(o, c, "o_custkey").select("o_orderkey", "c_name")


@query("SELECT l_orderkey, film_title FROM (SELECT l_orderkey, l_comment_like AS film_title, CASE WHEN l_returnflag = 'A' THEN '' ELSE 's' || l_suppkey END AS sid FROM (SELECT *, 'Film ' || l_partkey AS l_comment_like FROM lineitem)) WHERE sid <> ''")
def rich_collection_rows(spark, d):
    x = table(spark, d, "lineitem").select("l_orderkey", F.concat(F.lit("Film "), F.col("l_partkey").cast("string")).alias("film_title"), F.when(F.col("l_returnflag") == "A", "").otherwise(F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))).alias("collection_source_id"))
    bare = x.select("l_orderkey", "collection_source_id")
    rich = lambda t: C.rich_rows(t, "collection_source_id", ["film_title", "include_in_dataset"])
    return rich(x).select("l_orderkey", "film_title").unionByName(rich(bare).select("l_orderkey", F.lit("").alias("film_title")))


@query("SELECT o_orderkey, o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000) AS skipped FROM orders")
def container_skip_flags(spark, d):
    roots = table(spark, d, "customer").filter("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"), F.lit(True).alias("_root")).distinct()
    return table(spark, d, "orders").select("o_orderkey", "o_custkey").join(roots, "o_custkey", "left").select("o_orderkey", F.coalesce("_root", F.lit(False)).alias("skipped"))
