"""Registered linkage queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catlink.functions import text as T
from catlink.functions.runtime import checkpoint
from catlink.operators import linkage as L
from catlink.plans.registry import query
from catlink.plans.standins import ALTERNATES, CATALOG, CREDITS, PEOPLE, REFERENCE, duck, frame


def sides(spark, d):
    return frame(spark, d, CATALOG), frame(spark, d, REFERENCE), frame(spark, d, ALTERNATES), frame(spark, d, CREDITS), frame(spark, d, PEOPLE)


def scored(spark, d) -> DataFrame:
    c, r, a, k, p = sides(spark, d)
    return L.score_candidates(L.attach_names(L.all_candidates(c, r, a), k, p), c, r)


BASE = f"catalog AS ({duck(CATALOG)}), reference AS ({duck(REFERENCE)}), alternates AS ({duck(ALTERNATES)}), credits AS ({duck(CREDITS)}), people AS ({duck(PEOPLE)})"
KINDS = "('movie', 'short', 'tvMovie', 'video')"


def keys_sql(rel: str, key: str, titles: list[str], prefix: str, where: str = "true") -> str:
    parts = " UNION ALL ".join(f"SELECT {key}, '{prefix}_{how}' AS via, '{how}' AS how, {f(t)} AS k FROM {rel} WHERE {where}" for t in titles for how, f in (("exact", T.exact_sql), ("normalized", T.title_sql)))
    return f"SELECT DISTINCT * FROM ({parts}) WHERE k <> ''"


PAIRS = f"""
ck AS ({keys_sql('catalog', 'row_id', ['title'], 'c')}),
rk AS ({keys_sql('reference', 'ref_id', ['primary_title', 'original_title'], 'title', f'kind IN {KINDS}')} UNION ALL SELECT * FROM ({keys_sql('alternates', 'ref_id', ['title'], 'aka')}) WHERE ref_id IN (SELECT ref_id FROM reference WHERE kind IN {KINDS})),
pairs AS (SELECT row_id, ref_id, list_sort(list(DISTINCT rk.via)) AS via FROM ck JOIN rk USING (how, k) GROUP BY row_id, ref_id)"""

SIGNAL = "CASE WHEN kind = 'short' THEN 'imdb_title_type_short' WHEN list_contains(string_split(genres, ','), 'Short') THEN 'imdb_genre_short' WHEN runtime <= 40 THEN 'runtime_40_or_less' ELSE 'feature_or_unknown' END"
NAMES = "names AS (SELECT ref_id, list(name ORDER BY pos) AS names FROM credits JOIN people USING (person_id) GROUP BY ref_id)"
INSIDE = "len(list_filter(string_split({a}, ' '), lambda t: NOT list_contains(string_split({b}, ' '), t))) = 0"


def close_sql(own: str, names: str) -> str:
    return f"len(list_filter({names}, lambda n: n <> '' AND {own} <> '' AND ({INSIDE.format(a=own, b='n')} OR {INSIDE.format(a='n', b=own)}))) > 0"


SCORED = f"""
nn AS (SELECT ref_id, names, list_transform(names, lambda x: {T.person_sql('x')}) AS people FROM names),
rr AS (SELECT *, {SIGNAL} AS signal, {T.exact_sql('primary_title')} AS e1, {T.exact_sql('original_title')} AS e2, {T.title_sql('primary_title')} AS n1, {T.title_sql('original_title')} AS n2 FROM reference LEFT JOIN nn USING (ref_id)),
cc AS (SELECT *, {T.exact_sql('title')} AS e, {T.title_sql('title')} AS n, {T.person_sql('director')} AS own FROM catalog),
x AS (SELECT row_id, ref_id, via, signal, abs(year - start_year) AS year_difference, e, n, e1, e2, n1, n2, own, kind, coalesce(people, []) AS people, coalesce(names, []) AS names, primary_title, original_title, start_year, runtime, genres, title, director, year
  FROM pairs JOIN cc USING (row_id) JOIN rr USING (ref_id)),
scored AS (SELECT *, (
  CASE WHEN list_contains(via, 'title_exact') OR list_contains(via, 'aka_exact') THEN 40 WHEN list_contains(via, 'title_normalized') OR list_contains(via, 'aka_normalized') THEN 28 ELSE 0 END
  + CASE WHEN e IN (e1, e2) THEN 10 WHEN n IN (n1, n2) THEN 6 ELSE 0 END
  + CASE WHEN year_difference IS NULL THEN 0 WHEN year_difference = 0 THEN 25 WHEN year_difference = 1 THEN 10 WHEN year_difference = 2 THEN 4 ELSE -20 END
  + CASE WHEN {close_sql('own', 'people')} THEN 25 WHEN trim(director) <> '' AND len(names) > 0 THEN -5 ELSE 0 END
  + CASE WHEN kind IN ('movie', 'tvMovie', 'video') THEN 5 ELSE 0 END - CASE WHEN kind = 'short' THEN 20 ELSE 0 END - CASE WHEN signal <> 'feature_or_unknown' THEN 15 ELSE 0 END)::INTEGER AS score FROM x)"""

RANKED = """
ranked AS (SELECT *, row_number() OVER w AS rank, count(*) OVER (PARTITION BY row_id)::INTEGER AS candidates, (score - coalesce(lead(score) OVER w, 0))::INTEGER AS margin FROM scored
  WINDOW w AS (PARTITION BY row_id ORDER BY score DESC, coalesce(year_difference, 0), ref_id))"""

BUCKET = """CASE WHEN score IS NULL THEN 'unmatched'
  WHEN signal <> 'feature_or_unknown' THEN CASE WHEN score >= 50 AND year_difference = 0 AND (candidates = 1 OR margin >= 15) THEN 'exclude_short' ELSE 'review' END
  WHEN score >= 80 AND margin >= 15 THEN 'matched' WHEN score >= 92 THEN 'matched' WHEN score >= 75 AND year_difference = 0 AND (candidates = 1 OR margin >= 15) THEN 'matched' ELSE 'review' END"""

ALL = f"WITH {BASE}, {PAIRS}, {NAMES}, {SCORED}, {RANKED}"
FLAGSHIP = f"{ALL} SELECT c.row_id, c.title, b.ref_id, b.score, b.margin, b.candidates, CAST(b.year_difference AS INTEGER) AS year_difference, b.signal, {BUCKET} AS bucket FROM catalog c LEFT JOIN (SELECT * FROM ranked WHERE rank = 1) b USING (row_id)"


@query(FLAGSHIP)
def link_flagship_buckets(spark, d):
    return L.link(*sides(spark, d))


@query(f"{ALL} SELECT row_id, ref_id, score, CAST(year_difference AS INTEGER) AS year_difference, signal, array_to_string(via, '|') AS via FROM scored")
def link_candidate_scores(spark, d):
    return scored(spark, d).select("row_id", "ref_id", "score", "year_difference", "signal", F.array_join("via", "|").alias("via"))


@query(f"SELECT bucket, count(*) AS n FROM ({FLAGSHIP}) GROUP BY bucket")
def link_bucket_counts(spark, d):
    return L.link(*sides(spark, d)).groupBy("bucket").agg(F.count("*").alias("n"))


@query(f"WITH {BASE}, {PAIRS} SELECT row_id, ref_id, array_to_string(via, '|') AS via FROM pairs WHERE len(list_filter(via, lambda v: starts_with(v, 'aka'))) > 0")
def link_alt_title_candidates(spark, d):
    c, r, a, *_ = sides(spark, d)
    return L.all_candidates(c, r, a).filter(F.exists("via", lambda v: F.startswith(v, F.lit("aka")))).select("row_id", "ref_id", F.array_join("via", "|").alias("via"))


@query(f"{ALL} SELECT row_id, ref_id, rank::INTEGER AS rank, score FROM ranked WHERE rank <= 5")
def link_top5_review(spark, d):
    return L.rank_candidates(scored(spark, d), top=5).select("row_id", "ref_id", "rank", "score")


@query(f"""WITH {BASE}, {PAIRS.replace("'short', ", "'tvMiniSeries', ")},
y AS (SELECT row_id, ref_id, (CASE WHEN list_contains(via, 'title_exact') OR list_contains(via, 'aka_exact') THEN 50 ELSE 0 END + CASE WHEN list_contains(via, 'title_normalized') OR list_contains(via, 'aka_normalized') THEN 25 ELSE 0 END
  + CASE WHEN kind = 'movie' THEN 20 WHEN kind IN ('tvMovie', 'video', 'tvMiniSeries') THEN 10 ELSE 0 END + CASE WHEN start_year IS NOT NULL THEN 5 ELSE 0 END + CASE WHEN runtime >= 41 THEN 10 ELSE 0 END
  - CASE WHEN list_contains(string_split(genres, ','), 'Short') THEN 20 ELSE 0 END)::INTEGER AS score FROM pairs JOIN reference USING (ref_id))
SELECT row_id, ref_id, score FROM y""")
def link_constituent_scores(spark, d):
    c, r, a, *_ = sides(spark, d)
    return L.score_constituents(L.all_candidates(c, r, a, L.CONSTITUENT_KINDS).join(r, "ref_id")).select("row_id", "ref_id", "score")


HINTS = f"""
hk AS (SELECT DISTINCT ref_id, source, k FROM (SELECT ref_id, 'primary' AS source, {T.hint_sql('primary_title')} AS k FROM reference UNION ALL SELECT ref_id, 'original', {T.hint_sql('original_title')} FROM reference UNION ALL SELECT ref_id, 'aka', {T.hint_sql('title')} FROM alternates) WHERE ref_id IN (SELECT ref_id FROM reference WHERE kind <> 'tvSeries')),
hp AS (SELECT row_id, ref_id FROM (SELECT row_id, {T.hint_sql('title')} AS k FROM catalog) JOIN hk USING (k) GROUP BY row_id, ref_id),
hs AS (SELECT row_id, list_sort(list(DISTINCT source)) AS sources, count(DISTINCT ref_id) AS n FROM (SELECT row_id, {T.hint_sql('title')} AS k FROM catalog) JOIN hk USING (k) GROUP BY row_id),
hx AS (SELECT row_id, ref_id, sources, n, kind, start_year, {T.hint_sql('title')} AS k, {T.hint_sql('primary_title')} AS k1, {T.hint_sql('original_title')} AS k2, {T.initials_sql(T.hint_sql('director'))} AS own, list_transform(coalesce(names, []), lambda x: {T.initials_sql(T.hint_sql('x'))}) AS people FROM hp JOIN hs USING (row_id) JOIN catalog USING (row_id) JOIN reference USING (ref_id) LEFT JOIN names USING (ref_id)),
hscored AS (SELECT *, (CASE WHEN k1 = k THEN 50 WHEN k2 = k THEN 44 ELSE 0 END + CASE WHEN list_contains(sources, 'aka') THEN 18 ELSE 0 END + CASE WHEN list_contains(sources, 'primary') OR list_contains(sources, 'original') THEN 12 ELSE 0 END
  + CASE WHEN kind = 'movie' THEN 20 WHEN kind IN ('tvMovie', 'video', 'tvSpecial') THEN 10 WHEN kind = 'short' THEN 4 ELSE 0 END + CASE WHEN own <> '' AND list_contains(people, own) THEN 14 ELSE 0 END + 2)::INTEGER AS score FROM hx)"""


@query(f"""WITH {BASE}, {NAMES}, {HINTS} SELECT row_id, ref_id, score, n AS candidates, CASE WHEN n = 1 AND score >= 70 THEN 'high' WHEN score >= 60 THEN 'medium' ELSE 'low' END AS confidence FROM hscored
QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY score DESC, (kind = 'movie')::INTEGER DESC, start_year DESC, ref_id) = 1""")
def link_hint_scores(spark, d):
    c, r, a, k, p = sides(spark, d)
    allowed = r.filter(F.col("kind").isin(*L.HINT_KINDS))
    # keys are made once and kept: as expressions they would be repeated in every filter and join below
    own, other = L.hint_sides(c, L.attach_names(allowed, k, p))
    own, other = checkpoint(own), checkpoint(other)
    aka = a.join(allowed.select("ref_id"), "ref_id", "left_semi").select("ref_id", F.lit("aka").alias("source"), T.hint_key(F.col("title")).alias("key"))
    keyed = lambda source, key: other.select("ref_id", F.lit(source).alias("source"), F.col(key).alias("key"))
    index = keyed("primary", "_h1").unionByName(keyed("original", "_h2")).unionByName(checkpoint(aka)).filter("key <> ''").distinct()
    hits = own.select("row_id", F.col("_h").alias("key")).filter("key <> ''").join(index, "key")
    group = hits.groupBy("row_id").agg(F.array_sort(F.collect_set("source")).alias("sources"), F.count_distinct("ref_id").alias("candidates"))
    x = hits.select("row_id", "ref_id").distinct().join(group, "row_id").join(own, "row_id").join(other, "ref_id")
    return L.best_hint(L.score_hints(x), "row_id").select("row_id", "ref_id", "score", "candidates", "confidence")


@query(f"WITH {BASE}, {NAMES} SELECT ref_id, array_to_string(coalesce(names, []), ' | ') AS names FROM reference LEFT JOIN names USING (ref_id)")
def link_evidence_names(spark, d):
    _, r, _, k, p = sides(spark, d)
    return L.attach_names(r.select("ref_id"), k, p).select("ref_id", F.array_join("names", " | ").alias("names"))


@query(f"""WITH {BASE}, m AS (SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey), a AS (SELECT c_custkey, {T.person_sql("c_name || ' ' || n_name")} AS a, {T.person_sql("n_name || ' et ' || c_name").replace(' et ', ' ')} AS b0, {T.person_sql('c_name')} AS b FROM m)
SELECT c_custkey, ({INSIDE.format(a='a', b='b')} OR {INSIDE.format(a='b', b='a')}) AS close FROM a""")
def link_evidence_containment(spark, d):
    from catlink.plans.standins import table

    m = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    own, other = F.array(T.normalize_person(F.concat_ws(" ", "c_name", "n_name"))), F.array(T.normalize_person(F.col("c_name")))
    return m.select("c_custkey", T.name_sets_match(own, other).alias("close"))


@query(f"""{ALL}, z AS (SELECT *, {close_sql('own', 'people')} AS d, year = start_year AS y FROM scored), z1 AS (SELECT *, bool_or(d) OVER (PARTITION BY row_id) AS any_d FROM z), z2 AS (SELECT *, bool_or(y) OVER (PARTITION BY row_id) AS any_y FROM z1 WHERE d OR NOT any_d)
SELECT row_id, ref_id, score FROM z2 WHERE y OR NOT any_y QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY score DESC, ref_id) = 1""")
def link_pick_best_narrowing(spark, d):
    return L.pick_best(scored(spark, d), "row_id").select("row_id", "ref_id", "score")


@query(f"""{ALL} SELECT row_id, ref_id, CASE WHEN NOT regexp_matches(lower(title), 'trilogy|anthology|collection|archive|complete|series|:|/') AND n IN (n1, n2) THEN
  CASE WHEN signal <> 'feature_or_unknown' THEN CASE WHEN coalesce(year_difference <= 2, true) THEN 'exclude_short' END
  WHEN (coalesce(year_difference <= 1, false) AND score >= 65) OR (year_difference IS NULL AND score >= 55) THEN 'matched_directly' END END AS action FROM ranked WHERE rank = 1""")
def link_auto_resolve_review(spark, d):
    best = L.rank_candidates(scored(spark, d), top=1)
    return best.select("row_id", "ref_id", L.auto_resolution(F.col("title")).alias("action"))


URL_SQL = f"""
u AS (SELECT page_id, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS a, regexp_extract(html, '(?is)<p[^>]*>(.*?)</p>', 1) AS b, url FROM pages),
v AS (SELECT page_id, {T.page_sql('a')} AS a, {T.page_sql('b')} AS b FROM u),
w AS (SELECT page_id, a, b, list_filter(list_distinct(string_split(a, ' ')), lambda t: t <> '') AS s, list_filter(list_distinct(string_split(b, ' ')), lambda t: t <> '') AS t FROM v),
z AS (SELECT page_id, CASE WHEN len(s) = 0 OR len(t) = 0 THEN 0.0::DOUBLE ELSE len(list_intersect(s, t))::DOUBLE / len(list_distinct(list_concat(s, t))) END + CASE WHEN a = b THEN 0.5 ELSE 0.0 END + CASE WHEN contains(a, b) OR contains(b, a) THEN 0.15 ELSE 0.0 END AS score FROM w)"""


@query(f"WITH {URL_SQL} SELECT page_id, round(score, 6)::DOUBLE AS score, CASE WHEN score >= 1.0 THEN 'exact' WHEN score >= 0.72 THEN 'high' WHEN score >= 0.55 THEN 'medium' ELSE 'weak' END AS confidence FROM z")
def link_url_similarity(spark, d):
    from catlink.plans.standins import table

    h = F.col("html")
    a, b = F.regexp_extract(h, "(?is)<title[^>]*>(.*?)</title>", 1), F.regexp_extract(h, "(?is)<p[^>]*>(.*?)</p>", 1)
    x = table(spark, d, "pages").select("page_id", L.score_url(a, F.lit(None).cast("int"), b, F.lit(None).cast("int"), F.lit("/boxsets/")).alias("s"))
    return x.select("page_id", F.round("s.score", 6).alias("score"), "s.confidence")


@query()
def link_fuzzy_two_pass(spark, d):
    """With alternate titles and directors, which need text ratios; tests compare it with a loop over pairs."""
    return L.fuzzy_two_pass_by_title(*sides(spark, d))


@query(f"SELECT ref_id, {SIGNAL} AS signal FROM ({duck(REFERENCE)})")
def short_classifier(spark, d):
    return frame(spark, d, REFERENCE).select("ref_id", L.short_signal(F.col("kind"), F.col("runtime").cast("string"), F.col("genres")).alias("signal"))


@query(f"""WITH catalog AS ({duck(CATALOG)}), reference AS ({duck(REFERENCE)}), c AS (SELECT row_id, year, {T.title_sql('title')} AS k FROM catalog), r AS (SELECT ref_id, start_year, {T.title_sql('primary_title')} AS k1, {T.title_sql('original_title')} AS k2 FROM reference WHERE kind IN ('movie', 'short', 'tvMovie', 'video')),
p AS (SELECT row_id, ref_id, abs(year - start_year) AS gap FROM c JOIN r ON k <> '' AND (k = k1 OR k = k2)), s AS (SELECT *, 100.0::DOUBLE - CASE gap WHEN 0 THEN 0 WHEN 1 THEN 6 WHEN 2 THEN 18 ELSE 35 END AS score FROM p),
o AS (SELECT *, row_number() OVER w AS n, score - coalesce(lead(score) OVER w, -999) AS ahead FROM s WHERE gap <= 2 WINDOW w AS (PARTITION BY row_id ORDER BY score DESC, ref_id)),
t AS (SELECT * FROM s WHERE gap <= 5 QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY score DESC, ref_id) = 1),
a AS (SELECT row_id, o.ref_id AS ref1, o.score AS s1, coalesce(o.score >= 88 AND o.ahead >= 6, false) AS first, t.ref_id AS ref2, t.score AS s2, coalesce(t.score >= 92, false) AS second, row_id IN (SELECT row_id FROM p) AS found FROM catalog LEFT JOIN (SELECT * FROM o WHERE n = 1) o USING (row_id) LEFT JOIN t USING (row_id))
SELECT row_id, CASE WHEN first THEN ref1 WHEN second THEN ref2 END AS ref_id, CASE WHEN first THEN s1 WHEN second THEN s2 END AS score, CASE WHEN first THEN 'auto' WHEN second THEN 'second_pass' END AS method,
  CASE WHEN first OR second THEN NULL WHEN NOT found THEN 'no title candidates' WHEN ref1 IS NULL THEN 'year window removed all' ELSE 'ambiguous_or_low_confidence' END AS reason FROM a""")
def link_fuzzy_by_titles(spark, d):
    """Candidates by own titles and no directors: every ratio is 100, so SQL can tell the passes and reasons."""
    c, r, *_ = sides(spark, d)
    c = c.withColumn("director", F.lit(""))
    pairs = L.title_candidates(c, r).select("row_id", "ref_id").distinct().withColumn("name_keys", F.array().cast("array<string>"))
    return L.fuzzy_two_pass(pairs, c, r)


@query(f"""{ALL}, best AS (SELECT *, {BUCKET} AS bucket FROM ranked WHERE rank = 1 AND row_id % 7 <> 0), reviewed AS (SELECT r.row_id, r.ref_id FROM ranked r JOIN best b USING (row_id) WHERE b.bucket = 'review' AND r.rank <= 5)
SELECT 'matched' AS outcome, row_id, ref_id, '' AS note FROM best WHERE bucket = 'matched' UNION ALL SELECT 'exclude_short', row_id, ref_id, '' FROM best WHERE bucket = 'exclude_short'
UNION ALL SELECT 'review', row_id, ref_id, '' FROM reviewed UNION ALL SELECT 'unmatched', row_id, NULL, CASE WHEN row_id % 7 = 0 THEN 'collection_container_skipped' ELSE '' END FROM catalog WHERE row_id NOT IN (SELECT row_id FROM best)""")
def initial_matches_outputs(spark, d):
    """The four outputs of one pass; every seventh row stands for a collection."""
    from catlink.plans import pipelines

    c, r, a, k, p = sides(spark, d)
    out = pipelines.initial_matches(c, r, a, k, p, containers=c.filter("row_id % 7 = 0"))
    rows = lambda n: out[n].select(F.lit(n).alias("outcome"), "row_id", F.col("ref_id") if "ref_id" in out[n].columns else F.lit(None).cast("long").alias("ref_id"), F.col("note") if "note" in out[n].columns else F.lit("").alias("note"))
    return rows("matched").unionByName(rows("exclude_short")).unionByName(rows("review")).unionByName(rows("unmatched"))


NAMED = """
SELECT 'Set ' || CAST(p_size AS STRING) AS collection, CASE WHEN p_size % 10 = 0 THEN 'needs_manual_decomposition' ELSE 'slash_split' END AS method, p_size AS size, p_name AS title, min(p_partkey) AS o FROM part WHERE p_partkey % 5 = 0 GROUP BY p_size, p_name"""


@query(f"""WITH {BASE}, n AS ({duck(NAMED)}), f AS (SELECT collection, method, title, row_number() OVER (PARTITION BY collection ORDER BY o) AS seq FROM n WHERE size % 10 <> 0),
u AS (SELECT collection, method, title, seq FROM f UNION ALL SELECT DISTINCT collection, method, 'No Such Film At All', 99 FROM f WHERE collection = 'Set 11'),
catalog2 AS (SELECT DISTINCT title AS row_id, title FROM u), {PAIRS.replace("'short', ", "'tvMiniSeries', ").replace("FROM catalog ", "FROM catalog2 ")},
y AS (SELECT row_id AS title, ref_id, kind, (CASE WHEN list_contains(via, 'title_exact') OR list_contains(via, 'aka_exact') THEN 50 ELSE 0 END + CASE WHEN list_contains(via, 'title_normalized') OR list_contains(via, 'aka_normalized') THEN 25 ELSE 0 END
  + CASE WHEN kind = 'movie' THEN 20 WHEN kind IN ('tvMovie', 'video', 'tvMiniSeries') THEN 10 ELSE 0 END + CASE WHEN start_year IS NOT NULL THEN 5 ELSE 0 END + CASE WHEN runtime >= 41 THEN 10 ELSE 0 END
  - CASE WHEN list_contains(string_split(genres, ','), 'Short') THEN 20 ELSE 0 END)::INTEGER AS score FROM pairs JOIN reference USING (ref_id)),
z AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY score DESC, ref_id) AS rank FROM y)
SELECT 'best' AS output, collection, CASE WHEN seq = 99 THEN (SELECT count(*) + 1 FROM f g WHERE g.collection = u.collection) ELSE seq END::VARCHAR AS seq, u.title, coalesce(ref_id::VARCHAR, '') AS ref_id, coalesce(score::VARCHAR, '') AS score, CASE WHEN ref_id IS NULL THEN 'no_match_found' ELSE 'matched' END AS status FROM u LEFT JOIN (SELECT * FROM z WHERE rank = 1) b ON u.title = b.title
UNION ALL SELECT DISTINCT 'best', collection, '', '', '', '', 'no_constituent_titles_extracted' FROM n WHERE size % 10 = 0
UNION ALL SELECT 'review', collection, seq::VARCHAR, u.title, ref_id::VARCHAR, score::VARCHAR, rank::VARCHAR FROM u JOIN z ON u.title = z.title WHERE rank <= 10""")
def lookup_single_collections(spark, d):
    n = frame(spark, d, NAMED)
    listed = n.groupBy("collection", "method", "size").agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "title"))), lambda x: x["title"]).alias("t"))
    more = F.when(F.col("collection") == "Set 11", F.concat("t", F.array(F.lit("No Such Film At All")))).otherwise(F.col("t"))
    one = listed.select("collection", "method", F.when(F.col("size") % 10 == 0, F.array().cast("array<string>")).otherwise(more).alias("titles"))
    _, r, a, *_ = sides(spark, d)
    out = L.lookup_collections(one, r, a, "2001-02-03T04:05:06+00:00")
    text = lambda x, last: x.select("collection", F.col("seq").cast("string").alias("seq"), "title", F.col("ref_id").cast("string").alias("ref_id"), F.col("score").cast("string").alias("score"), F.col(last).cast("string").alias("status"))
    return text(out["best"], "status").withColumn("output", F.lit("best")).unionByName(text(out["review"], "rank").withColumn("output", F.lit("review")))


VOTED = "SELECT l_orderkey AS k, l_linenumber AS seq, CASE WHEN l_returnflag = 'A' AND l_orderkey % 3 = 0 THEN CAST(l_suppkey % 4 AS STRING) || ' Lee' ELSE '' END AS film_director, l_suppkey AS supp, l_partkey AS part FROM lineitem"


@query(f"""WITH v AS ({duck(VOTED)}), e AS (SELECT k, film_director AS n, count(*) AS c, min(seq) AS o FROM v WHERE film_director <> '' GROUP BY ALL), e1 AS (SELECT k, n FROM e QUALIFY row_number() OVER (PARTITION BY k ORDER BY c DESC, o, n) = 1),
h AS (SELECT o_orderkey AS k, o_clerk FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Boss ' || o_custkey ELSE ' ' END AS o_clerk FROM orders)),
g AS (SELECT k, 'S' || supp AS n, count(*) AS c, min(seq * 1000000 + part) AS o FROM v GROUP BY ALL), g1 AS (SELECT k, n FROM g QUALIFY row_number() OVER (PARTITION BY k ORDER BY c DESC, o, n) = 1)
SELECT k::VARCHAR AS source_id, coalesce(e1.n, nullif(trim(o_clerk), ''), g1.n, '') AS director FROM (SELECT DISTINCT k FROM v) LEFT JOIN e1 USING (k) LEFT JOIN h USING (k) LEFT JOIN g1 USING (k)""")
def group_director_votes(spark, d):
    from catlink.plans import pipelines
    from catlink.plans.standins import table

    v = frame(spark, d, VOTED).withColumn("source_id", F.col("k").cast("string"))
    boss = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("source_id"), F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("Boss "), F.col("o_custkey").cast("string"))).otherwise(" ").alias("director"))
    named = v.select("source_id", (F.col("seq").cast("long") * 1000000 + F.col("part")).alias("ord"), F.concat(F.lit("S"), F.col("supp").cast("string")).alias("name"))
    return pipelines.group_directors(v.select("source_id", "seq", "film_director"), boss, named)


@query()
def expand_collection_films(spark, d):
    """Constituents of a shelf with their best matches; compared by its parts elsewhere."""
    from catlink.plans import pipelines
    from catlink.plans.text_queries import KNOWN, SHELF

    x = frame(spark, d, SHELF).withColumn("source_id", F.when(F.col("spine").rlike("^[0-9]+$"), F.col("spine")).otherwise(F.concat(F.lit("row_"), F.col("idx").cast("string"))))
    _, r, a, k, p = sides(spark, d)
    none = spark.createDataFrame([], "collection_id string, seq string, film_title string, film_director string, film_year string, film_source_id string, imdb_id string, is_short string, notes string, ord int")
    return pipelines.expand_collections(x, KNOWN, none, r, a, k, p)["films"].select("idx", "seq", "film_title", "ref_id", "is_short", "notes")
