"""Registered queries of text, parsing, pages and groups, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from catlink.functions import text as T
from catlink.operators import groups as G
from catlink.operators import pages as P
from catlink.plans.registry import query
from catlink.plans.standins import LINES, LINES_SQL, frame, table
from catlink.sources import tables as S

L = f"l AS ({LINES_SQL})"


def lines(spark, d):
    return frame(spark, d, LINES)


@query(f"WITH {L} SELECT doc_id, {T.title_sql('title')} AS key FROM l")
def norm_title_documents(spark, d):
    return lines(spark, d).select("doc_id", T.normalize_title(F.col("title")).alias("key"))


@query(f"WITH {L} SELECT doc_id, {T.person_sql('title')} AS key FROM l")
def norm_person_tokens(spark, d):
    return lines(spark, d).select("doc_id", T.normalize_person(F.col("title")).alias("key"))


@query(f"WITH {L} SELECT doc_id, {T.reanchor_sql('title')} AS key, {T.reanchor_title_sql('title')} AS title_key FROM l")
def norm_reanchor_key(spark, d):
    return lines(spark, d).select("doc_id", T.reanchor_key(F.col("title")).alias("key"), T.reanchor_title(F.col("title")).alias("title_key"))


@query(f"WITH {L} SELECT doc_id, {T.hint_sql('title')} AS key FROM l")
def norm_hint_variant(spark, d):
    return lines(spark, d).select("doc_id", T.hint_key(F.col("title")).alias("key"))


@query(f"WITH {L} SELECT doc_id, {T.page_sql('title')} AS key FROM l")
def norm_scrape_variant(spark, d):
    return lines(spark, d).select("doc_id", T.page_key(F.col("title")).alias("key"))


@query(f"WITH {L} SELECT doc_id, array_to_string({T.names_sql('title')}, '|') AS names, len({T.names_sql('title')})::INTEGER AS n FROM l")
def split_directors(spark, d):
    names = T.split_names(F.col("title"))
    return lines(spark, d).select("doc_id", F.array_join(names, "|").alias("names"), F.size(names).alias("n"))


#: Titles of containers, made from part names and brands in the shapes that are split.
BOXES = """
SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN p_name || ' / ' || p_brand WHEN 1 THEN p_name || '/' || p_brand || ' / x: two films'
  WHEN 2 THEN p_name || ' Trilogy: ' || p_brand || ', ' || p_type || ', ' || p_name WHEN 3 THEN p_name || ' / ' || p_type || ': box' ELSE p_name || ': ' || p_brand END AS title
FROM part"""
TRIMMED = "list_filter(list_transform({}, lambda p: trim(p, ' ,')), lambda p: p <> '')"
SLASHES = "list_filter(list_transform(regexp_split_to_array({}, '\\s*/\\s*'), lambda p: trim(p)), lambda p: p <> '')"


@query(f"""WITH b AS ({BOXES}), c AS (SELECT p_partkey, title, trim(split_part(title, ':', 1)) AS l, trim(regexp_replace(title, '^[^:]*:', '')) AS r FROM b),
x AS (SELECT *, {TRIMMED.format("string_split(r, ',')")} AS many FROM c),
y AS (SELECT p_partkey, CASE WHEN contains(title, ' / ') THEN {SLASHES.format('title')} WHEN contains(title, ':') AND contains(l, ' / ') THEN {SLASHES.format('l')}
  WHEN contains(title, ':') AND contains(r, ',') AND (regexp_matches(lower(r), 'trilogy|two films|three films|five films') OR len(many) > 1) THEN many ELSE [] END AS t,
  CASE WHEN contains(title, ' / ') THEN 'slash_split' WHEN contains(title, ':') AND contains(l, ' / ') THEN 'colon_left_slash_split'
  WHEN contains(title, ':') AND contains(r, ',') AND (regexp_matches(lower(r), 'trilogy|two films|three films|five films') OR len(many) > 1) THEN 'colon_right_comma_split' ELSE 'needs_manual_decomposition' END AS method FROM x)
SELECT p_partkey, array_to_string(t, '|') AS titles, method FROM y""")
def split_constituents(spark, d):
    x = frame(spark, d, BOXES).select("p_partkey", G.split_constituents(F.col("title")).alias("s"))
    return x.select("p_partkey", F.array_join("s.titles", "|").alias("titles"), "s.method")


PARTS = TRIMMED.format("string_split(title, ',')").replace("' ,'", "' '")


@query(f"""WITH {L}, p AS (SELECT doc_id, {PARTS} AS a FROM l), s AS (SELECT doc_id, a, unnest(range(1, len(a) + 1)) AS start FROM p), w AS (SELECT doc_id, a, start, unnest(range(1, least(4, len(a) - start + 1) + 1)) AS width FROM s)
SELECT doc_id, start::INTEGER AS start, width::INTEGER AS width, array_to_string(a[start:start + width - 1], ', ') AS text FROM w""")
def split_fragments_ngrams(spark, d):
    x = lines(spark, d).select("doc_id", F.explode(G.ngrams(G.T_parts(F.col("title")))).alias("g"))
    return x.select("doc_id", "g.start", "g.width", "g.text")


@query()
def fragment_greedy_merge(spark, d):
    rows = lines(spark, d)
    known = rows.select(F.explode(G.ngrams(G.T_parts(F.col("title")), 2)).alias("g")).filter("g.width = 2").select(T.hint_key(F.col("g.text")).alias("key"))
    return G.merge_fragments(rows, "doc_id", "title", known.distinct()).select("doc_id", F.array_join("titles", "|").alias("titles"))


@query("""SELECT event_id, CASE WHEN regexp_full_match(trim(v), '[+-]?[0-9]{1,9}') THEN try_cast(trim(v) AS INTEGER) END AS year
FROM (SELECT event_id, CASE event_type WHEN 'view' THEN regexp_extract(props, '([0-9]+)', 1) WHEN 'click' THEN ' ' || regexp_extract(props, '([0-9]+)', 1) || ' ' WHEN 'error' THEN '\\N' ELSE value::VARCHAR END AS v FROM events)""")
def parse_year_strict(spark, d):
    number = F.regexp_extract("props", "([0-9]+)", 1)
    v = F.when(F.col("event_type") == "view", number).when(F.col("event_type") == "click", F.concat(F.lit(" "), number, F.lit(" "))).when(F.col("event_type") == "error", "\\N").otherwise(F.col("value").cast("string"))
    return table(spark, d, "events").select("event_id", T.strict_int(v).alias("year"))


@query("""SELECT event_id, CASE event_type WHEN 'error' THEN NULL ELSE trunc(value)::INTEGER END AS n FROM events""")
def parse_int_lenient(spark, d):
    v = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    return table(spark, d, "events").select("event_id", T.lenient_int(v).alias("n"))


@query("SELECT event_id, try_cast(nullif(regexp_extract('Eclipse  Series ' || regexp_extract(props, '([0-9]+)', 1) || CASE event_type WHEN 'view' THEN ': x' ELSE '' END, '(?i)Eclipse Series\\s+(\\d+):|(?i)Eclipse\\s+Series\\s+(\\d+):', 2), '') AS INTEGER) AS number FROM events")
def extract_series_number(spark, d):
    title = F.concat(F.lit("Eclipse Series "), F.regexp_extract("props", "([0-9]+)", 1), F.when(F.col("event_type") == "view", ": x").otherwise(""))
    return table(spark, d, "events").select("event_id", T.series_number(title, P.SERIES_TITLE).alias("number"))


DATED = "SELECT o_orderkey, o_orderpriority || CASE o_orderstatus WHEN 'F' THEN ': ' WHEN 'O' THEN ' (' ELSE ' no' END || {} || ' cut' AS text FROM orders"


@query(f"""WITH t AS ({DATED.format("CAST(year(o_orderdate) AS VARCHAR)")}) SELECT o_orderkey, CASE WHEN regexp_matches(text, '\\b(18|19|20)[0-9]{{2}}\\b') THEN nullif(trim(regexp_extract(text, '^(.*?)\\b(?:18|19|20)[0-9]{{2}}\\b', 1), ' :-'), '') END AS title,
CASE WHEN regexp_matches(text, '\\b(18|19|20)[0-9]{{2}}\\b') THEN regexp_extract(text, '\\b((18|19|20)[0-9]{{2}})\\b', 1)::INTEGER END AS year FROM t""")
def extract_title_year(spark, d):
    x = frame(spark, d, DATED.format("CAST(year(o_orderdate) AS STRING)"))
    return x.select("o_orderkey", T.title_and_year(F.col("text")).alias("f")).select("o_orderkey", "f.title", "f.year")


BROWSE = "SELECT c_custkey AS spine, '  ' || c_name || ' ' AS title, c_mktsegment || CASE c_nationkey % 2 WHEN 0 THEN ', ,' ELSE '' END AS country FROM customer"


@query(f"SELECT spine AS spine_number, trim(title) AS title, trim(regexp_replace(trim(country), ',+$', '')) AS country FROM ({BROWSE})")
def clean_browse_fields(spark, d):
    x = S.clean_fields(frame(spark, d, BROWSE))
    return x.select(F.col("spine").alias("spine_number"), "title", "country")


@query("""SELECT page_id, trim(regexp_replace(translate(regexp_replace(%s, '<[^>]+>', ' ', 'g'), ' ', ' '), '\\s+', ' ', 'g')) AS title,
trim(regexp_replace(translate(regexp_replace(%s, '<[^>]+>', ' ', 'g'), ' ', ' '), '\\s+', ' ', 'g')) AS heading,
len(regexp_extract_all(html, '(?i)<a[^>]+href="([^"]+)"', 1))::INTEGER AS links, coalesce(regexp_extract_all(html, '(?i)<a[^>]+href="([^"]+)"', 1)[1], '') AS first_link FROM pages"""
    % (T.entities_sql("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"), T.entities_sql("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")))
def html_titles_links(spark, d):
    return P.titles_and_links(table(spark, d, "pages"))


@query(f"SELECT page_id, {T.strip_tags_sql('html')} AS text FROM pages")
def html_strip_tags(spark, d):
    return table(spark, d, "pages").select("page_id", T.strip_tags(F.col("html")).alias("text"))


FILMS = "SELECT l_orderkey AS page_id, l_linenumber AS seq, p_name || CASE l_returnflag WHEN 'A' THEN '!' ELSE '' END AS title, 1950 + p_size AS year, l_partkey, l_suppkey, l_quantity FROM lineitem JOIN part ON l_partkey = p_partkey"


@query(f"""WITH f AS ({FILMS}), n AS (SELECT page_id, title, year, row_number() OVER (PARTITION BY page_id ORDER BY seq, l_partkey, l_suppkey, l_quantity, title) AS s FROM f),
u AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY page_id, {T.page_sql('title')}, year ORDER BY s) = 1)
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY s)::INTEGER AS seq, {T.page_sql('title')} AS key, year FROM u""")
def html_movie_dedupe(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("page_id").orderBy("seq", "l_partkey", "l_suppkey", "l_quantity", "title")
    x = frame(spark, d, FILMS).withColumn("seq", F.row_number().over(w))
    return P.dedupe_films(x).select("page_id", "seq", T.page_key(F.col("title")).alias("key"), "year")


@query()
def html_section_blocks(spark, d):
    return P.text_blocks(table(spark, d, "pages"))


@query()
def html_film_lists(spark, d):
    return P.film_list(P.text_blocks(table(spark, d, "pages")))


@query(f"""WITH {L} SELECT doc_id, regexp_matches(lower(title), '{"|".join(G.CONTAINER_HINTS)}') OR ((lang = 'en' OR source = 'src1') AND regexp_matches(title, '[/:]')) AS likely FROM l JOIN documents USING (doc_id)""")
def collection_hint_predicate(spark, d):
    x = lines(spark, d).join(table(spark, d, "documents").select("doc_id", "lang", "source"), "doc_id")
    director, year = F.when(F.col("lang") == "en", "").otherwise("x"), F.when(F.col("source") == "src1", F.lit(None)).otherwise("1999")
    return x.select("doc_id", G.is_likely_collection(F.col("title"), director, year).alias("likely"))


GENERIC = ", ".join(f"'{t}'" for t in G.GENERIC_TITLES)


@query(f"""WITH g AS (SELECT p_partkey, CASE WHEN p_size = 7 THEN 'Volume One' WHEN p_size = 9 THEN 'An  Anthology' ELSE p_name END AS title, CASE p_brand WHEN 'Brand#1' THEN 'partial' WHEN 'Brand#2' THEN 'partial' ELSE 'resolved' END AS status, CASE WHEN p_brand = 'Brand#1' THEN ['red bolt', 'old bolt'] END AS trusted FROM part), k AS (SELECT *, {T.title_sql('title')} AS key FROM g)
SELECT p_partkey, CASE WHEN key IN ({GENERIC}) THEN 'generic_title' WHEN status = 'partial' AND trusted IS NULL THEN 'partial_without_trusted_titles' WHEN status = 'partial' AND NOT list_contains(trusted, key) THEN 'not_a_trusted_title' END AS reason FROM k""")
def generic_title_guard(spark, d):
    from catlink.operators.curation import guard_item

    title = F.when(F.col("p_size") == 7, "Volume One").when(F.col("p_size") == 9, "An  Anthology").otherwise(F.col("p_name"))
    status = F.when(F.col("p_brand").isin("Brand#1", "Brand#2"), "partial").otherwise("resolved")
    trusted = F.when(F.col("p_brand") == "Brand#1", F.array(F.lit("red bolt"), F.lit("old bolt")))
    return table(spark, d, "part").select("p_partkey", guard_item(T.normalize_title(title), status, trusted).alias("reason"))


#: A catalog of boxes and films in order: orders are boxes where their status is F, their lines' parts follow.
SHELF = """
SELECT o_orderkey * 100 AS idx, CASE o_orderstatus WHEN 'F' THEN '' ELSE CAST(o_orderkey AS STRING) END AS spine, CASE o_orderstatus WHEN 'O' THEN 'The Red Trilogy' WHEN 'F' THEN 'Box ' || o_orderpriority || ': complete' ELSE 'red bolt / old bolt' END AS title,
  CASE o_orderstatus WHEN 'O' THEN CASE o_orderpriority WHEN '1-URGENT' THEN 'Ann Lee' ELSE '' END ELSE '' END AS director, CAST('' AS STRING) AS year FROM orders
UNION ALL SELECT idx, CASE o_orderstatus WHEN 'F' THEN '' ELSE CAST(o_orderkey AS STRING) || CAST(idx AS STRING) END, p_name, 'Director ' || p_brand, CAST(1950 + p_size AS STRING)
FROM (SELECT l_orderkey * 100 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS idx, l_orderkey, l_partkey FROM lineitem) JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey"""
KNOWN = {"The Red Trilogy": ["Red Bolt", "Red Widget", "Red Gear"]}


def _shelf_sql() -> str:
    shelf = SHELF.replace("AS STRING", "AS VARCHAR")
    hints = "|".join(G.CONTAINER_HINTS)
    slashes = SLASHES.format("title")
    return f"""WITH raw AS MATERIALIZED (SELECT * FROM ({shelf})),
keys AS MATERIALIZED (SELECT title, {T.title_sql('title')} AS k FROM (SELECT DISTINCT title FROM raw)),
x AS MATERIALIZED (SELECT raw.*, k, CASE WHEN regexp_full_match(spine, '[0-9]+') THEN spine ELSE 'row_' || idx END AS source_id, spine = '' AS bare, regexp_full_match(spine, '[0-9]+') AS numbered, director <> '' AS led,
  regexp_matches(lower(title), '{hints}') OR ((director = '' OR year = '') AND regexp_matches(title, '[/:]')) OR k = 'red trilogy' AS container,
  CASE WHEN k = 'red trilogy' THEN ['Red Bolt', 'Red Widget', 'Red Gear'] WHEN contains(title, ' / ') THEN {slashes} ELSE []::VARCHAR[] END AS expected,
  CASE WHEN k = 'red trilogy' THEN 'known_collection_map' WHEN contains(title, ' / ') THEN 'slash_split' ELSE 'needs_manual_decomposition' END AS method FROM raw JOIN keys USING (title)),
b AS MATERIALIZED (SELECT idx, bare, led, container, sum((NOT bare OR NOT led)::INTEGER) OVER (ORDER BY idx) AS block FROM x),
m1 AS MATERIALIZED (SELECT h.idx AS g, n FROM b h JOIN (SELECT block, count(*) AS n FROM b WHERE bare AND led GROUP BY block) r USING (block) WHERE h.bare AND NOT h.led AND h.container),
w AS MATERIALIZED (SELECT idx AS g, unnest(range(1, len(expected) + 1)) AS p, unnest(expected) AS want FROM x WHERE numbered AND NOT led AND container AND len(expected) > 0),
wk AS MATERIALIZED (SELECT want, {T.title_sql('want')} AS wk FROM (SELECT DISTINCT want FROM w)),
t AS MATERIALIZED (SELECT g, p, coalesce(r.numbered AND r.led AND (r.k = wk OR contains(r.k, wk) OR contains(wk, r.k)), false) AS ok, r.idx FROM w JOIN wk USING (want) LEFT JOIN x r ON r.idx = g + p),
miss AS MATERIALIZED (SELECT g, min(p) FILTER (NOT ok) AS broken FROM t GROUP BY g),
taken AS MATERIALIZED (SELECT g, idx FROM t JOIN miss USING (g) WHERE broken IS NULL OR p < broken),
c AS MATERIALIZED (SELECT g, n FROM m1 UNION ALL SELECT g, count(*) FROM taken GROUP BY g),
heads AS (SELECT x.*, coalesce(n, 0) AS n FROM x LEFT JOIN c ON c.g = x.idx WHERE container AND ((bare AND NOT led AND (coalesce(n, 0) > 0 OR len(expected) > 0)) OR (numbered AND NOT led AND len(expected) > 0)
  OR (numbered AND led AND len(expected) > 0 AND NOT EXISTS (SELECT 1 FROM taken u WHERE u.idx = x.idx))))
SELECT h.idx, CASE WHEN h.bare THEN 'spineless' ELSE 'spined' END AS kind,
  CASE WHEN h.bare AND len(expected) = 0 THEN 'spineless_catalog_children' ELSE h.method || CASE WHEN h.led THEN '+single_row_box' WHEN h.bare THEN CASE WHEN n = len(expected) THEN '+spineless_block' WHEN n > 0 THEN '+spineless_partial' ELSE '+spineless_no_children' END
    ELSE CASE WHEN n = len(expected) THEN '+following_spines' WHEN n > 0 THEN '+following_spines_partial' ELSE '+virtual_only' END END END AS method,
  (CASE WHEN n > 0 THEN n ELSE len(expected) END)::BIGINT AS films FROM heads h"""


@query(_shelf_sql())
def group_discovery_islands(spark, d):
    x = frame(spark, d, SHELF).withColumn("source_id", F.when(F.col("spine").rlike("^[0-9]+$"), F.col("spine")).otherwise(F.concat(F.lit("row_"), F.col("idx").cast("string"))))
    found = G.discover_groups(x, KNOWN)
    return found.groupBy("idx", "kind", "method").agg(F.count("*").alias("films"))
