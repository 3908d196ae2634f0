"""Registered queries against their SQL on small tables of odd rows."""

import duckdb

from catlink.plans import registry, source_queries, text_queries  # noqa: F401  register their queries
from tests.parity import compare


def tables(folder, **sql):
    """(folder, connection): each table written as a file there and seen by the connection."""
    con = duckdb.connect()
    for name, rows in sql.items():
        con.execute(f"COPY ({rows}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return str(folder), con


def check(spark, name, folder, con):
    compare(con, registry.QUERIES[name](spark, folder), registry.SQL[name])


def test_halves_are_rounded_as_the_cast_does(spark, tmp_path):
    values = "(1, 0.5), (2, 1.5), (3, 9052.5), (4, 9053.5), (5, 2.49), (6, -0.5), (7, NULL), (8, 0.0)"
    folder, con = tables(tmp_path, supplier=f"SELECT k::BIGINT AS s_suppkey, a::DOUBLE AS s_acctbal FROM (VALUES {values}) AS v(k, a)")
    check(spark, "null_to_blank", folder, con)


def test_notes_of_long_keys(spark, tmp_path):
    folder, con = tables(tmp_path, part="SELECT k::BIGINT AS p_partkey, 'Brand#1' AS p_brand, (k % 50 + 1)::INTEGER AS p_size FROM (VALUES (7), (99999), (100000), (1200000), (123456)) AS v(k)")
    check(spark, "override_notes", folder, con)


def plan_of(df):
    return df._jdf.queryExecution().analyzed().toString()


def test_a_page_is_resolved_once_for_all_its_groups(spark):
    from catlink.operators import pages as P

    pages = spark.createDataFrame([(1, "x")], "page_id long, html string")
    assert plan_of(P.product_seeds(pages)).count("[^\\t\\n") <= 24


def test_sections_are_found_once(spark):
    from catlink.operators import pages as P

    pages = spark.createDataFrame([(1, "<h2>Films in this set</h2><li>A: 1950</li><li></li><li>Newsletter</li><li>B: 1951</li><h2>x</h2><h3>films in this set</h3><p>B: 1951</p><p>A: 1950</p>")], "page_id long, html string")
    blocks = P.film_section_blocks(pages)
    assert "Join" not in plan_of(blocks)
    assert [(r.seq, r.block) for r in blocks.orderBy("seq").collect()] == [(1, "A: 1950"), (2, "B: 1951")]


def test_picks_by_title_are_those_of_each_row(spark):
    import random

    from catlink.operators import linkage as L

    random.seed(3)
    titles, names = ["t1", "t2", "t3"], ["ann lee", "bob ray", "cy fox"]
    scored = [(t, n, random.choice([None, "1950", "1951"]), random.choice([70, 80]), random.sample(names, random.randint(0, 2))) for t in titles for n in range(6)]
    wanted = [(k, random.choice([*titles, "t9"]), random.choice(["", "Ann Lee", "Bob Ray", "Di Poe"]), random.choice(["", "1950", "1951"])) for k in range(60)]
    s = spark.createDataFrame(scored, "row_id string, ref_id int, start_year string, score int, name_keys array<string>")
    w = spark.createDataFrame(wanted, "k int, title string, want string, year string")
    each = L.pick_best(s.withColumnRenamed("row_id", "title").join(w, "title"), "k", "want", "year").select("k", "ref_id", "score")
    by_title = w.join(L.pick_best_by_title(s, w.select("title", "want", "year")), ["title", "want", "year"]).select("k", "ref_id", "score")
    assert sorted(map(tuple, by_title.collect())) == sorted(map(tuple, each.collect()))


def test_pairs_of_shared_neighbours_are_not_joined_again(spark):
    from catlink.operators import networks as N

    found = N.shared_jaccard(spark.createDataFrame([("a", "h"), ("b", "h"), ("b", "g")], "src string, dst string"))
    assert plan_of(found).index("Aggregate") < plan_of(found).index("Join")
    assert sorted(map(tuple, found.collect())) == [("a", "b", 0.5), ("g", "h", 0.5)]


def test_pages_cut_inside_an_entity_are_read_as_the_reference_reads_them(spark, tmp_path):
    import html
    import re

    titles = ["a &amp;&amp", "b &lt", "c &amp;&am", "d &notit; &copy x", "e&nbsp", "f &#38 &#x26 g", "&amp;lt;b&amp;gt;"]
    folder, _ = tables(tmp_path, pages="SELECT k::BIGINT AS page_id, h AS html FROM (VALUES " + ", ".join(f"({i}, '<title>{t}</title><h1>{t}</h1>')" for i, t in enumerate(titles)) + ") AS v(k, h)")
    text = lambda x: re.sub(r"\s+", " ", re.sub("<[^>]+>", " ", html.unescape(x))).strip()
    got = {r.page_id: (r.title, r.heading) for r in registry.QUERIES["html_titles_links"](spark, folder).collect()}
    assert got == {i: (text(t),) * 2 for i, t in enumerate(titles)}
    got = {r.page_id: r.text for r in registry.QUERIES["html_strip_tags"](spark, folder).collect()}
    assert got == {i: text(f"<title>{t}</title><h1>{t}</h1>") for i, t in enumerate(titles)}
