import pytest
from pyspark.sql import functions as F

from catlink.operators import curation as C
from catlink.operators import pages as P
from catlink.sources import tables as S


@pytest.mark.parametrize(
    ("row", "want"),
    [
        ((True, True, True, "x", "include", "resolved"), ("rare_edge_case", "listed_in_rare_edge_cases")), ((False, True, True, "x", "include", "resolved"), ("excluded_short", "listed_in_excluded_shorts")),
        ((False, False, True, "expanded_collection", None, None), ("collection_unpacked", "final_via_expanded_collection")), ((False, False, True, "", None, None), ("matched_direct_feature", "final_matched_via=unknown")),
        ((False, False, True, None, "Collection ", None), ("collection_unpacked", "manual_resolution_collection")), ((False, False, False, None, "include", None), ("matched_direct_feature", "manual_resolution_pending_build_final")),
        ((False, False, False, None, "exclude_as_short", None), ("excluded_short", "manual_resolution_exclude_short")), ((False, False, False, None, "flag_edge_case", None), ("rare_edge_case", "manual_resolution_rare_edge")),
        ((False, False, True, None, "no_imdb_entry", "resolved"), ("unresolved", "no_imdb_entry")), ((False, False, True, None, None, "resolved"), ("collection_unpacked", "collection_container_expand_resolved")),
        ((False, False, True, None, None, "partial"), ("unresolved", "collection_expand_partial")), ((False, False, False, None, None, "resolved"), ("unresolved", "not_classified")),
    ],
)
def test_dispositions(spark, row, want):
    df = spark.createDataFrame([row], "in_rare boolean, in_excluded boolean, is_root boolean, final_via string, action string, expand_status string")
    r = C.dispositions(df).first()
    assert (r.disposition, r.detail) == want


def test_first_and_last_wins(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "c", 3)], "k int, v string, o int")
    assert C.first_wins(df, ["k"], "o").first().v == "a" and C.last_wins(df, ["k"], "o").first().v == "c"


def test_every_manual_row_is_routed_or_left_out(spark):
    df = spark.createDataFrame([("Matched",), ("exclude_short",), ("unresolved",), ("",), (None,)], "a string")
    assert [r[0] for r in df.select(C.route_action(F.col("a"))).collect()] == ["final", "short", "rare", None, None]


def test_movie_validation(spark):
    base = {"collection_title": "c", "movie_title": "m", "movie_year": 1999, "collection_url": "https://www.criterion.com/boxsets/1", "collection_number": 3, "expected_number": 3}
    cases = [({}, None), ({"movie_title": ""}, "missing_movie_title"), ({"movie_year": 1799}, "invalid_movie_year"), ({"collection_url": "x"}, "invalid_collection_url"), ({"expected_number": 4}, "number_mismatch"), ({"expected_number": None}, None)]
    schema = "collection_title string, movie_title string, movie_year int, collection_url string, collection_number int, expected_number int"
    df = spark.createDataFrame([tuple((base | c).values()) for c, _ in cases], schema)
    assert [r[0] for r in df.select(P.invalid_movie(df)).collect()] == [w for _, w in cases]


def test_saved_pages(spark):
    plain = '<a class="global-search__film-result-link" href="/boxsets/1-x"><img alt="Eclipse Series 4: B"></a><a class="q global-search__film-result-link z" href="/boxsets/2-eclipse-series-9-y"><span class="global-search__result-title">No &amp; number</span></a>'
    escaped = 'global-search__film-result-link" href="https://www.criterion.com/boxsets/7" <span class="html-attribute-name">alt</span>="<span class="html-attribute-value">Eclipse Series 7: Z</span>"'
    product = '{"boxset_films":"A, B","x":1,"directors":"Ann","slug":"boxsets\\/5-e","y":2,"title":"Eclipse Series 5: Caf\\u00e9"}'.replace("boxsets\\/", "boxsets/")
    df = spark.createDataFrame([("p", plain), ("e", escaped), ("d", product), ("n", "")], "page_id string, html string")
    got = sorted(tuple(r) for r in P.url_matches(df).collect())
    assert got == [("e", "Eclipse Series 7: Z", 7, "https://www.criterion.com/boxsets/7", "saved_html_escaped"), ("p", "Eclipse Series 4: B", 4, "https://www.criterion.com/boxsets/1-x", "saved_html"), ("p", "No & number", 9, "https://www.criterion.com/boxsets/2-eclipse-series-9-y", "saved_html")]
    assert [tuple(r) for r in P.product_seeds(df).collect()] == [(5, "Eclipse Series 5: Café", "https://www.criterion.com/boxsets/5-e", "Ann", "A, B")]


def test_film_lists_and_stop_sections(spark):
    html = "<h2>Films In This Set</h2><ul><li>First Film 1931</li><li>First film: 1931</li><li>Second (1940)</li></ul><p>Newsletter 1999</p><p>no year</p>"
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    got = [tuple(r)[1:] for r in P.film_list(P.text_blocks(df)).orderBy("seq").collect()]
    assert got == [(1, "First Film", 1931), (2, "Second (", 1940)]


def test_sources(spark, tmp_path):
    (tmp_path / "c.csv").write_text("﻿spine,title,country\n2,\" B, x \",\"France,,\"\n,A,\n", encoding="utf-8")
    (tmp_path / "b.tsv").write_text("tconst\ttitleType\tprimaryTitle\nt1\tmovie\t\"Q\nt2\tshort\t\\N\n", encoding="utf-8")
    rows = S.read_csv(spark, str(tmp_path / "c.csv"), ["spine", "title", "country"])
    assert S.clean_fields(rows).orderBy("title").collect()[1].asDict() == {"spine": "2", "title": "B, x", "country": "France"}
    with pytest.raises(ValueError):
        S.read_csv(spark, str(tmp_path / "c.csv"), ["nope"])
    assert S.read_optional(spark, str(tmp_path / "none.csv"), ["a"]).columns == ["a"]
    (tmp_path / "empty.csv").write_text("")
    assert S.read_optional(spark, str(tmp_path / "empty.csv"), ["a"]).count() == 0
    assert [r.primaryTitle for r in S.read_tsv(spark, str(tmp_path / "b.tsv"), ["movie"]).collect()] == ['"Q']
    assert S.read_ragged(spark, str(tmp_path / "b.tsv"), 3).count() == 3
    ids = S.with_row_ids(spark.createDataFrame([("9", 5), ("", 6), ("x", 7)], "spine string, ord int"), "ord", numeric_only=True)
    assert [(r.row_id, r.source_id) for r in ids.orderBy("ord").collect()] == [("criterion_row_00001", "9"), ("criterion_row_00002", "row_2"), ("criterion_row_00003", "row_3")]
    S.write_csv(rows.limit(0), str(tmp_path / "out"), ["title"])
    S.write_buckets(spark.createDataFrame([(1, "a"), (2, "b")], "x int, bucket string"), str(tmp_path / "by"), "bucket")
    assert spark.read.parquet(str(tmp_path / "by" / "bucket=a")).count() == 1
    S.write_report(spark.createDataFrame([(2, "b"), (1, "a")], "ord int, v string"), str(tmp_path / "report"), "concat('- ', v)")
    assert [r.value for r in spark.read.text(str(tmp_path / "report")).collect()] == ["- a", "- b"]


def test_stream_links_every_new_row(spark, tmp_path):
    from catlink.streaming.incremental import link_stream

    catalog = spark.createDataFrame([(1, "Film", 1990, "")], "row_id int, title string, year int, director string")
    catalog.write.parquet(str(tmp_path / "in"))
    reference = spark.createDataFrame([(10, "movie", "film", "x", "1990", "100", "Drama")], "ref_id int, kind string, primary_title string, original_title string, start_year string, runtime string, genres string")
    none = spark.createDataFrame([], "ref_id int, title string")
    credits, people = spark.createDataFrame([], "ref_id int, pos int, person_id int"), spark.createDataFrame([], "person_id int, name string")
    stream = spark.readStream.schema(catalog.schema).parquet(str(tmp_path / "in"))
    link_stream(stream, reference, none, credits, people, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert [r.bucket for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["matched"]


def test_required_lookup_names_what_is_missing(spark):
    rows, known = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(KeyError, match="2"):
        C.required_lookup(rows, known, "k")
    assert C.required_lookup(rows.filter("k = 1"), known, "k").collect()[0].v == "a"
