"""Parsing of saved pages: links and titles, sections, seeds, film lists.  No page is fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catlink.functions import text as T

#: Fixed values.
STOP_SECTIONS = ("purchase options", "newsletter", "shopping cart", "related films", "related boxsets")
RESULT_LINK = r'(?is)<a[^>]+class="[^"]*global-search__film-result-link[^"]*"[^>]+href="(/boxsets/[^"]+)"[^>]*>(.*?)</a>'
RESULT_TITLE = r'(?is)<span[^>]+class="[^"]*global-search__result-title[^"]*"[^>]*>(.*?)</span>'
IMAGE_ALT = r'(?is)<img[^>]+alt="([^"]+)"'
ESCAPED_LINK = r'(?is)global-search__film-result-link.*?href="(https://www\.criterion\.com/boxsets/[^"]+)"'
ESCAPED_ALT = r'(?is)<span class="html-attribute-name">alt</span>="<span class="html-attribute-value">([^<]+)</span>"'
ESCAPED_TEXT = r'(?is)global-search__result-title[^>]*</span>&gt;</span>(.*?)<span class="html-tag">&lt;/span&gt;</span>'
FILMS_HEADING = r"films\s+in\s+this\s+set"
SERIES_TITLE = r"(?i)Eclipse Series\s+(\d+):"
SERIES_SLUG = r"(?i)/boxsets/\d+-eclipse-series-(\d+)(?:-|$)"
PRODUCT = r'(?is)"boxset_films":"(.*?)".*?"directors":"(.*?)".*?"slug":"(boxsets/[^"]+)".*?"title":"(Eclipse Series[^"]+)"'


def extract_all(x: Column, pattern: str, *groups: int) -> Column:
    """Array of structs g1, g2, ... of a pattern's groups, by match."""
    parts = [F.regexp_extract_all(x, F.lit(pattern), F.lit(g)).alias(f"g{g}") for g in groups]
    return F.arrays_zip(*parts)


def titles_and_links(pages: DataFrame) -> DataFrame:
    """page_id, title, heading, links, first_link of html pages."""
    h = F.col("html")
    links = F.regexp_extract_all(h, F.lit(r'(?i)<a[^>]+href="([^"]+)"'), F.lit(1))
    return pages.select("page_id", T.strip_tags(F.regexp_extract(h, "(?is)<title[^>]*>(.*?)</title>", 1)).alias("title"), T.strip_tags(F.regexp_extract(h, "(?is)<h1[^>]*>(.*?)</h1>", 1)).alias("heading"), F.size(links).alias("links"), F.coalesce(F.get(links, 0), F.lit("")).alias("first_link"))


def text_blocks(pages: DataFrame, tags: str = "p|li|h1|h2|h3") -> DataFrame:
    """(page_id, seq, block): distinct texts of block elements in order of first appearance, without those of stop sections."""
    raw = F.regexp_extract_all("html", F.lit(rf"(?is)<(?:{tags})(?:\s[^>]*)?>(.*?)(?=<(?:{tags})[\s>]|</(?:{tags}|article|body|ul|div)>)"), F.lit(1))
    x = pages.select("page_id", F.posexplode(raw).alias("pos", "r")).select("page_id", "pos", T.strip_tags(F.col("r")).alias("block")).filter("block <> ''")
    x = x.filter(~T.page_key(F.col("block")).rlike("|".join(STOP_SECTIONS))).groupBy("page_id", "block").agg(F.min("pos").alias("pos"))
    return x.withColumn("seq", F.row_number().over(Window.partitionBy("page_id").orderBy("pos", "block"))).select("page_id", "seq", "block")


def film_section_blocks(pages: DataFrame) -> DataFrame:
    """(page_id, seq, block): distinct texts under the headings that announce a set's films, up to the next heading or stop text."""
    section = rf"(?is)<h([1-6])(?:\s[^>]*)?>(?:(?!</h\1>).)*?{FILMS_HEADING}(?:(?!</h\1>).)*</h\1>(.*?)(?=<h[1-6][\s>]|\z)"
    tags = "a|li|article|div|p"
    leaf = rf"(?is)<(?:{tags})(?:\s[^>]*)?>(.*?)(?=<(?:{tags})[\s>]|</(?:{tags}|ul|ol|section|body)>|\z)"
    x = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(section), F.lit(2))).alias("part", "s"))
    # a section's texts are cut at its first stop text where they stand, so sections are found once and not joined with themselves
    texts = x.select("page_id", "part", F.transform(F.regexp_extract_all("s", F.lit(leaf), F.lit(1)), T.strip_tags).alias("t"))
    stop = F.get(F.filter(F.transform("t", lambda t, i: F.when(T.page_key(t).rlike("|".join(STOP_SECTIONS)), i)), lambda i: i.isNotNull()), 0)
    x = texts.select("page_id", "part", "t", stop.alias("stop")).select("page_id", "part", "stop", F.posexplode("t").alias("pos", "block"))
    x = x.filter("block <> '' and (stop is null or pos < stop)").groupBy("page_id", "block").agg(F.min(F.struct("part", "pos")).alias("at"))
    return x.withColumn("seq", F.row_number().over(Window.partitionBy("page_id").orderBy("at"))).select("page_id", "seq", "block")


def url_matches(pages: DataFrame) -> DataFrame:
    """(page_id, title, number, url, confidence): result links of saved search pages; the escaped grammar where the plain one finds none."""
    plain = pages.select("page_id", F.posexplode_outer(extract_all(F.col("html"), RESULT_LINK, 1, 2)).alias("pos", "m"))
    body = F.col("m.g2")
    title = T.strip_tags(F.coalesce(F.nullif(F.regexp_extract(body, RESULT_TITLE, 1), F.lit("")), F.regexp_extract(body, IMAGE_ALT, 1)))
    plain = plain.filter("m is not null").select("page_id", "pos", title.alias("title"), F.concat(F.lit("https://www.criterion.com"), F.col("m.g1")).alias("url"), F.lit("saved_html").alias("confidence"))
    window = F.split("html", r"(?i)(?=global-search__film-result-link)")
    near = F.substring("w", 1, 2500)  # a fixed value: a result's title stands so near to its link
    alt, shown = F.regexp_extract(near, ESCAPED_ALT, 1), F.regexp_extract(near, ESCAPED_TEXT, 1)
    other = pages.select("page_id", F.posexplode(window).alias("pos", "w")).select("page_id", "pos", T.strip_tags(F.when(alt != "", alt).otherwise(shown)).alias("title"), F.regexp_extract("w", ESCAPED_LINK, 1).alias("url"), F.lit("saved_html_escaped").alias("confidence")).filter("url <> ''")
    numbered = lambda d: d.withColumn("number", F.coalesce(T.series_number(F.col("title"), SERIES_TITLE), T.series_number(F.col("url"), SERIES_SLUG))).filter("title <> '' and number is not null")
    plain, other = numbered(plain), numbered(other)
    both = plain.unionByName(other.join(plain.select("page_id").distinct(), "page_id", "left_anti"))
    last = Window.partitionBy("page_id", "number").orderBy(F.desc("pos"))
    return both.withColumn("_n", F.row_number().over(last)).filter("_n = 1").select("page_id", "title", "number", "url", "confidence")


def product_seeds(pages: DataFrame) -> DataFrame:
    """(number, title, url, directors, films): product blobs of saved pages, the first of each series number."""
    # a page is resolved once, before its four groups are taken
    x = pages.select("page_id", T.unescape_entities(T.unescape_entities(F.col("html"))).alias("html"))
    x = x.select("page_id", F.posexplode(extract_all(F.col("html"), PRODUCT, 1, 2, 3, 4)).alias("pos", "m"))
    # one expression for all texts, as it is long
    texts = F.transform(F.array("m.g4", "m.g2", "m.g1"), lambda g: T.strip_tags(T.decode_json_text(g)))
    x = x.select("page_id", "pos", texts.alias("t"), F.concat(F.lit("https://www.criterion.com/"), T.decode_json_text(F.col("m.g3"))).alias("url"))
    x = x.select("page_id", "pos", F.get("t", 0).alias("title"), "url", F.get("t", 1).alias("directors"), F.get("t", 2).alias("films"))
    x = x.withColumn("number", T.series_number(F.col("title"), SERIES_TITLE)).filter("number is not null")
    first = Window.partitionBy("number").orderBy("page_id", "pos")
    return x.withColumn("_n", F.row_number().over(first)).filter("_n = 1").select("number", "title", "url", "directors", "films")


def film_list(blocks: DataFrame) -> DataFrame:
    """(page_id, seq, title, year): films named with a year in text blocks, the first of each (title key, year), numbered anew."""
    x = blocks.withColumn("f", T.title_and_year(F.col("block"))).filter("f is not null").select("page_id", "seq", "f.title", "f.year")
    return dedupe_films(x)


def dedupe_films(x: DataFrame) -> DataFrame:
    first = Window.partitionBy("page_id", "_k", "year").orderBy("seq")
    x = x.withColumn("_k", T.page_key(F.col("title"))).withColumn("_n", F.row_number().over(first)).filter("_n = 1")
    return x.withColumn("seq", F.row_number().over(Window.partitionBy("page_id").orderBy("seq")).cast("int")).select("page_id", "seq", "title", "year")


def url_cascade(rows: DataFrame, cache: DataFrame, exact: DataFrame, numbered: DataFrame, searched: DataFrame) -> DataFrame:
    """(row_id, url, how): cache by title key, then saved pages by title key and by number, then accepted search results.

    rows: row_id, key, number; cache and exact: key, url; numbered: number, url; searched: row_id, url.
    """
    x = rows
    for name, other, on in (("cache", cache, "key"), ("exact_title", exact, "key"), ("series_number", numbered, "number"), ("search", searched, "row_id")):
        x = x.join(other.select(on, F.col("url").alias(f"u_{name}")).dropDuplicates([on]), on, "left")
    names = ["cache", "exact_title", "series_number", "search"]
    how = F.coalesce(*[F.when(F.col(f"u_{n}").isNotNull(), F.lit(n)) for n in names])
    return x.select("row_id", F.coalesce(*[F.col(f"u_{n}") for n in names]).alias("url"), how.alias("how"))


def fallback(status: Column, hints: Column) -> Column:
    """What stands for a page: its films, hint rows, or a failure row with the stage that failed."""
    failed = status.isin("timeout", "error", "parse_failure", "zero_movies")
    return F.when(~failed, "movies").when(hints > 0, "hints").otherwise(F.concat(F.lit("failure:"), status))


def invalid_movie(x: DataFrame, prefix: str = "https://www.criterion.com/boxsets/") -> Column:
    """The first rule that a film row breaks, or null: title, film title, year, url, number."""
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return (
        F.when(blank("collection_title"), "missing_collection_title").when(blank("movie_title"), "missing_movie_title").when(~F.coalesce(F.col("movie_year").cast("string").rlike("^(18|19|20)[0-9]{2}$"), F.lit(False)), "invalid_movie_year")
        .when(~F.startswith(F.coalesce("collection_url", F.lit("")), F.lit(prefix)), "invalid_collection_url").when(F.col("expected_number").isNotNull() & ~F.col("collection_number").eqNullSafe(F.col("expected_number")), "number_mismatch")
    )
