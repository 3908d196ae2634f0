"""Container records and their constituents: splitting titles, finding groups by position, rolling up.

The catalog's order is an explicit ``idx``.  Groups are found with window functions and equi-joins on
positions, and blocks are running sums by ranges, so the catalog is neither walked row by row nor
gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catlink.functions import text as T
from catlink.functions.runtime import checkpoint, running_sums

#: Fixed values.
CONTAINER_HINTS = (
    "collection", "trilogy", "anthology", "three films", "five films", "six films", "adventures of", "by brakhage", "box set", "films of",
    "volumes one and two", "two films", "complete", "series",
)
GENERIC_TITLES = (
    "an anthology", "anthology", "volume one", "volume two", "volumes one and two", "volume 1", "volume 2", "disc one", "disc two", "disc 1", "disc 2",
    "part one", "part two", "program one", "program two",
)


def is_likely_collection(title: Column, director: Column, year: Column) -> Column:
    """A title with a container hint, or one without director or year that has a slash or colon."""
    blank = lambda x: F.trim(F.coalesce(x.cast("string"), F.lit(""))) == ""
    return F.lower(title).rlike("|".join(CONTAINER_HINTS)) | ((blank(director) | blank(year)) & title.rlike("[/:]"))


def is_container(title: Column, director: Column, year: Column, known: Column | None = None) -> Column:
    own = is_likely_collection(title, director, year) | F.contains(F.lower(title), F.lit("eclipse series"))
    return own if known is None else own | known


def split_fragments(x: Column, trim: str = " ,") -> Column:
    """Comma-separated parts without blanks at their ends; empty parts are dropped."""
    return F.filter(F.transform(F.split(x, ","), lambda p: F.btrim(p, F.lit(trim))), lambda p: p != "")


def split_constituents(title: Column) -> Column:
    """struct(titles, method) of a container's title."""
    t = F.trim(title)
    slashes = lambda x: F.filter(F.transform(F.split(x, r"\s*/\s*"), lambda p: F.trim(p)), lambda p: p != "")
    left, right = F.trim(F.regexp_extract(t, "^([^:]*):", 1)), F.trim(F.regexp_extract(t, "(?s)^[^:]*:(.*)$", 1))
    many = split_fragments(right)
    colon = F.contains(t, F.lit(":"))
    named = F.contains(right, F.lit(",")) & (F.lower(right).rlike("trilogy|two films|three films|five films") | (F.size(many) > 1))
    made = lambda titles, method: F.struct(titles.alias("titles"), F.lit(method).alias("method"))
    return (
        F.when(F.contains(t, F.lit(" / ")), made(slashes(t), "slash_split")).when(colon & F.contains(left, F.lit(" / ")), made(slashes(left), "colon_left_slash_split"))
        .when(colon & named, made(many, "colon_right_comma_split")).otherwise(made(F.array().cast("array<string>"), "needs_manual_decomposition"))
    )


def known_map(known: dict[str, list[str]]) -> Column:
    """A fixed map of containers as a column: normalised title -> constituents."""
    pairs = [x for k, v in known.items() for x in (F.lit(T.python_title(k)), F.array(*[F.lit(t) for t in v]))]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,array<string>>")


def expected_titles(title: Column, known: dict[str, list[str]]) -> Column:
    """struct(titles, method): a known decomposition, else the split title."""
    listed = F.try_element_at(known_map(known), T.normalize_title(title))
    return F.when(listed.isNotNull(), F.struct(listed.alias("titles"), F.lit("known_collection_map").alias("method"))).otherwise(split_constituents(title))


def ngrams(parts: Column, most: int = 4) -> Column:
    """Runs of 1 to ``most`` neighbouring parts: array of struct(start, width, text); start from 1."""
    n = F.size(parts)
    starts = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    of = lambda s: F.transform(F.sequence(F.lit(1), F.least(F.lit(most), n - s + 1)), lambda w: F.struct(s.alias("start"), w.alias("width"), F.array_join(F.slice(parts, s, w), ", ").alias("text")))
    return F.flatten(F.transform(starts, of))


def merge_fragments(rows: DataFrame, id_col: str, raw_col: str, titles: DataFrame, most: int = 4) -> DataFrame:
    """(id, titles): neighbouring fragments merged to the longest run that is a known title key, from the left.

    Runs are semi-joined to the keys (column ``key``); the greedy walk is a fold over one row's parts.
    """
    x = rows.select(id_col, T_parts(F.col(raw_col)).alias("parts"))
    runs = x.select(id_col, F.explode(ngrams(F.col("parts"), most)).alias("g")).select(id_col, "g.*").withColumn("key", T.hint_key(F.col("text"))).filter("key <> ''")
    hits = runs.join(titles.select("key").distinct(), "key", "left_semi").groupBy(id_col, "start").agg(F.max("width").alias("width"))
    best = hits.groupBy(id_col).agg(F.map_from_entries(F.collect_list(F.struct("start", "width"))).alias("best"))
    y = x.join(best, id_col, "left").withColumn("best", F.coalesce("best", F.create_map().cast("map<int,int>")))
    start = F.struct(F.lit(1).alias("next"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, i: Column) -> Column:
        width = F.coalesce(F.try_element_at("best", i), F.lit(1))
        return F.when(i == acc["next"], F.struct((i + width).alias("next"), F.concat(acc["out"], F.array(F.array_join(F.slice("parts", i, width), ", "))).alias("out"))).otherwise(acc)

    at = F.when(F.size("parts") > 0, F.sequence(F.lit(1), F.size("parts"))).otherwise(F.array().cast("array<int>"))
    return y.select(id_col, F.aggregate(at, start, step, lambda a: a["out"]).alias("titles"))


def T_parts(x: Column) -> Column:
    return split_fragments(x, " ")


def discover_groups(catalog: DataFrame, known: dict[str, list[str]]) -> DataFrame:
    """Groups of a catalog (idx, source_id, spine, title, director, year): one row for each constituent.

    Returns idx (of the container), source_id, title, kind, method, seq, film_source_id, film_title,
    film_director, film_year, from_catalog.  Three cases, by the container's spine and director:
    neither: the run of spineless rows with a director that follows; spine only: the longest run of
    following numbered rows that match the expected titles in order; both: the expected titles.
    A row that a run has taken opens no group.
    """
    blank = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""
    listed = F.map_contains_key(known_map(known), T.normalize_title(F.col("title"))) if known else F.lit(False)
    x = catalog.select(
        "idx", "source_id", "title", F.col("director"), F.col("year").cast("string").alias("year"), blank("spine").alias("bare"), F.trim("spine").rlike("^[0-9]+$").alias("numbered"), (~blank("director")).alias("led"),
        is_container(F.col("title"), F.col("director"), F.col("year"), listed).alias("container"), expected_titles(F.col("title"), known).alias("e"),
    ).select("*", F.col("e.titles").alias("expected"), F.col("e.method").alias("method")).drop("e")
    follows = F.col("bare") & F.col("led")
    x = running_sums(x.withColumns({"_cut": (~follows).cast("int"), "_led": follows.cast("int")}), "idx", {"block": "_cut", "_seen": "_led"}).drop("_cut", "_led")
    x = checkpoint(x)
    fields = ["source_id", "title", "director", "year"]
    row = F.struct(*fields)
    keep = ["idx", "source_id", "title", "kind", "method", "expected"]
    k = F.size("expected")

    # no spine, no director: the rows of the block that the container opens, numbered by the running count
    one = x.filter("bare and not led and container")
    members = x.filter("bare and led").select("block", F.col("_seen").alias("_at"), row.alias("r"))
    sizes = members.groupBy("block").agg(F.count("*").alias("n"))
    one = one.join(sizes, "block", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    n = F.col("n")
    one = one.filter((n > 0) | (k > 0)).withColumn("kind", F.lit("spineless"))
    one = one.withColumn("method", F.when(k == 0, "spineless_catalog_children").when(n == k, F.concat("method", F.lit("+spineless_block"))).when(n > 0, F.concat("method", F.lit("+spineless_partial"))).otherwise(F.concat("method", F.lit("+spineless_no_children"))))
    one_rows = one.select(*keep, "block", "_seen").join(members, "block").withColumn("p", (F.col("_at") - F.col("_seen") - 1).cast("int"))

    # spine, no director: positions idx + 1, idx + 2, ... against the expected titles in order
    two = x.filter("numbered and not led and container").filter(k > 0)
    wanted = two.select(F.col("idx").alias("g"), F.posexplode("expected").alias("p", "want")).withColumn("idx", F.col("g") + F.col("p") + 1)
    fits = F.col("numbered") & F.col("led") & T.contains_either_way(T.normalize_title(F.col("title")), T.normalize_title(F.col("want")))
    tried = wanted.join(x.select("idx", "numbered", "led", *fields), "idx", "left").withColumn("ok", F.coalesce(fits, F.lit(False)))
    first_miss = tried.groupBy("g").agg(F.min(F.when(~F.col("ok"), F.col("p"))).alias("miss"))
    taken = tried.join(first_miss, "g").filter("miss is null or p < miss")
    # as many rows as a container has expected titles
    two = two.join(taken.groupBy("g").agg(F.count("*").alias("n")).withColumnRenamed("g", "idx"), "idx", "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("kind", F.lit("spined"))
    two = two.withColumn("method", F.concat("method", F.when(n == k, "+following_spines").when(n > 0, "+following_spines_partial").otherwise("+virtual_only")))
    two_rows = two.select(*keep).join(taken.select(F.col("g").alias("idx"), "p", row.alias("r")), "idx")

    # spine and director: a single row stands for the box, unless a run before it took the row
    three = x.filter("numbered and led and container").filter(k > 0).join(taken.select("idx"), "idx", "left_anti")
    three = three.withColumns({"kind": F.lit("spined"), "method": F.concat("method", F.lit("+single_row_box")), "n": F.lit(0)})

    blank_text = F.lit("")
    child = lambda sid, t, d, y, real: F.struct(sid.alias("source_id"), t.alias("title"), F.coalesce(d, blank_text).alias("director"), F.coalesce(y, blank_text).alias("year"), F.lit(real).alias("real")).alias("c")
    head = ["idx", "source_id", "title", "kind", "method"]
    real = one_rows.select(*head, "p", "r").unionByName(two_rows.select(*head, "p", "r")).select(*head, "p", child(F.col("r.source_id"), F.col("r.title"), F.col("r.director"), F.col("r.year"), True))
    empty = one.select(*keep, "n").unionByName(two.select(*keep, "n")).unionByName(three.select(*keep, "n")).filter("n = 0")
    virtual = empty.select(*head, F.posexplode("expected").alias("p", "t")).select(*head, "p", child(blank_text, F.col("t"), blank_text, blank_text, False))
    out = real.unionByName(virtual)
    # groups without catalog rows look their titles up among spineless rows, first row wins
    first = Window.partitionBy("_k").orderBy("idx")
    spare = x.filter("bare and led").withColumn("_k", T.normalize_title(F.col("title"))).filter("_k <> ''").withColumn("_n", F.row_number().over(first)).filter("_n = 1").select("_k", row.alias("spare"))
    out = out.withColumn("_k", F.when(~F.col("c.real"), T.normalize_title(F.col("c.title")))).join(spare, "_k", "left")
    pick = lambda f: F.coalesce(F.col(f"spare.{f}"), F.col(f"c.{f}"))
    return out.select(
        "idx", "source_id", "title", "kind", "method", (F.col("p") + 1).alias("seq"), pick("source_id").alias("film_source_id"), pick("title").alias("film_title"),
        F.coalesce(pick("director"), blank_text).alias("film_director"), F.coalesce(pick("year"), blank_text).alias("film_year"), (F.col("c.real") | F.col("spare").isNotNull()).alias("from_catalog"),
    )


def apply_overrides(constituents: DataFrame, overrides: DataFrame) -> DataFrame:
    """Overrides (collection_id, seq text, film_title, film_director, film_year, film_source_id, ord) replace values where not blank.

    Rows without a key or a whole seq are ignored; of equal keys the last wins.
    """
    last = Window.partitionBy("collection_id", "_seq").orderBy(F.desc("ord"))
    o = overrides.withColumn("_seq", T.strict_int(F.col("seq").cast("string"))).filter("_seq is not null and trim(collection_id) <> ''").withColumn("_n", F.row_number().over(last)).filter("_n = 1")
    names = ["film_title", "film_director", "film_year", "film_source_id"]
    o = o.select(F.col("collection_id").alias("source_id"), F.col("_seq").alias("seq"), *[F.nullif(F.trim(c), F.lit("")).alias(f"_{c}") for c in names])
    x = constituents.join(o, ["source_id", "seq"], "left")
    return x.withColumns({c: F.coalesce(f"_{c}", c) for c in names}).drop(*[f"_{c}" for c in names])


def plurality(votes: DataFrame, by: str, value: str, order: str) -> DataFrame:
    """(by, value): the most frequent value of each group; of equals, the one seen first."""
    counted = votes.filter(F.trim(value) != "").groupBy(by, value).agg(F.count("*").alias("_c"), F.min(order).alias("_o"))
    w = Window.partitionBy(by).orderBy(F.desc("_c"), "_o", value)
    return counted.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select(by, value)


def rollup_status(constituents: DataFrame, by: str, found: Column) -> DataFrame:
    """(by, total, missing, status) of each group."""
    x = constituents.groupBy(by).agg(F.count("*").alias("total"), F.count_if(~found).alias("missing"))
    return x.withColumn("status", F.when(F.col("missing") == 0, "resolved").when(F.col("missing") < F.col("total"), "partial").otherwise("needs_manual_decomposition"))
