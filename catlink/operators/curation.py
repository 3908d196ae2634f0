"""Curation: first-wins and last-wins rows, cascades, statuses, final assembly, dispositions, quality."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catlink.functions import text as T
from catlink.operators.groups import GENERIC_TITLES, is_likely_collection
from catlink.operators.linkage import FEATURE, short_signal

#: Fixed values.
OTHER_CONTENT = ("documentary", "short", "tvMiniSeries", "tvMovie", "tvSeries", "tvSpecial", "video")
MATCH_ACTIONS = ("matched", "matched_directly", "include")
SHORT_ACTIONS = ("exclude_short", "exclude_as_short")
RARE_ACTIONS = ("rare_edge_case", "flag_edge_case", "no_imdb_entry", "unresolved")
TV_KINDS = ("tvseries", "tvminiseries", "tvmovie", "tvspecial", "tvepisode", "tvshort", "tvpilot")
VIDEO_KINDS = ("short", "video", "videogame")
MOVIES, OTHER, PROBLEM, UNKNOWN = "Movies", "TV / Docs / Shorts / Video", "Untracked / Problem", "Unknown"


# --- rows by key ------------------------------------------------------------------------------


def first_wins(x: DataFrame, keys: Sequence[str], *order) -> DataFrame:
    """The first row of each key in a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return x.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def last_wins(x: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The last row of each key."""
    return first_wins(x, keys, F.desc(order))


def upsert(base: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``base`` whose key isn't in ``updates``, and all updates."""
    return base.join(updates.select(*keys).distinct(), list(keys), "left_anti").unionByName(updates)


def first_source(sources: Sequence[tuple[str, DataFrame]], keys: Sequence[str], order: str) -> DataFrame:
    """Union of sources in order of precedence; of equal keys the first source's first row stays, with its name as evidence."""
    tagged = [x.withColumns({"_rank": F.lit(i), "evidence": F.lit(name)}) for i, (name, x) in enumerate(sources)]
    return first_wins(reduce(lambda a, b: a.unionByName(b), tagged), keys, "_rank", order).drop("_rank")


def fill_blanks(x: DataFrame, other: DataFrame, on: str, columns: Sequence[str]) -> DataFrame:
    """Fills null or blank values of ``columns`` from the first row of ``other`` with the same key."""
    o = other.select(on, *[F.col(c).alias(f"_{c}") for c in columns]).dropDuplicates([on])
    y = x.join(o, on, "left")
    return y.withColumns({c: F.coalesce(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")), F.col(f"_{c}").cast("string"), F.lit("")) for c in columns}).drop(*[f"_{c}" for c in columns])


def first_text(*columns: Column) -> Column:
    """The first value that is neither null nor blank."""
    return F.coalesce(*[F.when(F.trim(c.cast("string")) != "", c.cast("string")) for c in columns])


def any_listed(x: DataFrame, id_col: str, list_col: str, allowed: DataFrame, key: str) -> DataFrame:
    """Rows of which some listed item is allowed."""
    hits = x.select(id_col, F.explode(list_col).alias(key)).join(allowed.select(key).distinct(), key, "left_semi").select(id_col).distinct()
    return x.join(hits, id_col, "left_semi")


def all_listed(x: DataFrame, id_col: str, list_col: str, allowed: DataFrame, key: str) -> DataFrame:
    """Rows of which every listed item is allowed; empty lists qualify."""
    misses = x.select(id_col, F.explode(list_col).alias(key)).join(allowed.select(key).distinct(), key, "left_anti").select(id_col).distinct()
    return x.join(misses, id_col, "left_anti")


def year_close(a: Column, b: Column, tolerance: int = 1) -> Column:
    """Years within the tolerance; a missing or unreadable year doesn't block."""
    x, y = T.strict_int(a.cast("string")), T.strict_int(b.cast("string"))
    return F.coalesce(F.abs(x - y) <= tolerance, F.lit(True))


# --- row statuses of a re-anchored catalog ----------------------------------------------------


def anchor_rows(catalog: DataFrame, old: DataFrame) -> DataFrame:
    """Cascade of a catalog (row_id, spine, title_key, director_key, year) to old rows (old_id, spine, title_key, director_key, year, ord).

    By spine; else by title and director, years within 1 first; else by title alone.  Returns row_id,
    old_id, how (spine, title_director, title_year, title_only or null).
    """
    c = catalog.select("row_id", "spine", "title_key", "director_key", "year")
    o = old.select("old_id", F.col("spine").alias("ospine"), F.col("title_key").alias("otitle"), F.col("director_key").alias("odirector"), F.col("year").alias("oyear"), "ord")
    close = year_close(F.col("year"), F.col("oyear"))
    has_year = F.coalesce(F.col("year").cast("string"), F.lit("")) != ""
    near = (has_year & close).cast("int").alias("near")
    one = c.join(o, F.col("spine") == F.col("ospine")).select("row_id", "old_id", F.lit(1).alias("stage"), F.lit(0).alias("near"), "ord")

    def by(stage: int, *keys: str) -> DataFrame:
        # only a year's first old row can win, so a title's rows meet years and not each other
        firsts = o.groupBy(*[f"o{k}" for k in keys], "oyear").agg(F.min(F.struct("ord", "old_id")).alias("m"))
        on = [F.col(f"{k}_key") == F.col(f"o{k}") for k in keys]
        return c.filter("title_key <> ''").join(firsts, on).select("row_id", "m.old_id", F.lit(stage).alias("stage"), near, "m.ord")

    more = by(2, "title", "director").unionByName(by(3, "title"))
    best = first_wins(one.unionByName(more), ["row_id"], "stage", F.desc("near"), "ord")
    how = F.when(F.col("stage") == 1, "spine").when(F.col("stage") == 2, "title_director").when(F.col("near") == 1, "title_year").otherwise("title_only")
    return c.select("row_id").join(best.select("row_id", "old_id", how.alias("how")), "row_id", "left")


def row_status(x: DataFrame) -> Column:
    """Status of a row with title, director, country, year, numbered, manual_type and flags in_short, in_match, in_review, in_unmatched, short_title, how."""
    blank = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""
    manual = F.when(F.col("manual_type") == "movie", "matched").when(F.col("manual_type").isin(*OTHER_CONTENT), "other_content").when(F.col("manual_type").isin("collection", "collection_label"), "collection_header")
    spined = F.when(F.col("in_short"), "excluded_short").when(F.col("in_match"), "matched").when(F.col("in_review") | F.col("in_unmatched"), "needs_review").otherwise("new_entry")
    header = is_likely_collection(F.col("title"), F.col("director"), F.col("year")) | (blank("year") & blank("country"))
    loose = F.when(F.col("short_title"), "excluded_short").when(F.col("how").isin("title_director", "title_year"), "matched").when(F.col("how") == "title_only", "needs_review").otherwise("new_entry")
    return F.coalesce(manual, F.when(F.col("numbered"), spined).when(blank("director"), F.when(header, "collection_header").otherwise("new_entry")).otherwise(loose))


def entity_type(status: Column, old_kind: Column, numbered: Column, director: Column) -> Column:
    blank = F.trim(F.coalesce(director, F.lit(""))) == ""
    return (
        F.when(status == "collection_header", F.when(old_kind.isin("collection", "collection_label"), old_kind).otherwise("collection_header"))
        .when((status == "other_content") & (F.coalesce(old_kind, F.lit("")) != ""), old_kind).when(numbered | blank, "named_criterion_entry").otherwise("collection_constituent_film")
    )


# --- unpacking --------------------------------------------------------------------------------


def unpack_class(x: DataFrame, docs_as_movies: bool = False) -> Column:
    """struct(category, confidence, reason, needs_review) of an item with ref_id, kind, genres, runtime, year, start_year, include, is_short, notes."""
    kind = F.lower(F.trim(F.coalesce("kind", F.lit(""))))
    runtime, own, ref = T.lenient_int(F.col("runtime").cast("string")), T.strict_int(F.col("year").cast("string")), T.strict_int(F.col("start_year").cast("string"))
    genres = F.transform(F.split(F.coalesce("genres", F.lit("")), ","), lambda g: F.lower(F.trim(g)))
    gap = F.abs(own - ref)
    made = lambda category, confidence, reason, review: F.struct(F.lit(category).alias("category"), (confidence if isinstance(confidence, Column) else F.lit(confidence)).alias("confidence"), F.lit(reason).alias("reason"), (review if isinstance(review, Column) else F.lit(review)).alias("needs_review"))
    documentary = F.array_contains(genres, "documentary") & F.lit(not docs_as_movies)
    feature = (kind == "movie") & (runtime >= 40)
    return (
        F.when(F.trim(F.coalesce(F.col("ref_id").cast("string"), F.lit(""))) == "", made(PROBLEM, "low", "no_reliable_match", True))
        .when((kind == "") & runtime.isNull() & ref.isNull() & own.isNull(), made(UNKNOWN, "low", "no_metadata", True))
        .when(kind.isin(*TV_KINDS), made(OTHER, "high", "television", False)).when(kind.isin(*VIDEO_KINDS), made(OTHER, "high", "video_or_short_form", False))
        .when(documentary, made(OTHER, F.when(runtime.isNotNull(), "high").otherwise("medium"), "documentary", runtime.isNull()))
        .when(F.col("is_short"), made(OTHER, "high", "flagged_short", False)).when(runtime < 40, made(OTHER, "high", "below_40_minutes", False))
        .when(feature & (gap > 1), made(MOVIES, "medium", "years_differ", True)).when(feature & (gap == 1), made(MOVIES, "medium", "years_differ_by_one", False))
        .when(feature, made(MOVIES, "high", "feature_length", False)).when((kind == "movie") & runtime.isNull(), made(UNKNOWN, "low", "runtime_missing", True))
        .when((F.col("include") == False) & (F.trim(F.coalesce("notes", F.lit(""))) == ""), made(OTHER, "medium", "excluded_without_reason", True))  # noqa: E712
        .otherwise(made(UNKNOWN, "low", "not_resolved", True))
    )


def guard_item(title_key: Column, status: Column, trusted: Column) -> Column:
    """Why an item stays in manual review before classification, or null: generic titles, partial groups without or outside a trusted list."""
    partial = status == "partial"
    return F.when(title_key.isin(*GENERIC_TITLES), "generic_title").when(partial & trusted.isNull(), "partial_without_trusted_titles").when(partial & ~F.array_contains(trusted, title_key), "not_a_trusted_title")


def years_match(own: Column, ref: Column) -> Column:
    gap = F.abs(T.strict_int(own.cast("string")) - T.strict_int(ref.cast("string")))
    return F.when(gap == 0, "exact").when(gap == 1, "within_1").when(gap.isNotNull(), "off").otherwise("")


def tracked(x: DataFrame, movies: DataFrame) -> DataFrame:
    """Adds already_tracked and duplicate_key: by reference id, else by title key and year."""
    ids = movies.select(F.col("ref_id").cast("string").alias("ref_id")).filter("trim(ref_id) <> ''").distinct().withColumn("_by_id", F.lit(True))
    keys = movies.select("title_key", F.col("year").cast("string").alias("_y")).filter("title_key <> '' and _y <> ''").distinct().withColumn("_by_key", F.lit(True))
    y = x.withColumn("ref_id", F.col("ref_id").cast("string")).withColumn("_y", F.col("year").cast("string")).join(ids, "ref_id", "left").join(keys, ["title_key", "_y"], "left")
    own = F.coalesce(F.trim("ref_id"), F.lit("")) != ""
    keyed = (F.coalesce("title_key", F.lit("")) != "") & (F.coalesce("_y", F.lit("")) != "")
    y = y.withColumn("already_tracked", F.when(own, F.coalesce("_by_id", F.lit(False))).when(keyed, F.coalesce("_by_key", F.lit(False))))
    return y.withColumn("duplicate_key", F.when(own, F.col("ref_id")).when(keyed, F.concat_ws("|", "title_key", "_y")).otherwise("")).drop("_by_id", "_by_key", "_y")


# --- resolutions, final rows, dispositions ----------------------------------------------------


def apply_resolutions(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Looks rows (source_id, status) up in a resolution table (source_id, kind, ref_id, action); headers and misses get defaults."""
    x = rows.join(table.select("source_id", "kind", "ref_id", "action"), "source_id", "left")
    header = F.col("status") == "collection_header"
    x = x.withColumns({"kind": F.when(header, "collection_label").otherwise(F.coalesce("kind", F.lit(""))), "action": F.when(header, "collection_label").otherwise(F.coalesce("action", F.lit("unresolved")))})
    return x.withColumn("resolved", (F.col("action") == "matched") & (F.coalesce(F.col("ref_id").cast("string"), F.lit("")) != ""))


def route_action(action: Column) -> Column:
    """final, short, rare or null for a manual action."""
    a = F.lower(F.trim(F.coalesce(action, F.lit(""))))
    return F.when(a.isin(*MATCH_ACTIONS), "final").when(a.isin(*SHORT_ACTIONS), "short").when(a.isin(*RARE_ACTIONS), "rare")


def assemble_final(direct: DataFrame, manual: DataFrame, constituents: DataFrame, basics: DataFrame) -> DataFrame:
    """Every input row with its output: final, short or rare, and why.

    direct and constituents: row_id, ref_id, kind, runtime, genres, ord (constituents also include);
    manual: row_id, ref_id, action, ord.  Rows without a rule are left out.  Of final rows with one
    (row, reference) the last stays; those whose reference isn't one, or is short by ``basics``, are
    excluded as shorts.
    """
    signal = lambda: short_signal(F.col("kind"), F.col("runtime").cast("string"), F.col("genres"))
    fields = ["row_id", "ref_id", "via", "output", "reason", "kind", "runtime", "genres", "ord"]
    text = lambda c: F.col(c).cast("string").alias(c)
    d = direct.withColumn("s", signal()).select("row_id", text("ref_id"), F.lit("direct").alias("via"), F.when(F.col("s") == FEATURE, "final").otherwise("short").alias("output"), F.col("s").alias("reason"), "kind", text("runtime"), "genres", "ord")
    m = manual.withColumn("output", route_action(F.col("action"))).filter("output is not null").select("row_id", text("ref_id"), F.lit("manual").alias("via"), "output", F.lower(F.trim("action")).alias("reason"), F.lit("").alias("kind"), F.lit("").alias("runtime"), F.lit("").alias("genres"), "ord")
    c = constituents.filter("trim(coalesce(cast(ref_id as string), '')) <> ''").withColumn("s", signal())
    shown = F.col("include") & (F.col("s") == FEATURE)
    c = c.select("row_id", text("ref_id"), F.lit("expanded").alias("via"), F.when(shown, "final").otherwise("short").alias("output"), F.when(F.col("s") != FEATURE, F.col("s")).when(~F.col("include"), "include_in_dataset_false").otherwise(F.lit(FEATURE)).alias("reason"), "kind", text("runtime"), "genres", "ord")
    rows = d.select(*fields).unionByName(m.select(*fields)).unionByName(c.select(*fields))
    final = rows.filter("output = 'final'").withColumn("expanded", F.col("via") == "expanded").withColumn("_v", F.when(F.col("via") == "direct", 1).when(F.col("via") == "manual", 2).otherwise(3))
    final = first_wins(final, ["expanded", "row_id", "ref_id"], F.desc("_v"), F.desc("ord")).drop("_v", "expanded")
    final = fill_blanks(final, basics.withColumn("ref_id", F.col("ref_id").cast("string")), "ref_id", ["kind", "runtime", "genres"]).withColumn("s", signal())
    valid = F.startswith(F.coalesce("ref_id", F.lit("")), F.lit("tt"))
    final = final.withColumn("output", F.when(valid & (F.col("s") == FEATURE), "final").otherwise("short")).withColumn("reason", F.when(~valid, "missing_or_invalid_id").otherwise(F.col("s")))
    out = ["row_id", "ref_id", "via", "output", "reason"]
    return rows.filter("output <> 'final'").select(*out).unionByName(final.select(*out))


def dispositions(x: DataFrame) -> DataFrame:
    """Adds disposition, bucket and detail to rows with flags in_rare, in_excluded, is_root, final_via, action and expand_status."""
    a = F.lower(F.trim(F.coalesce("action", F.lit(""))))
    made = lambda name, detail: F.struct(F.lit(name).alias("name"), (detail if isinstance(detail, Column) else F.lit(detail)).alias("detail"))
    status = F.when(F.col("is_root") & ~a.isin("no_imdb_entry", "unresolved"), F.coalesce("expand_status", F.lit("")))
    direct, unpacked, short, rare = "matched_direct_feature", "collection_unpacked", "excluded_short", "rare_edge_case"
    d = (
        F.when(F.col("in_rare"), made(rare, "listed_in_rare_edge_cases")).when(F.col("in_excluded"), made(short, "listed_in_excluded_shorts"))
        .when(F.col("final_via") == "expanded_collection", made(unpacked, "final_via_expanded_collection"))
        .when(F.col("final_via").isNotNull(), made(direct, F.concat(F.lit("final_matched_via="), F.when(F.trim("final_via") == "", "unknown").otherwise(F.trim("final_via")))))
        .when(a.isin("collection", "collection_label"), made(unpacked, F.concat(F.lit("manual_resolution_"), a))).when(a.isin(*MATCH_ACTIONS), made(direct, "manual_resolution_pending_build_final"))
        .when(a.isin(*SHORT_ACTIONS), made(short, "manual_resolution_exclude_short")).when(a.isin("rare_edge_case", "flag_edge_case"), made(rare, "manual_resolution_rare_edge"))
        .when(status == "resolved", made(unpacked, "collection_container_expand_resolved")).when(status.isin("partial", "needs_manual_decomposition"), made("unresolved", F.concat(F.lit("collection_expand_"), status)))
        .when(a.isin("no_imdb_entry", "unresolved"), made("unresolved", a)).otherwise(made("unresolved", "not_classified"))
    )
    x = x.withColumn("_d", d).withColumn("disposition", F.col("_d.name")).withColumn("detail", F.col("_d.detail")).drop("_d")
    label = F.when(F.col("disposition") == direct, "1_matched_direct_full_length").when(F.col("disposition") == unpacked, "2_unpacked_from_collection").when(F.col("disposition") == short, "3_identified_short_excluded").when(F.col("disposition") == rare, "4_rare_edge_case")
    return x.withColumn("bucket", label.otherwise("unresolved"))


def stage6_bucket(title: Column, year: Column, kind: Column, years_off: Sequence[str] = (), years_match: Sequence[str] = (), fixed: dict[str, str] | None = None) -> Column:
    """Final bucket of a manually reviewed row; title lists are parameters."""
    out = F.when(F.lit(False), "")
    for t, b in (fixed or {}).items():
        out = out.when(title == t, b)
    out = out.when(kind.isin(*OTHER_CONTENT), "Other Content").when(kind.isin("collection", "collection_label"), "Unverified Titles")
    movie = kind == "movie"
    out = out.when(movie & title.isin(*years_match), "Years Match") if years_match else out
    out = out.when(movie & (F.trim(F.coalesce(year.cast("string"), F.lit(""))) == ""), "Unverified Titles")
    out = out.when(movie & title.isin(*years_off), "Years Off") if years_off else out
    return out.when(movie, "Years Match").otherwise("Data Issues / Untracked")


# --- reports ----------------------------------------------------------------------------------


def counts_as_metrics(x: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(metric, value): ``column::value`` counts of several columns from one pass, by grouping sets."""
    long = x.select(F.explode(F.array(*[F.concat(F.lit(f"{c}::"), F.col(c).cast("string")) for c in columns])).alias("metric"))
    return long.filter("metric is not null").groupBy("metric").agg(F.count("*").alias("value"))


def metrics(x: DataFrame, named: dict[str, Column]) -> DataFrame:
    """(metric, value double): several aggregates of one pass, one row each."""
    one = x.agg(*[c.cast("double").alias(f"m{i}") for i, c in enumerate(named.values())])
    rows = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(f"m{i}").alias("value")) for i, n in enumerate(named)])
    return one.select(F.explode(rows).alias("x")).select("x.metric", "x.value")


def percentage(part: Column, whole: Column) -> Column:
    """Share in percent, two digits; 0 of nothing."""
    return F.coalesce(F.round(100.0 * part / F.nullif(whole.cast("double"), F.lit(0.0)), 2), F.lit(0.0))


# --- canonical titles, methods, review and checks (specified, not coded, in the original) -----


def canonical_titles(x: DataFrame) -> DataFrame:
    """Adds canonical_id and method to rows (row_id, ref_id, title_key, year, standalone): by reference id, else by title and year.

    The canonical row of a group is a standalone one if any is, then the smallest row id.
    """
    has = F.coalesce(F.trim(F.col("ref_id").cast("string")), F.lit("")) != ""
    x = x.withColumn("method", F.when(has, "id").otherwise("title_year")).withColumn("_k", F.when(has, F.concat(F.lit("i|"), F.col("ref_id").cast("string"))).otherwise(F.concat_ws("|", F.lit("t"), "title_key", F.col("year").cast("string"))))
    w = Window.partitionBy("_k").orderBy(F.desc("standalone"), "row_id")
    return x.withColumn("canonical_id", F.first("row_id").over(w)).drop("_k")


def match_method(via: Column, gap: Column, fuzzy: Column, manual: Column) -> Column:
    """struct(method, confidence) of a match, strongest evidence first."""
    has = lambda v: F.array_contains(via, v)
    exact = has("title_exact")
    method = (
        F.when(manual, "manual").when(exact & (gap == 0), "exact_title_and_year").when(exact & (gap == 1), "exact_title_year_within_1").when(exact, "exact_title")
        .when(has("title_normalized"), "normalized_title").when(has("aka_exact") | has("aka_normalized"), "alternate_title").when(fuzzy, "fuzzy").otherwise("none")
    )
    confidence = F.when(method.isin("manual", "exact_title_and_year"), "high").when(method.isin("exact_title_year_within_1", "exact_title", "normalized_title"), "medium").otherwise("low")
    return F.struct(method.alias("method"), confidence.alias("confidence"))


def review_reasons(named: dict[str, Column]) -> Column:
    """Sorted array of the reasons whose conditions hold."""
    return F.array_sort(F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in named.items()]), lambda r: r.isNotNull()))


def failure_status(candidates: Column, contaminated: Column, conflict: Column, known_fields: Column) -> Column:
    """Why a title has no match: its source row first, then its candidates, then their metadata; null where nothing failed."""
    return (
        F.when(F.coalesce(contaminated, F.lit(False)), "contaminated_source_row").when(F.coalesce(candidates, F.lit(0)) == 0, "no_match_found")
        .when(F.coalesce(conflict, F.lit(False)), "metadata_conflict").when(F.coalesce(known_fields, F.lit(0)) == 0, "insufficient_metadata").when(candidates > 1, "multiple_candidates")
    )


def required_lookup(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Rows joined to a table that must know every key; a key that it lacks is an error that names some."""
    missing = [r[0] for r in rows.join(table, key, "left_anti").select(key).distinct().orderBy(key).limit(5).collect()]
    if missing:
        raise KeyError(f"{key} without a row: {missing}")
    return rows.join(table, key)


def rich_rows(x: DataFrame, id_col: str, either: Sequence[str]) -> DataFrame:
    """Rows with an id, of a table that has one of the columns; any other table has none."""
    if id_col not in x.columns or not set(either) & set(x.columns):
        return x.limit(0)
    return x.filter(F.trim(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) != "")


def validation_metrics(tables: dict[str, DataFrame]) -> DataFrame:
    """(metric, value): the 24 counts of a finished run.

    tables: catalog (row_id), initial, unmatched, resolved, constituents (ref_id, include), shorts,
    final (row_id, source_id, ref_id, signal, via), excluded, rare (row_id each), containers (source_id),
    dispositions (disposition).  Each table is read once.
    """
    blank = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""
    ids = lambda t: tables[t].select("row_id").filter(~blank("row_id")).distinct()
    flag = tables["containers"].select("source_id").distinct().withColumn("_c", F.lit(True))
    final = tables["final"].join(flag, "source_id", "left")
    terminal = ids("initial").union(ids("excluded")).union(ids("rare")).distinct()
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    kinds = ["unresolved", "matched_direct_feature", "collection_unpacked", "excluded_short", "rare_edge_case"]
    done = F.col("disposition").isin(*kinds[1:])
    parts = [
        metrics(tables["catalog"], {"source_rows": F.count("*")}), metrics(tables["initial"], {"initial_matches_rows": F.count("*")}), metrics(tables["unmatched"], {"unmatched_tracking_rows": F.count("*")}),
        metrics(tables["resolved"], {"resolved_collections_rows": F.count("*")}), metrics(tables["shorts"], {"collection_shorts_rows": F.count("*")}),
        metrics(tables["constituents"], {"collection_constituent_films_rows": F.count("*"), "constituents_with_id": F.coalesce(count(~blank("ref_id")), F.lit(0)), "constituents_included": F.coalesce(count(F.col("include")), F.lit(0))}),
        metrics(final, {"final_rows": F.count("*"), "final_rows_missing_valid_id": F.coalesce(count(~F.startswith(F.trim(F.coalesce("ref_id", F.lit(""))), F.lit("tt"))), F.lit(0)), "final_rows_not_feature": F.coalesce(count(~blank("signal") & (F.trim("signal") != FEATURE)), F.lit(0)), "container_single_film_violations": F.coalesce(count(F.coalesce("_c", F.lit(False)) & (F.trim(F.coalesce("via", F.lit(""))) != "expanded_collection")), F.lit(0))}),
        metrics(ids("final"), {"final_unique_row_ids": F.count("*")}), metrics(tables["excluded"], {"excluded_shorts_rows": F.count("*")}), metrics(tables["rare"], {"rare_edge_cases_rows": F.count("*")}),
        metrics(terminal, {"terminal_status_row_ids": F.count("*")}), metrics(ids("unmatched").join(terminal, "row_id", "left_anti"), {"still_unresolved_row_ids": F.count("*")}),
        metrics(tables["dispositions"], {**{f"disposition_{k}": F.coalesce(count(F.col("disposition") == k), F.lit(0)) for k in kinds}, "terminal_rows": F.coalesce(count(done), F.lit(0)), "coverage_pct": percentage(F.coalesce(count(done), F.lit(0)), F.count("*"))}),
    ]
    return reduce(DataFrame.unionByName, parts)


def quality_checks(x: DataFrame) -> DataFrame:
    """(check_name, violations) of the seven final checks, from one pass and one aggregate by id.

    x: row_id, ref_id, bucket, kind, runtime, title, year, start_year, retained, explanation, provenance,
    in_review.
    """
    blank = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""
    verified = F.col("bucket").isin("Years Match", "Years Off")
    finals = ("Years Match", "Years Off", "Other Content", "Unverified Titles", "Data Issues / Untracked")
    feature = (F.col("kind") == "movie") & (F.col("runtime") > 40)
    off = F.col("bucket") == "Years Off"
    one = {
        "package_rows": verified & (F.lower("title").rlike("|".join(("collection", "trilogy", "anthology", "box set"))) | F.contains("title", F.lit(" / "))),
        "rows_without_bucket": ~F.coalesce(F.col("bucket").isin(*finals), F.lit(False)), "verified_rows_without_id": verified & blank("ref_id"),
        "verified_rows_not_feature": verified & ~F.coalesce(feature, F.lit(False)), "year_off_rows_unexplained": off & (F.col("year").isNull() | F.col("start_year").isNull() | F.col("retained").isNull() | blank("explanation")),
        "open_reviews": F.col("in_review") & blank("bucket"),
    }
    checks = metrics(x, {n: F.count_if(F.coalesce(c, F.lit(False))) for n, c in one.items()})
    twice = x.filter(verified & ~blank("ref_id")).groupBy("ref_id").agg(F.count("*").alias("n"), F.count_if(blank("provenance")).alias("bare")).filter("n > 1 and bare > 0")
    spread = x.groupBy("row_id").agg(F.count_distinct("bucket").alias("n")).filter("n > 1")
    every = checks.unionByName(metrics(twice, {"unexplained_duplicate_ids": F.count("*")})).unionByName(metrics(spread, {"rows_in_several_buckets": F.count("*")}))
    return every.select(F.col("metric").alias("check_name"), F.col("value").cast("long").alias("violations"))
