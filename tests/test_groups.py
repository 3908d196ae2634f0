import random

import pytest
from pyspark.sql import functions as F

from catlink.functions.text import python_title as norm
from catlink.operators import groups as G

KNOWN = {"The Red Trilogy": ["Red One", "Red Two", "Red Three"], "Blue Box": ["Blue A", "Blue B"]}
HINTS = G.CONTAINER_HINTS


def container(r):
    t = r["title"].lower()
    return any(h in t for h in HINTS) or ((not r["director"] or not r["year"]) and ("/" in t or ":" in t)) or norm(r["title"]) in map(norm, KNOWN) or "eclipse series" in t


def expected(title):
    for k, v in KNOWN.items():
        if norm(k) == norm(title):
            return v, "known_collection_map"
    if " / " in title:
        return [p.strip() for p in title.split("/") if p.strip()], "slash_split"
    return [], "needs_manual_decomposition"


def walk(rows):
    """The groups by a walk over the catalog, written from the rules."""
    out, spare = [], {}
    for r in rows:
        if not r["spine"] and r["director"]:
            spare.setdefault(norm(r["title"]), r)
    taken = set()
    for i, r in enumerate(rows):
        if not container(r):
            continue
        want, method = expected(r["title"])
        if not r["spine"] and not r["director"]:
            kids = []
            for n in rows[i + 1 :]:
                if n["spine"] or not n["director"]:
                    break
                kids.append(n)
            if not kids and not want:
                continue
            method = "spineless_catalog_children" if not want else method + ("+spineless_block" if len(kids) == len(want) else "+spineless_partial" if kids else "+spineless_no_children")
            kind = "spineless"
        elif r["spine"] and not r["director"]:
            if not want:
                continue
            kids = []
            for n, w in zip(rows[i + 1 :], want, strict=False):
                a, b = norm(n["title"]), norm(w)
                if not n["spine"] or not n["director"] or not (a in b or b in a):
                    break
                kids.append(n)
                taken.add(n["idx"])
            method += "+following_spines" if len(kids) == len(want) else "+following_spines_partial" if kids else "+virtual_only"
            kind = "spined"
        elif r["spine"] and want and r["idx"] not in taken:
            kids, method, kind = [], method + "+single_row_box", "spined"
        else:
            continue
        real = bool(kids)
        kids = kids or [{"source_id": "", "title": w, "director": "", "year": ""} for w in want]
        for seq, k in enumerate(kids, 1):
            s = None if real else spare.get(norm(k["title"]))
            k = s or k
            out.append((r["idx"], kind, method, seq, k["source_id"], k["title"], k["director"], k["year"], real or s is not None))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_discovery_matches_a_walk(spark, seed):
    random.seed(seed)
    titles = ["The Red Trilogy", "Blue Box", "Red One", "Red Two", "Red Three", "Blue A", "Blue B", "Plain", "Some Collection", "X / Y", "X", "Y", "What: ever"]
    rows = []
    for i in range(120):
        spine = random.choice(["", str(i), str(i)])
        rows.append({"idx": i, "source_id": spine or f"row_{i}", "spine": spine, "title": random.choice(titles), "director": random.choice(["", "Ann", "Bob"]), "year": random.choice(["", "1999"])})
        if random.random() < 0.3 and rows[-1]["title"] == "The Red Trilogy":
            for w in KNOWN["The Red Trilogy"][: random.randint(1, 3)]:
                rows.append({"idx": 1000, "source_id": "", "spine": "7", "title": w + random.choice(["", " II"]), "director": "Ann", "year": "1999"})
    for i, r in enumerate(rows):
        r["idx"] = i
        r["spine"] = str(i) if r["spine"] else ""
        r["source_id"] = r["spine"] or f"row_{i}"
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "idx long, source_id string, spine string, title string, director string, year string")
    got = sorted((r.idx, r.kind, r.method, r.seq, r.film_source_id, r.film_title, r.film_director, r.film_year, r.from_catalog) for r in G.discover_groups(df, KNOWN).collect())
    assert got == walk(rows)


def test_merge_fragments(spark):
    rows = spark.createDataFrame([(1, "Good, the Bad, and Ugly, Solo, A"), (2, ""), (3, "x")], "id int, raw string")
    keys = spark.createDataFrame([("good the bad and ugly",), ("solo",), ("solo a",)], "key string")
    got = {r.id: r.titles for r in G.merge_fragments(rows, "id", "raw", keys).collect()}
    assert got == {1: ["Good, the Bad, and Ugly", "Solo, A"], 2: [], 3: ["x"]}


def test_splits(spark):
    cases = {
        "Yojimbo / Sanjuro: Two Films": (["Yojimbo", "Sanjuro: Two Films"], "slash_split"), "Box: A, B ,C": (["A", "B", "C"], "colon_right_comma_split"), "Box: only": ([], "needs_manual_decomposition"), "A/B": ([], "needs_manual_decomposition"),
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert [(r[0].titles, r[0].method) for r in df.select(G.split_constituents(F.col("t"))).collect()] == list(cases.values())


def test_plurality_takes_the_first_of_equals(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (1, "a", 3), (1, "b", 4), (2, "", 1), (2, "z", 2)], "g int, v string, o int")
    assert {r.g: r.v for r in G.plurality(df, "g", "v", "o").collect()} == {1: "b", 2: "z"}
