import html
import random
import re
import unicodedata

import duckdb
import pytest
from pyspark.sql import functions as F

from catlink.functions import text as T

CASES = {
    "The Apu Trilogy": "apu trilogy", "Gray’s Anatomy": "grays anatomy", "W. C. Fields—Six Short Films": "w c fieldssix short films",
    "Zéro de conduite": "zero de conduite", "Jean & Manon": "jean and manon", "Straße": "strasse", "½ Mensch": "12 mensch", "Łódź": "odz",
    "Ｆｕｌｌ Ｗｉｄｔｈ": "full width", "ﬁlm": "film", "A": "a", "": "", "…And Justice": "and justice", "An  An Evening": "an evening",
}


def rows(spark, values, *columns):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [tuple(r) for r in df.select(*[c(F.col("x")) for c in columns]).collect()]


def test_titles(spark):
    got = rows(spark, [*CASES, None], T.normalize_title)
    assert [r[0] for r in got] == [*CASES.values(), ""]
    assert [T.python_title(x) for x in CASES] == list(CASES.values())


def test_titles_match_unicode_and_are_idempotent(spark):
    random.seed(4)
    pool = [*range(32, 127), *range(0xA1, 0x250), 0x2019, 0x2014, 0x2026, 0x2122, 0xFB01, 0x4E2D, 0xFF21]
    values = ["x" + "".join(chr(random.choice(pool)) for _ in range(random.randint(0, 25))) for _ in range(800)]
    got = [r[0] for r in rows(spark, values, T.normalize_title)]
    assert got == [T.python_title(v) for v in values]


def test_variants(spark):
    assert rows(spark, ["Zéro de conduite"], T.hint_key) == [("zro de conduite",)]
    assert rows(spark, ["Straße"], T.hint_key) == [("strasse",)]
    assert rows(spark, ["Fields—Six &amp; co"], T.hint_key) == [("fields six and co",)]
    assert rows(spark, ["I Am Curious", "Don't", "Don’t"], T.reanchor_title) == [("am curious",), ("don t",), ("dont",)]
    assert rows(spark, ["  “Été”  — x!?  "], T.page_key) == [('"été" - x',)]
    assert rows(spark, ["J. R. Smith"], T.normalize_person) == [("smith",)]


def test_names(spark):
    assert rows(spark, ["Joel and Ethan Coen, X & Y", " , ", "", None, "A y B et C"], T.split_names) == [(["Joel", "Ethan Coen", "X", "Y"],), ([","],), ([],), ([],), (["A", "B", "C"],)]
    df = spark.createDataFrame([(["lee ann"], ["ann lee"], True), (["lee lee"], ["lee x"], True), (["joel"], ["joel coen"], True), (["joel coen"], ["ethan coen"], False), ([], ["x"], False), ([""], [""], False)], "a array<string>, b array<string>, want boolean")
    assert df.filter(T.name_sets_match(F.col("a"), F.col("b")) != F.col("want")).count() == 0


@pytest.mark.parametrize(
    ("f", "cases"),
    [
        (T.strict_int, {"1999": 1999, " 7 ": 7, "": None, "\\N": None, "12.5": None, "1_0": None, "-3": -3}),
        (T.lenient_int, {"12.5": 12, "7": 7, "x": None, "": None, "1e2": 100}),
        (T.tri_bool, {"True": True, "FALSE ": False, "yes": None}),
        (T.yes_no, {"Yes": True, "0": False, "?": None}),
        (T.strip_tags, {"a<b>c</b>&amp;  d": "a c &d".replace("&d", "& d")}),
        (T.file_stem, {"The X Y": "x_y", "!": "collection_lookup"}),
        (T.decode_json_text, {"a\\u00e9\\/b": "aé/b", 'q"x\\/': 'q"x/'}),
    ],
)
def test_values(spark, f, cases):
    assert [r[0] for r in rows(spark, list(cases), f)] == list(cases.values())


def test_title_and_year(spark):
    df = spark.createDataFrame([("The Film: 1987 cut",), ("1984",), ("none",), ("x 21999",)], "x string")
    got = [r[0] and tuple(r[0]) for r in df.select(T.title_and_year(F.col("x"))).collect()]
    assert got == [("The Film", 1987), None, None, None]


def test_similarity(spark):
    df = spark.createDataFrame([("a b c", "b c d"), ("", "x"), ("A b!", "a B")], "a string, b string")
    assert [r[0] for r in df.select(T.token_jaccard(F.col("a"), F.col("b"))).collect()] == [0.5, 0.0, 1.0]
    assert spark.range(1).select(T.set_jaccard(F.array().cast("array<int>"), F.array().cast("array<int>"))).first()[0] == 1.0


def test_sql_chains_agree():
    con = duckdb.connect()
    for x, want in CASES.items():
        assert con.execute(f"SELECT {T.title_sql('x')} FROM (SELECT ? AS x)", [x]).fetchone()[0] == want


def python_anchor(text):
    x = unicodedata.normalize("NFKD", text or "").encode("ascii", "ignore").decode()
    return re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", x.casefold())).strip()


def python_hint(text):
    x = html.unescape((text or "").strip().casefold()).replace("\u2013", "-").replace("\u2014", "-")
    x = re.sub(r"^(a|an|the)\s+", "", re.sub("[’'`´]", "", x)).replace("&", " and ")
    return " ".join(re.sub(r"[^a-z0-9]+", " ", x.encode("ascii", "ignore").decode()).split())


def test_keys_of_all_code_points(spark):
    """Against Python's own case folding and decomposition, not against the tables."""
    points = [n for n in range(1, 0x110000) if not 0xD800 <= n < 0xE000 and (n < 0x10000 or unicodedata.normalize("NFKD", chr(n)) != chr(n) or chr(n).casefold() != chr(n))]
    values = [f"x{chr(n)}Y" for n in points] + [f"{chr(n)} the {chr(n)}{chr(n + 1) if n + 1 < 0xD800 else ''}" for n in points[:60000:7]]
    got = rows(spark, values, T.normalize_title, T.reanchor_key, T.hint_key)
    want = [(T.python_title(v), python_anchor(v), python_hint(v)) for v in values]
    wrong = [(v, [hex(ord(c)) for c in v], g, w) for v, g, w in zip(values, got, want, strict=True) if g != w]
    assert not wrong, (len(wrong), wrong[:10])


def test_entities_match_the_html_table(spark):
    random.seed(12)
    values = [f"a&{k}b" for k in html.entities.html5] + [f"&{k[:-1]} " for k in html.entities.html5 if k.endswith(";")][::3]
    values += [f"&#{n};" for n in [*range(0, 300), 8217, 0x1F600, 0xD800, 0xDFFF, 0xFDD0, 0xFFFE, 0xFFFF, 0x10FFFF, 0x110000, 10**12]] + [f"&#x{n:X}z" for n in (0, 13, 0x41, 0x80, 0x9F, 0x2019, 0x1FFFE, 0x1F600, 10**15)]
    values += ["", "&", "&&amp;", "&amp;amp;", "&;", "&#;", "&#x;", "&notit;", "&notin;", "&unknown; &Eacute;t&eacute", "x&lt;b&gt;y", "&#00065;", "&#x00041", "&" + "q" * 40]
    values += ["".join(random.choice(["&", "amp", ";", "#", "1", "x", " ", "lt", "copy", "é", "<"]) for _ in range(12)) for _ in range(400)]
    got = [r[0] for r in rows(spark, values, T.unescape_entities)]
    wrong = [(v, g, html.unescape(v)) for v, g in zip(values, got, strict=True) if g != html.unescape(v)]
    assert not wrong, (len(wrong), wrong[:10])
    assert rows(spark, ["Caf&eacute; <b>It&#8217;s</b>"], T.strip_tags) == [("Café It’s",)]
    assert rows(spark, ["⑩ Films", "㎏ x"], T.normalize_title) == [("10 films",), ("kg x",)]
