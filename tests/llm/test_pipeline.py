import random
import re

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    random.seed(21)
    words = ["".join(random.choices("abcdefghijklmnop", k=random.randint(3, 9))) for _ in range(3000)]
    text = lambda n: " ".join(random.choice(words) for _ in range(n))
    docs = {i: text(random.randint(80, 160)) for i in range(300)}
    for i in range(0, 40):
        docs[1000 + i] = docs[i]  # exact copies
        w = docs[100 + i].split()
        w[len(w) // 2] = "edited"
        docs[1100 + i] = " ".join(w)  # near copies
    passage = text(60)
    for i in range(10):
        docs[2000 + i] = text(60) + " " + passage + " " + text(60)
    items = {i: text(9) + ". " + text(12) + ". " + text(6) + "." for i in range(20)}
    for i in range(20):
        docs[3000 + i] = text(50) + " " + items[i] + " " + text(50)
    for i in range(30):
        docs[4000 + i] = " ".join(w.upper() + "!!" for w in text(50).split())
    docs |= {5000: "", 5001: None}
    top = str(tmp_path_factory.mktemp("sf"))
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in docs.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame(list(items.items()), "item_id long, text string").write.parquet(f"{top}/benchmark.parquet")
    spark.createDataFrame([(i, int(i < 4000), 0) for i in docs], "doc_id long, quality int, toxic int").write.parquet(f"{top}/labels.parquet")
    return top, docs, items, passage


def test_each_stage(spark, folder):
    top, docs, items, passage = folder
    frame = spark.read.parquet(f"{top}/documents.parquet")
    steps = []
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, top)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert frame.columns == COLUMNS
            frame = spark.createDataFrame(frame.collect(), frame.schema)
            steps.append({r.doc_id: r for r in frame.collect()})
    one, two, three, four = steps
    assert not [i for i in one if 4000 <= i < 5000] and set(one) == {i for i in docs if not 4000 <= i < 5000}
    gone = set(one) - set(two)
    assert {i for i in gone if i < 5000} == set(range(1000, 1040)) | {i for i in gone if 1100 <= i < 1140} and len([i for i in gone if 1100 <= i < 1140]) >= 38
    holders = [i for i in three if passage in (three[i].text or "")]
    assert holders == [2000] and all(three[i].n_chars == len(three[i].text or "") for i in three)
    assert all(three[i].text == docs[i] for i in three if not 2001 <= i < 2010)
    assert set(three) - set(four) == {3000 + i for i in items}
    tokens = {r.doc_id: r for r in frame.collect()}
    assert set(tokens) == set(four)
    for i, r in tokens.items():
        assert r.n_tokens == len(r.ids.split()) and re.sub("</w>| ", "", r.decoded) == re.sub(r"\s", "", (four[i].text or "").lower())


def test_run(spark, folder):
    top, docs, _, _ = folder
    out = corpus_pipeline.run(spark, top)
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded"] and 0 < out.count() < len(docs)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _i int, _row string, carried string, score int, kept int"


def test_stages_handle_odd_rows(spark, folder):
    top, docs, items, _ = folder
    odd = [
        (None, None, None, None, None, 1, "a", "b", 2, 3), (None, "only words here", None, None, None, None, None, None, None, None), (1, "", "en", "s", 0, 1, "a", "b", 2, 3), (1, "", "en", "s", 0, 1, "a", "b", 2, 3),
        (2, "x" * 50_000, "en", "s", 1, 1, "a", "b", 2, 3), (3, "word " * 40_000, "en", "s", 1, 1, "a", "b", 2, 3), (4, docs[0], "en", "s", 1, 1, "a", "b", 2, 3), (5, docs[0], "en", "s", 1, 1, "a", "b", 2, 3), (5, docs[0], "en", "s", 1, 1, "a", "b", 2, 3),
    ]
    frame = spark.createDataFrame(odd, SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, top)
        assert out.columns == frame.columns, name
        rows = out.collect()
        assert len(rows) <= len(odd) and {r.score for r in rows} <= {2, None}, name
        if name == "SimHash near-dedup":  # all texts without words are one group; so are the copies
            assert sorted(str(r.doc_id) for r in rows) == ["1", "2", "3", "4", "None"]
        assert stage(spark, frame.limit(0), top).count() == 0
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, frame, top).count() == len(odd) and last(spark, frame.limit(0), top).count() == 0
