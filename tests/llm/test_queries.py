import os

import pytest

from catlink.llm.queries import oracle_sql, queries
from tests.parity import SF, compare, connection

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 11))
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, name):
    compare(connection(), queries()[name](spark, SF), oracle_sql()[name])


def test_columns_of_the_contracts(spark):
    want = {
        "op2_simhash": ["doc_id", "fingerprint", "component_id"], "op5_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        "op9_lattice_lm": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"], "op10_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    }
    rows = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name, columns in want.items():
        df = queries()[name](spark, SF)
        assert df.columns[: len(columns)] == columns and df.count() == rows


def test_op5_returns_the_text_that_is_left(spark):
    from pyspark.sql import functions as F

    out = queries()["op5_suffix_dedup"](spark, SF)
    own = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("own"))
    left = out.join(own, "doc_id").select("text", "own", "n_removed", (F.sha2("text", 256) == F.col("kept_sha256")).alias("same"), F.contains("text", F.lit("�")).alias("cut")).collect()
    assert all(r.same or r.cut for r in left) and all(r.text == r.own for r in left if r.n_removed == 0)
    assert any(r.n_removed for r in left)


def test_op5_tells_passages_of_over_50_words_that_are_below_400_bytes(spark, tmp_path):
    import random

    random.seed(8)
    text = lambda n: " ".join("".join(random.choices("abcdefghé", k=random.randint(3, 7))) for _ in range(n))
    passage = text(55)
    assert 300 < len(passage.encode()) < 400
    own = {i: (text(80), text(80)) for i in range(6)}
    rows = [(i, f"{a} {i} {passage} {i} {b}" if i in (2, 4, 5) else f"{a} {b}") for i, (a, b) in own.items()]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in queries()["op5_suffix_dedup"](spark, str(tmp_path)).collect()}
    assert all(out[i].text == t and out[i].n_removed == 0 for i, t in rows)  # the contract's 400 bytes
    assert [i for i in out if passage in out[i].text_once] == [2]
    assert {i for i, t in rows if out[i].text_once != t} == {4, 5} == {i for i in out if out[i].n_later}
    assert all(out[i].text_once == f"{own[i][0]} {i}{i} {own[i][1]}" for i in (4, 5))
