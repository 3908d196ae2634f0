import os

import pytest

from catlink.llm.token_rollup import SCHEMA, RollupStore, changes


def totals(store):
    return sorted((tuple(r) for r in store.totals().collect()), key=str)


def test_signed_batches_and_idempotence(spark, tmp_path):
    rows = [(1, "a", "en", 10), (2, "a", "en", 5), (3, None, "fr", 7), (4, "b", None, None), (4, "b", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n long").selectExpr("*", "1 as tokens", "2 as documents")
    store = RollupStore(spark, str(tmp_path / "s"))
    assert totals(store) == []
    assert store.commit("one", changes(df, "t@1", 1, "n"))
    loaded = totals(store)
    assert loaded == sorted([("a", "en", "t@1", 2, 15), (None, "fr", "t@1", 1, 7), ("b", None, "t@1", 2, 0)], key=str)
    assert not store.commit("one", changes(df, "t@1", 1, "n")) and totals(store) == loaded
    store.commit("revise", changes(df.filter("doc_id = 1"), "t@1", 0, df.n + 3, was="n"))
    store.commit("delete", changes(df.filter("doc_id in (2, 3)"), "t@1", -1, "n"))
    store.commit("empty", spark.createDataFrame([], SCHEMA))
    want = sorted([("a", "en", "t@1", 1, 13), ("b", None, "t@1", 2, 0)], key=str)
    assert totals(store) == want
    store.compact()
    assert totals(store) == want and store.committed() == {"one", "revise", "delete", "empty"}
    assert not store.commit("delete", changes(df, "t@1", -1, "n")) and totals(store) == want
    store.commit("more", changes(df.filter("doc_id = 2"), "t@2", 1, "n"))
    store.compact()
    assert ("a", "en", "t@2", 1, 5) in totals(store) and len(totals(store)) == 3
    with pytest.raises(ValueError):
        store.commit("a/b", df)


def test_commit_cut_short_was_never_there(spark, tmp_path):
    store = RollupStore(spark, str(tmp_path / "s"))
    one = spark.createDataFrame([("a", "en", "t", 1, 4)], SCHEMA)
    one.write.parquet(str(tmp_path / "s" / "batches" / "_half"))
    assert totals(store) == [] and store.commit("x", one) and totals(store) == [("a", "en", "t", 1, 4)]


def test_two_writers_of_one_id(spark, tmp_path):
    one = spark.createDataFrame([("a", "en", "t", 1, 4)], SCHEMA)

    class Slow(RollupStore):
        def _has(self, batch):
            found = super()._has(batch)
            if not found:
                assert RollupStore(self.spark, self.path).commit(batch, one)  # the other one, after the look
            return found

    store = Slow(spark, str(tmp_path / "s"))
    assert not store.commit("x", one) and totals(store) == [("a", "en", "t", 1, 4)]
    assert os.listdir(tmp_path / "s" / "batches") == ["batch-x"]


@pytest.mark.parametrize("moment", ["_ids", "_sum"])
def test_commits_during_a_compaction_count_once(spark, tmp_path, moment):
    def row(n):
        return spark.createDataFrame([("a", "en", "t", 1, n)], SCHEMA)

    class Watched(RollupStore):
        def meanwhile(self):
            other = RollupStore(self.spark, self.path)
            assert other.commit("late", row(100)) or other.committed() >= {"late"}

    def hooked(self, *args):
        self.meanwhile()
        return getattr(RollupStore, moment)(self, *args)

    setattr(Watched, moment, hooked)
    plain = RollupStore(spark, str(tmp_path / "s"))
    plain.commit("a", row(1)), plain.compact(), plain.commit("b", row(10))
    Watched(spark, plain.path).compact()
    assert totals(plain) == [("a", "en", "t", 3, 111)]
    assert not plain.commit("late", row(100)) and not plain.commit("b", row(10))
    plain.compact(), plain.compact()
    assert totals(plain) == [("a", "en", "t", 3, 111)] and plain.committed() == {"a", "b", "late"}
    assert plain._list("batches") == [] or set(plain._list("batches")) <= {"batch-late"}


def test_two_compactions(spark, tmp_path):
    store = RollupStore(spark, str(tmp_path / "s"))
    store.commit("a", spark.createDataFrame([("a", "en", "t", 1, 4)], SCHEMA))

    class Slow(RollupStore):
        def _sum(self, *args):
            if not self._list("base"):
                assert RollupStore(self.spark, self.path).compact()
            return super()._sum(*args)

    assert not Slow(spark, store.path).compact() and totals(store) == [("a", "en", "t", 1, 4)]
