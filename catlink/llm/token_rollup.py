"""Token counts as delta-maintained rollups (operator 6).

Totals by (source, language, tokenizer version) are never recounted: a batch of signed changes is
pre-aggregated to its deltas and committed under its batch id, and the totals are the sum of the
committed batches.  Inserts add a document and its tokens, deletes take both away, revisions add
the difference of two counts.

Commits are idempotent and atomic: a batch is written to a folder of its own and published by one
rename that fails where the id is taken, so of several writers of an id one succeeds and a commit
that was cut short was never there.  ``compact`` folds the batches of one listing into a base that
names their ids, published in the same way.  A batch counts unless the base names it, so one
committed during the compaction is neither lost nor counted twice; folded batches and the base
before are deleted by the next compaction, when readers have had time to finish.

Cases: null sources and languages are keys of their own; a null count is 0; groups whose documents
and tokens are both 0 are not shown; an empty batch commits and changes nothing; texts are counted
before they come here, so their length doesn't matter; other columns of the counts are ignored,
whatever their names.
"""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catlink.functions.runtime import shared_root

KEYS = ["source", "lang", "tokenizer"]
SCHEMA = "source string, lang string, tokenizer string, documents long, tokens long"


def changes(counts: DataFrame, tokenizer: str, sign: int, tokens: Column | str, was: Column | str | None = None) -> DataFrame:
    """Deltas of counted documents: sign 1 inserts, -1 deletes, 0 revises from ``was`` to ``tokens``."""
    now = F.coalesce(tokens if isinstance(tokens, Column) else F.col(tokens), F.lit(0)).cast("long")
    before = F.lit(0) if was is None else F.coalesce(was if isinstance(was, Column) else F.col(was), F.lit(0))
    amount = now - before if sign == 0 else now * sign
    return counts.select(F.col("source"), F.col("lang"), F.lit(tokenizer).alias("tokenizer"), F.lit(sign).cast("long").alias("documents"), amount.cast("long").alias("tokens"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def publish(spark: SparkSession, made: str, place: str) -> bool:
    """Renames a finished folder to its place, in one step; False, and the folder goes, where the place is taken."""
    fs, jvm = spark._jvm.org.apache.hadoop.fs, spark._jvm
    source, target = fs.Path(made), fs.Path(place)
    context = fs.FileContext.getFileContext(source.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getUri())
    try:
        context.rename(source, target, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError as e:
        if not context.util().exists(target):
            raise e
        delete_folder(spark, made)
        return False
    return True


class RollupStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _list(self, name: str) -> list[str]:
        """Published entries, in order; what begins with an underscore is being written."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        fs = p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        return [x for x in sorted(f.getPath().getName() for f in fs.listStatus(p)) if not x.startswith("_")] if fs.exists(p) else []

    def _ids(self, base: str) -> DataFrame:
        return self.spark.read.schema("batch string").json(f"{self.path}/base/{base}/ids")

    def _state(self) -> tuple[str | None, list[str], list[str]]:
        """(base, batches that it holds, batches that it doesn't); batches are listed before the base."""
        present = [x.removeprefix("batch-") for x in self._list("batches")]
        bases = self._list("base")
        if not bases:
            return None, [], present
        folded = {r[0] for r in self._ids(bases[-1]).filter(F.col("batch").isin(present)).collect()}
        return bases[-1], [x for x in present if x in folded], [x for x in present if x not in folded]

    def committed(self) -> set[str]:
        """Ids of the batches that count, compacted ones included."""
        base, folded, fresh = self._state()
        return {*folded, *fresh, *({r[0] for r in self._ids(base).collect()} if base else ())}

    def _has(self, batch: str) -> bool:
        if f"batch-{batch}" in self._list("batches"):
            return True
        bases = self._list("base")
        return bool(bases) and not self._ids(bases[-1]).filter(F.col("batch") == batch).isEmpty()

    def commit(self, batch: str, deltas: DataFrame) -> bool:
        """Commits a batch of deltas once; False if its id is committed already."""
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
            raise ValueError(f"batch id: {batch!r}")
        if self._has(batch):
            return False
        summed = deltas.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        made = f"{self.path}/batches/_{uuid.uuid4().hex}"
        summed.coalesce(1).write.parquet(made)
        return publish(self.spark, made, f"{self.path}/batches/batch-{batch}")

    def _sum(self, base: str | None, fresh: list[str]) -> DataFrame:
        paths = ([f"{self.path}/base/{base}/totals"] if base else []) + [f"{self.path}/batches/batch-{x}" for x in fresh]
        rows = self.spark.read.schema(SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMA)
        return rows.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))

    def totals(self) -> DataFrame:
        base, _, fresh = self._state()
        return self._sum(base, fresh).filter("documents <> 0 or tokens <> 0")

    def compact(self) -> bool:
        """Folds the batches listed now into a new base; False if another compaction was faster."""
        base, folded, fresh = self._state()
        number, made = int(base or 0) + 1, f"{self.path}/base/_{uuid.uuid4().hex}"
        own = self.spark.createDataFrame([(x,) for x in fresh], "batch string")
        (self._ids(base).unionByName(own) if base else own).coalesce(1).write.json(f"{made}/ids")
        self._sum(base, fresh).filter("documents <> 0 or tokens <> 0").coalesce(1).write.parquet(f"{made}/totals")
        if not publish(self.spark, made, f"{self.path}/base/{number:08d}"):
            return False
        for x in folded:  # those of this base stay for readers that listed them
            delete_folder(self.spark, f"{self.path}/batches/batch-{x}")
        if number > 2:
            delete_folder(self.spark, f"{self.path}/base/{number - 2:08d}")
        return True
