"""Session helpers: cutting the lineage of iterative operators."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


#: Keys that ``lookup`` may broadcast, at most.
HOT_KEYS = 10_000


def shared_root(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``, or the one set by the caller.

    Only in local mode, as in tests, where driver and executors are one process, a temporary folder
    stands in for it; on a cluster a missing setting is an error.
    """
    context = spark.sparkContext
    top = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if top:
        return top.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir().rstrip("/")


def checkpoint(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder."""
    root, context = shared_root(df.sparkSession), df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return df.checkpoint(eager=True)


def lookup(left: DataFrame, right: DataFrame, key: str | list[str], rows: int, count: str = "_n") -> DataFrame:
    """``left`` joined to ``right``, which has one row for each key and in ``count`` how many of the ``rows`` rows of ``left`` have it.

    Keys with more than a ``HOT_KEYS``-th of all rows are looked up in a broadcast of ``HOT_KEYS`` rows
    at most, so the rows of a hot key stay where they are; the others are joined as ever.
    """
    keys = [key] if isinstance(key, str) else key
    limit = max(512, rows // HOT_KEYS)
    if rows < 4 * limit:
        return left.join(right.drop(count), keys)
    more = [c for c in right.columns if c not in (*keys, count)]
    hot = right.filter(F.col(count) > limit).select(*keys, F.struct(*more).alias("_hot"))
    told = left.join(F.broadcast(hot), keys, "left")
    spread = told.filter("_hot is not null").select(*left.columns, *[F.col(f"_hot.{c}").alias(c) for c in more])
    return spread.unionByName(told.filter("_hot is null").drop("_hot").join(right.drop(count), keys).select(*left.columns, *more))


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once for each session, for operators that run Python there.

    Without it the workers would need the package on their own path.
    """
    context = spark.sparkContext
    if getattr(context, "_has_catlink", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._has_catlink = True


def _offsets(part: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """(_p, sums over the ranges before): one row for each range partition."""
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    each = part.groupBy("_p").agg(*[c.alias(n) for n, c in sums.items()])
    return each.select("_p", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in sums])


def running_sums(rows: DataFrame, order: str, sums: dict[str, str]) -> DataFrame:
    """Adds running sums (name -> summed column) in the order of a unique column, without one task for all rows.

    Ranges are summed apart; the sums of the ranges before, one row for each, are added.
    """
    part = checkpoint(rows.repartitionByRange(order).withColumn("_p", F.spark_partition_id()))
    before = _offsets(part, {f"_b{i}": F.sum(v) for i, v in enumerate(sums.values())})
    inside = Window.partitionBy("_p").orderBy(order)
    own = part.withColumns({f"_o{i}": F.sum(v).over(inside) for i, v in enumerate(sums.values())})
    joined = own.join(F.broadcast(before), "_p")
    return joined.withColumns({n: F.col(f"_o{i}") + F.col(f"_b{i}") for i, n in enumerate(sums)}).select(*rows.columns, *sums)


def numbered(rows: DataFrame, order: list[Column | str], name: str = "i") -> DataFrame:
    """Adds the row's place in an order, from 1, by ranges and offsets, not by one sorted task.

    The order should be total; rows that it leaves equal are numbered in any way.
    """
    keys = {f"_k{i}": F.col(c) if isinstance(c, str) else c for i, c in enumerate(order)}
    part = checkpoint(rows.withColumns(keys).repartitionByRange(*keys).withColumn("_p", F.spark_partition_id()))
    placed = part.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(*keys)))
    return placed.join(F.broadcast(_offsets(part, {"_n": F.count("*")})), "_p").withColumn(name, F.col("_r") + F.col("_n")).select(*rows.columns, name)
