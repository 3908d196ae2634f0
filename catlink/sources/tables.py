"""Sources and sinks: catalogs with identifiers, tab-separated dumps, optional files, overrides, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from catlink.functions import text as T
from catlink.functions.runtime import numbered


def exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder with content, in whatever store the path names?"""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.exists(p) and (fs.getFileStatus(p).isDirectory() or fs.getFileStatus(p).getLen() > 0)


def text_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None, multi_line: bool = False) -> DataFrame:
    """A CSV with a header, all text, null as blank; a byte order mark is not part of the first name.

    ``multi_line``: values may hold line ends; such files can't be split, so large ones should do without.
    """
    df = spark.read.csv(path, header=True, multiLine=multi_line, escape='"', encoding="UTF-8")
    df = df.toDF(*[c.removeprefix("﻿") for c in df.columns])
    if columns is not None:
        missing = [c for c in columns if c not in df.columns]
        if missing:
            raise ValueError(f"{path}: missing columns {missing}")
        df = df.select(*columns)
    return df.na.fill("")


def read_optional(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """As ``read_csv``; a missing or empty file is an empty table."""
    return read_csv(spark, path) if exists(spark, path) else spark.createDataFrame([], text_schema(columns))


def read_tsv(spark: SparkSession, path: str, kinds: list[str] | None = None, kind_col: str = "titleType") -> DataFrame:
    """A tab-separated dump without quoting, \\N as null; ``kinds`` filters by type."""
    df = spark.read.csv(path, sep="\t", header=True, quote="", nullValue="\\N")
    return df if kinds is None else df.filter(F.col(kind_col).isin(*kinds))


def read_ragged(spark: SparkSession, path: str, fields: int, sep: str = "\t") -> DataFrame:
    """Lines split on a separator; lines of fewer fields are left out.  Column ``f``: array of text."""
    return spark.read.text(path).select(F.split("value", sep).alias("f")).filter(F.size("f") >= fields)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Saved pages, one row for each file: page_id (its path), html."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("page_id"), F.col("value").alias("html"))


def with_row_ids(rows: DataFrame, order: str, spine: str = "spine", numeric_only: bool = False) -> DataFrame:
    """Adds row_no from 1 in a given order, row_id and source_id (the spine, else ``row_n``).

    The order is a column of the source: file order isn't kept by a distributed reader.
    """
    x = rows.join(numbered(rows.select(order).distinct(), [order], "row_no"), order)
    s = F.trim(F.coalesce(spine, F.lit("")))
    own = s.rlike("^[0-9]+$") if numeric_only else s != ""
    return x.withColumn("row_id", F.format_string("criterion_row_%05d", F.col("row_no").cast("int"))).withColumn("source_id", F.when(own, s).otherwise(F.concat(F.lit("row_"), F.col("row_no").cast("string"))))


def clean_fields(rows: DataFrame, country: str = "country") -> DataFrame:
    """All text trimmed; trailing commas of the country dropped."""
    x = rows.withColumns({c: F.trim(c) for c, t in rows.dtypes if t == "string"})
    return x.withColumn(country, F.trim(F.regexp_replace(F.trim(country), ",+$", "")))


def sort_catalog(rows: DataFrame, spine: str, order: str) -> DataFrame:
    """Numbered rows by number, then the others in their order."""
    n = F.when(F.trim(spine).rlike("^[0-9]+$"), F.trim(spine).cast("long"))
    return rows.orderBy(n.isNull(), n, order)


def read_overrides(rows: DataFrame, order: str) -> DataFrame:
    """Overrides keyed by collection_id and whole seq; rows without either are dropped and the last of a key wins."""
    x = rows.withColumn("seq", T.strict_int(F.col("seq").cast("string"))).filter("seq is not null and trim(collection_id) <> ''")
    w = Window.partitionBy("collection_id", "seq").orderBy(F.desc(order))
    return x.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def inline(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small fixed relation."""
    return spark.createDataFrame(rows, schema)


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, one_file: bool = False) -> None:
    """Comma-separated text with a header; the schema is the frame's also when it is empty."""
    out = df.select(*columns) if columns else df
    (out.coalesce(1) if one_file else out).write.mode("overwrite").csv(path, header=True)


def write_sorted(df: DataFrame, path: str, key: str) -> None:
    """Overwrites a cache with its rows in the order of a key; files follow one another by ranges of it."""
    df.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").csv(path, header=True)


def write_edges(edges: DataFrame, path: str) -> None:
    """A network for later use: edges as Parquet, in the order of their source."""
    edges.repartitionByRange("src").sortWithinPartitions("src", "dst").write.mode("overwrite").parquet(path)


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def stamped(df: DataFrame, at: str, name: str = "generated_at") -> DataFrame:
    """Adds a run's time, given as text, so a repeated run gives the same rows."""
    return df.withColumn(name, F.lit(at))


def write_buckets(df: DataFrame, path: str, by: str) -> None:
    """One pass, one folder for each value of a column."""
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def write_report(df: DataFrame, path: str, line: str) -> None:
    """Lines of text in the order of column ``ord``; for reports, which are small."""
    df.orderBy("ord").select(F.expr(line).alias("value")).coalesce(1).write.mode("overwrite").text(path)
