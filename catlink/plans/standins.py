"""Roles of linkage and graph data played by the driver's tables, as frames and as SQL.

A catalog title is a distinct (name, size) of ``part``; the reference is all of ``part`` with titles spelled
in three ways; credits are line items' suppliers; films and actors are orders and parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CATALOG = """
SELECT min(p_partkey) AS row_id, (CASE WHEN p_size = 13 THEN 'Lost ' ELSE '' END) || p_name AS title, 1950 + p_size AS year,
  'Supplier#' || lpad(CAST(min(p_partkey) % 100 AS STRING), 9, '0') AS director
FROM part GROUP BY p_name, p_size"""

REFERENCE = """
SELECT p_partkey AS ref_id,
  CASE p_type WHEN 'ECONOMY' THEN 'short' WHEN 'PROMO' THEN 'tvMovie' WHEN 'SMALL' THEN 'video' WHEN 'LARGE' THEN 'tvSeries' ELSE 'movie' END AS kind,
  CASE p_partkey % 3 WHEN 0 THEN upper(p_name) WHEN 1 THEN p_name ELSE 'The ' || replace(p_name, ' ', '-') END AS primary_title,
  p_name || ' II' AS original_title, 1950 + p_size + CAST(p_partkey % 2 AS INT) AS start_year, p_size * 4 AS runtime,
  CASE WHEN p_size < 5 THEN 'Drama,Short' WHEN p_size > 45 THEN 'Documentary' ELSE 'Drama' END AS genres
FROM part"""

ALTERNATES = """
SELECT p_partkey AS ref_id, CASE p_partkey % 2 WHEN 0 THEN 'A ' || upper(p_name) ELSE 'Lost ' || p_name END AS title FROM part"""

CREDITS = "SELECT DISTINCT l_partkey AS ref_id, l_suppkey AS pos, l_suppkey AS person_id FROM lineitem"

PEOPLE = "SELECT s_suppkey AS person_id, s_name AS name FROM supplier"

MEMBERSHIP = "SELECT DISTINCT l_orderkey AS item, l_partkey AS member FROM lineitem"

#: First line of each document; titles in the text queries.
LINES = "SELECT doc_id, split(text, '\\n')[0] AS title FROM documents"
LINES_SQL = "SELECT doc_id, string_split(text, chr(10))[1] AS title FROM documents"


def duck(sql: str) -> str:
    return sql.replace("AS STRING", "AS VARCHAR")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frame(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A stand-in's frame; its tables are named in the text as ``{part}`` relations."""
    names = [n for n in ("part", "lineitem", "supplier", "documents", "orders", "customer", "events", "nation", "region", "labels", "pages", "benchmark", "conversations") if f" {n}" in f" {sql} ".replace("\n", " ")]
    for n in names:
        sql = sql.replace(f"FROM {n}", f"FROM {{{n}}}").replace(f"JOIN {n}", f"JOIN {{{n}}}")
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names})
