"""The domain's report table, built from the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dates that the reports were received on, from their own table: what is latest needs no join."""
    return load(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date_received"))


def reports(spark: SparkSession, sf_dir: str, occurred: bool = False) -> DataFrame:
    """One row per reported device; with ``occurred``, also the date of the event, which another table holds."""
    line, part, supplier = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "part"), load(spark, sf_dir, "supplier")
    kind = F.col("p_type")
    harm = F.when(F.col("l_quantity") < 5, "Minor Injury").when(F.col("l_returnflag") == "R", "Death").when(F.col("l_returnflag") == "A", "Serious Injury").otherwise("No Harm")
    rows = line.join(part, line["l_partkey"] == part["p_partkey"]).join(supplier, line["l_suppkey"] == supplier["s_suppkey"])
    if occurred:
        rows = rows.join(load(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return (
        rows.select(
            F.col("l_orderkey").alias("report_key"),
            F.col("l_linenumber").alias("line_number"),
            F.to_date("l_shipdate").alias("date_received"),
            *([F.to_date("o_orderdate").alias("date_occurred")] if occurred else []),
            F.col("s_name").alias("manufacturer_name"),
            F.col("p_brand").alias("product_code"),
            F.when(kind == "PROMO", "Other").when(kind == "MEDIUM", "Unknown").otherwise(kind).alias("defect_type"),
            harm.alias("patient_harm"),
            (F.col("l_linestatus") == "F").alias("defect_confirmed"),
            (F.col("p_size") % 5 - 1).alias("cluster"),
            F.split("p_name", " ").alias("problem_components"),
            F.when(F.col("l_linenumber") % 4 != 0, F.col("l_partkey").cast("string")).alias("udi_di"),
            F.col("p_type").alias("model_number"),
            F.when(F.col("p_size") % 7 != 0, F.col("p_size").cast("string")).alias("catalog_number"),
        )
    )


REPORTS_SQL = """reports AS (
  SELECT l_orderkey AS report_key, l_linenumber AS line_number, CAST(l_shipdate AS DATE) AS date_received, CAST(o_orderdate AS DATE) AS date_occurred,
         s_name AS manufacturer_name, p_brand AS product_code,
         CASE p_type WHEN 'PROMO' THEN 'Other' WHEN 'MEDIUM' THEN 'Unknown' ELSE p_type END AS defect_type,
         CASE WHEN l_quantity < 5 THEN 'Minor Injury' WHEN l_returnflag = 'R' THEN 'Death' WHEN l_returnflag = 'A' THEN 'Serious Injury' ELSE 'No Harm' END AS patient_harm,
         l_linestatus = 'F' AS defect_confirmed, p_size % 5 - 1 AS cluster, string_split(p_name, ' ') AS problem_components,
         CASE WHEN l_linenumber % 4 <> 0 THEN CAST(l_partkey AS VARCHAR) END AS udi_di, p_type AS model_number,
         CASE WHEN p_size % 7 <> 0 THEN CAST(p_size AS VARCHAR) END AS catalog_number
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey)"""
