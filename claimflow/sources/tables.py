"""Explicit schemas for the input tables and a reader that prunes columns.

Parquet carries its own schema; passing ours makes a drifted file fail
at read time instead of in the middle of a plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SCHEMAS = {
    "documents": T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType())]),
    "pages": T.StructType([
        T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType())]),
    "labels": T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()),
        T.StructField("toxic", T.IntegerType())]),
    "conversations": T.StructType([
        T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]),
    "benchmark": T.StructType([
        T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())]),
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


# What tells the rows of the text tables apart; text work is CPU-bound regex per row.
ROW_KEYS = {"documents": ("doc_id",), "pages": ("page_id",), "conversations": ("conv_id", "turn"), "benchmark": ("item_id",)}


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal the rows out by their hash when the scan yields fewer splits than the
    cluster has cores (a file written as one row group is one task); otherwise
    leave the scan alone, so on a large input this adds nothing. The keys should
    tell rows apart, so that no group of rows lands in one task."""
    n = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= n:
        return df
    return df.repartition(n, *keys)


def read_table(spark: SparkSession, sf_dir: str, name: str, spread_text: bool = True) -> DataFrame:
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    df = reader.parquet(table_path(sf_dir, name))
    if spread_text and name in ROW_KEYS:
        df = spread(df, *ROW_KEYS[name])
    return df
