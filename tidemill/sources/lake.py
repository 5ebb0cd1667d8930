"""Looking into a published lake: which tables there are, one of them, and what it holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.sources.files import join, list_dirs, read_table


def list_tables(spark: SparkSession, base: str, layer: str) -> list[str]:
    """A layer's tables by name; those of its subfolders (``_analytics``) are listed on their own."""
    return [t for t in list_dirs(spark, join(base, layer)) if not t.startswith("_")]


def load_table(spark: SparkSession, base: str, layer: str, name: str) -> DataFrame:
    return read_table(spark, join(base, layer), name)


def describe(spark: SparkSession, base: str, layers: tuple[str, ...] = ("bronze", "silver", "gold")) -> DataFrame:
    """layer, table, rows and columns of every table; row counts come from the files' footers."""
    out = []
    for layer in layers:
        for name in list_tables(spark, base, layer):
            df = load_table(spark, base, layer, name)
            out.append(df.agg(F.lit(layer).alias("layer"), F.lit(name).alias("table"), F.count("*").alias("rows"), F.lit(len(df.columns)).alias("columns")))
    if not out:
        return spark.createDataFrame([], "layer string, table string, rows long, columns int")
    first, *rest = out
    for df in rest:
        first = first.unionByName(df)
    return first
