"""Profiles of tables: what an explorer of raw data asks first. All exact."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions import exprs as X


def _values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, v, n): how often each column has each value, as text; what follows works on these, however many values there are."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("v")) for c in columns])
    return df.select(F.inline(pairs)).groupBy("column", "v").agg(F.count("*").alias("n"))


def profile(df: DataFrame) -> DataFrame:
    """column, non_null, null_pct, n_unique, min, max, mean (of numbers) and mode (of others)."""
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    aggs = [F.count("*").alias("_all")]
    for c in df.columns:
        q = f"`{c}`"
        aggs += [F.count(q).alias(f"{c}|n"), F.min(q).cast("string").alias(f"{c}|lo"), F.max(q).cast("string").alias(f"{c}|hi")]
        aggs.append((F.avg(q) if c in numeric else F.lit(None).cast("double")).alias(f"{c}|x"))
    wide = df.agg(*aggs)
    rows = []
    for c in df.columns:
        g = lambda k, c=c: F.col(f"`{c}|{k}`")
        rows.append(F.struct(F.lit(c).alias("column"), g("n").alias("non_null"), X.scaled_round(F.try_divide((F.col("_all") - g("n")) * 100.0, F.col("_all")), 2).alias("null_pct"), g("lo").alias("min"), g("hi").alias("max"), g("x").alias("mean"), F.lit(c not in numeric).alias("_named")))
    counts = _values(df, df.columns).where("v IS NOT NULL").groupBy("column").agg(F.count("*").alias("n_unique"), F.min(F.struct((-F.col("n")).alias("n"), "v")).alias("top"))
    both = wide.select(F.inline(F.array(*rows))).join(counts, "column", "left")
    return both.select("column", "non_null", "null_pct", F.coalesce("n_unique", F.lit(0)).alias("n_unique"), "min", "max", "mean", F.when(F.col("_named"), F.col("top.v")).alias("mode"))


def _interpolated(counts: DataFrame, quantiles: tuple[float, ...]) -> DataFrame:
    """(g, q, value) of rows (g, v, n): exact interpolated quantiles of each group. Counts are sorted by range and numbered by the parts'
    totals, so no task holds a group; a group's totals, a row for each part that it is in, are all that comes together."""
    parts = counts.repartitionByRange("g", "v").withColumn("part", F.spark_partition_id())
    inside = Window.partitionBy("g", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    sizes = parts.groupBy("g", "part").agg(F.sum("n").alias("size"))
    before = sizes.withColumn("before", F.sum("size").over(Window.partitionBy("g").orderBy("part")) - F.col("size"))
    totals = before.groupBy("g").agg(F.sum("size").alias("total"))
    upto = parts.withColumn("upto", F.sum("n").over(inside)).join(before.select("g", "part", "before"), ["g", "part"]).withColumn("upto", F.col("upto") + F.col("before"))
    wanted = totals.select("g", F.explode(F.array(*map(F.lit, quantiles))).alias("q"), ((F.col("total") - 1) * F.col("q")).alias("at"))
    # The value at place k is the first that reaches k + 1 rows.
    spans = wanted.select("g", "q", "at", F.floor("at").alias("lo"), F.ceil("at").alias("hi"))
    hit = upto.join(spans, "g").where((F.col("upto") > F.col("lo")) & (F.col("upto") - F.col("n") <= F.col("hi")))
    ends = hit.groupBy("g", "q").agg(F.first("at").alias("at"), F.first("lo").alias("lo"), F.min("v").alias("a"), F.max("v").alias("b"))
    return ends.select("g", "q", (F.col("a") + (F.col("at") - F.col("lo")) * (F.col("b") - F.col("a"))).alias("value"))


def ranked(df: DataFrame, columns: list[str], quantiles: tuple[float, ...]) -> DataFrame:
    """(column, q, value): exact interpolated quantiles of whole columns."""
    pairs = F.array(*[F.struct(F.struct(F.lit(c).alias("column")).alias("g"), F.col(c).cast("double").alias("v")) for c in columns])
    counts = df.select(F.inline(pairs)).where("v IS NOT NULL").groupBy("g", "v").agg(F.count("*").alias("n"))
    return _interpolated(counts, quantiles).select("g.column", "q", "value")


def quantiles(df: DataFrame, by: list[str], value: str, qs: tuple[float, ...]) -> DataFrame:
    """The ``by`` columns (none: all rows), q and value: exact interpolated quantiles of each group.

    Nulls in ``by`` are a group; null values don't count, and a group without others has no row. No group's values are gathered.
    """
    group = F.struct(*by) if by else F.struct(F.lit(0).alias("_all"))
    counts = df.select(group.alias("g"), F.col(value).cast("double").alias("v")).where("v IS NOT NULL").groupBy("g", "v").agg(F.count("*").alias("n"))
    return _interpolated(counts, qs).select(*[F.col("g")[c].alias(c) for c in by], "q", "value")


def sample(df: DataFrame, n: int, by: list[str], seed: int = 0) -> DataFrame:
    """``n`` rows (all, if fewer): those whose ``by`` columns have the least MD5 with the seed, ties by these columns.

    The same rows however the table is parted: each part sends its first ``n``, of which the first stay. Nulls count as empty.
    """
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by]
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), *text)), *by).limit(n)


def describe(df: DataFrame, columns: list[str], quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """column, count, mean, std, min, exact quantiles (q25, ...), max."""
    parts = []
    for c in columns:
        x = F.col(c).cast("double")
        parts.append(F.struct(F.lit(c).alias("column"), F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")))
    base = df.agg(F.array(*parts).alias("_rows")).select(F.inline("_rows"))
    wide = ranked(df, columns, quantiles).groupBy("column").agg(*[X.scaled_round(F.max(F.when(F.col("q") == q, F.col("value"))), 6).alias(f"q{round(q * 100)}") for q in quantiles])
    return base.join(wide, "column", "left").select("column", "count", "mean", "std", "min", *[f"q{round(q * 100)}" for q in quantiles], "max")


def value_counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def bins(x: Column, edges: list[float]) -> Column:
    """The number of a right-closed bin (edges[i], edges[i+1]], from 0; null outside."""
    out = F.lit(None).cast("int")
    for i in range(len(edges) - 2, -1, -1):
        out = F.when((x > edges[i]) & (x <= edges[i + 1]), F.lit(i)).otherwise(out)
    return out


def pivot_count(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """How often each of ``values`` stands beside each row's name; 0 where never."""
    return df.groupBy(row).pivot(column, values).count().fillna(0)


def duplicated(df: DataFrame, keys: list[str], name: str = "is_duplicated") -> DataFrame:
    """Flags every row whose key others have too."""
    return df.withColumn(name, F.count("*").over(Window.partitionBy(*keys)) > 1)


def range_check(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """column, n_outside, lowest and highest."""
    return df.agg(F.lit(column).alias("column"), F.count_if(X.outside(F.col(column), low, high)).alias("n_outside"), F.min(column).alias("lowest"), F.max(column).alias("highest"))


def key_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Each key of either table, and where it is: both, left_only or right_only."""
    a, b = left.select(key).distinct().withColumn("_l", F.lit(1)), right.select(key).distinct().withColumn("_r", F.lit(1))
    both = a.join(b, key, "full_outer")
    return both.select(key, F.when(F.col("_l").isNull(), "right_only").when(F.col("_r").isNull(), "left_only").otherwise("both").alias("indicator"))


def modal(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: each column's most frequent value, the smallest of equals."""
    tops = []
    for c in columns:
        counts = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n"))
        tops.append(counts.agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(c).alias("v"))).alias("top")).select(F.col("top.v").alias(c)))
    return reduce(DataFrame.crossJoin, tops)  # of one row each


def coverage_matrix(spine: DataFrame, key: str, tables: dict[str, DataFrame]) -> DataFrame:
    """For each key of the spine, how many rows each table has."""
    parts = [t.groupBy(key).agg(F.count("*").alias(n)) for n, t in tables.items()]
    return reduce(lambda a, b: a.join(b, key, "left"), parts, spine.select(key).distinct()).fillna(0)
