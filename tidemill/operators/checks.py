"""Checks as data: what a rule found, by how many rows and on whom."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Severities from worst to mildest.
SEVERITIES = ["assert_fail", "error", "warn", "assert_pass", "info"]
SCHEMA = "table string, rule string, severity string, n_affected long, detail string, participants string"
PREVIEW = 12


#: A way to keep a small table that is read more than once: (rows, name) -> the same rows. By itself none.
Hold = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class Check:
    """A rule on the rows of a table: ``n`` is what a row adds to the count (a condition counts one).

    In ``detail`` {} is what the rows' ``parts`` add up to, or how many distinct values ``spans`` has on the rows that the rule found.
    """

    rule: str
    severity: str
    n: Column
    detail: str
    always: bool = False
    spans: Column | None = None
    parts: Column | None = None


class Found:
    """What checks found, not yet put together: frames of facts, and rows that are checks already. Acts as its frame() wherever a frame is asked for."""

    def __init__(self, spark: SparkSession, facts: list[DataFrame], rows: list[DataFrame]) -> None:
        self.spark, self.facts, self.rows = spark, facts, rows

    def __add__(self, other: Found | DataFrame) -> Found:
        if isinstance(other, DataFrame):
            return Found(self.spark, self.facts, [*self.rows, other])
        return Found(self.spark, self.facts + other.facts, self.rows + other.rows)

    def frame(self) -> DataFrame:
        """Rows of SCHEMA, of all facts at once: a rule's total, and its first names."""
        if not self.facts:
            return reduce(DataFrame.unionByName, self.rows)
        all_ = reduce(DataFrame.unionByName, self.facts)
        what = F.struct("table", "rule", "severity", "detail").alias("check")
        total = all_.groupBy(what).agg(F.max("always").alias("always"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_affected"), F.coalesce(F.sum("parts"), F.count_distinct("span")).alias("of"))
        names = preview(all_.where("n > 0 AND who IS NOT NULL").select(what, "who").distinct(), "check", "who")
        both = total.where("always OR n_affected > 0").join(names, "check", "left")
        detail = F.replace("check.detail", F.lit("{}"), F.col("of").cast("string")).alias("detail")
        made = both.select("check.table", "check.rule", "check.severity", "n_affected", detail, F.coalesce("names", F.lit("")).alias("participants"))
        return reduce(DataFrame.unionByName, [made, *self.rows])

    def __getattr__(self, name: str):
        return getattr(self.frame(), name)


def evaluate(df: DataFrame, table: str, checks: list[Check], who: str = "participant_id", hold: Hold | None = None) -> Found:
    """The checks that found something, from one aggregation of ``df``.

    All counts are summed for each participant and span, next to the data; all that follows is worked out from these sums,
    a row for each rule that found something on a participant and span. Only the first names are kept.
    """
    spans = [c.spans for c in checks if c.spans is not None]
    if len({str(x) for x in spans}) > 1:
        raise ValueError("the checks of one evaluation have one kind of span")
    span = spans[0] if spans else F.lit(None).cast("date")
    sums = [F.sum(c.n.cast("long")).alias(f"n{i}") for i, c in enumerate(checks)]
    sums += [F.sum(c.parts.cast("long")).alias(f"p{i}") for i, c in enumerate(checks) if c.parts is not None]
    each = df.groupBy(F.col(who).cast("string").alias("who"), span.cast("string").alias("span")).agg(*sums)
    none = F.lit(None).cast("long")
    told = lambda i, c: F.struct(*[F.lit(x).alias(n) for n, x in (("table", table), ("rule", c.rule), ("severity", c.severity), ("detail", c.detail), ("always", c.always))], F.col(f"n{i}").alias("n"), (none if c.parts is None else F.col(f"p{i}")).alias("parts"))
    facts = each.select("who", "span", F.inline(F.array(*[told(i, c) for i, c in enumerate(checks)]))).where("n > 0")
    facts = [hold(facts, f"facts of {table}") if hold else facts]
    if always := [(c.rule, c.severity, c.detail) for c in checks if c.always]:  # these are told also where there is nothing
        row = df.sparkSession.createDataFrame(always, "rule string, severity string, detail string")
        facts.append(row.select(F.lit(None).cast("string").alias("who"), F.lit(None).cast("string").alias("span"), F.lit(table).alias("table"), "rule", "severity", "detail", F.lit(True).alias("always"), F.lit(0).cast("long").alias("n"), none.alias("parts")))
    return Found(df.sparkSession, facts, [])


def preview(df: DataFrame, by: str, who: str, most: int = PREVIEW) -> DataFrame:
    """(by, names): of rows with distinct names, each group's first ones in order, and how many more there are. No group is gathered."""
    ranked = df.withColumn("k", F.row_number().over(Window.partitionBy(by).orderBy(who))).where(F.col("k") <= most)
    names = ranked.groupBy(by).agg(F.array_join(F.array_sort(F.collect_list(who)), ", ").alias("names"))
    more = df.groupBy(by).agg((F.count("*") - most).alias("more"))
    return names.join(more, by).select(by, F.concat("names", F.when(F.col("more") > 0, F.concat(F.lit(" +"), F.col("more").cast("string"), F.lit(" more"))).otherwise("")).alias("names"))


def assertion(rule: str, table: str, bad: DataFrame, detail: str) -> DataFrame:
    """A row of SCHEMA: passed if ``bad``, one row with n, is 0."""
    n = F.col("n").cast("long")
    return bad.select(F.lit(table).alias("table"), F.lit(rule).alias("rule"), F.when(n == 0, "assert_pass").otherwise("assert_fail").alias("severity"), n.alias("n_affected"), F.lit(detail).alias("detail"), F.lit("").alias("participants"))


def by_severity(checks: DataFrame) -> DataFrame:
    """Worst first, then by table and rule."""
    rank = F.create_map(*[x for i, s in enumerate(SEVERITIES) for x in (F.lit(s), F.lit(i))])
    return checks.orderBy(rank[F.col("severity")].asc_nulls_last(), "table", "rule")


def summary(checks: DataFrame) -> dict[str, int]:
    return {r["severity"]: r["count"] for r in checks.groupBy("severity").count().collect()}


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """n: how many rows too many the keys have; nulls are equal to each other."""
    return df.groupBy(*keys).count().where("count > 1").agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("n"))


def orphans(df: DataFrame, of: DataFrame, key: str) -> DataFrame:
    """n: how many rows have a key that ``of`` hasn't."""
    return df.join(of.select(key), key, "left_anti").agg(F.count("*").alias("n"))
