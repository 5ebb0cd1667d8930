"""A register of what an exploration of raw data found."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions import exprs as X
from tidemill.operators.checks import SEVERITIES


@dataclass
class Findings:
    rows: list[tuple[str, str, str, int, str]] = field(default_factory=list)

    def flag(self, source: str, check: str, severity: str, n: int, detail: str = "") -> None:
        """Note a finding; one that concerns no rows is none."""
        if severity not in SEVERITIES:
            raise ValueError(f"unknown severity {severity}")
        if n:
            self.rows.append((source, check, severity, int(n), detail))

    def range_check(self, df: DataFrame, source: str, column: str, low: float, high: float, severity: str = "error") -> None:
        n = df.agg(F.count_if(X.outside(F.col(column), low, high))).first()[0]
        self.flag(source, f"{column}_out_of_range", severity, n, f"outside [{low}, {high}]")

    def duplicate_check(self, df: DataFrame, source: str, keys: list[str], severity: str = "error") -> None:
        n = df.groupBy(*keys).count().where("count > 1").agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0))).first()[0]
        self.flag(source, "duplicate_key", severity, n, ", ".join(keys))

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, "source string, check string, severity string, n long, detail string")
