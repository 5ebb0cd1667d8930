"""What must hold of the published tables, and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.conf import Study
from tidemill.operators import checks as K

WHO = "participant_id"
KEYS = {
    "participants": [WHO],
    "steps_minute": [WHO, "timestamp"],
    "heart_rate_minute": [WHO, "timestamp"],
    "sleep_sessions": ["session_key"],
    "wellness_survey": [WHO, "date"],
    "participant_day_coverage": [WHO, "date"],
}
MODEL_KEYS = {
    "participant_devices": [WHO],
    "daily_participant_metrics": [WHO, "date"],
    "weekly_participant_summary": [WHO, "study_week"],
    "chronotype_cohort_metrics": ["period_type", "study_week", "chronotype"],
}
REFERRING = ["steps_minute", "heart_rate_minute", "sleep_sessions", "wellness_survey"]


def _count(df: DataFrame, bad: str) -> DataFrame:
    return df.agg(F.count_if(F.expr(bad)).alias("n"))


def _off(df: DataFrame, people: DataFrame, times: int) -> DataFrame:
    """n: by how many rows a table misses so many for each person."""
    both = df.agg(F.count("*").alias("rows")).crossJoin(people.agg(F.count("*").alias("people")))  # of one row each
    return both.select(F.abs(F.col("rows") - F.col("people") * times).alias("n"))


def assertions(silver: dict[str, DataFrame], gold: dict[str, DataFrame], study: Study) -> DataFrame:
    """Keys, grains, ranges and references, as checks that passed or failed: one query."""
    out = []
    for tables, keys in ((silver, KEYS), (gold, MODEL_KEYS)):
        for name, by in keys.items():
            out.append(K.assertion("unique_key", name, K.duplicate_rows(tables[name], by), f"one row for each {', '.join(by)}"))
    people, daily = silver["participants"], gold["daily_participant_metrics"]
    out.append(K.assertion("row_count", "daily_participant_metrics", _off(daily, people, study.days), f"participants by {study.days} days"))
    out.append(K.assertion("row_count", "participant_devices", _off(gold["participant_devices"], people, 1), "a row for each participant"))
    out.append(K.assertion("nobody_dropped", "daily_participant_metrics", K.orphans(people, daily, WHO), "every participant has days"))
    out.append(K.assertion("steps_plausible", "steps_minute", _count(silver["steps_minute"], f"steps > {study.steps_most}"), f"no minute over {study.steps_most} steps"))
    low, high = study.heart_rate_range
    out.append(K.assertion("heart_rate_in_range", "heart_rate_minute", _count(silver["heart_rate_minute"], f"heart_rate_bpm NOT BETWEEN {low} AND {high}"), f"{low} to {high} bpm"))
    sleep = silver["sleep_sessions"]
    out.append(K.assertion("efficiency_in_range", "sleep_sessions", _count(sleep, "sleep_efficiency_pct NOT BETWEEN 0 AND 100"), "0 to 100 %"))
    out.append(K.assertion("sleep_within_bed", "sleep_sessions", _count(sleep, "total_sleep_min > time_in_bed_min + 1e-6"), "no more sleep than time in bed"))
    for name in REFERRING:
        out.append(K.assertion("participant_known", name, K.orphans(silver[name], people, WHO), "every participant is on the roster"))
    return reduce(DataFrame.unionByName, out)


def row_counts(layers: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """(layer, table, n) of published tables, in one query that reads no column."""
    counted = [df.agg(F.count("*").alias("n")).select(F.lit(layer).alias("layer"), F.lit(name).alias("table"), "n") for layer, tables in layers.items() for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counted)


def report(checks: DataFrame, run_id: str, stats: dict[str, object], rows: list = ()) -> str:
    """The run's checks as Markdown, after the rows (layer, table, n) of what was published."""
    found = K.by_severity(checks).collect()
    lines = [f"# Run {run_id}", "", *[f"- {k}: {v}" for k, v in stats.items()], ""]
    if rows:
        lines += ["## Rows", "", "| layer | table | rows |", "|---|---|---|", *[f"| {r['layer']} | {r['table']} | {r['n']:,} |" for r in rows], ""]
    lines += ["## Checks", "", "| severity | table | rule | rows | participants | detail |", "|---|---|---|---|---|---|"]
    lines += [f"| {r['severity']} | {r['table']} | {r['rule']} | {r['n_affected']:,} | {r['participants']} | {r['detail']} |" for r in found]
    return "\n".join(lines) + "\n"


def agreement(validation: DataFrame) -> DataFrame:
    """One row: participants whose derived chronotype is the declared one, all of them, and the percentage (null of nobody)."""
    n = F.col("n_participants")
    sums = validation.agg(F.coalesce(F.sum(F.when(F.col("agrees"), n)), F.lit(0)).alias("agree"), F.coalesce(F.sum(n), F.lit(0)).alias("of"))
    return sums.withColumn("agree_pct", F.try_divide(F.col("agree") * 100.0, F.col("of")))


def reading(agree: int, of: int, timing: list[str], others: list[str]) -> list[str]:
    """What the agreement and the metrics that separate the cohorts say of the declared label, in sentences."""
    share = f"{agree} of {of} participants ({100 * agree / of:.0f} %)" if of else "none, as nobody has a night"
    lines = [f"A chronotype derived from mid-sleep alone is the declared one for {share}."]
    if timing:
        return [*lines, f"{', '.join(timing)}: timing that defines a chronotype separates the cohorts, so behaviour bears the label out."]
    lines.append("No timing that defines a chronotype separates the cohorts: the declared label is not seen in these data, and their comparison is a null result.")
    if others:
        lines.append(f"{', '.join(others)}: the cohorts differ in this, which is not about when they sleep and can't confirm the label.")
    return lines


def analytics_report(results: dict[str, DataFrame], run_id: str) -> str:
    """The analytics as Markdown: what separates the cohorts, then each small table."""
    tested = results["effect_sizes"].collect()
    apart = [r["metric"] for r in tested if r["separates_cohorts"]]
    timing, others = ([r["metric"] for r in tested if r["separates_cohorts"] and r["defines_chronotype"] == x] for x in (True, False))
    agreed = agreement(results["analytics_02_chronotype_validation"]).first()
    lines = [f"# Chronotypes, run {run_id}", ""]
    lines.append(f"{len(apart)} of {len(tested)} metrics separate the cohorts: {', '.join(apart) or 'none'}.")
    lines += ["", "## Reading", "", *reading(agreed["agree"], agreed["of"], timing, others)]
    for name, df in results.items():
        lines += ["", f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        lines += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in df.limit(200).collect()]
    return "\n".join(lines) + "\n"
