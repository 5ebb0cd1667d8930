"""The whole run: land, clean, model, check, compare. ``python -m tidemill.plans.run --help``."""

from __future__ import annotations

import argparse
import operator
import sys
import time
import uuid
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.conf import Settings, load_settings
from tidemill.operators import checks as K
from tidemill.plans import analytics, clean, model, quality
from tidemill.sources import files, sinks

LAYERS = ("bronze", "silver", "gold", "analytics")
#: The columns of the source files, and the names of tables.
PARTICIPANTS = ["participant_id", "device_id", "age", "height_cm", "gender", "chronotype", "max_heart_rate"]
DEVICES = ["participant_id", "device_id", "wear_site", "calibration_date", "firmware_version", "device_label"]
SURVEY = ["participant_id", "date", "fatigue_score", "stress_score", "readiness_score", "sleep_quality_score"]
SILVER = {"participants": (), "devices": (), "steps_minute": ("date",), "heart_rate_minute": ("date",), "sleep_sessions": (), "sleep_stages": (), "wellness_survey": (), "participant_day_coverage": ()}
GOLD = {"participant_devices": (), "daily_participant_metrics": ("date",), "weekly_participant_summary": (), "chronotype_cohort_metrics": ()}


def land(spark: SparkSession, s: Settings, run_id: str, at: datetime) -> tuple[dict[str, DataFrame], K.Found]:
    """The export as it is, with lineage; and checks for fields that no document names."""
    events = lambda kind: files.read_records(spark, files.join(s.source, "wearable_events", "*", f"{kind}.json"), run_id, at, s.participants)
    raw = {"steps": events("steps"), "heart_rate": events("heart_rate")}
    raw["sleep_sessions"], raw["sleep_stages"] = files.read_sleep(spark, files.join(s.source, "wearable_events", "*", "sleep.json"), run_id, at, s.participants)
    for name, path, columns in (("participants", "participants/participants.csv", PARTICIPANTS), ("device_metadata", "health_summaries/device_metadata.csv", DEVICES), ("wellness_survey", "health_summaries/wellness_survey.csv", SURVEY)):
        raw[name] = files.lineage(files.read_csv(spark, files.join(s.source, path), columns, placed=True), run_id, at)
    out = {}
    for name, df in raw.items():
        by = ("_source_participant_dir",) if name in ("steps", "heart_rate") else ("participant_id",) if name.startswith("sleep") else ()
        sinks.write_table(df, files.join(s.target, "bronze"), name, by, s.compression, small=not by, dealt=bool(by))
        out[name] = files.read_table(spark, files.join(s.target, "bronze"), name)
    steps, heart_rate = (clean.undocumented_fields(out[k], k, s.study) for k in ("steps", "heart_rate"))
    return out, steps + heart_rate


def _event_columns(records: DataFrame) -> DataFrame:
    """Landed records with every field that any of them has as a column."""
    return files.fields(records, files.field_names(records))


def clean_all(spark: SparkSession, bronze: dict[str, DataFrame], s: Settings) -> tuple[dict[str, DataFrame], K.Found]:
    """The cleaned tables, written and read back, and their checks."""
    base, study = files.join(s.target, "silver"), s.study
    checks: list[K.Found] = []
    work = files.join(s.target, "_work", uuid.uuid4().hex)

    def hold(df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(path := files.join(work, name.replace(" ", "_")))
        return spark.read.schema(df.schema).parquet(path)

    def put(name: str, df: DataFrame) -> DataFrame:
        sinks.write_table(df, base, name, SILVER[name], s.compression, small=name in ("participants", "devices", "wellness_survey"))
        return files.read_table(spark, base, name)

    out: dict[str, DataFrame] = {}
    people, c = clean.build_participants(bronze["participants"], study)
    out["participants"] = put("participants", people)
    checks.append(c)
    devices, c = clean.build_devices(bronze["device_metadata"], out["participants"], study)
    out["devices"] = put("devices", devices)
    checks.append(c)
    steps, c = clean.build_steps(_event_columns(bronze["steps"]), study, hold)
    out["steps_minute"] = put("steps_minute", steps)
    checks.append(c)
    hr, c = clean.build_heart_rate(_event_columns(bronze["heart_rate"]), study, hold)
    out["heart_rate_minute"] = put("heart_rate_minute", hr)
    checks.append(c)
    good, kept, bad, c = clean.build_sleep(bronze["sleep_sessions"], bronze["sleep_stages"], study)
    out["sleep_sessions"], out["sleep_stages"] = put("sleep_sessions", good), put("sleep_stages", kept)
    sinks.write_quarantine(bad, s.target, "sleep_sessions", s.compression)
    checks.append(c)
    survey, rejected, c = clean.build_survey(bronze["wellness_survey"], out["participants"], study)
    out["wellness_survey"] = put("wellness_survey", survey)
    sinks.write_quarantine(rejected, s.target, "wellness_survey", s.compression)
    checks.append(c)
    coverage, c = clean.build_coverage(out["participants"], out["steps_minute"], out["heart_rate_minute"], out["sleep_sessions"], out["wellness_survey"], study)
    out["participant_day_coverage"] = put("participant_day_coverage", coverage)
    checks.append(c)
    # A row for each rule that found something: what they were made from goes now.
    found = K.Found(spark, [], [spark.createDataFrame(reduce(operator.add, checks).collect(), K.SCHEMA)])
    sinks.remove(spark, work)
    return out, found


def model_all(spark: SparkSession, silver: dict[str, DataFrame], s: Settings) -> dict[str, DataFrame]:
    """The modelled tables, each written before the next reads it."""
    base = files.join(s.target, "gold")

    def put(name: str, df: DataFrame) -> DataFrame:
        sinks.write_table(df, base, name, GOLD[name], s.compression, small=name != "daily_participant_metrics")
        return files.read_table(spark, base, name)

    gold = {"participant_devices": put("participant_devices", model.participant_devices(silver["participants"], silver["devices"]))}
    daily = model.daily_metrics(silver["participant_day_coverage"], silver["participants"], silver["steps_minute"], silver["heart_rate_minute"], silver["sleep_sessions"], silver["wellness_survey"], s.study)
    gold["daily_participant_metrics"] = daily = put("daily_participant_metrics", daily)
    gold["weekly_participant_summary"] = put("weekly_participant_summary", model.weekly_summary(daily))
    gold["chronotype_cohort_metrics"] = put("chronotype_cohort_metrics", model.cohort_metrics(daily))
    return gold


def compare(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    daily, cohorts = gold["daily_participant_metrics"], gold["chronotype_cohort_metrics"]
    people = analytics.per_participant(daily)
    return {
        "analytics_01_cohort_comparison": analytics.cohort_comparison(cohorts),
        "analytics_02_chronotype_validation": analytics.chronotype_validation(daily),
        "analytics_03_weekly_trend": analytics.weekly_trend(cohorts),
        "analytics_04_cohort_effect_size": people,
        "effect_sizes": analytics.effect_sizes(people),
    }


def run(spark: SparkSession, s: Settings, layers: tuple[str, ...] = LAYERS, run_id: str | None = None) -> DataFrame:
    """Run the layers and publish; the checks are returned. Layers that are left out are read back."""
    at = datetime.now(UTC).replace(tzinfo=None)
    run_id = run_id or at.strftime("%Y%m%dT%H%M%SZ")
    began = time.time()
    if "bronze" in layers:
        files.check_readable(spark, s.source, "source")
    sinks.check_writable(spark, s.target, "target")
    checks = K.Found(spark, [], [])
    bronze = silver = gold = None
    if "bronze" in layers:
        bronze, found = land(spark, s, run_id, at)
        checks = checks + found
    if "silver" in layers:
        names = ("steps", "heart_rate", "sleep_sessions", "sleep_stages", "participants", "device_metadata", "wellness_survey")
        bronze = bronze or {n: files.read_table(spark, files.join(s.target, "bronze"), n) for n in names}
        silver, found = clean_all(spark, bronze, s)
        checks = checks + found
    if "gold" in layers:
        silver = silver or {n: files.read_table(spark, files.join(s.target, "silver"), n) for n in SILVER}
        gold = model_all(spark, silver, s)
        checks = checks + quality.assertions(silver, gold, s.study)
    if "analytics" in layers and gold:
        results = compare(gold)
        for name, df in results.items():
            sinks.write_table(df, files.join(s.target, "gold", "_analytics"), name, compression=s.compression, small=True)
            sinks.write_csv(df, files.join(s.target, "outputs", f"{name}.csv"))
        sinks.write_text(spark, quality.analytics_report(results, run_id), files.join(s.target, "outputs", "analytics_report.md"))
    if not checks.facts and not checks.rows:
        return spark.createDataFrame([], K.SCHEMA)
    all_ = checks.frame().withColumns({"run_id": F.lit(run_id), "run_at": F.lit(at).cast("timestamp_ntz"), "run_date": F.lit(at.date())})
    sinks.write_table(all_, files.join(s.target, "_dq"), "dq_checks", ("run_date", "run_id"), s.compression)
    kept = files.read_table(spark, files.join(s.target, "_dq"), "dq_checks").where(F.col("run_id").cast("string") == run_id)
    sinks.write_csv(K.by_severity(kept), files.join(s.target, "outputs", "dq_checks.csv"))
    stats = {"mode": s.mode, "seconds": round(time.time() - began, 1), **K.summary(kept)}
    layered = {n: x for n, x in (("bronze", bronze), ("silver", silver), ("gold", gold)) if x}
    rows = quality.row_counts(layered).collect() if layered else []  # a row for each table
    sinks.write_text(spark, quality.report(kept, run_id, stats, rows), files.join(s.target, "outputs", "run_report.md"))
    return kept


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--source")
    p.add_argument("--target")
    p.add_argument("--online", action=argparse.BooleanOptionalAction, default=False)
    p.add_argument("--layers", default=",".join(LAYERS))
    p.add_argument("--participants", help="some participants' events, by id, with commas")
    p.add_argument("--run-id")
    p.add_argument("--strict", action="store_true", help="exit with 1 if an assertion fails")
    p.add_argument("--quiet", action="store_true")
    a = p.parse_args(argv)
    if unknown := set(a.layers.split(",")) - set(LAYERS):
        p.error(f"unknown layers: {', '.join(sorted(unknown))}")
    more = {"participants": tuple(a.participants.split(","))} if a.participants else {}
    settings = load_settings(a.source, a.target, a.online, **more)
    spark = SparkSession.builder.appName("tidemill").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    found = K.summary(run(spark, settings, tuple(a.layers.split(",")), a.run_id))
    if not a.quiet:
        print(", ".join(f"{k} {v}" for k, v in found.items()))
    return int(a.strict and found.get("assert_fail", 0) > 0)


if __name__ == "__main__":
    sys.exit(main())
