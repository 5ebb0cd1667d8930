import math
import statistics
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests import study
from tidemill.conf import Study
from tidemill.operators import checks as K
from tidemill.operators import profile as P
from tidemill.operators.findings import Findings
from tidemill.plans import analytics, clean, model
from tidemill.sources import files, lake, sinks


def test_records_keep_their_order_and_every_field(spark, tmp_path):
    study.write(tmp_path, people=2, days=1)
    at = datetime(2026, 3, 1)
    df = files.read_records(spark, f"{tmp_path}/wearable_events/*/steps.json", "r", at)
    assert files.field_names(df) == ["_unit", "participant_id", "steps", "timestamp"]
    assert df.where("_source_participant_dir = 'P002'").agg(F.min("_ordinal"), F.max("_ordinal")).first()[:] == (0, 1439)
    found = clean.undocumented_fields(df, "steps", Study()).collect()
    assert [(r["rule"], r["n_affected"], r["participants"]) for r in found] == [("undocumented_source_field", 1, "P002")]
    wide = files.fields(df, ["steps", "_unit"])
    assert wide.columns[:2] == ["steps", "_unit"] and wide.where("_unit IS NULL").count() == 1441


def test_csv_nulls(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\nNA,\nnull,x\n1,None\n")
    path, names = str(tmp_path / "x.csv"), ["a", "b"]
    assert [r[:] for r in files.read_csv(spark, path, names).collect()] == [(None, None), (None, "x"), ("1", None)]
    assert [r[:] for r in files.read_csv(spark, path, names, na_tokens=False).collect()] == [("NA", None), ("null", "x"), ("1", "None")]


def test_inventory(spark, tmp_path):
    study.write(tmp_path, people=2, days=1)
    (tmp_path / "wearable_events/P002/sleep.json").unlink()
    found = files.completeness(files.inventory(spark, f"{tmp_path}/wearable_events"), ["steps.json", "heart_rate.json", "sleep.json"])
    assert {r["folder"]: r["is_incomplete"] for r in found.collect()} == {"P001": False, "P002": True}
    assert files.list_dirs(spark, f"{tmp_path}/wearable_events") == ["P001", "P002"]
    with pytest.raises(FileNotFoundError):
        files.check_readable(spark, f"{tmp_path}/nothing", "source")


def test_only_touched_partitions_are_overwritten(spark, tmp_path):
    base = str(tmp_path)
    sinks.write_table(spark.createDataFrame([(1, "a"), (2, "b")], "x int, day string"), base, "t", ("day",))
    sinks.write_table(spark.createDataFrame([(3, "b"), (4, None)], "x int, day string"), base, "t", ("day",))
    assert sorted(r["x"] for r in files.read_table(spark, base, "t").collect()) == [1, 3, 4]
    plan = files.read_table(spark, base, "t").where("day = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert not sinks.write_quarantine(spark.createDataFrame([], "x int"), base, "q") and not files.exists(spark, f"{base}/_quarantine")
    sinks.check_writable(spark, base, "target")


def test_lake(spark, tmp_path):
    base = str(tmp_path)
    sinks.write_table(spark.range(5), f"{base}/gold", "five")
    sinks.write_table(spark.range(2), f"{base}/gold/_analytics", "two")
    assert lake.list_tables(spark, base, "gold") == ["five"] and lake.list_tables(spark, base, "silver") == []
    assert [r[:] for r in lake.describe(spark, base).collect()] == [("gold", "five", 5, 1)]
    files.register({"five_view": lake.load_table(spark, base, "gold", "five")})
    assert spark.sql("SELECT count(*) FROM five_view").first()[0] == 5


def test_findings(spark):
    f = Findings()
    df = spark.createDataFrame([(1,), (9,), (9,), (None,)], "x int")
    f.range_check(df, "t", "x", 0, 5)
    f.duplicate_check(df, "t", ["x"], "warn")
    f.flag("t", "none", "info", 0)
    assert [r[:] for r in f.to_frame(spark).collect()] == [("t", "x_out_of_range", "error", 2, "outside [0, 5]"), ("t", "duplicate_key", "warn", 1, "x")]
    assert P.profile(df).first()[:] == ("x", 3, 25.0, 2, "1", "9", pytest.approx(19 / 3), None)


def test_checks_name_the_first_twelve(spark):
    df = spark.createDataFrame([(f"P{i:03d}", i % 2) for i in range(40)], "participant_id string, bad int")
    r = K.evaluate(df, "t", [K.Check("odd", "warn", F.col("bad"), "d"), K.Check("never", "warn", F.lit(0), "d")]).collect()
    assert len(r) == 1 and r[0]["n_affected"] == 20
    assert r[0]["participants"] == ", ".join(f"P{i:03d}" for i in range(1, 25, 2)) + " +8 more"


def test_unknown_devices_are_dropped_and_blanks_filled(spark):
    people = spark.createDataFrame([("P001",), ("P002",)], "participant_id string")
    rows = [("P001", "d1", "w", "2025-12-01", " ", "Charge 5 · fw2.2.1 · x"), ("P002", "d2", "w", "soon", "1.0.0", "Charge 6 · fw1.0.1"), ("P999", "d3", "w", None, None, None)]
    df, checks = clean.build_devices(spark.createDataFrame(rows, "participant_id string, device_id string, wear_site string, calibration_date string, firmware_version string, device_label string"), people, Study())
    got = {r["participant_id"]: (r["firmware_version"], r["firmware_source"], r["device_model"], r["calibration_date"]) for r in df.collect()}
    assert set(got) == {"P001", "P002"} and got["P001"][:3] == ("2.2.1", "device_label", "Charge 5") and got["P002"][1:] == ("firmware_version", "Charge 6", None)
    assert {r["rule"]: r["n_affected"] for r in checks.collect()} == {"firmware_label_conflict": 1, "firmware_backfilled_from_label": 1, "device_orphan_participant": 1}


@pytest.fixture(scope="module")
def daily(spark):
    rows = []
    for p in range(8):
        for d in range(10):
            complete = (p + d) % 3 > 0
            rows.append((f"P{p}", f"2026-01-{8 + d:02d}", "AB"[p % 2] if p < 7 else None, 1000.0 * p + d, complete, 0.5 * p + 0.1 * d, d % 4 > 0))
    df = spark.createDataFrame(rows, "participant_id string, date string, chronotype_declared string, steps_total double, is_complete_day boolean, mid_sleep_hour double, has_sleep_session boolean").withColumn("date", F.to_date("date"))
    extra = {c: F.lit(1.0) for c in ("active_minutes", "activity_midpoint_hour", "hr_resting_bpm", "hr_mean_bpm", "hr_max_bpm", "total_sleep_min", "sleep_efficiency_pct", "deep_sleep_pct", "rem_sleep_pct", "restlessness", "fatigue_score", "stress_score", "readiness_score", "sleep_quality_score", "coverage_pct", "age")}
    return df.withColumns(extra | {"sleep_onset_hour": F.col("mid_sleep_hour") - 3, "gender": F.lit("f"), "is_missing_day": F.lit(False), "has_survey": F.lit(True), "minutes_nulled": F.lit(0), "hr_stuck_minutes": F.lit(0), "minutes_unit_rescaled": F.lit(0), "study_week": F.expr("CAST(rint(1 + datediff(date, DATE'2026-01-08') / 7.0D) AS INT)")})


def test_weeks_have_two_denominators(daily):
    weekly = {(r["participant_id"], r["study_week"]): r for r in model.weekly_summary(daily).collect()}
    rows = [r for r in daily.where("participant_id = 'P3' AND study_week = 2").collect()]
    full = [r["steps_total"] for r in rows if r["is_complete_day"]]
    w = weekly["P3", 2]
    assert (w["days_in_week"], w["days_complete"], w["steps_total_sum"]) == (len(rows), len(full), sum(full))
    assert w["steps_total_mean"] == round(statistics.mean(full), 1) and w["steps_total_sd"] == round(statistics.stdev(full), 1)
    assert w["mid_sleep_hour_mean"] == pytest.approx(statistics.mean(r["mid_sleep_hour"] for r in rows), abs=6e-4)


def test_cohorts_over_the_study_and_by_week(daily):
    out = model.cohort_metrics(daily).collect()
    assert [(r["period_type"], r["period_label"], r["chronotype"]) for r in out] == [*[("week", str(w), c) for w in (1, 2) for c in "AB"], ("study", "all", "A"), ("study", "all", "B")]
    assert {r["chronotype"]: r["n_participants"] for r in out if r["period_type"] == "study"} == {"A": 4, "B": 3}
    trend = analytics.weekly_trend(model.cohort_metrics(daily)).collect()
    assert [(r["study_week"], r["chronotype"]) for r in trend] == [(1, "A"), (1, "B"), (2, "A"), (2, "B")]
    compared = {r["metric"]: r for r in analytics.cohort_comparison(model.cohort_metrics(daily)).collect()}
    assert len(compared) == 17 and compared["Participants"]["delta_b_minus_a"] == -1


def test_validation_splits_at_the_median(daily):
    out = {(r["chronotype_declared"], r["chronotype_derived"]): r for r in analytics.chronotype_validation(daily).collect()}
    assert sum(r["n_participants"] for r in out.values()) == 8
    assert {k[1] for k in out} == {"A", "B"} and out["A", "A"]["agrees"] and out[None, "B"]["agrees"] is None


def test_effect_sizes(daily):
    people = analytics.per_participant(daily)
    a, b = ([r["mid_sleep_hour_median"] for r in people.collect() if (r["chronotype"] == "A") == side] for side in (True, False))
    va, vb = statistics.variance(a), statistics.variance(b)
    t = (statistics.mean(b) - statistics.mean(a)) / math.sqrt(va / len(a) + vb / len(b))
    d = (statistics.mean(b) - statistics.mean(a)) / math.sqrt(((len(a) - 1) * va + (len(b) - 1) * vb) / (len(a) + len(b) - 2))
    out = {r["metric"]: r for r in analytics.effect_sizes(people).collect()}
    r = out["Mid-sleep time (h)"]
    assert (r["welch_t"], r["cohens_d"], r["p_approx"]) == (round(t, 2), round(d, 2), round(math.erfc(abs(t) / math.sqrt(2)), 4))
    assert r["defines_chronotype"] and not r["separates_cohorts"]
    assert out["Total sleep (min)"]["cohens_d"] is None and len(out) == 8


ODD_ARRAYS = {
    "plain": '[{"a": 1, "b": "x"},\n {"a": 2.50}, {"b": null}]',
    "compact": '[{"a":1},{"a":2}]',
    "nested": '[{"a": {"x": {"y": 1}}, "b": 2}, {"a": [{"z": 3}, {"z": 4}]}, {}]',
    "braces in texts": '[{"a": "}{ , } {"}, {"a": "{"}, {"b": "\\"}"}, {"c": "\\\\"}, {"d": "x}"}]',
    "empty": "[]",
    "blank": "",
    "lines": "[\n{\n\"a\": 1\n}\n,\n{\n\"a\": \"né {ß}\"\n}\n]\n",
}


def test_arrays_are_read_in_parts(spark, tmp_path):
    """Each file's objects and their places, also where files are cut every few bytes."""
    import json

    for name, text in ODD_ARRAYS.items():
        (tmp_path / name.replace(" ", "_")).mkdir()
        (tmp_path / name.replace(" ", "_") / "x.json").write_text(text)
    (tmp_path / "large").mkdir()
    (tmp_path / "large" / "x.json").write_text(json.dumps([{"i": i, "t": "{" if i == 977 else "é" * (i % 9)} for i in range(1000)]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in (before, "700b", "64b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            rows = files.json_objects(spark, [str(tmp_path / "*" / "x.json")]).collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        got = {}
        for r in rows:
            got.setdefault(r["_source_uri"].split("/")[-2], []).append((r["_ordinal"], json.loads(r["value"])))
        for name in [*ODD_ARRAYS, "large"]:
            text = (tmp_path / name.replace(" ", "_") / "x.json").read_text()
            assert sorted(got.get(name.replace(" ", "_"), []), key=lambda x: x[0]) == list(enumerate(json.loads(text) if text else [])), (name, size)


def test_equal_partitions_are_left_alone(spark, tmp_path):
    """A repeated write rewrites no file; a changed row rewrites its partition's; a null partition is one of its own."""
    base = str(tmp_path / "out")
    rows = [("a", 1, "x"), ("a", 2, None), ("b", 3, "y"), (None, 4, "z")]
    frame = lambda rows: spark.createDataFrame(rows, "day string, n int, t string").repartition(3)
    files_ = lambda: {p.parent.name: p.name for p in (tmp_path / "out" / "t").rglob("*.parquet")}
    assert sinks.write_changed(frame(rows), base, "t", ("day",)) == 3
    first = files_()
    assert sinks.write_changed(frame(rows[::-1]), base, "t", ("day",)) == 0 and files_() == first
    assert sinks.write_changed(frame([*rows[:2], ("b", 3, "other")]), base, "t", ("day",)) == 1
    second = files_()
    assert {k for k in first if first[k] != second[k]} == {"day=b"}
    assert sinks.write_changed(frame([*rows, rows[0]]), base, "t", ("day",)) == 2  # a row more, and b as it was
    assert sorted((r["day"] or "", r["n"], r["t"] or "") for r in files.read_table(spark, base, "t").collect()) == [("", 4, "z"), ("a", 1, "x"), ("a", 1, "x"), ("a", 2, ""), ("b", 3, "y")]
    assert [sinks.write_changed(frame(rows), base, "whole") for _ in range(2)] == [1, 0]
    assert len(files.list_dirs(spark, base + "/_manifest/t")) == 1
