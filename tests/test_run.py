from pyspark.sql import functions as F

from tests import study
from tidemill.conf import load_settings
from tidemill.plans import run as R
from tidemill.sources.files import exists, list_dirs, read_table


def _same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_run_finds_each_defect_and_publishes(spark, tmp_path):
    study.write(tmp_path / "in")
    s = load_settings(str(tmp_path / "in"), str(tmp_path / "out"))
    kept = R.run(spark, s, run_id="one")
    found = {(r["table"], r["rule"]): r for r in kept.collect()}
    for key, n in study.DEFECTS.items():
        assert (found[key]["n_affected"] if key in found else 0) == n, key
    assert found["silver_steps_minute", "unit_rescaled"]["participants"] == "P002"
    assert found["silver_steps_minute", "duplicate_rows_removed"]["detail"].count(" 1 day(s)") == 1
    assert found["silver_heart_rate_minute", "stuck_sensor_flagged"]["detail"].startswith("1 run(s)")
    severity = {"firmware_backfilled_from_label": "warn", "calibration_after_study_start": "error", "undocumented_source_field": "error", "source_efficiency_ignored": "warn", "participant_device_one_to_one": "info"}
    assert severity == {rule: r["severity"] for (_, rule), r in found.items() if rule in severity}
    answers = read_table(spark, f"{s.target}/silver", "wellness_survey").where("participant_id = 'P001' AND date = DATE '2026-01-08'").collect()
    assert [r["fatigue_score"] for r in answers] == [3]  # the first in the file, though the later answer is lower
    failed = [k for k, r in found.items() if r["severity"] == "assert_fail"]
    assert not failed
    assert sum(r["severity"] == "assert_pass" for r in kept.collect()) == 21

    daily = read_table(spark, f"{s.target}/gold", "daily_participant_metrics").cache()
    rows = {(r["participant_id"], str(r["date"])): r for r in daily.collect()}
    assert len(rows) == 3 * 28
    assert rows["P002", "2026-01-08"]["steps_total"] == 14400
    assert rows["P001", "2026-01-08"]["active_minutes"] == 60
    assert rows["P001", "2026-01-08"]["activity_midpoint_hour"] == 12.492
    assert rows["P001", "2026-01-08"]["hr_stuck_minutes"] == 65
    assert rows["P001", "2026-01-08"]["minutes_nulled"] == 3
    assert rows["P001", "2026-01-08"]["sleep_efficiency_pct"] == 92.31
    assert rows["P001", "2026-01-08"]["mid_sleep_hour"] == 1.0
    assert not rows["P002", "2026-01-09"]["has_sleep_session"]
    weeks = daily.select("study_week").distinct().count()
    assert weeks == 5  # rounded weeks, as published
    assert [r["n"] for r in daily.where("participant_id = 'P001'").groupBy("study_week").agg(F.count("*").alias("n")).orderBy("study_week").collect()] == [4, 7, 7, 7, 3]
    weekly = read_table(spark, f"{s.target}/gold", "weekly_participant_summary")
    first = weekly.where("participant_id = 'P003' AND study_week = 1").first()
    assert (first["days_complete"], first["steps_total_mean"], first["steps_total_sd"], first["nights_with_sleep"]) == (1, 600.0, None, 2)
    cohorts = read_table(spark, f"{s.target}/gold", "chronotype_cohort_metrics")
    assert cohorts.count() == 2 + 10
    assert exists(spark, f"{s.target}/_quarantine/sleep_sessions") and exists(spark, f"{s.target}/_quarantine/wellness_survey")
    compared = read_table(spark, f"{s.target}/gold/_analytics", "analytics_01_cohort_comparison")
    assert compared.count() == 17
    assert "Chronotypes" in (tmp_path / "out/outputs/analytics_report.md").read_text()
    assert "is the declared one for" in (tmp_path / "out/outputs/analytics_report.md").read_text()
    assert (tmp_path / "out/outputs/dq_checks.csv").read_text().count("\n") == kept.count() + 1

    # Again from what is published: the same content, and another run's checks beside the first.
    again = str(tmp_path / "again")
    daily.write.parquet(again)
    daily.unpersist()
    R.run(spark, s, ("silver", "gold"), run_id="two")
    assert _same(spark.read.parquet(again), read_table(spark, f"{s.target}/gold", "daily_participant_metrics"))
    assert list_dirs(spark, f"{s.target}/_dq/dq_checks/{list_dirs(spark, s.target + '/_dq/dq_checks')[0]}") == ["run_id=one", "run_id=two"]


def test_some_participants_only(spark, tmp_path):
    study.write(tmp_path / "in", people=2, days=1)
    s = load_settings(str(tmp_path / "in"), str(tmp_path / "out"), participants=("P002",))
    R.run(spark, s, ("bronze", "silver"))
    steps = read_table(spark, f"{s.target}/silver", "steps_minute")
    assert [r[0] for r in steps.select("participant_id").distinct().collect()] == ["P002"]
    assert read_table(spark, f"{s.target}/silver", "participant_day_coverage").count() == 2 * 28


def test_command_line(spark, tmp_path, capsys):
    study.write(tmp_path / "in", people=2, days=1)
    assert R.main(["--source", str(tmp_path / "in"), "--target", str(tmp_path / "out"), "--layers", "bronze,silver,gold", "--strict"]) == 0
    assert "assert_pass 21" in capsys.readouterr().out


def test_settings():
    env = {"SOURCE_URI_LOCAL": "a/", "TARGET_URI_LOCAL": " 'b' ", "TARGET_URI_REMOTE": "s3a://t", "SOURCE_URI_REMOTE": "s3a://s"}
    assert load_settings(env=env).source == "a" and load_settings(env=env).target == "b"
    assert load_settings(source="x", env=env).source == "x"
    assert load_settings(online=True, env=env).mode == "remote -> remote"
    assert load_settings(env={}).compression == "zstd"
