import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.study import night
from tidemill.conf import Study
from tidemill.functions import exprs as X
from tidemill.operators import profile as P
from tidemill.operators import rules as R
from tidemill.plans import clean

S = Study()
AT = "2026-01-15T00:00:00"


def steps(spark, rows, unit=False):
    names = ["participant_id", "timestamp", "steps", *(["_unit"] if unit else []), "_ordinal"]
    kinds = dict.fromkeys(names, "string") | {"_ordinal": "int"}
    made = [(*[None if v is None else str(v) for v in r], i) for i, r in enumerate(rows)]
    return spark.createDataFrame(made, ", ".join(f"{n} {kinds[n]}" for n in names))


def minutes(start, values, gap_after=None):
    at = [datetime.fromisoformat(start) + timedelta(minutes=i + (360 if gap_after and i >= gap_after else 0)) for i in range(len(values))]
    return [("P001", t.isoformat(), v) for t, v in zip(at, values, strict=True)]


def found(checks):
    return {r["rule"]: r["n_affected"] for r in checks.collect()}


def test_clocks_meet(spark):
    df, checks = clean.build_steps(steps(spark, [("P018", "2026-01-15T05:00:00Z", 1), ("P018", AT, 1)]), S)
    assert [str(r["timestamp"]) for r in df.collect()] == ["2026-01-15 00:00:00"]
    assert found(checks) == {"timezone_normalised": 1, "duplicate_rows_removed": 1}


def test_duplicates_show_only_after_clocks(spark):
    raw = steps(spark, [("P018", "2026-01-15T05:00:00Z", 1), ("P018", AT, 1)])
    assert raw.dropDuplicates(["participant_id", "timestamp"]).count() == 2
    assert raw.transform(R.normalise_clock, "-05:00").transform(R.first_seen, ["participant_id", "timestamp"], ["_ordinal"]).count() == 1


@pytest.mark.parametrize(("text", "local", "off"), [("2026-01-15T10:00:37", "2026-01-15 10:00:00", True), ("2026-01-15T10:00:00.250", "2026-01-15 10:00:00", False), ("soon", None, False), (None, None, False), ("2026-01-15T02:30:00Z", "2026-01-14 21:30:00", False)])
def test_minutes(spark, text, local, off):
    df = steps(spark, [("P1", text, 1)]).transform(R.normalise_clock, "-05:00").transform(R.snap_to_minute)
    r = df.first()
    assert (r["timestamp"] and str(r["timestamp"]), r["was_off_minute"], r["was_unparseable"]) == (local, off, local is None)


def test_first_seen_stays(spark):
    df, _ = clean.build_steps(steps(spark, [("P1", "2026-01-15T10:00:37", 5), ("P1", "2026-01-15T10:00:00", 7)]), S)
    assert [(r["steps"], r["was_off_minute"]) for r in df.collect()] == [(5, True)]


@pytest.mark.parametrize(("value", "unit", "result", "rescaled"), [(600, "steps_per_hour", 10, True), (12, None, 12, False), (12, " Steps ", 12, False), (12, "steps_per_fortnight", None, False), (-1, None, None, False), (1_000_000, None, None, False), (-5, None, -5, False), (1_000_000, "steps_per_hour", 16667, True), ("x", None, None, False), (2.5, None, 2, False)])
def test_units_and_sentinels(spark, value, unit, result, rescaled):
    df, _ = clean.build_steps(steps(spark, [("P1", AT, value, unit)], unit=True), S)
    assert [(r["steps"], r["was_rescaled"]) for r in df.collect()] == [(result, rescaled)]


def test_an_hourly_day(spark):
    rows = [(p, t, 60, "steps_per_hour") for p, t, _ in minutes("2026-01-15T00:00:00", [0] * 1440)]
    df, _ = clean.build_steps(steps(spark, rows, unit=True), S)
    assert df.agg(F.sum("steps")).first()[0] == 1440


def test_a_doubled_day(spark):
    rows = minutes("2026-01-15T00:00:00", [3] * 1440)
    df, checks = clean.build_steps(steps(spark, rows + rows), S)
    assert df.agg(F.count("*"), F.sum("steps")).first()[:] == (1440, 4320)
    assert found(checks)["duplicate_rows_removed"] == 1440


@pytest.mark.parametrize(("values", "gap", "stuck"), [([60] * 65 + list(range(61, 90)), None, 65), ([70] * 110, 55, 0), ([70] * 59, None, 0), ([None] * 80, None, 0)])
def test_stuck(spark, values, gap, stuck):
    df, _ = clean.build_heart_rate(steps(spark, minutes("2026-01-15T00:00:00", values, gap)).withColumnRenamed("steps", "heart_rate_bpm"), S)
    assert df.count() == len(values)
    assert df.where("is_stuck").count() == stuck


@pytest.mark.parametrize(("bpm", "result"), [(72, 72), (-10, None), (999, None), (0, None), (20, 20), (250, 250)])
def test_heart_rate_range(spark, bpm, result):
    df, checks = clean.build_heart_rate(steps(spark, [("P1", AT, bpm)]).withColumnRenamed("steps", "heart_rate_bpm"), S)
    assert df.first()["heart_rate_bpm"] == result
    assert ("value_out_of_domain" in found(checks)) == (result is None)


def sleep(spark, *nights):
    import json

    from tidemill.sources.files import SLEEP

    df = spark.createDataFrame([(json.dumps(list(nights)),)], "value string").select(F.explode(F.from_json("value", SLEEP)).alias("s"))
    key = F.concat_ws("|", "s.participant_id", "s.date", "s.sleep_onset")
    sessions = df.select(key.alias("session_key"), "s.*").withColumn("n_stages", F.size("stages").cast("long")).drop("stages")
    stages = df.select(key.alias("session_key"), "s.participant_id", "s.date", F.posexplode("s.stages").alias("stage_idx", "g")).select("session_key", "participant_id", "date", "stage_idx", "g.*")
    return clean.build_sleep(sessions, stages, S)


def test_sleep_from_stages(spark):
    good, stages, bad, _ = sleep(spark, night("P1", 0))
    r = good.first()
    assert (r["total_sleep_min"], r["time_in_bed_min"], r["efficiency_pct_stated"], r["stage_order_canonical"]) == (240, 260, 100, True)
    assert r["sleep_efficiency_pct"] == pytest.approx(100 * 240 / 260) and r["mid_sleep_hour_signed"] == 1.0
    assert stages.count() == 5 and bad.count() == 0


def test_sleep_rejected(spark):
    empty = {**night("P4", 0), "stages": []}
    good, stages, bad, checks = sleep(spark, night("P1", 0, stated=99), night("P2", 0, end="18:00:00"), night("P3", 0, stated=99, end="18:00:00"), empty, night("P5", 0))
    assert {r["participant_id"]: r["reject_reason"] for r in bad.collect()} == {"P1": "stage_duration_mismatch", "P2": "sleep_end_corrupt", "P3": "stage_duration_mismatch", "P4": "incomplete_stages"}
    assert [r["participant_id"] for r in good.collect()] == ["P5"] and stages.count() == 5
    assert found(checks)["sessions_quarantined"] == 4


def test_grid_beats_row_counts(spark):
    day = lambda d: minutes(f"2026-01-{d:02d}T00:00:00", [1] * 1440)
    df, _ = clean.build_steps(steps(spark, day(9) + day(10) + day(10)), S)
    hr, _ = clean.build_heart_rate(steps(spark, day(9) + day(10)).withColumnRenamed("steps", "heart_rate_bpm").withColumn("heart_rate_bpm", F.lit("70")), S)
    people = spark.createDataFrame([("P001",)], "participant_id string")
    none = spark.createDataFrame([], "participant_id string, date date")
    grid, _ = clean.build_coverage(people, df, hr, none, none, S)
    by = {str(r["date"]): r for r in grid.collect()}
    assert len(by) == 28 and sum(r["is_complete_day"] for r in by.values()) == 2
    assert by["2026-01-08"]["is_missing_day"] and by["2026-01-10"]["is_complete_day"]


@pytest.mark.parametrize(("x", "digits", "away", "even"), [(2.5, 0, 3.0, 2.0), (-2.5, 0, -3.0, -2.0), (0.125, 2, 0.13, 0.12), (1.005, 2, 1.0, 1.0), (None, 1, None, None)])
def test_rounding(spark, x, digits, away, even):
    r = spark.createDataFrame([(x,)], "x double").select(X.scaled_round(F.col("x"), digits), X.even_round(F.col("x"), digits)).first()
    assert r[:] == (away, even)


def test_partition_counts_do_not_matter(spark):
    rows = steps(spark, minutes("2026-01-15T00:00:00", list(range(50)) * 3))
    results = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(sorted(map(tuple, clean.build_steps(rows, S)[0].collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1]


def test_empty_tables(spark):
    df, checks = clean.build_steps(steps(spark, []), S)
    assert df.count() == 0 and checks.count() == 0
    assert P.describe(spark.createDataFrame([], "x double"), ["x"]).first()["count"] == 0


def test_bins_are_closed_on_the_right(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (2.0,), (3.0,)], "x double").select(P.bins(F.col("x"), [0, 1, 2]).alias("b"))
    assert [r[0] for r in df.collect()] == [None, 0, 1, 1, None]


def test_duplicates_are_combined_before_the_shuffle(spark):
    """A minute that is repeated many times is a row for each part; of all its rows the flags are counted."""
    rows = spark.range(20_000).selectExpr("'P001' AS participant_id", "CAST(id % 2 AS string) AS timestamp", "id AS _ordinal", "id % 4 = 0 AS odd").repartition(4)
    df = R.first_seen(rows, ["participant_id", "timestamp"], ["_ordinal"], ("odd",))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min_by") > plan.index("Exchange hashpartitioning")  # nearer to the scan, which is printed last
    assert sorted((r["_ordinal"], r["n_dropped"], r["n_odd"]) for r in df.collect()) == [(0, 9999, 5000), (1, 9999, 0)]


def brute_runs(rows, near):
    """(who, at) -> (run_id, length, start) by going through each participant's rows."""
    out = {}
    for who in {r[0] for r in rows}:
        line = sorted(((at, v) for w, at, v in rows if w == who), key=lambda x: x[0])
        ids = []
        for i, (at, v) in enumerate(line):
            same = i and v is not None and line[i - 1][1] == v and (near is None or at - line[i - 1][0] == near)
            ids.append(ids[-1] if same else len(set(ids)) + 1)
        for (at, _), k in zip(line, ids, strict=True):
            out[who, at] = (k, ids.count(k), ids.index(k) == [a for a, _ in line].index(at))
    return out


@pytest.mark.parametrize("near", [None, 1])
@pytest.mark.parametrize("width", [None, 1, 7, 64])
def test_runs_of_a_hot_participant_by_segments(spark, near, width):
    """90 % of rows are one participant's: runs within, across and over whole segments are those of the whole line."""
    import random

    rng = random.Random(4)
    rows, at = [], 0
    while at < 1800:
        for _ in range(rng.choice([1, 2, 5, 40, 150])):
            rows.append(("hot", at, v := rng.choice([1.0, 2.0, None]) if not rows or rng.random() < 0.2 else rows[-1][2]))
            at += 1 if rng.random() < 0.95 else 3
    rows += [(w, i, float(i // 9)) for w in ("a", "b", None) for i in range(0, 60, 2 if w == "b" else 1)]
    df = spark.createDataFrame(rows, "who string, at long, v double").repartition(4)
    segment = None if width is None else F.floor(F.col("at") / width)
    step = None if near is None else F.lit(near).cast("long")
    got = R.runs(df, "v", ["who"], "at", step, segment)
    assert {(r["who"], r["at"]): (r["run_id"], r["run_length"], r["run_start"]) for r in got.collect()} == brute_runs(rows, near)
    assert got.columns == ["who", "at", "v", "run_id", "run_length", "run_start"]


def test_no_task_has_a_hot_participant(spark):
    rows = spark.range(60 * 1440).selectExpr("CASE WHEN id % 10 = 0 THEN concat('P', id % 7) ELSE 'hot' END AS participant_id", "TIMESTAMP_NTZ '2026-01-08 00:00:00' + make_dt_interval(0, 0, CAST(id AS int)) AS timestamp", "CAST(id % 1000 < 70 AS double) AS v")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = R.flag_stuck(rows, "v", 60)
        sizes = [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 60 * 1440 and max(sizes) < 0.4 * sum(sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_erfc(spark):
    xs = [0.0, 1e-9, 0.1, 0.5, 1.0, 2.0, 2.499, 2.5, 2.501, 3.0, 5.0, 8.0, 20.0, -0.3, -4.0]
    df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "x double")
    for r in df.select("x", X.erfc(F.col("x")).alias("y")).collect():
        assert r["y"] is None if r["x"] is None else r["y"] == pytest.approx(math.erfc(r["x"]), rel=1e-11)


def test_quantiles_of_groups(spark):
    rows = [("a", float(i % 37)) for i in range(500)] + [("b", 1.0), ("b", None), (None, 2.0), (None, 5.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(3)
    got = {(r["g"], r["q"]): r["value"] for r in P.quantiles(df, ["g"], "v", (0.0, 0.3, 0.5, 1.0)).collect()}
    want = df.groupBy("g").agg(F.percentile("v", F.array(*map(F.lit, (0.0, 0.3, 0.5, 1.0)))).alias("x")).where("x IS NOT NULL").collect()
    assert got == pytest.approx({(r["g"], q): x for r in want for q, x in zip((0.0, 0.3, 0.5, 1.0), r["x"], strict=True)})
    assert P.quantiles(df, [], "v", (0.5,)).first()["value"] == df.agg(F.median("v")).first()[0]


def test_samples_do_not_depend_on_parts(spark):
    df = spark.range(500).selectExpr("id", "id % 3 AS x")
    one, two = (sorted(map(tuple, P.sample(df.repartition(n), 20, ["id"], 5).collect())) for n in (1, 7))
    assert one == two and len(one) == 20 != len(P.sample(df, 900, ["id"]).collect())
    assert one != sorted(map(tuple, P.sample(df, 20, ["id"], 6).collect()))


def test_stream_agrees_with_batch(spark, tmp_path):
    from tidemill.streaming.events import clean_steps

    rows = steps(spark, minutes("2026-01-15T00:00:00", list(range(30))) * 2)
    rows.write.parquet(str(tmp_path / "in"))
    out = clean_steps(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), S)
    out.writeStream.format("memory").queryName("cleaned").start().processAllAvailable()
    assert spark.table("cleaned").count() == clean.build_steps(rows, S)[0].count() == 30
    for q in spark.streams.active:
        q.stop()
