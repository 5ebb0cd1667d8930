"""A made-up export with defects at known counts."""

import csv
import json
from datetime import datetime, timedelta

START = datetime(2026, 1, 8)


def write(root, people=3, days=2):
    """Participants P001.. with ``days`` of minutes each; DEFECTS says what is wrong with them."""
    for d in ("participants", "health_summaries"):
        (root / d).mkdir(parents=True)
    ids = [f"P{i:03d}" for i in range(1, people + 1)]
    serial = lambda i: f"FBT-{i:04d}-9D79801C"
    _csv(root / "participants/participants.csv", ["participant_id", "device_id", "age", "height_cm", "gender", "chronotype", "max_heart_rate"], [[p, serial(i), 30 + i, "NA" if i == 0 else 170, "f", "AB"[i % 2], 190] for i, p in enumerate(ids)])
    devices = [[p, serial(i), "wrist", "2025-12-01" if i else "2026-01-20", "" if i == 0 else "2.2.1", f"Band 5 · fw2.2.1 · SN:{serial(i)}"] for i, p in enumerate(ids)]
    _csv(root / "health_summaries/device_metadata.csv", ["participant_id", "device_id", "wear_site", "calibration_date", "firmware_version", "device_label"], [*devices, ["P999", "FBT-9999-00000000", "wrist", "2025-12-01", "1.0.0", "x"]])
    survey = [[p, (START + timedelta(days=d)).date(), 3, 2, 7, 4] for p in ids for d in range(days)]
    _csv(root / "health_summaries/wellness_survey.csv", ["participant_id", "date", "fatigue_score", "stress_score", "readiness_score", "sleep_quality_score"], [*survey, [*survey[0][:2], 1, 1, 1, 1], ["P999", START.date(), 1, 1, 1, 1]])
    for i, p in enumerate(ids):
        folder = root / "wearable_events" / p
        folder.mkdir(parents=True)
        steps, hr = [], []
        for m in range(days * 1440):
            at = START + timedelta(minutes=m)
            value = 600 if i == 1 else 10 if at.hour == 12 else 0
            steps.append({"timestamp": at.isoformat(), "steps": value, "participant_id": p} | ({"_unit": "steps_per_hour"} if i == 1 else {}))
            hr.append({"timestamp": at.isoformat(), "heart_rate_bpm": 60 + m % 40, "participant_id": p})
        if i == 0:
            steps[5]["timestamp"] = (START + timedelta(minutes=5, hours=5)).isoformat() + "Z"
            steps[6]["steps"], steps[7]["steps"] = -1, 1_000_000
            steps.append({**steps[8], "timestamp": steps[8]["timestamp"][:-2] + "37"})
            hr[9]["heart_rate_bpm"] = 999
            for x in hr[100:165]:
                x["heart_rate_bpm"] = 61
        if i == 2:
            del steps[1440:], hr[1440:]
        (folder / "steps.json").write_text(json.dumps(steps))
        (folder / "heart_rate.json").write_text(json.dumps(hr))
        (folder / "sleep.json").write_text(json.dumps([night(p, d, stated=99 if (i, d) == (1, 1) else 60) for d in range(days)]))
    return ids


#: What write() put in, by table and rule: rows affected.
DEFECTS = {
    ("silver_steps_minute", "timezone_normalised"): 1,
    ("silver_steps_minute", "timestamp_snapped_to_minute"): 1,  # the drifted copy is counted, though it goes as a duplicate
    ("silver_steps_minute", "unit_rescaled"): 2880,
    ("silver_steps_minute", "value_out_of_domain"): 2,
    ("silver_steps_minute", "duplicate_rows_removed"): 1,
    ("silver_steps_minute", "unit_field_nonstandard_name"): 2880,
    ("bronze_steps", "undocumented_source_field"): 1,
    ("silver_heart_rate_minute", "value_out_of_domain"): 1,
    ("silver_heart_rate_minute", "stuck_sensor_flagged"): 65,
    ("silver_sleep_stages", "stage_duration_mismatch"): 1,
    ("silver_sleep_sessions", "source_efficiency_ignored"): 6,
    ("silver_sleep_sessions", "sessions_quarantined"): 1,
    ("silver_devices", "firmware_backfilled_from_label"): 1,
    ("silver_devices", "calibration_after_study_start"): 1,
    ("silver_devices", "device_orphan_participant"): 1,
    ("silver_wellness_survey", "survey_orphan_participant"): 1,
    ("silver_wellness_survey", "duplicate_survey_response"): 1,
    ("silver_participant_day_coverage", "participant_day_missing"): 3 * 28 - 5,
    ("silver_participant_day_coverage", "grid_size"): 3 * 28,
}


def night(p, day, stated=60, end="03:00:00"):
    """light 60, deep 60, rem 60, light 60 from 23:00, then awake 20."""
    at = START + timedelta(days=day, hours=-1)
    stages, t = [], at
    for stage, m in (("light", 60), ("deep", 60), ("rem", 60), ("light", 60), ("awake", 20)):
        stages.append({"stage": stage, "start_time": t.isoformat(), "end_time": (t + timedelta(minutes=m)).isoformat(), "duration_min": stated if stage == "deep" else m})
        t += timedelta(minutes=m)
    date = (START + timedelta(days=day)).date().isoformat()
    return {"participant_id": p, "date": date, "sleep_onset": at.isoformat(), "sleep_end": f"{date}T{end}", "efficiency_pct": 100.0, "restlessness": 0.1, "stages": stages}


def _csv(path, head, rows):
    with path.open("w", newline="") as f:
        w = csv.writer(f)
        w.writerow(head)
        w.writerows(rows)
