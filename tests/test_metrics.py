"""Run history on hand-written records."""

import pytest
from pyspark.sql import functions as F

from claimloom.operators import metrics
from claimloom.operators.explore import class_balance, max_age_filter, status_histogram, text_coverage, top_unmapped_ratings
from claimloom.schema import PHASE_SNAPSHOT, RUN_RECORD


def runs(spark, *rows):
    filled = []
    for r in rows:
        base = {f.name: None for f in RUN_RECORD.fields} | {
            "duration_seconds": 1.0, "rows_read": 10, "rows_exported": 9, "rows_dropped_missing_text": 0,
            "rows_dropped_duplicate": 0, "rows_dropped_label": 1, "step_durations": {}}
        filled.append(tuple((base | r)[f.name] for f in RUN_RECORD.fields))
    return spark.createDataFrame(filled, RUN_RECORD)


def at(day, source="s", **more):
    return {"source": source, "run_timestamp": f"2024-01-{day:02d}T00:00:00Z", **more}


def test_merge_phase_metrics(spark):
    phases = spark.createDataFrame([
        ("s", "t", 1, 1.5, {"extract": 1.4, "x": 1.0}, {}, 100.0),
        ("s", "t", 2, 2.0, {"read": 0.5, "x": 2.0}, {"rows_read": 8, "rows_exported": 5}, 300.0),
        ("s", "t", 3, 0.25, {"x": 0.1}, {"rows_loaded": 5, "rows_read": 0}, None),
        ("s", "empty", 1, 0.1, {}, {}, 0.0),
    ], PHASE_SNAPSHOT)
    got = {r["run_timestamp"]: r for r in metrics.merge_phase_metrics(phases).collect()}
    run = got["t"]
    assert run["duration_seconds"] == 3.75 and run["peak_memory_mb"] == 300.0 and run["pct_valid"] == 62.5
    assert run["step_durations"] == {"extract": 1.4, "read": 0.5, "x": 0.1} and run["rows_loaded"] == 5
    empty = got["empty"]
    assert empty["pct_valid"] is None and empty["peak_memory_mb"] is None and empty["step_durations"] == {}


def test_latest_run_breaks_ties(spark):
    df = runs(spark, at(1), at(2, duration_seconds=3.0), at(2, duration_seconds=2.0), at(1, "o"))
    assert {r["source"]: r["duration_seconds"] for r in metrics.latest_run_per_source(df).collect()} == {"s": 3.0, "o": 1.0}


def test_badges(spark):
    values = [None, float("nan"), 100.0, 80.0, 79.99, 50.0, 49.99, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "p double")
    assert [r[0] for r in df.select(metrics.health_badge("p")).collect()] == [
        "no_data", "no_data", "good", "good", "watch", "watch", "problem", "problem"]


def test_overview_skips_nulls(spark):
    df = runs(spark, at(1, pct_valid=10.0), at(2, pct_valid=90.0), at(1, "o", pct_valid=None, peak_memory_mb=5.0))
    assert tuple(metrics.overview_kpis(df).first()) == (90.0, 1.0, 5.0, 3)


def test_precision_trend_needs_two_runs(spark):
    df = runs(spark, at(2, pct_valid=2.0), at(1, pct_valid=1.0), at(1, "single"))
    assert [r["pct_valid"] for r in metrics.precision_trend(df).collect()] == [1.0, 2.0]


def test_speed_alert_uses_earlier_runs_only(spark):
    same_day = {"source": "s", "run_timestamp": "2024-01-02T12:00:00Z", "duration_seconds": 12.0}
    df = runs(spark, at(1, duration_seconds=2.0), at(2, duration_seconds=4.0), same_day, at(5, duration_seconds=31.0), at(1, "o"))
    got = {r["run_timestamp"]: (r["mean_before"], r["alert"]) for r in metrics.speed_alert(df).filter("source = 's'").collect()}
    assert got == {
        "2024-01-01T00:00:00Z": (None, "no_data"), "2024-01-02T00:00:00Z": (2.0, "watch"),
        "2024-01-02T12:00:00Z": (3.0, "watch"), "2024-01-05T00:00:00Z": (6.0, "critical")}


def test_cost_and_precision_alerts(spark):
    df = runs(spark, at(1, peak_memory_mb=499.9), at(2, peak_memory_mb=500.0), at(3, peak_memory_mb=1024.0), at(4, peak_memory_mb=1024.1), at(5))
    alerts = [r["alert"] for r in metrics.cost_alert(df).orderBy("run_timestamp").collect()]
    assert alerts == ["good", "watch", "watch", "critical", "no_data"]
    df = runs(spark, at(1, "a", pct_valid=10.0), at(2, "a", pct_valid=90.0), at(1, "b", pct_valid=60.0), at(1, "c", pct_valid=5.0))
    assert {r["source"]: r["alert"] for r in metrics.precision_alert(df).collect()} == {"b": "watch", "c": "problem"}


def test_weekly_comparison_looks_one_calendar_week_back(spark):
    df = runs(spark, at(1, rows_dropped_label=3), at(3, rows_dropped_label=4), at(9, rows_dropped_label=5), at(29, rows_dropped_label=6))
    got = [(str(r["week"]), r["rows_dropped_label"], r["rows_dropped_label_week_before"])
           for r in metrics.weekly_drop_comparison(df).orderBy("week").collect()]
    assert got == [("2024-01-01", 7, None), ("2024-01-08", 5, 7), ("2024-01-29", 6, None)]


def test_label_imbalance(spark):
    rows = [("a", "fake")] * 99 + [("a", "true")] + [("b", "fake"), ("b", "true"), ("c", "fake"), ("c", None)]
    got = {(r["source"], r["label"]): (r["n"], r["share"], r["extreme"])
           for r in metrics.label_imbalance(spark.createDataFrame(rows, "source string, label string")).collect()}
    assert got[("a", "true")] == (1, 0.01, True) and got[("b", "fake")] == (1, 0.5, False)
    assert got[("c", "true")] == (0, 0.0, True) and got[("c", "fake")] == (1, 1.0, True)


def test_wide_long_and_ordered_tables(spark):
    df = runs(spark, at(1, "a", step_durations={"read": 1.0}, duration_seconds=9.0, peak_memory_mb=None), at(1, "b", peak_memory_mb=3.0))
    wide = {r["source"]: r["read"] for r in metrics.step_durations_wide(df).collect()}
    assert wide == {"a": 1.0, "b": None}
    assert metrics.drop_reasons_long(df).count() == 6
    assert [r["source"] for r in metrics.slowest_sources(df).collect()] == ["b", "a"]
    assert [r["source"] for r in metrics.costliest_sources(df).collect()] == ["b", "a"]
    assert metrics.run_history(df).count() == 2 and metrics.run_history(df, ["a"]).count() == 1
    assert tuple(metrics.runs_overview(df).first()) == (2, 2)


def test_exploration(spark):
    pages = spark.createDataFrame([(200, "x", None), (None, None, None), (200, None, "i"), (404, None, None)], "http_status int, article_text string, image_url string")
    assert [tuple(r) for r in status_histogram(pages).collect()] == [(200, 2), (404, 1), (None, 1)]
    assert tuple(text_coverage(pages).first()) == (4, 2, 1, 1, 0.25)
    ratings = spark.createDataFrame([(f"r{i:02d}",) for i in range(20)] + [("zz",), ("zz",), ("False",), (None,)], "textual_rating string")
    top = top_unmapped_ratings(ratings).collect()
    assert len(top) == 15 and tuple(top[0]) == ("zz", 2) and top[1]["rating"] == "r00"
    assert class_balance(spark.createDataFrame([("fake",), ("fake",), ("true",), (None,)], "label string")).collect()[0]["n"] == 2


def test_max_age(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2023-12-31T23:59:59Z",), ("bad",), (None,), ("May 1, 2024",)], "review_date string")
    kept = max_age_filter(df, "2024-06-29T00:00:00Z", days=180)
    assert {r["review_date"] for r in kept.collect()} == {"2024-01-01", "May 1, 2024"}
    assert max_age_filter(df, F.lit("2024-06-29").cast("timestamp"), days=1).count() == 0


def test_no_step_is_lost(spark):
    from claimloom.operators.metrics import step_durations_long, step_durations_wide
    from claimloom.schema import RUN_RECORD

    row = {f.name: None for f in RUN_RECORD.fields} | {"source": "s", "run_timestamp": "2024-01-01T00:00:00Z", "step_durations": {"clean": 1.0, "mine": 2.0}}
    runs = spark.createDataFrame([row], RUN_RECORD)
    assert {tuple(r) for r in step_durations_long(runs).collect()} == {("s", "clean", 1.0), ("s", "mine", 2.0)}
    with pytest.raises(Exception, match="steps without a column: mine"):
        step_durations_wide(runs).collect()
    assert step_durations_wide(runs, ["clean", "mine"]).first()["mine"] == 2.0
