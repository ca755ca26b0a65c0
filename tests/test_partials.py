"""Run figures from partials that are added up, against the whole history."""

import random

import pytest
from pyspark.sql import functions as F

from claimloom.operators import metrics, partials

RUNS = "source string, run_timestamp string, duration_seconds double, pct_valid double, peak_memory_mb double"


def history(spark, n, seed=1):
    rng = random.Random(seed)
    rows = [(rng.choice("abc"), f"2024-01-{rng.randrange(1, 29):02}T0{rng.randrange(10)}:00:00Z", round(rng.uniform(0, 100), 4),
             rng.choice([None, round(rng.uniform(0, 100), 2)]), rng.choice([None, 512.5])) for _ in range(n)]
    return spark.createDataFrame([*rows, ("a", None, 1.0, 2.0, 3.0), (None, "2024-01-01T00:00:00Z", None, None, None)], RUNS)


def test_pieces_in_any_order_equal_the_whole_history(spark, tmp_path):
    path, runs = str(tmp_path / "partials"), history(spark, 600)
    assert partials.kpi_summary(partials.stored_partials(spark, path)).count() == 0
    piece = F.pmod(F.hash("run_timestamp", "duration_seconds"), F.lit(3))
    for k in (2, 0, 1):
        partials.append_partials(runs.where(piece == k), path)
    stored = partials.stored_partials(spark, path)
    assert stored.count() == stored.select("source", "day").distinct().count() <= 28 * 3 + 2
    assert sorted(map(repr, partials.kpi_summary(stored).collect())) == sorted(map(repr, metrics.kpi_summary(runs).collect()))


def test_quantiles_keep_the_error_bound(spark):
    rows = [("s", f"2024-01-{1 + k % 20:02}T00:00:00Z", float((k * 7919) % 20_011), 1.0, 1.0) for k in range(20_011)]
    runs = spark.createDataFrame(rows, RUNS).repartition(7)
    new = spark.createDataFrame([("s", "2024-02-01T00:00:00Z", 1e9, None, None), ("s", "2024-02-01T01:00:00Z", 0.0, None, None),
                                 ("s", "2024-01-01T00:00:00Z", 5.0, None, None), ("other", "2024-02-01T00:00:00Z", 5.0, None, None)], RUNS)
    for quantile in (0.5, 0.95):
        got = {(r["source"], r["run_timestamp"]): r for r in partials.duration_alert(new, partials.run_partials(runs), quantile).collect()}
        first = got["s", "2024-02-01T00:00:00Z"]
        assert first["usual"] / 20_011 == pytest.approx(quantile, abs=0.02)
        assert [r["alert"] for _, r in sorted(got.items())] == ["no_data", "no_data", "slow", "good"]
