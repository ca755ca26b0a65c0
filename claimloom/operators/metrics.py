"""Run history: precision, speed and cost per source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions import as_column
from claimloom.functions.numbers import exact, exact_mean, exact_sum, round_half_even
from claimloom.operators.dedup import keep_last
from claimloom.schema import COUNTERS, DROP_REASONS, RUN_RECORD

# Thresholds of the three indicators.
PRECISION_GOOD, PRECISION_WATCH = 80.0, 50.0
SPEED_WATCH, SPEED_CRITICAL = 2.0, 5.0
MEMORY_WATCH_MB, MEMORY_CRITICAL_MB = 500.0, 1024.0
# Step names, in the order a run goes through them.
STEPS = ("extract", "read", "adapt", "clean", "enrich", "export", "load")


def pct_valid(exported: Column | str, read: Column | str) -> Column:
    """Share of read rows that were exported, in percent; null when nothing was read."""
    exported, read = as_column(exported), as_column(read)
    return F.when(read != 0, round_half_even((100 * exported).cast("double") / read, 2))


def merge_phase_metrics(phases: DataFrame) -> DataFrame:
    """One record per (source, run_timestamp) from its phases' snapshots.

    Counts and elapsed times add up, memory is the worst phase's (0 is unknown),
    and of two phases naming the same step the later one counts.
    """
    run = ["source", "run_timestamp"]
    totals = phases.groupBy(*run).agg(
        F.coalesce(exact_sum("elapsed_seconds"), F.lit(0.0)).alias("duration_seconds"),
        *[
            F.coalesce(F.sum(F.try_element_at("counts", F.lit(c))), F.lit(0)).cast("long").alias(c)
            for c in COUNTERS
        ],
        F.nullif(F.max(F.coalesce("peak_memory_mb", F.lit(0.0))), F.lit(0.0)).alias("peak_memory_mb"),
    )
    # Grouping by step first leaves one entry per step name to collect.
    steps = (
        phases.select(*run, "phase_no", F.explode("step_durations").alias("step", "seconds"))
        .groupBy(*run, "step")
        .agg(F.max_by("seconds", "phase_no").alias("seconds"))
        .groupBy(*run)
        .agg(F.map_from_entries(F.collect_list(F.struct("step", "seconds"))).alias("step_durations"))
    )
    merged = totals.join(steps, run, "left").withColumns({
        "step_durations": F.coalesce("step_durations", F.create_map().cast("map<string,double>")),
        "pct_valid": pct_valid("rows_exported", "rows_read"),
    })
    return merged.select(*RUN_RECORD.fieldNames())


def latest_run_per_source(runs: DataFrame, tie_break: Sequence[str] = ("duration_seconds", "rows_read")) -> DataFrame:
    return keep_last(runs, ["source"], ["run_timestamp", *tie_break])


def overview_kpis(runs: DataFrame) -> DataFrame:
    """Means over each source's latest run, and the number of all runs."""
    at = F.struct("run_timestamp", "duration_seconds", "rows_read")
    shown = F.struct("pct_valid", "duration_seconds", "peak_memory_mb")
    per_source = runs.groupBy("source").agg(F.max_by(shown, at).alias("latest"), F.count("*").alias("n"))
    return per_source.agg(
        round_half_even(exact_mean("latest.pct_valid"), 2).alias("mean_pct_valid"),
        round_half_even(exact_mean("latest.duration_seconds"), 2).alias("mean_duration_seconds"),
        round_half_even(exact_mean("latest.peak_memory_mb"), 2).alias("mean_peak_memory_mb"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("runs"),
    )


def health_badge(pct: Column | str) -> Column:
    """good, watch, problem, or no_data for a precision in percent."""
    pct = as_column(pct)
    return (
        F.when(pct.isNull() | F.isnan(pct), "no_data")
        .when(pct >= PRECISION_GOOD, "good")
        .when(pct >= PRECISION_WATCH, "watch")
        .otherwise("problem")
    )


def source_status(runs: DataFrame) -> DataFrame:
    """State table: the latest run of each source with its badge."""
    return latest_run_per_source(runs).select(
        "source", health_badge("pct_valid").alias("health"), "pct_valid", "duration_seconds", "peak_memory_mb"
    )


def drop_reasons_long(runs: DataFrame) -> DataFrame:
    """Drop counters of the latest runs, one row per source and reason."""
    return latest_run_per_source(runs).unpivot("source", list(DROP_REASONS), "cause", "rows")


def slowest_sources(runs: DataFrame) -> DataFrame:
    return latest_run_per_source(runs).select("source", "duration_seconds").orderBy("duration_seconds", "source")


def costliest_sources(runs: DataFrame) -> DataFrame:
    latest = latest_run_per_source(runs).select("source", "peak_memory_mb")
    return latest.orderBy(F.col("peak_memory_mb").asc_nulls_last(), "source")


def step_durations_wide(runs: DataFrame, steps: Sequence[str] = STEPS) -> DataFrame:
    """Step times of the latest runs, one column per step; null where a step did not run.

    A run with a step beyond ``steps`` fails the job: name it in ``steps``, or
    take ``step_durations_long``, which holds any.
    """
    other = F.array_except(F.map_keys("step_durations"), F.array(*[F.lit(s) for s in steps]))
    refused = F.raise_error(F.concat(F.lit("steps without a column: "), F.array_join(other, ", ")))
    columns = [F.try_element_at("step_durations", F.lit(s)).alias(s) for s in steps]
    source = F.when(F.size(other) > 0, refused).otherwise(F.col("source")).alias("source")
    return latest_run_per_source(runs).select(source, *columns)


def step_durations_long(runs: DataFrame) -> DataFrame:
    """Step times of the latest runs, one row per source and step, whatever the steps are called."""
    return latest_run_per_source(runs).select("source", F.explode("step_durations").alias("step", "seconds"))


def precision_trend(runs: DataFrame) -> DataFrame:
    """Precision over time, for sources that ran more than once."""
    repeated = runs.groupBy("source").agg(F.count("*").alias("n")).filter("n > 1").select("source")
    trend = runs.select("source", "run_timestamp", "pct_valid").join(repeated, "source", "left_semi")
    return trend.orderBy("source", "run_timestamp")


def kpi_summary(runs: DataFrame) -> DataFrame:
    return runs.groupBy("source").agg(
        F.count("run_timestamp").alias("runs"),
        round_half_even(exact_mean("pct_valid"), 2).alias("mean_pct_valid"),
        round_half_even(exact_mean("duration_seconds"), 2).alias("mean_duration_seconds"),
        round_half_even(exact_mean("peak_memory_mb"), 2).alias("mean_peak_memory_mb"),
    )


def run_history(runs: DataFrame, sources: Sequence[str] | None = None) -> DataFrame:
    """All runs, or those of the chosen sources, newest first."""
    chosen = runs if sources is None else runs.filter(F.col("source").isin(*sources))
    return chosen.orderBy(F.col("run_timestamp").desc(), "source")


def runs_overview(runs: DataFrame) -> DataFrame:
    return runs.agg(F.count("*").alias("runs"), F.count_distinct("source").alias("sources"))


def speed_alert(runs: DataFrame) -> DataFrame:
    """Each run's duration against the mean of its source's earlier runs.

    Earlier days enter as daily sums, so only the runs of one source and day are
    ordered in one task, not a source's whole history.
    """
    day = F.to_date("run_timestamp")
    timed = runs.withColumn("_day", day).select("source", "_day", "run_timestamp", "duration_seconds")
    days_before = Window.partitionBy("source").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    daily = (
        timed.groupBy("source", "_day")
        .agg(F.sum(exact("duration_seconds")).alias("s"), F.count("duration_seconds").alias("n"))
        .select("source", "_day", F.sum("s").over(days_before).alias("s"), F.sum("n").over(days_before).alias("n"))
    )
    same_day = (
        Window.partitionBy("source", "_day").orderBy("run_timestamp").rowsBetween(Window.unboundedPreceding, -1)
    )
    zero = F.lit(0)
    history = timed.withColumns({
        "_s": F.coalesce(F.sum(exact("duration_seconds")).over(same_day), zero),
        "_n": F.coalesce(F.count("duration_seconds").over(same_day), zero),
    }).join(daily, ["source", "_day"], "left")
    runs_before = F.col("_n") + F.coalesce("n", zero)
    mean = F.when(runs_before > 0, (F.col("_s") + F.coalesce("s", zero)).cast("double") / runs_before)
    return history.withColumn("mean_before", mean).select(
        "source",
        "run_timestamp",
        "duration_seconds",
        round_half_even("mean_before", 4).alias("mean_before"),
        F.when(F.col("mean_before").isNull(), "no_data")
        .when(F.col("duration_seconds") > SPEED_CRITICAL * F.col("mean_before"), "critical")
        .when(F.col("duration_seconds") >= SPEED_WATCH * F.col("mean_before"), "watch")
        .otherwise("good")
        .alias("alert"),
    )


def cost_alert(runs: DataFrame) -> DataFrame:
    memory = F.col("peak_memory_mb")
    level = (
        F.when(memory.isNull(), "no_data")
        .when(memory > MEMORY_CRITICAL_MB, "critical")
        .when(memory >= MEMORY_WATCH_MB, "watch")
        .otherwise("good")
    )
    return runs.select("source", "run_timestamp", "peak_memory_mb", level.alias("alert"))


def precision_alert(runs: DataFrame) -> DataFrame:
    """Sources whose latest run is in the watch or problem zone."""
    status = source_status(runs).select("source", "pct_valid", F.col("health").alias("alert"))
    return status.filter(F.col("alert").isin("watch", "problem"))


def weekly_drop_comparison(runs: DataFrame) -> DataFrame:
    """Dropped rows per source and week, next to the calendar week before (null if it had no run)."""
    weekly = runs.groupBy("source", F.to_date(F.date_trunc("week", F.to_timestamp("run_timestamp"))).alias("week")).agg(
        *[F.sum(c).cast("long").alias(c) for c in DROP_REASONS]
    )
    w = Window.partitionBy("source").orderBy("week")
    adjacent = F.lag("week").over(w) == F.date_sub("week", 7)
    before = [F.when(adjacent, F.lag(c).over(w)).alias(f"{c}_week_before") for c in DROP_REASONS]
    return weekly.select("source", "week", *DROP_REASONS, *before)


def label_imbalance(claims: DataFrame, rare: float = 0.05) -> DataFrame:
    """Share of each label per source; ``extreme`` where some label stays under ``rare``."""
    flags = {label: F.count_if(F.col("label") == label) for label in ("fake", "true")}
    per_source = claims.filter(F.col("label").isNotNull()).groupBy("source").agg(
        F.count("*").alias("_all"), *[n.alias(label) for label, n in flags.items()]
    )
    rarest = F.least(*[F.col(label) for label in flags]) / F.col("_all")
    return (
        per_source.withColumn("extreme", rarest < rare)
        .unpivot(["source", "_all", "extreme"], list(flags), "label", "n")
        .select("source", "label", "n", round_half_even(F.col("n") / F.col("_all"), 4).alias("share"), "extreme")
    )
