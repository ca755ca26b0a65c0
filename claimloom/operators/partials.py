"""Run figures that new runs update without the history.

Runs come down to one row per source and day: exact sums and counts, and a
quantile sketch of their durations. Such rows are merged by adding them up, so
a store of them is appended to like the history itself, in any order and in
pieces, and its size follows the days, not the runs. What is read off them
equals what the whole history gives; quantiles have the sketch's rank error.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions.numbers import exact, round_half_even
from claimloom.schema import RUN_PARTIAL

#: Size of a sketch. Ranks are off by 1.33 % at most with a probability of 99 %; up to about so many runs they are exact.
SKETCH = 200
FIGURES = ("pct_valid", "duration_seconds", "peak_memory_mb")


def run_partials(runs: DataFrame) -> DataFrame:
    """One row for each source and day of some runs. Runs without a time are a day of their own."""
    sums = [F.sum(exact(c)).cast("decimal(38,4)").alias(f"{c}_sum") for c in FIGURES]
    counts = [F.count(c).alias(f"{c}_n") for c in FIGURES]
    return runs.groupBy("source", F.to_date("run_timestamp").alias("day")).agg(
        F.count("run_timestamp").alias("runs"), *sums, *counts,
        F.kll_sketch_agg_double(F.col("duration_seconds").cast("double"), F.lit(SKETCH)).alias("durations"),
    ).select(*RUN_PARTIAL.fieldNames())


def merge_partials(partials: DataFrame, by: tuple[str, ...] = ("source", "day")) -> DataFrame:
    """Rows of the same source and day, or of another grouping, added up."""
    sums = [F.sum(f"{c}_sum").cast("decimal(38,4)").alias(f"{c}_sum") for c in FIGURES]
    counts = [F.sum(f"{c}_n").alias(f"{c}_n") for c in FIGURES]
    return partials.groupBy(*by).agg(
        F.sum("runs").alias("runs"), *sums, *counts, F.kll_merge_agg_double("durations").alias("durations"))


def append_partials(runs: DataFrame, path: str) -> None:
    """Add new runs to stored partials; nothing stored is read or rewritten."""
    run_partials(runs).write.mode("append").parquet(path)


def stored_partials(spark: SparkSession, path: str) -> DataFrame:
    """Stored partials, merged; none before the first runs."""
    try:
        rows = spark.read.schema(RUN_PARTIAL).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        rows = spark.createDataFrame([], RUN_PARTIAL)
    return merge_partials(rows)


def kpi_summary(partials: DataFrame) -> DataFrame:
    """What ``metrics.kpi_summary`` says of the whole history."""
    mean = {c: round_half_even(F.try_divide(F.col(f"{c}_sum").cast("double"), F.col(f"{c}_n")), 2) for c in FIGURES}
    return merge_partials(partials, ("source",)).select("source", "runs", *[m.alias(f"mean_{c}") for c, m in mean.items()])


def duration_alert(runs: DataFrame, partials: DataFrame, quantile: float = 0.95) -> DataFrame:
    """New runs against that quantile of their source's durations on all earlier days: ``slow`` above it, else ``good``.

    ``no_data`` without an earlier day. Quantiles are values that occurred.
    The history enters as one row for each source and day.
    """
    day = F.to_date("run_timestamp")
    new = runs.select("source", "run_timestamp", "duration_seconds", day.alias("day"))
    days = new.select("source", "day").where(F.col("day").isNotNull()).distinct()
    before = (days.alias("new").join(partials.alias("old"), (F.col("new.source") == F.col("old.source")) & (F.col("old.day") < F.col("new.day")))
              .where(F.col("old.duration_seconds_n") > 0).groupBy("new.source", "new.day").agg(F.kll_merge_agg_double("old.durations").alias("durations")))
    limits = before.select("source", "day", F.kll_sketch_get_quantile_double("durations", F.lit(quantile)).alias("usual"))
    return new.join(limits, ["source", "day"], "left").select(
        "source", "run_timestamp", "duration_seconds", "usual",
        F.when(F.col("usual").isNull() | F.col("duration_seconds").isNull(), "no_data").when(F.col("duration_seconds") > F.col("usual"), "slow").otherwise("good").alias("alert"))
