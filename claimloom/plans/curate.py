"""Raw collections -> one canonical dataset, and the recorded run around it."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from functools import reduce
from typing import TypeVar

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from claimloom.operators.adapters import DATASET, ORDER, adapt
from claimloom.operators.cleaning import DropTally, clean_keys, clean_payload, drop_blank_claims, survivors
from claimloom.operators.enrich import enrich_claims, run_stamp
from claimloom.operators.metrics import merge_phase_metrics
from claimloom.plans.load import commit_load, stage_load
from claimloom.schema import CANONICAL, PHASE_SNAPSHOT, project
from claimloom.sources.sinks import append_run_record, export_dataset, write_dataset, write_reports

Result = TypeVar("Result")


def adapt_all(raw: Mapping[str, DataFrame], blank_claims: bool = True, tally: DropTally | None = None) -> DataFrame:
    """All collections, {adapter name: raw rows}, in canonical columns with cleaned keys.

    Raw rows that bring a ``dataset`` column keep it: several files of one kind
    are read as one. Rows without claim text are left out on request. Keys are cleaned per collection, since ratings are mapped only where the
    collection brings no label column.
    """
    def adapted(name: str, df: DataFrame) -> DataFrame:
        rows = adapt(df if DATASET in df.columns else df.withColumn(DATASET, F.lit(name)), name)
        return tally.at_raw(rows) if tally else rows

    def keyed(rows: DataFrame) -> DataFrame:
        return clean_keys(rows if blank_claims else drop_blank_claims(rows))

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [keyed(adapted(name, df)) for name, df in raw.items()])


def curate_claims(
    raw: Mapping[str, DataFrame],
    ingested_at: str | None = None,
    pivot_year: int | None = None,
    keep_order: bool = False,
    fan_in: int = 0,
    tally: DropTally | None = None,
) -> DataFrame:
    """Curate collections, given as {adapter name: raw rows with ``input_order``}.

    One plan and one shuffle for all of them: copies are looked for inside a
    collection, so the shuffle is keyed by collection and key. Texts, dates and
    images are cleaned after it, on the surviving rows. ``keep_order`` adds the
    bookkeeping columns a load needs; ``fan_in`` is the one of ``keep_first``;
    ``tally`` counts the drops of one collection.
    """
    if tally and len(raw) != 1:
        raise ValueError("a tally counts one collection")
    first = survivors(adapt_all(raw, blank_claims=False, tally=tally), fan_in=fan_in, tally=tally)
    curated = enrich_claims(clean_payload(first, pivot_year), ingested_at)
    return curated.select(*CANONICAL.fieldNames(), DATASET, ORDER) if keep_order else project(curated)


def clocked(action: Callable[[], Result]) -> tuple[Result, float]:
    """An action's result and its wall-clock seconds."""
    begun = time.perf_counter()
    result = action()
    return result, round(time.perf_counter() - begun, 4)


def phase_snapshot(
    spark: SparkSession, source: str, stamp: str, phase_no: int, seconds: Mapping[str, float], counts: Mapping[str, int]
) -> DataFrame:
    """A phase as a row for ``merge_phase_metrics``: what its actions took, and what they counted.

    Spark plans reading, adapting, cleaning and enriching as one action, so
    they are one step, "clean".
    """
    row = (source, stamp, phase_no, round(sum(seconds.values()), 4), dict(seconds), dict(counts), None)
    return spark.createDataFrame([row], PHASE_SNAPSHOT)


def run_curation(
    source: str,
    raw: DataFrame,
    output_path: str,
    metrics_path: str | None = None,
    input_path: str = "",
    ingested_at: str | None = None,
    fmt: str = "parquet",
    fan_in: int = 0,
    extract: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Curate one collection, write dataset, manifest and issues, and record the run; the raw rows are read once.

    Returns the written dataset and the run's phases, those of ``extract``
    (rows as ``phase_snapshot`` gives them) included. Without ``metrics_path``
    nothing is recorded: the caller merges the phases with others.
    """
    stamp, tally = ingested_at or run_stamp(), DropTally()
    claims = curate_claims({source: raw}, stamp, fan_in=fan_in, tally=tally)
    written, cleaning = clocked(lambda: write_dataset(claims, output_path, fmt))
    _, reporting = clocked(lambda: write_reports(written, output_path, source, input_path, stamp))
    own = phase_snapshot(raw.sparkSession, source, stamp, 2, {"clean": cleaning, "export": reporting}, tally.counts())
    phases = extract.unionByName(own) if extract is not None else own
    if metrics_path:
        append_run_record(merge_phase_metrics(phases), metrics_path)
    return written, phases


def run_source(
    source: str,
    raw: DataFrame,
    output_path: str,
    root: str,
    metrics_path: str,
    input_path: str = "",
    ingested_at: str | None = None,
    fmt: str = "parquet",
    fan_in: int = 0,
    extract: DataFrame | None = None,
) -> Row:
    """Curate one collection, export it, load it into the star at ``root``, record one run for all phases.

    The curated rows are written once, as the load's own delta; the export
    reads them there, and the load then commits them.
    """
    spark, stamp, tally = raw.sparkSession, ingested_at or run_stamp(), DropTally()
    claims = curate_claims({source: raw}, stamp, keep_order=True, fan_in=fan_in, tally=tally)
    staged, cleaning = clocked(lambda: stage_load(spark, root, claims, stamp))
    _, exporting = clocked(lambda: export_dataset(project(staged.rows()), output_path, source, input_path, fmt, stamp))
    transform = phase_snapshot(spark, source, stamp, 2, {"clean": cleaning, "export": exporting}, tally.counts())
    summary, loading = clocked(lambda: commit_load(staged))
    load = phase_snapshot(spark, source, stamp, 3, {"load": loading}, {"rows_loaded": summary["claim_records"]})
    phases = [p for p in (extract, transform, load) if p is not None]
    append_run_record(merge_phase_metrics(reduce(DataFrame.unionByName, phases)), metrics_path)
    return summary
