"""Star tables kept as append-only deltas in shared storage.

A load writes its rows once, as a delta folder of its own, checks them there,
adds the dimension rows that are new, and commits with one small folder of its
own. What it writes depends on the batch, never on the store. Folder names are
unique, so loads may run at the same time: none touches what another writes,
and all of them arrive. A load that dies leaves folders that no commit names,
which readers never see.

Readers take the newest row for each ``record_id``, by the version and name of
the load that brought it. ``FAN`` runs of one level are merged into one of the
next, so a row is rewritten once per level and readers meet few runs; loads
that finish meanwhile stay runs of their own. ``compact`` merges everything.
``vacuum`` removes folders that no longer count, old loads that died among
them. The log of commits (``log``) is read from a bounded number of files.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.operators.adapters import input_position
from claimloom.operators.dedup import keep_first, keep_last
from claimloom.operators.enrich import run_stamp
from claimloom.operators.quality import broken_rules, id_clashes, require_load_columns
from claimloom.operators.upsert import new_publishers, new_sources, sink_values
from claimloom.plans import log
from claimloom.schema import CLAIM_RECORD, PUBLISHER_DIM, SOURCE_DIM
from claimloom.session import folders, remove_folder

TABLES = {"claim_record": CLAIM_RECORD, "source": SOURCE_DIM, "publisher": PUBLISHER_DIM}
#: Runs of one level that are merged.
FAN = 8
#: The load that brought a row, as merged runs hold it.
BROUGHT = [T.StructField("row_version", T.LongType()), T.StructField("row_load", T.StringType())]


def last_commit(spark: SparkSession, root: str) -> Row | None:
    return log.read_log(spark, root).last


def _path(root: str, table: str, load: str) -> str:
    return f"{root}/{table}/load={load}"


def _stored(spark: SparkSession, root: str, table: str, runs: Sequence[Row]) -> DataFrame:
    """Rows of a table in the given runs, each with the version and name of the load that brought it."""
    columns = TABLES[table].fields
    if not runs:
        return spark.createDataFrame([], T.StructType([*columns, T.StructField("version", T.LongType()), T.StructField("load", T.StringType())]))
    paths = [_path(root, table, r["load"]) for r in runs]
    found = T.StructType([*columns, *BROUGHT, T.StructField("load", T.StringType())])
    rows = spark.read.schema(found).option("basePath", f"{root}/{table}").parquet(*paths)
    versions = spark.createDataFrame([(r["load"], r["version"]) for r in runs], "load string, run_version long")
    # As many rows as runs count: FAN for each level, and loads that are not merged yet.
    return rows.join(F.broadcast(versions), "load").select(
        *TABLES[table].fieldNames(), F.coalesce("row_version", "run_version").alias("version"), F.coalesce("row_load", "load").alias("load"))


def _newest_claims(spark: SparkSession, root: str, runs: Sequence[Row]) -> DataFrame:
    """The newest row for each id, with its load. A run holds each id once, and of the oldest run only ids of others are taken out."""
    if len(runs) < 2:
        return _stored(spark, root, "claim_record", runs)
    base, others = runs[0], runs[1:]
    rows = _stored(spark, root, "claim_record", others)
    if base["version"] >= min(r["low"] for r in others):  # merged while others arrived
        return keep_last(_stored(spark, root, "claim_record", runs), ["record_id"], ["version", "load"])
    newest = keep_last(rows, ["record_id"], ["version", "load"]) if len(others) > 1 else rows
    ids = rows.select("record_id").distinct()
    return _stored(spark, root, "claim_record", [base]).join(ids, "record_id", "left_anti").unionByName(newest)


def read_star(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The stored tables: source, publisher, claim_record; empty before the first load."""
    rows = _read_runs(spark, root, log.read_log(spark, root).live)
    return {name: rows[name].select(*TABLES[name].fieldNames()) for name in TABLES}


def _read_runs(spark: SparkSession, root: str, runs: Sequence[Row]) -> dict[str, DataFrame]:
    """The rows of some runs that count among them, with the loads that brought them."""
    tables = {"claim_record": _newest_claims(spark, root, runs)}
    for name in ("source", "publisher"):
        # Loads at the same time may each add a name; the first one counts.
        tables[name] = keep_first(_stored(spark, root, name, runs), ["name"], ["version", "load"])
    return tables


@dataclass
class StagedLoad:
    """A batch written as a delta and not committed yet."""

    spark: SparkSession
    root: str
    load: str
    loaded_at: str
    order: tuple[str, ...]

    def rows(self) -> DataFrame:
        """The stored columns, the publisher's site and the columns that order the batch."""
        return self.spark.read.parquet(_path(self.root, "claim_record", self.load))


def stage_load(
    spark: SparkSession, root: str, batch: DataFrame, loaded_at: str | None = None, order: Sequence[str] | None = None
) -> StagedLoad:
    """Write curated rows as a delta; the plan behind ``batch`` runs once.

    Of rows that repeat an id the last one counts, in ``order``: by default the
    bookkeeping columns the batch carries.
    """
    require_load_columns(batch)
    staged = StagedLoad(spark, root, uuid.uuid4().hex, loaded_at or run_stamp(), tuple(order or input_position(batch)))
    beside = [c for c in dict.fromkeys(("publisher_site", *staged.order)) if c in batch.columns]
    last = sink_values(keep_last(batch, ["record_id"], staged.order), beside=beside)
    last.hint("rebalance").write.parquet(_path(root, "claim_record", staged.load))
    return staged


def _names(staged: StagedLoad) -> DataFrame:
    """One row for each source and publisher of a delta: rows, broken rules, the first site in order."""
    rows = staged.rows()
    site = F.col("publisher_site") if "publisher_site" in rows.columns else F.lit(None).cast("string")
    at = F.struct(*staged.order)
    broken = broken_rules()
    path = _path(staged.root, "_names", staged.load)
    rows.groupBy("source", "publisher_name").agg(
        F.count("*").alias("n"),
        F.min_by(F.struct(site.alias("site")), at)["site"].alias("publisher_site"),
        F.min(at).alias("at"),
        *[F.count_if(is_broken).alias(rule) for rule, is_broken in broken.items()],
        F.min(F.when(F.greatest(*[F.coalesce(b, F.lit(False)) for b in broken.values()]), F.col("record_id"))).alias("example"),
    ).write.parquet(path)
    return staged.spark.read.parquet(path)


def _refuse_broken(names: DataFrame) -> None:
    """Raise when a row breaks a rule, naming the rules and a record."""
    rules = list(broken_rules())
    found = names.agg(F.min("example").alias("example"), *[F.sum(F.col(f"`{rule}`")).alias(rule) for rule in rules]).first()
    if any(found[rule] for rule in rules):
        raise ValueError(f"load refused: {({rule: found[rule] for rule in rules if found[rule]})} row(s), record {found['example']} among them")


def commit_load(staged: StagedLoad, stream: str | None = None, batch: int | None = None, fan: int = FAN) -> Row:
    """Check a staged load, add its new dimension rows and commit it; returns the batch's summary.

    With the name of a stream and the number of a batch the commit says that
    this batch is in. Levels that are full then are merged (``fan`` 0: never);
    a merge that finds two claims under one id raises, after the commit.

    A broken rule (null in a required column, label outside the domain)
    refuses the whole load. Its dimension rows come from the batch itself, so
    no name can be unknown.
    """
    spark, root = staged.spark, staged.root
    names = _names(staged)
    _refuse_broken(names)
    stored = read_star(spark, root)
    new_sources(stored["source"], names, staged.loaded_at).write.parquet(_path(root, "source", staged.load))
    new_publishers(stored["publisher"], names, ["at"]).write.parquet(_path(root, "publisher", staged.load))
    summary = names.agg(
        F.count_distinct("source").alias("sources"),
        F.count_distinct("publisher_name").alias("publishers"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("claim_records"),
    ).first()
    log.commit(spark, root, staged.load, staged.loaded_at, stream=stream, batch=batch)
    if fan:
        merge_levels(spark, root, fan)
    return summary


def load_star(
    spark: SparkSession, root: str, batch: DataFrame, order: Sequence[str] | None = None, loaded_at: str | None = None, fan: int = FAN
) -> Row:
    """Upsert curated rows into the star tables, in one pass over the plan behind ``batch``; returns the batch's summary."""
    return commit_load(stage_load(spark, root, batch, loaded_at, order), fan=fan)


def load_batch(spark: SparkSession, root: str, batch: DataFrame, stream: str, number: int, loaded_at: str | None = None, fan: int = FAN) -> Row | None:
    """``load_star`` of a numbered batch of a stream, once: a batch that is in already, or an earlier one, writes nothing."""
    if log.read_log(spark, root).batches.get(stream, -1) >= number:
        return None
    return commit_load(stage_load(spark, root, batch, loaded_at), stream, number, fan)


def _refuse_clashes(clashes: DataFrame) -> None:
    """Raise when two claims share an id, naming both, before the newer one takes the other's place for good."""
    found = clashes.first()
    if found is not None:
        raise ValueError(f"merge refused: record {found['record_id']} is both {found['one']!r} and {found['other']!r}")


def _merge(spark: SparkSession, root: str, runs: Sequence[Row], level: int, at: str) -> None:
    """Write the rows of some runs that count among them as one run, and let it take their place."""
    load = uuid.uuid4().hex
    _refuse_clashes(id_clashes(_stored(spark, root, "claim_record", runs)))
    for name, rows in _read_runs(spark, root, runs).items():
        brought = rows.withColumnsRenamed({"version": "row_version", "load": "row_load"})
        brought.hint("rebalance").write.parquet(_path(root, name, load))
    low = min(r["low"] for r in runs)
    log.commit(spark, root, load, at, level, low, [r["load"] for r in runs])


def merge_levels(spark: SparkSession, root: str, fan: int = FAN, merged_at: str | None = None) -> int:
    """Merge the runs of every level that has ``fan`` of them; returns how many merges that took."""
    merges = 0
    while True:
        levels: dict[int, list[Row]] = {}
        for run in log.read_log(spark, root).live:
            levels.setdefault(run["level"], []).append(run)
        full = [level for level, runs in sorted(levels.items()) if len(runs) >= fan]
        if not full:
            return merges
        _merge(spark, root, levels[full[0]], full[0] + 1, merged_at or run_stamp())
        merges += 1


def compact(spark: SparkSession, root: str, compacted_at: str | None = None) -> None:
    """Merge all runs into one; what is stored stays as it was. Old folders are left for readers that still use them."""
    runs = log.read_log(spark, root).live
    if len(runs) > 1:
        _merge(spark, root, runs, max(r["level"] for r in runs) + 1, compacted_at or run_stamp())


def vacuum(spark: SparkSession, root: str, older_than: float = 7 * 86_400) -> list[str]:
    """Remove what no longer counts and was last changed over ``older_than`` seconds ago; returns the folders removed.

    That is runs that were merged, loads that never committed, and epochs of
    the log before the last two. Leave time enough for loads under way and for
    readers that still use a replaced run.
    """
    state, before = log.read_log(spark, root), time.time() - older_than
    counted, gone = {f"load={r['load']}" for r in state.live}, []
    for table in (*TABLES, "_names"):
        gone += [f"{table}/{name}" for name, at in folders(spark, f"{root}/{table}").items() if name not in counted and at <= before]
    gone += [f"_commits/{name}" for name, at in folders(spark, f"{root}/_commits").items()
             if name.startswith("epoch=") and int(name.removeprefix("epoch=")) < state.epoch - 1 and at <= before]
    for folder in gone:
        remove_folder(spark, f"{root}/{folder}")
    return gone
