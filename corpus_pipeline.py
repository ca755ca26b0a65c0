"""A training corpus from ``documents``, stage by stage.

Each stage takes what its predecessor kept, and its decision takes effect:
toxic documents go, one document of each group of near-duplicates stays,
documents that leak a benchmark item go, sources are mixed to their targets
(documents repeated or left out), and every row is placed in a shard. All
stages but the last return the columns of ``documents``; the last adds
``slot`` and ``shard``. The operators say what they do with nulls, empty and
repeated rows and empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import toxicity
from claimloom.llm.common import table, written
from claimloom.llm.latent import without_leaks
from claimloom.llm.maglev import place
from claimloom.llm.mixing import mixed
from claimloom.llm.queries import SHARDS
from claimloom.llm.simhash import drop_near_duplicates

#: Words of a shingle, and most differing bits of fingerprints that link.
SHINGLE, BITS = 3, 2


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier, fitted on the labels of these documents, calls toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    rows = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return toxicity.score(rows, model).where("predicted = 0").select("row.*")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, as the registered SimHash query forms them; null texts are empty ones."""
    return drop_near_duplicates(docs, SHINGLE, BITS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that leak a benchmark item; null and empty texts stay, and all documents if there is no item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents left out or repeated so that every source comes near its target; texts without words are in no mix that needs words."""
    return mixed(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with ``slot`` and ``shard`` by their id; columns of those names are replaced."""
    return place(docs, SHARDS)


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources", mixing_stage),
    ("sharding", sharding_stage),
]

#: SQL can express neither the classifier nor the fingerprints; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
