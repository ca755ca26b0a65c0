"""A bounded sample of labelled rows for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import hash60, held_out, text_or_empty, written

#: Most labelled documents that a classifier is fitted on.
SAMPLE_ROWS = 20_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(doc_id, text, label)`` of at most ``rows`` labelled documents that may be learned from, chosen by a hash of the id.

    An id counts once: with its largest label and its smallest text. Null ids,
    null labels and ids without a document are left out; a null text is empty.
    The ids are chosen first, so the texts of no more than ``rows`` ids move.
    """
    ids = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
           .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
           .orderBy(hash60(F.concat(F.lit("sample"), F.col("doc_id").cast("string"))), "doc_id").limit(rows))
    chosen = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(ids), "doc_id")
    return written(chosen.groupBy("doc_id", "label").agg(F.min("text").alias("text")), "labelled")
