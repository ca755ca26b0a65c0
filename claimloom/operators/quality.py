"""Contract checks. Reports are tables; only ``require_*`` functions raise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.ids import id_rest
from claimloom.operators.joins import skew_join
from claimloom.schema import CANONICAL, CLAIM_RECORD, LABELS, REQUIRED

# Columns the load does not accept null in.
NOT_NULL = ("record_id", "source", "claim_text", "label", "ingested_at")


# Texts of the issues a column can have.
MISSING_COLUMN = "Missing required column: %s"
MISSING_VALUES = "Column '%s' is required but has %d missing value(s)"
UNEXPECTED_LABEL = "Column 'label' has unexpected value: '%s'"


def schema_issues(df: DataFrame) -> DataFrame:
    """Issues as rows (issue, column_name, value, n_rows, message).

    A required column that is missing, its null count, and each label outside
    the domain. Optional columns may be absent. Unexpected labels stay rows: a
    free-text column taken for the label may hold any number of them. All is
    counted per label first, in one pass.
    """
    shape = "issue string, column_name string, value string, n_rows long, message string"
    absent = [("missing_column", c, None, None, MISSING_COLUMN % c) for c in REQUIRED if c not in df.columns]
    present = [c for c in REQUIRED if c in df.columns]
    label = F.col("label") if "label" in df.columns else F.lit(None).cast("string")
    per_label = df.groupBy(label.alias("_label")).agg(
        F.count_if(label.isNotNull() & ~label.isin(*LABELS)).alias("_stray"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in present],
    )

    def entry(issue: str, column: str, value: Column, n: Column) -> Column:
        return F.struct(
            F.lit(issue).alias("issue"), F.lit(column).alias("column_name"), value.alias("value"), n.alias("n_rows")
        )

    nothing = F.lit(None).cast("string")
    entries = [entry("null_values", c, nothing, F.col(c)) for c in present]
    entries.append(entry("unexpected_label", "label", F.when(F.col("_stray") > 0, F.col("_label")), F.col("_stray")))
    found = (
        per_label.select(F.inline(F.array(*entries)))
        .filter("n_rows > 0")
        .groupBy("issue", "column_name", "value")
        .agg(F.sum("n_rows").alias("n_rows"))
    )
    message = F.when(
        F.col("issue") == "null_values", F.format_string(MISSING_VALUES, "column_name", "n_rows")
    ).otherwise(F.format_string(UNEXPECTED_LABEL, "value"))
    issues = df.sparkSession.createDataFrame(absent, shape)
    return issues.unionByName(found.withColumn("message", message))


def require_load_columns(df: DataFrame) -> DataFrame:
    """Raise when a column the load writes is missing; reads the plan's schema only."""
    missing = [c for c in CLAIM_RECORD.fieldNames() if c not in df.columns]
    if missing:
        raise ValueError(f"load: missing canonical column(s) {missing}")
    return df


def broken_rules() -> dict[str, Column]:
    """The rules a row can break by itself: name, and the condition under which it is broken."""
    rules = {f"{c} not null": F.col(c).isNull() for c in NOT_NULL}
    return rules | {"label in domain": ~F.col("label").isin(*LABELS)}


def constraint_violations(
    claims: DataFrame,
    sources: DataFrame,
    publishers: DataFrame,
    spread_by: Sequence[str] = ("record_id",),
) -> DataFrame:
    """Rows the load must refuse, with the names of the rules each one breaks.

    ``sources`` and ``publishers`` are the dimension tables, one row per name.
    A claim without publisher is fine; one naming an unknown publisher is not.
    """
    def known(dim: DataFrame, key: str) -> DataFrame:
        return dim.select(F.col("name").alias(key), F.lit(True).alias(f"_known_{key}"))

    checked = skew_join(claims, known(sources, "source"), "source", spread_by, "left")
    checked = skew_join(checked, known(publishers, "publisher_name"), "publisher_name", spread_by, "left")
    rules = [F.when(is_broken, F.lit(rule)) for rule, is_broken in broken_rules().items()]
    rules += [
        F.when(F.col(c).isNotNull() & F.col(f"_known_{c}").isNull(), F.lit(f"{c} references dimension"))
        for c in ("source", "publisher_name")
    ]
    return (
        checked.withColumn("violations", F.array_compact(F.array(*rules)))
        .filter(F.size("violations") > 0)
        .select(*claims.columns, "violations")
    )


def require_no_violations(claims: DataFrame, sources: DataFrame, publishers: DataFrame, **options) -> None:
    """Raise when a row breaks a load rule, naming one of them."""
    bad = constraint_violations(claims, sources, publishers, **options).select("record_id", "violations").first()
    if bad is not None:
        raise ValueError(f"load refused: record {bad['record_id']} breaks {list(bad['violations'])}")


def id_clashes(claims: DataFrame) -> DataFrame:
    """Ids that stand for two different claims: ``record_id``, how many, and two of them by address or text.

    An id has 64 bits of its claim's digest, which some ten billion claims are
    enough to make meet; the digest's other 96 bits tell them apart. Sums are
    narrow and combined before they are shuffled, whatever an id's rows are.
    """
    rest = id_rest("source", "article_url", "claim_text", "article_text")
    named = F.concat("source", F.lit(":"), F.coalesce(F.nullif("article_url", F.lit("")), "claim_text"))
    told = claims.where(F.col("record_id").isNotNull()).select("record_id", rest.alias("rest"), named.alias("named"))
    bases = told.groupBy("record_id", "rest").agg(F.min("named").alias("named"))
    return (bases.groupBy("record_id")
            .agg(F.count(F.lit(1)).alias("claims"), F.min_by("named", "rest").alias("one"), F.max_by("named", "rest").alias("other"))
            .where("claims > 1"))


def label_distribution(df: DataFrame) -> DataFrame:
    return df.filter(F.col("label").isNotNull()).groupBy("label").agg(F.count("*").alias("n"))


def canonical_roles(df: DataFrame) -> dict[str, str]:
    """Role of each canonical column the frame has."""
    return {f.name: f.metadata["role"] for f in CANONICAL.fields if f.name in df.columns}
