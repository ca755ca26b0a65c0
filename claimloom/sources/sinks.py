"""Writers: curated dataset with its manifest, and the run history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.operators.enrich import run_stamp
from claimloom.operators.quality import MISSING_COLUMN, MISSING_VALUES, UNEXPECTED_LABEL, schema_issues
from claimloom.schema import LABELS, REQUIRED, RUN_RECORD

CSV_WRITE = {
    "header": True, "quoteAll": True, "escape": '"', "emptyValue": "",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def run_manifest(
    df: DataFrame, source: str, input_path: str, output_path: str, generated_at: str | None = None
) -> DataFrame:
    """One row that describes a dataset: where from, where to, size, labels, issues.

    ``label_distribution`` counts every label that occurs and ``schema_issues``
    names every unexpected one, as ``schema_issues`` the operator does row by
    row. Rows are counted per label first, so one row for each label meets.
    """
    label = F.col("label") if "label" in df.columns else F.lit(None).cast("string")
    present = [c for c in REQUIRED if c in df.columns]
    per_label = df.groupBy(label.alias("_label")).agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_no_{c}") for c in present])
    found = [F.lit(MISSING_COLUMN % c) for c in REQUIRED if c not in df.columns]
    found += [
        F.when(F.sum(f"_no_{c}") > 0, F.format_string(MISSING_VALUES, F.lit(c), F.sum(f"_no_{c}"))) for c in present
    ]
    named = F.col("_label").isNotNull()
    strays = F.collect_list(F.when(named & ~F.col("_label").isin(*LABELS), F.format_string(UNEXPECTED_LABEL, "_label")))
    return per_label.agg(
        F.lit(source).alias("source"),
        F.lit(input_path).alias("input_path"),
        F.lit(output_path).alias("output_path"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("row_count"),
        F.lit(generated_at or run_stamp()).alias("generated_at"),
        F.map_from_entries(F.sort_array(F.collect_list(F.when(named, F.struct(F.col("_label").alias("label"), F.col("_n").alias("n")))))).alias("label_distribution"),
        F.concat(F.array_compact(F.array(*found)), F.sort_array(strays)).alias("schema_issues"),
    )


def write_dataset(df: DataFrame, output_path: str, fmt: str = "parquet") -> DataFrame:
    """Write a dataset and return it as written, so the plan behind ``df`` runs once."""
    spark = df.sparkSession
    writer = df.write.mode("overwrite")
    if fmt == "parquet":
        writer.parquet(output_path)
        return spark.read.schema(df.schema).parquet(output_path)
    if fmt == "csv":
        writer.options(**CSV_WRITE).csv(output_path)
        reader = spark.read.options(header=True, multiLine=True, quote='"', escape='"')
        return reader.schema(df.schema).csv(output_path)
    raise ValueError(f"unknown format {fmt!r}; available: csv, parquet")


def write_reports(written: DataFrame, output_path: str, source: str, input_path: str, generated_at: str | None = None) -> None:
    """The manifest (``<output>.manifest``) and issues (``<output>.issues``) of a written dataset."""
    manifest = run_manifest(written, source, input_path, output_path, generated_at)
    manifest.coalesce(1).write.mode("overwrite").json(f"{output_path}.manifest")
    schema_issues(written).write.mode("overwrite").json(f"{output_path}.issues")


def export_dataset(
    df: DataFrame,
    output_path: str,
    source: str,
    input_path: str,
    fmt: str = "parquet",
    generated_at: str | None = None,
) -> DataFrame:
    """Write a dataset, its manifest and its issues, which never stop the export; returns the written dataset."""
    written = write_dataset(df, output_path, fmt)
    write_reports(written, output_path, source, input_path, generated_at)
    return written


def append_run_record(records: DataFrame, path: str) -> None:
    """Append run records as JSON lines; nothing already there is rewritten."""
    records.select(*RUN_RECORD.fieldNames()).write.mode("append").json(path)
