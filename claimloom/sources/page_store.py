"""Stored pages kept in buckets by address, so that a join on the address moves no page.

The pages are shuffled once, when they are stored. Each bucket is one file per
write, and Spark knows from the table's bucketing that equal addresses lie in
equal buckets: a batch of claims is brought to the pages, not the pages to it.
The folder describes itself; a session registers it in its own catalog, so no
metastore is needed.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SPEC = "buckets int, key string, columns string"


def _name(path: str) -> str:
    return f"claimloom_pages_{hashlib.sha256(path.encode()).hexdigest()[:16]}"


def _spec(path: str) -> str:
    return f"{path.rstrip('/')}.spec"


def _described(spark: SparkSession, path: str) -> Row:
    return spark.read.schema(SPEC).json(_spec(path)).first()


def store_pages(pages: DataFrame, path: str, buckets: int | None = None, key: str = "url") -> None:
    """Write pages below ``path`` in buckets, a new store; rows without address are stored too.

    There are as many buckets as the session's shuffles have partitions, unless
    told otherwise. With fewer than a later session's Spark moves the pages
    after all; with many more a batch of claims makes many small tasks.
    """
    spark = pages.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    # The bucket of a row is the task it is sent to, so every task writes one file.
    placed = pages.repartition(buckets, key)
    placed.write.bucketBy(buckets, key).sortBy(key).format("parquet").option("path", path).mode("errorifexists").saveAsTable(_name(path))
    spark.createDataFrame([(buckets, key, pages.schema.json())], SPEC).coalesce(1).write.json(_spec(path))


def stored_pages(spark: SparkSession, path: str) -> DataFrame:
    """The pages stored below ``path``, by whatever session, with what Spark has to know of their buckets."""
    spec = _described(spark, path)
    if not spark.catalog.tableExists(_name(path)):
        columns = StructType.fromJson(json.loads(spec["columns"]))
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
        spark.sql(f"CREATE TABLE {_name(path)} ({ddl}) USING parquet CLUSTERED BY (`{spec['key']}`) SORTED BY (`{spec['key']}`) "
                  f"INTO {spec['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(_name(path))


def add_pages(pages: DataFrame, path: str) -> None:
    """Add pages to a store; each bucket that gets some has one more file."""
    spark = pages.sparkSession
    known = stored_pages(spark, path)
    spec = _described(spark, path)
    placed = pages.select(*[F.col(f"`{c}`") for c in known.columns]).repartition(spec["buckets"], spec["key"])
    placed.write.bucketBy(spec["buckets"], spec["key"]).sortBy(spec["key"]).format("parquet").option("path", path).mode("append").saveAsTable(_name(path))
