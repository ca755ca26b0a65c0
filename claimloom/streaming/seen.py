"""A store of seen keys that a poll meets in part.

Keys lie in hash buckets, one folder each, as Parquet sorted by key:
``bucket=b/level=l/poll=p``. A poll reads only the folders of the buckets its
own keys fall into, so its cost follows the poll, not the store. It adds one
small file to each of them; when a bucket has ``FAN`` files of one level they
are merged into one of the next, so a key is rewritten once per level, the
number of files a bucket has grows with the logarithm of its polls, and only
buckets that a poll meets are looked at.

The store is a set, so nothing is lost or doubled when a task or the driver
dies: a poll that runs again writes the same folders again, and a merge that
stopped before it removed its inputs leaves keys that stand twice.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.session import remove_folder

#: Buckets of a store; fixed when it is made.
BUCKETS = 1_024
#: Files of one level that a bucket may have before they are merged.
FAN = 8
_FOLDER = re.compile(r"/bucket=(\d+)/level=(\d+)/poll=(-?\d+)/")


class SeenKeys:
    """The keys of ``column`` that polls have brought, stored below ``root``."""

    def __init__(self, spark: SparkSession, root: str, column: str = "guid", buckets: int = BUCKETS, fan: int = FAN):
        self.spark, self.root, self.column, self.buckets, self.fan = spark, root.rstrip("/"), column, buckets, fan
        self.schema = T.StructType([T.StructField(column, T.StringType()), T.StructField("bucket", T.IntegerType()),
                                    T.StructField("level", T.IntegerType()), T.StructField("poll", T.LongType())])

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.column), F.lit(self.buckets)).cast("int")

    def _read(self, buckets: Iterable[int]) -> DataFrame:
        """The rows of some buckets; only their folders are listed."""
        wanted = ",".join(map(str, sorted(buckets)))
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        try:
            return self.spark.read.schema(self.schema).option("basePath", self.root).parquet(f"{self.root}/bucket={{{wanted}}}")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], self.schema)

    def met(self, keys: DataFrame) -> list[int]:
        """The buckets of some keys, at most ``buckets`` numbers; null keys are in none."""
        rows = keys.where(F.col(self.column).isNotNull()).select(self._bucket().alias("bucket")).distinct().collect()
        return sorted(r["bucket"] for r in rows)

    def among(self, keys: DataFrame, before: int | None = None) -> DataFrame:
        """The stored keys of the buckets that ``keys`` meet, those of polls earlier than ``before``: all that an anti join with ``keys`` needs."""
        stored = self._read(self.met(keys))
        return (stored if before is None else stored.where(F.col("poll") < before)).select(self.column)

    def remember(self, keys: DataFrame, poll: int) -> None:
        """Add the keys of a poll, once each; a poll that runs again replaces what it wrote."""
        new = keys.select(self.column).where(F.col(self.column).isNotNull()).distinct().withColumn("bucket", self._bucket())
        self._write(new.withColumns({"level": F.lit(0), "poll": F.lit(poll).cast("long")}))

    def _write(self, rows: DataFrame) -> None:
        spread = rows.repartition("bucket").sortWithinPartitions("bucket", self.column)
        (spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option(f"parquet.bloom.filter.enabled#{self.column}", "true").partitionBy("bucket", "level", "poll").parquet(self.root))

    def files(self, buckets: Iterable[int]) -> dict[tuple[int, int], set[int]]:
        """Of each bucket and level its polls."""
        found = defaultdict(set)
        for file in self._read(buckets).inputFiles():
            bucket, level, poll = map(int, _FOLDER.search(file).groups())
            found[bucket, level].add(poll)
        return found

    def tidy(self, buckets: Iterable[int], before: int) -> None:
        """Merge the files of polls earlier than ``before`` where one of the given buckets has ``fan`` of a level or more."""
        while full := {at: max(polls) for at, kept in self.files(buckets).items() if len(polls := {p for p in kept if p < before}) >= self.fan}:
            at = self.spark.createDataFrame([(b, level, last) for (b, level), last in full.items()], "bucket int, level int, last long")
            rows = self._read({b for b, _ in full}).join(F.broadcast(at), ["bucket", "level"]).where("poll <= last")  # a row for each full level
            self._write(rows.groupBy(self.column, "bucket", (F.col("level") + 1).alias("level")).agg(F.max("last").alias("poll")))
            for (bucket, level), polls in self.files({b for b, _ in full}).items():
                for poll in polls:
                    if poll <= full.get((bucket, level), -2):
                        remove_folder(self.spark, f"{self.root}/bucket={bucket}/level={level}/poll={poll}")
