"""Records cut out of large text files by as many tasks as the files have blocks.

Spark reads text in blocks of ``spark.sql.files.maxPartitionBytes``. A block
may begin anywhere: inside a quoted field, whose line breaks end no record.
Which it is depends on every quote before it, so the two are told apart by
composition:

1. Each block is read on its own and its lines are marked for both cases. A
   line's quotes flip the state if their number is odd (a doubled quote flips
   it twice), so a block comes down to three numbers: whether it flips the
   state, and how many records begin in it in either case.
2. The blocks of a file are put in order and their numbers summed up: that
   gives the state and the record number at the head of every block.
3. The blocks are read again; every line now knows its record. Lines that are
   whole records stay in their task. Only lines of records with line breaks
   are shuffled, by record.

What goes to every task is one narrow row for each block, as many as the scan
has splits. Nothing else meets anywhere, and no file is read by one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Where a line or item lies: file and block.
FILE, BLOCK = "_file", "_block"


_RUNNING = T.StructType([T.StructField("before", T.IntegerType()), T.StructField("outside", T.LongType()), T.StructField("inside", T.LongType())])


@F.pandas_udf(_RUNNING)
def _running(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Of lines in the order of their blocks: the state before a line if its block begins outside quotes, and the records that
    begin in the block up to the line if it begins outside or inside. Only a key and two flags of a line come here, not its text."""
    now, odd_before, outside, inside = None, 0, 0, 0
    for blocks, odd, blank in batches:
        keys, flips, begins = blocks.to_numpy(), odd.to_numpy(dtype=np.int64), ~blank.to_numpy(dtype=bool)
        before, seen = np.empty(len(keys), np.int32), np.empty((len(keys), 2), np.int64)
        heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else []
        for start, end in zip(heads, [*heads[1:], len(keys)], strict=True):
            if keys[start] != now:
                now, odd_before, outside, inside = keys[start], 0, 0, 0
            sums = np.cumsum(flips[start:end]) + odd_before
            state = (sums - flips[start:end]) % 2
            before[start:end] = state
            seen[start:end, 0] = outside + np.cumsum((state == 0) & begins[start:end])
            seen[start:end, 1] = inside + np.cumsum((state == 1) & begins[start:end])
            odd_before, outside, inside = int(sums[-1] % 2), *map(int, seen[end - 1])
        yield pd.DataFrame({"before": before, "outside": seen[:, 0], "inside": seen[:, 1]})


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their block, whether their quotes flip the state, and whether they are blank."""
    lines = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"')))
    blank = F.col("value").isin("", "\r")
    told = lines.select(
        "value", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK), (quotes % 2).cast("int").alias("odd"), blank.alias("blank"))
    told = told.withColumn("file_key", F.xxhash64(FILE))
    # What it gives a line depends on the lines before: no filter may come first.
    return told.withColumn("at", _running.asNondeterministic()(F.xxhash64("file_key", BLOCK), F.col("odd"), F.col("blank")))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``_file, record, line``: the records of quoted CSV files, numbered from 1 in each file, blank lines left out.

    Fields in double quotes may hold line breaks and doubled quotes; records end
    with a line feed, with or without a carriage return. A record keeps the
    breaks inside it as they are and has none at its end. A quote inside an
    unquoted field is no quote to CSV writers, and flips the state here: what
    follows then has other numbers of fields, which a strict parser refuses.
    """
    lines = _lines(spark, path)
    blocks = lines.groupBy("file_key", BLOCK).agg(
        F.bit_xor("odd").alias("flips"),
        F.count_if((F.col("at.before") == 0) & ~F.col("blank")).alias("outside"),
        F.count_if((F.col("at.before") == 1) & ~F.col("blank")).alias("inside"))
    earlier = Window.partitionBy("file_key").orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    heads = blocks.withColumn("state", F.coalesce(F.sum("flips").over(earlier), F.lit(0)) % 2)
    heads = heads.withColumn("begun", F.when(F.col("state") == 0, F.col("outside")).otherwise(F.col("inside")))
    heads = heads.select("file_key", BLOCK, "state", F.coalesce(F.sum("begun").over(earlier), F.lit(0)).alias("base"))
    # One row for each split of the scan.
    placed = lines.join(F.broadcast(heads), ["file_key", BLOCK]).select(
        FILE, BLOCK, "value", "odd", "blank", "file_key",
        (F.col("at.before") != F.col("state")).alias("quoted"),
        (F.col("base") + F.when(F.col("state") == 0, F.col("at.outside")).otherwise(F.col("at.inside"))).alias("record"),
        F.monotonically_increasing_id().alias("line_no"))
    whole = ~F.col("quoted") & (F.col("odd") == 0)
    single = placed.where(whole & ~F.col("blank")).select(FILE, "record", F.col("value").alias("line"))
    parts = F.array_sort(F.collect_list(F.struct(BLOCK, "line_no", "value")))
    broken = (placed.where(~whole).groupBy(FILE, "record").agg(parts.alias("parts"))
              .select(FILE, "record", F.array_join(F.col("parts.value"), "\n").alias("line")))
    return single.unionByName(broken).withColumn("line", F.regexp_replace("line", "\r\\z", ""))


def feed_items(spark: SparkSession, path: str, tag: str = "item") -> DataFrame:
    """``_file, _block, _item, xml``: the elements of a tag in XML files, which don't nest, in the order of those three columns.

    Spark cuts the files after each closing tag, wherever a block begins. An
    element that the end of its file cuts off is closed there, and is malformed
    for its reader. Character data that holds a closing tag would be cut, so an
    element with an unclosed CDATA section fails the job. Elements written as
    one empty tag are left out.
    """
    pieces = spark.read.option("lineSep", f"</{tag}>").text(path).select(
        F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias("_item"), F.regexp_extract("value", rf"(?s)<{tag}(?:\s[^>]*)?>.*\z", 0).alias("xml"))
    opened = _count("xml", "<![CDATA[") > _count("xml", "]]>")
    checked = F.when(opened, F.raise_error(F.concat(F.lit("an element is cut inside a CDATA section in "), F.col(FILE))).cast("string")).otherwise(F.col("xml"))
    return pieces.where("xml <> ''").select(FILE, BLOCK, "_item", F.concat(checked, F.lit(f"</{tag}>")).alias("xml"))


def _count(col: str, what: str) -> Column:
    return (F.length(col) - F.length(F.replace(F.col(col), F.lit(what)))) / len(what)
