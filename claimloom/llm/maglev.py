"""Sharding by a permutation-filled lookup table.

Every shard walks the slots of a prime-sized table in its own order (a start
and a step from the MD5 of its name). The shards take turns; at each turn a
shard claims the first slot of its order that is still free. All shards end
with as many slots as another, give or take one, and when a shard joins or
leaves few slots change hands. A key hashes to a slot; the table is broadcast,
so placement is one lookup for each row and no shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import hash60

#: Slots for each shard, at least: shares then differ by under one hundredth.
SLOTS_PER_SHARD = 100
#: Bound of the broadcast table.
MAX_SLOTS = 2_000_000


def _digits(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def table_size(shards: int) -> int:
    """The smallest prime with ``SLOTS_PER_SHARD`` slots for each shard."""
    n = max(3, shards * SLOTS_PER_SHARD)
    while any(n % k == 0 for k in range(2, int(n ** 0.5) + 1)):
        n += 1
    return n


def lookup_table(shards: Sequence[str], size: int | None = None) -> list[int]:
    """For each slot the index of its shard."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards need distinct names, one at least")
    size = size or table_size(len(shards))
    if not len(shards) <= size <= MAX_SLOTS:
        raise ValueError(f"{size} slots for {len(shards)} shards; at most {MAX_SLOTS} can be broadcast")
    at = [_digits(f"{name}:start") % size for name in shards]
    step = [_digits(f"{name}:step") % (size - 1) + 1 for name in shards]
    slots, free = [-1] * size, size
    while free:
        for shard in range(len(shards)):
            while slots[at[shard]] >= 0:
                at[shard] = (at[shard] + step[shard]) % size
            slots[at[shard]] = shard
            free -= 1
            if not free:
                break
    return slots


def shard_names(shards: int) -> list[str]:
    return [f"shard-{k}" for k in range(shards)]


def place(df: DataFrame, shards: int | Sequence[str], key: str = "doc_id") -> DataFrame:
    """``df`` with ``slot`` (int) and ``shard`` (int, the index of the shard).

    Rows with equal keys share a shard; a null key is placed as the empty
    text. Columns of ``df`` named ``slot`` or ``shard`` are replaced. An empty
    table stays empty with the two columns added.
    """
    slots = lookup_table(shard_names(shards) if isinstance(shards, int) else list(shards))
    looked_up = df.sparkSession.range(1).select(
        F.posexplode(F.split(F.lit(",".join(map(str, slots))), ",")).alias("slot", "shard")
    ).select("slot", F.col("shard").cast("int").alias("shard"))
    keyed = df.drop("slot", "shard").withColumn("slot", (hash60(F.col(key)) % len(slots)).cast("int"))
    placed = keyed.join(F.broadcast(looked_up), "slot", "left")
    return placed.select(*[c for c in keyed.columns if c != "slot"], "slot", "shard")


def write_shards(df: DataFrame, path: str, shards: int, files_per_shard: int = 1, key: str = "doc_id") -> None:
    """Write each shard as its own folder ``shard=k`` of ``files_per_shard`` files, dealt by content, so none depends on one task."""
    part = F.pmod(F.xxhash64(key, F.monotonically_increasing_id()), F.lit(files_per_shard))
    placed = place(df, shards, key).withColumn("_part", part)
    placed.repartition(shards * files_per_shard, "shard", "_part").drop("_part").write.partitionBy("shard").parquet(path)
