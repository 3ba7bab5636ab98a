"""Placement of documents on shards through a permutation-filled lookup table.

Each shard orders all slots of a table of prime size by its own permutation
``(offset + k * skip) mod size``.  The shards take turns; at its turn a shard claims the first slot
of its order that is still free, until no slot is.  A document hashes to a slot and goes to the slot's
owner.  Shards own equally many slots (one more or less), and when a shard joins or leaves, nearly
all slots that are not its own stay where they were.

The table depends on the shard names and the size only, never on data, so its size is a proven
bound for the broadcast; documents are placed by one hash and one broadcast lookup, without a shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Prime, and at least a hundred slots a shard up to 655 shards.
TABLE_SIZE = 65_537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def slot_owners(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """Index of the owning shard for each slot."""
    if not _is_prime(size):
        raise ValueError("the table size must be prime, so that every skip visits every slot")
    if not shards or len(set(shards)) != len(shards) or len(shards) > size:
        raise ValueError("shards must be distinct names, at least one and at most the table size")
    digests = [hashlib.md5(name.encode()).hexdigest() for name in shards]
    nexts = [int(d[:16], 16) % size for d in digests]
    skips = [int(d[16:], 16) % (size - 1) + 1 for d in digests]
    owners = [-1] * size
    free = size
    while free:
        for shard, skip in enumerate(skips):
            slot = nexts[shard]
            while owners[slot] >= 0:
                slot = (slot + skip) % size
            owners[slot] = shard
            nexts[shard] = (slot + skip) % size
            free -= 1
            if not free:
                break
    return owners


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """Slot of a key: 60 bits of its MD5 as a number, modulo the table size; null is the empty key."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % F.lit(size)).cast("int")


def lookup_table(spark: SparkSession, shards: Sequence[str], size: int = TABLE_SIZE) -> DataFrame:
    rows = [(slot, owner, shards[owner]) for slot, owner in enumerate(slot_owners(shards, size))]
    return spark.createDataFrame(rows, "slot INT, shard INT, shard_name STRING")


def assign_shards(
    docs: DataFrame, shards: Sequence[str], size: int = TABLE_SIZE, key: str = "doc_id"
) -> DataFrame:
    """``docs`` with ``slot``, ``shard`` and ``shard_name``.

    Columns of these names that ``docs`` has already are replaced.  A null key counts as the empty
    string; rows with the same key share a shard, so a repeated row stays with its first one.
    Text of any length plays no part.  An empty table gives an empty result.
    """
    plain = docs.drop("slot", "shard", "shard_name")
    table = F.broadcast(lookup_table(docs.sparkSession, shards, size))
    placed = plain.withColumn("slot", slot_of(F.col(key), size))
    return placed.join(table, "slot", "left").select(*plain.columns, "slot", "shard", "shard_name")
