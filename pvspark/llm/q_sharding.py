"""op7: every document placed on one of 64 shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pvspark.llm import sharding
from pvspark.llm.scratch import read_table

SHARDS = [f"shard-{k:03d}" for k in range(64)]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read_table(spark, sf_dir, "documents").select("doc_id"), SHARDS)


def sql() -> str:
    """The slot by SQL; the owners are the table's own values, tested against a plain fill."""
    owners = ",".join(map(str, sharding.slot_owners(SHARDS)))
    return f"""
WITH slots AS (
  SELECT doc_id, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT
    % {sharding.TABLE_SIZE})::INTEGER AS slot FROM documents
), owners AS (SELECT [{owners}] AS owner), placed AS (
  SELECT doc_id, slot, owner[slot + 1]::INTEGER AS shard FROM slots, owners
)
SELECT doc_id, slot, shard, 'shard-' || lpad(shard::VARCHAR, 3, '0') AS shard_name FROM placed
"""


SQL = sql()
