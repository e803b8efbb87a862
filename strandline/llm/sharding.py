"""Sharding by jump consistent hashing: no ring table, and growth moves rows only into the new shard."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import id_block

#: The multiplier of the generator that the published algorithm steps through (Lamping and Veach, 2014). A fixed value.
STEP = 2862933555777941757


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of every key (uint64) among ``shards``: all keys jump at once, each until it leaves the range."""
    key = keys.astype(np.uint64)
    at = np.zeros(len(key), np.int64)
    ahead = np.zeros(len(key), np.int64)
    todo = np.arange(len(key))
    while len(todo):
        at[todo] = ahead[todo]
        key[todo] = key[todo] * np.uint64(STEP) + np.uint64(1)
        draw = (key[todo] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[todo] = np.floor((at[todo] + 1).astype(np.float64) * (2147483648.0 / draw)).astype(np.int64)
        todo = todo[ahead[todo] < shards]
    return at


def assign(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: its shard, its slot in the shard and the shard it would have with one shard more.

    The key is the id itself, so equal ids go together and nothing but id and shard count decides; a null id counts as 0.
    Slots run without gaps from 0 in each shard, by (id, size, checksum), nulls first; rows alike in all three are
    interchangeable. A null text has size 1 and the checksum of no bytes. An empty table gives an empty result. Other columns
    are ignored. Text never leaves its map task: only id, size and checksum are shuffled, in id blocks, and the offsets of
    the blocks come from a table of at most shards x 24,096 rows. Blocks have about as many rows however the ids lie.
    """
    if shards < 1:
        raise ValueError("shards must be positive")

    @F.pandas_udf("shard int, grown_shard int")
    def dealt(ids: pd.Series) -> pd.DataFrame:
        keys = ids.to_numpy(np.int64).view(np.uint64)
        return pd.DataFrame({"shard": jump(keys, shards).astype(np.int32), "grown_shard": jump(keys, shards + 1).astype(np.int32)})

    block = id_block(docs.select(F.col(id_col).alias("doc_id")), 1000, 20_000)
    rows = (
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
        )
        .withColumn("_to", dealt(F.coalesce("doc_id", F.lit(0)).cast("long")))  # a null would make floats of the ids beside it
        .select("doc_id", "size", "text_crc32", "_to.shard", "_to.grown_shard", block.alias("_block"))
    )
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "_block").agg(F.count("*").alias("_n")).select("shard", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("shard", "_block").orderBy("doc_id", "size", "text_crc32")
    return (
        rows.withColumn("_at", F.row_number().over(within) - 1)
        .join(starts, ["shard", "_block"])
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("_start") + F.col("_at")).alias("slot"), "grown_shard")
    )
