"""Sharding: a uniform shuffle into shards of exact sizes by a hypergeometric communication matrix."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import buckets_for, prefix_offsets, written

#: Below this many rows numpy draws hypergeometric numbers itself.
NUMPY_MOST = 1_000_000_000
#: Input partitions whose rows of the matrix are drawn by one task.
PARTITIONS_PER_TASK = 512


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of drawn rows, out of good + bad, are good; exact for any size (inversion around the mode)."""
    if good + bad < NUMPY_MOST:
        return int(rng.hypergeometric(good, bad, drawn)) if good and drawn else 0
    low, high = max(0, drawn - bad), min(good, drawn)
    mode = min(high, max(low, (drawn + 1) * (good + 1) // (good + bad + 2)))
    total = good + bad
    spread = math.sqrt(max(1.0, drawn * (good / total) * (bad / total) * (total - drawn) / max(1, total - 1)))
    a, b = max(low, mode - int(14 * spread) - 20), min(high, mode + int(14 * spread) + 20)
    k = np.arange(a, b, dtype=np.float64)
    step = np.log(good - k) + np.log(drawn - k) - np.log(k + 1) - np.log(bad - drawn + k + 1)  # log p(k + 1) / p(k)
    log_p = np.concatenate([[0.0], np.cumsum(step)])
    p = np.exp(log_p - log_p.max())
    return a + int(np.searchsorted(np.cumsum(p), rng.random() * p.sum(), "right"))


def split_counts(rng: np.random.Generator, rows: int, capacity: np.ndarray) -> np.ndarray:
    """How many of rows go to each shard, if the rows are a uniform sample of those that fill the capacities."""
    out, left, rest = np.zeros(len(capacity), np.int64), int(rows), int(capacity.sum())
    for s, c in enumerate(capacity.tolist()):
        rest -= c
        out[s] = hypergeometric(rng, c, rest, left) if rest else left
        left -= int(out[s])
    return out


def exact_sizes(rows: int, shards: int) -> np.ndarray:
    return np.array([rows // shards + (s < rows % shards) for s in range(shards)], np.int64)


def shard(df: DataFrame, shards: int, seed: int = 17) -> DataFrame:
    """Adds shard and slot to the rows of df by a uniform random permutation: shard sizes are exact (counts at
    most one apart) and each shard's slots are gapless from 0.

    The rows are written once with their input partition. A partition's rows are permuted by a random key; the
    communication matrix says how many of them go to each shard, drawn without replacement so that the columns
    add up to the exact sizes; after the exchange each shard is permuted again. The driver draws the counts of groups of partitions, tasks those of the partitions
    in a group. A shard is ordered in buckets of bounded size, so no task holds a whole shard. Equal rows are
    separate rows; nulls in any column do not matter; an empty table gives an empty one."""
    spark = df.sparkSession
    base = written(df.withColumn("__part", F.spark_partition_id()).withColumn("__uid", F.monotonically_increasing_id()), "shard-rows")
    parts = base.groupBy("__part").agg(F.count("*").alias("__n"))
    # one row for each block of partitions comes to the driver
    blocks = [(r["__block"], r["__rows"]) for r in parts.groupBy(F.floor(F.col("__part") / PARTITIONS_PER_TASK).cast("int").alias("__block")).agg(F.sum("__n").alias("__rows")).orderBy("__block").collect()]
    total = sum(n for _, n in blocks)
    capacity, rng, plan = exact_sizes(total, shards), np.random.default_rng(seed), {}
    for block, n in blocks:
        plan[block] = split_counts(rng, n, capacity)
        capacity = capacity - plan[block]

    def draw(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("__part")
        block = int(group["__part"].iloc[0]) // PARTITIONS_PER_TASK
        left, own, rows = plan[block].copy(), np.random.default_rng([seed, block]), []
        for part, n in zip(group["__part"], group["__n"], strict=True):
            counts = split_counts(own, int(n), left)
            left -= counts
            rows.append((part, np.cumsum(counts).tolist()))
        return pd.DataFrame(rows, columns=["__part", "__upto"])

    matrix = written(parts.groupBy(F.floor(F.col("__part") / PARTITIONS_PER_TASK)).applyInPandas(draw, "__part int, __upto array<long>"), "shard-matrix")
    random = lambda salt: F.xxhash64(F.lit(seed), F.lit(salt), "__uid")
    local = Window.partitionBy("__part").orderBy(random(1), "__uid")
    sent = base.withColumn("__pos", F.row_number().over(local) - 1).join(matrix, "__part")
    sent = sent.withColumn("shard", F.size(F.filter("__upto", lambda c: c <= F.col("__pos"))).cast("int")).drop("__upto", "__pos", "__part")
    sent = sent.withColumn("__key", random(2)).withColumn("__bucket", F.pmod("__key", F.lit(buckets_for(-(-total // shards)))).cast("int"))
    sent = written(sent, "shard-sent")
    offsets = prefix_offsets(sent.groupBy("shard", "__bucket").agg(F.count("*").alias("__n")), ["shard"], "__bucket", "__n", "__before").select("shard", "__bucket", "__before")
    again = Window.partitionBy("shard", "__bucket").orderBy("__key", "__uid")
    placed = sent.withColumn("__at", F.row_number().over(again) - 1).join(offsets, ["shard", "__bucket"])
    return placed.withColumn("slot", (F.col("__at") + F.col("__before")).cast("long")).drop("__at", "__before", "__bucket", "__key", "__uid")


def shard_documents(df: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", seed: int = 17) -> DataFrame:
    """Every row's shard by the law rows: doc_id, size (UTF-8 bytes and 8; a null text has none), text_crc32 (of
    the UTF-8 bytes; 0 for a null or empty text), law, shard, slot, grown_shard (null under this law)."""
    text = F.coalesce(df[text_col].cast("string"), F.lit(""))
    thin = df.select(df[id_col].cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "utf-8")).alias("text_crc32"))
    return shard(thin, shards, seed).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
