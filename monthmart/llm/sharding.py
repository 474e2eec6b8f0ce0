"""Shards by a permutation of row numbers.

Each row gets a global number, 0 to rows-1, and the number is permuted by a Feistel
network. The network permutes a power of four at least as large as the number of rows;
results beyond the last row are permuted again until they fall inside (cycle walking),
which is itself a permutation of the row numbers. Shard and slot follow from the
permuted number alone, so any row's place can be computed without the others, and
shard counts differ by one at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import materialize
from .text import mix

ROWS_PER_BUCKET = 200_000
ROUNDS = 6


def permuted(numbers: np.ndarray, rows: int, seed: int = 0, rounds: int = ROUNDS) -> np.ndarray:
    """Place of each row number in the permutation of range(rows) that the seed names."""
    half = max(1, (max(rows - 1, 1).bit_length() + 1) // 2)
    shift, mask = np.uint64(half), np.uint64((1 << half) - 1)
    keys = mix(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(seed))
    out = np.array(numbers, dtype=np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> shift, out[walking] & mask
        for key in keys:
            left, right = right, left ^ (mix(right ^ key) & mask)
        out[walking] = (left << shift) | right
        walking = walking[out[walking] >= rows]
    return out.astype(np.int64)


def shard_and_slot(number: int, rows: int, shards: int, seed: int = 0) -> tuple[int, int]:
    """Where one row number lies, computed alone."""
    place = int(permuted(np.array([number]), rows, seed)[0])
    return place % shards, place // shards


def row_numbers(keyed: DataFrame, keys: list[str], count: str = "copies") -> DataFrame:
    """Adds first_number: rows are numbered by hash bucket, then by key, each key taking as many numbers as it has copies.

    No row is numbered in one task: a bucket holds about ROWS_PER_BUCKET keys, and only the
    totals of the buckets meet in one window.
    """
    buckets = max(1, keyed.count() // ROWS_PER_BUCKET)
    keyed = keyed.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    inside = Window.partitionBy("_bucket").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = keyed.groupBy("_bucket").agg(F.sum(count).alias("_n")).select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    placed = keyed.withColumn("_inside", F.coalesce(F.sum(count).over(inside), F.lit(0)))
    return placed.join(starts, "_bucket").withColumn("first_number", F.col("_start") + F.col("_inside")).drop(
        "_bucket", "_start", "_inside"
    )


def shard(docs: DataFrame, keys: dict[str, Column], shards: int = 16, seed: int = 0) -> DataFrame:
    """One row per row of docs: its keys, global row_number, shard and slot (gapless from 0 in each shard).

    keys names the columns to carry; they also order the row numbers, so that a rerun gives the same
    shards whatever the partitions. Rows with equal keys take neighbouring numbers in any order, as nothing tells them
    apart. Null keys are keys like others; no rows give no rows.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    names = list(keys)
    carried = docs.select(*[c.alias(k) for k, c in keys.items()])
    keyed = materialize(carried.groupBy(*names).agg(F.count(F.lit(1)).alias("copies")), "shard-keys")
    rows = keyed.agg(F.sum("copies")).first()[0] or 0
    single = row_numbers(keyed, names).select(
        *names, F.explode(F.sequence("first_number", F.col("first_number") + F.col("copies") - 1)).alias("row_number")
    )
    fields = ", ".join(f"`{n}` {t}" for n, t in single.dtypes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = permuted(batch.column("row_number").to_numpy(), rows, seed)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array((places % shards).astype(np.int32)), pa.array(places // shards)],
                [*batch.schema.names, "shard", "slot"],
            )

    return single.mapInArrow(place, f"{fields}, shard int, slot bigint")
