"""Sharding: a keyed Feistel permutation of global row numbers gives each row its shard and slot.

Rows are numbered 0..N-1 in the order of (doc_id, checksum, size): a range sort whose partitions are counted, so a row's
number is its partition's offset plus its place in it. The numbered rows (no texts) are checkpointed, so every later
reader sees the same numbers. A Feistel network over the least even number of bits that holds N permutes the numbers;
cycle walking repeats it until the value is below N. Value v lies in shard v mod shards at slot v div shards: shard sizes
differ by at most one row, slots are gapless, and any row's place can be computed from its number, the key and N alone,
and back (``unpermute``).

Defined cases: a null text has size 16 and the checksum of the empty text; null doc_ids come first; wholly equal rows get
neighbouring numbers, which of them gets which doesn't matter; an empty table gives an empty result; other columns are
not looked at. Equal texts aren't kept together: the law is ``rows``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_root

SHARDS, ROUNDS, KEY = 40, 6, "claimgrid"
_U = np.uint64


def round_keys(key: str, rounds: int = ROUNDS) -> list[int]:
    return [int.from_bytes(hashlib.sha256(f"{key}:{r}".encode()).digest()[:8], "little") for r in range(rounds)]


def half_bits(n: int) -> int:
    return max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    x = (x + _U(key)) * _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def _network(v: np.ndarray, bits: int, keys: list[int], back: bool) -> np.ndarray:
    mask = _U((1 << bits) - 1)
    left, right = v >> _U(bits), v & mask
    for k in reversed(keys) if back else keys:
        if back:
            left, right = right ^ (_mix(left, k) & mask), left
        else:
            left, right = right, left ^ (_mix(right, k) & mask)
    return (left << _U(bits)) | right


def permute(numbers: np.ndarray, n: int, key: str = KEY, back: bool = False) -> np.ndarray:
    """The keyed permutation of 0..n-1 (or its inverse) at numbers, by cycle walking."""
    bits, keys = half_bits(n), round_keys(key)
    with np.errstate(over="ignore"):
        out = _network(numbers.astype(np.uint64), bits, keys, back)
        while (far := out >= _U(n)).any():
            out[far] = _network(out[far], bits, keys, back)
    return out.astype(np.int64)


def unpermute(places: np.ndarray, n: int, key: str = KEY) -> np.ndarray:
    return permute(places, n, key, back=True)


def numbered(rows: DataFrame, *order: str) -> tuple[DataFrame, int]:
    """rows with ``number``, their place in the order of the columns; and how many rows there are.

    The only thing collected is one count for each partition.
    """
    shared_root(rows.sparkSession)
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = placed.select("*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_i")).checkpoint()
    counts = dict(placed.groupBy("_p").count().collect())
    starts, n = {}, 0
    for p in sorted(counts):
        starts[p], n = n, n + counts[p]
    offsets = F.array(*(F.lit(starts.get(p, 0)).cast("long") for p in range(max(counts, default=0) + 1)))
    return placed.select("*", (F.get(offsets, F.col("_p")) + F.col("_i")).alias("number")).drop("_p", "_i"), n


def shard(docs: DataFrame, shards: int = SHARDS, key: str = KEY) -> DataFrame:
    """doc_id, size, text_crc32, law, number, shard, slot, grown_shard for every row of docs."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(raw) + 16).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    placed, n = numbered(rows, "doc_id", "text_crc32", "size")

    def place(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in parts:
            yield pd.Series(permute(x.to_numpy(), n, key))

    placed = placed.withColumn("_v", F.pandas_udf(place, "long")("number"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "number",
        (F.col("_v") % shards).cast("int").alias("shard"), F.floor(F.col("_v") / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
