"""What the training-data operators share: reading tables, words, the shared folder and connected components."""

from __future__ import annotations

import sys

from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimgrid.storage import shared_path, shared_root, written

__all__ = ["bounded_sample", "connected_components", "packed", "shared_path", "shared_root", "small_side", "split_words", "table", "unpacked", "written"]

# Executors need no copy of this package: functions travel with the tasks. Broadcast values are pickled by reference,
# so they are plain arrays, tuples and dictionaries.
register_pickle_by_value(sys.modules[__package__])

#: Rows and bytes up to which a side of a join is broadcast once it has been counted; above, the join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def split_words(raw: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes: bytes.split() cuts at exactly these six characters."""
    return raw.split() if raw else []


def _bytes(name: str, kind: T.DataType) -> Column:
    """About how many bytes a column's value takes."""
    c = F.col(f"`{name}`")
    if isinstance(kind, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        each = F.transform(c, lambda x: F.octet_length(x.cast("string")) + 8)
        return F.coalesce(F.aggregate(each, F.lit(0), lambda s, x: s + x), F.lit(0)) + 24
    return F.lit(16)


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if it has at most ``rows`` rows and about ``size`` bytes; else as it is, for a shuffled join.

    Meant for frames that are already written, since it counts them (up to the bound only).
    """
    width = sum((_bytes(f.name, f.dataType) for f in df.schema.fields), F.lit(0).cast("long"))
    n, total = df.limit(rows + 1).agg(F.count("*"), F.sum(width)).first()
    return F.broadcast(df) if n <= rows and (total or 0) <= size else df


def bounded_sample(labels: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows of labels (a row for each doc_id), the ones with the least hash of doc_id.

    A share of the hashes that gives little more than ``most`` rows is cut out first, so what is ordered stays small
    whatever the number of partitions.
    """
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / float(1 << 53)
    share = 1.2 * most / max(1, labels.count())
    some = labels if share >= 1 else labels.where(place < share)
    return written(some.orderBy(place, "doc_id").limit(most), "sample")


def packed(df: DataFrame, **columns) -> DataFrame:
    """All columns of df in one struct ``row``, beside working columns whose names then clash with none."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), *(c.alias(n) for n, c in columns.items()))


def unpacked(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*(F.col(f"row.`{c}`").alias(c) for c in names))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b), root being the least node reachable.

    Alternating large-star and small-star rounds; each is two aggregations with map-side minima and two joins
    on a node, so nothing holds a whole component, and a hot node is a skewed join that adaptive execution splits.
    A round's edges are checkpointed. Rounds grow with the logarithm of the longest chain, and end when every node that
    isn't a root has one edge, to a root: exactly then another round would change nothing.
    """
    shared_root(edges.sparkSession)
    now = edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    now = now.distinct().checkpoint()
    one, none = F.lit(1).alias("up"), F.lit(0).alias("up")
    while True:
        ends = now.select("a", one, F.lit(0).alias("down")).union(now.select("b", none, F.lit(1)))
        ends = ends.groupBy("a").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if ends.where("up > 1 or (up = 1 and down = 1)").isEmpty():
            break
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m"))
        now = small.where("a <> b").distinct().checkpoint()
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select("b", "b").distinct())
