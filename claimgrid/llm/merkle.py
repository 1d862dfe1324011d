"""Merkle manifest of a dataset: leaves are rows, each source has a tree, the sources' roots have one more.

Pregel-style supersteps over RDDs. A vertex (tree, level, run) is a run of at most FAN consecutive nodes of one level.
Going up, children message their run; a run that has all its children hashes them and sends its digest to the run above.
A source's lone last node goes up as it is until the deepest source is done; then all go to the tree of sources, whose lone
node is the root. Going down, each run sends each child the digests of its siblings and what it was itself sent: the path up
to the root. At the leaves each row folds its path back to the root, which verifies it.

Leaves are hashed by Spark, numbered by a range sort (no task holds a source), and messages are combined before they are
shuffled, FAN at most to a vertex. How many supersteps there are follows from the largest source's size, so none ends
in a job of its own; they grow with its logarithm. Runs of leaves are checkpointed; the runs above are a fifteenth of them
and are made again from shuffled messages if an executor is lost. What a source's rows must know (its rank, first
number and size) comes from a join with one row for each source, broadcast if that is small.

Defined cases: within a source, rows go by doc_id (null first), then by leaf, so wholly equal rows are neighbours and
equal; a null field is ``-``, an empty one ``0:``; a source of one row has its leaf as subroot; one source alone has its
subroot as root; an empty table gives an empty result; other columns aren't looked at; any type of doc_id with an order
will do.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator

from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shared_root, small_side, written
from .sharding import numbered

#: Nodes of a run; runs of a partition.
FAN, RUNS = 16, 10_000
#: The tree over the sources' subroots; sources' own trees are numbered from 0.
TOP = -1
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows whose hash of the id this divides are tampered with, to see that verification notices.
TAMPER = 5

Key = tuple[int, int, int]


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_hash(*values: Column) -> Column:
    each = (v.cast("string") for v in values)
    return F.sha2(F.concat(*(F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)) for v in each)), 256)


def leaves(docs: DataFrame, tamper: int | None = None) -> DataFrame:
    """doc_id, source, leaf, tampered: the leaf of the row with its text's A-Z in lower case; null where nothing was changed."""
    own = [F.col(c) for c in FIELDS]
    text = F.translate(own[-1], string.ascii_uppercase, string.ascii_lowercase)
    chosen = F.lit(False) if tamper is None else F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % tamper == 0, F.lit(False))
    return docs.select("doc_id", "source", leaf_hash(*own).alias("leaf"), F.when(chosen & ~text.eqNullSafe(own[-1]), leaf_hash(*own[:-1], text)).alias("tampered"))


def _placed(rows: DataFrame) -> tuple[DataFrame, int, int, int]:
    """rows with tree (rank of the source), at (place in it), of (its rows); how many rows and sources there are, and the
    rows of the largest source."""
    all_rows, n = numbered(rows, "source", "doc_id", "leaf")
    sources = all_rows.groupBy("source").agg(F.min("number").alias("start"), F.count("*").alias("of"))
    sources, n_sources = numbered(written(sources, "merkle-sources"), "start")
    sources = written(sources.select(F.col("source").alias("_s"), "start", "of", F.col("number").alias("tree")), "merkle-ranks")
    largest = sources.agg(F.coalesce(F.max("of"), F.lit(0))).first()[0]
    out = all_rows.join(small_side(sources), F.col("source").eqNullSafe(F.col("_s")))
    return out.select("doc_id", "leaf", "tampered", "tree", (F.col("number") - F.col("start")).alias("at"), "of"), n, n_sources, largest


def _levels(n: int) -> int:
    """Levels of runs above n nodes until one is left."""
    return 0 if n <= 1 else 1 + _levels(-(-n // FAN))


def _dealt(key: Key) -> int:
    return ((key[0] * 1_000_003 + key[1]) * 1_000_003 + key[2]) & 0x7FFFFFFF


def _combine(a: tuple[int, list], b: tuple[int, list]) -> tuple[int, list]:
    return a[0], a[1] + b[1]


def _ordered(vertex: tuple[Key, tuple[int, list]]) -> tuple[Key, tuple[int, list]]:
    """A run that has all its children, in order."""
    (tree, level, run), (of, children) = vertex
    if len(children) != min(FAN, of - FAN * run):
        raise ValueError(f"run {run} of level {level} in tree {tree} has {len(children)} of its children")
    return vertex[0], (of, sorted(children, key=lambda c: c[0]))


def _value(children: list, of: int) -> str:
    return children[0][1] if of == 1 else digest(*(c[1] for c in children))


def _upward(vertex: tuple[Key, tuple[int, list]]) -> tuple[Key, tuple[int, list]]:
    """The message of a run to the one above: (nodes of that level, [(place, digest, sender)])."""
    key, (of, children) = vertex
    tree, level, run = key
    return (tree, level + 1, run // FAN), (-(-of // FAN), [(run % FAN, _value(children, of), key)])


def _to_top(vertex: tuple[Key, tuple[int, list]], n_sources: int) -> tuple[Key, tuple[int, list]]:
    """A source's last node as a child in the tree of sources."""
    key, (of, children) = vertex
    return (TOP, 0, key[0] // FAN), (n_sources, [(key[0] % FAN, _value(children, of), key)])


def _downward(vertex: tuple[Key, tuple[tuple[int, list], tuple]]) -> Iterator[tuple[Key, tuple]]:
    """To each child the root and the runs above it, nearest first: (in the tree of sources, place, all digests) of each."""
    (tree, _, _), ((of, children), (root, path)) = vertex
    row = tuple(c[1] for c in children)
    for i, _, child in children:
        yield child, (root, path if of == 1 else ((tree == TOP, i, row), *path))


def _kept(rdd: RDD) -> RDD:
    """rdd in the shared folder, computed once, without its lineage."""
    rdd = rdd.persist(StorageLevel.DISK_ONLY)
    rdd.checkpoint()
    rdd.count()
    return rdd.unpersist()


def _beside(runs: RDD, sent: RDD) -> RDD:
    """(key, (run, what it was sent)): messages are dealt as the runs are, so that runs aren't shuffled."""
    sent = sent.mapValues(lambda v: (1, v)).partitionBy(runs.getNumPartitions(), _dealt)
    both = runs.mapValues(lambda v: (0, v)).union(sent).groupByKey(runs.getNumPartitions(), _dealt)
    return both.mapValues(lambda v: tuple(x for _, x in sorted(v, key=lambda x: x[0])))


def _messages(rows: Iterator) -> Iterator[tuple[Key, tuple[int, list]]]:
    """Leaves as messages to their runs, combined within the task as far as they follow one another."""
    key, of, children = None, 0, []
    for doc_id, leaf, tampered, tree, at, n in rows:
        if (now := (tree, 0, at // FAN)) != key:
            if children:
                yield key, (of, children)
            key, of, children = now, n, []
        children.append((at % FAN, leaf, (doc_id, tampered)))
    if children:
        yield key, (of, children)


def _folded(vertex: tuple[Key, tuple[tuple[int, list], tuple]]) -> Iterator[tuple]:
    """A row for each leaf of a run."""
    _, ((of, children), (root, path)) = vertex
    own = tuple(c[1] for c in children)
    above = [x for _, i, row in path for x in (*row[:i], *row[i + 1 :])]
    subroot = next((row[i] for top, i, row in path if top), root)
    tail, original = "".join(above), None
    for i, leaf, (doc_id, tampered) in children:
        folded = original
        if tampered is not None or original is None:
            folded = tampered or leaf
            for _, at, row in ((False, i, own), *path) if of > 1 else path:
                folded = digest(*row[:at], folded, *row[at + 1 :])
            original = original if tampered else folded
        beside = [*own[:i], *own[i + 1 :]]
        yield doc_id, leaf, subroot, root, [*beside, *above], digest(*beside, tail), folded, folded == root


def manifest(docs: DataFrame, tamper: int | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof (the siblings' digests, level by level), proof_sha256, folded_root, verified."""
    spark = docs.sparkSession
    shared_root(spark)
    placed, n, n_sources, largest = _placed(written(leaves(docs, tamper), "merkle-leaves"))
    known = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, leaf string, subroot string, root string, proof array<string>, proof_sha256 string, folded_root string, verified boolean"
    if not n:
        return spark.createDataFrame([], known)

    def superstep(messages: RDD, most: int) -> RDD:
        """Runs with their children; most: about how many there are."""
        return messages.reduceByKey(_combine, max(1, most // RUNS), _dealt).map(_ordered, preservesPartitioning=True)

    runs, most = [_kept(superstep(placed.rdd.mapPartitions(_messages), max(n // FAN, RUNS * spark.sparkContext.defaultParallelism)))], n // FAN
    for _ in range(_levels(largest)):
        most = most // FAN + n_sources
        runs.append(superstep(runs[-1].map(_upward), most))
    runs.append(superstep(runs[-1].map(lambda v: _to_top(v, n_sources)), n_sources // FAN))
    for _ in range(_levels(n_sources)):
        runs.append(superstep(runs[-1].map(_upward), n_sources // FAN**2))
    sent = runs[-1].mapValues(lambda v: (v, (v[1][0][1], ()))).flatMap(_downward)
    for level in reversed(runs[1:-1]):
        sent = _beside(level, sent).flatMap(_downward)
    return spark.createDataFrame(_beside(runs[0], sent).flatMap(_folded), known, verifySchema=False)
