"""SimHash near-duplicates: 64-bit fingerprints, exact tiled comparison, connected components.

Fingerprints that differ in at most ``radius`` bits are linked. Equal fingerprints are collapsed first. By the
pigeonhole principle two linked fingerprints agree in at least one of ``radius + 1`` bit blocks, so fingerprints are
dealt by (block, its value); the rows of a block value form tiles ordered by population count, and numpy compares
tiles by exclusive-or and bit counts. Tile pairs whose population counts differ by more than the radius are skipped.
A block value with more than TILE rows is split into tiles of one population count and a salt, and the tile pairs
are dealt to tasks, so no task holds more than two tiles. A task returns a spanning forest of the links it found, not
all pairs, which keeps every component.

Defined cases: a null or empty text, or one without words, has fingerprint 0 and links like any other; repeated rows
share a fingerprint and a component; a null doc_id is a row like others, and a component of such rows alone has a null
component_id; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import connected_components, packed, small_side, split_words, unpacked, written

SHINGLE, RADIUS, SEED = 3, 3, 42
#: Most rows of a block value that one task compares; larger ones are cut into tiles.
TILE = 8192
#: Rows of a side of the numpy comparison.
SQUARE = 256
#: Shingles of a text whose bits are unpacked at a time.
BLOCK = 255 * 256
#: Rows of complete groups that a task compares at a time.
CHUNK = 50_000


def fingerprint(raw: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned fingerprint of a text: bit set where over half the shingle hashes have it."""
    words = split_words(raw.lower() if raw else raw)
    if not words:
        return 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) <= shingle:
        hashes = [digest(join(words), seed)]
    else:
        hashes = [digest(join(x), seed) for x in zip(*(words[i:] for i in range(shingle)), strict=False)]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        some = hashes[at : at + BLOCK]
        rows = np.zeros((-(-len(some) // 255) * 255, 8), np.uint8)
        rows[: len(some)] = np.array(some, "<u8").view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(rows, axis=1, bitorder="little").reshape(-1, 255, 64)  # 255 ones still fit a byte
        ones += bits.sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep columns and ``fp`` (the fingerprint's bits as a signed long), one row for each row of docs."""
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(x.as_py(), shingle) for x in b.column(n)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(fps.view(np.int64))], names=[*keep, "fp"])

    some = docs.select(*keep, F.col(text).cast("binary").alias("raw"))
    schema = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep) + ", fp long"
    return some.mapInArrow(run, schema)


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least index that each of n nodes reaches over the edges a[i], b[i]."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root[root] != root).any():
            root = root[root]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def square_links(x: np.ndarray, y: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    return np.nonzero(np.bitwise_count(x[:, None] ^ y[None, :]) <= radius)


def group_links(fp: np.ndarray, pop: np.ndarray, side: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (index, least index) of a group ordered by population count.

    side: 0 and 1 for the two tiles of a pair, which are compared with each other only; all 0 within a tile.
    """
    n, cross = len(fp), bool(side.any())
    left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if cross else (np.arange(n), np.arange(n))
    found_a, found_b, held = [], [], 0
    for i in range(0, len(left), SQUARE):
        rows = left[i : i + SQUARE]
        for j in range(0 if cross else i, len(right), SQUARE):
            cols = right[j : j + SQUARE]
            if pop[cols[0]] - pop[rows[-1]] > radius:
                break
            if pop[rows[0]] - pop[cols[-1]] > radius:
                continue
            a, b = square_links(fp[rows], fp[cols], radius)
            found_a.append(rows[a])
            found_b.append(cols[b])
            held += len(a)
            if held > 1_000_000:
                root = forest(np.concatenate(found_a), np.concatenate(found_b), n)
                found_a, found_b, held = [np.arange(n)], [root], n
    if not found_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    root = forest(np.concatenate(found_a), np.concatenate(found_b), n)
    moved = np.flatnonzero(root != np.arange(n))
    return moved, root[moved]


def sweep_links(fp: np.ndarray, pop: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All links within many small groups, which lie one after another, each ordered by population count."""
    found_a, found_b = [], []
    at, step = np.arange(len(fp)), 0
    while True:
        step += 1
        at = at[at < len(fp) - step]
        at = at[(group[at] == group[at + step]) & (pop[at + step] - pop[at] <= radius)]
        if not len(at):
            break
        hit = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= radius]
        found_a.append(hit)
        found_b.append(hit + step)
    if not found_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_a), np.concatenate(found_b)


def compare(fp: np.ndarray, group: np.ndarray, side: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a forest for each group; rows come ordered by group and population count."""
    bits = fp.view(np.uint64)
    pop = np.bitwise_count(bits).astype(np.int64)
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(fp)])
    small = np.repeat(sizes <= SQUARE // 4, sizes) & ~np.repeat(np.maximum.reduceat(side, starts) > 0, sizes)
    own = np.flatnonzero(small)
    a, b = sweep_links(bits[own], pop[own], group[own], radius)
    a, b = [own[a]], [own[b]]
    for s, n in zip(starts, sizes, strict=True):
        if not small[s]:
            x, y = group_links(bits[s : s + n], pop[s : s + n], side[s : s + n], radius)
            a.append(x + s)
            b.append(y + s)
    return np.concatenate(a), np.concatenate(b)


def links(nodes: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b): a spanning forest of the links among the distinct fingerprints ``fp`` of nodes."""
    blocks = radius + 1
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    fp, pop = F.col("fp"), F.bit_count("fp").cast("int")
    part = [F.shiftrightunsigned(fp, lo).bitwiseAND((1 << (hi - lo)) - 1) if hi - lo < 64 else fp for lo, hi in zip(cuts, cuts[1:], strict=False)]
    keyed = nodes.select("fp", pop.alias("pop"), F.posexplode(F.array(*part)).alias("block", "value"))
    keyed = keyed.select("fp", "pop", F.struct("block", "value").alias("key"))
    # Block values with more than a tile: how many tiles each of their population counts takes.
    hot = keyed.groupBy("key", "pop").count()
    hot = hot.groupBy("key").agg(F.sum("count").alias("rows"), F.map_from_entries(F.collect_list(F.struct("pop", F.ceil(F.col("count") / tile).cast("int").alias("n")))).alias("tiles"))
    hot = small_side(written(hot.where(F.col("rows") > tile).select("key", "tiles"), "simhash-hot"), 10_000)
    dealt = keyed.join(hot, "key", "left")
    n_of = lambda q: F.coalesce(F.try_element_at("tiles", q), F.lit(0))
    code = lambda q, t: q * (1 << 24) + t
    mine = F.when(F.col("tiles").isNull(), F.lit(0)).otherwise(code(F.col("pop"), F.pmod(F.xxhash64("fp", F.lit(7)), n_of(F.col("pop"))).cast("int")))
    dealt = dealt.withColumn("mine", mine)
    others = F.flatten(F.transform(F.sequence(F.col("pop") - radius, F.col("pop") + radius), lambda q: F.when(n_of(q) > 0, F.transform(F.sequence(F.lit(0), n_of(q) - 1), lambda t: code(q, t))).otherwise(F.array().cast("array<int>"))))
    other = F.explode(F.when(F.col("tiles").isNull(), F.array(F.lit(0))).otherwise(others))
    dealt = dealt.select("fp", "pop", "key", "mine", other.alias("other"))
    dealt = dealt.select("fp", "pop", F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("task"), (F.col("mine") > F.col("other")).cast("int").alias("side"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def emit(tab: pa.Table) -> pa.RecordBatch:
            v = tab.column("fp").to_numpy()
            a, b = compare(v, tab.column("task").to_numpy(), tab.column("side").to_numpy(), radius)
            return pa.RecordBatch.from_arrays([pa.array(v[a]), pa.array(v[b])], names=["a", "b"])

        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= CHUNK:
                tab = pa.Table.from_batches(held)
                task = tab.column("task").to_numpy()
                cut = int(np.searchsorted(task, task[-1]))  # the last group may go on
                if cut:
                    yield emit(tab.slice(0, cut))
                    held = tab.slice(cut).combine_chunks().to_batches()
                    rows = tab.num_rows - cut
        if rows:
            yield emit(pa.Table.from_batches(held))

    dealt = dealt.repartition("task").sortWithinPartitions("task", "pop", "fp")
    return dealt.select("task", "fp", "side").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, tile: int = TILE) -> DataFrame:
    """doc_id, fp and component_id (the least doc_id reachable), one row for each row of docs."""
    fps = written(fingerprints(docs, shingle), "simhash-fps")
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "simhash-nodes")
    roots = connected_components(links(nodes, radius, tile))
    named = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "doc_id", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return fps.join(named.join(least, "root").select("fp", "component_id"), "fp", "left").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """docs without near-duplicates: of each component the row with the least (doc_id, text hash) stays.

    Every row has a place: rows are told apart by doc_id and text, and of wholly equal rows one stays. Rows with a
    null doc_id come after the others of their component.
    """
    mine = packed(docs, doc_id=F.col("doc_id"), text=F.col("text"), _h=F.xxhash64("text"))
    rows = written(fingerprints(mine, shingle, keep=("doc_id", "_h")), "simhash-fps")
    nodes = written(rows.groupBy("fp").count(), "simhash-nodes")
    roots = connected_components(links(nodes, radius))
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_h")
    best = rows.groupBy("fp").agg(F.min(order).alias("best"))
    best = best.join(roots, best.fp == roots.node, "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("best").alias("best"))
    kept = written(best.select(F.col("best.doc_id").alias("_d"), F.col("best._h").alias("_k")), "simhash-kept")
    same = lambda df, side: df.join(side, df["doc_id"].eqNullSafe(side["_d"]) & (df["_h"] == side["_k"]), "left_semi")
    # Of wholly equal rows one stays. They are found among the fingerprints, so only their own rows are ordered.
    twice = same(rows, small_side(kept)).groupBy("doc_id", "_h").count().where("count > 1")
    twice = written(twice.select(F.col("doc_id").alias("_d"), F.col("_h").alias("_k")), "simhash-twice")
    if twice.isEmpty():
        return unpacked(same(mine, small_side(kept)), docs.columns)
    once = kept.join(twice, kept["_d"].eqNullSafe(twice["_d"]) & (kept["_k"] == twice["_k"]), "left_anti")
    first = Window.partitionBy("doc_id", "_h").orderBy(F.lit(1))
    one = same(mine, small_side(twice)).withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    return unpacked(same(mine, small_side(written(once, "simhash-once"))).unionByName(one), docs.columns)
