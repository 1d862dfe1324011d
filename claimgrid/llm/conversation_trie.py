"""Prefix trie of conversations: a node for each distinct sequence of first turns, with what its subtree shares.

Turns are dealt by range of (conversation, place), so one conversation may lie in many partitions. A scan in numpy gives
each prefix a polynomial rolling fingerprint (the sum of turn hashes times powers of a base, modulo 2**64); partitions
hand on their last conversation's sum. Prefixes with equal depth and fingerprint are candidates for one node: sorted by
(depth, fingerprint, conversation), each is verified against its group's representative, the least conversation: the
turn's SHA-256 must agree, and so must the parent's group. By induction over the depth that verifies all turns. Members
that differ were put together by a collision: they, and all that is below them, take a further number along the scan, and
groups are verified anew until none differs.

The rollup needs no rounds by depth. A node belongs to its representative, whose nodes are the last ones of its own
prefixes; so a node's subtree is, over its members, what each member owns from that depth on: sums from the end of each
conversation, then one aggregation by node with partial sums.

Defined cases: rows with a null conv_id belong to no conversation; a null turn comes first; a null role or text is empty;
turns of equal number go by role, then text; wholly equal rows are turns of their own; an empty table gives an empty
result; other columns aren't looked at; conv_id may be any integer (% has the sign of c, as in SQL).
"""

from __future__ import annotations

import hashlib
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shared_root, written
from .scans import Batches, Walk, carried, changes, noted, numbers, placed, run_notes, run_states

_U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
#: Ids that a block of a node's ending conversations holds.
BLOCK = 256
#: Shared first turns are taken from conversation c - c % EVERY; a conversation takes fewer than HEADS of them.
EVERY, HEADS = 100, 6
_NODE = ("depth", "f", "s")
_ROW = "conv_id long, depth long, f long, s long, pf long, ps long, digest binary, chars long, ends boolean"


def turn_columns() -> list[Column]:
    """t, digest, chars of a turn (role, text)."""
    exact = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return [F.xxhash64("role", "text").alias("t"), F.unhex(F.sha2(exact, 256)).alias("digest"), F.char_length("text").cast("long").alias("chars")]


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0), t (a 64-bit hash), digest, chars of every turn."""
    filled = conversations.where("conv_id is not null").select("conv_id", "turn", *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")))
    rows = placed(filled, "conv_id", "turn", "role", "text", keep=("conv_id", *turn_columns()))
    states = run_states(noted(rows, run_notes("conv_id", lambda b, place: [])))

    def number(batches: Batches, carry: Any) -> Batches:
        walk = Walk(batches, "conv_id", carry[0])
        for b in walk:
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), pa.array(walk.place), *(b.column(c) for c in ("t", "digest", "chars"))], names=["conv_id", "place", "t", "digest", "chars"])

    out = carried(rows.withColumn("conv_id", F.col("conv_id").cast("long")), number, "conv_id long, place long, t long, digest binary, chars long", states)
    return written(out, "trie-turns")


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and conversations (conv_id) where each conversation c takes its first h turns from c - c % EVERY, h being its
    id's hash modulo HEADS, and goes on with its own turns after its first h."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    convs = own.select("conv_id").distinct()
    heads = own.where((F.col("conv_id") % EVERY == 0) & (F.col("place") < HEADS - 1)).withColumnRenamed("conv_id", "base")
    shared = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % EVERY).join(heads, "base").where(F.col("place") < h)
    rest = own.where(F.col("place") >= h).withColumn("place", F.col("place") + HEADS)
    return shared.select(own.columns).unionByName(rest.select(own.columns)), convs


def _fingerprints(rows: DataFrame, mask: int) -> DataFrame:
    """Every prefix, the empty one too, with its fingerprint and its parent's."""
    rows = placed(rows, "conv_id", "place")
    powers = np.cumprod(np.r_[_U(1), np.full(100_000, BASE, _U)], dtype=_U)

    def power(place: np.ndarray) -> np.ndarray:
        first = int(place.min())
        top = int((place - first).max())
        table = powers if top < len(powers) else np.cumprod(np.r_[_U(1), np.full(top, BASE, _U)], dtype=_U)
        return table[place - first] * _U(pow(BASE, first, 1 << 64))

    def term(b: pa.RecordBatch, place: np.ndarray) -> list[np.ndarray]:
        return [numbers(b, "t").view(_U) * power(place)]

    states = run_states(noted(rows, run_notes("conv_id", term)), lambda n, a, b: a + pow(BASE, n, 1 << 64) * b)

    def step(batches: Batches, carry: Any) -> Batches:
        walk = Walk(batches, "conv_id", carry[0], carry[1])
        for b in walk:
            own = term(b, walk.place)[0]
            f = walk.running(0, own)
            columns = [b.column("conv_id"), walk.place, (f & _U(mask)).view(np.int64), ((f - own) & _U(mask)).view(np.int64), b.column("digest"), b.column("chars"), ~walk.followed]
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], names=["conv_id", "depth", "f", "pf", "digest", "chars", "ends"])

    out = carried(rows, step, "conv_id long, depth long, f long, pf long, digest binary, chars long, ends boolean", states)
    zero = F.lit(0).cast("long")
    return written(out.select("conv_id", "depth", "f", zero.alias("s"), "pf", zero.alias("ps"), "digest", "chars", "ends"), "trie-prefixes")


def _marks(b: pa.RecordBatch) -> np.ndarray:
    """What must agree within a node, as rows of 6 numbers: the parent's group and the turn's digest."""
    raw = b.column("digest").cast(pa.binary(32))
    digest = np.frombuffer(raw.buffers()[1], np.uint8)[raw.offset * 32 : (raw.offset + len(raw)) * 32].view("<i8").reshape(-1, 4)
    return np.column_stack([numbers(b, "pf"), numbers(b, "ps"), digest])


def _first_last(batches: Batches) -> Any:
    """A partition's first and last group: (key, representative, its marks)."""
    first, now = None, None
    for b in batches:
        keys = np.column_stack([numbers(b, c) for c in _NODE])
        starts = np.flatnonzero(changes(*keys.T))
        for at in starts[[0, -1]] if len(starts) > 1 else starts:
            key = tuple(keys[at].tolist())
            if now is None or now[0] != key:
                now = (key, int(numbers(b, "conv_id")[at]), _marks(b)[at].tolist())
                first = first or now
    return first, now


def _open_groups(notes: list[tuple[int, Any]]) -> dict[int, Any]:
    """For each partition the group that is open where it begins."""
    out, now = {}, None
    for p, (first, last) in notes:
        out[p] = now
        now = now if now and last[0] == now[0] else last
    return out


def _verified(batches: Batches, now: Any) -> Batches:
    """Rows with their representative, and whether they differ from it."""
    for b in batches:
        keys, convs, marks = np.column_stack([numbers(b, c) for c in _NODE]), numbers(b, "conv_id"), _marks(b)
        starts = np.flatnonzero(changes(*keys.T))
        sizes = np.diff(np.r_[starts, len(keys)])
        reps, wanted = convs[starts], marks[starts]
        if now and now[0] == tuple(keys[0].tolist()):
            reps[0], wanted[0] = now[1], now[2]
        wrong = (marks != np.repeat(wanted, sizes, axis=0)).any(axis=1)
        now = (tuple(keys[-1].tolist()), int(reps[-1]), wanted[-1].tolist())
        kept = [b.column(c) for c in ("conv_id", *_NODE, "pf", "ps", "digest", "chars", "ends")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(np.repeat(reps, sizes)), pa.array(wrong)], names=["conv_id", *_NODE, "pf", "ps", "digest", "chars", "ends", "rep", "wrong"])


def _split(rows: DataFrame, again: int) -> DataFrame:
    """Rows that differ from their representative, and the ones below them, with a further number of their own."""
    moved = F.when(F.col("wrong"), F.xxhash64(F.lit(again), "pf", "ps", "digest")).otherwise(F.lit(0))
    rows = placed(rows.withColumn("moved", moved), "conv_id", "depth")
    states = run_states(noted(rows, run_notes("conv_id", lambda b, place: [numbers(b, "moved").view(_U)])))

    def step(batches: Batches, carry: Any) -> Batches:
        walk = Walk(batches, "conv_id", carry[0])
        for b in walk:
            own = numbers(b, "moved").view(_U)
            by = walk.running(0, own)
            new = {"s": numbers(b, "s").view(_U) + by, "ps": numbers(b, "ps").view(_U) + by - own}
            names = [x.split()[0] for x in _ROW.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(new[c].view(np.int64)) if c in new else b.column(c) for c in names], names=names)

    return written(carried(rows, step, _ROW, states), "trie-split")


def _blocks(batches: Batches, _: Any) -> Batches:
    """The ids of a node's ending conversations, in order, in blocks."""
    for b in batches:
        keys, convs = [numbers(b, c) for c in _NODE], numbers(b, "conv_id")
        starts = np.flatnonzero(changes(*keys) | (np.arange(len(convs)) % BLOCK == 0))
        cuts = pa.array(np.r_[starts, len(convs)].astype(np.int32))
        yield pa.RecordBatch.from_arrays([*(pa.array(k[starts]) for k in keys), pa.array(convs[starts]), pa.ListArray.from_arrays(cuts, pa.array(convs))], names=[*_NODE, "first", "ids"])


def _digests(batches: Batches) -> Batches:
    """SHA-256 of each node's ids, whose blocks come one after another."""
    now, sha, done = None, None, []
    for b in batches:
        for key, ids in zip(zip(*(b.column(c).to_pylist() for c in _NODE), strict=True), b.column("ids").to_pylist(), strict=True):
            text = ",".join(map(str, ids)).encode()
            if key == now:
                sha.update(b"," + text)
            else:
                if now is not None:
                    done.append((*now, sha.hexdigest()))
                now, sha = key, hashlib.sha256(text)
        if done:
            yield pa.RecordBatch.from_pylist([dict(zip((*_NODE, "ends_sha256"), x, strict=True)) for x in done])
            done = []
    if now is not None:
        yield pa.RecordBatch.from_pylist([dict(zip((*_NODE, "ends_sha256"), (*now, sha.hexdigest()), strict=True))])


def _rollup(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """For each node its parent's conv_id, and over its subtree leaves and saved characters."""
    own = nodes.select(F.col("conv_id").alias("_c"), F.col("depth").alias("_d"), ((F.col("n_convs") - 1) * F.col("chars")).alias("w"), (F.col("n_children") == 0).cast("long").alias("leaf"))
    beside = rows.join(own, (F.col("conv_id") == F.col("_c")) & (F.col("depth") == F.col("_d")), "left")
    beside = written(beside.select("conv_id", *_NODE, "rep", F.coalesce("w", F.lit(0)).alias("w"), F.coalesce("leaf", F.lit(0)).cast("long").alias("leaf")), "trie-owned")
    rows = placed(beside, "conv_id", F.desc("depth"))
    values = lambda b, place: [numbers(b, "w").view(_U), numbers(b, "leaf").view(_U)]
    states = run_states(noted(rows, run_notes("conv_id", values, lambda b: int(numbers(b, "rep")[0]))))

    def step(batches: Batches, carry: Any) -> Batches:
        heads = [carry[2]]
        walk = Walk(_remembering(batches, heads), "conv_id", carry[0], carry[1])
        for b in walk:
            w, leaf = (walk.running(i, v).view(np.int64) for i, v in enumerate(values(b, None)))
            rep = numbers(b, "rep")
            above = np.r_[rep[1:], heads[-1] if heads[-1] is not None else 0]
            mine = walk.followed & (rep == numbers(b, "conv_id"))
            parent = pa.array(above.astype(np.int64), mask=~mine)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in _NODE), pa.array(w), pa.array(leaf), parent], names=[*_NODE, "w", "leaf", "parent"])

    sums = carried(rows, step, "depth long, f long, s long, w long, leaf long, parent long", states)
    return sums.groupBy(*_NODE).agg(F.max("parent").alias("parent_conv_id"), F.sum("leaf").alias("n_leaves"), F.sum("w").alias("saved_tokens"))


def _remembering(batches: Batches, heads: list) -> Batches:
    """Batches, the last of heads being the first representative of what follows the batch that is worked on."""
    end = heads[0]
    for b in batches:
        heads.append(int(numbers(b, "rep")[0]))
        yield b
    heads.append(end)


def trie(own: DataFrame, convs: DataFrame | None = None, bits: int = 64) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of each node.

    own: conv_id, place, t, digest, chars of turns. convs: all conversations (conv_id), if some have no turns. bits: of the
    fingerprint; fewer give collisions, which are split.
    """
    shared_root(own.sparkSession)
    convs = own.select("conv_id").distinct() if convs is None else convs
    none = [F.lit(-1).cast("long"), F.lit(0).cast("long"), F.unhex(F.lit("00" * 32)), F.lit(0).cast("long")]
    rows = written(convs.select("conv_id", *none).toDF(*own.columns).union(own), "trie-rows")
    rows, again = _fingerprints(rows, (1 << bits) - 1), 0
    while True:
        ordered = placed(rows, *_NODE, "conv_id")
        found = written(carried(ordered, _verified, f"{_ROW}, rep long, wrong boolean", _open_groups(noted(ordered, _first_last))), "trie-verified")
        if found.where("wrong").isEmpty():
            break
        again += 1
        rows = _split(found.drop("rep"), again)
    nodes = written(found.groupBy(*_NODE).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"), F.max("pf").alias("pf"), F.max("ps").alias("ps")), "trie-nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pf").alias("f"), F.col("ps").alias("s")).agg(F.count("*").alias("n_children"))
    ending = ordered.where("ends")
    blocks = carried(ending, _blocks, "depth long, f long, s long, first long, ids array<long>", {p: None for p in range(ordered.rdd.getNumPartitions())})
    ends = blocks.repartition(*_NODE).sortWithinPartitions(*_NODE, "first").mapInArrow(_digests, "depth long, f long, s long, ends_sha256 string")
    nodes = nodes.join(children, [*_NODE], "left").join(ends, [*_NODE], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = written(nodes, "trie-nodes-with-children")
    out = nodes.join(_rollup(found, nodes), [*_NODE])
    nothing = F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", nothing)
