"""Scans over a table sorted across partitions, with what is carried from one partition to the next.

``placed`` deals rows by ranges of an order that tells rows apart, so one hot key spreads over as many partitions as its
rows need. ``noted`` takes one small note from each partition; the driver folds these few notes into what each partition
must know of its neighbours; ``carried`` then streams each partition with it. Nothing holds a key's rows together.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from itertools import chain
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_root

Batches = Iterator[pa.RecordBatch]


def placed(rows: DataFrame, *order: Any, keep: tuple = ("*",)) -> DataFrame:
    """rows dealt by range and sorted by ``order``, with ``_p``, the number of their partition; checkpointed, so that every
    later reader sees the same rows in the same places. rows is read twice (Spark samples it), so it should be written.
    keep: what of them is kept once they are sorted."""
    shared_root(rows.sparkSession)
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select(*keep, F.spark_partition_id().alias("_p")).checkpoint()


def _opened(batches: Batches) -> tuple[int, Batches] | None:
    batches = (b for b in batches if b.num_rows)
    first = next(batches, None)
    return None if first is None else (first.column("_p")[0].as_py(), chain([first], batches))


def noted(rows: DataFrame, note: Callable[[Batches], Any]) -> list[tuple[int, Any]]:
    """(partition, its note) of placed rows, in order; empty partitions have none. A note's size mustn't grow with the rows."""

    def run(batches: Batches) -> Batches:
        if found := _opened(batches):
            yield pa.RecordBatch.from_pydict({"p": pa.array([found[0]], pa.int32()), "note": pa.array([pickle.dumps(note(found[1]))], pa.binary())})

    return sorted(((r.p, pickle.loads(bytes(r.note))) for r in rows.mapInArrow(run, "p int, note binary").collect()), key=lambda x: x[0])


def carried(rows: DataFrame, step: Callable[[Batches, Any], Batches], schema: str, carry: dict[int, Any]) -> DataFrame:
    """The batches of ``step(batches, carry[partition])``; carry has a small value for each partition with rows."""

    def run(batches: Batches) -> Batches:
        if found := _opened(batches):
            yield from step(found[1], carry[found[0]])

    return rows.mapInArrow(run, schema)


def numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def changes(*columns: np.ndarray) -> np.ndarray:
    """Whether each row but the first differs from the row before in some column; the first is True."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def ahead(batches: Batches) -> Iterator[tuple[pa.RecordBatch, pa.RecordBatch | None]]:
    """Each batch with the next."""
    now = next(batches, None)
    while now is not None:
        after = next(batches, None)
        yield now, after
        now = after


class Walk:
    """Batches of rows sorted by a key, with each row's place in its key's run and sums over the run up to each row."""

    def __init__(self, batches: Batches, key: str, state: tuple[Any, int, list[int]], after: Any = None):
        self.batches, self.key, self.after = batches, key, after
        self.open, self.n, self.sums = state[0], state[1], list(state[2])

    def __iter__(self) -> Iterator[pa.RecordBatch]:
        for b, following in ahead(self.batches):
            keys = numbers(b, self.key)
            self.starts = np.flatnonzero(changes(keys))
            self.sizes = np.diff(np.r_[self.starts, len(keys)])
            self.goes_on = self.open is not None and keys[0] == self.open
            self.place = np.arange(len(keys)) - np.repeat(self.starts, self.sizes)
            if self.goes_on:
                self.place[: self.sizes[0]] += self.n
            after = self.after if following is None else numbers(following, self.key)[0]
            #: Whether each row is followed by one of its run.
            self.followed = np.ones(len(keys), bool)
            self.followed[self.starts[1:] - 1] = False
            self.followed[-1] = after is not None and after == keys[-1]
            yield b
            self.open, self.n = keys[-1], int(self.place[-1]) + 1

    def running(self, which: int, values: np.ndarray) -> np.ndarray:
        """Sums modulo 2**64 of a run's values up to each row; called once a batch for each ``which``."""
        values = values.astype(np.uint64)
        total = np.cumsum(values, dtype=np.uint64)
        total -= np.repeat(total[self.starts] - values[self.starts], self.sizes)
        if self.goes_on:
            total[: self.sizes[0]] += np.uint64(self.sums[which])
        self.sums[which] = int(total[-1])
        return total


def run_notes(key: str, values: Callable[[pa.RecordBatch, np.ndarray], list[np.ndarray]], more: Callable[[pa.RecordBatch], Any] = lambda b: None) -> Callable[[Batches], Any]:
    """A note of a partition's first and last run of a key: [key, rows, sums of values(batch, place)]; and more of its first row."""

    def note(batches: Batches) -> Any:
        first, head = None, None
        walk = Walk(batches, key, (None, 0, [0] * 8))
        for b in walk:
            if head is None:
                head = more(b)
            sums = [walk.running(i, v) for i, v in enumerate(values(b, walk.place))]
            if first is None and walk.open is not None and not walk.goes_on:
                first = before
            elif first is None and len(walk.starts) > 1:
                at = walk.starts[1] - 1
                first = [numbers(b, key)[at], int(walk.place[at]) + 1, [int(s[at]) for s in sums]]
            before = [numbers(b, key)[-1], int(walk.place[-1]) + 1, [int(s[-1]) for s in sums]]
        return first or before, before, first is None, head

    return note


def run_states(notes: list[tuple[int, Any]], add: Callable[[int, int, int], int] = lambda n, a, b: a + b) -> dict[int, tuple[tuple, Any, Any]]:
    """For each partition the state of the run that is open where it begins, the key and the head of the next partition.

    add(rows before, sum before, sum of this partition) joins sums."""
    out, state = {}, (None, 0, [0] * 8)
    for i, (p, (first, last, single, _)) in enumerate(notes):
        following = notes[i + 1][1] if i + 1 < len(notes) else None
        out[p] = state, following and following[0][0], following and following[3]
        if first[0] == state[0]:
            first = [first[0], state[1] + first[1], [add(state[1], a, b) % (1 << 64) for a, b in zip(state[2], first[2], strict=False)]]
        state = tuple(first if single else last)
    return out
