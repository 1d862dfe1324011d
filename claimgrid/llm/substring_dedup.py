"""Substring dedup: words inside long passages that an earlier document also has are removed.

Level-wise doubling. Levels are window lengths, each twice the one below (13, 25 and 50 words for passages of 50). At a level
only windows are looked at whose halves survived the level below, and of these only the ones with the least hash within
some window of the level above: equal windows choose equal halves, so none is missed, and about one word in seven gives
a row at the first level. Windows that no other document has at this length drop out; the others are extended to
twice the length. The levels end where nothing survives, or at whole windows, which are named by their half's 64-bit hash and
a second 64-bit hash of their own. A whole window that a document with a smaller doc_id also has is repeated and its words
go: every longer repeat is covered by repeated whole windows.

Equal whole windows lie around equal halves, so a half's hash deals them to a task. Before that, each batch of documents
settles what it can by itself and sends a window only for its earliest document. Windows around a half that very many
documents share (a common line between different texts) are dealt by half and whole together, so such a passage makes
one small row for each batch of documents in the task of each of its windows, whatever the number of documents.

A document is known by (doc_id, checksum of its text). Defined cases: a null text has no words; documents under 50 words
keep all; rows with an equal doc_id don't remove each other's words; a row with a null doc_id keeps all words and counts as
no earlier document; doc_id may be of any type that has an order; the order of rows is of no effect; an empty table gives
an empty result; other columns aren't looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, small_side, split_words, written

WINDOW = 50
#: Length up to which windows aren't halved any more.
SHORTEST = 16
_U = np.uint64
_BASE = {1: 0x9E3779B97F4A7C15 | 1, 2: 0xC2B2AE3D27D4EB4F | 1}
#: Occurrences above which a half window counts as hot; there are at most the words of the corpus divided by this.
HOT = 2000
#: Words whose hashes a task remembers.
REMEMBER = 500_000


def _finish(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    x = (x ^ (x >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


class Hasher:
    """Hashes of all windows of a word sequence, by differences of prefix sums modulo 2**64."""

    def __init__(self, which: int):
        self.base, self.inverse = _BASE[which], pow(_BASE[which], -1, 1 << 64)
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def windows(self, h: np.ndarray, length: int) -> np.ndarray:
        n = len(h)
        with np.errstate(over="ignore"):
            if n > len(self.up):
                self.up = np.cumprod(np.r_[_U(1), np.full(2 * n, self.base, np.uint64)], dtype=np.uint64)
                self.down = np.cumprod(np.r_[_U(1), np.full(2 * n, self.inverse, np.uint64)], dtype=np.uint64)
            sums = np.r_[_U(0), np.cumsum(h * self.up[:n], dtype=np.uint64)]
            return _finish((sums[length:] - sums[:-length]) * self.down[: n - length + 1])


class Words:
    """64-bit hashes of words, remembered for the most recent."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known, digest = self.known, xxhash.xxh64_intdigest
        if len(known) > REMEMBER:
            known.clear()
        out = [known.get(w) for w in words]
        if None in out:
            for i, x in enumerate(out):
                if x is None:
                    out[i] = known[words[i]] = digest(words[i])
        return np.array(out, np.uint64)


def chosen(half: np.ndarray, window: int, size: int) -> np.ndarray:
    """For each whole window the place of the least hash among its half windows, the first if equal."""
    around = np.lib.stride_tricks.sliding_window_view(half, window - size + 1)
    return around.argmin(axis=1) + np.arange(len(around))


def level_lengths(window: int, shortest: int = SHORTEST) -> list[int]:
    """Window lengths from the least to ``window``, at least two, each covered by two windows of the one before."""
    out = [window]
    while out[0] > shortest or len(out) < 2:
        out.insert(0, -(-out[0] // 2))
    return out


def _lists(ids: pa.Array, marks: pa.Array, found: list[tuple[np.ndarray, np.ndarray]], **more: pa.Array) -> pa.RecordBatch:
    halves, places = [x.view(np.int64) for x, _ in found], [x.astype(np.int32) for _, x in found]
    columns = {"doc_id": ids, "mark": marks, **more, "half": pa.array(halves, pa.list_(pa.int64())), "at": pa.array(places, pa.list_(pa.int32()))}
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


_NONE = (np.empty(0, np.uint64), np.empty(0, np.int64))


def _first_rows(batches: Iterator[pa.RecordBatch], lengths: list[int]) -> Iterator[pa.RecordBatch]:
    """What each document is, and its windows of the first level."""
    hasher, word_hashes = Hasher(1), Words()
    for b in batches:
        n_words, digests, found = [], [], []
        for doc_id, raw in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
            words = split_words(raw)
            n_words.append(len(words))
            digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
            if doc_id is None or len(words) < lengths[-1]:
                found.append(_NONE)
                continue
            half = hasher.windows(word_hashes(words), lengths[0])
            at = np.unique(chosen(half, lengths[1], lengths[0]))
            found.append((half[at], at))
        yield _lists(b.column(0), b.column(1), found, n_words=pa.array(n_words, pa.int64()), sha256=pa.array(digests))


def _next_rows(batches: Iterator[pa.RecordBatch], lengths: list[int]) -> Iterator[pa.RecordBatch]:
    """From places ``at`` that survive at lengths[0], the windows of lengths[1] to look at for those of lengths[2]."""
    small, middle, large = lengths
    hasher, word_hashes = Hasher(1), Words()
    for b in batches:
        found = []
        for raw, at in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
            h = word_hashes(split_words(raw))
            dead = ~np.isin(chosen(hasher.windows(h, small), middle, small), at)
            # A large window is alive if all middle ones in it are.
            within = np.r_[0, np.cumsum(dead)]
            alive = within[large - middle + 1 :] == within[: -(large - middle + 1)]
            half = hasher.windows(h, middle)
            places = np.unique(chosen(half, large, middle)[alive])
            found.append((half[places], places))
        yield _lists(b.column(0), b.column(1), found)


def _whole_rows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Windows around surviving halves, whose places are inverted (below 0) if hot. settled: repeated already within the
    batch; else to be compared by half, or by half and whole if hot."""
    size, first, second, word_hashes = -(-window // 2), Hasher(1), Hasher(2), Words()
    for b in batches:
        ids = _ranks(b.column(0))
        part: dict[str, list[np.ndarray]] = {k: [] for k in ("half", "whole", "place", "row")}
        for i, (raw, at) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)):
            h = word_hashes(split_words(raw))
            half = first.windows(h, size)
            choice = chosen(half, window, size)
            at = np.array(at)
            place = np.flatnonzero(np.isin(choice, np.where(at < 0, ~at, at)))
            key, whole = half[choice[place]], second.windows(h, window)[place]
            # For equal wholes the key of a hot half tells halves apart as well as the half itself.
            part["half"].append(np.where(np.isin(choice[place], ~at[at < 0]), _finish(key ^ whole), key))
            part["whole"].append(whole)
            part["place"].append(place)
            part["row"].append(np.full(len(place), i))
        if not part["half"]:
            continue
        half, whole, place, row = (np.concatenate(part[k]) for k in ("half", "whole", "place", "row"))
        if not len(half):
            continue
        order = np.lexsort((ids[row], whole, half))
        half, whole, place, row = half[order], whole[order], place[order], row[order]
        new = np.r_[True, (half[1:] != half[:-1]) | (whole[1:] != whole[:-1])]
        least = ids[row][np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        settled = ids[row] > least
        yield _packed(b.column(0), b.column(1), half, whole, place, row, settled)


def _ranks(ids: pa.Array) -> np.ndarray:
    """Numbers in the order of ids."""
    return np.unique(ids.to_numpy(zero_copy_only=False), return_inverse=True)[1]


def _packed(ids: pa.Array, marks: pa.Array, half, whole, place, row, settled) -> pa.RecordBatch:
    """A row for each (document, half) with its windows; a row for each document with its settled windows."""
    half = np.where(settled, _U(0), half)
    order = np.lexsort((place, half, row, settled))
    half, whole, place, row, settled = half[order], whole[order], place[order], row[order], settled[order]
    starts = np.flatnonzero(np.r_[True, (half[1:] != half[:-1]) | (row[1:] != row[:-1]) | (settled[1:] != settled[:-1])])
    cuts = pa.array(np.r_[starts, len(half)].astype(np.int32))
    own = pa.array(row[starts])
    whole = pa.array(np.where(settled, _U(0), whole).view(np.int64))
    key = np.where(settled[starts], _U(0), half[starts]).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(settled[starts]), pa.array(key), ids.take(own), marks.take(own), pa.ListArray.from_arrays(cuts, whole), pa.ListArray.from_arrays(cuts, pa.array(place.astype(np.int32)))], names=["settled", "half", "doc_id", "mark", "whole", "place"])


def _compare_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by half, settled ones as they are; repeated places go out by document."""
    names = ["doc_id", "mark", "place"]

    def repeated(tab: pa.Table) -> pa.RecordBatch:
        tab = tab.combine_chunks()
        lists = tab.column("whole").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        row = np.repeat(np.arange(len(sizes)), sizes)
        whole, place = lists.flatten().to_numpy(), tab.column("place").combine_chunks().flatten().to_numpy()
        ids, half = _ranks(tab.column("doc_id").combine_chunks()), tab.column("half").to_numpy()
        order = np.lexsort((ids[row], whole, half[row]))
        r, w = row[order], whole[order]
        new = np.r_[True, (w[1:] != w[:-1]) | (half[r][1:] != half[r][:-1])]
        least = ids[r][np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        keep = tab.column("settled").to_numpy()[row]
        keep[order] |= ids[r] > least
        row, place = row[keep], place[keep]
        sizes = np.bincount(row, minlength=len(sizes))
        some = np.flatnonzero(sizes)
        cuts = np.r_[0, np.cumsum(sizes[some])].astype(np.int32)
        own = [tab.column(c).combine_chunks().take(pa.array(some)) for c in ("doc_id", "mark")]
        return pa.RecordBatch.from_arrays([*own, pa.ListArray.from_arrays(pa.array(cuts), pa.array(place))], names=names)

    held, rows = [], 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows >= 20_000:
            tab = pa.Table.from_batches(held)
            half = tab.column("half").to_numpy()
            cut = int(np.searchsorted(half, half[-1]))  # the last half may go on
            if cut:
                yield repeated(tab.slice(0, cut))
                held, rows = tab.slice(cut).combine_chunks().to_batches(), tab.num_rows - cut
    if rows:
        yield repeated(pa.Table.from_batches(held))


def _kept_rows(batches: Iterator[pa.RecordBatch], window: int, text: bool) -> Iterator[pa.RecordBatch]:
    """What stays of each text: the text itself, or its sha256 alone."""
    for b in batches:
        removed, kept = [], []
        for raw, places in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
            words = split_words(raw)
            depth = np.zeros(len(words) + 1, np.int32)
            at = np.unique(np.concatenate([np.asarray(x, np.int64) for x in places]))
            depth[at] += 1
            depth[at + window] -= 1
            out = np.cumsum(depth)[:-1] > 0
            removed.append(int(out.sum()))
            left = b" ".join([w for w, gone in zip(words, out.tolist(), strict=True) if not gone])
            kept.append(left.decode() if text else hashlib.sha256(left).hexdigest())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "mark", "n_removed", "kept"])


def _marked(docs: DataFrame) -> DataFrame:
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select("doc_id", F.crc32(raw).alias("mark"), raw.alias("raw"))


def _survivors(found: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, mark, at) of the documents' windows that another document has too, and (half, n) of these windows.

    found: doc_id, mark, and arrays ``half`` and ``at``. Windows with over ``most`` occurrences are few: they are told
    apart without a shuffle, so no task gets all their rows, and their places are inverted (below 0).
    """
    rows = found.select("doc_id", "mark", F.inline(F.arrays_zip("half", "at")))
    twice = rows.groupBy("half").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n")).where("lo < hi").select("half", "n")
    twice = written(twice, "substring-twice")
    hot = small_side(twice.where(F.col("n") > most).select("half"))
    seldom = rows.join(hot, "half", "left_anti").join(twice.where(F.col("n") <= most).select("half"), "half", "left_semi")
    common = rows.join(hot, "half", "left_semi").withColumn("at", F.bitwise_not("at"))
    alive = common.unionByName(seldom).groupBy("doc_id", "mark").agg(F.collect_set("at").alias("at"))
    return written(alive, "substring-alive"), twice


def cleaned(docs: DataFrame, window: int = WINDOW, most: int = HOT, shortest: int = SHORTEST, report: list[tuple[int, int, int]] | None = None, text: bool = True) -> tuple[DataFrame, DataFrame]:
    """What every document is, and the documents that lose words.

    The first: doc_id, mark, n_words, sha256 of all words, one row for each row of docs. The second: doc_id, mark,
    n_removed, kept (the kept words, joined by a space; without ``text`` their sha256, so that no text leaves its task), one row
    for each (doc_id, mark) with a repeated window.
    Halves with over ``most`` occurrences are dealt as hot, which is of no effect on the result. report takes, for each
    level below whole windows, its length, the different windows that survive it and how often they occur.
    """
    lengths, marked = level_lengths(window, shortest), _marked(docs)
    known = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, mark long"
    first = written(marked.mapInArrow(lambda x: _first_rows(x, lengths), f"{known}, n_words long, sha256 string, half array<long>, at array<int>"), "substring-first")
    summary, found = first.select("doc_id", "mark", "n_words", "sha256"), first
    for i in range(len(lengths) - 1):
        alive, twice = _survivors(found, most)
        if report is not None:
            report.append((lengths[i], *twice.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()))
        if alive.isEmpty():
            return summary, docs.sparkSession.createDataFrame([], f"{known}, n_removed long, kept string")
        some = marked.join(small_side(alive.select("doc_id", "mark")), ["doc_id", "mark"], "left_semi")
        both = some.join(alive, ["doc_id", "mark"])
        if i < len(lengths) - 2:
            three, plain = lengths[i : i + 3], F.transform("at", lambda x: F.when(x < 0, F.bitwise_not(x)).otherwise(x))
            found = written(both.withColumn("at", plain).mapInArrow(lambda x, three=three: _next_rows(x, three), f"{known}, half array<long>, at array<int>"), "substring-next")
    whole = both.mapInArrow(lambda x: _whole_rows(x, window), f"settled boolean, half long, {known}, whole array<long>, place array<int>")
    deal = F.when(F.col("settled"), F.xxhash64("doc_id", "mark")).otherwise(F.col("half"))
    dealt = whole.withColumn("half", deal).repartition("half").sortWithinPartitions("half")
    gone = dealt.mapInArrow(_compare_rows, f"{known}, place array<int>")
    gone = gone.groupBy("doc_id", "mark").agg(F.collect_set("place").alias("places"))
    lost = some.join(gone, ["doc_id", "mark"]).mapInArrow(lambda x: _kept_rows(x, window, text), f"{known}, n_removed long, kept string")
    return summary, lost.dropDuplicates(["doc_id", "mark"])


def digests(docs: DataFrame, window: int = WINDOW, most: int = HOT, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row of docs."""
    whole, lost = cleaned(docs, window, most, shortest, text=False)
    lost = lost.withColumnRenamed("kept", "kept_sha256")
    out = whole.join(lost, ["doc_id", "mark"], "left")
    return out.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("kept_sha256", "sha256").alias("kept_sha256"))


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs with repeated passages cut out of ``text``; texts without any stay as they are."""
    _, lost = cleaned(docs, window)
    mine = packed(docs, doc_id=F.col("doc_id"), mark=F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    out = mine.join(lost.select("doc_id", "mark", "kept"), ["doc_id", "mark"], "left")
    column = lambda c: F.coalesce("kept", "row.text").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c)
    return out.select(*(column(c) for c in docs.columns))
