"""Line dedup: lines whose key many documents have are dropped; what comes back is a bitmap for each document, not text.

A line's key is the line without spaces, tabs and other ASCII blanks at its ends, A-Z in lower case. Keys are told apart by
two 64-bit hashes. Rows (hash, document, place) are dealt by range and sorted by all of these, so a line that a third of
the corpus has spreads over many partitions. Each partition is streamed: where document or hash change, a first occurrence
begins, and a hash's first occurrences in documents are counted. Rows of a hash are held back only until its count
decides. A hash that goes over from one partition to the next is settled before: each partition notes its first and last
run, and the driver adds up these two notes for each partition.

Dropped places are grouped by document into a bitmap (bit i is 1 where line i stays; lines beyond its end stay),
compressed by zlib. Texts meet their bitmaps in one join.

A document is known by (doc_id, hash of its text). Defined cases: a null or empty text is one empty line; lines with an empty
key stay; wholly equal rows are one document and lose the same lines; null doc_ids are told apart by text; an empty table
gives an empty result; other columns aren't looked at; the order of rows is of no effect. With ``keep_first`` the first
occurrence, by doc_id (null first), hash of the text and place, stays.
"""

from __future__ import annotations

import hashlib
import string
import zlib
from itertools import chain
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, small_side, written
from .scans import Batches, carried, changes, noted, numbers, placed

#: Documents that must have a key for its lines to go, and code points that a key must have.
MIN_DOCS, MIN_CHARS = 10, 1
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _runs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Where a hash begins, and where a hash or a document begins."""
    ids = batch.column("doc_id").dictionary_encode(null_encoding="encode").indices.to_numpy()
    run = changes(numbers(batch, "h1"), numbers(batch, "h2"))
    return run, run | changes(ids, numbers(batch, "mark"))


def _at(batch: pa.RecordBatch, row: int, *names: str) -> tuple:
    return tuple(batch.column(n)[row].as_py() for n in names)


def _ends(batches: Batches) -> tuple[list, list]:
    """The partition's first and last run: [hash, documents, first document, last document]."""
    done, now = [], None
    for b in batches:
        run, doc = _runs(b)
        cuts = np.flatnonzero(run)
        pieces = [(cuts[0], cuts[1] if len(cuts) > 1 else b.num_rows)]
        if len(cuts) > 1:
            pieces.append((cuts[-1], b.num_rows))
        for lo, hi in pieces:
            key, first, last = _at(b, lo, "h1", "h2"), _at(b, lo, "doc_id", "mark"), _at(b, hi - 1, "doc_id", "mark")
            n = int(doc[lo:hi].sum())
            if now and now[0] == key:
                now[1] += n - (now[3] == first)
                now[3] = last
            else:
                if now and not done:
                    done.append(now)
                now = [key, n, first, last]
        if not done and len(cuts) > 2:  # the runs between aren't looked at, so the first one is over
            done.append(now)
    return (done[0] if done else now), now


def _spread(notes: list[tuple[int, tuple[list, list]]]) -> dict[int, tuple[dict, tuple | None]]:
    """For each partition the documents of the hashes that lie in more than one, and the hash that it goes on with."""
    total: dict[tuple, int] = {}
    last_doc, before, opened = None, None, {}
    for p, (first, last) in notes:
        opened[p] = first[0] if first[0] == before else None
        for i, (key, n, lo, hi) in enumerate((first, last)):
            if i and last is first or i and key == first[0]:
                continue
            if key == before:
                total[key] += n - (last_doc == lo)
            else:
                total[key] = n
            before, last_doc = key, hi
    return {p: ({x[0]: total[x[0]] for x in note}, opened[p]) for p, note in notes}


def _dropped(batches: Batches, carry: tuple[dict, tuple | None], least: int, keep_first: bool) -> Batches:
    """(doc_id, mark, place) of the lines that go."""
    sure, going_on = {k: n >= least for k, n in carry[0].items()}, carry[1]
    held: list[pa.RecordBatch] = []
    for b in chain(batches, [None]):  # None: what is held is all there is
        last = b is None
        if last and not held:
            return
        tab = pa.Table.from_batches([*held, *([] if last else [b])]).combine_chunks().to_batches()[0]
        run, doc = _runs(tab)
        cuts = np.flatnonzero(run)
        sizes = np.diff(np.r_[cuts, tab.num_rows])
        go = np.add.reduceat(doc.astype(np.int64), cuts) >= least
        end = _at(tab, len(run) - 1, "h1", "h2")
        for i in {0, len(cuts) - 1}:
            key = _at(tab, cuts[i], "h1", "h2")
            go[i] = sure.get(key, go[i])
        wait = not last and not go[-1] and end not in sure
        if go[-1]:
            sure[end] = True
        drop = np.repeat(go, sizes)
        if keep_first:
            stays = cuts[1:] if going_on == _at(tab, 0, "h1", "h2") else cuts
            drop[stays] = False
        going_on = None if wait else end
        held = [tab.slice(cuts[-1])] if wait else []
        rows = tab.filter(pa.array(drop))
        if rows.num_rows:
            yield pa.RecordBatch.from_arrays([rows.column(c) for c in ("doc_id", "mark", "place")], names=["doc_id", "mark", "place"])


def _pack(batches: Batches) -> Batches:
    for b in batches:
        maps = []
        for places in b.column("places").to_pylist():
            keep = np.ones((max(places) // 8 + 1) * 8, bool)
            keep[places] = False
            maps.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes()))
        counts = pa.array([len(x) for x in b.column("places").to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("mark"), counts, pa.array(maps, pa.binary())], names=["doc_id", "mark", "n_dropped", "bitmap"])


def unpack(bitmap: bytes, n_lines: int) -> np.ndarray:
    """Whether each of a document's lines stays."""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), bitorder="little")[:n_lines].astype(bool)
    return np.r_[bits, np.ones(n_lines - len(bits), bool)]


def bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep_first: bool = False) -> DataFrame:
    """doc_id, mark (hash of the text), n_dropped, bitmap of each document that loses a line."""
    each = docs.select("doc_id", F.xxhash64(_text()).alias("mark"), F.posexplode(F.split(_text(), "\n")).alias("place", "line"))
    keyed = each.select("doc_id", "mark", "place", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    lines = written(keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "mark", "place"), "lines")
    rows = placed(lines, "h1", "h2", "doc_id", "mark", "place")
    known = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, mark long"
    gone = carried(rows, lambda x, c: _dropped(x, c, min_docs, keep_first), f"{known}, place int", _spread(noted(rows, _ends)))
    places = gone.groupBy("doc_id", "mark").agg(F.collect_set("place").alias("places"))
    return written(places.mapInArrow(_pack, f"{known}, n_dropped long, bitmap binary"), "line-bitmaps")


def _kept(batches: Batches, keep: list[str], digest: bool) -> Batches:
    """The columns ``keep`` and, for each row, the text without its dropped lines or that text's sha256."""
    for b in batches:
        texts = []
        for text, bitmap in zip(b.column("_text").to_pylist(), b.column("_bitmap").to_pylist(), strict=True):
            if bitmap is not None:
                lines = text.split("\n")
                text = "\n".join([x for x, stays in zip(lines, unpack(bitmap, len(lines)).tolist(), strict=True) if stays])
            texts.append(hashlib.sha256(text.encode()).hexdigest() if digest else text)
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(texts, pa.string())], names=[*keep, "kept_sha256" if digest else "_kept"])


def _beside(mine: DataFrame, found: DataFrame) -> DataFrame:
    """mine (with _id, _mark) with _bitmap and _dropped, null where nothing goes."""
    own = found.select(F.col("doc_id").alias("_i"), F.col("mark").alias("_m"), F.col("bitmap").alias("_bitmap"), F.col("n_dropped").alias("_dropped"))
    return mine.join(small_side(own), F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_mark") == F.col("_m")), "left").drop("_i", "_m")


def digests(docs: DataFrame, **how: Any) -> DataFrame:
    """doc_id, n_lines, n_dropped, bitmap, kept_sha256 of every row of docs."""
    found = bitmaps(docs, **how)
    mine = docs.select(F.col("doc_id").alias("_id"), F.xxhash64(_text()).alias("_mark"), _text().alias("_text"))
    lines = F.char_length("_text") - F.char_length(F.translate("_text", "\n", "")) + 1
    both = _beside(mine, found).select(F.col("_id").alias("doc_id"), lines.cast("long").alias("n_lines"), F.coalesce("_dropped", F.lit(0)).cast("long").alias("n_dropped"), F.col("_bitmap").alias("bitmap"), "_text", "_bitmap")
    known = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_lines long, n_dropped long, bitmap binary"
    return both.mapInArrow(lambda x: _kept(x, ["doc_id", "n_lines", "n_dropped", "bitmap"], True), f"{known}, kept_sha256 string")


def dedup(docs: DataFrame, **how: Any) -> DataFrame:
    """docs with the dropped lines cut out of ``text``; texts that lose none stay as they are, null too."""
    mine = packed(docs, _id=F.col("doc_id"), _mark=F.xxhash64(_text()), _text=_text())
    both = _beside(mine, bitmaps(docs, **how)).select("row", (F.col("_bitmap").isNull()).alias("_whole"), "_text", "_bitmap")
    out = both.mapInArrow(lambda x: _kept(x, ["row", "_whole"], False), f"row {docs.schema.simpleString()}, _whole boolean, _kept string")
    text = F.when(F.col("_whole"), F.col("row.text")).otherwise(F.col("_kept"))
    return out.select(*((text if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
