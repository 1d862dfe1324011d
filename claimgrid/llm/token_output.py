"""Token-ID output as Arrow files of equal-length sequences.

Documents are range-partitioned and sorted by doc_id. A task encodes its texts, appends the end id and packs the ids into
rows of ``length`` tokens; it writes them as an Arrow IPC file whose batches hold two fixed-size lists: ``ids`` and ``mask``
(a byte each: 1, and 0 on the padding that fills a file's last row). Masks are a dictionary, written once a file: entry k has k
ones. Batches have equal row counts, so row r lies in batch r // rows at r % rows, and a memory map gives its ids and mask
without a copy. A second file has each document's id, start and length. File names carry the attempt; only files named in the manifest, which finished tasks return, belong to the
output, so repeated or lost tasks do no harm, and files of other attempts are removed in the end.

Where the tokenizer's own file says that it lower-cases, drops white space and closes words by a suffix, words between ASCII
white space are encoded once and remembered by each Python worker, from task to task, in small letters: none of its rules
reach across white space, so a text's ids are those of its words in turn. With any other tokenizer whole texts are encoded.

Defined cases: a null text is empty and yields the end id alone; equal doc_ids are ordered by text hash; a null doc_id comes
first; doc_id may be of any type that has an order; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import shared_path, split_words

END_ID, LENGTH, ROWS = 2, 1024, 256
#: Words whose ids a Python worker remembers, and words of texts it looks at together.
REMEMBER, WORDS_AT_ONCE = 600_000, 200_000
#: The module that holds a worker's encoder between tasks.
KEPT = "_claimgrid_token_output"


# The normalizers and the split of a tokenizer whose words can be encoded one by one.
_NORMALIZERS = ("NFC", "Replace", "Lowercase")
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: ASCII characters that are neither letters nor numbers.
_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: The first of some marks after a letter or digit of ASCII or a small letter of Latin-1: a new piece begins there.
_FIRST_MARK = re.compile(rb"[!-/:-@\[-`{-~](?:(?<=[a-z0-9].)|(?<=\xc3[\x9f-\xb6\xb8-\xbf].))", re.S)


def _ends_in_letter(word: bytes) -> bool:
    """Whether a word's last character is a letter from A to z or a small one of Latin-1, which stays one in any normal form."""
    return word[-1:].isalpha() or (word[-2:-1] == b"\xc3" and 0x9F <= word[-1] != 0xB7)


def splits_at_spaces(config: dict) -> bool:
    """Whether a tokenizer's file says that it lower-cases, folds white space, drops it and closes each piece by a suffix."""
    normalizers = (config.get("normalizer") or {}).get("normalizers") or []
    splits = (config.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    model, folds = config.get("model") or {}, [n for n in normalizers if n["type"] == "Replace"]
    return (
        tuple(n["type"] for n in normalizers) == _NORMALIZERS
        and [(n["pattern"], n["content"]) for n in folds] == [({"Regex": r"\s+"}, " ")]
        and [x.get("type") for x in splits] == ["Split", "ByteLevel"]
        and (splits[0]["pattern"], splits[0]["behavior"], splits[0]["invert"]) == ({"Regex": _SPLIT}, "Removed", True)
        and not splits[1]["add_prefix_space"]
        and (model.get("type"), model.get("end_of_word_suffix"), model.get("dropout")) == ("BPE", "</w>", None)
        and all(t["content"].startswith("<|") for t in config.get("added_tokens") or [])
    )


def facts(path: str) -> tuple[bool, np.ndarray]:
    """Of a tokenizer's file, once for all tasks: whether words can be encoded one by one, and which ids close a word."""
    with open(path, encoding="utf-8") as f:
        config = json.load(f)
    vocab = config["model"].get("vocab", {})
    vocab = vocab if isinstance(vocab, dict) else {x[0]: i for i, x in enumerate(vocab)}
    closes = np.zeros(1 + max([*vocab.values(), *(t["id"] for t in config.get("added_tokens") or [])], default=0), bool)
    closes[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
    return splits_at_spaces(config), closes


class Encoder:
    """ids of whole texts as little-endian bytes of ``dtype``."""

    def __init__(self, path: str, known: tuple[bool, np.ndarray] | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_word, self.closes = known or facts(path)
        self.dtype = np.dtype("<u2" if len(self.closes) <= 1 << 16 else "<u4")
        self.batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    @classmethod
    def of_worker(cls, path: str, known: tuple[bool, np.ndarray]) -> Encoder:
        """An encoder with what this Python worker's earlier tasks learned from the same file. It lies in a module of its own
        name, as this package's own globals come anew with each task."""
        kept = vars(sys.modules.setdefault(KEPT, types.ModuleType(KEPT)))
        stat = os.stat(path)
        file = (path, stat.st_ino, stat.st_mtime_ns, stat.st_size)
        if kept.get("file") != file:
            kept.update(file=file, encoder=cls(path, known))
        encoder = kept["encoder"]
        encoder.__class__ = cls
        return encoder

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.batch(texts, add_special_tokens=False)]

    def learn(self, words: list[bytes]) -> None:
        """Words of letters are encoded many at a time: each ends with the one token that closes a word. Of other words the
        marks after a last letter are a piece of their own, so they and what is before them are learned instead."""
        known, kind = self.known, self.dtype
        tails, parts = [], []
        for w in words:
            stem = w.rstrip(_MARKS)
            if len(stem) < len(w) and _ends_in_letter(stem) and b"<|" not in w:
                tails.append((w, stem, w[len(stem) :]))
                parts += tails[-1][1:]
        ended = {w for w, _, _ in tails}
        new = [w for w in dict.fromkeys([*words, *parts]) if w not in known and w not in ended]
        plain, other = [], []
        for w, text in zip(new, b"\n".join(new).decode().split("\n"), strict=True):
            (plain if text.isalpha() else other).append(w)
        for i in range(0, len(plain), 4000):
            some = plain[i : i + 4000]
            ids = np.array(self._ids([b" ".join(some).decode()])[0], kind)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(some):  # a word of letters closes at least once, so here each does so once
                flat, cuts = ids.tobytes(), (ends * kind.itemsize).tolist()
                known.update(zip(some, map(flat.__getitem__, map(slice, [0, *cuts[:-1]], cuts)), strict=True))
            else:
                other += some
        for i in range(0, len(other), 4096):
            some = other[i : i + 4096]
            for w, ids in zip(some, self._ids([w.decode() for w in some]), strict=True):
                known[w] = np.array(ids, kind).tobytes()
        for w, stem, tail in tails:
            known[w] = known[stem] + known[tail]

    def many(self, raws: list[bytes | None]) -> Iterator[bytes]:
        """ids of each text, learning new words of many texts at once."""
        if not self.by_word:
            for raw in raws:
                yield np.array(self._ids([(raw or b"").decode()])[0], self.dtype).tobytes()
            return
        split, n = [], 0
        for raw in raws:
            # Capitals and small letters have the same ids, but for the tokenizer's special strings, and so have marks after a
            # letter that stand by themselves, as they are a piece of their own.
            split.append(split_words(raw if raw is None or b"<|" in raw else _FIRST_MARK.sub(rb" \g<0>", raw.lower())))
            n += len(split[-1])
            if n > WORDS_AT_ONCE:
                yield from self._some(split)
                split, n = [], 0
        yield from self._some(split)

    def _some(self, split: list[list[bytes]]) -> Iterator[bytes]:
        """The new words of some texts are learned together. Of two halves of what is remembered the older goes when the other
        is full; its words that are met again before are taken over, so frequent ones stay."""
        every = set().union(*split)
        new = every.difference(self.known)
        if len(self.known) + len(new) > REMEMBER // 2:
            self.older, self.known, new = self.known, {}, every
        known, older = self.known, self.older
        again = older.keys() & new
        known.update(zip(again, map(older.__getitem__, again), strict=True))
        if len(again) < len(new):
            self.learn(list(new.difference(again)))
        for words in split:
            yield b"".join(map(known.__getitem__, words))


def _masks(length: int) -> pa.Array:
    """For each number of real tokens, from 0 to length, the mask of a row."""
    return pa.FixedSizeListArray.from_arrays(pa.array(np.tri(length + 1, length, -1, np.uint8).ravel()), length)


def _schema(dtype: np.dtype, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.dictionary(pa.int32(), pa.list_(pa.uint8(), length)))])


def _pack(flat: np.ndarray, real: int, length: int, schema: pa.Schema, masks: pa.Array) -> pa.RecordBatch:
    own = np.clip(real - np.arange(0, len(flat), length), 0, length).astype(np.int32)
    lists = [pa.FixedSizeListArray.from_arrays(pa.array(flat), length), pa.DictionaryArray.from_arrays(pa.array(own), masks)]
    return pa.RecordBatch.from_arrays(lists, schema=schema)


def _index(kind: pa.DataType) -> pa.Schema:
    return pa.schema([("doc_id", kind), ("start", pa.int64()), ("n_tokens", pa.int64())])


def write(docs: DataFrame, out: str, tokenizer: str, end_id: int = END_ID, length: int = LENGTH, rows: int = ROWS) -> list[tuple]:
    """Writes docs under the URI out; the manifest: (file, index file, first token's place, tokens), in order."""
    kind, known = to_arrow_type(docs.schema["doc_id"].dataType), facts(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of_worker(tokenizer, known)
        fs, base = pa.fs.FileSystem.from_uri(out)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        schema, masks, index_schema, end = _schema(encoder.dtype, length), _masks(length), _index(kind), np.array([end_id], encoder.dtype).tobytes()
        step, place, held = length * rows * encoder.dtype.itemsize, 0, bytearray()
        fs.create_dir(base, recursive=True)
        with fs.open_output_stream(f"{base}/{name}.arrow") as sink, fs.open_output_stream(f"{base}/{name}.index.arrow") as index_sink, pa.ipc.new_file(sink, schema) as writer, pa.ipc.new_file(index_sink, index_schema) as index:
            for b in batches:
                sizes = []
                for ids in encoder.many(b.column(1).to_pylist()):
                    held += ids
                    held += end
                    sizes.append(len(ids) // encoder.dtype.itemsize + 1)
                    while len(held) >= step:
                        writer.write_batch(_pack(np.frombuffer(bytes(held[:step]), encoder.dtype), length * rows, length, schema, masks))
                        del held[:step]
                ends = place + np.cumsum(np.array(sizes, np.int64))
                index.write_batch(pa.RecordBatch.from_arrays([b.column(0).cast(kind), pa.array(ends - sizes), pa.array(sizes, pa.int64())], schema=index_schema))
                place = int(ends[-1]) if sizes else place
            if held:
                flat = np.frombuffer(bytes(held), encoder.dtype)
                writer.write_batch(_pack(np.concatenate([flat, np.zeros(-len(flat) % length, encoder.dtype)]), len(flat), length, schema, masks))
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([name]), pa.array([place], pa.int64())], names=["part", "name", "tokens"])

    some = docs.select("doc_id", F.col("text").cast("binary").alias("raw"))
    order = ["doc_id", F.xxhash64("raw")]
    done = some.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, "part int, name string, tokens long").collect()  # a row for each file
    manifest, place = [], 0
    _remove_others(out, {name for _, name, tokens in done if tokens})
    for _, name, tokens in sorted(done):
        if tokens:
            manifest.append((f"{out}/{name}.arrow", f"{out}/{name}.index.arrow", place, tokens))
            place += tokens
    return manifest


def _remove_others(out: str, names: set[str]) -> None:
    """Files of empty partitions and of attempts that didn't finish."""
    fs, base = pa.fs.FileSystem.from_uri(out)
    for info in fs.get_file_info(pa.fs.FileSelector(base, allow_not_found=True)):
        if info.base_name.split(".")[0] not in names:
            fs.delete_file(info.path)


def opened(uri: str) -> pa.ipc.RecordBatchFileReader:
    """A file as it lies, mapped into memory if the store is a local or mounted folder."""
    fs, path = pa.fs.FileSystem.from_uri(uri)
    return pa.ipc.open_file(pa.memory_map(path) if isinstance(fs, pa.fs.LocalFileSystem) else fs.open_input_file(path))


def sequence(reader: pa.ipc.RecordBatchFileReader, row: int, rows: int = ROWS) -> tuple[np.ndarray, np.ndarray]:
    """ids and mask of one sequence, by its row in the file: views of the file's own bytes."""
    batch = reader.get_batch(row // rows)
    ids, mask = batch.column(0), batch.column(1)
    n, at = ids.type.list_size, row % rows
    return ids.flatten().slice(at * n, n).to_numpy(), mask.dictionary.flatten().slice(mask.indices[at].as_py() * n, n).to_numpy()


class Stream:
    """The tokens of a file, read forwards batch by batch."""

    def __init__(self, uri: str):
        self.reader, self.next, self.flat, self.first = opened(uri), 0, np.empty(0, np.uint16), 0

    def pieces(self, start: int, n: int) -> Iterator[np.ndarray]:
        while n:
            while start >= self.first + len(self.flat):
                self.first += len(self.flat)
                self.flat = self.reader.get_batch(self.next).column(0).flatten().to_numpy()
                self.next += 1
            piece = self.flat[start - self.first : start - self.first + n]
            yield piece
            start, n = start + len(piece), n - len(piece)


def read(spark, manifest: list[tuple], kind: str = "long") -> DataFrame:
    """doc_id (of the type kind), start, n_tokens, ids_crc32 of every document, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for uri, index_uri, place in zip(*(files.column(i).to_pylist() for i in range(3)), strict=True):
                stream, index = Stream(uri), opened(index_uri)
                for i in range(index.num_record_batches):
                    b = index.get_batch(i)
                    sums = []
                    for start, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                        crc = 0
                        for piece in stream.pieces(start, n):
                            crc = zlib.crc32(piece.astype("<u4").tobytes(), crc)
                        sums.append(crc)
                    yield pa.RecordBatch.from_arrays([b.column(0), pa.array(b.column(1).to_numpy() + place), b.column(2), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = spark.createDataFrame(manifest or [("", "", 0, 0)], "file string, idx string, place long, tokens long").where("tokens > 0")
    return files.repartition(max(1, len(manifest)), "file").mapInArrow(lambda x: run(b.select(["file", "idx", "place"]) for b in x), f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def tokenized(docs: DataFrame, tokenizer: str, **how) -> DataFrame:
    """Writes docs to a new place in the shared folder and reads the files back."""
    spark = docs.sparkSession
    return read(spark, write(docs, shared_path(spark, "tokens"), tokenizer, **how), docs.schema["doc_id"].dataType.simpleString())
