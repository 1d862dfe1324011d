"""Annotation databases in BSON as a Spark data source: one document a file, whose top-level fields are rows (key, json).

``spark.read.format("bson").load(path)`` and ``df.write.format("bson").save(path)``, once ``register`` was called. A path is a
file, a folder of ``.bson`` files or a pattern, on a file system that driver and executors mount. Reading, a first pass
goes over the top-level lengths of each file, seeking past every value, and cuts partitions of about ``partitionBytes`` at
fields; tasks then read their stretch field by field. A file ends where it ends, whatever its 32-bit length says, so it
may be larger than that can say. Writing, each task writes files of at most ``fileBytes`` whose keys are sorted at every level,
under names of their own; the driver renames the files of committed tasks alone, so lost and repeated tasks leave nothing.

With the option ``compression`` (gzip or zstd) files end in ``.bson.gz`` or ``.bson.zst``, as dumps of databases do. Readers know
them by that. Such a file is read by one task, so ``fileBytes``, which counts what isn't compressed, should be small.
"""

from __future__ import annotations

import base64
import glob
import json
import math
import os
import shutil
import struct
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any, BinaryIO

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

#: Rows of a batch.
ROWS = 5000
# Bytes of a value by its type, where that is fixed; types that begin with the length of what follows it (and
# how many bytes follow in addition); types whose length counts itself.
FIXED = {0x01: 8, 0x06: 0, 0x07: 12, 0x08: 1, 0x09: 8, 0x0A: 0, 0x10: 4, 0x11: 8, 0x12: 8, 0x13: 16, 0x7F: 0, 0xFF: 0}
COUNTED = {0x02: 0, 0x05: 1, 0x0C: 12, 0x0D: 0, 0x0E: 0}
WHOLE = (0x03, 0x04, 0x0F)
REGEX = 0x0B
#: Endings of files by their compression.
ENDINGS = {"none": ".bson", "gzip": ".bson.gz", "zstd": ".bson.zst"}
#: Bytes of a compressed file's content that a task holds in memory; what is larger lies in its temporary folder meanwhile.
HELD = 128 << 20


class UnknownBson(ValueError):
    """A type that BSON doesn't have."""


def _unknown(kind: int, name: str) -> UnknownBson:
    return UnknownBson(f"field {name!r} has the type 0x{kind:02x}, which BSON doesn't have")


def _text(raw: bytes, at: int) -> tuple[str, int]:
    end = raw.index(0, at)
    return raw[at:end].decode(), end + 1


def value(kind: int, raw: bytes, at: int, name: str = "") -> tuple[Any, int]:
    """The value of a field as JSON can say it (extended forms with a "$" for what it can't), and where it ends."""
    if kind == 0x01:
        number = struct.unpack_from("<d", raw, at)[0]
        return (number if math.isfinite(number) else {"$numberDouble": str(number)}), at + 8
    if kind in (0x02, 0x0D, 0x0E):
        size = struct.unpack_from("<i", raw, at)[0]
        return raw[at + 4 : at + 3 + size].decode(), at + 4 + size
    if kind in (0x03, 0x04):
        own = dict(fields(raw, at))
        return (own if kind == 0x03 else list(own.values())), at + struct.unpack_from("<i", raw, at)[0]
    if kind == 0x05:
        size, sub = struct.unpack_from("<iB", raw, at)
        return {"$binary": {"base64": base64.b64encode(raw[at + 5 : at + 5 + size]).decode(), "subType": f"{sub:02x}"}}, at + 5 + size
    if kind in (0x06, 0x0A):
        return None, at
    if kind == 0x07:
        return {"$oid": raw[at : at + 12].hex()}, at + 12
    if kind == 0x08:
        return raw[at] == 1, at + 1
    if kind in (0x09, 0x12):
        return struct.unpack_from("<q", raw, at)[0], at + 8
    if kind == REGEX:
        pattern, at = _text(raw, at)
        options, at = _text(raw, at)
        return {"$regularExpression": {"pattern": pattern, "options": options}}, at
    if kind == 0x0C:
        size = struct.unpack_from("<i", raw, at)[0]
        end = at + 4 + size
        return {"$dbPointer": {"$ref": raw[at + 4 : end - 1].decode(), "$id": {"$oid": raw[end : end + 12].hex()}}}, end + 12
    if kind == 0x0F:
        size, code = struct.unpack_from("<ii", raw, at)
        return {"$code": raw[at + 8 : at + 7 + code].decode(), "$scope": dict(fields(raw, at + 8 + code))}, at + size
    if kind == 0x10:
        return struct.unpack_from("<i", raw, at)[0], at + 4
    if kind == 0x11:
        i, t = struct.unpack_from("<II", raw, at)
        return {"$timestamp": {"t": t, "i": i}}, at + 8
    if kind == 0x13:
        return {"$numberDecimalBytes": raw[at : at + 16].hex()}, at + 16
    if kind in (0x7F, 0xFF):
        return {"$maxKey" if kind == 0x7F else "$minKey": 1}, at
    raise _unknown(kind, name)


def fields(raw: bytes, at: int = 0) -> Iterator[tuple[str, Any]]:
    """Names and values of the document that begins at a place, one at a time."""
    at += 4
    while kind := raw[at]:
        name, start = _text(raw, at + 1)
        own, at = value(kind, raw, start, name)
        yield name, own


def _name(file: BinaryIO) -> bytes:
    out = bytearray()
    while (c := file.read(1)) not in (b"\0", b""):
        out += c
    return bytes(out)


def _size(kind: int, file: BinaryIO, name: str) -> int:
    """How long the value is at which the file stands; the file stands there still."""
    if kind in FIXED:
        return FIXED[kind]
    start = file.tell()
    if kind == REGEX:
        size = len(_name(file)) + len(_name(file)) + 2
    elif kind in COUNTED or kind in WHOLE:
        (size,) = struct.unpack("<i", file.read(4))
        size += 0 if kind in WHOLE else 4 + COUNTED[kind]
    else:
        raise _unknown(kind, name)
    file.seek(start)
    return size


def stretch(file: BinaryIO, start: int, end: int | None = None) -> Iterator[tuple[int, int, str, int]]:
    """(place, type, name, size) of the fields from start up to end; the file stands at each value when it is given out."""
    file.seek(start)
    while (end is None or file.tell() < end) and (head := file.read(1)) not in (b"\0", b""):
        at = file.tell() - 1
        name = _name(file).decode()
        size = _size(head[0], file, name)
        value_at = file.tell()
        yield at, head[0], name, size
        file.seek(value_at + size)


def encoded(own: Any) -> tuple[int, bytes]:
    """Type and bytes of a JSON value; keys sorted at every level."""
    if own is None:
        return 0x0A, b""
    if isinstance(own, bool):
        return 0x08, bytes([own])
    if isinstance(own, int):
        if not -(1 << 63) <= own < 1 << 63:
            raise ValueError(f"{own} has more than 64 bits")
        return (0x10, struct.pack("<i", own)) if -(1 << 31) <= own < 1 << 31 else (0x12, struct.pack("<q", own))
    if isinstance(own, float):
        return 0x01, struct.pack("<d", own)
    if isinstance(own, str):
        raw = own.encode()
        return 0x02, struct.pack("<i", len(raw) + 1) + raw + b"\0"
    items = sorted(own.items(), key=lambda kv: kv[0].encode()) if isinstance(own, dict) else ((str(i), x) for i, x in enumerate(own))
    body = b"".join(field(k, x) for k, x in items)
    return 0x03 if isinstance(own, dict) else 0x04, struct.pack("<i", len(body) + 5) + body + b"\0"


def field(name: str, own: Any) -> bytes:
    raw = name.encode()
    if b"\0" in raw:
        raise ValueError(f"the key {name!r} has a zero in it")
    kind, body = encoded(own)
    return bytes([kind]) + raw + b"\0" + body


def _local(path: str) -> str:
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return path
    if scheme != "file":
        raise ValueError(f"{path} isn't on a mounted file system")
    return "/" + rest.lstrip("/")


def _files(folder: str) -> list[str]:
    return sorted(n for end in ENDINGS.values() for n in glob.glob(f"{glob.escape(folder)}/*{end}"))


def compression(path: str) -> str:
    """The compression that a file's name tells."""
    return next((c for c, end in ENDINGS.items() if c != "none" and path.endswith(end)), "none")


def unpacked(path: str, raw: pa.NativeFile | bytes | None = None) -> BinaryIO:
    """The content of a compressed file, of the path or as given, as a file that can be sought."""
    out = tempfile.SpooledTemporaryFile(HELD)  # noqa: SIM115  closed by the caller
    with pa.input_stream(path if raw is None else pa.py_buffer(raw), compression=compression(path)) as stream:
        shutil.copyfileobj(stream, out, 1 << 20)
    out.seek(0)
    return out


@dataclass
class Stretch(InputPartition):
    path: str
    start: int
    end: int | None


class BsonReader(DataSourceReader):
    def __init__(self, path: str, most: int):
        self.path, self.most = _local(path), most

    def partitions(self) -> list[Stretch]:
        out = []
        names = _files(self.path) if os.path.isdir(self.path) else sorted(glob.glob(self.path))
        if not names and not os.path.isdir(self.path):
            raise FileNotFoundError(self.path)
        for name in names:
            if compression(name) != "none":
                out.append(Stretch(name, 4, None))
                continue
            with open(name, "rb") as file:
                start = last = 4
                for at, _, _, size in stretch(file, 4):
                    last = file.tell() + size
                    if last - start >= self.most:
                        out.append(Stretch(name, start, last))
                        start = last
            if last > start:
                out.append(Stretch(name, start, last))
        return out or [Stretch("", 0, 0)]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        with open(partition.path, "rb") if compression(partition.path) == "none" else unpacked(partition.path) as file:
            keys: list[str] = []
            texts: list[str] = []
            for _, kind, name, size in stretch(file, partition.start, partition.end):
                own, _ = value(kind, file.read(size), 0, name)
                keys.append(name)
                texts.append(json.dumps(own, ensure_ascii=False))
                if len(keys) == ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(texts)], names=["key", "json"])
                    keys, texts = [], []
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(texts)], names=["key", "json"])


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class BsonWriter(DataSourceWriter):
    def __init__(self, path: str, most: int, overwrite: bool, packed: str = "none"):
        if packed not in ENDINGS:
            raise ValueError(f"compression {packed!r} is none of {', '.join(ENDINGS)}")
        self.path, self.most, self.overwrite, self.packed = _local(path), most, overwrite, packed
        os.makedirs(self.path, exist_ok=True)

    def write(self, rows: Iterator[Any]) -> Written:
        names: list[str] = []
        file = None
        for row in rows:
            body = field(row["key"], json.loads(row["json"]))
            if file is None or file.tell() + len(body) >= self.most:
                self._end(file, names)
                names.append(os.path.join(self.path, f"_{uuid.uuid4().hex}.part"))
                file = open(names[-1], "wb") if self.packed == "none" else tempfile.SpooledTemporaryFile(HELD)  # noqa: SIM115  closed by _end
                file.write(b"\0\0\0\0")
            file.write(body)
        self._end(file, names)
        return Written(names)

    def _end(self, file: BinaryIO | None, names: list[str]) -> None:
        if file is not None:
            file.write(b"\0")
            size = file.tell()
            file.seek(0)
            file.write(struct.pack("<I", size & 0xFFFFFFFF))
            if self.packed != "none":
                file.seek(0)
                with pa.CompressedOutputStream(names[-1], self.packed) as out:
                    shutil.copyfileobj(file, out, 1 << 20)
            file.close()

    def commit(self, messages: list[Written | None]) -> None:
        old = _files(self.path) if self.overwrite else []
        done = uuid.uuid4().hex[:8]
        names = [n for m in messages if m is not None for n in m.names]
        for i, n in enumerate(names):
            os.rename(n, os.path.join(self.path, f"part-{i:05}-{done}{ENDINGS[self.packed]}"))
        for n in old:
            os.remove(n)
        self.abort([])

    def abort(self, messages: list[Written | None]) -> None:
        """Removes what tasks have left that weren't committed."""
        for n in glob.glob(f"{glob.escape(self.path)}/_*.part"):
            os.remove(n)


class BsonSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bson"

    def schema(self) -> str:
        return "key string, json string"

    def reader(self, schema: StructType) -> BsonReader:
        return BsonReader(self.options["path"], int(self.options.get("partitionBytes", 64 << 20)))

    def writer(self, schema: StructType, overwrite: bool) -> BsonWriter:
        return BsonWriter(self.options["path"], int(self.options.get("fileBytes", 1 << 30)), overwrite, self.options.get("compression", "none"))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BsonSource)
