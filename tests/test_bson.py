"""BSON databases: every type, partitions at fields, files of any size, and the way there and back."""

import json
import os
import struct

import pytest

from claimgrid import sinks
from claimgrid.plans import driver, raw_queries  # noqa: F401  both register their queries
from claimgrid.plans.retrieval import Database, Request, retrieve
from claimgrid.sources import bson, readers


def document(*parts):
    body = b"".join(parts)
    return struct.pack("<i", len(body) + 5) + body + b"\0"


def test_all_types(spark, tmp_path):
    text = lambda t: struct.pack("<i", len(t) + 1) + t + b"\0"
    scope = document(b"\x10n\0" + struct.pack("<i", 1))
    code = struct.pack("<i", 4 + len(text(b"f()")) + len(scope)) + text(b"f()") + scope
    kinds = {
        "double": (b"\x01", struct.pack("<d", 1.5), 1.5), "nan": (b"\x01", struct.pack("<d", float("nan")), {"$numberDouble": "nan"}), "string": (b"\x02", text("é".encode()), "é"), "array": (b"\x04", document(b"\x080\0\x01"), [True]),
        "binary": (b"\x05", struct.pack("<iB", 2, 3) + b"\x00\xff", {"$binary": {"base64": "AP8=", "subType": "03"}}), "undefined": (b"\x06", b"", None), "oid": (b"\x07", bytes(range(12)), {"$oid": bytes(range(12)).hex()}),
        "false": (b"\x08", b"\0", False), "time": (b"\x09", struct.pack("<q", 12345), 12345), "null": (b"\x0a", b"", None), "regex": (b"\x0b", b"a.b\0i\0", {"$regularExpression": {"pattern": "a.b", "options": "i"}}),
        "pointer": (b"\x0c", text(b"db.c") + bytes(12), {"$dbPointer": {"$ref": "db.c", "$id": {"$oid": "00" * 12}}}), "code": (b"\x0d", text(b"f()"), "f()"), "symbol": (b"\x0e", text(b"s"), "s"), "scoped": (b"\x0f", code, {"$code": "f()", "$scope": {"n": 1}}),
        "int": (b"\x10", struct.pack("<i", -3), -3), "stamp": (b"\x11", struct.pack("<II", 7, 9), {"$timestamp": {"t": 9, "i": 7}}), "long": (b"\x12", struct.pack("<q", 1 << 40), 1 << 40), "decimal": (b"\x13", bytes(16), {"$numberDecimalBytes": "00" * 16}), "max": (b"\x7f", b"", {"$maxKey": 1}), "min": (b"\xff", b"", {"$minKey": 1}),
    }
    (tmp_path / "d.bson").write_bytes(document(*(k + n.encode() + b"\0" + raw for n, (k, raw, _) in kinds.items()), b"\x03all\0" + document(*(k + n.encode() + b"\0" + raw for n, (k, raw, _) in kinds.items()))))
    for size in (1, 40, 64 << 20):
        rows = {r.key: json.loads(r.json) for r in readers.bson_map(spark, str(tmp_path / "d.bson"), size).collect()}
        assert rows == {n: want for n, (_, _, want) in kinds.items()} | {"all": {n: want for n, (_, _, want) in kinds.items()}}
    (tmp_path / "odd.bson").write_bytes(document(b"\x10a\0" + struct.pack("<i", 1), b"\x55b\0"))
    with pytest.raises(Exception, match="field 'b' has the type 0x55"):
        readers.bson_map(spark, str(tmp_path / "odd.bson")).collect()


def test_partitions_at_fields(tmp_path):
    entries = {f"GSM{i}": {"organism": "x" * (i % 50)} for i in range(300)}
    (tmp_path / "d.bson").write_bytes(bson.encoded(entries)[1])
    parts = bson.BsonReader(f"file://{tmp_path}/d.bson", 1000).partitions()
    assert len(parts) > 10 and all(a.end == b.start for a, b in zip(parts, parts[1:], strict=False)) and max(p.end - p.start for p in parts) < 1100
    assert [k for p in parts for b in bson.BsonReader("", 1).read(p) for k in b.column(0).to_pylist()] == sorted(entries)


def test_file_beyond_two_gigabytes(tmp_path):
    """A sparse file: a binary field of 1.5 GB, again, then one more; the length at its head is of no use."""
    path = tmp_path / "large.bson"
    with open(path, "wb") as f:
        f.write(b"\0\0\0\0")
        for name in (b"a", b"b"):
            f.write(b"\x05" + name + b"\0" + struct.pack("<iB", 1_500_000_000, 0))
            f.seek(1_500_000_000, 1)
        f.write(b"\x10last\0" + struct.pack("<i", 5) + b"\0")
    parts = bson.BsonReader(str(path), 64 << 20).partitions()
    assert os.path.getsize(path) > 2 << 30 and [p.end - p.start >= 1_500_000_000 for p in parts] == [True, True, False]
    assert [b.to_pylist() for b in bson.BsonReader("", 1).read(parts[-1])] == [[{"key": "last", "json": "5"}]]


def test_there_and_back(spark, tmp_path):
    values = {"b": {"z": 1, "a": {"é": [1, "x", None, {"k": 2.5, "b": True}], "big": 1 << 50}}, "a": {}, "ü": {"n": -1}}
    rows = spark.createDataFrame([(k, json.dumps(v)) for k, v in values.items()], "key string, json string")
    for most in (1 << 30, 40):
        sinks.save_bson(rows, f"file://{tmp_path}/db", most)
        names = os.listdir(tmp_path / "db")
        assert len(names) == (1 if most > 40 else 3) or spark.conf.get("spark.sql.adaptive.enabled") and len(names) <= 3
        back = readers.bson_map(spark, f"{tmp_path}/db").collect()
        assert {r.key: json.loads(r.json) for r in back} == values
        text = next(r.json for r in back if r.key == "b")
        assert text.index('"a"') < text.index('"z"') and text.index('"big"') < text.index('"é"')
    with pytest.raises(Exception, match="64 bits"):
        sinks.save_bson(spark.createDataFrame([("k", str(1 << 70))], "key string, json string"), f"{tmp_path}/bad")
    assert not [n for n in os.listdir(tmp_path / "bad") if n.endswith(".bson")]
    with pytest.raises(Exception, match="none.bson"):
        readers.bson_map(spark, f"{tmp_path}/none.bson").collect()


def test_retrieve_from_a_database_file(spark, tmp_path):
    claims = spark.createDataFrame([("GSM1", "tissue", "ALE", "UBERON:2", "lung", "expert-curated"), ("GSM1", "tissue", "ALE", "UBERON:3", "lobe", "expert-curated"), ("GSM2", "tissue", "CREEDS", "UBERON:3", None, "expert-curated")], "entry string, attribute string, source string, term_id string, term_name string, ecode string")
    entries = spark.createDataFrame([(f"GSM{i}", "GSE1", "GPL1", "homo sapiens") for i in (1, 2, 3)], "entry string, series string, platform string, organism string")
    sinks.save_bson(sinks.database_rows(claims, entries), f"{tmp_path}/db")
    tech = spark.createDataFrame([("GPL1", "rnaseq")], "id string, technology string")
    closure = spark.createDataFrame([(a, d) for a, d in (("UBERON:1", "UBERON:1"), ("UBERON:1", "UBERON:2"), ("UBERON:1", "UBERON:3"), ("UBERON:2", "UBERON:2"), ("UBERON:3", "UBERON:3"))], "ancestor string, descendant string")
    db = Database.of_bson(spark, f"{tmp_path}/db", tech, closure)
    assert {(r.entry, r.source, r.term_id, r.term_name) for r in db.claims.collect()} == {("GSM1", "ALE", "UBERON:2", "lung"), ("GSM1", "ALE", "UBERON:3", "lobe"), ("GSM2", "CREEDS", "UBERON:3", "")}
    found = retrieve(db, Request("tissue", ["UBERON:1", "UBERON:2"], metadata=["series"]))
    assert sorted(map(tuple, found.curation.cells.select("entry", "term").collect())) == [("GSM1", "UBERON:1"), ("GSM1", "UBERON:2"), ("GSM2", "UBERON:1")]


def test_a_database_is_parsed_once(spark, sf_dir):
    """What is asked of a database that was read back doesn't parse its files again."""
    plan = driver.QUERIES["bson_database"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" not in plan and "FileScan" in plan


def test_claims_get_their_entry_without_a_join(spark, sf_dir):
    """A claim and its entry are read from one document, so nothing is dealt or joined after the files are parsed."""
    plan = driver.QUERIES["bson_database"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_database_rows_are_dealt_once(spark, tmp_path):
    """Claims and entries are dealt by ranges of entries, and the texts not again for their order."""
    claims = spark.createDataFrame([("b", "tissue", "S2", "T2", "y", "e2"), ("b", "tissue", "S2", "T1", None, "e1"), ("b", "tissue", "S1", "T1", "x", "e1"), ("b", None, None, "T9", None, "e1"), ("c", None, "S1", "T1", "x", "e1"), ("d", "tissue", "S1", "T1", "x", "e1"), (None, "tissue", "S1", "T1", "x", "e1")], "entry string, attribute string, source string, term_id string, term_name string, ecode string")
    entries = spark.createDataFrame([("a", "G1", "o"), ("b", "G1", "o"), ("c", None, None), (None, "G2", "o"), ("d", "G3", "o"), ("d", "G4", "p")], "entry string, series string, organism string")
    rows = sinks.database_rows(claims, entries)
    plan = rows.orderBy("key")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    sinks.save_bson(rows, f"{tmp_path}/db", compression="gzip")
    d = {"S1": {"id": "T1", "value": "x", "ecode": "e1"}}
    want = [("b", {"accession_ids": {"series": "G1"}, "organism": "o", "tissue": {"S1": d["S1"], "S2": {"id": "T1|T2", "value": "|y", "ecode": "e1"}}}), ("c", {"accession_ids": {}}), ("d", {"accession_ids": {"series": "G3"}, "organism": "o", "tissue": d}), ("d", {"accession_ids": {"series": "G4"}, "organism": "p", "tissue": d})]
    back = [(r.key, json.loads(r.json)) for r in readers.bson_map(spark, f"{tmp_path}/db").collect()]
    assert sorted(back, key=repr) == want


def test_compressed_files(spark, tmp_path):
    entries = {f"GSM{i:04}": {"organism": "x" * (i % 50)} for i in range(1000)}
    rows = spark.createDataFrame([(k, json.dumps(v)) for k, v in entries.items()], "key string, json string")
    plain = f"{tmp_path}/plain"
    sinks.save_bson(rows, plain)
    sinks.save_bson(rows, f"{tmp_path}/db")
    for name, end in (("zstd", ".bson.zst"), ("gzip", ".bson.gz")):
        sinks.save_bson(rows, f"{tmp_path}/db", 5000, name)
        files = sorted(n for n in os.listdir(tmp_path / "db"))
        assert len(files) > 3 and all(n.endswith(end) for n in files)  # those that were there have gone
        keys = []
        for n in files:
            with bson.unpacked(f"{tmp_path}/db/{n}") as file:
                content = file.read()
            assert struct.unpack_from("<i", content)[0] == len(content) <= 5100
            keys += [k for k, _ in bson.fields(content)]
        assert keys == sorted(entries)
        assert {r.key: json.loads(r.json) for r in readers.bson_map(spark, f"{tmp_path}/db").collect()} == entries
        with bson.unpacked(files[0], (tmp_path / "db" / files[0]).read_bytes()) as file:
            assert next(bson.fields(file.read()))[0] == "GSM0000"
    size = lambda d: sum(os.path.getsize(f"{d}/{n}") for n in os.listdir(d))
    sinks.save_bson(rows, f"{tmp_path}/db", compression="zstd")
    assert size(f"{tmp_path}/db") < size(plain) / 4
    with pytest.raises(Exception, match="'lzma' is none of"):
        sinks.save_bson(rows, f"{tmp_path}/db", compression="lzma")
