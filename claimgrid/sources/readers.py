"""Readers of raw files: everything is read by Spark, with schemas named rather than inferred."""

from __future__ import annotations

import csv
import glob
import io
import json
import os
import re
import warnings
import zipfile
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgrid.schema import ATTRIBUTES
from claimgrid.sources import bson

#: Rows of an archive's file that a task holds at once.
ROWS = 4096
#: Accessions that a database keeps of an entry.
SAMPLE_ACCESSIONS = ("sample", "series", "platform", "srx", "srs", "srp")


def delimited(spark: SparkSession, path: str, columns: list[str] | None = None, sep: str = ",", nulls: tuple[str, ...] = ("",), encoding: str = "UTF-8", names: list[str] | None = None, skip: int = 0) -> DataFrame:
    """CSV or TSV as strings, with several spellings of null.

    columns: which to read, by header. names: the columns of files without a header, or whose header is among the ``skip``
    lines left out at the start (of each file, which is then read as one text, so for small files).
    """
    if names is None and not skip:
        df = spark.read.csv(path, sep=sep, header=True, encoding=encoding, quote='"', escape='"')
        df = df.toDF(*(c.lstrip("﻿") for c in df.columns))
    elif not skip:
        df = spark.read.schema(_ddl(names)).csv(path, sep=sep, encoding=encoding, quote='"', escape='"')
    else:
        lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("pos", "line")).where((F.col("pos") >= skip) & (F.col("line") != ""))
        header = names or [c.strip('"').lstrip("﻿") for c in lines.orderBy("pos").first()["line"].split(sep)]
        parsed = lines.select(F.from_csv("line", _ddl(header), {"sep": sep, "quote": '"', "escape": '"'}).alias("r")).select("r.*")
        df = parsed if names else parsed.where(~_is_header(header))
    if columns:
        df = df.select(*(F.col(f"`{c}`") for c in columns))
    return df.select(*(F.when(~F.col(f"`{c}`").isin(*nulls), F.col(f"`{c}`")).alias(c) for c in df.columns))


def _ddl(names: list[str]) -> str:
    return ", ".join(f"`{n}` string" for n in names)


def _is_header(names: list[str]):
    return F.coalesce(F.col(f"`{names[0]}`") == names[0], F.lit(False))


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file that holds one JSON array of objects."""
    return spark.read.schema(schema).json(path, multiLine=True)


def json_map(spark: SparkSession, path: str, value: str, names: tuple[str, str] = ("key", "value")) -> DataFrame:
    """A file that holds one JSON object, as rows of key and value; value: the type of its values."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", f"map<string,{value}>")).alias(*names))


def gmt(spark: SparkSession, path: str) -> DataFrame:
    """(name, description): the first two fields of each line."""
    parts = F.split("value", "\t")
    return spark.read.text(path).where(F.size(parts) >= 2).select(F.get(parts, F.lit(0)).alias("name"), F.get(parts, F.lit(1)).alias("description"))


def id_list(spark: SparkSession, path: str, name: str = "id") -> DataFrame:
    """One id a line."""
    return spark.read.text(path).select(F.trim("value").alias(name)).where(f"`{name}` <> ''").distinct()


def name_lists(spark: SparkSession, path: str) -> DataFrame:
    """(term_id, name, synonyms) from a JSON map id -> {name, synonyms: [{text, scope}]}."""
    rows = json_map(spark, path, "struct<name:string,synonyms:array<struct<text:string,scope:string>>>", ("term_id", "v"))
    return rows.select("term_id", "v.name", F.coalesce("v.synonyms", F.array().cast("array<struct<text:string,scope:string>>")).alias("synonyms"))


def parquet_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    return None


def claim_tables(spark: SparkSession, root: str, sources: list[str]) -> dict[str, DataFrame]:
    """Processed claims of each source under root/source=<name>; a source that isn't there is left out, with a warning."""
    found = {s: parquet_if_there(spark, f"{root}/source={s}") for s in sources}
    if absent := [s for s, df in found.items() if df is None]:
        warnings.warn(f"no claims of {', '.join(absent)} under {root}", stacklevel=2)
    return {s: df for s, df in found.items() if df is not None}


def batches(spark: SparkSession, path: str) -> DataFrame:
    """(accession, characteristics: array of category, valueUri, value) of each study in a JSON map of batches, each a list of
    studies. What isn't a list, and studies without an accession, are left out."""
    study = "struct<accession:string,characteristics:array<struct<category:string,valueUri:string,value:string>>>"
    rows = json_map(spark, path, "string").select(F.explode(F.from_json("value", f"array<{study}>")).alias("s"))
    none = F.array().cast("array<struct<category:string,valueUri:string,value:string>>")
    return rows.where("s.accession <> ''").select("s.accession", F.coalesce("s.characteristics", none).alias("characteristics"))


def zipped_tables(spark: SparkSession, path: str, sep: str = "\t", nulls: tuple[str, ...] = ("", "NA", "na", "N/A"), encoding: str = "utf-8-sig") -> DataFrame:
    """(file, row): each data row of the delimited files in ZIP archives, as a map from header to value without nulls. Fields
    beyond the header are left out."""
    return zipped_rows(spark, path, sep, nulls, encoding).select("file", "row")


def zipped_rows(spark: SparkSession, path: str, sep: str = "\t", nulls: tuple[str, ...] = ("", "NA", "na", "N/A"), encoding: str = "utf-8-sig") -> DataFrame:
    """The same with ``surplus``: a row's fields beyond the header, null if there are none.

    On a mounted file system the driver reads the archives' directories, and each of their files is streamed by a task of its
    own. In other stores an archive is read by one task, up to 2 GB. No task holds more than ``ROWS`` rows.
    """

    def rows(archive: zipfile.ZipFile, name: str) -> Iterator[pd.DataFrame]:
        with archive.open(name) as member:
            lines = csv.DictReader(io.TextIOWrapper(member, encoding, newline=""), delimiter=sep)
            while some := list(islice(lines, ROWS)):
                yield pd.DataFrame({"file": [name] * len(some), "row": [{k: v for k, v in r.items() if k and isinstance(v, str) and v not in nulls} for r in some], "surplus": [r.get(None) for r in some]})

    def unzip(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for content in (x for part in parts for x in part["content"]):
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                for name in _members(archive):
                    yield from rows(archive, name)

    def unzip_member(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for at, name in (x for part in parts for x in zip(part["archive"], part["member"], strict=True)):
            with zipfile.ZipFile(at) as archive:
                yield from rows(archive, name)

    schema = "file string, row map<string,string>, surplus array<string>"
    if (mounted := mounted_path(path)) is None:
        return spark.read.format("binaryFile").load(path).select("content").mapInPandas(unzip, schema)
    found = [(at, name) for at in _archives(mounted) for name in _archive_members(at)]
    one_each = spark.sparkContext.parallelize(found, max(len(found), 1))
    return spark.createDataFrame(one_each, "archive string, member string").mapInPandas(unzip_member, schema)


def _members(archive: zipfile.ZipFile) -> list[str]:
    return [n for n in archive.namelist() if not n.endswith("/")]


def _archive_members(path: str) -> list[str]:
    with zipfile.ZipFile(path) as archive:
        return _members(archive)


def _archives(path: str) -> list[str]:
    """The archives of a folder or a glob, or the one named."""
    found = sorted(glob.glob(os.path.join(path, "*.zip") if os.path.isdir(path) else path))
    if not found:
        raise FileNotFoundError(path)
    return found


def mounted_path(path: str) -> str | None:
    """The path in the mounted file system, without a scheme; None if it is of another store."""
    scheme = path.partition(":")[0] if ":" in path.partition("/")[0] else "file"
    return None if scheme != "file" else re.sub("^file:(?://)?(?=/)", "", path)


def bson_map(spark: SparkSession, path: str, partition_bytes: int = 64 << 20) -> DataFrame:
    """(key, json): the top-level fields of BSON files, each one document. On a mounted file system a file of any size is read
    by a task for every ``partition_bytes``; in other stores, and where it is compressed, by one task a file, up to 2 GB in other
    stores."""
    if mounted_path(path) is not None:
        bson.register(spark)
        return spark.read.format("bson").option("partitionBytes", partition_bytes).load(path)

    def parse(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for path, content in (x for part in parts for x in zip(part["path"], part["content"], strict=True)):
            if bson.compression(path) != "none":
                with bson.unpacked(path, content) as file:
                    content = file.read()
            rows = bson.fields(content)
            while some := list(islice(rows, bson.ROWS)):
                yield pd.DataFrame([(k, json.dumps(v, ensure_ascii=False)) for k, v in some], columns=["key", "json"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, "key string, json string")


def database_claims(rows: DataFrame, *keep: str) -> DataFrame:
    """Claims from an annotation database as (key, json) of its entries: attribute -> source -> id, value, ecode. Of an id
    that names several terms each is a claim, with its name where there are as many. All attributes are read in one pass.
    keep: columns of rows that each claim also gets."""
    of = lambda a: F.from_json(F.get_json_object("json", f"$.{a}"), "map<string,struct<id:string,value:string,ecode:string>>")
    named = lambda a: F.transform(F.map_entries(of(a)), lambda x: F.struct(F.lit(a).alias("attribute"), x["key"].alias("source"), x["value"].alias("v")))
    each = rows.select(F.col("key").alias("entry"), *keep, F.explode(F.flatten(F.array_compact(F.array(*map(named, ATTRIBUTES))))).alias("c")).select("entry", *keep, "c.*")
    ids, names = F.split("v.id", "[|]"), F.split("v.value", "[|]")
    names = F.when(F.size(ids) == F.size(names), names).otherwise(F.transform(ids, lambda _: F.col("v.value")))
    each = each.select("entry", *keep, "attribute", "source", "v.ecode", F.explode(F.arrays_zip(ids.alias("term_id"), names.alias("term_name"))).alias("t"))
    return each.select("entry", "attribute", "source", "t.term_id", "t.term_name", "ecode", *keep).where("term_id is not null")


def database_entries(rows: DataFrame, *keep: str) -> DataFrame:
    """Entries of an annotation database: accessions and organism. keep: columns of rows that each entry also gets."""
    ids = F.from_json(F.get_json_object("json", "$.accession_ids"), ", ".join(f"{c} string" for c in SAMPLE_ACCESSIONS))
    own = rows.select(F.col("key").alias("entry"), ids.alias("i"), F.get_json_object("json", "$.organism").alias("organism"), *keep)
    return own.select("entry", *(f"i.{c}" for c in SAMPLE_ACCESSIONS), "organism", *keep)


def term_column(spark: SparkSession, path: str, column: str = "term") -> list[str]:
    """The values of a CSV's column, in order of their first place; a request's terms, so few."""
    return list(dict.fromkeys(r[0] for r in delimited(spark, path, [column]).where(F.col(column).isNotNull()).collect()))


def tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database))


def fields(df: DataFrame) -> list[str]:
    return df.columns


def by_ids(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows of a catalogue table whose accession is among ids."""
    return df.join(ids.select(F.col(ids.columns[0]).alias(column)).distinct(), column, "left_semi")
