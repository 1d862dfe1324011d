"""Raw files to raw frames: how each source's files lie is declared, one reader of each layout interprets it, and what can't be
read goes to a table of rejects with its reason instead of vanishing."""

from __future__ import annotations

import csv
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgrid.sources import processors, readers

CORRUPT = "_corrupt_record"
REJECTS = "source string, frame string, file string, reason string, record string"
STUDY = "struct<accession:string,characteristics:array<struct<category:string,valueUri:string,value:string>>>"


class IngestError(ValueError):
    """A file or a column that a source needs is missing."""


@dataclass(frozen=True)
class Layout:
    """One raw frame.

    kind: delimited, array (a JSON array of objects), map (a JSON object of values), batches (a JSON object of lists of
    studies), gmt or zip (of delimited files). columns: what the frame must have, by header, or as DDL for an array. names: new
    names of the first columns by place. skip: title lines before the header, if any, of each file; they are told by their
    text. nulls: spellings of null. key: a column without which a row is rejected. value: the type of a map's values.
    multiline: fields may hold line breaks; each file is then read by one task.
    """

    kind: str = "delimited"
    columns: tuple[str, ...] = ()
    key: str | None = None
    sep: str = ","
    nulls: tuple[str, ...] = ("",)
    encoding: str = "UTF-8"
    header: bool = True
    names: tuple[str, ...] = ()
    skip: int = 0
    value: str = "string"
    multiline: bool = False


def _map(*columns: str) -> Layout:
    """A crosswalk file with these columns among others."""
    return Layout(columns=columns, key=columns[0])


# Columns, separators, spellings of null and title lines of the sources' files.
_NA = ("", "NA", "na")
_BGEE = ("Run IDs", "Expression mapped anatomical entity ID", "Expression mapped anatomical entity name", "Expression mapped stage ID", "Expression mapped stage name", "Expression mapped sex")
SPECS: dict[str, dict[str, Layout]] = {
    "ALE": {"raw": Layout(columns=("accession", "brenda", "age_months", "gender"), key="accession", sep="\t", nulls=_NA, names=("accession", "brenda", "age_months", "gender"), skip=1), "tissues": _map("brenda", "uberon", "uberon_name")},
    "BGee": {"raw": Layout(columns=_BGEE, key="Run IDs", sep="\t", nulls=_NA)},
    "Cello": {"raw": Layout("map", value="array<string>")},
    "CREEDS": {"raw": Layout("array", columns=("organism string", "do_id string", "disease_name string", "pert_ids array<string>", "ctrl_ids array<string>"))},
    "DiSignAtlas": {"raw": Layout("gmt"), "tissues": _map("name", "id"), "corrections": _map("sample", "term", "name")},
    "Gemma": {"raw": Layout("batches"), "stages": replace(_map("term_id", "age_group"), nulls=("", "na"))},
    "Golightly_2018": {"raw": Layout("zip", sep="\t", nulls=(*_NA, "N/A"), key="SampleID"), "files": _map("file", "tissue", "tissue_name", "age_column", "sex_column")},
    "Gu_2023": {"raw": Layout(columns=("Sample ID", "Manual annotation", "Sample info #manual annotation"), key="Sample ID", nulls=_NA, skip=1), "diseases": _map("disease_name", "mondo_id"), "tissues": _map("tissue_name", "uberon_id")},
    "Johnson_2023_microarray": {"raw": Layout(columns=("gsm", "disease", "tissue", "sex", "age_group"), key="gsm", sep="\t", nulls=_NA), "diseases": _map("mesh_id", "mondo_id", "mondo_name"), "tissues": _map("mesh_id", "uber_id")},
    "Johnson_2023_rnaseq": {"raw": Layout(columns=("run", "disease", "tissue", "sex", "age_group"), key="run", sep="\t", nulls=_NA, encoding="ISO-8859-1"), "diseases": _map("original_label", "mondo_id", "mondo_name"), "tissues": _map("original_label", "uber_id")},
    "Curated_GSM": {"raw": Layout(columns=("GSM", "ID", "ID_name", "task"), key="GSM", sep="\t")},
    "Sirota_2011": {"raw": Layout(columns=("DISEASE CUI", "TISSUE CUI", "CONTROL GSM", "DISEASE GSM")), "diseases": _map("CUI", "mapped_mondo_id", "mondo_name"), "tissues": _map("TISSUE_CUI", "mapped_uber_id", "uberon_name")},
    "URSA": {"raw": Layout(columns=("accession", "study_id", "term_id"), key="accession", header=False, names=("accession", "study_id", "term_id"))},
    "URSA_HD": {"raw": Layout(columns=("GSMID", "UID", "GSEID", "GEO Sample Description"), key="GSMID"), "series_tissues": _map("GSE", "tissue_name", "UBERON_ID"), "raw_tissues": _map("raw_tissue", "tissue_uberon", "uberon_id")},
}


@dataclass
class Ingested:
    """A source's frames by name, and its rejects as ``REJECTS``."""

    frames: dict[str, DataFrame]
    rejects: DataFrame


def _named(names: list[str]) -> list[str]:
    """Names without a byte order mark; empty and repeated ones, which no spec can ask for, by their place."""
    out: list[str] = []
    for i, n in enumerate(names):
        n = n.lstrip("﻿").strip('"')
        out.append(n if n and n not in out else f"_c{i}")
    return out


def _delimited(spark: SparkSession, path: str, lay: Layout) -> DataFrame:
    """The rows of a file or folder, ``CORRUPT`` for those with too many or too few fields, and their file."""
    options = {"sep": lay.sep, "quote": '"', "escape": '"', "columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"}
    ddl = lambda names: readers._ddl([*names, CORRUPT])
    if not lay.skip:
        # without columnPruning=false a scan of some columns doesn't see that others are missing
        read = spark.read.options(**options, columnPruning="false", encoding=lay.encoding, header=str(lay.header).lower(), multiLine=str(lay.multiline).lower())
        names = _named(spark.read.options(sep=lay.sep, quote='"', escape='"', encoding=lay.encoding, header=str(lay.header).lower()).csv(path).columns)
        names = [*lay.names, *names[len(lay.names) :]]
        return read.schema(ddl(names)).csv(path).select("*", F.col("_metadata.file_path").alias("_file"))
    if lay.encoding != "UTF-8" or lay.multiline:
        raise IngestError("files with title lines are read as lines in UTF-8")
    lines = spark.read.text(path)
    head = [r["value"] for r in lines.head(lay.skip + lay.header)]  # titles and header
    if len(head) < lay.skip + lay.header:
        raise IngestError(f"{path} ends before its header")
    names = _named(next(csv.reader(head[-1:], delimiter=lay.sep))) if lay.header else []
    names = [*lay.names, *names[len(lay.names) :]]
    own = lines.where(~F.col("value").isin(*head) & (F.col("value") != "")).select(F.from_csv("value", ddl(names), options).alias("r"), F.col("_metadata.file_path").alias("_file"))
    return own.select("r.*", "_file")


def _rejects(df: DataFrame, reason: Column, record: Column) -> DataFrame:
    return df.where(reason.isNotNull()).select(F.col("_file").alias("file"), reason.alias("reason"), record.alias("record"))


def _rows(spark: SparkSession, path: str, lay: Layout) -> tuple[DataFrame, DataFrame]:
    raw = _delimited(spark, path, lay)
    if lacks := [c for c in lay.columns if c not in raw.columns]:
        raise IngestError(f"{path} lacks {', '.join(lacks)}")
    names = [c for c in raw.columns if c not in (CORRUPT, "_file")]
    clean = raw.select(CORRUPT, "_file", *(F.when(~F.col(f"`{c}`").isin(*lay.nulls), F.col(f"`{c}`")).alias(c) for c in names))
    reason = F.when(F.col(CORRUPT).isNotNull(), "number of fields")
    if lay.key:
        reason = reason.when(F.coalesce(F.trim(F.col(f"`{lay.key}`")), F.lit("")) == "", f"no {lay.key}")
    record = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*(F.col(f"`{c}`") for c in names))))
    return clean.where(reason.isNull()).select(*(F.col(f"`{c}`") for c in lay.columns)), _rejects(clean, reason, record)


def _array(spark: SparkSession, path: str, lay: Layout) -> tuple[DataFrame, DataFrame]:
    """Fields are read as text and then typed one by one: a wrong one costs its own element alone, not its file."""
    types = dict(c.split(" ", 1) for c in lay.columns)
    raw = spark.read.schema(", ".join([*(f"`{n}` string" for n in types), f"{CORRUPT} string"])).json(path, multiLine=True, columnNameOfCorruptRecord=CORRUPT, mode="PERMISSIVE")
    typed = {n: F.from_json(n, t) for n, t in types.items() if t != "string"}
    raw = raw.select(CORRUPT, F.col("_metadata.file_path").alias("_file"), F.to_json(F.struct(*types)).alias("_record"), *(typed.get(n, F.col(n)).alias(n) for n in types), *(F.col(n).alias(f"_text_{n}") for n in typed))
    wrong = reduce(lambda a, b: a | b, (F.col(f"_text_{n}").isNotNull() & F.col(n).isNull() for n in typed), F.lit(False))
    reason = F.when(F.col(CORRUPT).isNotNull(), "not a JSON array of objects").when(wrong, "not as declared")
    return raw.where(reason.isNull()).select(*types), _rejects(raw, reason, F.coalesce(F.col(CORRUPT), F.col("_record")))


def _whole(spark: SparkSession, path: str, value: str) -> tuple[DataFrame, DataFrame]:
    """(key, value, file) of files that hold one JSON object each; a file that doesn't is named, without its text."""
    parsed = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("_file"), F.from_json("value", f"map<string,{value}>").alias("m"))
    return parsed.select("_file", F.explode("m").alias("key", "value")), _rejects(parsed, F.when(F.col("m").isNull(), "not a JSON object"), F.lit(None).cast("string"))


def _entries(spark: SparkSession, path: str, lay: Layout) -> tuple[DataFrame, DataFrame]:
    rows, bad = _whole(spark, path, "string")
    rows = rows.select("*", F.from_json("value", lay.value).alias("v"))
    reason = F.when(F.col("v").isNull() & (F.coalesce("value", F.lit("null")) != "null"), f"not {lay.value}")
    return rows.where(reason.isNull()).select("key", F.col("v").alias("value")), bad.unionByName(_rejects(rows, reason, F.to_json(F.struct("key", "value"))))


def _batches(spark: SparkSession, path: str, lay: Layout) -> tuple[DataFrame, DataFrame]:
    rows, bad = _whole(spark, path, "string")
    rows = rows.select("*", F.from_json("value", f"array<{STUDY}>").alias("studies"))
    bad = bad.unionByName(_rejects(rows, F.when(F.col("studies").isNull(), "not a list of studies"), F.to_json(F.struct("key", "value"))))
    each = rows.select("_file", F.explode("studies").alias("s"))
    reason = F.when(F.coalesce("s.accession", F.lit("")) == "", "no accession")
    none = F.array().cast("array<struct<category:string,valueUri:string,value:string>>")
    return each.where(reason.isNull()).select("s.accession", F.coalesce("s.characteristics", none).alias("characteristics")), bad.unionByName(_rejects(each, reason, F.to_json("s")))


def _gmt(spark: SparkSession, path: str, lay: Layout) -> tuple[DataFrame, DataFrame]:
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file")).where("value <> ''")
    reason = F.when(F.size(F.split("value", "\t")) < 2, "number of fields")
    return readers.gmt(spark, path), _rejects(lines, reason, F.col("value"))


def _zip(spark: SparkSession, path: str, lay: Layout) -> tuple[DataFrame, DataFrame]:
    """Rows with too many fields are rejected with them; those with too few lack the last ones."""
    rows = readers.zipped_rows(spark, path, lay.sep, lay.nulls).withColumn("_file", F.concat(F.lit(path + "!"), "file"))
    reason = F.when(F.col("surplus").isNotNull(), "number of fields").when(F.try_element_at("row", F.lit(lay.key)).isNull(), f"no {lay.key}")
    record = F.when(F.col("surplus").isNull(), F.to_json("row")).otherwise(F.to_json(F.struct("row", "surplus")))
    return rows.where(reason.isNull()).select("file", "row"), _rejects(rows, reason, record)


_KINDS = {"delimited": _rows, "array": _array, "map": _entries, "batches": _batches, "gmt": _gmt, "zip": _zip}


def read(spark: SparkSession, paths: str, lay: Layout) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of paths joined by commas; each may have its own order of columns."""
    if lay.kind not in _KINDS:
        raise IngestError(f"no layout {lay.kind!r}; there are {', '.join(_KINDS)}")
    both = [_KINDS[lay.kind](spark, p, lay) for p in paths.split(",")]
    return tuple(reduce(DataFrame.unionByName, some) for some in zip(*both, strict=True))


def layouts(source: str, changes: dict[str, dict] | None = None) -> dict[str, Layout]:
    """A source's layouts, with changes by frame: what a Layout has, as a configuration file gives it."""
    if source not in SPECS:
        raise IngestError(f"no source {source!r}; there are {', '.join(SPECS)}")
    out = dict(SPECS[source])
    for frame, fields in (changes or {}).items():
        if frame not in out or (odd := fields.keys() - Layout.__dataclass_fields__.keys()):
            raise IngestError(f"{source} has no frame {frame!r}" if frame not in out else f"a layout has no {', '.join(sorted(odd))}")
        out[frame] = replace(out[frame], **{k: tuple(v) if isinstance(v, list) else v for k, v in fields.items()})
    return out


def ingest(spark: SparkSession, source: str, paths: dict[str, str], changes: dict[str, dict] | None = None) -> Ingested:
    """The frames that a source's processor takes, from files by frame name.

    Golightly's archive becomes rows by its table of files; rows of files that aren't listed are rejected.
    """
    own = layouts(source, changes)
    if lacks := own.keys() - paths.keys():
        raise IngestError(f"{source} lacks files of {', '.join(sorted(lacks))}")
    if odd := paths.keys() - own.keys():
        raise IngestError(f"{source} has no frame {', '.join(sorted(odd))}")
    frames, bad = {}, []
    for frame, lay in own.items():
        frames[frame], rejected = read(spark, paths[frame], lay)
        bad.append(rejected.select(F.lit(source).alias("source"), F.lit(frame).alias("frame"), "file", "reason", "record"))
    if source == "Golightly_2018":
        members, files = frames["raw"], frames.pop("files")
        unlisted = members.join(files.select("file"), "file", "left_anti")
        bad.append(unlisted.select(F.lit(source).alias("source"), F.lit("raw").alias("frame"), F.concat(F.lit(paths["raw"] + "!"), "file").alias("file"), F.lit("file isn't listed").alias("reason"), F.to_json("row").alias("record")))
        frames["raw"] = processors.golightly_rows(members, files)
    return Ingested(frames, reduce(DataFrame.unionByName, bad))


def save_rejects(rejects: DataFrame, root: str, source: str) -> str:
    """Rejects as Parquet under root/source=<name>."""
    path = f"{root}/source={source}"
    rejects.drop("source").write.mode("overwrite").parquet(path)
    return path
