"""Descriptive metadata of samples and series, flattened from a catalogue's nested tables to strings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimgrid.functions.scalar import one_line
from claimgrid.operators.reshape import flat_channels
from claimgrid.schema import DELIMITER, NA

SAMPLE_FIELDS = ["accession", "title", "description", "source_name", "characteristics"]
SERIES_FIELDS = ["accession", "title", "summary", "overall_design", "sample_id"]


def channel_fields(table: DataFrame, channels: str = "channels") -> list[str]:
    """Fields of the structs in a column of channels; none if there is no such column."""
    kind = table.schema[channels].dataType if channels in table.columns else None
    return kind.elementType.fieldNames() if isinstance(kind, T.ArrayType) else []


def known_fields(table: DataFrame, requested: list[str]) -> tuple[list[str], list[str]]:
    """The requested fields that the table or its channels have, the accession first if absent; and the others."""
    have = {*table.columns, *channel_fields(table)} - {"channels"}
    wanted = list(dict.fromkeys([*([] if "accession" in requested else ["accession"]), *requested]))
    return [f for f in wanted if f in have], [f for f in wanted if f not in have]


def _strings(df: DataFrame, null: str | None) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        c = F.array_join(c, DELIMITER) if isinstance(f.dataType, T.ArrayType) else c.cast("string")
        out.append(one_line(F.coalesce(c, F.lit(null)) if null is not None else c).alias(f.name))
    return df.select(*out)


def sample_metadata(table: DataFrame, ids: DataFrame, requested: list[str] | None = None, null: str | None = NA) -> DataFrame:
    """Fields of the samples among ids (a column of accessions); those of channels as <field>_ch1 and <field>_ch2."""
    fields, _ = known_fields(table, requested or SAMPLE_FIELDS)
    nested = [f for f in fields if f in channel_fields(table)]
    own = [f for f in fields if f not in nested]
    rows = table.join(ids.select(F.col(ids.columns[0]).alias("accession")).distinct(), "accession", "left_semi")
    rows = flat_channels(rows.select(*own, "channels"), nested) if nested else rows.select(*own)
    return _strings(rows, null).withColumnRenamed("accession", "sample")


def series_metadata(table: DataFrame, ids: DataFrame, requested: list[str] | None = None, null: str | None = NA) -> DataFrame:
    """Fields of the series among ids, with a description made of title and summary."""
    fields, _ = known_fields(table, requested or SERIES_FIELDS)
    rows = table.join(ids.select(F.col(ids.columns[0]).alias("accession")).distinct(), "accession", "left_semi")
    out = _strings(rows.select(*fields), null)
    if {"title", "summary"} <= set(fields):
        out = out.withColumn("description", F.concat(F.lit("Title: "), "title", F.lit(f" {DELIMITER} Summary: "), "summary"))
    return out.withColumnRenamed("accession", "series")
