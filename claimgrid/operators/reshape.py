"""Reshaping: one-hot pivots, unpivots, exploding delimited lists, flattening nested channels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimgrid.functions.scalar import get, split_multi
from claimgrid.schema import NA_QUERY, SCOPE_WEIGHTS


def exploded(df: DataFrame, column: str, delimiter: str = "|", keep_empty: bool = False) -> DataFrame:
    """A row for each part of a delimited column, trimmed."""
    out = df.withColumn(column, F.explode(split_multi(column, delimiter))).withColumn(column, F.trim(column))
    return out if keep_empty else out.where(F.col(column) != "")


def cells(long: DataFrame, anchor: str = "id") -> DataFrame:
    """(entry, term): sparse one-hot cells of long annotations; absent terms are left out."""
    each = exploded(long.select("entry", F.col(anchor).alias("term")), "term")
    return each.where(~F.col("term").isin(*NA_QUERY)).distinct()


def one_hot(cells: DataFrame, terms: list[str], index: str = "entry", column: str = "term") -> DataFrame:
    """A 0/1 column for each term, in the order of terms. Their number is bounded by spark.sql.pivotMaxValues."""
    wide = cells.groupBy(index).pivot(column, terms).agg(F.lit(1))
    return wide.select(index, *(F.coalesce(F.col(f"`{t}`"), F.lit(0)).cast("int").alias(t) for t in terms))


def unpivoted(wide: DataFrame, index: str, names: tuple[str, str] = ("term", "value"), keep_zero: bool = False) -> DataFrame:
    """A row for each cell of a wide frame that isn't 0."""
    values = [c for c in wide.columns if c != index]
    out = wide.unpivot([index], values, *names)
    return out if keep_zero else out.where(F.col(names[1]) != 0)


def split_fields(df: DataFrame, column: str, names: list[str], delimiter: str = "|") -> DataFrame:
    """A delimited column as named columns; rows with another number of fields are dropped."""
    parts = split_multi(column, delimiter)
    df = df.where(F.size(parts) == len(names))
    return df.select(*(c for c in df.columns if c != column), *(get(parts, i).alias(n) for i, n in enumerate(names)))


def flat_channels(df: DataFrame, fields: list[str], channels: str = "channels", n: int = 2) -> DataFrame:
    """Fields of the first n of an array of channel structs as columns <field>_ch<i>; characteristics as tag: value."""
    out = []
    for i in range(n):
        ch = get(F.col(channels), i)
        for f in fields:
            value = ch[f]
            if f == "characteristics":
                value = F.array_join(F.transform(value, lambda x: F.concat_ws(": ", x["tag"], x["value"])), "|")
            out.append(value.alias(f"{f}_ch{i + 1}"))
    return df.select(*(c for c in df.columns if c != channels), *out)


def synonyms_by_scope(synonyms: DataFrame) -> DataFrame:
    """term_id and an array of synonyms for each scope, as syn_<scope>; an unknown or absent scope counts as RELATED."""
    scope = F.when(F.col("scope").isin(*SCOPE_WEIGHTS), F.col("scope")).otherwise("RELATED")
    scoped = synonyms.withColumn("scope", scope)
    lists = [F.array_sort(F.collect_set(F.when(F.col("scope") == s, F.col("synonym")))).alias(f"syn_{s.lower()}") for s in SCOPE_WEIGHTS]
    return scoped.groupBy("term_id").agg(*lists)


def swapped(mapping: DataFrame) -> DataFrame:
    """A two-column map turned around; of values that clash the least key stays."""
    k, v = mapping.columns
    return mapping.groupBy(v).agg(F.min(k).alias(k))
