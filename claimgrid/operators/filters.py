"""Filters over claims and entries. Membership in small fixed sets is a pushed-down IN; in tables, a semi join."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgrid.functions.scalar import is_na, split_multi
from claimgrid.schema import ATTRIBUTES, CONTROL_ID, ECODES, LICENCES, NA, NA_BUILD, NA_QUERY, ORGANISMS


class NoResults(ValueError):
    """Nothing is left of a request."""


def without_na(df: DataFrame, *columns: str, absent: tuple[str, ...] = NA_QUERY) -> DataFrame:
    """Rows whose columns all hold a value."""
    for c in columns:
        df = df.where(~is_na(F.col(c), absent))
    return df


def staged(df: DataFrame, anchor: str, level: str) -> DataFrame:
    """Rows with an anchor (id or value); at series level without NA series and the sample column."""
    df = without_na(df, anchor)
    return df if level == "sample" else df.where(F.col(level) != NA).drop("sample")


def allowed_sources(licence: str, registry: dict[str, str] = LICENCES) -> list[str] | None:
    """Lower-cased names of the sources under a licence category; None: all. nc means non-commercial sources only."""
    if licence not in ("any", "permissive", "nc"):
        raise ValueError(f"licence {licence!r} is none of any, permissive, nc")
    return None if licence == "any" else sorted(s.lower() for s, kind in registry.items() if kind == licence)


def of_licence(claims: DataFrame, licence: str, registry: dict[str, str] = LICENCES) -> DataFrame:
    allowed = allowed_sources(licence, registry)
    return claims if allowed is None else claims.where(F.lower("source").isin(*allowed) if allowed else F.lit(False))


def of_ecode(claims: DataFrame, ecode: str) -> DataFrame:
    if ecode not in ECODES:
        raise ValueError(f"ecode {ecode!r} is none of {', '.join(ECODES)}")
    return claims.where(F.col("ecode").isin(*ECODES[ecode]))


def of_species(entries: DataFrame, organism: str, strict: bool = True) -> DataFrame:
    """Entries of an organism. strict: the whole value is equal, so an entry of several organisms never matches."""
    return entries.where(F.col("organism") == organism if strict else F.array_contains(split_multi("organism"), organism))


def of_technology(entries: DataFrame, technology_map: DataFrame, technology: str, strict: bool = True) -> DataFrame:
    """Entries whose platform is of a technology, by a map (id, technology)."""
    ids = technology_map.where(F.col("technology") == technology).select("id").distinct()
    if strict:
        return entries.join(ids, entries["platform"] == ids["id"], "left_semi")
    own = entries.select("entry", F.explode(split_multi("platform")).alias("id")).join(ids, "id", "left_semi")
    return entries.join(own.select("entry").distinct(), "entry", "left_semi")


def select_claims(claims: DataFrame, entries: DataFrame, attribute: str, organism: str | None = None, ecode: str = "any", licence: str = "any", technology_map: DataFrame | None = None, technology: str | None = None, strict: bool = True, registry: dict[str, str] = LICENCES) -> DataFrame:
    """Claims of one attribute that pass all filters; a claim needs an entry."""
    chosen = of_licence(of_ecode(claims.where(F.col("attribute") == attribute), ecode), licence, registry)
    if organism is not None:
        entries = of_species(entries, organism, strict)
    if technology is not None:
        entries = of_technology(entries, technology_map, technology, strict)
    return chosen.join(entries.select("entry"), "entry", "left_semi")


def required(df: DataFrame, what: str = "the request") -> DataFrame:
    """df, or NoResults if it is empty; the only filter that runs a job."""
    if df.isEmpty():
        raise NoResults(f"no results for {what}")
    return df


def excluded(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """df without the ids of an exclusion list, a frame of one column."""
    ids = ids.select(F.col(ids.columns[0]).alias(on)).distinct()
    return df.join(ids, on, "left_anti")


def valid_samples(entries: DataFrame, organisms: Iterable[str] = ORGANISMS) -> DataFrame:
    return entries.where(F.col("organism").isin(*organisms))


def valid_series(entries: DataFrame, organisms: Iterable[str] = ORGANISMS) -> DataFrame:
    """Series with a valid organism; the others of their organisms are dropped from the list."""
    kept = F.array_intersect(split_multi("organism"), F.array(*(F.lit(o) for o in organisms)))
    return entries.withColumn("organism", kept).where(F.size("organism") > 0).withColumn("organism", F.array_join("organism", "|"))


def cleaned(claims: DataFrame) -> DataFrame:
    """Claims of a known attribute with a real term."""
    return claims.where(F.col("attribute").isin(*ATTRIBUTES)).where(~is_na(F.lower("term_id"), tuple({x.lower() for x in NA_BUILD})))


def known_terms(requested: DataFrame, closure: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requested terms that the ontology has, and the others."""
    have = closure.select(F.col("ancestor").alias("term")).distinct()
    return requested.join(have, "term", "left_semi"), requested.join(have, "term", "left_anti")


def within(claims: DataFrame, terms: DataFrame, keep_control: bool = True, control: str = CONTROL_ID) -> DataFrame:
    """Claims whose term is among terms (a column ``term``); controls may pass."""
    inside = claims.join(terms.select(F.col("term").alias("term_id")).distinct(), "term_id", "left_semi").select(*claims.columns)
    return inside.unionByName(claims.where(F.col("term_id") == control)) if keep_control else inside


def removed(df: DataFrame, predicate: Column) -> DataFrame:
    """df without the rows that meet a predicate; where it is null a row stays."""
    return df.where(~F.coalesce(predicate, F.lit(False)))
