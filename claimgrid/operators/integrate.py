"""Integration: claims of many sources to entries, sequence-archive ids to samples, samples to series."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgrid.functions.scalar import level_of, split_multi, sra_kind, unquoted
from claimgrid.operators.filters import cleaned, excluded, valid_samples
from claimgrid.operators.ontology import most_specific
from claimgrid.schema import CLAIMS


def from_processed(processed: DataFrame, source: str) -> DataFrame:
    """Claims of one source from its processed table."""
    return processed.select(F.col("accession").alias("entry"), "attribute", F.lit(source).alias("source"), "term_id", "term_name", "ecode")


def combined(tables: dict[str, DataFrame], sources: dict[str, str] | None = None) -> DataFrame:
    """Claims of all sources; a source may be absent. sources: the source of a table's claims, if it isn't the table's name."""
    out = None
    for name, df in tables.items():
        one = from_processed(df, (sources or {}).get(name, name))
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no sources")
    return out.select(*(f.name for f in CLAIMS))


def archive_to_sample(runs: DataFrame, samples: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """(archive_id, entry): runs by way of their experiment, and experiments, to samples whose JSON field names the experiment.

    runs: accession, experiment_accession. samples: accession, sra_experiment (JSON string). overrides are added.
    """
    experiments = samples.where("sra_experiment is not null").select(F.coalesce(F.get_json_object("sra_experiment", "$"), unquoted(F.col("sra_experiment"))).alias("experiment"), F.col("accession").alias("entry"))
    by_run = runs.join(experiments, runs["experiment_accession"] == experiments["experiment"]).select(F.col("accession").alias("archive_id"), "entry")
    out = by_run.union(experiments.select("experiment", "entry"))
    return out if overrides is None else out.union(overrides.select("archive_id", "entry"))


def union_relaxed(*frames: DataFrame) -> DataFrame:
    """Rows of all frames by column name; what a frame lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def json_field(value: Column, field: str, kind: str = "string") -> Column:
    """A field of JSON objects."""
    return F.from_json(value, f"`{field}` {kind}")[field]


def archive_claims(claims: DataFrame, mapping: DataFrame) -> DataFrame:
    """Claims on runs and experiments as claims on samples; projects are left out. An id of two samples gives both a claim."""
    own = claims.where(F.coalesce(sra_kind(F.col("entry")) != "project", F.lit(True)))
    return own.join(mapping.withColumnRenamed("entry", "_sample"), own["entry"] == mapping["archive_id"]).select(F.col("_sample").alias("entry"), "attribute", "source", "term_id", "term_name", "ecode")


def merged(first: DataFrame, second: DataFrame) -> DataFrame:
    """Claims of both; where both say something about the same entry, attribute and source, the second counts."""
    keys = ["entry", "attribute", "source"]
    return second.unionByName(first.join(second.select(*keys).distinct(), keys, "left_anti").select(*second.columns))


def with_archive(claims: DataFrame, mapping: DataFrame) -> DataFrame:
    """Claims on samples, with those on runs and experiments brought to samples; of both on one thing the archive's count."""
    own = claims.where(level_of(F.col("entry")) == "sample")
    return merged(own, archive_claims(claims.where(sra_kind(F.col("entry")).isin("run", "experiment")), mapping))


def merged_entries(first: DataFrame, second: DataFrame) -> DataFrame:
    """One row for each entry of either; of two values the second counts, if it has one."""
    a, b = first.alias("a"), second.alias("b")
    out = a.join(b, F.col("a.entry") == F.col("b.entry"), "full_outer")
    return out.select(F.coalesce("a.entry", "b.entry").alias("entry"), *(F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}")).alias(c) for c in first.columns if c != "entry"))


def sample_entries(samples: DataFrame, series: DataFrame, experiments: DataFrame) -> DataFrame:
    """entry, series, platform, srx, srs, srp of samples.

    samples: accession, platform_id, sra_experiment. series: accession, sample_id (list). experiments: accession,
    sample_accession, study_accession.
    """
    own = series.select(F.col("accession").alias("series"), F.explode("sample_id").alias("entry"))
    own = own.groupBy("entry").agg(F.array_join(F.array_sort(F.collect_set("series")), "|").alias("series"))
    base = samples.select(F.col("accession").alias("entry"), F.col("platform_id").alias("platform"), F.coalesce(F.get_json_object("sra_experiment", "$"), unquoted(F.col("sra_experiment"))).alias("srx"))
    archive = experiments.groupBy(F.col("accession").alias("srx")).agg(F.min("sample_accession").alias("srs"), F.min("study_accession").alias("srp"))
    out = base.join(own, "entry", "left").join(archive, "srx", "left")
    return out.select("entry", *(F.coalesce(F.col(c), F.lit("NA")).alias(c) for c in ("series", "platform", "srx", "srs", "srp")))


def with_organism(entries: DataFrame, channels: DataFrame) -> DataFrame:
    """Entries with the organism of their channels (accession, organism); of several the least, so reruns agree."""
    own = channels.groupBy(F.col("accession").alias("entry")).agg(F.min(F.lower("organism")).alias("organism"))
    return entries.join(own, "entry")


def sample_database(claims: DataFrame, entries: DataFrame, closure: DataFrame | None = None, systems: DataFrame | None = None, deleted: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Claims and entries of the sample level: valid organisms, no excluded ids, known attributes, and of tissues and diseases
    the most specific terms within the systems."""
    entries = sample_catalogue(entries, deleted)
    claims = sample_claims(claims, entries, closure, systems)
    return claims, entries.join(claims.select("entry").distinct(), "entry", "left_semi")


def sample_catalogue(entries: DataFrame, deleted: DataFrame | None = None) -> DataFrame:
    """Entries of a valid organism without excluded ids."""
    entries = valid_samples(entries)
    return entries if deleted is None else excluded(entries, deleted, "entry")


def sample_claims(claims: DataFrame, entries: DataFrame, closure: DataFrame | None = None, systems: DataFrame | None = None) -> DataFrame:
    """Claims of some entries: known attributes, and of tissues and diseases the most specific terms within the systems."""
    claims = cleaned(claims).join(entries.select("entry"), "entry", "left_semi")
    if closure is not None:
        of_ontology = F.col("attribute").isin("tissue", "disease")
        claims = most_specific(claims.where(of_ontology), closure, systems).unionByName(claims.where(~of_ontology))
    return claims


def nested(claims: DataFrame) -> DataFrame:
    """One row for each entry with a map source -> (id, ecode) for each attribute. Claims are dealt by entry once, for both
    groupings, as they are: sets of terms in the making are larger than the rows."""
    claims = claims.select("entry", "attribute", "source", "term_id", "ecode").repartition("entry")
    by = claims.groupBy("entry", "attribute", "source").agg(F.array_join(F.array_sort(F.collect_set("term_id")), "|").alias("id"), F.min(F.struct("term_id", "ecode"))["ecode"].alias("ecode"))
    maps = [F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("attribute") == a, F.struct("source", F.struct("id", "ecode")))))).alias(a) for a in ("tissue", "disease", "sex", "age")]
    return by.groupBy("entry").agg(*maps)


def unnested(nested: DataFrame) -> DataFrame:
    """Claims from rows with a map for each attribute."""
    out = None
    for a in ("tissue", "disease", "sex", "age"):
        one = nested.select("entry", F.lit(a).alias("attribute"), F.explode(a).alias("source", "v"))
        one = one.select("entry", "attribute", "source", F.explode(split_multi("v.id")).alias("term_id"), F.lit(None).cast("string").alias("term_name"), F.col("v.ecode").alias("ecode"))
        out = one if out is None else out.unionByName(one)
    return out
