"""The stages of a build, from processed claims to the tables that requests read.

Under the root lie ``claims/level=<level>/attribute=<attribute>``, ``entries/level=<level>``, ``technologies``, ``closure``,
``terms``, ``synonyms`` and ``search_index``; badges and overlaps in folders of their own; what stages hand on in ``geo_claims`` and
``archive_claims``.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgrid.functions.scalar import level_of
from claimgrid.operators import aggregate, integrate, ontology, report, search, search_index
from claimgrid.operators.filters import excluded, valid_series
from claimgrid.plans.pipeline import Pipeline, StageTable, fingerprint
from claimgrid.schema import LEVELS
from claimgrid.sinks import database_rows, save_bson
from claimgrid.sources import processors, registry  # noqa: F401  registers the sources
from claimgrid.sources.readers import claim_tables, id_list, name_lists
from claimgrid.storage import written

#: What a build needs; with ``runs`` and ``samples`` it also brings archive ids to samples, and makes entries if there are none.
NEEDED = ("obo", "systems", "claims", "technologies")
#: What each stage reads: files and parameters by their names among the inputs, and the stages before it.
READS = {
    "relations": (("obo", "technologies", "descriptions"), ("cycles",), ()),
    "search": (("names",), (), ()),
    "geo": (("claims",), (), ()),
    "archive": (("claims", "runs", "samples", "overrides"), (), ()),
    "sample": (("entries", "samples", "series", "experiments", "channels", "deleted"), ("systems",), ("relations", "geo", "archive")),
    "series": (("deleted",), (), ("relations", "sample")),
    "report": ((), (), ("sample", "series")),
    "bson": ((), (), ("sample", "series")),
}
#: Raw catalogue tables from which entries are made.
CATALOGUE = ("samples", "series", "experiments", "channels")


def save(df: DataFrame, path: str, *partition: str) -> None:
    df.write.mode("overwrite").partitionBy(*partition).parquet(path) if partition else df.write.mode("overwrite").parquet(path)


def stages(spark: SparkSession, root: str, inputs: dict[str, str]) -> Pipeline:
    """Stages relations, search, geo, archive, sample, series, report under root.

    inputs: obo, systems (comma-separated ids), claims (folder of processed claims), technologies (Parquet: id, technology);
    entries (Parquet), or samples, series, experiments and channels (Parquet) to make them from; optional: names (JSON),
    runs and overrides (Parquet) of the archive, deleted (text), descriptions (Parquet: entry, level, description), cycles
    (break: edges that close a cycle are left out; otherwise a cycle is an error that names its terms), bson (any value: also write databases in BSON).
    """
    if missing := [k for k in NEEDED if not inputs.get(k)]:
        raise ValueError("the build lacks " + ", ".join(missing))
    at = lambda name: f"{root}/{name}"
    read = lambda name: spark.read.parquet(at(name))
    given = lambda name: spark.read.parquet(inputs[name])
    deleted = id_list(spark, inputs["deleted"]) if "deleted" in inputs else None

    def relations() -> None:
        edges = written(ontology.edges(ontology.stanzas(spark, inputs["obo"])), "edges")
        save(ontology.closure(ontology.without_cycles(edges) if inputs.get("cycles") == "break" else ontology.checked(edges)), at("closure"))
        save(given("technologies"), at("technologies"))
        if "descriptions" in inputs:
            save(given("descriptions"), at("descriptions"), "level")

    def search_tables() -> None:
        if "names" in inputs:
            terms, synonyms = search.term_tables(name_lists(spark, inputs["names"]))
            save(terms, at("terms"))
            save(synonyms, at("synonyms"))
            search_index.build(read("terms"), read("synonyms"), at("search_index"))

    def all_claims() -> DataFrame:
        return integrate.combined(claim_tables(spark, inputs["claims"], registry.names()), registry.sources())

    def geo() -> None:
        """Claims that are on samples as they come."""
        save(all_claims().where(level_of(F.col("entry")) == "sample"), at("geo_claims"))

    def archive() -> None:
        """Claims on runs and experiments, brought to samples; none without the archive's tables. Only overrides may name other
        ids, so without them claims that are on samples already aren't dealt."""
        own = all_claims()
        own = own if "overrides" in inputs else own.where(F.coalesce(level_of(F.col("entry")) != "sample", F.lit(True)))
        if "runs" in inputs and "samples" in inputs:
            mapping = integrate.archive_to_sample(given("runs"), given("samples"), given("overrides") if "overrides" in inputs else None)
            own = integrate.archive_claims(own, mapping)
        else:
            own = own.limit(0)
        save(own, at("archive_claims"))

    def catalogue() -> DataFrame:
        if "entries" in inputs:
            return given("entries")
        return integrate.with_organism(integrate.sample_entries(given("samples"), given("series"), given("experiments")), given("channels"))

    def sample() -> None:
        claims = integrate.merged(read("geo_claims"), read("archive_claims"))
        systems = spark.createDataFrame([(s.strip(),) for s in inputs["systems"].split(",")], "term string")
        entries = written(integrate.sample_catalogue(catalogue(), deleted), "catalogue")
        save(integrate.sample_claims(claims, entries, read("closure"), systems), at("claims/level=sample"), "attribute")
        own = spark.read.parquet(at("claims/level=sample")).select("entry").distinct()  # as written, not made again
        save(entries.join(own, "entry", "left_semi"), at("entries/level=sample"))

    def series() -> None:
        rolled = aggregate.series_claims(spark.read.parquet(at("claims/level=sample")), spark.read.parquet(at("entries/level=sample")))
        own = valid_series(aggregate.series_entries(spark.read.parquet(at("entries/level=sample")))).withColumnRenamed("series", "entry")
        own = own if deleted is None else excluded(own, deleted, "entry")
        own = written(own, "series")
        rolled = written(rolled.join(own.select("entry"), "entry", "left_semi"), "rolled")
        rolled = ontology.most_specific(rolled, read("closure"))
        save(rolled, at("claims/level=series"), "attribute")
        save(own, at("entries/level=series"))

    def databases() -> None:
        """The same claims as annotation databases in BSON, where the store is mounted."""
        for level in LEVELS:
            rows = database_rows(spark.read.parquet(at(f"claims/level={level}")), spark.read.parquet(at(f"entries/level={level}")))
            save_bson(rows, at(f"bson/level={level}"))

    def reports() -> None:
        for level in LEVELS:
            claims = spark.read.parquet(at(f"claims/level={level}"))
            save(report.badges(aggregate.claims_by_source(claims), level, sorted(set(registry.sources().values()))), at(f"badges/level={level}"))
            save(aggregate.overlap(claims), at(f"overlap/level={level}"))

    def inputs_of(stage: str) -> str:
        files, parameters, _ = READS[stage]
        return fingerprint(spark, [inputs[f] for f in files if f in inputs], {p: inputs.get(p) for p in parameters} | {"files": [f for f in files if f in inputs]})

    every = [("relations", relations), ("search", search_tables), ("geo", geo), ("archive", archive), ("sample", sample), ("series", series), ("report", reports), *([("bson", databases)] if inputs.get("bson") else [])]
    return Pipeline(every, StageTable(spark, at("stages")), {n: partial(inputs_of, n) for n, _ in every}, {n: READS[n][2] for n, _ in every})
