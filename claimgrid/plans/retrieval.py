"""A request as a lazy plan: filter, compile, curate, export. Nothing runs before an export or a check for emptiness."""

from __future__ import annotations

import csv
import os
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgrid import sinks
from claimgrid.operators.aggregate import compiled, counts_from_lists
from claimgrid.operators.curate import Curation, direct
from claimgrid.operators.filters import NoResults, required, select_claims
from claimgrid.schema import ATTRIBUTES, CONTROL_ID, ECODES, LEVELS, MODES, NEGATIVE, SEXES, SPECIES, TECHNOLOGIES, AGE_GROUPS
from claimgrid.sources.readers import SAMPLE_ACCESSIONS, bson_map, database_claims, database_entries, parquet_if_there
from claimgrid.storage import written


@dataclass(frozen=True)
class Database:
    """The frames that requests read."""

    claims: DataFrame
    entries: DataFrame
    technologies: DataFrame
    closure: DataFrame | None = None
    descriptions: DataFrame | None = None
    licences: dict[str, str] | None = None

    @staticmethod
    def load(spark: SparkSession, root: str, level: str = "sample", licences: dict[str, str] | None = None) -> Database:
        """The tables that a build writes under a folder, of one level."""
        at = lambda name: spark.read.parquet(f"{root}/{name}")
        descriptions = parquet_if_there(spark, f"{root}/descriptions/level={level}")
        return Database(at(f"claims/level={level}"), at(f"entries/level={level}"), at("technologies"), at("closure"), descriptions, licences)

    @staticmethod
    def of_bson(spark: SparkSession, path: str, technologies: DataFrame, closure: DataFrame | None = None, descriptions: DataFrame | None = None, licences: dict[str, str] | None = None) -> Database:
        """An annotation database in BSON, of one level, beside the technologies and the closure that it is asked with. It is
        parsed once, to a table in the shared folder."""
        rows = written(bson_map(spark, path), "database")
        entries = database_entries(rows)
        kept = [c for c in entries.columns if c in ("entry", "organism") or c in SAMPLE_ACCESSIONS]
        return Database(database_claims(rows), entries.select(*kept), technologies, closure, descriptions, licences)


@dataclass(frozen=True)
class Request:
    attribute: str
    terms: str | list[str] = "all"
    level: str = "sample"
    mode: str = "annotate"
    species: str = "human"
    ecode: str = "expert"
    technology: str = "rnaseq"
    licence: str = "any"
    metadata: list[str] = field(default_factory=list)
    fmt: str = "parquet"
    #: Whether a series of several organisms or platforms matches none of them, as it does by default.
    strict: bool = True

    def __post_init__(self):
        for name, value, allowed in (
            ("attribute", self.attribute, ATTRIBUTES), ("level", self.level, LEVELS), ("mode", self.mode, MODES), ("species", self.species, SPECIES),
            ("ecode", self.ecode, ECODES), ("technology", self.technology, TECHNOLOGIES), ("licence", self.licence, ("any", "permissive", "nc")), ("format", self.fmt, sinks.FORMATS),
        ):
            if value not in allowed:
                raise ValueError(f"{name} {value!r} is none of {', '.join(allowed)}")
        if self.attribute in ("sex", "age") and self.mode != "direct":
            object.__setattr__(self, "mode", "direct")  # these have no ontology


def parse_filters(text: str) -> dict[str, str]:
    """species=human,ecode=expert,tech=rnaseq"""
    out = {}
    for part in filter(None, (p.strip() for p in text.split(","))):
        name, sep, value = part.partition("=")
        if not sep or name not in ("species", "ecode", "tech"):
            raise ValueError(f"filter {part!r} isn't species=, ecode= or tech=")
        out["technology" if name == "tech" else name] = value
    return out


def parse_terms(text: str, attribute: str) -> str | list[str]:
    """all, a list joined by commas, a CSV file with a column ``term`` (or ``id``, or its first), or another file with a term on
    each line; sexes become M and F."""
    if text == "all":
        return text
    if os.path.isfile(text):
        with open(text, encoding="utf-8-sig", newline="") as f:
            if text.endswith(".csv"):
                rows = csv.DictReader(f)
                column = next((c for c in rows.fieldnames or [] if c.lower() in ("term", "term_id", "id")), (rows.fieldnames or [""])[0])
                names = [x.strip() for r in rows if (x := r.get(column)) and x.strip()]
            else:
                names = [x.strip() for x in f if x.strip()]
    else:
        names = [x.strip() for x in text.split(",") if x.strip()]
    if attribute == "sex":
        names = [SEXES.get(n.lower(), n) for n in names]
    if attribute == "age" and (odd := [n for n in names if n not in {g for g, _, _ in AGE_GROUPS}]):
        raise ValueError(f"no age groups: {', '.join(odd)}")
    return list(dict.fromkeys(names))


@dataclass(frozen=True)
class Result:
    curation: Curation
    targets: list[str]
    missing: list[str]
    labelled: bool
    sources: DataFrame


def retrieve(db: Database, request: Request) -> Result:
    """The curation that a request asks for. Collected: only the names of target terms, which the caller named or the ontology
    has; joins take them as a frame."""
    spark = db.claims.sparkSession
    chosen = select_claims(db.claims, db.entries, request.attribute, SPECIES[request.species], request.ecode, request.licence, db.technologies, request.technology, strict=request.strict, **({"registry": db.licences} if db.licences else {}))
    columns = [c for c in db.entries.columns if c in ("entry", "sample", "series", "platform", "srx", "srs", "srp")]
    long = compiled(chosen, db.entries.select(*columns))
    entries = long.drop("id", "value")
    cells = chosen.select("entry", F.col("term_id").alias("term")).distinct()
    curation = Curation(cells, entries, collapsed=request.level == "series")  # series have no controls of their own
    asked = None if request.terms == "all" else spark.createDataFrame([(t,) for t in request.terms], "term string")
    have = cells if request.mode == "direct" else db.closure.select(F.col("ancestor").alias("term"))
    have = have.select("term").distinct()
    found = {r["term"] for r in (have if asked is None else have.join(F.broadcast(asked), "term", "left_semi")).collect()}
    targets = sorted(found) if asked is None else [t for t in request.terms if t in found]
    missing = [] if asked is None else [t for t in request.terms if t not in found]
    if not targets:
        raise NoResults("none of the terms occurs" if request.mode == "direct" else "the ontology has none of the terms")
    wanted = have if asked is None else asked
    if request.mode == "direct":
        own = curation if asked is None else replace(curation, cells=direct(cells, asked))
        return Result(own, targets, missing, False, entries)
    if request.mode == "annotate":
        return Result(curation.propagate(db.closure, wanted), targets, missing, False, entries)
    return Result(curation.labels(db.closure, wanted, CONTROL_ID), targets, missing, True, entries)


def export(result: Result, db: Database, request: Request, path: str, credits: dict[str, dict[str, str]] | None = None, today: str | None = None) -> str:
    """Writes a result, and returns what to cite for it; raises NoResults if it is empty.

    credits: what is known of each source. JSON is written as rows (term, entry, metadata), sorted by term.
    """
    c = result.curation
    required(c.cells)
    index = "sample" if request.level == "sample" else "series"
    metadata, _ = sinks.metadata_columns(request.metadata, request.level, index)
    have = c.cells.select("entry").distinct()
    entries = c.entries if result.labelled else c.entries.join(have, "entry", "left_semi")
    entries = sinks.described(entries, db.descriptions) if "description" in metadata and db.descriptions is not None else entries
    if request.fmt == "json":
        targets = c.cells.sparkSession.createDataFrame([(t,) for t in result.targets], "term string")
        rows = sinks.label_rows(c.cells, entries, targets, metadata) if result.labelled else sinks.json_rows(c.cells, entries, metadata)
        sinks.write(rows, path, "json", sort_by=["term", "entry"])
    elif result.labelled:
        sinks.save_wide(c.cells, entries, result.targets, metadata, path, request.fmt, absent=NEGATIVE, sort_by=["series", "entry"] if "series" in entries.columns else "entry")
    else:
        sinks.save_wide(c.cells, entries, result.targets, metadata, path, request.fmt)
    asked = {"attribute": request.attribute, "terms": request.terms if isinstance(request.terms, str) else ", ".join(request.terms), "level": request.level, "species": request.species, "ecode": request.ecode, "tech": request.technology, "mode": request.mode, "license": request.licence}
    return sinks.citation(source_counts(result), credits or {}, **({"date": today} if today else {}), **asked)


def source_counts(result: Result) -> DataFrame:
    return counts_from_lists(result.curation.entries if "sources" in result.curation.entries.columns else result.sources)
