"""Command line: python -m claimgrid.cli

Users: setup, search, retrieve, supported, validate, delete. Builders: process, build, combine, ontology, shields, metadata,
package, sources, status, init-config, validate-config. Downloads are left to other tools.
"""

from __future__ import annotations

import argparse
import csv
import json
import os
import shutil
import sys
from datetime import date

from claimgrid import packages, schema, sinks
from claimgrid.plans.pipeline import Checkpoints, environment, merged_config, next_folder, read_config
from claimgrid.plans.retrieval import Database, Request, export, parse_filters, parse_terms, retrieve


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="claimgrid")
    sub = p.add_subparsers(dest="command", required=True)
    s = sub.add_parser("search", help="find ontology terms by words")
    s.add_argument("--data", required=True)
    s.add_argument("--query", required=True)
    s.add_argument("--type", choices=sorted(set(schema.TERM_TYPES.values())))
    s.add_argument("--by-field", action="store_true", help="weighted scores of names and synonyms from the stored index")
    s.add_argument("--conjunctive", action="store_true", help="by field, where it has all words")
    s.add_argument("--ontology", choices=sorted(schema.TERM_TYPES))
    s.add_argument("-k", type=int, default=20)
    r = sub.add_parser("retrieve", help="annotations or labels of entries")
    r.add_argument("attribute", choices=["age", "diseases", "sex", "tissues"])
    r.add_argument("--data", required=True)
    r.add_argument("--terms", default="all")
    r.add_argument("--level", choices=schema.LEVELS, default="sample")
    r.add_argument("--mode", choices=schema.MODES, default="annotate")
    r.add_argument("--direct", action="store_true")
    r.add_argument("--filters", default="species=human,ecode=expert,tech=rnaseq")
    r.add_argument("--license", choices=["any", "permissive", "nc"], default="any")
    r.add_argument("--metadata", default="")
    r.add_argument("--fmt", choices=sinks.FORMATS, default="parquet")
    r.add_argument("--output", required=True)
    r.add_argument("--registry", help="CSV of source, license and whatever is to be cited: citation, doi, url, rights, notes")
    sub.add_parser("supported", help="values that requests take")
    v = sub.add_parser("validate", help="files of a package that are missing or have changed")
    v.add_argument("folder")
    sub.add_parser("sources", help="sources that can be processed")
    t = sub.add_parser("status", help="stages of a build that are done")
    t.add_argument("checkpoint")
    t.add_argument("--clear", action="store_true")
    for name, text in (("setup", "remember where the data lies"), ("delete", "remove the data and forget it")):
        one = sub.add_parser(name, help=text)
        one.add_argument("--config", default=CONFIG)
        if name == "setup":
            one.add_argument("--data", required=True)
    one = sub.add_parser("process", help="claims of a source from its raw files, or from tables of its raw frames")
    one.add_argument("source")
    one.add_argument("--raw", action="append", default=[], metavar="NAME=PATH", help="a Parquet table for each raw frame")
    one.add_argument("--raw-files", action="append", default=[], metavar="NAME=PATH[,PATH]", help="files of each raw frame as the source gives them")
    one.add_argument("--layouts", help="JSON or YAML: frame -> what differs from the source's usual layout")
    one.add_argument("--rejects", help="folder of the rows that can't be read; by default OUTPUT-rejects")
    one.add_argument("--obo", required=True)
    one.add_argument("--tissue-systems", required=True)
    one.add_argument("--disease-systems", required=True)
    one.add_argument("--output", required=True)
    one = sub.add_parser("build", help="all stages from processed claims to tables")
    one.add_argument("--config", required=True)
    one.add_argument("--start")
    one.add_argument("--end")
    one.add_argument("--skip", default="")
    one.add_argument("--again", metavar="STAGE", help="this stage and all that follow it run again")
    one = sub.add_parser("combine", help="one step of a build")
    one.add_argument("step", choices=["geo", "sra", "sample", "series"])
    one.add_argument("--config", required=True)
    one = sub.add_parser("ontology", help="the relations of terms, or the tables of the search")
    one.add_argument("step", choices=["relations", "search-db"])
    one.add_argument("--config", required=True)
    one = sub.add_parser("shields", help="a badge file for each source and level")
    one.add_argument("--data", required=True)
    one.add_argument("--output", required=True)
    one = sub.add_parser("metadata", help="descriptive metadata of samples or series")
    one.add_argument("level", choices=["sample", "series", "list-fields"])
    one.add_argument("--table", required=True)
    one.add_argument("--ids")
    one.add_argument("--fields", default="")
    one.add_argument("--output")
    one = sub.add_parser("package", help="write a folder's manifest")
    one.add_argument("folder")
    one.add_argument("--from", dest="sources", action="append", default=[], help="a file or folder to copy in first")
    one.add_argument("--overwrite", action="store_true")
    for name in ("init-config", "validate-config"):
        sub.add_parser(name, help="a build's configuration").add_argument("path")
    return p


CONFIG = os.path.join(os.path.expanduser("~"), ".claimgrid.json")
#: What a build's configuration names.
INPUTS = ("root", "obo", "claims", "systems", "technologies")
#: Steps of a build by the names of the command line.
STEPS = {"geo": "geo", "sra": "archive", "sample": "sample", "series": "series", "relations": "relations", "search-db": "search"}


def config(path: str) -> dict:
    """A build's configuration, with values of the environment on top; ValueError if something is missing."""
    out = merged_config(read_config(path), environment("CLAIMGRID"))
    if missing := [k for k in INPUTS if not out.get(k)]:
        raise ValueError("the configuration lacks " + ", ".join(missing))
    return out


def registry_of(path: str) -> dict[str, dict[str, str]]:
    """What a CSV with a column ``source`` says about each source."""
    with open(path, newline="", encoding="utf-8-sig") as f:
        return {r["source"]: {k: v for k, v in r.items() if k != "source" and v} for r in csv.DictReader(f)}


def _local(a: argparse.Namespace) -> int | None:
    """Commands that need no Spark; None if the command isn't one of them."""
    if a.command == "setup":
        sinks.save_json({"data": os.path.abspath(a.data)}, a.config)
    elif a.command == "delete":
        with open(a.config) as f:
            data = json.load(f)["data"]
        if not os.path.exists(os.path.join(data, "MANIFEST.md5")):
            print(f"{data} isn't a package; nothing is deleted", file=sys.stderr)
            return 1
        shutil.rmtree(data)
        os.remove(a.config)
    elif a.command == "init-config":
        sinks.save_json(dict.fromkeys(INPUTS, ""), a.path)
    elif a.command == "validate-config":
        try:
            config(a.path)
        except ValueError as e:
            print(e, file=sys.stderr)
            return 1
    else:
        return None
    return 0


def _process(spark, a: argparse.Namespace) -> None:
    from claimgrid.operators import ontology
    from claimgrid.sources import ingest, processors, registry  # noqa: F401  registers the sources
    from claimgrid.storage import written

    if bool(a.raw) == bool(a.raw_files):
        raise ValueError("either --raw or --raw-files")
    terms = ontology.stanzas(spark, a.obo)
    closed = ontology.closure(ontology.checked(written(ontology.edges(terms), "edges")))
    inside = lambda ids: ontology.system_descendants(closed, spark.createDataFrame([(t,) for t in ids.split(",")], "term string"))
    foreign = {p: ontology.reverse_xrefs(ontology.placed_xrefs(terms, p)) for p in ("DOID", "MESH", "UMLS")}
    ctx = registry.Context(inside(a.tissue_systems), inside(a.disease_systems), ontology.term_names(terms), foreign)
    pairs = lambda given: dict(x.split("=", 1) for x in given)
    if a.raw_files:
        own = ingest.ingest(spark, a.source, pairs(a.raw_files), read_config(a.layouts) if a.layouts else None)
        ingest.save_rejects(own.rejects, a.rejects or f"{a.output.rstrip('/')}-rejects", a.source)
        raw = own.frames
    else:
        raw = {name: spark.read.parquet(path) for name, path in pairs(a.raw).items()}
    registry.save(registry.process(a.source, ctx, **raw), a.output, a.source)


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    if a.command == "supported":
        for name in ("ATTRIBUTES", "LEVELS", "MODES", "TECHNOLOGIES", "SAMPLE_METADATA", "SERIES_METADATA"):
            print(f"{name.lower()}: {', '.join(getattr(schema, name))}")
        print(f"species: {', '.join(schema.SPECIES)}\necodes: {', '.join(schema.ECODES)}\nages: {', '.join(g for g, _, _ in schema.AGE_GROUPS)}")
        return 0
    if a.command == "sources":
        from claimgrid.sources import processors, registry  # noqa: F401  registers the sources

        print("\n".join(registry.names()))
        return 0
    if a.command == "status":
        state = Checkpoints.load(a.checkpoint)
        if a.clear:
            state.clear()
        print("\n".join(f"{x['stage']}  {x['at']}" for x in state.done) or "no stage is done")
        return 0
    if (code := _local(a)) is not None:
        return code
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("claimgrid").getOrCreate()
    if a.command == "package":
        print(packages.package(spark, a.folder, a.overwrite, a.sources))
        return 0
    if a.command == "validate":
        bad = 0
        for r in packages.changed(spark, a.folder).orderBy("name").toLocalIterator():
            print(f"{r['name']}  {r['state']}")
            bad = 1
        if not bad:
            print("all files are as packaged")
        return bad
    if a.command == "search":
        from claimgrid.operators import search_index
        from claimgrid.operators.search import search

        if a.by_field or a.conjunctive:
            search_index.search(spark, f"{a.data}/search_index", a.query, a.k, a.type, a.ontology, conjunctive=a.conjunctive).show(a.k, truncate=80)
            return 0
        search(spark.read.parquet(f"{a.data}/terms"), spark.read.parquet(f"{a.data}/synonyms"), a.query, a.k, a.type, a.ontology).show(a.k, truncate=80)
        return 0
    if a.command == "process":
        _process(spark, a)
        return 0
    if a.command == "build":
        from claimgrid.plans.build import stages

        inputs = config(a.config)
        plan = stages(spark, inputs["root"], inputs)
        if a.again:
            plan.clear(a.again)
        print("\n".join(plan.run(a.start, a.end, tuple(filter(None, a.skip.split(","))))))
        return 0
    if a.command in ("combine", "ontology"):
        from claimgrid.plans.build import stages

        inputs, step = config(a.config), STEPS[a.step]
        print("\n".join(stages(spark, inputs["root"], inputs).run(step, step, resume=False)))
        return 0
    if a.command == "shields":
        from claimgrid.sources.readers import parquet_if_there

        for level in schema.LEVELS:
            if (badges := parquet_if_there(spark, f"{a.data}/badges/level={level}")) is not None:
                print("\n".join(sinks.save_badges(badges, a.output)))
        return 0
    if a.command == "metadata":
        from claimgrid.operators import metadata

        table = spark.read.parquet(a.table)
        if a.level == "list-fields":
            print("\n".join([*(c for c in table.columns if c != "channels"), *metadata.channel_fields(table)]))
            return 0
        make = metadata.sample_metadata if a.level == "sample" else metadata.series_metadata
        sinks.write(make(table, spark.read.parquet(a.ids), list(filter(None, a.fields.split(",")))), a.output, sort_by=a.level)
        return 0
    attribute = {"tissues": "tissue", "diseases": "disease"}.get(a.attribute, a.attribute)
    request = Request(attribute, parse_terms(a.terms, attribute), a.level, "direct" if a.direct else a.mode, licence=a.license, fmt=a.fmt, metadata=[x for x in a.metadata.split(",") if x], **parse_filters(a.filters))
    credits = registry_of(a.registry) if a.registry else {}
    licences = {name: info["license"] for name, info in credits.items() if info.get("license")}
    db = Database.load(spark, a.data, a.level, {**schema.LICENCES, **licences})
    result = retrieve(db, request)
    if result.missing:
        print("unknown terms: " + ", ".join(result.missing), file=sys.stderr)
    local = "://" not in a.output
    output = next_folder(a.output) if local else a.output
    text = export(result, db, request, output, credits, date.today().isoformat())
    if local:
        with open(f"{output}.citation.txt", "w") as f:
            f.write(text)
    print(text, end="")
    return 0


if __name__ == "__main__":
    sys.exit(main())
