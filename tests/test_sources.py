"""Readers, the thirteen sources on tiny raw tables, the ontology parser, integration, exports, plans, command line."""

import gzip
import json

import pytest

from claimgrid import cli, packages, sinks
from claimgrid.functions import scalar as S
from claimgrid.operators import aggregate, filters, integrate, ontology, report
from claimgrid.plans import build, pipeline
from claimgrid.sources import processors, readers, registry

OBO = """format-version: 1.2

[Term]
id: MONDO:1
name: Disease System

[Term]
id: MONDO:2
name: Flu
xref: DOID:8
xref: DOID:9
xref: MESH:D1
xref: UMLS:C1
is_a: MONDO:1 ! disease system

[Term]
id: UBERON:1
name: body system

[Term]
id: UBERON:2
name: Lung
is_a: UBERON:1 ! x
relationship: develops_from UBERON:9

[Term]
id: CL:1
name: lung cell
relationship: part_of UBERON:2 ! lung

[Term]
id: MONDO:9
name: old
is_obsolete: true

[Typedef]
id: part_of
name: part of
"""


@pytest.fixture(scope="module")
def terms(spark, tmp_path_factory):
    p = tmp_path_factory.mktemp("obo") / "small.obo.gz"
    with gzip.open(p, "wt") as f:
        f.write(OBO)
    return ontology.stanzas(spark, str(p)).cache()


@pytest.fixture(scope="module")
def ctx(spark, terms):
    closed = ontology.closure(ontology.edges(terms))
    system = lambda t: ontology.system_descendants(closed, spark.createDataFrame([(t,)], "term string")).cache()
    to = {p: ontology.reverse_xrefs(ontology.placed_xrefs(terms, p)).select("xref", "id") for p in ("DOID", "MESH", "UMLS")}
    return registry.Context(system("UBERON:1"), system("MONDO:1"), ontology.term_names(terms), to)


def frame(spark, columns, *rows):
    return spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"`{c}` string" for c in columns))


def run(name, ctx, **raw):
    return sorted((r.accession, r.attribute, r.term_id, r.term_name) for r in registry.process(name, ctx, **raw).collect())


def test_obo(terms):
    assert terms.count() == 5
    assert {r.id: r.name for r in ontology.term_names(terms).collect()}["MONDO:2"] == "flu"
    assert sorted(map(tuple, ontology.edges(terms).collect())) == [("MONDO:1", "MONDO:2"), ("UBERON:1", "UBERON:2"), ("UBERON:2", "CL:1")]
    assert [tuple(r) for r in ontology.xrefs(terms, "DOID").collect()] == [("MONDO:2", "DOID:8")]


def test_ale(spark, ctx):
    raw = frame(spark, ["accession", "brenda", "age_months", "gender"], ("GSM1", "b1", "252", "F"), ("GSM1", "b1", "252", "F"), ("GSM2", "b9", "12", "M"), ("GSM3", "b2", None, "x"))
    tissues = frame(spark, ["brenda", "uberon", "uberon_name"], ("b1", "UBERON:2", "lung"), ("b2", "UBERON:1", "system"))
    assert run("ALE", ctx, raw=raw, tissues=tissues) == [("GSM1", "age", "adult", "adult"), ("GSM1", "sex", "F", "female"), ("GSM1", "tissue", "UBERON:2", "lung")]


def test_bgee(spark, ctx):
    raw = frame(spark, ["Run IDs", "Expression mapped anatomical entity ID", "Expression mapped anatomical entity name", "Expression mapped stage ID", "Expression mapped stage name", "Expression mapped sex"], ("SRR1|SRR2", "CL:1", "lung cell", "S:1", "adult", "male"), ("SRR3", "UBERON:1", "system", None, None, "mixed"))
    got = run("BGee", ctx, raw=raw)
    assert got == [x for s in ("SRR1", "SRR2") for x in [(s, "developmental_stage", "S:1", "adult"), (s, "sex", "M", "male"), (s, "tissue", "CL:1", "lung cell")]]


def test_cello(spark, ctx, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"GSM1": ["CL:1", "CL:404"], "GSM2": [], "GSM3": ["UBERON:1"]}, indent=1))
    raw = readers.json_map(spark, str(tmp_path / "c.json"), "array<string>")
    assert run("Cello", ctx, raw=raw) == [("GSM1", "tissue", "CL:1", "lung cell")]


def test_creeds(spark, ctx, tmp_path):
    rows = [{"organism": "human", "do_id": "DOID:8", "disease_name": "flu", "pert_ids": ["GSM1"], "ctrl_ids": ["GSM2"]}, {"organism": "mouse", "do_id": "DOID:8", "pert_ids": ["GSM3"], "ctrl_ids": []}, {"organism": "human", "do_id": "DOID:404", "pert_ids": ["GSM4"], "ctrl_ids": ["GSM5"]}, {"organism": "human", "do_id": None, "pert_ids": ["GSM6"], "ctrl_ids": []}]
    (tmp_path / "c.json").write_text(json.dumps(rows))
    raw = readers.json_array(spark, str(tmp_path / "c.json"), "organism string, do_id string, disease_name string, pert_ids array<string>, ctrl_ids array<string>")
    assert run("CREEDS", ctx, raw=raw) == [("GSM1", "disease", "MONDO:2", "flu"), ("GSM2", "disease", "MONDO:0000000", "control")]


def test_disign_atlas(spark, ctx, tmp_path):
    line = "GSE1|GSM1;GSM2|GSM3;SRR4|GPL1|x|Flu|C1|Lung|d|s|human"
    (tmp_path / "d.gmt").write_text(f"d1\t{line}\tgene\nd2\ttoo|few\n")
    got = run("DiSignAtlas", ctx, raw=readers.gmt(spark, str(tmp_path / "d.gmt")), tissues=frame(spark, ["name", "id"], ("lung", "UBERON:2")), corrections=frame(spark, ["sample", "term", "name"], ("GSM2", "CL:1", "lung cell")))
    assert got == [("GSM1", "disease", "MONDO:0000000", "control"), ("GSM1", "tissue", "UBERON:2", "lung"), ("GSM2", "disease", "MONDO:0000000", "control"), ("GSM2", "tissue", "CL:1", "lung cell"), ("GSM3", "disease", "MONDO:2", "flu"), ("GSM3", "tissue", "UBERON:2", "lung")]


def test_gemma(spark, ctx):
    c = lambda cat, uri, v: (cat, uri, v)
    rows = [("GSE1", [c("organism part", "http://x/UBERON_2", "Lung"), c("biological sex", "http://x/PATO_0000384", "male"), c("developmental stage", "http://x/S_1", "adult stage"), c("developmental stage", "http://x/S_2", "odd"), c("treatment", "u", "v"), c("disease", "http://x/MONDO_2", "Flu"), c("disease", None, "none"), c("biological sex", "http://x/UBERON_0007222", "late adult stage")]), ("E-1", [c("disease", "http://x/MONDO_2", "Flu")])]
    raw = spark.createDataFrame(rows, "accession string, characteristics array<struct<category:string,valueUri:string,value:string>>")
    stages = frame(spark, ["term_id", "age_group"], ("S:1", "adult"), ("S:2", None))
    assert run("Gemma", ctx, raw=raw, stages=stages) == [("GSE1", "age", "adult", "adult stage"), ("GSE1", "disease", "MONDO:2", "flu"), ("GSE1", "sex", "M", "male"), ("GSE1", "tissue", "UBERON:2", "lung")]


def test_golightly(spark, ctx):
    raw = frame(spark, ["accession", "tissue", "tissue_name", "age", "sex"], ("GSM1", "UBERON:2", "lung", "40-50", "Female"), ("GSM2", "UBERON:2", "lung", "x", "?"))
    assert run("Golightly_2018", ctx, raw=raw) == [("GSM1", "age", "adult", "adult"), ("GSM1", "sex", "F", "female"), ("GSM1", "tissue", "UBERON:2", "lung"), ("GSM2", "tissue", "UBERON:2", "lung")]


def test_gu(spark, ctx, tmp_path):
    (tmp_path / "g.csv").write_text('title line,,\nSample ID,Manual annotation,Sample info #manual annotation\nGSM1,lung,"the flu, bad"\nGSM2,na,NA\n')
    raw = readers.delimited(spark, str(tmp_path / "g.csv"), nulls=("NA", "na"), skip=1)
    got = run("Gu_2023", ctx, raw=raw, diseases=frame(spark, ["disease_name", "mondo_id"], ("the flu, bad", "MONDO:2")), tissues=frame(spark, ["tissue_name", "uberon_id"], ("lung", "UBERON:2")))
    assert got == [("GSM1", "disease", "MONDO:2", "the flu, bad"), ("GSM1", "tissue", "UBERON:2", "lung")]


def test_johnson(spark, ctx):
    raw = frame(spark, ["gsm", "disease", "tissue", "sex", "age_group"], ("GSM1", "D1:Flu|D2:Cold", "D9:Lung", "F", "elderly"), ("GSM2", None, None, "na", "na"))
    got = run("Johnson_2023_microarray", ctx, raw=raw, diseases=frame(spark, ["mesh_id", "mondo_id", "mondo_name"], ("D1", "MONDO:2", "flu")), tissues=frame(spark, ["mesh_id", "uber_id"], ("D9", "UBERON:2|CL:1")))
    assert got == [("GSM1", "age", "elderly_adult", "elderly_adult"), ("GSM1", "disease", "MONDO:2", "flu"), ("GSM1", "sex", "F", "female"), ("GSM1", "tissue", "CL:1", "lung cell"), ("GSM1", "tissue", "UBERON:2", "lung")]
    raw = frame(spark, ["run", "disease", "tissue", "sex", "age_group"], ("SRR1", "normal", "lungs", "male", "adult"))
    got = run("Johnson_2023_rnaseq", ctx, raw=raw, diseases=frame(spark, ["original_label", "mondo_id", "mondo_name"], ("normal", "MONDO:000000", "control")), tissues=frame(spark, ["original_label", "uber_id"], ("lungs", "UBERON:2|na")))
    assert got == [("SRR1", "age", "adult", "adult"), ("SRR1", "disease", "MONDO:000000", "control"), ("SRR1", "sex", "M", "male"), ("SRR1", "tissue", "UBERON:2", "lung")]


def test_curated_and_ursa(spark, ctx, tmp_path):
    raw = frame(spark, ["GSM", "ID", "ID_name", "task"], ("GSM1", "CL:1", "cell", "tissue"), ("GSM2", "DOID:8", "flu", "disease"), ("GSM3", "DOID:404", "?", "disease"))
    assert run("Curated_GSM", ctx, raw=raw) == [("GSM1", "tissue", "CL:1", "cell"), ("GSM2", "disease", "MONDO:2", "flu")]
    (tmp_path / "u.csv").write_text("GSM1,GSE1,CL:1\nGSM2,GSE1,CL:404\n")
    raw = readers.delimited(spark, str(tmp_path / "u.csv"), names=["accession", "study_id", "term_id"])
    assert run("URSA", ctx, raw=raw) == [("GSM1", "tissue", "CL:1", "lung cell")]


def test_sirota(spark, ctx):
    raw = frame(spark, ["DISEASE CUI", "TISSUE CUI", "CONTROL GSM", "DISEASE GSM"], ("C1", "T1", "1, 2", "3,"), ("C9", "T9", None, "4"))
    got = run("Sirota_2011", ctx, raw=raw, diseases=frame(spark, ["CUI", "mapped_mondo_id", "mondo_name"], ("C1", "MONDO:2", "flu")), tissues=frame(spark, ["TISSUE_CUI", "mapped_uber_id", "uberon_name"], ("T1", "UBERON:2", "lung")))
    assert got == sorted([("GSM1", "disease", "MONDO:0000000", "control"), ("GSM2", "disease", "MONDO:0000000", "control"), ("GSM3", "disease", "MONDO:2", "flu"), *((f"GSM{i}", "tissue", "UBERON:2", "lung") for i in (1, 2, 3))])


def test_ursa_hd(spark, ctx):
    raw = frame(spark, ["GSMID", "UID", "GSEID", "GEO Sample Description"], ("GSM1", "D1|", "GSE1|GSE2", "Age: 30 years|Sex: F"), ("GSM2", "D000000", "GSE3526", "x| the lung |age (months): 6|prostate"), ("GSM3", "D404", "GSE9", "nothing"))
    got = run("URSA_HD", ctx, raw=raw, series_tissues=frame(spark, ["GSE", "tissue_name", "UBERON_ID"], ("GSE2", "lung", "UBERON:2")), raw_tissues=frame(spark, ["raw_tissue", "tissue_uberon", "uberon_id"], ("the lung", "lung", "UBERON:2")))
    assert got == sorted([("GSM1", "disease", "MONDO:2", "flu"), ("GSM1", "tissue", "UBERON:2", "lung"), ("GSM1", "age", "adult", "adult"), ("GSM1", "sex", "F", "F"), ("GSM2", "disease", "MONDO:0000000", "control"), ("GSM2", "tissue", "UBERON:2", "lung"), ("GSM2", "age", "infant", "infant"), ("GSM2", "sex", "M", "M")])


def test_registry(spark, ctx):
    assert len(registry.names()) == 14 and processors.SEX_NAMES
    with pytest.raises(registry.ProcessorError):
        registry.process("nobody", ctx)
    with pytest.raises(registry.ProcessorError):
        registry.validated(frame(spark, ["accession"], ("x",)))


def test_ages(spark):
    df = spark.createDataFrame([(float(x),) for x in (-1, 0, 1, 2, 10, 20, 50, 80, 150, 151, -2)], "y double")
    got = [r[0] for r in df.select(S.age_group(df.y)).collect()]
    assert got == ["fetus", "fetus", "infant", "infant", "child", "adolescent", "adult", "older_adult", "elderly_adult", None, None]


def test_integration(spark):
    claims = frame(spark, ["entry", "attribute", "source", "term_id", "term_name", "ecode"], ("SRR1", "tissue", "BGee", "T", "t", "expert-curated"), ("SRP1", "tissue", "BGee", "T", "t", "expert-curated"))
    samples = frame(spark, ["accession", "platform_id", "sra_experiment"], ("GSM1", "GPL1", '"SRX1"'), ("GSM2", "GPL1", None))
    runs = frame(spark, ["accession", "experiment_accession"], ("SRR1", "SRX1"))
    mapping = integrate.archive_to_sample(runs, samples, frame(spark, ["archive_id", "entry"], ("SRR1", "GSM9")))
    assert sorted(r.entry for r in integrate.archive_claims(claims, mapping).collect()) == ["GSM1", "GSM9"]
    series = spark.createDataFrame([("GSE2", ["GSM1"]), ("GSE1", ["GSM1", "GSM2"])], "accession string, sample_id array<string>")
    experiments = frame(spark, ["accession", "sample_accession", "study_accession"], ("SRX1", "SRS1", "SRP1"))
    got = {r.entry: tuple(r)[1:] for r in integrate.sample_entries(samples, series, experiments).collect()}
    assert got == {"GSM1": ("GSE1|GSE2", "GPL1", "SRX1", "SRS1", "SRP1"), "GSM2": ("GSE1", "GPL1", "NA", "NA", "NA")}
    organism = integrate.with_organism(spark.createDataFrame([("GSM1",)], "entry string"), frame(spark, ["accession", "organism"], ("GSM1", "Mus musculus"), ("GSM1", "Homo sapiens")))
    assert organism.first().organism == "homo sapiens"
    nested = integrate.nested(integrate.archive_claims(claims, mapping))
    assert sorted(r.entry for r in integrate.unnested(nested).collect()) == ["GSM1", "GSM9"]


def test_strict_and_loose_filters(spark):
    entries = frame(spark, ["entry", "organism", "platform"], ("a", "homo sapiens", "GPL1"), ("b", "homo sapiens|mus musculus", "GPL1|GPL2"), ("c", None, None))
    assert [r.entry for r in filters.of_species(entries, "homo sapiens").collect()] == ["a"]
    assert sorted(r.entry for r in filters.of_species(entries, "homo sapiens", strict=False).collect()) == ["a", "b"]
    tech = frame(spark, ["id", "technology"], ("GPL2", "rnaseq"))
    assert filters.of_technology(entries, tech, "rnaseq").count() == 0
    assert [r.entry for r in filters.of_technology(entries, tech, "rnaseq", strict=False).collect()] == ["b"]
    with pytest.raises(ValueError):
        filters.allowed_sources("free")
    assert filters.allowed_sources("any") is None and "gemma" in filters.allowed_sources("nc")


def test_most_specific(spark):
    closed = frame(spark, ["ancestor", "descendant"], ("A", "A"), ("B", "B"), ("C", "C"), ("A", "B"), ("A", "C"), ("B", "C"))
    claims = frame(spark, ["entry", "attribute", "source", "term_id", "term_name", "ecode"], *[("e", "tissue", s, t, t, "x") for s, t in (("1", "A"), ("2", "C"), ("3", "B"))], ("f", "tissue", "1", "A", "A", "x"), ("f", "disease", "1", "MONDO:0000000", "c", "x"))
    assert sorted((r.entry, r.term_id) for r in ontology.most_specific(claims, closed).collect()) == [("e", "C"), ("f", "A"), ("f", "MONDO:0000000")]
    inside = ontology.most_specific(claims, closed, frame(spark, ["term"], ("A",)))
    assert sorted((r.entry, r.term_id) for r in inside.collect()) == [("e", "C"), ("f", "MONDO:0000000")]


def test_most_specific_holds_no_set_of_ancestors(spark):
    closed = frame(spark, ["ancestor", "descendant"], ("A", "A"), ("A", "B"), ("B", "B"))
    claims = frame(spark, ["entry", "attribute", "source", "term_id"], ("e", "tissue", "1", "A"), ("e", "tissue", "1", "B"))
    plan = ontology.most_specific(claims, closed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1  # the distinct terms of entries


def test_most_specific_has_a_control_below_a_system_once(spark):
    closed = frame(spark, ["ancestor", "descendant"], ("A", "A"), ("A", "MONDO:0000000"), ("MONDO:0000000", "MONDO:0000000"))
    claims = frame(spark, ["entry", "attribute", "source", "term_id"], ("f", "disease", "1", "MONDO:0000000"), ("f", "disease", "1", "other"))
    assert [r.term_id for r in ontology.most_specific(claims, closed, frame(spark, ["term"], ("A",))).collect()] == ["MONDO:0000000"]


def test_violations(spark):
    claims = frame(spark, ["entry", "attribute", "source", "term_id", "ecode"], ("a", "tissue", "s", "UBERON:1|CL:1", "expert-curated"), ("a", "disease", "s", "DOID:1", "expert-curated"), ("b", "sex", "s", "M|F", "guess"), ("b", "age", "s", "old", "expert-curated"))
    entries = frame(spark, ["entry", "organism"], ("a", "homo sapiens"), ("b", "martian"))
    got = sorted((r.entry, r.rule) for r in report.violations(claims, entries).collect())
    assert got == [("a", "disease ontology"), ("b", "age group"), ("b", "ecode"), ("b", "ecode"), ("b", "organism"), ("b", "several values of sex")]
    both = report.level_violations(claims, entries)
    for level in ("sample", "series"):
        own = report.violations(claims, entries, level=level)
        assert sorted(map(tuple, both.where(f"level = '{level}'").drop("level").collect())) == sorted(map(tuple, own.collect()))
    assert both._jdf.queryExecution().analyzed().toString().count("LogicalRDD") == 3  # the claims twice, the entries once


def test_accessions_of_the_contract(spark):
    entries = frame(spark, ["entry", "series", "platform", "srx", "srs", "srp", "organism"], ("GSM1", "GSE1|GSE2", "GPL1", "ERX1", None, "DRP1", "homo sapiens"), ("SRX2", "GSE1|E2", None, "SRS2", "SRX2", "SRP1|X", "homo sapiens"), ("GSM3\n", "GSE", "GPL1\nx", None, None, None, None))
    got = sorted((r.entry, r.rule, r.value) for r in report.broken(entries, "entries", "sample").collect())
    assert got == sorted([("GSM3\n", "organism", None), ("SRX2", "archive sample accession", "SRX2"), ("SRX2", "experiment accession", "SRS2"), ("SRX2", "platform accession", None), ("SRX2", "project accession", "X"), ("SRX2", "sample accession", "SRX2"), ("SRX2", "series accession", "E2")])
    own = report.Rule("even", "entries", "n", "[0-9]*[02468]", severity="warning")
    assert [tuple(r) for r in report.broken(frame(spark, ["entry", "n"], ("a", "12"), ("b", "13"), ("c", None)), "entries", "sample", (own,)).collect()] == [("b", "even", "13", "warning")]


def test_exports(spark, tmp_path):
    cells = frame(spark, ["entry", "term"], ("g1", "MONDO:2"), ("g2", "MONDO:2"))
    entries = frame(spark, ["entry", "series"], ("g1", "s1"), ("g2", "s1"))
    assert json.loads(sinks.nested_json(cells, entries, ["series"]).first().json) == {"g1": {"series": "s1"}, "g2": {"series": "s1"}}
    assert json.loads(sinks.entry_lists(cells).first().json) == ["g1", "g2"]
    labels = spark.createDataFrame([("g1", "MONDO:2", 1), ("g2", "MONDO:2", 2), ("g1", "X:1", -1), ("g2", "X:1", 0)], "entry string, term string, value int")
    got = {r.term: json.loads(r.json) for r in sinks.label_json(labels, entries, ["series"]).collect()}
    assert got == {"MONDO:2": {"positive": [{"g1": {"series": "s1"}}], "negative": [], "control": [{"g2": {"series": "s1"}}]}, "X:1": {"positive": [], "negative": [{"g1": {"series": "s1"}}]}}
    assert sinks.metadata_columns("series, color,srx", "sample", "sample") == (["series", "srx", "sample"], ["color"])
    text = sinks.citation(spark.createDataFrame([("ale", 8), ("Gemma", 1025)], "source string, n long"), {"ALE": {"doi": "10/1", "rights": "CC0"}}, date="d", version="1", attribute="disease", terms="all", level="sample", species="human", ecode="expert", tech="rnaseq", mode="label", license="any")
    assert text.index("Gemma (1,025") < text.index("ALE (8") and "DOI: 10/1" in text and "attribute: disease" in text
    sinks.save_wide(cells, entries, ["MONDO:2"], ["series"], f"{tmp_path}/w", "csv")
    with pytest.raises(ValueError):
        sinks.write(cells, "x", "xls")


def test_package_and_pipeline(spark, tmp_path, capsys):
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "a.txt").write_text("a")
    packages.package(spark, str(tmp_path / "p"))
    with pytest.raises(FileExistsError):
        packages.package(spark, str(tmp_path / "p"))
    assert cli.main(["validate", str(tmp_path / "p")]) == 0
    (tmp_path / "p" / "a.txt").write_text("b")
    assert cli.main(["validate", str(tmp_path / "p")]) == 1
    ran = []
    state = pipeline.Checkpoints.load(str(tmp_path / "stages.json"))
    p = pipeline.Pipeline([(n, lambda n=n: ran.append(n)) for n in "abcd"], state)
    assert p.run("b", "d", ("c",)) == ["b", "d"] and p.run() == ["a", "c"] and ran == ["b", "d", "a", "c"]
    assert pipeline.Checkpoints.load(str(tmp_path / "stages.json")).has("c")
    with pytest.raises(ValueError):
        p.selected("d", "a")
    assert cli.main(["status", str(tmp_path / "stages.json"), "--clear"]) == 0 and cli.main(["supported"]) == 0 and cli.main(["sources"]) == 0
    assert "no stage is done" in capsys.readouterr().out
    assert pipeline.merged_config({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}}
    assert pipeline.environment("CG", {"CG_A__B": "x", "OTHER": "y"}) == {"a": {"b": "x"}}
    assert pipeline.next_folder(str(tmp_path / "p")) == str(tmp_path / "p_1")


def built(spark, tmp_path, obo=OBO):
    """A small build from processed claims of four sources, two of them of one source, one on archive ids."""
    (tmp_path / "o.obo").write_text(obo)
    (tmp_path / "n.json").write_text(json.dumps({"MONDO:2": {"name": "flu", "synonyms": []}}))
    (tmp_path / "deleted.txt").write_text("GSM9\nGSE9\n")
    columns, expert, crowd = ["accession", "attribute", "term_id", "term_name", "ecode"], "expert-curated", "crowd-sourced"
    rows = {
        "ALE": [("GSM1", "tissue", "CL:1", "lung cell", expert), ("GSM1", "tissue", "UBERON:2", "lung", expert), ("GSM9", "sex", "M", "male", expert)],
        "CREEDS": [("GSM2", "disease", "MONDO:2", "flu", crowd), ("GSM2", "developmental_stage", "S:1", "x", crowd), ("GSM6", "disease", "MONDO:0000000", "control", expert)],
        "Johnson_2023_microarray": [("GSM2", "disease", "MONDO:2", "flu", expert), ("GSM5", "tissue", "UBERON:2", "lung", expert)],
        "Johnson_2023_rnaseq": [("SRR1", "tissue", "CL:1", "lung cell", expert), ("SRX4", "sex", "F", "female", expert), ("SRP1", "sex", "M", "male", expert), ("SRR404", "sex", "M", "male", expert)],
    }
    for name, own in rows.items():
        registry.save(frame(spark, columns, *own), f"{tmp_path}/claims", name)
    frame(spark, ["accession", "platform_id", "sra_experiment"], ("GSM1", "GPL1", None), ("GSM2", "GPL1", None), ("GSM4", "GPL1", '"SRX4"'), ("GSM5", "GPL1", None), ("GSM6", "GPL1", None), ("GSM9", "GPL1", None)).write.parquet(f"{tmp_path}/samples")
    spark.createDataFrame([("GSE1", ["GSM1", "GSM2", "GSM6"]), ("GSE2", ["GSM1"]), ("GSE4", ["GSM4", "GSM5", "GSM9"])], "accession string, sample_id array<string>").write.parquet(f"{tmp_path}/series")
    frame(spark, ["accession", "sample_accession", "study_accession"], ("SRX4", "SRS4", "SRP4")).write.parquet(f"{tmp_path}/experiments")
    frame(spark, ["accession", "organism"], *[(f"GSM{i}", "Martian" if i == 5 else "Homo sapiens") for i in (1, 2, 4, 5, 6, 9)]).write.parquet(f"{tmp_path}/channels")
    frame(spark, ["accession", "experiment_accession"], ("SRR1", "SRX4")).write.parquet(f"{tmp_path}/runs")
    frame(spark, ["id", "technology"], ("GPL1", "rnaseq")).write.parquet(f"{tmp_path}/tech")
    frame(spark, ["entry", "level", "description"], ("GSM4", "sample", "a lung"), ("GSE4", "series", "lungs")).write.parquet(f"{tmp_path}/descriptions")
    inputs = {"root": f"{tmp_path}/db", "obo": f"{tmp_path}/o.obo", "names": f"{tmp_path}/n.json", "claims": f"{tmp_path}/claims", "systems": "MONDO:1,UBERON:1", "technologies": f"{tmp_path}/tech", "deleted": f"{tmp_path}/deleted.txt", "descriptions": f"{tmp_path}/descriptions"}
    return inputs | {k: f"{tmp_path}/{k}" for k in ("samples", "series", "experiments", "channels", "runs")}


@pytest.fixture(scope="module")
def database(spark, tmp_path_factory):
    """What the build command wrote, and the inputs it read."""
    folder = tmp_path_factory.mktemp("build")
    inputs = built(spark, folder)
    (folder / "c.yaml").write_text("\n".join(f"{k}: '{v}'" for k, v in inputs.items()))
    with pytest.warns(UserWarning, match="no claims of BGee"):
        assert cli.main(["build", "--config", str(folder / "c.yaml")]) == 0
    return inputs | {"config": str(folder / "c.yaml")}


def test_build(spark, database):
    inputs, root = database, database["root"]
    p = build.stages(spark, root, inputs)
    assert p.run() == [] and {x["stage"] for x in p.checkpoints.done} == set(p.names())
    claims = spark.read.parquet(f"{root}/claims")
    got = sorted((r.entry, r.source, r.term_id) for r in claims.where("level = 'sample'").collect())
    assert got == [("GSM1", "ALE", "CL:1"), ("GSM2", "CREEDS", "MONDO:2"), ("GSM2", "Johnson_2023", "MONDO:2"), ("GSM4", "Johnson_2023", "CL:1"), ("GSM4", "Johnson_2023", "F"), ("GSM6", "CREEDS", "MONDO:0000000")]
    got = sorted((r.entry, r.source, r.term_id, r.term_name, r.ecode) for r in claims.where("level = 'series' and attribute <> 'sex'").collect())
    e, c = "expert-curated", "crowd-sourced"
    assert got == [("GSE1", "ALE", "CL:1", "lung cell", e), ("GSE1", "CREEDS", "MONDO:2", "flu", c), ("GSE1", "Johnson_2023", "MONDO:2", "flu", e), ("GSE2", "ALE", "CL:1", "lung cell", e), ("GSE4", "Johnson_2023", "CL:1", "lung cell", e)]
    entry = spark.read.parquet(f"{root}/entries/level=sample").where("entry = 'GSM4'").first()
    assert (entry.series, entry.srx, entry.srs, entry.srp, entry.organism) == ("GSE4", "SRX4", "SRS4", "SRP4", "homo sapiens")
    p.checkpoints.clear()
    assert not p.checkpoints.has("geo") and p.run("geo", "geo") == ["geo"]
    with pytest.raises(ValueError, match="lacks obo"):
        build.stages(spark, root, {"systems": "x", "claims": "y", "technologies": "z"})


def test_build_then_retrieve_by_the_command_line(spark, database, tmp_path, capsys):
    """Both levels, all modes and formats, on what the build command wrote."""
    inputs = database
    assert cli.main(["combine", "sra", "--config", inputs["config"]]) == 0
    (tmp_path / "registry.csv").write_text("source,license,doi\nALE,permissive,10/ale\nJohnson_2023,nc,10/j\n")
    (tmp_path / "terms.csv").write_text("name,term\nlung,UBERON:2\nnone,X:1\n")

    def ask(attribute, name, *more):
        assert cli.main(["retrieve", attribute, "--data", inputs["root"], "--output", str(tmp_path / name), *more]) == 0
        return spark.read.parquet(str(tmp_path / name)) if "--fmt" not in more else None

    rows = ask("tissues", "a", "--terms", str(tmp_path / "terms.csv"), "--metadata", "sample,series,srp,description", "--registry", str(tmp_path / "registry.csv")).collect()
    assert sorted((r.entry, r.series, r.srp, r.description, r["UBERON:2"]) for r in rows) == [("GSM1", "GSE1|GSE2", "NA", "NA", 1), ("GSM4", "GSE4", "SRP4", "a lung", 1)]
    out = capsys.readouterr()
    assert "X:1" in out.err and "DOI: 10/ale" in out.out and (tmp_path / "a.citation.txt").read_text() in out.out
    assert [r.entry for r in ask("tissues", "permissive", "--license", "permissive", "--registry", str(tmp_path / "registry.csv")).collect()] == ["GSM1"]
    assert sorted(r.entry for r in ask("tissues", "by_series", "--level", "series", "--metadata", "series,description").collect()) == ["GSE1", "GSE2", "GSE4"]
    labels = {r.entry: r["MONDO:2"] for r in ask("diseases", "l", "--mode", "label", "--metadata", "series").collect()}
    assert labels == {"GSM2": 1, "GSM6": 2}
    assert {r.entry: r["MONDO:2"] for r in ask("diseases", "ls", "--mode", "label", "--level", "series").collect()} == {"GSE1": 1}
    assert [(r.entry, r["F"]) for r in ask("sex", "s", "--terms", "female").collect()] == [("GSM4", 1)]
    assert [r.entry for r in ask("tissues", "d", "--direct", "--terms", "CL:1").orderBy("entry").collect()] == ["GSM1", "GSM4"]
    ask("diseases", "j", "--mode", "label", "--terms", "MONDO:2,MONDO:1", "--fmt", "json")
    got = sorted((r.term, r.label, r.entry) for r in spark.read.json(str(tmp_path / "j")).collect())
    assert got == [("MONDO:1", "control", "GSM6"), ("MONDO:1", "positive", "GSM2"), ("MONDO:2", "control", "GSM6"), ("MONDO:2", "positive", "GSM2")]
    for fmt in ("csv", "tsv", "json"):
        ask("tissues", fmt, "--fmt", fmt)
    assert cli.main(["shields", "--data", inputs["root"], "--output", str(tmp_path / "badges")]) == 0
    assert json.loads((tmp_path / "badges" / "Johnson_2023__sample.json").read_text())["message"] == "3"
    assert cli.main(["search", "--data", inputs["root"], "--query", "flu"]) == 0 and "MONDO:2" in capsys.readouterr().out
    (tmp_path / "pack").mkdir()
    assert cli.main(["package", str(tmp_path / "pack"), "--from", inputs["root"], "--from", inputs["names"]]) == 0
    assert (tmp_path / "pack" / "n.json").exists() and (tmp_path / "pack" / "db" / "closure").is_dir() and cli.main(["validate", str(tmp_path / "pack")]) == 0


def test_zipped_tables_and_batches(spark, ctx, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "g.zip", "w") as z:
        z.writestr("a.txt", 'SampleID\tAge\tSex\nGSM1\t40-50\tFemale\nGSM2\tNA\tMale\n\t3\tMale\n')
        z.writestr("b.txt", 'SampleID\tYears\nGSM3\t"30"\n')
        z.writestr("c.txt", "x\ty\n1\t2\n")
    rows = readers.zipped_tables(spark, str(tmp_path / "g.zip"))
    assert rows.count() == 5 and rows.where("file = 'a.txt'").first()["row"]["SampleID"] == "GSM1"
    files = frame(spark, ["file", "tissue", "tissue_name", "age_column", "sex_column"], ("a.txt", "UBERON:2", "lung", "Age", "Sex"), ("b.txt", "UBERON:404", "moon", "Years", ""))
    assert run("Golightly_2018", ctx, raw=processors.golightly_rows(rows, files)) == [
        ("GSM1", "age", "adult", "adult"), ("GSM1", "sex", "F", "female"), ("GSM1", "tissue", "UBERON:2", "lung"), ("GSM2", "sex", "M", "male"), ("GSM2", "tissue", "UBERON:2", "lung"), ("GSM3", "age", "adult", "adult"),
    ]
    one = {"category": "organism part", "valueUri": "http://x/UBERON_2", "value": "Lung"}
    (tmp_path / "b.json").write_text(json.dumps({"0": [{"accession": "GSE1", "characteristics": [one]}, {"accession": "", "characteristics": [one]}, {"accession": "GSE2"}], "100": [{"accession": "GSE3", "characteristics": [one, one]}], "error": "none"}))
    raw = readers.batches(spark, str(tmp_path / "b.json"))
    assert sorted((r.accession, len(r.characteristics)) for r in raw.collect()) == [("GSE1", 1), ("GSE2", 0), ("GSE3", 2)]
    got = run("Gemma", ctx, raw=raw, stages=frame(spark, ["term_id", "age_group"], ("S:1", "adult")))
    assert got == [("GSE1", "tissue", "UBERON:2", "lung"), ("GSE3", "tissue", "UBERON:2", "lung")]


def bson(value):
    """A test's own writer."""
    import struct

    def element(name, v):
        kind, body = {str: lambda: (2, struct.pack("<i", len(v.encode()) + 1) + v.encode() + b"\0"), dict: lambda: (3, bson(v)), list: lambda: (4, bson({str(i): x for i, x in enumerate(v)})), float: lambda: (1, struct.pack("<d", v)), int: lambda: (18, struct.pack("<q", v)), bool: lambda: (8, bytes([v])), type(None): lambda: (10, b"")}[type(v)]()
        return bytes([kind]) + name.encode() + b"\0" + body

    body = b"".join(element(k, v) for k, v in value.items())
    return struct.pack("<i", len(body) + 5) + body + b"\0"


def test_annotation_database(spark, tmp_path):
    entries = {
        "GSM1": {"organism": "homo sapiens", "tissue": {"ALE": {"id": "UBERON:1|UBERON:2", "value": "a|é", "ecode": "x"}}, "disease": {}, "accession_ids": {"series": "GSE1", "platform": "GPL1"}},
        "GSM2": {"sex": {"Gemma": {"id": "M", "value": "male", "ecode": "y"}, "ALE": {"id": "F|M", "value": "female", "ecode": "y"}}, "odd": [1, 2.5, True, None], "accession_ids": {}},
    }
    (tmp_path / "d.bson").write_bytes(bson(entries))
    rows = readers.bson_map(spark, str(tmp_path / "d.bson"))
    assert {r.key: json.loads(r.json) for r in rows.collect()} == entries
    got = sorted(tuple(r) for r in readers.database_claims(rows).collect())
    assert got == [("GSM1", "tissue", "ALE", "UBERON:1", "a", "x"), ("GSM1", "tissue", "ALE", "UBERON:2", "é", "x"), ("GSM2", "sex", "ALE", "F", "female", "y"), ("GSM2", "sex", "ALE", "M", "female", "y"), ("GSM2", "sex", "Gemma", "M", "male", "y")]
    assert sorted((r.entry, r.series, r.platform, r.organism) for r in readers.database_entries(rows).collect()) == [("GSM1", "GSE1", "GPL1", "homo sapiens"), ("GSM2", None, None, None)]


def test_readers_without_header_and_columns_of_terms(spark, tmp_path):
    (tmp_path / "n.csv").write_text('a,"b,c"\nd,NA\n')
    assert sorted(map(tuple, readers.delimited(spark, str(tmp_path / "n.csv"), names=["x", "y"], nulls=("NA",)).collect())) == [("a", "b,c"), ("d", None)]
    (tmp_path / "t.csv").write_text("id,term\n1,A\n2,B\n3,A\n")
    assert readers.term_column(spark, str(tmp_path / "t.csv")) == ["A", "B"]
    assert aggregate.counts_from_lists(frame(spark, ["sources"], ("a|b",), ("b",))).collect()[0]["source"] == "b"


def test_metadata(spark):
    from claimgrid.operators import metadata

    kind = "accession string, title string, channels array<struct<source_name:string,characteristics:array<struct<tag:string,value:string>>>>"
    table = spark.createDataFrame([("GSM1", "a\nb", [("lung", [("age", "3"), (None, "x")])]), ("GSM2", None, None), ("GSM3", "c", [])], kind)
    ids = spark.createDataFrame([("GSM1",), ("GSM2",), ("GSM1",)], "id string")
    got = {r["sample"]: tuple(r)[1:] for r in metadata.sample_metadata(table, ids, ["title", "source_name", "characteristics", "color"]).collect()}
    assert got == {"GSM1": ("a b", "lung", "age: 3|x", "NA", "NA"), "GSM2": ("NA",) * 5}
    assert metadata.known_fields(table, ["title", "color"]) == (["accession", "title"], ["color"])
    series = spark.createDataFrame([("GSE1", "t", None, ["GSM1", "GSM2"])], "accession string, title string, summary string, sample_id array<string>")
    row = metadata.series_metadata(series, series.select("accession")).first()
    assert row.description == "Title: t | Summary: NA" and row.sample_id == "GSM1|GSM2" and row.series == "GSE1"


def test_local_commands(tmp_path, capsys):
    c, data = str(tmp_path / "c.json"), tmp_path / "data"
    data.mkdir()
    assert cli.main(["setup", "--data", str(data), "--config", c]) == 0
    assert cli.main(["delete", "--config", c]) == 1 and data.exists()
    assert cli.main(["package", str(data)]) == 0 and cli.main(["delete", "--config", c]) == 0 and not data.exists()
    assert cli.main(["init-config", c]) == 0 and cli.main(["validate-config", c]) == 1
    assert "lacks root" in capsys.readouterr().err
