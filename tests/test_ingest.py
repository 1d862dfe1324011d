"""From the raw files of all sources to a request on what a build made of them."""

import json
import zipfile

import pytest

from claimgrid import cli
from claimgrid.operators import ontology
from claimgrid.plans import build
from claimgrid.sources import ingest, processors, readers, registry
from claimgrid.sources.ingest import IngestError
from tests.test_sources import OBO, frame

FILES = {
    "ALE": {"raw": ("a.tsv", "samples of a lab\nGSM\ttissue\tmonths\tsex\nGSM1\tb1\t252\tF\nGSM2\tb1\n\tb1\t1\tM\nGSM3\tb1\tna\tM\n"), "tissues": ("t.csv", "﻿brenda,brenda_name,uberon,uberon_name\nb1,Lung,UBERON:2,lung\n")},
    "BGee": {"raw": ("b.tsv", "x\tRun IDs\tExpression mapped anatomical entity ID\tExpression mapped anatomical entity name\tExpression mapped stage ID\tExpression mapped stage name\tExpression mapped sex\ny\tSRR1\tCL:1\tlung cell\tNA\tNA\tmale\n")},
    "Cello": {"raw": ("c.json", json.dumps({"GSM11": ["CL:1"], "GSM12": "odd"}, indent=1))},
    "CREEDS": {"raw": ("c.json", json.dumps([{"organism": "human", "do_id": "DOID:8", "disease_name": "flu", "pert_ids": ["GSM21"], "ctrl_ids": ["GSM22"]}, {"organism": "human", "do_id": "DOID:8", "pert_ids": "GSM23", "ctrl_ids": []}]))},
    "DiSignAtlas": {"raw": ("d.gmt", "d1\tGSE1|GSM31|GSM32|GPL1|x|Flu|C1|Lung|d|s|human\tgene\nshort\n"), "tissues": ("t.csv", "name,id\nlung,UBERON:2\n"), "corrections": ("c.csv", "sample,term,name\nGSM31,CL:1,lung cell\n")},
    "Gemma": {"raw": ("g.json", json.dumps({"0": [{"accession": "GSE1", "characteristics": [{"category": "organism part", "valueUri": "http://x/UBERON_2", "value": "Lung"}]}, {"accession": ""}], "100": 7})), "stages": ("s.csv", "term_id,term_label,age_group\nS:1,x,adult\nS:2,x,na\n")},
    "Gu_2023": {"raw": ("g.csv", 'a title,,\nSample ID,Manual annotation,Sample info #manual annotation\nGSM41,lung,"the flu, bad"\nGSM42,na,NA\nGSM43,lung,x,y\n'), "diseases": ("d.csv", '﻿disease_name,mondo_id\n"the flu, bad",MONDO:2\n'), "tissues": ("t.csv", "tissue_name,uberon_id\nlung,UBERON:2\n")},
    "Johnson_2023_microarray": {"raw": ("j.tsv", "gsm\tdisease\ttissue\tsex\tage_group\nGSM51\tD1:Flu\tD9:Lung\tF\telderly\n"), "diseases": ("d.csv", "mesh_id,mesh_name,mondo_id,mondo_name\nD1,x,MONDO:2,flu\n"), "tissues": ("t.csv", "mesh_id,mesh_name,uber_id,uber_name\nD9,x,UBERON:2,lung\n")},
    "Johnson_2023_rnaseq": {"raw": ("j.tsv", "run\tdisease\ttissue\tsex\tage_group\nSRR2\tNA\tpoumon entière\tmale\tadult\n".encode("latin1")), "diseases": ("d.csv", "original_label,doid,do_name,mondo_id,mondo_name\nx,y,z,MONDO:2,flu\n"), "tissues": ("t.csv", "original_label,uber_id,uber_name\npoumon entière,UBERON:2,lung\n")},
    "Curated_GSM": {"raw": ("k.tsv", "n\tGSM\tID\tID_name\ttask\n1\tGSM61\tDOID:8\tflu\tdisease\n2\t\tDOID:8\tflu\tdisease\n")},
    "Sirota_2011": {"raw": ("s.csv", '﻿DISEASE,GDS,DISEASE CUI,TISSUE CUI,CONTROL GSM,DISEASE GSM\nflu,1,C1,T1,"71,72",73\n'), "diseases": ("d.csv", "CUI,umls_name,mapped_mondo_id,mondo_name,from_mondo_ont,manually_searched,,\nC1,x,MONDO:2,flu,,,,\n"), "tissues": ("t.csv", "TISSUE_CUI,umls_name,mapped_uber_id,uberon_name,,\nT1,x,UBERON:2,lung,,\n")},
    "URSA": {"raw": ("u.csv", "GSM81,GSE1,CL:1\nGSM82,GSE1\n")},
    "URSA_HD": {"raw": ("u.csv", "GSMID,UID,GSEID,GEO Sample Description,more\nGSM91,D1,GSE2,Age: 30 years|Sex: F,\n"), "series_tissues": ("s.csv", "GSE,tissue_name,UBERON_ID\nGSE2,lung,UBERON:2\n"), "raw_tissues": ("r.csv", "raw_tissue,tissue_uberon,uberon_id\nx,lung,UBERON:2\n")},
}


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    """Folders of raw files; paths by source and frame."""
    top, paths = tmp_path_factory.mktemp("raw"), {}
    for source, frames in FILES.items():
        for name, (file, text) in frames.items():
            at = top / source / name
            at.mkdir(parents=True)
            (at / file).write_bytes(text if isinstance(text, bytes) else text.encode())
            paths.setdefault(source, {})[name] = str(at / file)
    with zipfile.ZipFile(top / "g.zip", "w") as z:
        z.writestr("a.txt", "SampleID\tAge\tSex\nGSM101\t40-50\tFemale\n\t3\tMale\n")
        z.writestr("c.txt", "SampleID\tAge\nGSM102\t2\n")
    (top / "files.csv").write_text("file,tissue,tissue_name,age_column,sex_column\na.txt,UBERON:2,lung,Age,Sex\n")
    paths["Golightly_2018"] = {"raw": str(top / "g.zip"), "files": str(top / "files.csv")}
    (top / "o.obo").write_text(OBO)
    return top, paths


def test_raw_files_of_all_sources_to_a_request(spark, raw, tmp_path, capsys):
    top, paths = raw
    assert sorted(paths) == registry.names() == sorted(ingest.SPECS)
    terms = ontology.stanzas(spark, str(top / "o.obo")).cache()
    closed = ontology.closure(ontology.edges(terms)).cache()
    system = lambda t: ontology.system_descendants(closed, frame(spark, ["term"], (t,))).cache()
    to = {p: ontology.reverse_xrefs(ontology.placed_xrefs(terms, p)) for p in ("DOID", "MESH", "UMLS")}
    ctx = registry.Context(system("UBERON:1"), system("MONDO:1"), ontology.term_names(terms), to)
    rejects = set()
    for source, own in paths.items():
        got = ingest.ingest(spark, source, own)
        registry.save(registry.process(source, ctx, **got.frames), str(tmp_path / "claims"), source)
        ingest.save_rejects(got.rejects, str(tmp_path / "rejects"), source)
    saved = spark.read.parquet(str(tmp_path / "rejects"))
    rejects = {(r.source, r.frame, r.file.rpartition("/")[2], r.reason) for r in saved.collect()}
    assert rejects == {
        ("ALE", "raw", "a.tsv", "number of fields"), ("ALE", "raw", "a.tsv", "no accession"), ("Cello", "raw", "c.json", "not array<string>"), ("CREEDS", "raw", "c.json", "not as declared"),
        ("DiSignAtlas", "raw", "d.gmt", "number of fields"), ("Gemma", "raw", "g.json", "no accession"), ("Gemma", "raw", "g.json", "not a list of studies"), ("Gu_2023", "raw", "g.csv", "number of fields"),
        ("Curated_GSM", "raw", "k.tsv", "no GSM"), ("URSA", "raw", "u.csv", "number of fields"), ("Golightly_2018", "raw", "g.zip!a.txt", "no SampleID"), ("Golightly_2018", "raw", "g.zip!c.txt", "file isn't listed"),
    }
    assert {r.record for r in saved.where("source in ('URSA', 'Gu_2023')").collect()} == {"GSM82,GSE1", "GSM43,lung,x,y"}
    claims = spark.read.parquet(str(tmp_path / "claims"))
    tissues = {(r.source, r.accession, r.term_id) for r in claims.where("attribute = 'tissue'").collect()}
    assert tissues == {
        ("ALE", "GSM1", "UBERON:2"), ("ALE", "GSM3", "UBERON:2"), ("BGee", "SRR1", "CL:1"), ("Cello", "GSM11", "CL:1"), ("DiSignAtlas", "GSM31", "CL:1"), ("DiSignAtlas", "GSM32", "UBERON:2"), ("Gemma", "GSE1", "UBERON:2"), ("Golightly_2018", "GSM101", "UBERON:2"),
        ("Gu_2023", "GSM41", "UBERON:2"), ("Johnson_2023_microarray", "GSM51", "UBERON:2"), ("Johnson_2023_rnaseq", "SRR2", "UBERON:2"), ("Sirota_2011", "GSM71", "UBERON:2"), ("Sirota_2011", "GSM72", "UBERON:2"), ("Sirota_2011", "GSM73", "UBERON:2"), ("URSA", "GSM81", "CL:1"), ("URSA_HD", "GSM91", "UBERON:2"),
    }
    samples = [f"GSM{i}" for i in (1, 3, 11, 21, 22, 31, 32, 41, 51, 61, 71, 72, 73, 81, 91, 101)]
    frame(spark, ["entry", "series", "platform", "srx", "srs", "srp", "organism"], *[(s, "GSE1", "GPL1", None, None, None, "homo sapiens") for s in samples]).write.parquet(str(tmp_path / "entries"))
    frame(spark, ["id", "technology"], ("GPL1", "rnaseq")).write.parquet(str(tmp_path / "tech"))
    inputs = {"obo": str(top / "o.obo"), "systems": "MONDO:1,UBERON:1", "claims": str(tmp_path / "claims"), "technologies": str(tmp_path / "tech"), "entries": str(tmp_path / "entries")}
    build.stages(spark, str(tmp_path / "db"), inputs).run(skip=("report",))
    assert cli.main(["retrieve", "diseases", "--data", str(tmp_path / "db"), "--terms", "MONDO:2", "--filters", "species=human,ecode=any,tech=rnaseq", "--output", str(tmp_path / "out")]) == 0
    assert sorted(r.entry for r in spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(f"GSM{i}" for i in (21, 32, 41, 51, 61, 73, 91))


def test_process_raw_files_by_the_command_line(spark, raw, tmp_path):
    top, paths = raw
    (tmp_path / "semi.csv").write_text("GSM81;GSE1;CL:1\nGSM82\n")
    (tmp_path / "l.json").write_text(json.dumps({"raw": {"sep": ";"}}))
    common = ["--obo", str(top / "o.obo"), "--tissue-systems", "UBERON:1", "--disease-systems", "MONDO:1", "--output", str(tmp_path / "claims")]
    assert cli.main(["process", "URSA", "--raw-files", f"raw={tmp_path}/semi.csv", "--layouts", str(tmp_path / "l.json"), *common]) == 0
    assert [(r.accession, r.term_id) for r in readers.claim_tables(spark, str(tmp_path / "claims"), ["URSA"])["URSA"].collect()] == [("GSM81", "CL:1")]
    assert [(r.frame, r.record) for r in spark.read.parquet(str(tmp_path / "claims-rejects")).collect()] == [("raw", "GSM82")]
    with pytest.raises(ValueError, match="either"):
        cli.main(["process", "URSA", *common])


def test_what_a_layout_refuses(spark, raw, tmp_path):
    _, paths = raw
    with pytest.raises(IngestError, match="lacks files of tissues"):
        ingest.ingest(spark, "ALE", {"raw": paths["ALE"]["raw"]})
    with pytest.raises(IngestError, match="no frame x"):
        ingest.ingest(spark, "URSA", paths["URSA"] | {"x": "y"})
    with pytest.raises(IngestError, match="no source"):
        ingest.layouts("nobody")
    with pytest.raises(IngestError, match="a layout has no colour"):
        ingest.layouts("URSA", {"raw": {"colour": 1}})
    (tmp_path / "k.tsv").write_text("GSM\tID\ntask\n")
    with pytest.raises(IngestError, match="lacks ID_name, task"):
        ingest.ingest(spark, "Curated_GSM", {"raw": str(tmp_path / "k.tsv")})
    (tmp_path / "two.tsv").write_text("task\tID_name\tID\tGSM\ntissue\tlung\tUBERON:2\tGSM9\n")
    got = ingest.ingest(spark, "Curated_GSM", {"raw": f"{paths['Curated_GSM']['raw']},{tmp_path}/two.tsv"})
    assert sorted((r.GSM, r.ID) for r in got.frames["raw"].collect()) == [("GSM61", "DOID:8"), ("GSM9", "UBERON:2")]
    (tmp_path / "broken.json").write_text("{")
    got = ingest.ingest(spark, "Cello", {"raw": str(tmp_path / "broken.json")})
    assert got.frames["raw"].isEmpty() and [(r.reason, r.record) for r in got.rejects.collect()] == [("not a JSON object", None)]
    assert processors.SIGNATURE[0] == "gse"


def test_an_archive_is_read_by_a_task_for_each_file(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "many.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for i in range(44):
            z.writestr(f"d/f{i}.txt", "SampleID\tx\n" + "".join(f"GSM{j}\t{j}\n" for j in range(i)))
    own = readers.zipped_tables(spark, str(tmp_path / "many.zip"))
    assert own.rdd.getNumPartitions() == 44
    assert {r.file: r["count"] for r in own.groupBy("file").count().collect()} == {f"d/f{i}.txt": i for i in range(1, 44)}
    assert readers.zipped_tables(spark, f"file://{tmp_path}").count() == 44 * 43 // 2
    with pytest.raises(FileNotFoundError):
        readers.zipped_tables(spark, str(tmp_path / "none.zip"))


def test_archived_rows_with_too_many_fields_are_rejected_whole(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "odd.zip", "w") as z:
        z.writestr("a.txt", "SampleID\tAge\nGSM1\t3\nGSM2\t4\tmore\tNA\nGSM3\n\t5\t6\n")
        z.writestr("b.txt", "SampleID\tAge\nGSM4\t7\n")
        z.writestr("none.txt", "SampleID\tAge\n")
    layout = ingest.layouts("Golightly_2018")["raw"]
    rows, rejects = ingest.read(spark, str(tmp_path / "odd.zip"), layout)
    assert rows.columns == ["file", "row"]
    assert sorted((r.file, sorted(r.row.items())) for r in rows.collect()) == [("a.txt", [("Age", "3"), ("SampleID", "GSM1")]), ("a.txt", [("SampleID", "GSM3")]), ("b.txt", [("Age", "7"), ("SampleID", "GSM4")])]
    bad = sorted((r.file.rsplit("/")[-1], r.reason, json.dumps(json.loads(r.record), sort_keys=True)) for r in rejects.collect())
    assert bad == [
        ("odd.zip!a.txt", "number of fields", '{"row": {"Age": "4", "SampleID": "GSM2"}, "surplus": ["more", "NA"]}'),
        ("odd.zip!a.txt", "number of fields", '{"row": {"Age": "5"}, "surplus": ["6"]}'),
    ]
