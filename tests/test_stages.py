"""Stages that know their inputs."""

import json

import pytest

from claimgrid import cli
from claimgrid.operators import ontology
from claimgrid.plans import build, pipeline
from claimgrid.sources import registry
from tests.test_sources import built, frame


def test_only_stages_on_changed_inputs_run_again(spark, tmp_path, capsys):
    inputs = built(spark, tmp_path)
    plan = lambda **more: build.stages(spark, inputs["root"], inputs | more)
    with pytest.warns(UserWarning):
        assert plan().run() == plan().names()
    assert plan().run() == []
    rows = [("GSM1", "tissue", "CL:1", "lung cell", "expert-curated"), ("GSM6", "sex", "M", "male", "expert-curated")]
    registry.save(frame(spark, ["accession", "attribute", "term_id", "term_name", "ecode"], *rows), inputs["claims"], "ALE")
    assert plan().run() == ["geo", "archive", "sample", "series", "report"]
    assert ("GSM6", "M") in {(r.entry, r.term_id) for r in spark.read.parquet(f"{inputs['root']}/claims/level=sample").collect()}
    (tmp_path / "n.json").write_text(json.dumps({"MONDO:2": {"name": "the flu", "synonyms": []}}))
    assert plan().run() == ["search"]
    (tmp_path / "deleted.txt").write_text("GSM9\n")
    assert plan().run(end="sample") == ["sample"]
    assert {x["stage"] for x in plan().checkpoints.done} == {"relations", "search", "geo", "archive", "sample"}
    assert plan().run() == ["series", "report"]
    assert plan(systems="UBERON:1").run(end="geo") == [] and plan(systems="UBERON:1").run(end="sample") == ["sample"]
    config = tmp_path / "c.json"
    config.write_text(json.dumps(inputs))
    capsys.readouterr()
    assert cli.main(["build", "--config", str(config), "--again", "series"]) == 0
    assert capsys.readouterr().out.split() == ["sample", "series", "report"]  # the systems are the first ones again
    state = plan().checkpoints.done
    other = pipeline.StageTable(spark, str(tmp_path / "other"))
    other.add("old")
    other.restore(state)
    assert other.done == state and not other.has("old") and other.has("geo", next(x["inputs"] for x in state if x["stage"] == "geo")) and not other.has("geo", "else")


def test_a_stage_lets_its_followers_run_again(tmp_path):
    ran, state = [], pipeline.Checkpoints.load(str(tmp_path / "s.json"))
    values = {n: "1" for n in "abcd"}
    p = pipeline.Pipeline([(n, lambda n=n: ran.append(n)) for n in "abcd"], state, {n: lambda n=n: values[n] for n in "abcd"}, {"b": ("a",), "d": ("b",)})
    assert p.run() == list("abcd") and p.run() == [] and p.followers("a") == ["b", "d"]
    values["b"] = "2"
    assert p.run() == ["b", "d"]
    assert p.clear("a") == ["a", "b", "d"] and p.run(end="b") == ["a", "b"] and p.run() == ["d"]
    values["a"] = "2"
    assert p.run("a", "a") == ["a"] and {x["stage"] for x in state.done} == {"a", "c"}
    with pytest.raises(ValueError, match="no stage"):
        p.clear("z")
    other = pipeline.Checkpoints.load(str(tmp_path / "t.json"))
    other.restore(state.done)
    assert pipeline.Checkpoints.load(str(tmp_path / "t.json")).done == state.done


def test_fingerprints(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "b" / "x").write_text("1")
    one = lambda **p: pipeline.fingerprint(spark, [str(tmp_path / "a"), str(tmp_path / "none")], p)
    first = one(k=1)
    assert first == one(k=1) != one(k=2)
    (tmp_path / "a" / "y").write_text("2")
    assert one(k=1) != first


def test_claims_of_samples_are_made_once(spark, tmp_path, monkeypatch):
    """Entries of a level follow the claims as they were written, and no claim is made again for them."""
    inputs, read, save = built(spark, tmp_path), {}, build.save

    def noted(df, path, *partition):
        read[path.removeprefix(inputs["root"] + "/")] = df.inputFiles()
        save(df, path, *partition)

    monkeypatch.setattr(build, "save", noted)
    with pytest.warns(UserWarning):
        build.stages(spark, inputs["root"], inputs).run(end="series")
    own = read["entries/level=sample"]
    assert any("/claims/level=sample/" in f for f in own) and not any("/geo_claims/" in f or "/archive_claims/" in f for f in own)
    assert not any("/claims/level=sample/" in f for f in read["claims/level=series"])


def test_only_claimed_ancestors_are_dealt(spark):
    claims = frame(spark, ["entry", "attribute", "source", "term_id"], ("a", "tissue", "x", "T:3"), ("a", "tissue", "y", "T:2"), ("b", "tissue", "x", "T:2"))
    closure = frame(spark, ["ancestor", "descendant"], *((f"T:{i}", f"T:{j}") for i in range(4) for j in range(i, 4)))
    own = ontology.most_specific(claims, closure)
    assert {(r.entry, r.term_id) for r in own.collect()} == {("a", "T:3"), ("b", "T:2")}
    plan = own._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") == 1
