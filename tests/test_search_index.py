"""The stored index: the same results as searching whole names, from a share of its buckets."""

import re

import pytest

from claimgrid.operators import search, search_index
from claimgrid.operators.filters import NoResults
from claimgrid.plans import driver


@pytest.fixture(scope="module")
def corpus(spark):
    terms = [("MONDO:1", "heart attack", "MONDO", "disease"), ("MONDO:2", "Heart heart block", "MONDO", "disease"), ("UBERON:1", "heart", "UBERON", "tissue"), ("CL:1", "", "CL", "celltype"), ("CL:2", None, "CL", "celltype"), ("CL:3", "attack cell 9", "CL", "celltype")]
    synonyms = [("MONDO:1", "infarct of the heart", "EXACT"), ("MONDO:1", "attack", "BROAD"), ("MONDO:2", "block", None), ("UBERON:1", "pump", "odd scope"), ("CL:1", "attack", "NARROW"), ("none", "heart attack", "EXACT"), ("CL:3", None, "EXACT")]
    return spark.createDataFrame(terms, "term_id string, name string, ontology string, type string"), spark.createDataFrame(synonyms, "term_id string, synonym string, scope string")


@pytest.fixture(scope="module")
def folder(corpus, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('index')}"
    search_index.build(*corpus, path)
    return path


def rows(df):
    return [(r.term_id, r.name, r.ontology, r.type, round(r.score, 9), r.synonyms) for r in df.collect()]


@pytest.mark.parametrize("how", [{}, {"conjunctive": True}, {"type": "disease"}, {"ontology": "UBERON"}, {"k": 2}, {"weights": {"name": 1.0, "exact": 4.0}}, {"k1": 2.0, "b": 0.1}])
def test_like_a_search_of_whole_names(spark, corpus, folder, how):
    for query in ("heart attack", "Block of, block!", "nothing", "attack 9"):
        assert rows(search_index.search(spark, folder, query, **how)) == rows(search.search_fields(*corpus, query, **how))
    with pytest.raises(NoResults):
        search_index.search(spark, folder, " ?! ")


def test_table_function(spark, corpus, folder):
    search_index.create_function(spark, folder, "terms_like")
    ask = lambda call: rows(spark.sql(f"SELECT * FROM terms_like({call}) ORDER BY score DESC, term_id"))
    assert ask("'heart attack'") == rows(search.search_fields(*corpus, "heart attack")) != []
    assert ask("'heart attack', conjunctive => 1") == rows(search.search_fields(*corpus, "heart attack", conjunctive=True))
    assert ask("'heart', 1, ontology_filter => 'MONDO'") == rows(search.search_fields(*corpus, "heart", 1, ontology="MONDO"))
    assert ask("'attack', type_filter => 'celltype', w_narrow => 0, k1 => 2.0, b => 0.1") == rows(search.search_fields(*corpus, "attack", type="celltype", weights={**search_index.FIELD_WEIGHTS, "narrow": 0.0}, k1=2.0, b=0.1))
    assert ask("' ?! '") == []


def test_reads_a_share_of_the_buckets(spark, sf_dir):
    folder = driver._index(spark, sf_dir)
    stored = len(spark.read.parquet(f"{folder}/postings").select("bucket").distinct().collect())
    hit = search_index.of_tokens(spark, folder, "postings", ["blue", "ring"])
    assert len({re.search(r"bucket=(\d+)", f)[1] for f in hit.select("_metadata.file_path").distinct().toPandas()["file_path"]}) <= 2 < stored
    assert "bucket" in hit._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_texts_are_grouped_once(spark, corpus, tmp_path, monkeypatch):
    """Postings and the fields' statistics come from one written frame of grouped texts."""
    frames, kept = [], search_index.written
    monkeypatch.setattr(search_index, "written", lambda df, name: frames.append(kept(df, name)) or frames[-1])
    search_index.build(*corpus, f"file://{tmp_path}/index")
    assert len(frames) == 1
    n = {r.field: r.n for r in spark.read.parquet(f"file://{tmp_path}/index/fields").collect()}
    assert n == {r.field: r["count"] for r in frames[0].groupBy("field").count().collect()} != {}
