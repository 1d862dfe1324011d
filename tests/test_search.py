"""Search over a small corpus against a direct evaluation of the formula."""

import math
import re

import pytest

from claimgrid.operators import search
from claimgrid.operators.filters import NoResults
from claimgrid.sources.readers import name_lists

NAMES = {
    "MONDO:1": ("myocardial infarction", [("heart attack", "EXACT"), ("MI", "RELATED")]),
    "MONDO:2": ("heart failure", [("cardiac failure", "EXACT"), ("weak heart", "BROAD")]),
    "MONDO:3": ("panic attack", [("attack of panic", None)]),
    "MONDO:4": ("melanoma", []),
    "CL:1": ("heart cell", [("cardiac cell", "EXACT")]),
    "UBERON:1": ("heart", [("cardium", "NARROW")]),
    "UBERON:2": ("naïve étage", []),
    "UBERON:3": ("", [("nameless", "EXACT")]),
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    import json

    p = tmp_path_factory.mktemp("names") / "names.json"
    p.write_text(json.dumps({k: {"name": n, "synonyms": [{"text": t} | ({"scope": s} if s else {}) for t, s in syn]} for k, (n, syn) in NAMES.items()}))
    terms, synonyms = search.term_tables(name_lists(spark, str(p)))
    return terms.cache(), synonyms.cache()


def direct(query, keep):
    weight = {"EXACT": 8, "NARROW": 7, "BROAD": 3, "RELATED": 1, None: 1}
    tok = lambda s: re.findall(r"[a-zA-Z0-9]+", s.lower())
    docs = {}
    for k, (name, syn) in NAMES.items():
        if name and keep(k):
            docs[k] = tok(name) * 10 + [w for t, s in syn for w in tok(t) * weight[s]]
    n, avg = len(docs), sum(map(len, docs.values())) / len(docs)
    out = {}
    for k, words in docs.items():
        out[k] = 0
        for q in tok(query):
            df = sum(q in d for d in docs.values())
            if df:
                tf = words.count(q)
                out[k] += math.log((n + 1) / df) * (0.5 + tf * 2.2 / (1.2 * (0.2 + 0.8 * len(words) / avg) + tf))
    return out


@pytest.mark.parametrize("query", ["heart attack", "Cardiac!", "heart heart cell", "attack of the unknown"])
def test_scores(tables, query):
    terms, synonyms = tables
    got = {r.term_id: r.score for r in search.search(terms, synonyms, query, 20).collect()}
    want = direct(query, lambda k: True)
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-12) for k in want)


def test_order_filters_and_synonyms(tables):
    terms, synonyms = tables
    rows = search.search(terms, synonyms, "heart attack", 3, type="disease").collect()
    assert rows[0].term_id == "MONDO:1" and len(rows) == 3 and [r.score for r in rows] == sorted((r.score for r in rows), reverse=True)
    want = direct("heart attack", lambda k: k.startswith("MONDO"))
    assert math.isclose(rows[0].score, want["MONDO:1"])
    assert [tuple(s) for s in rows[0].synonyms] == [("heart attack", "EXACT"), ("MI", "RELATED")]
    assert search.search(terms, synonyms, "heart", ontology="CL").first().term_id == "CL:1"


def test_nothing_is_found(tables):
    terms, synonyms = tables
    assert search.search(terms, synonyms, "zzz").count() == 0
    assert search.search(terms, synonyms, "heart", type="planet").count() == 0
    with pytest.raises(NoResults):
        search.search(terms, synonyms, "?!")


def test_fields(tables):
    terms, synonyms = tables
    rows = search.search_fields(terms, synonyms, "heart attack", 10).collect()
    assert {"UBERON:1", "MONDO:1", "MONDO:3"} <= {r.term_id for r in rows} and all(r.score > 0 for r in rows)
    both = search.search_fields(terms, synonyms, "heart attack", 10, conjunctive=True).collect()
    assert [r.term_id for r in both] == ["MONDO:1"] and both[0].synonyms == "heart attack | MI"


def test_token_counts_are_dealt_before_texts_are_split(spark):
    """A single partition of texts is counted by as many tasks as a shuffle has, without another shuffle."""
    texts = spark.createDataFrame([(f"t{i}", "a b a", 2) for i in range(40)], "term_id string, text string, weight int").coalesce(1)
    own = search.term_frequencies(texts)
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert {(r.token, r.tf) for r in own.collect()} == {("a", 4), ("b", 2)} and own.count() == 80
    assert own.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) and plan.count("Exchange ") == 1
