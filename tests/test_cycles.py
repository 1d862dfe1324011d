"""Cycles of the ontology graph, and what a build does about them."""

import numpy as np
import pytest

from claimgrid.operators import ontology
from claimgrid.plans import driver, raw_queries  # noqa: F401
from tests.oracle import compare, connection


def frame(spark, pairs):
    return spark.createDataFrame([tuple(p) for p in pairs], "parent string, child string")


def components(pairs):
    """Mutual reachability, pair by pair."""
    reach = {}
    terms = sorted({t for p in pairs for t in p})
    for t in terms:
        seen, front = set(), {t}
        while front:
            front = {b for a, b in pairs if a in front} - seen
            seen |= front
        reach[t] = seen
    return {(min(u for u in terms if u in reach[t] and t in reach[u]), t) for t in terms if t in reach[t]}


def test_components_against_brute_force(spark):
    rng = np.random.default_rng(1)
    n = 30
    pairs = {(f"t{a:02}", f"t{b:02}") for a, b in rng.integers(0, n, (36, 2))}
    got = {tuple(r) for r in ontology.cycles(frame(spark, pairs)).select("component", "term").collect()}
    assert got == components(pairs)
    left = {tuple(r) for r in ontology.without_cycles(frame(spark, pairs)).select("parent", "child").collect()}
    assert left <= pairs and not components(left) and {p for p in pairs if not any({*p} <= {t for c, t in got if c == x} for x, _ in got)} <= left


def test_graph_without_cycles(spark):
    chain = [(f"{i:02}", f"{i + 1:02}") for i in range(30)] + [(None, "01"), ("01", None)]
    edges = frame(spark, chain)
    assert ontology.cycles(edges).count() == 0 and ontology.checked(edges) is edges
    assert ontology.cycles(edges.limit(0)).count() == 0


def test_error_names_the_terms(spark):
    with pytest.raises(ontology.CyclicOntology, match="^a, b, c; x, y$"):
        ontology.checked(frame(spark, ["ab", "bc", "ca", "cx", "xy", "yx", "yz"]))


KNOWN = """[Term]
id: UBERON:8000009
name: one
is_a: UBERON:0002354

[Term]
id: UBERON:0002354
name: other
relationship: part_of UBERON:8000009

[Term]
id: MONDO:2
name: second
xref: DOID:7

[Term]
id: MONDO:1
name: first
xref: DOID:7
"""


def test_known_cycle_and_last_reference(spark, tmp_path):
    path = tmp_path / "known.obo"
    path.write_text(KNOWN)
    terms = ontology.stanzas(spark, str(path))
    edges = ontology.edges(terms)
    assert [tuple(r) for r in edges.collect()] == [("UBERON:8000009", "UBERON:0002354")]
    assert [tuple(r) for r in ontology.reverse_xrefs(ontology.placed_xrefs(terms, "DOID")).collect()] == [("DOID:7", "MONDO:1")]
    claims = spark.createDataFrame([("e", "tissue", "s", t) for t in ("UBERON:8000009", "UBERON:0002354")], "entry string, attribute string, source string, term_id string")
    assert [r.term_id for r in ontology.most_specific(claims, ontology.closure(ontology.checked(edges))).collect()] == ["UBERON:0002354"]
    both = ontology.edges(terms, without=())
    with pytest.raises(ontology.CyclicOntology):
        ontology.checked(both)
    assert ontology.without_cycles(both).count() == 1


@pytest.mark.parametrize("name", ["ontology_cycles", "obo_xrefs_reversed", "source_disign_atlas"])
def test_at_a_larger_size(spark, name):
    larger = "/root/testdata/sf0.01"
    compare(connection(larger), driver.QUERIES[name](spark, larger), driver.ORACLE_SQL[name])


def test_rounds_of_a_chain_of_cycles(spark, monkeypatch):
    """Cycles that lie one above the other are settled in few rounds, each of several steps."""
    pairs = [(f"{90 - i}{x}", f"{90 - i}{y}") for i in range(12) for x, y in ("ab", "ba")] + [(f"{90 - i}a", f"{89 - i}b") for i in range(11)]
    frames, kept = [], ontology.written
    monkeypatch.setattr(ontology, "written", lambda df, name: frames.append(name) or kept(df, name))
    assert {tuple(r) for r in ontology.cycles(frame(spark, pairs)).collect()} == components(set(pairs))
    assert len(frames) <= 40, len(frames)


def test_components_of_graphs_with_many_cycles(spark):
    rng = np.random.default_rng(7)
    for n, m in ((12, 30), (25, 34), (60, 66)):
        pairs = {(f"t{a:02}", f"t{b:02}") for a, b in rng.integers(0, n, (m, 2))}
        assert {tuple(r) for r in ontology.cycles(frame(spark, pairs)).collect()} == components(pairs)
