"""Propagation on the four-node graph and on random graphs; curations; requests."""

import random

import pytest
from pyspark.sql import functions as F

from claimgrid.operators import curate, ontology
from claimgrid.operators.filters import NoResults
from claimgrid.plans.retrieval import Database, Request, export, parse_filters, parse_terms, retrieve, source_counts

CONTROL = "MONDO:0000000"


@pytest.fixture(scope="module")
def diamond(spark):
    return spark.createDataFrame([("A", "B"), ("A", "C"), ("B", "D")], "parent string, child string")


@pytest.fixture(scope="module")
def closed(diamond):
    return ontology.closure(diamond).cache()


def pairs(df):
    return sorted(map(tuple, df.collect()))


def test_closure(diamond, closed):
    want = sorted([("A", "A"), ("A", "B"), ("A", "C"), ("A", "D"), ("B", "B"), ("B", "D"), ("C", "C"), ("D", "D")])
    assert pairs(closed) == want
    assert pairs(ontology.closure_sql(diamond)) == want
    wide = closed.groupBy("ancestor").pivot("descendant").count().na.fill(0)
    assert pairs(ontology.closure_from_matrix(wide)) == want


def test_closure_of_a_cycle_and_of_nothing(spark):
    loop = spark.createDataFrame([("A", "B"), ("B", "A"), ("B", "C"), (None, "C")], "parent string, child string")
    assert pairs(ontology.closure(loop)) == sorted([(a, b) for a in "AB" for b in "ABC"] + [("C", "C")])
    assert ontology.closure(loop.limit(0)).count() == 0


def test_relations(spark, closed, diamond):
    of = spark.createDataFrame([("D",), ("A",), ("none",)], "term string")
    assert {r.term: r.ancestors for r in ontology.ancestors(closed, of).collect()} == {"D": ["A", "B", "D"], "A": ["A"]}
    assert {r.term: r.descendants for r in ontology.descendants(closed, of, keep_self=False).collect()} == {"A": ["B", "C", "D"]}
    asked = spark.createDataFrame([("D", "A"), ("A", "D"), ("A", "A"), ("C", "B")], "a string, b string")
    assert {(r.a, r.b): r.relation for r in ontology.relations(closed, asked).collect()} == {("D", "A"): 1, ("A", "D"): 0, ("A", "A"): -1, ("C", "B"): -1}
    assert pairs(ontology.roots(diamond)) == [("A",)] and pairs(ontology.leaves(diamond)) == [("C",), ("D",)]
    assert ontology.deepest(diamond, of.union(spark.createDataFrame([("B",)], "term string"))).first().term == "D"
    assert pairs(ontology.depths(diamond)) == [("A", 0), ("B", 1), ("C", 1), ("D", 2)]


def test_depth_is_the_longest_of_the_shortest_ways(spark):
    edges = spark.createDataFrame([("R", "X"), ("S", "Y"), ("Y", "X"), ("R", "Y")], "parent string, child string")
    assert dict(pairs(ontology.depths(edges))) == {"R": 0, "S": 0, "Y": 1, "X": 2}


def test_depths_of_many_roots(spark):
    """10,000 roots over three levels, some of which skip one, against a walk from every root."""
    rng = random.Random(5)
    ways = [(f"R{i}", f"A{rng.randrange(60)}") for i in range(10_000)] + [(f"R{i}", f"B{rng.randrange(25)}") for i in range(0, 10_000, 7)]
    ways += [(f"A{i}", f"B{rng.randrange(25)}") for i in range(60) for _ in range(2)] + [(f"B{i}", f"C{i % 4}") for i in range(25)] + [("R1", "C0"), ("lone", "B1"), ("R2", "A1"), ("R2", "A1")]
    below = {}
    for parent, child in ways:
        below.setdefault(parent, set()).add(child)
    expected = {}
    for root in {p for p, _ in ways} - {c for _, c in ways}:
        front, seen, d = {root}, {root}, 0
        while front:
            expected.update({t: max(expected.get(t, 0), d) for t in front})
            front = {c for t in front for c in below.get(t, ())} - seen
            seen, d = seen | front, d + 1
    edges = spark.createDataFrame(ways, "parent string, child string")
    assert dict(pairs(ontology.depths(edges))) == expected


def test_depths_keep_no_row_for_each_root_of_a_term(spark, monkeypatch):
    """Where nearly every term lies at one distance from all its roots, no frame outgrows the graph; cycles end too."""
    rng = random.Random(3)
    ways = [(f"R{i}", f"A{rng.randrange(300)}") for i in range(900)] + [(f"A{i}", f"B{rng.randrange(40)}") for i in range(300) for _ in range(6)]
    ways += [(f"B{i}", f"C{i % 3}") for i in range(40)] + [(f"R{i}", f"C{i % 3}") for i in range(0, 900, 2)] + [("C0", "D"), ("D", "C0"), ("R5", "D")]
    below = {}
    for parent, child in ways:
        below.setdefault(parent, set()).add(child)
    expected = {}
    for root in {p for p, _ in ways} - {c for _, c in ways}:
        front, seen, d = {root}, {root}, 0
        while front:
            expected.update({t: max(expected.get(t, 0), d) for t in front})
            front = {c for t in front for c in below.get(t, ())} - seen
            seen, d = seen | front, d + 1
    sizes, plain = [], ontology.written

    def counted(df, name):
        out = plain(df, name)
        if name != "edges":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(ontology, "written", counted)
    edges = spark.createDataFrame(ways, "parent string, child string")
    assert dict(pairs(ontology.depths(edges))) == expected
    assert max(sizes) <= len({t for way in ways for t in way})


def walked(ways):
    """The greatest of the shortest distances from each root, by a walk from every root."""
    below, expected = {}, {}
    for parent, child in ways:
        below.setdefault(parent, set()).add(child)
    for root in {p for p, _ in ways} - {c for _, c in ways}:
        front, seen, d = {root}, {root}, 0
        while front:
            expected.update({t: max(expected.get(t, 0), d) for t in front})
            front = {c for t in front for c in below.get(t, ())} - seen
            seen, d = seen | front, d + 1
    return expected


@pytest.mark.parametrize(("broadcast", "few"), [(0, 0), (40, 3), (500_000, 1000)])
def test_depths_by_levels_on_dealt_edges(spark, monkeypatch, broadcast, few):
    """Shortcuts of several lengths, a loop that a root reaches and one that none does, more than 64 terms with several
    lengths; edges in buckets, and fronts of each size."""
    rng = random.Random(7)
    ways = [(f"R{i}", f"A{rng.randrange(30)}") for i in range(150)] + [(f"A{i}", f"B{rng.randrange(20)}") for i in range(30) for _ in range(3)]
    ways += [(f"B{i}", f"C{rng.randrange(70)}") for i in range(20) for _ in range(4)] + [(f"R{i}", f"C{i % 70}") for i in range(0, 150, 2)] + [("A3", "C5"), ("R9", "D1"), ("C1", "D1"), ("D1", "D2")]
    ways += [("D2", "D1"), ("Z0", "Z1"), ("Z1", "Z0"), ("Z1", "B2"), ("Z1", "C9")] + [(f"C{i}", f"C{(i * 7 + 1) % 70}") for i in range(0, 70, 5)]
    for name, value in (("BROADCAST", broadcast), ("FEW", few)):
        monkeypatch.setattr(ontology, name, value)
    dealt, upwards, plain = ontology._ways, [], ontology._depths_upwards
    monkeypatch.setattr(ontology, "_ways", lambda edges: dealt(edges, 5, 5))
    monkeypatch.setattr(ontology, "_depths_upwards", lambda *a: upwards.append(1) or plain(*a))
    assert dict(pairs(ontology.depths(spark.createDataFrame(ways, "parent string, child string")))) == walked(ways)
    assert upwards and not [t for t in spark.catalog.listTables() if t.name.startswith("by_")]


def test_edges_of_a_walk_are_dealt_once(spark, monkeypatch):
    """No round deals or sorts the edges: a front goes to them, and what few send lies where it arrives."""
    edges = ontology.written(spark.range(1000).selectExpr("concat('A', id) AS parent", "concat('B', id % 50) AS child"), "edges")
    with ontology._ways(edges, 100, 100) as ways:
        front = edges.select(F.col("parent").alias("term"))
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        few = plan(ways.sent(front, 5000).groupBy("child").count())
        assert "Exchange hashpartitioning" not in few and "BroadcastHashJoin" in few and "PushedFilters: [IsNotNull(parent), GreaterThanOrEqual(parent,A0), LessThanOrEqual(parent,A999)]" in few
        monkeypatch.setattr(ontology, "BROADCAST", 500)
        many = plan(ways.sent(front, 1001))
        assert many.count("Exchange") == 1 and "ShuffledHashJoin" in many and "Sort " not in many
        assert "EqualTo(parent,A7)" in plan(ways.sent(front.where("term = 'A7'"), 1))
        monkeypatch.setattr(ontology, "BROADCAST", 1)
        assert "ShuffledHashJoin" not in plan(ways.sent(front, 1001))  # too many of a bucket to hash


def test_depths_of_odd_graphs(spark):
    loop = spark.createDataFrame([("A", "B"), ("B", "A"), ("R", "X"), (None, "X"), ("X", None)], "parent string, child string")
    assert dict(pairs(ontology.depths(loop))) == {"R": 0, "X": 1}
    assert ontology.depths(loop.limit(0)).count() == 0


def test_annotate_and_label(spark, closed):
    cells = spark.createDataFrame([("d", "D"), ("b", "B"), ("a", "A"), ("c", "C")], "entry string, term string")
    assert pairs(curate.annotate(cells, closed, ["B"])) == [("b", "B"), ("d", "B")]
    labels = curate.label(cells, closed, ["B"])
    assert pairs(curate.dense(labels, cells, ["B"])) == [("a", "B", 0), ("b", "B", 1), ("c", "B", -1), ("d", "B", 1)]
    assert curate.annotate(cells, closed, []).count() == 0


def test_controls(spark):
    """A control is 2 where its series has a positive; its own positive counts; a series without one drops it."""
    entries = spark.createDataFrame([("p", "s1"), ("k1", "s1"), ("k2", "s2"), ("k3", "s3"), ("u", "s2"), ("k4", "s1|s2")], "entry string, series string")
    cells = spark.createDataFrame([("p", "T"), ("k1", CONTROL), ("k2", CONTROL), ("k3", CONTROL), ("k3", "T"), ("u", "U"), ("k4", CONTROL)], "entry string, term string")
    flat = spark.createDataFrame([("T", "T"), ("U", "U")], "ancestor string, descendant string")
    labels = curate.label(cells.where(F.col("term") != CONTROL), flat, ["T"])
    assert pairs(curate.with_controls(labels, cells, entries)) == [("k1", "T", 2), ("k3", "T", 2), ("p", "T", 1)]


def test_sparse_equals_dense_on_random_graphs(spark):
    rng = random.Random(4)
    for _ in range(3):
        n = 12
        edges = [(f"t{i}", f"t{j}") for j in range(1, n) for i in rng.sample(range(j), min(j, rng.randint(1, 2)))]
        below = {f"t{i}": {f"t{i}"} for i in range(n)}
        for i in reversed(range(n)):
            for a, b in edges:
                if a == f"t{i}":
                    below[a] |= below[b]
        owned = {f"e{k}": {f"t{rng.randrange(n)}" for _ in range(rng.randint(1, 3))} for k in range(25)}
        targets = [f"t{i}" for i in rng.sample(range(n), 4)]
        closed = ontology.closure(spark.createDataFrame(edges, "parent string, child string"))
        cells = spark.createDataFrame([(e, t) for e, ts in owned.items() for t in ts], "entry string, term string")
        want = [(e, t, 1 if ts & below[t] else 0 if any(t in below[x] for x in ts) else -1) for e, ts in owned.items() for t in targets]
        assert pairs(curate.dense(curate.label(cells, closed, targets), cells, targets)) == sorted(want)
        frame = spark.createDataFrame([(t,) for t in targets], "term string")
        assert pairs(curate.dense(curate.label(cells, closed, frame), cells, frame)) == sorted(want)
        assert pairs(curate.annotate(cells, closed, targets)) == sorted((e, t) for e, t, v in want if v == 1)


def test_collapse_is_idempotent(spark):
    entries = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", "b"), ("4", "b")], "entry string, series string")
    cells = spark.createDataFrame([("1", "x"), ("3", "x"), ("2", "y"), ("4", "y"), ("1", "z"), ("2", "z")], "entry string, term string")
    once = curate.collapse(cells, entries)
    assert pairs(once) == [("a", "x"), ("a", "y"), ("a", "z"), ("b", "x"), ("b", "y")]
    again = curate.collapse(once.withColumnRenamed("series", "entry"), spark.createDataFrame([("a", "a"), ("b", "b")], "entry string, series string"))
    assert pairs(again) == pairs(once)


def test_curation(spark):
    entries = spark.createDataFrame([(f"{i}", f"s{i % 2}", "GPL1") for i in range(6)], "entry string, series string, platform string")
    cells = spark.createDataFrame([(f"{i}", "x" if i < 3 else "y") for i in range(6)], "entry string, term string")
    c = curate.Curation(cells, entries)
    assert (c.n_indices, c.n_entities, c.groups) == (6, 2, ["series", "platform"])
    assert c.filter(F.col("series") == "s0").cells.count() == 3
    assert c.having("x").n_indices == 3 and c.select("y").cells.count() == 3 and c.drop("y").n_entities == 1
    assert [r.entry for r in c.slice(2, 2).entries.collect()] == ["2", "3"] and c.head(2).count() == 2
    assert c.collapse().collapsed and c.collapse().n_indices == 2 and c.unique_groups().count() == 2
    more = spark.createDataFrame([(f"{i}", "d") for i in range(6)], "entry string, description string")
    assert "description" in c.add_ids(more).entries.columns
    with pytest.raises(ValueError):
        c.add_ids(more.limit(3))
    with pytest.raises(ValueError):  # one id doubled, another missing
        c.add_ids(more.where("entry <> '5'").union(more.where("entry = '4'")))


def test_curation_of_a_wide_frame(spark):
    wide = spark.createDataFrame([("a", "s1", 1, 0), ("b", "s1", 0, 1), ("c", "s2", 0, 0)], "entry string, series string, z int, y int")
    c = curate.Curation.of_wide(wide, ["entry", "series"])
    assert pairs(c.cells) == [("a", "z", 1), ("b", "y", 1)] and c.ids.columns == ["entry", "series"]
    assert c.wide().columns == ["entry", "series", "y", "z"] and c.wide(descending=True).columns == ["entry", "series", "z", "y"]
    assert pairs(c.wide(["z", "y"])) == pairs(wide)


@pytest.fixture(scope="module")
def database(spark, closed):
    entries = spark.createDataFrame([("g1", "s1", "GPL1", "homo sapiens"), ("g2", "s1", "GPL1", "homo sapiens"), ("g3", "s2", "GPL2", "homo sapiens"), ("g4", "s2", None, "mus musculus")], "entry string, series string, platform string, organism string")
    rows = [("g1", "disease", "ALE", "D"), ("g2", "disease", "Gemma", CONTROL), ("g2", "disease", "ALE", "C"), ("g3", "disease", "ALE", "B"), ("g4", "disease", "ALE", "B"), ("g1", "sex", "ALE", "M")]
    claims = spark.createDataFrame([(*r, r[3].lower(), "expert-curated") for r in rows], "entry string, attribute string, source string, term_id string, term_name string, ecode string")
    return Database(claims, entries, spark.createDataFrame([("GPL1", "rnaseq"), ("GPL2", "microarray")], "id string, technology string"), closed)


def test_requests(spark, database, tmp_path):
    done = retrieve(database, Request("disease", ["B", "nowhere"]))
    assert pairs(done.curation.cells) == [("g1", "B")] and done.missing == ["nowhere"]
    labels = retrieve(database, Request("disease", ["B", "C"], mode="label"))
    assert pairs(labels.curation.cells) == [("g1", "B", 1), ("g2", "B", 2), ("g2", "C", 2)]
    idle = retrieve(database, Request("disease", ["D"], mode="label"))  # D is in the control's series, C is not asked for
    assert pairs(idle.curation.cells) == [("g1", "D", 1), ("g2", "D", 2)]
    assert pairs(retrieve(database, Request("disease", ["C"], mode="label")).curation.entries.select("entry")) == [("g1",), ("g2",)]
    assert pairs(retrieve(database, Request("disease", "all", mode="direct", technology="microarray")).curation.cells) == [("g3", "B")]
    assert pairs(retrieve(database, Request("sex", ["M"])).curation.cells) == [("g1", "M")]
    assert retrieve(database, Request("disease", ["B"], licence="nc")).curation.cells.count() == 0
    assert {r.source: r.n for r in source_counts(done).collect()} == {"ALE": 1}
    export(labels, database, Request("disease", ["B", "C"], mode="label", metadata=["series"]), f"{tmp_path}/labels")
    got = {r.entry: (r.B, r.C) for r in spark.read.parquet(f"{tmp_path}/labels").collect()}
    assert got == {"g1": (1, -1), "g2": (2, 2)}
    for fmt in ("csv", "tsv", "json"):
        export(done, database, Request("disease", ["B"], metadata=["series"], fmt=fmt), f"{tmp_path}/{fmt}")
    with pytest.raises(NoResults):
        retrieve(database, Request("disease", ["nowhere"]))
    with pytest.raises(NoResults):
        export(retrieve(database, Request("disease", ["B"], licence="nc")), database, Request("disease"), f"{tmp_path}/none")


def test_parsing(tmp_path):
    assert parse_filters("species=mouse,tech=microarray") == {"species": "mouse", "technology": "microarray"}
    with pytest.raises(ValueError):
        parse_filters("planet=mars")
    assert parse_terms("male, female", "sex") == ["M", "F"] and parse_terms("all", "disease") == "all"
    (tmp_path / "terms").write_text("X:1\n\nX:2\n")
    assert parse_terms(str(tmp_path / "terms"), "tissue") == ["X:1", "X:2"]
    with pytest.raises(ValueError):
        Request("disease", species="martian")


def test_wide_table_of_many_terms(spark, tmp_path):
    """Over 10,000 columns in one table, sorted by a column that isn't written; the greatest of several values counts."""
    from claimgrid import sinks

    terms = [f"MONDO:{i:05}" for i in range(10_050)]
    labels = spark.createDataFrame([("e1", terms[0], 1), ("e1", terms[0], 0), ("e1", terms[10_049], 0), ("e2", terms[7], 2), ("e2", "other", 1)], "entry string, term string, value int")
    entries = spark.createDataFrame([("e1", "b"), ("e2", "a"), ("e3", "c")], "entry string, series string")
    sinks.save_wide(labels, entries, terms, [], f"{tmp_path}/w", absent=-1, sort_by=["series", "entry"])
    out = spark.read.parquet(f"{tmp_path}/w")
    assert out.columns == ["entry", *terms]
    rows = {r[0]: r[1:] for r in out.collect()}
    want = {"e1": {0: 1, 10_049: 0}, "e2": {7: 2}, "e3": {}}
    assert rows == {e: tuple(own.get(i, -1) for i in range(len(terms))) for e, own in want.items()}
    sinks.save_wide(labels.where("value <> 0"), entries, terms[:9], ["series"], f"{tmp_path}/a")
    assert sorted((r.entry, r.series, r[terms[0]], r[terms[7]]) for r in spark.read.parquet(f"{tmp_path}/a").collect()) == [("e1", "b", 1, 0), ("e2", "a", 0, 2)]


def test_wide_table_in_blocks(spark):
    """Blocks spell out what the table of named columns says; those that an entry has no label in are left out."""
    from claimgrid import sinks

    terms = [f"T:{i:04}" for i in range(1_003)]
    places = sinks.placed(spark.createDataFrame([(t,) for t in [*reversed(terms), terms[3], None]], "term string").repartition(7))
    assert pairs(places) == [(t, i) for i, t in enumerate(terms)]
    labels = spark.createDataFrame([("e1", terms[0], 0), ("e1", terms[0], 1), ("e1", terms[1_002], 0), ("e2", terms[256], 2), ("e2", "other", 1)], "entry string, term string, value int")
    entries = spark.createDataFrame([("e1",), ("e2",), ("e3",)], "entry string")
    rows = {(r.entry, r.block): (r.first, r["values"]) for r in sinks.blocks(labels, entries, places, -1).collect()}
    assert sorted(rows, key=str) == [("e1", 0), ("e1", 3), ("e2", 1), ("e3", None)] and rows["e3", None] == (None, None)
    assert rows["e1", 0] == (0, [1] + [-1] * 255) and rows["e2", 1] == (256, [2] + [-1] * 255)
    assert rows["e1", 3] == (768, [-1] * 234 + [0])


def test_labels_are_made_by_one_join_and_one_sum(spark, closed):
    cells = spark.createDataFrame([("e", "B"), ("e", "D"), ("e", "D"), ("f", "A")], "entry string, term string")
    own = curate.label(cells, closed, ["A", "B", "D"])
    assert pairs(own) == [("e", "A", 1), ("e", "B", 1), ("e", "D", 1), ("f", "A", 1), ("f", "B", 0), ("f", "D", 0)]
    plan = own._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and plan.count("Aggregate [") == 1


def test_claims_are_grouped_by_one_shuffle(spark):
    from claimgrid.operators import aggregate, integrate

    claims = spark.createDataFrame([("e", "tissue", "s", t, "x") for t in "bab"] + [("e", "sex", "s", "M", "y")], "entry string, attribute string, source string, term_id string, ecode string")
    nested, grouped = integrate.nested(claims), aggregate.grouped(claims, "source")
    for own in (nested, grouped):
        plan = own._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange ") == 1 and "REPARTITION" in plan
    assert nested.first().tissue["s"]["id"] == "a|b" and pairs(grouped) == [("e", "sex", "s", "M", "y"), ("e", "tissue", "s", "a|b", "x")]
