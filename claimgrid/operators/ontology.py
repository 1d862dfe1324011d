"""Ontology graphs: parsing, cycles, reflexive closure, relations of terms, depth, systems and the most-specific filter."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimgrid.functions.scalar import extract
from claimgrid.schema import CONTROL_ID, NA
from claimgrid.storage import bucketed, shared_root, written

# Pseudo ids that stand for a control, by ontology; and the one edge (parent, child) that closes a cycle in the
# published ontologies.
PSEUDO_CONTROLS = ("DOID:0000000", "MESH:D000000", "UMLS:C0000000")
CLOSES_CYCLE = (("UBERON:0002354", "UBERON:8000009"),)
MAPPINGS = {("DOID", "MONDO"), ("MESH", "MONDO"), ("UMLS", "MONDO"), ("MONDO", "MESH")}


class CyclicOntology(ValueError):
    """Terms that are each other's ancestors."""


def stanzas(spark: SparkSession, path: str) -> DataFrame:
    """(pos, text): [Term] stanzas of OBO files, plain or gz, without obsolete terms; pos orders them by file and place."""
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("n"))
    raw = spark.read.text(path, lineSep="\n\n").select(place.alias("pos"), F.trim("value").alias("text"))
    return raw.where(F.col("text").startswith("[Term]") & ~F.col("text").rlike(r"(?m)^is_obsolete:\s*true"))


def term_names(terms: DataFrame) -> DataFrame:
    """(id, name): lower-cased; the first stanza of an id counts."""
    rows = terms.select("pos", extract(F.col("text"), r"(?m)^id:\s*(\S+)").alias("id"), F.lower(extract(F.col("text"), r"(?m)^name:\s*(.+)$")).alias("name"))
    return rows.where("id is not null and name is not null").groupBy("id").agg(F.min(F.struct("pos", "name"))["name"].alias("name"))


def xrefs(terms: DataFrame, prefix: str) -> DataFrame:
    """(id, xref): the first cross-reference with a prefix of each term."""
    return placed_xrefs(terms, prefix).select("id", "xref")


def placed_xrefs(terms: DataFrame, prefix: str) -> DataFrame:
    """The same with ``pos``, where the id's first reference stands."""
    rows = terms.select("pos", extract(F.col("text"), r"(?m)^id:\s*(\S+)").alias("id"), F.posexplode(F.regexp_extract_all("text", F.lit(r"(?m)^xref:\s*(\S+)"), F.lit(1))).alias("n", "xref"))
    rows = rows.where(F.col("xref").startswith(prefix + ":"))
    first = rows.groupBy("id").agg(F.min(F.struct("pos", "n", "xref")).alias("first"))
    return first.select("id", "first.xref", "first.pos")


def reverse_xrefs(mapping: DataFrame) -> DataFrame:
    """(xref, id) from (id, xref, pos): of ids that share a reference the last in the file stays, whatever its number."""
    return mapping.groupBy("xref").agg(F.max(F.struct("pos", "id"))["id"].alias("id"))


def map_terms(df: DataFrame, column: str, mapping: DataFrame, source: str, target: str, out: str = "mapped") -> DataFrame:
    """A column of term ids by a map (key, value): pseudo controls become the control, the unmapped NA."""
    if (source, target) not in MAPPINGS:
        raise NotImplementedError(f"{source} to {target}")
    k, v = mapping.columns
    joined = df.join(mapping.select(F.col(k).alias("_k"), F.col(v).alias("_v")), F.col(column) == F.col("_k"), "left")
    value = F.when(F.col(column).isin(*PSEUDO_CONTROLS), CONTROL_ID).otherwise(F.coalesce("_v", F.lit(NA)))
    return joined.withColumn(out, value).drop("_k", "_v")


def edges(terms: DataFrame, prefixes: tuple[str, ...] = ("UBERON", "CL", "MONDO"), without: tuple[tuple[str, str], ...] = CLOSES_CYCLE) -> DataFrame:
    """(parent, child) by is_a and part_of, for terms of the given ontologies. without: edges (parent, child) to leave out,
    by default the one that is known to close a cycle."""
    own = terms.select(extract(F.col("text"), r"(?m)^id:\s*(\S+)").alias("child"), F.explode(F.array_union(
        F.regexp_extract_all("text", F.lit(r"(?m)^is_a:\s*(\S+)"), F.lit(1)),
        F.regexp_extract_all("text", F.lit(r"(?m)^relationship:\s*part_of\s+(\S+)"), F.lit(1)),
    )).alias("parent"))
    belongs = lambda c: F.col(c).rlike("^(?:" + "|".join(prefixes) + "):")
    own = own.where(belongs("child") & belongs("parent"))
    for parent, child in without:
        own = own.where(~((F.col("parent") == parent) & (F.col("child") == child)))
    return own.select("parent", "child").distinct()


def nodes(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("parent").alias("term")).union(edges.select("child")).distinct()


def _trimmed(edges: DataFrame, at_once: int = 4) -> DataFrame:
    """Edges left when terms without parents and terms without children have gone, again and again: those of cycles and of ways
    from one cycle to another. Of a graph without cycles nothing is left."""
    now = written(edges.where("parent is not null and child is not null").select("parent", "child").distinct(), "trimmed")
    n = now.count()
    while n:
        some = now
        for _ in range(at_once):
            below, above = some.select(F.col("child").alias("parent")).distinct(), some.select(F.col("parent").alias("child")).distinct()
            some = some.join(below, "parent", "left_semi").join(above, "child", "left_semi").select("parent", "child")
        now, before = written(some, "trimmed"), n
        n = now.count()
        if n == before:
            break
    return now


def _coloured(edges: DataFrame, at_once: int = 4) -> DataFrame:
    """(term, colour): the greatest term from which each can be reached, itself included. Of each written round there are
    several steps; as every term also has an edge to itself, a step is one join and one aggregation."""
    own = nodes(edges)
    ways = written(edges.select(F.col("parent").alias("term"), "child", F.lit(False).alias("same")).union(own.select("term", "term", F.lit(True))), "ways")
    now = own.select("term", F.col("term").alias("colour"))
    while True:
        after = now.select("term", "colour", F.col("colour").alias("had"))
        for _ in range(at_once):
            sent = after.join(ways, "term").select(F.col("child").alias("term"), "colour", F.when(F.col("same"), F.col("had")).alias("had"))
            after = sent.groupBy("term").agg(F.max("colour").alias("colour"), F.max("had").alias("had"))
        after = written(after, "colours")
        now = after.select("term", "colour")
        if after.where("colour <> had").isEmpty():
            return now


def _alike(edges: DataFrame, colours: DataFrame) -> DataFrame:
    """Edges between terms of one colour."""
    at = lambda side: colours.select(F.col("term").alias(side), F.col("colour").alias(f"of_{side}"))
    return edges.join(at("parent"), "parent").join(at("child"), "child").where("of_parent = of_child").select("parent", "child")


def cycles(edges: DataFrame) -> DataFrame:
    """(component, term): the strongly connected components that hold a cycle, named by their least term.

    After trimming, every term takes the greatest colour that reaches it (forward); edges between colours lie on no cycle and
    go. Within a colour every term then takes the greatest one that it reaches (backward): where both are equal it is of the
    component of the colour's own term, which leaves, and what is left falls apart by the second colour. Frames stay in
    proportion to terms and edges, whatever the size of a component; rounds grow with the length of its ways.
    """
    left, found = _trimmed(edges), edges.sparkSession.createDataFrame([], "root string, term string")
    loops = edges.where("parent = child").select(F.col("parent").alias("root"), F.col("child").alias("term")).distinct()
    while not left.isEmpty():
        down = _coloured(left)
        within = written(_alike(left, down), "within")
        up = _coloured(within.select(F.col("child").alias("parent"), F.col("parent").alias("child")))
        both = written(down.withColumnRenamed("colour", "root").join(up, "term"), "both")
        found = found.union(both.where("root = colour").select("root", "term"))
        left = _trimmed(_alike(within, both.where("root <> colour").select("term", "colour")))
    named = found.groupBy("root").agg(F.min("term").alias("component"), F.count("*").alias("n"))
    kept = found.join(named, "root").where("n > 1").select("component", "term")
    return kept.union(loops.join(kept, "term", "left_anti").select("root", "term"))


def without_cycles(edges: DataFrame) -> DataFrame:
    """edges without those that lead, within a component, to its least term, and so on until there is no cycle."""
    while not (found := written(cycles(edges), "cycles")).isEmpty():
        above = found.select("component", F.col("term").alias("parent"))
        closing = above.join(found.select("component", F.col("term").alias("child")), "component").where("child = component").select("parent", "child")
        edges = written(edges.join(closing, ["parent", "child"], "left_anti"), "edges")
    return edges


def checked(edges: DataFrame, named: int = 20) -> DataFrame:
    """edges if they have no cycle; else an error that names the first terms of cycles, by component."""
    found = written(cycles(edges), "cycles")
    if found.isEmpty():
        return edges
    some = found.orderBy("component", "term").limit(named).collect()
    by: dict[str, list[str]] = {}
    for r in some:
        by.setdefault(r["component"], []).append(r["term"])
    more = "" if len(some) < named else ", and more"
    raise CyclicOntology("; ".join(", ".join(terms) for terms in by.values()) + more)


def closure(edges: DataFrame) -> DataFrame:
    """(ancestor, descendant) with every term its own: paths double in length each round until no pair is new.

    A round joins only the last round's new pairs with all pairs. Cycles end it too. Each round is checkpointed to the
    shared folder, so plans stay short and lost executors do no harm.
    """
    spark = edges.sparkSession
    shared_root(spark)
    own = edges.where("parent is not null and child is not null").select(F.col("parent").alias("ancestor"), F.col("child").alias("descendant"))
    new = own.distinct().checkpoint()
    pairs = new
    via = lambda df, side: df.withColumnRenamed(side, "via")
    while not new.isEmpty():
        longer = via(new, "descendant").join(via(pairs, "ancestor"), "via").union(via(pairs, "descendant").join(via(new, "ancestor"), "via"))
        new = longer.select("ancestor", "descendant").distinct().join(pairs, ["ancestor", "descendant"], "left_anti").checkpoint()
        pairs = pairs.union(new)
    self_pairs = nodes(edges).where("term is not null").select(F.col("term").alias("ancestor"), F.col("term").alias("descendant"))
    return pairs.where("ancestor <> descendant").union(self_pairs)


def closure_sql(edges: DataFrame, levels: int = 100) -> DataFrame:
    """The same by one recursive query: no jobs between rounds, but paths are counted along every way, so for shallow graphs.

    It is run at once, as Spark's limit on the rows of a recursion (1,000,000) is lifted for this query alone.
    """
    edges.createOrReplaceTempView("_edges")
    nodes(edges).createOrReplaceTempView("_nodes")
    spark = edges.sparkSession
    shared_root(spark)
    limit = spark.conf.get("spark.sql.cteRecursionRowLimit")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    try:
        return spark.sql(
            f"""WITH RECURSIVE walk(ancestor, descendant) MAX RECURSION LEVEL {levels} AS (
              SELECT term, term FROM _nodes
              UNION ALL SELECT w.ancestor, e.child FROM walk w JOIN _edges e ON w.descendant = e.parent)
            SELECT DISTINCT ancestor, descendant FROM walk"""
        ).checkpoint()
    finally:
        spark.conf.set("spark.sql.cteRecursionRowLimit", limit)


def closure_from_matrix(wide: DataFrame, row: str = "ancestor") -> DataFrame:
    """(ancestor, descendant) from a square 0/1 matrix with a column for each descendant."""
    values = [c for c in wide.columns if c != row]
    return wide.unpivot([row], values, "descendant", "v").where("v <> 0").select(F.col(row).alias("ancestor"), "descendant")


def ancestors(closure: DataFrame, of: DataFrame, keep_self: bool = True) -> DataFrame:
    """(term, ancestors): sorted; of: a column ``term``. Unknown terms have no row."""
    own = closure.join(of.select(F.col("term").alias("descendant")).distinct(), "descendant")
    own = own if keep_self else own.where("ancestor <> descendant")
    return own.groupBy(F.col("descendant").alias("term")).agg(F.array_sort(F.collect_set("ancestor")).alias("ancestors"))


def descendants(closure: DataFrame, of: DataFrame, keep_self: bool = True) -> DataFrame:
    own = closure.join(of.select(F.col("term").alias("ancestor")).distinct(), "ancestor")
    own = own if keep_self else own.where("ancestor <> descendant")
    return own.groupBy(F.col("ancestor").alias("term")).agg(F.array_sort(F.collect_set("descendant")).alias("descendants"))


def roots(edges: DataFrame) -> DataFrame:
    return nodes(edges).join(edges.select(F.col("child").alias("term")).distinct(), "term", "left_anti")


def leaves(edges: DataFrame) -> DataFrame:
    return nodes(edges).join(edges.select(F.col("parent").alias("term")).distinct(), "term", "left_anti")


# Rows of edges that aren't dealt yet, of those in one bucket at most, if they are spread evenly, of a front that is
# broadcast or of its part for a bucket that is hashed, and of one whose terms are looked up in their buckets.
UNDEALT, BUCKET, BROADCAST, FEW = 10_000_000, 1_000_000, 500_000, 1000


@dataclass
class Ways:
    """Edges for many rounds of walks: (parent, child), once dealt by parent and once by child, if there are many."""

    by_parent: DataFrame
    by_child: DataFrame
    buckets: int = 0

    def turned(self) -> Ways:
        """The same edges from child to parent."""
        turn = lambda df: df.select(F.col("child").alias("parent"), F.col("parent").alias("child"))
        return Ways(turn(self.by_child), turn(self.by_parent), self.buckets)

    def sent(self, front: DataFrame, n: int) -> DataFrame:
        """The n rows of front and each ``child`` of their term. Where edges are dealt, they stay where they are: a front of many
        rows is dealt to the edges by parent; one of few rows is sent to the edges by child, so what arrives lies there. Of a
        front of very few only the buckets of its terms are read, of others what lies between their least and their greatest."""
        at = F.col("term") == F.col("parent")
        if not self.buckets:
            return front.join(self.by_parent, at)
        if n <= FEW:
            terms = [r["term"] for r in front.select("term").distinct().collect()]
            return self.by_parent.where(F.col("parent").isin(terms)).join(F.broadcast(front), at)
        near = F.col("parent").between(*front.agg(F.min("term"), F.max("term")).first())
        if n <= BROADCAST:
            return self.by_child.where(near).join(F.broadcast(front), at)
        return self.by_parent.where(near).join(front.hint("shuffle_hash") if n <= BROADCAST * self.buckets else front, at)


@contextmanager
def _ways(edges: DataFrame, undealt: int = UNDEALT, bucket: int = BUCKET) -> Iterator[Ways]:
    """Ways of a written frame; beyond some rows they are dealt. There are as many buckets as a shuffle has parts at least, as
    Spark would deal the edges of fewer again."""
    if (n := edges.count()) <= undealt:
        yield Ways(edges, edges)
        return
    parts = max(int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // bucket))
    with bucketed(edges, "by-parent", "parent", parts) as by_parent, bucketed(edges, "by-child", "child", parts) as by_child:
        yield Ways(by_parent, by_child, parts)


def _numbered(roots: DataFrame) -> DataFrame:
    """(term, word, bit): each root's place in the sets of ``depths``, 64 to a word; roots of near ids share words."""
    rows = roots.repartitionByRange("term").sortWithinPartitions("term").withColumn("n", F.monotonically_increasing_id())
    return written(rows.select("term", F.shiftright("n", 6).alias("word"), F.expr("shiftleft(1L, cast(n % 64 AS INT))").alias("bit")), "roots")


def _rounds(ways: Ways, numbered: DataFrame):
    """Yields (step, seen) for each round of a walk from all numbered terms at once, until no term sees a new one.

    seen: (term, word, seen, new, depth), the numbered terms as 64 bits of a word; depth is the last step at which the term
    saw a new one of the word. A round sends only new bits, so at most a row for each edge and word.
    """
    seen = numbered.select("term", "word", F.col("bit").alias("seen"), F.col("bit").alias("new"), F.lit(0).alias("depth"))
    step = 0
    while n := (front := written(seen.where("new <> 0").select("term", "word", "new"), "front")).count():
        step += 1
        sent = ways.sent(front, n).select(F.col("child").alias("term"), "word", F.lit(0).cast("long").alias("seen"), "new", F.lit(0).alias("depth"))
        both = seen.select("term", "word", "seen", F.lit(0).cast("long").alias("new"), "depth").union(sent)
        merged = both.groupBy("term", "word").agg(F.bit_or("seen").alias("had"), F.bit_or("new").alias("got"), F.max("depth").alias("depth"))
        new = F.col("got").bitwiseAND(F.bitwise_not("had"))
        after = merged.select("term", "word", F.col("had").bitwiseOR(F.col("got")).alias("seen"), new.alias("new"), F.when(new != 0, F.lit(step)).otherwise(F.col("depth")).alias("depth"))
        seen = written(after, "depths")
        yield step, seen


def _levels(ways: Ways, roots: DataFrame, n: int, at_once: int = 8) -> tuple[DataFrame, DataFrame]:
    """(term, level), the shortest distance from any of the n roots, and (term) of those that a root's walk of another length
    reaches too.

    A term is sent on twice at most: when it is first reached, and when it is found to have several lengths. What a round
    finds is kept beside what was found before, and put together after some rounds.
    """
    reached, several, front, step = roots.select("term", F.lit(0).alias("level")), roots.select("term").limit(0), roots.select("term"), 0
    while n:
        step += 1
        sent = written(ways.sent(front, n).select(F.col("child").alias("term")).distinct(), "sent")
        known = written(reached.join(sent, "term", "left_semi").select("term"), "known")
        new, turned = written(sent.join(known, "term", "left_anti"), "reached"), written(known.join(several, "term", "left_anti"), "several")
        reached, several = reached.union(new.select("term", F.lit(step).alias("level"))), several.union(turned)
        front, n = new.union(turned), new.count() + turned.count()
        if step % at_once == 0:
            reached, several = written(reached, "levels"), written(several, "several")
    return reached, several


def depths(edges: DataFrame) -> DataFrame:
    """(term, depth): the greatest, over the roots, of the shortest distance from a root; terms that no root reaches have no row.

    Roots are the bits of numbers, 64 to a row of a term. With more roots than that, the terms that walks of one length only
    reach are settled first, as every root is at that distance. For the others, if there are fewer of them than roots, they
    are the bits, which go up to the roots level by level (``_depths_upwards``). Otherwise a walk goes down from the roots, where
    a term's depth is the last step at which it sees a new root.
    """
    own = written(edges.where("parent is not null and child is not null").select("parent", "child"), "edges")
    with _ways(own) as ways:
        below = ways.by_child.select(F.col("child").alias("term")).distinct()
        top = written(ways.by_parent.select(F.col("parent").alias("term")).distinct().join(below, "term", "left_anti"), "tops")
        n = top.count()
        if n > 64:
            levels, several = _levels(ways, top, n)
            left = written(several, "several")
            if left.count() < n:
                settled = levels.join(left, "term", "left_anti").select("term", F.col("level").alias("depth"))
                return settled.union(_depths_upwards(ways, top, levels, left))
        numbered = _numbered(top)
        seen = numbered.select("term", F.lit(0).alias("depth"))
        for _, seen in _rounds(ways, numbered):  # noqa: B007  the last one counts
            pass
        return seen.groupBy("term").agg(F.max("depth").alias("depth"))


def _depths_upwards(ways: Ways, roots: DataFrame, levels: DataFrame, terms: DataFrame) -> DataFrame:
    """depths of the terms that walks of several lengths reach. What is below such a term is one too, so a way from a root to it
    goes by settled terms first, and by an edge (above, term) on to the others.

    Their distances among each other are walked within them. A settled term's parents are all one level above it, and all its
    roots are at the distance of its level, so with what it sees go the totals that its roots see, and each edge is used
    once, level by level. The column ``b<slot>`` of a term's row has the bits whose total is at that place among the totals of
    their term: the first slot in which a root sees one counts. There are as many as ways of a term differ in length.
    """
    n, numbered, up = terms.count(), _numbered(terms), ways.turned()
    into = written(up.sent(terms, n).select("term", F.col("child").alias("above")), "edges")
    inner = written(into.join(terms.select(F.col("term").alias("above")), "above", "left_semi").select(F.col("term").alias("parent"), F.col("above").alias("child")), "edges")
    seen = numbered.select("term", "word", F.col("bit").alias("bits"), F.lit(1).alias("steps"))
    with _ways(inner) as within:
        for step, after in _rounds(within, numbered):
            seen = seen.union(after.where("new <> 0").select("term", "word", F.col("new").alias("bits"), F.lit(step + 1).alias("steps")))
    settled = levels.join(terms, "term", "left_anti").withColumnRenamed("term", "above")
    outer = written(into.join(settled, "above"), "edges")
    if not (at := [r["level"] for r in outer.select("level").distinct().collect()]):
        return terms.select("term", F.lit(0).alias("depth"))
    given = outer.join(seen, "term").select(F.col("above").alias("term"), "level", "word", (F.col("level") + F.col("steps")).alias("total"), "bits")
    totals = given.groupBy("word", "total").agg(F.bit_or("bits").alias("bits")).join(numbered, "word").where(F.col("bits").bitwiseAND(F.col("bit")) != 0)
    slots = written(totals.select("term", "word", "bit", "total", F.row_number().over(Window.partitionBy("term").orderBy("total")).alias("slot")), "slots")
    columns = {k: f"b{k}" for k in range(1, slots.agg(F.max("slot")).first()[0] + 1)}
    masks = slots.groupBy("word", "total").agg(*(F.coalesce(F.bit_or(F.when(F.col("slot") == k, F.col("bit"))), F.lit(0).cast("long")).alias(c) for k, c in columns.items()))
    own = given.join(masks, ["word", "total"]).groupBy("term", "level", "word").agg(*(F.bit_or(F.col("bits").bitwiseAND(F.col(c))).alias(c) for c in columns.values()))
    own, now = written(own, "placed"), None
    together = [F.bit_or(c).alias(c) for c in columns.values()]
    for level in range(max(at), -1, -1):
        rows = own.where(F.col("level") == level).drop("level") if level in at else None
        if now is not None:
            sent = up.sent(now, now.count()).select(F.col("child").alias("term"), "word", *columns.values()).groupBy("term", "word").agg(*together)
            rows = sent if rows is None else rows.unionByName(sent).groupBy("term", "word").agg(*together)
        now = written(rows, "up")
    before, first = F.lit(0).cast("long"), []
    for k, c in columns.items():
        first.append(F.struct(F.lit(k).alias("slot"), F.bit_or(F.col(c).bitwiseAND(F.bitwise_not(before))).alias("met")))
        before = before.bitwiseOR(F.col(c))
    met = now.join(roots, "term", "left_semi").groupBy("word").agg(F.array(*first).alias("met")).select("word", F.inline("met"))
    found = slots.join(met, ["word", "slot"]).where(F.col("met").bitwiseAND(F.col("bit")) != 0)
    return found.groupBy("term").agg(F.max("total").alias("depth"))


def deepest(edges: DataFrame, of: DataFrame) -> DataFrame:
    """The deepest of some terms; of equal depth the least id."""
    return depths(edges).join(of.select("term").distinct(), "term", "left_semi").orderBy(F.desc("depth"), "term").limit(1)


def relations(closure: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs (a, b) with ``relation``: 1 if a is a strict descendant of b, 0 if a strict ancestor, else -1."""
    strict = closure.where("ancestor <> descendant")
    down = strict.select(F.col("descendant").alias("a"), F.col("ancestor").alias("b"), F.lit(1).alias("r"))
    up = strict.select(F.col("ancestor").alias("a"), F.col("descendant").alias("b"), F.lit(0).alias("r"))
    found = down.union(up).groupBy("a", "b").agg(F.max("r").alias("r"))
    return pairs.join(found, ["a", "b"], "left").select("a", "b", F.coalesce("r", F.lit(-1)).alias("relation"))


def system_descendants(closure: DataFrame, systems: DataFrame) -> DataFrame:
    """(term): strict descendants of the listed systems (a column ``term``)."""
    own = closure.where("ancestor <> descendant").join(systems.select(F.col("term").alias("ancestor")).distinct(), "ancestor", "left_semi")
    return own.select(F.col("descendant").alias("term")).distinct()


def most_specific(claims: DataFrame, closure: DataFrame, systems: DataFrame | None = None, control: str = CONTROL_ID) -> DataFrame:
    """Claims whose term has no strict descendant among the terms of the same entry and attribute, over all sources.

    systems: first keep strict descendants of these only, and the control; these claims are written once, as they are read
    several times. The closure joins the distinct terms of an entry once, without ancestors that no claim has; the rows that go
    are then anti-joined, so nothing compares terms pair by pair, and no task has to hold the ancestors of its claims as a set.
    """
    if systems is not None:
        inside = system_descendants(closure, systems).join(systems.select("term"), "term", "left_anti")
        inside = written(inside.union(claims.sparkSession.createDataFrame([(control,)], "term string")), "inside")
        claims = written(claims.join(inside.select(F.col("term").alias("term_id")), "term_id", "left_semi").select(*claims.columns), "claims-inside")
    have = claims.select("entry", "attribute", "term_id").distinct()
    strict = closure.where("ancestor <> descendant").join(claims.select(F.col("term_id").alias("ancestor")).distinct(), "ancestor", "left_semi")
    above = have.join(strict, have["term_id"] == strict["descendant"]).select("entry", "attribute", F.col("ancestor").alias("term_id"))
    return claims.join(above, ["entry", "attribute", "term_id"], "left_anti").select(*claims.columns)
