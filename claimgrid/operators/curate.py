"""Propagating cells along an ontology: annotations, labels, controls, collapse.

``cells`` is (entry, term), sparse. What the dense form does by a matrix product is here a join with the closure and a
distinct. Only targets' pairs of the closure take part: they are cut out before the join with the cells.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgrid.operators.reshape import unpivoted
from claimgrid.schema import CONTROL, CONTROL_ID, NEGATIVE, POSITIVE, UNKNOWN


def _targets(closure: DataFrame, targets: list[str] | DataFrame, side: str) -> DataFrame:
    if isinstance(targets, DataFrame):
        return closure.join(targets.select(F.col("term").alias(side)).distinct(), side, "left_semi")
    return closure.where(F.col(side).isin(*targets)) if targets else closure.limit(0)


def annotate(cells: DataFrame, closure: DataFrame, targets: list[str] | DataFrame) -> DataFrame:
    """(entry, term): a target where the entry has it or any descendant of it. Entries without any have no row."""
    up = _targets(closure, targets, "ancestor")
    return cells.join(up, cells["term"] == up["descendant"]).select("entry", F.col("ancestor").alias("term")).distinct()


def label(cells: DataFrame, closure: DataFrame, targets: list[str] | DataFrame) -> DataFrame:
    """(entry, term, value): 1 where the entry has the target or a descendant, 0 where it has only an ancestor of it.

    -1 is implied for all other pairs of an entry and a target; ``dense`` spells it out.
    """
    up = _targets(closure, targets, "ancestor").select(F.col("descendant").alias("term"), F.col("ancestor").alias("target"), F.lit(POSITIVE).alias("value"))
    down = _targets(closure.where("ancestor <> descendant"), targets, "descendant").select(F.col("ancestor").alias("term"), F.col("descendant").alias("target"), F.lit(UNKNOWN).alias("value"))
    every = cells.select("entry", "term").join(up.union(down), "term")
    return every.groupBy("entry", F.col("target").alias("term")).agg(F.max("value").alias("value"))


def dense(labels: DataFrame, entries: DataFrame, targets: list[str] | DataFrame) -> DataFrame:
    """A row for each entry and target, -1 where labels has none. Its size is entries times targets, asked for at export only.

    An entry's labels are gathered first, so the pairs that are spelled out aren't shuffled.
    """
    spark = labels.sparkSession
    every = (targets if isinstance(targets, DataFrame) else spark.createDataFrame([(t,) for t in targets], "term string")).agg(F.array_sort(F.collect_set("term")).alias("every"))
    given = labels.groupBy("entry").agg(F.map_from_entries(F.collect_list(F.struct("term", "value"))).alias("given"))
    own = entries.select("entry").distinct().join(given, "entry", "left").crossJoin(F.broadcast(every))  # one row
    return own.select("entry", "given", F.explode("every").alias("term")).select("entry", "term", F.coalesce(F.try_element_at("given", F.col("term")), F.lit(NEGATIVE)).alias("value"))


def with_controls(labels: DataFrame, cells: DataFrame, entries: DataFrame, control: str = CONTROL_ID) -> DataFrame:
    """Labels in which control entries have 2 for each target that some entry of their series is positive for.

    Control entries lose all other labels, and have no row if no target is left; their own positives count for the
    series. The series is taken literally, as one group.
    """
    controls = cells.where(F.col("term") == control).select("entry").distinct()
    groups = entries.select("entry", "series")
    positive = labels.where(F.col("value") == POSITIVE).join(groups, "entry").select("series", "term").distinct()
    marked = controls.join(groups, "entry").join(positive, "series").select("entry", "term", F.lit(CONTROL).alias("value")).distinct()
    return labels.join(controls, "entry", "left_anti").select("entry", "term", "value").union(marked)


def direct(cells: DataFrame, targets: list[str] | DataFrame) -> DataFrame:
    """Cells of the targets themselves, without propagation."""
    if isinstance(targets, DataFrame):
        return cells.join(targets.select("term").distinct(), "term", "left_semi").select("entry", "term")
    return cells.where(F.col("term").isin(*targets) if targets else F.lit(False))


def collapse(cells: DataFrame, entries: DataFrame, on: str = "series") -> DataFrame:
    """(on, term): a group has a term if any of its entries has."""
    return cells.join(entries.select("entry", on), "entry").select(on, "term").distinct()


@dataclass(frozen=True)
class Curation:
    """Cells (entry, term[, value]) with the entries they describe; every change gives a new one."""

    cells: DataFrame
    entries: DataFrame
    index: str = "entry"
    collapsed: bool = False

    @property
    def groups(self) -> list[str]:
        return [c for c in self.entries.columns if c not in (self.index, "sources")]

    @property
    def entities(self) -> DataFrame:
        return self.cells.select("term").distinct().orderBy("term")

    @property
    def ids(self) -> DataFrame:
        return self.entries

    @property
    def n_indices(self) -> int:
        return self.entries.count()

    @property
    def n_entities(self) -> int:
        return self.entities.count()

    def unique_groups(self, column: str = "series") -> DataFrame:
        return self.entries.select(column).distinct().orderBy(column)

    def filter(self, predicate: Column) -> Curation:
        """By a condition over entries; cells follow."""
        kept = self.entries.where(predicate)
        return replace(self, entries=kept, cells=self.cells.join(kept.select(self.index), self.index, "left_semi"))

    def having(self, *terms: str) -> Curation:
        """Entries that have any of the terms."""
        own = self.cells.where(F.col("term").isin(*terms)).select(self.index).distinct()
        return replace(self, entries=self.entries.join(own, self.index, "left_semi"), cells=self.cells.join(own, self.index, "left_semi"))

    def select(self, *terms: str) -> Curation:
        return replace(self, cells=self.cells.where(F.col("term").isin(*terms)))

    def drop(self, *terms: str) -> Curation:
        return replace(self, cells=self.cells.where(~F.col("term").isin(*terms)))

    def slice(self, offset: int, length: int) -> Curation:
        """Entries by place in the order of their ids."""
        kept = self.entries.orderBy(self.index).offset(offset).limit(length)
        return replace(self, entries=kept, cells=self.cells.join(kept.select(self.index), self.index, "left_semi"))

    def head(self, n: int = 5) -> DataFrame:
        return self.entries.orderBy(self.index).limit(n)

    def add_ids(self, more: DataFrame) -> Curation:
        """Further columns of entries; every entry must have exactly one row in more."""
        found = more.groupBy(self.index).agg(F.count("*").alias("_n"))
        if not self.entries.select(self.index).join(found, self.index, "left").where("coalesce(_n, 0) <> 1").isEmpty():
            raise ValueError("the new ids don't match the entries one to one")
        return replace(self, entries=self.entries.join(more, self.index))

    @staticmethod
    def of_wide(wide: DataFrame, ids: list[str], index: str = "entry", keep_zero: bool = False) -> Curation:
        """From a frame with id columns and a column for each term; cells are those that aren't 0, with ``value`` if any is
        not 1."""
        cells = unpivoted(wide.select(index, *(F.col(f"`{c}`") for c in wide.columns if c not in ids)), index, keep_zero=keep_zero)
        return Curation(cells, wide.select(*ids), index)

    def wide(self, terms: list[str] | None = None, descending: bool = False) -> DataFrame:
        """Ids and a column for each term, in the order given, else sorted."""
        terms = terms or sorted((r["term"] for r in self.entities.collect()), reverse=descending)
        value = F.first("value") if "value" in self.cells.columns else F.lit(1)
        pivot = self.cells.groupBy(self.index).pivot("term", terms).agg(value)
        return self.entries.join(pivot, self.index, "left").na.fill(0, terms)

    def collapse(self, on: str = "series") -> Curation:
        groups = self.entries.select(on, *(c for c in self.groups if c != on)).groupBy(on).agg(*(F.array_join(F.array_sort(F.collect_set(c)), "|").alias(c) for c in self.groups if c != on))
        return Curation(collapse(self.cells, self.entries, on).withColumnRenamed(on, "entry"), groups.withColumnRenamed(on, "entry"), "entry", True)

    def propagate(self, closure: DataFrame, targets: list[str] | DataFrame) -> Curation:
        cells = annotate(self.cells, closure, targets)
        return replace(self, cells=cells, entries=self.entries.join(cells.select("entry").distinct(), "entry", "left_semi"))

    def labels(self, closure: DataFrame, targets: list[str] | DataFrame, control: str = CONTROL_ID) -> Curation:
        """Labels with controls, unless the curation is collapsed. Controls that are none for any target are left out."""
        out = label(self.cells.where(F.col("term") != control), closure, targets)
        if self.collapsed:
            return replace(self, cells=out)
        out = with_controls(out, self.cells, self.entries, control)
        idle = self.cells.where(F.col("term") == control).select(self.index).distinct().join(out.select(self.index), self.index, "left_anti")
        return replace(self, cells=out, entries=self.entries.join(idle, self.index, "left_anti"))
