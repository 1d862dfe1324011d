"""Aggregations over claims: groups, counts, overlaps and co-occurrence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimgrid.functions.scalar import join_sorted, split_multi
from claimgrid.schema import CONTROL_ID, DELIMITER


def grouped(claims: DataFrame, *by: str) -> DataFrame:
    """One row for each entry and attribute (and ``by``): its distinct term ids sorted and joined, and the evidence code
    of the first term. Claims are dealt as they are: sets of terms in the making are larger than the rows."""
    keys = ["entry", "attribute", *by]
    return claims.select(*keys, "term_id", "ecode").repartition(*keys).groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_set("term_id")), DELIMITER).alias("id"),
        F.min(F.struct("term_id", "ecode"))["ecode"].alias("ecode"),
    )


def compiled(claims: DataFrame, entries: DataFrame) -> DataFrame:
    """Long annotations: an entry's ids, names and sources, each sorted and joined, with its accessions (NA if absent)."""
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), DELIMITER)
    long = claims.groupBy("entry").agg(joined("term_id").alias("id"), joined("term_name").alias("value"), joined("source").alias("sources"))
    ids = [F.coalesce(F.col(c), F.lit("NA")).alias(c) for c in entries.columns if c not in ("entry", "organism")]
    return long.join(entries.select("entry", *ids), "entry")


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a stated order."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def first_value(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """The first non-null value of each key by a column's order."""
    chosen = F.min(F.when(F.col(value).isNotNull(), F.struct(order, value)))
    return df.groupBy(*keys).agg(chosen[value].alias(value))


def counts_from_lists(df: DataFrame, column: str = "sources") -> DataFrame:
    """How often each name occurs in a column of joined names, most frequent first."""
    names = df.select(F.explode(split_multi(column)).alias("source")).where("source <> ''")
    return names.groupBy("source").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source")


def claims_by_source(claims: DataFrame) -> DataFrame:
    """Annotations of each source: distinct (entry, attribute)."""
    return claims.select("source", "entry", "attribute").distinct().groupBy("source").agg(F.count("*").alias("n"))


def entries_by_source(claims: DataFrame) -> DataFrame:
    return claims.groupBy("source").agg(F.countDistinct("entry").alias("n"))


def overlap(claims: DataFrame) -> DataFrame:
    """Entries that two sources share, and the share of those that either has.

    An entry's few sources are paired within its own row, so the shuffle carries sets, not a self-join of claims.
    """
    sets = claims.groupBy("entry").agg(F.array_sort(F.collect_set("source")).alias("s"))
    pairs = sets.select(F.explode("s").alias("a"), "s").select("a", F.explode("s").alias("b"))
    both = pairs.groupBy("a", "b").agg(F.count("*").alias("shared"))
    own = both.where("a = b").select(F.col("a").alias("x"), F.col("shared").alias("n"))
    out = both.where("a <> b").join(own, F.col("a") == F.col("x")).select("a", "b", "shared", F.col("n").alias("n_a"))
    out = out.join(own, F.col("b") == F.col("x")).withColumnRenamed("n", "n_b")
    return out.select("a", "b", "shared", (F.col("shared") / (F.col("n_a") + F.col("n_b") - F.col("shared"))).alias("share"))


def cooccurrence(pairs: DataFrame) -> DataFrame:
    """Pointwise mutual information of a symmetric co-occurrence table (a, b, n) without its diagonal: pmi, ppmi, npmi."""
    pairs = pairs.where("a <> b and n > 0")
    total = pairs.agg(F.sum("n").alias("total"))
    left = pairs.groupBy("a").agg(F.sum("n").alias("n_a"))
    right = pairs.groupBy("b").agg(F.sum("n").alias("n_b"))
    out = pairs.join(left, "a").join(right, "b").join(F.broadcast(total))  # a single row
    p = F.col("n") / F.col("total")
    pmi = F.log2(p / (F.col("n_a") / F.col("total") * (F.col("n_b") / F.col("total"))))
    return out.select("a", "b", "n", pmi.alias("pmi"), F.greatest(pmi, F.lit(0.0)).alias("ppmi"), F.when(p < 1, pmi / -F.log2(p)).alias("npmi"))


def attribute_sets(claims: DataFrame) -> DataFrame:
    """How many entries have exactly which attributes."""
    sets = claims.groupBy("entry").agg(F.array_join(F.array_sort(F.collect_set("attribute")), DELIMITER).alias("attributes"))
    return sets.groupBy("attributes").agg(F.count("*").alias("n"))


def series_samples(entries: DataFrame) -> DataFrame:
    """Samples of each series; a sample of several series counts in each."""
    each = entries.select("entry", F.explode(split_multi("series")).alias("series")).where("series <> '' and series <> 'NA'")
    return each.groupBy("series").agg(F.array_join(F.array_sort(F.collect_set("entry")), DELIMITER).alias("samples"), F.countDistinct("entry").alias("n"))


def study_rollup(claims: DataFrame, entries: DataFrame, control: str = CONTROL_ID) -> DataFrame:
    """Claims of series: the union over a series' samples, by attribute and source, without pure controls."""
    series = entries.select("entry", F.explode(split_multi("series")).alias("series")).where("series <> '' and series <> 'NA'")
    own = claims.where(F.col("term_id") != control).join(series, "entry")
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), DELIMITER).alias(c)
    return own.groupBy("series", "attribute", "source").agg(joined("term_id"), joined("ecode"))


def series_claims(claims: DataFrame, entries: DataFrame, control: str = CONTROL_ID) -> DataFrame:
    """Claims of series, one for each term, without pure controls: a curated evidence code counts before a crowd's."""
    series = entries.select("entry", F.explode(split_multi("series")).alias("series")).where("series <> '' and series <> 'NA'")
    own = claims.where(F.col("term_id") != control).join(series, "entry")
    rolled = own.groupBy(F.col("series").alias("entry"), "attribute", "source", "term_id").agg(F.min("term_name").alias("term_name"), F.max("ecode").alias("ecode"))
    return rolled.select("entry", "attribute", "source", "term_id", "term_name", "ecode")


def series_entries(entries: DataFrame) -> DataFrame:
    """Accessions of series: platforms, organisms and projects of all its samples, sorted and joined."""
    each = entries.withColumn("series", F.explode(split_multi("series"))).where("series <> '' and series <> 'NA'")
    columns = [c for c in ("platform", "srp", "organism") if c in entries.columns]
    return each.groupBy("series").agg(*(join_sorted(F.flatten(F.collect_set(split_multi(c)))).alias(c) for c in columns))


def unique_terms(*cells: DataFrame) -> DataFrame:
    """Terms that some result has."""
    out = cells[0].select("term")
    for c in cells[1:]:
        out = out.union(c.select("term"))
    return out.distinct()
