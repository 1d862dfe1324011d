"""Exports: wide Parquet/CSV/TSV, nested JSON, citations. The only place where frames become wide."""

from __future__ import annotations

import json
import os
import textwrap
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimgrid.operators.curate import dense
from claimgrid.operators.reshape import one_hot
from claimgrid.schema import ATTRIBUTES, CONTROL, NA, NEGATIVE, POSITIVE, SAMPLE_METADATA, SERIES_METADATA
from claimgrid.sources import bson
from claimgrid.sources.readers import SAMPLE_ACCESSIONS
from claimgrid.storage import written

FORMATS = ("parquet", "csv", "tsv", "json")


def metadata_columns(requested: str | Iterable[str], level: str, index: str) -> tuple[list[str], list[str]]:
    """Requested metadata fields in their order, the index appended if absent; and the unknown ones."""
    names = [x.strip() for x in requested.split(",")] if isinstance(requested, str) else list(requested)
    supported = SAMPLE_METADATA if level == "sample" else SERIES_METADATA
    known = [n for n in dict.fromkeys(names) if n in supported]
    return known if index in known else [*known, index], [n for n in names if n not in supported]


def described(entries: DataFrame, descriptions: DataFrame) -> DataFrame:
    """entries with ``description``; NA where there is none."""
    own = descriptions.select("entry", "description").dropDuplicates(["entry"])
    return entries.join(own, "entry", "left").withColumn("description", F.coalesce("description", F.lit(NA)))


def _ids(entries: DataFrame, metadata: list[str]) -> list[str]:
    return ["entry", *(c for c in [*metadata, "sources"] if c in entries.columns and c != "entry")]


def wide(cells: DataFrame, entries: DataFrame, terms: list[str], metadata: list[str]) -> DataFrame:
    """Metadata, sources and a 0/1 column for each term, of the entries that cells has."""
    return entries.select(*_ids(entries, metadata)).join(one_hot(cells, terms), "entry")


def gathered(labels: DataFrame, entries: DataFrame, terms: list[str], metadata: list[str]) -> DataFrame:
    """Ids and ``given`` of each entry: (place, value) of its labels, by the place of their term among ``terms``; null without
    any. What wide tables of any number of terms are cut from; of several values of a term the greatest counts."""
    value = (F.col("value") if "value" in labels.columns else F.lit(1)).cast("byte").alias("value")
    places = labels.sparkSession.createDataFrame([(t, i) for i, t in enumerate(terms)], "term string, place int")
    own = labels.select("entry", "term", value).join(F.broadcast(places), "term")  # as many rows as the table has columns
    pairs = own.groupBy("entry").agg(F.array_sort(F.collect_set(F.struct("place", "value"))).alias("p"))
    return entries.select(*_ids(entries, metadata)).join(pairs.select("entry", _once("p").alias("given")), "entry", "left")


def _row(n: Column, absent: int) -> Column:
    """An array of n values from ``given``, (place, value) by place; gaps are filled."""
    fill = lambda k: F.array_repeat(F.lit(absent).cast("byte"), k)
    before = lambda i: F.when(i == 0, F.lit(-1)).otherwise(F.get("given", i - 1)["place"])
    parts = F.transform("given", lambda x, i: F.concat(fill(x["place"] - before(i) - 1), F.array(x["value"])))
    tail = fill(n - 1 - F.element_at("given", -1)["place"])
    return F.coalesce(F.when(F.size("given") > 0, F.concat(F.flatten(parts), tail)), fill(n))


def _once(pairs: str) -> Column:
    """Of sorted (place, value) pairs the last of each place."""
    return F.filter(pairs, lambda x, i: (i == F.size(pairs) - 1) | (F.get(pairs, i + 1)["place"] != x["place"]))


def cut(rows: DataFrame, terms: list[str], absent: int) -> DataFrame:
    """A column for each term from gathered rows: the labels are laid out once as an array of all places, gaps filled, and each
    column takes its place of it."""
    row = _row(F.lit(len(terms)), absent)
    names = [c for c in rows.columns if c != "given"]
    quoted = lambda c: f"`{c.replace('`', '``')}`"  # noqa: E731  text, as thousands of columns are slow to build one by one
    return rows.select(*names, row.alias("_row")).selectExpr(*map(quoted, names), *(f"CAST(get(_row, {i}) AS INT) AS {quoted(t)}" for i, t in enumerate(terms)))


def wide_labels(labels: DataFrame, entries: DataFrame, terms: list[str], metadata: list[str]) -> DataFrame:
    """The same with label values; -1 where none is given."""
    return cut(gathered(labels, entries, terms, metadata), terms, NEGATIVE)


def json_rows(cells: DataFrame, entries: DataFrame, metadata: list[str]) -> DataFrame:
    """(term, entry, metadata), a row for each cell; with ``value`` if cells have one, without metadata if entries have none.
    Written sorted by term, a term's rows lie together however many they are; ``nested_json`` assembles one object for a
    term where that is wanted."""
    fields = [c for c in metadata if c in entries.columns and c != "entry"]
    own = [F.struct(*fields).alias("metadata")] if fields else []
    value = ["value"] if "value" in cells.columns else []
    return cells.join(entries, "entry").select("term", *value, "entry", *own)


LABELS = {POSITIVE: "positive", NEGATIVE: "negative", CONTROL: "control"}


def label_rows(labels: DataFrame, entries: DataFrame, targets: DataFrame, metadata: list[str]) -> DataFrame:
    """(term, label, entry, metadata) of positive, control and negative pairs of an entry and a target (a column ``term``).

    Negatives are what an entry has no label for: they are spelled out from its own row, without a join of all pairs.
    Controls are of disease terms only; unknown pairs are left out.
    """
    rows = json_rows(dense(labels, entries, targets), entries, metadata)
    names = F.create_map(*(F.lit(x) for kv in LABELS.items() for x in kv))
    rows = rows.withColumn("label", F.try_element_at(names, F.col("value"))).where("label is not null")
    return rows.where(f"value <> {CONTROL} or term like 'MONDO%'").select("term", "label", "entry", *(c for c in rows.columns if c == "metadata"))


def nested_json(cells: DataFrame, entries: DataFrame, metadata: list[str]) -> DataFrame:
    """(term, json): for each term an object entry -> metadata, in one row, so for terms of a bounded number of entries."""
    own = F.struct(*(F.col(c) for c in metadata if c in entries.columns and c != "entry"))
    rows = cells.join(entries, "entry").select("term", "entry", own.alias("meta"))
    return rows.groupBy("term").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("entry", "meta"))))).alias("json"))


def entry_lists(cells: DataFrame) -> DataFrame:
    """(term, json): for each term the sorted list of its entries."""
    return cells.groupBy("term").agg(F.to_json(F.array_sort(F.collect_set("entry"))).alias("json"))


def label_json(labels: DataFrame, entries: DataFrame, metadata: list[str]) -> DataFrame:
    """(term, json): positive, negative and, for disease terms, control lists of {entry: metadata}; unknowns are left out."""
    own = F.struct(*(F.col(c) for c in metadata if c in entries.columns and c != "entry"))
    rows = labels.join(entries, "entry").select("term", "value", "entry", own.alias("meta"))

    def bucket(value: int) -> Column:
        chosen = F.collect_list(F.when(F.col("value") == value, F.struct("entry", "meta")))
        return F.transform(F.array_sort(chosen), lambda x: F.create_map(x["entry"], x["meta"]))

    lists = rows.groupBy("term").agg(bucket(POSITIVE).alias("positive"), bucket(NEGATIVE).alias("negative"), bucket(CONTROL).alias("control"))
    disease = F.col("term").startswith("MONDO")
    text = F.when(disease, F.to_json(F.struct("positive", "negative", "control"))).otherwise(F.to_json(F.struct("positive", "negative")))
    return lists.select("term", text.alias("json"))


def write(df: DataFrame, path: str, fmt: str = "parquet", sort_by: str | list[str] | None = None) -> None:
    """Writes a frame, sorted by ranges and not in one task."""
    if fmt not in FORMATS:
        raise ValueError(f"format {fmt!r} is none of {', '.join(FORMATS)}")
    if sort_by:
        keys = [sort_by] if isinstance(sort_by, str) else sort_by
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    out = df.write.mode("overwrite")
    if fmt == "parquet":
        out.parquet(path)
    elif fmt == "json":
        out.json(path)
    else:
        out.csv(path, sep="," if fmt == "csv" else "\t", header=True)


def save_wide(cells: DataFrame, entries: DataFrame, terms: list[str], metadata: list[str], path: str, fmt: str = "parquet", absent: int = 0, sort_by: str | list[str] | None = None) -> None:
    """Writes the wide form as one table, however many terms it has.

    absent: what a cell that isn't there says; entries without any cell are left out where it is 0. sort_by: columns of
    entries, whether they are among the metadata or not. Rows are dealt and sorted before they become wide.
    """
    keys = [] if sort_by is None else [sort_by] if isinstance(sort_by, str) else list(sort_by)
    extra = [k for k in keys if k != "entry" and k not in metadata]
    rows = gathered(cells, entries, terms, [*metadata, *extra])
    rows = rows.where("given is not null") if absent == 0 else rows
    if keys:
        rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    write(cut(rows.drop(*extra), terms, absent), path, fmt)


BLOCK = 256


def placed(terms: DataFrame) -> DataFrame:
    """(term, place): the distinct terms' places, from 0, in their order; a range sort and a count for each partition."""
    ordered = terms.where("term is not null").select("term").distinct().repartitionByRange("term").sortWithinPartitions("term")
    rows = written(ordered.withColumn("n", F.monotonically_increasing_id()), "ordered")
    part, within = F.shiftright("n", 33), F.col("n").bitwiseAND((1 << 33) - 1)
    counts = rows.groupBy(part.alias("part")).agg(F.count("*").alias("own"))  # a row for each partition
    before = counts.select("part", (F.sum("own").over(Window.orderBy("part")) - F.col("own")).alias("before"))
    return rows.withColumn("part", part).join(F.broadcast(before), "part").select("term", (F.col("before") + within).alias("place"))


def blocks(labels: DataFrame, entries: DataFrame, places: DataFrame, absent: int, width: int = BLOCK) -> DataFrame:
    """(entry, block, first, values): the wide table cut into blocks of ``width`` columns, whose values are spelled out in the
    order of ``places`` from the column ``first`` on; all of an entry's values in other blocks are ``absent``. An entry
    without labels has one row without a block. Of several values of a term the greatest counts.

    For ontologies that grow with the entries: rows and their size follow the labels, not entries times terms.
    """
    n = places.agg(F.count("*").alias("n"))
    own = labels.join(places, "term").select("entry", F.floor(F.col("place") / width).alias("block"), (F.col("place") % width).cast("int").alias("place"), F.col("value").cast("byte").alias("value"))
    given = own.groupBy("entry", "block").agg(F.array_sort(F.collect_set(F.struct("place", "value"))).alias("p")).select("entry", "block", _once("p").alias("given"))
    columns = F.least(F.lit(width), F.col("n") - F.col("block") * width).cast("int")
    rows = given.crossJoin(F.broadcast(n)).select("entry", "block", (F.col("block") * width).alias("first"), _row(columns, absent).alias("values"))
    return entries.select("entry").distinct().join(rows, "entry", "left")


def database_rows(claims: DataFrame, entries: DataFrame, attributes: Iterable[str] = ATTRIBUTES) -> DataFrame:
    """(key, json) of an annotation database: for each entry its accessions and organism, and for each attribute a map
    source -> id, value, ecode, where several terms are joined by pipes.

    Claims and entries are dealt together, once, by ranges of entries, so the rows come by ranges of keys and only have to be
    sorted within them; the long texts aren't dealt.
    """
    accessions = [c for c in SAMPLE_ACCESSIONS if c in entries.columns]
    given = claims.select("entry", "attribute", "source", F.struct("term_id", "term_name").alias("t"), "ecode")
    either = given.unionByName(entries.select("entry", F.struct(F.struct(*accessions).alias("accession_ids"), "organism").alias("own")), allowMissingColumns=True)
    either = either.where("entry is not null").repartitionByRange("entry")
    by = either.groupBy("entry", "attribute", "source").agg(
        F.array_sort(F.collect_set("t")).alias("t"), F.min(F.struct(F.col("t.term_id").alias("term_id"), "ecode"))["ecode"].alias("ecode"), F.collect_list("own").alias("own"), F.count("t").alias("n")
    )
    joined = lambda name: F.array_join(F.transform("t", lambda x: F.coalesce(x[name], F.lit(""))), "|").alias("id" if name == "term_id" else "value")
    by = by.select("entry", "attribute", F.struct("source", F.struct(joined("term_id"), joined("term_name"), "ecode").alias("v")).alias("s"), "own", "n")
    maps = [F.map_from_entries(F.collect_list(F.when(F.col("attribute") == a, F.col("s")))).alias(a) for a in attributes]
    both = by.groupBy("entry").agg(*maps, F.flatten(F.collect_list("own")).alias("own"), F.sum("n").alias("n")).where("n > 0")
    both = both.select("entry", F.explode("own").alias("own"), *attributes)
    filled = [F.when(F.size(a) > 0, F.col(a)).alias(a) for a in attributes]
    return both.select(F.col("entry").alias("key"), F.to_json(F.struct("own.accession_ids", "own.organism", *filled)).alias("json"))


def save_bson(rows: DataFrame, path: str, file_bytes: int = 1 << 30, compression: str = "none") -> None:
    """Writes (key, json) as BSON files, sorted by key over all files and within values, in place of those that are there.
    Rows that lie by ranges of keys already aren't dealt again."""
    bson.register(rows.sparkSession)
    ordered = rows.select("key", "json").orderBy("key")
    ordered.write.format("bson").option("fileBytes", file_bytes).option("compression", compression).mode("overwrite").save(path)


#: What a citation file says about a request, in this order.
CITED = ("attribute", "terms", "level", "species", "ecode", "tech", "mode", "license")


def reference(name: str, n: int, info: dict[str, str], width: int = 80) -> str:
    """One source of a reference list, wrapped; absent fields are left out."""
    lines = [f"{name} ({n:,} annotations)"]
    for field in ("citation", "doi", "url", "rights", "notes"):
        if value := " ".join(str(info.get(field) or "").split()):
            lines += textwrap.wrap(f"{field.capitalize() if field != 'doi' else 'DOI'}: {value}", width, initial_indent="  ", subsequent_indent="    ", break_long_words=False)
    return "\n".join(lines)


def citation(counts: DataFrame, registry: dict[str, dict[str, str]], **query: str) -> str:
    """What was asked for and whom to credit, as text; counts: (source, n), one row for each source, the only rows collected.

    query: date, version and the fields of CITED; absent ones are left out.
    """
    by_lower = {k.lower(): (k, v) for k, v in registry.items()}
    parts = []
    for r in counts.orderBy(F.desc("n"), "source").collect():
        name, info = by_lower.get(r["source"].lower(), (r["source"], {}))
        parts.append(reference(name, r["n"], info))
    head = [f"claimgrid export of {query['date']}" if "date" in query else "claimgrid export"]
    head += [f"  {name}: {query[name]}" for name in ("version", *CITED) if query.get(name)]
    credit = f"These {len(parts)} sources contributed; credit each of them:" if len(parts) != 1 else "One source contributed; credit it:"
    return "\n".join([*head, "", credit if parts else "No source contributed.", "", "\n\n".join(parts)]).rstrip() + "\n"


def save_badges(badges: DataFrame, folder: str) -> list[str]:
    """A small JSON file for each source and level (source, level, message), as badge services read them; their names."""
    os.makedirs(folder, exist_ok=True)
    names = []
    for r in badges.orderBy("source", "level").collect():  # a row for each source and level
        names.append(f"{r['source']}__{r['level']}.json")
        save_json({"schemaVersion": 1, "label": r["source"], "message": r["message"], "color": "blue"}, os.path.join(folder, names[-1]))
    return names


def save_json(obj: object, path: str) -> None:
    with open(path, "w") as f:
        json.dump(obj, f, indent=2, sort_keys=True)
