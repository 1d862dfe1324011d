"""Queries that run readers, sources, the ontology parser, curations and exports on raw forms of the driver's tables.

Parts stand for raw records of every source: a part's size n names the term UBERON:n or MONDO:n, of which those up to 30 lie
within the systems and those up to 40 have a name.
"""

from __future__ import annotations

import os
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgrid import packages, sinks
from claimgrid.functions import scalar as S
from claimgrid.operators import aggregate, curate, filters, integrate, metadata, ontology, reshape, search
from claimgrid.plans import build, driver
from claimgrid.plans.catalog import query, table
from claimgrid.plans.retrieval import Database, Request, retrieve
from claimgrid.schema import AGE_GROUPS, CONTROL_ID
from claimgrid.sources import ingest, processors, readers, registry
from claimgrid.storage import shared_path, written

KNOWN, NAMED = 30, 40


def text(*parts: str | Column) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p_partkey and p_size as k and n."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.col("p_size").cast("long").alias("n"), "p_name", "p_type", "p_brand")


def K() -> Column:  # noqa: N802
    return F.col("k")


def N() -> Column:  # noqa: N802
    return F.col("n")


_PARTS_SQL = "r AS (SELECT p_partkey AS k, p_size AS n, p_name, p_type, p_brand FROM part)"


def context(spark: SparkSession) -> registry.Context:
    n = spark.range(1, NAMED + 1).select(F.col("id").alias("n"))
    inside = lambda prefix: n.where(N() <= KNOWN).select(text(prefix, N()).alias("term"))
    names = n.select(text("UBERON:", N()).alias("id"), text("tissue ", N()).alias("name")).union(n.select(text("MONDO:", N()), text("disease ", N())))
    foreign = {p: n.select(text(q, N()).alias("xref"), text("MONDO:", N()).alias("id")) for p, q in (("DOID", "DOID:"), ("MESH", "MESH:D"), ("UMLS", "UMLS:C"))}
    return registry.Context(inside("UBERON:"), inside("MONDO:"), names, foreign)


def crosswalk(spark: SparkSession, key: str, *columns: tuple[str, str]) -> DataFrame:
    """A map from key + n to other prefixes + n, for the named n."""
    return spark.range(1, NAMED + 1).select(text(key, F.col("id")).alias("key"), *(text(p, F.col("id")).alias(c) for c, p in columns))


def _age_case(years: str) -> str:
    return "CASE " + " ".join(f"WHEN {years} BETWEEN {a} AND {b} THEN '{g}'" for g, a, b in AGE_GROUPS) + " END"


def _claim(accession: str, attribute: str, term: str, name: str, where: str = "true", ecode: str = "expert-curated", source: str = "r") -> str:
    return f"SELECT {accession} AS accession, '{attribute}' AS attribute, {term} AS term_id, {name} AS term_name, '{ecode}' AS ecode FROM {source} WHERE {where}"


def _claims_sql(*selects: str, distinct: bool = False) -> str:
    union = " UNION ALL ".join(selects)
    return f"WITH {_PARTS_SQL} " + (f"SELECT DISTINCT * FROM ({union})" if distinct else union)


def _sexes(accession: str, sex: str, where: str = "true") -> str:
    return _claim(accession, "sex", f"CASE WHEN {sex} IN ('m', 'male') THEN 'M' ELSE 'F' END", f"CASE WHEN {sex} IN ('m', 'male') THEN 'male' ELSE 'female' END", f"{sex} IN ('m', 'male', 'f', 'female') AND {where}")


_GSM = "'GSM' || k"
_TISSUE = ("'UBERON:' || n", "'tissue ' || n")
_DISEASE = ("'MONDO:' || n", "'disease ' || n")


# ---- sources ----


@query("source_ale", _claims_sql(_claim(_GSM, "tissue", *_TISSUE, f"n <= {KNOWN}"), _sexes(_GSM, "['f', 'm', 'x'][k % 3 + 1]", f"n <= {NAMED}"), _claim(_GSM, "age", _age_case("n"), _age_case("n"), f"n <= {NAMED}")))
def source_ale(spark, sf_dir):
    raw = parts(spark, sf_dir).select(text("GSM", K()).alias("accession"), text("BTO:", N()).alias("brenda"), text(N() * 12).alias("age_months"), F.get(F.array(F.lit("F"), F.lit("M"), F.lit("x")), (K() % 3).cast("int")).alias("gender"))
    return registry.process("ALE", context(spark), raw=raw.union(raw), tissues=crosswalk(spark, "BTO:", ("uberon", "UBERON:"), ("uberon_name", "tissue ")).withColumnRenamed("key", "brenda"))


@query("source_bgee", _claims_sql(*(s for a in ("'SRR' || k", "'SRX' || k") for s in (_claim(a, "tissue", "'UBERON:' || n", "p_name", f"n <= {KNOWN}"), _sexes(a, "['male', 'female', 'mixed'][k % 3 + 1]"), _claim(a, "developmental_stage", "'S:' || n", "'stage'", "k % 2 = 0")))))
def source_bgee(spark, sf_dir):
    raw = parts(spark, sf_dir).select(
        text("SRR", K(), "|SRX", K()).alias("Run IDs"), text("UBERON:", N()).alias("Expression mapped anatomical entity ID"), F.col("p_name").alias("Expression mapped anatomical entity name"),
        F.when(K() % 2 == 0, text("S:", N())).alias("Expression mapped stage ID"), F.when(K() % 2 == 0, "stage").alias("Expression mapped stage name"),
        F.get(F.array(F.lit("male"), F.lit("female"), F.lit("mixed")), (K() % 3).cast("int")).alias("Expression mapped sex"),
    )
    return registry.process("BGee", context(spark), raw=raw)


@query("source_cello", _claims_sql(_claim(_GSM, "tissue", *_TISSUE, f"n <= {KNOWN}"), _claim(_GSM, "tissue", "'UBERON:' || (n + 20)", "'tissue ' || (n + 20)", f"n + 20 <= {KNOWN}")))
def source_cello(spark, sf_dir):
    raw = parts(spark, sf_dir).select(text("GSM", K()).alias("key"), F.array(text("UBERON:", N()), text("UBERON:", N() + 20)).alias("value"))
    return registry.process("Cello", context(spark), raw=raw)


_CREEDS = f"k % 3 <> 0 AND k % 5 <> 0 AND n <= {KNOWN}"


@query("source_creeds", _claims_sql(_claim(_GSM, "disease", "'MONDO:' || n", "CASE WHEN k % 2 = 0 THEN p_name ELSE 'unknown' END", _CREEDS, "crowd-sourced"), *(_claim(f"'GSM{i}' || k", "disease", f"'{CONTROL_ID}'", "'control'", _CREEDS, "crowd-sourced") for i in (8, 9))))
def source_creeds(spark, sf_dir):
    raw = parts(spark, sf_dir).select(
        F.when(K() % 3 != 0, "human").otherwise("mouse").alias("organism"), F.when(K() % 5 != 0, text("DOID:", N())).otherwise("umls").alias("do_id"), F.when(K() % 2 == 0, F.col("p_name")).alias("disease_name"),
        F.array(text("GSM", K())).alias("pert_ids"), F.array(text("GSM8", K()), text("GSM9", K())).alias("ctrl_ids"),
    )
    return registry.process("CREEDS", context(spark), raw=raw)


@query("source_disign_atlas", _claims_sql(
    _claim(_GSM, "disease", "'MONDO:' || n", "lower(p_type)", f"k % 4 <> 0 AND n <= {KNOWN}"), _claim("'GSMC' || k", "disease", f"'{CONTROL_ID}'", "'control'", "k % 4 <> 0"),
    _claim(_GSM, "tissue", "CASE WHEN k % 10 = 1 THEN 'CL:1' WHEN n % 2 = 0 THEN 'UBERON:' || n ELSE 'na' END", "CASE WHEN k % 10 = 1 THEN 'cell' WHEN n % 2 = 0 THEN 'tissue ' || n ELSE lower(p_name) END", f"k % 4 <> 0 AND n <= {KNOWN} AND n % 5 <> 0"),
    _claim("'GSMC' || k", "tissue", "CASE WHEN n % 2 = 0 THEN 'UBERON:' || n ELSE 'na' END", "CASE WHEN n % 2 = 0 THEN 'tissue ' || n ELSE lower(p_name) END", "k % 4 <> 0 AND n % 5 <> 0"),
))
def source_disign_atlas(spark, sf_dir):
    """Of the lines, every fourth has a field too few."""
    tissue = F.when(N() % 5 == 0, F.lit("None")).when(N() % 2 == 0, text("Tissue ", N())).otherwise(F.col("p_name"))
    line = F.concat_ws("|", F.lit("GSE1"), text("GSMC", K(), ";X1"), text("GSM", K()), F.lit("GPL1"), F.lit("x"), F.col("p_type"), text("C", N()), tissue, F.lit("d"), F.lit("s"), F.when(K() % 4 != 0, "human"))
    raw = parts(spark, sf_dir).select(text("sig", K()).alias("name"), line.alias("description"))
    corrections = parts(spark, sf_dir).where(K() % 10 == 1).select(text("GSM", K()).alias("sample"), F.lit("CL:1").alias("term"), F.lit("cell").alias("name"))
    tissues = crosswalk(spark, "tissue ", ("id", "UBERON:")).withColumnRenamed("key", "name").unionByName(spark.range(NAMED + 1, 51).select(text("tissue ", F.col("id")).alias("name"), text("UBERON:", F.col("id")).alias("id")))
    return registry.process("DiSignAtlas", context(spark), raw=raw, tissues=tissues, corrections=corrections)


@query("source_gemma", _claims_sql(
    _claim("'GSE' || k", "tissue", "'UBERON:' || n", "lower(p_name)", f"n <= {KNOWN}"), _claim("'GSE' || k", "disease", "'MONDO:' || n", "lower(p_type)", f"n <= {KNOWN}"),
    _claim("'GSE' || k", "sex", "CASE WHEN k % 2 = 0 THEN 'M' ELSE 'F' END", "'sex'"), _claim("'GSE' || k", "age", "'adult'", "'grown'", "n <= 10"), distinct=True,
))
def source_gemma(spark, sf_dir):
    """Batches in a JSON map, as one file; studies without an accession and categories of no use are left out."""
    one = lambda category, uri, value: F.struct(F.lit(category).alias("category"), uri.alias("valueUri"), value.alias("value"))
    uri = lambda prefix: text(f"http://purl/{prefix}_", N())
    each = F.array(
        one("organism part", uri("UBERON"), F.col("p_name")), one("cell type", uri("UBERON"), F.col("p_name")), one("disease", uri("MONDO"), F.col("p_type")), one("genotype", uri("X"), F.lit("x")),
        one("biological sex", F.when(K() % 2 == 0, F.lit("http://purl/PATO_0000384")).otherwise("http://purl/PATO_0000383"), F.lit("Sex")), one("developmental stage", uri("STAGE"), F.lit("Grown")), one("disease", F.lit(""), F.lit("y")),
    )
    raw = parts(spark, sf_dir).select(text("GSE", K()).alias("accession"), each.alias("characteristics"))
    stages = spark.range(1, 21).select(text("STAGE:", F.col("id")).alias("term_id"), F.when(F.col("id") <= 10, "adult").otherwise("na").alias("age_group"))
    return registry.process("Gemma", context(spark), raw=raw.union(raw.withColumn("accession", F.lit("E-1"))), stages=stages)


@query("source_golightly", _claims_sql(_claim(_GSM, "tissue", "'UBERON:7'", "'lung'", "k % 3 = 0"), _sexes(_GSM, "['male', 'female'][k % 2 + 1]", "k % 3 < 2"), _claim(_GSM, "age", _age_case("(CASE WHEN k % 2 = 0 THEN n + 1 ELSE n END)"), _age_case("(CASE WHEN k % 2 = 0 THEN n + 1 ELSE n END)"), "k % 3 = 0")))
def source_golightly(spark, sf_dir):
    """Rows of three files: one within the systems, one outside, one that isn't listed."""
    age = F.when(K() % 2 == 0, text(N(), "-", N() + 2)).otherwise(text(N()))
    row = F.map_from_arrays(F.array(F.lit("SampleID"), F.lit("Age"), F.lit("Sex")), F.array(text("GSM", K()), age, F.when(K() % 2 == 0, "Male").otherwise("Female")))
    members = parts(spark, sf_dir).select(text("f", K() % 3).alias("file"), row.alias("row"))
    files = spark.createDataFrame([("f0", "UBERON:7", "lung", "Age", "Sex"), ("f1", "UBERON:99", "moon", "", "Sex")], "file string, tissue string, tissue_name string, age_column string, sex_column string")
    return registry.process("Golightly_2018", context(spark), raw=processors.golightly_rows(members, files))


@query("source_gu", _claims_sql(_claim(_GSM, "disease", "'MONDO:' || n", "'ill ' || n", f"n <= {KNOWN}"), _claim(_GSM, "tissue", "'UBERON:' || n", "'part ' || n", f"n <= {KNOWN}")))
def source_gu(spark, sf_dir):
    raw = parts(spark, sf_dir).select(text("GSM", K()).alias("Sample ID"), text("part ", N()).alias("Manual annotation"), text("ill ", N()).alias("Sample info #manual annotation"))
    diseases = crosswalk(spark, "ill ", ("mondo_id", "MONDO:")).withColumnRenamed("key", "disease_name")
    return registry.process("Gu_2023", context(spark), raw=raw, diseases=diseases, tissues=crosswalk(spark, "part ", ("uberon_id", "UBERON:")).withColumnRenamed("key", "tissue_name"))


_AGED = "CASE WHEN k % 4 = 0 THEN 'elderly_adult' ELSE 'adult' END"


@query("source_johnson_microarray", _claims_sql(_claim(_GSM, "disease", *_DISEASE, f"n <= {KNOWN}"), _claim(_GSM, "disease", "'MONDO:' || (n + 1)", "'disease ' || (n + 1)", f"n + 1 <= {KNOWN}"), _claim(_GSM, "tissue", *_TISSUE, f"n <= {KNOWN}"), _sexes(_GSM, "['f', 'm', 'na'][k % 3 + 1]"), _claim(_GSM, "age", _AGED, _AGED, "k % 5 <> 0")))
def source_johnson_microarray(spark, sf_dir):
    raw = parts(spark, sf_dir).select(text("GSM", K()).alias("gsm"), text("D", N(), ":a|D", N() + 1, ":b").alias("disease"), text("D", N(), ":x").alias("tissue"), F.get(F.array(F.lit("F"), F.lit("M"), F.lit("na")), (K() % 3).cast("int")).alias("sex"), F.when(K() % 5 == 0, "na").when(K() % 4 == 0, "elderly").otherwise("adult").alias("age_group"))
    diseases = crosswalk(spark, "D", ("mondo_id", "MONDO:"), ("mondo_name", "disease ")).withColumnRenamed("key", "mesh_id")
    return registry.process("Johnson_2023_microarray", context(spark), raw=raw, diseases=diseases, tissues=crosswalk(spark, "D", ("uber_id", "UBERON:")).withColumnRenamed("key", "mesh_id"))


@query("source_johnson_rnaseq", _claims_sql(_claim("'SRR' || k", "disease", "CASE WHEN k % 7 = 0 THEN 'MONDO:000000' ELSE 'MONDO:' || n END", "CASE WHEN k % 7 = 0 THEN 'control' ELSE 'disease ' || n END", f"k % 7 = 0 OR n <= {KNOWN}"), _claim("'SRR' || k", "tissue", *_TISSUE, f"n <= {KNOWN}"), _sexes("'SRR' || k", "['female', 'male', 'na'][k % 3 + 1]"), _claim("'SRR' || k", "age", _AGED, _AGED, "k % 5 <> 0")))
def source_johnson_rnaseq(spark, sf_dir):
    raw = parts(spark, sf_dir).select(text("SRR", K()).alias("run"), F.when(K() % 7 == 0, F.lit("normal")).otherwise(text("ill ", N())).alias("disease"), text("part ", N()).alias("tissue"), F.get(F.array(F.lit("female"), F.lit("male"), F.lit("na")), (K() % 3).cast("int")).alias("sex"), F.when(K() % 5 == 0, "na").when(K() % 4 == 0, "elderly").otherwise("adult").alias("age_group"))
    diseases = crosswalk(spark, "ill ", ("mondo_id", "MONDO:"), ("mondo_name", "disease ")).withColumnRenamed("key", "original_label")
    diseases = diseases.union(spark.createDataFrame([("normal", "MONDO:000000", "control")], diseases.schema))
    return registry.process("Johnson_2023_rnaseq", context(spark), raw=raw, diseases=diseases, tissues=crosswalk(spark, "part ", ("uber_id", "UBERON:")).withColumnRenamed("key", "original_label"))


@query("source_curated_gsm", _claims_sql(_claim(_GSM, "tissue", "'UBERON:' || n", "p_name", f"k % 2 = 0 AND n <= {KNOWN}"), _claim(_GSM, "disease", *_DISEASE, f"k % 2 = 1 AND n <= {KNOWN}")))
def source_curated_gsm(spark, sf_dir):
    raw = parts(spark, sf_dir).select(text("GSM", K()).alias("GSM"), F.when(K() % 2 == 0, text("UBERON:", N())).otherwise(text("DOID:", N())).alias("ID"), F.col("p_name").alias("ID_name"), F.when(K() % 2 == 0, "tissue").otherwise("disease").alias("task"))
    return registry.process("Curated_GSM", context(spark), raw=raw)


@query("source_sirota", _claims_sql(_claim("'GSM1' || k", "disease", *_DISEASE, f"n <= {KNOWN}"), _claim("'GSM2' || k", "disease", f"'{CONTROL_ID}'", "'control'"), *(_claim(f"'GSM{i}' || k", "tissue", *_TISSUE, f"n <= {KNOWN}") for i in (1, 2)), distinct=True))
def source_sirota(spark, sf_dir):
    raw = parts(spark, sf_dir).select(text("C", N()).alias("DISEASE CUI"), text("T", N()).alias("TISSUE CUI"), text("2", K()).alias("CONTROL GSM"), text("1", K(), ", 1", K(), ",").alias("DISEASE GSM"))
    diseases = crosswalk(spark, "C", ("mapped_mondo_id", "MONDO:"), ("mondo_name", "disease ")).withColumnRenamed("key", "CUI")
    return registry.process("Sirota_2011", context(spark), raw=raw, diseases=diseases, tissues=crosswalk(spark, "T", ("mapped_uber_id", "UBERON:"), ("uberon_name", "tissue ")).withColumnRenamed("key", "TISSUE_CUI"))


@query("source_ursa", _claims_sql(_claim(_GSM, "tissue", *_TISSUE, f"n <= {KNOWN}")))
def source_ursa(spark, sf_dir):
    """Read from CSV without a header."""
    path = shared_path(spark, "ursa")
    parts(spark, sf_dir).select(text("GSM", K()), text("GSE", K()), text("UBERON:", N())).toDF("a", "b", "c").write.csv(path)
    return registry.process("URSA", context(spark), raw=readers.delimited(spark, path, names=["accession", "study_id", "term_id"]))


_URSA_TERM = "CASE WHEN n <= 20 THEN 'UBERON:' || n ELSE 'UBERON:3' END"


@query("source_ursa_hd", _claims_sql(
    _claim(_GSM, "disease", f"CASE WHEN k % 7 = 0 THEN '{CONTROL_ID}' ELSE 'MONDO:' || n END", "CASE WHEN k % 7 = 0 THEN 'control' ELSE 'disease ' || n END", f"k % 7 = 0 OR n <= {KNOWN}"),
    _claim(_GSM, "tissue", _URSA_TERM, "CASE WHEN n <= 20 THEN 'tissue ' || n ELSE 'the lung' END", "n <= 20 OR k % 2 = 0"), _claim(_GSM, "age", _age_case("n"), _age_case("n")), _claim(_GSM, "sex", "CASE WHEN k % 3 = 0 THEN 'M' ELSE 'F' END", "CASE WHEN k % 3 = 0 THEN 'M' ELSE 'F' END"),
))
def source_ursa_hd(spark, sf_dir):
    series = F.when(N() <= 20, text("GSE", N())).when(K() % 2 == 0, F.lit("GSE3526")).otherwise("GSE9999")
    sex = F.when(K() % 3 == 0, F.lit("|gender: male")).otherwise("|normal ovary")
    raw = parts(spark, sf_dir).select(text("GSM", K()).alias("GSMID"), F.when(K() % 7 == 0, F.lit("D000000")).otherwise(text("D", N())).alias("UID"), text("GSE0|", series).alias("GSEID"), text("x|the lung|age: ", N(), " years", sex).alias("GEO Sample Description"))
    of_series = crosswalk(spark, "GSE", ("UBERON_ID", "UBERON:"), ("tissue_name", "tissue ")).withColumnRenamed("key", "GSE").where("cast(substring(GSE, 4) as int) <= 20")
    return registry.process("URSA_HD", context(spark), raw=raw, series_tissues=of_series, raw_tissues=spark.createDataFrame([("the lung", "the lung", "UBERON:3")], "raw_tissue string, tissue_uberon string, uberon_id string"))


# ---- the ontology parser ----


def stanzas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as stanzas of an OBO file; every eleventh is obsolete, and every fifth is followed by a second one of its id."""
    lines = F.concat_ws(
        "\n", F.lit("[Term]"), text("id: UBERON:", K()), text("name: ", F.col("p_name")), text("xref: DOID:", K() * 2), text("xref: DOID:", K()), text("xref: MESH:D", N()), text("is_a: UBERON:", F.expr("k div 10"), " ! above"),
        F.when(N() % 2 == 0, text("relationship: part_of CL:", N())), text("relationship: develops_from UBERON:", N()), text("is_a: OTHER:", N()), F.when(K() % 11 == 0, "is_obsolete: true"),
    )
    again = F.when(K() % 5 == 0, text("\n\n[Term]\nid: UBERON:", K(), "\nname: Again\n\n[Typedef]\nid: part_of"))
    path = shared_path(spark, "obo")
    ordered = parts(spark, sf_dir).repartitionByRange("k").sortWithinPartitions("k")
    ordered.select(F.concat(lines, F.coalesce(again, F.lit("")))).write.option("lineSep", "\n\n").text(path)
    return ontology.stanzas(spark, path)


@query("obo_names", f"WITH {_PARTS_SQL} SELECT 'UBERON:' || k AS id, CASE WHEN k % 11 = 0 THEN 'again' ELSE lower(p_name) END AS name FROM r WHERE k % 11 <> 0 OR k % 5 = 0")
def obo_names(spark, sf_dir):
    return ontology.term_names(stanzas(spark, sf_dir))


@query("obo_xrefs", f"WITH {_PARTS_SQL} SELECT 'UBERON:' || k AS id, 'DOID:' || (k * 2) AS xref FROM r WHERE k % 11 <> 0")
def obo_xrefs(spark, sf_dir):
    return ontology.xrefs(stanzas(spark, sf_dir), "DOID")


@query("obo_xrefs_reversed", f"WITH {_PARTS_SQL} SELECT 'MESH:D' || n AS xref, arg_max('UBERON:' || k, k) AS id FROM r WHERE k % 11 <> 0 GROUP BY n")
def obo_xrefs_reversed(spark, sf_dir):
    """Ids in the order of numbers, so that the last isn't the greatest as text."""
    return ontology.reverse_xrefs(ontology.placed_xrefs(stanzas(spark, sf_dir), "MESH"))


@query("obo_edges", f"WITH {_PARTS_SQL} SELECT 'UBERON:' || (k // 10) AS parent, 'UBERON:' || k AS child FROM r WHERE k % 11 <> 0 AND k <> 5 UNION ALL SELECT 'CL:' || n, 'UBERON:' || k FROM r WHERE k % 11 <> 0 AND n % 2 = 0")
def obo_edges(spark, sf_dir):
    return ontology.edges(stanzas(spark, sf_dir), without=(("UBERON:0", "UBERON:5"),))


@query("closure_of_matrix", "SELECT r_name AS ancestor, n_name AS descendant FROM nation JOIN region ON n_regionkey = r_regionkey")
def closure_of_matrix(spark, sf_dir):
    both = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    wide = both.groupBy(F.col("r_name").alias("ancestor")).pivot("n_name").agg(F.lit(1)).na.fill(0)
    return ontology.closure_from_matrix(wide)


# ---- readers ----


@query("read_csv", "SELECT c_custkey::VARCHAR AS id, c_name AS name, CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN c_mktsegment END AS segment FROM customer")
def read_csv(spark, sf_dir):
    path = shared_path(spark, "csv")
    own = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.lit('a "b", c').alias("other"))
    own.write.csv(path, sep="\t", header=True, escape='"')
    return readers.delimited(spark, path, ["id", "name", "segment"], "\t", ("BUILDING", "MACHINERY"))


@query("read_gmt", "SELECT p_partkey::VARCHAR AS name, p_name AS description FROM part WHERE p_partkey % 4 <> 0")
def read_gmt(spark, sf_dir):
    path = shared_path(spark, "gmt")
    table(spark, sf_dir, "part").select(F.concat_ws("\t", F.col("p_partkey").cast("string"), F.when(F.col("p_partkey") % 4 != 0, F.col("p_name")), F.when(F.col("p_partkey") % 4 != 0, F.lit("GENE")))).write.text(path)
    return readers.gmt(spark, path)


@query("read_id_list", "SELECT DISTINCT o_custkey::VARCHAR AS id FROM orders")
def read_id_list(spark, sf_dir):
    path = shared_path(spark, "ids")
    table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 3 == 0, text(" ", F.col("o_custkey"), " ")).otherwise(text(F.col("o_custkey")))).write.text(path)
    return readers.id_list(spark, path)


def _one_file_each(rows: DataFrame, path: str) -> None:
    """Each row of text as a file of its own."""
    rows.write.option("maxRecordsPerFile", 1).text(path)


@query("read_json_map", "SELECT o_custkey::VARCHAR AS key, o_orderkey::VARCHAR AS term FROM orders")
def read_json_map(spark, sf_dir):
    """JSON objects of lists, a file for every 200 customers."""
    path = shared_path(spark, "map")
    lists = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(text(F.col("o_orderkey"))).alias("v"))
    of = F.map_from_entries(F.collect_list(F.struct(text(F.col("o_custkey")), "v")))
    _one_file_each(lists.groupBy(F.floor(F.col("o_custkey") / 200)).agg(F.to_json(of).alias("value")).select("value"), path)
    return readers.json_map(spark, path, "array<string>").select("key", F.explode("value").alias("term"))


@query("read_json_array", "SELECT c_custkey, c_name FROM customer")
def read_json_array(spark, sf_dir):
    """JSON arrays of objects, a file for every 200 customers."""
    path = shared_path(spark, "array")
    arrays = table(spark, sf_dir, "customer").groupBy(F.floor(F.col("c_custkey") / 200)).agg(F.to_json(F.collect_list(F.struct("c_custkey", "c_name"))).alias("value"))
    _one_file_each(arrays.select("value"), path)
    return readers.json_array(spark, path, "c_custkey long, c_name string")


@query("read_batches", "SELECT 'GSE' || c_custkey AS accession, c_name AS value FROM customer")
def read_batches(spark, sf_dir):
    """JSON maps of batches, each a list of studies, a file for every 300 customers."""
    path = shared_path(spark, "batches")
    one = F.struct(text("GSE", F.col("c_custkey")).alias("accession"), F.array(F.struct(F.lit("c").alias("category"), F.lit("u").alias("valueUri"), F.col("c_name").alias("value"))).alias("characteristics"))
    lists = table(spark, sf_dir, "customer").groupBy(F.floor(F.col("c_custkey") / 300).alias("n"), (F.col("c_custkey") % 3).cast("string").alias("b")).agg(F.collect_list(one).alias("v"))
    _one_file_each(lists.groupBy("n").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("b", "v")))).alias("value")).select("value"), path)
    return readers.batches(spark, path).select("accession", F.explode("characteristics").alias("c")).select("accession", "c.value")


@query("package_states", "SELECT DISTINCT 'bucket=' || o_orderkey % 20 AS folder, unnest(CASE WHEN o_orderkey % 20 = 3 THEN ['missing', 'new'] ELSE ['same'] END) AS state FROM orders")
def package_states(spark, sf_dir):
    """The orders as a package of text files, one folder of which is written again after it was packed."""
    path = shared_path(spark, "package")
    own = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 20).alias("bucket"), text(F.col("o_orderkey"), "|", F.col("o_custkey")).alias("line"))
    own.write.partitionBy("bucket").text(path)
    packages.package(spark, path)
    own.where("bucket = 3").select("line").write.mode("overwrite").text(f"{path}/bucket=3")
    return packages.states(spark, path).select(F.substring_index("name", "/", 1).alias("folder"), "state").distinct()


@query("read_zip", "SELECT 'nation' || c_nationkey || '.txt' AS file, 'GSM' || c_custkey AS sample, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segment FROM customer")
def read_zip(spark, sf_dir):
    """Archives with a file for each nation, written by the tasks that have its rows."""
    path = shared_path(spark, "archives")
    own = table(spark, sf_dir, "customer").select(text("nation", F.col("c_nationkey"), ".txt").alias("file"), text("GSM", F.col("c_custkey"), "\t", F.when(F.col("c_mktsegment") == "BUILDING", "NA").otherwise(F.col("c_mktsegment"))).alias("line"))
    _write_archives(own.repartition(4, "file").sortWithinPartitions("file"), path, "SampleID\tsegment")
    row = lambda name: F.try_element_at("row", F.lit(name))
    return readers.zipped_tables(spark, path).select("file", row("SampleID").alias("sample"), row("segment").alias("segment"))


def _write_archives(lines: DataFrame, path: str, header: str) -> None:
    """A ZIP archive for each partition of (file, line), whose files lie together; on a mounted file system."""
    folder = readers.mounted_path(path)

    def write(parts):
        import os
        import uuid
        import zipfile

        os.makedirs(folder, exist_ok=True)
        new, name, member = os.path.join(folder, f"{uuid.uuid4().hex}.new"), None, None
        with zipfile.ZipFile(new, "w", zipfile.ZIP_DEFLATED) as archive:
            for file, line in ((f, x) for part in parts for f, x in zip(part["file"], part["line"], strict=True)):
                if file != name:
                    if member:
                        member.close()
                    name, member = file, archive.open(file, "w", force_zip64=True)
                    member.write(f"{header}\n".encode())
                member.write(f"{line}\n".encode())
            if member:
                member.close()
        yield pd.DataFrame({"path": [new]})

    for r in lines.mapInPandas(write, "path string").collect():  # an archive for each partition; those of lost attempts stay .new
        os.replace(r["path"], r["path"].removesuffix("new") + "zip")


_INGEST_SQL = f"""WITH {_PARTS_SQL},
 ursa AS (SELECT 'URSA' AS source, CASE WHEN k % 7 = 0 THEN 'number of fields' WHEN k % 11 = 0 THEN 'no accession' END AS reason, CASE WHEN k % 7 = 0 THEN 'GSM' || k || ',GSE1' ELSE '{{"study_id":"GSE1","term_id":"UBERON:' || n || '"}}' END AS record FROM r),
 gu AS (SELECT 'Gu_2023' AS source, CASE WHEN k % 5 = 0 THEN 'number of fields' WHEN k % 13 = 0 THEN 'no Sample ID' END AS reason, CASE WHEN k % 5 = 0 THEN 'GSM' || k || ',"' || p_name || ', x",y,z' ELSE '{{"Manual annotation":"' || p_name || ', x"}}' END AS record FROM r),
 atlas AS (SELECT 'DiSignAtlas' AS source, CASE WHEN k % 3 = 0 THEN 'number of fields' END AS reason, p_name AS record FROM r)
 SELECT source, 'raw' AS frame, reason, record FROM (FROM ursa UNION ALL FROM gu UNION ALL FROM atlas) WHERE reason IS NOT NULL"""


def _raw_files(spark, sf_dir) -> dict[str, dict[str, str]]:
    """Files of three sources, some lines of which can't be read; those of Gu_2023 have a title line."""
    top = shared_path(spark, "raw")
    own = parts(spark, sf_dir)
    own.select(F.when(K() % 7 == 0, text("GSM", K(), ",GSE1")).otherwise(text(F.when(K() % 11 == 0, "").otherwise(text("GSM", K())), ",GSE1,UBERON:", N()))).write.text(f"{top}/ursa")
    line = F.when(K() % 5 == 0, text("GSM", K(), ',"', F.col("p_name"), ', x",y,z')).otherwise(text(F.when(K() % 13 == 0, "").otherwise(text("GSM", K())), ',"', F.col("p_name"), ', x",NA'))
    first = F.monotonically_increasing_id() % (1 << 33) == 0  # of its file
    own.select(F.when(first, text("a title,,\nSample ID,Manual annotation,Sample info #manual annotation\n", line)).otherwise(line)).write.text(f"{top}/gu")
    own.select(F.when(K() % 3 == 0, F.col("p_name")).otherwise(text("s", K(), "\t", F.col("p_name"), "\tgene"))).write.text(f"{top}/atlas")
    maps = {"diseases": ("disease_name", "mondo_id"), "tissues": ("tissue_name", "uberon_id"), "atlas": ("name", "id"), "corrections": ("sample", "term", "name")}
    for name, columns in maps.items():
        own.select(*(text(F.col("p_name")).alias(c) for c in columns)).distinct().write.csv(f"{top}/{name}_map", header=True)
    at = lambda name: f"{top}/{name}"
    return {"URSA": {"raw": at("ursa")}, "Gu_2023": {"raw": at("gu"), "diseases": at("diseases_map"), "tissues": at("tissues_map")}, "DiSignAtlas": {"raw": at("atlas"), "tissues": at("atlas_map"), "corrections": at("corrections_map")}}


@query("ingest_rejects", _INGEST_SQL)
def ingest_rejects(spark, sf_dir):
    own = [ingest.ingest(spark, source, paths).rejects for source, paths in _raw_files(spark, sf_dir).items()]
    return reduce(DataFrame.unionByName, own).select("source", "frame", "reason", "record")


@query("ingest_rows", f"WITH {_PARTS_SQL} SELECT 'URSA' AS source, 'GSM' || k AS entry, 'UBERON:' || n AS value FROM r WHERE k % 7 <> 0 AND k % 11 <> 0 UNION ALL SELECT 'Gu_2023', 'GSM' || k, p_name || ', x' FROM r WHERE k % 5 <> 0 AND k % 13 <> 0 UNION ALL SELECT 'DiSignAtlas', 's' || k, p_name FROM r WHERE k % 3 <> 0")
def ingest_rows(spark, sf_dir):
    """What the same files give beside their rejects."""
    paths = _raw_files(spark, sf_dir)
    own = {"URSA": ("accession", "term_id"), "Gu_2023": ("Sample ID", "Manual annotation"), "DiSignAtlas": ("name", "description")}
    each = [ingest.ingest(spark, s, paths[s]).frames["raw"].select(F.lit(s).alias("source"), F.col(f"`{e}`").alias("entry"), F.col(f"`{v}`").alias("value")) for s, (e, v) in own.items()]
    return reduce(DataFrame.unionByName, each)


@query("bson_database", f"WITH {driver._claims_sql('tissue', 'sex')}, {driver._ENTRIES_SQL}, d AS (SELECT entry, attribute, source, term_id, first(ecode ORDER BY ecode) AS e, min(ecode) AS low FROM claims GROUP BY ALL), g AS (SELECT entry, attribute, source, arg_min(low, term_id) AS ecode FROM d GROUP BY ALL) SELECT d.entry, attribute, source, term_id, g.ecode, series, platform, organism FROM d JOIN g USING (entry, attribute, source) JOIN entries USING (entry)")
def bson_database(spark, sf_dir):
    """Claims and entries written as BSON databases and read back. A claim and its entry are of one document, so they aren't joined."""
    path = shared_path(spark, "bson")
    claims, own = driver.claims(spark, sf_dir, "tissue", "sex").drop("term_name").withColumn("term_name", F.lit(None).cast("string")), driver.entries(spark, sf_dir)
    sinks.save_bson(sinks.database_rows(claims, own), path, file_bytes=64 << 20, compression="zstd")
    rows = written(readers.bson_map(spark, path), "database")  # parsed once
    found = readers.database_entries(rows, "json").withColumnRenamed("entry", "key")
    return readers.database_claims(found, "series", "platform", "organism").select("entry", "attribute", "source", "term_id", "ecode", "series", "platform", "organism")


@query("catalogue_rows", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def catalogue_rows(spark, sf_dir):
    return readers.by_ids(table(spark, sf_dir, "customer"), "c_custkey", table(spark, sf_dir, "orders").select("o_custkey")).select("c_custkey", "c_name")


@query("saved_claims", f"WITH {driver._claims_sql('sex')} SELECT entry AS accession, term_id, ecode FROM claims")
def saved_claims(spark, sf_dir):
    """Processed claims written for a source, and read back by it."""
    root = shared_path(spark, "claims")
    registry.save(driver.claims(spark, sf_dir, "sex").withColumnRenamed("entry", "accession"), root, "ALE")
    return readers.claim_tables(spark, root, ["ALE"])["ALE"].select("accession", "term_id", "ecode")


# ---- filters, curations, reshaping ----

_SERIES = "SELECT 'O:' || o_orderkey AS entry, CASE WHEN o_custkey % 50 = 0 THEN 'NA' ELSE 'C:' || o_custkey END AS series, CASE WHEN o_orderkey % 3 <> 0 THEN 'T' END AS id FROM orders"


@query("staged_series", f"SELECT entry, series, id FROM ({_SERIES}) WHERE series <> 'NA' AND id IS NOT NULL")
def staged_series(spark, sf_dir):
    own = table(spark, sf_dir, "orders").select(text("O:", F.col("o_orderkey")).alias("entry"), F.when(F.col("o_custkey") % 50 == 0, F.lit("NA")).otherwise(text("C:", F.col("o_custkey"))).alias("series"), F.when(F.col("o_orderkey") % 3 != 0, "T").alias("id"), F.lit("x").alias("sample"))
    return filters.staged(own, "id", "series")


def curation(spark: SparkSession, sf_dir: str) -> curate.Curation:
    """Users as entries, with the kinds of their events as terms."""
    own = table(spark, sf_dir, "events")
    cells = own.select(text("U:", F.col("user_id")).alias("entry"), F.col("event_type").alias("term")).distinct()
    users = own.groupBy("user_id").agg(F.count("*").alias("n"))
    return curate.Curation(cells, users.select(text("U:", F.col("user_id")).alias("entry"), text("G:", F.col("user_id") % 10).alias("series"), text("P:", F.col("n") % 3).alias("platform")))


_CURATION_SQL = "own AS (SELECT * FROM events), cells AS (SELECT DISTINCT 'U:' || user_id AS entry, event_type AS term FROM own), ids AS (SELECT 'U:' || user_id AS entry, 'G:' || (user_id % 10) AS series, 'P:' || (count(*) % 3) AS platform FROM own GROUP BY user_id)"


@query("curation_filter", f"WITH {_CURATION_SQL} SELECT entry, term FROM cells JOIN ids USING (entry) WHERE series < 'G:4'")
def curation_filter(spark, sf_dir):
    return curation(spark, sf_dir).filter(F.col("series") < "G:4").cells


@query("curation_having", f"WITH {_CURATION_SQL} SELECT entry, term FROM cells WHERE entry IN (SELECT entry FROM cells WHERE term IN ('click', 'view'))")
def curation_having(spark, sf_dir):
    return curation(spark, sf_dir).having("click", "view").cells


@query("curation_select", f"WITH {_CURATION_SQL} SELECT entry, term FROM cells WHERE term IN ('click', 'view') AND term <> 'view'")
def curation_select(spark, sf_dir):
    return curation(spark, sf_dir).select("click", "view").drop("view").cells


@query("curation_sorted", f"WITH {_CURATION_SQL} SELECT ids.*, " + ", ".join(f"max((term = '{e}')::INT) AS {e}" for e in driver.EVENTS) + " FROM ids JOIN cells USING (entry) GROUP BY ALL")
def curation_sorted(spark, sf_dir):
    """From a wide frame to a curation and back, columns sorted."""
    wide = curation(spark, sf_dir).wide(list(reversed(driver.EVENTS)))
    return curate.Curation.of_wide(wide, ["entry", "series", "platform"]).wide()


@query("curation_head", f"WITH {_CURATION_SQL} SELECT * FROM ids ORDER BY entry LIMIT 7")
def curation_head(spark, sf_dir):
    return curation(spark, sf_dir).head(7)


@query("curation_ids", f"WITH {_CURATION_SQL} SELECT *, 'about ' || entry AS description FROM ids")
def curation_ids(spark, sf_dir):
    own = curation(spark, sf_dir)
    return own.add_ids(own.entries.select("entry", text("about ", F.col("entry")).alias("description"))).ids


@query("curation_collapsed", f"WITH {_CURATION_SQL} SELECT series AS entry, string_agg(DISTINCT platform, '|' ORDER BY platform) AS platform FROM ids GROUP BY series")
def curation_collapsed(spark, sf_dir):
    return curation(spark, sf_dir).collapse().ids


@query("curation_entities", f"WITH {_CURATION_SQL} SELECT DISTINCT term FROM cells")
def curation_entities(spark, sf_dir):
    return curation(spark, sf_dir).entities


@query("cells_without_na", "SELECT DISTINCT 'D:' || doc_id AS entry, lang AS term FROM documents WHERE lang <> 'en' UNION SELECT DISTINCT 'D:' || doc_id, source FROM documents")
def cells_without_na(spark, sf_dir):
    long = table(spark, sf_dir, "documents").select(text("D:", F.col("doc_id")).alias("entry"), F.concat_ws("|", F.when(F.col("lang") == "en", "NA").otherwise(F.col("lang")), "source", F.lit(""), "source").alias("id"))
    return reshape.cells(long)


@query("swapped_map", "SELECT p_name AS name, min(p_partkey) AS id FROM part GROUP BY p_name")
def swapped_map(spark, sf_dir):
    return reshape.swapped(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")))


@query("removed_rows", "SELECT o_orderkey FROM orders WHERE NOT coalesce(CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END = 'F', false)")
def removed_rows(spark, sf_dir):
    status = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus"))
    return filters.removed(table(spark, sf_dir, "orders").select("o_orderkey", status.alias("s")), F.col("s") == "F").select("o_orderkey")


@query("required_results", "SELECT c_custkey FROM customer")
def required_results(spark, sf_dir):
    return filters.required(table(spark, sf_dir, "customer").select("c_custkey"))


@query("claims_in_systems", f"WITH {driver._claims_sql('tissue')} SELECT entry, term_id FROM claims WHERE term_id IN ('P:1', 'P:2', 'P:3')")
def claims_in_systems(spark, sf_dir):
    return filters.within(driver.claims(spark, sf_dir, "tissue"), driver.named(spark, "term", ["P:1", "P:2", "P:3"])).select("entry", "term_id")


# ---- integration and export ----


@query("archive_claims", "SELECT 'GSM' || c_custkey AS entry, CASE WHEN s_suppkey % 2 = 0 THEN 'M' ELSE 'F' END AS term_id FROM supplier JOIN customer ON s_suppkey // 2 = c_custkey // 4 AND c_custkey % 10 <> 0")
def archive_claims(spark, sf_dir):
    """Claims on runs and projects: runs by way of their experiment, projects left out."""
    keys = table(spark, sf_dir, "supplier").select("s_suppkey", F.explode(F.array(F.lit("SRR"), F.lit("SRP"))).alias("kind"))
    own = keys.select(F.concat("kind", F.col("s_suppkey").cast("string")).alias("entry"), F.lit("sex").alias("attribute"), F.lit("S").alias("source"), F.when(F.col("s_suppkey") % 2 == 0, "M").otherwise("F").alias("term_id"), F.lit(None).cast("string").alias("term_name"), F.lit("expert-curated").alias("ecode"))
    return integrate.archive_claims(own, driver.sra_to_gsm(spark, sf_dir)).select("entry", "term_id")


_SAMPLE_SQL = "SELECT 'GSM' || c_custkey AS entry, coalesce(s.series, 'NA') AS series, 'GPL' || c_nationkey AS platform, CASE WHEN c_custkey % 10 <> 0 THEN 'SRX' || c_custkey ELSE 'NA' END AS srx, CASE WHEN c_custkey % 10 <> 0 AND c_custkey % 2 = 0 THEN 'SRS' || c_custkey ELSE 'NA' END AS srs, CASE WHEN c_custkey % 10 <> 0 AND c_custkey % 2 = 0 THEN 'SRP1' ELSE 'NA' END AS srp, lower(c_mktsegment) AS organism FROM customer LEFT JOIN (SELECT o_custkey, string_agg(DISTINCT 'GSE' || (o_orderkey % 100), '|' ORDER BY 'GSE' || (o_orderkey % 100)) AS series FROM orders GROUP BY o_custkey) s ON o_custkey = c_custkey"


@query("sample_entries", _SAMPLE_SQL)
def sample_entries(spark, sf_dir):
    """Samples with their series, archive accessions and organism."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    samples = c.select(text("GSM", key).alias("accession"), text("GPL", F.col("c_nationkey")).alias("platform_id"), F.when(key % 10 != 0, text('"SRX', key, '"')).alias("sra_experiment"))
    series = table(spark, sf_dir, "orders").groupBy(text("GSE", F.col("o_orderkey") % 100).alias("accession")).agg(F.collect_list(text("GSM", F.col("o_custkey"))).alias("sample_id"))
    experiments = c.where("c_custkey % 2 = 0").select(text("SRX", key).alias("accession"), text("SRS", key).alias("sample_accession"), F.lit("SRP1").alias("study_accession"))
    channels = c.select(text("GSM", key).alias("accession"), F.col("c_mktsegment").alias("organism"))
    return integrate.with_organism(integrate.sample_entries(samples, series, experiments), channels.union(channels.withColumn("organism", F.lit("zz"))))


@query("series_claims", f"WITH {driver._claims_sql('disease')}, {driver._ENTRIES_SQL} SELECT series AS entry, source, term_id, min(term_name) AS term_name, max(ecode) AS ecode FROM claims JOIN entries USING (entry) WHERE term_id <> '{CONTROL_ID}' GROUP BY series, source, term_id")
def series_claims(spark, sf_dir):
    return aggregate.series_claims(driver.claims(spark, sf_dir, "disease"), driver.entries(spark, sf_dir)).select("entry", "source", "term_id", "term_name", "ecode")


@query("named_terms", f"WITH {_PARTS_SQL} SELECT k, CASE WHEN n <= {NAMED} THEN 'tissue ' || n END AS name FROM r")
def named_terms(spark, sf_dir):
    return processors.named(parts(spark, sf_dir).select("k", text("UBERON:", N()).alias("term")), "term", context(spark).names).select("k", "name")


_T = driver.TARGETS


@query("labels_wide", f"WITH RECURSIVE {driver._CELLS_SQL}, {driver._CLOSURE_SQL}, {driver._LABELS_SQL} SELECT e.entry, e.series, " + ", ".join(f"coalesce(max(CASE WHEN term = '{t}' THEN value END), -1)::INT AS \"{t}\"" for t in _T) + " FROM (SELECT * FROM entries WHERE entry IN (SELECT entry FROM cells)) e LEFT JOIN labels l ON l.entry = e.entry GROUP BY e.entry, e.series")
def labels_wide(spark, sf_dir):
    own = driver.cells(spark, sf_dir)
    entries = driver.entries(spark, sf_dir).join(own.select("entry").distinct(), "entry", "left_semi")
    return sinks.wide_labels(curate.label(own, driver.closure(spark, sf_dir), _T), entries, _T, ["series"])


@query("label_rows", f"WITH RECURSIVE {driver._CELLS_SQL}, {driver._CLOSURE_SQL}, {driver._LABELS_SQL} SELECT t.term, CASE WHEN l.value = 1 THEN 'positive' ELSE 'negative' END AS label, e.entry, e.series FROM (SELECT * FROM entries WHERE entry IN (SELECT entry FROM cells)) e CROSS JOIN (SELECT unnest({_T}) AS term) t LEFT JOIN labels l ON l.entry = e.entry AND l.term = t.term WHERE coalesce(l.value, -1) <> 0")
def label_rows(spark, sf_dir):
    own = driver.cells(spark, sf_dir)
    entries = driver.entries(spark, sf_dir).join(own.select("entry").distinct(), "entry", "left_semi")
    rows = sinks.label_rows(curate.label(own, driver.closure(spark, sf_dir), _T), entries, driver.named(spark, "term", _T), ["series"])
    return rows.select("term", "label", "entry", "metadata.series")


@query("annotation_rows", f"WITH {driver._CELLS_SQL} SELECT term, entry, series, platform FROM cells JOIN entries USING (entry)")
def annotation_rows(spark, sf_dir):
    return sinks.json_rows(driver.cells(spark, sf_dir), driver.entries(spark, sf_dir), ["series", "platform"]).select("term", "entry", "metadata.*")


@query("metadata_samples", "SELECT 'GSM' || c_custkey AS sample, c_name AS title, 'a b' AS description, c_mktsegment AS source_name_ch1, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE 'NA' END AS source_name_ch2 FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def metadata_samples(spark, sf_dir):
    one, two = (F.struct(F.col(c).alias("source_name")) for c in ("c_mktsegment", "c_name"))
    samples = table(spark, sf_dir, "customer").select(text("GSM", F.col("c_custkey")).alias("accession"), F.col("c_name").alias("title"), F.lit("a\nb").alias("description"), F.when(F.col("c_custkey") % 2 == 0, F.array(one, two)).otherwise(F.array(one)).alias("channels"))
    ids = table(spark, sf_dir, "orders").select(text("GSM", F.col("o_custkey")).alias("id"))
    return metadata.sample_metadata(samples, ids, ["title", "description", "source_name"])


@query("metadata_series", "SELECT 'GSE' || s_suppkey AS series, s_name AS title, CASE WHEN s_suppkey % 3 = 0 THEN 'NA' ELSE 'about' END AS summary, 'Title: ' || s_name || ' | Summary: ' || CASE WHEN s_suppkey % 3 = 0 THEN 'NA' ELSE 'about' END AS description FROM supplier")
def metadata_series(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(text("GSE", F.col("s_suppkey")).alias("accession"), F.col("s_name").alias("title"), F.when(F.col("s_suppkey") % 3 != 0, "about").alias("summary"))
    return metadata.series_metadata(s, s.select("accession"), ["title", "summary"])


@query("search_tables", "SELECT 'UBERON:' || p_partkey AS term_id, p_name AS name, 'UBERON' AS ontology, 'tissue' AS type, p_brand AS synonym, CASE WHEN p_size % 2 = 0 THEN 'EXACT' ELSE 'RELATED' END AS scope FROM part WHERE p_size > 5")
def search_tables(spark, sf_dir):
    one = F.struct(F.col("p_brand").alias("text"), F.when(F.col("p_size") % 2 == 0, "EXACT").alias("scope"))
    nested = table(spark, sf_dir, "part").select(text("UBERON:", F.col("p_partkey")).alias("term_id"), F.when(F.col("p_size") > 5, F.col("p_name")).alias("name"), F.array(one, F.struct(F.lit("").alias("text"), F.lit("EXACT").alias("scope"))).alias("synonyms"))
    terms, synonyms = search.term_tables(nested)
    return terms.join(synonyms, "term_id")


@query("scalar_strings", """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'sample' WHEN c_custkey % 3 = 1 THEN 'series' ELSE 'platform' END AS level, 'UBERON:' || c_custkey AS term, 'D' || c_custkey AS bare, 'a ' || c_custkey AS line,
 CASE WHEN c_mktsegment = 'BUILDING' THEN 'house' ELSE c_mktsegment END AS segment, CASE c_custkey % 3 WHEN 0 THEN 'run' WHEN 1 THEN 'experiment' ELSE 'project' END AS kind, c_custkey % 2 = 0 AND c_acctbal > 0 AS both, c_custkey % 2 = 0 OR c_acctbal > 0 AS any_one, 'b|a|c' AS listed, 2 AS n FROM customer""")
def scalar_strings(spark, sf_dir):
    k, even, rich = F.col("c_custkey"), F.col("c_custkey") % 2 == 0, F.col("c_acctbal") > 0
    third = lambda *names: F.get(F.array(*(F.lit(x) for x in names)), (k % 3).cast("int"))
    listed = F.array(F.lit("b"), F.lit("a"), F.lit(None).cast("string"), F.lit("b"), F.lit("c"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", S.level_of(F.concat(third("GSM", "GSE", "GPL"), k.cast("string"))).alias("level"), S.uri_tail(text("http://x/y/UBERON_", k)).alias("term"), S.without_prefix("MESH:", S.with_prefix("MESH:", text("D", k))).alias("bare"),
        S.one_line(text("a\r\n", k)).alias("line"), S.replaced(F.col("c_mktsegment"), {"BUILDING": "house"}).alias("segment"), S.sra_kind(third("SRR1", "ERX1", "DRP1")).alias("kind"), S.all_of(even, rich).alias("both"), S.any_of(even, rich).alias("any_one"),
        F.array_join(S.distinct_list(listed), "|").alias("listed"), (F.size(S.distinct_list(listed)) - 1).alias("n"),
    )


# ---- build, then retrieve ----

SYSTEM = "UBERON:1"


def built(spark: SparkSession, sf_dir: str) -> str:
    """The folder of a build of all stages: orders are samples, customers series, parts tissue terms. Suppliers tell sources;
    those of the last are two tables of one source, one of them on runs of the archive."""
    items, key = table(spark, sf_dir, "lineitem"), F.col("l_orderkey")
    root, raw = shared_path(spark, "build"), shared_path(spark, "raw")
    own = items.select(F.when(F.col("l_suppkey") % 4 == 3, text("SRR", key)).otherwise(text("GSM", key)).alias("accession"), F.lit("tissue").alias("attribute"), text("UBERON:", F.col("l_partkey")).alias("term_id"), text("t", F.col("l_partkey")).alias("term_name"), F.when(F.col("l_returnflag") == "N", "crowd-sourced").otherwise("expert-curated").alias("ecode"), (F.col("l_suppkey") % 4).alias("s"))
    for i, name in enumerate(("ALE", "CREEDS", "Johnson_2023_microarray", "Johnson_2023_rnaseq")):
        registry.save(own.where(F.col("s") == i).drop("s"), f"{raw}/claims", name)
    orders = table(spark, sf_dir, "orders")
    o = F.col("o_orderkey")
    build.save(orders.select(text("GSM", o).alias("accession"), text("GPL", F.col("o_custkey") % 5).alias("platform_id"), F.when(o % 10 != 0, text('"SRX', o, '"')).alias("sra_experiment")), f"{raw}/samples")
    build.save(orders.groupBy(text("GSE", F.col("o_custkey")).alias("accession")).agg(F.collect_list(text("GSM", o)).alias("sample_id")), f"{raw}/series")
    build.save(orders.select(text("SRX", o).alias("accession"), text("SRS", o).alias("sample_accession"), F.lit("SRP1").alias("study_accession")), f"{raw}/experiments")
    build.save(orders.select(text("GSM", o).alias("accession"), F.when((F.col("o_orderstatus") == "P") & (F.col("o_custkey") % 2 == 0), "Mus musculus").otherwise("Homo sapiens").alias("organism")), f"{raw}/channels")
    build.save(orders.select(text("SRR", o).alias("accession"), text("SRX", o).alias("experiment_accession")), f"{raw}/runs")
    build.save(spark.range(5).select(text("GPL", F.col("id")).alias("id"), F.when(F.col("id") < 3, "rnaseq").otherwise("microarray").alias("technology")), f"{raw}/technologies")
    path = shared_path(spark, "build-obo")
    p = F.col("p_partkey")
    table(spark, sf_dir, "part").select(F.concat_ws("\n", F.lit("[Term]"), text("id: UBERON:", p), F.when(p > 0, text("is_a: UBERON:", F.expr("p_partkey div 10"))))).write.option("lineSep", "\n\n").text(path)
    inputs = {"obo": path, "systems": SYSTEM, "claims": f"{raw}/claims", "technologies": f"{raw}/technologies", **{k: f"{raw}/{k}" for k in ("samples", "series", "experiments", "channels", "runs")}}
    build.stages(spark, root, inputs).run(skip=("search", "report"))
    return root


_BUILT_SQL = f"""tree AS (SELECT p_partkey // 10 AS a, p_partkey AS d FROM part WHERE p_partkey > 0), below AS (SELECT a, d FROM tree UNION SELECT b.a, t.d FROM below b JOIN tree t ON t.a = b.d),
 inside AS (SELECT d AS t FROM below WHERE a = 1 AND d <> 1),
 raw AS (SELECT l_orderkey AS o, ['ALE', 'CREEDS', 'Johnson_2023', 'Johnson_2023'][l_suppkey % 4 + 1] AS source, l_partkey AS t, CASE WHEN l_returnflag = 'N' THEN 'crowd-sourced' ELSE 'expert-curated' END AS ecode, l_suppkey % 4 = 3 AS archive FROM lineitem),
 arch AS (SELECT o, source, t, ecode FROM raw WHERE archive AND o % 10 <> 0), geo AS (SELECT o, source, t, ecode FROM raw WHERE NOT archive),
 merged AS (SELECT * FROM arch UNION ALL SELECT * FROM geo g WHERE NOT EXISTS (SELECT 1 FROM arch x WHERE x.o = g.o AND x.source = g.source)),
 kept AS (SELECT m.* FROM merged m WHERE t IN (SELECT t FROM inside)),
 sample AS (SELECT DISTINCT k.* FROM kept k WHERE NOT EXISTS (SELECT 1 FROM kept x JOIN below b ON b.d = x.t AND b.a = k.t WHERE x.o = k.o)),
 ids AS (SELECT o_orderkey AS o, 'GSM' || o_orderkey AS entry, 'GSE' || o_custkey AS series, o_custkey % 5 AS platform, o_orderstatus = 'P' AND o_custkey % 2 = 0 AS mouse FROM orders)"""


@query("build_retrieve_sample", f"""WITH RECURSIVE {_BUILT_SQL}, cells AS (SELECT DISTINCT i.entry, s.t FROM sample s JOIN ids i USING (o) WHERE ecode = 'expert-curated' AND NOT mouse AND platform < 3)
 SELECT DISTINCT entry, 'UBERON:' || a AS term FROM cells JOIN (SELECT a, d FROM below UNION SELECT t, t FROM inside) ON d = t WHERE a IN (1, 12, 15, 17)""")
def build_retrieve_sample(spark, sf_dir):
    """What a request for some tissues gets from a build's tables."""
    db = Database.load(spark, built(spark, sf_dir), "sample")
    return retrieve(db, Request("tissue", ["UBERON:1", "UBERON:12", "UBERON:15", "UBERON:17", "UBERON:none"])).curation.cells


@query("build_retrieve_series", f"""WITH RECURSIVE {_BUILT_SQL}, own AS (SELECT i.series, s.source, s.t, max(ecode) AS ecode FROM sample s JOIN ids i USING (o) GROUP BY ALL),
 top AS (SELECT * FROM own k WHERE NOT EXISTS (SELECT 1 FROM own x JOIN below b ON b.d = x.t AND b.a = k.t WHERE x.series = k.series)),
 facts AS (SELECT series, any_value(platform) AS platform, bool_or(mouse) AS mouse FROM ids WHERE o IN (SELECT o FROM sample) GROUP BY series),
 cells AS (SELECT DISTINCT series AS entry, t FROM top JOIN facts USING (series) WHERE ecode = 'expert-curated' AND NOT mouse AND platform < 3),
 pairs AS (SELECT a, d FROM below UNION SELECT t, t FROM inside), up AS (SELECT DISTINCT entry, a AS term, 1 AS value FROM cells JOIN pairs ON d = t WHERE a IN (1, 12, 15, 17)), down AS (SELECT DISTINCT entry, d AS term, 0 AS value FROM cells JOIN below ON a = t WHERE d IN (1, 12, 15, 17) AND a <> d)
 SELECT entry, 'UBERON:' || term AS term, max(value) AS value FROM (SELECT * FROM up UNION ALL SELECT * FROM down) GROUP BY ALL""")
def build_retrieve_series(spark, sf_dir):
    """Labels of series: a series of several organisms matches none."""
    db = Database.load(spark, built(spark, sf_dir), "series")
    return retrieve(db, Request("tissue", ["UBERON:1", "UBERON:12", "UBERON:15", "UBERON:17"], level="series", mode="label")).curation.cells


