"""Reports and the quality contract of an integrated database: a violation is a row."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgrid.functions.scalar import split_multi
from claimgrid.schema import AGE_GROUPS, CROWD, EXPERT, LICENCES, ORGANISMS


def badges(counts: DataFrame, level: str, sources: list[str] | None = None) -> DataFrame:
    """source, level, message: thousands-separated counts; sources without any count 0."""
    spark = counts.sparkSession
    every = spark.createDataFrame([(s,) for s in sources or sorted(LICENCES)], "source string")
    return every.join(counts, "source", "left").select("source", F.lit(level).alias("level"), F.format_number(F.coalesce("n", F.lit(0)), 0).alias("message"))


def missing_accessions(entries: DataFrame, *columns: str) -> DataFrame:
    """(entry, column) for each absent accession."""
    lacks = F.array_compact(F.array(*(F.when(F.col(c).isNull() | F.col(c).isin("", "NA"), F.lit(c)) for c in columns)))
    return entries.select("entry", F.explode(lacks).alias("column"))


@dataclass(frozen=True)
class Rule:
    """What a value of a column must be.

    table: claims or entries. pattern: a regular expression that must match from the start of a value to its end. attribute:
    of which claims alone. required: null breaks the rule too. levels: where it holds. many: values are joined by |, each must match.
    """

    name: str
    table: str
    column: str
    pattern: str
    attribute: str | None = None
    required: bool = False
    levels: tuple[str, ...] = ("sample", "series")
    many: tuple[str, ...] = ()
    severity: str = "error"


def _one_of(values) -> str:
    return "|".join(re.escape(v) for v in values)


# The contract of an integrated database, on values and on accessions. Entries may have several series, platforms
# and projects, those of series several organisms.
_ARCHIVE = "[SED]R"
VALUES = (
    Rule("ecode", "claims", "ecode", _one_of((EXPERT, CROWD))),
    Rule("tissue ontology", "claims", "term", "(?:UBERON|CL)(?::.*)?", "tissue"),
    Rule("disease ontology", "claims", "term", "MONDO(?::.*)?", "disease"),
    Rule("sex", "claims", "term", "M|F", "sex"),
    Rule("age group", "claims", "term", _one_of(g for g, _, _ in AGE_GROUPS), "age"),
    Rule("organism", "entries", "organism", _one_of(sorted(ORGANISMS)), required=True, many=("series",)),
)
ACCESSIONS = (
    Rule("sample accession", "entries", "entry", "GSM.*", required=True, levels=("sample",)),
    Rule("series accession", "entries", "series", "GSE.*", required=True, levels=("sample",), many=("sample",)),
    Rule("series accession", "entries", "entry", "GSE.*", required=True, levels=("series",)),
    Rule("platform accession", "entries", "platform", "GPL.*", required=True, many=("sample", "series")),
    Rule("experiment accession", "entries", "srx", f"{_ARCHIVE}X.*", levels=("sample",), many=("sample",)),
    Rule("archive sample accession", "entries", "srs", f"{_ARCHIVE}S.*", levels=("sample",), many=("sample",)),
    Rule("project accession", "entries", "srp", f"{_ARCHIVE}P.*", many=("sample", "series")),
)
CONTRACT = VALUES + ACCESSIONS


def _hits(rule: Rule, level: str, shown: str | None) -> Column:
    """The values of a rule's column that break it, as an array of (rule, value, severity)."""
    column = F.col(rule.column)
    absent = F.array(F.lit(None).cast("string")) if rule.required else F.array().cast("array<string>")
    values = F.when(column.isNull(), absent).otherwise(split_multi(rule.column) if level in rule.many else F.array(column))
    wrong = F.filter(values, lambda v: v.isNull() | ~v.rlike(f"(?s)^(?:{rule.pattern})\\z"))
    return F.transform(wrong, lambda v: F.struct(F.lit(rule.name).alias("rule"), (F.col(shown) if shown else v).alias("value"), F.lit(rule.severity).alias("severity")))


def broken(df: DataFrame, table: str, level: str, rules: tuple[Rule, ...] = CONTRACT, shown: str | None = None) -> DataFrame:
    """(entry, rule, value, severity) for each value that breaks a rule of a table at a level: one scan, whatever the number of
    rules. Of a claim's rules the first that it breaks counts. Rules on columns that df doesn't have are left out. shown: the
    column whose value is given, by default the one that breaks the rule."""
    each = df.select("entry", F.explode(_breaks(df, table, level, rules, shown)).alias("b"))
    return each.select("entry", "b.rule", "b.value", "b.severity")


def _breaks(df: DataFrame, table: str, level: str, rules: tuple[Rule, ...], shown: str | None) -> Column:
    own = [r for r in rules if r.table == table and level in r.levels and r.column in df.columns]
    none = F.array().cast("array<struct<rule:string,value:string,severity:string>>")
    found = [_hits(r, level, shown) for r in own]
    found = [F.when(F.col("attribute") == r.attribute, hits).otherwise(none) if r.attribute else hits for r, hits in zip(own, found, strict=True)]
    every = F.flatten(F.array(*found)) if found else none
    return F.slice(every, 1, 1) if table == "claims" else every


def violations(claims: DataFrame, entries: DataFrame, level: str = "sample", rules: tuple[Rule, ...] = VALUES) -> DataFrame:
    """(entry, rule, value, severity) for each broken rule, by default of those on values; ``CONTRACT`` also has those on
    accessions. A claim's violation gives its term."""
    return level_violations(claims, entries, (level,), rules).drop("level")


def level_violations(claims: DataFrame, entries: DataFrame, levels: tuple[str, ...] = ("sample", "series"), rules: tuple[Rule, ...] = VALUES) -> DataFrame:
    """(level, entry, rule, value, severity): violations at several levels, by one scan of the claims, and another for several
    values of an attribute, and one of the entries."""

    def at(df: DataFrame, table: str, shown: str | None) -> DataFrame:
        marked = [F.transform(_breaks(df, table, x, rules, shown), lambda b: F.struct(F.lit(x).alias("level"), b["rule"].alias("rule"), b["value"].alias("value"), b["severity"].alias("severity"))) for x in levels]  # noqa: B023
        return df.select("entry", F.explode(F.concat(*marked)).alias("b")).select("b.level", "entry", "b.rule", "b.value", "b.severity")

    each = claims.select("entry", "attribute", "source", "ecode", F.explode(split_multi("term_id")).alias("term"))
    out = at(each, "claims", "term")
    if "sample" in levels:
        many = each.where("attribute in ('sex', 'age')").groupBy("entry", "attribute", "source").agg(F.countDistinct("term").alias("n")).where("n > 1")
        out = out.unionByName(many.select(F.lit("sample").alias("level"), "entry", F.concat(F.lit("several values of "), "attribute").alias("rule"), F.col("n").cast("string").alias("value"), F.lit("error").alias("severity")))
    return out.unionByName(at(entries, "entries", None))


def totals(claims: DataFrame) -> DataFrame:
    """Annotations and distinct terms of each attribute."""
    return claims.groupBy("attribute").agg(F.count("*").alias("n"), F.countDistinct("term_id").alias("terms"))


def by_technology(claims: DataFrame, entries: DataFrame, technology_map: DataFrame) -> DataFrame:
    """Annotations by technology, attribute and source; an unknown platform is left out."""
    own = entries.select("entry", F.explode(split_multi("platform")).alias("id")).join(technology_map, "id").select("entry", "technology").distinct()
    return claims.join(own, "entry").groupBy("technology", "attribute", "source").agg(F.count("*").alias("n"))
