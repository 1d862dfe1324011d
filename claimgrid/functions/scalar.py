"""Scalar expressions of the claim model, all built from Spark's own functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimgrid.schema import AGE_GROUPS, DELIMITER, TERM_TYPES


def split_multi(col: str | Column, delimiter: str = DELIMITER) -> Column:
    """A delimited string as an array; the delimiter is taken literally."""
    return F.split(col, "\\Q" + delimiter + "\\E")


def join_sorted(values: Column, delimiter: str = DELIMITER) -> Column:
    """An array as a string: distinct, sorted, without nulls."""
    return F.array_join(F.array_sort(F.array_distinct(F.array_compact(values))), delimiter)


def distinct_list(values: Column) -> Column:
    """An array without nulls or repeats, in the order of first occurrence."""
    return F.array_distinct(F.array_compact(values))


def first_case(cases: list[tuple[Column, Column]], default: Column | None = None) -> Column:
    """The value of the first condition that holds; else the default, or null."""
    (condition, value), *rest = cases
    out = F.when(condition, value)
    for condition, value in rest:
        out = out.when(condition, value)
    return out if default is None else out.otherwise(default)


def age_group(years: Column) -> Column:
    """The first closed age interval that holds a number of years; null outside all."""
    return first_case([(years.between(low, high), F.lit(name)) for name, low, high in AGE_GROUPS])


def months_to_years(months: Column) -> Column:
    return months / F.lit(12.0)


def range_mean(text: Column, separator: str = "-") -> Column:
    """The mean of the numbers of a range such as 20-30; parts that are no numbers are left out."""
    numbers = F.filter(F.transform(F.split(text, separator), lambda x: x.try_cast("double")), lambda x: x.isNotNull())
    total = F.aggregate(numbers, F.lit(0.0), lambda s, x: s + x)
    return F.when(F.size(numbers) > 0, total / F.size(numbers))


def extract(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, or null."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def title(text: Column) -> Column:
    """Each word with a capital, the rest small."""
    return F.initcap(text)


def tokens(text: Column) -> Column:
    """Lower-cased runs of ASCII letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit("[A-Za-z0-9]+"), F.lit(0))


def uri_tail(uri: Column) -> Column:
    """The term id at the end of an address: .../UBERON_0001 is UBERON:0001."""
    return F.translate(F.substring_index(uri, "/", -1), "_", ":")


def with_prefix(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value)


def without_prefix(prefix: str, value: Column) -> Column:
    return F.regexp_replace(value, "^" + prefix, "")


def unquoted(value: Column) -> Column:
    return F.btrim(value, F.lit('"'))


def one_line(value: Column) -> Column:
    return F.regexp_replace(value, r"[\r\n]+", " ")


def get(values: Column, i: int) -> Column:
    """An element by place from 0; null beyond the end."""
    return F.get(values, F.lit(i))


def replaced(value: Column, mapping: dict[str, str], default: Column | None = None) -> Column:
    """A value by a map; without a default what isn't in the map stays."""
    if not mapping:
        return value if default is None else default
    table = F.create_map(*(F.lit(x) for kv in mapping.items() for x in kv))
    return F.coalesce(F.try_element_at(table, value), value if default is None else default)


def any_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def ontology_of(term_id: Column) -> Column:
    return F.substring_index(term_id, ":", 1)


def term_type(term_id: Column) -> Column:
    """disease, tissue or celltype by the id's prefix; else null."""
    return replaced(ontology_of(term_id), TERM_TYPES, F.lit(None).cast("string"))


def level_of(accession: Column) -> Column:
    """sample, series or platform by the accession's prefix."""
    return F.when(accession.startswith("GSM"), "sample").when(accession.startswith("GSE"), "series").when(accession.startswith("GPL"), "platform")


def sra_kind(accession: Column) -> Column:
    """run, experiment or project by the third letter of a sequence archive's accession."""
    letter = F.upper(F.substring(accession, 3, 1))
    return F.when(letter == "R", "run").when(letter == "X", "experiment").when(letter == "P", "project").when(letter == "S", "sample")


def is_na(col: Column, absent: tuple[str, ...]) -> Column:
    return col.isNull() | col.isin(*absent)


def thousands(n: Column) -> Column:
    return F.format_number(n, 0)
