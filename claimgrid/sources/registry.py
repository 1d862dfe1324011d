"""Sources as plug-ins: a function from raw frames and an ontology context to processed claims."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimgrid.schema import PROCESSED


class ProcessorError(ValueError):
    """A source is unknown, or what it gave isn't a claim table."""


@dataclass(frozen=True)
class Context:
    """What normalising needs of the ontologies.

    tissues, diseases: (term) strict descendants of the systems. names: (id, name). to_disease: (key, value) maps of
    foreign ids by prefix.
    """

    tissues: DataFrame
    diseases: DataFrame
    names: DataFrame
    to_disease: dict[str, DataFrame]


_PROCESSORS: dict[str, Callable[..., DataFrame]] = {}
_SOURCES: dict[str, str] = {}


def source(name: str, of: str | None = None):
    """Registers a processor under a name; its claims are of the source ``of``, by default of that name."""

    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        _PROCESSORS[name] = f
        _SOURCES[name] = of or name
        return f

    return add


def names() -> list[str]:
    return sorted(_PROCESSORS)


def sources() -> dict[str, str]:
    """The source of each processor: two processors may serve one source."""
    return dict(_SOURCES)


def validated(df: DataFrame) -> DataFrame:
    missing = [f.name for f in PROCESSED if f.name not in df.columns]
    if missing:
        raise ProcessorError(f"columns are missing: {', '.join(missing)}")
    return df.select(*(F.col(f.name).cast("string") for f in PROCESSED))


def process(name: str, ctx: Context, **raw: DataFrame) -> DataFrame:
    """Processed claims of a source, distinct rows."""
    if name not in _PROCESSORS:
        raise ProcessorError(f"no source {name!r}; there are {', '.join(names())}")
    return validated(_PROCESSORS[name](ctx, **raw))


def save(df: DataFrame, root: str, name: str) -> str:
    """Claims as Parquet under root/source=<name>, sorted within files for compact pages and pruned reads."""
    path = f"{root}/source={name}"
    df.repartitionByRange("accession").sortWithinPartitions("accession", "attribute", "term_id", "term_name").write.mode("overwrite").parquet(path)
    return path
