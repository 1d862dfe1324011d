"""The corpus pipeline: documents without toxic ones, near copies and benchmark leaks, mixed and written as token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next one's docs.
All stages keep extra columns, whatever their names; an empty table stays empty; rows with null ids or sources are rows
like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimgrid.llm import decontaminate, mixing, simhash, token_output, toxicity
from claimgrid.llm.common import shared_path, table
from claimgrid.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that score 0.5 or more go. The labelled rows among docs train the model; without both kinds of them all stay. A null
    or empty text scores the intercept alone; repeated rows stay or go together."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints one document stays, the one with the least (doc_id, text hash), null ids last. Texts
    without words are linked to one another; of wholly equal rows one stays."""
    return simhash.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go, equal texts alike. A null text holds none; items under 9 words must
    stand in a text whole, and those under 4 words are passed over; items with a null item_id count; an empty benchmark
    leaves all."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, up to 3 times. Null sources are one source, the last; texts without words are
    taken by their place in their source's order, like others."""
    return mixing.expand(mixing.mix(docs, mixing.words_of()), docs.columns)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each row, read back from the token files, null ids first. A null text has the end id
    alone."""
    return token_output.tokenized(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        out = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None
