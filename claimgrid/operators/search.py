"""Term search: weighted fields, BM25+ over names and synonyms, per-field Okapi BM25.

A term's document isn't spelled out: a field's weight multiplies its token counts. Only the query's tokens are kept
before anything is grouped; corpus statistics (documents, lengths, document frequencies) come from one pass over postings.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgrid.functions.scalar import ontology_of, term_type, tokens
from claimgrid.operators.filters import NoResults
from claimgrid.schema import NAME_WEIGHT, SCOPE_ORDER_SEARCH, SCOPE_ORDER_TABLE, SCOPE_WEIGHTS

K1, B, DELTA = 1.2, 0.8, 0.5


def term_tables(names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Terms (term_id, name, ontology, type) and synonyms (term_id, synonym, scope) from a nested table
    (term_id, name, synonyms: array of (text, scope)); terms without a name are left out."""
    named = names.where("name is not null and name <> ''")
    terms = named.select("term_id", "name", ontology_of(F.col("term_id")).alias("ontology"), term_type(F.col("term_id")).alias("type"))
    each = named.select("term_id", F.explode("synonyms").alias("s")).select("term_id", F.col("s.text").alias("synonym"), F.coalesce("s.scope", F.lit("RELATED")).alias("scope"))
    return terms, each.where("synonym is not null and synonym <> ''")


def filtered(terms: DataFrame, type: str | None = None, ontology: str | None = None) -> DataFrame:
    if type is not None:
        terms = terms.where(F.col("type") == type)
    return terms if ontology is None else terms.where(F.col("ontology") == ontology)


def fields(terms: DataFrame, synonyms: DataFrame) -> DataFrame:
    """(term_id, text, weight): the name and each synonym."""
    weight = F.lit(SCOPE_WEIGHTS["RELATED"])
    for scope, w in SCOPE_WEIGHTS.items():
        weight = F.when(F.col("scope") == scope, w).otherwise(weight)
    own = synonyms.join(terms.select("term_id"), "term_id", "left_semi")
    return terms.select("term_id", F.col("name").alias("text"), F.lit(NAME_WEIGHT).alias("weight")).union(own.select("term_id", "synonym", weight))


def term_frequencies(fields: DataFrame) -> DataFrame:
    """(term_id, token, tf): weighted counts. Texts are dealt by term before they are split into tokens, in as many tasks as
    a shuffle has, since a small file of texts is one task's and has many tokens."""
    spark = fields.sparkSession
    dealt = fields.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "term_id")
    each = dealt.select("term_id", "weight", F.explode(tokens(F.col("text"))).alias("token"))
    return each.groupBy("term_id", "token").agg(F.sum("weight").alias("tf"))


def postings(fields: DataFrame) -> DataFrame:
    """(term_id, token, tf, dl): weighted counts, and the weighted length of the whole document."""
    tf = term_frequencies(fields)
    return tf.join(tf.groupBy("term_id").agg(F.sum("tf").alias("dl")), "term_id")


def query_tokens(query: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", query.lower())


def occurrences(words: str, token: str) -> Column:
    return F.size(F.filter(words, lambda x: x == token))


def bm25plus(fields: DataFrame, query: str, k1: float = K1, b: float = B, delta: float = DELTA) -> DataFrame:
    """(term_id, score) of every document once some token of the query is known; empty otherwise.

    delta counts for every document, token by token, so it is a sum over the query and added once. Tokens that occur twice
    in the query count twice.
    """
    counts: dict[str, int] = {}
    for t in query_tokens(query):
        counts[t] = counts.get(t, 0) + 1
    if not counts:
        raise NoResults(f"no words in {query!r}")
    each = fields.select("term_id", "weight", tokens(F.col("text")).alias("w"))
    hit = [occurrences("w", t) for t in counts]
    docs = each.groupBy("term_id").agg(F.sum(F.size("w") * F.col("weight")).alias("dl"), *(F.sum(h * F.col("weight")).alias(f"tf{i}") for i, h in enumerate(hit)))
    stats = docs.agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"), *(F.sum((F.col(f"tf{i}") > 0).cast("int")).alias(f"df{i}") for i in range(len(hit))))
    scored = docs.crossJoin(F.broadcast(stats))  # stats is one row
    total, known = F.lit(0.0), F.lit(False)
    for i, n in enumerate(counts.values()):
        tf, df = F.col(f"tf{i}"), F.col(f"df{i}")
        idf = F.log((F.col("n") + 1) / df)
        part = idf * (F.lit(delta) + tf * (k1 + 1) / (k1 * (1 - b + b * F.col("dl") / F.col("avgdl")) + tf))
        total = total + F.when(df > 0, n * part).otherwise(0.0)
        known = known | (df > 0)
    return scored.where(known).select("term_id", total.alias("score"))


def ranked_scope(scope: Column, order: tuple[str, ...]) -> Column:
    rank = F.lit(9)
    for i, s in enumerate(order):
        rank = F.when(scope == s, i).otherwise(rank)
    return rank


def ordered_synonyms(synonyms: DataFrame, order: tuple[str, ...] = SCOPE_ORDER_SEARCH) -> DataFrame:
    """(term_id, synonyms): structs (text, scope) by scope, then by text."""
    key = F.struct(ranked_scope(F.col("scope"), order).alias("rank"), F.col("synonym").alias("text"), "scope")
    sorted_ = synonyms.groupBy("term_id").agg(F.array_sort(F.collect_list(key)).alias("s"))
    return sorted_.select("term_id", F.transform("s", lambda x: F.struct(x["text"].alias("text"), x["scope"].alias("scope"))).alias("synonyms"))


def search(terms: DataFrame, synonyms: DataFrame, query: str, k: int = 20, type: str | None = None, ontology: str | None = None) -> DataFrame:
    """The k best terms: term_id, ontology, name, type, synonyms, score. Statistics are of the filtered terms; ties by id."""
    chosen = filtered(terms, type, ontology)
    scored = bm25plus(fields(chosen, synonyms), query)
    top = scored.join(chosen, "term_id").orderBy(F.desc("score"), "term_id").limit(k)
    own = ordered_synonyms(synonyms.join(top.select("term_id"), "term_id", "left_semi"))
    out = top.join(own, "term_id", "left").select("term_id", "ontology", "name", "type", F.coalesce("synonyms", F.array().cast("array<struct<text:string,scope:string>>")).alias("synonyms"), "score")
    return out.orderBy(F.desc("score"), "term_id")


def field_scores(docs: DataFrame, field: str, query: str, k1: float = K1, b: float = B, conjunctive: bool = False) -> DataFrame:
    """(term_id, score): Okapi BM25 of one text column over the distinct tokens of a query, for documents with a hit."""
    words = sorted(set(query_tokens(query)))
    each = docs.select("term_id", tokens(F.coalesce(F.col(field), F.lit(""))).alias("w")).where(F.size("w") > 0)
    each = each.select("term_id", F.size("w").alias("dl"), *(occurrences("w", t).alias(f"tf{i}") for i, t in enumerate(words)))
    stats = each.agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"), *(F.sum((F.col(f"tf{i}") > 0).cast("int")).alias(f"df{i}") for i in range(len(words))))
    total, hits = F.lit(0.0), F.lit(0)
    for i in range(len(words)):
        tf, df = F.col(f"tf{i}"), F.col(f"df{i}")
        idf = F.log((F.col("n") - df + 0.5) / (df + 0.5) + 1)
        total = total + F.when(tf > 0, idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("dl") / F.col("avgdl")))).otherwise(0.0)
        hits = hits + (tf > 0).cast("int")
    scored = each.crossJoin(F.broadcast(stats))  # stats is one row
    return scored.where(hits >= (len(words) if conjunctive else 1)).select("term_id", total.alias("score"))


def search_fields(terms: DataFrame, synonyms: DataFrame, query: str, k: int = 20, type: str | None = None, ontology: str | None = None, weights: dict[str, float] | None = None, k1: float = K1, b: float = B, conjunctive: bool = False) -> DataFrame:
    """The k best terms by weighted per-field scores; statistics are of all terms, filters come after."""
    scope = F.when(F.col("scope").isin(*SCOPE_WEIGHTS), F.col("scope")).otherwise("RELATED")
    joined = synonyms.withColumn("scope", scope).groupBy("term_id").agg(*(F.array_join(F.array_sort(F.collect_list(F.when(F.col("scope") == s, F.col("synonym")))), " ").alias(s.lower()) for s in SCOPE_WEIGHTS))
    docs = terms.join(joined, "term_id", "left")
    weights = weights or {"name": NAME_WEIGHT, **{s.lower(): w for s, w in SCOPE_WEIGHTS.items()}}
    parts = None
    for field, w in weights.items():
        one = field_scores(docs, field, query, k1, b, conjunctive).select("term_id", (F.col("score") * w).alias("score"))
        parts = one if parts is None else parts.union(one)
    total = parts.groupBy("term_id").agg(F.sum("score").alias("score")).where("score > 0")
    top = total.join(filtered(terms, type, ontology), "term_id").orderBy(F.desc("score"), "term_id").limit(k)
    own = ordered_synonyms(synonyms.join(top.select("term_id"), "term_id", "left_semi"), SCOPE_ORDER_TABLE)
    text = F.array_join(F.transform("synonyms", lambda x: x["text"]), " | ")
    return top.join(own, "term_id", "left").select("term_id", "name", "ontology", "type", "score", F.coalesce(text, F.lit("")).alias("synonyms")).orderBy(F.desc("score"), "term_id")
