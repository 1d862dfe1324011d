"""A stored inverted index of terms: built once, and searched by reading the postings of the query's tokens alone.

Under a folder lie ``postings`` (bucket, token, field, term_id, tf, dl), ``frequencies`` (bucket, token, field, df), ``fields``
(field, n, avgdl), ``terms`` and ``synonyms``. Fields are the name and the synonyms of each scope. Postings are dealt by ranges
of (bucket, token, term), so a frequent token is written by many tasks, and stored by bucket of the token: a search prunes
to its tokens' buckets and, within them, to the row groups that hold the tokens. Scores are Okapi BM25 by field, weighted;
statistics are of all terms, filters come after.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgrid.functions.scalar import tokens
from claimgrid.operators.filters import NoResults
from claimgrid.operators.search import B, K1, filtered, ordered_synonyms, query_tokens
from claimgrid.schema import NAME_WEIGHT, SCOPE_ORDER_TABLE, SCOPE_WEIGHTS
from claimgrid.storage import written

#: Folders that postings are dealt to.
BUCKETS = 64
FIELD_WEIGHTS = {"name": NAME_WEIGHT, **{s.lower(): w for s, w in SCOPE_WEIGHTS.items()}}


def bucket(token: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def field_texts(terms: DataFrame, synonyms: DataFrame) -> DataFrame:
    """(term_id, field, text): names and synonyms; an unknown scope counts as RELATED, synonyms of unknown terms not at all."""
    scope = F.when(F.col("scope").isin(*SCOPE_WEIGHTS), F.lower("scope")).otherwise("related")
    own = synonyms.join(terms.select("term_id"), "term_id", "left_semi")
    return terms.select("term_id", F.lit("name").alias("field"), F.col("name").alias("text")).union(own.select("term_id", scope, "synonym"))


def build(terms: DataFrame, synonyms: DataFrame, folder: str, buckets: int = BUCKETS) -> None:
    """Writes the index of terms (term_id, name, ontology, type) and synonyms (term_id, synonym, scope) to a folder."""
    spark = terms.sparkSession
    words = field_texts(terms, synonyms).select("term_id", "field", tokens(F.coalesce("text", F.lit(""))).alias("words"))
    documents = words.groupBy("term_id", "field").agg(F.flatten(F.collect_list("words")).alias("words")).where(F.size("words") > 0)
    documents = written(documents, "index-documents")  # read for postings and for the fields
    each = documents.select("term_id", "field", F.size("words").cast("long").alias("dl"), F.explode("words").alias("token"))
    tf = each.groupBy("term_id", "field", "token").agg(F.count("*").alias("tf"), F.first("dl").alias("dl"))
    placed = tf.select(bucket(F.col("token"), buckets).alias("bucket"), "token", "field", "term_id", "tf", "dl")
    order = ["bucket", "token", "term_id"]
    placed.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/postings")
    stored = spark.read.parquet(f"{folder}/postings")
    df = stored.groupBy("bucket", "token", "field").agg(F.count("*").alias("df"))
    df.repartitionByRange("bucket", "token").sortWithinPartitions("bucket", "token").write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/frequencies")
    documents.groupBy("field").agg(F.count("*").alias("n"), F.avg(F.size("words")).alias("avgdl")).write.mode("overwrite").parquet(f"{folder}/fields")
    terms.select("term_id", "name", "ontology", "type").write.mode("overwrite").parquet(f"{folder}/terms")
    own = ordered_synonyms(synonyms.join(terms.select("term_id"), "term_id", "left_semi"), SCOPE_ORDER_TABLE)
    own.select("term_id", F.array_join(F.transform("synonyms", lambda x: x["text"]), " | ").alias("synonyms")).write.mode("overwrite").parquet(f"{folder}/synonyms")


def of_tokens(spark: SparkSession, folder: str, name: str, words: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Rows of postings or frequencies for some tokens; only their buckets are read."""
    rows = spark.read.parquet(f"{folder}/{name}")
    within = F.lit(False)
    for w in words:
        within = within | ((F.col("bucket") == bucket(F.lit(w), buckets)) & (F.col("token") == w))
    return rows.where(within)


def search(spark: SparkSession, folder: str, query: str, k: int = 20, type: str | None = None, ontology: str | None = None, weights: dict[str, float] | None = None, k1: float = K1, b: float = B, conjunctive: bool = False, buckets: int = BUCKETS) -> DataFrame:
    """The k best terms: term_id, name, ontology, type, score, synonyms. conjunctive: a field counts where it has all tokens.

    Joined are the query's postings with one row for each token and field, and the k best with their synonyms.
    """
    words = sorted(set(query_tokens(query)))
    if not words:
        raise NoResults(f"no words in {query!r}")
    weights = FIELD_WEIGHTS if weights is None else weights
    df = of_tokens(spark, folder, "frequencies", words, buckets).select("token", "field", "df")  # at most tokens times fields
    fields = spark.read.parquet(f"{folder}/fields").where(F.col("field").isin(*weights))  # a row for each field
    known = df.join(F.broadcast(fields), "field")
    hits = of_tokens(spark, folder, "postings", words, buckets).join(F.broadcast(known), ["token", "field"])
    idf = F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1)
    part = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / F.col("avgdl")))
    by_field = hits.groupBy("term_id", "field").agg(F.sum(part).alias("score"), F.count("*").alias("n"))
    if conjunctive:
        by_field = by_field.where(F.col("n") == len(words))
    weight = F.lit(0.0)
    for field, w in weights.items():
        weight = F.when(F.col("field") == field, float(w)).otherwise(weight)
    total = by_field.groupBy("term_id").agg(F.sum(F.col("score") * weight).alias("score")).where("score > 0")
    top = total.join(filtered(spark.read.parquet(f"{folder}/terms"), type, ontology), "term_id").orderBy(F.desc("score"), "term_id").limit(k)
    out = top.join(spark.read.parquet(f"{folder}/synonyms"), "term_id", "left")
    return out.select("term_id", "name", "ontology", "type", "score", F.coalesce("synonyms", F.lit("")).alias("synonyms")).orderBy(F.desc("score"), "term_id")


def create_function(spark: SparkSession, folder: str, name: str = "ont_search", buckets: int = BUCKETS) -> None:
    """A SQL table function on the index, for this session:

    SELECT * FROM ont_search('heart attack', 10, type_filter => 'disease', conjunctive => 1) ORDER BY score DESC, term_id
    """
    weights = ", ".join(f"w_{f} DOUBLE DEFAULT {float(w)}" for f, w in FIELD_WEIGHTS.items())
    weight = "CASE f.field " + " ".join(f"WHEN '{f}' THEN w_{f}" for f in FIELD_WEIGHTS) + " END"
    words = "array_distinct(regexp_extract_all(lower(q), '[a-z0-9]+', 0))"
    within = f"array_contains(transform({words}, w -> CAST(pmod(xxhash64(w), {buckets}) AS INT)), bucket) AND array_contains({words}, token)"
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(q STRING, k_results INT DEFAULT 20, ontology_filter STRING DEFAULT NULL, type_filter STRING DEFAULT NULL, {weights}, k1 DOUBLE DEFAULT {K1}, b DOUBLE DEFAULT {B}, conjunctive INT DEFAULT 0)
 RETURNS TABLE (term_id STRING, name STRING, ontology STRING, type STRING, score DOUBLE, synonyms STRING)
 RETURN SELECT term_id, name, ontology, type, score, synonyms FROM (
   SELECT r.term_id, t.name, t.ontology, t.type, r.score, coalesce(s.synonyms, '') AS synonyms, row_number() OVER (ORDER BY r.score DESC, r.term_id) AS place FROM (
     SELECT term_id, sum(score) AS score FROM (SELECT term_id, field, sum(part) AS score, count(*) AS n, max(wanted) AS wanted, max(every) AS every FROM (
       SELECT p.term_id, p.field, {weight} * ln((f.n - d.df + 0.5D) / (d.df + 0.5D) + 1) * p.tf * (k1 + 1) / (p.tf + k1 * (1 - b + b * p.dl / f.avgdl)) AS part, size({words}) AS wanted, conjunctive AS every
       FROM (SELECT * FROM parquet.`{folder}/postings` WHERE {within}) p JOIN (SELECT * FROM parquet.`{folder}/frequencies` WHERE {within}) d ON p.token = d.token AND p.field = d.field
       JOIN parquet.`{folder}/fields` f ON p.field = f.field) GROUP BY term_id, field)
     WHERE every = 0 OR n = wanted GROUP BY term_id HAVING sum(score) > 0) r
   JOIN parquet.`{folder}/terms` t ON t.term_id = r.term_id LEFT JOIN parquet.`{folder}/synonyms` s ON s.term_id = r.term_id
   WHERE (ontology_filter IS NULL OR t.ontology = ontology_filter) AND (type_filter IS NULL OR t.type = type_filter))
 WHERE place <= k_results""")
