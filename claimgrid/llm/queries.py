"""The queries of this subpackage: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation_trie, decontaminate, line_dedup, merkle, mixing, pii, quality_rules, secret_scan, sharding, simhash, substring_dedup, token_output, toxicity
from .common import table, written

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.col("agreeing").cast("long").alias("agreeing"), F.col("doc_place").cast("long").alias("doc_place"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sizes = written(docs.select("doc_id", "source", mixing.words_of().alias("size"), F.xxhash64("text").alias("tie")), "mix-sizes")
    mixed = mixing.mix(sizes, F.col("size"), tie=F.col("tie"))
    return mixed.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), (F.col("_size") * F.col("_copies")).alias("taken"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(table(spark, sf_dir, "documents"), secret_scan.ranked_of_vocabulary(tokenizer_path()))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.tokenized(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op9_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.pseudonymise(docs.select("doc_id", "text"), pii.session_key(spark))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"), tamper=merkle.TAMPER).drop("proof")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = conversation_trie.turns(table(spark, sf_dir, "conversations"))
    return conversation_trie.trie(*conversation_trie.rebuilt(own))


def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op2_quality_rules counts, before any model."""
    return quality_rules.counted(table(spark, sf_dir, "documents")).select("doc_id", *quality_rules.COUNTS)


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op3_mix_sources aims at."""
    return op3_mix_sources(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 4).alias("target"))


def secret_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base kinds of op4_secret_scan."""
    return op4_secret_scan(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex")


def shard_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each shard of op8_sharding; bytes of all."""
    out = op8_sharding(spark, sf_dir).groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("slots"), F.max("slot").alias("last"))
    return out.withColumn("shard", F.col("shard").cast("long"))


OPERATORS = (op1_decontaminate, op2_quality_rules, op3_mix_sources, op4_secret_scan, op5_toxicity, op6_token_output, op7_simhash, op8_sharding, op9_pseudonyms, op10_substring_dedup, op11_line_dedup, op12_merkle_manifest, op13_conversation_trie)
QUERIES = {f.__name__: f for f in (*OPERATORS, quality_counts, mix_targets, secret_base_counts, shard_counts)}

_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"


def _counts_sql() -> str:
    """op2's counts: words in windows of three that occur twice are told by place."""
    return f"""WITH w AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents),
 grams AS (SELECT doc_id, p, ws[p : p + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS p FROM w)),
 twice AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
 covered AS (SELECT doc_id, count(DISTINCT i) AS n FROM (SELECT doc_id, unnest(range(p, p + 3)) AS i FROM twice) GROUP BY doc_id),
 lines AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM w)
 SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
 FROM w JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)"""


def _targets_sql(rounds: int = 6) -> str:
    """op3's targets: ``rounds`` rounds of capping and sharing anew, which is as many as sources that one after another overflow."""
    most, weights = mixing.PASSES, mixing.WEIGHTS
    steps = ["s0 AS (SELECT *, false AS capped FROM s)"]
    for i in range(1, rounds + 1):
        left, weight = f"(SELECT sum(size) - coalesce(sum({most} * size) FILTER (WHERE capped), 0) FROM s{i - 1})", f"(SELECT sum(w) FILTER (WHERE NOT capped) FROM s{i - 1})"
        steps.append(f"s{i} AS (SELECT k, size, w, capped OR {left} * w / {weight} > {most} * size AS capped FROM s{i - 1})")
    left, weight = f"(SELECT sum(size) - coalesce(sum({most} * size) FILTER (WHERE capped), 0) FROM s{rounds})", f"(SELECT sum(w) FILTER (WHERE NOT capped) FROM s{rounds})"
    return f"""WITH d AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size FROM documents),
 s AS (SELECT source AS k, sum(size)::BIGINT AS size, [{", ".join(map(str, weights))}][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)}) + 1] AS w FROM d GROUP BY source), {", ".join(steps)}
 SELECT doc_id, d.size, s.size AS source_size, round(CASE WHEN capped THEN {most} * s.size ELSE {left} * w / {weight} END::DOUBLE, 4) AS target FROM d JOIN s{rounds} s ON source IS NOT DISTINCT FROM k"""


_SECRETS_SQL = """SELECT doc_id, len(list_filter(regexp_extract_all(coalesce(text, ''), '(?i:password|passwd|secret|token|api_?key)["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1), lambda x: length(x) >= 6))::BIGINT AS n_assign,
 len(list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 20))::BIGINT AS n_access, len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), lambda x: length(x) >= 24))::BIGINT AS n_hex FROM documents"""
_SHARDS_SQL = f"WITH n AS (SELECT count(*) AS n FROM documents) SELECT i AS shard, n // {sharding.SHARDS} + (i < n % {sharding.SHARDS})::INT AS n, n // {sharding.SHARDS} + (i < n % {sharding.SHARDS})::INT AS slots, n // {sharding.SHARDS} + (i < n % {sharding.SHARDS})::INT - 1 AS last FROM n, (SELECT unnest(range({sharding.SHARDS})) AS i) WHERE i < n"


def _leak_sql() -> str:
    """Verification of every diagonal that shares enough words, without any seeds."""
    alone = "".join(f"\\p{{{x}}}" for x in decontaminate.UNSPACED)
    words = f"list_filter(regexp_split_to_array(regexp_replace(lower(coalesce(text, '')), '([{alone}])', ' \\1 ', 'g'), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
    verify, agree, span = decontaminate.VERIFY, decontaminate.AGREE, decontaminate.SPAN
    return f"""WITH d AS (SELECT doc_id, {words} AS h FROM documents), b AS (SELECT DISTINCT item_id, {words} AS h FROM benchmark),
 dw AS (SELECT doc_id, unnest(h) AS w, unnest(range(len(h))) AS p FROM d), bw AS (SELECT item_id, unnest(h) AS w, unnest(range(len(h))) AS p FROM b),
 near AS (SELECT doc_id, item_id, dw.p - bw.p AS diagonal FROM dw JOIN bw USING (w) JOIN b USING (item_id) GROUP BY ALL HAVING count(*) >= least(any_value(len(b.h)), {math.ceil(span * agree)})),
 beside AS (SELECT near.*, greatest(-diagonal, 0) AS f, d.h AS dh, b.h AS bh FROM near JOIN d USING (doc_id) JOIN b USING (item_id)),
 same AS (SELECT doc_id, item_id, diagonal, least({verify}, len(bh)) AS wide, list_transform(range(f, least(len(bh), len(dh) - diagonal)), lambda j: (dh[diagonal + j + 1] = bh[j + 1])::INT) AS s FROM beside),
 best AS (SELECT doc_id, item_id, diagonal, wide, list_max(list_transform(range(1, len(s) - wide + 2), lambda p: list_sum(s[p : p + wide - 1]))) AS agreeing FROM same)
 SELECT doc_id, item_id, max(agreeing)::BIGINT AS agreeing, arg_max(diagonal, (agreeing, -diagonal))::BIGINT AS doc_place FROM best WHERE agreeing >= CASE WHEN wide < {span} THEN wide ELSE ceil(wide * {agree}) END GROUP BY doc_id, item_id"""


def _substring_sql(window: int = substring_dedup.WINDOW) -> str:
    return f"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
 windows AS (SELECT doc_id, p, md5(array_to_string(ws[p : p + {window - 1}], ' ')) AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {window - 2})) AS p FROM w WHERE len(ws) >= {window})),
 earliest AS (SELECT g, min(doc_id) AS first FROM windows GROUP BY g),
 gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + {window})) AS i FROM windows JOIN earliest USING (g) WHERE first < doc_id),
 each AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
 kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
 SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)"""


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINES_SQL = f"""WITH w AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
 l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS p FROM w),
 k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS k FROM l),
 gone AS (SELECT k FROM k WHERE length(k) >= {line_dedup.MIN_CHARS} GROUP BY k HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_DOCS}),
 m AS (SELECT k.*, gone.k IS NOT NULL AS goes FROM k LEFT JOIN gone USING (k))
 SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE goes)::BIGINT AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT goes), '')) AS kept_sha256 FROM m GROUP BY doc_id"""


def _crc_sql(x: str) -> str:
    """Unsigned crc32 of a number's decimal digits, bit by bit."""
    bits = f"flatten(list_transform(string_split(({x})::VARCHAR, ''), lambda ch: [ord(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295)"


def _merkle_sql(levels: int = 6, top: int = 5, fan: int = merkle.FAN) -> str:
    """The trees level by level, then each leaf's way up; for sources of at most fan ** levels rows."""
    field = lambda v: f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen(({v})::VARCHAR) || ':' || ({v})::VARCHAR END"
    leaf = lambda *v: f"sha256({' || '.join(map(field, v))})"
    lower = f"translate(text, '{_UPPER}', '{_LOWER}')"
    steps = [
        f"l AS (SELECT doc_id, source, {leaf(*merkle.FIELDS)} AS leaf, CASE WHEN {_crc_sql('doc_id')} % {merkle.TAMPER} = 0 THEN {leaf(*merkle.FIELDS[:-1], lower)} ELSE {leaf(*merkle.FIELDS)} END AS fold FROM documents)",
        "p AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM l)",
        "t0 AS (SELECT s, i, leaf AS v, n FROM p)",
    ]
    runs = lambda t, k: f"r{t}{k} AS (SELECT s, i // {fan} AS run, list(v ORDER BY i) AS vs, any_value(n) AS n FROM {t}{k} GROUP BY ALL)"
    above = lambda t, k: f"{t}{k + 1} AS (SELECT s, run AS i, CASE WHEN n = 1 THEN vs[1] ELSE sha256(array_to_string(vs, '')) END AS v, (n + {fan - 1}) // {fan} AS n FROM r{t}{k})"
    for k in range(levels):
        steps += [runs("t", k), above("t", k)]
    steps.append(f"u0 AS (SELECT 0 AS s, s AS i, v, count(*) OVER () AS n FROM t{levels})")
    for k in range(top):
        steps += [runs("u", k), above("u", k)]
    now, at = "p", 0
    steps.append("f0 AS (SELECT doc_id, leaf, s, i, fold, '' AS path FROM p)")
    for t, n, i, tree in (("t", levels, "i", "s"), ("u", top, "s", "0")):
        for k in range(n):
            j = f"({i} // {fan**k} % {fan})"
            one = "array_to_string(list_concat(vs[1:{0}], {1}vs[{0} + 2:]), '')"
            alone, with_own = one.format(j, ""), f"array_to_string(list_concat(list_concat(vs[1:{j}], [fold]), vs[{j} + 2:]), '')"
            steps.append(f"f{at + 1} AS (SELECT doc_id, leaf, f.s, f.i, CASE WHEN r.n = 1 THEN fold ELSE sha256({with_own}) END AS fold, path || CASE WHEN r.n = 1 THEN '' ELSE {alone} END AS path FROM f{at} f JOIN r{t}{k} r ON r.s = {'f.' + tree if tree == 's' else tree} AND r.run = f.{i} // {fan ** (k + 1)})")
            at += 1
    return f"""WITH {", ".join(steps).replace("(i // ", "(f.i // ").replace("(s // ", "(f.s // ")}
 SELECT doc_id, leaf, t{levels}.v AS subroot, u{top}.v AS root, sha256(path) AS proof_sha256, fold AS folded_root, fold = u{top}.v AS verified FROM f{at} JOIN t{levels} USING (s), u{top}"""


_TRIE_SQL = f"""WITH own AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
 convs AS (SELECT DISTINCT conv_id, {_crc_sql("conv_id")} % {conversation_trie.HEADS} AS h, conv_id - conv_id % {conversation_trie.EVERY} AS base FROM own),
 again AS (SELECT c.conv_id, 0 AS part, p, role, text FROM convs c JOIN own o ON o.conv_id = base AND p <= h UNION ALL SELECT conv_id, 1, p, role, text FROM own JOIN convs USING (conv_id) WHERE p > h),
 seqs AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY part, p) FILTER (WHERE p IS NOT NULL) AS seq FROM convs LEFT JOIN again USING (conv_id) GROUP BY conv_id),
 whole AS (SELECT conv_id, coalesce(seq, []) AS seq FROM seqs),
 prefixes AS (SELECT conv_id, d, len(seq) AS n, seq[1:d] AS node FROM (SELECT conv_id, seq, unnest(range(len(seq) + 1)) AS d FROM whole)),
 nodes AS (SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends_sha256 FROM prefixes GROUP BY node, d),
 children AS (SELECT node[1:d - 1] AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
 full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (node)),
 sums AS (SELECT node, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM (SELECT node[1:e] AS node, (n_children = 0)::INT AS leaf, saved FROM (SELECT *, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * length(node[d].text) END AS saved, unnest(range(d + 1)) AS e FROM full_nodes)) GROUP BY node)
 SELECT n.conv_id, n.d::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, n.ends_sha256 FROM full_nodes n JOIN sums ON sums.node = n.node LEFT JOIN nodes u ON n.d > 0 AND u.node = n.node[1:n.d - 1]"""


ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate": _leak_sql(), "op10_substring_dedup": _substring_sql(), "quality_counts": _counts_sql(), "mix_targets": _targets_sql(), "secret_base_counts": _SECRETS_SQL, "shard_counts": _SHARDS_SQL,
    "op11_line_dedup": _LINES_SQL, "op12_merkle_manifest": _merkle_sql(), "op13_conversation_trie": _TRIE_SQL,
}
