"""Line dedup, the Merkle manifest and the conversation trie against brute force, and in the odd cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimgrid.llm import conversation_trie, line_dedup, merkle, queries, scans
from claimgrid.llm.common import table, written

from . import samples as S

CLASH = ["_id", "_mark", "_text", "mark", "place", "h1", "row", "leaf", "tree", "number", "at", "t", "digest", "_p", "rep", "s", "f"]


@pytest.fixture()
def spread(spark):
    """Many partitions of few rows, in small batches, so that runs go over from one to the next."""
    changed = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "9", "spark.sql.execution.arrow.maxRecordsPerBatch": "3"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def lines(docs, **how):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.digests(docs, **how).collect()), key=repr)


def test_op11(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").select("doc_id", "text").orderBy("doc_id").collect()]
    got = sorted(map(tuple, queries.op11_line_dedup(spark, sf_dir).collect()))
    assert got == sorted(S.line_digest(docs)) and any(r[2] for r in got)


def test_lines_odd(spread):
    texts = [None, "", "\n\n", " \tHead \r\nbody", "head\nbody\nHEAD", "ÄÖ\nhead", "\x1chead", "head\n" * 50, S.long_text("a", 9000) + "\nhead", "x\nhead", "x\nhead", "é\nhead"]
    ids = [None, 0, 1, 2, 3, 4, 5, 6, 7, 8, 8, None]
    docs = S.table(spread, texts, ids).withColumns({c: F.lit("z") for c in CLASH})
    distinct = [x for n, x in enumerate(zip(ids, texts, strict=True)) if x not in list(zip(ids, texts, strict=True))[:n]]
    for least in (1, 2, 7, 8, 20):
        want = S.line_digest(distinct, least)
        want.append(next(w for w in want if w[0] == 8))
        assert lines(docs, min_docs=least) == sorted(want, key=repr), least
    assert lines(docs.limit(0)) == []
    out = line_dedup.dedup(docs, min_docs=8)
    assert out.columns == docs.columns
    kept = {r.doc_id: r.text for r in out.collect() if r.doc_id is not None}
    assert kept[0] == "" and kept[3] == "head\nbody\nHEAD" and out.where("text is null").count() == 1
    assert {r.doc_id: r.text for r in line_dedup.dedup(docs, min_docs=7).collect()}[3] == "body"


def test_lines_keep_first(spread):
    """One line in every document, one in half of them: the first occurrences stay, wherever partitions end."""
    texts = [("all\n" if i % 3 else "All \n\n") + f"own {i}" + ("\nhalf" if i % 2 else "") + "\nall" for i in range(120)]
    docs = S.table(spread, texts)
    for how in ({}, {"min_docs": 61}, {"min_docs": 2, "keep_first": True}, {"min_docs": 60, "keep_first": True}):
        assert lines(docs, **how) == sorted(S.line_digest(list(enumerate(texts)), **({"min_docs": 10} | how)), key=repr), how


def test_bitmaps_are_compressed(spark):
    texts = [f"own {i}\n" + "same\n" * 20_000 for i in range(12)]
    rows = line_dedup.bitmaps(S.table(spark, texts)).collect()
    assert len(rows) == 12 and all(r.n_dropped == 20_000 and len(r.bitmap) < 100 for r in rows)
    keep = line_dedup.unpack(rows[0].bitmap, 20_002)
    assert keep[0] and not keep[1:-1].any() and keep[-1]


def trees(docs, **how):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in merkle.manifest(docs, **how).collect()), key=repr)


def test_op12(spark, sf_dir):
    docs = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = sorted((tuple(r) for r in queries.op12_merkle_manifest(spark, sf_dir).collect()), key=repr)
    assert got == sorted(S.merkle(docs), key=repr) and {r[-1] for r in got} == {True, False}


def rows_of(docs):
    return [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_merkle_odd(spread):
    texts, ids = S.ODD + ["Upper", "UPPER"] + [f"T{i}" for i in range(300)], [None, 0, 1, 2, 3, 3, 4, 5, 6, 6, 9, 9, *range(100, 400)]
    sources = [None, "", "a", "a", None, None, "ä", "Z", "b", "b", "c", "c", *["hot"] * 257, *[f"s{i}" for i in range(43)]]
    docs = S.table(spread, texts, ids, sources).withColumns({c: F.lit("z") for c in CLASH})
    assert trees(docs, tamper=5) == sorted(S.merkle(rows_of(docs)), key=repr)
    assert all(r[-1] for r in trees(docs))
    assert trees(docs.limit(0)) == []
    alone = docs.where("doc_id = 9 and text = 'Upper'")
    assert [(r[1], r[2], r[3], r[4]) for r in trees(alone)] == [(x, x, x, S.sha("")) for x in [trees(alone)[0][1]]]
    one = docs.where("source = 'hot'")
    assert trees(one, tamper=5) == sorted(S.merkle(rows_of(one)), key=repr)


def test_proofs_fold_by_themselves(spark):
    """Whoever has a leaf, its places in its runs and the listed siblings comes to the root."""
    docs = S.table(spark, [f"text {i}" for i in range(40)], sources=["a"] * 40)
    rows = {r.doc_id: r for r in merkle.manifest(docs).collect()}
    for i, r in rows.items():
        v, rest = r.leaf, list(r.proof)
        for n, at in ((40, i), (3, i // 16)):
            lo = at // 16 * 16
            beside, rest = rest[: min(16, n - lo) - 1], rest[min(16, n - lo) - 1 :]
            v = S.sha(*beside[: at - lo], v, *beside[at - lo :])
        assert not rest and v == r.root == r.subroot


def nodes(conversations, **how):
    out = conversation_trie.trie(*conversation_trie.rebuilt(conversation_trie.turns(conversations)), **how)
    return sorted(map(tuple, out.collect()), key=repr)


def test_op13(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, queries.op13_conversation_trie(spark, sf_dir).collect()), key=repr) == sorted(S.trie(rows), key=repr)


TALKS = "conv_id long, turn long, role string, text string"


def test_trie_odd(spread):
    rng = np.random.default_rng(3)
    rows = [(None, 0, "user", "none"), (7, None, None, None), (7, 1, "user", "b"), (7, 1, "user", "a"), (7, 1, "user", "a"), (8, 0, "us", "erx"), (8, 1, "user", ""), (-203, 4, "user", "é" * 9), (-203, 2, "a", "bc"), (-200, 2, "ab", "c")]
    for c in [*range(100, 130), *range(200, 230)]:
        rows += [(c, t, "user", f"say {rng.integers(2)}") for t in range(int(rng.integers(1, 9)))]
    rows += [(500, t, "user", f"long {t}") for t in range(90)] + [(501, t, "user", f"long {t}") for t in range(90)]
    talks = spread.createDataFrame(rows, TALKS).withColumns({c: F.lit("z") for c in CLASH})
    want = sorted(S.trie(rows), key=repr)
    assert nodes(talks) == want
    assert nodes(talks, bits=5) == want  # nearly all prefixes collide with others
    assert nodes(talks.limit(0)) == [] and nodes(talks.where("conv_id is null")) == []


def test_same_turns_below_different_ones(spark):
    """Collided prefixes with equal turns below: the difference goes down with them."""
    own = [(c, p, 0 if p else c * 1000, bytes([c if p == 0 else 77] * 32), 1) for c in range(40) for p in range(6)]
    df = spark.createDataFrame(own, "conv_id long, place long, t long, digest binary, chars long")
    out = conversation_trie.trie(df, bits=1).collect()
    assert len(out) == 1 + 40 * 6 and max(r.n_convs for r in out if r.depth) == 1


def test_scan_over_partitions(spread):
    """Running sums and places of runs that lie in many partitions."""
    rng = np.random.default_rng(2)
    rows = [(int(k), i, int(rng.integers(-(2**62), 2**62))) for i, k in enumerate(np.sort(rng.choice([1, 5, 6, 9], 400, p=[0.02, 0.9, 0.02, 0.06])))]
    placed = scans.placed(written(spread.createDataFrame(rows, "k long, i long, v long"), "rows"), "k", "i")
    assert placed.select("_p").distinct().count() > 5
    values = lambda b, place: [scans.numbers(b, "v").view(np.uint64)]
    states = scans.run_states(scans.noted(placed, scans.run_notes("k", values)))

    def step(batches, carry):
        import pyarrow as pa

        walk = scans.Walk(batches, "k", carry[0], carry[1])
        for b in walk:
            total = walk.running(0, values(b, None)[0])
            yield pa.RecordBatch.from_arrays([b.column("i"), pa.array(walk.place), pa.array(total.view(np.int64)), pa.array(walk.followed)], names=["i", "place", "total", "followed"])

    got = {r.i: (r.place, r.total, r.followed) for r in scans.carried(placed, step, "i long, place long, total long, followed boolean", states).collect()}
    place, total, want = {}, {}, {}
    for n, (k, i, v) in enumerate(rows):
        place[k], total[k] = place.get(k, -1) + 1, total.get(k, 0) + v
        want[i] = (place[k], (total[k] + 2**63) % 2**64 - 2**63, n + 1 < len(rows) and rows[n + 1][0] == k)
    assert got == want
