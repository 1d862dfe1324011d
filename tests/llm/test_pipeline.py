"""The pipeline against a brute-force form of each stage, on a small table with planted cases."""

import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as P
from claimgrid.llm.common import table
from claimgrid.llm.queries import tokenizer_path

from . import samples as S


@pytest.fixture(scope="module")
def planted(spark, sf_dir, tmp_path_factory):
    """The smallest tables, and in documents also: exact copies, near copies, a leak, toxic texts, nulls and empty texts."""
    root = str(tmp_path_factory.mktemp("planted"))
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    item = bench.where("item_id = 1").first().text
    base = S.long_text("clean", 300)
    words = base.split()
    near = " ".join(["changed" if i == 150 else w for i, w in enumerate(words)])
    rows = [(100_000, base), (100_001, base), (100_002, near), (100_003, S.long_text("l", 80) + " " + item), (100_004, S.long_text("t", 90) + " idiot moron trash clown scum stupid loser pathetic"), (100_005, None), (100_006, ""), (100_007, S.long_text("own", 200))]
    more = spark.createDataFrame([(i, t, "en", None if i % 2 else "src0", None if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.unionByName(more).write.parquet(f"{root}/documents.parquet")
    bench.write.parquet(f"{root}/benchmark.parquet")
    table(spark, sf_dir, "labels").write.parquet(f"{root}/labels.parquet")
    return root


def test_stages(spark, planted, tmp_path):
    docs = table(spark, planted, "documents")
    columns, kept = docs.columns, {}
    for name, stage in P.STAGES:
        stage(spark, docs, planted).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "tokens":
            assert docs.columns == columns
            kept[name] = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    every = [(r.doc_id, r.text, r.source) for r in table(spark, planted, "documents").collect()]
    # toxicity: the planted toxic text goes, the planted clean ones stay
    ids = {i for i, _, _ in kept["toxicity"]}
    toxic = {r.doc_id for r in table(spark, planted, "labels").where("toxic = 1").collect()}
    assert ids >= {100_000, 100_001, 100_002, 100_003, 100_005, 100_006, 100_007} and set(kept["toxicity"]) <= set(every)
    clean = {i for i, _, _ in every} - toxic
    assert len(ids & clean) / len(clean) > 0.95
    # near copies: brute-force components, the least doc_id of each
    fps = {i: S.simhash(t) for i, t, _ in kept["toxicity"]}
    order = sorted(fps)
    v = np.array([fps[i] for i in order], np.uint64)
    a, b = np.nonzero(np.bitwise_count(v[:, None] ^ v[None, :]) <= 3)
    root = S.components(order, [(order[x], order[y]) for x, y in zip(a, b, strict=True) if x < y])
    assert sorted(i for i, _, _ in kept["simhash"]) == sorted(set(root.values()))
    assert {100_000, 100_007} <= set(root.values()) and not {100_001} & set(root.values())
    # leaks: texts that hold a whole item go, texts that share no nine words in a row stay
    cut = lambda t: __import__("re").findall(r"[^\W_]+", (t or "").lower())
    items = [cut(r.text) for r in table(spark, planted, "benchmark").collect()]
    grams = {tuple(x[p : p + 3]) for x in items for p in range(len(x) - 2)}
    left = {i for i, _, _ in kept["decontamination"]}
    for i, t, _ in kept["simhash"]:
        flat = " " + " ".join(cut(t)) + " "
        if any(" " + " ".join(x) + " " in flat for x in items if len(x) >= 9):
            assert i not in left
        elif not any(tuple(cut(t)[p : p + 3]) in grams for p in range(len(cut(t)) - 2)):
            assert i in left
    assert 100_003 not in left and 100_007 in left
    # mixing: whole copies of what was kept, 3 at most, near the targets
    copies = Counter(i for i, _, _ in kept["mixing"])
    sizes = {i: len(S.words(t)) for i, t, _ in kept["decontamination"]}
    assert set(copies) <= set(sizes) and max(copies.values()) <= 3
    total, taken = sum(sizes.values()), sum(sizes[i] * n for i, n in copies.items())
    assert 0 < taken <= total * 1.1
    # tokens: what the library gives for each row, one after another
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    text = {i: t for i, t, _ in kept["mixing"]}
    ids = {i: [*tok.encode(t or "", add_special_tokens=False).ids, 2] for i, t in text.items()}
    rows = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/tokens").collect()), key=lambda r: r[1])
    start, want = 0, []
    for i in sorted(copies):
        for _ in range(copies[i]):
            want.append((i, start, len(ids[i]), zlib.crc32(np.array(ids[i], "<u4").tobytes())))
            start += len(ids[i])
    assert rows == want
    assert sorted(map(tuple, P.run(spark, planted).collect()), key=lambda r: r[1]) == want


def test_pipeline_of_nothing_and_of_little(spark, sf_dir, tmp_path):
    """Empty tables give empty results; without labels and items nothing is dropped but copies; clashing names stay."""
    def tables(root, docs, labels, bench):
        docs.write.parquet(f"{root}/documents.parquet")
        labels.write.parquet(f"{root}/labels.parquet")
        bench.write.parquet(f"{root}/benchmark.parquet")
        return str(root)

    docs = S.table(spark, [S.long_text("a", 80), S.long_text("b", 70), None, "", S.long_text("a", 80)], ids=[1, 2, 3, None, 5], sources=["x", None, "x", "y", "x"])
    docs = docs.withColumnsRenamed({"extra": "_h", "h": "_score", "key": "_copies", "fp": "_n", "place": "_size"})
    labels, bench = table(spark, sf_dir, "labels").limit(0), table(spark, sf_dir, "benchmark").limit(0)
    none = tables(tmp_path / "none", docs.limit(0), labels, bench)
    assert P.run(spark, none).count() == 0
    little = tables(tmp_path / "little", docs, labels, bench)
    now = table(spark, little, "documents")
    for i, (name, stage) in enumerate(P.STAGES[:-1]):
        stage(spark, now, little).write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        assert now.columns == docs.columns
        if i < 3:
            assert now.count() == (5 if i == 0 else 3)  # the copy, and the second of the texts without words
    assert P.run(spark, little).count() == now.count() > 0
