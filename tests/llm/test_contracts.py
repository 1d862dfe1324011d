"""The queries against brute force on whole tables."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from claimgrid.llm import queries
from claimgrid.llm.common import table

from . import samples as S


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return sorted((r.doc_id, r.text, r.source) for r in table(spark, sf_dir, "documents").select("doc_id", "text", "source").collect())


def test_op2(spark, sf_dir, docs):
    rows = {r.doc_id: r for r in queries.op2_quality_rules(spark, sf_dir).collect()}
    assert len(rows) == len(docs)
    for i, t, _ in docs:
        n, chars, symbols, dup, repeats = S.quality_counts(t)
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeats)
        assert r.base_failed == (n < 50 or 100 * repeats > 50 * n)
        assert not (r.kept and r.base_failed)
    good = {r.doc_id: r.quality for r in table(spark, sf_dir, "labels").collect()}
    judged = [(good[i], rows[i].kept) for i in good if not rows[i].base_failed]
    assert np.mean([bool(q) == k for q, k in judged]) > 0.95


def test_op3(spark, sf_dir, docs):
    rows = {r.doc_id: r for r in queries.op3_mix_sources(spark, sf_dir).collect()}
    again = {r.doc_id: r for r in queries.op3_mix_sources(spark, sf_dir).collect()}
    assert rows == again and len(rows) == len(docs)
    sizes, taken, largest = Counter(), Counter(), Counter()
    for i, t, s in docs:
        n = len(S.words(t))
        assert rows[i].size == n and rows[i].taken <= 3 * n
        sizes[s] += n
        taken[s] += rows[i].taken
        largest[s] = max(largest[s], n)
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    left, free, goal = float(sum(sizes.values())), set(order), {}
    while free:
        over = [s for s in free if left * weight[s] / sum(weight[x] for x in free) > 3 * sizes[s]]
        if not over:
            goal |= {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
            break
        goal |= {s: 3.0 * sizes[s] for s in over}
        left -= sum(goal[s] for s in over)
        free -= set(over)
    for i, _, s in docs:
        assert rows[i].source_size == sizes[s] and math.isclose(rows[i].target, goal[s], rel_tol=1e-9)
    for s in order:
        assert abs(taken[s] - goal[s]) <= largest[s] / 2 + 1


def test_op4(spark, sf_dir, docs):
    rows = {r.doc_id: r for r in queries.op4_secret_scan(spark, sf_dir).collect()}
    for i, t, _ in docs:
        r = rows[i]
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == S.secret_base(t)
        base = ",".join(x for x in r.spans.split(",") if x and not x.startswith("guess"))
        assert hashlib.sha256(base.encode()).hexdigest() == r.base_sha256


def test_op5(spark, sf_dir, docs):
    rows = {r.doc_id: r for r in queries.op5_toxicity(spark, sf_dir).collect()}
    toxic = {r.doc_id: r.toxic for r in table(spark, sf_dir, "labels").collect()}
    assert len(rows) == len(docs)
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    right = [rows[i].predicted == y for i, y in toxic.items() if rows[i].held_out]
    assert np.mean(right) > 0.85


def test_op6(spark, sf_dir, docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_path())
    rows = {r.doc_id: r for r in queries.op6_token_output(spark, sf_dir).collect()}
    start = 0
    for i, t, _ in docs:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_op7(spark, sf_dir, docs):
    rows = {r.doc_id: r for r in queries.op7_simhash(spark, sf_dir).collect()}
    fps = {i: S.simhash(t) for i, t, _ in docs}
    ids = sorted(fps)
    v = np.array([fps[i] for i in ids], np.uint64)
    a, b = np.nonzero(np.bitwise_count(v[:, None] ^ v[None, :]) <= 3)
    root = S.components(ids, [(ids[x], ids[y]) for x, y in zip(a, b, strict=True) if x < y])
    assert {i: (r.fingerprint, r.component_id) for i, r in rows.items()} == {i: (f"{fps[i]:016x}", root[i]) for i in ids}


def test_op8(spark, sf_dir, docs):
    rows = {r.doc_id: r for r in queries.op8_sharding(spark, sf_dir).collect()}
    slots = defaultdict(list)
    for i, t, _ in docs:
        r = rows[i]
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len((t or "").encode()) + 16, S.crc(t), "rows", None)
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(40))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_op9(spark, sf_dir, docs):
    """Values that simple layouts of our own find are replaced in place, one to one over all documents; nothing else of a text
    changes; the way back is exact."""
    import datetime
    import re

    from claimgrid.llm import pii

    spark.conf.set(pii.KEY_SETTING, "of the tests")
    out = queries.op9_pseudonyms(spark, sf_dir)
    rows = {r.doc_id: r for r in out.collect()}
    assert len(rows) == len(docs)
    luhn = lambda d: sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(d))) % 10 == 0
    simple = {
        "email": (r"(?<![\w.+%-])[a-z0-9.]+@[a-z0-9]+\.[a-z]+(?![\w.-])", lambda v: True),
        "ip": (r"(?<![\w.])\d+\.\d+\.\d+\.\d+(?![\w.])", lambda v: all(int(x) < 256 and str(int(x)) == x for x in v.split("."))),
        "card": (r"(?<![\w-])\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}(?![\w -])", lambda v: luhn(re.sub(r"\D", "", v))),
        "date": (r"(?<![\w./-])\d{4}-\d\d-\d\d(?![\w./-])", lambda v: bool(datetime.date.fromisoformat(v))),
    }
    pairs, changed = {}, 0
    for i, t, _ in docs:
        text, n = rows[i].text, rows[i].n_values
        assert (text == t) == (n == 0)
        changed += n > 0
        old_words, new_words = ([(m.start(), m.end()) for m in re.finditer(r"\S+", x or "")] for x in (t, text))
        assert len(old_words) == len(new_words)
        for kind, (layout, valid) in simple.items():
            for m in re.finditer(layout, t or ""):
                try:
                    if not valid(m[0]):
                        continue
                except ValueError:
                    continue
                first = next(k for k, (_, e) in enumerate(old_words) if e > m.start())
                last = next(k for k, (_, e) in enumerate(old_words) if e >= m.end())
                new = text[new_words[first][0] + m.start() - old_words[first][0] : new_words[last][1] - (old_words[last][1] - m.end())]
                assert new != m[0] and re.fullmatch(layout, new) and valid(new), (m[0], new)
                plain = re.sub(r"[ -]", "", new) if kind == "card" else new
                assert pairs.setdefault((kind, re.sub(r"[ -]", "", m[0]) if kind == "card" else m[0]), plain) == plain
    assert changed and len({(k, v) for (k, _), v in pairs.items()}) == len(pairs) > 2
    back = {r.doc_id: r.text for r in pii.restore(out.select("doc_id", "text"), "of the tests").collect()}
    assert back == {i: t for i, t, _ in docs}


def test_op10(spark, sf_dir, docs):
    rows = {(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in queries.op10_substring_dedup(spark, sf_dir).collect()}
    assert rows == set(S.substring_digest([(i, t) for i, t, _ in docs]))


def test_op1(spark, sf_dir, docs):
    """Whole passages are found, and nothing is that brute-force alignment doesn't confirm."""
    import re

    cut = lambda t: [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w]
    items = {r.item_id: cut(r.text) for r in table(spark, sf_dir, "benchmark").collect()}
    found = {(r.doc_id, r.item_id): r for r in queries.op1_decontaminate(spark, sf_dir).collect()}
    for i, t, _ in docs:
        w = cut(t)
        flat = " " + " ".join(w) + " "
        for k, item in items.items():
            if " " + " ".join(item) + " " in flat:
                assert (i, k) in found
            if (i, k) in found:
                r = found[i, k]
                same = [0 <= r.doc_place + j < len(w) and w[r.doc_place + j] == x for j, x in enumerate(item)]
                n = min(16, len(item))
                assert max(sum(same[p : p + n]) for p in range(len(item) - n + 1)) == r.agreeing >= 0.8 * n
    assert found
