"""Quality rules: gradient-boosted trees over document statistics, scored from flat numpy node arrays.

Statistics are counted over whole texts, in one pass. The trees are grown from histograms on at most ``max_train`` labelled rows of
numbers, with monotonic constraints: more symbols, more duplicate lines or more repeated words never raise the quality. A
split that would break a constraint is refused, and the values of later splits are kept on their side of the middle. All
trees lie in four arrays (feature, threshold, children, value), and a batch walks them level by level.

Defined cases: a null text has no words; a text without words has all statistics 0; a doc_id with several labels takes the
least quality; null labels are left out; without labelled rows of both kinds the trees keep everything that passes the base
rules; repeated rows have equal results; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, split_words, written

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Further statistics, and for each statistic the sign of its effect on quality (0: any).
RATIOS = {"mean_word": 0, "symbols": -1, "dup_lines": -1, "repeats": -1, "upper": 0, "marks": 0, "digits": 0, "distinct": 0, "words_a_line": 0, "log_words": 0, "ends": 0}
MAX_TRAIN, TREES, DEPTH, BINS, RATE, L2, LEAST = 20_000, 60, 4, 32, 0.2, 1.0, 8
_SYMBOLS, _MARKS, _DIGITS = b"#*$%&|<>", b"!?;:", b"0123456789"
_UPPER = bytes(range(65, 91))


def statistics(raw: bytes | None) -> tuple:
    """The five counts and then the ratios of a text."""
    raw = raw or b""
    words = split_words(raw)
    n = len(words)
    if not n:
        return (0,) * len(COUNTS) + (0.0,) * len(RATIOS)
    chars = sum(map(len, words)) - (0 if raw.isascii() else sum(0x80 <= c < 0xC0 for w in words if not w.isascii() for c in w))
    size = len(raw)
    symbols = size - len(raw.translate(None, _SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip(b" \t\n\r\x0b\x0c")]
    dup = len(lines) - len(set(lines))
    code: dict[bytes, int] = {}
    ids = np.array([code.setdefault(w, len(code)) for w in words], np.int64)
    repeats = 0
    if n >= 3:
        base = len(code)
        keys = (ids[:-2] * base + ids[1:-1]) * base + ids[2:] if base < 2_000_000 else _row_ids(ids)
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        twin = ranked[1:] == ranked[:-1]
        if twin.any():
            hit = np.zeros(n, bool)
            at = order[np.r_[twin, False] | np.r_[False, twin]]
            hit[at] = hit[at + 1] = hit[at + 2] = True
            repeats = int(hit.sum())
    share = lambda chosen: (size - len(raw.translate(None, chosen))) / size
    ratios = (chars / n, symbols / n, dup / len(lines), repeats / n, share(_UPPER), share(_MARKS), share(_DIGITS), len(code) / n, n / len(lines), float(np.log1p(n)), sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines) / len(lines))
    return (n, chars, symbols, dup, repeats, *ratios)


def _row_ids(ids: np.ndarray) -> np.ndarray:
    """A number for each 3-word window, where products of ids would overflow."""
    return np.unique(np.stack([ids[:-2], ids[1:-1], ids[2:]], axis=1), axis=0, return_inverse=True)[1].ravel()


def counted(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep columns, the counts and the ratios, one row for each row of docs."""
    k = len(keep)
    names = [*COUNTS, *RATIOS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = list(zip(*(statistics(x.as_py()) for x in b.column(k)), strict=True)) or [()] * len(names)
            kinds = [pa.int64()] * len(COUNTS) + [pa.float64()] * len(RATIOS)
            yield pa.RecordBatch.from_arrays([*b.columns[:k], *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], names=[*keep, *names])

    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), *(f"{c} long" for c in COUNTS), *(f"{c} double" for c in RATIOS)])
    return docs.select(*keep, F.col("text").cast("binary").alias("raw")).mapInArrow(run, schema)


@dataclass
class Trees:
    """Nodes of all trees one after another: a leaf has feature -1 and is its own child."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(DEPTH):
                f = self.feature[at]
                inner = f >= 0
                low = x[np.arange(len(x)), np.maximum(f, 0)] <= self.threshold[at]
                at = np.where(inner, np.where(low, self.left[at], self.right[at]), at)
            out += self.value[at]
        return out


def grow(x: np.ndarray, y: np.ndarray, signs: np.ndarray, trees: int = TREES) -> Trees:
    """Boosted trees for the logistic loss; signs: -1, 0 or 1 for each feature."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    n, k = x.shape
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    nodes: dict[str, list] = {c: [] for c in ("feature", "threshold", "left", "right", "value")}
    roots, margin = [], np.full(n, base)

    def node(value: float) -> int:
        i = len(nodes["value"])
        for c, v in (("feature", -1), ("threshold", 0.0), ("left", i), ("right", i), ("value", value)):
            nodes[c].append(v)
        return i

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        root = node(0.0)
        roots.append(root)
        open_nodes = [(root, np.arange(n), -np.inf, np.inf)]
        for depth in range(DEPTH + 1):
            deeper = []
            for i, rows, lo, hi in open_nodes:
                g0, h0 = g[rows].sum(), h[rows].sum()
                own = float(np.clip(g0 / (h0 + L2), lo, hi))
                nodes["value"][i] = RATE * own
                if depth == DEPTH:
                    margin[rows] += RATE * own
                    continue
                flat = (binned[rows] + np.arange(k) * BINS).ravel()
                sums = [np.bincount(flat, np.repeat(v[rows], k) if v is not None else None, k * BINS).reshape(k, BINS).cumsum(axis=1)[:, :-1] for v in (g, h, None)]
                gl, hl, cl = sums
                gr, hr, cr = g0 - gl, h0 - hl, len(rows) - cl
                vl, vr = np.clip(gl / (hl + L2), lo, hi), np.clip(gr / (hr + L2), lo, hi)
                gain = gl * vl - (hl + L2) * vl**2 / 2 + gr * vr - (hr + L2) * vr**2 / 2 - (g0 * own - (h0 + L2) * own**2 / 2)
                gain[(cl < LEAST) | (cr < LEAST) | (signs[:, None] * (vr - vl) < 0)] = 0
                for f in range(k):
                    gain[f, len(edges[f]) :] = 0
                f, b = np.unravel_index(np.argmax(gain), gain.shape)
                if gain[f, b] <= 1e-6:
                    margin[rows] += RATE * own
                    continue
                middle = (vl[f, b] + vr[f, b]) / 2
                low = binned[rows, f] <= b
                nodes["feature"][i], nodes["threshold"][i] = int(f), float(edges[f][b])
                a, c = nodes["left"][i], nodes["right"][i] = node(0.0), node(0.0)
                s = signs[f]
                deeper.append((a, rows[low], middle if s < 0 else lo, middle if s > 0 else hi))
                deeper.append((c, rows[~low], middle if s > 0 else lo, middle if s < 0 else hi))
            open_nodes = deeper
    kinds = {"feature": np.int64, "threshold": float, "left": np.int64, "right": np.int64, "value": float}
    return Trees(*(np.array(nodes[c], kinds[c]) for c in ("feature", "threshold", "left", "right", "value")), np.array(roots), base)


def fit(stats: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Trees:
    """Trees from at most max_train labelled rows of statistics, the ones with the least hash of doc_id."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("_quality"))
    known = bounded_sample(known.join(stats.select("doc_id").distinct(), "doc_id", "left_semi"), max_train)
    rows = stats.join(F.broadcast(known), "doc_id").groupBy("doc_id", "_quality").agg(*(F.min(c).alias(c) for c in RATIOS))
    rows = rows.toPandas().sort_values("doc_id")  # max_train rows of numbers at most
    x, y = rows[list(RATIOS)].to_numpy(float), rows["_quality"].to_numpy(float)
    if len(set(y)) < 2:
        return Trees(*(np.array([v]) for v in (-1, 0.0, 0, 0, 0.0)), np.array([0]), 1.0)
    return grow(x, y, np.array(list(RATIOS.values())))


def judged(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, the counts, base_failed, kept, score for every row of docs."""
    stats = written(counted(docs), "quality-stats")
    shared = docs.sparkSession.sparkContext.broadcast(astuple(fit(stats, labels, max_train)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = Trees(*shared.value)
        for b in batches:
            x = np.stack([b.column(c).to_numpy() for c in RATIOS], axis=1)
            score = 1 / (1 + np.exp(-trees.margin(x)))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", *COUNTS)), pa.array(score)], names=["doc_id", *COUNTS, "score"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in COUNTS) + ", score double"
    out = stats.mapInArrow(run, schema)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select("doc_id", *COUNTS, failed.alias("base_failed"), (~failed & (F.col("score") >= 0.5)).alias("kept"), "score")
