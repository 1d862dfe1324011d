"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

A text's features are the distinct 32-bit hashes of its lower-cased words, of pairs of neighbours and of pairs that skip one
word. Each coordinate has its own rate, and L1 keeps the weights sparse: what is trained fits a small broadcast array of
(hash, weight). Training takes at most ``max_train`` labelled rows, the ones with the least hash of doc_id, and of these the
first that have at most MAX_FEATURES features together, so its one task is bounded at every size; features are made in
parallel before. Rows of the held-out part are never looked at. Labels, language, source and doc_id aren't inputs of a score.

Defined cases: an empty or null text scores the intercept alone; a doc_id with several labels counts as toxic if one is 1,
null labels are left out; unless labelled rows of both kinds are there, nothing can be told: every score is 0 and ``clean``
keeps all; repeated rows score alike; a null doc_id is scored and counts as not held out; doc_id may be of any type; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, packed, unpacked, written

#: Most labelled rows that are trained on (in one task, in sequence), and passes over them.
MAX_TRAIN, PASSES = 12_000, 6
#: Most features of all rows that are trained on, four bytes each.
MAX_FEATURES = 60_000_000
ALPHA, BETA, L1, L2 = 3.0, 1.0, 4.0, 0.0
FOLDS = 5
_WORD = re.compile(r"\w+")
REMEMBER = 500_000


class Features:
    """All feature hashes of a text, repeats included."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = _WORD.findall(text.lower()) if text else []
        known = self.known
        if len(known) > REMEMBER:
            known.clear()
        out = [known.get(w) for w in words]
        if None in out:
            for i, x in enumerate(out):
                if x is None:
                    out[i] = known[words[i]] = xxhash.xxh32_intdigest(words[i].encode("utf-8", "surrogatepass"))
        h = np.array(out, np.uint64)
        with np.errstate(over="ignore"):
            pairs = [_mix(h[:-k], h[k:], k) for k in (1, 2)]
        return np.concatenate([h.astype(np.uint32), *pairs])


def _mix(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    x = (a * np.uint64(0x9E3779B97F4A7C15) + b + np.uint64(k)) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


def numbered(every: np.ndarray, step: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes in order, and the number of each hash among them: by one sort of (hash, place) in a word each. The
    numbers are written over the hashes, and all else goes in stretches, so 12 bytes for each hash are the most that is held."""
    keys, flat, names, n = np.empty(len(every), np.uint64), every.view(np.int32), [], 0
    for i in range(0, len(every), step):
        some = every[i : i + step].astype(np.uint64)
        keys[i : i + step] = some << np.uint64(32) | np.arange(i, i + len(some), dtype=np.uint64)
    keys.sort()
    last = None
    for i in range(0, len(keys), step):
        hashes = (keys[i : i + step] >> np.uint64(32)).astype(np.uint32)
        new = np.r_[hashes[0] != last if i else True, hashes[1:] != hashes[:-1]]
        flat[keys[i : i + step] & np.uint64(0xFFFFFFFF)] = n - 1 + np.cumsum(new, dtype=np.int32)
        names.append(hashes[new])
        n, last = n + len(names[-1]), hashes[-1]
    return np.concatenate([*names, np.empty(0, np.uint32)]), flat


def train(rows: list[np.ndarray], labels: np.ndarray, seed: int = 0, passes: int = PASSES) -> tuple[np.ndarray, np.ndarray, float]:
    """FTRL-proximal over rows of distinct features; (hashes, weights, intercept) of the weights that aren't 0."""
    ends = np.cumsum([len(r) for r in rows], dtype=np.int64)
    return train_flat(np.concatenate([*rows, np.empty(0, np.uint32)]), ends - [len(r) for r in rows], ends, labels, seed, passes)


def train_flat(every: np.ndarray, starts: np.ndarray, ends: np.ndarray, labels: np.ndarray, seed: int = 0, passes: int = PASSES, step: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, float]:
    """The same for rows that are stretches of one array of hashes, which is written over."""
    names, flat = numbered(every)
    z, n = np.zeros(len(names) + 1), np.zeros(len(names) + 1)  # the last is the intercept, without L1
    last = len(names)

    def weights(at: np.ndarray | slice) -> np.ndarray:
        zi = z[at]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        w[np.abs(zi) <= L1] = 0.0
        return w

    def intercept() -> float:
        return -z[last] / ((BETA + np.sqrt(n[last])) / ALPHA + L2)

    order = np.random.default_rng(seed)
    for _ in range(passes):
        for i in order.permutation(len(starts)):
            at = flat[starts[i] : ends[i]].astype(np.intp)
            w, w0 = weights(at), intercept()
            g = 1 / (1 + np.exp(-np.clip(w.sum() + w0, -30, 30))) - labels[i]
            before = np.sqrt(n[at])
            n[at] += g * g
            z[at] += g - (np.sqrt(n[at]) - before) / ALPHA * w
            before = np.sqrt(n[last])
            n[last] += g * g
            z[last] += g - (np.sqrt(n[last]) - before) / ALPHA * w0
    kept = [(names[i : i + step][w != 0], w[w != 0]) for i in range(0, last, step) for w in [weights(slice(i, min(i + step, last)))]]
    hashes, own = zip(*kept, strict=True) if kept else ((), ())
    return np.concatenate([*hashes, np.empty(0, np.uint32)]), np.concatenate([*own, np.empty(0)]), float(intercept())


class Model:
    """Sparse weights by sorted hash. Without weights and intercept (None) it knows nothing and scores 0."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray, intercept: float | None):
        order = np.argsort(hashes)
        self.hashes, self.weights, self.intercept = hashes[order], weights[order], intercept
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[self.hashes & 0xFFFF] = True

    @property
    def plain(self) -> tuple[np.ndarray, np.ndarray, float | None]:
        """What a broadcast carries."""
        return self.hashes, self.weights, self.intercept

    def score(self, features: np.ndarray) -> float:
        if self.intercept is None:
            return 0.0
        total = self.intercept
        some = features[self.maybe[features & 0xFFFF]] if len(self.hashes) else features[:0]
        if len(some):
            some = np.unique(some)
            at = np.minimum(np.searchsorted(self.hashes, some), len(self.hashes) - 1)
            total += float(self.weights[at][self.hashes[at] == some].sum())
        return float(1 / (1 + np.exp(-np.clip(total, -500, 500))))


def fold():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, max_features: int = MAX_FEATURES) -> Model:
    known = labels.where("doc_id is not null and toxic is not null").where(fold() != 0)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.join(docs.select("doc_id").where("doc_id is not null").distinct(), "doc_id", "left_semi")
    known = bounded_sample(known, max_train)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # max_train rows at most

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Features()
        for b in batches:
            found = [np.unique(make(t)).view(np.int32) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "toxic", "f"])

    rows = rows.select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"))
    made = written(rows.mapInArrow(features, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, toxic int, f array<int>"), "toxicity-features")
    sizes = made.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.sum(F.size("f")).alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").toPandas()  # max_train rows of numbers
    fit_in = sizes["n"].cumsum() <= max_features
    if sizes["toxic"][fit_in].nunique() < 2:
        return Model(np.empty(0, np.uint32), np.empty(0), None)
    some = made
    if not fit_in.all():
        kept = docs.sparkSession.createDataFrame([(x,) for x in sizes["doc_id"][fit_in].tolist()], docs.select("doc_id").schema)
        some = made.join(F.broadcast(kept), "doc_id", "left_semi")  # max_train ids at most
    total = int(sizes["n"][fit_in].sum())

    def train_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Features are copied into one array as they come, so a batch is the most that is held twice."""
        every, place, ids, toxic, ends = np.empty(total, np.uint32), 0, [], [], []
        for b in batches:
            f = b.column(2)
            own = f.flatten().to_numpy().view(np.uint32)
            every[place : place + len(own)] = own
            ends.append(place + np.cumsum(f.value_lengths().to_numpy(), dtype=np.int64))
            place += len(own)
            ids.append(b.column(0))
            toxic.append(b.column(1).to_numpy())
        if not ids:
            return
        ends = np.concatenate(ends)
        pdf = pd.DataFrame({"doc_id": pa.chunked_array(ids).to_pandas(), "toxic": np.concatenate(toxic), "start": np.r_[0, ends[:-1]], "end": ends})
        pdf = pdf.drop_duplicates("doc_id").sort_values("doc_id")  # a document counts once
        hashes, weights, intercept = train_flat(every, pdf["start"].to_numpy(), pdf["end"].to_numpy(), pdf["toxic"].to_numpy(float))
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[hashes.astype(np.int64), -1]), pa.array(np.r_[weights, intercept])], names=["hash", "weight"])

    trained = some.coalesce(1).mapInArrow(train_all, "hash long, weight double").toPandas()  # sparse weights
    own = trained["hash"].to_numpy() >= 0
    return Model(trained["hash"].to_numpy()[own].astype(np.uint32), trained["weight"].to_numpy(float)[own], float(trained["weight"][~own].sum()))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of docs and ``_score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model.plain)

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        make, own = Features(), Model(*shared.value)
        for part in texts:
            yield pd.Series([own.score(make(t)) for t in part], dtype=float)

    return docs.withColumn("_score", F.pandas_udf(run, "double")(F.col("text")))


def classify(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    out = scored(docs.select("doc_id", "text"), fit(docs, labels, max_train))
    return out.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """docs without the texts that score 0.5 or more; all of them if there is nothing to learn from."""
    mine = packed(docs, text=F.col("text"))
    return unpacked(scored(mine, fit(docs, labels, max_train)).where("_score < 0.5"), docs.columns)
