"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Texts are lower-cased and cut into the distinct character n-grams of 3 to 5 code points inside
words (with their borders), hashed into 2**18 features. From labelled texts, the log-count ratio
of each feature is r = log((p + a) / |p|) / ((q + a) / |q|)) over toxic and clean documents; the
classifier is a logistic regression on x * r, fitted by full-batch gradient steps with momentum.
Only the product of weight and ratio is kept, so scoring is one table lookup per n-gram.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, mix64, tidy

FEATURES = 1 << 18
ORDERS = (3, 4, 5)
#: Most labelled rows of each class that the fit uses (those with the smallest hash of the id).
FIT_ROWS_PER_CLASS = 1500
#: Code points of whole texts handled at once, each of which takes some 100 bytes meanwhile; a longer text is one chunk.
CHUNK = 1 << 17
THRESHOLD = 0.7
_SEP = 32


def _code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts, each between two spaces, and where each text starts."""
    joined = [" " + t.lower() + " " for t in texts]
    points = np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return points, np.concatenate([[0], np.cumsum([len(t) for t in joined])])


def hashed_ngrams(points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order the start positions and features of the n-grams that span no word border."""
    wide = points.astype(np.uint64)
    gap = (points <= _SEP) | (points == 0xA0)
    inner = np.concatenate([[0], np.cumsum(gap)])
    wide[gap] = _SEP
    with np.errstate(over="ignore"):
        for n in ORDERS:
            count = len(points) - n + 1
            if count <= 0:
                continue
            # borders may stand first or last, not in between
            keep = np.flatnonzero(inner[n - 1 : n - 1 + count] - inner[1 : 1 + count] == 0)
            h = np.full(len(keep), n, dtype=np.uint64)
            for j in range(n):
                h = h * np.uint64(0x100000001B3) + wide[keep + j]
            yield keep, (mix64(h) >> np.uint64(46)).astype(np.int64)


def _chunks(texts: list[str]) -> Iterator[list[int]]:
    some, size = [], 0
    for i, t in enumerate(texts):
        some.append(i)
        size += len(t)
        if size >= CHUNK:
            yield some
            some, size = [], 0
    if some:
        yield some


def feature_sets(texts: list[str], useful: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """The distinct features of each text; with ``useful``, only those it marks."""
    for some in _chunks(texts):
        points, starts = _code_points([texts[i] for i in some])
        keys = []
        for at, f in hashed_ngrams(points):
            if useful is not None:
                hit = useful[f]
                at, f = at[hit], f[hit]
            doc = np.searchsorted(starts, at, side="right") - 1
            keys.append(doc * FEATURES + f)
        found = np.unique(np.concatenate(keys)) if keys else np.empty(0, dtype=np.int64)
        cut = np.searchsorted(found, np.arange(len(some) + 1) * FEATURES)
        for k in range(len(some)):
            yield found[cut[k] : cut[k + 1]] - k * FEATURES


def fit(sets: list[np.ndarray], toxic: np.ndarray, steps: int = 150, penalty: float = 3e-4, rate: float = 2.0) -> tuple[np.ndarray, np.ndarray, float]:
    """Features, their weights (classifier weight times log-count ratio) and the bias.

    Without both classes nothing tells them apart: the weights are empty and the bias is zero.
    """
    y = np.asarray(toxic, dtype=np.float64)
    if len(y) == 0 or y.min() == y.max():
        return np.empty(0, dtype=np.int64), np.empty(0), 0.0
    # a set's features are distinct, so it adds one to each
    p, q = np.full(FEATURES, 0.5), np.full(FEATURES, 0.5)
    for s, label in zip(sets, y):
        (p if label else q)[s] += 1
    r = np.log(p / (y.sum() + 1)) - np.log(q / ((1 - y).sum() + 1))
    # features that say next to nothing only add noise from long texts
    seen = np.flatnonzero((p + q - 1 >= 3) & (np.abs(r) >= np.log(3)) & (p + q >= 6))
    r = r[seen]
    position = np.full(FEATURES, -1, dtype=np.int32)
    position[seen] = np.arange(len(seen))
    kept = [at[at >= 0] for at in (position[s] for s in sets)]
    flat, doc = np.concatenate(kept), np.repeat(np.arange(len(kept), dtype=np.int32), [len(at) for at in kept])
    x = r[flat]
    balance = np.where(y == 1, 0.5 / max(1.0, y.sum()), 0.5 / max(1.0, (1 - y).sum()))
    w, v, bias, bias_v = np.zeros(len(seen)), np.zeros(len(seen)), 0.0, 0.0
    scale = 1.0 / max(1.0, np.bincount(doc, weights=x * x, minlength=len(y)).max())
    for _ in range(steps):
        z = np.bincount(doc, weights=w[flat] * x, minlength=len(y)) + bias
        g = balance * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        grad = np.bincount(flat, weights=x * g[doc], minlength=len(seen)) + penalty * scale * w
        v = 0.9 * v - rate * scale * 40 * grad
        w = w + v
        bias_v = 0.9 * bias_v - rate * 0.2 * g.sum()
        bias += bias_v
    return seen, w * r, float(bias)


def train(docs: DataFrame, labels: DataFrame, rows_per_class: int = FIT_ROWS_PER_CLASS, training=None) -> tuple[np.ndarray, np.ndarray, float]:
    """Fit on a bounded sample of the labelled rows for which ``training`` (a column) holds.

    Label rows with a null id or label are left out; of several label rows of an id the highest label
    counts, of several documents of an id the one with the least features (as bytes); null texts count
    as empty. The fit runs in one task on at most 2 * ``rows_per_class`` rows. Without labels of both
    classes the model is empty and scores one half.
    """
    bound_batches(docs.sparkSession)
    chosen = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    if training is not None:
        chosen = chosen.where(training)
    ranked = chosen.select("doc_id", "toxic", F.xxhash64("doc_id").alias("h"))
    picked = ranked.where("toxic = 1").orderBy("h").limit(rows_per_class).unionAll(ranked.where("toxic = 0").orderBy("h").limit(rows_per_class))
    # at most 2 * rows_per_class ids
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked.select("doc_id", "toxic")), "doc_id")

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [s.astype("<i4").tobytes() for s in feature_sets(batch["text"].tolist())]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"], "features": sets})

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"doc_id": [], "toxic": [], "features": []}), *batches]).sort_values(["doc_id", "features"])
        sets = [np.frombuffer(f, dtype="<i4") for f in rows["features"]]
        at, weight, bias = fit(sets, rows["toxic"].to_numpy(dtype=np.float64))
        yield pd.DataFrame({"features": [at.astype("<i4").tobytes()], "weights": [weight.astype("<f8").tobytes()], "bias": [bias]})

    model = (
        rows.mapInPandas(tidy(features), "doc_id long, toxic int, features binary")
        .groupBy("doc_id", "toxic").agg(F.min("features").alias("features"))
        .repartition(1)
        .mapInPandas(tidy(learn), "features binary, weights binary, bias double")
        .collect()
    )
    if not model:
        return np.empty(0, dtype=np.int64), np.empty(0), 0.0
    m = model[0]
    return np.frombuffer(m["features"], "<i4").astype(np.int64), np.frombuffer(m["weights"], "<f8"), m["bias"]


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], column: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1; null and empty texts get the model's bias alone.

    Every row is kept with its own columns; a column of the new name is replaced.
    """
    bound_batches(docs.sparkSession)
    features, weights, bias = model
    docs = docs.drop(column)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(FEATURES)
        table[features] = weights
        useful = table != 0
        for batch in batches:
            texts = batch.column(names.index("text")).to_pylist()
            z = [bias + float(table[s].sum()) for s in feature_sets([t or "" for t in texts], useful)]
            scores = 1 / (1 + np.exp(-np.clip(np.array(z, dtype=np.float64), -50, 50)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*names, column])

    from pyspark.sql import types as T

    return docs.mapInArrow(tidy(run), T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))
