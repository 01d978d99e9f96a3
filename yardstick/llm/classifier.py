"""Quality classifier: naive Bayes support vectors (NB-SVM).

Features are indicators of hashed word, word-pair and three-byte n-grams. Each is scaled by its class
log-count ratio, a text's scaled vector has length 1, and a linear hinge-loss model is
fitted by dual coordinate descent. Learning uses at most FIT_ROWS labelled texts (the first in hash
order of their id): a bounded model and one bounded task. Every text is scored whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yardstick.llm.common import table
from yardstick.llm.textvec import by_bytes, pair, raw_bytes, words

DIMENSIONS = 1 << 18
FIT_ROWS = 8192
EPOCHS = 10
COST = 1.0
STEEPNESS = 2.0
SLICE = 1 << 20  # bytes of text that are worked on at once (a longer text alone): bounds a task's memory


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of every text, end to end, and their offsets."""
    w = words(texts, lower=False)
    raw, at = raw_bytes(texts)
    size = np.uint64(DIMENSIONS)
    one = (w.hash % size).astype(np.int32)
    two = (pair(w.hash[:-1], w.hash[1:]) % size).astype(np.int32) if len(w.hash) > 1 else one[:0]
    b = raw.astype(np.uint64)
    tri = ((b[:-2] << np.uint64(16) | b[1:-1] << np.uint64(8) | b[2:]) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % size \
        if len(b) > 2 else b[:0]
    tri = tri.astype(np.int32)
    parts = []
    for i in range(len(at) - 1):
        f, g = w.first[i], w.first[i + 1]
        parts.append(np.unique(np.concatenate([one[f:g], two[f:max(f, g - 1)], tri[at[i]:max(at[i], at[i + 1] - 2)]])))
    return (np.concatenate(parts) if parts else one[:0]), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def log_count_ratios(idx: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    p, q = np.ones(DIMENSIONS), np.ones(DIMENSIONS)
    for f, v in zip(idx, y, strict=True):
        (p if v > 0 else q)[f] += 1
    return np.log((p / p.sum()) / (q / q.sum()))


def dual_coordinate_descent(idx: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: float = COST, epochs: int = EPOCHS):
    """Weights (with the ratios folded in) and bias of the hinge-loss model."""
    n = len(y)
    w, bias = np.zeros(DIMENSIONS), 0.0
    alpha = np.zeros(n)
    scale = np.array([1 / np.sqrt(np.square(ratio[f]).sum() or 1.0) for f in idx])
    weight = np.where(y > 0, 1.0, (y > 0).sum() / max(1, (y < 0).sum())) * cost  # either class weighs the same
    rng = np.random.default_rng(1)
    for _ in range(epochs):
        for i in rng.permutation(n):
            x = ratio[idx[i]] * scale[i]
            gradient = y[i] * (w[idx[i]] @ x + bias) - 1
            new = min(max(alpha[i] - gradient / 2.0, 0.0), weight[i])  # |x|^2 + the bias's 1
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[idx[i]] += step * x
                bias += step
                alpha[i] = new
    return w * ratio, bias


def fit(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """Ratios, weights and bias from labelled (doc_id, text, quality 0 or 1), a bounded number of texts, in one task."""
    def indices(batches):
        for batch in batches:
            for part in by_bytes(batch, "text", SLICE):
                f, at = features(part.column("text"))
                yield pa.RecordBatch.from_pydict({
                    "h": part.column("h"), "y": part.column("y"),
                    "f": pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(f, pa.int32()))})

    def learn(group: pa.Table) -> pa.Table:
        group = group.sort_by([("h", "ascending"), ("y", "ascending")])
        y = np.where(group.column("y").to_numpy() > 0, 1.0, -1.0)
        idx = [np.asarray(x.values) for x in group.column("f")]
        ratio = log_count_ratios(idx, y)
        both = (y > 0).any() and (y < 0).any()
        w, bias = dual_coordinate_descent(idx, y, ratio) if both else (np.zeros(DIMENSIONS), 0.0)
        return pa.table({"ratio": pa.array([ratio.tobytes()], pa.binary()), "w": pa.array([w.tobytes()], pa.binary()), "bias": pa.array([float(bias)])})

    chosen = labelled.select(F.xxhash64("doc_id").alias("h"), F.col("quality").cast("int").alias("y"), "text")
    rows = chosen.mapInArrow(indices, "h long, y int, f array<int>")
    model = rows.groupBy(F.lit(0).alias("g")).applyInArrow(learn, "ratio binary, w binary, bias double").collect()
    if not model:  # nothing labelled: every text scores one half
        return np.zeros(DIMENSIONS), np.zeros(DIMENSIONS), 0.0
    return np.frombuffer(model[0]["ratio"]), np.frombuffer(model[0]["w"]), model[0]["bias"]


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def score_quality(docs: DataFrame, all_docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS,
                  keep_columns: bool = False) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted per row of docs; with keep_columns all columns of docs as well.

    Learns from texts of all_docs whose id is labelled and not held out; a doc_id with labels that
    differ, or a null one, teaches nothing. A null or empty text is scored by the bias alone. With
    no labels of both classes every score is 0.5. Repeated rows score alike.
    """
    known = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
             .agg(F.min("quality").alias("quality"), F.max("quality").alias("__hi")).where("quality = __hi").drop("__hi")
             .where(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows))
    texts = all_docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").dropDuplicates(["doc_id"])
    ratio, w, bias = fit(texts)

    made = T.StructType([T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    names = [c for c in (docs.columns if keep_columns else ["doc_id"]) if c not in made.names]

    def run(batches):
        for batch in batches:
            for part in by_bytes(batch, "text", SLICE):
                f, at = features(part.column("text"))
                length = np.sqrt(sums(np.square(ratio)[f], at))
                margin = sums(w[f], at) / np.where(length > 0, length, 1.0) + bias
                score = 1 / (1 + np.exp(-np.clip(STEEPNESS * margin, -500, 500)))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), part.column("__held"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                    [*names, *made.names])

    rows = docs.select(*names, held_out().alias("__held"), *([] if "text" in names else ["text"]))
    return rows.mapInArrow(run, T.StructType([*docs.select(*names).schema.fields, *made.fields]))


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs; an empty run's is 0."""
    out = np.zeros(len(at) - 1)
    some = np.flatnonzero(np.diff(at))
    if len(some):
        out[some] = np.add.reduceat(values, at[:-1][some])
    return out


def op6_nb_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, scored by what the labelled two thirds teach."""
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, docs, table(spark, sf_dir, "labels"))
