"""Embedding whitening from a weighted multiplicity covariance.

Entries are quantised to whole numbers x, identical x vectors are one row with their count, and each weighs its count
or one in the fit. Sums are exact whole numbers; the covariance is a weighted GEMM of vectors
that are centred first, one partial matrix a task, added by Spark. Its eigenvectors (a
matrix of the dimension, on the driver) whiten each distinct vector once, and the rows join back by their
vector's digest.

Vectors of one length are one space: where a table holds several lengths, each is fitted and whitened apart.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yardstick.llm.common import drop_stored, store, table

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
LARGEST = float(1 << 40)  # entries of this size or more count as not finite: x and its sums stay exact below it
CELLS = 1 << 20
HOT = 256  # a vector that 1 / HOT of all rows share is hot; there are at most HOT of them


def quantised(embedding: Column) -> Column:
    """x of every entry, floor(SCALE * c) + SHIFT; null for a vector that is null or holds a null or non-finite entry."""
    c = F.transform(embedding, lambda v: v.cast("double"))
    good = F.forall(c, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < LARGEST), F.lit(False)))
    return F.when(good, F.transform(c, lambda v: F.floor(v * SCALE) + F.lit(SHIFT).cast("long")))


def _by_length(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, matrix) for each length of the batch's vectors, at most CELLS entries (or one row) at a time."""
    vectors = batch.column(column)
    at = np.concatenate([[0], np.cumsum(vectors.value_lengths().to_numpy())]).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(at)
    for d in np.unique(sizes):
        rows, step = np.flatnonzero(sizes == d), max(1, CELLS // max(1, int(d)))
        for i in range(0, len(rows), step):
            part = rows[i:i + step]
            yield int(d), part, flat[at[part][:, None] + np.arange(d)]


def _totals(vectors: DataFrame, column: str, f: Callable[[int, np.ndarray, np.ndarray], np.ndarray], exact: bool = False) -> dict[int, np.ndarray]:
    """{length: the sum over all vectors of f(length, matrix, weights)}: one partial array a task and length, added by Spark.

    What comes to the driver is one array for each length, however many rows there are.
    """
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            weights = batch.column("weight").to_numpy()
            for d, rows, m in _by_length(batch, column):
                got = f(d, m, weights[rows]).ravel()
                got = got.astype(object) if exact else got
                sums[d] = sums[d] + got if d in sums else got
        for d, s in sums.items():
            value = pa.array([str(v) for v in s]) if exact else pa.array(s, pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([d] * len(s), pa.int32()), pa.array(range(len(s)), pa.int32()), value], ["d", "i", "v"])

    kind = "string" if exact else "double"
    rows = vectors.select(column, "weight").mapInArrow(partial, f"d int, i int, v {kind}")
    value = F.sum(F.col("v").cast("decimal(38,0)") if exact else F.col("v"))
    found = rows.groupBy("d", "i").agg(value.alias("v")).orderBy("d", "i").collect()
    out: dict[int, list] = {}
    for r in found:
        out.setdefault(r.d, []).append(int(r.v) if exact else r.v)
    return {d: np.array(v, object if exact else float) for d, v in out.items()}


class Space:
    """The fit of the vectors of one length: n, exact sums, components and their scaled directions."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.explained = self.axes = None

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact: as int64 where that holds it, else as Python integers."""
        if self.n < 1 << 15 and (not x.size or np.abs(x).max() < 1 << 47):
            return x * self.n - np.array(self.sums, np.int64)
        near = np.array([s // self.n for s in self.sums], np.int64)  # x less the whole mean is small, whatever n
        rest = np.array([s % self.n for s in self.sums], np.int64)
        small = x - near
        if not small.size or int(np.abs(small).max()) * self.n < 1 << 61:
            return small * self.n - rest
        return small.astype(object) * self.n - rest.astype(object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x less the mean, rounded once."""
        return (self.deviations(x) / self.n).astype(np.float64)

    def solve(self, v: np.ndarray, components: int) -> None:
        e, axes = np.linalg.eigh((v + v.T) / 2)
        e, axes = e[::-1][:components], axes[:, ::-1][:, :components]
        trace = float(np.trace(v))
        self.explained = [max(float(x), 0.0) / trace if trace > 0 else None for x in e]
        least = max(float(np.linalg.norm(v, 2)) * len(v) * np.finfo(float).eps, 0.0)
        self.real = [bool(x > least) for x in e]
        self.axes = axes / np.sqrt(np.where(self.real, e, 1.0))  # directions without variance stay unscaled, and unused

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.axes


def _squares(dev: np.ndarray) -> list[int | None]:
    """Exact sums of squares; None where one doesn't fit a long."""
    if dev.dtype != object and (not dev.size or int(np.abs(dev).max()) ** 2 * max(1, dev.shape[1]) < 1 << 63):
        return (dev * dev).sum(1).tolist()
    sums = [sum(int(v) ** 2 for v in row) for row in dev]
    return [s if s < 1 << 63 else None for s in sums]


def distinct_vectors(rows: DataFrame, weights: str = "one") -> DataFrame:
    """x, n_rows, weight for each distinct x vector of rows; counts are partial sums, so copies of one vector move once a task."""
    weight = {"one": F.lit(1).cast("long"), "counts": F.col("n_rows")}[weights]
    return rows.groupBy("x").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("weight", weight)


def fit(distinct: DataFrame, components: int = COMPONENTS) -> dict[int, Space]:
    """{length: fitted Space} from distinct vectors (x, weight)."""
    def sums(d: int, m: np.ndarray, w: np.ndarray) -> np.ndarray:
        n = int(w.sum())
        m = m if int(np.abs(m).max(initial=0)) * n < 1 << 62 else m.astype(object)
        return np.concatenate([np.array([n], object), (m * w[:, None]).sum(0)])

    total = _totals(distinct, "x", sums, exact=True)
    spaces = {d: Space(int(s[0]), [int(v) for v in s[1:]]) for d, s in total.items() if d}

    def scatter(d: int, m: np.ndarray, w: np.ndarray) -> np.ndarray:
        if d not in spaces:
            return np.zeros(0)
        c = spaces[d].centred(m)
        return (c * w[:, None]).T @ c

    for d, s in _totals(distinct, "x", scatter).items():
        spaces[d].solve(s.reshape(d, d) / spaces[d].n, components)
    return spaces


def _whitened(distinct: DataFrame, spaces: dict[int, Space]) -> DataFrame:
    """distinct with d, n, deviation and w (array, one entry a component)."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, rows, m in _by_length(batch, "x"):
                if d not in spaces:
                    continue
                s = spaces[d]
                w = s.whiten(m)
                part = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("n_rows"), part.column("weight"), pa.array([d] * len(rows), pa.int32()),
                     pa.array(_squares(s.deviations(m)), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel(), pa.float64()))],
                    ["key", "n_rows", "weight", "d", "deviation", "w"])

    return distinct.mapInArrow(apply, "key binary, n_rows long, weight long, d int, deviation long, w array<double>")


def _identity_errors(white: DataFrame, spaces: dict[int, Space]) -> dict[int, float | None]:
    """Largest absolute entry of the whitened vectors' covariance less the identity, over components with variance, by length."""
    sizes = {d: s.axes.shape[1] for d, s in spaces.items()}  # w's length tells its space only together with d
    out: dict[int, float | None] = {}
    for d, k in sizes.items():
        own, real = white.where(F.col("d") == d), np.flatnonzero(spaces[d].real)
        if not len(real):
            out[d] = None
            continue
        mean = _totals(own, "w", lambda _, m, w: (m * w[:, None]).sum(0))[k] / spaces[d].n

        def scatter(_: int, m: np.ndarray, w: np.ndarray, mean=mean) -> np.ndarray:
            c = m - mean
            return (c * w[:, None]).T @ c

        cov = _totals(own, "w", scatter)[k].reshape(k, k) / spaces[d].n
        out[d] = float(np.abs(cov[np.ix_(real, real)] - np.eye(len(real))).max())
    return out


def whiten(vectors: DataFrame, components: int = COMPONENTS, weights: str = "one") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error per row of vectors (vec_id, embedding) and component.

    Rows whose vector is null, or holds a null, non-finite or 2^40-sized entry, are left out, and empty vectors have no
    components. Repeated rows and ids, and null ids, are rows like any other; copies have equal results. Vectors of
    each length are fitted apart. A component without variance (constant entries, or fewer
    distinct vectors than components) has whitened null, and explained is null where nothing varies; a deviation
    that no long can hold is null. An empty table gives an empty result. `weights`: "one" fits every distinct vector
    once, "counts" as often as it occurs. The fit runs jobs while the result is built.
    """
    digest = F.unhex(F.sha2(F.concat_ws(",", "x"), 256))
    rows = vectors.select("vec_id", quantised(F.col("embedding")).alias("x")).where("x is not null")
    distinct = store(distinct_vectors(rows, weights).withColumn("key", digest), "vectors")
    spaces = fit(distinct, components)
    white = store(_whitened(distinct, spaces), "whitened")
    drop_stored(distinct)
    errors = _identity_errors(white, spaces)
    parts = [(d, c + 1, s.n, s.explained[c], errors[d], s.real[c]) for d, s in spaces.items() for c in range(len(s.real))]
    fitted = white.sparkSession.createDataFrame(parts, "d int, component int, n long, explained double, identity_error double, real boolean")
    per = fitted.groupBy("d").agg(F.sort_array(F.collect_list(F.struct("component", "n", "explained", "identity_error", "real"))).alias("parts"))
    total = white.agg(F.sum("n_rows")).first()[0] or 0  # one number
    mine = store(rows.select("vec_id", digest.alias("key")), "vector-keys")
    light = white.select("key", "d", "deviation", "w", (F.col("n_rows") * HOT >= total).alias("hot"))
    hot = F.broadcast(light.where("hot").drop("hot"))  # at most HOT rows
    few = F.broadcast(per)  # one row a length
    joined = (mine.join(hot, "key").unionByName(
        mine.join(F.broadcast(light.where("hot").select("key")), "key", "left_anti").join(light.where("not hot").drop("hot"), "key")))
    out = joined.join(few, "d").select("vec_id", "deviation", "w", F.explode("parts").alias("p"))
    return out.select("vec_id", "p.component", "p.n", "deviation", F.when(F.col("p.real"), F.get("w", F.col("p.component") - 1)).alias("whitened"),
                      "p.explained", "p.identity_error")


def op11_multiplicity_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors, each distinct one with weight one."""
    return whiten(table(spark, sf_dir, "embeddings"))
