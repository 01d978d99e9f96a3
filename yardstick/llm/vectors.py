"""Embedding near-duplicates within a label: cover-tree dual traversal, exact threshold pairs.

On unit vectors cosine >= c means a distance of at most tau = sqrt(2 - 2 c). Upper levels of a cover
tree (nested nets, radii 2, 1, 1/2, 1/4) are built from a bounded sample of CENTRES
vectors; every vector descends to the deepest node that covers it, and each node's covering radius is
the largest distance of any vector below it. The dual traversal starts from a label's root pair and drops
a node pair where d(p, q) > radius(p) + radius(q) + tau; what survives is compared in
blocks of vectors in tree order, in double precision. The sample decides how much is pruned,
never the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from yardstick.llm.common import drop_stored, numbered, salted_join, store, table
from yardstick.llm.components import components

COSINE = 0.93
CENTRES = 1024
RADII = (2.0, 1.0, 0.5, 0.25)
BLOCK = 2048
SLACK = 1e-9  # for rounding in bounds; pairs themselves are decided by their cosine


def unit_rows(batch: pa.RecordBatch) -> list:
    """Unit vectors in double precision; None where null, zero or not finite."""
    out: list = []
    for x in batch.column("embedding"):
        v = None
        if x.is_valid and x.values is not None and len(x.values) and not x.values.null_count:
            v = np.asarray(x.values.to_numpy(zero_copy_only=False), np.float64)
            big = np.abs(v).max()
            v = v / big if np.isfinite(v).all() and big > 0 else None
            v = None if v is None else v / np.sqrt(v @ v)
        out.append(v)
    return out


class CoverTree:
    """Nested nets over one label's sample: node 0 is the root; children follow their parents."""

    def __init__(self, points: np.ndarray):
        self.points = points
        dist = np.sqrt(np.maximum(0.0, 2 - 2 * points @ points.T))
        centre, level, parent = [0], [0], [-1]
        last = [0]
        for j, r in enumerate(RADII[1:], 1):
            net = {centre[p]: p for p in last}
            nodes = []
            for p in last:  # every centre is its own child
                centre.append(centre[p])
                level.append(j)
                parent.append(p)
                nodes.append(len(centre) - 1)
            at = [centre[n] for n in nodes]
            near = dist[:, at].min(1)
            for i in range(len(points)):
                if near[i] > r:
                    upper = list(net)
                    centre.append(i)
                    level.append(j)
                    parent.append(net[upper[int(dist[i, upper].argmin())]])
                    nodes.append(len(centre) - 1)
                    near = np.minimum(near, dist[:, i])
            last = nodes
        self.centre, self.level, self.parent = map(np.array, (centre, level, parent))
        kids: list[list[int]] = [[] for _ in centre]
        for n, p in enumerate(parent):
            if p >= 0:
                kids[p].append(n)
        self.kids = kids
        order, stack = [], [0]
        while stack:
            n = stack.pop()
            order.append(n)
            stack += reversed(kids[n])
        self.place = np.empty(len(order), np.int64)  # depth-first place of a node
        self.place[order] = np.arange(len(order))

    def descend(self, x: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """The deepest node of each row, and (nodes, distances) of the rows' paths level by level."""
        dist = np.sqrt(np.maximum(0.0, 2 - 2 * x @ self.points.T))
        node = np.zeros(len(x), np.int64)
        paths = [(node.copy(), dist[:, self.centre[0]])]
        active = np.ones(len(x), bool)
        for r in RADII[1:]:
            moved = np.zeros(len(x), bool)
            for n in np.unique(node[active]):
                if not self.kids[n]:
                    continue
                rows = np.flatnonzero(active & (node == n))
                kids = np.array(self.kids[n])
                d = dist[np.ix_(rows, self.centre[kids])]
                best = d.argmin(1)
                ok = d[np.arange(len(rows)), best] <= r
                node[rows[ok]] = kids[best[ok]]
                moved[rows[ok]] = True
            active &= moved
            got = np.flatnonzero(active)
            paths.append((node[got], dist[got, self.centre[node[got]]]))
        return node, paths

    def dual(self, radius: np.ndarray, tau: float) -> np.ndarray:
        """Node pairs that the traversal from (root, root) does not prune (symmetric, boolean)."""
        dist = np.sqrt(np.maximum(0.0, 2 - 2 * self.points @ self.points.T))
        n = len(self.centre)
        alive = np.zeros((n, n), bool)
        frontier = [(0, 0)]
        while frontier:
            a, b = frontier.pop()
            if alive[a, b] or radius[a] < 0 or radius[b] < 0:
                continue
            if dist[self.centre[a], self.centre[b]] > radius[a] + radius[b] + tau + SLACK:
                continue
            alive[a, b] = alive[b, a] = True
            frontier += [(a, k) for k in self.kids[b]] + [(k, b) for k in self.kids[a]]
        return alive


def _linked(m: np.ndarray, ia: np.ndarray, ib: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id reachable through the links of one block pair, for either side's rows."""
    big = np.iinfo(np.int64).max
    la, lb = ia.copy(), ib.copy()
    while True:
        na = np.minimum(la, np.where(m, lb[None, :], big).min(1, initial=big))
        nb = np.minimum(lb, np.where(m, na[:, None], big).min(0, initial=big))
        if (na == la).all() and (nb == lb).all():
            return la, lb
        la, lb = na, nb


def vector_groups(vectors: DataFrame, cosine: float = COSINE, centres: int = CENTRES, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors (vec_id, embedding, label).

    Pairs of one non-null label with cosine >= `cosine` are linked. A vector that is null, empty, zero or
    holds a null or non-finite component, and a row with a null vec_id or label, links with
    nothing (component_id its vec_id). Vectors of different lengths never link. Rows equal in label and
    unit vector are one class, compared once and counted with its size. Repeated vec_ids count as vectors of their own, each
    judged in its label; those of one label and vector get the same result.
    """
    tau = float(np.sqrt(2 - 2 * cosine))

    def unit(batches):
        for batch in batches:
            vs = unit_rows(batch)
            ok = [v is not None and i.is_valid and k.is_valid for v, i, k in zip(vs, batch.column("vec_id"), batch.column("label"), strict=True)]
            raw = [v.tobytes() if o else None for v, o in zip(vs, ok, strict=True)]
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id"),
                "space": pa.array([f"{len(v)}:{k}" if o else None for v, k, o in zip(vs, batch.column("label").to_pylist(), ok, strict=True)], pa.string()),
                "same": pa.array([xxhash.xxh3_128_digest(r) if r else None for r in raw], pa.binary()), "vec": pa.array(raw, pa.binary())})

    rows = store(vectors.select(F.col("vec_id").cast("long"), "embedding", F.col("label").cast("string"))
                 .mapInArrow(unit, "vec_id long, space string, same binary, vec binary"), "vectors")
    valid = rows.where("vec is not null")
    # classes have numbers of their own, which hold once they are written: ids may repeat, over labels and vectors
    classes = valid.groupBy("space", "same").agg(F.min("vec_id").alias("low_id"), F.count(F.lit(1)).alias("n_same"))
    classes = store(classes.withColumn("rep", F.monotonically_increasing_id()), "vector-classes")
    members = store(salted_join(valid.select("vec_id", "space", "same"), classes.drop("low_id"), ["space", "same"], ["vec_id"]), "vector-members")
    reps = store(valid.join(classes.withColumnRenamed("low_id", "vec_id"), ["space", "same", "vec_id"])
                 .dropDuplicates(["rep"]).select(F.col("rep").alias("vec_id"), "space", "n_same", "vec"), "vector-reps")

    # a bounded sample: at most `centres` vectors, the first in hash order
    sample = reps.orderBy(F.xxhash64("vec_id"), "vec_id").limit(centres).select("space", "vec").collect()
    spaces: dict[str, list[np.ndarray]] = {}
    for r in sample:
        spaces.setdefault(r["space"], []).append(np.frombuffer(r["vec"]))
    trees = {s: CoverTree(np.stack(v)) for s, v in spaces.items()}

    def place(batches):
        cover: dict[tuple[str, int], float] = {}
        for batch in batches:
            space = np.array(batch.column("space").to_pylist(), object)
            raw = batch.column("vec")
            node, deep = np.full(len(space), -1, np.int64), np.zeros(len(space), np.int64)
            for s in set(space):
                if s not in trees:
                    continue
                at = np.flatnonzero(space == s)
                got, paths = trees[s].descend(np.stack([np.frombuffer(raw[i].as_buffer()) for i in at]))
                node[at], deep[at] = trees[s].place[got], got
                for nodes, dist in paths:
                    far = np.full(len(trees[s].centre), -1.0)
                    np.maximum.at(far, nodes, dist)
                    for n in np.flatnonzero(far >= 0):
                        cover[s, int(n)] = max(cover.get((s, int(n)), -1.0), float(far[n]))
            n = len(space)
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id"), "space": batch.column("space"), "n_same": batch.column("n_same"), "vec": raw,
                "place": pa.array(node), "node": pa.array(deep), "radius": pa.array([None] * n, pa.float64())})
        if cover:
            k = len(cover)
            yield pa.RecordBatch.from_pydict({
                "vec_id": pa.array([None] * k, pa.int64()), "space": pa.array([s for s, _ in cover]),
                "n_same": pa.array([None] * k, pa.int64()), "vec": pa.array([None] * k, pa.binary()),
                "place": pa.array([None] * k, pa.int64()), "node": pa.array([n for _, n in cover], pa.int64()), "radius": pa.array(list(cover.values()))})

    placed = store(reps.mapInArrow(place, "vec_id long, space string, n_same long, vec binary, place long, node long, radius double"), "vector-placed")
    # at most len(RADII) * centres nodes
    radii = {s: np.full(len(t.centre), -1.0) for s, t in trees.items()}
    for r in placed.where("radius is not null").groupBy("space", "node").agg(F.max("radius").alias("radius")).collect():
        radii[r["space"]][r["node"]] = r["radius"]
    alive = {s: t.dual(radii[s], tau) for s, t in trees.items()}

    # blocks of vectors in tree order
    there = placed.where("vec is not null").withColumn("cell", F.concat_ws("/", "space", F.col("place").cast("string")))
    cells = there.groupBy("cell", "space", "place").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("space").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select("cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    there = numbered(there.drop("radius"), "cell", ["vec_id"], "i", per_key=starts)
    there = there.withColumn("block", F.expr(f"(start + i) div {block}")).select("space", "block", "place", "node", "vec_id", "n_same", "vec")

    def packed(group: pa.Table) -> pa.Table:
        group = group.sort_by([("place", "ascending"), ("vec_id", "ascending")])
        nodes = group.column("node").to_numpy()
        return pa.table({"space": group.column("space")[:1], "block": group.column("block")[:1],
                         "nodes": pa.array([nodes], pa.list_(pa.int64())), "ids": pa.array([group.column("vec_id").to_numpy()], pa.list_(pa.int64())),
                         "sizes": pa.array([group.column("n_same").to_numpy()], pa.list_(pa.int64())),
                         "vecs": pa.array([b"".join(group.column("vec").to_pylist())], pa.binary())})

    blocks = store(there.groupBy("space", "block").applyInArrow(
        packed, "space string, block long, nodes array<long>, ids array<long>, sizes array<long>, vecs binary"), "vector-blocks")
    drop_stored(placed)
    light = blocks.select("space", "block", F.array_distinct("nodes").alias("nodes"))

    def unpruned(batches):
        for batch in batches:
            keep = []
            for s, x, y in zip(*(batch.column(c).to_pylist() for c in ("space", "na", "nb")), strict=True):
                keep.append(s not in alive or bool(alive[s][np.ix_(x, y)].any()))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_pydict({c: batch.column(c).filter(mask) for c in ("space", "a", "b")})

    pairs = (light.select("space", F.col("block").alias("a"), F.col("nodes").alias("na"))
             .join(light.select("space", F.col("block").alias("b"), F.col("nodes").alias("nb")), "space").where("a <= b"))
    pairs = store(pairs.mapInArrow(unpruned, "space string, a long, b long"), "vector-block-pairs")

    def compare(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i] for c in batch.schema.names}
                s, same = r["space"].as_py(), r["a"].as_py() == r["b"].as_py()
                ids, sizes, nodes, vecs = ([np.asarray(r[c + k].values) if c != "v" else np.frombuffer(r[c + k].as_buffer()) for k in "ab"] for c in ("i", "n", "t", "v"))
                xs = [v.reshape(len(k), -1) for v, k in zip(vecs, ids, strict=True)]
                pick = [np.arange(len(k)) for k in ids]
                if s in alive:
                    ok = alive[s][np.ix_(nodes[0], nodes[1])]
                    pick = [np.flatnonzero(ok.any(1)), np.flatnonzero(ok.any(0))]
                (ia, ib), (na, nb), (xa, xb) = ([v[p] for v, p in zip(part, pick, strict=True)] for part in (ids, sizes, xs))
                m = xa @ xb.T >= cosine
                if same:
                    m &= ia[:, None] != ib[None, :]
                la, lb = _linked(m, ia, ib)
                out = [(ia, m @ nb, la)] + ([] if same else [(ib, na @ m, lb)])
                hit = [c > 0 for _, c, _ in out]
                yield pa.RecordBatch.from_pydict({
                    "id": pa.array(np.concatenate([x[0][h] for x, h in zip(out, hit, strict=True)])),
                    "n": pa.array(np.concatenate([x[1][h] for x, h in zip(out, hit, strict=True)])),
                    "low": pa.array(np.concatenate([x[2][h] for x, h in zip(out, hit, strict=True)]))})

    def side(k: str) -> DataFrame:
        return blocks.select("space", F.col("block").alias(k), F.col("ids").alias("i" + k), F.col("sizes").alias("n" + k),
                             F.col("nodes").alias("t" + k), F.col("vecs").alias("v" + k))

    joined = pairs.join(side("a"), ["space", "a"]).join(side("b"), ["space", "b"])
    found = store(joined.mapInArrow(compare, "id long, n long, low long"), "vector-links")
    links = found.groupBy("id").agg(F.sum("n").alias("n"))
    labels = components(found.select(F.col("id").alias("a"), F.col("low").alias("b")))
    comps = store(classes.join(labels.select(F.col("id").alias("rep"), "component"), "rep", "left")
                  .join(links.select(F.col("id").alias("rep"), "n"), "rep", "left")
                  .select("rep", "low_id", "n", F.coalesce("component", "rep").alias("component")), "vector-components")
    low = comps.groupBy("component").agg(F.min("low_id").alias("component_id"))
    named = salted_join(comps, low, ["component"], ["rep"]).select("rep", "n", "component_id")
    out = salted_join(members.select("vec_id", "rep", "n_same"), named, ["rep"], ["vec_id"]).select(
        "vec_id", (F.col("n_same") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id")
    alone = rows.where("vec is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op5_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of all embeddings at cosine 0.93 within their label."""
    return vector_groups(table(spark, sf_dir, "embeddings"))


OP5_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS n FROM v
       WHERE label IS NOT NULL AND e IS NOT NULL AND list_count(e) = len(e)
             AND isfinite(list_dot_product(e, e)) AND list_dot_product(e, e) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
          AND len(a.e) = len(b.e) AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.93),
reach AS (SELECT vec_id AS id, vec_id AS low FROM embeddings
          UNION SELECT links.b, reach.low FROM reach JOIN links ON links.a = reach.id WHERE reach.low < links.b)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = vec_id) AS n_links, min(low) AS component_id,
       vec_id = min(low) AS kept
FROM embeddings JOIN reach ON reach.id = vec_id GROUP BY vec_id"""
