"""Near-duplicates, vector groups and components against brute force and on odd inputs."""

import random

import numpy as np
import pytest

from tests.llm import brute
from tests.llm.conftest import SF
from yardstick.llm import neardup, vectors
from yardstick.llm.common import store, table
from yardstick.llm.components import components, extended


@pytest.mark.parametrize("shape", ["random", "path", "star", "empty"])
def test_components(spark, shape):
    rng = random.Random(3)
    if shape == "random":
        links = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)]
    elif shape == "path":
        order = list(range(70))
        rng.shuffle(order)
        links = list(zip(order, order[1:], strict=False))
    elif shape == "star":
        links = [(60, i) for i in range(60)] + [(60, 60)]
    else:
        links = []
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    ends = {x for a, b in links if a != b for x in (a, b)}
    assert got == brute.components(ends, [p for p in links if p[0] != p[1]])


@pytest.mark.parametrize("more", [60, 3, 0])
def test_components_extended_by_more_links(spark, more):
    rng = random.Random(more)
    old, new = ([(rng.randrange(120), rng.randrange(120)) for _ in range(n)] for n in (50, more))
    labels, added = (store(spark.createDataFrame(x, "a long, b long"), "t") for x in (old, [*new, (200, 200), (None, 1)]))
    got = extended(store(components(labels), "t"), added).collect()
    ends = {x for a, b in old + new if a != b for x in (a, b)}
    assert len(got) == len(ends)
    assert {r.id: r.component for r in got} == brute.components(ends, [p for p in old + new if p[0] != p[1]])


def test_old_links_are_not_gone_through_again(spark, docs_of):
    """Links that a later trial adds none to: one loop over them, so few queries for the driver to plan."""
    docs = store(docs_of(["a b c d e f g", "a b c d e f g", "h i j k l m n", "A b c d e f g", ""]), "t")
    sc = spark.sparkContext
    sc.setJobGroup("near-duplicates", "")
    try:
        assert neardup.near_duplicates(docs, 5).count() == 5
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("near-duplicates")) <= 60


def _families(rng, n):
    """Texts in families: copies with some words changed, exact copies, and strangers."""
    texts = []
    for f in range(n):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(3, 90))]
        for _ in range(rng.randrange(1, 9)):
            t = list(base)
            for _ in range(rng.randrange(0, 1 + len(t) // 12)):
                t[rng.randrange(len(t))] = f"v{rng.randrange(999)}"
            texts.append(" ".join(t).upper() if rng.random() < 0.2 else "  ".join(t))
    return texts


@pytest.mark.parametrize("n_words", [2, 5])
def test_near_duplicates_against_brute_force(spark, docs_of, n_words):
    texts = _families(random.Random(n_words), 40) + ["", None, "one", "ONE", " one\n"]
    docs = docs_of(texts)
    component, size = brute.near_duplicates(dict(enumerate(texts)), n_words)
    got = neardup.near_duplicates(docs, n_words).collect()
    assert len(got) == len(texts)
    assert {r.doc_id: r.n_shingles for r in got} == size
    assert {r.doc_id: r.component_id for r in got} == component
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_large_near_copy_group_is_one_component(spark, docs_of):
    rng = random.Random(1)
    base = [f"b{i}" for i in range(200)]
    texts = []
    for i in range(150):
        t = list(base)
        for _ in range(6):
            t[rng.randrange(200)] = f"c{i}x{rng.randrange(9)}"
        texts.append(" ".join(t))
    texts += [" ".join(base)] * 150
    component, _ = brute.near_duplicates(dict(enumerate(texts)), 2)
    got = neardup.near_duplicates(docs_of(texts), 2).collect()
    assert {r.doc_id: r.component_id for r in got} == component
    assert sum(r.kept for r in got) == len(set(component.values()))


def test_unlinked_family_is_compared_in_blocks(spark, docs_of, monkeypatch):
    """Copies of one text that mostly fall just short of the threshold among themselves."""
    monkeypatch.setattr(neardup, "BLOCK", 15)
    rng = random.Random(8)
    base = [f"b{i}" for i in range(120)]
    texts = []
    for i in range(90):
        t = list(base)
        for at in rng.sample(range(120), rng.choice([4, 6, 7, 8])):
            t[at] = f"c{i}x{at}"
        texts.append(" ".join(t))
    component, _ = brute.near_duplicates(dict(enumerate(texts)), 2)
    assert 5 < len(set(component.values())) < 85
    got = neardup.near_duplicates(docs_of(texts), 2).collect()
    assert {r.doc_id: r.component_id for r in got} == component


def test_near_duplicates_on_the_driver_table(spark):
    docs = table(spark, SF, "documents")
    component, _ = brute.near_duplicates({r.doc_id: r.text for r in docs.collect()}, 5)
    kept = neardup.kept_documents(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, c in component.items() if d == c}


def test_near_duplicates_odd_rows(spark, odd, clash, empty):
    got = neardup.near_duplicates(clash, 2).collect()
    assert len(got) == odd.count()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[7].component_id == 6 and not by_id[7].kept and by_id[6].kept
    assert all(by_id[i].n_shingles == 0 and by_id[i].kept for i in (0, 1, 2))
    kept = neardup.kept_documents(clash, 2)
    assert kept.columns == clash.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 1, 2, 3, 4, 5, 6, 8, 9]
    assert sum(r.doc_id is None for r in kept.collect()) == 2  # nothing names them: both stay
    assert neardup.near_duplicates(empty, 2).collect() == [] and neardup.kept_documents(empty).collect() == []


def test_near_duplicates_without_and_with_shared_ids(spark, docs_of):
    """Null ids are linked like others, texts under one id are judged each by itself, one row of a group stays."""
    rng = random.Random(11)
    a, b, c = (" ".join(f"{x}{rng.randrange(10 ** 6)}" for _ in range(120)) for x in "abc")
    near = lambda t: t + " tail"
    texts = [a, near(a), a, b, c, near(c), near(b), b, b]
    ids = [1, None, None, 7, 7, 9, None, None, None]  # b and c share id 7; a, b have copies and near copies without ids
    docs = docs_of(texts, ids)
    got = neardup.near_duplicates(docs, 2).collect()
    assert len(got) == 9
    want = {a: 1, near(a): 1, b: 7, near(b): 7, c: 7, near(c): 7}
    found = sorted(((-1 if r.doc_id is None else r.doc_id), r.component_id, r.kept) for r in got)
    assert found == sorted(((-1 if i is None else i), want[t], i == want[t]) for i, t in zip(ids, texts, strict=True))
    kept = neardup.kept_documents(docs, 2).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([(1, a), (7, b), (7, c)])
    alone = docs_of([a, near(a), a, b], [None] * 4)  # nobody has an id: one row of each group, of repeated rows one
    kept = neardup.kept_documents(alone, 2).collect()
    assert len(kept) == 2 and b in {r.text for r in kept} and {r.text for r in kept} & {a, near(a)}
    judged = neardup.near_duplicates(alone, 2).collect()
    assert all(r.component_id is None for r in judged) and {sum(r.kept for r in judged)} <= {2, 3}


def _brute_vectors(rows, cosine=0.93):
    unit = {}
    for i, v, label in rows:
        if v is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            unit[i] = (label, len(v), np.array(v, float) / np.linalg.norm(np.array(v, float)))
    links = [(a, b) for a in unit for b in unit if a < b and unit[a][:2] == unit[b][:2] and unit[a][2] @ unit[b][2] >= cosine]
    count = {i: 0 for i, _, _ in rows}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    return count, brute.components(count, links)


@pytest.mark.parametrize("block", [2048, 7])
def test_vector_groups_against_brute_force(spark, block):
    rng = np.random.default_rng(5)
    rows, i = [], 0
    for label in (0, 1, 2, None):
        for _ in range(6):
            c = rng.normal(size=8)
            for _ in range(int(rng.integers(1, 12))):
                rows.append((i, [float(x) for x in c + rng.normal(size=8) * 0.28], label))
                i += 1
    copy = rows[0][1]
    for v in (None, [], [0.0] * 8, [float("nan")] + [1.0] * 7, [float("inf")] * 8, [None] + [1.0] * 7, copy, copy, [2 * x for x in copy], [1.0], [2.0]):
        rows.append((i, v, 0))
        i += 1
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = vectors.vector_groups(df, block=block, centres=40).collect()
    count, component = _brute_vectors(rows)
    assert {r.vec_id: r.n_links for r in got} == count
    assert {r.vec_id: r.component_id for r in got} == component
    assert len(got) == len(rows) and all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_vector_groups_with_repeated_ids(spark):
    """One id with two vectors, and one id in two labels: every vector keeps its links, labels stay apart."""
    rows = [(1, [1.0, 0.0, 0.0], 7), (1, [0.0, 1.0, 0.0], 7), (2, [0.0, 1.0, 0.01], 7), (3, [1.0, 0.0, 0.0], 8), (2, [1.0, 0.0, 0.01], 8), (4, [0.0, 0.0, 1.0], 8)]
    got = vectors.vector_groups(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 0, 1), (1, 1, 1), (2, 1, 1), (2, 1, 2), (3, 1, 2), (4, 0, 4)]


def test_vector_groups_empty_and_clashing(spark):
    from pyspark.sql import functions as F
    df = table(spark, SF, "embeddings")
    assert vectors.vector_groups(df.limit(0)).collect() == []
    wide = df.limit(50).withColumn("block", F.lit(1)).withColumn("node", F.lit(1)).withColumn("space", F.lit("x"))
    assert vectors.vector_groups(wide.withColumn("vec_id", F.when(F.col("vec_id") != 3, F.col("vec_id")))).count() == 50


def test_cover_tree_prunes_only_far_pairs():
    rng = np.random.default_rng(2)
    c = rng.normal(size=(20, 6))
    x = (c[rng.integers(0, 20, 400)] + rng.normal(size=(400, 6)) * 0.1)
    x /= np.linalg.norm(x, axis=1)[:, None]
    tree = vectors.CoverTree(x[:120])
    assert all(np.linalg.norm(tree.points[tree.centre[n]] - tree.points[tree.centre[p]]) <= vectors.RADII[tree.level[n] - 1]
               for n, p in enumerate(tree.parent) if p >= 0)
    node, paths = tree.descend(x)
    radius = np.full(len(tree.centre), -1.0)
    for nodes, dist in paths:
        np.maximum.at(radius, nodes, dist)
    tau = np.sqrt(0.14)
    alive = tree.dual(radius, tau)
    close = np.linalg.norm(x[:, None] - x[None], axis=2) <= tau
    assert alive[node[:, None], node[None, :]][close].all()  # nothing near is pruned
    assert not alive[node[:, None], node[None, :]].all()  # and something far is
