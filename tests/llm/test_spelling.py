"""Spelling variants against brute force over all pairs of words."""

import collections
import random
import re
import zlib

import pytest

from tests.llm.brute import AZ
from tests.llm.conftest import SF
from yardstick.llm import spelling
from yardstick.llm.common import table

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(rows, min_length=6, min_count=5):
    n = collections.Counter()
    for d, text in rows:
        for run in RUN.findall(text or ""):
            w = run.translate(AZ)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 199 == 0:
                at = h % len(w)
                w = w[:at] + w[at + 1:]
            if len(w) >= min_length:
                n[w] += 1
    return {w: c for w, c in n.items() if c >= min_count}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def forms(n, ratio=5):
    words = sorted(n)
    others = {w: [] for w in words}
    for i, a in enumerate(words):
        for b in words[i + 1:]:
            if near(a, b):
                others[a].append(b)
                others[b].append(a)
    form = {}
    for w in words:
        best = min(others[w], key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(others[w]), n[form[w]] if form[w] else None)
    return out


def got(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    df = spelling.op13_asymmetric_qchunks(spark, SF)
    assert dict(df.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    want = forms(counted(rows))
    assert len(want) > 500 and any(v[0] for v in want.values())
    assert got(df) == want


@pytest.mark.parametrize("alphabet", ["ab", "abéÿz"])
def test_every_near_pair_is_found(spark, alphabet):
    """Few letters and lengths 4 to 9: many words share their chunks, with every kind of edit at every place."""
    rng = random.Random(len(alphabet))
    words = {"".join(rng.choice(alphabet) for _ in range(rng.randrange(4, 10))) for _ in range(350)}
    n = {w: rng.choice([1, 2, 5, 10, 50, 250, 1250]) for w in words}
    df = spark.createDataFrame(sorted(n.items()), "word string, n long")
    pairs = {(r.a, r.b) for r in spelling.near_pairs(df).collect()}
    assert {frozenset(p) for p in pairs} == {frozenset((a, b)) for a in words for b in words if near(a, b)}
    assert len(pairs) == len({frozenset(p) for p in pairs})
    assert got(spelling.variant_forms(df)) == forms(n)


def test_long_way_to_the_root(spark):
    """Each word is a fifth as frequent as the next: ten forms on the way to the last."""
    chain = ["abcdefghij"[:k] + "zzzzzzzzzz"[k:] for k in range(11)]
    n = {w: 5 ** k for k, w in enumerate(chain)}
    out = got(spelling.variant_forms(spark.createDataFrame(sorted(n.items()), "word string, n long")))
    assert {v[1] for v in out.values()} == {chain[-1]}
    assert out == forms(n)


def test_odd_rows(spark, odd, clash, empty, docs_of):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for docs in (odd, clash):
        found = spelling.vocabulary(docs, min_length=1, min_count=1).collect()
        assert {r.word: r.n for r in found} == counted(rows, 1, 1)
    assert spelling.variant_forms(spelling.vocabulary(empty)).collect() == []
    long = "longwordx" * 4000
    docs = docs_of([f"{long} {long[:-1]}"] * 6 + ["ÀÉÎ÷×ÿÀ"] * 5 + ["plainword Plainword PLAINWORD"] * 2)
    out = got(spelling.variant_forms(spelling.vocabulary(docs)))
    assert out == forms(counted([(i, r.text) for i, r in enumerate(docs.collect())]))
    assert long in out and out[long][3] == 1
