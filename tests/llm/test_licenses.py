"""License scans against brute force, on odd rows and on hand-made files."""

import collections
import math
import re

import duckdb

from tests.llm.brute import AZ
from tests.llm.conftest import SF
from yardstick.llm import licenses as L
from yardstick.llm.common import table

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
COLS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def words(text):
    return WORD.findall((text or "").translate(AZ))


def at(ws, phrase):
    p = words(phrase)
    return [i for i in range(len(ws) - len(p) + 1) if ws[i:i + len(p)] == p]


def brute(texts):
    files = [words(t) for t in texts]
    df = collections.Counter(w for f in files for w in set(f))
    out = []
    index = []
    for t in L.TEMPLATES:
        tw = words(t.text)
        rare = sorted(set(tw), key=lambda w: (df[w], w))[:L.RARE]
        index.append([(q, w, math.log((len(files) + 1) / (df[w] + 1))) for q, w in enumerate(tw) if w in rare])
    for f in files:
        base = [(i, label) for label, p in L.PHRASES for i in at(f, p)]
        labels, score = {x for _, x in base}, 0.0
        for t, posts in zip(L.TEMPLATES, index, strict=True):
            total, votes, size = sum(x[2] for x in posts), collections.Counter(), len(words(t.text))
            for i, w in enumerate(f):
                for q, v, idf in posts:
                    if v == w:
                        votes[i - q] += idf
            for d, s in votes.items():
                if total and s / total >= L.MIN_SHARE:
                    own = f[max(0, d - L.SLACK):max(0, d + size + L.SLACK)]
                    if all(at(own, p) for p in t.phrases):
                        labels.add(t.label)
                        score = max(score, s / total)
        places = [i for i, _ in base]
        out.append((len(f), len(places), min(places, default=None), max(places, default=None),
                    ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), round(min(score, 1.0), 6)))
    return out


def got(df):
    return sorted((tuple(r[c] for c in COLS) for r in df.collect()), key=repr)


def same(a, b):
    assert len(a) == len(b)
    for x, y in zip(sorted(a, key=repr), sorted(b, key=repr), strict=True):
        assert x[:-1] == y[:-1] and abs(x[-1] - y[-1]) <= 1e-6


def test_driver_table_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    df = L.op12_rare_token_index(spark, SF)
    assert dict(df.dtypes) == {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint",
                               "base_labels": "string", "labels": "string", "score": "double"}
    want = brute([r.text for r in docs.collect()])
    same(got(df), want)
    assert any(x[4] for x in want) and any(x[5] != x[4] for x in want)  # the method adds labels


def _files():
    filler = "some words that are in no licence at all"
    mit, bsd = L.TEMPLATES[1].text, L.TEMPLATES[8].text
    gone = mit.replace("without restriction", "at will")  # a key phrase is missing
    moved = " ".join(reversed(bsd.split()))  # the words are there, their order isn't
    return [f"{filler} {mit}\n{filler}", f"/* {mit.upper()} */", gone, bsd.replace("source", "text"), moved,
            f"{filler}. {L.TEMPLATES[17].text}", f"{mit} {filler} {bsd}", "the mit\nlicense, MIT-LICENSE mitlicense, mit x license",
            "General Public. License general  public license", "apache license " * 3, "Licensed under CC BY-SA 4.0"]


def test_files(spark, docs_of):
    texts = _files()
    rows = {r.doc_id: r for r in L.scan_licenses(docs_of(texts)).collect()}
    assert [rows[i].labels for i in range(len(texts))] == [
        "mit", "mit", "", "", "", "cc-by-nc", "bsd,mit", "mit", "gpl", "apache", "cc-by-sa"]
    assert (rows[7].n_base, rows[7].first_word, rows[7].last_word) == (2, 1, 3)
    assert rows[0].base_labels == "" and rows[0].score > 0.99 and rows[2].score == 0
    same(got(L.scan_licenses(docs_of(texts))), brute(texts))


def test_odd_rows(spark, docs_of, odd, clash, empty):
    texts = [r.text for r in odd.collect()]
    same(got(L.scan_licenses(odd)), brute(texts))
    same(got(L.scan_licenses(clash)), brute(texts))
    assert L.scan_licenses(empty).collect() == []
    long = "licensed under " * 20_000 + "mit license " * 5_000 + L.TEMPLATES[3].text
    same(got(L.scan_licenses(docs_of([long, "é" * 9, "license", long]))), brute([long, "é" * 9, "license", long]))


def test_oracle_on_the_made_files(spark, docs_of):
    texts = [*_files(), None, ""]
    con = duckdb.connect()
    con.register("documents", docs_of(texts).toArrow())
    got_sql = con.sql(f"SELECT {', '.join(COLS)} FROM ({L.OP12_SQL})").fetchall()
    same(got(L.scan_licenses(docs_of(texts))), got_sql)


def test_plan_is_native(spark):
    plan = L.op12_rare_token_index(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
