"""Word hashes, quality rules, line dedup and classifier against brute force and on odd inputs."""

import collections
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import rows
from tests.llm import brute
from tests.llm.conftest import SF
from yardstick.llm import classifier, linededup, quality, textvec


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB \n\t\x0b\x0c\réz ", max_size=30)), max_size=8), st.integers(1, 40))
def test_word_hashes_equal_words(texts, chunk):
    before, textvec.CHUNK = textvec.CHUNK, chunk  # tiny chunks: hashes must not depend on them
    textvec._tables.clear()
    try:
        w = textvec.words(pa.array(texts, pa.string()))
    finally:
        textvec.CHUNK = before
    expected = [brute.words(t) for t in texts]
    assert np.diff(w.first).tolist() == [len(x) for x in expected]
    by_hash = collections.defaultdict(set)
    for h, x in zip(w.hash.tolist(), [y for t in expected for y in t], strict=True):
        by_hash[h].add(x)
    assert all(len(x) == 1 for x in by_hash.values())
    assert len(by_hash) == len({y for t in expected for y in t})


def test_shingles_are_sets(spark):
    texts = ["a b c", "a b c a b", "", "z", "A b C", None]
    keys, at = textvec.shingles(textvec.words(pa.array(texts)), 2)
    sets = [set(keys[at[i]:at[i + 1]].tolist()) for i in range(len(texts))]
    assert [len(s) for s in sets] == [len(brute.shingles(t, 2)) for t in texts]
    assert sets[0] == sets[4] and sets[0] < sets[1]


def test_base_rules(spark, odd, clash):
    from yardstick.llm.common import table
    real = table(spark, SF, "documents")
    for docs in (odd, real, clash):
        trusted = docs.select("doc_id").limit(20)
        text = {r.doc_id: r.text for r in docs.collect()}
        got = quality.quality_rules(docs, trusted).collect()
        assert len(got) == docs.count()
        for r in got:
            if r.doc_id is None:
                continue
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.base_rules(text[r.doc_id])
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert r.kept == (not r.base_failed and r.score >= quality.MIN_LLR)


def test_llr_separates_and_is_neutral_without_target(spark, docs_of, empty):
    rng = np.random.default_rng(4)
    good = [" ".join(f"w{x}" for x in rng.integers(0, 60, 80)) for i in range(30)]
    bad = [" ".join(f"j{x}" for x in rng.integers(0, 60, 80)) for i in range(30)]
    docs = docs_of(good + bad)
    got = {r.doc_id: r for r in quality.quality_rules(docs, docs.where("doc_id < 20").select("doc_id")).collect()}
    assert min(got[i].score for i in range(30)) > max(got[i].score for i in range(30, 60))
    assert all(got[i].kept for i in range(30)) and not any(got[i].kept for i in range(30, 60))
    assert {r.score for r in quality.quality_rules(docs, empty.select("doc_id")).collect()} == {0.0}
    assert quality.quality_rules(empty, docs.select("doc_id")).collect() == []


PIECE = re.compile(r"(?<=\n)|(?<=[.!?] )")


def _lines(text):
    """(pieces, the numbers of those with words, their bare texts)."""
    p = PIECE.split(text or "")
    at = [i for i, x in enumerate(p) if brute.words(x)]
    return p, at, [p[i].rstrip(" \n") for i in at]


def test_pieces_join_to_the_text_and_lines_are_counted(spark):
    odd = ["a. b\x01. c\nd! e", "a. b. c\nd! e", "", "\n", "a\n\n", "\n\nb", "No end", "One. Two! Three?  Four.\nFive. ", "v1.2. é. 😀. z",
           "a  b\tc\n   d e. f\x0bg\x0ch\r\ni", " lead", "x y. z", "\t\n\n a", "a\tb \t\n" * 3, "one two\n three", " \n . x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "i int, t string")
    got = df.select("i", linededup.pieces(F.col("t")).alias("p"), linededup.lines(F.col("t")).alias("l")).collect()
    for r in got:
        p, _, own = _lines(odd[r.i])
        assert r.p == p and "".join(p) == odd[r.i]
        assert [(x.h, x.w) for x in r.l] == [(_xxhash(x), len(brute.words(x))) for x in own]


def _xxhash(text):
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def test_passage_inside_lines_is_found(spark, docs_of):
    """A passage set into the middle of other lines: all but its ends goes from the later documents."""
    rng = np.random.default_rng(6)
    say = lambda n, k, m=12: ". ".join(" ".join(f"w{x}" for x in rng.integers(k, k + 500, n)) for _ in range(m)) + ". "
    passage = say(7, 0, 40)
    texts = [say(8, 1000 * (i + 1)) + f"start{i} " + passage + f"end{i} " + say(6, 1000 * (i + 20)) for i in range(4)]
    left = {r.doc_id: r for r in linededup.dedup_lines(docs_of(texts)).collect()}
    assert left[0].text == texts[0]
    inside = set(passage.split())
    for i in (1, 2, 3):
        kept = [w for w in left[i].text.split() if w in inside]
        assert len(kept) < 0.35 * len(passage.split())
        own = [w for w in texts[i].split() if w not in inside]
        assert [w for w in left[i].text.split() if w not in inside] == own  # and nothing else


def test_words_are_matched_only_where_white_space_is_odd(spark):
    """Lines of single spaces are counted by their spaces: no regular expression splits texts or runs over their words, and the counts are those of brute force."""
    rng = np.random.default_rng(3)
    parts = ["a", "bc", "é", "😀", ".", "!", "?", " ", " ", " ", "  ", "\n", "\t", "\r", "\x0b", "\x0c", ". ", "! ", "? ", "\x01", "\u00a0"]
    texts = ["".join(rng.choice(parts[:12] if i % 3 else parts, int(rng.integers(0, 40)))) for i in range(600)] + [None, "", " ", "a.  b", "a. \nb", "a.\n b. "]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for r in df.select("i", linededup.pieces(F.col("t")).alias("p"), linededup.lines(F.col("t")).alias("l")).collect():
        p, _, own = _lines(texts[r.i])
        assert r.p == p
        assert [(x.h, x.w) for x in r.l] == [(_xxhash(x), len(brute.words(x))) for x in own]
    h = spark.createDataFrame([([int(x) for x in rng.integers(-9, 9, 6)],)], "h array<long>")
    spans = [(s, e) for s in range(6) for e in range(s, 6)]
    got = h.select(*(linededup._span_hash(F.col("h"), F.lit(s), F.lit(e)).alias(f"a{s}{e}") for s, e in spans),
                   *(F.xxhash64(F.slice("h", s + 1, e - s + 1)).alias(f"b{s}{e}") for s, e in spans)).first()
    assert all(got[f"a{s}{e}"] == got[f"b{s}{e}"] for s, e in spans)

    plan = lambda c: df.select(c(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "(?<=" not in plan(linededup.pieces) and "(?<=" not in plan(linededup.lines)
    assert "contains" in plan(linededup.lines).lower()


def _brute_dedup(docs):
    """docs: list of (doc_id, text), different ids. The text that is left of each: chunks, seeds, runs and repeats by their definitions."""
    long = linededup.LONG_LINE
    cut = {}
    for d, t in docs:
        p, at, own = _lines(t)
        n = [len(brute.words(x)) for x in own]
        starts = [i for i in range(len(own)) if _xxhash(own[i]) % linededup.FEW < n[i] or n[i] >= long or (i and own[i - 1] == own[i])]
        enough = lambda s, e: n[s] >= long if e == s else sum(n[s:e + 1]) >= linededup.MIN_WORDS  # noqa: E731,B023
        cut[d] = p, at, own, [(s, next((e for e in range(s, len(own)) if enough(s, e)), None)) for s in starts]  # noqa: B023
    count = collections.Counter(tuple(own[s:e + 1]) for _, _, own, spans in cut.values() for s, e in spans if e is not None)
    first, runs = {}, {}
    for d, (_, _, own, spans) in cut.items():
        seeds = [k for k, (s, e) in enumerate(spans) if e is not None and count[tuple(own[s:e + 1])] > 1]
        mine = set()
        for k in seeds:
            s, e = spans[k]
            until = spans[k + 1][0] if k + 1 in seeds else len(own) if k + 1 == len(spans) or spans[k + 1][1] is None else spans[k + 1][1]
            since = spans[k - 1][1] + 1 if k - 1 in seeds else spans[k - 1][0] if k else 0
            mine |= {(s, x) for x in range(e, max(e + 1, until))} | {(x, e) for x in range(since, s)}
        runs[d] = mine
        for s, e in runs[d]:
            key = tuple(own[s:e + 1])
            first[key] = min(first.get(key, (d, s)), (d, s))
    out = {}
    for d, (p, at, own, _) in cut.items():
        gone = {j for s, e in runs[d] if first[tuple(own[s:e + 1])] != (d, s)
                for j in range(at[s], at[e + 1] if e + 1 < len(at) else len(p))}
        out[d] = "".join(x for j, x in enumerate(p) if j not in gone)
    return out


def test_line_dedup_against_brute_force(spark, docs_of):
    from yardstick.llm.common import table
    passage = "\n".join(f"this shared passage has line {i} and {i * 3} more" for i in range(12))
    own = [f"own words of text {i} " + " ".join(f"q{i}x{j}" for j in range(i)) for i in range(40)]
    texts = [f"{own[i]}\n{passage}\n{own[i][::-1]}" if i % 2 else own[i] for i in range(40)]
    made = docs_of([*texts, texts[3], texts[5]])
    for docs in (made, table(spark, SF, "documents")):
        source = sorted((r.doc_id, r.text) for r in docs.collect())
        got = {r.doc_id: r.text for r in linededup.dedup_lines(docs).collect()}
        assert got == _brute_dedup(source)
    left = linededup.dedup_lines(made).collect()
    assert sum("line 6 and 18" in r.text for r in left) == 1  # one copy of the passage stays
    assert all(r.text == texts[r.doc_id] for r in left if r.doc_id < 40 and r.doc_id % 2 == 0)


def test_chunks_are_cut_once_and_first_places_hold_for_any_id(spark, monkeypatch):
    """Lines and chunks of a text are worked out and stored together; the first place is right for ids of any size and in texts that repeat themselves."""
    passage = [f"line {i} of a passage has {i * 3} and a few more" for i in range(6)]
    ids = [-(1 << 63), -5, -1, 0, 1, (1 << 31) - 1, 1 << 31, (1 << 32) - 1, 1 << 32, (1 << 32) + 1, 1 << 62, (1 << 63) - 2]
    texts = ["\n".join([f"own words of text {i} " + "x" * i, *passage[i % 4:], f"end {i}", *passage[:3], *passage[:2 + i % 3]]) for i in range(len(ids))]
    cuts, made, chunks, store = [], {}, linededup.chunks, linededup.store
    monkeypatch.setattr(linededup, "chunks", lambda *a: cuts.append(1) or chunks(*a))
    monkeypatch.setattr(linededup, "store", lambda df, name: made.update({name: df.columns}) or store(df, name))
    for some in (slice(None), slice(0, 3), slice(3, 8), slice(8, None)):
        docs = list(zip(ids, texts, strict=True))[some]
        df = spark.createDataFrame(docs[::-1], "doc_id long, text string")
        cuts.clear()
        assert {r.doc_id: r.text for r in linededup.dedup_lines(df).collect()} == _brute_dedup(docs)
        assert len(cuts) == 1
    assert "chunk-hashes" not in made and "w" not in made["line-hashes"]  # one table of lines and chunks, without word counts


def _repeated_words(docs, words):
    """Per document, which words lie in a run of `words` or more that an earlier document holds, by brute force."""
    seen, out = set(), []
    for t in docs:
        w = brute.words(t, lower=False)
        runs = [tuple(w[i:i + words]) for i in range(len(w) - words + 1)]
        hit = {j for i, r in enumerate(runs) if r in seen for j in range(i, i + words)}
        out.append([j in hit for j in range(len(w))])
        seen |= set(runs)
    return out


def test_short_pieces_between_other_neighbours_are_found(spark, docs_of, tmp_path):
    """Passages of 50 to 80 words in pieces under 12 words, whatever lies around them: every word goes, and no other."""
    rng = np.random.default_rng(8)
    fresh = iter(range(10 ** 6))
    say = lambda n: " ".join(f"w{next(fresh)}" for _ in range(n))
    texts = []
    for n, words in ((5, 11), (6, 9), (8, 7), (7, 11), (11, 5)) * 6:
        end = ("\n", ". ", "\n\n")[rng.integers(3)]
        passage = "".join(say(words) + end for _ in range(n))
        texts += ["".join(say(int(rng.integers(1, 12))) + ". " for _ in range(rng.integers(0, 4))) + passage
                  + "\n".join(say(int(rng.integers(1, 12))) for _ in range(rng.integers(0, 4))) for _ in range(3)]
    docs_of(texts).write.parquet(f"{tmp_path}/documents.parquet")
    left = {r.doc_id: r.text for r in linededup.op2_content_defined_lines(spark, str(tmp_path)).collect()}
    for i, (t, repeated) in enumerate(zip(texts, _repeated_words(texts, 50), strict=True)):
        assert brute.words(left[i], lower=False) == [w for w, r in zip(brute.words(t, lower=False), repeated, strict=True) if not r]


def test_every_removed_line_repeats_and_no_passage_stays(spark):
    """On the driver's table, by definitions that know no chunks: what goes lies in an earlier run, what stays in no passage."""
    from yardstick.llm.common import table
    source = sorted((r.doc_id, r.text) for r in table(spark, "/root/testdata/sf0.01", "documents").collect())
    left = {r.doc_id: r.text for r in linededup.op2_content_defined_lines(spark, "/root/testdata/sf0.01").collect()}
    where = collections.defaultdict(list)
    for d, t in source:
        own = _lines(t)[2]
        for j, x in enumerate(own):
            where[x].append((d, j))
    own_lines = {d: _lines(t)[2] for d, t in source}

    def said(d, j, run):
        """Whether the run of lines from j occurs before (for j of -1: in an earlier text)."""
        return any((o, k) < (d, j) and own_lines[o][k:k + len(run)] == run for o, k in where[run[0]])

    removed = passage = stayed = 0
    for d, t in source:
        own, kept = own_lines[d], collections.Counter(_lines(left[d])[2])
        lost = collections.Counter(own) - kept
        n = [len(brute.words(x)) for x in own]
        fair = collections.Counter()
        for j, x in enumerate(own):
            if not lost[x]:
                continue
            # a long line, or a run of two lines or more with ten words around it, occurs before
            ok = n[j] >= 12 and said(d, j, own[j:j + 1])
            for s in range(max(0, j - 12), j + 1):
                for e in range(max(s + 1, j), min(len(own), j + 13)):
                    ok = ok or (sum(n[s:e + 1]) >= 10 and said(d, s, own[s:e + 1]))
            fair[x] += ok
        removed += lost.total()
        assert lost <= fair, (d, lost - fair)
        for s in range(len(own)):  # the shortest runs of 50 words that an earlier text holds
            e = s
            while e < len(own) and sum(n[s:e + 1]) < 50:
                e += 1
            if e < len(own) and said(d, -1, own[s:e + 1]):
                passage += 1
                stayed += all(kept[x] for x in own[s:e + 1])
    assert removed > 200 and passage > 100
    assert stayed <= 0.01 * passage


def test_tabs_and_deep_indents(spark, docs_of):
    tabs = "\n".join("\t".join(f"v{i}x{j}" for j in range(14)) for i in range(3))
    deep = [f"def f{i}():\n    if a{i}:\n" + " " * 20 + f"return None\n    b{i}\n" for i in range(3)]
    left = {r.doc_id: r.text for r in linededup.dedup_lines(docs_of([f"{tabs}\nfirst end", f"{tabs}\nother end", *deep])).collect()}
    assert left[0] == f"{tabs}\nfirst end" and left[1] == "other end"
    assert [left[i] for i in (2, 3, 4)] == deep


def test_line_dedup_odd_rows(spark, odd, clash, empty):
    got = linededup.dedup_lines(clash)
    assert set(got.columns) == {*clash.columns, "n_removed"}
    before, after = odd.collect(), got.collect()
    assert len(before) == len(after)
    assert sum(r.text is None for r in after) == sum(r.text is None for r in before)
    assert linededup.dedup_lines(empty).count() == 0


def test_classifier_learns_and_holds_out(spark):
    from yardstick.llm.common import table
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    got = classifier.score_quality(docs, docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got)


def test_classifier_odd_rows(spark, odd, clash, empty):
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 0), (3, 1, 0), (4, 0, 1), (4, 1, 1), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = classifier.score_quality(clash, clash, labels, keep_columns=True)
    assert got.count() == odd.count() and set(clash.columns) <= set(got.columns)
    assert classifier.score_quality(empty, odd, labels).collect() == []
    neutral = classifier.score_quality(odd, odd, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in neutral} == {(0.5, 1)}


def test_dual_coordinate_descent_reaches_the_margin():
    rng = np.random.default_rng(0)
    idx = [np.unique(np.r_[rng.integers(0, 50, 5), 100 + (i % 2)]) for i in range(200)]
    y = np.where(np.arange(200) % 2, 1.0, -1.0)
    w, b = classifier.dual_coordinate_descent(idx, y, classifier.log_count_ratios(idx, y))
    assert all((sum(w[f]) + b) * v > 0 for f, v in zip(idx, y, strict=True))


@pytest.mark.parametrize("n", [1, 2, 5])
def test_repeated_words_windows(spark, docs_of, n):
    texts = [" ".join("abcde"[(i * n) % 5] for i in range(k)) for k in range(0, 12)]
    docs = docs_of(texts)
    got = dict(rows(quality.quality_rules(docs, docs.select("doc_id").limit(0)), "doc_id", "n_repeat_words"))
    assert got == {i: brute.base_rules(t)[4] for i, t in enumerate(texts)}
