"""Mixing, packing, sharding, url filter, trie and the pipeline."""

import collections
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tests.llm.conftest import SF
from yardstick.llm import eliasfano, lm, mixing, packing, sharding, urls
from yardstick.llm.common import numbered, store, table
from yardstick.session import scratch_path

# ---- mixing ----


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=12))
def test_pfair_windows_and_lag(shares):
    slots, q = mixing.earliest_deadline_first(shares), sum(shares)
    assert sorted(t for s in slots for t in s) == list(range(q))
    for w, own in zip(shares, slots, strict=True):
        assert all(i * q // w <= t < -(-(i + 1) * q // w) for i, t in enumerate(own))
        for t in range(q + 1):
            assert abs(sum(x < t for x in own) * q - t * w) < q  # less than one block


def test_mixing_keeps_every_row_and_its_share(spark, docs_of):
    texts = [f"t{i}" for i in range(600)]
    docs = docs_of(texts, sources=["big" if i % 3 else ("a", "b", None)[i // 3 % 3] for i in range(600)])
    got = mixing.schedule(docs, {"big": 3}, block_rows=4).collect()
    assert sorted(r.doc_id for r in got) == list(range(600))
    assert all(r.release <= r.slot < r.deadline for r in got)
    seen = {(r.slot, r.place) for r in got}
    assert len(seen) == 600
    by_slot = {r.slot: r.source for r in got}
    for t in range(1, 300, 7):  # while no source has run out
        for s, w in (("big", 3), ("a", 1), ("b", 1), (None, 1)):
            n = sum(by_slot.get(x) == s and x in by_slot for x in range(min(t, 90)))
            assert abs(n - min(t, 90) * w / 6) < 1
    for s in ("big", "a", "b", None):
        own = sorted((r.block, r.place) for r in got if r.source == s)
        assert own == [(i // 4, i % 4) for i in range(len(own))]


def test_mixed_rows_are_laid_out_in_order(spark, odd, clash, empty):
    out = mixing.mixed(clash, {"src0": 2}, block_rows=2)
    assert out.columns == clash.columns and out.count() == clash.count()
    assert mixing.schedule(empty, {"src0": 2}).collect() == []
    with pytest.raises(ValueError):
        mixing.schedule(odd, {"src0": 0})
    made = mixing.schedule(odd, {}, block_rows=1).select("doc_id", "slot").collect()
    order = [r.doc_id for r in sorted(made, key=lambda r: r.slot)]
    assert [r.doc_id for r in mixing.mixed(odd, {}, block_rows=1).select("doc_id").collect()] == order


def test_numbering_is_gapless(spark):
    df = spark.range(500).select(F.col("id"), F.when(F.col("id") % 5 == 0, "x").otherwise("hot").alias("key"))
    got = numbered(df.unionByName(df), "key", ["id"], "i").collect()
    for key in ("x", "hot"):
        assert sorted(r.i for r in got if r.key == key) == list(range(sum(r.key == key for r in got)))


# ---- packing ----


@given(st.integers(0, 9000))
def test_cut_adds_up(n):
    parts = packing.cut(n, 2048, 0.02)
    assert sum(parts) == n and all(0 < p <= 2048 for p in parts)


def _check_packing(got, texts):
    encode = packing.Encoder(packing.tokenizer_path()).model.encode
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for d, own in by_doc.items():
        ids = np.array(encode(texts[d] or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    return sum(r.length for r in got) / (2048 * len(by_sequence))


def test_packing_round_trip(spark, docs_of, empty):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = packing.pack_documents(docs).collect()
    assert _check_packing(got, {r.doc_id: r.text for r in docs.collect()}) > 0.97
    texts = [None, "", "  two  spaces ", "a\n\nb", "<|endoftext|> it's", "word " * 5000, "é　ü\u00a0x"] + ["copy"] * 40
    got = packing.pack_documents(docs_of(texts)).collect()
    _check_packing(got, dict(enumerate(texts)))
    assert packing.pack_documents(empty).collect() == []


def test_packing_odd_rows(spark, odd, clash):
    pieces = packing.pack_documents(clash).collect()
    assert sum(r.length for r in pieces) == sum(r.doc_tokens for r in pieces if r.start == 0)
    assert sum(r.doc_id is None for r in pieces) >= 2  # rows without an id are packed as well


def test_packing_numbers_the_pieces_once(spark):
    """The plan of the last step holds what follows the numbering, not the numbering in each of its branches."""
    docs = store(table(spark, SF, "documents"), "t")
    plan = packing.pack_stored(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") <= 20


def test_full_sequences_hold_exactly_k_pieces(spark):
    docs = table(spark, SF, "documents")
    stored = store(packing.pieces(docs, packing.tokenizer_path(), keep_ids=True), "t")
    got = packing.pack(stored).collect()
    assert all(len(r.ids) == r.length for r in got)
    own = collections.defaultdict(list)
    for r in got:
        own[r.sequence_id].append(r.k)
    whole = [k for k in own.values() if len(set(k)) == 1 and len(k) == k[0]]
    assert len(whole) > 0.5 * len(own)


# ---- sharding ----


def test_shards(spark, odd, clash, empty):
    docs = table(spark, SF, "documents")
    got = sharding.op10_external_shuffle(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs.collect())
    text = {r.doc_id: r.text for r in docs.collect()}
    count = collections.Counter(r.shard for r in got)
    assert set(count) <= set(range(8)) and max(count.values()) - min(count.values()) <= 1
    for r in got:
        raw = text[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(count[s]))
    again = sharding.external_shuffle(docs.repartition(7).select("doc_id"), ["doc_id"]).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in again} == {(r.doc_id, r.shard, r.slot) for r in
            sharding.external_shuffle(docs.select("doc_id"), ["doc_id"]).collect()}
    assert sharding.external_shuffle(empty.select("doc_id"), ["doc_id"]).collect() == []
    wide = sharding.external_shuffle(clash, ["doc_id", "text"], shards=3)
    assert wide.count() == clash.count() and set(wide.columns) == set(clash.columns)


def test_repeated_rows_scatter(spark):
    df = spark.range(3000).select((F.col("id") % 3 * F.lit(0)).alias("doc_id"))  # one key holds every row
    got = sharding.external_shuffle(df, ["doc_id"], rows_per_bucket=100).collect()
    count = collections.Counter(r.shard for r in got)
    assert sorted(count.values()) == [375] * 8
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(375)) for s in range(8))


def test_only_repeated_records_move_twice(spark, tmp_path):
    """Records of 2 KB, one in four repeated: only those cross an exchange before the scatter, and all are shuffled as if each did."""
    def moved(df):
        """Bytes that the exchanges of a plan wrote."""
        total, todo = 0, [df._jdf.queryExecution().executedPlan()]
        while todo:
            p = todo.pop()
            if p.nodeName() == "AdaptiveSparkPlan":
                todo.append(p.executedPlan())
            elif "QueryStage" in p.nodeName():
                todo.append(p.plan())
            elif p.nodeName() != "ReusedExchange":
                if p.nodeName() == "Exchange":
                    total += p.metrics().apply("dataSize").value()
                todo += [p.children().apply(i) for i in range(p.children().size())]
        return total

    alone = spark.range(2000).select(F.col("id").alias("doc_id"), F.repeat(F.md5(F.col("id").cast("string")), 64).alias("text"))
    for name, source, most in (("alone", alone, 1.25), ("some", alone.unionByName(alone.where("doc_id % 4 = 0")), 2)):
        source.repartition(5).write.parquet(f"{tmp_path}/{name}")
        df = spark.read.parquet(f"{tmp_path}/{name}")
        out = sharding.external_shuffle(df, ["doc_id", "text"])
        got = out.collect()
        assert collections.Counter((r.doc_id, r.text) for r in got) == collections.Counter((r.doc_id, r.text) for r in df.collect())
        count = collections.Counter(r.shard for r in got)
        assert max(count.values()) - min(count.values()) <= 1
        assert all(sorted(r.slot for r in got if r.shard == s) == list(range(count[s])) for s in range(8))
        size = df.agg(F.sum(F.length("text"))).first()[0]
        assert size < moved(out) < most * size, name
        again = sharding.external_shuffle(df.repartition(3), ["doc_id", "text"]).collect()
        assert sorted(again) == sorted(got)


def test_written_shards_hold_whole_records(spark, odd):
    path = scratch_path(spark, "shards")
    sharding.write_shards(odd, path, ["doc_id", "text"], shards=4)
    back = spark.read.parquet(path)
    key = lambda r: repr((r.doc_id, r.text, r.source))
    assert sorted(map(key, back.collect())) == sorted(map(key, odd.collect()))


def test_long_records_get_more_buckets(spark, docs_of):
    """Texts of 1 MB: buckets are sized by bytes, every record comes back whole, shards stay within one row."""
    docs = docs_of([chr(97 + i % 26) * (1 << 20) for i in range(40)] + ["short"] * 200)
    path = scratch_path(spark, "long-shards")
    sharding.write_shards(docs, path, docs.columns, shards=8, bytes_per_bucket=2 << 20)
    back = spark.read.parquet(path)
    per = [r["count"] for r in back.groupBy("shard").count().collect()]
    assert sum(per) == 240 and max(per) - min(per) <= 1
    got = back.select("doc_id", F.md5(F.col("text").cast("binary")).alias("m"), "n_chars").collect()
    assert sorted(got) == sorted(docs.select("doc_id", F.md5(F.col("text").cast("binary")).alias("m"), "n_chars").collect())
    assert sharding.buckets_needed(docs, bytes_per_bucket=2 << 20).first().n in (21, 22)  # 40 MB of texts
    assert sharding.buckets_needed(docs, rows_per_bucket=10).first().n == 24


# ---- urls ----


def _brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:end].translate(brute.AZ), rest[end:]
    path = tail[:min([tail.index(c) for c in "?#" if c in tail] or [len(tail)])]
    best = (None, None)
    for says, text in urls.RULES:
        name, _, p = text.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + p) and len(text) > len(best[0] or ""):
            best = (text, says)
    return host, path, *best


def test_rules_and_hosts(spark):
    odd = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/x?q#f", "http://example.org/en/12", "http://notexample.org/es/",
           "http://org/", "http://org", "a://b://c/d", "x://É.com/fr/", "http://com/de/?", "http://h.com?x/de/", "://a.net/p\nq?r"]
    rows = [(i, u) for i, u in enumerate(odd)] + [(100 + r.page_id, r.url) for r in table(spark, SF, "pages").collect()]
    got = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()
    url = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        host, path, rule, says = _brute_rule(url[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (says or ("block" if r.host_bound > urls.LIMIT else "allow"))


def test_reputation_blocks_bad_hosts_and_shrinks(spark):
    rows = [("bad.x.com", True)] * 50 + [("good.y.com", False)] * 50 + [("bad.x.com", None), ("one.z.com", True), ("new.x.com", None), ("new.q.com", None)]
    rows += [(f"h{i}.m{i}.com", j < 8 + i % 5) for i in range(12) for j in range(20)]  # half good, half bad
    got = {r.host: r for r in urls.host_reputation(spark.createDataFrame(rows, "host string, blocked boolean")).collect()}
    assert got["bad.x.com"].bound > 0.5 > got["good.y.com"].mean
    assert got["one.z.com"].bound < 0.5  # one outcome is not enough
    assert got["new.x.com"].mean > got["new.q.com"].mean  # its domain is known
    assert urls.host_reputation(spark.createDataFrame([], "host string, blocked boolean")).collect() == []
    assert urls.filter_urls(spark.createDataFrame([], "page_id long, url string")).collect() == []
    alone = urls.filter_urls(spark.createDataFrame([(None, "http://n.net/a", "k")] * 3, "page_id long, url string, domain string")).collect()
    assert len(alone) == 3 and {r.verdict for r in alone} == {"allow"}


# ---- trie ----


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1), max_size=80), st.integers(0, 60), st.lists(st.integers(0, (1 << 64) - 1), max_size=30))
def test_elias_fano(values, shift, others):
    values = np.array(sorted({v >> shift for v in values}), np.uint64)
    ef = eliasfano.EliasFano(eliasfano.from_buffer(eliasfano.to_bytes(eliasfano.encode(values, "x"))), "x")
    assert (ef[np.arange(len(values))] == values).all()
    asked = np.array([*values.tolist(), *others, *[(int(v) + 1) % (1 << 64) for v in values]], np.uint64)
    place = {int(v): i for i, v in enumerate(values)}
    assert ef.find(asked).tolist() == [place.get(int(v), -1) for v in asked]


def _brute_scores(train, texts):
    tok = lambda t: [*brute.words(t), None]
    one, two, three = (collections.Counter() for _ in range(3))
    for t in train:
        t = tok(t)
        one.update(t)
        two.update(zip(t, t[1:], strict=False))
        three.update(zip(t, t[1:], t[2:], strict=False))
    n, v, d = sum(one.values()), len(one), lm.DISCOUNT
    mass = collections.Counter()
    for counts in (two, three):
        for k, c in counts.items():
            if c >= 2:
                mass[k[:-1]] += c - d
    out = []
    for t in map(tok, texts):
        base = score = 0.0
        for i, w in enumerate(t):
            p = (one[w] + 0.5) / (n + 0.5 * (v + 1))
            base += np.log10(p)
            if i and one[t[i - 1]]:
                k = (t[i - 1],)
                p = (1 - mass[k] / one[k[0]]) * p + ((two[k + (w,)] - d) / one[k[0]] if two[k + (w,)] >= 2 else 0)
                k = (t[i - 2], *k) if i > 1 else None
                if k and two[k] >= 2:
                    p = (1 - mass[k] / two[k]) * p + ((three[k + (w,)] - d) / two[k] if three[k + (w,)] >= 2 else 0)
            score += np.log10(p)
        out.append((len(t), sum(one[w] > 0 for w in t), n, base, score))
    return out


@pytest.mark.parametrize("shard", [2_000_000, 40])
def test_trie_scores_against_brute_force(spark, docs_of, monkeypatch, shard):
    monkeypatch.setattr(lm, "SHARD_TOKENS", shard)  # many shards: contexts that span them
    monkeypatch.setattr(lm, "RUN_KEYS", 50)
    rng = random.Random(shard)
    texts = [" ".join(rng.choice("the the the a of X y zz é w".split()) for _ in range(rng.randrange(0, 60))) for _ in range(40)] + [None, "", "unseen words"]
    docs = docs_of(texts).repartition(3)
    model = lm.train(docs.where("doc_id < 30"), scratch_path(spark, "trie"))
    assert 3 in model.levels
    got = {r.doc_id: r for r in lm.score(docs, model).collect()}
    for i, (n, known, total, base, score) in enumerate(_brute_scores(texts[:30], texts)):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(score, abs=4e-4 * n)


def _brute_whole_scores(train, texts):
    """log10 p of each text by a model that drops no pair or triple."""
    tok = lambda t: [*brute.words(t), None]
    counts, mass = collections.Counter(), collections.Counter()
    for t in map(tok, train):
        counts.update(tuple(t[i:i + n]) for n in (1, 2, 3) for i in range(len(t) - n + 1))
    for k, c in counts.items():
        mass[k[:-1]] += c - lm.DISCOUNT
    total, v = sum(c for k, c in counts.items() if len(k) == 1), sum(len(k) == 1 for k in counts)
    out = []
    for t in map(tok, texts):
        score = 0.0
        for i, w in enumerate(t):
            p = (counts[w,] + 0.5) / (total + 0.5 * (v + 1))
            for context in (tuple(t[i - n:i]) for n in (1, 2) if i >= n):
                if counts[context]:
                    own = counts[(*context, w)]
                    p = (1 - mass[context] / counts[context]) * p + max(own - lm.DISCOUNT, 0) / counts[context]
            score += np.log10(p)
        out.append((len(t), score))
    return out


@pytest.mark.parametrize("shard", [2_000_000, 40])
def test_trie_query_keeps_pairs_and_triples_seen_once(spark, docs_of, monkeypatch, tmp_path, shard):
    monkeypatch.setattr(lm, "SHARD_TOKENS", shard)
    monkeypatch.setattr(lm, "RUN_KEYS", 50)
    rng = random.Random(shard)
    texts = [" ".join(f"w{int(rng.random() ** 3 * 40)}" for _ in range(rng.randrange(0, 40))) for _ in range(50)] + [None, "", "unseen words"]
    docs_of(texts).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in lm.op7_elias_fano_trie(spark, str(tmp_path)).collect()}
    train = [t for i, t in enumerate(texts) if not got[i].held_out]
    assert 0 < len(train) < len(texts)
    for i, (n, score) in enumerate(_brute_whole_scores(train, texts)):
        assert got[i].score == pytest.approx(score, abs=4e-4 * n)


def test_trie_counts_take_a_byte_and_stay_exact(spark, docs_of):
    """Counts and masses on both sides of 255 come back exactly; a level's file has a byte a count, and two a context."""
    texts = [" ".join(f"w{i}" for i in range(400)), *["b c"] * 254, *["d e"] * 255, *["f g"] * 256, "a " * 70_000]
    model = lm.train(docs_of(texts), scratch_path(spark, "trie"), min_count=1)
    h, at = lm.tokens(pa.array(texts))
    one, two = collections.Counter(h.tolist()), collections.Counter()
    number, count, word = model.words(h)
    assert [int(c) for c in count[word]] == [one[x] for x in h.tolist()]
    keys = model.pairs(number[word], at)
    keys = np.unique(keys[keys != lm.NONE], return_counts=True)
    places = model.levels[2].find(keys[0])
    assert (places >= 0).all() and (model.levels[2].at("count", places) == keys[1]).all()
    for k, n in zip(keys[0].tolist(), keys[1].tolist(), strict=True):
        two[k // model.fan[2]] += n - lm.DISCOUNT
    mass, _ = model.levels[2].context(np.array(sorted(two), np.uint64), model.fan[2])
    assert mass.tolist() == [two[c] for c in sorted(two)]
    for level in (2, 3):
        for s, meta in enumerate(model.levels[level].metas):
            held = {k: v.nbytes for k, v in lm._get(model.levels[level].paths[s]).items() if not k.startswith(("key.", "context.", "start.", "p"))}
            large = sum(v for k, v in held.items() if k.endswith((".big", ".value")))
            assert sum(held.values()) - large <= 3 * meta[1] and large <= 8 * 2 * 3 * 8


def test_trie_odd_rows(spark, odd, clash, empty):
    model = lm.train(clash, scratch_path(spark, "trie"))
    assert lm.score(clash, model).count() == clash.count()
    nothing = lm.train(empty, scratch_path(spark, "trie"))
    assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in lm.score(odd, nothing).collect()} == {(0, 0, 0.0, 0.0)}


def test_trie_beats_its_base_on_held_out_text(spark):
    got = lm.op7_elias_fano_trie(spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("base_score"), F.sum("score")).collect()[0]
    assert got[1] > got[0]


# ---- pipeline ----


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, store(stage(spark, docs, SF), "t")
        if name != "packing":
            assert docs.columns == before.columns, name
        if name in ("line_dedup", "source_mixing"):
            assert docs.count() == before.count(), name
    assert docs.agg(F.count_distinct("doc_id")).collect()[0][0] == before.count()


def test_the_mix_reaches_the_sequences(spark, docs_of):
    """Any stretch of the packed sequences has the target shares while the sources last, though src0 has most rows."""
    rng = random.Random(5)
    texts = [" ".join(rng.choice("alpha beta gamma delta epsilon".split()) for _ in range(rng.randrange(330, 370))) for _ in range(4000)]
    source = {i: "src0" if i % 10 else "src1" for i in range(len(texts))}
    docs = docs_of(texts, sources=list(source.values())).repartition(5)
    mix = store(corpus_pipeline.source_mixing(spark, docs, SF), "t")
    shares = {}
    for name, rows in (("with", mix), ("without", store(docs, "t"))):
        by_sequence = collections.defaultdict(collections.Counter)
        for r in corpus_pipeline.packing(spark, rows, SF).collect():
            by_sequence[r.sequence_id][source[r.doc_id]] += r.length
        assert sorted(by_sequence) == list(range(len(by_sequence)))  # no gap
        lasting = 400 * 5 * 350 // 2048 - 130  # src1 has 400 rows of every fifth
        shares[name] = []
        for a in range(0, lasting - 100, 20):
            own = sum((by_sequence[s] for s in range(a, a + 100)), collections.Counter())
            shares[name].append(own["src1"] / own.total())
    assert all(abs(x - 0.2) < 0.06 for x in shares["with"])
    assert all(abs(x - 0.2) > 0.06 for x in shares["without"])


def test_pipeline_odd_rows(spark, clash, tmp_path):
    labels = spark.createDataFrame([(0, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for rows in (clash, clash.limit(0)):
        docs = rows
        for _, stage in corpus_pipeline.STAGES:
            docs = store(stage(spark, docs, str(tmp_path)), "t")
        assert docs.agg(F.coalesce(F.sum("length"), F.lit(0))).collect()[0][0] >= rows.limit(1).count()
