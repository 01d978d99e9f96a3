"""Language-model scoring with an Elias-Fano n-gram trie.

Three levels, each counted over all training texts and cut into shards by ranges of its
sorted keys, one file a shard in the shared folder, memory-mapped by the tasks that read it:

1. words: Elias-Fano coded word hashes; a word's place is its number; exact counts;
2. pairs: (number of the first word, number of the second);
3. triples: (place of the pair in level 2, rank of the third word among the successors of the
   second) - the context-relative number, found by successor search in level 2.

The query keeps every pair and triple that it counts; `train` alone can drop the rare ones (min_count).

Levels 2 and 3 also hold, for every context, a monotone pointer to its first successor, the count of all
successors and that of different ones: their probability mass. Counts take a byte each, those of 255 and more are listed apart. Probabilities are interpolated absolute discounting:
p(w | c) = max(n(c w) - D, 0) / n(c) + lambda(c) p(w | shorter c), lambda(c) the mass that is left, down to
the smoothed word probability; stored as 16-bit log codes. What a task gathers is bounded: it
sends sorted runs of counted keys, a shard's runs meet in one task, and keys are spread
over shards by a bounded sample of keys (which only moves the limits of shards).
"""

from __future__ import annotations

import functools
import mmap
import os
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yardstick.llm.classifier import sums
from yardstick.llm.common import partitions, table
from yardstick.llm.eliasfano import EliasFano, encode, from_buffer, to_bytes
from yardstick.llm.textvec import by_bytes, words
from yardstick.session import scratch_path

DISCOUNT = 0.75
MIN_COUNT = 2  # of pairs and triples that `train` keeps unless told; the mass of the others goes to the shorter context
SHARD_TOKENS = 2_000_000
RUN_KEYS = 3_000_000  # keys that a task gathers before it sends a run
SAMPLE_TEXTS = 512
SAMPLE_KEYS = 128  # of each sampled text
CODES = 4096  # steps of a code per power of ten
END = np.uint64(0x8F1BBCDC5A827999)
U = np.uint64
NONE = ~U(0)  # a key that no level holds


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes end to end (an end token closes each text) and offsets."""
    w = words(texts)
    n = np.diff(w.first)
    at = np.concatenate([[0], np.cumsum(n + 1)])
    out = np.empty(at[-1], U)
    ends = at[1:] - 1
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner] = w.hash
    out[ends] = END
    return out, at


def unique(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their counts."""
    if counts is None:
        keys = np.sort(keys)
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        return keys[starts], np.diff(np.append(starts, len(keys)))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def _planes(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes())


def _from_planes(raw: bytes, dtype) -> np.ndarray:
    got = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(got.reshape(np.dtype(dtype).itemsize, -1).T).reshape(-1).view(dtype)


def _code(p: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-np.log10(p) * CODES), 0, 65535).astype(np.uint16)


def _value(code: np.ndarray) -> np.ndarray:
    return np.power(10.0, code / -float(CODES))


def _small(values: np.ndarray, name: str) -> dict[str, np.ndarray]:
    """Arrays of counts, a byte each; those of 255 and more are listed whole beside them."""
    big = np.flatnonzero(values >= 255)
    return {name: np.minimum(values, 255).astype(np.uint8), f"{name}.big": big, f"{name}.value": values[big].astype(np.int64)}


class Small:
    def __init__(self, arrays: dict[str, np.ndarray], name: str):
        self.low, self.big, self.value = (arrays[k] for k in (name, f"{name}.big", f"{name}.value"))

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """Values at places i."""
        out = self.low[i].astype(np.int64)
        over = np.flatnonzero(out == 255)
        out[over] = self.value[np.searchsorted(self.big, i[over])]
        return out


# ---- files ---------------------------------------------------------------------------


def _put(path: str, raw: bytes) -> None:
    """Write a file whole or not at all; a repeated task writes the same bytes."""
    fs, where = pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), _local(path))
    fs.create_dir(os.path.dirname(where), recursive=True)
    part = f"{where}.{os.getpid()}.{np.random.SeedSequence().entropy:x}"
    with fs.open_output_stream(part) as out:
        out.write(raw)
    fs.move(part, where)


def _local(path: str) -> str | None:
    u = urlparse(path)
    return u.path if u.scheme in ("", "file") else None


@functools.lru_cache(maxsize=4096)
def _get(path: str) -> dict[str, np.ndarray]:
    local = _local(path)
    if local is not None:
        with open(local, "rb") as f:
            return from_buffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
    fs, where = pyarrow.fs.FileSystem.from_uri(path)
    with fs.open_input_file(where) as f:
        return from_buffer(f.read_buffer())


# ---- the model -----------------------------------------------------------------------


class Level:
    """The shards of one level, opened as they are needed. metas: (shard, n, first key, last key), by shard."""

    def __init__(self, folder: str, level: int, metas: list[tuple]):
        self.metas = sorted(metas, key=lambda m: m[0])
        self.paths = [f"{folder}/{level}-{m[0]:06d}.ef" for m in self.metas]
        self.base = np.concatenate([[0], np.cumsum([m[1] for m in self.metas])]).astype(np.int64)
        self.first = np.array([m[2] for m in self.metas], U)
        self.n = int(self.base[-1])
        self.open: dict = {}

    def __getstate__(self):
        return self.__dict__ | {"open": {}}

    def part(self, s: int, name: str):
        if (s, name) not in self.open:
            arrays = _get(self.paths[s])
            kind = EliasFano if f"{name}.head" in arrays else Small if f"{name}.big" in arrays else None
            self.open[s, name] = kind(arrays, name) if kind else arrays[name]
        return self.open[s, name]

    def _split(self, shard: np.ndarray):
        """Shard number and the run of each, of sorted shard numbers."""
        if len(shard):
            starts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
            for a, b in zip(starts, np.append(starts[1:], len(shard)), strict=True):
                if shard[a] >= 0:
                    yield int(shard[a]), slice(int(a), int(b))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of sorted keys, or -1."""
        out = np.full(len(keys), -1, np.int64)
        for s, r in self._split(np.searchsorted(self.first, keys, "right") - 1):
            got = self.part(s, "key").find(keys[r])
            out[r] = np.where(got >= 0, got + self.base[s], -1)
        return out

    def at(self, name: str, places: np.ndarray) -> np.ndarray:
        """Values of an array at sorted places."""
        out = None
        for s, r in self._split(np.searchsorted(self.base, places, "right") - 1):
            got = np.asarray(self.part(s, name)[places[r] - self.base[s]])
            out = np.zeros(len(places), got.dtype) if out is None else out
            out[r] = got
        return out if out is not None else np.zeros(len(places))

    def context(self, contexts: np.ndarray, fan: int) -> tuple[np.ndarray, np.ndarray]:
        """Successor mass and place of the first successor (-1: none) of sorted contexts; one may span shards."""
        mass, start = np.zeros(len(contexts)), np.full(len(contexts), -1, np.int64)
        if not self.metas or not len(contexts):
            return mass, start
        lo = np.maximum(np.searchsorted(self.first, contexts * U(fan), "right") - 1, 0)
        hi = np.searchsorted(self.first, contexts * U(fan) + U(fan - 1), "right") - 1
        for step in range(int((hi - lo).max()) + 1):
            rows = np.flatnonzero(lo + step <= hi)
            for s, r in self._split((lo + step)[rows]):
                got = self.part(s, "context").find(contexts[rows[r]])
                ok = got >= 0
                hit = rows[r][ok]
                mass[hit] += self.part(s, "total")[got[ok]] - DISCOUNT * self.part(s, "kinds")[got[ok]]
                begin = self.part(s, "start")[got[ok]].astype(np.int64) + self.base[s]
                start[hit] = np.where(start[hit] < 0, begin, start[hit])
        return mass, start


class Model:
    def __init__(self, folder: str, tokens_: int, metas: dict[int, list]):
        self.folder, self.tokens = folder, tokens_
        self.levels = {k: Level(folder, k, m) for k, m in metas.items()}
        self.fan = {2: max(1, self.levels[1].n), 3: 1}

    def words(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the distinct words (-1: unknown), their counts, and each token's place among them."""
        distinct, back = np.unique(h, return_inverse=True)
        ids = self.levels[1].find(distinct)
        counts = np.zeros(len(distinct), np.int64)
        known = ids >= 0
        counts[known] = self.levels[1].at("count", ids[known])
        return ids, counts, back

    def pairs(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Key of (previous token, token) at every token; NONE where a text starts or either is unknown."""
        keys = np.full(len(ids), NONE, U)
        ok = np.zeros(len(ids), bool)
        ok[1:] = (ids[1:] >= 0) & (ids[:-1] >= 0)
        ok[at[:-1]] = False
        i = np.flatnonzero(ok)
        keys[i] = ids[i - 1].astype(U) * U(self.fan[2]) + ids[i].astype(U)
        return keys

    def place(self, level: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct keys' places in a level (-1: not kept), and every token's place among the distinct ones."""
        distinct, back = np.unique(keys, return_inverse=True)
        places = self.levels[level].find(distinct)
        if len(distinct) and distinct[-1] == NONE:
            places[-1] = -1
        return places, back

    def contexts(self, level: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Successor mass and first successor of ascending places of the level below (-1 among them: no context)."""
        mass, start = np.zeros(len(places)), np.full(len(places), -1, np.int64)
        known = places >= 0
        mass[known], start[known] = self.levels[level].context(places[known].astype(U), self.fan[level])
        return mass, start

    def triples(self, place2: np.ndarray, start: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Key of (pair before, rank of the token among the successors of the token before) at every token.

        place2: place of the pair that each token closes; start: first successor of each token.
        """
        keys = np.full(len(place2), NONE, U)
        ok = np.zeros(len(place2), bool)
        ok[1:] = (place2[1:] >= 0) & (place2[:-1] >= 0)
        ok[at[:-1]] = False
        i = np.flatnonzero(ok)
        keys[i] = place2[i - 1].astype(U) * U(self.fan[3]) + (place2[i] - start[i - 1]).astype(U)
        return keys

    def logs(self, h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 p of every token: smoothed alone, in context; and whether it is known."""
        number, count, word = self.words(h)
        alone = ((count + 0.5) / (self.tokens + 0.5 * (self.levels[1].n + 1)))[word]
        p = alone
        if 2 in self.levels:
            inner = np.ones(len(h), bool)
            inner[at[:-1]] = False
            inner = np.flatnonzero(inner)  # tokens with a token before them in their text
            mass, start = self.contexts(2, number)
            keys = self.pairs(number[word], at)
            places, pair = self.place(2, keys)
            p = self._interpolate(2, p, inner, mass, start, count, word, places, pair)
            if 3 in self.levels:
                keys = self.triples(places[pair], start[word], at)
                mass, start = self.contexts(3, places)
                count = np.zeros(len(places), np.int64)
                count[places >= 0] = self.levels[2].at("count", places[places >= 0])
                p = self._interpolate(3, p, inner, mass, start, count, pair, *self.place(3, keys))
        return np.log10(alone), np.log10(p), (number >= 0)[word]

    def _interpolate(self, level: int, lower: np.ndarray, inner, mass, start, count, context, places, back) -> np.ndarray:
        """lambda(context) * lower + the kept part. mass, start and count are by distinct context; `context` is the place
        among them of the one that each token closes; places and back are of the tokens' own keys."""
        left = np.where(start >= 0, 1 - mass / np.maximum(count, 1), 1.0)
        out = lower.copy()
        out[inner] *= left[context[inner - 1]]
        own = np.zeros(len(places))
        own[places >= 0] = _value(self.levels[level].at("p", places[places >= 0]))
        return out + own[back]


# ---- building ------------------------------------------------------------------------


def _runs(keys_of, shard_of):
    """Count the keys of a partition's texts and send them as sorted, compressed runs by shard."""
    def flush(parts):
        keys, counts = unique(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
        if not len(keys):
            return
        shard = shard_of(keys)
        starts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
        cols: dict = {"shard": [], "keys": [], "counts": [], "n": []}
        for a, b in zip(starts, [*starts[1:], len(shard)], strict=True):
            k = keys[a:b]
            cols["shard"].append(int(shard[a]))
            cols["keys"].append(_planes(np.concatenate([k[:1], np.diff(k)])))
            cols["counts"].append(_planes(counts[a:b].astype(np.uint32)))
            cols["n"].append(int(counts[a:b].sum()))
        yield pa.RecordBatch.from_arrays([pa.array(cols["shard"], pa.int32()), pa.array(cols["keys"], pa.binary()),
                                          pa.array(cols["counts"], pa.binary()), pa.array(cols["n"], pa.int64())], list(cols))

    def run(batches):
        parts, size = [], 0
        for batch in batches:
            for part in by_bytes(batch, "text"):
                got = unique(keys_of(*tokens(part.column("text"))))
                parts.append(got)
                size += len(got[0])
                if size >= RUN_KEYS:
                    yield from flush(parts)
                    parts, size = [], 0
        if parts:
            yield from flush(parts)

    return run


def _build(folder: str, level: int, make):
    """A shard's file from its runs; one row about it."""
    def run(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        keys = np.concatenate([np.cumsum(_from_planes(k.as_py(), U), dtype=U) for k in group.column("keys")])
        counts = np.concatenate([_from_planes(c.as_py(), np.uint32) for c in group.column("counts")]).astype(np.int64)
        keys, counts = unique(keys, counts)
        total = int(counts.sum())
        keys, arrays, most = make(keys, counts)
        if len(keys):
            _put(f"{folder}/{level}-{shard:06d}.ef", to_bytes(encode(keys, "key") | arrays))
        ends = [int(keys[0]), int(keys[-1])] if len(keys) else [0, 0]
        return pa.table({"shard": pa.array([shard], pa.int32()), "n": pa.array([len(keys)], pa.int64()),
                         "first": pa.array([str(ends[0])]), "last": pa.array([str(ends[1])]),
                         "total": pa.array([total], pa.int64()), "most": pa.array([most], pa.int64())})
    return run


def _level(texts: DataFrame, folder: str, level: int, keys_of, shard_of, make) -> tuple[list, int, int]:
    """Count, build and write a level. Returns its metas, all counts, and the most successors of a context."""
    counted = texts.mapInArrow(_runs(keys_of, shard_of), "shard int, keys binary, counts binary, n long")
    rows = counted.groupBy("shard").applyInArrow(_build(folder, level, make), "shard int, n long, first string, last string, total long, most long").collect()
    metas = [(r["shard"], r["n"], int(r["first"]), int(r["last"])) for r in rows if r["n"]]
    return metas, sum(r["total"] for r in rows), max([0, *(r["most"] for r in rows)])


def _kept(contexts_count, fan: int, min_count: int):
    """Keep keys seen min_count times; contexts_count(sorted contexts) gives their own counts."""
    def make(keys, counts):
        keep = counts >= min_count
        keys, counts = keys[keep], counts[keep]
        if not len(keys):
            return keys, {}, 0
        context = keys // U(fan)
        starts = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
        own = context[starts]
        kinds = np.diff(np.append(starts, len(keys)))
        n = np.repeat(contexts_count(own), kinds)
        return keys, {"p": _code((counts - DISCOUNT) / n), **_small(counts, "count"),
                      **_small(np.add.reduceat(counts, starts), "total"), **_small(kinds, "kinds"),
                      **encode(own, "context"), **encode(starts.astype(U), "start")}, int(kinds.max())
    return make


def _limits(texts: DataFrame, keys_of, shards: int) -> np.ndarray:
    """Shard limits from a bounded sample of keys: SAMPLE_KEYS of each of SAMPLE_TEXTS texts, the first in hash order."""
    def run(batches):
        for batch in batches:
            for part in by_bytes(batch, "text"):
                h, at = tokens(part.column("text"))
                keys = keys_of(h, at)
                yield pa.RecordBatch.from_pydict({"key": pa.array([str(k) for k in keys[:: max(1, len(keys) // (SAMPLE_KEYS * part.num_rows))]], pa.string())})

    sample = texts.orderBy(F.xxhash64("doc_id"), F.xxhash64("text")).limit(SAMPLE_TEXTS)
    keys = np.sort(np.array([int(r["key"]) for r in sample.mapInArrow(run, "key string").collect()], U))
    if shards < 2 or not len(keys):
        return np.zeros(0, U)
    return np.unique(keys[np.arange(1, shards) * len(keys) // shards])


def train(texts: DataFrame, folder: str, min_count: int = MIN_COUNT) -> Model:
    """Build the trie of texts (doc_id, text) in folder, which all executors must share. Empty input gives an empty model.

    Pairs and triples seen min_count times are kept; 1 keeps all.
    """
    p = partitions(texts.sparkSession)

    def words_made(keys, counts):
        return keys, _small(counts, "count"), 0

    by_hash = lambda keys: ((keys >> U(32)) * U(p) >> U(32)).astype(np.int64)
    metas, total, _ = _level(texts, folder, 1, lambda h, at: h, by_hash, words_made)
    model = Model(folder, total, {1: metas})
    shards = max(p, -(-total // SHARD_TOKENS))

    def pair_keys(h, at):
        number, _, back = model.words(h)
        keys = model.pairs(number[back], at)
        return keys[keys != NONE]

    def triple_keys(h, at):
        number, _, word = model.words(h)
        _, start = model.contexts(2, number)
        places, pair = model.place(2, model.pairs(number[word], at))
        keys = model.triples(places[pair], start[word], at)
        return keys[keys != NONE]

    def grow(level, keys_of, count_of):
        limits = _limits(texts, keys_of, shards)
        shard_of = lambda keys: np.searchsorted(limits, keys, "right")
        return _level(texts, folder, level, keys_of, shard_of, _kept(count_of, model.fan[level], min_count))

    metas, _, most = grow(2, pair_keys, lambda c: model.levels[1].at("count", c.astype(np.int64)).astype(np.int64))
    if metas:
        model.levels[2] = Level(folder, 2, metas)
        model.fan[3] = most * max(1, len(metas)) + 1  # a context's successors may lie in several shards
        metas, _, _ = grow(3, triple_keys, lambda c: model.levels[2].at("count", c.astype(np.int64)).astype(np.int64))
        if metas:
            model.levels[3] = Level(folder, 3, metas)
    return model


def held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row of docs.

    A null or empty text is its end token alone. Repeated rows score alike; unknown words have the smoothed
    probability of a word never seen, in any context. With an empty model every token has probability 1.
    """
    def run(batches):
        for batch in batches:
            for part in by_bytes(batch, "text"):
                h, at = tokens(part.column("text"))
                alone, inside, known = model.logs(h, at)
                n = part.num_rows
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "held_out": part.column("held_out"), "n_tokens": pa.array(np.diff(at)),
                    "n_known": pa.array(sums(known.astype(float), at).astype(np.int64)), "train_tokens": pa.array([model.tokens] * n, pa.int64()),
                    "base_score": pa.array(sums(alone, at)), "score": pa.array(sums(inside, at))})

    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op7_elias_fano_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, scored by a model of all words, pairs and triples of those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = scratch_path(spark, "trie")
    return score(docs, train(docs.where(~held_out()), folder, min_count=1))
