"""MinHash near-duplicates by tensored banding.

Two collections of M small hashes (each of HALF minhashes) are formed; the M * M tables' keys are
all pairs of one from either, so the minhashes needed grow with the square root of the
tables: 2 * M * HALF values feed M * M tables of 2 * HALF minhashes. Texts with the same shingle set
are one class before any table. Candidates are checked on their full shingle sets.

At similarity 0.8, HALF = 3 and M = 12 miss a pair with chance 1 - (1 - (1 - 0.8**3)**12)**2 < 0.0004.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from yardstick.llm.common import drop_stored, salted_join, store, table
from yardstick.llm.components import components, extended
from yardstick.llm.textvec import by_bytes, shingles, words

HALF, M = 3, 12
TRIALS = 6  # partners tried one by one before all the pairs that are left
BLOCK = 200  # members of a block of such pairs
SEED = 7


def _permutations(n: int) -> np.ndarray:
    return np.random.default_rng(SEED).integers(1 << 32, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def small_hashes(keys: np.ndarray, at: np.ndarray, half: int, m: int) -> np.ndarray:
    """(texts, 2 m) hashes, each of `half` minhashes, of non-empty sorted sets laid end to end."""
    out = np.empty((len(at) - 1, 2 * m), np.uint64)
    for c in range(2 * m):
        h = np.full(len(at) - 1, c + 1, np.uint64)
        for a in _permutations(2 * m * half)[c * half:(c + 1) * half]:
            v = keys * a
            low = np.minimum.reduceat(v ^ (v >> np.uint64(29)), at[:-1])
            h = (h ^ low) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
        out[:, c] = h
    return out


def row_key() -> Column:
    """A row's identity: rows alike in doc_id and text are one, also where the id is null or two texts share it."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def sketches(docs: DataFrame, n_words: int, half: int = HALF, m: int = M) -> DataFrame:
    """rid (see row_key), doc_id, n_shingles, set_key (hash of the whole set; null if empty) and small (2 m hashes) of every text."""
    def run(batches):
        for batch in batches:
            for part in by_bytes(batch, "text"):
                keys, at = shingles(words(part.column("text")), n_words)
                sizes = np.diff(at)
                some = np.flatnonzero(sizes)
                set_key: list = [None] * len(sizes)
                small: list = [None] * len(sizes)
                if len(some):
                    got = small_hashes(keys, np.append(at[:-1][some], at[-1]), half, m).view(np.int64)
                    for row, i in enumerate(some):
                        set_key[i] = xxhash.xxh3_128_digest(keys[at[i]:at[i + 1]].tobytes())
                        small[i] = got[row]
                yield pa.RecordBatch.from_pydict({
                    "rid": part.column("rid"), "doc_id": part.column("doc_id"), "n_shingles": pa.array(sizes, pa.int64()),
                    "set_key": pa.array(set_key, pa.binary()), "small": pa.array(small, pa.list_(pa.int64()))})

    return docs.select(row_key().alias("rid"), F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "rid long, doc_id long, n_shingles long, set_key binary, small array<long>")


def shingle_sets(docs: DataFrame, n_words: int) -> DataFrame:
    """id and set (sorted 64-bit shingle hashes as bytes) of every text of docs (id, text)."""
    def run(batches):
        for batch in batches:
            for part in by_bytes(batch, "text"):
                keys, at = shingles(words(part.column("text")), n_words)
                yield pa.RecordBatch.from_pydict({
                    "id": part.column("id"),
                    "set": pa.array([keys[at[i]:at[i + 1]].tobytes() for i in range(len(at) - 1)], pa.binary())})

    return docs.mapInArrow(run, "id long, set binary")


def _similar(u: np.ndarray, v: np.ndarray, percent: int) -> bool:
    """Exact test of two sorted non-empty sets."""
    common = int(np.count_nonzero(u[np.minimum(np.searchsorted(u, v), len(u) - 1)] == v))
    return 100 * common >= percent * (len(u) + len(v) - common)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The stored pairs (a, b) with 100 |A and B| >= percent |A or B| on the full sets."""
    both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b"))

    def run(batches):
        for batch in batches:
            mask = pa.array([_similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                             for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_pydict({"a": batch.column("a").filter(mask), "b": batch.column("b").filter(mask)})

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _pairs_to_check(x: dict, y: dict, same: bool, table: int, percent: int, m: int) -> np.ndarray:
    """Row numbers (of x, of y) of a block pair's pairs: in other components, of sizes that can link, with a common hash in
    either collection, and met here first (in their first common hash of the first collection)."""
    common = x["small"][:, None, :m] == y["small"][None, :, :m]
    ok = common.any(2) & (common.argmax(2) == table)
    ok &= (x["small"][:, None, m:] == y["small"][None, :, m:]).any(2)
    ok &= x["component"][:, None] != y["component"][None, :]
    nx, ny = x["n_shingles"][:, None], y["n_shingles"][None, :]
    ok &= 100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny)
    if same:
        ok = np.triu(ok, 1)
    return np.argwhere(ok)


def _block(members, m: int) -> dict:
    """A block's members (a list of structs) as arrays."""
    out = {c: np.asarray(members.field(c)) for c in ("rep", "component", "n_shingles")}
    out["small"] = np.asarray(members.field("small").flatten()).reshape(len(members), 2 * m)
    return out


def across(docs: DataFrame, sets: DataFrame, percent: int, m: int) -> DataFrame:
    """Links between components among docs (rep, component, n_shingles, small): every pair that shares a table is compared.

    Groups are the hashes of the first collection, cut into blocks of about BLOCK members.
    Pairs of blocks meet, and their pairs are compared inside the task: no row is made for a
    pair that is not a link. Full sets move only for blocks that have a pair to compare.
    """
    hashes = docs.select("*", F.posexplode(F.slice("small", 1, m)).alias("table", "key"))
    stats = hashes.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    placed = salted_join(hashes, stats.select("key", F.ceil(F.col("n") / BLOCK).alias("blocks")), ["key"], ["rep"])
    placed = store(placed.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks"))).drop("blocks"), "blocks")
    member = ("rep", "component", "n_shingles", "small")

    def pairs(blocks: DataFrame) -> DataFrame:
        sides = [blocks.select("key", "table", F.col("block").alias(k), F.col("members").alias("m" + k)) for k in "ab"]
        return sides[0].join(sides[1].drop("table"), "key").where("a <= b")

    def any_pair(batches):
        for batch in batches:
            keep = []
            for key, table, a, b, ma, mb in zip(*(batch.column(c) for c in ("key", "table", "a", "b", "ma", "mb")), strict=True):
                x, y = _block(ma.values, m), _block(mb.values, m)
                keep.append(len(_pairs_to_check(x, y, a.as_py() == b.as_py(), table.as_py(), percent, m)) > 0)
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_pydict({c: batch.column(c).filter(mask) for c in ("key", "a", "b")})

    light = placed.groupBy("key", "table", "block").agg(F.collect_list(F.struct(*member)).alias("members"))
    met = store(pairs(light).mapInArrow(any_pair, "key long, a long, b long"), "block-pairs")
    needed = met.select("key", F.col("a").alias("block")).unionByName(met.select("key", F.col("b").alias("block"))).distinct()
    full = placed.join(needed, ["key", "block"], "left_semi").join(sets.withColumnRenamed("id", "rep"), "rep")
    full = store(full.groupBy("key", "table", "block").agg(F.collect_list(F.struct(*member, "set")).alias("members")), "set-blocks")

    def compare(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                x, y = _block(row["ma"].values, m), _block(row["mb"].values, m)
                sx, sy = ([np.frombuffer(v.as_buffer(), np.uint64) for v in row[c].values.field("set")] for c in ("ma", "mb"))
                found = [(x["rep"][p], y["rep"][q]) for p, q in _pairs_to_check(
                    x, y, row["a"].as_py() == row["b"].as_py(), row["table"].as_py(), percent, m) if _similar(sx[p], sy[q], percent)]
                if found:
                    a, b = np.sort(np.array(found, np.int64), axis=1).T
                    yield pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b)})

    return store(pairs(full).join(met, ["key", "a", "b"], "left_semi").mapInArrow(compare, "a long, b long"), "links")


def near_duplicates(docs: DataFrame, n_words: int = 5, percent: int = 80, half: int = HALF, m: int = M) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs (doc_id, text).

    Links: 100 |intersection| >= percent |union| of the distinct n-word shingles (A-Z
    lower-cased; fewer words are one shingle). A null, empty or blank text has no shingles and
    links with nothing: its component is its own doc_id. Texts with equal sets are one class, so
    copies never meet pair by pair. Members of a table key are tried against its smallest member
    and their neighbour: each class's most frequent partner first, then TRIALS - 1 more
    where the components still differ. Then every pair that shares a key and whose components
    still differ is compared, block by block: no link between different texts is lost to the order of trials.

    Classes have numbers of their own, so ids decide nothing but names: component_id is the smallest doc_id of the rows
    reachable, null if none of them has one. kept is doc_id = component_id; in a group without ids the rows of one text
    are kept. Repeated rows get the same result; texts that share a doc_id are judged each by itself.
    """
    return _judged(docs, n_words, percent, half, m).select(
        "doc_id", "n_shingles", F.col("component_doc").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component_doc"), F.col("component_doc").isNull() & F.col("root")).alias("kept"))


def _judged(docs: DataFrame, n_words: int, percent: int, half: int = HALF, m: int = M) -> DataFrame:
    """rid, doc_id, n_shingles, component (a number; null without shingles), component_doc and root (whether the row is of the text that
    stands for a group without ids) of every row."""
    rows = store(sketches(docs, n_words, half, m), "sketches")
    named = rows.where("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("class_doc"), F.min("rid").alias("class_rid"))
    named = store(named.withColumn("rep", F.monotonically_increasing_id()), "classes")  # numbers hold once they are written
    members = store(salted_join(rows.where("set_key is not null"), named.drop("class_doc"), ["set_key"], ["rid"])
                    .select("rid", "doc_id", "n_shingles", "rep",
                            F.when(F.col("rid") == F.col("class_rid"), F.col("small")).alias("small"))
                    .unionByName(rows.where("set_key is null").select(
                        "rid", "doc_id", "n_shingles", F.lit(None).cast("long").alias("rep"), F.lit(None).cast("array<long>").alias("small"))),
                    "members")
    drop_stored(rows)
    # one key per table, for class representatives only
    tables = F.flatten(F.transform(F.slice("small", 1, m), lambda x: F.transform(
        F.slice("small", m + 1, m), lambda y: F.xxhash64(x, y))))
    keys = members.where("small is not null").select("rep", "n_shingles", F.explode(tables).alias("key"))
    by_key = Window.partitionBy("key").orderBy("rep")
    buckets = store(keys.select(
        "key", "rep", "n_shingles", F.first("rep").over(by_key).alias("first"), F.first("n_shingles").over(by_key).alias("n_first"),
        F.lag("rep").over(by_key).alias("before"), F.lag("n_shingles").over(by_key).alias("n_before"),
        F.lead("rep").over(by_key).alias("after")).where("before is not null or after is not null").drop("after"), "buckets")
    near = lambda n: (100 * F.least("n_shingles", n) >= percent * F.greatest("n_shingles", n))  # noqa: E731  sizes alone rule the rest out
    tried = (buckets.where((F.col("first") < F.col("rep")) & near("n_first")).select(F.col("first").alias("a"), F.col("rep").alias("b"))
             .unionByName(buckets.where((F.col("before") < F.col("rep")) & near("n_before")).select(F.col("before").alias("a"), F.col("rep").alias("b"))))
    best = Window.partitionBy("b").orderBy(F.desc("n"), "a")
    trials = store(tried.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).withColumn("turn", F.row_number().over(best))
                   .where(F.col("turn") <= TRIALS), "trials")
    involved = named.join(buckets.select("rep").distinct(), "rep", "left_semi").select(F.col("class_rid").alias("rid"), F.col("rep").alias("id"))
    texts = docs.select(row_key().alias("rid"), F.col("text").cast("string")).join(involved, "rid").select("id", "text")
    sets = store(shingle_sets(texts, n_words).dropDuplicates(["id"]), "sets")

    labels = components(store(confirmed(trials.where("turn = 1").select("a", "b"), sets, percent), "links"))
    la = labels.select(F.col("id").alias("a"), F.col("component").alias("ca"))
    lb = labels.select(F.col("id").alias("b"), F.col("component").alias("cb"))
    rest = (trials.where("turn > 1").select("a", "b").join(la, "a", "left").join(lb, "b", "left")
            .where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"))
    labels = extended(labels, store(confirmed(store(rest, "rest"), sets, percent), "links"))
    # keys whose members are still in several components
    marked = (buckets.select("key", "rep", "n_shingles").join(labels.withColumnRenamed("id", "rep"), "rep", "left")
              .withColumn("component", F.coalesce("component", "rep")))
    mixed = marked.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    open_ = marked.join(mixed, "key", "left_semi").groupBy("rep").agg(
        F.first("component").alias("component"), F.first("n_shingles").alias("n_shingles"))
    small = members.where("small is not null").groupBy("rep").agg(F.first("small").alias("small"))
    labels = extended(labels, across(store(open_.join(small, "rep"), "open"), sets, percent, m))
    # names of the components: the smallest doc_id of each, then of each class, then of each row
    classes = store(named.join(labels.select(F.col("id").alias("rep"), "component"), "rep", "left")
                    .select("rep", "class_doc", "class_rid", F.coalesce("component", "rep").alias("component")), "class-components")
    docs_of = classes.groupBy("component").agg(F.min("class_doc").alias("component_doc"))
    classes = salted_join(classes, docs_of, ["component"], ["rep"]).select("rep", "class_rid", "component", "component_doc")
    found = salted_join(members.where("rep is not null").drop("small"), classes, ["rep"], ["rid"])
    root = (F.col("rid") == F.col("class_rid")) & (F.col("rep") == F.col("component"))
    return found.select("rid", "doc_id", "n_shingles", "component", "component_doc", root.alias("root")).unionByName(
        members.where("rep is null").select("rid", "doc_id", "n_shingles", F.lit(None).cast("long").alias("component"),
                                            F.col("doc_id").alias("component_doc"), F.lit(True).alias("root")))


def kept_documents(docs: DataFrame, n_words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that stay, with their columns: one of each group of near-duplicates, whatever their ids.

    Of a group the row with the smallest doc_id stays (null ids last; of several texts under that id, one); of rows alike
    in doc_id and text, one. A text without shingles is a group of its own, one for each doc_id and text.
    """
    judged = store(_judged(docs, n_words, percent), "judged")
    group = F.coalesce("component", "rid")  # of texts without shingles, the row itself
    judged = judged.select("rid", "doc_id", group.alias("group"), F.col("component").isNull().alias("alone"))
    first = judged.groupBy("group", "alone").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("m"))
    stays = store(first.select(F.col("m.rid").alias("__rid")).distinct(), "kept-rows")
    rows = docs.withColumn("__rid", row_key())
    left = rows.join(stays, "__rid", "left_semi")
    repeated = store(left.groupBy("__rid").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__rid"), "repeated-rows")
    once = left.join(repeated, "__rid", "left_anti")
    return once.unionByName(left.join(repeated, "__rid", "left_semi").dropDuplicates(["__rid"])).select(*docs.columns)


def op4_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents on two-word shingles at 80 %."""
    return near_duplicates(table(spark, sf_dir, "documents"), n_words=2, percent=80)


OP4_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) < 2 THEN w
        ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS x FROM d),
e AS (SELECT doc_id, len(x) AS n, unnest(x) AS x FROM s),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS id, doc_id AS low FROM s
          UNION SELECT links.b, reach.low FROM reach JOIN links ON links.a = reach.id WHERE reach.low < links.b)
SELECT doc_id, CAST(len(x) AS BIGINT) AS n_shingles, min(low) AS component_id, doc_id = min(low) AS kept
FROM s JOIN reach ON reach.id = doc_id GROUP BY doc_id, len(x)"""
