"""Spelling variant grouping by asymmetric q-chunks: words one edit apart, each led to its most frequent form.

For one edit the shorter of two words (or either, at equal length) is cut into two disjoint chunks;
at least one of them stands unchanged in the other word, at the same place if the edit is after it,
moved by the difference of the lengths (at most one) if the edit is before it. The other word gives
its grams of a chunk's length at those places. A frequent chunk ("tion") would still pair every word that ends in it, so
the same argument is used once more on the chunk that holds the edit: it is cut in two, and one of the two is unchanged as
well. A key is thus the unchanged chunk with the unchanged half of the other one, and words under one key differ within
a quarter of their length. Candidates are verified by their edit distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yardstick.llm.common import drop_stored, lower_az, store, table

RUNS = r"[A-Za-z\x{C0}-\x{FF}]+"
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5  # a form is this many times as frequent as its variant
DROP_EVERY = 199


def observed(doc_id: Column, run: Column, drop_every: int | None = DROP_EVERY) -> Column:
    """A lower-cased run as it is counted: where `drop_every` divides the hash of document and run, one code point is deleted."""
    if drop_every is None:
        return run
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    less = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % drop_every == 0, less).otherwise(run)


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
               drop_every: int | None = DROP_EVERY) -> DataFrame:
    """(word, n): the words of docs (doc_id, text) with min_length code points and min_count occurrences or more.

    Counts are partial sums in every task, so a word that is everywhere moves once a task. A null
    text has no words; a null doc_id counts as an empty one.
    """
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(lower_az(F.col("text")), F.lit(RUNS), F.lit(0))).alias("run"))
    words = runs.where(F.length("run") >= min_length).select(observed(F.col("doc_id"), F.col("run"), drop_every).alias("word"))
    return (words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_count))


def _keys(word: Column, length: Column, more: int) -> Column:
    """The four keys of a word as one of `length` code points: before and after the quarter that may hold the edit.

    `more` is how many code points longer the word itself is: the grams after the edit are moved by it.
    """
    half = F.floor(length / 2).cast("int")
    cuts = [F.lit(0), F.floor(length / 4).cast("int"), half, F.floor((length + half) / 2).cast("int"), length]
    made = []
    for i in range(4):
        before = F.substring(word, F.lit(1), cuts[i])
        after = F.substring(word, cuts[i + 1] + more + 1, F.length(word))
        made.append(F.xxhash64(F.lit(i), length, before, after))
    return F.array(*made)


def near_pairs(words: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of words (word, distinct, of four code points or more) that are one edit apart, each once.

    A key joins a word of length l, by its chunks, with words of length l and l + 1, by their grams.
    Words under one key differ within a quarter, so keys stay short lists; the hash of a key only proposes.
    """
    length = F.length("word")
    chunks = words.select(F.col("word").alias("a"), F.explode(_keys(F.col("word"), length, 0)).alias("key"))
    grams = words.select(F.col("word").alias("b"), F.explode(F.concat(
        _keys(F.col("word"), length, 0), _keys(F.col("word"), length - 1, 1))).alias("key"))
    once = (F.length("a") < F.length("b")) | ((F.length("a") == F.length("b")) & (F.col("a") < F.col("b")))
    return chunks.join(grams, "key").where(once & (F.levenshtein("a", "b", 1) == 1)).select("a", "b").distinct()


def variant_forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n per row of words (word distinct, n).

    A word's form is its near word of largest n (ties: smallest), if that is at least `ratio` times
    the word's own n. Each step to a form multiplies n by `ratio`, so forms make no cycles and the
    way to the root is doubled in a few rounds. An empty table gives an empty result.
    """
    words = store(words.select("word", "n"), "spelling-words")
    pairs = store(near_pairs(words), "spelling-pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    seen = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("__n")), "b")
    best = seen.groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("__n")).alias("less"), F.col("b").alias("form"))).alias("m"))
    rows = words.join(best, "word", "left")
    enough = -F.col("m.less") >= ratio * F.col("n")
    rows = store(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                             F.when(enough, F.col("m.form")).alias("form"), F.when(enough, -F.col("m.less")).alias("form_n")), "spelling-forms")
    drop_stored(pairs)
    ways = store(rows.where("form is not null").select("word", F.col("form").alias("to")), "spelling-ways")
    while True:
        on = ways.select(F.col("word").alias("to"), F.col("to").alias("__far"))
        further = store(ways.join(on, "to", "left").select("word", F.coalesce("__far", "to").alias("to"),
                                                           F.col("__far").isNotNull().alias("moved")), "spelling-ways")
        drop_stored(ways)
        ways = further
        if ways.where("moved").isEmpty():
            break
    roots = ways.select("word", F.col("to").alias("root"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_asymmetric_qchunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of all documents, with their forms."""
    return variant_forms(vocabulary(table(spark, sf_dir, "documents")))
