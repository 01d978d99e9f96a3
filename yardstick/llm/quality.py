"""Quality rules: heuristics and a hashed n-gram log-likelihood ratio, DataFrame functions only.

Words and word pairs are hashed to BUCKETS features. Two multinomials are counted, one over the
trusted target texts and one over all texts; a text's score is the mean log ratio of its
features (so it doesn't depend on length), and a text passes at MIN_LLR or more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yardstick.llm.common import let, table

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
BUCKETS = 1 << 18
PRIOR = 16.0  # pseudo-counts of every feature, in target features: rare features say little
MIN_LLR = -0.1
MEMBER_BITS = 1 << 22
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def word_array(text: Column) -> Column:
    """The words of a whole text; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def _chain(left: Column, right: Column, shift: int) -> Column:
    """Hashes of left[i] with right[i + shift], for every i that right has a partner for."""
    n = F.greatest(F.size(right) - shift, F.lit(0))
    return F.zip_with(F.slice(left, 1, n), F.slice(right, shift + 1, n), lambda a, b: F.xxhash64(a, b))


def repeated_words(windows: Column) -> Column:
    """Words inside three-word windows found twice or more, from the windows' hashes in text order."""
    def covered(places: Column) -> Column:
        return F.aggregate(F.transform(places, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(places, j + 1) - p, F.lit(3)))),
                           F.lit(0), lambda a, x: a + x)

    def twice(s: Column) -> Column:
        same = F.filter(s, lambda e, j: F.coalesce(F.get(s, j - 1)["h"] == e["h"], F.lit(False))
                        | F.coalesce(F.get(s, j + 1)["h"] == e["h"], F.lit(False)))
        return let(F.sort_array(F.transform(same, lambda e: e["i"])), covered)

    slow = let(F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), twice)
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(slow)


def _features(docs: DataFrame) -> DataFrame:
    """docs with __words, and hashes of words (__h) and of word pairs (__g)."""
    out = docs.withColumn("__words", word_array(F.col("text")))
    out = out.withColumn("__h", F.transform("__words", lambda w: F.xxhash64(w)))
    return out.withColumn("__g", _chain(F.col("__h"), F.col("__h"), 1))


def _may_be_in(ids: DataFrame) -> Column:
    """Whether a row's doc_id may be one of ids (distinct): a hashed bitmap of fixed size, as a scalar subquery.

    It only saves moving texts: false positives are joined, and more ids only mean more of them.
    """
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(MEMBER_BITS))
    one = F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc_id), {MEMBER_BITS}) % 64 as int))")
    words = ids.groupBy(F.floor(bit / 64).cast("int").alias("i")).agg(F.bit_or(one).alias("w"))
    every = ids.sparkSession.range(MEMBER_BITS // 64).select(F.col("id").cast("int").alias("i"))
    laid = every.join(words, "i", "left").agg(F.sort_array(F.collect_list(F.struct("i", F.coalesce("w", F.lit(0)).alias("w")))).alias("a"))
    bitmap = laid.select(F.transform("a", lambda r: r["w"])).scalar()
    return F.coalesce(F.get(bitmap, F.floor(bit / 64).cast("int")).bitwiseAND(one) != 0, F.lit(False))


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, prior: float = PRIOR) -> DataFrame:
    """One row: the array of every bucket's log ratio, target to corpus, counted over all texts.

    docs has doc_id and text, trusted distinct doc_ids. Only texts that may be trusted move to meet
    their id. The counts are partial sums by bucket: the one task that lays them out reads
    `buckets` rows at most, whatever the input.
    """
    texts, may = docs.select("doc_id", "text"), _may_be_in(trusted)
    marked = (texts.where(may).join(trusted.select("doc_id", F.lit(1).alias("__t")).hint("merge"), "doc_id", "left")
              .unionByName(texts.where(~may).withColumn("__t", F.lit(None).cast("int"))))
    features = _features(marked).select(F.explode(F.concat("__h", "__g")).alias("x"), "__t")
    counts = (features.groupBy(F.pmod("x", F.lit(buckets)).cast("int").alias("b"))
              .agg(F.count(F.lit(1)).cast("double").alias("raw"), F.count("__t").cast("double").alias("target")))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("b"))
    rows = F.sort_array(F.collect_list(F.struct("b", "raw", "target")))
    total = F.struct(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    laid = (every.join(counts, "b", "left").na.fill(0.0).agg(rows.alias("rows"), total.alias("total")))
    share = F.coalesce(F.try_divide(F.col("total.target"), F.col("total.raw")), F.lit(0.0))
    return laid.select(F.transform("rows", lambda r: F.ln((r["target"] + prior) / (r["raw"] * share + prior))).alias("w"))


def quality_rules(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, prior: float = PRIOR,
                  min_llr: float = MIN_LLR, fit_on: DataFrame | None = None) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score per row of docs.

    `trusted` holds the target's doc_ids (repeats and nulls do no harm). A null or empty text
    has no words, fails the base rules and scores 0. With no trusted text every ratio is 0 and
    only the base rules decide. Repeated rows are judged alike. Every text is judged whole.
    """
    known = trusted.select("doc_id").where("doc_id is not null").distinct()
    model = log_ratios(docs if fit_on is None else fit_on, known, buckets, prior).scalar()
    rows = _features(docs.select("doc_id", "text"))
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(WORD))
    rows = rows.withColumn("__lines", lines)
    light = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = rows.select(
        "doc_id", F.size("__words").cast("long").alias("n_words"), F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        let(_chain(F.col("__g"), F.col("__h"), 2), repeated_words).cast("long").alias("n_repeat_words"),
        F.concat("__h", "__g").alias("__f"), F.greatest(F.size("__h") + F.size("__g"), F.lit(1)).alias("__n"))
    # every column is read once here: the optimiser makes it one projection, and no row carries the model
    total = F.aggregate("__f", F.lit(0.0), lambda a, x: a + F.get(F.col("__w"), F.pmod(x, F.lit(buckets)).cast("int")))
    rows = rows.withColumn("__w", model).select(*light, (total / F.col("__n")).alias("score"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.select(*light, failed.alias("base_failed"), (~failed & (F.col("score") >= min_llr)).alias("kept"), "score")


def op1_ngram_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; trusted are those whose every quality label is 1."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1")
    return quality_rules(table(spark, sf_dir, "documents"), labels)
