"""Line dedup by content-defined chunks, DataFrame functions only.

Lines are cut after sentence ends as well, so that a passage set into a longer line is found. The
hashes of the lines choose the boundaries: a chunk begins at a line of w words whose hash modulo FEW is under w (so at every line of
FEW words, and at every FEWth word of shorter ones), and at one that is like the line before it. That depends on the line
itself, so it survives shifts. A chunk is the shortest run from there of several lines with MIN_WORDS words or more, or
one line of LONG_LINE words or more. Equal stretches of 50 words between other neighbours hold an equal chunk with chance 0.99 or more.

Chunks that repeat anywhere are seeds, and are grown line by line to both sides: these runs find where equal text
ends between boundaries. Runs that repeat are compared byte by byte (grouped on the bytes of their lines, without the
white space after each); the first occurrence (smallest doc_id, then place) stays and the others are removed.

What is stored of the corpus are each text's line hashes and chunk hashes. Texts move only if they hold a run that repeats (a bitmap of
fixed size tells which may).
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yardstick.llm.common import drop_stored, let, may_be_in, spread_join, store, table

LONG_LINE = 12
MIN_WORDS = 10
FEW = 8  # a power of two
WORDS = r"[^\x20\x09-\x0D]+"
BLANK = " \t\n\x0b\x0c\r"


def _marked(text: Column) -> Column:
    """The text with a line end after each sentence end, so that its pieces are what lies between line ends."""
    text = F.coalesce(text, F.lit(""))
    for end in (". ", "! ", "? "):
        text = F.replace(text, F.lit(end), F.lit(end + "\n"))
    return text


def _sentence(piece: Column) -> Column:
    """Whether a piece between two marks is cut at a sentence end, which always has a mark of its own, not at a line end of the text."""
    return piece.endswith(". ") | piece.endswith("! ") | piece.endswith("? ")


def pieces(text: Column) -> Column:
    """A text's pieces in order; end to end they are the text."""
    def whole(p: Column) -> Column:
        return F.transform(p, lambda x, i: F.when((i == F.size(p) - 1) | _sentence(x), x).otherwise(F.concat(x, F.lit("\n"))))

    return let(F.split(_marked(text), "\n", -1), whole)


def _bare(marked: Column) -> Column:
    return F.transform(F.split(marked, "\n", -1), lambda x: F.rtrim(x))


def bare_pieces(text: Column) -> Column:
    """The pieces without the white space after them (spaces and line ends)."""
    return _bare(_marked(text))


def _says(piece: Column) -> Column:
    """Whether a piece holds a word: it begins with one, or something is left of it without white space."""
    return (piece >= "!") | (F.trim(piece, F.lit(BLANK)) != "")  # by bytes: white space is below "!"


def _places(p: Column) -> Column:
    """The numbers of the pieces that hold a word: the lines."""
    return F.filter(F.sequence(F.lit(0), F.size(p) - 1), lambda i: _says(F.get(p, i)))


def lines(text: Column) -> Column:
    """Structs h, w (hash and words) of a text's lines: its pieces with words, without the white space after them."""
    def line(x: Column, w: Column) -> Column:
        return F.struct(F.xxhash64(x).alias("h"), w.alias("w"))

    def matched(x: Column) -> Column:
        return F.regexp_count(x, F.lit(WORDS))

    def spaced(x: Column, solid: Column) -> Column:
        """Words of a piece whose white space is spaces: one more than its spaces, if none stands at its start or beside another."""
        odd = x.startswith(" ") | x.contains("  ")
        return F.when(odd, matched(x)).when(x == "", 0).otherwise(F.octet_length(x) - F.octet_length(solid) + 1)

    def neat(x: Column, solid: Column) -> Column:
        """The same in a text without such spaces."""
        return F.when(x == "", 0).otherwise(F.octet_length(x) - F.octet_length(solid) + 1)

    def made(t: Column) -> Column:  # solid: the same pieces without their spaces, taken out of the whole text at once
        solid = F.split(F.replace(t, F.lit(" "), F.lit("")), "\n", -1)
        odd = t.contains("  ") | t.contains("\n ") | t.startswith(" ")  # told once for all lines of a text
        each = lambda words: F.zip_with(_bare(t), solid, lambda x, y: line(x, words(x, y)))
        return F.when(odd, each(spaced)).otherwise(each(neat))

    t = F.coalesce(text, F.lit(""))
    other = functools.reduce(lambda a, c: a | t.contains(c), "\x0b\x0c\r", t.contains("\t"))  # white space but spaces and line ends
    all_ = F.when(other, F.transform(bare_pieces(t), lambda x: line(x, matched(x)))).otherwise(let(_marked(t), made))
    return F.filter(all_, lambda x: x["w"] > 0)


def chunks(h: Column, w: Column, min_words: int = MIN_WORDS, long_line: int = LONG_LINE) -> Column:
    """Struct s, e of arrays (first and last line) of a text's chunks: from each line that begins one, the shortest run that is long
    enough; an entry of e is null where the text ends before that."""
    def begins(i: Column) -> Column:
        own = F.get(h, i).bitwiseAND(F.lit(FEW - 1).cast("long")) < F.get(w, i)
        if long_line < FEW:  # else a long line has words enough for any hash
            own = own | (F.get(w, i) >= long_line)
        return own | F.coalesce(F.get(h, i - 1) == F.get(h, i), F.lit(False))

    def end(i: Column) -> Column:
        """The lines from i on, at most min_words of them as each has a word: lines in the upper half of a long, words in the lower."""
        step = lambda a, v: F.when((a >= 2 << 32) & (F.pmod(a, F.lit(1 << 32)) >= min_words), a).otherwise(a + v + F.lit(1 << 32))
        last = lambda a: F.when((a >= 2 << 32) & (F.pmod(a, F.lit(1 << 32)) >= min_words), (i + F.shiftright(a, 32) - 1).cast("int"))
        two = F.get(w, i) + F.get(w, i + 1)  # most chunks end here; null at the last line
        return F.when(F.get(w, i) >= long_line, i).when(two >= min_words, i + 1).when(two.isNotNull(), F.aggregate(
            F.slice(w, i + 1, F.lit(max(2, min_words))), F.lit(0).cast("long"), step, last))

    starts = F.filter(F.sequence(F.lit(0), F.size(w) - 1), begins)
    return let(starts, lambda s: F.struct(s.alias("s"), F.transform(s, end).alias("e")))


def _span_hash(h: Column, s: Column, e: Column) -> Column:
    """Hash of the lines s to e; that of an array is the one of its entries in turn, so most spans need no array."""
    one, two = F.xxhash64(F.get(h, s)), F.xxhash64(F.get(h, s), F.get(h, e))
    return F.when(e == s, one).when(e == s + 1, two).otherwise(F.xxhash64(F.slice(h, s + 1, e - s + 1)))


def hashed(text: Column, min_words: int = MIN_WORDS, long_line: int = LONG_LINE) -> Column:
    """A text's lines and chunks, all that is stored of it: struct h (the lines' hashes), s, e (first and last line of each chunk)
    and c (the chunk's hash); e and c are null where the text ends before the chunk."""
    def stored(h: Column, c: Column) -> Column:
        key = F.zip_with(c["s"], c["e"], lambda s, e: F.when(e.isNotNull(), _span_hash(h, s, e)))
        return F.struct(h.alias("h"), c["s"].alias("s"), c["e"].alias("e"), key.alias("c"))

    # a field of an array of structs is an array made anew wherever it is read: once a text here
    return let(lines(text), lambda x: let(x["h"], lambda h: let(x["w"], lambda w: let(
        chunks(h, w, min_words, long_line), lambda c: stored(h, c)))))


def grown(h: Column, s: Column, e: Column, seeds: Column) -> Column:
    """What is removed if it repeats: structs s, e and h of the chunks numbered `seeds` (in order), and of those grown by lines.

    A chunk grows forwards up to where the next one ends, or to the line before the next seed, and backwards to where the
    one before it begins, or to the line after the seed before. So a stretch of equal lines that holds a seed is
    covered by runs that it holds as a whole.
    """
    span = lambda a, b: F.struct(a.alias("s"), b.alias("e"), _span_hash(h, a, b).alias("h"))

    def runs(no: Column, k: Column) -> Column:
        start, end = F.get(s, no), F.get(e, no)
        until = F.when(F.get(seeds, k + 1) == no + 1, F.get(s, no + 1) - 1).otherwise(F.coalesce(F.get(e, no + 1) - 1, F.size(h) - 1))
        since = F.when(F.get(seeds, k - 1) == no - 1, F.get(e, no - 1) + 1).otherwise(F.coalesce(F.get(s, no - 1), F.lit(0)))
        ahead = F.transform(F.sequence(end, F.greatest(end, until)), lambda x: span(start, x))
        behind = F.transform(F.sequence(since, start - 1), lambda x: span(x, end))
        return F.when(since < start, F.concat(ahead, behind)).otherwise(ahead)

    return F.flatten(F.transform(seeds, runs))


def _place(s: Column, e: Column) -> Column:
    """A run's first and last line in one long, as structs cost several times that where millions are collected."""
    return F.shiftleft(s.cast("long"), 32).bitwiseOR(e.cast("long"))


def _ends(place: Column) -> tuple[Column, Column]:
    return F.shiftright(place, 32).cast("int"), place.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")


def _texts_of(text: Column, runs: Column) -> Column:
    """The runs of a text, given as places, each with the bytes of its lines."""
    def run(t: Column, at: Column) -> Column:
        s, e = _ends(at)
        one, two = F.get(t, s), F.concat(F.get(t, s), F.lit("\n"), F.get(t, e))
        more = F.array_join(F.slice(t, s + 1, e - s + 1), "\n")
        return F.struct(at.alias("at"), F.when(e == s, one).when(e == s + 1, two).otherwise(more).alias("bytes"))

    return let(F.filter(bare_pieces(text), _says), lambda t: F.transform(runs, lambda at: run(t, at)))


def _repeated(keys: DataFrame, spread: list[str]) -> DataFrame:
    """The rows of keys whose h occurs more than once; h is counted before it moves, and a frequent one is joined in many tasks."""
    twice = store(keys.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated")
    return spread_join(keys, twice, ["h"], "n", spread)


def _collected(rows: DataFrame, by: list[str], of: Column, name: str) -> DataFrame:
    """The distinct values `of` the rows of each key, as an array. The rows move as they are: few of a key lie together
    before that, and arrays of few values cost more to make and move."""
    return rows.select(*by, of.alias(name)).repartition(*by).groupBy(*by).agg(F.collect_set(name).alias(name))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, long_line: int = LONG_LINE, counts: bool = True) -> DataFrame:
    """docs with text less its repeated runs of lines (see above), plus n_removed (long, pieces) if `counts`.

    Every row stays; a text all of which occurred before becomes empty. A null text stays null.
    Texts of which nothing is removed are unchanged to the byte; blank pieces go with the line before them. Rows alike in doc_id
    and text are one occurrence; a null doc_id comes last. All columns are returned; with `counts`
    one named n_removed is replaced.
    """
    keep = [c for c in docs.columns if not counts or c != "n_removed"]
    last = F.lit((1 << 63) - 1)
    rows = docs.select(*keep).withColumn("__rid", F.xxhash64("doc_id", "text")).withColumn(
        "__doc", F.coalesce("doc_id", last).cast("long"))
    light = rows.select("__rid", "__doc", "text").where("text is not null")
    own = store(light.select("__rid", "__doc", hashed(F.col("text"), min_words, long_line).alias("l")).select(
        "__rid", "__doc", "l.*"), "line-hashes")
    keys = own.select("__rid", F.posexplode("c").alias("no", "h")).where("h is not null")
    seeds = _collected(_repeated(keys, ["__rid", "no"]), ["__rid"], F.col("no"), "seeds").withColumn("seeds", F.sort_array("seeds"))
    runs = own.select("__rid", "__doc", "h", "s", "e").join(seeds.hint("merge"), "__rid").select("__rid", "__doc", F.explode(
        grown(F.col("h"), F.col("s"), F.col("e"), F.col("seeds"))).alias("r")).select("__rid", "__doc", _place(F.col("r.s"), F.col("r.e")).alias("at"), "r.h")
    runs = store(runs, "runs")
    found = _collected(_repeated(runs, ["__rid", "at"]), ["__rid", "__doc"], F.col("at"), "runs")
    # byte comparison of the runs whose hash repeats; neither table that joins the texts has a size bound, so neither is broadcast
    found = store(found, "runs-found")
    light = light.where(may_be_in(found.select("__rid").distinct(), "__rid"))  # only these texts move
    candidates = light.join(found.hint("merge"), ["__rid", "__doc"]).select(
        "__rid", "__doc", F.explode(_texts_of(F.col("text"), F.col("runs"))).alias("r"))
    candidates = store(candidates.select("__rid", "__doc", "r.at", F.xxhash64(F.lit(1), "r.bytes").alias("h"),
                                         F.xxhash64("r.bytes").alias("b"), "r.bytes"), "candidates")
    # the first line in the smallest doc_id: both in a long where the doc_id has 32 bits, in a decimal only where not
    line, bits = _ends(F.col("at"))[0].cast("long"), F.lit(1 << 31)
    small = F.col("__doc").between(0, (1 << 32) - 1)
    near = F.when(small, F.shiftleft("__doc", 31).bitwiseOR(line))
    far = F.when(~small, (F.col("__doc").cast("decimal(20,0)") * bits.cast("decimal(11,0)") + line).cast("decimal(33,0)"))
    same = candidates.groupBy("h", "b", "bytes").agg(F.min(near).alias("near"), F.min(far).alias("far"), F.min("__doc").alias("doc"),
                                                     F.count(F.lit(1)).alias("n")).where("n > 1")
    line = F.when(F.shiftright("near", 31) == F.col("doc"), F.col("near").bitwiseAND(bits - 1)).otherwise(F.pmod("far", bits.cast("decimal(11,0)")))
    # rows find their bytes' first place again by the two hashes, 128 bits
    first = store(same.select("h", "b", "doc", line.cast("int").alias("line"), "n"), "firsts")
    later = (F.col("__doc") > F.col("doc")) | ((F.col("__doc") == F.col("doc")) & (_ends(F.col("at"))[0] > F.col("line")))
    light_runs = candidates.select("__rid", "__doc", "at", "h", "b")
    gone = spread_join(light_runs, first, ["h", "b"], "n", ["__rid", "at"]).where(later)
    gone = _collected(gone, ["__rid", "__doc"], F.col("at"), "__gone")
    gone = store(gone, "runs-gone")
    for t in (own, runs, found, candidates, first):
        drop_stored(t)
    hit = may_be_in(gone.select("__rid").distinct(), "__rid")
    untouched = rows.where(~hit).withColumn("__gone", F.lit(None).cast(gone.schema["__gone"].dataType))
    out = rows.where(hit).join(gone.hint("merge"), ["__rid", "__doc"], "left").unionByName(untouched)

    def cut(p: Column, at: Column) -> Column:
        covered = lambda s, e: F.sequence(F.get(at, s), F.coalesce(F.get(at, e + 1), F.size(p)) - 1)
        inside = F.flatten(F.transform("__gone", lambda g: covered(*_ends(g))))
        return let(F.array_except(F.sequence(F.lit(0), F.size(p) - 1), inside), lambda left: F.struct(
            F.array_join(F.transform(left, lambda i: F.get(p, i)), "").alias("text"),
            *([(F.size(p) - F.size(left)).alias("n")] if counts else [])))

    # only texts that lose a run are cut again
    out = out.withColumn("__cut", F.when(F.col("__gone").isNotNull(), let(pieces(F.col("text")), lambda p: let(_places(p), lambda at: cut(p, at)))))
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.col("__cut.text")).alias("text")
    made = [F.coalesce("__cut.n", F.lit(0)).cast("long").alias("n_removed")] if counts else []
    return out.select(*(text if c == "text" else c for c in keep), *made)


def op2_content_defined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, the text that is left, n_removed (pieces)."""
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
