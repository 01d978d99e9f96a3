"""License scan by a positional rare-token index, DataFrame functions only.

A licence is known by templates: notices, each with key phrases that must stand in it. Document
frequencies of all template words are counted over all documents; the index holds, for each
template, its RARE words of highest IDF with their positions. A file looks its words up in it;
postings are intersected by relative position: a place of a word in the file less its place in
the template is where the template would begin, and the IDF of the postings that agree on
a beginning is their share of the template. At MIN_SHARE or more every key phrase of the template is verified word by word in the
stretch of the file that the template covers.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yardstick.llm.common import let, lower_az, store, table

CUT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RARE = 8
MIN_SHARE = 0.59
SLACK = 16  # words before and after a template in which its key phrases are looked for
SLOTS = 1 << 12  # of the index: a word's postings are found by its hash


class Template(NamedTuple):
    label: str
    text: str
    phrases: tuple[str, ...]


# The labels and phrases that are counted wherever they stand.
PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))

# Public licence notices, each with the phrases that it must hold.
TEMPLATES = (
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
             "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
             ("permission is hereby granted", "without restriction")),
    Template("apache", "Licensed under the Apache License, Version 2.0", ("apache license",)),
    Template("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
             "compliance with the License. You may obtain a copy of the License at", ("apache license", "in compliance with the license")),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3", ("gnu general public license",)),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
             "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
             "later version", ("free software", "gnu general public license")),
    Template("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation", ("lesser general public license",)),
    Template("agpl", "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
             ("affero general public license",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
             "the following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
             "promote products derived from this software without specific prior written permission", ("endorse or promote products",)),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted, provided that the above copyright notice and this permission notice appear in all copies",
             ("with or without fee is hereby granted",)),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
             "not distributed with this file, You can obtain one at", ("mozilla public license",)),
    Template("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License",
             ("eclipse public license",)),
    Template("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
             "held liable for any damages arising from the use of this software", ("as is without any express or implied warranty",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain",
             ("unencumbered software", "public domain")),
    Template("cc-by", "Licensed under CC BY 4.0", ("cc by 4",)),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4",)),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
             ("creative commons attribution noncommercial",)),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0", ("cc by sa",)),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
             ("creative commons attribution sharealike",)),
)


def _words_of(text: str) -> list[str]:
    """A template's words, by the same rule as a file's."""
    return [w for w in re.split(CUT, "".join(c.lower() if "A" <= c <= "Z" else c for c in text)) if w]


def file_words(text: Column) -> Column:
    """The words of a whole text; a null text has none."""
    return F.array_remove(F.split(lower_az(F.coalesce(text, F.lit(""))), CUT), "")


def license_words(docs: DataFrame, templates: Sequence[Template], phrases: Sequence[tuple[str, str]]) -> DataFrame:
    """doc_id, n_words and hits, the words of the text that are in any template or phrase with their places, in order."""
    known = sorted({w for t in templates for w in (*_words_of(t.text), *(x for p in t.phrases for x in _words_of(p)))}
                   | {w for _, p in phrases for w in _words_of(p)})
    words = docs.select("doc_id", file_words(F.col("text")).alias("__words"))
    placed = F.transform("__words", lambda w, i: F.struct(i.alias("p"), w.alias("w")))
    return words.select("doc_id", F.size("__words").cast("long").alias("n_words"),
                        F.filter(placed, lambda x: x["w"].isin(known) if known else F.lit(False)).alias("hits"))


def _slot(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(SLOTS)).cast("int")


def rare_index(hits: DataFrame, templates: Sequence[Template], rare: int = RARE) -> DataFrame:
    """One row: `slots` (the postings w, t, q, idf by the hash of their word) and `totals` (each template's sum of IDF).

    Its size is that of the templates, whatever the input: document frequencies are partial sums by word.
    """
    spark = hits.sparkSession
    placed = json.dumps([{"t": t, "q": q, "w": w} for t, x in enumerate(templates) for q, w in enumerate(_words_of(x.text))])
    lic = spark.range(1).select(F.explode(F.from_json(F.lit(placed), "array<struct<t:int,q:int,w:string>>")).alias("x")).select("x.*")
    seen = hits.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["w"]))).alias("w")).groupBy("w").agg(
        F.count(F.lit(1)).alias("df"))
    total = hits.agg(F.count(F.lit(1))).scalar()
    df = F.coalesce("df", F.lit(0))
    words = lic.select("t", "w").distinct().join(seen, "w", "left").select(
        "t", "w", df.alias("df"), F.ln((total + 1.0) / (df + 1.0)).alias("idf"))
    best = F.slice(F.sort_array(F.collect_list(F.struct("df", "w", "idf"))), 1, rare)  # of one template's words
    words = words.groupBy("t").agg(best.alias("best")).select("t", F.explode("best").alias("x")).select("t", "x.w", "x.idf")
    postings = lic.join(words, ["t", "w"])
    slots = postings.groupBy(_slot(F.col("w")).alias("id")).agg(F.collect_list(F.struct("w", "t", "q", "idf")).alias("posts"))
    slots = spark.range(SLOTS).select(F.col("id").cast("int").alias("id")).join(slots, "id", "left").agg(
        F.sort_array(F.collect_list(F.struct("id", "posts"))).alias("s"))
    sums = postings.groupBy("t").agg(F.sum("idf").alias("s")).agg(F.sort_array(F.collect_list(F.struct("t", "s"))).alias("s"))
    return slots.select(F.struct(F.transform("s", lambda x: x["posts"]).alias("slots"),
                                 sums.select(F.transform("s", lambda x: x["s"])).scalar().alias("totals")).alias("index"))


def _beginnings(hits: Column, index: Column, min_share: float) -> Column:
    """Structs t, d, share: where templates would begin (d, words from the start), with min_share of their IDF or more."""
    def posts(h: Column) -> Column:
        own = F.filter(F.get(index["slots"], _slot(h["w"])), lambda x: x["w"] == h["w"])
        return F.transform(own, lambda x: F.struct(x["t"].alias("t"), (h["p"] - x["q"]).alias("d"), x["idf"].alias("idf")))

    votes = F.flatten(F.transform(F.filter(hits, lambda h: F.get(index["slots"], _slot(h["w"])).isNotNull()), posts))
    nothing = F.from_json(F.lit("[]"), "array<struct<t:int,d:int,share:double>>")
    start = F.struct(F.lit(-1).alias("t"), F.lit(0).alias("d"), F.lit(0.0).alias("s"), nothing.alias("done"))

    def step(a: Column, v: Column) -> Column:
        same = (a["t"] == v["t"]) & (a["d"] == v["d"])
        share = F.coalesce(F.try_divide(a["s"], F.get(index["totals"], a["t"])), F.lit(0.0))
        ended = F.when(~same & (a["t"] >= 0) & (share >= min_share), F.array_append(a["done"], F.struct(
            a["t"].alias("t"), a["d"].alias("d"), share.alias("share")))).otherwise(a["done"])
        return F.struct(v["t"].alias("t"), v["d"].alias("d"), F.when(same, a["s"] + v["idf"]).otherwise(v["idf"]).alias("s"), ended.alias("done"))

    last = F.array(F.struct(F.lit(-1).alias("t"), F.lit(0).alias("d"), F.lit(0.0).alias("idf")))
    return F.aggregate(F.concat(F.sort_array(votes), last), start, step)["done"]  # votes of one beginning lie together


def _holds(hits: Column, x: Column, templates: Sequence[Template]) -> Column:
    """Whether every key phrase of the template stands within the stretch that it covers from its beginning."""
    sizes = F.array(*[F.lit(len(_words_of(t.text))) for t in templates])
    wanted = F.array(*[F.array(*[F.lit(" " + " ".join(_words_of(p)) + " ") for p in t.phrases]).cast("array<string>") for t in templates])
    own = F.filter(hits, lambda h: (h["p"] >= x["d"] - SLACK) & (h["p"] < x["d"] + F.get(sizes, x["t"]) + SLACK))

    def line(own: Column) -> Column:  # words that don't follow one another are kept apart
        return F.concat(F.lit(" "), F.array_join(F.transform(own, lambda h, i: F.concat(
            F.when(F.coalesce(F.get(own, i - 1)["p"], h["p"]) + 1 < h["p"], F.lit("- ")).otherwise(F.lit("")), h["w"])), " "), F.lit(" "))

    return let(let(own, line), lambda s: F.forall(F.get(wanted, x["t"]), lambda p: F.contains(s, p)))


def _places(hits: Column, phrase: str) -> Column:
    """Where the words of a phrase stand one after the other."""
    words = _words_of(phrase)

    def stands(h: Column, i: Column) -> Column:
        ok = h["w"] == words[0]
        for k, w in enumerate(words[1:], 1):
            ok = ok & (F.get(hits, i + k)["w"] == w) & (F.get(hits, i + k)["p"] == h["p"] + k)
        return F.coalesce(ok, F.lit(False))

    return F.transform(F.filter(hits, stands), lambda h: h["p"].cast("long"))


def scan_licenses(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES,
                  rare: int = RARE, min_share: float = MIN_SHARE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score per row of docs (doc_id, text).

    base_labels come from the phrases wherever they stand (n_base places, the first and the last);
    labels adds those of the templates found; both are sorted, comma-joined and empty where there is none. score is the
    largest share of a template that was found and verified, else 0. A null or empty text has no words and no labels.
    Repeated rows and null ids are judged like any other row. The words of templates and phrases are
    taken from each text once, written as a scratch table, and all else is read from that.
    """
    hits = store(license_words(docs, templates, phrases), "license-words")
    rows = hits.withColumn("__index", rare_index(hits, templates, rare).scalar())
    hit = F.col("hits")
    found = F.filter(_beginnings(hit, F.col("__index"), min_share), lambda x: _holds(hit, x, templates))
    rows = rows.select("doc_id", "n_words", "hits", found.alias("__found"))
    places = F.array(*[F.struct(F.lit(label).alias("label"), _places(hit, p).alias("at")) for label, p in phrases])
    rows = rows.select("doc_id", "n_words", "__found", F.filter(places, lambda x: F.size(x["at"]) > 0).alias("__base"))
    at, base = F.flatten(F.transform("__base", lambda x: x["at"])), F.transform("__base", lambda x: x["label"])
    labels = F.array(*[F.lit(t.label) for t in templates])
    every = F.concat(base, F.transform("__found", lambda x: F.get(labels, x["t"])))
    joined = lambda a: F.array_join(F.sort_array(F.array_distinct(a)), ",")
    score = F.least(F.coalesce(F.array_max(F.transform("__found", lambda x: x["share"])), F.lit(0.0)), F.lit(1.0))
    return rows.select("doc_id", "n_words", F.size(at).cast("long").alias("n_base"), F.array_min(at).alias("first_word"),
                       F.array_max(at).alias("last_word"), joined(base).alias("base_labels"), joined(every).alias("labels"),
                       F.round(score, 6).alias("score"))


def op12_rare_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    return scan_licenses(table(spark, sf_dir, "documents"))


def _oracle(templates: Sequence[Template] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES) -> str:
    text = lambda s: "'" + s.replace("'", "''") + "'"
    placed = ", ".join(f"({t}, {q}, {text(w)})" for t, x in enumerate(templates) for q, w in enumerate(_words_of(x.text)))
    names = ", ".join(f"({t}, {text(x.label)}, {len(_words_of(x.text))})" for t, x in enumerate(templates))
    keys = ", ".join(f"({t}, {text(' ' + ' '.join(_words_of(p)) + ' ')})" for t, x in enumerate(templates) for p in x.phrases)
    bases = " UNION ALL ".join(
        f"SELECT a.rid, a.p, {text(label)} AS label FROM w a " + " ".join(
            f"JOIN w b{k} ON b{k}.rid = a.rid AND b{k}.p = a.p + {k} AND b{k}.w = {text(x)}" for k, x in enumerate(_words_of(p)[1:], 1))
        + f" WHERE a.w = {text(_words_of(p)[0])}" for label, p in phrases)
    return f"""
WITH tw(t, q, w) AS (VALUES {placed}), names(t, label, size) AS (VALUES {names}), wanted(t, phrase) AS (VALUES {keys}),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
w AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS p FROM d),
df AS (SELECT w, count(DISTINCT rid) AS df FROM w WHERE w IN (SELECT w FROM tw) GROUP BY w),
idf AS (SELECT t, w, coalesce(df, 0) AS df, ln(((SELECT count(*) FROM d) + 1.0::DOUBLE) / (coalesce(df, 0) + 1.0::DOUBLE)) AS idf
        FROM (SELECT DISTINCT t, w FROM tw) LEFT JOIN df USING (w)),
rare AS (SELECT * FROM idf QUALIFY row_number() OVER (PARTITION BY t ORDER BY df, w) <= {RARE}),
post AS (SELECT t, q, w, idf FROM tw JOIN rare USING (t, w)),
tot AS (SELECT t, sum(idf) AS total FROM post GROUP BY t),
votes AS (SELECT rid, t, p - q AS d, sum(idf) AS s FROM w JOIN post USING (w) GROUP BY rid, t, p - q),
cand AS (SELECT rid, t, label, d, s / total AS share, size FROM votes JOIN tot USING (t) JOIN names USING (t) WHERE s / nullif(total, 0) >= {MIN_SHARE}),
stretch AS (SELECT cand.*, ' ' || array_to_string(ws[greatest(1, d - {SLACK} + 1):d + size + {SLACK}], ' ') || ' ' AS line
            FROM cand JOIN d AS f USING (rid)),
found AS (SELECT * FROM stretch s WHERE NOT EXISTS (SELECT 1 FROM wanted k WHERE k.t = s.t AND NOT contains(s.line, k.phrase))),
base AS ({bases}),
b AS (SELECT rid, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word,
      string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY rid),
a AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
      FROM (SELECT rid, label FROM base UNION ALL SELECT rid, label FROM found) GROUP BY rid),
s AS (SELECT rid, max(share) AS score FROM found GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       round(least(coalesce(score, 0), 1), 6) AS score
FROM d LEFT JOIN b USING (rid) LEFT JOIN a USING (rid) LEFT JOIN s USING (rid)"""


OP12_SQL = _oracle()
