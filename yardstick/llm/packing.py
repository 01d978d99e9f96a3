"""Packing token sequences by reciprocal-capacity classes (harmonic packing).

A piece of r tokens is of class k = floor(L / r): k of its class fit a sequence of L tokens,
and each of a class's sequences gets exactly k pieces, found from the piece's number in its
class alone, so workers fill bins independently. Documents may be cut, which keeps padding low:
a document gives whole sequences, then the rest r is taken as it is if k such pieces leave at
most `max_waste` of the sequence empty, or else gives a piece of exactly floor(L / (k + 1)).
What is left of each class (fewer than k pieces) fills common sequences, longest first.
Documents with a position (the mix) are taken in its order: a class's sequences hold pieces that
follow each other, and sequences are numbered by their first piece, those of the left-overs last.
"""

from __future__ import annotations

import base64
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from yardstick.llm.common import numbered, store, table
from yardstick.llm.textvec import by_bytes

LENGTH = 2048
MAX_WASTE = 0.02
END_ID = 1
RUN_ROWS = 8192  # positions whose pieces are numbered in one task

# Texts on which the fast encoder must agree with the tokenizer before it is used.
PROBES = ("It's we'll  they've\n\n 12,345 x", " a\t b\r\n", "\u00e9\u00e8 \u00fc\u00df\u3000\u4e2d\u6587 \U0001f600!?  ", "a" * 300, "\x85 \x1c \xa0z", "<|endoftext|> <|endoftext|>")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Texts to token ids, as little-endian unsigned 32-bit bytes. Special tokens' strings are ordinary text.

    `path` names the tokenizer. Where the same vocabulary lies beside it as ranks (.tiktoken), a
    faster encoder of those ranks is used, provided that it gives the tokenizer's ids on PROBES.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self.fast = self._ranked(os.path.splitext(path)[0] + ".tiktoken")

    def _ranked(self, path: str):
        if not os.path.exists(path):
            return None
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        same = all(fast.encode_ordinary(t) == self.model.encode(t, add_special_tokens=False).ids for t in PROBES)
        return fast if same else None

    def encode(self, text: str) -> bytes:
        if self.fast is not None:
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        return np.array(self.model.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_encoders: dict[str, Encoder] = {}


def cut(n: int, length: int, max_waste: float) -> list[int]:
    """Piece lengths of a document of n tokens."""
    out = [length] * (n // length)
    rest = n % length
    while rest:
        k = length // rest
        if length - k * rest <= max_waste * length:
            out.append(rest)
            break
        out.append(length // (k + 1))
        rest -= out[-1]
    return out


def pieces(docs: DataFrame, path: str, length: int = LENGTH, max_waste: float = MAX_WASTE, end_id: int = END_ID,
           keep_ids: bool = False, position: bool = False) -> DataFrame:
    """Tokenise and cut every document (doc_id, text, and position if it is asked for): one row per piece.

    A null text counts as empty: its only token is end_id. With keep_ids the pieces carry their
    ids (array of int); otherwise only their checksum.
    """
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, k int" + ", position long" * position + ", ids array<int>" * keep_ids

    def run(batches):
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        encode, end = _encoders[path].encode, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for part in by_bytes(batch, "text"):
                doc, start, size, crc, total, ids, rows = [], [], [], [], [], [], []
                for row, (d, text) in enumerate(zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True)):
                    raw = encode(text or "") + end
                    n, at = len(raw) // 4, 0
                    for m in cut(n, length, max_waste):
                        own = raw[4 * at:4 * (at + m)]
                        doc.append(d)
                        rows.append(row)
                        start.append(at)
                        size.append(m)
                        crc.append(zlib.crc32(own))
                        total.append(n)
                        if keep_ids:
                            ids.append(np.frombuffer(own, "<u4").astype(np.int32))
                        at += m
                cols = {"doc_id": pa.array(doc, pa.int64()), "start": pa.array(start, pa.int64()),
                        "length": pa.array(size, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                        "doc_tokens": pa.array(total, pa.int64()),
                        "k": pa.array([length // m for m in size], pa.int32())}
                if position:
                    cols["position"] = part.column("position").take(pa.array(rows, pa.int64()))
                if keep_ids:
                    cols["ids"] = pa.array(ids, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(cols)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                       *([F.col("position").cast("long")] if position else [])).mapInArrow(run, schema)


def _first_fit(length: int):
    def run(group: pa.Table) -> pa.Table:
        sizes, docs, starts, crcs = (group.column(c).to_pylist() for c in ("length", "doc_id", "start", "ids_crc32"))
        order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], docs[i] is not None, docs[i] or 0, starts[i], crcs[i]))
        free: list[int] = []
        bins, offsets = [0] * group.num_rows, [0] * group.num_rows
        for i in order:
            b = next((b for b, room in enumerate(free) if room >= sizes[i]), len(free))
            if b == len(free):
                free.append(length)
            bins[i], offsets[i] = b, length - free[b]
            free[b] -= sizes[i]
        return group.append_column("__bin", pa.array(bins, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))
    return run


def pack(piece_rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """Add sequence_id and offset (long) to stored pieces (from `pieces`).

    Class sizes differ by worker only in how many sequences they fill. The classes number at
    most `length`, so their counts are a table of bounded size; the left-over pieces of all
    classes are fewer than the sum of k over the distinct floor(length / r), bounded alike
    (some 16,000 pieces for 2048), whatever the input. A sequence's pieces lie without gaps
    from offset 0; the rest of it is padding. Repeated documents are packed each. Pieces with
    a column position (long) are taken in its order, others in hash order.
    """
    placed = "position" in piece_rows.columns
    run = F.col("position").bitwiseAND(~(RUN_ROWS - 1))
    cols = piece_rows.columns
    classes = (piece_rows.groupBy("k").agg(F.count(F.lit(1)).alias("__n"))
               .withColumn("__full", F.expr("__n div k"))
               .select("k", "__full", F.coalesce(F.sum("__full").over(
                   Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__first")))
    classes = store(classes, "piece-classes")  # read four times below, as the numbered pieces are three times
    ranked = store(numbered(piece_rows, "k", ["position"] * placed + ["doc_id", "start", "ids_crc32"], "__i",
                            bucket=run if placed else None).join(F.broadcast(classes), "k"), "numbered-pieces")
    whole = F.col("__i") < F.col("__full") * F.col("k")
    inside = Window.partitionBy("sequence_id").orderBy("__i").rowsBetween(Window.unboundedPreceding, -1)
    full = (ranked.where(whole).withColumn("sequence_id", F.expr("__first + __i div k"))
            .withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)))
            .select(*cols, "sequence_id", "offset"))
    if placed:  # whole sequences by the position of their first piece
        own = full.groupBy("sequence_id").agg(F.min("position").alias("position")).withColumn("__g", F.lit(0))
        ids = numbered(own, "__g", ["position", "sequence_id"], "__id", bucket=run).select("sequence_id", "__id")
        full = full.join(ids, "sequence_id").select(*cols, F.col("__id").alias("sequence_id"), "offset")
    left = ranked.where(~whole).select(*cols)
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in left.schema) + ", __bin long, offset long"
    rest = left.groupBy(F.lit(0).alias("__g")).applyInArrow(_first_fit(length), out)
    rest = rest.withColumn("sequence_id", classes.agg(F.coalesce(F.sum("__full"), F.lit(0))).scalar() + F.col("__bin"))
    return full.unionByName(rest.select(*cols, "sequence_id", "offset"))


def op9_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def pack_documents(docs: DataFrame) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens; a null text is empty (one token)."""
    return _packed(pieces(docs, tokenizer_path()))


def pack_stored(docs: DataFrame) -> DataFrame:
    """The same for documents read from Parquet files: sequences follow the rows' order across and within the files."""
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("long")
    position = F.shiftleft(F.coalesce(part, F.lit(0)), 40) + F.col("_metadata.row_index")
    return _packed(pieces(docs.select("doc_id", "text", position.alias("position")), tokenizer_path(), position=True))


def _packed(piece_rows: DataFrame) -> DataFrame:
    return pack(store(piece_rows, "pieces")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
