"""Mixing sources to target weights by Pfair scheduling.

A source with w shares out of Q in all gets w of every Q slots. Its block i of a period is
released at floor(i Q / w) and due at ceil((i + 1) Q / w); earliest-deadline-first fills the
slots. The windows of a source follow each other by less than one block, so after any number t
of slots a source has had within one block of t w / Q. A period ends with no lag, so one period's
slots, found once, hold for all: block j of a source goes to slot (j div w) Q + slots[j mod w].
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yardstick.llm.common import numbered, partitions, table

SHARES = {"src0": 4}  # of 4 + 1 for every other source
BLOCK_ROWS = 32


def earliest_deadline_first(shares: list[int]) -> list[list[int]]:
    """The slots of each source's blocks in one period of sum(shares) slots."""
    q = sum(shares)
    releases: list[list[tuple[int, int]]] = [[] for _ in range(q)]
    for s, w in enumerate(shares):
        for i in range(w):
            releases[i * q // w].append((-(-(i + 1) * q // w), s))
    slots: list[list[int]] = [[] for _ in shares]
    ready: list[tuple[int, int]] = []
    for t in range(q):
        for job in releases[t]:
            heapq.heappush(ready, job)
        slots[heapq.heappop(ready)[1]].append(t)  # the shares fill the period: a job is ready in every slot
    return slots


def _period(sources: pa.Table) -> pa.Table:
    sources = sources.sort_by("__s")
    shares = sources.column("__w").to_pylist()
    slots = earliest_deadline_first(shares)
    return pa.table({"__s": sources.column("__s"), "__w": pa.array(shares, pa.int32()),
                     "__q": pa.array([sum(shares)] * len(shares), pa.int32()),
                     "__slots": pa.array(slots, pa.list_(pa.int32()))})


def schedule(docs: DataFrame, shares: dict[str, int], default_share: int = 1, source: str = "source",
             order: tuple[str, ...] = ("doc_id",), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add block, place, release, deadline and slot (long) to every row.

    block counts a source's blocks of `block_rows` rows from 0, place the rows of a block; slot
    is the block's slot, release and deadline its window; (slot, place) orders the mix. Every
    row stays: once a source has run out its slots are empty, and the others go on in proportion
    to their shares. Shares are whole numbers of 1 or more, `default_share` for sources that are
    not named; a null source is a source of its own. A source's rows are taken in hash order of
    `order`; repeated rows each get a place. Columns of these names in the input are replaced.
    Empty input gives an empty result. The sources (not the rows) meet in one task.
    """
    if default_share < 1 or any(w < 1 for w in shares.values()):
        raise ValueError("shares are whole numbers of 1 or more")
    made = ("block", "place", "release", "deadline", "slot")
    rows = docs.drop(*(c for c in made if c in docs.columns))
    rows = rows.withColumn("__s", F.when(F.col(source).isNull(), "n").otherwise(F.concat(F.lit("s"), F.col(source).cast("string"))))
    share = F.lit(default_share)
    for name, w in shares.items():
        share = F.when(F.col("__s") == f"s{name}", F.lit(w)).otherwise(share)
    sources = rows.select("__s").distinct().withColumn("__w", share.cast("int"))
    period = (sources.groupBy(F.lit(0).alias("__g")).applyInArrow(_period, "__s string, __w int, __q int, __slots array<int>"))
    ranked = numbered(rows, "__s", list(order), "__i", per_key=period)
    block = F.floor(F.col("__i") / block_rows).cast("long")
    return (ranked.withColumn("block", block).withColumn("place", F.pmod("__i", F.lit(block_rows)).cast("long"))
            .withColumn("release", F.expr("(block * __q) div __w"))
            .withColumn("deadline", F.expr("((block + 1) * __q + __w - 1) div __w"))
            .withColumn("slot", F.expr("(block div __w) * __q") + F.get("__slots", F.pmod(F.col("block"), F.col("__w")).cast("int")))
            .drop("__s", "__w", "__q", "__slots", "__i"))


def mixed(docs: DataFrame, shares: dict[str, int], **kw) -> DataFrame:
    """The rows of docs, unchanged, laid out in the order of the schedule (across and within files)."""
    cols = docs.columns
    out = schedule(docs, shares, **kw)
    return (out.repartitionByRange(partitions(docs.sparkSession), "slot", "place")
            .sortWithinPartitions("slot", "place").select(*cols))


def op8_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in the mix: doc_id, source, block, place, release, deadline, slot."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return schedule(docs, SHARES).select("doc_id", "source", "block", "place", "release", "deadline", "slot")
