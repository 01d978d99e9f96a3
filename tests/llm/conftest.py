import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts: doc_id from 0, sources in turn."""
    def make(texts, ids=None, sources=None):
        ids = list(range(len(texts))) if ids is None else ids
        sources = [f"src{i % 3}" for i in range(len(texts))] if sources is None else sources
        return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in zip(ids, texts, sources, strict=True)], SCHEMA)
    return make


ODD = [None, "", " \n\t ", "one", "One two", "x " * 30_000, "same text of a few words here\nand one more line", "same text of a few words here\nand one more line",
       "É è ü　 z 😀 a\x0bb\x0cc\rd", "a  b \n\n c"]


@pytest.fixture(scope="session")
def odd(docs_of):
    """Nulls, empty, blank, very long and repeated texts; a repeated row, a null id and a null source."""
    return docs_of([*ODD, ODD[6], "no id at all", None], [*range(len(ODD)), 6, None, None], ["src0"] * 10 + ["src0", None, None])


@pytest.fixture(scope="session")
def empty(docs_of):
    return docs_of([])


@pytest.fixture(scope="session")
def clash(odd):
    """The same with extra columns whose names an operator might use itself."""
    from pyspark.sql import functions as F
    for c in ("shard", "slot", "block", "rank", "n", "h", "key", "score", "kept", "length", "start", "k", "id", "component", "n_lines", "n_pieces", "label", "total"):
        odd = odd.withColumn(c, F.lit(7))
    return odd
