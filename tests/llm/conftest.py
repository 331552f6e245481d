import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest

SF = "/root/testdata/sf0.001"

AWKWARD = [
    (1, "", "x", 1),
    (2, None, None, None),
    (None, "a text without an id", "x", 3),
    (None, None, None, None),
    (3, "the same text twice", "x", 5),
    (3, "the same text twice", "x", 5),
    (4, "one id", "x", 6),
    (4, "with two texts", "x", 6),
    (5, " \t\r\n\x0b\x0c ", "x", 7),
    (6, "a" * 5000, "x", 8),
    (7, "word " * 30000, "x", 9),
    (8, "naïve façade — 東京 🙂🙂 don't I'LL can't've <|endoftext|> x\n\n  y z　 1,234.5!?'s", "x", 10),
    (9, "<|endoftext|>", "x", 11),
    (10, "\x00\x01'\x1c ''s 's'll 'RE\n\n\nThe  end.   ", "x", 12),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns named like results."""
    rows = [(*r, i) for i, r in enumerate(AWKWARD)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string, score int, sequence_id int")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, n_tokens string")


def small_documents():
    return pq.read_table(Path(SF) / "documents.parquet").to_pydict()


@pytest.fixture(scope="session")
def texts():
    """Documents of the smallest table and the awkward ones, as (id, text)."""
    table = small_documents()
    return [*zip(table["doc_id"], table["text"]), *((r[0], r[1]) for r in AWKWARD)]


@pytest.fixture(scope="session")
def frame(spark, texts):
    rows = list(texts)
    random.Random(3).shuffle(rows)
    return spark.createDataFrame([(i, t, "extra") for i, t in rows], "doc_id bigint, text string, length string").repartition(5)
