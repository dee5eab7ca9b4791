import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

CLASHING = "id bigint, `row` string, _id int, _row int, _text string, seed string, hit int, kept string, " \
           "text_sha256 string, node int, term string, _key string, _share int, mix_slot string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """(doc_id, text, source) rows as a table with further columns whose names clash."""
    def make(rows):
        width = CLASHING.count(",") + 1
        return spark.createDataFrame(
            [(i, t, s, *[None] * width) for i, t, s in rows],
            f"doc_id bigint, text string, source string, {CLASHING}").repartition(3)

    return make


LONG = " ".join(f"word{i % 977} x{i}" for i in range(30_000))

EDGES = [
    (1, "The same text stands here, twice over.", "a"), (2, "The same  text stands\there, twice over.", "a"),
    (3, None, "b"), (4, "", None), (5, LONG, "a"), (6, LONG, "c"), (7, " \n\t", "c"),
    (None, "A text without an id, alone.", "a"), (None, None, None),
    (8, "Repeated row of some length", "b"), (8, "Repeated row of some length", "b"),
    (9, "é è ü", "b"), (10, "one", "b"), (11, "One", "b")]


@pytest.fixture(scope="session")
def edges():
    return EDGES
