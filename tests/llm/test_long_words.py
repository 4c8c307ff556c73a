"""Texts without spaces: patterns take time in proportion to the text, the model sees all of it;
the table of frequent chunks comes from all documents."""

import time

from tillroll.llm import pii, token_counts
from tillroll.llm.queries import BYTE_BPE


def test_long_runs_of_digits_take_linear_time():
    """A search that tried each digit would take minutes."""
    for text in ("7" * 1_000_000, "1." * 500_000, "1-" * 500_000, "+1 " * 300_000, "a@" * 300_000,
                 "12.34.56.78" + "9" * 1_000_000 + " 10.0.0.1"):
        began = time.process_time()
        found = pii.base_spans(text)
        assert time.process_time() - began < 20
        if text.endswith("10.0.0.1"):
            ip = pii.KINDS.index("ip")
            assert [(s, e) for s, k, e in found if k == ip] == [(len(text) - 8, len(text))]


def test_shapes_hold_the_whole_word():
    assert pii.shape("x" * 200 + "@1") == "a@1"
    assert pii.shape("ab-" * 100 + "5") == "a-" * 100 + "1"
    assert pii.spans(["x-" * 40_000 + "1"], pii.Finder(pii.train()))[0][0] == []


def test_frequent_chunks_come_from_all_documents(spark):
    """A word that only the last and longest documents hold is in the table."""
    rows = [("early words here " * 20,)] * 3000 + [("late " * 30_000,)] * 2
    df = spark.createDataFrame(rows, "text string").repartition(5)
    table = token_counts.frequent_chunks(df, BYTE_BPE, "text", 100)
    assert table["late"] == 1 and table["early"] == 1 and len(table) <= 100
    blocks = token_counts.frequent_chunks(df, BYTE_BPE, "text", 20, block_chunks=2)
    assert {"late", "early"} <= set(blocks) <= set(table)
    assert token_counts.frequent_chunks(df, BYTE_BPE, "text", 1) == {}  # no room for words used alike
    assert token_counts.frequent_chunks(df, BYTE_BPE, "text", 0) == {}
