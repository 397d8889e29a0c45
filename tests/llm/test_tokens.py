import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from papyrine.llm.tokens import VOCABULARY, Encoder, encode, merge_piece, read_ranks

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def ranks():
    with open(VOCABULARY, "rb") as f:
        return read_ranks(f.read())


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(VOCABULARY.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    return t


@given(st.text(max_size=200))
@settings(max_examples=300, deadline=None)
def test_equals_the_library(ranks, library, text):
    if "�" not in text.encode("utf-8", "replace").decode():
        assert Encoder(ranks).encode(text) == library.encode(text, add_special_tokens=False).ids


def test_long_pieces(ranks, library):
    rnd = random.Random(1)
    for text in ("a" * 20_000, "".join(rnd.choice("abcdeé日") for _ in range(20_000)), " " * 5000 + "x", "<|endoftext|> a"):
        assert Encoder(ranks).encode(text) == library.encode(text, add_special_tokens=False).ids
    assert merge_piece(b"", ranks) == [] and merge_piece(b"a", ranks) == [ranks[b"a"]]


def test_table(spark):
    rows = spark.createDataFrame([(1, "Hello hello"), (2, ""), (3, None), (1, "Hello hello"), (None, "x"), (4, "\ud800 lone".encode("utf-8", "replace").decode())], "doc_id long, text string").withColumnRenamed("text", "t").withColumn("k", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("clash"))
    got = [(r.doc_id, r.ids) for r in encode(rows, "doc_id", "t").collect()]
    assert len(got) == 6 and (2, []) in got and (3, []) in got and got.count((1, got[0][1])) == 2
    assert encode(rows.where("false"), "doc_id", "t").count() == 0
