"""Encoding and decoding with the public vocabulary."""

import os
import random

import pytest

from jobstrata.llm import encoding

pytestmark = pytest.mark.skipif(not os.path.exists(encoding.BYTE_BPE_50K), reason="no vocabulary")

TEXTS = [
    "Hello world", "", None, "  ", " \n\t x", "it's we'll I'd '", "<|endoftext|> is text", "naïve café 東京 🙂👩‍💻", "a  b   c\n\n\nd ", " x　y ",
    "x = [477442, 390392]", "ß́​", "퟿\U0003fffd͸", "é" * 3000, "word " * 20000, "1234567890" * 5, "''s", "\r\n\r\n", "Hello world",
]


def expected(text):
    tok = encoding._tokenizer(encoding.BYTE_BPE_50K)
    return tok.encode(text, add_special_tokens=False).ids if text else []


def test_equal_to_the_tokenizer(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: r.ids for r in encoding.encode_corpus(docs).collect()}
    assert got == {i: expected(t) for i, t in enumerate(TEXTS)}


def test_random_texts(spark):
    rng = random.Random(7)
    pool = "abcXYZ019 '\n\t.,-é東🙂 ‍͸"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(40))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.ids for r in encoding.encode_corpus(docs).collect()} == {i: expected(t) for i, t in enumerate(texts)}


def test_round_trip(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in encoding.decode_corpus(encoding.encode_corpus(docs)).collect()}
    assert got == {i: t or "" for i, t in enumerate(TEXTS)}


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(1, "same", 5, "w"), (1, "same", 6, "w"), (1, "other", 7, "w"), (None, "no id", 8, "w"), (None, None, 9, "w"), (2, None, 1, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pos int, word string")
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.ids) for r in encoding.encode_corpus(docs).collect()))
    assert got == sorted((d is None, d or 0, expected(t)) for d, t, *_ in rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    out = encoding.encode_corpus(docs)
    assert out.columns == ["doc_id", "ids"] and out.count() == 0 and encoding.decode_corpus(out).count() == 0
