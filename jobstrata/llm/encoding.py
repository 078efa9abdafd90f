"""Encoding a corpus with a public byte-level BPE vocabulary, and decoding it.

Words repeat far more often than they are new, so the corpus is split into
pre-tokens with positions, each distinct pre-token is encoded once, and the
ids are joined back and put together by position.  Frequent words would make
the join skewed; their list has a proven bound (see :data:`HOT_SHARE`) and is
broadcast, while all other words go through a shuffle join.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobstrata.session import materialize
from jobstrata.sources.tables import table

#: Folder of the public vocabularies; JOBSTRATA_TOKENIZERS names another.
VOCABULARIES = os.environ.get("JOBSTRATA_TOKENIZERS", "/opt/tokenizers")
BYTE_BPE_50K = f"{VOCABULARIES}/byte_bpe_50k.json"
BYTE_BPE_50K_RANKS = f"{VOCABULARIES}/byte_bpe_50k.tiktoken"

#: Fixed value: the vocabulary's pre-token pattern, with Unicode white space.
PRE_TOKEN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: A word is hot if it makes up more than one in HOT_SHARE of all pre-tokens.
#: There can't be more than HOT_SHARE such words, however large the corpus is.
HOT_SHARE = 2000

_SPANS = T.ArrayType(T.StringType())
_IDS = T.ArrayType(T.IntegerType())


def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    return tok


def _exact_splitter(path: str):
    """Pre-tokens by the tokenizer itself, for texts with characters that the JVM's Unicode tables lack."""

    @F.pandas_udf(_SPANS)
    def split(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pre = _tokenizer(path).pre_tokenizer
        for texts in batches:
            yield texts.map(lambda t: None if t is None else [t[a:b] for _, (a, b) in pre.pre_tokenize_str(t)])

    return split


def _word_encoder(path: str):
    @F.pandas_udf(_IDS)
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tok = _tokenizer(path)
        for words in batches:
            yield pd.Series([e.ids for e in tok.encode_batch(words.tolist(), add_special_tokens=False)], dtype=object)

    return encode


def pre_tokens(docs: DataFrame, key: list[str], text: str, vocabulary: str = BYTE_BPE_50K) -> DataFrame:
    """One row per pre-token: the key columns, ``pos`` and ``word``.

    A null or empty text gives one row with a null word, so that it isn't lost.
    """
    body = docs.select(*key, F.col(text).alias("_text"))
    unknown = F.coalesce(F.col("_text").rlike(r"\p{Cn}"), F.lit(False))
    fast = body.where(~unknown).withColumn("_words", F.regexp_extract_all("_text", F.lit(PRE_TOKEN), F.lit(0)))
    slow = body.where(unknown).withColumn("_words", _exact_splitter(vocabulary)("_text"))
    return fast.unionByName(slow).select(*key, F.posexplode_outer("_words").alias("pos", "word"))


def encode_corpus(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, vocabulary: str = BYTE_BPE_50K) -> DataFrame:
    """``doc_id, ids``: one row for every row of ``docs``, without special tokens.

    Null and empty texts give an empty list; a blank text is encoded as it
    stands; the string of a special token is ordinary text.  Repeated rows come
    out as often as they came in, and so do rows without an id; rows that share
    an id but not the text stay apart.  Further columns are ignored.  An empty
    table gives an empty table.
    """
    tokens = pre_tokens(
        docs.select(F.col(doc_id).alias("_doc"), F.xxhash64(F.col(text)).alias("_hash"), F.col(text).alias("_body")),
        ["_doc", "_hash"], "_body", vocabulary,
    )
    counts = tokens.where("word is not null").groupBy("word").agg(F.count("*").alias("n"))
    words = materialize(counts.withColumn("ids", _word_encoder(vocabulary)("word")), "words")
    total = words.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * HOT_SHARE > F.lit(total)
    hot = words.where(is_hot).select("word", F.col("ids").alias("_hot"))
    rest = words.where(~is_hot).select("word", "ids")
    split = tokens.join(F.broadcast(hot), "word", "left")
    done = split.where("_hot is not null or word is null").select("_doc", "_hash", "pos", F.col("_hot").alias("ids"))
    joined = split.where("_hot is null and word is not null").drop("_hot").join(rest, "word")
    spans = done.unionByName(joined.select("_doc", "_hash", "pos", "ids"))
    # A document's words come from many tasks, so collecting before the shuffle would only sort what is there.
    whole = spans.repartition("_doc", "_hash").groupBy("_doc", "_hash").agg(
        F.sort_array(F.collect_list(F.struct("pos", "ids"))).alias("spans"),
        F.count_if(F.coalesce(F.col("pos"), F.lit(0)) == 0).alias("copies"),
    )
    # A row that came several times has each position as often, side by side.
    once = F.filter("spans", lambda s, i: (i == 0) | (s["pos"] != F.get("spans", i - 1)["pos"]))
    spans = F.when(F.col("copies") > 1, once).otherwise(F.col("spans"))
    ids = F.flatten(F.transform(spans, lambda s: F.coalesce(s["ids"], F.array().cast(_IDS))))
    return whole.select(F.col("_doc").alias(doc_id), ids.alias("ids"), F.sequence(F.lit(1), F.col("copies").cast("int")).alias("_c")).select(
        doc_id, "ids", F.explode("_c").alias("_c")
    ).drop("_c")


def token_bytes(spark: SparkSession, ranks: str = BYTE_BPE_50K_RANKS) -> DataFrame:
    """``id, bytes`` of a rank file; its size is that of the vocabulary."""
    with open(ranks, "rb") as f:
        rows = [(int(n), bytearray(base64.b64decode(b))) for b, n in map(bytes.split, f)]
    return spark.createDataFrame(rows, "id int, bytes binary")


def decode_corpus(encoded: DataFrame, doc_id: str = "doc_id", ids: str = "ids", *, ranks: str = BYTE_BPE_50K_RANKS) -> DataFrame:
    """``doc_id, text`` of encoded rows, by a join with the token-byte table.

    A null or empty list gives the empty text.  Ids outside the table raise
    no error and give no bytes.  ``doc_id`` must be unique; null counts as a value.
    """
    spark = encoded.sparkSession
    table_ = F.broadcast(token_bytes(spark, ranks).select("id", F.hex("bytes").alias("_hex")))
    spans = encoded.select(F.col(doc_id).alias("_doc"), F.posexplode_outer(F.col(ids)).alias("pos", "id"))
    whole = spans.join(table_, "id", "left").groupBy("_doc").agg(
        F.sort_array(F.collect_list(F.struct("pos", "_hex"))).alias("s")
    )
    text = F.unhex(F.array_join(F.transform("s", lambda s: F.coalesce(s["_hex"], F.lit(""))), ""))
    return whole.select(F.col("_doc").alias(doc_id), F.decode(text, "UTF-8").alias("text"))


def p6_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode_corpus(table(spark, folder, "documents").select("doc_id", "text"))


def p6_decoded(spark: SparkSession, folder: str) -> DataFrame:
    """The texts of all documents after encoding and decoding."""
    return decode_corpus(materialize(p6_ids(spark, folder), "encoded"))


P6_DECODED_SQL = "SELECT doc_id, coalesce(text, '') AS text FROM documents"
