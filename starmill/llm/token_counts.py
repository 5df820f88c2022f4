"""Token counts through a digest cache.

A stored table holds (content digest, tokenizer digest, tokens). Texts are joined to it by both digests;
only distinct texts that it lacks are encoded, and their counts are appended. The content is the text as it
is, null being empty: the tokenizer's own normaliser changes nothing, so no two different texts may share
an entry. The tokenizer digest covers the vocabulary file and the library's version, so a new file
or library never meets old counts.

Defined results: null text counts as empty (0 tokens, 0 bytes); a null doc_id stays null; repeated rows come
back as often as they are there; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from importlib.metadata import version

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from starmill.llm.common import text_or_empty, text_pieces
from starmill.session import scratch_dir

CACHE_SCHEMA = "content_digest binary, tokenizer_digest string, n_tokens long"
COUNTS_SCHEMA = "content_digest binary, n_tokens long"


def tokenizer_digest(model: str) -> str:
    """Of the vocabulary file and the library that reads it."""
    with open(model, "rb") as file:
        found = hashlib.sha256(file.read())
    found.update(f"sentencepiece {version('sentencepiece')}".encode())
    return found.hexdigest()


def encoder(model: str):
    """Counts the tokens of (content_digest, text) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=model)
        for batch in batches:
            for rows, texts in text_pieces(batch):
                found = library.encode([x.decode() for x in texts], num_threads=1)
                columns = [rows.column("content_digest"), pa.array(map(len, found), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["content_digest", "n_tokens"])

    return run


class TokenCountCache:
    """Stored counts below ``path``; any number of tokenizers share a table."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or scratch_dir(spark, "token-counts")
        spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(self.path)

    def counts(self, tokenizer: str) -> DataFrame:
        """One row a digest, also if two writers appended it."""
        stored = self.spark.read.schema(CACHE_SCHEMA).parquet(self.path)
        own = stored.filter(F.col("tokenizer_digest") == tokenizer)
        return own.groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))

    def append(self, counts: DataFrame, tokenizer: str) -> None:
        rows = counts.select("content_digest", F.lit(tokenizer).alias("tokenizer_digest"), "n_tokens")
        rows.write.mode("append").parquet(self.path)


def _distinct_misses(keyed: DataFrame, stored: DataFrame) -> DataFrame:
    """A row (content_digest, text) of each text that the cache lacks.

    Digests are grouped without their texts; one row of each missing digest is then looked up by digest and
    doc_id together, so copies of a hot text are spread over all partitions.
    """
    one = keyed.groupBy("content_digest").agg(F.min("doc_id").alias("one_id"))
    missing = one.join(stored, "content_digest", "left_anti")
    wanted = missing.select(F.col("content_digest").alias("wanted"), "one_id")
    same = F.col("wanted").eqNullSafe(F.col("content_digest")) & F.col("one_id").eqNullSafe(F.col("doc_id"))
    return keyed.join(wanted, same, "left_semi").select("content_digest", "text")


def token_counts(docs: DataFrame, model: str, cache: TokenCountCache, over: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document; the cache holds all its texts after."""
    tokenizer = tokenizer_digest(model)
    text = text_or_empty()
    keyed = docs.select("doc_id", text.alias("text"), F.unhex(F.sha2(text, 256)).alias("content_digest"))
    misses = _distinct_misses(keyed, cache.counts(tokenizer).select("content_digest"))
    found = misses.mapInArrow(encoder(model), COUNTS_SCHEMA)
    cache.append(found.groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens")), tokenizer)
    sized = docs.select(
        "doc_id",
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.unhex(F.sha2(text, 256)).alias("content_digest"),
    )
    joined = sized.join(cache.counts(tokenizer), "content_digest")
    return joined.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > over).alias("over_limit"))
