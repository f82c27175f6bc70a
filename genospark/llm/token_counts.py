"""Token counts with a digest cache."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytetext import parts
from .tables import saved
from .tokenizer import encoder

CACHE_SCHEMA = "content string, tokenizer string, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """The version of a tokenizer: the digest of its file and of the libraries' releases."""
    import tokenizers

    with open(path, "rb") as f:
        body = hashlib.sha256(f.read()).hexdigest()
    return hashlib.sha256(json.dumps([body, tokenizers.__version__]).encode()).hexdigest()


def token_counts(docs: DataFrame, cache_path: str, tokenizer_path: str, normalise: Callable[[Column], Column] | None = None, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per row of docs(doc_id, text).

    Each normalised text is known by its SHA-256. Digests that the cache at cache_path holds for this tokenizer version
    are looked up; each distinct other text is encoded once, whole, and appended to the cache. `normalise` maps the text
    column before hashing and encoding; by default only null becomes empty, since any other change could change counts.

    Null text counts as empty: 0 tokens. Repeated rows stay repeated, with equal counts; a null doc_id is kept. An empty
    table gives no rows. Other columns of docs are ignored. The cache is append-only and keyed, so that a job that fails
    half-way leaves at most files that Spark's committer has not published.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer_path)
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    text = normalise(text) if normalise else text
    keyed = docs.select(docs["doc_id"].alias("doc_id"), F.sha2(text, 256).alias("content"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    spark.createDataFrame([], CACHE_SCHEMA).coalesce(1).write.mode("append").parquet(cache_path)
    known = spark.read.schema(CACHE_SCHEMA).parquet(cache_path).where(F.col("tokenizer") == version).select("content", "n_tokens")
    misses = keyed.select("content", "text").join(known.select("content"), "content", "left_anti").dropDuplicates(["content"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        for b in parts(batches):
            counts = pa.array([len(encode(t.as_py())) for t in b.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("content"), pa.array([version] * b.num_rows), counts], ["content", "tokenizer", "n_tokens"])

    misses.mapInArrow(count, CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    counted = spark.read.schema(CACHE_SCHEMA).parquet(cache_path).where(F.col("tokenizer") == version)
    # jobs that append at the same time may add a digest twice
    counted = saved(counted.groupBy("content").agg(F.max("n_tokens").alias("n_tokens")))
    return (
        keyed.select("doc_id", "content", "n_bytes")
        .join(counted, "content")
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
