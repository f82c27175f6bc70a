"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle
from .conversation_repair import conversation_summaries, damaged, repaired_turns
from .decontamination import contamination
from .hidden_markov import text_scores
from .html_text import extracted_pages
from .jaccard_join import jaccard_components
from .language_id import language_profiles, predicted_languages
from .packing import packed_documents
from .preferences import formatted_preferences, pairs_of_conversations
from .quality_rules import quality_verdicts
from .tables import bucket_of, in_small_batches, shared_dir, table
from .token_alignment import token_alignment
from .token_counts import token_counts
from .toxicity import toxicity_model, toxicity_scores
from .vector_search import nearest

Query = Callable[[SparkSession, str], DataFrame]


def bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op6_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_scores(table(spark, sf_dir, "documents").select("doc_id", "text", (bucket_of("doc_id", 7) == 2).alias("held_out")))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache is a new one for each call, so that every call counts all distinct texts."""
    return token_counts(table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/token-cache-{uuid.uuid4().hex}", bpe_path())


def op1_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op2_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = formatted_preferences(pairs_of_conversations(table(spark, sf_dir, "conversations")))
    for side in ("chosen_spans", "rejected_spans"):
        out = out.withColumn(side, F.array_join(F.transform(side, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ","))
    return out


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = language_profiles(docs.where(bucket_of("doc_id", 4) != 2))
    out = predicted_languages(docs.select("doc_id", (bucket_of("doc_id", 4) == 2).alias("held_out"), "text"), profiles)
    return out.select("doc_id", "held_out", "lang_pred", "score")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted_pages(table(spark, sf_dir, "pages"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"), bpe_path())


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", (bucket_of("doc_id", 4) == 2).alias("held_out"), "text")
    model = toxicity_model(docs.where("not held_out"), table(spark, sf_dir, "labels"))
    return toxicity_scores(docs, model).select("doc_id", "held_out", "score", "predicted")


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_verdicts(table(spark, sf_dir, "documents"))
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select("doc_id", *base, base_failed.alias("base_failed"), F.col("rejected_by").isNull().alias("kept"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment(table(spark, sf_dir, "documents"), bpe_path(), piece_path())


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_summaries(repaired_turns(damaged(table(spark, sf_dir, "conversations"))))


def small(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        in_small_batches(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    "op1_vector_search": op1_vector_search,
    "op2_preferences": op2_preferences,
    "op3_language_id": op3_language_id,
    "op4_html_text": op4_html_text,
    "op5_packing": op5_packing,
    "op6_hidden_markov": op6_hidden_markov,
    "op7_token_counts": op7_token_counts,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_decontamination": op9_decontamination,
    "op10_toxicity": op10_toxicity,
    "op11_quality_rules": op11_quality_rules,
    "op12_token_alignment": op12_token_alignment,
    "op13_conversation_repair": op13_conversation_repair,
}
QUERIES = {name: small(query) for name, query in QUERIES.items()}
ORACLES: dict[str, str] = oracle.SQL
