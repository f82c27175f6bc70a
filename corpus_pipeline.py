"""From raw documents to packed training sequences: five stages, each on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genospark.llm.decontamination import contamination
from genospark.llm.jaccard_join import jaccard_components
from genospark.llm.language_id import language_profiles, predicted_languages
from genospark.llm.packing import packed_documents
from genospark.llm.queries import bpe_path
from genospark.llm.tables import bucket_of, in_small_batches, saved, table
from genospark.llm.toxicity import toxicity_model, toxicity_scores

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
LEAST_SCORE, LONG_ENOUGH = 0.1, 200


def apart(docs: DataFrame, decide: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """decide(docs), with columns of docs that are named like an operator's results out of the way, and back after it."""
    own = {c: f"own {c}" for c in docs.columns if c in ("lang_pred", "score", "predicted")}
    out = decide(docs.withColumnsRenamed(own)).drop(*own).withColumnsRenamed({v: k for k, v in own.items()})
    return out.select(*docs.columns)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: those without letters, and those of 200 characters or more that are like no language (cosine below 0.1).

    Null and empty texts have no letters and go. Without labelled rows nothing is learned and all go. Rows are judged one
    by one, repeated ones and those without a doc_id too; no rows: no rows.
    """
    in_small_batches(spark)
    profiles = language_profiles(docs.where(bucket_of("doc_id", 4) != 2))
    keep = (F.col("lang_pred") != "und") & ((F.col("score") >= LEAST_SCORE) | (F.length("text") < LONG_ENOUGH))
    return apart(docs, lambda d: predicted_languages(d, profiles).where(keep))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go. Rows are judged one by one, whatever their ids; null texts are judged as empty ones."""
    in_small_batches(spark)
    model = toxicity_model(docs.where(bucket_of("doc_id", 4) != 2), table(spark, sf_dir, "labels"))
    return apart(docs, lambda d: toxicity_scores(d, model).where("predicted = 0"))


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by a Jaccard similarity of 0.8 of their five-word shingles, the one with the smallest doc_id stays: of several such the first by row key, and rows without a doc_id only where no other row has one.

    Texts without words are linked with nothing and stay.
    """
    in_small_batches(spark)
    key = "near duplicate row"
    keyed = saved(docs.withColumn(key, F.monotonically_increasing_id()))
    linked = jaccard_components(keyed.select(F.col(key).alias("doc_id"), "text"), shingle=5, percent=80)
    linked = saved(linked.select(F.col("doc_id").alias("row"), "component_id"))
    groups = linked.where("component_id <> row").select("component_id").distinct()
    rows = saved(linked.join(groups, "component_id", "left_semi").join(keyed.select(F.col(key).alias("row"), "doc_id"), "row"))
    first = rows.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"].alias("first"))
    copies = saved(rows.join(first, "component_id").where("row <> first").select(F.col("row").alias(key)))
    return keyed.join(copies, key, "left_anti").select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that give a benchmark item away go. A text decides for itself, whatever its id; null texts stay."""
    in_small_batches(spark)
    digest = F.sha2("text", 256)
    leaks = saved(contamination(docs.select(digest.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("digest")).distinct())
    return docs.join(leaks, digest == F.col("digest"), "left_anti").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows, packed into sequences; null texts are the end id alone, repeated rows are packed each. Only doc_id and text matter."""
    in_small_batches(spark)
    return packed_documents(docs, bpe_path())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_stage),
    ("toxicity", toxicity_stage),
    ("jaccard_join", jaccard_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# No stage before packing can be written in SQL: profiles, classifier, index and hash joins are trained or exact in code.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written as Parquet to the shared folder and read again. Empty tables run through: no pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = saved(docs)
    return docs
