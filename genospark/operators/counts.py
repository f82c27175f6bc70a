"""Count tables (sample, feature, n): matrix, assignment and class summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as X

CLASSES = (*X.TE_CLASSES, "unknown")


def classified_features(counts: DataFrame, level: str = "subfamily") -> DataFrame:
    """counts with kind (TE or gene), te_family and te_class; locus keys need three parts, subfamily keys two."""
    te, family, group = X.feature_parts(F.col("feature"), 3 if level == "locus" else 2)
    return counts.withColumns({"kind": F.when(te, "TE").otherwise("gene"), "te_family": family, "te_class": group})


def feature_class_filter(counts: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """The rows whose feature is among keys(feature); all rows without keys."""
    return counts if keys is None else counts.join(keys.select("feature"), "feature", "left_semi")


def feature_long(counts: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    return feature_class_filter(counts, keys).groupBy("feature", "sample").agg(F.sum("n").alias("n"))


def assignment_summary(counts: DataFrame, level: str = "subfamily") -> DataFrame:
    """(sample, kind, n, pct): reads of genes and of TEs, with their share in per cent; both kinds for every sample."""
    wide = classified_features(counts, level).groupBy("sample").agg(*[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(k) for k in ("gene", "TE")])
    long = wide.unpivot("sample", ["gene", "TE"], "kind", "n")
    return long.withColumn("pct", X.percent(F.col("n"), F.sum("n").over(Window.partitionBy("sample"))))


def class_summary(counts: DataFrame, level: str = "subfamily") -> DataFrame:
    """(sample, te_class, n, pct): TE reads by class, in per cent of the sample's TE reads; all six classes for every sample."""
    wide = classified_features(counts, level).groupBy("sample").agg(*[F.coalesce(F.sum(F.when(F.col("te_class") == k, F.col("n"))), F.lit(0)).alias(k) for k in CLASSES])
    long = wide.unpivot("sample", list(CLASSES), "te_class", "n")
    return long.withColumn("pct", X.percent(F.col("n"), F.sum("n").over(Window.partitionBy("sample"))))
