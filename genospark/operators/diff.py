"""Differences between two groups of samples."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from ..storage import Shelf
from .sampleqc import dispersions, normalised, size_factors


def erfc(x: np.ndarray) -> np.ndarray:
    """1 - erf(x) for x >= 0, all values at once: the power series up to 2, beyond it the continued fraction. The relative error is below 1e-12."""
    near, far = np.minimum(x, 2.0), np.maximum(x, 2.0)
    term = total = near.copy()
    for n in range(1, 60):
        term = term * (-near * near / n)
        total = total + term / (2 * n + 1)
    tail = np.zeros_like(far)
    for n in range(120, 0, -1):
        tail = (n / 2) / (far + tail)
    return np.where(x <= 2, 1 - 2 / math.sqrt(math.pi) * total, np.exp(-far * far) / math.sqrt(math.pi) / (far + tail))


@pandas_udf(DoubleType())
def two_sided_p(z: pd.Series) -> pd.Series:
    return pd.Series(erfc(np.abs(z.to_numpy(float)) / math.sqrt(2))).where(z.notna().to_numpy())


def adjusted(p: DataFrame) -> DataFrame:
    """p(contrast, feature, pvalue, ...) with padj by Benjamini and Hochberg within the contrast; null p count for nothing and stay null.

    Equal p have equal padj, so that distinct p with their numbers are enough. They are dealt over ranges, 256 for each
    power of 2; ranks and minima are taken inside a range, and carried on from range to range by one row for each.
    p is stored first: results meet their rows by the value itself, and sums of floats made a second time may differ in
    their last place.
    """
    p = Shelf(p.sparkSession).put(p, keep=True)
    place = F.coalesce(F.floor(F.log2("pvalue") * 256), F.lit(-(2**30))).alias("place")
    per = p.where("pvalue is not null").groupBy("contrast", "pvalue").agg(F.count("*").alias("held")).select("*", place)
    every, up = Window.partitionBy("contrast"), (Window.unboundedPreceding, -1)
    ranges = per.groupBy("contrast", "place").agg(F.sum("held").alias("held"))
    before = F.coalesce(F.sum("held").over(every.orderBy("place").rowsBetween(*up)), F.lit(0))
    ranges = ranges.select("contrast", "place", F.sum("held").over(every).alias("m"), before.alias("before"))
    inside = Window.partitionBy("contrast", "place")
    ranked = per.join(ranges, ["contrast", "place"]).withColumn("i", F.col("before") + F.sum("held").over(inside.orderBy("pvalue")))
    ranked = ranked.select("contrast", "place", "pvalue", (F.col("pvalue") * F.col("m") / F.col("i")).alias("q"))
    later = ranked.groupBy("contrast", "place").agg(F.min("q").alias("q")).select("contrast", "place", F.min("q").over(every.orderBy(F.desc("place")).rowsBetween(*up)).alias("later"))
    padj = F.least(F.lit(1.0), F.min("q").over(inside.orderBy(F.desc("pvalue"))), "later").alias("padj")
    found = ranked.join(later, ["contrast", "place"]).select("contrast", "pvalue", padj)
    return p.join(found, ["contrast", "pvalue"], "left").select(*p.columns, "padj")


def contrast_effects(counts: DataFrame, contrasts: DataFrame, minread: int = 1) -> DataFrame:
    """(contrast, feature, base_mean, log2fc, z): negative-binomial Wald statistics of features with minread counts at least in the contrast."""
    factors = size_factors(counts)
    sides = normalised(counts, factors).join(contrasts, "sample")
    mean = lambda role: F.avg(F.when(F.col("role") == role, F.col("q")))
    size = lambda role: F.count_if(F.col("role") == role)
    by = sides.groupBy("contrast", "feature").agg(F.sum("n").alias("total"), F.avg("q").alias("base_mean"), mean("treatment").alias("t"), mean("control").alias("c"), size("treatment").alias("nt"), size("control").alias("nc"))
    by = by.where((F.col("total") >= minread) & (F.col("nt") > 0) & (F.col("nc") > 0)).join(dispersions(counts, factors).select("feature", "alpha"), "feature")
    part = lambda mu, n: (1 / F.greatest(mu, F.lit(0.5)) + F.col("alpha")) / n
    lfc = F.log2((F.col("t") + 0.5) / (F.col("c") + 0.5))
    se = F.sqrt(part(F.col("t"), F.col("nt")) + part(F.col("c"), F.col("nc"))) / math.log(2)
    return by.select("contrast", "feature", "base_mean", lfc.alias("log2fc"), (lfc / se).alias("z"))


def diff_contrast(counts: DataFrame, contrasts: DataFrame, padj_cut: float = 0.05, foldchange: float = 1.0, minread: int = 1) -> DataFrame:
    """contrast_effects with pvalue, padj and significant."""
    out = adjusted(contrast_effects(counts, contrasts, minread).withColumn("pvalue", two_sided_p("z")))
    return out.withColumn("significant", (F.col("padj") < padj_cut) & (F.abs("log2fc") >= math.log2(foldchange)))
