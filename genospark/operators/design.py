"""The sample sheet: lanes, checks, conditions, contrasts and strandedness.

sheet(row, sample, fastq_1, fastq_2, strandedness, condition), row giving the order of the sheet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X


def _blank(c: str) -> F.Column:
    return F.nullif(F.trim(F.col(c)), F.lit(""))


def lane_group(sheet: DataFrame) -> DataFrame:
    """(sample, fastq_1, fastq_2, strandedness, condition): one row per sample, its files in the order of the sheet."""
    files = lambda c: F.transform(F.array_sort(F.collect_list(F.when(_blank(c).isNotNull(), F.struct("row", _blank(c).alias("f"))))), lambda x: x["f"])
    return sheet.where(_blank("sample").isNotNull()).groupBy(_blank("sample").alias("sample")).agg(
        files("fastq_1").alias("fastq_1"), files("fastq_2").alias("fastq_2"), F.max(_blank("strandedness")).alias("strandedness"), F.max(_blank("condition")).alias("condition")
    )


def sheet_violations(sheet: DataFrame) -> DataFrame:
    """(sample, rule, n): what is wrong with a sheet, and in how many rows or with how many values."""
    rows = sheet.select(*[_blank(c).alias(c) for c in ("sample", "fastq_1", "fastq_2", "strandedness", "condition")])
    by = rows.groupBy("sample").agg(
        F.when(F.col("sample").isNull(), F.count("*")).otherwise(0).alias("missing_sample"),
        F.count_if(F.col("fastq_1").isNull()).alias("missing_fastq_1"),
        F.greatest(F.count_distinct("strandedness") - 1, F.lit(0)).alias("strandedness_conflict"),
        F.greatest(F.count_distinct("condition") - 1, F.lit(0)).alias("condition_conflict"),
        F.when((F.count("fastq_2") > 0) & (F.count("fastq_2") != F.count("fastq_1")), F.abs(F.count("fastq_1") - F.count("fastq_2"))).otherwise(0).alias("mate_count"),
    )
    rules = ["missing_sample", "missing_fastq_1", "strandedness_conflict", "condition_conflict", "mate_count"]
    return by.unpivot("sample", rules, "rule", "n").where("n > 0")


def strandedness_violations(sheet: DataFrame) -> DataFrame:
    """(sample, value): strandedness values that aren't known."""
    return sheet.where(_blank("strandedness").isNotNull() & X.normal_strandedness(F.col("strandedness")).isNull()).select("sample", F.col("strandedness").alias("value"))


def require_none(violations: DataFrame, what: str) -> None:
    """Strict mode: an error that names some of the violations, if there are any."""
    if found := violations.limit(5).collect():
        raise ValueError(f"{what}: " + "; ".join(str(r.asDict()) for r in found))


def has_condition(sheet: DataFrame) -> DataFrame:
    """(has_condition): whether every sample has a condition; false for an empty sheet."""
    return sheet.groupBy("sample").agg(F.max(_blank("condition")).alias("c")).agg(F.coalesce(F.bool_and(F.col("c").isNotNull()), F.lit(False)).alias("has_condition"))


def contrast_pairs(sheet: DataFrame) -> DataFrame:
    """(contrast, sample, role) for every pair of conditions, named later_vs_earlier by the alphabet; the later is the treatment.

    No rows unless every sample has a condition. Conditions are few: their pairs are the contrasts asked for.
    """
    samples = sheet.groupBy("sample").agg(F.max(_blank("condition")).alias("condition"))
    samples = samples.join(F.broadcast(has_condition(sheet).where("has_condition")), how="cross").drop("has_condition")
    c = samples.select("condition").distinct()
    pairs = c.toDF("earlier").join(c.toDF("later"), F.col("earlier") < F.col("later")).withColumn("contrast", F.concat_ws("_vs_", "later", "earlier"))
    sides = pairs.select("contrast", F.col("later").alias("condition"), F.lit("treatment").alias("role")).union(pairs.select("contrast", F.col("earlier").alias("condition"), F.lit("control").alias("role")))
    return sides.join(samples, "condition").select("contrast", "sample", "role")


def contrast_replicates(contrasts: DataFrame) -> DataFrame:
    """(contrast, role, n, warning): samples on each side; a warning below two."""
    return contrasts.groupBy("contrast", "role").agg(F.count("*").alias("n")).withColumn("warning", F.col("n") < 2)


def contrast_strandedness(contrasts: DataFrame, calls: DataFrame) -> DataFrame:
    """(contrast, n_calls, calls): contrasts whose samples don't share one strandedness call."""
    by = contrasts.join(calls, "sample").groupBy("contrast").agg(F.count_distinct("call").alias("n_calls"), F.array_join(F.array_sort(F.collect_set("call")), ",").alias("calls"))
    return by.where("n_calls > 1")


def _own_strandedness(sheet: DataFrame) -> DataFrame:
    return sheet.groupBy("sample").agg(F.max(X.normal_strandedness(_blank("strandedness"))).alias("own"))


def strandedness_open(sheet: DataFrame) -> DataFrame:
    """(sample): the samples whose strandedness the sheet leaves to inference."""
    return _own_strandedness(sheet).where("own is null or own = 'auto'").select("sample")


def strandedness_resolve(sheet: DataFrame, inferred: DataFrame) -> DataFrame:
    """(sample, call): the sheet's value, or for auto or none the inferred call, `no` where there isn't one."""
    joined = _own_strandedness(sheet).join(inferred.select("sample", F.col("call").alias("found")), "sample", "left")
    return joined.select("sample", F.coalesce(F.nullif("own", F.lit("auto")), "found", F.lit("no")).alias("call"))


def report_calls(report: DataFrame, least: float = 0.6) -> DataFrame:
    """(sample, forward, reverse, call) from parsed report lines (sample, line_no, pattern, fraction); a later line of a kind counts."""
    token = F.element_at(F.split("pattern", ","), 1)
    last = lambda end: F.coalesce(F.max_by(F.when(token.endswith(end), F.col("fraction")), F.when(token.endswith(end), F.col("line_no"))), F.lit(0.0))
    by = report.groupBy("sample").agg(last("++").alias("forward"), last("+-").alias("reverse"))
    return by.withColumn("call", X.strandedness_call(F.col("forward"), F.col("reverse"), least))
