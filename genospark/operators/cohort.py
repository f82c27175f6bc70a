"""Tables over all samples of a cohort: the catalog of events, counts, and compositions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as X
from .chimera import EVENT_COLUMNS, te_chimeras

ANNOTATION = [c for c in EVENT_COLUMNS if c not in ("sample", "reads", "event_id", "donor_hits", "acceptor_hits")]


def event_catalog(events: DataFrame) -> DataFrame:
    """One row per event_id: annotations as in its first sample by name, n_samples and total_reads. An event's samples are gathered as a set, so that events are shuffled once."""
    first = F.min_by(F.struct(*ANNOTATION), "sample").alias("a")
    return events.groupBy("event_id").agg(F.min("sample").alias("first_sample"), first, F.size(F.collect_set("sample")).cast("long").alias("n_samples"), F.sum("reads").alias("total_reads")).select("event_id", "first_sample", "a.*", "n_samples", "total_reads")


def te_catalog(events: DataFrame) -> DataFrame:
    """The gene-TE rows of event_catalog. Direction is part of event_id, so that the other events go before they are grouped."""
    return event_catalog(te_chimeras(events))


def counts_long(events: DataFrame) -> DataFrame:
    """(feature, sample, n): the canonical form of a counts matrix."""
    return events.groupBy(F.col("event_id").alias("feature"), "sample").agg(F.sum("reads").alias("n"))


def wide_matrix(long: DataFrame, samples: list[str], key: str = "feature") -> DataFrame:
    """A row per feature and a column per sample, 0 where there is no count. The samples are given, so that one job is enough."""
    return long.groupBy(key).pivot("sample", samples).agg(F.sum("n")).fillna(0, subset=samples)


def dense_grid(long: DataFrame) -> DataFrame:
    """(feature, sample, n) with a row for every feature and sample. The samples, a few thousand at most, are repeated for each feature."""
    samples = long.agg(F.array_sort(F.collect_set("sample")).alias("samples"))
    full = long.select("feature").distinct().join(F.broadcast(samples), how="cross").select("feature", F.explode("samples").alias("sample"))
    summed = long.groupBy("feature", "sample").agg(F.sum("n").alias("n"))
    return full.join(summed, ["feature", "sample"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def junction_qc(events: DataFrame) -> DataFrame:
    """(sample, metric, value): 21 counts of events per sample, zeros included, as one aggregation and an unpivot."""
    te = X.is_gene_te(F.col("direction"))
    metrics = {"events_total": F.lit(True), "events_gene_te": te}
    metrics |= {f"direction_{d}": F.col("direction") == d for d in X.DIRECTIONS}
    metrics |= {f"chimera_type_{k}": te & (F.col("chimera_type") == k) for k in X.CHIMERA_TYPES}
    metrics |= {f"canonical_{k}": F.col("canonical") == k for k in ("yes", "no")}
    metrics |= {"antisense_yes": F.col("antisense_flag") == "yes"}
    metrics |= {f"strand_match_{k}": te & (F.col("gene_strand_match") == k) for k in ("yes", "no", "NA")}
    wide = events.groupBy("sample").agg(*[F.count_if(test).alias(name.replace(".", "none")) for name, test in metrics.items()])
    long = wide.unpivot("sample", [m.replace(".", "none") for m in metrics], "metric", "value")
    return long.withColumn("metric", F.replace("metric", F.lit("_none"), F.lit("_.")))


def direction_composition(events: DataFrame) -> DataFrame:
    """(sample, direction, n, pct): events by direction and their share in per cent of the sample's, all eight directions."""
    counts = [F.count_if(F.col("direction") == d).alias(d) for d in X.DIRECTIONS]
    long = events.groupBy("sample").agg(*counts).unpivot("sample", list(X.DIRECTIONS), "direction", "n")
    return long.withColumn("pct", X.percent(F.col("n"), F.sum("n").over(Window.partitionBy("sample"))))


def te_chimera_composition(events: DataFrame) -> DataFrame:
    """(sample, direction, n, pct) of the two gene-TE directions, in per cent of all events."""
    counts = [F.count_if(F.col("direction") == d).alias(d) for d in X.GENE_TE]
    long = events.groupBy("sample").agg(F.count("*").alias("total"), *counts).unpivot(["sample", "total"], list(X.GENE_TE), "direction", "n")
    return long.select("sample", "direction", "n", X.percent(F.col("n"), F.col("total")).alias("pct"))


def repeat_flagged(events: DataFrame) -> DataFrame:
    """(sample, repeat_flagged): events whose repeat flag isn't 0."""
    return events.groupBy("sample").agg(F.count_if(F.col("repeat_flag") != "0").alias("repeat_flagged"))


def top_families(events: DataFrame, k: int = 5, column: str = "te_family") -> DataFrame:
    """(sample, rank, te_family, n): the k families with most gene-TE events of each sample; equal numbers go by name."""
    counts = te_chimeras(events).where(F.col(column) != ".").groupBy("sample", column).agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("sample").orderBy(F.desc("n"), column))
    return counts.withColumn("rank", rank).where(F.col("rank") <= k).select("sample", F.col("rank").cast("long").alias("rank"), column, "n")
