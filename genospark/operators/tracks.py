"""Gene, exon and TE tracks from annotation records.

Records: (line_no, chrom, feature, start, end, strand, attrs), positions 1-based and inclusive; see sources.readers.read_gtf.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _attr(name: str, default: str | None = ".") -> F.Column:
    value = F.try_element_at(F.col("attrs"), F.lit(name))
    return value if default is None else F.coalesce(value, F.lit(default))


def gene_spans(records: DataFrame) -> DataFrame:
    """(chrom, start0, end0, gene_id, strand): the span of every gene over all its records; strand of the first, chromosome of the last."""
    return records.groupBy(_attr("gene_id", None).alias("gene_id")).agg(
        F.max_by("chrom", "line_no").alias("chrom"), (F.min("start") - 1).alias("start0"), F.max("end").alias("end0"), F.min_by("strand", "line_no").alias("strand")
    ).select("chrom", "start0", "end0", "gene_id", "strand")


def exon_track(records: DataFrame) -> DataFrame:
    """(chrom, start0, end0, gene_id, strand), one row for each exon record, repeated ones too."""
    return records.where("feature = 'exon'").select("chrom", (F.col("start") - 1).alias("start0"), F.col("end").alias("end0"), _attr("gene_id", None).alias("gene_id"), "strand")


def te_track(records: DataFrame, key: str = "gene_id") -> DataFrame:
    """(chrom, start0, end0, te_id, strand, te_family, te_class): span of each key over all records, the rest from its first record.

    With key='transcript_id' each copy is a row of its own; with 'gene_id' copies that share it are one span.
    """
    first = lambda c: F.min_by(c, "line_no")
    return (
        records.where(_attr(key, None).isNotNull())
        .groupBy(_attr(key, None).alias("te_id"))
        .agg(first(F.col("chrom")).alias("chrom"), (F.min("start") - 1).alias("start0"), F.max("end").alias("end0"), first(F.col("strand")).alias("strand"), first(_attr("family_id")).alias("te_family"), first(_attr("class_id")).alias("te_class"))
        .select("chrom", "start0", "end0", "te_id", "strand", "te_family", "te_class")
    )


def transcript_blocks(records: DataFrame) -> DataFrame:
    """(chrom, start0, end0, transcript_id, strand, blocks): one row per transcript with exons, blocks (start, size) from its start on."""
    exons = records.where((F.col("feature") == "exon") & _attr("transcript_id", None).isNotNull())
    grouped = exons.groupBy(_attr("transcript_id", None).alias("transcript_id")).agg(
        F.min_by("chrom", "line_no").alias("chrom"), (F.min("start") - 1).alias("start0"), F.max("end").alias("end0"), F.min_by("strand", "line_no").alias("strand"),
        F.array_sort(F.collect_list(F.struct((F.col("start") - 1).alias("start"), (F.col("end") - F.col("start") + 1).alias("size")))).alias("found"),
    )
    blocks = F.transform("found", lambda b: F.struct((b["start"] - F.col("start0")).alias("start"), b["size"].alias("size")))
    return grouped.select("chrom", "start0", "end0", "transcript_id", "strand", blocks.alias("blocks"))


def feature_keys(records: DataFrame) -> DataFrame:
    """(feature): the keys under which a count table has the annotation: gene:family:class for TEs, else the gene."""
    family, group = _attr("family_id", None), _attr("class_id", None)
    key = F.when(family.isNotNull() & group.isNotNull(), F.concat_ws(":", _attr("gene_id", None), family, group)).otherwise(_attr("gene_id", None))
    return records.select(key.alias("feature")).where("feature is not null").distinct()


def line_count(lines: DataFrame, by: str = "file") -> DataFrame:
    """(by, n, warning): lines of an annotation file that are neither blank nor comments; a warning where there are none."""
    counts = ~(F.trim("value").startswith("#") | (F.trim("value") == ""))
    return lines.groupBy(by).agg(F.count_if(counts).alias("n")).withColumn("warning", F.col("n") == 0)
