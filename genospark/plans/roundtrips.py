"""Registered queries over text files: views written by the writers, read by the readers, with the order that the files have."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import cohort, design, reads
from ..sources import readers, writers
from ..storage import Shelf, few, shared_dir
from .queries import SAMPLES, Views, _jobs, _lanes, _read_sheet, query


def folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/text-{uuid.uuid4().hex}"


def of(name: str) -> Column:
    """The value of a partition column in a file's path."""
    return F.regexp_extract("file", f"{name}=([^/]+)", 1)


def in_order(lines: DataFrame, by: Column, skip: int = 0, whole: bool = False) -> DataFrame:
    """lines(file, line_no, value) with at, their place (from 1) among those of the same `by` as the files have them, headers of `skip` lines aside.

    Places are taken inside a file, and go on from file to file by one row for each: no task reads all lines of a `by`.
    whole: all lines of a file have one `by`, so that their numbers are their places in it, and no line is shuffled.
    """
    rows = lines.where(F.col("line_no") >= skip).withColumn("by", by)
    earlier = Window.partitionBy("by").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("by", "file").agg(F.count("*").alias("n"))
    sizes = Shelf(lines.sparkSession).put(sizes.select("by", "file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), keep=True)
    k = F.col("line_no") - skip + 1 if whole else F.row_number().over(Window.partitionBy("by", "file").orderBy("line_no"))
    placed = rows.withColumn("k", k)
    return placed.join(few(sizes), ["by", "file"]).withColumn("at", F.col("before") + F.col("k")).drop("before", "k")


def bed(spark: SparkSession, sf: str, gzip: bool) -> str:
    path = folder(spark)
    writers.write_bed(Views(spark, sf).te, path, "te_id", ("te_family", "te_class"), gzip=gzip)
    return path


@query
def s4_read_bed(spark, sf):
    return readers.read_bed(spark, bed(spark, sf, False), ("te_family", "te_class"))


@query
def s14_gzip_bed(spark, sf):
    return readers.read_bed(spark, bed(spark, sf, True), ("te_family", "te_class"))


@query
def o1_bed_order(spark, sf):
    """The place of each row among those of its chromosome."""
    fields = F.split("value", "\t")
    return in_order(readers.numbered_lines(spark, bed(spark, sf, False)), fields[0]).select(F.col("by").alias("chrom"), "at", fields[3].alias("te_id"))


@query
def s6_read_junctions(spark, sf):
    """Lines of junctions in folders by sample, and how often each is there."""
    columns = ["donor_chrom", "donor_bp", "donor_strand", "acceptor_chrom", "acceptor_bp", "acceptor_strand", "junction_type", "repeat_flag"]
    path = folder(spark)
    Views(spark, sf).junctions.orderBy("sample", "line_no").select("sample", *columns).write.partitionBy("sample").csv(path, sep="\t", header=True)
    back = readers.read_junctions(spark, path, of("sample"))
    return back.groupBy("sample", *columns).agg(F.count("*").alias("n"))


def events_written(spark: SparkSession, sf: str) -> str:
    path = folder(spark)
    writers.write_events(Views(spark, sf).annotated(), path, gzip=True)
    return path


@query
def s7_read_events(spark, sf):
    return readers.read_events(spark, f"{events_written(spark, sf)}/events")


@query
def o2_event_order(spark, sf):
    """The place of each event in its sample's files."""
    lines = readers.numbered_lines(spark, f"{events_written(spark, sf)}/events")
    return in_order(lines, of("sample"), 1, whole=True).select(F.col("by").alias("sample"), "at", F.split("value", "\t")[0].alias("event_id"))


@query
def o3_catalog_order(spark, sf):
    """The place of each event of the catalog's files among those of its direction."""
    path = folder(spark)
    writers.write_catalog(cohort.event_catalog(Views(spark, sf).annotated()), path, gzip=True)
    lines = readers.numbered_lines(spark, path).withColumn("value", F.split("value", "\t")[0])
    return in_order(lines, F.element_at(F.split("value", ":"), -1), 1).select(F.col("by").alias("direction"), "at", F.col("value").alias("event_id"))


@query
def s8_read_count_tables(spark, sf):
    path = folder(spark)
    Views(spark, sf).cnt.select("sample", "feature", "n").write.partitionBy("sample").csv(path, sep="\t", header=True)
    return readers.read_count_tables(spark, {s: f"{path}/sample={s}" for s in SAMPLES})


@query
def s9_read_sample_sheet(spark, sf):
    path = folder(spark)
    sheet = _lanes(spark, sf).orderBy("row")
    sheet.drop("row").write.csv(path, header=True)
    return readers.read_sample_sheet(spark, path)


@query
def s11_read_fastq(spark, sf):
    """Reads as records of four lines in files by sample and lane, read in ranges of 64 KiB."""
    return fastq(spark, sf, "none")


@query
def s11_read_fastq_gz(spark, sf):
    return fastq(spark, sf, "gzip")


def fastq(spark: SparkSession, sf: str, compression: str) -> DataFrame:
    path = folder(spark)
    r = Views(spark, sf).reads
    record = F.concat_ws("\n", F.concat(F.lit("@"), F.col("read_id").cast("string"), F.lit(" 1:N:0")), "seq", F.lit("+"), "qual")
    r.select("sample", "lane", record.alias("value")).write.partitionBy("sample", "lane").option("compression", compression).text(path)
    back = readers.read_fastq(spark, path, 1 << 16)
    return back.select(of("sample").alias("sample"), of("lane").alias("lane"), F.col("read_id").cast("long").alias("read_id"), "seq", "qual")


@query
def s12_read_job_metrics(spark, sf):
    path = folder(spark)
    Views(spark, sf).metrics.select("rule", "s", "max_rss", "mean_load").write.partitionBy("rule").csv(path, sep="\t", header=True)
    back = readers.read_job_metrics(spark, path)
    number = lambda c: F.round(F.sum(F.col(c).cast("double")), 4).alias(c)
    return back.groupBy(F.regexp_replace("rule", "^rule=", "").alias("rule")).agg(F.count("*").alias("n"), *map(number, ("s", "max_rss", "mean_load")))


@query
def s13_read_metrics(spark, sf):
    path = folder(spark)
    cohort.junction_qc(Views(spark, sf).annotated()).write.partitionBy("sample").csv(path, sep="\t", header=True)
    return readers.read_metrics(spark, path, of("sample"))


@query
def s16_track_lines(spark, sf):
    """The browser tracks' lines by sample and place."""
    path = folder(spark)
    writers.write_igv_bed(Views(spark, sf).annotated(), path)
    return in_order(readers.numbered_lines(spark, path), of("sample"), whole=True).select(F.col("by").alias("sample"), "at", "value")


def matrix(spark: SparkSession, sf: str) -> str:
    path = folder(spark)
    writers.write_matrix(Views(spark, sf).cnt, path, SAMPLES)
    return path


@query
def s17_write_matrix(spark, sf):
    return readers.read_table(spark, matrix(spark, sf)).select("feature", *[F.col(s).cast("long").alias(s) for s in SAMPLES])


@query
def o4_matrix_order(spark, sf):
    """The place of each feature in the matrix' files among those with the same first letter."""
    key = F.split("value", "\t")[0]
    return in_order(readers.numbered_lines(spark, matrix(spark, sf)), F.substring(key, 1, 1), 1).select("by", "at", key.alias("feature"))


@query
def o5_rule_order(spark, sf):
    """The place of each rule in the written summary."""
    path = folder(spark)
    writers.write_table(_jobs(spark, sf), path, ["pos", "rule"])
    return in_order(readers.numbered_lines(spark, path), F.lit(""), 1).select("at", F.split("value", "\t")[0].alias("rule"))


@query
def q9_merged_files(spark, sf):
    """Lanes merged in the order of the sheet, written as FASTQ by sample and mate, and read again: at is a read's place."""
    v, path = Views(spark, sf), folder(spark)
    r = v.reads.withColumn("file", F.concat_ws("_", "lane", "mate")).withColumn("pos", F.col("read_id"))
    merged = reads.lane_merge(r, reads.lane_places(design.lane_group(_read_sheet(v))))
    writers.write_reads(merged, path, ["place", "pos"])
    back = readers.read_fastq(spark, path, 1 << 16).select(of("sample").alias("sample"), of("mate").alias("mate"), "file", "pos", F.col("read_id").cast("long").alias("read_id"))
    at = F.row_number().over(Window.partitionBy("sample", "mate").orderBy("file", "pos")).cast("long")
    return back.select("sample", "mate", at.alias("at"), "read_id")
