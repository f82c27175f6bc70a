"""Text inputs as DataFrames. Compression goes by the file name's ending; bad lines are dropped or zeroed as each reader says."""

from __future__ import annotations

import json
import os
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expressions import try_long
from ..operators.chimera import EVENT_COLUMNS
from ..storage import Shelf, few
from . import fastq

Paths = str | list[str]
# Patterns of the files' formats.
QUOTED_ATTRIBUTE = r'(\w+)\s+"([^"]*)"'
REPORT_LINE = r'explained by "([^"]+)":\s*([\d.]+)'


def numbered_lines(spark: SparkSession, paths: Paths) -> DataFrame:
    """(file, line_no, value): the lines of text files with their numbers from 0.

    Lines are counted per split; the running sum of these counts, a few numbers per file, gives the first number of each
    split. So a large file is numbered in parallel, without sorting its lines; the counts are stored first, so that no line
    is shuffled to meet them.
    """
    return numbered(spark.read.text(paths).select("value", *_block()))


def _block() -> list[Column]:
    """Where a row of a file comes from."""
    return [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]


def numbered(rows: DataFrame, by: tuple[str, ...] = ("file",)) -> DataFrame:
    """rows read from files, with file and block, as file, line_no and their own columns: see numbered_lines. by: what numbers begin anew for; without it they go on from file to file by name."""
    own = [c for c in rows.columns if c not in ("file", "block")]
    rows = rows.withColumn("id", F.monotonically_increasing_id())
    splits = rows.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*by).orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = Shelf(rows.sparkSession).put(splits.withColumn("before", before), keep=True)
    return rows.join(few(splits), ["file", "block"]).select("file", (F.col("before") + F.col("id") - F.col("first")).alias("line_no"), *own)


def _content(lines: DataFrame) -> DataFrame:
    return lines.where((F.trim("value") != "") & ~F.col("value").startswith("#"))


def gtf_attrs(text: Column) -> Column:
    """The attributes of a GTF line, quotes optional; a key without a value has an empty one, of a repeated key the last value counts."""
    pairs = F.filter(F.transform(F.split(text, ";"), lambda p: F.split(F.trim(p), r"\s+", 2)), lambda p: p[0] != "")
    value = lambda p: F.coalesce(F.get(p, F.lit(1)), F.lit(""))
    entry = F.transform(pairs, lambda p: F.struct(p[0].alias("k"), F.trim(F.regexp_replace(F.trim(value(p)), '^"|"$', "")).alias("v")))
    return _last_wins(entry)


def gtf_attrs_quoted(text: Column) -> Column:
    """The attributes with quoted values only."""
    k, v = (F.regexp_extract_all(text, F.lit(QUOTED_ATTRIBUTE), F.lit(i)) for i in (1, 2))
    return _last_wins(F.zip_with(k, v, lambda a, b: F.struct(a.alias("k"), b.alias("v"))))


def _last_wins(entries: Column) -> Column:
    """A map of (k, v) entries in which the last of equal keys stays."""
    kept = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.greatest(F.size(entries) - i - 1, F.lit(0))), lambda x: x["k"] == e["k"]))
    return F.map_from_entries(kept)


def gtf_records(lines: DataFrame, quoted: bool = False) -> DataFrame:
    """(line_no, chrom, source, feature, start, end, score, strand, frame, attrs) of lines(line_no, value); lines with fewer than 9 columns, without whole-number positions or a gene_id are dropped."""
    c = F.split("value", "\t")
    rows = _content(lines).where(F.size(c) >= 9).select("line_no", c.alias("c"))
    rows = rows.select(
        "line_no", *[F.col("c")[i].alias(n) for i, n in ((0, "chrom"), (1, "source"), (2, "feature"))], try_long(F.col("c")[3]).alias("start"), try_long(F.col("c")[4]).alias("end"),
        *[F.col("c")[i].alias(n) for i, n in ((5, "score"), (6, "strand"), (7, "frame"))], (gtf_attrs_quoted if quoted else gtf_attrs)(F.col("c")[8]).alias("attrs"),
    )
    return rows.where(F.col("start").isNotNull() & F.col("end").isNotNull() & (F.coalesce(F.try_element_at("attrs", F.lit("gene_id")), F.lit("")) != ""))


def read_gtf(spark: SparkSession, paths: Paths, quoted: bool = False) -> DataFrame:
    return gtf_records(numbered_lines(spark, paths), quoted)


def read_bed(spark: SparkSession, paths: Paths, extra: tuple[str, ...] = ()) -> DataFrame:
    """(chrom, start0, end0, id, score, strand, *extra); comments, blank lines and lines with fewer than 6 columns are dropped."""
    c = F.split("value", "\t")
    rows = _content(spark.read.text(paths)).where(F.size(c) >= 6)
    names = ("id", "score", "strand", *extra)
    return rows.select(c[0].alias("chrom"), try_long(c[1]).alias("start0"), try_long(c[2]).alias("end0"), *[F.get(c, F.lit(3 + i)).alias(n) for i, n in enumerate(names)])


def _sample_of(file: Column) -> Column:
    return F.regexp_extract(file, r"([^/]+?)(?:_Chimeric\.out\.junction|\.[^/]*)?$", 1)


def read_junctions(spark: SparkSession, paths: Paths, sample: Column | None = None) -> DataFrame:
    """Junction lines by file; those with fewer than 8 columns or breakpoints that are no whole numbers (the header) are dropped."""
    c = F.split("value", "\t")
    rows = numbered_lines(spark, paths).where(F.size(c) >= 8)
    name = sample if sample is not None else _sample_of(F.col("file"))
    return rows.select(
        name.alias("sample"), "line_no", c[0].alias("donor_chrom"), try_long(c[1]).alias("donor_bp"), c[2].alias("donor_strand"), c[3].alias("acceptor_chrom"), try_long(c[4]).alias("acceptor_bp"), c[5].alias("acceptor_strand"), c[6].alias("junction_type"), c[7].alias("repeat_flag")
    ).where("donor_bp is not null and acceptor_bp is not null")


def read_events(spark: SparkSession, paths: Paths) -> DataFrame:
    """Event tables as write_events leaves them, in folders by sample, with whole numbers as such; a number that is none is null, a row of another number of columns is an error."""
    numbers = ("donor_breakpoint", "acceptor_breakpoint", "reads")
    schema = ", ".join(f"{c} {'long' if c in numbers else 'string'}" for c in EVENT_COLUMNS if c != "sample")
    rows = spark.read.schema(f"{schema}, sample string").csv(paths, sep="\t", header=True, enforceSchema=False, quote="")
    return rows.select(*EVENT_COLUMNS)


def read_table(spark: SparkSession, paths: Paths) -> DataFrame:
    """A tab-separated table with a header, all columns text."""
    return spark.read.csv(paths, sep="\t", header=True, inferSchema=False, quote="")


def _files(spark: SparkSession, path: str) -> list[str]:
    """The path itself, or the files of the folder that it names, without hidden ones."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(p) or not system.getFileStatus(p).isDirectory():
        return [path]
    names = [x.getPath().getName() for x in system.listStatus(p)]
    return [f"{path.rstrip('/')}/{n}" for n in names if not n.startswith(("_", "."))]


def read_count_tables(spark: SparkSession, paths: dict[str, str], on_bad: str = "zero") -> DataFrame:
    """(sample, feature, n) of one count table per sample, given as {sample: path of a file or folder}; the header's own names don't matter.

    Numbers are cut to whole ones. on_bad: what becomes of other text: 'zero'; 'strict', which also zeroes decimals; or
    'raise'. Of a feature that a file holds twice the last line counts.
    """
    bare = r"^[^:/]+:(//[^/]*)?"  # scheme and host
    named = [(re.sub(bare, "", p) if re.match(bare, p) else os.path.abspath(p), sample) for sample, path in paths.items() for p in _files(spark, path)]
    lines = numbered_lines(spark, list(paths.values())).withColumn("path", F.regexp_replace("file", bare, ""))
    c = F.split("value", "\t")
    # one scan, however many samples: each file's name gives its own
    rows = lines.join(few(spark.createDataFrame(named, "path string, sample string")), "path")
    out = rows.where((F.col("line_no") > 0) & (F.size(c) >= 2)).select("sample", c[0].alias("feature"), F.trim(c[1]).alias("text"), "line_no")
    n = F.col("text").try_cast("bigint") if on_bad == "strict" else F.col("text").try_cast("double").cast("bigint")
    n = F.when(F.col("text").rlike(r"^[+-]?\d+$"), n) if on_bad == "strict" else n
    n = F.coalesce(n, F.raise_error(F.concat(F.lit("no number: "), "text")).cast("bigint") if on_bad == "raise" else F.lit(0))
    return out.groupBy("sample", "feature").agg(F.max_by("text", "line_no").alias("text")).select("sample", "feature", n.alias("n"))


def read_sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """(row, sample, fastq_1, fastq_2, strandedness, condition), all text, trimmed, blank as null; lines that begin with # are comments. row: the row's number in the sheet, however its file is split; the part files of a folder follow each other by name."""
    sheet = spark.read.csv(path, header=True, comment="#", inferSchema=False)
    sheet = numbered(sheet.select("*", *_block()), ())
    blank = lambda c: F.nullif(F.trim(F.col(c)), F.lit("")).alias(c) if c in sheet.columns else F.lit(None).cast("string").alias(c)
    return sheet.select(F.col("line_no").alias("row"), *[blank(c) for c in ("sample", "fastq_1", "fastq_2", "strandedness", "condition")])


def infer_report(lines: DataFrame) -> DataFrame:
    """(sample, line_no, pattern, fraction) of the lines (sample, line_no, value) of strandedness reports."""
    pattern = REPORT_LINE
    rows = lines.where(F.col("value").rlike(pattern))
    return rows.select("sample", "line_no", F.regexp_extract("value", pattern, 1).alias("pattern"), F.regexp_extract("value", pattern, 2).try_cast("double").alias("fraction"))


def read_infer_report(spark: SparkSession, paths: Paths) -> DataFrame:
    return infer_report(numbered_lines(spark, paths).select(_sample_of(F.col("file")).alias("sample"), "line_no", "value"))


def read_fastq(spark: SparkSession, paths: Paths, split_bytes: int = fastq.SPLIT) -> DataFrame:
    """(file, pos, read_id, seq, qual): records of four lines; pos orders the records of a file.

    Paths that tasks can open are read by the data source `fastq`, without a shuffle: pos is the record's first byte. What
    only Spark's own readers reach (globs, file systems of their own) goes by numbered lines: pos is the record's number.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if all(map(fastq.reachable, paths)):
        spark.dataSource.register(fastq.FastqSource)
        return spark.read.format("fastq").option("paths", json.dumps(paths)).option("splitbytes", split_bytes).load()
    lines = numbered_lines(spark, paths).withColumn("record", F.floor(F.col("line_no") / 4))
    part = lambda k: F.max(F.when(F.col("line_no") % 4 == k, F.col("value")))
    by = lines.groupBy("file", F.col("record").alias("pos")).agg(part(0).alias("h"), part(1).alias("seq"), part(3).alias("qual")).where("qual is not null")
    return by.select("file", "pos", F.split(F.regexp_replace("h", "^@", ""), r"\s")[0].alias("read_id"), "seq", "qual")


def read_job_metrics(spark: SparkSession, paths: Paths) -> DataFrame:
    """(rule, s, max_rss, mean_load): the rule is the folder's name; older files have cpu_percent in place of mean_load."""
    lines = numbered_lines(spark, paths).where(F.trim("value") != "")
    head = lines.groupBy("file").agg(F.min_by(F.split("value", "\t"), "line_no").alias("head"), F.min("line_no").alias("first"))
    rows = lines.join(few(head), "file").where(F.col("line_no") > F.col("first"))
    at = lambda name: F.when(F.array_contains("head", name), F.get(F.split("value", "\t"), (F.array_position("head", name) - 1).cast("int")))
    load = F.when(F.array_contains("head", "mean_load"), at("mean_load")).otherwise(at("cpu_percent"))
    return rows.select(F.element_at(F.split("file", "/"), -2).alias("rule"), at("s").alias("s"), at("max_rss").alias("max_rss"), load.alias("mean_load"))


def read_metrics(spark: SparkSession, paths: Paths, sample: Column | None = None) -> DataFrame:
    """(sample, metric, value) of two-column tables with a header; the sample is the file's name unless an expression over file is given."""
    c = F.split("value", "\t")
    rows = numbered_lines(spark, paths).where((F.col("line_no") > 0) & (F.size(c) >= 2))
    name = sample if sample is not None else _sample_of(F.col("file"))
    return rows.select(name.alias("sample"), c[0].alias("metric"), c[1].alias("value"))
