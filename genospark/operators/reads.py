"""Reads (sample, mate, file or lane, read_id, seq, qual): lanes, lengths and quality profiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import few


#: What a quality report is by; columns that reads lack are left out.
BY = ("sample", "mate")


def _by(reads: DataFrame, by: tuple[str, ...]) -> list[str]:
    return [c for c in by if c in reads.columns]


def lane_places(lanes: DataFrame) -> DataFrame:
    """(sample, mate, file, place): the files of design.lane_group, by mate R1 and R2, with their places in the order of the sheet."""
    of = lambda c, mate: lanes.select("sample", F.lit(mate).alias("mate"), F.posexplode(c).alias("place", "file"))
    return of("fastq_1", "R1").union(of("fastq_2", "R2")).select("sample", "mate", "file", "place")


def lane_merge(reads: DataFrame, lanes: DataFrame) -> DataFrame:
    """reads(sample, mate, file, pos, ...) of the files that the lanes (sample, mate, file, place) name, with place.

    Ordered by place, then pos, the rows of a sample and mate are its merged file; a single lane passes as it is. A file
    that two rows of the sheet name is there twice.
    """
    return reads.join(few(lanes), ["sample", "mate", "file"]).select(*reads.columns, "place")


def read_totals(reads: DataFrame, by: tuple[str, ...] = BY) -> DataFrame:
    """(sample, mate, n_reads, n_bases, min_length, max_length, gc_pct, n_pct)."""
    by = _by(reads, by)
    of = lambda letters: F.sum(F.length(F.regexp_replace("seq", f"[^{letters}]", "")))
    out = reads.groupBy(*by).agg(F.count("*").alias("n_reads"), F.sum(F.length("seq")).cast("long").alias("n_bases"), F.min(F.length("seq")).cast("long").alias("min_length"), F.max(F.length("seq")).cast("long").alias("max_length"), of("GCgc").alias("gc"), of("Nn").alias("nn"))
    share = lambda c: F.when(F.col("n_bases") > 0, F.round(100.0 * F.col(c) / F.col("n_bases"), 6)).otherwise(0.0)
    return out.select(*by, "n_reads", "n_bases", "min_length", "max_length", share("gc").alias("gc_pct"), share("nn").alias("n_pct"))


def _positions(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, position, byte) of every byte of a column of ASCII texts; null is empty."""
    data = column.fill_null("").cast(pa.large_binary())
    bounds = np.frombuffer(data.buffers()[1], np.int64, len(data) + 1 + data.offset)[data.offset :]
    size = np.diff(bounds)
    flat = np.frombuffer(data.buffers()[2], np.uint8)[bounds[0] : bounds[-1]] if bounds[-1] > bounds[0] else np.zeros(0, np.uint8)
    return np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(bounds[:-1] - bounds[0], size), flat


def position_profile(reads: DataFrame, by: tuple[str, ...] = BY) -> DataFrame:
    """(sample, mate, pos, n, mean_quality, n_pct): by position from 0, the quality values, their mean Phred score, and the N among the bases in per cent.

    A task adds its reads up to arrays by position and gives one row for each sample and mate: no row for a base, whatever
    the number of reads. FASTQ texts are ASCII.
    """
    by = _by(reads, by)
    names = ("n", "q", "bases", "nn")
    schema = ", ".join([f"{c} {reads.schema[c].dataType.simpleString()}" for c in by] + [f"{c} array<long>" for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place: dict[tuple, int] = {}
        sums = {c: np.zeros((0, 0), np.int64) for c in names}
        kinds = None
        for b in batches:
            kinds = [b.schema.field(c).type for c in by]
            keys = zip(*(b.column(c).to_pylist() for c in by)) if by else [()] * b.num_rows
            code = np.array([place.setdefault(k, len(place)) for k in keys], int)
            for column, count, value, worth in (("qual", "n", "q", lambda x: x.astype(np.int64) - 33), ("seq", "bases", "nn", lambda x: (x == 78) | (x == 110))):
                row, pos, byte = _positions(b.column(column))
                longest = int(pos.max()) + 1 if len(pos) else 0
                for name in (count, value):
                    have = sums[name]
                    sums[name] = np.pad(have, ((0, max(len(place) - have.shape[0], 0)), (0, max(longest - have.shape[1], 0))))
                cell = code[row] * sums[count].shape[1] + pos
                for name, weight in ((count, None), (value, worth(byte))):
                    sums[name] += np.bincount(cell, weight, sums[name].size).astype(np.int64).reshape(sums[name].shape)
        if place and kinds is not None:
            keys = [pa.array([k[i] for k in place], t) for i, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*keys, *(pa.array(list(sums[c]), pa.list_(pa.int64())) for c in names)], [*by, *names])

    parts = reads.select(*by, F.col("seq").cast("string"), F.col("qual").cast("string")).mapInArrow(run, schema)
    wide = parts.select(*by, *names, F.explode(F.sequence(F.lit(0), F.greatest(F.size("n"), F.size("bases")) - 1)).alias("pos"))
    at = lambda c: F.coalesce(F.sum(F.get(F.col(c), F.col("pos"))), F.lit(0)).alias(c)
    out = wide.groupBy(*by, F.col("pos").cast("long").alias("pos")).agg(*map(at, names)).where("n + bases > 0")
    share = F.when(F.col("bases") > 0, F.round(100.0 * F.col("nn") / F.col("bases"), 6)).otherwise(0.0)
    return out.select(*by, "pos", "n", F.round(F.try_divide(F.col("q"), F.col("n")), 6).alias("mean_quality"), share.alias("n_pct"))


def length_distribution(reads: DataFrame, by: tuple[str, ...] = BY) -> DataFrame:
    return reads.groupBy(*_by(reads, by), F.length("seq").cast("long").alias("length")).agg(F.count("*").alias("n"))


def max_read_length(reads: DataFrame, peek: int | None = 20, file: str = "lane", order: str = "read_id", overhang: int | None = None) -> DataFrame:
    """(sample, max_length, overhang): the longest of the first `peek` reads of each of a sample's files (of all without), and one less, or the overhang that is given.

    Reads go by `order`, their place in the file. A sample whose longest read is empty is an error, unless an overhang is given.
    """
    if peek:
        by = Window.partitionBy("sample", file).orderBy(order)
        reads = reads.withColumn("k", F.row_number().over(by)).where(F.col("k") <= peek)
    longest = reads.groupBy("sample").agg(F.max(F.length("seq")).cast("long").alias("max_length"))
    failed = F.raise_error(F.concat(F.lit("no read with a length: "), F.coalesce("sample", F.lit("")))).cast("long")
    found = F.when(F.col("max_length") > 0, F.col("max_length") - 1).otherwise(failed)
    return longest.withColumn("overhang", found if overhang is None else F.lit(overhang).cast("long"))


def nonempty_reads(files: DataFrame) -> DataFrame:
    """(sample, n_files, n_reads, ok): files(sample, file, n_reads); not ok only if none of the files has a read."""
    return files.groupBy("sample").agg(F.count("*").alias("n_files"), F.sum("n_reads").alias("n_reads"), F.bool_or(F.col("n_reads") > 0).alias("ok"))
