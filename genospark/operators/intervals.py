"""Overlap joins of half-open intervals [start0, end0) on chromosomes, as binned equi-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import window_end, window_start

#: Bin widths. An interval belongs to the first level that is as wide as it is long, so that it lies in two bins at most.
WIDTHS = tuple(1 << k for k in (9, 13, 17, 21, 25, 29))
#: Parts that the narrower rows of a bin are dealt to, by level: wide bins hold many of them, and few wide rows to be repeated.
SALTS = (1, 1, 4, 16, 64, 256)


def level(start: Column, end: Column) -> Column:
    out = F.lit(len(WIDTHS) - 1)
    for i in range(len(WIDTHS) - 2, -1, -1):
        out = F.when(end - start <= WIDTHS[i], i).otherwise(out)
    return out


def _by_level(values: tuple[int, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("lv") + 1)


def _dealt(df: DataFrame, prefix: str, from_level: Column, to_level: Column, repeated: bool, levels: list[int] | None = None) -> DataFrame:
    """df with a row for each level of the range, and of levels where they are given, and each of its bins there: lv, bin, first, its first bin, and salt, a part of the bin by its place, or each of them where it is repeated."""
    width, salts = _by_level(WIDTHS), _by_level(SALTS)
    start, end = F.col(f"{prefix}start0"), F.greatest(F.col(f"{prefix}end0"), F.col(f"{prefix}start0") + 1)
    none = F.array().cast("array<int>")
    at = F.when(from_level <= to_level, F.sequence(from_level, to_level)).otherwise(none)
    return (
        df.withColumn("lv", F.explode(at if levels is None else F.filter(at, lambda lv: lv.isin(levels))))
        .withColumn("first", F.floor(start / width).cast("long"))
        .withColumn("bin", F.explode(F.sequence(F.col("first"), F.floor((end - 1) / width).cast("long"))))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)) if repeated else F.pmod(F.hash(start, end), salts))
    )


def _level_of(width: int) -> int:
    return next((k for k, w in enumerate(WIDTHS) if width <= w), len(WIDTHS) - 1)


def _levels(features: DataFrame) -> list[int]:
    """The levels that features belong to, six at most: looked up by a job of its own."""
    return sorted(features.agg(F.collect_set(level(F.col("start0"), F.col("end0")))).first()[0])


def candidates(probes: DataFrame, features: DataFrame, widest: int | None = None) -> DataFrame:
    """The pairs of probes p and features f that share a bin of the wider one's own level, in the later of both first bins.

    Two equi-joins on chromosome, level and bin: features at their own level meet the probes that are no wider, probes at
    their own level meet the features that are narrower. So a row meets those of another width only where such rows are:
    a level that no row belongs to makes no pair. The narrower rows of a bin are dealt to parts by their places, and the
    wider ones repeated for each, so that the distinct places that meet in one key are bounded, at the widest level too.
    The levels that features have are looked up first, and probes are dealt to these only. widest: no probe is longer,
    where that is known; where no feature is narrower either, the second join is left out.
    """
    f = features.select(*[F.col(c).alias(f"f_{c}") for c in features.columns]).withColumn("own", level(F.col("f_start0"), F.col("f_end0")))
    p = probes.withColumn("own", level(F.col("start0"), F.col("end0")))
    levels = _levels(features)
    last = len(WIDTHS) - 1 if widest is None else _level_of(widest)
    top = F.lit(len(WIDTHS) - 1)

    def met(a: DataFrame, b: DataFrame) -> DataFrame:
        same = (F.col("a.chrom") == F.col("b.f_chrom")) & (F.col("a.lv") == F.col("b.lv")) & (F.col("a.bin") == F.col("b.bin")) & (F.col("a.salt") == F.col("b.salt")) & (F.col("a.bin") == F.greatest("a.first", "b.first"))
        return a.alias("a").join(b.alias("b"), same).select(*[f"a.{c}" for c in probes.columns], *[f"b.f_{c}" for c in features.columns])

    own = F.col("own")
    wide_features = met(_dealt(p, "", own, top, False, levels), _dealt(f, "f_", own, own, True))
    if not levels or last <= levels[0]:
        return wide_features
    wide_probes = met(_dealt(p.where(own > levels[0]), "", own, own, True), _dealt(f, "f_", own + 1, F.lit(last), False))
    return wide_features.union(wide_probes)


def overlaps(probes: DataFrame, features: DataFrame, widest: int | None = None) -> DataFrame:
    """Every pair of a probe and a feature of one chromosome that overlap, once: probe columns as they are, feature columns with f_ before.

    Both have chrom, start0 and end0. No pair is made twice, so that nothing has to be made distinct. Each row is dealt to
    two bins a level at most, however long it is; a crowded bin is a skewed key that Spark may split. widest: see candidates.
    """
    return candidates(probes, features, widest).where((F.col("f_start0") < F.col("end0")) & (F.col("f_end0") > F.col("start0")))


#: Parts that the rows of a bin are dealt to where hits are gathered by row, at least: rows of one place are many there.
SPREAD = 4


def hits_by_row(rows: DataFrame, features: DataFrame, widest: int, name: str = "hits") -> DataFrame:
    """The distinct rows that overlap a feature, with the set of these, as structs of the features' columns but their places.

    rows have chrom, start0 and end0, and none is longer than widest. Where neither rows nor features go beyond one level,
    each row lies in the bin of its start only, and features are repeated in all bins that such a row may start in: then
    the hits of a row are gathered where they are found, and rows are shuffled once. Else they are gathered by a shuffle.
    """
    levels, last = _levels(features), _level_of(widest)
    own = [c for c in features.columns if c not in ("chrom", "start0", "end0")]
    if len(levels) == 1 and last <= levels[0]:
        width, parts = WIDTHS[levels[0]], max(SPREAD, SALTS[levels[0]])
        bins = F.sequence(F.floor((F.col("start0") - max(widest, 1) + 1) / width).cast("long"), F.floor((F.greatest("end0", F.col("start0") + 1) - 1) / width).cast("long"))
        f = features.withColumn("bin", F.explode(bins)).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        f = f.select(*[F.col(c).alias(f"f_{c}") for c in f.columns])
        r = rows.withColumn("bin", F.floor(F.col("start0") / width).cast("long")).withColumn("salt", F.pmod(F.hash(*rows.columns), F.lit(parts)))
        same = (F.col("chrom") == F.col("f_chrom")) & (F.col("bin") == F.col("f_bin")) & (F.col("salt") == F.col("f_salt"))
        pairs, keys = r.join(f, same & (F.col("f_start0") < F.col("end0")) & (F.col("f_end0") > F.col("start0"))), r.columns
    else:
        pairs, keys = overlaps(rows, features, widest), rows.columns
    hits = F.collect_set(F.struct(*[F.col(f"f_{c}").alias(c) for c in own])).alias(name)
    return pairs.groupBy(*keys).agg(hits).select(*rows.columns, name)


def probes(points: DataFrame, tolerance: int = 0) -> DataFrame:
    """points(chrom, bp) with the span that is looked up for each."""
    return points.select("chrom", "bp", window_start(F.col("bp"), tolerance).alias("start0"), window_end(F.col("bp"), tolerance).alias("end0"))


def probe_width(tolerance: int = 0) -> int:
    """The length of the widest span that probes gives."""
    return 2 + 2 * max(tolerance, 0)


def point_hits(points: DataFrame, features: DataFrame, id_column: str, tolerance: int = 0, name: str = "hits") -> DataFrame:
    """(chrom, bp, hits): the sorted distinct ids of the features at each distinct breakpoint; breakpoints without any are left out.

    Features are found by overlap alone, also long ones that lie behind shorter ones.
    """
    found = overlaps(probes(points.select("chrom", "bp").distinct(), tolerance), features.select("chrom", "start0", "end0", F.col(id_column).alias("id")), probe_width(tolerance))
    return found.groupBy("chrom", "bp").agg(F.array_sort(F.collect_set("f_id")).alias(name))
