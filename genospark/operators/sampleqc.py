"""Sample quality control on counts (feature, sample, n): filters, transforms, distances, principal components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import log2p1
from ..storage import Shelf, few
from .cohort import dense_grid

FEATURES = 1024
#: Vectors that subspace iteration carries; numbers that a task lays out at a time.
BLOCK, CELLS = 12, 1 << 20


def presence_filter(counts: DataFrame, min_samples: int = 2, min_total: int = 5) -> DataFrame:
    """The rows of features that enough samples have, with enough counts in all."""
    keep = counts.groupBy("feature", "sample").agg(F.sum("n").alias("n")).groupBy("feature").agg(F.count_if(F.col("n") > 0).alias("present"), F.sum("n").alias("total"))
    return counts.join(keep.where((F.col("present") >= min_samples) & (F.col("total") >= min_total)).select("feature"), "feature", "left_semi")


def log2_transform(counts: DataFrame) -> DataFrame:
    """(feature, sample, x): log2(n + 1) over the full grid."""
    return dense_grid(counts).select("feature", "sample", log2p1(F.col("n")).alias("x"))


def zero_variance_filter(values: DataFrame) -> DataFrame:
    """values(feature, sample, x) without features that are constant or hold anything but finite numbers."""
    odd = F.col("x").isNull() | F.isnan("x") | (F.abs("x") == float("inf"))
    finite = F.when(~odd, F.col("x"))
    keep = values.groupBy("feature").agg(F.count_if(odd).alias("odd"), F.max(finite).alias("hi"), F.min(finite).alias("lo"))
    return values.join(keep.where("odd = 0 and hi > lo").select("feature"), "feature", "left_semi")


def min_events_gate(values: DataFrame, min_events: int = 10) -> DataFrame:
    """values, or no rows at all where there are fewer than two samples or too few features."""
    size = values.agg(F.count_distinct("sample").alias("s"), F.count_distinct("feature").alias("f")).where((F.col("s") >= 2) & (F.col("f") >= max(min_events, 2))).select(F.lit(1).alias("ok"))
    return values.join(F.broadcast(size), how="cross").drop("ok")


def _squared_differences(values: DataFrame) -> DataFrame:
    """(a, b, s): for all ordered pairs of samples, s, the sum of squared differences over the features that both have.

    One shuffle by feature gives each feature's row. A task adds up its features in blocks, as matrices of FEATURES rows at
    most, and gives one row for each pair of samples, so that rows don't grow with the features. It holds two numbers for
    each pair: samples are thousands at most. Null values count as missing.
    """
    rows = values.where(F.col("x").isNotNull()).groupBy("feature").agg(F.collect_list(F.struct("sample", "x")).alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place: dict[str, int] = {}
        total = shared = np.zeros((0, 0))
        for b in batches:
            for at in range(0, b.num_rows, FEATURES):
                v = b.column("v").slice(at, FEATURES)
                flat, row = v.flatten(), np.repeat(np.arange(len(v)), v.value_lengths().to_numpy(zero_copy_only=False))
                names = flat.field("sample").dictionary_encode()
                own = np.array([place.setdefault(n, len(place)) for n in names.dictionary.to_pylist()], int)
                column, x = own[names.indices.to_numpy()], flat.field("x").to_numpy()
                if len(place) > len(total):
                    grow = len(place) - len(total)
                    total, shared = np.pad(total, (0, grow)), np.pad(shared, (0, grow))
                dense, there = np.zeros((len(v), len(place))), np.zeros((len(v), len(place)))
                np.add.at(dense, (row, column), x)
                there[row, column] = 1
                shared += there.T @ there
                for k in range(len(place)):
                    # differences before squares: equal samples are at distance 0 exactly
                    both = there[:, k] > 0
                    total[k] += ((dense[both, k, None] - dense[both]) ** 2 * there[both]).sum(0)
        names = pa.array(place, pa.string())
        for k, name in enumerate(place):
            met = pa.array(shared[k] > 0)
            b = names.filter(met)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(b), pa.string()), b, pa.array(total[k]).filter(met)], ["a", "b", "s"])

    parts = rows.select("v").mapInArrow(run, "a string, b string, s double")
    return parts.groupBy("a", "b").agg(F.sum("s").alias("s"))


def sample_distances(values: DataFrame) -> DataFrame:
    """(sample_a, sample_b, distance): Euclidean, for all ordered pairs with a feature in common, the diagonal too."""
    return _squared_differences(values).select(F.col("a").alias("sample_a"), F.col("b").alias("sample_b"), F.sqrt("s").alias("distance"))


def _sample_numbers(values: DataFrame) -> list[str]:
    """The samples' names in order: the driver's only table of the names, thousands at most."""
    return sorted(r["sample"] for r in values.select("sample").distinct().collect())


def _feature_rows(values: DataFrame, names: list[str]) -> DataFrame:
    """(k, x): a row for each feature, its centred and scaled values x of the samples with numbers k in names. A missing value counts as 0."""
    place = values.sparkSession.createDataFrame([(n, k) for k, n in enumerate(names)], "sample string, k int")
    w = Window.partitionBy("feature")
    z = F.coalesce(F.try_divide(F.col("x") - F.avg("x").over(w), F.stddev_samp("x").over(w)), F.lit(0.0))
    at = values.withColumn("x", z).join(few(place), "sample")
    return at.groupBy("feature").agg(F.array_sort(F.collect_list(F.struct("k", "x"))).alias("v")).select(F.col("v.k").alias("k"), F.col("v.x").alias("x"))


def _times(rows: DataFrame, block: np.ndarray) -> tuple[np.ndarray, float]:
    """(G block, trace of G) for G, the samples x samples matrix of inner products of the features' rows, which is nowhere made.

    A task multiplies its rows with the block, some MB of them at a time, and gives one row for each sample.
    """
    n, width = block.shape
    sent = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y, squares, chunk = np.zeros((n, width)), 0.0, max(1, CELLS // n)
        for b in batches:
            for at in range(0, b.num_rows, chunk):
                k, x = (b.column(c).slice(at, chunk) for c in ("k", "x"))
                dense = np.zeros((len(k), n))
                dense[np.repeat(np.arange(len(k)), k.value_lengths().to_numpy(zero_copy_only=False)), k.flatten().to_numpy()] = x.flatten().to_numpy()
                y += dense.T @ (dense @ sent.value)
                squares += float((dense * dense).sum())
        columns = [pa.array(np.arange(n + 1), pa.int32()), *(pa.array(np.append(y[:, j], squares)) for j in range(width))]
        yield pa.RecordBatch.from_arrays(columns, ["k", *(f"y{j}" for j in range(width))])

    schema = "k int, " + ", ".join(f"y{j} double" for j in range(width))
    try:
        found = rows.mapInArrow(run, schema).groupBy("k").agg(*[F.sum(f"y{j}").alias(f"y{j}") for j in range(width)]).toPandas().sort_values("k").to_numpy()
    finally:
        sent.destroy()
    return (found[:-1, 1:], float(found[-1, 1])) if len(found) else (np.zeros((n, width)), 0.0)


def sample_pca(values: DataFrame, exact: float = 1e-10, most: int = 200) -> DataFrame:
    """(sample, pc1, pc2, pct1, pct2): scores of the first two components of the features, centred and scaled to variance 1.

    Block subspace iteration from random vectors: each round is one pass over the features' rows, stored once, and the
    driver holds BLOCK numbers for each sample, whatever their number; the samples x samples matrix is never made. It ends
    when the first two components' residuals are `exact` of the largest value, or what is left of them is 0; after `most`
    rounds without that it raises. The sign is such that the largest score by size is positive. Fewer than two samples: no
    rows.
    """
    spark = values.sparkSession
    names = _sample_numbers(values)
    schema = "sample string, pc1 double, pc2 double, pct1 double, pct2 double"
    if len(names) < 2:
        return spark.createDataFrame([], schema)
    with Shelf(spark) as shelf:
        rows = shelf.put(_feature_rows(values, names))
        q = np.linalg.qr(np.random.default_rng(1).standard_normal((len(names), min(BLOCK, len(names)))))[0]
        for _ in range(most):
            y, trace = _times(rows, q)
            small = q.T @ y
            value, turn = np.linalg.eigh((small + small.T) / 2)
            value, turn = value[::-1], turn[:, ::-1]
            residual = np.linalg.norm(y @ turn[:, :2] - (q @ turn[:, :2]) * value[:2], axis=0).max()
            if residual <= exact * max(value[0], 0.0):
                break
            q = np.linalg.qr(y)[0]
        else:
            raise ArithmeticError(f"no components after {most} rounds: residual {residual:.3g} of {value[0]:.3g}")
    vector, value = q @ turn, np.maximum(value, 0)
    scores = vector[:, :2] * np.sqrt(value[:2])
    for k in range(2):
        if scores[np.abs(scores[:, k]).argmax(), k] < 0:
            scores[:, k] *= -1
    share = [round(float(100 * v / trace), 1) if trace else 0.0 for v in value[:2]]
    return spark.createDataFrame([(n, float(scores[k, 0]), float(scores[k, 1]), *share) for k, n in enumerate(names)], schema)


def condition_lookup(samples: DataFrame, sheet: DataFrame) -> DataFrame:
    """samples(sample) with condition: that of the sheet's first row of the sample, `all` where it is blank or missing."""
    first = sheet.groupBy("sample").agg(F.min_by(F.struct(F.nullif(F.trim("condition"), F.lit("")).alias("c")), "row").alias("f")).select("sample", F.col("f.c").alias("c"))
    return samples.join(first, "sample", "left").withColumn("condition", F.coalesce("c", F.lit("all"))).drop("c")


def medians(values: DataFrame, key: str, x: str, accuracy: int = 10_000, shelf: Shelf | None = None) -> DataFrame:
    """(key, median): the exact median of x (no null) by key, the mean of both middle values where their number is even.

    Two passes over values, which should be stored. The first takes, by a sketch of bounded size, two values that have the
    median between them, no further than a few parts of `accuracy` from it. The second counts what is below them, and each
    distinct value between them; only those counts are put in order. No buffer holds the values of a key. With a shelf the
    bounds are stored there, so that the first pass runs once.
    """
    near = 2.0 / accuracy
    sketch = lambda q: F.percentile_approx(x, q, accuracy)
    bounds = values.groupBy(key).agg(sketch([0.5 - near, 0.5 + near]).alias("between"), F.count("*").alias("size"))
    bounds = shelf.put(bounds) if shelf else bounds
    met = values.join(few(bounds), key).withColumn("side", F.when(F.col(x) < F.col("between")[0], -1).when(F.col(x) > F.col("between")[1], 1).otherwise(0))
    # one row for each distinct value between, and one for all below
    counted = met.where("side <= 0").groupBy(key, "size", F.when(F.col("side") == 0, F.col(x)).alias("value")).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(key).orderBy(F.col("value").asc_nulls_first()))
    rank = lambda up: F.min(F.when(F.col("value").isNotNull() & (F.col("upto") > F.floor((F.col("size") - (0 if up else 1)) / 2)), F.col("value")))
    return counted.withColumn("upto", upto).groupBy(key).agg(((rank(False) + rank(True)) / 2).alias("median"))


def size_factors(counts: DataFrame) -> DataFrame:
    """(sample, size_factor): median of the ratios to the features' geometric means, over features that every sample has."""
    grid = dense_grid(counts)
    w = Window.partitionBy("feature")
    logs = grid.withColumn("least", F.min("n").over(w)).where("least > 0").select("sample", (F.ln("n") - F.avg(F.ln("n")).over(w)).alias("r"))
    with Shelf(counts.sparkSession) as shelf:
        found = shelf.put(medians(shelf.put(logs), "sample", "r", shelf=shelf), keep=True)
    return found.select("sample", F.exp("median").alias("size_factor"))


def normalised(counts: DataFrame, factors: DataFrame | None = None) -> DataFrame:
    """(feature, sample, n, q, size_factor) over the full grid: counts over size factors, which are made here unless they are given."""
    return dense_grid(counts).join(few(size_factors(counts) if factors is None else factors), "sample").withColumn("q", F.col("n") / F.col("size_factor"))


def dispersions(counts: DataFrame, factors: DataFrame | None = None) -> DataFrame:
    """(feature, mu, alpha): mean of the normalised counts, and the dispersion by moments, not below 0."""
    s = normalised(counts, factors).groupBy("feature").agg(F.avg("q").alias("mu"), F.var_samp("q").alias("v"), F.avg(1 / F.col("size_factor")).alias("xi"))
    alpha = F.when(F.col("mu") > 0, F.greatest(F.lit(0.0), (F.coalesce("v", F.lit(0.0)) - F.col("xi") * F.col("mu")) / (F.col("mu") ** 2))).otherwise(0.0)
    return s.select("feature", "mu", alpha.alias("alpha"))


def dispersion_trend(counts: DataFrame, factors: DataFrame | None = None) -> tuple[float, float] | None:
    """(a0, a1) of alpha = a1 / mu + a0, a gamma regression with identity link; None where it can't be fitted."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression

    points = dispersions(counts, factors).where("alpha > 1e-8 and mu > 0").withColumn("inv", 1 / F.col("mu"))
    if points.limit(3).count() < 3:
        return None
    try:
        m = GeneralizedLinearRegression(family="gamma", link="identity", labelCol="alpha", featuresCol="x", maxIter=50).fit(VectorAssembler(inputCols=["inv"], outputCol="x").transform(points))
    except Exception as e:  # the solver's failures come as Java exceptions of several kinds
        if "analysis" in type(e).__name__.lower():
            raise
        return None
    a0, a1 = float(m.intercept), float(m.coefficients[0])
    return (a0, a1) if np.isfinite([a0, a1]).all() and a0 > 0 and a1 >= 0 else None


def vst_transform(counts: DataFrame) -> DataFrame:
    """(feature, sample, x): the variance-stabilising transform of normalised counts; log2(n + 1) where there are fewer than two samples or no trend."""
    if counts.select("sample").distinct().limit(2).count() < 2:
        return log2_transform(counts)
    factors = size_factors(counts)
    if (trend := dispersion_trend(counts, factors)) is None:
        return log2_transform(counts)
    a0, a1 = trend
    q = F.col("q")
    x = F.log2((1 + a1 + 2 * a0 * q + 2 * F.sqrt(a0 * q * (1 + a1 + a0 * q))) / (4 * a0))
    return normalised(counts, factors).select("feature", "sample", x.alias("x"))


def qc_transform(counts: DataFrame, method: str = "vst", min_samples: int = 2, min_total: int = 5) -> DataFrame:
    kept = presence_filter(counts, min_samples, min_total)
    return vst_transform(kept) if method == "vst" else log2_transform(kept)
