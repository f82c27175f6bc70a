"""Expectation maximisation of the masses of features from reads that fit several of them."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import Shelf, few

#: Links (class, feature) in a block of classes, and masses in a part of them: what one task holds at a time.
LINKS, MASSES = 1 << 18, 1 << 16
#: Blocks' worth of links up to which each sample is fitted by one task (about 10 million links), and classes it works on at a time.
ALONE, CLASSES = 40, 1 << 18


@dataclass
class Fit:
    """theta (sample, feature, theta, tpm), likelihood (sample, log_likelihood) of the masses before the last step, steps taken, and the last change of a mass where it was looked at."""

    theta: DataFrame
    likelihood: DataFrame
    steps: int
    change: float | None


def read_classes(hits: DataFrame) -> DataFrame:
    """(sample, c, m): reads with the same candidate features act alike and are counted. Ambiguous ones are left out."""
    reads = hits.select("sample", "read_id", F.explode("features").alias("feature")).where("feature <> '__ambiguous'").groupBy("sample", "read_id").agg(F.array_sort(F.collect_set("feature")).alias("c"))
    return reads.groupBy("sample", "c").agg(F.count("*").alias("m"))


def stored_classes(shelf: Shelf, hits: DataFrame) -> DataFrame:
    """read_classes with class, a number."""
    return shelf.put(read_classes(hits).withColumn("class", F.monotonically_increasing_id()))


def covered_lengths(spans: DataFrame, key: str) -> DataFrame:
    """(feature, length): the bases that the spans (key, chrom, start0, end0) of a feature cover, overlapping ones once."""
    w = Window.partitionBy(key, "chrom").orderBy("start0", "end0").rowsBetween(Window.unboundedPreceding, -1)
    own = F.col("end0") - F.greatest(F.col("start0"), F.coalesce(F.max("end0").over(w), F.col("start0")))
    return spans.withColumn("own", F.greatest(own, F.lit(0))).groupBy(F.col(key).alias("feature")).agg(F.sum("own").alias("length"))


def effective_lengths(lengths: DataFrame, alignments: DataFrame) -> DataFrame:
    """(sample, feature, length): the places where a read of the sample's mean aligned length can begin in the feature, 1 at least."""
    mean = alignments.groupBy("sample").agg(F.avg(F.col("end0") - F.col("start0")).alias("mean"))
    mean = Shelf(alignments.sparkSession).put(mean, keep=True)  # a row for each sample
    return lengths.join(few(mean), how="cross").select("sample", "feature", F.greatest(F.col("length") - F.col("mean") + 1, F.lit(1.0)).alias("length"))


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(values, sizes) of a column of lists, none of them null."""
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), pa.array(values))


def _sent(left: pa.Table, right: pa.Table) -> pa.Table:
    """(block, part, x): theta / length of one part's masses, a list for each block of classes that holds some of them.

    left (part, block, at, length): the places `at` of the masses that a block holds; block -1 has all lengths. right
    (part, t): all masses.
    """
    own = left.filter(pc.equal(left.column("block"), -1))
    x = _flat(right.column("t"))[0] / _flat(own.column("length"))[0]
    left = left.filter(pc.greater_equal(left.column("block"), 0))
    at, size = _flat(left.column("at"))
    return pa.table({"block": left.column("block"), "part": left.column("part"), "x": _lists(x[at], size)})


def _stepped(x: np.ndarray, slots: np.ndarray, size: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masses after a step, of x, what each feature has (theta / length), and the log likelihood of each class. slots: the classes' features, `size` of them for each."""
    mass, fits, begin = np.zeros(len(x)), [np.zeros(0)], 0
    for k in range(0, len(size), CLASSES):  # what a step needs besides is held for these only
        own, n = size[k : k + CLASSES], m[k : k + CLASSES]
        links = slots[begin : begin + own.sum()]
        begin += len(links)
        first, of = np.cumsum(own) - own, np.repeat(np.arange(len(own)), own)
        total = np.add.reduceat(x[links], first)
        known, all_ = total > 0, np.where(total > 0, total, 1)
        share = np.where(known[of], x[links] / all_[of], (1 / own)[of])
        mass += np.bincount(links, n[of] * share, minlength=len(x))
        fits.append(n * np.log(all_))
    return mass, np.concatenate(fits)


def _expected(samples: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """(part, block, x): one block's part of a step: its classes' reads dealt over their features, and as part -1 the log likelihoods by sample.

        left (block, code, m, slots): classes; right (block, part, x): what their features have, slots counted through the parts.
        """
        right = right.take(pa.array(np.argsort(right.column("part").to_numpy())))
        x, width = _flat(right.column("x"))
        slots, size = _flat(left.column("slots"))
        m, code = left.column("m").to_numpy(), left.column("code").to_numpy()
        mass, fits = _stepped(x, slots, size, m)
        fit = np.bincount(code, fits, minlength=samples)
        part = np.append(right.column("part").to_numpy(), -1).astype(np.int32)
        block = np.full(len(part), left.column("block")[0].as_py(), np.int32)
        return pa.table({"part": part, "block": block, "x": _lists(np.concatenate([mass, fit]), np.append(width, samples))})

    return run


def _gathered(left: pa.Table, right: pa.Table) -> pa.Table:
    """(part, t): the masses of one part summed over the blocks that hold them; those of part -1 by place."""
    in_order = lambda t: t.take(pa.array(np.argsort(t.column("block").to_numpy())))
    part = right.column("part")[0].as_py() if right.num_rows else None
    if part is None:
        return pa.table({"part": pa.array([], pa.int32()), "t": pa.array([], pa.list_(pa.float64()))})
    right = in_order(right)
    x, size = _flat(right.column("x"))
    if part < 0:
        at = np.concatenate([np.arange(k) for k in size])
    else:
        at = _flat(in_order(left.filter(pc.greater_equal(left.column("block"), 0))).column("at"))[0]
    return pa.table({"part": pa.array([part], pa.int32()), "t": _lists(np.bincount(at, x), np.array([at.max() + 1]))})


class _Blocks:
    """Classes dealt to blocks, and masses to parts, once and for all; a step moves masses only, as one list for each block and part that meet, and their sums back.

    packed (block, code, m, slots) stays partitioned by block, routes (part, block, at, length) by part; samples go by
    their codes, places in names. theta (part, t) has a row for each part; a step gives one more, part -1: the log
    likelihoods before it, by code.
    """

    def __init__(self, shelf: Shelf, hits: DataFrame, lengths: DataFrame | None, classes: DataFrame | None = None):
        """classes: the stored classes of hits, where they are there already."""
        spark = hits.sparkSession
        classes = classes if classes is not None else stored_classes(shelf, hits)
        n = classes.agg(F.sum(F.size("c"))).first()[0] or 0
        self.names = sorted(r[0] for r in classes.select("sample").distinct().where("sample is not null").collect())
        codes = few(spark.createDataFrame([(s, i) for i, s in enumerate(self.names)], "sample string, code int"))
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        blocks = max(1, math.ceil(n / LINKS), min(8, n // 4096))
        masses = classes.select("sample", (F.col("m") / F.size("c")).alias("x"), F.explode("c").alias("feature")).groupBy("sample", "feature").agg(F.sum("x").alias("theta")).join(codes, "sample")
        if lengths is None:
            masses = masses.withColumn("length", F.lit(1.0))
        else:
            masses = masses.join(lengths.select("sample", "feature", F.col("length").cast("double").alias("length")), ["sample", "feature"], "left").withColumn("length", F.coalesce("length", F.lit(1.0)))
        masses = shelf.put(masses)
        many = max(1, math.ceil(masses.count() / MASSES), min(8, blocks))
        masses = masses.withColumn("part", F.pmod(F.xxhash64("sample", "feature"), F.lit(many)).cast("int"))
        self.masses = masses = shelf.put(masses.withColumn("at", F.row_number().over(Window.partitionBy("part").orderBy("sample", "feature")) - 1))
        links = classes.select(F.pmod(F.xxhash64("class"), F.lit(blocks)).cast("int").alias("block"), "class", "sample", "m", F.explode("c").alias("feature"))
        links = shelf.put(links.join(masses.select("sample", "feature", "code", "part", "at"), ["sample", "feature"]).select("block", "class", "code", "m", "part", "at"))
        routes = shelf.put(links.groupBy("part", "block").agg(F.array_sort(F.collect_set("at")).alias("at")))
        before = F.coalesce(F.sum(F.size("at")).over(Window.partitionBy("block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        slots = routes.withColumn("before", before).select("part", "block", "before", F.posexplode("at").alias("pos", "at"))
        slots = slots.select("part", "block", "at", (F.col("before") + F.col("pos")).cast("int").alias("slot"))
        packed = shelf.put(links.join(slots, ["block", "part", "at"]).groupBy("block", "class", "code", "m").agg(F.array_sort(F.collect_list("slot")).alias("slots")).drop("class"))
        listed = masses.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("at", "code", "length", "theta"))).alias("x"))
        listed = shelf.put(listed.select("part", F.col("x.code").alias("code"), F.col("x.length").alias("length"), F.col("x.theta").alias("t")))
        self.codes, self.start = listed.select("part", "code"), listed.select("part", "t")
        none = F.lit(None).cast("array<double>")
        routes = routes.select("part", "block", "at", none.alias("length")).union(listed.select("part", F.lit(-1), F.col("code"), "length"))
        self.packed = packed.repartition(parts, "block").persist()
        self.routes = routes.repartition(parts, "part").persist()

    def step(self, theta: DataFrame) -> DataFrame:
        """(part, t) after one step."""
        sent = self.routes.groupBy("part").cogroup(theta.groupBy("part")).applyInArrow(_sent, "block int, part int, x array<double>")
        back = self.packed.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(_expected(len(self.names)), "part int, block int, x array<double>")
        return self.routes.groupBy("part").cogroup(back.groupBy("part")).applyInArrow(_gathered, "part int, t array<double>")

    def together(self, **thetas: DataFrame) -> DataFrame:
        """(part, code, ...): the lists of several thetas beside each other, and their samples' codes."""
        out = self.codes
        for name, theta in thetas.items():
            out = out.join(_masses(theta).withColumnRenamed("t", name), "part")
        return out

    def close(self) -> None:
        self.packed.unpersist()
        self.routes.unpersist()


def _masses(stepped: DataFrame) -> DataFrame:
    return stepped.where("part >= 0")


def _fits(stepped: DataFrame, samples: int) -> np.ndarray:
    """The log likelihoods by sample that a step found."""
    found = stepped.where("part = -1").first()
    return np.array(found["t"]) if found else np.zeros(samples)


def _change(both: DataFrame) -> float:
    return float(both.agg(F.max(F.array_max(F.zip_with("new", "old", lambda a, b: F.abs(a - b))))).first()[0] or 0.0)


def _each(rows: DataFrame, f: Callable[..., pa.RecordBatch], schema: str) -> DataFrame:
    """f of each row's part, codes and lists of masses, as arrays."""
    names = rows.columns[2:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                lists = (b.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("code", *names))
                yield f(b.column("part")[i].as_py(), *lists)

    return rows.mapInArrow(run, schema)


def _part(part: int, t: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), _lists(t, np.array([len(t)]))], ["part", "t"])


def _leap(rows: DataFrame, samples: int) -> DataFrame:
    """(part, t): masses extrapolated by squares from three in a row, rows (part, code, t0, t1, t2), by sample; those after the second step where a mass would not stay positive. The driver holds two numbers for each sample."""

    def norms(part, code, t0, t1, t2):
        r, v = t1 - t0, t2 - 2 * t1 + t0
        sums = [np.bincount(code, x * x, samples) for x in (r, v)]
        return pa.RecordBatch.from_arrays([pa.array(np.arange(samples), pa.int32()), *map(pa.array, sums)], ["code", "rr", "vv"])

    found = _each(rows, norms, "code int, rr double, vv double").groupBy("code").agg(F.sqrt(F.sum("rr")).alias("rr"), F.sqrt(F.sum("vv")).alias("vv")).collect()
    far = np.ones(samples)
    for r in found:
        far[r["code"]] = max(r["rr"] / r["vv"], 1.0) if r["vv"] > 0 else 1.0

    def place(code, t0, t1, t2):
        return t0 + 2 * far[code] * (t1 - t0) + far[code] ** 2 * (t2 - 2 * t1 + t0)

    def below(part, code, t0, t1, t2):
        x = place(code, t0, t1, t2)
        return pa.RecordBatch.from_arrays([pa.array(np.unique(code[(x < 0) | ((x == 0) & (t2 > 0))]), pa.int32())], ["code"])

    bad = np.zeros(samples, bool)
    bad[[r["code"] for r in _each(rows, below, "code int").distinct().collect()]] = True
    return _each(rows, lambda part, code, t0, t1, t2: _part(part, np.where(bad[code], t2, place(code, t0, t1, t2))), "part int, t array<double>")


def _fit_one(steps: int, tolerance: float | None, accelerate: bool, least: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """One sample's fit: (sample, feature, theta, tpm, fit, taken, change), a row for each feature, and one without a feature that has the last three.

    As fit_masses does it for all samples; with a tolerance it goes on for `least` steps, whatever the change.
    """

    def run(classes: pa.Table, lengths: pa.Table) -> pa.Table:
        if not classes.num_rows:
            return pa.table({"sample": [], "feature": [], "theta": [], "tpm": [], "fit": [], "taken": [], "change": []}, schema=_FITTED)
        lists = classes.column("c").combine_chunks()
        names, size, m = lists.flatten().dictionary_encode(), lists.value_lengths().to_numpy(zero_copy_only=False), classes.column("m").to_numpy()
        slots, names = names.indices.to_numpy(zero_copy_only=False), names.dictionary
        at = pc.index_in(names, lengths.column("feature").combine_chunks()).to_numpy(zero_copy_only=False) if lengths.num_rows else np.full(len(names), np.nan)
        length, found = np.ones(len(names)), ~np.isnan(at)
        if found.any():
            known = lengths.column("length").to_numpy(zero_copy_only=False)[at[found].astype(int)]
            length[found] = np.where(np.isnan(known), 1.0, known)
        step = lambda t: (lambda mass, fits: (mass, fits.sum()))(*_stepped(t / length, slots, size, m))
        theta = np.bincount(slots, np.repeat(m / size, size), minlength=len(names))
        taken, change, fit = 0, None, None
        while taken < steps:
            before = theta
            theta, fit = step(before)
            taken += 1
            if accelerate and taken + 2 <= steps:
                one = theta
                two, fit = step(one)
                r, v = one - before, two - 2 * one + before
                rr, vv = math.sqrt((r * r).sum()), math.sqrt((v * v).sum())
                far = max(rr / vv, 1.0) if vv > 0 else 1.0
                leap = before + 2 * far * r + far**2 * v
                three, leapt = step(two if ((leap < 0) | ((leap == 0) & (two > 0))).any() else leap)
                theta, fit, taken = (three, leapt, taken + 2) if leapt >= fit else (two, fit, taken + 2)
            if tolerance is not None:
                change = float(np.abs(theta - before).max())
                if change <= tolerance and taken >= least:
                    break
        rate = theta / length
        tpm = 1e6 * rate / rate.sum() if rate.sum() > 0 else np.zeros(len(rate))
        n, sample = len(names), classes.column("sample")[0].as_py()
        none = lambda value: pa.array([None] * n + [value])
        columns = {"sample": pa.array([sample] * (n + 1)), "feature": pa.array([*names.to_pylist(), None]), "theta": pa.array(np.append(theta, 0.0)), "tpm": pa.array(np.append(tpm, 0.0))}
        return pa.table(columns | {"fit": none(fit), "taken": none(taken), "change": none(change)}).cast(_FITTED)

    return run


_FITTED = pa.schema([("sample", pa.string()), ("feature", pa.string()), ("theta", pa.float64()), ("tpm", pa.float64()), ("fit", pa.float64()), ("taken", pa.int32()), ("change", pa.float64())])


def _fit_alone(shelf: Shelf, classes: DataFrame, lengths: DataFrame | None, steps: int, tolerance: float | None, accelerate: bool) -> Fit:
    """fit_masses where each sample's classes are few enough for one task: samples have nothing in common but when they end.

    With a tolerance, samples are fitted until each one's own masses rest, and then anew for as many steps at least as the
    longest took, until all end together: the first step at which no mass of any sample moves, as by steps of all samples.
    """
    spark = classes.sparkSession
    if lengths is None:
        lengths = spark.createDataFrame([], "sample string, feature string, length double")
    left = classes.where("sample is not null").select("sample", "c", "m")
    right = shelf.put(lengths.groupBy("sample", "feature").agg(F.min(F.col("length").cast("double")).alias("length")))
    schema, least = "sample string, feature string, theta double, tpm double, fit double, taken int, change double", 0
    while True:
        rows = left.groupBy("sample").cogroup(right.groupBy("sample")).applyInArrow(_fit_one(steps, tolerance, accelerate, least), schema)
        rows = shelf.put(rows, keep=True)
        ends = rows.where("taken is not null").select("sample", "fit", "taken", "change").collect()
        longest = max((r["taken"] for r in ends), default=0)
        if tolerance is None or all(r["taken"] == longest for r in ends):
            break
        least = longest
    fits = spark.createDataFrame([(r["sample"], r["fit"]) for r in sorted(ends, key=lambda r: r["sample"]) if r["fit"] is not None], "sample string, log_likelihood double")
    change = max((r["change"] for r in ends if r["change"] is not None), default=None)
    return Fit(rows.where("taken is null").select("sample", "feature", "theta", "tpm"), fits, longest, change)


def fit_masses(hits: DataFrame, lengths: DataFrame | None = None, steps: int = 10, tolerance: float | None = None, accelerate: bool = False) -> Fit:
    """Masses of the features by expectation maximisation, at most `steps` steps.

    hits (sample, read_id, features) as quant.assigned gives them; lengths (sample, feature, length): effective lengths, 1
    where there is none. A read goes to its features in proportion to theta / length, evenly where that is 0 for all. It
    begins with reads dealt evenly. With a tolerance it ends when no mass changes by more (in reads); the change is looked
    at after each step, or each cycle of three when accelerated. Accelerated: two steps, a leap along them (squared
    extrapolation, a length for each sample), and a step from there, taken back for samples whose likelihood it lowers, so
    that the likelihood never falls. tpm: theta / length in parts of a million of the sample.

    Where no sample has more than ALONE * LINKS links, a task fits a sample with all its steps, and nothing is moved between
    steps; beyond that classes and masses are dealt to blocks and parts, and a step is a job.
    """
    spark = hits.sparkSession
    with Shelf(spark) as shelf:
        classes = stored_classes(shelf, hits)
        if (classes.groupBy("sample").agg(F.sum(F.size("c")).alias("n")).agg(F.max("n")).first()[0] or 0) <= ALONE * LINKS:
            return _fit_alone(shelf, classes, lengths, steps, tolerance, accelerate)
        blocks = _Blocks(shelf, hits, lengths, classes)
        samples = len(blocks.names)
        try:
            theta, taken, change, fit = blocks.start, 0, None, None
            while taken < steps and samples:
                before = theta
                one = shelf.put(blocks.step(theta))
                theta, fit, taken = _masses(one), _fits(one, samples), taken + 1
                if accelerate and taken + 2 <= steps:
                    two = shelf.put(blocks.step(theta))
                    three = shelf.put(blocks.step(shelf.put(_leap(shelf.put(blocks.together(t0=before, t1=one, t2=two)), samples))))
                    # the likelihood of the leap against that of the first step: the second step is at least as good as that
                    fit, leapt = _fits(two, samples), _fits(three, samples)
                    better = leapt >= fit
                    fit, taken = np.where(better, leapt, fit), taken + 2
                    theta = shelf.put(_each(blocks.together(t2=two, t3=three), lambda part, code, t2, t3, better=better: _part(part, np.where(better[code], t3, t2)), "part int, t array<double>"))
                if tolerance is not None:
                    change = _change(blocks.together(new=theta, old=before))
                    if change <= tolerance:
                        break
            rate = theta.select("part", F.posexplode("t").alias("at", "theta")).join(blocks.masses.drop("theta"), ["part", "at"])
            rate = shelf.put(rate.select("sample", "feature", "theta", (F.col("theta") / F.col("length")).alias("rate")))
            whole = few(shelf.put(rate.groupBy("sample").agg(F.sum("rate").alias("all"))))
            tpm = F.when(F.col("all") > 0, 1e6 * F.col("rate") / F.col("all")).otherwise(0.0)
            out = shelf.put(rate.join(whole, "sample").select("sample", "feature", "theta", tpm.alias("tpm")), keep=True)
            fits = spark.createDataFrame([] if fit is None else list(zip(blocks.names, fit.tolist())), "sample string, fit double")
        finally:
            blocks.close()
    return Fit(out, fits.withColumnRenamed("fit", "log_likelihood"), taken, change)
