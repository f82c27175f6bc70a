"""Counting by each sample's own strand, expectation maximisation, medians and components against plain Python and NumPy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from genospark.operators import em, quant, sampleqc
from genospark.storage import Shelf, few

HITS = "sample string, read_id long, aln long, n long, features array<string>"
ALIGNMENTS = "sample string, read_id long, chrom string, start0 long, end0 long, strand string"


def overlapping(a, spans):
    return [s for s in spans if s[0] == a[2] and s[1] < a[4] and s[2] > a[3]]


def test_each_sample_by_its_own_call(spark):
    r = random.Random(1)
    exons = [("c", s, s + r.randrange(5, 40), f"G{i % 6}", r.choice("+-")) for i, s in enumerate(r.sample(range(400), 14))]
    tes = [("c", s, s + 30, f"T{i}", r.choice("+-")) for i, s in enumerate(r.sample(range(400), 14))]
    rows = [(f"S{i % 5}", i // 3, "c", s := r.randrange(400), s + 20, r.choice("+-")) for i in range(600)]
    calls = {"S0": "forward", "S1": "reverse", "S2": "no"}
    fits = {"forward": lambda f, a: f[4] == a[5], "reverse": lambda f, a: f[4] != a[5]}
    want = set()
    for a in set(rows):
        fit = fits.get(calls.get(a[0]), lambda f, a: True)
        genes = sorted({f[3] for f in overlapping(a, exons) if fit(f, a)})
        found = genes if len(genes) == 1 else ["__ambiguous"] if genes else sorted({f[3] for f in overlapping(a, tes) if fit(f, a)})
        if found:
            want.add((a[0], a[1], a[3], a[5], tuple(found)))
    table = lambda x, key: spark.createDataFrame(x, f"chrom string, start0 long, end0 long, {key} string, strand string")
    al = spark.createDataFrame(rows, ALIGNMENTS)
    for given in (spark.createDataFrame(list(calls.items()), "sample string, call string"), spark.createDataFrame([*calls.items(), ("S9", "forward")], "sample string, call string")):
        got = quant.assigned(al, table(exons, "gene_id"), table(tes, "te_id"), calls=given)
        places = quant.numbered(al).join(got, quant.KEY)
        assert {(x["sample"], x["read_id"], x["start0"], x["strand"], tuple(x["features"])) for x in places.collect()} == want
    assert quant.assigned(al.limit(0), table(exons, "gene_id"), table(tes, "te_id")).count() == 0


@pytest.mark.parametrize("calls", ["no", "forward", {"S0": "forward", "S1": "reverse"}])
def test_unique_reads_are_counted_before_the_lookup(spark, monkeypatch, calls):
    """The counts of hits, looked up for the places of reads with one alignment only; null samples and reads too, repeated alignments are two."""
    r = random.Random(3)
    span = lambda i, p: ("c", s := r.randrange(300), s + r.randrange(5, 40), f"{p}{i % 6}", r.choice("+-"))
    table = lambda p, key: spark.createDataFrame([span(i, p) for i in range(10)], f"chrom string, start0 long, end0 long, {key} string, strand string")
    exons, tes = table("G", "gene_id"), table("T", "te_id")
    rows = [(r.choice(["S0", "S1", "S2", None]), r.choice([None, *range(300)]), "c", s := r.randrange(300), s + 20, r.choice("+-")) for _ in range(400)]
    al = spark.createDataFrame(rows + rows[:20] + [("S0", 900, None, 5, 25, "+"), ("S0", 901, "c", 100, 120, None)], ALIGNMENTS)
    if isinstance(calls, dict):
        calls = spark.createDataFrame(list(calls.items()), "sample string, call string")
    want = sorted(map(tuple, quant.quantify_uniq(quant.assigned(al, exons, tes, calls=calls)).collect()), key=str)
    asked, found = [], quant.candidate_features
    monkeypatch.setattr(quant, "candidate_features", lambda rows, *a: (asked.append(quant.places(rows).count()), found(rows, *a))[1])
    got = quant.counted_uniq(al, exons, tes, calls=calls)
    assert sorted(map(tuple, got.collect()), key=str) == want and want
    alone = al.groupBy("sample", "read_id").agg(F.count("*").alias("n"), F.first("start0"), F.first("strand")).where("n = 1").count()
    assert asked[0] <= alone < quant.places(al).count()
    from genospark.plans import queries as Q

    monkeypatch.setattr(Q.Views, "__getattr__", lambda self, name: {"alignments": al, "exons": exons, "te": tes}[name])
    asked.clear()
    Q.q2_quantify_uniq_forward(spark, "")
    assert asked[0] <= alone


def test_only_open_samples_are_inferred(spark):
    sheet = spark.createDataFrame([(0, "A", "reverse"), (1, "B", "auto"), (2, "C", None), (3, "D", "auto")], "row long, sample string, strandedness string")
    genes = spark.createDataFrame([("c", 0, 100, "G", "+")], "chrom string, start0 long, end0 long, gene_id string, strand string")
    al = spark.createDataFrame([(s, i, "c", 10, 20, strand) for s, strand in (("A", "+"), ("B", "+"), ("C", "-")) for i in range(5)], ALIGNMENTS)
    assert {r["sample"]: r["call"] for r in quant.sample_calls(sheet, al, genes).collect()} == {"A": "reverse", "B": "forward", "C": "reverse", "D": "no"}


def reads(seed, n, features=12):
    r = random.Random(seed)
    rows = [(f"S{r.randrange(3)}", i, 1, 1, sorted(r.sample([f"f{j}" for j in range(features)], r.choice([1, 1, 2, 3, 5])))) for i in range(n)]
    return rows + [("S0", n, 1, 1, ["__ambiguous"]), ("S0", n + 1, 1, 2, ["f0"]), ("S0", n + 1, 2, 2, ["f1", "f2"])]


def em_by_definition(rows, steps, length=lambda s, f: 1.0):
    """{(sample, feature): theta} read by read, and the log likelihood by sample before the last step."""
    of = {}
    for s, i, _, _, c in rows:
        of.setdefault((s, i), set()).update(x for x in c if x != "__ambiguous")
    of = {k: v for k, v in of.items() if v}
    theta = {}
    for (s, _), c in of.items():
        for f in c:
            theta[s, f] = theta.get((s, f), 0) + 1 / len(c)
    fit = {}
    for _ in range(steps):
        new, fit = dict.fromkeys(theta, 0.0), {}
        for (s, _), c in of.items():
            x = {f: theta[s, f] / length(s, f) for f in c}
            fit[s] = fit.get(s, 0) + math.log(sum(x.values()))
            for f in c:
                new[s, f] += x[f] / sum(x.values())
        theta = new
    return theta, fit


def masses(frame):
    return {(r["sample"], r["feature"]): r["theta"] for r in frame.collect()}


@pytest.mark.parametrize("links", [1 << 18, 40])
def test_em_read_by_read(spark, monkeypatch, links):
    """Equal to the definition, however the classes are dealt to blocks."""
    monkeypatch.setattr(em, "LINKS", links)
    rows = reads(1, 400)
    size = lambda s, f: 1.0 + (int(f[1:]) * 7 + int(s[1:])) % 5
    lengths = spark.createDataFrame([(s, f"f{j}", size(s, f"f{j}")) for s in ("S0", "S1", "S2") for j in range(12)], "sample string, feature string, length double")
    hits = spark.createDataFrame(rows, HITS)
    want, _ = em_by_definition(rows, 10)
    got = masses(quant.quantify_em(hits))
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9, abs_tol=1e-12) for k in want)
    fit = em.fit_masses(hits, lengths, 4)
    want, likelihood = em_by_definition(rows, 4, size)
    got = masses(fit.theta)
    assert fit.steps == 4 and all(math.isclose(got[k], want[k], rel_tol=1e-9, abs_tol=1e-12) for k in want)
    assert all(math.isclose(r["log_likelihood"], likelihood[r["sample"]], rel_tol=1e-9) for r in fit.likelihood.collect())
    tpm = {}
    for r in fit.theta.collect():
        tpm[r["sample"]] = tpm.get(r["sample"], 0) + r["tpm"]
    assert all(math.isclose(x, 1e6, rel_tol=1e-9) for x in tpm.values())


def test_em_accelerated_reaches_the_same_in_fewer_steps(spark):
    rows = reads(2, 300, 6)
    hits = spark.createDataFrame(rows, HITS)
    want, _ = em_by_definition(rows, 3000)
    fit = em.fit_masses(hits, steps=90, tolerance=1e-6, accelerate=True)
    got = masses(fit.theta)
    assert fit.steps < 90 and fit.change <= 1e-6 and all(abs(got[k] - want[k]) < 1e-3 for k in want)
    best = em_by_definition(rows, 3000)[1]
    assert all(r["log_likelihood"] >= best[r["sample"]] - 1e-6 for r in fit.likelihood.collect())
    assert all(math.isclose(sum(v for (s, _), v in got.items() if s == name), sum(v for (s, _), v in want.items() if s == name), rel_tol=1e-9) for name in ("S0", "S1", "S2"))


def test_em_edges(spark):
    """No hits, only ambiguous ones, no steps, one class with a third of all reads."""
    empty = spark.createDataFrame([], HITS)
    assert quant.quantify_em(empty).count() == 0
    assert quant.quantify_em(spark.createDataFrame([("S", 1, 1, 1, ["__ambiguous"])], HITS)).count() == 0
    start = em.fit_masses(spark.createDataFrame([("S", 1, 1, 1, ["a", "b"])], HITS), steps=0)
    assert masses(start.theta) == {("S", "a"): 0.5, ("S", "b"): 0.5} and start.likelihood.count() == 0
    hot = [("S", i, 1, 1, ["a", "b"] if i % 3 == 0 else [f"f{i % 40}", "a"]) for i in range(3000)]
    want, _ = em_by_definition(hot, 3)
    got = masses(quant.quantify_em(spark.createDataFrame(hot, HITS), 3))
    assert all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)


def test_covered_lengths(spark):
    spans = [("a", "c1", 0, 10), ("a", "c1", 5, 20), ("a", "c1", 6, 8), ("a", "c2", 0, 5), ("b", "c1", 3, 3), ("a", "c1", 30, 31)]
    df = spark.createDataFrame(spans, "gene_id string, chrom string, start0 long, end0 long")
    assert {r["feature"]: r["length"] for r in em.covered_lengths(df, "gene_id").collect()} == {"a": 26, "b": 0}
    al = spark.createDataFrame([("S", 1, "c", 0, 10, "+"), ("S", 2, "c", 0, 20, "+")], ALIGNMENTS)
    assert {r["feature"]: r["length"] for r in em.effective_lengths(em.covered_lengths(df, "gene_id"), al).collect()} == {"a": 12.0, "b": 1.0}


@pytest.mark.parametrize("accuracy", [10_000, 40])
def test_medians_are_exact(spark, accuracy):
    """Many and few values, even and odd numbers, ties over the middle, a third of all rows equal; a coarse sketch gives the same."""
    r = np.random.default_rng(1)
    by = {"many": r.normal(size=30_001), "even": r.lognormal(size=10_000), "ties": np.repeat([1.0, 2.0, 3.0], [10, 5000, 12]), "two": np.array([1.0, 4.0]), "one": np.array([-3.0]), "split": np.repeat([0.0, 1.0], 500), "tiny": r.normal(size=7) * 1e-300}
    rows = [(k, float(x)) for k, v in by.items() for x in v]
    df = spark.createDataFrame(rows, "key string, x double").repartition(16)
    got = {row["key"]: row["median"] for row in sampleqc.medians(df, "key", "x", accuracy).collect()}
    assert got == {k: float(np.median(v)) for k, v in by.items()}
    assert sampleqc.medians(df.limit(0), "key", "x").count() == 0


def grid(spark, m):
    rows = [(f"f{i}", [(f"s{j:05}", float(x)) for j, x in enumerate(row)]) for i, row in enumerate(m)]
    df = spark.createDataFrame(rows, "feature string, v array<struct<sample:string,x:double>>")
    return df.select("feature", F.explode("v").alias("v")).select("feature", "v.sample", "v.x")


@pytest.mark.parametrize("samples,features", [(3, 40), (12, 50), (60, 30), (300, 80)])
def test_components_against_eigh(spark, samples, features):
    """More samples than vectors in the block, fewer features than samples."""
    r = np.random.default_rng(samples)
    m = r.normal(size=(features, samples)) + np.outer(r.normal(size=features), np.linspace(-1, 1, samples)) + 0.7 * np.outer(r.normal(size=features), np.arange(samples) % 3)
    z = (m - m.mean(1, keepdims=True)) / m.std(1, ddof=1, keepdims=True)
    value, vector = np.linalg.eigh(z.T @ z)
    got = sorted(sampleqc.sample_pca(grid(spark, m)).collect(), key=lambda x: x["sample"])
    for k, name in ((1, "pc1"), (2, "pc2")):
        want = vector[:, -k] * math.sqrt(value[-k])
        want *= np.sign(want[np.abs(want).argmax()])
        assert np.allclose([x[name] for x in got], want, atol=1e-6)
    assert (got[0]["pct1"], got[0]["pct2"]) == tuple(round(float(100 * v / value.sum()), 1) for v in value[[-1, -2]])


def test_components_of_nothing(spark):
    assert sampleqc.sample_pca(grid(spark, np.zeros((0, 3)))).count() == 0
    same = sampleqc.sample_pca(grid(spark, np.ones((5, 3)))).collect()
    assert len(same) == 3 and all(x["pc1"] == 0 and x["pct1"] == 0 for x in same)


def test_shelf_and_few(spark):
    with Shelf(spark) as a, Shelf(spark) as b:
        x, y = a.put(spark.range(3)), b.put(spark.range(4))
        a.__exit__()
        assert y.count() == 4
        with pytest.raises(Exception, match="(?i)not exist|not found|no such"):
            x.count()
    assert "broadcast" in few(spark.range(3))._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in few(spark.range(3), 2)._jdf.queryExecution().logical().toString().lower()
