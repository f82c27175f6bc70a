"""Hand-written edge rows."""

import math

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from genospark.functions import expressions as X
from genospark.operators import chimera, cohort, counts, design, diff, jobs, quant, reads, sampleqc, tracks

J = "sample string, line_no long, donor_chrom string, donor_bp long, donor_strand string, acceptor_chrom string, acceptor_bp long, acceptor_strand string, junction_type string, repeat_flag string"
EXONS = "chrom string, start0 long, end0 long, gene_id string, strand string"
TES = "chrom string, start0 long, end0 long, te_id string, strand string, te_family string, te_class string"


def col(spark, values, expression, kind="string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"x {kind}").select(expression(F.col("x"))).collect()]


def test_canonical(spark):
    assert col(spark, ["-1", "0", "1", "6", "7", "x", None], X.canonical) == ["no", "no", "yes", "yes", "no", "no", "no"]


def test_feature_parts(spark):
    keys = ["a", "a:b", "a:b:LINE", "a:b:LINE/L1", "a::LINE", "a:"]
    df = spark.createDataFrame([(k, "s", 1) for k in keys], "feature string, sample string, n long")
    classes = lambda level: [(r["kind"], r["te_class"]) for r in counts.classified_features(df, level).collect()]
    assert classes("subfamily") == [("gene", None), ("TE", "unknown"), ("TE", "LINE"), ("TE", "unknown"), ("gene", None), ("gene", None)]
    assert classes("locus")[1] == ("gene", None)


def test_as_float_and_calls(spark):
    assert col(spark, ["NA", "1.5", None, "x", "NaN"], X.as_float) == [0.0, 1.5, 0.0, 0.0, 0.0]
    df = spark.createDataFrame([(0.6, 0.4), (0.6, 0.6), (0.5, 0.5), (0.0, 0.7)], "f double, r double")
    assert [r[0] for r in df.select(X.strandedness_call(F.col("f"), F.col("r"))).collect()] == ["forward", "forward", "no", "reverse"]
    assert col(spark, [" Unstranded ", "REVERSE", "maybe"], X.normal_strandedness) == ["no", "reverse", None]


def test_chimera_type_abutting_is_inside(spark):
    df = spark.createDataFrame([("+", 100, 200, 50, 100), ("+", 100, 200, 50, 99), ("-", 100, 200, 50, 99), (".", 100, 200, 50, 99)], "g string, gs long, ge long, ts long, te long")
    assert [r[0] for r in df.select(X.chimera_type(*[F.col(c) for c in ("g", "gs", "ge", "ts", "te")])).collect()] == ["te_exonized", "te_initiated", "te_terminated", "."]


def annotated(spark, rows, **options):
    exons = spark.createDataFrame([("c1", 100, 200, "G1", "+"), ("c1", 150, 260, "G2", "-"), ("c2", 100, 200, "G3", "+")], EXONS)
    tes = spark.createDataFrame([("c1", 180, 300, "T1", "+", "L1", "LINE"), ("c2", 500, 600, "T2", "+", "Alu", "SINE")], TES)
    genes = spark.createDataFrame([("c1", 100, 200, "G1", "+"), ("c1", 150, 260, "G2", "-"), ("c2", 100, 200, "G3", "+")], EXONS)
    return chimera.annotate_junctions(spark.createDataFrame(rows, J), exons, genes, tes, **options)


def test_annotation(spark):
    rows = [
        ("S", 2, "c1", 190, "+", "c1", 195, "+", "1", "0"),
        ("S", 1, "c1", 190, "+", "c1", 195, "+", "0", "2"),
        ("S", 3, "c9", 1, "+", "c2", 550, "+", "x", "0"),
        ("S", 4, "c2", 150, "-", "c1", 290, "-", "3", "0"),
    ]
    got = {r["donor_breakpoint"]: r for r in annotated(spark, rows, strandedness="reverse").collect()}
    both = got[190]
    assert (both["direction"], both["reads"], both["junction_type"], both["repeat_flag"], both["canonical"]) == ("gene_to_te", 2, "0", "2", "no")
    assert (both["gene_id"], both["te_id"], both["antisense_flag"], both["transcript_strand"], both["gene_strand_match"]) == ("G1", "T1", "yes", "-", "no")
    assert both["donor_hits"] == "gene:G1,G2|te:T1"
    assert (got[1]["direction"], got[1]["gene_id"], got[1]["gene_strand_match"]) == ("other", ".", "NA")
    assert got[150]["chimera_type"] == "te_exonized"
    assert {r["donor_breakpoint"] for r in annotated(spark, rows, require_canonical=True).collect()} == {150}
    assert {r["chimera_type"] for r in annotated(spark, rows, cis_only=True).where("donor_breakpoint = 150").collect()} == {"."}
    assert annotated(spark, []).count() == 0


def test_totals_agree(spark):
    from compare import DATA

    from genospark.plans.queries import Views

    v = Views(spark, f"{DATA}/sf0.001")
    events = v.annotated().cache()
    assert events.agg(F.sum("reads")).first()[0] == v.junctions.count()
    assert cohort.direction_composition(events).agg(F.sum("n")).first()[0] == events.count()
    long = cohort.counts_long(events)
    wide = cohort.wide_matrix(long, [f"S{i}" for i in range(6)])
    assert sum(wide.agg(*[F.sum(f"S{i}") for i in range(6)]).first()) == long.agg(F.sum("n")).first()[0]


def test_catalog_takes_the_first_sample_by_name(spark):
    rows = [("S2", 1, "c1", 190, "+", "c1", 195, "+", "1", "0"), ("S0", 1, "c1", 190, "+", "c1", 195, "+", "4", "7")]
    r = cohort.event_catalog(annotated(spark, rows)).first()
    assert (r["first_sample"], r["junction_type"], r["repeat_flag"], r["n_samples"], r["total_reads"]) == ("S0", "4", "7", 2, 2)


def test_gene_on_two_chromosomes_takes_the_last(spark):
    attrs = {"gene_id": "G"}
    records = spark.createDataFrame([(1, "c1", "gene", 10, 20, "+", attrs), (2, "c2", "exon", 5, 90, "-", attrs)], "line_no long, chrom string, feature string, start long, end long, strand string, attrs map<string,string>")
    assert tracks.gene_spans(records).first() == Row(chrom="c2", start0=4, end0=90, gene_id="G", strand="+")
    assert tracks.exon_track(records).count() == 1


def test_zero_sums_give_zero_per_cent(spark):
    df = spark.createDataFrame([("s", "a", 0), ("s", "x:L1:LINE", 0)], "sample string, feature string, n long")
    assert {r["pct"] for r in counts.assignment_summary(df).collect()} == {0.0}
    assert counts.class_summary(df).count() == 6


def grid(spark, m):
    return spark.createDataFrame([(f"f{i}", f"s{j}", float(x)) for i, row in enumerate(m) for j, x in enumerate(row)], "feature string, sample string, x double")


def test_pca_and_distances_against_numpy(spark):
    m = np.random.default_rng(1).normal(size=(40, 5))
    z = (m - m.mean(1, keepdims=True)) / m.std(1, ddof=1, keepdims=True)
    u, s, _ = np.linalg.svd(z.T, full_matrices=False)
    got = {r["sample"]: r for r in sampleqc.sample_pca(grid(spark, m)).collect()}
    for k, name in enumerate(("pc1", "pc2")):
        want = u[:, k] * s[k]
        want *= np.sign(want[np.abs(want).argmax()])
        assert np.allclose([got[f"s{j}"][name] for j in range(5)], want, atol=1e-8)
    assert got["s0"]["pct1"] == round(100 * s[0] ** 2 / (s**2).sum(), 1)
    d = {(r["sample_a"], r["sample_b"]): r["distance"] for r in sampleqc.sample_distances(grid(spark, m)).collect()}
    assert all(abs(d[f"s{i}", f"s{j}"] - np.linalg.norm(m[:, i] - m[:, j])) < 1e-9 and d[f"s{i}", f"s{j}"] == d[f"s{j}", f"s{i}"] for i in range(5) for j in range(5))
    assert sampleqc.sample_pca(grid(spark, m[:, :1])).count() == 0


def test_filters_and_gate(spark):
    m = [[1, 1], [1, 2], [float("nan"), 1], [float("inf"), 2]]
    assert {r["feature"] for r in sampleqc.zero_variance_filter(grid(spark, m)).collect()} == {"f1"}
    nine = grid(spark, np.arange(18).reshape(9, 2))
    assert sampleqc.min_events_gate(nine).count() == 0 and sampleqc.min_events_gate(nine, 9).count() == 18
    assert sampleqc.min_events_gate(grid(spark, np.ones((20, 1)))).count() == 0
    c = spark.createDataFrame([("a", "s", 9), ("b", "s", 2), ("b", "t", 2), ("c", "s", 2), ("c", "t", 3)], "feature string, sample string, n long")
    assert {r["feature"] for r in sampleqc.presence_filter(c).collect()} == {"c"}


def test_vst_matches_its_formula_and_falls_back(spark):
    from compare import DATA

    from genospark.plans.queries import Views

    c = Views(spark, f"{DATA}/sf0.01").counts()
    a0, a1 = sampleqc.dispersion_trend(c)
    x = {(r["feature"], r["sample"]): r["x"] for r in sampleqc.vst_transform(c).collect()}
    for r in sampleqc.normalised(c).limit(50).collect():
        q = r["q"]
        assert math.isclose(x[r["feature"], r["sample"]], math.log2((1 + a1 + 2 * a0 * q + 2 * math.sqrt(a0 * q * (1 + a1 + a0 * q))) / (4 * a0)), rel_tol=1e-9)
    one = spark.createDataFrame([("a", "s", 3)], "feature string, sample string, n long")
    assert sampleqc.vst_transform(one).first()["x"] == 2.0


def test_p_values_and_adjustment(spark):
    z = spark.createDataFrame([(0.0,), (1.959963984540054,), (-3.0,)], "z double").select(diff.two_sided_p("z")).collect()
    assert np.allclose([r[0] for r in z], [1.0, 0.05, math.erfc(3 / math.sqrt(2))])
    p = [0.01, 0.04, 0.03, 0.2]
    df = spark.createDataFrame([("c", str(i), x) for i, x in enumerate(p)], "contrast string, feature string, pvalue double")
    assert np.allclose([r["padj"] for r in diff.adjusted(df).orderBy("feature").collect()], [0.04, 0.04 * 4 / 3, 0.04 * 4 / 3, 0.2])


def test_adjustment_against_brute_force(spark):
    draw = np.random.default_rng(3)
    p = {c: np.concatenate([draw.uniform(size=300), draw.uniform(size=100) ** 20, np.full(50, 1.0), [0.0, 0.0, 0.5, 0.5]]) for c in "ab"}
    rows = [(c, str(i), float(x)) for c, values in p.items() for i, x in enumerate(values)] + [("a", "none", None)]
    df = spark.createDataFrame(rows, "contrast string, feature string, pvalue double").repartition(5)
    got = {(r["contrast"], r["feature"]): r["padj"] for r in diff.adjusted(df).collect()}
    assert len(got) == len(rows) and got["a", "none"] is None
    for c, values in p.items():
        m, rank = len(values), lambda x: (values <= x).sum()  # noqa: B023
        for i, x in enumerate(values):
            assert math.isclose(got[c, str(i)], min(1.0, *[y * m / rank(y) for y in values if y >= x]), rel_tol=1e-12)


def test_distances_with_missing_values(spark):
    rows = [("f", "a", 1.0), ("f", "b", 4.0), ("g", "a", 2.0), ("g", "b", None), ("g", "c", 2.0), ("h", "b", 0.0), ("h", "a", 4.0)]
    d = {(r["sample_a"], r["sample_b"]): r["distance"] for r in sampleqc.sample_distances(spark.createDataFrame(rows, "feature string, sample string, x double")).collect()}
    assert d == {("a", "a"): 0.0, ("b", "b"): 0.0, ("c", "c"): 0.0, ("a", "b"): 5.0, ("b", "a"): 5.0, ("a", "c"): 0.0, ("c", "a"): 0.0}


SHEET = "row long, sample string, fastq_1 string, fastq_2 string, strandedness string, condition string"


def test_sheet(spark):
    rows = [(1, "A", "a2", "m2", "forward", "x"), (0, "A", "a1", "m1", None, " "), (2, "B", "b1", None, "reverse", "y"), (3, "C", "c1", "n1", "auto", "z"), (4, "C", "c2", None, "auto", "w")]
    sheet = spark.createDataFrame(rows, SHEET)
    lanes = {r["sample"]: r for r in design.lane_group(sheet).collect()}
    assert (lanes["A"]["fastq_1"], lanes["A"]["fastq_2"], lanes["A"]["condition"], lanes["B"]["fastq_2"]) == (["a1", "a2"], ["m1", "m2"], "x", [])
    assert {(r["sample"], r["rule"]) for r in design.sheet_violations(sheet).collect()} == {("C", "condition_conflict"), ("C", "mate_count")}
    assert design.contrast_pairs(sheet.where("sample <> 'C'")).count() == 2
    assert {r["contrast"] for r in design.contrast_pairs(sheet).collect()} == {"y_vs_x", "z_vs_x", "z_vs_y"}
    assert design.contrast_pairs(sheet.where("row = 0 or sample = 'B'")).count() == 0
    assert design.has_condition(sheet.limit(0)).first()[0] is False
    inferred = spark.createDataFrame([("C", "reverse")], "sample string, call string")
    assert {r["sample"]: r["call"] for r in design.strandedness_resolve(sheet, inferred).collect()} == {"A": "forward", "B": "reverse", "C": "reverse"}


def test_em_keeps_the_mass(spark):
    hits = spark.createDataFrame([("S", 1, 1, 1, ["a"]), ("S", 2, 1, 1, ["a", "b"]), ("S", 3, 1, 1, ["b", "c"]), ("S", 4, 1, 1, ["__ambiguous"])], "sample string, read_id long, aln long, n long, features array<string>")
    theta = {r["feature"]: r["theta"] for r in quant.quantify_em(hits, 20).collect()}
    assert math.isclose(sum(theta.values()), 3.0, rel_tol=1e-9) and theta["a"] > theta["b"]
    assert {r["feature"]: r["n"] for r in quant.quantify_uniq(hits).collect()} == {"a": 1}


def test_jobs_and_reads(spark):
    m = spark.createDataFrame([("r", "3600", "1024", "150"), ("r", "NA", "NA", "50")], "rule string, s string, max_rss string, cpu_percent string")
    a = spark.createDataFrame([("r", 2, 2048.0, 0)], "rule string, threads long, mem_mb double, pos long")
    r = jobs.job_resource_summary(m, a).first()
    assert (r["n"], r["walltime_mean_h"], r["cpu_used_mean_cores"], r["cpu_eff"], r["ram_used_mean_gb"], r["ram_eff"]) == (2, 0.5, 1.0, 0.5, 0.5, 0.25)
    files = spark.createDataFrame([("a", "1", 0), ("a", "2", 3), ("b", "1", 0)], "sample string, file string, n_reads long")
    assert {r["sample"]: r["ok"] for r in reads.nonempty_reads(files).collect()} == {"a": True, "b": False}
    q = spark.createDataFrame([("s", "L", 1, "ACGN", "II#5")], "sample string, lane string, read_id long, seq string, qual string")
    assert [(r["mean_quality"], r["n_pct"]) for r in reads.position_profile(q).orderBy("pos").collect()] == [(40.0, 0.0), (40.0, 0.0), (2.0, 0.0), (20.0, 100.0)]
    assert reads.max_read_length(q).first()["overhang"] == 3


@pytest.mark.parametrize("path,want", [("x_trimmed.fq.gz", True), ("d_trimmed.fq/x.fastq", False), ("a_val_2.FASTQ", True), ("a.trimmed.fastq", True), ("trimmed.fq", False)])
def test_trimmed(spark, path, want):
    assert col(spark, [path], X.already_trimmed) == [want]


def test_erfc_against_math():
    x = np.concatenate([np.linspace(0, 6, 4001), np.geomspace(1e-12, 26, 400)])
    want = np.array([math.erfc(v) for v in x])
    assert np.max(np.abs(diff.erfc(x) / want - 1)) < 1e-12 and diff.erfc(np.array([40.0]))[0] == 0.0


def test_position_profile_by_definition(spark):
    """Texts of different lengths, empty and null ones, many tasks; with and without mates."""
    import random

    r = random.Random(1)
    text = lambda letters, n: "".join(r.choice(letters) for _ in range(n))
    rows = []
    for i in range(300):
        n = r.randrange(12)
        rows.append((f"S{i % 2}", r.choice(["R1", "R2"]), i, text("ACGTNn", n), text("".join(map(chr, range(33, 93))), n)))
    rows += [("S0", "R1", 300, None, None), ("S0", "R1", 301, "AC", None)]
    q = spark.createDataFrame(rows, "sample string, mate string, read_id long, seq string, qual string").repartition(7)
    for by in (("sample", "mate"), ("sample",), ()):
        got = {(*(x[c] for c in by), x["pos"]): (x["n"], x["mean_quality"], x["n_pct"]) for x in reads.position_profile(q, by).collect()}
        want = {}
        for row in rows:
            key = dict(zip(("sample", "mate"), row))
            for pos in range(max(len(row[3] or ""), len(row[4] or ""))):
                cell = want.setdefault((*(key[c] for c in by), pos), ([], []))
                cell[0].extend(ord(c) - 33 for c in (row[4] or "")[pos : pos + 1])
                cell[1].extend(c in "Nn" for c in (row[3] or "")[pos : pos + 1])
        assert got == {k: (len(a), round(sum(a) / len(a), 6) if a else None, round(100 * sum(b) / len(b), 6) if b else 0.0) for k, (a, b) in want.items()}
    assert reads.position_profile(q.limit(0)).count() == 0
