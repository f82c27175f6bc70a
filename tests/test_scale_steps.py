"""Steps whose rows must not meet in one task, or be made twice."""

import random
import re

from pyspark.sql import functions as F

from genospark.operators import chimera, cohort, diff, em, quant
from genospark.plans.roundtrips import in_order
from genospark.sources import readers
from genospark.storage import Shelf, few_met

COORDS = "donor_chrom string, donor_bp long, donor_strand string, acceptor_chrom string, acceptor_bp long, acceptor_strand string"


def test_adjusted_takes_the_p_values_it_was_given_once(spark):
    """Values that come out otherwise when they are made again still meet their rows."""
    noisy = F.udf(lambda i: 0.01 + i / 100 + random.random() * 1e-9, "double").asNondeterministic()
    p = spark.range(40).select(F.lit("c").alias("contrast"), F.col("id").cast("string").alias("feature"), noisy("id").alias("pvalue"))
    assert diff.adjusted(p).where("padj is null").count() == 0


def test_events_without_a_key_are_dealt_over_tasks(spark):
    rows = [("S0", "c", i, "+", "c", i, "+", f"T{i}" if i % 50 == 0 else None, "c" if i % 100 == 0 else None) for i in range(4000)]
    events = spark.createDataFrame(rows, f"sample string, {COORDS}, te_id string, te_chrom string")
    table = spark.createDataFrame([(f"T{i}", c, i) for i in range(0, 4000, 50) for c in "cd"], "te_id string, te_chrom string, v int")
    given = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(given, ("-1", "false")):
            spark.conf.set(k, v)
        out = chimera.left_join(events, table, "te_id", "te_chrom")
        assert out.columns == [*events.columns, "v"]
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        got = {(r["donor_bp"], r["v"]) for r in out.collect()}
    finally:
        for k, v in given.items():
            spark.conf.set(k, v)
    assert got == {(i, i if i % 100 == 0 else None) for i in range(4000)}
    assert max(sizes) < 1000


def test_places_go_on_from_file_to_file(spark):
    rows = [(f"f{f}", n, f"{'ab'[(f + n) % 2]}{f}-{n}") for f in range(5) for n in range(30)]
    random.Random(1).shuffle(rows)
    lines = spark.createDataFrame(rows, "file string, line_no long, value string")
    out = in_order(lines, F.substring("value", 1, 1), 1)
    want = {}
    for k in "ab":
        want |= {v: i + 1 for i, (_, n, v) in enumerate(sorted(r for r in rows if r[2][0] == k and r[1] >= 1))}
    assert {r["value"]: r["at"] for r in out.collect()} == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"row_number\(\).*file#\d+ ASC", plan)


def test_tables_of_many_samples_are_cut_to_those_there(spark):
    calls = spark.range(150_000).select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("sample"), F.lit("reverse").alias("call"))
    rows = spark.createDataFrame([("S1",), ("S1",), ("S7",), ("X",)], "sample string")
    met = few_met(calls, rows, "sample")
    assert sorted(r["sample"] for r in met.collect()) == ["S1", "S7"]
    assert "broadcast" in met._jdf.queryExecution().logical().toString().lower()
    al = spark.createDataFrame([("S1", 1, "c", 5, 20, "+")], "sample string, read_id long, chrom string, start0 long, end0 long, strand string")
    exons = spark.createDataFrame([("c", 0, 30, "G", "-")], "chrom string, start0 long, end0 long, gene_id string, strand string")
    tes = spark.createDataFrame([], "chrom string, start0 long, end0 long, te_id string, strand string")
    hits = quant.assigned(al, exons, tes, calls=calls)
    assert [r["features"] for r in hits.collect()] == [["G"]]
    assert "SortMergeJoin [sample" not in hits._jdf.queryExecution().executedPlan().toString()


def test_sheet_in_part_files_keeps_its_order(spark, tmp_path):
    spark.range(1000).select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("sample")).repartitionByRange(6, F.length("sample"), "sample").sortWithinPartitions(F.length("sample"), "sample").write.csv(str(tmp_path / "s"), header=True)
    sheet = readers.read_sample_sheet(spark, str(tmp_path / "s"))
    assert {r["sample"]: r["row"] for r in sheet.collect()} == {f"S{i}": i for i in range(1000)}


def test_em_moves_lists_not_rows(spark, monkeypatch):
    """Over many blocks and parts: a row for each part a step, and the masses of plain EM."""
    monkeypatch.setattr(em, "LINKS", 8)
    monkeypatch.setattr(em, "MASSES", 3, raising=False)
    r = random.Random(2)
    reads = [(f"S{i % 2}", i, 1, 1, sorted(r.sample("abcdefgh", r.randrange(1, 4)))) for i in range(60)]
    hits = spark.createDataFrame(reads, "sample string, read_id long, aln long, n long, features array<string>")
    want = {}
    for s in ("S0", "S1"):
        own = [x[4] for x in reads if x[0] == s]
        t = {f: sum((f in c) / len(c) for c in own) for f in {f for c in own for f in c}}
        for _ in range(5):
            t = {f: sum(t[f] / sum(t[g] for g in c) for c in own if f in c) for f in t}
        want |= {(s, f): v for f, v in t.items()}
    got = {(x["sample"], x["feature"]): x["theta"] for x in em.fit_masses(hits, steps=5).theta.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    with Shelf(spark) as shelf:
        blocks = em._Blocks(shelf, hits, None)
        assert blocks.step(blocks.start).count() < len(want)
        blocks.close()


def without_broadcast(spark, plan):
    """plan()'s executed plan where no table is small enough to be broadcast by itself."""
    given = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(given, ("-1", "false")):
            spark.conf.set(k, v)
        return plan()._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in given.items():
            spark.conf.set(k, v)


def test_alignments_are_shuffled_once_for_their_hits(spark):
    """By read to be numbered, by bin to meet the features: no third time, and no row for a level without features; long features too give the hits of all pairs."""
    r = random.Random(4)
    al = [(f"S{i % 2}", i // 3, r.choice("cd"), s := r.randrange(3000), s + r.choice([0, 1, 50]), r.choice("+-")) for i in range(300)]
    rows = spark.createDataFrame(al + al[:9], "sample string, read_id long, chrom string, start0 long, end0 long, strand string")
    for longest in (500, 2000):
        spans = {p: [(r.choice("cd"), s := r.randrange(3000), s + r.choice([0, 40, longest]), f"{p}{i % 9}", r.choice("+-")) for i in range(14)] for p in "GT"}
        exons, tes = (spark.createDataFrame(spans[p], f"chrom string, start0 long, end0 long, {key} string, strand string") for p, key in (("G", "gene_id"), ("T", "te_id")))
        want = []
        for s, i, c, a, b, strand in al + al[:9]:
            g, t = (sorted({x[3] for x in spans[p] if x[0] == c and x[1] < b and x[2] > a and x[4] == strand}) for p in "GT")
            if g or t:
                want.append((s, i, g if len(g) == 1 else ["__ambiguous"] if g else t))
        hits = quant.assigned(rows, exons, tes, calls="forward")
        assert sorted((x["sample"], x["read_id"], x["features"]) for x in hits.collect()) == sorted(want)
        once = {(x["sample"], x["read_id"], tuple(x["features"])) for x in quant.fitted(rows, exons, tes, calls="forward").collect()}
        assert once == {(s, i, tuple(f)) for s, i, f in want}
        if longest == 500:
            assert len(re.findall(r"Exchange hashpartitioning", without_broadcast(spark, lambda: quant.assigned(rows, exons, tes)))) <= 3


def test_events_are_not_shuffled_to_meet_genes_and_tes(spark, tmp_path):
    """Breakpoints take what is known of genes and TEs; catalogs shuffle events once more, by event_id; lines of files aren't shuffled to be numbered."""
    j = spark.createDataFrame([("S", i, "c", i, "+", "c", i + 9, "+", "1", "0") for i in range(40)], f"sample string, line_no long, {COORDS}, junction_type string, repeat_flag string")
    exons = spark.createDataFrame([("c", 3, 20, "G", "+"), ("c", 15, 30, "H", "-")], "chrom string, start0 long, end0 long, gene_id string, strand string")
    tes = spark.createDataFrame([("c", 12, 40, "T", "+", "f", "LINE")], "chrom string, start0 long, end0 long, te_id string, strand string, te_family string, te_class string")
    events = lambda: chimera.annotate_junctions(j, exons, exons, tes)
    shuffles = lambda f: len(re.findall("Exchange hashpartitioning", without_broadcast(spark, f)))
    assert shuffles(events) == 1
    assert shuffles(lambda: cohort.event_catalog(events())) == 2 == shuffles(lambda: cohort.te_catalog(events()))
    found = {r["event_id"] for r in cohort.event_catalog(events()).collect() if r["direction"] in ("gene_to_te", "te_to_gene")}
    assert {r["event_id"] for r in cohort.te_catalog(events()).collect()} == found and found
    spark.range(50).select(F.col("id").cast("string")).write.text(str(tmp_path / "t"))
    lines = lambda: readers.numbered_lines(spark, str(tmp_path / "t"))
    assert shuffles(lines) == 0 and shuffles(lambda: in_order(lines(), F.col("file"), whole=True)) == 0
    assert sorted(in_order(lines(), F.lit("a")).select("at", "value").collect()) == sorted(in_order(lines(), F.lit("a"), whole=True).select("at", "value").collect())


def test_em_of_small_samples_moves_nothing_between_steps(spark, monkeypatch):
    """Samples that fit a task are fitted there, classes a few at a time, with the masses, steps and likelihoods of steps over blocks; and they end together."""
    monkeypatch.setattr(em, "CLASSES", 7, raising=False)
    r = random.Random(5)
    reads = [(f"S{min(i % 4, 2)}", i, sorted(r.sample("abcdefgh"[: 3 + 2 * min(i % 4, 2)], r.randrange(1, 4)))) for i in range(400)]
    hits = spark.createDataFrame([*reads, (None, 1, ["a"]), ("S0", 900, ["__ambiguous"])], "sample string, read_id long, features array<string>")
    lengths = spark.createDataFrame([("S0", "a", 3.0), ("S1", "b", 2.0), ("S2", "a", None), ("S9", "a", 5.0), ("S0", "z", 1.0)], "sample string, feature string, length double")
    asked, step = [], em._Blocks.step
    monkeypatch.setattr(em._Blocks, "step", lambda self, theta: (asked.append(1), step(self, theta))[1])
    for given in ({"steps": 3}, {"steps": 60, "tolerance": 0.05}, {"steps": 30, "tolerance": 0.05, "accelerate": True}):
        alone = em.fit_masses(hits, lengths, **given)
        assert not asked
        with monkeypatch.context() as m:
            m.setattr(em, "ALONE", 0, raising=False)
            blocks = em.fit_masses(hits, lengths, **given)
        assert asked and alone.steps == blocks.steps and (alone.change is None) == (blocks.change is None)
        for table in ("theta", "likelihood"):
            got, want = ({tuple(v for v in x if isinstance(v, str)): [v for v in x if isinstance(v, float)] for x in getattr(fit, table).collect()} for fit in (alone, blocks))
            assert got.keys() == want.keys() and all(abs(a - b) <= 1e-6 * max(1, abs(b)) for k in want for a, b in zip(got[k], want[k]))
        asked.clear()
