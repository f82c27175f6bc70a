"""Round trips through text."""

import gzip

import pytest

from pyspark.sql import functions as F

from genospark.operators import cohort, reads
from genospark.operators.tracks import exon_track
from genospark.plans.queries import Views
from genospark.sources import readers, writers
from compare import DATA


def write(path, lines):
    opened = gzip.open(path, "wt") if str(path).endswith(".gz") else open(path, "w")
    with opened as f:
        f.write("\n".join(lines) + "\n")
    return str(path)


def test_line_numbers_across_splits(spark, tmp_path):
    path = write(tmp_path / "x.txt", [f"line {i} {'x' * (i % 70)}" for i in range(5000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = readers.numbered_lines(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 5000 and all(r["value"].startswith(f"line {r['line_no']} ") for r in rows)


def test_gtf(spark, tmp_path):
    lines = ["# comment", "", "c1\ts\texon\t11\t20\t.\t+\t.\tgene_id \"G1\"; transcript_id T1; gene_id \"G2\";", "c1\ts\texon\tx\t20\t.\t+\t.\tgene_id \"G1\";", "c1\ts\texon\t1\t2\t.\t+\t.\tother \"G1\";", "short\tline"]
    path = write(tmp_path / "a.gtf.gz", lines)
    got = readers.read_gtf(spark, path).collect()
    assert len(got) == 1 and got[0]["attrs"] == {"gene_id": "G2", "transcript_id": "T1"} and got[0]["start"] == 11
    assert readers.read_gtf(spark, path, quoted=True).first()["attrs"] == {"gene_id": "G2"}


def test_bed_round_trip(spark, tmp_path):
    v = Views(spark, f"{DATA}/sf0.001")
    track = exon_track(v.records())
    writers.write_bed(track, str(tmp_path / "bed"), "gene_id", gzip=True)
    back = readers.read_bed(spark, str(tmp_path / "bed")).select("chrom", "start0", "end0", F.col("id").alias("gene_id"), "strand")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, track.select("chrom", "start0", "end0", "gene_id", "strand").collect()))
    te = v.te
    writers.write_bed(te, str(tmp_path / "te"), "te_id", ("te_family", "te_class"))
    back = readers.read_bed(spark, str(tmp_path / "te"), ("te_family", "te_class"))
    assert back.count() == te.count() and back.where("te_class is null").count() == 0


def test_junctions(spark, tmp_path):
    good = "c1\t10\t+\tc2\t20\t-\t1\t0\textra"
    path = write(tmp_path / "S7_Chimeric.out.junction", ["chr_donorA\tbrkpt_donorA\tx\tx\tbrkpt\tx\tx\tx", good, "c1\t10\t+\tc2\t20\t-\t1", "", good])
    rows = readers.read_junctions(spark, path).orderBy("line_no").collect()
    assert [(r["sample"], r["line_no"], r["donor_bp"], r["acceptor_bp"]) for r in rows] == [("S7", 1, 10, 20), ("S7", 4, 10, 20)]


def test_count_tables(spark, tmp_path):
    path = write(tmp_path / "c.txt", ["gene/TE\tx.bam", "a\t3.9", "b\tx", "c\t3.0", "d", "a\t5"])
    read = lambda how: {r["feature"]: r["n"] for r in readers.read_count_tables(spark, {"s": path}, how).collect()}
    assert read("zero") == {"a": 5, "b": 0, "c": 3} and read("strict") == {"a": 5, "b": 0, "c": 0}


def test_sheet_report_metrics_fastq(spark, tmp_path):
    sheet = readers.read_sample_sheet(spark, write(tmp_path / "s.csv", ["# note", "sample,fastq_1,condition", "A, a.fq ,", "B,b.fq,x"])).orderBy("row").collect()
    assert [(r["sample"], r["fastq_1"], r["fastq_2"], r["condition"]) for r in sheet] == [("A", "a.fq", None, None), ("B", "b.fq", None, "x")]
    report = readers.read_infer_report(spark, write(tmp_path / "R1.txt", ["x", 'Fraction of reads explained by "1++,1--,2+-,2-+": 0.91', 'Fraction of reads explained by "1+-,1-+,2++,2--": 0.02']))
    assert [(r["sample"], r["pattern"][:3], r["fraction"]) for r in report.orderBy("line_no").collect()] == [("R1", "1++", 0.91), ("R1", "1+-", 0.02)]
    fq = readers.read_fastq(spark, write(tmp_path / "r.fastq.gz", ["@r1 x", "ACGT", "+", "@@II", "@r2", "AC", "+", "I#"])).orderBy("pos").collect()
    assert [(r["read_id"], r["seq"], r["qual"]) for r in fq] == [("r1", "ACGT", "@@II"), ("r2", "AC", "I#")]
    for rule, head in (("new", "s\tmax_rss\tmean_load"), ("old", "s\tmax_rss\tcpu_percent")):
        (tmp_path / rule).mkdir()
        write(tmp_path / rule / "b.tsv", ["", head, "1\t2\t3"])
    got = readers.read_job_metrics(spark, [str(tmp_path / r / "b.tsv") for r in ("new", "old")]).orderBy("rule").collect()
    assert [tuple(r) for r in got] == [("new", "1", "2", "3"), ("old", "1", "2", "3")]
    assert [tuple(r) for r in readers.read_metrics(spark, write(tmp_path / "m.txt", ["metric\tvalue", "a\t1"])).collect()] == [("m", "a", "1")]


def test_events_tracks_and_matrix(spark, tmp_path):
    events = Views(spark, f"{DATA}/sf0.001").annotated().cache()
    writers.write_events(events, str(tmp_path / "e"), gzip=True)
    back = spark.read.csv(str(tmp_path / "e/events"), sep="\t", header=True)
    assert back.count() == events.count() and set(back.columns) == set(events.columns)
    writers.write_igv_bed(events, str(tmp_path / "igv"))
    lines = spark.read.text(str(tmp_path / "igv")).collect()
    assert sum(r["value"].startswith("track name=") for r in lines) == events.where("direction in ('gene_to_te', 'te_to_gene')").select("sample").distinct().count()
    from genospark.operators.cohort import counts_long

    writers.write_matrix(counts_long(events), str(tmp_path / "m"), ["S0", "S1"])
    m = readers.read_table(spark, str(tmp_path / "m"))
    assert m.columns == ["feature", "S0", "S1"] and m.where("S0 is null").count() == 0


def test_attribute_without_a_value(spark):
    row = spark.range(1).select(readers.gtf_attrs(F.lit('gene_id "G1"; pseudo; family_id ; note a b;')).alias("a")).first()
    assert row["a"] == {"gene_id": "G1", "pseudo": "", "family_id": "", "note": "a b"}


def test_events_and_catalog_are_written_in_order(spark, tmp_path):
    v = Views(spark, f"{DATA}/sf0.001")
    events = v.annotated()
    writers.write_events(events, str(tmp_path / "e"))
    back = [line.split("\t") for f in sorted((tmp_path / "e/events/sample=S1").glob("part-*")) for line in f.read_text().splitlines()[1:]]
    keys = [(r[1], int(r[2]), r[3], r[4], int(r[5]), r[6]) for r in back]
    assert keys == sorted(keys) and len(keys) == events.where("sample = 'S1'").count()
    catalog = cohort.event_catalog(events)
    writers.write_catalog(catalog, str(tmp_path / "c"))
    ids = [line.split("\t")[0] for f in sorted((tmp_path / "c").glob("part-*")) for line in f.read_text().splitlines()[1:]]
    assert ids == [r["event_id"] for r in catalog.orderBy("first_sample", "event_id").collect()]


def test_read_length_override_and_error(spark):
    reads_ = spark.createDataFrame([("a", "L1", 1, ""), ("a", "L2", 2, "")], "sample string, lane string, read_id long, seq string")
    assert reads.max_read_length(reads_, overhang=99).first()["overhang"] == 99
    with pytest.raises(Exception, match="no read with a length"):
        reads.max_read_length(reads_).collect()


def fastq_text(n, seed=1):
    import random

    r = random.Random(seed)
    rows = []
    for i in range(n):
        size = r.choice([0, 1, 5, 40, 150]) if i % 7 else 30
        rows.append((f"r{i}", "".join(r.choice("ACGTN") for _ in range(size)), "".join(r.choice("@+I#F5") for _ in range(size))))
    return rows, "".join(f"@{name} extra {i}\n{seq}\n+{name if i % 3 else ''}\n{qual}\n" for i, (name, seq, qual) in enumerate(rows))


@pytest.mark.parametrize("split", [1, 7, 100, 4096, 1 << 30])
def test_fastq_ranges_hold_each_record_once(split):
    """However a file is cut, and however small the chunks are: qualities that begin with @ or +, empty sequences, no last newline, \\r\\n."""
    import io

    from genospark.sources import fastq

    rows, text = fastq_text(120)
    for data in (text.encode(), text.encode()[:-1], text.replace("\n", "\r\n").encode(), text.encode() + b"@cut\nAC\n+"):
        got = []
        for at in range(0, len(data), split):
            for pos, head, seq, qual in fastq.records(io.BytesIO(data), at, min(at + split, len(data))):
                got += [(p, h.rstrip(b"\r").split()[0][1:].decode(), s.rstrip(b"\r").decode(), q.rstrip(b"\r").decode()) for p, h, s, q in zip(pos, head, seq, qual)]
        assert [g[1:] for g in got] == rows and [g[0] for g in got] == sorted({g[0] for g in got})
        assert all(data[p : p + 1] == b"@" for p, *_ in got)


def test_fastq_source(spark, tmp_path):
    """Folders, several paths, gzip, hidden files; the path through Spark's own reader gives the same reads."""
    rows, text = fastq_text(500)
    (tmp_path / "d").mkdir()
    (tmp_path / "d/_hidden.fq").write_text("@x\nA\n+\nI\n")
    (tmp_path / "d/a.fq").write_text(text)
    with gzip.open(tmp_path / "b.fq.gz", "wt") as f:
        f.write(text)
    (tmp_path / "empty.fq").write_text("")
    want = sorted(rows * 2)
    paths = [str(tmp_path / "d"), "file://" + str(tmp_path / "b.fq.gz"), str(tmp_path / "empty.fq")]
    got = readers.read_fastq(spark, paths, 999)
    assert got.columns == ["file", "pos", "read_id", "seq", "qual"] and got.rdd.getNumPartitions() > 10
    assert sorted((r["read_id"], r["seq"], r["qual"]) for r in got.collect()) == want
    slow = readers.read_fastq(spark, [str(tmp_path / "d/*.fq"), str(tmp_path / "*.fq.gz")])
    assert sorted((r["read_id"], r["seq"], r["qual"]) for r in slow.collect()) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    spark.dataSource.register(readers.fastq.FastqSource)
    assert spark.read.format("fastq").load(str(tmp_path / "d/a.fq")).count() == 500


def test_matrix_of_thousands_of_samples(spark, tmp_path):
    """A column for each of 5,000 samples, without a pivot: gaps, sums of repeated rows, samples that aren't asked for."""
    samples = [f"s{i:04}" for i in range(5000)]
    rows = [(f"f{i % 30:02}", samples[i * 37 % 5000], i) for i in range(3000)] + [("f00", samples[0], 5), ("f01", "other", 7), ("g", "other", 1), ("h", samples[-1], None)]
    writers.write_matrix(spark.createDataFrame(rows, "feature string, sample string, n long"), str(tmp_path / "m"), samples)
    want = {f: [0] * 5000 for f in sorted({r[0] for r in rows})}
    for f, s, n in rows:
        if s != "other":
            want[f][int(s[1:])] += n or 0
    lines = [x for p in sorted((tmp_path / "m").glob("part-*")) for x in p.read_text().splitlines()]
    head = "\t".join(["feature", *samples])
    assert lines[0] == head and [x for x in lines if x != head] == ["\t".join([f, *map(str, n)]) for f, n in want.items()]


def test_track_over_several_parts(spark, tmp_path):
    """A sample's track in several files: in order, and the track line at the head of the first only."""
    v = Views(spark, f"{DATA}/sf0.01")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        writers.write_igv_bed(v.annotated(), str(tmp_path / "igv"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    parts = [sorted(d.glob("part-*")) for d in sorted((tmp_path / "igv").glob("sample=*"))]
    assert len(parts) == 6 and max(map(len, parts)) > 1
    for files in parts:
        lines = [x for p in files for x in p.read_text().splitlines()]
        assert lines[0].startswith("track name=") and not any(x.startswith("track") for x in lines[1:])
        keys = [(c[0], int(c[1])) for c in (x.split("\t") for x in lines[1:])]
        assert keys == sorted(keys)
