import pytest
from compare import DATA
from pyspark.sql import functions as F

from genospark.plans.queries import Views
from genospark.plans.run import Options, run_all


def test_run_all(spark):
    v = Views(spark, f"{DATA}/sf0.001")
    records, te = v.records(), v.te_records()
    inputs = {"gene_records": records.select(*te.columns), "te_records": te, "junctions": v.junctions, "alignments": v.alignments, "counts": v.cnt, "sheet": v.rows(), "metrics": v.metrics}
    out = run_all(inputs, Options(transform="log2", te_key="transcript_id", feature_class="all"))
    assert out["events"].count() >= out["event_catalog"].count() > 0
    assert out["feature_distances"].count() == 36 and out["jobs"].count() > 0
    plan = out["event_catalog"]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan  # from the written table of events, not from the annotation again
    assert {"differential", "strandedness", "multi", "te_catalog", "transcripts"} <= out.keys()
    for name in ("em", "locus_em"):
        by = out[name].groupBy("sample").agg(F.sum("tpm").alias("t")).collect()
        assert by and all(abs(r["t"] - 1e6) < 1e-3 for r in by)
    assert out["feature_pca"].count() == 6 and out["locus_multi"].count() > 0 and out["em_likelihood"].count() == 6


def test_reads_and_checks(spark):
    v = Views(spark, f"{DATA}/sf0.001")
    reads = v.reads.withColumn("file", F.concat_ws("_", "lane", "mate")).withColumn("pos", F.col("read_id"))
    rows = [(0, "S0", "L1_R1", "L1_R2"), (1, "S0", "L2_R1", "L2_R2"), (2, "S1", "x_trimmed.fq.gz", None), (3, "S2", "none.fq", None)]
    sheet = spark.createDataFrame([(*r, "forward", "a") for r in rows], "row long, sample string, fastq_1 string, fastq_2 string, strandedness string, condition string")
    lines = spark.createDataFrame([("a.gtf", "# only"), ("b.gtf", "c1\tx")], "file string, value string")
    out = run_all({"reads": reads, "sheet": sheet, "annotation_lines": lines})
    assert {r["sample"] for r in out["samples_without_reads"].collect()} == {"S1", "S2"}
    assert [r["file"] for r in out["trimmed_inputs"].collect()] == ["x_trimmed.fq.gz"] and "trimmed_inputs" not in run_all({"sheet": sheet}, Options(trimming=False))
    assert [r["file"] for r in out["empty_annotations"].collect()] == ["a.gtf"]
    assert out["merged_reads"].count() == reads.where("sample = 'S0'").count() and out["overhang"].count() == 6
    assert {r["overhang"] for r in run_all({"reads": reads}, Options(overhang=99))["overhang"].collect()} == {99}
    assert out["position_profile"].where("n_pct > 0").count() > 0 and out["read_qc"].count() == 12
    with pytest.raises(ValueError, match="x_trimmed"):
        run_all({"sheet": sheet.where("row < 3")}, Options(strict=True))


def test_parts(spark):
    assert run_all({}) == {}
    out = run_all({"sheet": Views(spark, f"{DATA}/sf0.001").rows()})
    assert set(out) == {"lanes", "sheet_violations", "strandedness_violations", "contrasts", "contrast_replicates", "trimmed_inputs"}


def test_strict(spark):
    bad = Views(spark, f"{DATA}/sf0.001").rows().withColumn("strandedness", F.lit("sideways"))
    assert run_all({"sheet": bad})["strandedness_violations"].count() > 0
    with pytest.raises(ValueError, match="sideways"):
        run_all({"sheet": bad}, Options(strict=True))
