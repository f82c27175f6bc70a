"""The registered queries: one for each operator, over whole views of the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators import chimera, cohort, counts, design, diff, em, intervals, jobs, quant, reads, sampleqc, tracks
from ..sources import readers
from ..storage import Shelf
from .fixtures import view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SAMPLES = [f"S{i}" for i in range(6)]
#: Library calls of the derived samples, one of each kind.
CALLS = [("S0", "forward"), ("S1", "reverse"), ("S2", "no"), ("S3", "auto"), ("S4", "forward"), ("S5", "reverse")]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


class Views:
    """The views of one folder, and what is derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, f"fx_{name}")

    def genes(self) -> DataFrame:
        return self.exons.groupBy("gene_id").agg(F.min("chrom").alias("chrom"), F.min("start0").alias("start0"), F.max("end0").alias("end0"), F.min("strand").alias("strand"))

    def events(self) -> DataFrame:
        return chimera.collapse_events(self.junctions)

    def classified(self) -> DataFrame:
        return chimera.classified(chimera.with_hits(self.events(), self.exons, self.te, points=chimera.breakpoints(self.junctions)))

    def meta(self) -> DataFrame:
        return chimera.with_meta(self.classified(), self.genes(), self.te)

    def calls(self) -> DataFrame:
        return self.spark.createDataFrame(CALLS, "sample string, call string")

    def annotated(self, calls: DataFrame | None = None, **options) -> DataFrame:
        return chimera.annotate_junctions(self.junctions, self.exons, self.genes(), self.te, self.calls() if calls is None else calls, **options)

    def own_calls(self) -> DataFrame:
        """(sample, call): what the sheet says, and what the alignments show for the samples that it leaves open."""
        return Shelf(self.spark).put(quant.sample_calls(_open_sheet(self), self.alignments, self.genes()), keep=True)

    def records(self) -> DataFrame:
        return readers.gtf_records(self.gtf_lines)

    def te_records(self) -> DataFrame:
        """Annotation records of the TE view, one per copy, keyed by family and class."""
        attrs = F.create_map(F.lit("gene_id"), F.col("te_family"), F.lit("transcript_id"), F.col("te_id"), F.lit("family_id"), F.col("te_family"), F.lit("class_id"), F.col("te_class"))
        return self.te.select(F.substring("te_id", 3, 7).cast("long").alias("line_no"), "chrom", F.lit("exon").alias("feature"), (F.col("start0") + 1).alias("start"), F.col("end0").alias("end"), "strand", attrs.alias("attrs"))

    def rows(self) -> DataFrame:
        return self.sheet.withColumn("row", F.substring("sample", 2, 9).cast("long"))

    def counts(self) -> DataFrame:
        return self.cnt

    def contrasts(self) -> DataFrame:
        return design.contrast_pairs(self.rows())

    def hits(self) -> DataFrame:
        return quant.assigned(self.alignments, self.exons, self.te)

    def fitted(self) -> DataFrame:
        return quant.fitted(self.alignments, self.exons, self.te)


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Sums of floats depend on their order: six places are compared, or fewer where many sums follow from each other."""
    return df.withColumns({c: F.round(c, places) for c in columns})


@query
def p1_breakpoint_window(spark, sf):
    j = Views(spark, sf).junctions
    return j.select("line_no", X.window_start(F.col("donor_bp"), 2).alias("start0"), X.window_end(F.col("donor_bp"), 2).alias("end0"))


@query
def p2_classify_direction(spark, sf):
    return Views(spark, sf).classified().groupBy("sample", "direction").agg(F.count("*").alias("n"), F.sum("reads").alias("reads"))


@query
def p3_pick_ids(spark, sf):
    return Views(spark, sf).classified().select("sample", *chimera.COORDS, "direction", "gene_id", "te_id")


@query
def p4_gene_side_strand(spark, sf):
    return Views(spark, sf).classified().groupBy("direction", "side_strand").agg(F.count("*").alias("n"))


@query
def p5_canonical_flag(spark, sf):
    return Views(spark, sf).junctions.groupBy("sample", X.canonical(F.col("junction_type")).alias("canonical")).agg(F.count("*").alias("n"))


@query
def p6_require_canonical(spark, sf):
    return Views(spark, sf).annotated(require_canonical=True).groupBy("sample", "direction").agg(F.count("*").alias("n"), F.sum("reads").alias("reads"))


@query
def p7_chimera_type(spark, sf):
    return Views(spark, sf).annotated().groupBy("direction", "gene_strand", "chimera_type").agg(F.count("*").alias("n"))


@query
def p8_strand_evidence(spark, sf):
    v = Views(spark, sf)
    return v.annotated(v.own_calls()).groupBy("sample", "library_strand", "transcript_strand", "gene_strand", "gene_strand_match").agg(F.count("*").alias("n"))


@query
def p9_event_id(spark, sf):
    return Views(spark, sf).annotated().select("sample", "event_id")


@query
def p10_hits_render(spark, sf):
    return Views(spark, sf).annotated().select("sample", "event_id", "donor_hits", "acceptor_hits")


@query
def p11_te_chimera_filter(spark, sf):
    return chimera.te_chimeras(Views(spark, sf).annotated()).select("sample", "event_id", "reads", "te_family", "te_class")


@query
def p12_classify_feature_subfamily(spark, sf):
    return counts.classified_features(Views(spark, sf).cnt).select("sample", "feature", "n", "kind", "te_family", "te_class")


@query
def p13_classify_feature_locus(spark, sf):
    return counts.classified_features(Views(spark, sf).cnt, "locus").select("sample", "feature", "n", "kind", "te_family", "te_class")


@query
def p14_strandedness_call(spark, sf):
    a = Views(spark, sf).alignments.groupBy("sample", "chrom").agg((F.count_if(F.col("strand") == "+") / F.count("*")).alias("f"))
    return a.select("sample", "chrom", X.strandedness_call(F.col("f"), 1 - F.col("f"), 0.5).alias("call"))


@query
def p15_normalize_strandedness(spark, sf):
    s = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", F.concat(F.lit(" "), F.element_at(F.array(*[F.lit(x) for x in ("Forward", "REVERSE ", "unstranded", "no", "bad")]), (F.col("o_orderkey") % 5 + 1).cast("int"))).alias("raw"))
    return s.select("o_orderkey", X.normal_strandedness(F.col("raw")).alias("call"))


@query
def p16_already_trimmed_check(spark, sf):
    s = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", F.concat(F.lit("r_trimmed.d/S"), F.col("o_orderkey").cast("string"), F.element_at(F.array(*[F.lit(x) for x in ("_val_1.fq.gz", "_trimmed.FASTQ", ".trimmed.fq", ".fastq.gz")]), (F.col("o_orderkey") % 4 + 1).cast("int"))).alias("path"))
    return s.select("o_orderkey", X.already_trimmed(F.col("path")).alias("trimmed"))


@query
def p17_log2p1(spark, sf):
    return Views(spark, sf).cnt.select("sample", "feature", F.round(X.log2p1(F.col("n")), 6).alias("x"))


@query
def p18_as_float(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    text = F.when(F.col("event_id") % 3 == 0, "NA").when(F.col("event_id") % 3 == 1, F.col("event_id").cast("string")).otherwise("x1")
    return e.select("event_id", X.as_float(text).alias("x"))


@query
def j1_interval_join_points(spark, sf):
    v = Views(spark, sf)
    hits = intervals.point_hits(chimera.breakpoints(v.events()), v.exons, "gene_id")
    return hits.select("chrom", "bp", F.array_join("hits", ",").alias("hits"))


@query
def j1_interval_join_tolerance(spark, sf):
    v = Views(spark, sf)
    hits = intervals.point_hits(chimera.breakpoints(v.events()), v.te, "te_id", 5)
    return hits.select("chrom", "bp", F.array_join("hits", ",").alias("hits"))


@query
def j2_interval_join_spans(spark, sf):
    v = Views(spark, sf)
    return intervals.overlaps(v.te, v.genes()).select("te_id", F.col("f_gene_id").alias("gene_id"))


@query
def j3_left_join_hits(spark, sf):
    csv = [F.array_join(c, ",").alias(c) for c in ("donor_genes", "donor_tes", "acceptor_genes", "acceptor_tes")]
    v = Views(spark, sf)
    return chimera.with_hits(v.events(), v.exons, v.te).select("sample", *chimera.COORDS, *csv)


@query
def j4_meta_lookup(spark, sf):
    return Views(spark, sf).meta().select("sample", *chimera.COORDS, "gene_start", "gene_end", "gene_strand", "te_start", "te_end", "te_family", "te_class")


@query
def j5_antisense_flag(spark, sf):
    return Views(spark, sf).annotated().groupBy("direction", "antisense_flag").agg(F.count("*").alias("n"))


@query
def j6_feature_class_filter(spark, sf):
    v = Views(spark, sf)
    return counts.feature_class_filter(v.cnt, v.genes().select(F.col("gene_id").alias("feature")))


@query
def j7_condition_lookup(spark, sf):
    v = Views(spark, sf)
    sheet = v.rows().withColumn("condition", F.when(F.col("row") != 4, F.col("condition")).otherwise(" "))
    return sampleqc.condition_lookup(v.junctions.select("sample").distinct(), sheet.where("row <> 5"))


@query
def j8_contrast_pairs(spark, sf):
    return Views(spark, sf).contrasts()


@query
def j9_strandedness_resolve(spark, sf):
    v = Views(spark, sf)
    return design.strandedness_resolve(_open_sheet(v), quant.infer_strandedness(v.alignments, v.genes()).select("sample", "call"))


@query
def j10_allocated_join(spark, sf):
    return _jobs(spark, sf).select("rule", "cpu_alloc_cores", "ram_alloc_gb", "cpu_eff", "ram_eff")


@query
def j11_dense_grid(spark, sf):
    return cohort.dense_grid(Views(spark, sf).counts())


@query
def a1_collapse_events(spark, sf):
    return Views(spark, sf).events()


@query
def a2_gene_spans(spark, sf):
    return tracks.gene_spans(Views(spark, sf).records())


@query
def a3_te_loci(spark, sf):
    return tracks.te_track(Views(spark, sf).te_records())


@query
def a3_te_copies(spark, sf):
    return tracks.te_track(Views(spark, sf).te_records(), "transcript_id")


@query
def a4_exon_track(spark, sf):
    return tracks.exon_track(Views(spark, sf).records())


@query
def a5_transcript_blocks(spark, sf):
    t = tracks.transcript_blocks(Views(spark, sf).records())
    csv = lambda c: F.array_join(F.transform("blocks", lambda b: b[c].cast("string")), ",")
    return t.select("chrom", "start0", "end0", "transcript_id", "strand", csv("start").alias("starts"), csv("size").alias("sizes"))


@query
def a6_feature_keys(spark, sf):
    v = Views(spark, sf)
    columns = ["line_no", "chrom", "feature", "start", "end", "strand", "attrs"]
    return tracks.feature_keys(v.records().select(*columns).unionByName(v.te_records().select(*columns)))


@query
def a7_event_catalog(spark, sf):
    return cohort.event_catalog(Views(spark, sf).annotated())


@query
def a8_event_counts_matrix(spark, sf):
    return cohort.wide_matrix(cohort.counts_long(Views(spark, sf).annotated()), SAMPLES)


@query
def a9_te_catalog(spark, sf):
    return cohort.te_catalog(Views(spark, sf).annotated()).select("event_id", "n_samples", "total_reads", "chimera_type")


@query
def a10_junction_qc(spark, sf):
    return cohort.junction_qc(Views(spark, sf).annotated())


@query
def a11_direction_composition(spark, sf):
    return cohort.direction_composition(Views(spark, sf).classified())


@query
def a12_te_chimera_composition(spark, sf):
    return cohort.te_chimera_composition(Views(spark, sf).classified())


@query
def a13_feature_matrix(spark, sf):
    return cohort.wide_matrix(counts.feature_long(Views(spark, sf).cnt), SAMPLES)


@query
def a14_assignment_summary(spark, sf):
    return counts.assignment_summary(Views(spark, sf).cnt)


@query
def a15_te_class_summary(spark, sf):
    return counts.class_summary(Views(spark, sf).cnt)


@query
def a16_locus_assignment_summary(spark, sf):
    return counts.assignment_summary(_loci(spark, sf), "locus")


@query
def a16_locus_class_summary(spark, sf):
    return counts.class_summary(_loci(spark, sf), "locus")


@query
def a17_qc_presence_filter(spark, sf):
    return sampleqc.presence_filter(Views(spark, sf).cnt, 3, 500)


@query
def a18_zero_variance_filter(spark, sf):
    return rounded(sampleqc.zero_variance_filter(sampleqc.log2_transform(Views(spark, sf).counts())), "x")


@query
def a19_min_events_gate(spark, sf):
    return rounded(sampleqc.min_events_gate(sampleqc.log2_transform(Views(spark, sf).counts()), 100), "x")


@query
def a20_sample_distances(spark, sf):
    return rounded(sampleqc.sample_distances(sampleqc.log2_transform(Views(spark, sf).counts())), "distance")


@query
def a21_sample_pca(spark, sf):
    return sampleqc.sample_pca(sampleqc.zero_variance_filter(sampleqc.log2_transform(Views(spark, sf).counts())))


@query
def a22_lane_group(spark, sf):
    g = design.lane_group(_lanes(spark, sf))
    return g.select("sample", F.array_join("fastq_1", ",").alias("fastq_1"), F.array_join("fastq_2", ",").alias("fastq_2"), "strandedness", "condition")


@query
def a23_sheet_violations(spark, sf):
    return design.sheet_violations(_lanes(spark, sf))


@query
def a24_has_condition(spark, sf):
    return design.has_condition(Views(spark, sf).rows())


@query
def a25_contrast_replicates(spark, sf):
    return design.contrast_replicates(Views(spark, sf).contrasts())


@query
def a26_contrast_strandedness(spark, sf):
    v = Views(spark, sf)
    return design.contrast_strandedness(v.contrasts(), v.own_calls())


@query
def a27_max_read_length(spark, sf):
    return reads.max_read_length(Views(spark, sf).reads)


@query
def a28_gtf_feature_count(spark, sf):
    lines = Views(spark, sf).gtf_lines.select(F.concat(F.lit("f"), (F.col("line_no") % 3).cast("string")).alias("file"), F.when(F.col("line_no") % 3 == 2, F.concat(F.lit("#"), "value")).otherwise(F.col("value")).alias("value"))
    return tracks.line_count(lines)


@query
def a29_nonempty_reads(spark, sf):
    files = Views(spark, sf).reads.groupBy("sample", F.col("lane").alias("file")).agg(F.count_if(F.col("lane") == "L1").alias("n_reads"))
    return reads.nonempty_reads(files)


@query
def a30_job_resource_summary(spark, sf):
    return _jobs(spark, sf).drop("pos")


@query
def a31_repeat_flagged(spark, sf):
    return cohort.repeat_flagged(Views(spark, sf).annotated())


@query
def a31_top_families(spark, sf):
    return cohort.top_families(Views(spark, sf).annotated())


@query
def a31_top_classes(spark, sf):
    return cohort.top_families(Views(spark, sf).annotated(), 3, "te_class")


@query
def q1_infer_strandedness(spark, sf):
    v = Views(spark, sf)
    return rounded(quant.infer_strandedness(v.alignments, v.genes()), "forward", "reverse", "undetermined")


@query
def q2_quantify_uniq(spark, sf):
    v = Views(spark, sf)
    return quant.counted_uniq(v.alignments, v.exons, v.te)


@query
def q2_quantify_uniq_forward(spark, sf):
    v = Views(spark, sf)
    return quant.counted_uniq(v.alignments, v.exons, v.te, calls="forward")


def _called_hits(v: Views) -> DataFrame:
    """Hits by the strand of each sample's own call: the sheet's, or what its alignments show."""
    return quant.assigned(v.alignments, v.exons, v.te, calls=v.own_calls())


@query
def q2_quantify_uniq_by_call(spark, sf):
    v = Views(spark, sf)
    return quant.counted_uniq(v.alignments, v.exons, v.te, calls=v.own_calls())


@query
def q3_quantify_multi_by_call(spark, sf):
    return rounded(quant.quantify_multi(_called_hits(Views(spark, sf))), "weight")


@query
def q3_quantify_multi(spark, sf):
    return rounded(quant.quantify_multi(Views(spark, sf).hits()), "weight")


@query
def q4_quantify_em(spark, sf):
    return rounded(quant.quantify_em(Views(spark, sf).fitted()), "theta", places=3)


def _lengths(v: Views) -> DataFrame:
    both = em.covered_lengths(v.exons, "gene_id").union(em.covered_lengths(v.te, "te_id"))
    return em.effective_lengths(both, v.alignments)


@query
def q4_quantify_em_lengths(spark, sf):
    """Ten steps with effective lengths."""
    v = Views(spark, sf)
    return rounded(em.fit_masses(v.fitted(), _lengths(v)).theta, "theta", "tpm", places=2)


@query
def q4_effective_lengths(spark, sf):
    return rounded(_lengths(Views(spark, sf)), "length")


@query
def q4_em_likelihood(spark, sf):
    """The log likelihood of the masses that ten steps end with, one step back."""
    v = Views(spark, sf)
    return rounded(em.fit_masses(v.fitted(), _lengths(v)).likelihood, "log_likelihood", places=2)


@query
def q4_em_converged(spark, sf):
    """Accelerated, until no mass moves by a hundredth of a read."""
    v = Views(spark, sf)
    return em.fit_masses(v.fitted(), _lengths(v), 300, 0.01, accelerate=True).theta


@query
def q5_quantify_locus(spark, sf):
    return rounded(quant.quantify_multi(_locus_hits(spark, sf)), "weight")


@query
def q5_locus_uniq(spark, sf):
    return quant.counted_uniq(*_by_locus(Views(spark, sf)))


@query
def q5_locus_em(spark, sf):
    return rounded(quant.quantify_em(quant.fitted(*_by_locus(Views(spark, sf)))), "theta", places=3)


@query
def q6_size_factors(spark, sf):
    return rounded(sampleqc.size_factors(Views(spark, sf).counts()), "size_factor")


@query
def q7_dispersions(spark, sf):
    return rounded(sampleqc.dispersions(Views(spark, sf).counts()), "mu", "alpha")


@query
def q7_vst_transform(spark, sf):
    return rounded(sampleqc.vst_transform(Views(spark, sf).counts()), "x")


@query
def q8_contrast_effects(spark, sf):
    v = Views(spark, sf)
    return rounded(diff.contrast_effects(v.counts(), v.contrasts()), "base_mean", "log2fc", "z")


@query
def q8_diff_contrast(spark, sf):
    v = Views(spark, sf)
    return rounded(diff.diff_contrast(v.counts(), v.contrasts()), "base_mean", "log2fc", "z", "pvalue", "padj")


@query
def q8_adjusted_p(spark, sf):
    v = Views(spark, sf)
    p = diff.contrast_effects(v.counts(), v.contrasts()).withColumn("pvalue", F.round(1 / (1 + F.abs("z")), 4)).select("contrast", "feature", "pvalue")
    return rounded(diff.adjusted(p), "padj")


@query
def q9_lane_merge(spark, sf):
    """The merged reads with the place of their file and their place in it."""
    v = Views(spark, sf)
    r = v.reads.withColumn("file", F.concat_ws("_", "lane", "mate")).withColumn("pos", F.col("read_id"))
    return reads.lane_merge(r, reads.lane_places(design.lane_group(_read_sheet(v)))).select("sample", "mate", "place", "pos", "read_id")


@query
def q10_read_qc(spark, sf):
    return reads.read_totals(Views(spark, sf).reads)


@query
def q10_position_quality(spark, sf):
    return reads.position_profile(Views(spark, sf).reads)


@query
def q10_length_distribution(spark, sf):
    return reads.length_distribution(Views(spark, sf).reads)


@query
def s1_gtf_records(spark, sf):
    return Views(spark, sf).records().select("line_no", "chrom", "source", "feature", "start", "end", "strand", F.col("attrs")["gene_id"].alias("gene_id"), F.col("attrs")["transcript_id"].alias("transcript_id"))


@query
def s3_gtf_attrs_quoted(spark, sf):
    r = readers.gtf_records(Views(spark, sf).gtf_lines, quoted=True)
    return r.select("line_no", F.col("attrs")["gene_id"].alias("gene_id"), F.col("attrs")["transcript_id"].alias("transcript_id"))


@query
def s10_infer_report(spark, sf):
    """Reports that say what was inferred, written out, read and called again."""
    v = Views(spark, sf)
    found = quant.infer_strandedness(v.alignments, v.genes())
    line = lambda tag, c: F.concat(F.lit(f'Fraction of reads explained by "{tag}": '), F.round(c, 4).cast("decimal(5,4)").cast("string"))
    lines = found.select("sample", F.posexplode(F.array(line("++,--", "forward"), line("+-,-+", "reverse"))).alias("line_no", "value"))
    return design.report_calls(readers.infer_report(lines))


@query
def s15_te_chimeras(spark, sf):
    return chimera.te_chimeras(Views(spark, sf).annotated())


@query
def s16_igv_bed(spark, sf):
    return chimera.igv_bed(Views(spark, sf).annotated())


@query
def e2_annotate_junctions(spark, sf):
    return Views(spark, sf).annotated(tol=2)


@query
def e2_annotate_cis_only(spark, sf):
    return Views(spark, sf).annotated(cis_only=True).groupBy("sample", "chimera_type").agg(F.count("*").alias("n"))


def _by_locus(v: Views) -> tuple[DataFrame, DataFrame, DataFrame, str]:
    """What is quantified by TE copy."""
    return v.alignments, v.exons, v.te.withColumn("locus", F.concat_ws(":", "te_id", "te_family", "te_family", "te_class")), "locus"


def _locus_hits(spark: SparkSession, sf: str) -> DataFrame:
    return quant.assigned(*_by_locus(Views(spark, sf)))


def _open_sheet(v: Views) -> DataFrame:
    """The sheet with a strandedness for every other sample only."""
    return v.rows().withColumn("strandedness", F.when(F.col("row") % 2 == 0, F.col("strandedness")).when(F.col("row") == 1, "auto"))


def _read_sheet(v: Views) -> DataFrame:
    """A row for each sample and lane of the reads, with its two files; every other sample has lane 2 before lane 1."""
    number = lambda c: F.substring(c, 2, 9).cast("long")
    lanes = v.reads.select("sample", "lane").distinct()
    row = number("sample") * 2 + (number("lane") + number("sample")) % 2
    text = F.lit(None).cast("string")
    return lanes.select(row.alias("row"), "sample", F.concat("lane", F.lit("_R1")).alias("fastq_1"), F.concat("lane", F.lit("_R2")).alias("fastq_2"), text.alias("strandedness"), text.alias("condition"))


def _loci(spark: SparkSession, sf: str) -> DataFrame:
    c = Views(spark, sf).cnt
    return c.withColumn("feature", F.when(F.col("feature").startswith("SF"), F.concat(F.lit("T1:"), "feature")).otherwise(F.col("feature")))


def _lanes(spark: SparkSession, sf: str) -> DataFrame:
    """Every order is a lane of one of a third as many samples; some lack a mate, a condition, a file or a name."""
    o, k = spark.read.parquet(f"{sf}/orders.parquet"), F.col("o_orderkey")
    text = lambda p, s: F.concat(F.lit(p), k.cast("string"), F.lit(s))
    return o.select(
        k.alias("row"), F.when(k % 97 != 5, F.concat(F.lit("S"), F.floor(k / 3).cast("string"))).alias("sample"), F.when(k % 89 != 7, text("r", "_1.fq")).alias("fastq_1"), F.when(k % 5 != 0, text("r", "_2.fq")).otherwise(" ").alias("fastq_2"),
        F.when(k % 31 == 3, "reverse").otherwise("forward").alias("strandedness"), F.when(k % 29 == 4, "b").when(k % 2 == 0, "a").alias("condition"),
    )


def _jobs(spark: SparkSession, sf: str) -> DataFrame:
    m = Views(spark, sf).metrics
    allocated = m.select("rule").distinct().where("rule <> 'click'").select("rule", F.length("rule").cast("long").alias("threads"), (F.length("rule") * 1000.0).alias("mem_mb"), F.length("rule").cast("long").alias("pos"))
    return jobs.job_resource_summary(m, allocated)


from . import roundtrips as _roundtrips  # noqa: E402, F401  registers the queries over text files
