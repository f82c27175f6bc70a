"""The whole screen as one function: tables in, named DataFrames out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators import chimera, cohort, counts, design, diff, em, jobs, quant, reads, sampleqc, tracks
from ..storage import Shelf, few_met


@dataclass
class Options:
    """Defaults of the reference tools' configuration."""

    tolerance: int = 0
    require_canonical: bool = False
    cis_only: bool = False
    te_key: str = "gene_id"
    feature_class: str = "TE"
    transform: str = "vst"
    min_samples_present: int = 2
    min_total_counts: int = 5
    min_events: int = 10
    min_fraction: float = 0.6
    padj: float = 0.05
    foldchange: float = 1.0
    minread: int = 1
    peek: int = 20  # reads of each file that are looked at for the overhang
    overhang: int | None = None
    trimming: bool = True  # reads will be trimmed: files that look trimmed are a fault
    em_steps: int = 100
    em_tolerance: float = 0.1  # reads
    strict: bool = False  # what the checks find raises; else it is an output


def run_all(inputs: dict[str, DataFrame], options: Options | None = None) -> dict[str, DataFrame]:
    """Every output that the given inputs allow.

    inputs: gene_records and te_records (annotation), annotation_lines (file, value), junctions, alignments, counts, sheet,
    reads (sample, mate, file, pos, read_id, seq, qual), metrics, allocated. What an output needs and isn't there leaves
    the output out. Events, library calls, masses and components are stored in the shared folder, or made, at once; the
    other outputs are plans. With strict, what the checks find is an error.
    """
    o, has, out = options or Options(), inputs.get, {}
    checks: dict[str, DataFrame] = {}
    if has("sheet") is not None:
        sheet = inputs["sheet"]
        out |= {"lanes": design.lane_group(sheet), "contrasts": design.contrast_pairs(sheet)}
        out["contrast_replicates"] = design.contrast_replicates(out["contrasts"])
        checks |= {"sheet_violations": design.sheet_violations(sheet), "strandedness_violations": design.strandedness_violations(sheet)}
        if o.trimming:
            files = reads.lane_places(out["lanes"])
            checks["trimmed_inputs"] = files.where(X.already_trimmed(F.col("file"))).select("sample", "mate", "file")
    if has("annotation_lines") is not None:
        out["annotation_sizes"] = tracks.line_count(inputs["annotation_lines"])
        checks["empty_annotations"] = out["annotation_sizes"].where("n = 0")
    if has("reads") is not None:
        out |= _reads(inputs["reads"], out.get("lanes"), o, checks)
    if o.strict:
        for what, found in checks.items():
            design.require_none(found, what.replace("_", " "))
    out |= checks
    if has("gene_records") is not None:
        out |= {"genes": tracks.gene_spans(inputs["gene_records"]), "exons": tracks.exon_track(inputs["gene_records"]), "transcripts": tracks.transcript_blocks(inputs["gene_records"]), "feature_keys": tracks.feature_keys(inputs["gene_records"])}
    if has("te_records") is not None:
        out |= {"tes": tracks.te_track(inputs["te_records"], o.te_key), "te_keys": tracks.feature_keys(inputs["te_records"])}
    if has("alignments") is not None and "genes" in out:
        out |= _alignments(inputs, out, o)
    if has("junctions") is not None and {"genes", "tes"} <= out.keys():
        calls = out.get("strandedness", "no")
        events = Shelf(inputs["junctions"].sparkSession).put(chimera.annotate_junctions(inputs["junctions"], out["exons"], out["genes"], out["tes"], calls, o.tolerance, o.require_canonical, o.cis_only), keep=True)
        out |= {"events": events, "te_chimeras": chimera.te_chimeras(events), "igv_bed": chimera.igv_bed(events), "event_catalog": cohort.event_catalog(events), "te_catalog": cohort.te_catalog(events), "event_counts": cohort.counts_long(events)}
        out |= {"junction_qc": cohort.junction_qc(events), "direction_composition": cohort.direction_composition(events), "te_chimera_composition": cohort.te_chimera_composition(events)}
        out |= _quality("event", out["event_counts"], o, max(o.min_events, 2))
    if has("counts") is not None:
        table = inputs["counts"]
        out |= {"assignment": counts.assignment_summary(table), "te_classes": counts.class_summary(table)}
        keys = {"TE": out.get("te_keys"), "gene": out.get("feature_keys")}.get(o.feature_class)
        out["feature_counts"] = counts.feature_long(table, keys)
        out |= _quality("feature", out["feature_counts"], o, 2)
        if "contrasts" in out:
            out["differential"] = diff.diff_contrast(table, out["contrasts"], o.padj, o.foldchange, o.minread)
    if has("metrics") is not None:
        out["jobs"] = jobs.job_resource_summary(inputs["metrics"], has("allocated")).orderBy("pos", "rule")
    return out


def _reads(table: DataFrame, lanes: DataFrame | None, o: Options, checks: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Read quality by sample and mate, the overhang, and with a sheet the merged lanes and the samples without a read."""
    out = {"read_qc": reads.read_totals(table), "position_profile": reads.position_profile(table), "length_distribution": reads.length_distribution(table)}
    out["overhang"] = reads.max_read_length(table, o.peek, "file", "pos", o.overhang)
    if lanes is not None:
        files = reads.lane_places(lanes)
        out["merged_reads"] = reads.lane_merge(table, files)
        found = files.join(table.groupBy("sample", "mate", "file").agg(F.count("*").alias("n")), ["sample", "mate", "file"], "left")
        out["nonempty_reads"] = reads.nonempty_reads(found.select("sample", "file", F.coalesce("n", F.lit(0)).alias("n_reads")))
        checks["samples_without_reads"] = out["nonempty_reads"].where("not ok")
    return out


def _alignments(inputs: dict[str, DataFrame], made: dict[str, DataFrame], o: Options) -> dict[str, DataFrame]:
    """Library calls, and counts by subfamily (or whatever te_key names) and by locus, each sample by its own call."""
    table, out = inputs["alignments"], {}
    shelf = Shelf(table.sparkSession)
    if "lanes" in made:
        sheet = inputs["sheet"]
        out["inferred"] = quant.infer_strandedness(table.join(few_met(design.strandedness_open(sheet), table, "sample"), "sample", "left_semi"), made["genes"], o.min_fraction)
        out["strandedness"] = shelf.put(design.strandedness_resolve(sheet, out["inferred"]), keep=True)
        out["contrast_strandedness"] = design.contrast_strandedness(made["contrasts"], out["strandedness"])
        if o.strict:
            design.require_none(out["contrast_strandedness"], "contrasts of mixed strandedness")
    else:
        out["inferred"] = quant.infer_strandedness(table, made["genes"], o.min_fraction)
    if "tes" not in made:
        return out
    calls = out.get("strandedness", "no")
    loci = tracks.te_track(inputs["te_records"], "transcript_id").withColumn("locus", F.concat_ws(":", "te_id", "te_family", "te_class"))
    for name, tes, key in (("", made["tes"], "te_id"), ("locus_", loci, "locus")):
        hits = shelf.put(quant.assigned(table, made["exons"], tes, key, calls), keep=True)
        lengths = em.effective_lengths(em.covered_lengths(made["exons"], "gene_id").union(em.covered_lengths(tes, key)), table)
        fit = em.fit_masses(hits, lengths, o.em_steps, o.em_tolerance, accelerate=True)
        out |= {f"{name}uniq": quant.quantify_uniq(hits), f"{name}multi": quant.quantify_multi(hits), f"{name}em": fit.theta, f"{name}em_likelihood": fit.likelihood}
    return out


def _quality(name: str, long: DataFrame, o: Options, least: int) -> dict[str, DataFrame]:
    """The transformed counts, and the distances and first components of the samples."""
    kept = sampleqc.presence_filter(long.withColumn("n", F.col("n").cast("long")), o.min_samples_present, o.min_total_counts)
    values = sampleqc.log2_transform(kept) if o.transform != "vst" else sampleqc.vst_transform(kept)
    usable = Shelf(long.sparkSession).put(sampleqc.min_events_gate(sampleqc.zero_variance_filter(values), least), keep=True)
    return {f"{name}_transformed": values, f"{name}_distances": sampleqc.sample_distances(usable), f"{name}_pca": sampleqc.sample_pca(usable)}
