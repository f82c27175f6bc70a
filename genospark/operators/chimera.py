"""Chimeric junctions: reads collapsed to events, events annotated with genes and transposable elements (TEs)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..storage import Shelf, few, few_met
from .intervals import overlaps, probe_width, probes

COORDS = ["donor_chrom", "donor_bp", "donor_strand", "acceptor_chrom", "acceptor_bp", "acceptor_strand"]
#: By direction, the side whose first gene, whose first TE and whose strand are the event's.
GENE_SIDE = {"gene_to_te": "donor", "te_to_gene": "acceptor", "gene_to_gene": "donor", "gene_to_other": "donor", "other_to_gene": "acceptor"}
TE_SIDE = {"gene_to_te": "acceptor", "te_to_gene": "donor", "te_to_te": "donor", "te_to_other": "donor"}
STRAND_SIDE = {**GENE_SIDE, "te_to_te": "donor", "te_to_other": "donor"}


def collapse_events(junctions: DataFrame) -> DataFrame:
    """One row per sample and coordinates: reads, and the junction type and repeat flag of the first line.

    Direction follows from the coordinates, so reads are collapsed before any overlap is looked up.
    """
    first = F.min_by(F.struct("junction_type", "repeat_flag"), "line_no").alias("first")
    return junctions.groupBy("sample", *COORDS).agg(F.count("*").alias("reads"), first).select("sample", *COORDS, "first.junction_type", "first.repeat_flag", "reads")


def breakpoints(rows: DataFrame) -> DataFrame:
    """The distinct (chrom, bp) of both ends of events or junctions, in one pass over them."""
    ends = F.array(*[F.struct(F.col(f"{side}_chrom").alias("chrom"), F.col(f"{side}_bp").alias("bp")) for side in ("donor", "acceptor")])
    return rows.select(F.explode(ends).alias("e")).select("e.*").distinct()


def with_hits(events: DataFrame, exons: DataFrame, tes: DataFrame, tolerance: int = 0, points: DataFrame | None = None) -> DataFrame:
    """events with donor_genes, donor_tes, acceptor_genes and acceptor_tes: sorted distinct ids, empty where nothing is hit.

    points: the breakpoints of the events, where they can be had more cheaply than from the events themselves. The hits of
    distinct breakpoints are looked up and stored once for both sides; where they are few, no event is shuffled to meet them.
    """
    hits = Shelf(events.sparkSession).put(hits_at(points if points is not None else breakpoints(events), exons, tes, tolerance), keep=True)
    out = at_both_ends(events, hits, "genes", "tes")
    none = F.array().cast("array<string>")
    empty = {f"{side}_{kind}": F.coalesce(F.col(f"{side}_{kind}"), none) for side in ("donor", "acceptor") for kind in ("genes", "tes")}
    return out.withColumns(empty).select(*events.columns, *empty)


def hits_at(points: DataFrame, exons: DataFrame, tes: DataFrame, tolerance: int = 0) -> DataFrame:
    """(chrom, bp, genes, tes) of the distinct breakpoints that hit something."""
    named = lambda t, key, kind: t.select("chrom", "start0", "end0", F.col(key).alias("id"), F.lit(kind).alias("kind"))
    found = overlaps(probes(points, tolerance), named(exons, "gene_id", "gene").union(named(tes, "te_id", "te")), probe_width(tolerance))
    of = lambda kind: F.array_sort(F.collect_set(F.when(F.col("f_kind") == kind, F.col("f_id"))))
    return found.groupBy("chrom", "bp").agg(of("gene").alias("genes"), of("te").alias("tes"))


def at_both_ends(events: DataFrame, sites: DataFrame, *columns: str) -> DataFrame:
    """events with the columns of sites (chrom, bp, ...), stored, at either breakpoint, as donor_ and acceptor_; null where a breakpoint isn't among them."""
    sent = few(sites) is not sites
    for side in ("donor", "acceptor"):
        named = sites.select(F.col("chrom").alias(f"{side}_chrom"), F.col("bp").alias(f"{side}_bp"), *[F.col(c).alias(f"{side}_{c}") for c in columns])
        events = events.join(F.broadcast(named) if sent else named, [f"{side}_chrom", f"{side}_bp"], "left")
    return events


def classified(events: DataFrame) -> DataFrame:
    """events with hits, plus direction, gene_id, te_id and side_strand: the first id of the side that decides, and the gene side's strand."""
    d, of = F.col("direction"), lambda sides, column: {k: column(side) for k, side in sides.items()}
    out = events.withColumn("direction", X.direction(*[F.col(c) for c in ("donor_genes", "donor_tes", "acceptor_genes", "acceptor_tes")]))
    return out.withColumns(
        {
            "gene_id": X.by_direction(d, of(GENE_SIDE, lambda side: F.array_min(f"{side}_genes"))),
            "te_id": X.by_direction(d, of(TE_SIDE, lambda side: F.array_min(f"{side}_tes"))),
            "side_strand": F.coalesce(X.by_direction(d, of(STRAND_SIDE, lambda side: F.col(f"{side}_strand"))), F.lit(".")),
        }
    )


def first_rows(track: DataFrame, key: str) -> DataFrame:
    """The first row of each id, by place."""
    rest = [c for c in track.columns if c not in ("chrom", "start0", "end0", key)]
    return track.groupBy(key).agg(F.min(F.struct("chrom", "start0", "end0", *rest)).alias("m")).select(key, "m.*")


def left_join(events: DataFrame, table: DataFrame, *keys: str, place: tuple[str, ...] = ("sample", *COORDS)) -> DataFrame:
    """events, or other rows that have a place, with the columns of table, as a left join on keys gives them, the first of them a text.

    Events that lack a key meet nothing, and there are many of them: they are dealt over tasks by their place, so that null
    isn't one key that a single task reads.
    """
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    dealt = F.concat(F.lit("\0"), F.xxhash64(*place).cast("string"))
    rows = events.withColumn("_known", known).withColumn("_key", F.when(F.col("_known"), F.col(keys[0])).otherwise(dealt))
    named = table.withColumnsRenamed({k: f"_t_{k}" for k in keys})
    same = F.col("_known") & (F.col("_key") == F.col(f"_t_{keys[0]}"))
    for k in keys[1:]:
        same = same & (F.col(k) == F.col(f"_t_{k}"))
    return rows.join(named, same, "left").drop("_known", "_key", *(f"_t_{k}" for k in keys))


def with_meta(events: DataFrame, genes: DataFrame, tes: DataFrame) -> DataFrame:
    """classified events with the spans of their gene and TE, gene_strand, te_family and te_class ('.' where there is none)."""
    g = first_rows(genes, "gene_id").select("gene_id", F.col("start0").alias("gene_start"), F.col("end0").alias("gene_end"), F.col("strand").alias("gene_strand"))
    t = first_rows(tes, "te_id").select("te_id", F.col("start0").alias("te_start"), F.col("end0").alias("te_end"), "te_family", "te_class")
    return left_join(left_join(events, g, "gene_id"), t, "te_id").withColumns({c: F.coalesce(F.col(c), F.lit(".")) for c in ("gene_strand", "te_family", "te_class")})


def antisense_genes(tes: DataFrame, genes: DataFrame) -> DataFrame:
    """(te_id, te_chrom, against): by strand, the first and last id of the genes that a TE's span overlaps; TEs without any are left out.

    Whether another gene than a given one is among them follows from these two alone.
    """
    span = first_rows(tes, "te_id").select("te_id", "start0", "end0")
    spans = tes.select("te_id", "chrom").distinct().join(span, "te_id")
    by = overlaps(spans, genes.select("chrom", "start0", "end0", "gene_id", "strand")).groupBy("te_id", "chrom", "f_strand").agg(F.struct(F.min("f_gene_id").alias("lo"), F.max("f_gene_id").alias("hi")).alias("ids"))
    return by.groupBy("te_id", F.col("chrom").alias("te_chrom")).agg(F.map_from_entries(F.collect_list(F.struct("f_strand", "ids"))).alias("against"))


def described(hits: DataFrame, genes: DataFrame, tes: DataFrame) -> DataFrame:
    """(chrom, bp, hits, gene, te): what an event takes from a breakpoint, of hits_at's rows: the hits as a text, and all of their first gene and first TE, null where there is none.

    Everything that is known of an event's gene and TE follows from one of its breakpoints, and these are fewer and narrower
    than events: only they are joined with the tables of genes and TEs.
    """
    rows = hits.select("chrom", "bp", X.hits_text(F.col("genes"), F.col("tes")).alias("hits"), F.array_min("genes").alias("gene_id"), F.array_min("tes").alias("te_id"))
    g = first_rows(genes, "gene_id").select("gene_id", F.col("start0").alias("gene_start"), F.col("end0").alias("gene_end"), F.col("strand").alias("gene_strand"))
    t = first_rows(tes, "te_id").select("te_id", F.col("start0").alias("te_start"), F.col("end0").alias("te_end"), "te_family", "te_class")
    place = ("chrom", "bp")
    rows = left_join(left_join(rows, g, "gene_id", place=place), t, "te_id", place=place)
    rows = left_join(rows, antisense_genes(tes, genes).withColumnRenamed("te_chrom", "chrom"), "te_id", "chrom", place=place)
    of = lambda key, *columns: F.when(F.col(key).isNotNull(), F.struct(key, *columns))
    return rows.select("chrom", "bp", "hits", of("gene_id", "gene_start", "gene_end", "gene_strand").alias("gene"), of("te_id", "te_start", "te_end", "te_family", "te_class", "against").alias("te"))


def with_descriptions(events: DataFrame, sites: DataFrame) -> DataFrame:
    """events with direction, side_strand, both breakpoints' hits, all of their gene and TE, and antisense: yes where the TE of a gene-TE event overlaps another gene, on the strand opposite to the event's; else '.'.

    sites: the stored rows of `described` for their breakpoints.
    """
    d, of = F.col("direction"), lambda sides, name: X.by_direction(F.col("direction"), {k: F.col(f"{side}_{name}") for k, side in sides.items()})
    there = [F.col(f"{side}_{kind}").isNotNull() for side in ("donor", "acceptor") for kind in ("gene", "te")]
    out = at_both_ends(events, sites, "hits", "gene", "te").withColumn("direction", X.direction_of(*there))
    out = out.withColumns({"gene": of(GENE_SIDE, "gene"), "te": of(TE_SIDE, "te"), "side_strand": F.coalesce(of(STRAND_SIDE, "strand"), F.lit("."))})
    text = {f"{side}_hits": F.coalesce(f"{side}_hits", X.hits_text(F.array(), F.array())) for side in ("donor", "acceptor")}
    own = {c: F.col("gene")[c] for c in ("gene_id", "gene_start", "gene_end")} | {c: F.col("te")[c] for c in ("te_id", "te_start", "te_end")}
    named = {"gene_strand": F.col("gene")["gene_strand"]} | {c: F.col("te")[c] for c in ("te_family", "te_class")}
    out = out.withColumns(text | own | {c: F.coalesce(v, F.lit(".")) for c, v in named.items()})
    ids = F.try_element_at(F.col("te")["against"], X.opposite(F.col("gene_strand")))
    known = X.is_gene_te(d) & F.col("gene_start").isNotNull() & F.col("te_start").isNotNull()
    other = known & ((ids["lo"] != F.col("gene_id")) | (ids["hi"] != F.col("gene_id")))
    return out.withColumn("antisense", F.when(other, "yes").otherwise("."))


def annotate_junctions(junctions: DataFrame, exons: DataFrame, genes: DataFrame, tes: DataFrame, strandedness: DataFrame | str = "no", tol: int = 0, require_canonical: bool = False, cis_only: bool = False) -> DataFrame:
    """The events table: 25 columns, one row per event of every sample.

    strandedness: one value for all samples, or a table (sample, call); auto and unknown samples count as unstranded.
    cis_only leaves chimera_type '.' where both sides lie on different chromosomes.
    """
    events = collapse_events(junctions)
    if require_canonical:
        events = events.where(X.canonical(F.col("junction_type")) == "yes")
    sites = Shelf(junctions.sparkSession).put(described(hits_at(breakpoints(junctions), exons, tes, tol), genes, tes), keep=True)
    full = with_descriptions(events, sites)
    if isinstance(strandedness, str):
        full = full.withColumn("library_strandedness", F.lit("no" if strandedness == "auto" else strandedness))
    else:
        calls = strandedness.groupBy("sample").agg(F.max("call").alias("library_strandedness"))
        full = full.join(few_met(calls, junctions, "sample"), "sample", "left").withColumn("library_strandedness", F.coalesce(F.nullif("library_strandedness", F.lit("auto")), F.lit("no")))
    kind = X.chimera_type(*[F.col(c) for c in ("gene_strand", "gene_start", "gene_end", "te_start", "te_end")])
    if cis_only:
        kind = F.when(F.col("donor_chrom") == F.col("acceptor_chrom"), kind).otherwise(".")
    full = full.withColumns(
        {
            "event_id": F.concat_ws(":", *COORDS, "direction"),
            "canonical": X.canonical(F.col("junction_type")),
            "chimera_type": F.when(X.is_gene_te(F.col("direction")), kind).otherwise("."),
            "transcript_strand": X.transcript_strand(F.col("library_strandedness"), F.col("side_strand")),
        }
    )
    full = full.withColumn("strand_match", X.strand_match(F.col("transcript_strand"), F.col("gene_strand")))
    return full.withColumns({c: F.coalesce(F.col(c), F.lit(".")) for c in ("gene_id", "te_id")}).withColumnsRenamed(OUTPUT_NAMES).select(*EVENT_COLUMNS)


OUTPUT_NAMES = {"donor_bp": "donor_breakpoint", "acceptor_bp": "acceptor_breakpoint", "antisense": "antisense_flag", "library_strandedness": "library_strand", "strand_match": "gene_strand_match"}
EVENT_COLUMNS = [
    "event_id", "sample", *[OUTPUT_NAMES.get(c, c) for c in COORDS], "junction_type", "canonical", "repeat_flag", "reads", "donor_hits", "acceptor_hits", "direction", "gene_id", "gene_strand", "te_id", "te_family", "te_class",
    "chimera_type", "antisense_flag", "library_strand", "transcript_strand", "gene_strand_match",
]


def te_chimeras(events: DataFrame) -> DataFrame:
    return events.where(X.is_gene_te(F.col("direction")))


def igv_bed(events: DataFrame) -> DataFrame:
    """(sample, chrom, start0, end0, name, score, strand): a browser track of the gene-TE events."""
    d, a = F.col("donor_breakpoint") - 1, F.col("acceptor_breakpoint")
    return te_chimeras(events).where("donor_breakpoint is not null and acceptor_breakpoint is not null").select(
        "sample", F.col("donor_chrom").alias("chrom"), F.least(d, a).alias("start0"), F.greatest(d, a).alias("end0"), F.col("event_id").alias("name"), F.col("reads").alias("score"), F.col("donor_strand").alias("strand")
    )
