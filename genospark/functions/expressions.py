"""Scalar expressions on columns: predicates, labels and parsing rules of the RNA-seq tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names and their order as the tables have them.
DIRECTIONS = ("gene_to_te", "te_to_gene", "gene_to_gene", "te_to_te", "gene_to_other", "other_to_gene", "te_to_other", "other")
GENE_TE = ("gene_to_te", "te_to_gene")
CHIMERA_TYPES = ("te_initiated", "te_terminated", "te_exonized", "trans", ".")
TE_CLASSES = ("LINE", "SINE", "LTR", "DNA", "RC")
STRANDEDNESS = {"auto": "auto", "forward": "forward", "reverse": "reverse", "unstranded": "no", "no": "no"}
TRIMMED = r"(?i)(_trimmed|_val_[12]|\.trimmed)(\.fq|\.fastq)(\.gz)?$"


def try_long(c: Column) -> Column:
    return F.trim(c).try_cast("bigint")


def window_start(bp: Column, tolerance: int = 0) -> Column:
    """Zero-based start of the probe of a breakpoint; a negative tolerance counts as none."""
    return bp - 1 - max(tolerance, 0)


def window_end(bp: Column, tolerance: int = 0) -> Column:
    """End of the half-open probe. With tolerance 0 it is two bases wide: the breakpoint's and the next."""
    return bp + 1 + max(tolerance, 0)


def opposite(strand: Column) -> Column:
    return F.when(strand == "+", "-").when(strand == "-", "+").otherwise(".")


def canonical(junction_type: Column) -> Column:
    """yes for splice types 1 to 6, else no; what is no number is no."""
    return F.when(F.coalesce(try_long(junction_type).between(1, 6), F.lit(False)), "yes").otherwise("no")


def is_gene_te(direction: Column) -> Column:
    return direction.isin(*GENE_TE)


def direction(donor_genes: Column, donor_tes: Column, acceptor_genes: Column, acceptor_tes: Column) -> Column:
    """What the two sides hit, by priority. An acceptor that alone hits a TE is `other`."""
    return direction_of(*[F.size(c) > 0 for c in (donor_genes, donor_tes, acceptor_genes, acceptor_tes)])


def direction_of(dg: Column, dt: Column, ag: Column, at: Column) -> Column:
    """direction of whether the donor hits a gene, the donor a TE, the acceptor a gene, the acceptor a TE."""
    rules = ((dg & at, "gene_to_te"), (dt & ag, "te_to_gene"), (dg & ag, "gene_to_gene"), (dt & at, "te_to_te"), (dg, "gene_to_other"), (ag, "other_to_gene"), (dt, "te_to_other"))
    out = F.lit("other")
    for test, name in reversed(rules):
        out = F.when(test, name).otherwise(out)
    return out


def by_direction(d: Column, values: dict[str, Column]) -> Column:
    """The value for the row's direction, null where there is none."""
    out = F.lit(None)
    for name, value in values.items():
        out = F.when(d == name, value).otherwise(out)
    return out


def chimera_type(gene_strand: Column, gene_start: Column, gene_end: Column, te_start: Column, te_end: Column) -> Column:
    """Where the TE lies along the gene's transcription: before, after, or inside (abutting spans are inside)."""
    left, right = te_end < gene_start, te_start > gene_end
    along = F.when(left, "te_initiated").when(right, "te_terminated").otherwise("te_exonized")
    against = F.when(right, "te_initiated").when(left, "te_terminated").otherwise("te_exonized")
    known = gene_start.isNotNull() & te_start.isNotNull()
    return F.when(known & (gene_strand == "+"), along).when(known & (gene_strand == "-"), against).otherwise(".")


def transcript_strand(library: Column, side_strand: Column) -> Column:
    return F.when(library == "forward", side_strand).when(library == "reverse", opposite(side_strand)).otherwise("NA")


def strand_match(transcript: Column, gene_strand: Column) -> Column:
    return F.when((transcript == "NA") | (gene_strand == "."), "NA").when(transcript == gene_strand, "yes").otherwise("no")


def hits_text(genes: Column, tes: Column) -> Column:
    csv = lambda a: F.coalesce(F.nullif(F.array_join(a, ","), F.lit("")), F.lit("."))
    return F.concat(F.lit("gene:"), csv(genes), F.lit("|te:"), csv(tes))


def feature_parts(feature: Column, least: int) -> tuple[Column, Column, Column]:
    """(is TE, family, class) of a count table's key: at least `least` parts between colons, none of them empty."""
    parts = F.split(feature, ":")
    te = (F.size(parts) >= least) & F.forall(parts, lambda p: p != "")
    last = F.when(F.size(parts) >= 3, F.element_at(parts, -1))
    group = F.when(te, F.when(last.isin(*TE_CLASSES), last).otherwise("unknown"))
    return te, F.when(te, F.element_at(parts, -2)), group


def percent(part: Column, whole: Column) -> Column:
    """part of whole in per cent to one decimal; 0 where the whole isn't positive."""
    return F.when(whole > 0, F.round(100.0 * part / whole, 1)).otherwise(0.0)


def normal_strandedness(c: Column) -> Column:
    """The name of a strandedness value; null where it isn't known."""
    table = F.create_map(*[F.lit(x) for kv in STRANDEDNESS.items() for x in kv])
    return F.try_element_at(table, F.lower(F.trim(c)))


def already_trimmed(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1).rlike(TRIMMED)


def strandedness_call(forward: Column, reverse: Column, least: float = 0.6) -> Column:
    """forward if its fraction reaches the threshold, else reverse if that does, else no."""
    return F.when(forward >= least, "forward").when(reverse >= least, "reverse").otherwise("no")


def log2p1(c: Column) -> Column:
    return F.log2(c + F.lit(1.0))


def as_float(c: Column) -> Column:
    """The number in a text, 0 for anything else (also for what isn't finite)."""
    x = F.trim(c).try_cast("double")
    return F.coalesce(F.when(F.isnan(x), 0.0).otherwise(x), F.lit(0.0))
