"""Quantification of alignments (sample, read_id, chrom, start0, end0, strand) against genes and TEs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import opposite, strandedness_call
from ..storage import few_met
from . import em
from .design import strandedness_open, strandedness_resolve
from .intervals import hits_by_row, overlaps

KEY = ["sample", "read_id", "aln"]
PLACE = ["chrom", "start0", "end0", "strand"]


def places(alignments: DataFrame) -> DataFrame:
    """The distinct (chrom, start0, end0, strand) of alignments: overlaps are looked up once for each."""
    return alignments.select(*PLACE).distinct()


def numbered(alignments: DataFrame) -> DataFrame:
    """alignments with aln, a number within their read."""
    order = Window.partitionBy("sample", "read_id").orderBy("chrom", "start0", "end0", "strand")
    return alignments.withColumn("aln", F.row_number().over(order))


def infer_strandedness(alignments: DataFrame, genes: DataFrame, least: float = 0.6) -> DataFrame:
    """(sample, n_reads, forward, reverse, undetermined, call): fractions of alignments on, or opposite to, the strand of the one strand of genes they overlap."""
    hit = overlaps(places(alignments), genes.select(*PLACE)).groupBy(*PLACE).agg(F.min("f_strand").alias("lo"), F.max("f_strand").alias("hi"))
    side = F.when(F.col("lo") == F.col("hi"), F.when(F.col("strand") == F.col("lo"), "f").when(F.col("strand") == opposite(F.col("lo")), "r"))
    # alignments of one place are alike: counted by sample before they meet the hits
    counted = alignments.groupBy("sample", *PLACE).agg(F.count("*").alias("n"))
    of = lambda k: F.coalesce(F.sum(F.when(side == k, F.col("n"))), F.lit(0))
    out = counted.join(hit, PLACE, "left").groupBy("sample").agg(F.sum("n").alias("n_reads"), of("f").alias("f"), of("r").alias("r"))
    out = out.select("sample", "n_reads", (F.col("f") / F.col("n_reads")).alias("forward"), (F.col("r") / F.col("n_reads")).alias("reverse"))
    return out.withColumn("undetermined", 1 - F.col("forward") - F.col("reverse")).withColumn("call", strandedness_call(F.col("forward"), F.col("reverse"), least))


def sample_calls(sheet: DataFrame, alignments: DataFrame, genes: DataFrame, least: float = 0.6) -> DataFrame:
    """(sample, call): what the sheet says, and what the alignments show for the samples that it leaves open. Only those are looked at."""
    asked = alignments.join(few_met(strandedness_open(sheet), alignments, "sample"), "sample", "left_semi")
    return strandedness_resolve(sheet, infer_strandedness(asked, genes, least))


def longest(alignments: DataFrame) -> int:
    """The length of the longest alignment; 0 where there is none."""
    return alignments.agg(F.max(F.col("end0") - F.col("start0"))).first()[0] or 0


def candidate_features(rows: DataFrame, exons: DataFrame, tes: DataFrame, te_key: str = "te_id", widest: int | None = None) -> DataFrame:
    """The distinct rows that have candidates, with no, forward and reverse, one array of features for each library call: the gene, or '__ambiguous' where there are several, else the TEs.

    rows have a place, and what else tells them apart. forward and reverse libraries take only features on, or opposite to,
    the place's strand. Genes and TEs are looked up together and once, whatever the calls, and the rows themselves are the
    probes: they meet the features' bins, and their hits are gathered by row. Null: no candidates. widest: see intervals.hits_by_row.
    """
    named = lambda t, key, gene: t.select(*PLACE, F.col(key).alias("id"), F.lit(gene).alias("gene"))
    met = hits_by_row(rows, named(exons, "gene_id", True).union(named(tes, te_key, False)).where("id is not null"), longest(rows) if widest is None else widest)
    fits = {"no": lambda h: F.lit(True), "forward": lambda h: h["strand"] == F.col("strand"), "reverse": lambda h: opposite(h["strand"]) == F.col("strand")}

    def features(fit) -> Column:
        ids = lambda gene: F.array_sort(F.array_distinct(F.transform(F.filter("hits", lambda h: (h["gene"] == gene) & fit(h)), lambda h: h["id"])))
        some = lambda c: F.when(F.size(c) > 0, c)
        return F.when(F.size(ids(True)) > 1, F.array(F.lit("__ambiguous"))).otherwise(F.coalesce(some(ids(True)), some(ids(False))))

    return met.select(*rows.columns, *[features(fit).alias(call) for call, fit in fits.items()])


def assigned(alignments: DataFrame, exons: DataFrame, tes: DataFrame, te_key: str = "te_id", calls: str | DataFrame = "no") -> DataFrame:
    """(sample, read_id, aln, n, features): each alignment with its candidate features; n is the read's number of alignments. Alignments without any are left out.

    calls: one library call for all samples (no, forward, reverse), or (sample, call); `no` for samples that it lacks.
    """
    aln = numbered(alignments).withColumn("n", F.count("*").over(Window.partitionBy("sample", "read_id")))
    return with_features(aln, alignments, exons, tes, te_key, calls).select(*KEY, "n", "features")


def fitted(alignments: DataFrame, exons: DataFrame, tes: DataFrame, te_key: str = "te_id", calls: str | DataFrame = "no") -> DataFrame:
    """(sample, read_id, features) of assigned(...), for those who ask only which features a read fits: nothing is numbered, and a read's equal alignments are one."""
    return with_features(alignments.select("sample", "read_id", *PLACE), alignments, exons, tes, te_key, calls).select("sample", "read_id", "features")


def with_features(rows: DataFrame, alignments: DataFrame, exons: DataFrame, tes: DataFrame, te_key: str, calls: str | DataFrame) -> DataFrame:
    """The distinct rows with samples and places, made of alignments, with the candidate features by their sample's call; those without any are left out."""
    met = candidate_features(rows, exons, tes, te_key, longest(alignments))
    if isinstance(calls, str):
        met = met.withColumn("call", F.lit(calls))
    else:
        met = met.join(few_met(calls.groupBy("sample").agg(F.min("call").alias("call")), alignments, "sample"), "sample", "left")
    features = F.when(F.col("call") == "forward", F.col("forward")).when(F.col("call") == "reverse", F.col("reverse")).otherwise(F.col("no"))
    return met.select(*rows.columns, features.alias("features")).where("features is not null")


def counted_uniq(alignments: DataFrame, exons: DataFrame, tes: DataFrame, te_key: str = "te_id", calls: str | DataFrame = "no") -> DataFrame:
    """quantify_uniq(assigned(...)), where hits aren't needed for more.

    Reads with several alignments go before anything is looked up, and nothing is numbered. The others are counted by sample
    and place, and only their places are looked up.
    """
    one = alignments.groupBy("sample", "read_id").agg(F.count("*").alias("n"), F.min(F.struct(*PLACE)).alias("at")).where("n = 1")
    counted = one.groupBy("sample", *[F.col(f"at.{c}").alias(c) for c in PLACE]).agg(F.count("*").alias("n"))
    met = with_features(counted, alignments, exons, tes, te_key, calls).where((F.size("features") == 1) & (F.col("features")[0] != "__ambiguous"))
    return met.groupBy("sample", F.col("features")[0].alias("feature")).agg(F.sum("n").alias("n"))


def quantify_uniq(hits: DataFrame) -> DataFrame:
    """(sample, feature, n): reads with one alignment and one candidate; the others aren't counted."""
    one = hits.where((F.col("n") == 1) & (F.size("features") == 1) & (F.col("features")[0] != "__ambiguous"))
    return one.groupBy("sample", F.col("features")[0].alias("feature")).agg(F.count("*").alias("n"))


def quantify_multi(hits: DataFrame) -> DataFrame:
    """(sample, feature, weight): each alignment weighs 1 / n, dealt evenly over its candidates."""
    rows = hits.select("sample", F.explode("features").alias("feature"), (1 / (F.col("n") * F.size("features"))).alias("w")).where("feature <> '__ambiguous'")
    return rows.groupBy("sample", "feature").agg(F.sum("w").alias("weight"))


def quantify_em(hits: DataFrame, rounds: int = 10, lengths: DataFrame | None = None, tolerance: float | None = None, accelerate: bool = False) -> DataFrame:
    """(sample, feature, theta) by expectation maximisation over each read's candidates: see em.fit_masses."""
    return em.fit_masses(hits, lengths, rounds, tolerance, accelerate).theta.drop("tpm")
