import random

from compare import DATA
from pyspark.sql import functions as F

from genospark.operators import chimera
from genospark.operators import intervals
from genospark.operators.intervals import candidates, overlaps, point_hits
from genospark.plans.queries import Views


def track(spark, rows):
    return spark.createDataFrame(rows, "chrom string, start0 long, end0 long, id string")


def test_binned_join_equals_all_pairs(spark):
    """Spans of very different lengths, across bins and levels; the join makes each pair once."""
    r = random.Random(3)
    spans = lambda n, tag: [(f"c{r.randrange(2)}", s := r.randrange(0, 300_000), s + int(2 ** r.uniform(0, 18)), f"{tag}{i}") for i in range(n)]
    a, b = spans(300, "p"), spans(300, "f")
    got = sorted((x["id"], x["f_id"]) for x in overlaps(track(spark, a), track(spark, b)).collect())
    want = sorted((p[3], f[3]) for p in a for f in b if p[0] == f[0] and f[1] < p[2] and f[2] > p[1])
    assert got == want and len(got) > 100


def test_result_does_not_depend_on_partitions(spark):
    r = random.Random(5)
    rows = [("c", s := r.randrange(5000), s + r.randrange(1, 900), str(i)) for i in range(200)]
    one, many = track(spark, rows).coalesce(1), track(spark, rows).repartition(13)
    key = lambda df: sorted((x["id"], x["f_id"]) for x in overlaps(df, df).collect())
    assert key(one) == key(many)


def test_breakpoint_edges(spark):
    """The probe is two bases wide; a long feature behind a short one is found; tolerance widens, a negative one is none."""
    t = track(spark, [("c", 100, 200, "short"), ("c", 10, 5000, "long")])
    points = spark.createDataFrame([("c", bp) for bp in (100, 200, 201, 202, 4000)], "chrom string, bp long")
    hits = lambda tol: {r["bp"]: r["hits"] for r in point_hits(points, t, "id", tol).collect()}
    assert hits(0) == {100: ["long", "short"], 200: ["long", "short"], 201: ["long"], 202: ["long"], 4000: ["long"]}
    assert hits(-1) == hits(0)
    assert hits(2)[202] == ["long", "short"]


def test_empty(spark):
    t = track(spark, [])
    assert overlaps(t, t).count() == 0
    assert point_hits(spark.createDataFrame([("c", 1)], "chrom string, bp long"), t, "id").count() == 0


def test_candidates_follow_hits(spark):
    """The pairs that meet in a bin are a small multiple of those that overlap, and no plan compares levels after the join."""
    v = Views(spark, f"{DATA}/sf0.1")
    p = chimera.breakpoints(v.events()).select("chrom", (F.col("bp") - 1).alias("start0"), (F.col("bp") + 1).alias("end0"))
    pairs = candidates(p, v.exons)
    met, hit = pairs.agg(F.count("*"), F.count_if((F.col("f_start0") < F.col("end0")) & (F.col("f_end0") > F.col("start0")))).first()
    assert hit > 10_000 and met <= 20 * hit


def test_crowded_bins(spark):
    """A third of all places, and features as long as a chromosome, in one wide bin: no key holds more than its share, and the pairs are right."""
    r = random.Random(9)
    near = [("c", s := 40_000_000 + r.randrange(20_000_000), s + r.randrange(2, 300), f"p{i}") for i in range(6000)]
    far = [(f"c{i % 40}", s := r.randrange(500_000_000), s + 20, f"q{i}") for i in range(12_000)]
    wide = [("c", k * 1000, k * 1000 + 400_000_000, f"w{k}") for k in range(6)] + [("c", 41_000_000 + k, 41_900_000 + k, f"m{k}") for k in range(20)] + [(f"c{k}", 0, 3_000, f"s{k}") for k in range(40)]
    p, f = track(spark, near + far), track(spark, wide)
    for a, b in ((p, f), (f, p)):
        got = sorted((x["id"], x["f_id"]) if a is p else (x["f_id"], x["id"]) for x in overlaps(a, b).collect())
        assert got == sorted((x[3], y[3]) for x in near + far for y in wide if x[0] == y[0] and y[1] < x[2] and y[2] > x[1])
    own = p.withColumn("own", intervals.level(F.col("start0"), F.col("end0")))
    keys = intervals._dealt(own, "", F.lit(5), F.lit(5), False).groupBy("chrom", "lv", "bin", "salt").count()
    assert keys.agg(F.max("count")).first()[0] <= 6000 / 256 * 3
