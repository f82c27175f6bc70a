import random

import pytest
from pyspark.sql import functions as F

from genospark.llm.quality_rules import Rule, cascade, default_rules, ordered_rules, quality_verdicts, text_features

SPACE = " \t\n\x0b\x0c\r"


def words_of(text):
    for c in SPACE:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def by_definition(text):
    text = text or ""
    w = words_of(text)
    lines = [x for x in text.split("\n") if words_of(x)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    places = {p for i, x in enumerate(windows) if windows.count(x) > 1 for p in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), sum(x in lines[:i] for i, x in enumerate(lines)), len(places)


def rejected(text):
    """Any rule, in plain Python."""
    text = text or ""
    n, chars, symbols, dups, repeats = by_definition(text)
    lines = [x for x in text.split("\n") if words_of(x)]
    letters = sum(any(c.isalpha() for c in w) for w in words_of(text))
    bullets = sum(x.lstrip(" \t")[:1] in tuple("-*•‣▪●") for x in lines)
    dots = sum(x.rstrip(" \t\r").endswith(("...", "…")) for x in lines)
    return n < 50 or 100 * repeats > 50 * n or not 3 * n <= chars <= 10 * n or 10 * symbols > n or 10 * dups > 3 * len(lines) or 10 * letters < 8 * n or 10 * bullets > 9 * len(lines) or 10 * dots > 3 * len(lines)


def texts(seed=1):
    r = random.Random(seed)
    pool = ["alpha", "beta", "gamma", "été", "漢字", "12", "#", "x*y", "<b>", "- z", "end...", "more…"] + ["".join(r.choices("abcdefgh", k=r.randrange(2, 9))) for _ in range(80)]
    out = [None, "", " \n\t ", "one", "one two three", "a a a a", "a b c d a b c d", "x\n\nx\n \nx", "a b c a b c"]
    for i in range(150):
        k = r.choice([5, 12, len(pool)])
        out.append("".join(r.choice(pool[:k] if i % 3 else pool[12:]) + r.choice([" "] * 8 + ["\n", "\n- ", "  ", "\t", "...\n"]) for _ in range(r.randrange(1, 160))))
    return out


def test_features_and_verdicts_by_definition(spark):
    rows = list(enumerate(texts()))
    got = {r["doc_id"]: r for r in quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string")).drop("words", "lines").collect()}
    for i, t in rows:
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == by_definition(t), t
        assert (r["rejected_by"] is not None) == rejected(t), t
    kept = sum(r["rejected_by"] is None for r in got.values())
    assert 10 < kept < 100


def test_order_is_rejection_for_cost(spark):
    """A slow rule comes behind a fast one that rejects as much, and what rejects nothing that is left comes last."""
    rows = spark.range(20_000).withColumn("text", F.repeat(F.lit("word "), 200))
    slow = F.size(F.filter(F.sequence(F.col("id"), F.col("id") + 20_000), lambda x: (x * x) % 7 == 3)) >= 0
    rules = [Rule("slow", slow & (F.col("id") % 2 == 0)), Rule("none", F.col("id") < 0), Rule("even", F.col("id") % 2 == 0), Rule("odd", F.col("id") % 2 == 1)]
    names = [r.name for r in ordered_rules(rows, rules)]
    assert {*names[:2]} == {"even", "odd"} and {*names[2:]} == {"slow", "none"}
    assert [r.name for r in ordered_rules(rows.limit(0), rules)] == ["slow", "none", "even", "odd"]


def test_cascade_stops_at_the_first(spark):
    """What stands behind the first rejection isn't evaluated."""
    rows = spark.range(10)
    fails = F.raise_error(F.lit("evaluated")).cast("boolean")
    got = cascade(rows, [Rule("null", F.lit(None).cast("boolean")), Rule("all", F.col("id") >= 0), Rule("never", fails)]).collect()
    assert {r["rejected_by"] for r in got} == {"all"}
    assert {r["rejected_by"] for r in cascade(rows, []).collect()} == {None}


def test_any_order_gives_the_same(spark):
    features = text_features(spark.createDataFrame(list(enumerate(texts(2))), "doc_id long, text string"))
    want = None
    for seed in range(4):
        rules = default_rules()
        random.Random(seed).shuffle(rules)
        kept = {r["doc_id"] for r in cascade(features, rules).where("rejected_by is null").select("doc_id").collect()}
        assert want is None or kept == want
        want = kept


@pytest.mark.parametrize("rows", [[], [(1, None, 5), (None, "w " * 60, 6), (1, None, 5)]])
def test_edges(spark, rows):
    """Empty tables, repeated rows, null ids, columns named like results."""
    got = quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string, words long")).collect()
    assert sorted((r["doc_id"] is None, r["n_words"], r["rejected_by"] is None) for r in got) == sorted((i is None, 60 if t else 0, False) for i, t, _ in rows)


def test_very_long_text(spark):
    text = " ".join(str(i) + "x" for i in range(300_000)) + " 5x 6x 7x"
    r = quality_verdicts(spark.createDataFrame([(1, text), (2, "1" * 2_000_000)], "doc_id long, text string")).drop("words", "lines", "text").orderBy("doc_id").collect()
    assert (r[0]["n_words"], r[0]["n_repeat_words"]) == (300_003, 6) and r[1]["n_words"] == 1


def test_native_plan(spark, docs):
    plan = quality_verdicts(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
