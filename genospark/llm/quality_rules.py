"""Quality rules as a short-circuit cascade: DataFrame functions only, no shuffle of the documents."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import scratch

SAMPLE_PARTS = 8
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
#: A letter behind anything but letters from a word's beginning on: one match for each word with a letter, each character read once.
LETTER_WORD = rf"(?<!{WORD})[^\x20\x09-\x0D\p{{L}}]*+\p{{L}}"
BULLET = r"^[\x20\x09]*[-*\x{2022}\x{2023}\x{25AA}\x{25CF}]"
ELLIPSIS = r"(\.\.\.|\x{2026})[\x20\x09\x0D]*$"


@dataclass(frozen=True)
class Rule:
    """A rule by name; `rejects` is true for a row that it rejects, null counts as false."""

    name: str
    rejects: Column

    def verdict(self) -> Column:
        return F.coalesce(self.rejects, F.lit(False))


def text_features(docs: DataFrame) -> DataFrame:
    """The rows of docs(doc_id, text, ...) as (doc_id, text, words, lines, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words).

    words: runs of anything but 0x20 and 0x09-0x0D; lines: those with a word, of text split by \\n. n_dup_lines: lines equal
    to an earlier one. n_repeat_words: words in a window of three words that the text holds twice or more. Windows are
    sorted with their places inside the row, n log n for n words, and compared as words, not as hashes. A null text is empty.
    """
    d = docs.select(docs["doc_id"].alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    d = d.select("*", F.array_remove(F.split("text", BLANKS), "").alias("words"), F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)).alias("lines"))
    n = F.size("words")
    windows = F.arrays_zip(F.col("words").alias("a"), F.slice("words", 2, n).alias("b"), F.slice("words", 3, n).alias("c"), F.sequence(F.lit(0), n - 1).alias("i"))
    d = d.withColumn("windows", F.when(n > 3, F.sort_array(windows)).otherwise(F.slice(windows, 1, 0)))
    # each window and the next in order: the places of both where they are equal; incomplete ones hold nulls and equal none
    equal = lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])
    pairs = F.zip_with("windows", F.slice("windows", 2, F.size("windows")), lambda x, y: F.when(equal(x, y), F.array(*[p["i"] + k for p in (x, y) for k in range(3)])))
    count = lambda c: c.cast("long")
    return d.select(
        "doc_id",
        "text",
        "words",
        "lines",
        count(n).alias("n_words"),
        count(F.length(F.array_join("words", ""))).alias("word_chars"),
        count(F.regexp_count("text", F.lit(SYMBOLS))).alias("n_symbols"),
        count(F.size("lines")).alias("n_lines"),
        count(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        count(F.size(F.array_distinct(F.flatten(F.array_compact(pairs))))).alias("n_repeat_words"),
    )


def default_rules() -> list[Rule]:
    """Rules over text_features. Too few words and repeated windows come with any order; shares are compared in whole numbers."""
    c = F.col
    share = lambda pattern: F.size(F.filter("lines", lambda x: x.rlike(pattern)))
    return [
        Rule("few_words", c("n_words") < 50),
        Rule("repeated_windows", 100 * c("n_repeat_words") > 50 * c("n_words")),
        Rule("mean_word", (c("word_chars") < 3 * c("n_words")) | (c("word_chars") > 10 * c("n_words"))),
        Rule("symbols", 10 * c("n_symbols") > c("n_words")),
        Rule("repeated_lines", 10 * c("n_dup_lines") > 3 * c("n_lines")),
        Rule("letters", 10 * F.regexp_count("text", F.lit(LETTER_WORD)) < 8 * c("n_words")),
        Rule("bullets", 10 * share(BULLET) > 9 * c("n_lines")),
        Rule("ellipses", 10 * share(ELLIPSIS) > 3 * c("n_lines")),
    ]


def seconds(df: DataFrame, times: int = 2) -> list[float]:
    """The times of a few runs of df, without keeping its rows, in order."""
    found = []
    for _ in range(times):
        began = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        found.append(time.perf_counter() - began)
    return sorted(found)


def ordered_rules(rows: DataFrame, rules: Sequence[Rule], sample_rows: int = 2000, prepare: Callable[[DataFrame], DataFrame] = lambda df: df) -> list[Rule]:
    """The rules by rejection per cost, as a sample shows them.

    The sample: about `sample_rows` rows, each with the same chance, so that rows are read once more but only the sample's
    are prepared (given the columns that rules need) and shuffled. A rule's cost is the time it takes over the sample
    beyond reading it, and no less than reading varies by. The next rule is always the one that rejects most of the
    sample's rows left over, for its cost. Rules that reject nothing more go to the end, cheap ones first; an empty sample
    leaves the given order. The driver gets a count for each combination of verdicts: no more than rows in the sample. The
    order changes no verdict, only how soon a row is rejected.
    """
    if not rules:
        return []
    with scratch(rows.sparkSession) as keep:
        sample = rows.where(F.rand(7) < sample_rows / max(rows.count(), 1)).repartition(SAMPLE_PARTS)
        sample = keep(prepare(sample))
        verdicts = [r.verdict().alias(f"r{k}") for k, r in enumerate(rules)]
        bits = [f"r{k}" for k in range(len(rules))]
        found = [(tuple(x[b] for b in bits), x["count"]) for x in sample.select(*verdicts).groupBy(*bits).count().collect()]
        if not found:
            return list(rules)
        idle = seconds(sample.select(F.lit(1)), 4)[1:]
        cost = [max(seconds(sample.select(v))[0] - idle[0], idle[-1] - idle[0], 0.005) for v in verdicts]
    left, order = set(range(len(rules))), []
    while left:
        rejected = {k: sum(n for v, n in found if v[k]) for k in left}
        best = min(left, key=lambda k: (-rejected[k] / cost[k], cost[k], k))
        order.append(rules[best])
        left.remove(best)
        found = [(v, n) for v, n in found if not v[best]]
    return order


def cascade(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """rows with rejected_by, the first of the rules that rejects the row: later ones aren't evaluated for it. Null: kept. A column of that name in rows is replaced."""
    verdict = F.lit(None).cast("string")
    for r in reversed(rules):
        verdict = F.when(r.verdict(), F.lit(r.name)).otherwise(verdict)
    return rows.withColumn("rejected_by", verdict)


def quality_verdicts(docs: DataFrame, rules: Sequence[Rule] | None = None, sample_rows: int = 2000) -> DataFrame:
    """text_features of docs with rejected_by (null: kept), one row per row of docs, by rules ordered on a sample.

    A null, empty or blank text has no words and fails `few_words`. Repeated rows are judged each, null ids stay, other
    columns of docs are ignored, whatever their names; no rows: no rows. A very long text takes n log n time for its n
    words, and memory of a few times its size. All is one projection of each row; nothing is shuffled but the sample.
    """
    features = text_features(docs)
    chosen = default_rules() if rules is None else list(rules)
    return cascade(features, ordered_rules(docs.select("doc_id", "text"), chosen, sample_rows, text_features))
