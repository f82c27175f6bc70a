"""Benchmark decontamination: a BM25 index of test items, queried by every training passage with block-max WAND.

Passages are all windows of a document's words. The index holds, for each term, its items in blocks with the largest
impact of each block. What a passage has of an item's rarest terms bounds what the item can score there; where no bound
reaches the threshold the passage is done, else lists are merged and blocks skipped by their own bounds. Every item above
the threshold is then verified on the whole document: its question (the text but for its last fifth) and its answer (the
rest) must both be there, as word n-grams or, but for a few edits, as words in order.

Document frequencies, the number of items, their mean length and the passage width are those of all items; the index is
built from them in tasks, a shard each, so that scores don't depend on how many shards there are.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytetext import Words, mix, parts, slices, words
from .tables import saved

K1, B = 1.2, 0.75
BLOCK = 64
SHARD_BYTES = 16 << 20  # of item text in one index, on average


@dataclass
class Index:
    """terms: sorted hashes. Postings of term t are at[t]:at[t+1], in blocks of BLOCK; impact: the item's BM25 part over its own full score.

    rare_*: the essential postings only: of each item, those of its rarest terms, so many that the others, `rest`, make up
    no more than half the threshold. An item that reaches the threshold has some of them.
    """

    ids: np.ndarray
    terms: np.ndarray
    at: np.ndarray
    item: np.ndarray
    impact: np.ndarray
    top: np.ndarray
    rare_at: np.ndarray
    rare_item: np.ndarray
    rare_impact: np.ndarray
    rest: np.ndarray
    question: list[tuple[np.ndarray, int, np.ndarray]]
    answer: list[tuple[np.ndarray, int, np.ndarray]]

    def blocks(self, term: int) -> list[tuple[int, int, int, float]]:
        """(first item, last item, start of postings, bound) of the term's blocks."""
        a, z = int(self.at[term]), int(self.at[term + 1])
        return [(int(self.item[k]), int(self.item[min(k + BLOCK, z) - 1]), k, float(self.impact[k : min(k + BLOCK, z)].max())) for k in range(a, z, BLOCK)]


def part(hashes: np.ndarray, size: int) -> tuple[np.ndarray, int, np.ndarray]:
    """(words, words in an n-gram, n-grams) of a part of an item: of fewer words than size, the whole part."""
    size = min(size, len(hashes))
    return hashes, size, grams(hashes, size)


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """The distinct n-grams of a sequence of word hashes."""
    if not size or len(hashes) < size:
        return hashes[:0]
    x = np.full(len(hashes) - size + 1, size, np.uint64)
    for k in range(size):
        x = mix(x * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(hashes) - size + 1 + k])
    return np.unique(x)


def in_order(wanted: np.ndarray, own: np.ndarray) -> float:
    """The share of a part's words left by the fewest edits (words put in, left out or changed) that turn it into some run of a document's words."""
    if not len(wanted):
        return 1.0
    step = np.arange(len(own) + 1, dtype=np.int32)
    edits = np.zeros(len(own) + 1, np.int32)
    for word in wanted:
        least = edits + np.int32(1)
        least[1:] = np.minimum(least[1:], edits[:-1] + (own != word))
        edits = np.minimum.accumulate(least - step) + step
    return 1 - int(edits.min()) / len(wanted)


def given_away(shares: list[float], lengths: list[int], overlap: float) -> bool:
    """Whether an item is there: `overlap` of its words, and of each part all but the rest of them, or but one word of a short part."""
    enough = all((1 - s) * n <= max(1.0, (1 - overlap) * n) + 1e-9 for s, n in zip(shares, lengths))
    return enough and sum(s * n for s, n in zip(shares, lengths)) >= overlap * sum(lengths) - 1e-9


@dataclass
class Statistics:
    """Of all items: their number, mean length in words, and the length of the longest."""

    n: int
    mean: float
    longest: int


def build_index(ids: np.ndarray, sequences: list[np.ndarray], terms: np.ndarray, df: np.ndarray, of_all: Statistics, size: int, threshold: float) -> Index:
    """The index of some items, given as hashes of their words. terms: their sorted terms, df: the number of items, of all, that hold each."""
    lengths = np.array([len(s) for s in sequences], np.float64)
    flat = np.concatenate([*sequences, np.zeros(0, np.uint64)])
    owner = np.repeat(np.arange(len(sequences)), lengths.astype(int))
    code = np.searchsorted(terms, flat)
    pair, count = np.unique(code.astype(np.int64) * max(len(sequences), 1) + owner, return_counts=True)
    term, item = pair // max(len(sequences), 1), pair % max(len(sequences), 1)
    idf = np.log(1 + (of_all.n - df + 0.5) / (df + 0.5))
    weight = idf[term] * count * (K1 + 1) / (count + K1 * (1 - B + B * lengths[item] / max(of_all.mean, 1.0)))
    weight = weight / np.bincount(item, weight, len(sequences))[item]
    at = np.searchsorted(term, np.arange(len(terms) + 1))
    top = np.zeros(len(terms))
    np.maximum.at(top, term, weight)
    by = np.lexsort((term, df[term], item))
    spent = np.cumsum(weight[by])
    before = np.concatenate([[0.0], spent])[np.searchsorted(item[by], item[by], "left")]
    rare = np.zeros(len(weight), bool)
    rare[by] = spent - before - weight[by] < 1 - threshold / 2
    rest = np.bincount(item[~rare], weight[~rare], len(sequences))
    rare_at = np.concatenate([[0], np.cumsum(rare)])[at]
    cut = [max(len(s) - max(len(s) // 5, min(len(s), size)), 0) for s in sequences]
    return Index(ids, terms, at, item, weight, top, rare_at, item[rare], weight[rare], rest, [part(s[:c], size) for s, c in zip(sequences, cut)], [part(s[c:], size) for s, c in zip(sequences, cut)])


def item_rows(items: DataFrame) -> DataFrame:
    """(item_no, item_id, n, words): the items with words, numbered, with the hashes of their words without punctuation at the ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            found: list[np.ndarray] = []
            for a, z, data, bounds in slices(b.column("text")):
                w = words(data, bounds).bare()
                h = w.hashes()[0].view(np.int64)
                found += [h[w.first[d] : w.first[d + 1]] for d in range(z - a)]
            yield pa.RecordBatch.from_arrays([b.column("item_no"), b.column("item_id"), pa.array([len(x) for x in found], pa.int32()), pa.array(found, pa.list_(pa.int64()))], ["item_no", "item_id", "n", "words"])

    kind = dict(items.dtypes)["item_id"]
    numbered = items.where("item_id is not null and text is not null").select(F.monotonically_increasing_id().alias("item_no"), "item_id", F.lower(F.col("text").cast("string")).alias("text"))
    return saved(numbered.mapInArrow(run, f"item_no long, item_id {kind}, n int, words array<long>").where("n > 0"))


def index_shards(rows: DataFrame, of_all: Statistics, size: int, threshold: float, shard_bytes: int) -> DataFrame:
    """(shard, index): an index of each shard of item_rows, built in a task and pickled.

    Items are dealt by a hash; a shard has about shard_bytes of text, six bytes a word.
    """
    n_shards = max(1, ceil(of_all.n * of_all.mean * 6 / shard_bytes))
    dealt = rows.select(F.pmod(F.xxhash64("item_no"), F.lit(n_shards)).alias("shard"), "item_no", "words")
    terms = dealt.select("shard", F.explode(F.array_distinct("words")).alias("term")).groupBy("term", "shard").agg(F.count("*").alias("n"))
    df = terms.groupBy("term").agg(F.sum("n").alias("df"), F.collect_list("shard").alias("shards")).select(F.explode("shards").alias("shard"), "term", "df")

    def build(key: tuple, items: pd.DataFrame, df: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values("item_no")
        terms = df["term"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(terms)
        sequences = [np.asarray(w, np.int64).view(np.uint64) for w in items["words"]]
        index = build_index(items["item_no"].to_numpy(np.int64), sequences, terms[order], df["df"].to_numpy(np.float64)[order], of_all, size, threshold)
        return pd.DataFrame({"shard": [key[0]], "index": [pickle.dumps(index)]})

    return saved(dealt.groupBy("shard").cogroup(df.groupBy("shard")).applyInPandas(build, "shard long, index binary"))


def wand(index: Index, terms: np.ndarray, threshold: float) -> list[tuple[int, float]]:
    """(item, score) of all items whose score for these distinct terms is the threshold at least: block-max WAND.

    Lists are kept in order of their current item. The pivot is the first list at which the bounds of the lists so far
    reach the threshold; if the bounds of the blocks that hold the pivot item don't, all lists up to it skip past the
    nearest end of those blocks.
    """
    lists = [{"t": int(t), "blocks": index.blocks(int(t)), "b": 0, "p": int(index.at[t]), "end": int(index.at[t + 1]), "top": float(index.top[t])} for t in terms]
    out = []

    def seek(x: dict, item: int) -> None:
        while x["b"] < len(x["blocks"]) and x["blocks"][x["b"]][1] < item:
            x["b"] += 1
        if x["b"] == len(x["blocks"]):
            x["p"] = x["end"]
        else:
            low = max(x["p"], x["blocks"][x["b"]][2])
            x["p"] = low + int(np.searchsorted(index.item[low : x["end"]], item))

    while lists := [x for x in lists if x["p"] < x["end"]]:
        lists.sort(key=lambda x: index.item[x["p"]])
        total, pivot = 0.0, -1
        for i, x in enumerate(lists):
            total += x["top"]
            if total >= threshold - 1e-12:
                pivot = i
                break
        if pivot < 0:
            break
        item = int(index.item[lists[pivot]["p"]])
        while pivot + 1 < len(lists) and index.item[lists[pivot + 1]["p"]] == item:
            pivot += 1
        bound, ends = 0.0, []
        for x in lists[: pivot + 1]:
            b = x["b"]
            while b < len(x["blocks"]) and x["blocks"][b][1] < item:
                b += 1
            if b < len(x["blocks"]):
                bound += x["blocks"][b][3]
                ends.append(x["blocks"][b][1] + 1)
        after = min([*ends, *(int(index.item[x["p"]]) for x in lists[pivot + 1 : pivot + 2])], default=item + 1)
        if bound < threshold - 1e-12:
            for x in lists[: pivot + 1]:
                seek(x, max(after, item + 1))
        elif index.item[lists[0]["p"]] == item:
            score = sum(float(index.impact[x["p"]]) for x in lists[: pivot + 1])
            if score >= threshold - 1e-12:
                out.append((item, score))
            for x in lists[: pivot + 1]:
                x["p"] += 1
        else:
            for x in lists[:pivot]:
                if index.item[x["p"]] < item:
                    seek(x, item)
    return out


def passages(index: Index, w: Words, hashes: np.ndarray, width: int, threshold: float) -> list[tuple[int, int, int]]:
    """(text, first word, end word) of passages in which some item could reach the threshold.

    For each item, the sum of its essential postings met in a window of `width` words plus its rest bounds its score
    there. A passage takes in all windows with the same essential postings, so it has under twice `width` words.
    """
    if not len(index.terms) or not len(hashes):
        return []
    place = np.minimum(np.searchsorted(index.terms, hashes), len(index.terms) - 1)
    word = np.flatnonzero(index.terms[place] == hashes)
    term = place[word]
    n = index.rare_at[term + 1] - index.rare_at[term]
    posting = np.repeat(index.rare_at[term], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    word = np.repeat(word, n)
    item = index.rare_item[posting]
    text = w.texts()[word]
    span = len(hashes) + width + 1
    key = (text * len(index.ids) + item) * span + word
    order = np.argsort(key, kind="stable")
    key, word, item, text = key[order], word[order], item[order], text[order]
    total = np.concatenate([[0.0], np.cumsum(index.rare_impact[posting[order]])])
    low = np.searchsorted(key, np.maximum(key - width + 1, key - word), "left")
    reached = total[1:] - total[low] + index.rest[item] >= threshold - 1e-9
    text, first, end = text[reached], word[low[reached]], word[reached] + 1
    slack = width - (end - first)
    found = np.stack([text, np.maximum(w.first[text], first - slack), np.minimum(w.first[text + 1], end + slack)], axis=1)
    return [tuple(x) for x in np.unique(found, axis=0).tolist()]


def in_documents(index: Index, w: Words, width: int, threshold: float, overlap: float) -> Iterator[tuple[int, int, float, float, float]]:
    """(text, item, score, question_overlap, answer_overlap) of the items that texts give away; item by its place in the index."""
    h = w.hashes()[0]
    best: dict[tuple[int, int], float] = {}
    for text, start, end in passages(index, w, h, width, threshold):
        unique = np.unique(h[start:end])
        place = np.minimum(np.searchsorted(index.terms, unique), len(index.terms) - 1)
        known = place[index.terms[place] == unique]
        if index.top[known].sum() < threshold - 1e-9:
            continue
        for item, score in wand(index, known, threshold):
            best[text, item] = max(score, best.get((text, item), 0.0))
    whole: dict[tuple[int, int], np.ndarray] = {}
    for (text, item), score in best.items():
        own = h[w.first[text] : w.first[text + 1]]
        shares, lengths = [], []
        for sequence, size, wanted in (index.question[item], index.answer[item]):
            if (text, size) not in whole:
                whole[text, size] = grams(own, size)
            share = float(np.isin(wanted, whole[text, size]).mean()) if size else 1.0
            shares.append(share if share == 1 else max(share, in_order(sequence, own)))
            lengths.append(len(sequence))
        if given_away(shares, lengths, overlap):
            yield text, item, score, shares[0], shares[1]


def contamination(docs: DataFrame, items: DataFrame, width: int | None = None, threshold: float = 0.6, shingle: int = 5, overlap: float = 0.8, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap): every document and item that it gives away.

    docs(doc_id, text) against items(item_id, text), ids of any type. score: the item's best BM25 score in a passage, over
    the score of the item's own text, so that 1 is the whole item. Windows have `width` words, by default as many as the
    longest item; a passage takes in the windows with the same of an item's rarest terms, which are under twice as many
    words. Retrieved are all items with a score of `threshold`; reported are those of which at least `overlap` of the
    question and of the answer are in the document: of its `shingle`-word n-grams, or of its words in order, whichever is
    more. A part of fewer than five words may lack one, if `overlap` of the whole item is there.

    Null or empty documents give nothing; null or empty items, and items without an id, are in nothing. A document row is
    reported for itself, so that repeated rows repeat; repeated item_ids are items of their own; a null doc_id is kept.
    Other columns are ignored; an empty table on either side gives no rows. Documents are read once for every index of
    `shard_bytes` of item text (all public test sets together are smaller), which bounds what a task and the driver hold.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.lower(F.col("text").cast("string")).alias("text"))
    kind = dict(docs.dtypes)["doc_id"]
    rows = item_rows(items.select("item_id", "text"))
    n, mean, longest = rows.agg(F.count("*"), F.coalesce(F.avg("n"), F.lit(0.0)), F.coalesce(F.max("n"), F.lit(0))).first()
    of_all = Statistics(n, mean, longest)
    schema = f"doc_id {kind}, item_no long, score double, question_overlap double, answer_overlap double"
    found = spark.createDataFrame([], schema)
    shards = index_shards(rows, of_all, shingle, threshold, shard_bytes)
    for shard in sorted(r["shard"] for r in shards.select("shard").collect()):
        # one at a time: the driver holds the bytes of one index only
        held = spark.sparkContext.broadcast(bytes(shards.where(F.col("shard") == shard).first()["index"]))

        def run(batches: Iterator[pa.RecordBatch], held=held, wide=width or max(longest, 1)) -> Iterator[pa.RecordBatch]:
            index = pickle.loads(held.value)
            for b in parts(batches):
                got = [(a + x[0], int(index.ids[x[1]]), *x[2:]) for a, _, data, bounds in slices(b.column("text")) for x in in_documents(index, words(data, bounds).bare(), wide, threshold, overlap)]
                columns = [list(c) for c in zip(*got)] or [[]] * 5
                numbers = [pa.array(c, t) for c, t in zip(columns[1:], (pa.int64(), pa.float64(), pa.float64(), pa.float64()))]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(columns[0], pa.int64())), *numbers], ["doc_id", "item_no", "score", "question_overlap", "answer_overlap"])

        found = found.unionByName(docs.mapInArrow(run, schema))
    return found.join(rows.select("item_no", "item_id"), "item_no").select("doc_id", "item_id", "score", "question_overlap", "answer_overlap")
