"""Exact Jaccard join on word n-grams with token-combination prefixes.

Tokens are the hashed shingles of a document, in the order of their hashes. Equal sets are one class. With a threshold of p
per cent, a set of n tokens lacks at most (100 - p) n / 100 of a linked set's tokens, so the first tokens of both, one more
than that, share one: the prefix. Three cases:

- Tokens that more than `frequent` classes have near their beginning are the frequent class. They come last in the order;
  prefixes are extended past them to further rare tokens, each indexed alone.
- A set with too few rare tokens anywhere keeps those and is also indexed by combinations: all its tokens are dealt over
  one cell more than the number of tokens two linked sets can differ by, so that one cell at least holds the same tokens in
  both. The combination of a cell's k tokens (k is about ten) is the key. All k-combinations of an extended prefix would be
  (d + k over k) keys, 5,151 for 1,000 tokens and k = 2; dealt combinations are as many as cells.
- Lists of more than `long` classes, those of large groups of near copies, make no pairs of their own. Their members are
  first compared with one other each; then what is outside a list's largest component meets the whole list, as pivots, round
  by round, until all members are in one component or every pair of different components has been compared.

Candidates are then verified on the whole sets. Each filter follows from the threshold; none caps or samples.
Token hashes have 64 bits: two different shingles of a pair fall together with a chance below 1e-12.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytetext import mix, parts, shingle_hashes, slices, words
from .components import connected_components
from .tables import saved, scratch

SMALL = 200_000  # rows of up to four numbers that are broadcast: 10 to 20 MB; more are joined by a shuffle
LISTED = 2_000_000  # numbers that are sent to every task as one sorted array: 16 MB; more are joined by a shuffle
SKETCH = 256
BLOCK = 1024
DEALS = 16
MET = 64
STAR = 8


def sized(df: DataFrame, most: int = SMALL) -> DataFrame:
    """df (a saved table of a few numbers a row), marked for broadcast if it has few rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def gathered(df: DataFrame, rows: int, each: int = 50_000) -> DataFrame:
    """df, made of some `rows` rows, in as many tasks as these take and there are cores, not in one for each partition of a shuffle."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, rows // each))


def listed(ids: DataFrame) -> np.ndarray | None:
    """The numbers of a saved table of one column, sorted; None where they are too many to be sent to every task."""
    if ids.limit(LISTED + 1).count() > LISTED:
        return None
    return np.sort(ids.toArrow().column(0).to_numpy())


def among(x: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which of x are in the sorted ids."""
    if not len(ids):
        return np.zeros(len(x), bool)
    return ids[np.minimum(np.searchsorted(ids, x), len(ids) - 1)] == x


def without(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows of df whose number isn't in the saved table ids(column); wide rows stay where they are."""
    gone = listed(ids)
    if gone is None:
        return df.join(ids, column, "left_anti")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(~among(b.column(column).to_numpy(), gone)))

    return df.mapInArrow(run, df.schema) if len(gone) else df


def token_sets(text: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    """The sorted distinct token hashes of each text."""
    for a, z, data, bounds in slices(text):
        h, at = shingle_hashes(words(data, bounds), shingle)
        h = h.view(np.int64)
        for d in range(z - a):
            yield np.unique(h[at[d] : at[d + 1]])


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Tokens by the last byte of their hash, counted up to 255. The distance of two sketches is at most their sets' difference."""
    return np.minimum(np.bincount(tokens & (SKETCH - 1), minlength=SKETCH), 255).astype(np.uint8)


def level_width(percent: int) -> float:
    """Of size levels, in logarithms: sizes of linked documents are at most one level apart."""
    return float(-np.log(percent / 100 - 0.001))


def least_size(percent: int) -> int:
    """Smaller sets are linked with their equals only."""
    return -(-percent // (100 - percent))


def cells(tokens: np.ndarray, percent: int) -> list[int]:
    """Keys of the token combinations, for the size levels that the document may be linked in."""
    out: list[int] = []
    if not len(tokens):
        return out
    width = level_width(percent)
    level = int(np.log(len(tokens)) / width)
    u = tokens.view(np.uint64)
    for tag in (level, level + 1):
        largest = int(np.exp(width * (tag + 1))) + 1
        g = (100 - percent) * 2 * largest // (100 + percent) + 1
        cell = (mix(u ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(g)).astype(np.int64)
        total = np.zeros(g, np.uint64)
        np.add.at(total, cell, mix(u + np.uint64(tag)))
        out += mix(total + mix(np.arange(g, dtype=np.uint64) + np.uint64(tag << 32))).view(np.int64).tolist()
    return out


def shingled(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(doc_id, n, d1, d2, window, sketch): size, digest and first tokens of each row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = least_size(percent)
        for b in parts(batches):
            n, d1, d2, window, sketches = [], [], [], [], []
            for tokens in token_sets(b.column("text"), shingle):
                n.append(len(tokens))
                for out, x in zip((d1, d2), digest(tokens)):
                    out.append(x)
                window.append(tokens[: ((100 - percent) * len(tokens) // 100 + 1) * 3 // 2 + 4] if len(tokens) >= small else tokens[:0])
                sketches.append(sketch(tokens).tobytes())
            size = np.cumsum([0, *map(len, window)], dtype=np.int32)
            flat = np.concatenate(window) if window else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int32()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.ListArray.from_arrays(size, pa.array(flat)), pa.array(sketches, pa.binary())],
                ["doc_id", "n", "d1", "d2", "window", "sketch"],
            )

    return docs.mapInArrow(run, "doc_id long, n int, d1 long, d2 long, window array<long>, sketch binary")


def digest(tokens: np.ndarray) -> tuple[int, int]:
    u = tokens.view(np.uint64)
    return int(u.sum(dtype=np.uint64).view(np.int64)), int(mix(u).sum(dtype=np.uint64).view(np.int64))


def whole_sets(docs: DataFrame, wanted: DataFrame, shingle: int, combine: int = 0) -> DataFrame:
    """(rep, n, tokens, cells) of the classes wanted(rep, doc_id, d1); cells, for a threshold of `combine` per cent, empty without.

    A class is read from the rows with its doc_id; of these, the first digest tells its set from other texts with that id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # repeated rows of a task go on once
        for b in parts(batches):
            sets = list(token_sets(b.column("text"), shingle))
            reps = b.column("rep").to_pylist()
            own = np.array([digest(t)[0] == d and r not in seen and not seen.add(r) for t, d, r in zip(sets, b.column("d1").to_pylist(), reps)], bool)
            sets = [t for t, ok in zip(sets, own) if ok]
            yield pa.RecordBatch.from_arrays(
                [b.column("rep").filter(pa.array(own)), pa.array(map(len, sets), pa.int32()), pa.array(sets, pa.list_(pa.int64())), pa.array([cells(t, combine) if combine else [] for t in sets], pa.list_(pa.int64()))],
                ["rep", "n", "tokens", "cells"],
            )

    found = docs.join(sized(wanted.select("rep", "doc_id", "d1")), "doc_id").select("rep", "d1", "text")
    return found.mapInArrow(run, "rep long, n int, tokens array<long>, cells array<long>")


def allowance(n: Column, percent: int) -> Column:
    """How many tokens of a set of this size a linked set may lack."""
    return F.floor(n * (100 - percent) / 100).cast("int")


def prefixes(reps: DataFrame, often: DataFrame, percent: int) -> DataFrame:
    """(rep, doc_id, d1, n, prefix, easy) of reps(rep, doc_id, d1, n, window): the first rare tokens of the window, as many as a prefix has, and whether there are so many."""
    known = listed(often)
    if known is None:
        hits = reps.select("rep", F.explode("window").alias("sig")).join(often, "sig").groupBy("rep").agg(F.collect_set("sig").alias("hits"))
        need = allowance(F.col("n"), percent) + 1
        rare = F.array_except("window", F.coalesce("hits", F.array().cast("array<long>")))
        return reps.join(hits, "rep", "left").select("rep", "doc_id", "d1", "n", F.slice(rare, F.lit(1), need).alias("prefix"), (F.size(rare) >= need).alias("easy"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            window = b.column("window")
            size = window.value_lengths().to_numpy(zero_copy_only=False)
            tokens = window.flatten().to_numpy()
            need = b.column("n").to_numpy().astype(np.int64) * (100 - percent) // 100 + 1
            rare = ~among(tokens, known)
            ends = np.cumsum(size)
            seen = np.concatenate([[0], np.cumsum(rare)])
            before, total = seen[ends - size], seen[ends] - seen[ends - size]
            first = rare & (seen[1:] - np.repeat(before, size) <= np.repeat(need, size))
            at = np.concatenate([[0], np.cumsum(np.minimum(total, need))]).astype(np.int32)
            prefix = pa.ListArray.from_arrays(pa.array(at), pa.array(tokens[first]))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("rep", "doc_id", "d1", "n")), prefix, pa.array(total >= need)], ["rep", "doc_id", "d1", "n", "prefix", "easy"])

    return reps.mapInArrow(run, "rep long, doc_id long, d1 long, n int, prefix array<long>, easy boolean")


def index_entries(docs: DataFrame, reps: DataFrame, shingle: int, percent: int, frequent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of the classes reps(rep, doc_id, d1, n, window): (rep, doc_id, d1), and twice (rep, n, p, last, prefix), the easy ones and the others.

    prefix has the keys: single rare tokens and combinations. p: how many tokens it has, and last: the last of them; p is 0
    where it is the whole of the rare tokens. A key is in the prefixes of `frequent` easy classes at most.
    """
    often = saved(reps.select(F.explode("window").alias("sig")).groupBy("sig").count().where(F.col("count") > frequent).select("sig"))
    marked = saved(prefixes(reps, often, percent))
    hard = saved(whole_sets(docs, saved(marked.where("not easy").select("rep", "doc_id", "d1")), shingle, percent))
    kept = hard.select("rep", F.explode("tokens").alias("sig")).join(sized(often), "sig", "left_anti").groupBy("rep").agg(F.sort_array(F.collect_set("sig")).alias("rare"))
    need = allowance(F.col("n"), percent) + 1
    hard = hard.select("rep", "n", "cells").join(kept, "rep", "left").withColumn("rare", F.coalesce("rare", F.array().cast("array<long>"))).withColumn("very", F.size("rare") < need)
    cut = F.when(F.col("very"), F.concat("rare", "cells")).otherwise(F.slice("rare", F.lit(1), need))
    p, last = F.when(F.col("very"), 0).otherwise(F.size("prefix")), F.when(F.col("very"), F.lit(2**63 - 1)).otherwise(F.element_at("prefix", -1))
    keys = lambda df: df.select("rep", "n", p.alias("p"), last.alias("last"), "prefix")
    easy = keys(marked.where("easy").withColumn("very", F.lit(False)))
    return marked.select("rep", "doc_id", "d1"), easy, saved(keys(hard.select("rep", "n", "very", cut.alias("prefix"))))


def pairs_of_short_lists(cool: DataFrame, numbers: DataFrame, percent: int) -> DataFrame:
    """(a, b), a < b: pairs with a common key in the short lists cool(sig, rep, n) that share as many keys there as the threshold asks, less those that long lists may hold.

    numbers(rep, n, p, last, hot): of each class, hot being its keys with long lists. They meet pairs, not keys.
    """
    x, y = cool.alias("x"), cool.alias("y")
    near = (F.col("x.sig") == F.col("y.sig")) & (F.col("x.rep") < F.col("y.rep")) & (100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n"))
    shared = saved(x.join(y, near).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).groupBy("a", "b").count())
    for c in ("a", "b"):
        shared = shared.join(sized(numbers).select(F.col("rep").alias(c), F.struct("n", "p", "last", "hot").alias(f"of_{c}")), c)
    overlap = F.ceil((F.col("of_a.n") + F.col("of_b.n")) * percent / (100 + percent)).cast("int")
    # of the set whose prefix ends first, tokens of the prefix that aren't shared are missing in the other
    least = F.when(F.col("of_a.last") <= F.col("of_b.last"), F.col("of_a.p") - F.col("of_a.n")).otherwise(F.col("of_b.p") - F.col("of_b.n")) + overlap
    least = F.when((F.col("of_a.p") == 0) & (F.col("of_b.p") == 0), F.lit(0)).otherwise(least)
    return shared.where(F.col("count") + F.least("of_a.hot", "of_b.hot") >= least).select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets have a Jaccard similarity of the threshold at least. Only sets that are asked for are moved, and a pair's first once for about STAR others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in parts(batches, 16):
            one, two = [], []
            for a, star in zip(x.column("a").to_pylist(), x.column("star")):
                reps, tokens = star.values.field("rep").to_pylist(), star.values.field("tokens")
                s = tokens[reps.index(a)].values.to_numpy()
                for r, other in zip(reps, tokens):
                    t = other.values.to_numpy()
                    shared = len(np.intersect1d(s, t, assume_unique=True))
                    if r != a and 100 * shared >= percent * (len(s) + len(t) - shared):
                        one.append(a)
                        two.append(r)
            yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64())], ["a", "b"])

    rows = pairs.count()
    k = saved(gathered(pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR).alias("k")).where("k > 1"), rows))
    part = F.pmod(F.xxhash64("b"), F.coalesce("k", F.lit(1))).alias("part")
    stars = pairs.join(sized(k), "a", "left").select("a", "b", part).groupBy("a", "part").agg(F.collect_set("b").alias("b"))
    wanted = saved(gathered(stars.select("a", "part", F.explode(F.array_union("b", F.array("a"))).alias("rep")), rows))
    full = sets.select("rep", "tokens").join(sized(wanted), "rep").groupBy("a", "part").agg(F.collect_list(F.struct("rep", "tokens")).alias("star"))
    return gathered(full, rows, 1000).mapInArrow(run, "a long, b long")


def with_components(df: DataFrame, nodes: DataFrame, column: str) -> DataFrame:
    """df with c_<column>: the component of its class in that column, by itself its own."""
    of = nodes.select(F.col("node").alias(column), F.col("component").alias("found"))
    return df.join(of, column, "left").withColumn(f"c_{column}", F.coalesce("found", column)).drop("found")


def apart(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) that aren't in one component of nodes(node, component) yet, with their components."""
    return with_components(with_components(pairs, nodes, "a"), nodes, "b").where("c_a <> c_b")


def close_pairs(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and b whose sketches don't rule a link out: the distance of two sketches is no more than their sets' difference."""
    found = []
    for at in range(0, len(a), 32):
        x = a[at : at + 32].astype(np.int16)
        gap = np.abs(x[:, None, :] - b.astype(np.int16)[None, :, :]).sum(2, dtype=np.int32)
        i, j = np.nonzero((100 + percent) * gap <= (100 - percent) * (na[at : at + 32, None] + nb[None, :]))
        found.append((i + at, j))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int))


def deal(sig: Column, lists: Column) -> Column:
    """A part of a class's `lists` long lists: all of them where MET hold them with room to spare, else as many parts as that takes, DEALS at most."""
    parts, most = F.lit(DEALS), DEALS // 2
    while most:
        parts, most = F.when(lists <= most * MET * 3 // 4, most).otherwise(parts), most // 2
    return F.pmod(F.xxhash64(sig), parts)


def met_before(sig: int, x: pd.Series, y: pd.Series) -> np.ndarray:
    """Whether each of x and each of y, arrays of lists, have one in common that comes before sig."""
    out = np.zeros((len(x), len(y)), bool)
    flat = np.concatenate(x.to_numpy())
    row = np.repeat(np.arange(len(x)), x.map(len))
    row, flat = row[flat < sig], flat[flat < sig]
    for j, lists in enumerate(y):
        out[row[np.isin(flat, lists)], j] = True
    return out


def pairs_with_pivots(hot: DataFrame, pivots: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """(a, b), a < b: members of long lists hot(sig, rep, n, c, blocks) with the pivots of their lists, of other components c, but for pairs that sketches rule out.

    A list's members are dealt over blocks of about BLOCK, and its pivots repeated for each, so that a list that a third of
    all rows are in is worked on by many tasks. Near copies meet in most of their lists: a pair is made in the first list that
    the one is in and the other a pivot of. Rows tell each other by the MET first of these; what has more is dealt, and makes a
    pair in the first list of each of its deals. A pair that these don't show together is made in each list.
    """

    rows = hot.count()

    def known(df: DataFrame) -> DataFrame:
        own = df.groupBy("rep").agg(F.first("n").alias("n"), F.first("c").alias("c"), F.array_sort(F.collect_set(F.struct("sig", "blocks"))).alias("at"))
        of = lambda x: deal(x["sig"], F.size("at"))
        deals = F.transform(F.sequence(F.lit(0), F.lit(DEALS - 1)), lambda d: F.slice(F.filter("at", lambda x: of(x) == d), 1, MET)["sig"])
        own = gathered(own, rows).join(sketches, "rep").withColumn("deals", deals).withColumn("x", F.explode("at"))
        return own.select("rep", "n", "c", "sketch", "x.sig", "x.blocks", F.get("deals", of(F.col("x")).cast("int")).alias("lists"))

    x = known(hot).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    y = known(pivots).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))

    def run(key: tuple, x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(y):
            return pd.DataFrame({"a": [], "b": []})
        s, t = (np.frombuffer(b"".join(d["sketch"]), np.uint8).reshape(-1, SKETCH) for d in (x, y))
        i, j = close_pairs(s, t, x["n"].to_numpy(np.int64), y["n"].to_numpy(np.int64), percent)
        new = (x["c"].to_numpy()[i] != y["c"].to_numpy()[j]) & ~met_before(key[0], x["lists"], y["lists"])[i, j]
        a, b = x["rep"].to_numpy()[i[new]], y["rep"].to_numpy()[j[new]]
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    # columns of their own on either side, for both come from the same tables
    x, y = (df.select(*[F.col(c).alias(c) for c in ("sig", "block", "rep", "n", "c", "sketch", "lists")]).groupBy("sig", "block") for df in (x, y))
    return gathered(x.cogroup(y).applyInPandas(run, "a long, b long"), rows)


def contracted(hot: DataFrame, turn: int) -> DataFrame:
    """(a, b), a < b: each member of long lists with one member of one of its lists, another list and member each turn."""
    rows = hot.count()
    own = hot.groupBy("rep").agg(F.min(F.struct(F.xxhash64("sig", F.lit(turn)).alias("h"), "sig"))["sig"].alias("sig"))
    middle = saved(gathered(hot.groupBy("sig").agg(F.min(F.struct(F.xxhash64("rep", "sig", F.lit(turn)).alias("h"), "rep"))["rep"].alias("other")), rows))
    met = gathered(own, rows).join(sized(middle), "sig").where("rep <> other")
    return met.select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b"))


def joined(nodes: DataFrame, some: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """nodes with the links among some pairs taken in; None where they join no components."""
    rows = some.count()
    links = saved(gathered(apart(verified(some, sets, percent), nodes).select(F.col("c_a").alias("u"), F.col("c_b").alias("v")), rows, 1000)) if rows else some
    if links.isEmpty():
        return None
    # components of components: few edges, whatever the number of classes
    above = connected_components(links, SMALL)
    changed = with_components(nodes, above, "component").select("node", F.col("c_component").alias("component"))
    new = above.join(nodes, above["node"] == nodes["node"], "left_anti")
    return sized(saved(gathered(changed.union(new), rows + nodes.count())))


def linked(pairs: DataFrame, hot: DataFrame, sets: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """(node, component) over all links among the candidate pairs(a, b) and the members of the long lists hot(sig, rep, n).

    Only links that join two components matter. At first each member of the long lists is compared with one other, twice:
    groups of near copies mostly become one component by that. Then each round takes pivots of each long list (one at first,
    16 times as many each round), of its components but the largest, and pairs them with the members of other components;
    it verifies, for every class, some of its candidates (one, then four times as many each round) and joins what is linked.
    Candidates inside a component go, and so do lists with one component, and pivots, which have met all of their list. So
    pairs are what is outside a list's largest component times the list, and the end is reached when no candidate and no
    list is left: then each pair of two components has been compared.
    """
    nodes = pairs.sparkSession.createDataFrame([], "node long, component long")
    if not hot.isEmpty():
        for turn in range(2):
            found = joined(nodes, saved(gathered(apart(contracted(hot, turn), nodes).select("a", "b"), hot.count())), sets, percent)
            nodes = nodes if found is None else found
    left, take, drawn, more = saved(apart(pairs, nodes).select("a", "b")), 1, 1, True
    sketches = sized(sketches, SMALL // 16)
    while True:
        if more:
            named = with_components(hot, nodes, "rep").withColumnRenamed("c_rep", "c")
            rows = named.count()
            by = gathered(named.groupBy("sig", "c").agg(F.count("*").alias("k")), rows)
            by = by.groupBy("sig").agg(F.max(F.struct("k", "c"))["c"].alias("largest"), F.count("*").alias("parts"), F.sum("k").alias("k"))
            by = saved(gathered(by.where("parts > 1").select("sig", "largest", F.ceil(F.col("k") / BLOCK).cast("int").alias("blocks")), rows))
            named = saved(gathered(named.join(sized(by), "sig"), rows))
            rows = named.count()
            more = rows > 0
        if more:
            # by class, so that lists with the same members have the same pivots
            draw = F.struct(F.xxhash64("rep").alias("h"), *[F.col(c) for c in ("rep", "n", "c", "blocks")])
            slot = F.pmod(F.xxhash64("rep", F.lit(drawn)), F.lit(drawn)).alias("slot")
            pivots = gathered(named.where("c <> largest").groupBy("sig", slot).agg(F.min(draw).alias("x")), rows)
            pivots = saved(pivots.select("sig", "x.rep", "x.n", "x.c", "x.blocks"))
            left = left.unionByName(pairs_with_pivots(named, pivots, sketches, percent)).distinct()
            left = saved(gathered(left, rows))
            hot = named.join(sized(pivots.select("sig", "rep")), ["sig", "rep"], "left_anti").select("sig", "rep", "n")
        rows = left.count()
        if not rows and not more:
            return nodes
        rank = F.expr("row_number() over (partition by b order by a)")
        some = left.withColumn("k", rank).where(F.col("k") <= take).select("a", "b") if take > 1 else left.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
        some = saved(gathered(some, rows))
        left, take, drawn = left.join(sized(some), ["a", "b"], "left_anti"), 4 * take, 16 * drawn
        found = joined(nodes, some, sets, percent)
        if found is not None:
            nodes, left = found, apart(left, found).select("a", "b")
        left = saved(gathered(left, rows))


def linked_classes(docs: DataFrame, every: DataFrame, classes: DataFrame, shingle: int, percent: int, frequent: int, long: int) -> DataFrame:
    """(node, component) of the classes(rep, n, d1, d2, first_id) that are linked with others; node and component are reps."""
    # of each class, one row of its first doc_id stands for it; sets too small for links with others stay out
    least = F.col("n") >= least_size(percent)
    rows = every.withColumnRenamed("row", "rep").where(least & F.col("doc_id").isNotNull())
    copies = saved(rows.select("rep").join(sized(classes.where(least).select("rep")), "rep", "left_anti"))
    reps = without(rows.select("rep", "doc_id", "d1", "n", "window"), "rep", copies)
    named, easy, hard = index_entries(docs, reps, shingle, percent, frequent)
    keys = lambda df: df.select(F.explode("prefix").alias("sig"), "rep", "n")
    entries = keys(easy.union(hard))
    # a list is long by its hard classes, for it has `frequent` easy ones at most
    counted = keys(hard).groupBy("sig").count().where(F.col("count") > long - frequent) if long >= frequent else entries
    long_sigs = entries.join(sized(saved(counted.select("sig").distinct())), "sig", "left_semi").groupBy("sig").count().where(F.col("count") > long)
    long_sigs = sized(saved(long_sigs.select("sig")))
    hot = saved(entries.join(long_sigs, "sig", "left_semi").select("sig", "rep", "n").distinct())
    numbers = easy.union(hard).select("rep", "n", "p", "last").join(sized(saved(hot.groupBy("rep").agg(F.count("*").alias("hot")))), "rep", "left")
    numbers = saved(numbers.withColumn("hot", F.coalesce("hot", F.lit(0))))
    pairs = saved(pairs_of_short_lists(entries.join(long_sigs, "sig", "left_anti"), numbers, percent))
    met = saved(pairs.select(F.explode(F.array("a", "b")).alias("rep")).union(hot.select("rep")).distinct())
    sets = saved(whole_sets(docs, saved(named.join(sized(met), "rep", "left_semi")), shingle))
    sketches = saved(rows.select("rep", "sketch").join(sized(saved(hot.select("rep").distinct())), "rep", "left_semi"))
    return linked(pairs, hot, sets, sketches, percent)


def jaccard_components(docs: DataFrame, shingle: int = 3, percent: int = 90, frequent: int = 24, long: int = 64) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of docs(doc_id, text).

    Rows are linked where the Jaccard similarity of their distinct word shingles is `percent` / 100 at least; component_id is
    the smallest doc_id that links lead to, the row's own included. Equal sets are linked as one class, not pair by
    pair. Null or wordless texts have no shingles and no links; with fewer words than a shingle has, the whole sequence
    is the one shingle. Rows that share a doc_id are rows of their own, each with the links of its own text. Rows without a
    doc_id are linked with their equals only: without such, component_id is null. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    key = ["n", "d1", "d2"]
    with scratch(docs.sparkSession) as keep:
        every = keep(shingled(docs, shingle, percent).withColumn("row", F.monotonically_increasing_id()))
        first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
        classes = every.where("n > 0").groupBy(*key).agg(first).select(*key, F.col("first.doc_id").alias("first_id"), F.col("first.row").alias("rep"))
        classes = saved(classes)
        nodes = linked_classes(docs, every, classes, shingle, percent, frequent, long)
        named = classes.join(nodes.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
        least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
        named = keep(named.join(least, "component").select(*key, "component_id"))
    same = [F.col(f"e.{k}") == F.col(f"k.{k}") for k in key]
    return every.alias("e").join(named.alias("k"), same, "left").select(
        "doc_id", F.col("e.n").cast("long").alias("n_shingles"), F.when(F.col("e.n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )
