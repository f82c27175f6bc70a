"""Approximate nearest neighbours by inner product: robust-pruned directed graphs, one per shard, searched by beams.

A shard's vectors are dealt to graphs by ranges of length. In a graph they get one more component that gives all the same
length; inner products with a query then order them as distances do, and the graph can be built by distance. A point's neighbours are proposed by a greedy search of the graph so
far and pruned: a candidate goes if one kept before is nearer to it, by the factor alpha, than the point itself is. Every
query is searched in every shard, and the shards' best are merged with scores in double precision.

Graphs are built once, a task each, and saved; searches are dealt by shard and block of queries.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import saved

SHARDS = 8  # as long as SHARD_BYTES allows it
SHARD_BYTES = 128 << 20  # of vectors in single precision in one graph
RATIO = 1.2  # of the longest to the shortest vector of a graph; a shard has a graph for each such range
PIECE_BYTES = 4 << 20  # of a saved graph in one row


class Graph:
    """A graph over the rows of x. Batches of points are searched, pruned and linked together, as matrices."""

    def __init__(self, x: np.ndarray, degree: int = 40, beam: int = 64, alpha: float = 1.1, batch: int = 256):
        most = float(np.abs(x).max()) if x.size else 1.0
        unit = (x / most).astype(np.float32)  # no squares overflow
        norms = np.sqrt((unit.astype(np.float64) ** 2).sum(1))
        top = norms.max() if len(x) else 1.0
        extra = np.sqrt(np.maximum(top**2 - norms**2, 0))
        self.x = (np.hstack([unit, extra[:, None]]) / (top or 1.0)).astype(np.float32)
        self.degree, self.beam, self.alpha = degree, beam, alpha
        n = len(x)
        self.links = np.full((n, degree), -1, np.int32)
        self.count = np.zeros(n, np.int32)
        self.entries = np.arange(min(n, 1))
        at = 1
        while at < n:
            stop = min(n, at + min(batch, at))
            self._insert(np.arange(at, stop))
            at = stop
            self.entries = np.arange(min(at, 16))
        # the first points were placed when there were few others
        for at in range(0, min(n, 4 * batch), batch):
            self._insert(np.arange(at, min(n, at + batch)))

    def _insert(self, points: np.ndarray) -> None:
        """Links points with what a greedy search finds for them, and with what they are linked with already."""
        found, score = self.search(self.x[points], self.beam)
        own = self.links[points]
        if (own >= 0).any():
            more = np.where((own >= 0) & ~(own[:, :, None] == found[:, None, :]).any(2), own, -1)
            s = np.where(more >= 0, np.einsum("bkd,bd->bk", self.x[more], self.x[points]), -np.inf)
            found, score = np.hstack([found, more]), np.hstack([score, s])
            by = np.argsort(-score, axis=1, kind="stable")
            found, score = np.take_along_axis(found, by, 1), np.take_along_axis(score, by, 1)
        self._connect(points, found, score)

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the beam of each query, best first; -1 and -inf where there are fewer."""
        b = len(q)
        ids = np.full((b, beam), -1, np.int32)
        score = np.full((b, beam), -np.inf, np.float32)
        e = self.entries[:beam]
        ids[:, : len(e)] = e
        score[:, : len(e)] = q @ self.x[e].T
        done = np.zeros((b, beam), bool)
        active = np.arange(b)
        while len(active):
            a_ids, a_score, a_done = ids[active], score[active], done[active]
            open_ = np.where(a_done | (a_ids < 0), -np.inf, a_score)
            pick = np.argpartition(-open_, 1, axis=1)[:, :2] if beam > 2 else np.argmax(open_, 1)[:, None]
            some = np.take_along_axis(open_, pick, 1) > -np.inf
            go = some.any(1)
            if not go.all():
                active, a_ids, a_score, a_done, pick, some = active[go], a_ids[go], a_score[go], a_done[go], pick[go], some[go]
                if not len(active):
                    break
            rows = np.arange(len(active))[:, None]
            a_done[rows, pick] |= some
            at = np.where(some, a_ids[rows, pick], -1)
            near = np.where((at >= 0)[:, :, None], self.links[at], -1).reshape(len(active), -1)
            s = np.einsum("bkd,bd->bk", self.x[near], q[active])
            s[near < 0] = -np.inf
            all_ids = np.concatenate([a_ids, near], 1)
            all_score = np.concatenate([a_score, s], 1)
            all_done = np.concatenate([a_done, np.zeros(near.shape, bool)], 1)
            by = np.argsort(all_ids * 2 + ~all_done, axis=1, kind="stable")
            sorted_ids = np.take_along_axis(all_ids, by, 1)
            again = np.zeros(sorted_ids.shape, bool)
            again[:, 1:] = sorted_ids[:, 1:] == sorted_ids[:, :-1]
            sorted_score = np.where(again, -np.inf, np.take_along_axis(all_score, by, 1))
            best = np.argsort(-sorted_score, axis=1, kind="stable")[:, :beam]
            new_score = np.take_along_axis(sorted_score, best, 1)
            ids[active] = np.where(np.isinf(new_score), -1, np.take_along_axis(sorted_ids, best, 1))
            score[active] = new_score
            done[active] = np.take_along_axis(np.take_along_axis(all_done, by, 1), best, 1)
        return ids, score

    def _prune(self, points: np.ndarray, candidates: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Up to `degree` of each point's candidates (best first): each farther from those kept before than from the point, by alpha."""
        out = np.full((len(points), self.degree), -1, np.int32)
        score = np.where(np.isinf(score), -9, score)
        v = self.x[candidates]
        length = 2 * float((self.x[0] ** 2).sum())
        own = np.maximum(length - 2 * score, 0)
        between = np.maximum(length - 2 * np.einsum("bid,bjd->bij", v, v), 0)
        alive = (candidates >= 0) & (candidates != points[:, None])
        rows = np.arange(len(points))
        for k in range(self.degree):
            some = alive.any(1)
            if not some.any():
                break
            pick = alive.argmax(1)
            out[some, k] = candidates[rows, pick][some]
            alive[rows, pick] = False
            alive &= ~((self.alpha**2 * between[rows, pick] <= own) & some[:, None])
        return out

    def _connect(self, points: np.ndarray, candidates: np.ndarray, score: np.ndarray) -> None:
        for at in range(0, len(points), 256):
            p = points[at : at + 256]
            kept = self._prune(p, candidates[at : at + 256], score[at : at + 256])
            self.links[p] = kept
            self.count[p] = (kept >= 0).sum(1)
        source, k = np.nonzero(self.links[points] >= 0)
        target, source = self.links[points][source, k], points[source]
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        new = ~(self.links[target] == source[:, None]).any(1)
        target, source = target[new], source[new]
        if not len(target):
            return
        rank = np.arange(len(target)) - np.searchsorted(target, target)
        place = self.count[target] + rank
        fits = place < self.degree
        self.links[target[fits], place[fits]] = source[fits]
        np.add.at(self.count, target[fits], 1)
        target, source, rank = target[~fits], source[~fits], rank[~fits]
        if not len(target):
            return
        full, group = np.unique(target, return_inverse=True)
        rank = np.arange(len(target)) - np.searchsorted(target, target)
        more = np.full((len(full), int(rank.max()) + 1), -1, np.int32)  # no wider than a batch
        more[group, rank] = source
        step = max(1, (1 << 22) // (self.degree + more.shape[1]) ** 2)
        for at in range(0, len(full), step):
            p = full[at : at + step]
            c = np.concatenate([self.links[p], more[at : at + step]], 1)
            s = np.einsum("bkd,bd->bk", self.x[c], self.x[p])
            s[c < 0] = -np.inf
            by = np.argsort(-s, axis=1, kind="stable")
            self.links[p] = self._prune(p, np.take_along_axis(c, by, 1), np.take_along_axis(s, by, 1))
            self.count[p] = (self.links[p] >= 0).sum(1)


def by_length(x: np.ndarray) -> list[tuple[float, np.ndarray]]:
    """(greatest length, rows) of the rows of x by ranges of length, longest first; lengths in a range differ by less than RATIO.

    So the component that makes lengths equal stays small beside the others, whatever the lengths of all are.
    """
    most = np.abs(x).max(1).astype(np.float64)
    unit = np.sqrt(((x / most[:, None]) ** 2).sum(1, dtype=np.float64))
    size = np.log(most) + np.log(unit)  # a length may be beyond what a number can hold
    number = np.floor((size - size.max()) / math.log(RATIO) + 1e-9).astype(np.int64)
    with np.errstate(over="ignore"):
        length = most * unit
    return [(float(length[rows].max()), rows) for rows in (np.flatnonzero(number == k) for k in np.unique(number)[::-1])]


def shard_count(vectors: int, numbers: int) -> int:
    """SHARDS graphs, so that searches are as many for each query whatever the input, until they would exceed SHARD_BYTES."""
    return max(min(SHARDS, vectors), ceil(4 * numbers / SHARD_BYTES), 1)


def runs_of(b: pa.RecordBatch, columns: list[str]) -> Iterator[tuple[tuple[int, ...], pa.RecordBatch]]:
    """The parts of a sorted batch with equal columns, of whole numbers."""
    if not b.num_rows:
        return
    key = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in columns], 1)
    cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist(), b.num_rows]
    for a, z in zip(cuts, cuts[1:]):
        yield tuple(key[a].tolist()), b.slice(a, z - a)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def equal_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(dim, id, embedding, members): a row for each different vector, with its k + 1 smallest ids, of which id is the first.

    Vectors are equal by a digest of 128 bits. Of a large group of copies each task passes on no more than these ids.
    """
    keyed = rows.withColumn("h1", F.xxhash64("embedding")).withColumn("h2", F.xxhash64(F.lit(7), "embedding"))
    rank = F.dense_rank().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))
    first = keyed.withColumn("k", rank).where(F.col("k") <= k + 1)
    by = first.groupBy("h1", "h2").agg(F.min_by("embedding", "vec_id").alias("embedding"), F.sort_array(F.collect_set("vec_id")).alias("members"))
    return by.select(F.size("embedding").alias("dim"), F.element_at("members", 1).alias("id"), "embedding", "members")


def graphs(nodes: DataFrame, shards: int) -> DataFrame:
    """(dim, shard, seq, piece): the graph of each shard of nodes(dim, id, embedding, members), its vectors and ids, pickled in pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None
        held: list[np.ndarray] = []
        members: list[pa.Array] = []

        def built() -> Iterator[pa.RecordBatch]:
            x = np.concatenate(held)
            ids = pa.concat_arrays(members)
            ranges = []
            for longest, rows in by_length(x):
                graph = Graph(x[rows])
                ranges.append({"longest": longest, "rows": rows.astype(np.int32), "links": graph.links, "entries": graph.entries, "points": graph.x})
            body = pickle.dumps({"x": x, "ranges": ranges, "at": np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())]), "ids": ids.flatten().to_numpy()})
            for seq, at in enumerate(range(0, len(body), PIECE_BYTES)):
                yield pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()), pa.array([seq], pa.int32()), pa.array([body[at : at + PIECE_BYTES]], pa.binary())], ["dim", "shard", "seq", "piece"])

        for b in batches:
            for key, part in runs_of(b, ["dim", "shard"]):
                if key != now and held:
                    yield from built()
                    held, members = [], []
                now = key
                held.append(matrix(part.column("embedding"), key[0]))
                members.append(part.column("members"))
        if held:
            yield from built()

    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")).repartition(2 * shards, "dim", "shard").sortWithinPartitions("dim", "shard", F.xxhash64("id", F.lit(1)))
    return dealt.select("dim", "shard", "embedding", "members").mapInArrow(run, "dim int, shard int, seq int, piece binary")


def searched(shard: dict, q: np.ndarray, ids: list[int], k: int, beam: int) -> Iterator[tuple[int, int, float]]:
    """(query_id, vec_id, score): the k best of a shard for each query, of those its beams have found.

    Ranges of length are searched from the longest on; a query leaves out those that can't reach what it has found.
    """
    graph = Graph.__new__(Graph)
    for at in range(0, len(q), 256):
        some = q[at : at + 256].astype(np.float64)
        most = np.abs(some).max(1, keepdims=True)
        unit = some / most
        length = np.linalg.norm(unit, axis=1, keepdims=True)
        with np.errstate(over="ignore"):
            unit, length = np.hstack([unit / length, np.zeros((len(some), 1))]).astype(np.float32), (length * most)[:, 0]
        best, score = np.full((len(some), k + 1), -1, np.int64), np.full((len(some), k + 1), -np.inf)
        for r in shard["ranges"]:
            graph.x, graph.links, graph.entries = r["points"], r["links"], r["entries"]
            go = np.flatnonzero(~(r["longest"] * length * (1 + 1e-9) < score[:, k]))
            if not len(go):
                continue
            found, _ = graph.search(unit[go], beam)
            rows = np.where(found >= 0, r["rows"][found], -1)
            exact = np.where(rows >= 0, np.einsum("bkd,bd->bk", shard["x"][rows].astype(np.float64), some[go]), -np.inf)
            rows, exact = np.hstack([best[go], rows]), np.hstack([score[go], exact])
            by = np.argsort(-exact, axis=1, kind="stable")[:, : k + 1]
            best[go], score[go] = np.take_along_axis(rows, by, 1), np.take_along_axis(exact, by, 1)
        for i, row in enumerate(best):
            me = ids[at + i]
            all_ = sorted((-score[i, j], m) for j, v in enumerate(row) if v >= 0 for m in shard["ids"][shard["at"][v] : shard["at"][v + 1]].tolist() if m != me)
            yield from ((me, m, -s) for s, m in all_[:k])


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, beam: int = 96, shards: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k vectors of the largest inner product that were found.

    vectors and queries: (vec_id, embedding). A query isn't its own neighbour. Scores are inner products of the original
    vectors in double precision; ties go to the smaller vec_id. Vectors that are null, zero, or hold null or non-finite
    components, and rows without vec_id, take no part; vectors of other lengths aren't compared. Equal vectors are one node
    of a graph, with their k + 1 smallest ids, which is all that a result can show; nothing is lost to large groups of
    copies. A vec_id with other vectors is a candidate with each. Fewer than k candidates: all of them. Other columns are
    ignored; an empty table gives no rows.

    A shard's graphs and vectors are what a task holds, bounded by SHARD_BYTES. Each graph goes to one task for every block of
    queries, of which there are as many as a graph has points, so that searching takes a task about as long as building.
    """
    proper = "vec_id is not null and embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(embedding, x -> x <> 0)"
    rows = vectors.where(proper).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    wanted = queries.where(proper).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    n, numbers = vectors.agg(F.count("*"), F.coalesce(F.sum(F.size("embedding")), F.lit(0))).first()
    p = shards or shard_count(n, numbers)
    built = saved(graphs(equal_vectors(rows, k), p))
    blocks = max(1, ceil(queries.count() / max(4096, n // p)))
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    kept = built.select("dim", "shard", every(blocks).alias("block"), F.lit(0).alias("kind"), "seq", "piece", F.lit(None).cast("long").alias("id"), F.lit(None).cast(dict(wanted.dtypes)["embedding"]).alias("embedding"))
    block = F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)).cast("int").alias("block")
    asked = wanted.select(F.size("embedding").alias("dim"), every(p).alias("shard"), block, F.lit(1).alias("kind"), F.lit(0).alias("seq"), F.lit(None).cast("binary").alias("piece"), F.col("vec_id").alias("id"), "embedding")
    dealt = kept.union(asked).repartition(2 * p * blocks, "dim", "shard", "block").sortWithinPartitions("dim", "shard", "block", "kind", "seq")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, pieces, shard = None, [], None
        for b in batches:
            for (dim, number, at, kind), part in runs_of(b, ["dim", "shard", "block", "kind"]):
                if (dim, number, at) != now:
                    now, pieces, shard = (dim, number, at), [], None
                if kind == 0:
                    pieces += part.column("piece").to_pylist()
                    continue
                if pieces:
                    shard, pieces = pickle.loads(b"".join(pieces)), []
                if shard is None:
                    continue
                out = list(searched(shard, matrix(part.column("embedding"), dim), part.column("id").to_pylist(), k, beam))
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], ["query_id", "vec_id", "score"])

    found = dealt.mapInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
