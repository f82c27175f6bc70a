"""Best-two-fit packing of documents into sequences of bounded length.

Pieces of equal length are interchangeable, so the packing rule itself needs only how many pieces there are of each
length: at most `capacity` numbers. Spark cuts and encodes the documents, counts the lengths, ranks the pieces within
their length, and joins the ranks with the plan of the rule; no piece ever goes through the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytetext import parts
from .tables import saved
from .tokenizer import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLAN = "length long, low long, high long, uses long, sequence long, offset long"


def cut(ids: np.ndarray, capacity: int) -> list[tuple[int, np.ndarray]]:
    """(start, ids) of the pieces: whole ones of `capacity`, but for the first, which holds the remainder."""
    first = (len(ids) - 1) % capacity + 1
    starts = [0, *range(first, len(ids), capacity)]
    return [(a, ids[a:b]) for a, b in zip(starts, [*starts[1:], len(ids)])]


def encoded_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """PIECES of every document: its ids and then end_id, cut where they exceed the capacity. Null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        end = np.array([end_id], "<u4")
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        for b in parts(batches):
            rows = [
                (doc.as_py(), k, start, len(ids), zlib.crc32(ids.tobytes()))
                for doc, text in zip(b.column("doc_id"), b.column("text"))
                for k, (start, ids) in enumerate(cut(np.concatenate([encode(text.as_py()).astype("<u4"), end]), capacity))
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text")).mapInArrow(run, PIECES)


def best_two_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(how many sequences, {length: pieces of it in each}) for a multiset of piece lengths.

    A sequence is opened with the longest piece left and filled greedily with the longest that still fits. Then its
    smallest piece is taken out again where two pieces not yet packed fit the widened gap more tightly. The choice
    depends only on which lengths are left, so equal sequences are made together: as many as the counts allow.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out = []
    while (open_ := np.flatnonzero(left)).size:
        used: dict[int, int] = {}
        room = capacity

        def take(length: int, n: int = 1) -> None:
            used[length] = used.get(length, 0) + n
            left[length] -= n

        while room and (fits := np.flatnonzero(left[: room + 1])).size:
            n = min(int(left[fits[-1]]), room // int(fits[-1]))
            take(int(fits[-1]), n)
            room -= int(fits[-1]) * n
        smallest = min(used)
        if room and len(used) + max(used.values()) > 2:
            gap = room + smallest
            have = np.flatnonzero(left[:gap])
            if have.size:
                # for each a, the largest b <= gap - a; the pair must fill more than the smallest piece did
                b = have[np.maximum(np.searchsorted(have, gap - have, "right") - 1, 0)]
                ok = (have + b <= gap) & ((have != b) | (left[have] > 1)) & (have + b > smallest)
                if ok.any():
                    k = int(np.argmax(np.where(ok, have + b, -1)))
                    used[smallest] -= 1
                    left[smallest] += 1
                    if not used[smallest]:
                        del used[smallest]
                    take(int(have[k]))
                    take(int(b[k]))
        more = min(int(left[length]) // n for length, n in used.items())
        for length, n in used.items():
            left[length] -= n * more
        out.append((1 + more, used))
    return out


def sequence_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows of PLAN: pieces of `length` with ranks low <= rank < high go, `uses` to a sequence, to sequences from `sequence` on, from `offset` on."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for times, used in best_two_fit(counts, capacity):
        offset = 0
        for length in sorted(used, reverse=True):
            low = rank.get(length, 0)
            rank[length] = low + times * used[length]
            rows.append((length, low, rank[length], used[length], sequence, offset))
            offset += length * used[length]
        sequence += times
    return rows


def packed(pieces: DataFrame, capacity: int = 1024, per_bucket: int = 1 << 16) -> DataFrame:
    """pieces(doc_id, piece, length, ...) with sequence_id and offset.

    Ranks within a length are dealt over hash buckets of the pieces' ids, about `per_bucket` pieces in each, so that no
    window grows with the input, also where a third of the pieces have one length. The plan goes to the driver as at most
    `capacity` counts and back as the rows of PLAN; each greedy step halves a count at least, so there are at most
    capacity x log2(pieces) sequences of different make.

    Lengths must lie between 1 and the capacity. Ties in length go by id and piece; (doc_id, piece) should be unique, for
    repeated rows get places of their own in either order. No pieces: no rows.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = spark.createDataFrame(sequence_plan(counts, capacity), PLAN)
    buckets = spark.createDataFrame([(k, -(-n // per_bucket)) for k, n in counts.items()], "length long, buckets int")
    keyed = pieces.join(F.broadcast(buckets), "length").withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.col("buckets")).cast("int")).drop("buckets")
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = keyed.groupBy("length", "bucket").count().select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    inner = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece"))
    ranked = keyed.withColumn("inner", inner).join(offsets, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("inner") - 1)
    p = F.broadcast(plan).alias("p")
    place = F.col("rank") - F.col("low")
    return (
        ranked.alias("r")
        .join(p, (F.col("r.length") == F.col("p.length")) & F.col("rank").between(F.col("low"), F.col("high") - 1))
        .select(
            *[f"r.{c}" for c in pieces.columns],
            (F.col("sequence") + F.floor(place / F.col("uses"))).cast("long").alias("sequence_id"),
            (F.col("offset") + place % F.col("uses") * F.col("r.length")).cast("long").alias("offset"),
        )
    )


def packed_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece of every row of docs(doc_id, text).

    The sequence's content isn't moved: its pieces are named by document, start and length, with a checksum of their ids.
    Null and empty texts are the end id alone. Repeated doc_ids are packed each for itself; other columns are ignored.
    """
    return packed(saved(encoded_pieces(docs, tokenizer_path, capacity, end_id)), capacity)
