"""Alignment of two tokenizers' tokens over the same bytes, and how often they are linked corpus-wide."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytetext import parts
from .tables import saved
from .tokenizer import byte_characters, encoder

#: Rows of counted pairs up to which they are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
WINDOW = 4096
PAIRS = "array<struct<pair:long,n:int>>"


class Aligned(NamedTuple):
    """A text's ids in A and B, and where their groups end: group k is a[at_a[k-1]:at_a[k]] beside b[at_b[k-1]:at_b[k]]."""

    a: np.ndarray
    b: np.ndarray
    at_a: np.ndarray
    at_b: np.ndarray

    def text(self, names: Sequence[str]) -> str:
        """The groups as a1,a2|b1;a3|b2,b3. names: each id followed by a comma, a bar and a semicolon, id by id."""
        a, b = self.a * 3, self.b * 3
        a[self.at_a - 1] += 1
        b[self.at_b - 1] += 2
        # in front of an A id stand the B ids of earlier groups, in front of a B id the A ids up to its own group
        earlier = np.repeat(np.append(0, self.at_b[:-1]), np.diff(self.at_a, prepend=0))
        own = np.repeat(self.at_a, np.diff(self.at_b, prepend=0))
        merged = np.empty(len(a) + len(b), np.int64)
        merged[np.arange(len(a)) + earlier] = a
        merged[np.arange(len(b)) + own] = b
        return "".join(picked(names, merged.tolist()))[:-1]

    def links(self) -> np.ndarray:
        """The linked id pairs, B id << 32 | A id. No token is empty, so that of a group's tokens the last ones end together, and no others."""
        return self.b[self.at_b - 1] << 32 | self.a[self.at_a - 1]


def groups_of(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> Aligned:
    """The groups of two id lists over the same bytes, size: the bytes of each id.

    The places where tokens end are the keys of two dictionaries (end -> index behind the token), made in ascending order;
    the common ones, in that order, cut both lists. An end meets its equal within one window of WINDOW bytes, so that
    dictionaries are made window by window and stay small.
    """
    ends_a, ends_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
    marks = np.arange(WINDOW, (ends_a[-1] if len(a) else 0) + WINDOW, WINDOW)
    cuts_a, cuts_b = (np.searchsorted(ends, marks, "right").tolist() for ends in (ends_a, ends_b))
    places, at_a, at_b, i, j = _places(WINDOW), [], [], 0, 0
    for p, q in zip(cuts_a, cuts_b):
        index_a, index_b = dict(zip(ends_a[i:p].tolist(), places)), dict(zip(ends_b[j:q].tolist(), places))
        common = list(filter(index_b.__contains__, index_a))
        at_a.append(np.fromiter(map(index_a.__getitem__, common), np.int64, len(common)) + i)
        at_b.append(np.fromiter(map(index_b.__getitem__, common), np.int64, len(common)) + j)
        i, j = p, q
    none = [np.zeros(0, np.int64)]
    return Aligned(a, b, np.concatenate(at_a or none), np.concatenate(at_b or none))


@lru_cache(maxsize=4)
def _places(n: int) -> list[int]:
    """1 to n, made once: a window of n bytes has no more tokens, since none is empty."""
    return list(range(1, n + 1))


def picked(table: Sequence, ids: list[int]) -> Sequence:
    """table[i] for each of ids."""
    return itemgetter(*ids)(table) if len(ids) > 1 else [table[i] for i in ids]


def id_names(n: int) -> list[str]:
    """What Aligned.text takes, for ids below n."""
    return [f"{i}{sign}" for i in range(n) for sign in ",|;"]


def byte_level_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary file; an added token stands for its own text."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters, added = byte_characters(), {x["id"]: x["content"] for x in spec["added_tokens"]}
    entries = {i: piece for piece, i in spec["model"]["vocab"].items()} | added
    return [entries[i].encode() if i in added else bytes(letters[c] for c in entries[i]) if i in entries else b"" for i in range(max(entries) + 1)]


def piece_tokens(model) -> list[bytes]:
    """The bytes of each id of a sentencepiece model: a byte piece is its byte, U+2581 a space."""
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> tuple[Callable[[str], Aligned | None], list[str]]:
    """(text -> its tokens, aligned; none where the text has no tokens: it is empty, or the bytes of either's tokens differ from space+text; names of all ids)."""
    import sentencepiece

    encode_a, model = encoder(a_path, special=False), sentencepiece.SentencePieceProcessor(model_file=b_path)
    bytes_a, bytes_b = byte_level_tokens(a_path), piece_tokens(model)
    size_a, size_b = (np.array(list(map(len, x)), np.int64) for x in (bytes_a, bytes_b))

    def align(text: str) -> Aligned | None:
        if not text:
            return None
        a, b, want = encode_a(f" {text}").astype(np.int64), model.encode(text), f" {text}".encode()
        if b"".join(picked(bytes_a, a.tolist())) != want or b"".join(picked(bytes_b, b)) != want:
            return None
        return groups_of(a, np.array(b, np.int64), size_a, size_b)

    return align, id_names(max(len(size_a), len(size_b)))


def aligned_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs), one row per row of docs(doc_id, text), in one pass without a shuffle.

    pairs: the distinct linked id pairs of the text (B id << 32 | A id) and how many of its links hold each.
    groups_sha256: of the groups as a1,a2|b1;a3|b2,b3. row: a number of its own for each row.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).withColumn("row", F.monotonically_increasing_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align, names = aligner(a_path, b_path)
        for b in parts(batches):
            counts, digests, pairs, times, bounds = [], [], [], [], [0]
            for text in b.column("text"):
                found = align(text.as_py() or "")
                counts.append((len(found.a), len(found.b), len(found.at_a)) if found else (0, 0, 0))
                digests.append(hashlib.sha256(found.text(names).encode()).hexdigest() if found else "")
                pair, n = np.unique(found.links() if found else np.zeros(0, np.int64), return_counts=True)
                pairs.append(pair)
                times.append(n)
                bounds.append(bounds[-1] + len(pair))
            n_a, n_b, n_groups = np.array(counts, np.int64).reshape(-1, 3).T
            flat = [pa.array(np.concatenate(x) if x else np.zeros(0), t) for x, t in ((pairs, pa.int64()), (times, pa.int32()))]
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(flat, ["pair", "n"]))
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), *map(pa.array, (n_a, n_b, n_groups, n_groups)), pa.array(digests, pa.string()), lists], ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"])

    return rows.mapInArrow(run, f"row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs {PAIRS}")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best) over all links: best says whether no other A id is linked with the B id more often. A row for each distinct pair."""
    counted = aligned.select(F.explode("pairs").alias("p")).groupBy(F.col("p.pair").alias("pair")).agg(F.sum(F.col("p.n").cast("long")).alias("count"))
    of_b = Window.partitionBy(F.shiftright("pair", 32))
    return counted.withColumn("best", F.col("count") == F.max("count").over(of_b))


def token_alignment(docs: DataFrame, a_path: str, b_path: str, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per row of docs(doc_id, text).

    A encodes space+text, B text (it adds the space), without special tokens; special strings inside texts are plain text.
    Places where tokens of both end cut the text's tokens into groups; a link is a pair of tokens that end together.
    n_best: links whose pair has the highest count, corpus-wide, of its B id, ties included; count_sum: those counts' sum.

    A null or empty text, and one whose tokens' bytes differ from space+text, has no tokens: zeros and an empty digest.
    Repeated rows stay and count each; a null doc_id stays; other columns are ignored; no rows: no rows. Texts are encoded
    whole, at any length. Links are saved once as distinct pairs of each text, then counted and looked up. The counted
    pairs, at most |A| x |B|, are broadcast up to broadcast_rows of them; more are joined by a shuffle, with equal results.
    """
    aligned = saved(aligned_documents(docs, a_path, b_path))
    counts = saved(pair_counts(aligned))
    small = counts.limit(broadcast_rows + 1).count() <= broadcast_rows
    links = aligned.select("row", F.explode("pairs").alias("p")).select("row", "p.pair", "p.n")
    met = links.join(F.broadcast(counts) if small else counts.hint("merge"), "pair")
    sums = met.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).cast("long").alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return aligned.drop("pairs").join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
