"""A hidden Markov language model: trained by Baum-Welch, with counts added up over all blocks of documents.

The states emit words: each of the most frequent words by itself; other words fall into classes by the hash of their last
bytes, and a class emits its words by their counts in the training texts, one more for words never seen. The probability of
a text is the sum over all state paths, by the scaled forward recursion; training takes expectations over whole texts.

Long texts are cut into windows that are worked on together. A window's transfer matrix, the product of its steps, carries
the forward variables from its first to its last token and the backward ones the other way, so that the windows' ends are
those of the recursion over the whole text, and no result depends on the cut.

Texts are tokenised once into blocks of local word numbers. A word's count, a sum over all blocks, comes back to each
block by a shuffle of the blocks' distinct words; no table of words goes to the driver or to all executors, but for the
bounded head.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import saved

BLOCK_TOKENS = 1 << 21
TAIL = 1024  # classes of words outside the head
WINDOW = 512  # tokens in a window
ROWS = 2048  # windows worked on together


@dataclass
class Model:
    """start: states; move: states x states; emit: states x classes."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def tail_class(word: bytes, head: int) -> int:
    return head + 1 + zlib.crc32(word[-3:]) % TAIL


def packed_ids(ids: np.ndarray) -> bytes:
    """int32 numbers as compressed bytes, the low bytes first: most numbers are small."""
    planes = np.ascontiguousarray(ids.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked_ids(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<i4").ravel()


def tokenised(docs: DataFrame) -> DataFrame:
    """A row per block of docs(doc_id, text, held_out): the documents and their numbers of words, the words' local ids one
    behind the other, and the distinct words with k, their count in the block's training texts.

    A block ends with BLOCK_TOKENS words or with its partition.
    """
    schema = pa.schema(
        [("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("size", pa.list_(pa.int32())), ("ids", pa.binary()), ("words", pa.list_(pa.binary())), ("k", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, total = TaskContext.get().partitionId(), 0, 0
        number: dict[bytes, int] = {}
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            ids = np.concatenate([r[2] for r in rows])
            learn = np.repeat([not r[1] for r in rows], [len(r[2]) for r in rows])
            k = np.bincount(ids[learn], minlength=len(number))
            columns = ([part * (1 << 32) + block], [[r[0] for r in rows]], [[r[1] for r in rows]], [[len(r[2]) for r in rows]], [packed_ids(ids)], [list(number)], [k])
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for b in batches:
            for doc, held, text in zip(b.column("doc_id").to_pylist(), b.column("held_out").to_pylist(), b.column("text")):
                words = (text.as_py() or "").encode().lower().split()
                get = number.setdefault
                rows.append((doc, held, np.fromiter((get(w, len(number)) for w in words), np.int32, len(words))))
                total += len(words)
                if total >= BLOCK_TOKENS:
                    yield flush()
                    number, rows, total, block = {}, [], 0, block + 1
        if rows:
            yield flush()

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, "block long, doc_ids array<long>, held array<boolean>, size array<int>, ids binary, words array<binary>, k array<long>")


def counted(blocks: DataFrame) -> DataFrame:
    """(block, id, word, c, first): every distinct word of every block with its count in all training texts; first: once for each word."""
    words = blocks.select("block", F.posexplode(F.arrays_zip("words", "k")).alias("id", "w")).select("block", "id", F.col("w.words").alias("word"), F.col("w.k").alias("k"))
    w = Window.partitionBy("word")
    return words.select("block", "id", "word", F.sum("k").over(w).alias("c"), (F.row_number().over(w.orderBy("block")) == 1).alias("first"))


def sequences(blocks: DataFrame, counts: DataFrame, head: list[bytes]) -> DataFrame:
    """(block, doc_ids, held, length, known, logs, classes): per block, arrays over its documents, and all their classes.

    known: tokens with a count; logs: log10(c + 1) summed over a document's tokens outside the head, and over those in it.
    The classes of a document end with that of the end token, the class number len(head).
    """
    rank = {w: i for i, w in enumerate(head)}
    held_head = blocks.sparkSession.sparkContext.broadcast(rank)

    def run(key: tuple, docs: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        rank, n = held_head.value, len(held_head.value)
        order = np.argsort(words["id"].to_numpy())
        c = words["c"].to_numpy()[order].astype(np.float64)
        names = words["word"].to_numpy()[order]
        cls = np.array([rank[w] if w in rank else tail_class(w, n) for w in map(bytes, names)], np.int16)
        log = np.log10(c + 1)
        inside = cls < n
        size = np.asarray(docs["size"].iloc[0], np.int64)
        ids = unpacked_ids(docs["ids"].iloc[0], int(size.sum()))
        text = np.repeat(np.arange(len(size)), size)
        sums = lambda x: np.bincount(text, x[ids] if len(ids) else None, len(size))
        # each document's classes, and behind them that of the end token
        classes = np.full(len(ids) + len(size), n, np.int16)
        classes[np.arange(len(ids)) + text] = cls[ids] if len(ids) else 0
        return pd.DataFrame(
            {
                "block": [key[0]],
                "doc_ids": [docs["doc_ids"].iloc[0]],
                "held": [docs["held"].iloc[0]],
                "length": [(size + 1).astype(np.int32)],
                "known": [sums((c > 0).astype(float)).astype(np.int32)],
                "tail_log": [sums(np.where(inside, 0, log))],
                "head_log": [sums(np.where(inside, log, 0))],
                "classes": [classes.tobytes()],
            }
        )

    schema = "block long, doc_ids array<long>, held array<boolean>, length array<int>, known array<int>, tail_log array<double>, head_log array<double>, classes binary"
    return blocks.select("block", "doc_ids", "held", "size", "ids").groupBy("block").cogroup(counts.select("block", "id", "word", "c").groupBy("block")).applyInPandas(run, schema)


def initial(states: int, weights: np.ndarray, seed: int = 7) -> Model:
    """A model near the class frequencies: states told apart by noise, and likely to stay."""
    r = np.random.default_rng(seed)
    noise = lambda *s: r.gamma(1.0, 1.0, s)
    norm = lambda x: x / x.sum(-1, keepdims=True)
    return Model(norm(noise(states)), norm(noise(states, states) + 3 * states * np.eye(states)), norm(noise(states, len(weights)) * weights))


@dataclass
class Windows:
    """Texts in windows, those of one text one behind the other; by them, `prior`: the states' distribution before the
    window's first token, `before`: that after the token before it, and `after`: the backward variables at its end."""

    classes: np.ndarray
    start: np.ndarray
    size: np.ndarray
    inner: np.ndarray
    text: np.ndarray
    prior: np.ndarray
    before: np.ndarray
    after: np.ndarray

    def batches(self) -> Iterator[tuple[np.ndarray, np.ndarray, list[int]]]:
        """(windows, their classes, the number of them with more than t tokens for each t), the longest first."""
        yield from _batches(self.classes, self.start, self.size, np.arange(len(self.size)))


def _batches(classes: np.ndarray, start: np.ndarray, size: np.ndarray, chosen: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, list[int]]]:
    chosen = chosen[np.argsort(-size[chosen], kind="stable")]
    for a in range(0, len(chosen), ROWS):
        some = chosen[a : a + ROWS]
        n = size[some]
        at = np.minimum(start[some][:, None] + np.arange(int(n[0])), len(classes) - 1)
        yield some, classes[at], [int(np.searchsorted(-n, -t, "left")) for t in range(int(n[0]))]


def windowed(model: Model, classes: np.ndarray, lengths: np.ndarray, window: int) -> Windows:
    """The windows of some texts, with the forward and backward variables of the whole texts at their ends."""
    s = len(model.start)
    n = -(-lengths // window)
    text = np.repeat(np.arange(len(lengths)), n)
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = (np.cumsum(lengths) - lengths)[text] + inner * window
    size = np.minimum(lengths[text] - inner * window, window)
    w = Windows(classes, start, size, inner, text, np.tile(model.start, (len(text), 1)), np.zeros((len(text), s)), np.ones((len(text), s)))
    many = np.flatnonzero(n[text] > 1)
    if not len(many):
        return w
    emit = np.ascontiguousarray(model.emit.T)
    transfer = np.zeros((len(text), s, s))
    for some, x, alive in _batches(classes, start, size, many):
        # from the states of the token before the window (for a text's first, of its first token) to those of its last
        m = np.where((inner[some] == 0)[:, None, None], np.eye(s), model.move) * emit[x[:, 0]][:, None, :]
        for t in range(1, x.shape[1]):
            k = alive[t]
            m[:k] = (m[:k].reshape(-1, s) @ model.move).reshape(k, s, s) * emit[x[:k, t]][:, None, :]
            if t % 8 == 0:
                m[:k] /= m[:k].max((1, 2), keepdims=True)
        transfer[some] = m / m.max((1, 2), keepdims=True)
    first, last = np.cumsum(n) - n, np.cumsum(n) - 1
    for k in range(1, int(n.max())):
        at = first[n > k] + k
        a = np.einsum("bi,bij->bj", w.before[at - 1] if k > 1 else np.broadcast_to(model.start, (len(at), s)), transfer[at - 1])
        w.before[at] = a / a.sum(1, keepdims=True)
        w.prior[at] = w.before[at] @ model.move
        at = last[n > k] - k
        b = np.einsum("bij,bj->bi", transfer[at + 1], w.after[at + 1])
        w.after[at] = b / b.sum(1, keepdims=True)
    return w


def expectations(model: Model, classes: np.ndarray, lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, moves and emissions over some whole texts, and their log likelihood (natural), by scaled forward-backward."""
    s, k = model.emit.shape
    starts, moves, emits, total = np.zeros(s), np.zeros((s, s)), np.zeros((k, s)), 0.0
    move = model.move.astype(np.float32)
    emit = np.ascontiguousarray(model.emit.T, np.float32)
    w = windowed(model, classes, lengths, window)
    for some, x, alive in w.batches():
        begins = w.inner[some] == 0
        alpha, scale = [], []
        for t, m in enumerate(alive):
            f = (w.prior[some].astype(np.float32) if t == 0 else alpha[-1][:m] @ move) * emit[x[:m, t]]
            c = f.sum(1, keepdims=True)
            alpha.append(f / c)
            scale.append(c)
            total += float(np.log(c).sum())
        ends = w.after[some].astype(np.float32)
        beta = np.zeros((0, s), np.float32)
        gammas, columns = [], []
        for t in range(len(alive) - 1, -1, -1):
            if len(beta) < alive[t]:  # windows that end here; alpha times beta sums to 1 from here on
                new = ends[len(beta) : alive[t]]
                beta = np.concatenate([beta, new / (alpha[t][len(beta) :] * new).sum(1, keepdims=True)])
            column = x[: alive[t], t]
            gammas.append(alpha[t] * beta)
            columns.append(column)
            right = emit[column] * beta / scale[t]
            if t == 0:
                starts += gammas[-1][begins].sum(0)
                moves += move * (w.before[some][~begins].astype(np.float32).T @ right[~begins])
                break
            moves += move * (alpha[t - 1][: alive[t]].T @ right)
            beta = right @ move.T
        column = np.concatenate(columns)
        gamma = np.concatenate(gammas)
        for i in range(s):
            emits[:, i] += np.bincount(column, gamma[:, i], k)
    return starts, moves, emits, total


def likelihoods(model: Model, classes: np.ndarray, lengths: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The exact log10 likelihood of each text's whole class sequence, by the scaled forward recursion."""
    emit = np.ascontiguousarray(model.emit.T)
    w = windowed(model, classes, lengths, window)
    out = np.zeros(len(w.size))
    for some, x, alive in w.batches():
        alpha, log = w.prior[some], np.zeros(len(some))
        for t, m in enumerate(alive):
            f = (alpha if t == 0 else alpha[:m] @ model.move) * emit[x[:m, t]]
            c = f.sum(1)
            log[:m] += np.log10(c)
            alpha = f / c[:, None]
        out[some] = log
    return np.bincount(w.text, out, len(lengths))


def trained(blocks: DataFrame, n_classes: int, weights: np.ndarray, states: int, rounds: int) -> Model:
    """Baum-Welch: each round a pass over all blocks, whose expected counts are summed by Spark; the driver gets one table of states x classes."""
    model = initial(states, weights)
    context = blocks.sparkSession.sparkContext
    names = [f"s{i}" for i in range(states)]
    schema = ", ".join(["j int", *[f"{c} double" for c in names]])
    for _ in range(rounds):
        held = context.broadcast(model)

        def run(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            m = held.value
            total = np.zeros((1 + states + n_classes, states))
            for b in batches:
                for classes, lengths, out in zip(b["classes"], b["length"], b["held"]):
                    x, n, learn = np.frombuffer(classes, np.int16), np.asarray(lengths, np.int64), ~np.asarray(out, bool)
                    if learn.any():
                        starts, moves, emits, _ = expectations(m, x[np.repeat(learn, n)], n[learn])
                        total += np.vstack([starts, moves.T, emits])
            some = np.flatnonzero(total.any(1))
            yield pd.DataFrame({"j": some} | {c: total[some, i] for i, c in enumerate(names)})

        table = np.zeros((1 + states + n_classes, states))
        for r in blocks.mapInPandas(run, schema).groupBy("j").agg(*[F.sum(c).alias(c) for c in names]).collect():
            table[r["j"]] = r[1:]
        held.destroy()
        starts, moves, emits = table[0] + 1e-3, table[1 : 1 + states].T + 1e-3, table[1 + states :].T + 1e-2 * weights
        model = Model(starts / starts.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(1, keepdims=True))
    return model


def text_scores(docs: DataFrame, states: int = 6, rounds: int = 7, head_words: int = 8192) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row of docs(doc_id, text, held_out).

    Words are bytes other than white space, A-Z lower-cased; each text ends with one end token. The model learns from the
    texts that aren't held out. base_score: log10 of the smoothed unigram probability; score: the model's log10
    probability of the text, tokens never seen in training counting as one further word of their class.

    Null text is empty: the end token alone. Nothing to learn from: every class is as likely. Repeated rows stay, null
    ids too; other columns are ignored. Words are taken whole, however long.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce("held_out", F.lit(False)).alias("held_out"))
    blocks = saved(tokenised(docs))
    counts = saved(counted(blocks))
    n_learn = blocks.agg(F.coalesce(F.sum(F.size(F.filter("held", lambda h: ~h))), F.lit(0))).first()[0]
    total, distinct = counts.where("first and c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    end_kinds = 1 if n_learn else 0
    n_all, v_all = total + n_learn, distinct + end_kinds
    top = counts.where("first and c > 0").orderBy(F.desc("c"), "word").select("word", "c").limit(head_words).collect()
    head = [bytes(r["word"]) for r in top]
    n = len(head)
    known_tail = counts.where("first and c > 0").select("word", "c").mapInPandas(lambda bs: _class_sums(bs, set(head), n), "class int, c long, v long")
    sums = {r["class"]: (r["c"], r["v"]) for r in known_tail.groupBy("class").agg(F.sum("c").alias("c"), F.sum("v").alias("v")).collect()}
    n_classes = n + 1 + TAIL
    weights = np.ones(n_classes)
    weights[:n] += [r["c"] for r in top]
    weights[n] += n_learn
    # of a tail class, words seen have c + 1 and those never seen together 1
    room = np.ones(n_classes)
    for k, (c, v) in sums.items():
        weights[k] += c
        room[k] = c + v + 1
    weights /= weights.sum()
    encoded = saved(sequences(blocks, counts, head))
    model = trained(encoded, n_classes, weights, states, rounds)
    held = docs.sparkSession.sparkContext.broadcast((model, np.log10(room)))
    log_all, log_end = float(np.log10(n_all + v_all + 1)), float(np.log10(n_learn + 1))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, log_room = held.value
        for b in batches:
            for r in b.itertuples():
                classes, length = np.frombuffer(r.classes, np.int16), np.asarray(r.length, np.int64)
                first = np.cumsum(length) - length
                score = likelihoods(model, classes, length) - np.add.reduceat(log_room[classes], first) + np.asarray(r.tail_log)
                base = np.asarray(r.tail_log) + np.asarray(r.head_log) + log_end - length * log_all
                known = np.asarray(r.known, np.int64) + (1 if n_learn else 0)
                yield pd.DataFrame({"doc_id": pd.array(r.doc_ids, "Int64"), "held_out": r.held, "n_tokens": length, "n_known": known, "train_tokens": n_all, "base_score": base, "score": score})

    return encoded.mapInPandas(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _class_sums(batches: Iterator[pd.DataFrame], head: set[bytes], n: int) -> Iterator[pd.DataFrame]:
    """(class, tokens, distinct words) of the words outside the head, a row for each class and batch."""
    for b in batches:
        c = np.zeros((n + 1 + TAIL, 2), np.int64)
        for w, k in zip(map(bytes, b["word"]), b["c"]):
            if w not in head:
                c[tail_class(w, n)] += (k, 1)
        some = np.flatnonzero(c[:, 1])
        yield pd.DataFrame({"class": some, "c": c[some, 0], "v": c[some, 1]})
