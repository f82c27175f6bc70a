"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1; the vector of an n-gram is the product of its letters' vectors, each
rotated by its place; a text's profile is the sum of its n-grams' vectors, a language's prototype the sum over its texts.
A text gets the language whose prototype has the largest cosine with its profile.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytetext import parts

N = 3
SLICE_CHARS = 1 << 18


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point, itself if it's a letter, else 0."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if unicodedata.category(chr(c))[0] == "L":
            table[c] = c
    return table


class Space:
    """The random vectors, made from the code point alone, so that every task has the same ones."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions
        self.number: dict[int, int] = {}
        self.rows = np.zeros((0, dimensions), np.float32)

    def letter(self, codes: np.ndarray) -> np.ndarray:
        """The row of each code's vector."""
        new = [int(c) for c in codes if int(c) not in self.number]
        if len(self.rows) + len(new) > 8192:  # scripts with very many letters: begin anew, so that memory stays bounded
            self.number, self.rows, new = {}, self.rows[:0], [int(c) for c in codes]
        if new:
            made = [np.random.default_rng([7, c]).integers(0, 2, self.dimensions).astype(np.float32) * 2 - 1 for c in new]
            self.number |= {c: len(self.rows) + i for i, c in enumerate(new)}
            self.rows = np.concatenate([self.rows, made])
        return np.array([self.number[int(c)] for c in codes], np.int64)

    def grams(self, codes: np.ndarray) -> np.ndarray:
        """codes: k x N code points; the k vectors."""
        unique, place = np.unique(codes, return_inverse=True)
        row = self.letter(unique)[place.reshape(codes.shape)]
        out = self.rows[row[:, 0]].copy()
        for i in range(1, codes.shape[1]):
            out *= np.roll(self.rows[row[:, i]], i, axis=1)
        return out


def profiles_of(counts: np.ndarray, grams: np.ndarray, space: Space, most: int = 2048) -> np.ndarray:
    """counts (texts x grams) times the grams' vectors, which are made a few at a time."""
    out = np.zeros((len(counts), space.dimensions), np.float32)
    for at in range(0, len(grams), most):
        out += counts[:, at : at + most] @ space.grams(grams[at : at + most])
    return out


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(counts, grams, letters): texts x grams counts, the grams' code points, and the number of letters of each text.

    Runs of anything but letters count as one space, code point 0; each text has a space at either end.
    """
    lowered = [t.lower() for t in texts]
    joined = "".join(f"\0{t}\0" for t in lowered)
    points = letters()[np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)]
    # by length, for a text may itself hold \0
    ends = np.cumsum([len(t) + 2 for t in lowered])
    starts = np.concatenate([[0], ends[:-1]])
    owner = np.repeat(np.arange(len(texts)), ends - starts)
    solid = points != 0
    n_letters = np.bincount(owner[solid], minlength=len(texts))
    keep = solid.copy()
    keep[1:] |= solid[:-1]
    keep[0] = True
    keep[starts] = True
    points, owner = points[keep], owner[keep]
    present, small = np.unique(points, return_inverse=True)
    k = len(present)
    if len(points) < N:
        return np.zeros((len(texts), 0), np.float32), np.zeros((0, N), np.uint32), n_letters
    code = small[: len(small) - N + 1].astype(np.int64)
    inside = owner[: len(owner) - N + 1] == owner[N - 1 :]
    for i in range(1, N):
        code = code * k + small[i : len(small) - N + 1 + i]
    code, who = code[inside], owner[: len(owner) - N + 1][inside]
    if k**N <= 1 << 24:
        seen = np.bincount(code, minlength=k**N) > 0
        found = np.flatnonzero(seen)
        place = (np.cumsum(seen) - 1)[code]
    else:
        found, place = np.unique(code, return_inverse=True)
    counts = np.bincount(who * len(found) + place, minlength=len(texts) * len(found)).reshape(len(texts), len(found)).astype(np.float32)
    digits = np.stack([found // k ** (N - 1 - i) % k for i in range(N)], axis=1)
    return counts, present[digits], n_letters


def runs(texts: list[str], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about `most` characters and at most 128 texts."""
    a, size = 0, 0
    for i, t in enumerate(texts):
        if i > a and (size + len(t) > most or i - a >= 128):
            yield a, i
            a, size = i, 0
        size += len(t)
    if a < len(texts):
        yield a, len(texts)


@dataclass
class Profiles:
    languages: list[str]
    prototypes: np.ndarray


def language_profiles(docs: DataFrame, dimensions: int = 1024) -> Profiles:
    """Prototypes of every non-null lang of docs(text, lang), over all its texts.

    Each batch sends one sum per language; the driver gets one vector per language, so what it holds follows the number
    of languages, not of documents. Null texts add nothing. No labelled rows: no languages.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, total = Space(dimensions), {}
        for b in parts(batches):
            texts, langs = b.column("text").to_pylist(), np.array(b.column("lang").to_pylist())
            for a, z in runs(texts):
                counts, grams, _ = gram_counts(texts[a:z])
                names, which = np.unique(langs[a:z], return_inverse=True)
                by = np.zeros((len(names), counts.shape[1]), np.float32)
                np.add.at(by, which, counts)
                for name, v in zip(names, profiles_of(by, grams, space).astype(np.float64)):
                    total[name] = total.get(name, 0) + v
        for name, v in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * dimensions), pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(v)], ["lang", "d", "v"])

    sums = docs.select("text", "lang").where("text is not null and lang is not null").mapInArrow(run, "lang string, d int, v double")
    found: dict[str, np.ndarray] = {}
    for r in sums.groupBy("lang", "d").agg(F.sum("v").alias("v")).collect():
        found.setdefault(r["lang"], np.zeros(dimensions))[r["d"]] = r["v"]
    names = sorted(found)
    return Profiles(names, np.array([found[n] for n in names], np.float64).reshape(len(names), dimensions))


def predicted_languages(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """docs with lang_pred and score: one row per row of docs(text, ...).

    score is the largest cosine, or 0 if that is negative. `und` with score 0 where the text is null or has no letter, or
    no language was learned. Equal cosines go to the first language by name. Whole texts; other columns stay, a null
    doc_id too, but earlier lang_pred and score are replaced. An empty table gives no rows.
    """
    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    norm = np.linalg.norm(profiles.prototypes, axis=1, keepdims=True)
    unit = profiles.prototypes / np.where(norm == 0, 1, norm)
    names = np.array([*profiles.languages, "und"], object)
    dimensions = unit.shape[1] if len(unit) else 0
    held = docs.sparkSession.sparkContext.broadcast((unit.astype(np.float32), names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, names = held.value
        space = Space(dimensions)
        for b in parts(batches):
            texts = [t or "" for t in b.column("text").to_pylist()]
            best, score = np.full(len(texts), len(names) - 1), np.zeros(len(texts))
            for a, z in runs(texts) if len(unit) else ():
                counts, grams, n = gram_counts(texts[a:z])
                if not len(grams):
                    continue
                vectors = profiles_of(counts, grams, space)
                length = np.linalg.norm(vectors, axis=1)
                cosine = vectors @ unit.T / np.where(length == 0, 1, length)[:, None]
                some = n > 0
                best[a:z][some] = cosine.argmax(1)[some]
                score[a:z][some] = np.clip(cosine.max(1), 0, 1)[some]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names[best].tolist(), pa.string()), pa.array(score)], [*b.schema.names, "lang_pred", "score"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "lang_pred string, score double"])
    return docs.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(run, schema)
