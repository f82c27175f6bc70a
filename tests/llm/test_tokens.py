import random
import zlib

import numpy as np

from genospark.llm.packing import best_two_fit, cut, packed, packed_documents, sequence_plan
from genospark.llm.queries import bpe_path
from genospark.llm.token_counts import CACHE_SCHEMA, token_counts
from genospark.llm import tokenizer as T
from genospark.llm.tokenizer import encoder


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe_path())


def test_encoder_is_the_library():
    t, encode, r = library(), encoder(bpe_path()), random.Random(1)
    pool = [chr(c) for c in range(32, 1200)] + list("\n\t\r  　漢字仮名🙂") + ["<|endoftext|>", "'ll", "12 "]
    for _ in range(2000):
        s = "".join(r.choices(pool, k=r.randrange(40)))
        assert encode(s).tolist() == t.encode(s, add_special_tokens=False).ids


def test_encoder_over_code_points():
    """Letters, numbers and white space are the same classes to both: each character of two planes in several places."""
    t, encode = library(), encoder(bpe_path())
    assert encode.__qualname__.startswith("encoder.") and encode.__name__ == "encode"
    for a in range(0, 0x20000, 64):
        s = "".join(f"x{c}y 1{c}2  {c} {c}'ll." for c in map(chr, range(a, a + 64)) if not 0xD800 <= ord(c) < 0xE000)
        assert encode(s).tolist() == t.encode(s, add_special_tokens=False).ids


LONG = [" " * 1_000_000, "\n" * 1_000_000, "a" * 1_000_000, " \t" * 400_000 + "x", "ab漢字 é" * 100_000]


def test_very_long_runs(spark, tmp_path):
    """Texts that the fast path refuses, in both queries."""
    t = library()
    docs = spark.createDataFrame(list(enumerate(LONG)), "doc_id long, text string")
    want = {i: len(t.encode(s, add_special_tokens=False).ids) for i, s in enumerate(LONG)}
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts(docs, str(tmp_path / "c"), bpe_path()).collect()} == want
    pieces = {r["doc_id"]: r["n"] for r in packed_documents(docs, bpe_path()).groupBy("doc_id").sum("length").toDF("doc_id", "n").collect()}
    assert pieces == {i: n + 1 for i, n in want.items()}


def test_files_of_another_make():
    spec = {"model": {"type": "BPE", "vocab": {}, "merges": []}, "pre_tokenizer": {"type": "ByteLevel"}, "added_tokens": []}
    letters = {c: i for i, c in enumerate(T.byte_characters())}
    spec["model"] |= {"vocab": letters | {"ab": 256, "abc": 257}, "merges": ["a b", "ab c"]}
    assert T.plain_byte_level(spec)
    for change in ({"merges": ["ab c", "a b"]}, {"merges": ["a b", "ab c", "a bc"]}, {"ignore_merges": True}, {"type": "Unigram"}, {"merges": ["a b"]}):
        assert not T.plain_byte_level(spec | {"model": spec["model"] | change})
    assert not T.plain_byte_level(spec | {"added_tokens": [{"content": "<x>", "id": 258, "lstrip": True}]})


def test_counts_and_cache(spark, docs, tmp_path):
    t, path = library(), str(tmp_path / "cache")
    want = sorted((r["doc_id"], len((r["text"] or "").encode()), len(t.encode(r["text"] or "", add_special_tokens=False).ids)) for r in docs.collect())
    got = token_counts(docs, path, bpe_path()).collect()
    assert sorted((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got)
    cache = lambda: spark.read.schema(CACHE_SCHEMA).parquet(path)
    n = cache().count()
    assert n == cache().select("content").distinct().count() == docs.fillna("").select("text").distinct().count()
    assert len(token_counts(docs, path, bpe_path()).collect()) == len(got) and cache().count() == n
    more = docs.unionByName(spark.createDataFrame([(None, "brand new", None, None)], docs.schema))
    assert token_counts(more, path, bpe_path()).where("doc_id is null").first()["n_tokens"] == 2
    assert cache().count() == n + 1
    assert token_counts(docs.limit(0), path, bpe_path()).count() == 0


def test_best_two_fit():
    """A bin's smallest piece gives way to two that fill it."""
    assert (1, {6: 1, 2: 2}) in best_two_fit({6: 1, 3: 1, 2: 2}, 10)
    r = random.Random(2)
    for _ in range(60):
        cap = r.choice([10, 64, 1024])
        counts = {r.randrange(1, cap + 1): r.randrange(1, 50) for _ in range(r.randrange(1, 40))}
        made = best_two_fit(counts, cap)
        assert all(sum(k * n for k, n in u.items()) <= cap for _, u in made)
        total = {}
        for times, u in made:
            for k, n in u.items():
                total[k] = total.get(k, 0) + times * n
        assert total == counts
        bins = sum(t for t, _ in made)
        assert bins <= first_fit_decreasing(counts, cap) * 1.02 + 1
    assert sequence_plan({}, 10) == []


def first_fit_decreasing(counts, cap):
    rooms = []
    for k in sorted(counts, reverse=True):
        for _ in range(counts[k]):
            for i, room in enumerate(rooms):
                if room >= k:
                    rooms[i] -= k
                    break
            else:
                rooms.append(cap - k)
    return len(rooms)


def test_packed_documents(spark, docs):
    t = library()
    unique = docs.dropDuplicates(["doc_id"])
    got = packed_documents(unique, bpe_path(), 64).collect()
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for d in unique.collect():
        ids = np.array([*t.encode(d["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for k, r in enumerate(sorted(by_doc.pop(d["doc_id"]), key=lambda r: r["piece"])):
            assert (r["piece"], r["start"], r["ids_crc32"]) == (k, at, zlib.crc32(ids[at : at + r["length"]].tobytes()))
            assert r["length"] == 64 or k == 0
            at += r["length"]
        assert at == len(ids)
    assert not by_doc
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 64
    assert packed_documents(docs.limit(0), bpe_path(), 64).count() == 0
    assert packed_documents(docs, bpe_path(), 64).count() > len(got)


def test_cut():
    assert [(a, len(x)) for a, x in cut(np.arange(10), 4)] == [(0, 2), (2, 4), (6, 4)]
    assert [(a, len(x)) for a, x in cut(np.arange(8), 4)] == [(0, 4), (4, 4)]


def test_one_length_for_all(spark):
    """A hot length: every piece gets a place of its own."""
    pieces = spark.range(1000).selectExpr("id as doc_id", "0 as piece", "cast(3 as long) as length")
    got = packed(pieces, 10, 64).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == 1000 and len({r["sequence_id"] for r in got}) == 334
