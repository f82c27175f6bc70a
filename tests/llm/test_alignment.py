import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from genospark.llm import token_alignment as A
from genospark.llm.queries import bpe_path, piece_path
from genospark.llm.tokenizer import byte_characters


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe_path())
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=piece_path())


def ends(sizes):
    out = []
    for n in sizes:
        out.append((out[-1] if out else 0) + n)
    return out


def tokens(libraries, text):
    """(A ids, B ids, their ends) of whole texts, or nothing, from the libraries alone."""
    t, model = libraries
    if not text:
        return [], [], [], []
    letters, want = byte_characters(), f" {text}".encode()
    a, b = t.encode(f" {text}", add_special_tokens=False).ids, model.encode(text)
    a_bytes = [bytes(letters[c] for c in t.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in map(model.id_to_piece, b)]
    if b"".join(a_bytes) != want or b"".join(b_bytes) != want:
        return [], [], [], []
    return a, b, ends(map(len, a_bytes)), ends(map(len, b_bytes))


def by_definition(libraries, texts):
    found, links = [], []
    for text in texts:
        a, b, x, y = tokens(libraries, text)
        both = sorted(set(x) & set(y))
        links.append([(i, j) for i, e in zip(a, x) for j, f in zip(b, y) if e == f])
        groups, start = [], 0
        for end in both:
            part = lambda ids, at: ",".join(str(i) for i, e in zip(ids, at) if start < e <= end)  # noqa: B023,E731
            groups.append(f"{part(a, x)}|{part(b, y)}")
            start = end
        found.append((len(a), len(b), len(groups), len(links[-1]), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    count = Counter(p for row in links for p in row)
    most = {}
    for (i, j), n in count.items():
        most[j] = max(most.get(j, 0), n)
    return [(*f[:4], sum(count[p] == most[p[1]] for p in row), sum(count[p] for p in row), f[4]) for f, row in zip(found, links)]


POOL = ["the", " ", "  ", "\n", "\t", " \n ", "é", "漢字", "🙂", "▁", "<|endoftext|>", "<s>", "<0x41>", "'s", "don't", "12", "3.5", " ", "　", "\x85", "\x1f", "ing", "Ünder", "x", "ABC", "​", "é"]


def odd_texts(seed, n):
    r = random.Random(seed)
    return [None, "", " ", "  ", " a", "a ", "a  b", "\n", "a▁b", "x <|endoftext|> y", "a" * 3000, " " * 500 + "b"] + ["".join(r.choice(POOL) + r.choice(["", " ", " "]) for _ in range(r.randrange(40))) for _ in range(n)]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def found(spark, texts, **options):
    out = A.token_alignment(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), bpe_path(), piece_path(), **options).collect()
    return [tuple(r[c] for c in COLUMNS) for r in sorted(out, key=lambda r: r["doc_id"])]


def test_by_definition(spark, libraries):
    texts = odd_texts(1, 400) * 2
    want = by_definition(libraries, texts)
    assert sum(w[0] > 0 for w in want) > 300 and any(w[0] == 0 for w in want[12:])
    assert found(spark, texts) == want
    assert found(spark, texts, broadcast_rows=10) == want


def test_groups_cover_both_lists(libraries):
    """Each text's groups hold all ids of both, in order, and groups_of needs no more than ids and sizes."""
    align, _ = A.aligner(bpe_path(), piece_path())
    for text in odd_texts(2, 2000)[2:]:
        a, b, x, y = tokens(libraries, text)
        got = align(text)
        if got is None:
            assert not a
            continue
        assert (got.a.tolist(), got.b.tolist()) == (a, b) and [x[i - 1] for i in got.at_a] == [y[i - 1] for i in got.at_b] == sorted({*x} & {*y})
    ids, size = lambda *x: np.array(x, np.int64), np.arange(9)
    assert A.groups_of(ids(1, 2, 3), ids(3, 3), size, size).text(A.id_names(9)) == "1,2|3;3|3"
    assert A.groups_of(ids(), ids(), size, size).links().tolist() == []


@pytest.mark.parametrize("window", [1, 2, 3, 7, 4096])
def test_windows_change_nothing(monkeypatch, window):
    monkeypatch.setattr(A, "WINDOW", window)
    r = np.random.default_rng(1)
    size = np.arange(9)
    for _ in range(200):
        a = r.integers(1, 9, r.integers(1, 30))
        b = r.permutation(a) if r.random() < 0.5 else np.array([1] * int(a.sum()))
        x, y = np.cumsum(size[a]), np.cumsum(size[b])
        got = A.groups_of(a, b, size, size)
        assert x[got.at_a - 1].tolist() == y[got.at_b - 1].tolist() == sorted({*x.tolist()} & {*y.tolist()})


@pytest.mark.parametrize("rows", [[], [(None, "a b", 1), (None, "a b", 2), (3, None, 3)]])
def test_edges(spark, rows, libraries):
    """No rows, repeated rows, null ids and texts, columns named like results."""
    out = A.token_alignment(spark.createDataFrame(rows, "doc_id long, text string, pairs long"), bpe_path(), piece_path()).collect()
    want = by_definition(libraries, [t for _, t, _ in rows])
    assert sorted(tuple(r[c] for c in COLUMNS) for r in out) == sorted(want) and len(out) == len(rows)


def test_long_text(spark, libraries):
    text = " ".join(f"word{i % 977} é{i}" for i in range(60_000))
    a, b, x, y = tokens(libraries, text)
    (row,) = found(spark, [text])
    assert row[:4] == (len(a), len(b), len(set(x) & set(y)), len(set(x) & set(y)))
