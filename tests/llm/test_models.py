"""Language ID, toxicity, and the language model."""

import itertools
import math
import zlib

import numpy as np
from compare import DATA
from pyspark.sql import functions as F

from genospark.llm import hidden_markov as H
from genospark.llm import language_id as L
from genospark.llm import toxicity as T
from genospark.llm.queries import QUERIES

SF = f"{DATA}/sf0.01"


def test_profiles_are_sums_of_bound_vectors():
    """Against the definition, gram by gram."""
    space = L.Space(64)
    counts, grams, n = L.gram_counts(["Ab, c", "", "1 2"])
    got = L.profiles_of(counts, grams, space, most=2)
    v = lambda c: space.rows[space.letter(np.array([ord(c) if c != " " else 0]))[0]]
    want = sum(v(a) * np.roll(v(b), 1) * np.roll(v(c), 2) for a, b, c in (" ab", "ab ", "b c", " c "))
    assert np.array_equal(got[0], want) and n.tolist() == [3, 0, 0] and not got[1].any()


def test_language_edges(spark, docs):
    train = spark.createDataFrame([("the cat and the dog", "en"), ("le chat et le chien", "fr"), (None, "fr"), ("x", None)], "text string, lang string")
    p = L.language_profiles(train, 256)
    assert p.languages == ["en", "fr"]
    out = L.predicted_languages(docs, p)
    rows = out.collect()
    assert len(rows) == docs.count() and sorted(out.columns) == sorted(docs.columns)
    assert {r["doc_id"] for r in rows if r["lang_pred"] == "und"} == {0, 1, 2, 8}
    assert all(0 <= r["score"] <= 1 for r in rows)
    none = L.predicted_languages(docs, L.language_profiles(train.limit(0), 256)).collect()
    assert {(r["lang_pred"], r["score"]) for r in none} == {("und", 0.0)}
    assert L.predicted_languages(docs.limit(0), p).count() == 0


def test_cosines_by_definition():
    """The prediction of a text is the language of the largest cosine, worked out gram by gram."""
    space = L.Space(128)
    texts, names = ["the cat and the dog", "le chat et le chien", "der hund und die katze"], ["en", "fr", "de"]
    counts, grams, _ = L.gram_counts(texts + ["the dog and a cat", "ein hund"])
    profile = L.profiles_of(counts, grams, space).astype(float)
    for row, want in ((3, "en"), (4, "de")):
        cosine = [profile[row] @ p / np.linalg.norm(profile[row]) / np.linalg.norm(p) for p in profile[:3]]
        assert names[int(np.argmax(cosine))] == want


def test_language_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", F.length("text").alias("n"))
    got = QUERIES["op3_language_id"](spark, SF).join(docs, "doc_id").where("held_out and lang_pred <> 'und'").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.97 * len(got) > 100


def test_toxicity_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    got = QUERIES["op10_toxicity"](spark, SF).join(labels, "doc_id").collect()
    seen = [r for r in got if not r["held_out"]]
    assert sum(r["predicted"] == r["toxic"] for r in seen) >= 0.95 * len(seen)
    clean = [r for r in got if r["held_out"] and r["toxic"] == 0]
    assert sum(r["predicted"] for r in clean) <= 0.1 * len(clean)


def test_toxicity_edges(spark, docs):
    labels = spark.createDataFrame([(4, 1, "t"), (9, 0, "t"), (9, None, "t")], "doc_id long, toxic int, text string")
    out = T.toxicity_scores(docs, T.toxicity_model(docs, labels)).collect()
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out)
    none = T.toxicity_model(docs, labels.limit(0))
    assert T.toxicity_scores(docs, none).where("score is null").count() == 0 and T.toxicity_scores(docs.limit(0), none).count() == 0


def test_toxicity_of_held_out_texts(spark):
    """Toxic documents that the model has not seen are found, and others are left alone."""
    sf = f"{DATA}/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    got = [r for r in QUERIES["op10_toxicity"](spark, sf).join(labels.where("toxic is not null"), "doc_id").collect() if r["held_out"]]
    toxic = [r["predicted"] for r in got if r["toxic"]]
    clean = [r["predicted"] for r in got if not r["toxic"]]
    assert sum(toxic) >= 0.9 * len(toxic) > 20 and sum(clean) <= 0.02 * len(clean)


def test_toxicity_sample_is_bounded(spark):
    """One id in many rows is one document, that with the first text."""
    docs = spark.createDataFrame([(1, "b")] * 500 + [(1, "a bad one"), (2, "a kind one")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (3, 1), (None, 1)], "doc_id long, toxic int")
    rows = T.sample_features(docs, labels, 10, 5).collect()
    assert sorted((r["label"], r["features"]) for r in rows) == sorted([(1, T.one("a bad one", 10).tolist()), (0, T.one("a kind one", 10).tolist())])
    assert T.sample_features(docs, labels, 10, 1).count() == 1


def test_toxicity_by_definition(spark, docs):
    """Scores against words and beginnings looked up one by one; the gradient against differences of the loss."""
    r = np.random.default_rng(2)
    m = T.Model(r.normal(size=1 << 12).astype(np.float32), 0.3, 12)
    for row in T.toxicity_scores(docs.select("doc_id", "text"), m).collect():
        text = row["text"] or ""
        found = {int(b) for w in text.split() for b in T.one(w, 12)} if text.isascii() else set(T.one(text, 12).tolist())
        z = m.bias + sum(float(m.weights[b]) for b in found)
        assert math.isclose(row["score"], 1 / (1 + math.exp(-max(min(z, 30), -30))), abs_tol=1e-5)
    own = [r.choice(9, 4, replace=False).astype(np.int32) for _ in range(12)]
    x, gap = T.sparse([(own, 1.0)]), T.sparse([([o[:1] for o in own], 1.0), ([o[1:2] for o in own], -1.0)])
    y, w = r.integers(0, 2, 12).astype(float), r.normal(size=9)
    _, grad, gb = T.loss_and_gradient(w, 0.2, x, gap, y, 0.1, 0.7)
    loss = lambda w, b: T.loss_and_gradient(w, b, x, gap, y, 0.1, 0.7)[0]
    step = 1e-6 * np.eye(9)
    assert np.allclose(grad, [(loss(w + s, 0.2) - loss(w - s, 0.2)) / 2e-6 for s in step], atol=1e-6)
    assert math.isclose(gb, (loss(w, 0.2 + 1e-6) - loss(w, 0.2 - 1e-6)) / 2e-6, abs_tol=1e-6)


def test_identity_terms_carry_no_weight_of_their_own(spark):
    """Toxic rows name one group more often; the penalty takes the weight off the name."""
    rows = []
    for i in range(400):
        toxic = i % 2
        rows.append((i, f"some {'muslim' if i % 8 < (6 if toxic else 2) else 'christian'} person is {'awful' if toxic else 'kind'} today w{i % 7}", toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    plain, fair = (T.toxicity_model(docs.select("doc_id", "text"), docs, 14, screen=1.0, counterfactual=c) for c in (0.0, 20.0))
    weight = lambda m, w: m.weights[T.one(w, 14)].sum()
    gap = lambda m: abs(weight(m, "muslim") - weight(m, "christian"))
    assert gap(fair) < 0.5 * gap(plain) and weight(fair, "awful") > 1
    assert T.swapped("nothing here") is None and T.swapped("Women, MÄNNER") == "men, frauen"


def brute_likelihood(m, x):
    s, total = len(m.start), 0.0
    for path in itertools.product(range(s), repeat=len(x)):
        p = m.start[path[0]] * m.emit[path[0], x[0]]
        for a, b, c in zip(path, path[1:], x[1:]):
            p *= m.move[a, b] * m.emit[b, c]
        total += p
    return math.log10(total)


def test_forward_recursion_sums_all_paths():
    """Whatever the windows: texts of one token, of whole windows, and longer ones."""
    m = H.initial(3, np.ones(5) / 5)
    x, n = np.array([0, 1, 4, 2, 3, 3, 1, 0], np.int16), np.array([4, 1, 3])
    want = [brute_likelihood(m, x[a:b]) for a, b in ((0, 4), (4, 5), (5, 8))]
    for window in (1, 2, 3, 512):
        assert np.allclose(H.likelihoods(m, x, n, window), want)


def brute_expectations(m, x):
    """Starts, moves and emissions of every path, by its share of the likelihood."""
    s, k = m.emit.shape
    starts, moves, emits, total = np.zeros(s), np.zeros((s, s)), np.zeros((k, s)), 0.0
    for path in itertools.product(range(s), repeat=len(x)):
        p = m.start[path[0]] * m.emit[path[0], x[0]] * math.prod(m.move[a, b] * m.emit[b, c] for a, b, c in zip(path, path[1:], x[1:]))
        total += p
        starts[path[0]] += p
        for a, b in zip(path, path[1:]):
            moves[a, b] += p
        for a, c in zip(path, x):
            emits[c, a] += p
    return starts / total, moves / total, emits / total, math.log(total)


def test_expectations_over_all_paths():
    m = H.initial(2, np.array([0.4, 0.3, 0.2, 0.1]))
    r = np.random.default_rng(4)
    lengths = np.array([1, 7, 4, 10, 2])
    x = r.integers(0, 4, lengths.sum()).astype(np.int16)
    cuts = np.cumsum([0, *lengths])
    want = [sum(parts) for parts in zip(*(brute_expectations(m, x[a:b]) for a, b in zip(cuts, cuts[1:])))]
    for window in (1, 3, 4, 512):
        for got, w in zip(H.expectations(m, x, lengths, window), want):
            assert np.allclose(got, w, rtol=1e-4, atol=1e-5)


def test_long_texts_do_not_depend_on_windows():
    r = np.random.default_rng(5)
    m, lengths = H.initial(6, np.ones(40) / 40), np.array([3000, 700, 512, 513, 20])
    x = r.integers(0, 40, lengths.sum()).astype(np.int16)
    one, many = H.expectations(m, x, lengths, 4096), H.expectations(m, x, lengths)
    assert all(np.allclose(a, b, rtol=2e-3, atol=1e-2) for a, b in zip(one, many))
    assert np.allclose(H.likelihoods(m, x, lengths, 4096), H.likelihoods(m, x, lengths), rtol=1e-12)


def test_each_round_is_likelier():
    r = np.random.default_rng(1)
    x, n = r.integers(0, 6, 900).astype(np.int16), np.array([300, 600])
    x[:300] %= 3
    m, last = H.initial(2, np.ones(6) / 6), -np.inf
    for _ in range(6):
        a, b, c, total = H.expectations(m, x[:250], np.array([250]))
        assert total >= last - 1e-6
        last = total
        m = H.Model(a / a.sum(), b / b.sum(1, keepdims=True), c.T / c.T.sum(1, keepdims=True))
    assert n.sum() == 900


def test_scores_against_brute_force(spark):
    docs = {r["doc_id"]: (r["text"] or "").encode().lower().split() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op6_hidden_markov"](spark, SF).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    count, n_docs = {}, 0
    for i, words in docs.items():
        if not held[i]:
            n_docs += 1
            for w in words:
                count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()) + n_docs, len(count) + 1
    for i, words in docs.items():
        base = sum(math.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in words) + math.log10((n_docs + 1) / (n + v + 1))
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(words) + 1, sum(w in count for w in words) + 1, n)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
    some = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in some) > sum(r["base_score"] for r in some)


def test_scores_edges(spark, docs):
    out = H.text_scores(docs.withColumn("held_out", F.col("doc_id") > 8), states=2, rounds=2, head_words=10).collect()
    assert len(out) == docs.count() and all(math.isfinite(r["score"]) for r in out)
    assert {r["n_tokens"] for r in out if r["doc_id"] in (0, 1, 2)} == {1}
    assert H.text_scores(docs.withColumn("held_out", F.lit(True)), states=2, rounds=1).where("n_known > 0 or train_tokens > 0").count() == 0
    assert H.text_scores(docs.withColumn("held_out", F.lit(True)).limit(0), states=2, rounds=1).count() == 0
