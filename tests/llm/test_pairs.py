"""Jaccard join, decontamination, vector search, preferences, pages, pipeline."""

import html
import math
import random
import re
import time

import numpy as np
import pytest
from compare import rows_of, sql_rows
from compare import DATA
from pyspark.sql import functions as F

from genospark.llm import bytetext as B
from genospark.llm import decontamination as D
from genospark.llm import html_text
from genospark.llm import oracle
from genospark.llm.components import connected_components
from genospark.llm.html_text import extracted_pages, main_text
from genospark.llm.jaccard_join import jaccard_components
from genospark.llm.preferences import formatted_preferences, pairs_of_conversations
from genospark.llm.queries import QUERIES
from genospark.llm.vector_search import Graph, by_length, nearest


WORDS = ["".join(random.Random(i).choices("abcdefghij", k=3 + i % 5)) for i in range(600)]


def prose(seed, n=60):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def brute_components(rows, size, percent):
    """[(doc_id, size of the set, component)] of the rows, each a node of its own, named by the smallest doc_id."""
    sets, of = [], list(range(len(rows)))
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else []))
    for a in range(len(rows)):
        for b in range(a):
            if of[a] != of[b] and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((of[a], of[b]))
                    of = [x if v == y else v for v in of]
    least = {}
    for (i, _), c in zip(rows, of):
        least[c] = min(i, least.get(c, i))
    return sorted((i, len(s), least[c]) for (i, _), s, c in zip(rows, sets, of))


def components(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


@pytest.mark.parametrize("size,percent,frequent,long", [(3, 90, 24, 64), (2, 80, 1, 2)])
def test_jaccard(spark, docs, size, percent, frequent, long):
    """Also with so small classes that combinations and blocks are needed."""
    want = brute_components([(r["doc_id"], r["text"]) for r in docs.collect()], size, percent)
    assert components(jaccard_components(docs, size, percent, frequent, long)) == want


@pytest.mark.parametrize("frequent,long", [(24, 64), (1, 2)])
def test_jaccard_repeated_ids(spark, frequent, long):
    """Rows of one doc_id with different texts keep the links of each."""
    x, y = prose(50, 61), prose(51, 61)
    rows = [(1, x), (1, y), (1, y), (5, y + " z"), (6, x + " q"), (6, prose(52, 61)), (7, y), (7, "a b c")]
    got = components(jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90, frequent, long))
    assert got == brute_components(rows, 3, 90) and (5, 60, 1) in got and (6, 60, 1) in got


def test_jaccard_large_group_makes_few_pairs(spark, monkeypatch):
    """A group of near copies: what is verified grows with the group, not with its square."""
    from genospark.llm import jaccard_join as J

    verified, seen = J.verified, []
    monkeypatch.setattr(J, "verified", lambda pairs, *a: (seen.append(pairs.count()), verified(pairs, *a))[1])
    r, base = random.Random(8), prose(60, 80).split()
    rows = []
    for i in range(1500):
        x = base[:]
        for _ in range(3):
            x[r.randrange(80)] = f"e{r.randrange(10**6)}"
        rows.append((i, " ".join(x)))
    got = components(jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 70))
    assert {c for _, _, c in got} == {0} and sum(seen) < 20 * len(rows)


def test_jaccard_cloud_of_near_copies(spark):
    """A large group around the threshold, and documents that are mostly one passage."""
    r = random.Random(4)
    word = lambda: "w" + str(r.randrange(5000))
    base, rows = [word() for _ in range(60)], []
    for i in range(70):
        x = base[:]
        for _ in range(i % 6):
            x[r.randrange(60)] = word()
        rows.append((i, " ".join(x)))
    rows += [(100 + i, " ".join(base[:40] + [word() for _ in range(12)])) for i in range(30)]
    assert components(jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 80, 2, 4)) == brute_components(rows, 3, 80)


def test_jaccard_pivots_meet_once(spark):
    """Near copies that share many long lists: a pair is made in one of them, not in each; none is lost, whatever lists it has in common."""
    from genospark.llm import jaccard_join as J

    r = random.Random(5)
    lists = {i: set(range(400)) - set(r.sample(range(400), 4 * i)) for i in range(60)}
    lists |= {60: {398, 399, 900}, 61: {5, 901}, 62: {900, 901}}
    hot = spark.createDataFrame([(s, i, 100, i, 2) for i, own in lists.items() for s in own], "sig long, rep long, n int, c long, blocks int")
    sketches = spark.createDataFrame([(i, bytes([1] * J.SKETCH)) for i in lists], "rep long, sketch binary")
    drawn = [0, 7, 60, 61]
    got = [tuple(x) for x in J.pairs_with_pivots(hot, hot.where(F.col("rep").isin(drawn)), sketches, 80).collect()]
    want = {(min(x, y), max(x, y)) for x in lists for y in drawn if x != y and lists[x] & lists[y]}
    assert set(got) == want and len(got) <= 2 * J.DEALS * len(want) < sum(len(lists[x] & lists[y]) for x in lists for y in drawn)


def test_jaccard_pivots_meet_once_in_all_lists(spark):
    """With some dozens of long lists, a member and a pivot make one pair whatever they have in common, also where the pivot was drawn in a part of its lists only."""
    from genospark.llm import jaccard_join as J

    r = random.Random(7)
    lists = {i: set(r.sample(range(48), 48 - i % 30)) for i in range(60)} | {60: {3, 900}, 61: {901}}
    hot = spark.createDataFrame([(s, i, 100, i, 2) for i, own in lists.items() for s in own], "sig long, rep long, n int, c long, blocks int")
    sketches = spark.createDataFrame([(i, bytes([1] * J.SKETCH)) for i in lists], "rep long, sketch binary")
    drawn = {y: {s for s in lists[y] if s % 3 == y % 3 or s > 48} for y in (0, 7, 29, 60, 61)}
    pivots = hot.where(F.col("rep").isin(*drawn) & ((F.col("sig") % 3 == F.col("rep") % 3) | (F.col("sig") > 48)))
    got = [tuple(x) for x in J.pairs_with_pivots(hot, pivots, sketches, 80).collect()]
    assert sorted(got) == sorted((min(x, y), max(x, y)) for x in lists for y in drawn if x != y and lists[x] & drawn[y])


def test_jaccard_rounds_take_few_tasks(spark, monkeypatch):
    """Rounds on a few numbers don't run a task, nor write a file, for each of many shuffle partitions."""
    import uuid

    from genospark.llm import jaccard_join as J

    r, base, conf = random.Random(10), prose(62, 80).split(), {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    rows = [(i, " ".join(w if r.random() > 0.02 * (i % 6) else f"e{r.randrange(10**6)}" for w in base)) for i in range(150)]
    docs, before, sc, group = spark.createDataFrame(rows, "doc_id long, text string"), {k: spark.conf.get(k) for k in conf}, spark.sparkContext, uuid.uuid4().hex
    linked = J.linked

    def counted(*a):
        sc.setJobGroup(group, "")
        try:
            return linked(*a)
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)

    monkeypatch.setattr(J, "linked", counted)
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = components(jaccard_components(docs, 3, 80, 1, 2))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    told = sc.statusTracker()
    stages = {s: told.getStageInfo(s) for j in told.getJobIdsForGroup(group) for s in told.getJobInfo(j).stageIds}
    assert got == brute_components(rows, 3, 80) and max(c for _, _, c in got) > 0
    tasks = sum(x.numCompletedTasks for x in stages.values() if x)
    assert 0 < tasks < 2500


def test_jaccard_keeps_windows_in_place(spark, monkeypatch):
    """First tokens are the wide part of a row: neither leaving copies out nor leaving frequent tokens out moves them, and both do the same where they must be joined."""
    from genospark.llm import jaccard_join as J
    from genospark.llm.tables import saved

    r = random.Random(6)
    rows = [(i, i, i, n, sorted(r.sample(range(300), n // 3 + 1))) for i, n in enumerate([5, 30, 60, 90] * 30)]
    reps = saved(spark.createDataFrame(rows, "rep long, doc_id long, d1 long, n int, window array<long>"))
    often, copies = saved(spark.range(0, 300, 4).toDF("sig")), saved(spark.range(10, 40).toDF("rep"))
    made = J.prefixes(J.without(reps, "rep", copies), often, 80)
    assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
    found = sorted(map(tuple, made.collect()))
    assert len(found) == 90 and all(p == [t for t in rows[i][4] if t % 4][: n // 5 + 1] and easy == (len(p) == n // 5 + 1) for i, _, _, n, p, easy in found)
    monkeypatch.setattr(J, "LISTED", 3)
    assert sorted(map(tuple, J.prefixes(J.without(reps, "rep", copies), often, 80).collect())) == found


@pytest.mark.parametrize("frequent,long", [(2, 4), (4, 2)])
def test_jaccard_joined_lists(spark, monkeypatch, frequent, long):
    """Without any list sent to tasks, and with long lists below and above what easy sets share."""
    from genospark.llm import jaccard_join as J

    monkeypatch.setattr(J, "LISTED", 0)
    monkeypatch.setattr(J, "SMALL", 0)
    r, base = random.Random(9), prose(61, 70).split()
    rows = [(i, " ".join(w if r.random() > 0.01 * (i % 5) else f"e{r.randrange(10**6)}" for w in base)) for i in range(60)]
    rows += [(100 + i, prose(70 + i % 8, 50) + f" {i}") for i in range(40)]
    assert components(jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 80, frequent, long)) == brute_components(rows, 3, 80)


def test_jaccard_empty(spark, docs):
    assert jaccard_components(docs.limit(0)).count() == 0
    assert jaccard_components(spark.createDataFrame([(None, "a b c"), (7, "a b c"), (None, None)], "doc_id long, text string")).where("component_id = 7").count() == 2


def test_jaccard_few_words_alone(spark):
    """Slices that hold fewer words in all than a shingle has: one text to a partition."""
    texts = ["a", "a b", "a b c", "a b c d", "a b c d e", "A b C", ""]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(list(enumerate(texts)), len(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(docs, 5, 80).collect()}
    assert got == {0: (1, 0), 1: (1, 1), 2: (1, 2), 3: (1, 3), 4: (1, 4), 5: (1, 2), 6: (0, 6)}


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(50, 60), (60, 60), (61, 50)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 1 for i in range(1, 31)} | {50: 50, 60: 50, 61: 50}


@pytest.mark.parametrize("few", [0, 10**6])
def test_components_by_rounds_or_at_once(spark, few):
    """Up to `few` edges are named at once, more in rounds: the same components, whatever the order of the names along a chain."""
    r = random.Random(11)
    names = r.sample(range(-1000, 1000), 200)
    edges = [(names[i], names[i + 1]) for i in range(60)] + [(names[61], names[j]) for j in range(62, 100)] + [tuple(r.sample(names[100:], 2)) for _ in range(60)] + [(names[0], names[0])]
    of = {x: x for e in edges for x in e}
    for _ in of:
        for a, b in edges:
            of[a] = of[b] = min(of[a], of[b])
    got = connected_components(spark.createDataFrame(edges, "u long, v long"), few).collect()
    assert len(got) == len(of) and {x["node"]: x["component"] for x in got} == of


ITEMS = ["the quick brown fox jumps over the lazy dog near the old river bank today", "water boils at one hundred degrees at the level of the sea they say", "", None, "two words"]


def test_contamination(spark):
    pad = " ".join(f"pad{i}" for i in range(300))
    texts = [f"{pad} {ITEMS[0].upper()}! {pad}", pad + " the quick brown fox jumps over the lazy dog", None, "", ITEMS[1], f"some {ITEMS[4]} here", pad]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(4, ITEMS[1], 1)], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(i, t) for i, t in enumerate(ITEMS)], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in D.contamination(docs, items).collect())
    assert got == [(0, 0), (4, 1), (4, 1), (5, 4)]
    assert D.contamination(docs, items.limit(0)).count() == 0 and D.contamination(docs.limit(0), items).count() == 0


@pytest.mark.parametrize("n", [5, 6, 8, 15, 41])
def test_contamination_of_edited_copies(spark, n):
    """One word changed, left out or put in, at every place of an item, is still the item; a part of it, or its words in disorder, isn't."""
    item = [f"w{i}" for i in range(n)]
    other = [" ".join(f"o{k}x{i}" for i in range(n)) for k in range(9)]
    near = [item[:i] + x + item[i + y :] for i in range(n) for x, y in ((["edit"], 1), ([], 1), (["edit"], 0))]
    mixed = item[:]
    random.Random(n).shuffle(mixed)
    question = item[: n - max(n // 5, 5)]
    far = [item[::-1], mixed, question, item[n - max(n // 5, 5) :] if len(question) > 1 else item[:3], [x for w in item for x in (w, "pad")], item[: n * 7 // 10]]
    pad = [f"pad{i}" for i in range(200)]
    docs = spark.createDataFrame([(i, " ".join(pad + x + pad)) for i, x in enumerate(near + far)], "doc_id long, text string")
    items = spark.createDataFrame(list(enumerate([" ".join(item), *other])), "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in D.contamination(docs, items).collect())
    assert got == [(i, 0) for i in range(len(near))]


def hashed(texts):
    data = " ".join(texts).encode()
    w = B.words(np.frombuffer(data, np.uint8), np.cumsum([0, *(len(t.encode()) + 1 for t in texts[:-1]), len(texts[-1].encode())]))
    h = w.bare().hashes()[0]
    return [h[w.first[i] : w.first[i + 1]] for i in range(len(texts))]


def index_of(texts, size, threshold):
    """The index of texts by themselves."""
    sequences = hashed(texts)
    terms, df = np.unique(np.concatenate([np.unique(s) for s in sequences]), return_counts=True)
    of_all = D.Statistics(len(texts), float(np.mean([len(s) for s in sequences])), max(map(len, sequences)))
    return D.build_index(np.arange(len(texts)), sequences, terms, df.astype(float), of_all, size, threshold)


def brute_scores(index, terms, n):
    score = np.zeros(n)
    for t in np.unique(terms):
        a, z = index.at[t], index.at[t + 1]
        score[index.item[a:z]] += index.impact[a:z]
    return score


def test_wand_against_all_scores():
    r = random.Random(5)
    vocabulary = [f"t{i}" for i in range(60)]
    index = index_of([" ".join(r.choices(vocabulary, k=r.randrange(3, 12))) for _ in range(300)], 5, 0.3)
    for _ in range(40):
        terms = np.unique(r.choices(range(len(index.terms)), k=12))
        score = brute_scores(index, terms, 300)
        got = dict(D.wand(index, terms, 0.4))
        assert set(got) == set(np.flatnonzero(score >= 0.4 - 1e-12)) and all(abs(got[i] - score[i]) < 1e-9 for i in got)


def test_passages_against_all_windows():
    """Every window of every text in which an item reaches the threshold lies in a passage; long texts, ties and items that share words too."""
    r = random.Random(6)
    vocabulary = [f"t{i}" for i in range(40)]
    items = [" ".join(r.choices(vocabulary, k=r.randrange(3, 9))) for _ in range(40)] + ["t1 t2 t3"] * 2
    index, width = index_of(items, 5, 0.6), 8
    texts = [" ".join(r.choices(vocabulary, k=k)) for k in (3, 30, 400)] + [" ".join(["pad"] * 50 + items[0].split() + ["pad"] * 50)]
    data = "".join(texts).encode()
    w = B.words(np.frombuffer(data, np.uint8), np.cumsum([0, *(len(t) for t in texts)])).bare()
    h = w.hashes()[0]
    made = D.passages(index, w, h, width, 0.6)
    place = {int(t): i for i, t in enumerate(index.terms)}
    hits = 0
    for t in range(len(texts)):
        for a in range(w.first[t], w.first[t + 1]):
            z = min(a + width, w.first[t + 1])
            known = [place[int(x)] for x in h[a:z] if int(x) in place]
            reached = np.flatnonzero(brute_scores(index, known, len(items)) >= 0.6 + 1e-9) if known else []
            for i in reached:
                hits += 1
                inside = [(x, y) for u, x, y in made if u == t and x <= a + 1e9 and min(y, z) > max(x, a)]
                assert any(brute_scores(index, [place[int(q)] for q in h[x:y] if int(q) in place], len(items))[i] >= 0.6 - 1e-9 for x, y in inside)
    assert hits > 50 and all(y - x < 2 * width for _, x, y in made)


def test_contamination_does_not_depend_on_shards(spark):
    """Ids of text, one shard or many: the same rows and scores."""
    r = random.Random(9)
    items = [(f"q{i}", prose(200 + i, 20)) for i in range(30)] + [("q0", prose(200, 20)), (None, "x y z"), ("empty", " ")]
    texts = [prose(400 + i, 50) + " " + items[r.randrange(30)][1] + " " + prose(500 + i, 400) for i in range(40)]
    docs = spark.createDataFrame([(f"d{i}", t, 1.0) for i, t in enumerate(texts)] + [(None, items[3][1], 0.0)], "doc_id string, text string, score double")
    table = spark.createDataFrame(items, "item_id string, text string")
    rows = lambda **o: sorted((x["doc_id"] or "", x["item_id"], round(x["score"], 9)) for x in D.contamination(docs, table, **o).collect())
    one = rows()
    assert one == rows(shard_bytes=600) and len({d for d, _, _ in one}) == 41 and ("", "q3", 1.0) in one


def brute_nearest(rows, k):
    out = {}
    ok = [(i, np.array(v, float)) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    for i, q in ok:
        if i % 20 == 0:
            out[i] = [m for _, m in sorted((-float(v @ q), m) for m, v in ok if m != i and len(v) == len(q))[:k]]
    return out


def test_nearest(spark):
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=8).astype(np.float32).tolist()) for i in range(400)]
    rows += [(400 + i, rows[20][1]) for i in range(60)]
    rows += [(1000, None), (1020, [0.0] * 8), (1040, [float("nan")] * 8), (1060, [1.0, 2.0]), (1080, [2.0, 1.0]), (1100, [])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    got = {}
    for x in nearest(df, df.where("vec_id % 20 = 0"), 5, shards=3).orderBy("query_id", "rank").collect():
        got.setdefault(x["query_id"], []).append(x["vec_id"])
    want = brute_nearest(rows, 5)
    assert set(got) == set(want) and got[20] == want[20] and got[400] == want[400] and got[1060] == [1080]
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.97 * sum(map(len, want.values()))
    assert nearest(df.limit(0), df.limit(0)).count() == 0


def test_recall(spark):
    sf = f"{DATA}/sf0.01"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want, got = brute_nearest(rows, 20), {}
    for x in QUERIES["op1_vector_search"](spark, sf).collect():
        got.setdefault(x["query_id"], set()).add(x["vec_id"])
    assert sum(len(got[q] & set(w)) for q, w in want.items()) >= 0.9 * sum(map(len, want.values()))


def test_graph_of_greedy_proposals():
    """One graph, all of whose edges come from searches of the graph so far: its recall, and that hubs keep to their degree."""
    x = np.random.default_rng(1).normal(size=(4000, 24)).astype(np.float32)
    g, q = Graph(x), x[:200].astype(float)
    found, _ = g.search(np.hstack([q / np.linalg.norm(q, axis=1, keepdims=True), np.zeros((200, 1))]).astype(np.float32), 96)
    s = q @ x.T.astype(float)
    want = np.argsort(-s, axis=1)[:, :20]
    got = np.take_along_axis(found, np.argsort(-np.take_along_axis(s, found, 1), axis=1)[:, :20], 1)
    assert np.mean([len(set(a) & set(b)) / 20 for a, b in zip(got, want)]) >= 0.9
    assert g.links.shape == (4000, 40) and all(len(set(r[r >= 0])) == (r >= 0).sum() for r in g.links)


@pytest.mark.parametrize("shards", [1, 4])
@pytest.mark.parametrize("kind", ["unit", "lognormal", "outlier"])
def test_recall_whatever_the_lengths(spark, kind, shards):
    """Unit vectors, lengths over orders of magnitude, one vector a hundred times longer than the others: one graph or several."""
    r = np.random.default_rng(11)
    x = r.normal(size=(2400, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x *= {"unit": np.ones((2400, 1)), "lognormal": np.exp(r.normal(size=(2400, 1))), "outlier": 1 + 0.1 * r.normal(size=(2400, 1))}[kind]
    x[17] *= 100 if kind == "outlier" else 1
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want, got = brute_nearest(rows, 20), {}
    for row in nearest(df, df.where("vec_id % 20 = 0"), 20, shards=shards).collect():
        got.setdefault(row["query_id"], set()).add(row["vec_id"])
    assert all(len(got[q]) == 20 for q in want)
    assert sum(len(got[q] & set(w)) for q, w in want.items()) >= 0.95 * sum(map(len, want.values()))


def test_ranges_of_length():
    x = np.array([[3.0, 4.0], [0.0, 1.0], [4.9, 0.0], [1e-300, 0.0], [1e308, 1e308]])
    assert [sorted(rows.tolist()) for _, rows in by_length(x)] == [[4], [0, 2], [1], [3]]


def test_nearest_of_huge_components_and_many_blocks(spark, monkeypatch):
    """Doubles whose squares overflow; several graphs and blocks of queries; a vec_id with two vectors, and one in many rows."""
    from genospark.llm import vector_search as V

    monkeypatch.setattr(V, "ceil", lambda v: 3)
    r = np.random.default_rng(7)
    rows = [(i, (r.normal(size=6) * 1e150).tolist()) for i in range(120)] + [(40, [1e150] * 6)] + [(3, [2e150] * 6)] * 50
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for x in nearest(df, df.where("vec_id = 20 or vec_id = 60"), 5, shards=2).orderBy("query_id", "rank").collect():
        got.setdefault(x["query_id"], []).append(x["vec_id"])
    for i in (20, 60):
        q = np.array(rows[i][1]) / 1e150
        want = sorted({(-float(np.array(v) @ q), m) for m, v in rows if m != i})[:5]
        assert got[i] == [m for _, m in want]


def test_preferences(spark):
    u, a, b = ("user", "hi"), ("assistant", "yes"), ("assistant", "no")
    rows = [(1, [u, a], [u, b], 0), (2, [u, a], [u, a], 0), (3, None, [u], 0), (4, [u, a, u], [u], 0), (5, [(None, None)], [], 0)]
    kind = "array<struct<role:string,text:string>>"
    got = {r["pair_id"]: r for r in formatted_preferences(spark.createDataFrame(rows, f"pair_id long, chosen {kind}, rejected {kind}, prompt int")).collect()}
    one = got[1]
    assert one["prompt"] == "<|im_start|>user\nhi<|im_end|>\n" and one["n_prompt_turns"] == 1
    s = one["chosen_spans"][0]
    assert one["chosen"][s["start"] : s["end"]] == "yes<|im_end|>" and len(one["chosen_spans"]) == 1
    assert (got[2]["chosen"], got[2]["rejected"], got[2]["chosen_spans"]) == ("", "", [])
    assert (got[3]["prompt"], got[3]["chosen"]) == ("", "") and got[3]["rejected"].startswith("<|im_start|>user")
    assert (got[4]["n_prompt_turns"], got[4]["rejected"]) == (1, "")
    assert got[5]["chosen"] == "<|im_start|>\n<|im_end|>\n"


def test_pairs_of_conversations(spark):
    """Null ids and turns, repeated rows, a neighbour that is missing or has no answer, extra columns, no rows."""
    rows = [
        (2, 0, "user", "hi"), (2, 1, "assistant", "yes"), (2, 2, "user", "bye"), (3, 0, "user", "hi"), (3, 1, "assistant", "no"), (3, 1, "assistant", "no"),
        (4, 0, "user", "x"), (4, 1, "assistant", "y"), (6, None, "user", "first"), (6, 0, "assistant", None), (7, 0, None, "z"), (None, 0, "user", "lost"),
    ]
    table = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn int, role string, text string, chosen string")
    got = {r["pair_id"]: ([tuple(t) for t in r["chosen"]], [tuple(t) for t in r["rejected"]]) for r in pairs_of_conversations(table).collect()}
    u, yes, no, bye = ("user", "hi"), ("assistant", "yes"), ("assistant", "no"), ("user", "bye")
    assert got[2] == ([u, yes, bye], [u, no]) and got[3] == ([u, no, no], [u, no, yes])
    assert got[4] == ([("user", "x"), ("assistant", "y")], [("user", "x")])
    assert got[6] == ([("user", "first"), ("assistant", "")], [("user", "first")]) and got[7] == ([("", "z")], [("", "z")])
    assert set(got) == {2, 3, 4, 6, 7} and pairs_of_conversations(table.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_matches_sql(spark, duck, name):
    assert rows_of(QUERIES[name](spark, f"{DATA}/sf0.001")) == sql_rows(duck, oracle.SQL[name])


PAGE = """<html><head><title>t</title><style>p{}</style></head><body><nav><ul><li><a href=a>Home</a><li><a href=b>More</a></ul></nav><header>Site</header><div class="cookie-notice">We use cookies</div>
<div id=main><article><h1>Title &amp; more</h1><p>First   long paragraph with words, and more
words.<p>Second <b>bold</b> one &eacute;.<ul><li>item<li>other item</ul></article><aside class=sidebar>Related <a href=x>links</a></aside></div>
<section class="comments"><p>A reader says something long enough to matter in a density measure.</p></section><form>Mail<input></form><script>var a="<p>no</p>"</script><footer>&copy; site</footer></body></html>"""


def test_main_text():
    assert main_text(PAGE) == "Title & more\nFirst long paragraph with words, and more words.\nSecond bold one é.\nitem\nother item"
    assert [main_text(x) for x in (None, "", "<nav>a</nav>", "plain", "<p>cut off <b", "<!-- x", "<p>a</b></i>b")] == ["", "", "", "plain", "cut off", "", "ab"]
    assert main_text("<div>" * 3000 + "deep") == "deep"


STORY = "<h1>Title</h1><p>A first paragraph of the story with a good number of words in it.</p><p>A second one, which goes on for about as long as the first.</p>"
TOLD = "Title\nA first paragraph of the story with a good number of words in it.\nA second one, which goes on for about as long as the first."


@pytest.mark.parametrize("label", ["class=content-sidebar-wrap", "class='site-content has-sidebar'", "class=no-sidebar", "class=fixed-header", "id=side-by-side", "class=with_menu", "data-role=menu"])
@pytest.mark.parametrize("inner", ["article", "div"])
def test_main_text_in_named_wrapper(label, inner):
    page = f"<body><nav><a href=a>Home</a></nav><div {label}><{inner}>{STORY}</{inner}><div class=sidebar>Something else</div></div><div class=footer>Site</div></body>"
    assert main_text(page) == TOLD


@pytest.mark.parametrize("label", ["role=navigation", "role=contentinfo", "role='complementary'", "class=navigation", "class=site-navigation", "class='x sidebar'", "id=footer", "class=comments-area"])
def test_main_text_without_named(label):
    """Comments are articles in some pages."""
    page = f"<body><div><article>{STORY}</article></div><section {label}><p>A reader says something long enough to matter here.</p><article class=comment>And another one answers them at length, too.</article></section></body>"
    if label.startswith("role") or "navigation" in label:
        page = page.replace("<article class=comment>", "<p>").replace("too.</article>", "too.</p>")
    assert main_text(page) == TOLD


@pytest.mark.parametrize(
    "page,text",
    [
        ('<div class="page has-sidebar"><p>article</p></div>', "article"),
        ('<div class="col with-sidebar-right"><p>article</p></div>', "article"),
        ('<div class="entry related-topic"><p>article</p></div>', "article"),
        ('<body><form id="aspnetForm"><div><p>article text</p><input><button>Go</button></div></form></body>', "article text"),
        ("<body><p title=it's>one more.</p><p>two don't go.</p></body>", "one more.\ntwo don't go."),
        ("<body><p>a</p><xmp>raw <b> &amp;</xmp></body>", "a\nraw <b> &amp;"),
        ("<a href='x>y'>l</a><p>z</p>", "l\nz"),
        ('<p a="b>c</p>d', "c\nd"),
        ("<p>" + "<i>" * 4000 + "deep " * 50_000 + "</i>" * 4000, ("deep " * 50_000).strip()),
        ("<p " + "a='" * 50_000 + ">x</p>", "x"),
    ],
)
def test_main_text_of_odd_pages(page, text):
    assert main_text(page) == text


def test_form_beside_the_article():
    page = f"<body><div><article>{STORY}</article></div><form><p>Write to us with all of your questions about this page.</p><label>Mail</label><input></form></body>"
    assert main_text(page) == TOLD


def test_main_text_of_unclosed_tags_is_linear():
    """Time in proportion to the page: no walk over the open elements for each tag."""
    began = time.perf_counter()
    for page in ("<b>" * 100_000 + "x", "<div><p>" * 40_000 + "x", "<table><tr><td>" * 25_000 + "x", "<li>" * 80_000 + "x", "</p>" * 80_000 + "x"):
        assert main_text(page) == "x"
    assert time.perf_counter() - began < 60


def test_comments_told_by_structure():
    """Beside the one article, comments, notes and unnamed footers are no text, whatever they are called and however much they say."""
    comments = "<ol class=commentlist>" + "<li>A reader says something here that is as long as a paragraph of the story.</li>" * 6 + "</ol>"
    for beside in (comments, comments.replace("commentlist", "x1"), "<div>Copyright 2024 Someone</div>", "<div><p>Read next: another story of some length, with no link at all.</p></div>"):
        assert main_text(f"<body><article>{STORY}</article>{beside}</body>") == TOLD
        assert main_text(f"<body>{beside}<main>{STORY}</main></body>") == TOLD
    head, rest = STORY.split("</h1>")
    assert main_text(f"<body>{head}</h1><article>{rest}</article><div>{comments}</div></body>") == TOLD
    assert main_text(f"<body><h1><a href=/>Site</a></h1><article>{STORY}</article></body>") == TOLD


def test_article_text_is_not_dropped_by_name():
    page = STORY.replace("<h1>", '<h1 class="entry-header">').replace("<p>A first", '<section id="side-effects"><p>A first').replace("in it.</p>", "in it.</p></section>")
    assert main_text(f"<body><article>{page}</article></body>") == TOLD


def test_several_articles_tell_nothing():
    """Comments that are articles themselves, and a placeholder that holds next to nothing."""
    assert main_text(f"<body><div>{STORY * 3}</div><main><p>Hi</p></main></body>").startswith(TOLD)
    two = f"<body><article>{STORY}</article><article>{STORY.replace('Title', 'Other')}</article></body>"
    assert "Title" in main_text(two) and "Other" in main_text(two)


def test_density_by_definition():
    """Counts and densities against a recursion over random trees."""
    r = random.Random(12)

    def tree(depth):
        inner = "".join(tree(depth - 1) if depth and r.random() < 0.7 else "w" * r.randrange(1, 30) + " " for _ in range(r.randrange(1, 4)))
        tag = r.choice(["div", "p", "a", "section", "span"]) if depth < 4 else "body"
        return f"<{tag}>{inner}</{tag}>" if tag != "p" else f"<div>{inner}</div>"

    def counted(x):
        c, t, lc, lt = 0, 0, 0, 0
        for y in x.parts:
            if isinstance(y, str):
                c += len("".join(y.split()))
            else:
                a, b, d, e = counted(y)
                c, t, lc, lt = c + a, t + b + 1, lc + d, lt + e + (y.tag == "a")
        return c, t, c if x.tag == "a" else lc, lt

    for _ in range(30):
        root = html_text.parse(tree(4))
        found = html_text.measure(root)
        c0, _, lc0, _ = counted(root)
        for x in found:
            c, t, lc, lt = counted(x)
            assert (x.chars, x.tags, x.link_chars, x.link_tags) == (c, t, lc, lt)
            if c:
                base = math.log(c / max(c - lc, 1) * lc + lc0 / c0 * c + math.e)
                want = c / max(t, 1) * max(math.log(c / max(lc, 1) * max(t, 1) / max(lt, 1)), 0) / base
                assert math.isclose(x.density, want, abs_tol=1e-12)
            assert math.isclose(x.total, sum(y.density for y in x.parts if not isinstance(y, str)), abs_tol=1e-12)


def test_articles_of_given_pages(spark):
    """Every given page's article, read with plain patterns."""
    for row in spark.read.parquet(f"{DATA}/sf0.01/pages.parquet").collect():
        body = re.search(r"<article>(.*?)</article>", row["html"], re.S)[1]
        body = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1|ul|li)>", "\0", re.sub(r"<br>", " ", body)))
        assert main_text(row["html"]) == "\n".join(y for x in body.split("\0") if (y := " ".join(html.unescape(x).split())))


def test_pages(spark):
    rows = [(1, "u", PAGE, "t"), (1, "u", PAGE, "t"), (2, None, None, None), (None, "", "<p>x" + "y" * 300_000, "")]
    got = extracted_pages(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert extracted_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert len(got) == 4 and all(r["n_chars"] == len(r["text"]) for r in got) and max(r["n_chars"] for r in got) == 300_001


def test_pipeline(spark):
    """Each stage keeps the columns, and drops what its operator says."""
    import corpus_pipeline as C

    sf = f"{DATA}/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in C.STAGES] == ["language_id", "toxicity", "jaccard_join", "decontamination", "packing"]
    sizes = [docs.count()]
    for _, stage in C.STAGES[:-1]:
        columns, docs = docs.columns, C.saved(stage(spark, docs, sf))
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > sizes[0] // 2
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert all(i == c for i, _, c in brute_components(rows, 5, 80))
    assert {r["doc_id"] for r in C.run(spark, sf).collect()} == {i for i, _ in rows}


def test_pipeline_edges(spark, tmp_path):
    """Null columns, repeated rows, one id with two texts, columns named like results, empty tables: each stage's decisions."""
    import corpus_pipeline as C

    sf, item = str(tmp_path), prose(70, 30)
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, lang_pred string, predicted int"
    rows = [(i, prose(i, 60), "en", "s", 1, 0.5, "own", 9) for i in range(6)]
    rows += [(6, None, None, None, None, None, None, None), (6, "", "en", "s", 0, 0.5, "own", 9), (None, prose(30, 60), None, None, None, 0.5, "own", 9)]
    rows += [(7, prose(31, 40) + " " + item, "en", "s", 1, 0.5, "own", 9), (7, prose(32, 60), "en", "s", 1, 0.5, "own", 9), (None, item, "en", "s", 1, 0.5, "own", 9), rows[0]]
    docs = spark.createDataFrame(rows, schema)
    spark.createDataFrame([(0, 0), (1, 1), (None, 1)], "doc_id long, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(0, item), (1, None)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    ids = lambda df: sorted((r["doc_id"] if r["doc_id"] is not None else -1, (r["text"] or "")[:9]) for r in df.collect())
    every = ids(docs)
    made = {name: stage(spark, docs, sf) for name, stage in C.STAGES}
    assert all(made[n].columns == docs.columns and made[n].where("score <> 0.5 or lang_pred <> 'own' or predicted <> 9").count() == 0 for n in list(made)[:4])
    assert ids(made["language_id"]) == [x for x in every if x[1]]
    assert len(ids(made["jaccard_join"])) == len(every) - 1
    assert ids(made["decontamination"]) == [x for x in every if x not in ((7, rows[9][1][:9]), (-1, item[:9]))]
    assert made["packing"].select("doc_id", "piece").count() >= len(every)
    assert {n: stage(spark, docs.limit(0), sf).count() for n, stage in C.STAGES} == dict.fromkeys(made, 0)


def test_near_duplicates_by_row(spark):
    """Repeated rows with one doc_id, rows without one, and a doc_id with two texts."""
    import corpus_pipeline as C

    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcde")
    rows = [(1, a), (1, a), (2, a + " x"), (2, b), (None, c), (None, c), (None, a), (None, d), (5, e), (4, e), (6, ""), (None, None), (7, "")]
    got = C.jaccard_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted(((r["doc_id"] or 0, r["text"] or "") for r in got)) == sorted([(1, a), (2, b), (0, c), (0, d), (4, e), (6, ""), (0, ""), (7, "")])
