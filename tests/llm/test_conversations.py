import hashlib
import heapq
import itertools
import random
import re
import zlib

from genospark.llm.conversation_repair import conversation_summaries, damaged, repaired_turns, tables

BLANK = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(rows):
    """rows of (role, text, fault): (cost, audit, repaired rows) by a search through all scripts, cheapest and ASCII-least first."""
    heap, seen = [(0, "", 0, ())], set()
    while True:
        cost, audit, i, out = heapq.heappop(heap)
        roles = "".join(r[:1] if r[:1] in tuple("sua") else "o" for r, _ in out)
        if not re.fullmatch(r"s?(ua)*u?", roles) or (i, roles) in seen:
            continue
        if i == len(rows) and re.fullmatch(r"(s?(ua)+)?", roles):
            return cost, audit, out
        seen.add((i, roles))
        for role in ("user", "assistant"):
            if len(out) <= 2 * len(rows) + 2:
                heapq.heappush(heap, (cost + 2, audit + "I", i, (*out, (role, ""))))
        if i == len(rows):
            continue
        role, text, fault = rows[i]
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, out))
        if fault not in ("blank", "duplicate"):
            late = fault == "truncated"
            heapq.heappush(heap, (cost + late, audit + "K", i + 1, (*out, (role, text))))
            for to in ("user", "assistant"):
                heapq.heappush(heap, (cost + 2 + late, audit + "R", i + 1, (*out, (to, text))))


def by_definition(turns):
    """{conv: result} of rows (conv, turn, role, text), damage included, from the definition alone."""
    out = {}
    for conv, rows in itertools.groupby(sorted(turns, key=lambda r: (r[0] is not None, r[0] or 0)), key=lambda r: r[0]):
        after = []
        for _, turn, role, text in rows:
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            after += [] if kind == 0 else [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, judged = set(), []
        for _, role, text in after:
            solid = BLANK.findall(text)
            judged.append((role, text, "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""))
            seen.add((role, text))
        cost, audit, repaired = cheapest(judged)
        numbers = [t for t, _, _ in after if t is not None]
        initials = [r[:1] for r, _, _ in judged]
        faults = [f for _, _, f in judged]
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest(),
        )
    return out


def conversations(seed, n, longest):
    r = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(r.randrange(1, longest)):
            role = r.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "User"])
            text = r.choice(["Yes.", "No!", "Why? ", "so on", "", " \t\n", None, "é.", "…", "x" * r.randrange(40) + "."])
            rows.append((conv, turn * r.choice([1, 1, 1, 3]) if r.random() > 0.05 else None, role, text))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def found(spark, rows, schema=SCHEMA):
    out = conversation_summaries(repaired_turns(damaged(spark.createDataFrame(rows, schema)))).collect()
    assert len({r["conv_id"] for r in out}) == len(out)
    return {r["conv_id"]: tuple(r)[1:] for r in out}


def test_repairs_by_definition(spark):
    rows = conversations(1, 600, 9) + [(None, 0, "user", "Hi."), (None, None, None, None)]
    assert found(spark, rows) == by_definition(rows)


def test_longer_than_a_batch(spark):
    """Conversations whose rows and blocks are cut by Arrow batches give the same."""
    rows = conversations(2, 12, 60)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        want = found(spark, rows)
        spark.conf.set(key, "3")
        assert found(spark, rows) == want
    finally:
        spark.conf.set(key, before)
    short = [r for r in rows if r[0] < 6 and (r[1] or 0) < 12]
    assert found(spark, short) == by_definition(short)


def test_edges(spark):
    assert found(spark, []) == {}
    dropped = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert found(spark, [(7, dropped, "user", "Hi.")]) == {7: (0, 0, 0, 0, 0, 0, "", empty)}
    long = [(1, 5, "user", "word " * 400_000 + "."), (1, 6, "assistant", "Yes.")]
    assert found(spark, long) == by_definition(long)
    again = conversations(3, 40, 6) * 2
    assert found(spark, again) == by_definition(again)


def test_turns_and_clashing_columns(spark):
    """Real turns come out, in order; columns named like results are ignored; without `present` all turns are there."""
    rows = [(1, 0, "system", "Be kind.", "a", 9), (1, 1, "assistant", "Hello.", "b", 9), (1, 2, "user", "", "c", 9), (2, 0, "user", "Well", "d", 9)]
    got = repaired_turns(spark.createDataFrame(rows, SCHEMA + ", fault string, block int")).orderBy("conv_id", "step").collect()
    assert [(r["conv_id"], r["step"], r["edit"], r["was"], r["role"], r["text"], r["fault"], r["cost"]) for r in got] == [
        (1, 0, "K", "system", "system", "Be kind.", "", 0),
        (1, 1, "I", None, "user", "", None, 2),
        (1, 2, "K", "assistant", "assistant", "Hello.", "", 0),
        (1, 3, "D", "user", None, None, "blank", 3),
        (2, 0, "D", "user", None, None, "truncated", 3),
    ]


def test_one_hot_conversation(spark):
    """A third of all rows in one conversation."""
    rows = conversations(4, 300, 6) + [(10**6, t, "user" if t % 2 else "assistant", f"{t}.") for t in range(600)]
    got = found(spark, rows)
    assert len(got[10**6][6]) >= 500 and got == by_definition([r for r in rows if r[0] != 10**6]) | {10**6: got[10**6]}


def test_tables_follow_from_single_steps():
    vectors, step, block = tables()
    r = random.Random(5)
    for _ in range(500):
        v, s = r.randrange(len(vectors)), [r.randrange(9) for _ in range(4)]
        code, w = 0, v
        for x in s:
            code, w = code * 9 + x, step[w, x]
        assert block[v, code] == w
    assert all(min(v) == 0 for v in vectors)
