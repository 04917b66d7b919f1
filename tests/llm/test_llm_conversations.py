"""Conversation repair against a uniform-cost search over whole conversations."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from ridelake.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string"
WS = "\x20\x09-\x0D"
GRAMMAR = {0: "su", 1: "u", 2: "a", 3: "u"}
AFTER = {"s": 1, "u": 2, "a": 3}


def cheapest(rows):
    """(cost, audit, repaired) of (role, fault) rows, by uniform cost, then audit."""
    heap, seen = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, state, kept = heapq.heappop(heap)
        if i == len(rows) and state in (0, 3):
            return cost, audit, list(kept)
        if (i, state) in seen:
            continue
        seen.add((i, state))
        new = "assistant" if state == 2 else "user"
        heapq.heappush(heap, (cost + 2, audit + "I", i, AFTER[new[0]], kept + ((new, None),)))
        if i < len(rows):
            role, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, kept))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if role[:1] and role[0] in GRAMMAR[state]:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, AFTER[role[0]], kept + ((role, i),)))
                heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, AFTER[new[0]], kept + ((new, i),)))


def brute(table):
    out, convs = [], {}
    for conv, turn, role, text in table:
        convs.setdefault(conv, [])
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        convs[conv] += [(turn, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, marked, count = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for turn, role, text in rows:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            marked.append((role, fault))
            if fault:
                count[fault] += 1
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in itertools.pairwise(rows))
        cost, audit, kept = cheapest(marked)
        text = "\n".join(f"{role}:{'' if i is None else rows[i][2]}" for role, i in kept)
        out.append((conv, gaps, *count.values(), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(n, seed=1, longest=14):
    rng, rows = random.Random(seed), []
    for conv in range(n):
        turn = 0
        for _ in range(rng.randint(1, longest)):
            turn += rng.choice([1, 1, 1, 1, 2, 5])
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "sage"]) if rng.random() < 0.4 else ("user", "assistant")[turn % 2]
            text = rng.choice(["Hello.", "Yes!", "What?", "no end", "  ", "", None, "Line.\n", "a" * 200 + rng.choice("bc") + "."] + [f"Text {rng.random()}."] * 9)
            rows.append((conv, turn if rng.random() < 0.95 else None, role, text))
    return rows


AWKWARD = [
    (None, 1, "user", "Hi."), (None, None, "user", "Ho."), (None, 2, "assistant", "x"), (900, None, None, None), (901, None, "user", "a."), (901, None, "user", "b."),
    (902, 1, "user", "same."), (902, 1, "user", "same."), (902, 1, "assistant", "same."), (903, 5, "user", "é" * 50000), (903, 6, "assistant", "\U0001f600 done."),
]


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_query_matches_brute_force(spark, tmp_path):
    rows = conversations(150) + AWKWARD
    random.Random(3).shuffle(rows)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    out = cr.op12_iterative_deepening(spark, str(tmp_path))
    assert out.columns == NAMES
    assert {t for n, t in out.dtypes if n in NAMES[:7]} == {"bigint"}
    assert got(out) == brute(rows)


def test_conversations_of_many_segments(spark):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool"]) if rng.random() < 0.5 else ("user", "assistant")[t % 2],
             rng.choice(["Fine.", "cut", f"T {t}.", f"U {t}.", ""])) for c in range(3) for t in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert got(cr.report(df, cr.ordered(cr.damaged(df)))) == brute(rows)


def test_repaired_rows_follow_the_grammar(spark):
    rows = conversations(60, seed=8, longest=90)
    fixed = {}
    for r in sorted(cr.repair(spark.createDataFrame(rows, SCHEMA)).collect(), key=lambda r: (r.conv_id, r["at"])):
        part = fixed.setdefault(r.conv_id, [])
        assert r["at"] == len(part) and r.edit in "IKR"
        part.append(r.role[0])
    assert len(fixed) > 50 and all(re.fullmatch("s?(ua)+", "".join(p)) for p in fixed.values())


def test_empty_table_other_columns_and_all_rows_dropped(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cr.report(empty, cr.ordered(cr.damaged(empty))).collect() == []
    gone = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    rows = [(1, gone, "user", "Hello.")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("mine") for c in ("pos", "fault", "seg", "symbol", "code", "copy", "spread", "digest")})
    assert got(cr.report(df, cr.ordered(cr.damaged(df)))) == brute(rows) == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
    df = spark.createDataFrame(conversations(20), SCHEMA).withColumn("plan", F.lit(1)).withColumn("cost", F.lit(2))
    assert got(cr.report(df, cr.ordered(cr.damaged(df)))) == brute(conversations(20))


@pytest.mark.parametrize("seed", range(3))
def test_search_equals_uniform_cost_and_bounds_are_admissible(seed):
    rng = random.Random(seed)
    faults = {**dict.fromkeys(cr.KEPT, None), **dict.fromkeys(cr.CUT, "truncated"), **dict.fromkeys(cr.GONE, "blank")}
    role = dict(zip(cr.KEPT + cr.CUT + cr.GONE, ["system", "user", "assistant", "tool"] * 3))
    for _ in range(400):
        symbols = "".join(rng.choice(cr.KEPT * 3 + cr.CUT + cr.GONE) for _ in range(rng.randint(0, 9)))
        cost, audit, _ = cheapest([(role[s], faults[s]) for s in symbols])
        assert cr.search(symbols, cr.START, cr.END)[:2] == (cost, audit)
        assert cr.Estimate(symbols, cr.END)(0, cr.START) <= cost
        cut = rng.randint(0, len(symbols))
        parts = [s for s in (symbols[:cut], symbols[cut:]) if s]
        if parts:
            path = cr.joined([cr.segment_paths(s, i == 0, i == len(parts) - 1) for i, s in enumerate(parts)])
            assert (path.cost, "".join(p.edits for p in path.parts())) == (cost, audit)
