"""Operator 12 against a dynamic program over whole conversations."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sensorlab.llm import conversation_repair as cr
from sensorlab.llm import queries
from tests.llm import helpers as h

TURNS = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        x = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if x == 1 else re.sub("[.!?]", "", text) if x == 2 else text
        out += [(conv, turn, "user" if x == 4 else role, text)] * (0 if x == 0 else 2 if x == 3 else 1)
    return out


def least(rows, faults):
    """(cost, audit, repaired) from the last row to the first; at most two inserts follow each other."""
    follow = {0: "su", 1: "u", 2: "a", 3: "u"}
    best = {s: (0, "", ()) if s in (0, 3) else None for s in range(4)}

    def with_inserts(best):
        for _ in range(3):
            for s in range(4):
                role, then = ("assistant", 3) if s == 2 else ("user", 2)
                if best[then]:
                    cost, audit, lines = best[then]
                    new = (cost + 5, "I" + audit, (f"{role}:", *lines))
                    best[s] = min(best[s] or new, new)
        return best

    best = with_inserts(best)
    for (role, text), fault in reversed(list(zip(rows, faults))):
        new = {}
        for s in range(4):
            options = []
            if best[s]:
                options.append((best[s][0] + 2, "D" + best[s][1], best[s][2]))
            if fault in ("", "truncated"):
                more = 5 if fault else 0
                initial = role[:1]
                if initial and initial in follow[s]:
                    then = best["sua".index(initial) + 1]
                    options += [(then[0] + more, "K" + then[1], (f"{role}:{text}", *then[2]))] if then else []
                wanted, then = ("assistant", best[3]) if s == 2 else ("user", best[2])
                options += [(then[0] + 1 + more, "R" + then[1], (f"{wanted}:{text}", *then[2]))] if then else []
            new[s] = min(options, default=None)
        best = with_inserts(new)
    return best[0]


def brute(rows, harm=True):
    convs = defaultdict(list)
    for conv in {r[0] for r in rows}:
        convs[conv] = []
    for r in (damage(rows) if harm else [(*r[:2], *(" " if x is None else x for x in r[2:])) for r in rows]):
        convs[r[0]].append(r)
    out = set()
    for conv, turns in convs.items():
        turns.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        seen, faults = set(), []
        for _, _, role, text in turns:
            end = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            faults.append("blank" if not end else "duplicate" if (role, text) in seen
                          else "" if end[-1] in ".!?" else "truncated")
            seen.add((role, text))
        known = [r[1] for r in turns if r[1] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit, lines = least([r[2:] for r in turns], faults)
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.add((conv, gaps, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha))
    return out


def random_turns(seed, convs, most):
    rng = random.Random(seed)
    rows = []
    for conv in range(convs):
        turn = rng.randint(-2, 3)
        for _ in range(rng.randint(1, most)):
            turn += rng.choice([1, 1, 1, 1, 0, 3])
            rows.append((conv if conv else None, None if rng.random() < 0.05 else turn,
                         rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User", "usher"]),
                         rng.choice(["Yes.", "No!", "so", "so ", "x\n", "", " \t\x0b", None, f"é{rng.random()}.", f"t {rng.random()}?\n"])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, convs, most", [(1, 120, 9), (2, 6, 400)])
def test_equals_brute_force(spark, seed, convs, most, monkeypatch):
    rows = random_turns(seed, convs, most)
    got = cr.repair(cr.damaged(spark.createDataFrame(rows, TURNS).repartition(5)))
    assert h.rows(got, *NAMES) == brute(rows)


@pytest.mark.parametrize("block", [1, 2, 7])
def test_blocks_do_not_change_the_result(spark, block):
    rng = random.Random(block)
    for _ in range(60):
        code = "".join(rng.choice(cr.SYMBOLS) for _ in range(rng.randint(0, 14)))
        whole = cr.Search(code).cheapest(0, cr.ANY_END)
        rest = None
        parts = [code[i:i + block] for i in range(0, len(code), block)] or [""]
        for part in reversed(parts):
            search, found = cr.Search(part), {}
            for s, e in itertools.product(range(4), range(5)):
                got = search.cheapest(s, e)
                if got is None or (rest is None) != (e == cr.ANY_END) or (rest is not None and e not in rest):
                    continue
                new = (got[0], (got[1], None)) if rest is None else (got[0] + rest[e][0], (got[1], rest[e][1]))
                if cr._better(new, found.get(s)):
                    found[s] = new
            rest = found
        cost, chain = rest[0]
        text = ""
        while chain:
            text, chain = text + chain[0], chain[1]
        assert (cost, text) == whole


def test_one_conversation_over_many_partitions(spark):
    rng = random.Random(11)
    rows = [(5, t, rng.choice(["user", "assistant", "system"]), rng.choice(["ok.", f"{t}.", f"{t}", " "])) for t in range(900)]
    rows += [(6, 0, "user", "a."), (6, 1, "assistant", "b.")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = h.rows(cr.repair(cr.plain(spark.createDataFrame(rows, TURNS))), *NAMES)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == brute(rows, harm=False)


def test_whole_table_and_repaired_turns(spark):
    table = spark.read.parquet(f"{h.SF}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = queries.op12_conversation_repair(spark, h.SF)
    assert got.columns == NAMES and h.rows(got, *NAMES) == brute(rows)
    lines = defaultdict(list)
    for r in cr.repaired_turns(cr.damaged(table)).orderBy("conv_id", "position").collect():
        lines[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    assert all(h.sha("\n".join(lines[r["conv_id"]])) == r["repaired_sha256"] for r in got.collect())


def test_odd_tables(spark):
    rows = random_turns(4, 30, 6) + [(900, 1, "user", "word " * 50_000 + "end."), (901, None, None, None)]
    df = spark.createDataFrame(rows, TURNS)
    extra = df
    for name in ("copies", "digest", "kind", "first", "code", "audit", "part", "no"):
        extra = extra.withColumn(name, F.lit("x"))
    assert h.rows(cr.repair(cr.damaged(extra)), *NAMES) == brute(rows)
    twice = df.union(df)
    assert h.rows(cr.repair(cr.damaged(twice)), *NAMES) == brute(rows + rows)
    assert cr.repair(cr.damaged(df.limit(0))).collect() == []
