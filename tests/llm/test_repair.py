from __future__ import annotations

import hashlib
import random
import sys
import zlib
from functools import lru_cache
from itertools import product

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from linkyard.llm.repair import END, REPAIR_SQL, START, Blocks, cost_matrix, damaged, repair, repair_report, replay

sys.setrecursionlimit(20_000)
SPACE = " \t\n\x0b\x0c\r"
FAULTS = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [] if kind == 0 else [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def solve(rows):
    """``(cost, audit, repaired rows)`` of ``(role, text, must go, truncated)`` rows by plain recursion over (rows, last initial)."""
    @lru_cache(None)
    def best(i, came, put):
        options = [(0, "", ())] if i == len(rows) and came in "-a" else []
        due = "a" if came == "u" else "u"
        if put < 2:
            c, a, r = best(i, due, put + 1)
            options.append((c + 5, "I" + a, ((("user", "assistant")[due == "a"], ""), *r)))
        if i < len(rows):
            role, text, gone, late = rows[i]
            c, a, r = best(i + 1, came, 0)
            options.append((c + 2, "D" + a, r))
            if not gone:
                if role[:1] == due or (came == "-" and role[:1] == "s"):
                    c, a, r = best(i + 1, role[:1], 0)
                    options.append((c + 5 * late, "K" + a, ((role, text), *r)))
                c, a, r = best(i + 1, due, 0)
                options.append((c + 1 + 5 * late, "R" + a, ((("user", "assistant")[due == "a"], text), *r)))
        return min(options, default=(10**9, "~", ()))
    return best(0, "-", 0)


def brute(rows):
    """Result by conversation of the damaged ``rows``."""
    convs = {}
    for r in rows:
        convs.setdefault(r[0], []).append(r[1:])
    out = {}
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), hashlib.md5(t[2].encode()).hexdigest()))
        seen, classed, count = set(), [], dict(blank=0, duplicate=0, truncated=0)
        for _, role, text in turns:
            kept = text.rstrip(SPACE)
            fault = "blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                count[fault] += 1
            classed.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        known = [t[0] for t in turns if t[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit, made = solve(tuple(classed))
        out[conv] = (gaps, *count.values(), illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest())
    return out


def got(df):
    return {r.conv_id: tuple(r[c] for c in FAULTS) for r in df.collect()}


def random_rows(seed, n_convs):
    rnd, rows = random.Random(seed), []
    roles, texts = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "superb"], ["ok.", "yes", "no!", " ", "", None, "\t\n", "a? ", "b.\x0b", "é…"]
    for conv in range(n_convs):
        for turn in range(rnd.randint(0, 14)):
            rows.append((conv, None if rnd.random() < .08 else turn + rnd.choice([0, 0, 0, 3]), rnd.choice(roles),
                         rnd.choice(texts) if rnd.random() < .4 else f"text {conv} {turn} {rnd.random()}" + rnd.choice([".", "", "!"])))
    return rows + [(None, 1, "user", "hi."), (None, 2, "assistant", "ho."), (None, None, "user", "he")]


@pytest.fixture(scope="module")
def odd_turns():
    hot = [(-5, i // 3, ("user", "assistant", "system")[i % 3], f"hot {i % 37}" + (".", "")[i % 5 == 0]) for i in range(900)]
    return random_rows(4, 150) + hot + [(-6, 2, "user", "same.")] * 500 + [(-8, None, "user", f"n{i}.") for i in range(60)]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.withColumns({c: F.lit("x") for c in ("n", "rng", "seq", "codes", "cost", "audit", "first", "is_row", "conv", "kind", "copy")})


def test_every_short_conversation_against_recursion():
    """All conversations of up to four rows over a few kinds of rows, solved in one batch and as one block each."""
    kinds = [("system", "s.", False, False), ("user", "u.", False, False), ("assistant", "a.", False, False), ("x", "x.", False, False),
             ("user", "", True, False), ("assistant", "late", False, True), ("system", "late", False, True)]
    initial = {"s": 0, "u": 1, "a": 2}
    cases = [c for n in range(5) for c in product(kinds, repeat=n) if n < 4 or c[0] is not c[1]]
    codes = [np.array([8 * g + 4 * t + initial.get(r[0], 3) for r, _, g, t in c], np.uint8) for c in cases]
    blocks = Blocks(codes, np.tile(END, (len(cases), 1)), np.ones(len(cases), bool))
    for case, solved in zip(cases, blocks.audits([[START]] * len(cases))):
        cost, audit, made = solve(case)
        assert solved[0][1:] == (audit, cost)
        assert tuple(replay(audit, [(r, t, 1) for r, t, _, _ in case])) == made


def test_cost_matrix_combines_blocks():
    rnd = np.random.default_rng(1)
    code = rnd.integers(0, 12, 200).astype(np.uint8)
    whole = Blocks([code], END[None], np.array([True]))
    cost = END
    for lo in range(180, -1, -20):
        cost = (cost_matrix(code[lo: lo + 20]) + cost[None, :]).min(1)
    assert (cost == whole.cost[0]).all()


@pytest.mark.parametrize("block_rows,range_bytes", [(4096, 16e6), (7, 2000.0)])
def test_odd_conversations_against_recursion(spark, odd_turns, block_rows, range_bytes):
    """Nulls, repeated rows, other roles, clashing columns; small blocks and ranges cut conversations in many."""
    docs = frame(spark, odd_turns).repartition(4)
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in odd_turns]
    assert got(repair(docs, block_rows=block_rows, range_bytes=range_bytes)) == brute(plain)


def test_damage_and_lost_conversations(spark, odd_turns):
    gone = [c for c in range(10_000, 10_400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:5]
    rows = odd_turns + [(c, 0, "user", "gone.") for c in gone]
    docs = frame(spark, rows)
    assert sorted(map(str, damaged(docs).collect())) == sorted(map(str, spark.createDataFrame(
        damage(rows), "conv_id long, turn long, role string, text string").collect()))
    want = brute(damage(rows))
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got(repair_report(docs)) == {c: want.get(c, empty) for c, *_ in rows}
    assert len(gone) == 5


def test_empty(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair_report(none).count() == 0
    assert repair(none).count() == 0


def test_whole_table_against_sql(spark):
    path = "/root/testdata/sf0.001/conversations.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}'")
    want = con.execute(REPAIR_SQL)
    names = [d[0] for d in want.description]
    rows = sorted(map(str, want.fetchall()))
    assert rows == sorted(str(tuple(r)) for r in repair_report(spark.read.parquet(path)).select(*names).collect())
