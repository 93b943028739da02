import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest

from boxframe.llm import conversations as c

SHAPE = "conv_id long, turn long, role string, text string"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def plain_repair(rows):
    """Of one conversation: shortest paths over (row, state), by cost and then by letters."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    faults, seen = [], set()
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\v\f\r")
        blank, twice = not bare, (role, text) in seen
        faults.append("blank" if blank else "duplicate" if twice else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    fill = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}
    heap = [(0, "", 0, 0, ())]
    done = set()
    while True:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in (0, 3):
            break
        to, name = fill[state]
        heapq.heappush(heap, (cost + 2, audit + "I", i, to, (*lines, f"{name}:")))
        if i == len(rows):
            continue
        _, _, role, text = rows[i]
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, lines))
        if faults[i] in ("blank", "duplicate"):
            continue
        late = faults[i] == "truncated"
        heapq.heappush(heap, (cost + 2 + late, audit + "R", i + 1, to, (*lines, f"{name}:{text}")))
        kept = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}.get((state, role[:1]))
        if kept is not None:
            heapq.heappush(heap, (cost + late, audit + "K", i + 1, kept, (*lines, f"{role}:{text}")))
    turns = [r[1] for r in rows if r[1] is not None]
    pairs = [a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(pairs), "cost": cost, "audit": audit, "sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def found(spark, rows, damage=False, **options):
    given = spark.createDataFrame(rows, SHAPE)
    repaired = c.repair(given, c.damaged(given) if damage else None, **options)
    joined = repaired.summary.join(c.digests(repaired), "conv", "left").toPandas()
    empty = hashlib.sha256(b"").hexdigest()
    return {r["conv"]: {k: (("" if k == "audit" else empty) if pd.isna(r[k]) else r[k]) for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "sha256")} for _, r in joined.iterrows()}


def expected(rows, damage=False):
    groups = {" " if r[0] is None else str(r[0]): [] for r in rows}
    for r in plain_damage(rows) if damage else [tuple(" " if v is None and i > 1 else v for i, v in enumerate(r)) for r in rows]:
        groups[" " if r[0] is None else str(r[0])].append(r)
    return {k: plain_repair(v) for k, v in groups.items()}


def conversations(seed, n, longest):
    rng, rows = random.Random(seed), []
    for conv in range(n):
        for turn in range(rng.randint(0, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "no", "  ", "", None, "What? ", "a.\n", "b! ", f"t{turn}."])
            rows.append((conv if conv else None, rng.choice([turn, turn, turn * 3, None]), role, text))
    return rows


@pytest.mark.parametrize(("chunk", "passes", "run"), [(64, 6, 1024), (3, 6, 1024), (2, 0, 2), (1, 1, 3)])
def test_against_shortest_paths(spark, chunk, passes, run):
    rows = conversations(chunk, 25, 14)
    assert found(spark, rows, chunk=chunk, passes=passes, run=run) == expected(rows)


def test_damage(spark):
    rows = [(i % 40 or None, i // 40, "user" if i // 40 % 2 == 0 else "assistant", f"Turn {i}. More!") for i in range(400)]
    assert found(spark, rows, damage=True) == expected(rows, damage=True)


@pytest.mark.parametrize("roles", [["tool"], ["user"], ["user", "assistant"], ["system", "tool", "user"]])
def test_long_conversations_whose_costs_forget_slowly(spark, roles):
    """Many chunks of roles that repeat: what passes leave open is settled by matrices in several levels."""
    rows = [(1, i, roles[i % len(roles)], f"{i}.") for i in range(150)] + [(1, 150, "user", "end")]
    assert found(spark, rows, chunk=4, passes=1, run=3) == expected(rows)


def test_hot_conversation_in_several_windows(spark):
    rows = [(7, i % 50, "user" if i % 2 else "assistant", f"{i}.") for i in range(300)] + [(1, 0, "user", "x.")]
    assert found(spark, rows, chunk=8, hot_rows=20) == expected(rows)


def test_very_long_text_empty_table_and_clashing_columns(spark):
    long = "word " * 200_000 + "end."
    rows = [(1, 0, "user", long), (1, 1, "assistant", long), (1, 2, "assistant", long)]
    assert found(spark, rows) == expected(rows)
    assert found(spark, []) == {}
    from pyspark.sql import functions as F

    odd = spark.createDataFrame([(1, 0, "user", "a.")], SHAPE).withColumns({"place": F.lit("x"), "conv": F.lit("y"), "code": F.lit(1)})
    assert c.repair(odd).rows.count() == 2


def test_rows_are_the_repaired_turns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hello."), (1, 2, "assistant", "Yes.")]
    repaired = c.repair(spark.createDataFrame(rows, SHAPE))
    listed = [(r.edit, r.role, r.text) for r in repaired.rows.orderBy("place", "step").collect()]
    assert listed == [("K", "user", "Hi."), ("I", "assistant", ""), ("K", "user", "Hello."), ("K", "assistant", "Yes.")]


def test_a_pass_stops_where_vectors_agree():
    codes = np.array([[1, 2] * 20], np.uint8)
    first = c.backward(codes, c.END[None])
    again = c.backward(codes, np.array([[1, 3, 0, 1]]), first)
    assert (again[0, :30] == first[0, :30]).all() and (again == c.backward(codes, np.array([[1, 3, 0, 1]]))).all()
