"""Conversation repair against a plain restatement of damage, faults and cheapest edits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from storeledger.llm import turn_repair

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]")


def damage(rows):
    """(conv_id, turn, role, text) after damage, as the contract says it."""
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        for _ in range(2 if fate == 3 else 1):
            yield conv, turn, role, text


def cheapest(turns):
    """(cost, audit, repaired) by trying every edit in every state, front to back.

    `turns` are (role, text, must go, truncated). Per place and state the best of all
    edit strings is kept by (cost, string), states being the legal prefixes of roles.
    """
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    full = {"u": "user", "a": "assistant"}
    best = {(0, ""): (0, "", ())}

    def offer(table, key, cost, audit, lines):
        if key not in table or (cost, audit) < table[key][:2]:
            table[key] = (cost, audit, lines)

    def inserted(table):
        for _ in range(3):
            for state, (cost, audit, lines) in list(table.items()):
                for new in set(follow[state]) & set("ua"):
                    offer(table, new, cost + 5, audit + "I", (*lines, f"{full[new]}:"))

    table = {"": (0, "", ())}
    inserted(table)
    for role, text, must_go, truncated in turns:
        after, extra = {}, 5 if truncated else 0
        for state, (cost, audit, lines) in table.items():
            offer(after, state, cost + 2, audit + "D", lines)
            if must_go:
                continue
            if role[:1] and role[:1] in follow[state]:
                offer(after, role[0], cost + extra, audit + "K", (*lines, f"{role}:{text}"))
            for new in set(follow[state]) & set("ua"):
                offer(
                    after, new, cost + 1 + extra, audit + "R", (*lines, f"{full[new]}:{text}")
                )
        table = after
        inserted(table)
    cost, audit, lines = min(table[s] for s in ("", "a") if s in table)
    return cost, audit, "\n".join(lines)


def said_hash(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def judged(rows):
    """{conv_id: result} of a table, by the plain way."""
    of = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in damage(rows):
        of[conv].append((turn, role, text))
    found = {}
    for conv, turns in of.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, said_hash(t[1], t[2])))
        seen, marked, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in turns:
            last = WORD.findall(text)[-1:]
            kind = (
                "blank" if not last
                else "duplicate" if (role, text) in seen
                else "truncated" if last[0] not in ".!?"
                else None
            )
            seen.add((role, text))
            if kind:
                counts[kind] += 1
            marked.append((role, text, kind in ("blank", "duplicate"), kind == "truncated"))
        initials = [t[1][:1] for t in turns]
        illegal = sum(a + b not in ("su", "ua", "au") or not a for a, b in zip(initials, initials[1:]))
        known = [t[0] for t in turns if t[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        cost, audit, repaired = cheapest(marked)
        found[conv] = (gaps, *counts.values(), illegal, cost, audit,
                       hashlib.sha256(repaired.encode()).hexdigest())
    return found


def made_up(seed, n, hot=None):
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        conv = hot if hot is not None and draw.random() < 0.4 else draw.choice([None, *range(12)])
        turn = draw.choice([None, *range(-2, 40)])
        role = draw.choice(["user", "user", "assistant", "assistant", "system", "tool", "", None])
        text = draw.choice(["", " \n", "Yes.", "No", "Why? ", "é…", None, f"w{draw.randrange(60)}."])
        rows.append((conv, turn, role, text))
    return rows


def results(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[n] for n in names) for r in rows}


@pytest.mark.parametrize("signs, edits, cost", [
    ("", "", 0),
    ("BC", "KK", 0),  # user, assistant
    ("ABC", "KKK", 0),
    ("B", "D", 2),
    ("CB", "RR", 2),  # Two new roles cost less than two deletions.
])
def test_small_conversations(signs, edits, cost):
    assert turn_repair.edits_of(signs, 0, 0, True, turn_repair.tables()) == (edits, cost)


def test_blocks_and_segments_agree_with_every_edit_tried():
    made, draw = turn_repair.tables(), random.Random(3)
    names = ["system", "user", "assistant", "other"]
    for _ in range(400):
        signs = "".join(chr(65 + draw.randrange(16)) for _ in range(draw.randrange(0, 20)))
        codes = [ord(c) - 65 for c in signs]
        turns = [(names[c % 4], "x", c // 4 >= 2, c // 4 == 1) for c in codes]
        cost, audit, _ = cheapest(turns)
        assert turn_repair.edits_of(signs, 0, 0, True, made) == (audit, cost)
        cuts = sorted(draw.randrange(0, len(signs) + 1) for _ in range(3))
        parts = [signs[a:b] for a, b in zip([0, *cuts], [*cuts, len(signs)]) if a < b]
        if parts:
            bounds = turn_repair.handed_down([turn_repair.summed_up(p, made) for p in parts], 0, 0)
            got = [
                turn_repair.edits_of(p, v, q, i == len(parts) - 1, made)
                for i, (p, (v, q)) in enumerate(zip(parts, bounds, strict=True))
            ]
            assert ("".join(g[0] for g in got), sum(g[1] for g in got)) == (audit, cost)


@pytest.mark.parametrize("hot, size", [(None, 300), (7, 900)])
def test_repair_equals_the_plain_way(spark, hot, size):
    rows = made_up(size, size, hot)
    table = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit(1)).repartition(5)
    # Small segments and a small fan-in: a hot conversation spans levels of them.
    got = turn_repair.repair(table, turn_repair.damaged(table), segment_rows=8, fan_in=3)
    assert results(got) == judged(rows)


def test_one_row_repeated_by_a_third_of_all(spark):
    rows = [(None, None, "user", "Same.")] * 200 + made_up(1, 100)
    table = spark.createDataFrame(rows, SCHEMA)
    got = turn_repair.repair(table, turn_repair.damaged(table), segment_rows=16, fan_in=4)
    assert results(got) == judged(rows)


def test_large_ids_empty_tables_and_long_texts(spark):
    big = [9007199254740993, None, 9007199254740995]
    rows = [(c, t, r, "word " * 200_000 + ".") for c in big for t, r in ((1, "user"), (2, "assistant"))]
    table = spark.createDataFrame(rows, SCHEMA)
    assert results(turn_repair.repair(table, turn_repair.damaged(table))) == judged(rows)
    empty = spark.createDataFrame([], SCHEMA)
    assert turn_repair.repair(empty, turn_repair.damaged(empty)).count() == 0


def test_conversation_that_damage_empties(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(conv, 0, "user", "Hello.")]
    table = spark.createDataFrame(rows, SCHEMA)
    expected = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert results(turn_repair.repair(table, turn_repair.damaged(table))) == {conv: expected}
