"""Hard negatives against every pair scored in whole numbers."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from storeledger.llm import hard_negatives as mining

SCHEMA = "vec_id long, embedding array<double>, label int"
LIMITS = (-(1 << 63), (1 << 63) - 1)


def whole(x):
    return math.floor(x * 256) if abs(x) < 2.0**44 else int(x) * 256


def plain(rows, positives=5, negatives=3, every=50):
    fit = [
        (i, [whole(x) for x in v], label)
        for i, v, label in rows
        if i is not None and label is not None and v is not None
        and all(x is not None and math.isfinite(x) for x in v)
    ]
    found = []
    for a_id, a, a_label in fit:
        if a_id % every:
            continue
        scored = [
            (-max(LIMITS[0], min(LIMITS[1], sum(x * y for x, y in zip(a, v)))), i, label == a_label)
            for i, v, label in fit
            if i != a_id
        ]
        for neg_p, p_id, same in sorted(s for s in scored if s[2])[:positives]:
            p = -neg_p
            fits = sorted(s for s in scored if not s[2] and 50 * p <= 100 * -s[0] <= 95 * p)
            for rank, (neg, n_id, _) in enumerate(fits[:negatives], 1):
                found.append((a_id, p_id, rank, n_id, p, -neg))
    return sorted(found)


def rows_of(df):
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def vectors(seed, n, scale=1.0, width=11, labels=4, ids=None):
    draw = random.Random(seed)
    centers = [[draw.gauss(0, 1) for _ in range(width)] for _ in range(labels)]
    rows = []
    for i in range(n):
        # A third of the rows have one label; components are coarse, so scores tie.
        label = 0 if draw.random() < 0.35 else draw.randrange(labels)
        v = [round((c + draw.gauss(0, 0.8)) * 8) / 8 * scale for c in centers[label]]
        rows.append((ids(i) if ids else i, v, label))
    return rows


@pytest.mark.parametrize("rows, per_shard", [
    (vectors(1, 300), None),
    (vectors(2, 400), 60),
    (vectors(3, 200, scale=2.0**20), 50),  # Sums beyond exact doubles.
    (vectors(4, 120, scale=1e305), 40),  # Scores beyond a long.
    (vectors(5, 260, ids=lambda i: 9007199254740950 + i), 70),
    (vectors(6, 260, ids=lambda i: i % 90), 70),  # Repeated ids, anchors too.
], ids=["one shard", "shards", "large", "giant", "large ids", "repeated ids"])
def test_equals_every_pair_scored(spark, rows, per_shard):
    table = spark.createDataFrame(rows, SCHEMA).withColumn("row", F.lit("x")).repartition(4)
    got = mining.hard_negatives(table, every=10, rows_per_shard=per_shard)
    expected = plain(rows, every=10)
    assert expected or max(map(max, (r[1] for r in rows))) > 1e300
    assert rows_of(got) == expected


def test_rows_that_take_no_part_and_short_vectors(spark):
    good = vectors(7, 80)
    odd = [
        (None, [1.0] * 11, 1), (101, None, 1), (102, [1.0] * 11, None), (103, [None] * 11, 1),
        (104, [math.nan] * 11, 1), (105, [math.inf] * 11, 1), (106, [], 1), (110, [4.0], 2),
        (120, [0.0] * 11, 0),
    ]
    table = spark.createDataFrame(good + odd, SCHEMA)
    got = mining.hard_negatives(table, every=10, rows_per_shard=30)
    assert rows_of(got) == plain(good + odd, every=10)


def test_own_label_rule_few_rows_and_empty_tables(spark):
    rows = vectors(8, 150)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    moved = [(i, v, (c + 1) % 10 if i % 7 == 0 else c) for i, v, c in rows]
    got = mining.hard_negatives(spark.createDataFrame(rows, SCHEMA), label=label)
    assert rows_of(got) == plain(moved)
    for few in ([], rows[:1], [(1, [1.0], 1)]):
        assert mining.hard_negatives(spark.createDataFrame(few, SCHEMA)).count() == 0


def test_bounds_drop_candidates_but_no_result():
    draw = np.random.default_rng(1)
    rows = np.floor(draw.normal(0, 1, (3000, 32)) * 256) / 256
    rows[:, 0] *= 40  # One dimension decides: the bitmap shrinks after the first step.
    shard = mining.Shard.of(list(range(3000)), [0] * 3000, list(rows))
    got = list(shard.scan(rows[0], np.arange(3000) != 0, 5, [(*LIMITS, LIMITS[0])]))
    scores = (rows * 256) @ (rows[0] * 256)
    best = sorted((-int(s), i) for i, s in enumerate(scores) if i)[:5]
    assert [(i, s) for _, i, s in got] == [(i, -s) for s, i in best]
