"""The factorization machine: pairs it learns, held-out accuracy, and odd rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from storeledger.llm import toxicity

SCHEMA = "doc_id long, text string"


def terms(text):
    words = toxicity.words_of(text)
    return np.array(sorted({b for w in words for b in toxicity.term_buckets(w)}), np.int64)


def chance(machine, text):
    return machine.score(machine.places[b] for b in terms(text) if b in machine.places)


def plain_score(machine, text):
    """The model's formula, pair by pair."""
    at = [machine.places[b] for b in terms(text) if b in machine.places]
    said = machine.bias + sum(machine.weights[i] for i in at)
    said += sum(
        float(machine.factors[i] @ machine.factors[j]) for n, i in enumerate(at) for j in at[n + 1 :]
    )
    return 1 / (1 + np.exp(-said))


@pytest.fixture(scope="module")
def made_up():
    draw = random.Random(5)
    plain = [f"w{draw.randrange(10**6)}" for _ in range(60)]
    rows = []
    for i in range(4000):
        words = draw.choices(plain, k=draw.randrange(3, 30))
        insult, group = draw.random() < 0.3, draw.random() < 0.3
        words += ["rotten"] * insult + ["islanders"] * group
        draw.shuffle(words)
        rows.append((i, " ".join(words), int(insult and group)))
    return rows


def test_learns_a_pair_that_single_weights_miss(spark, made_up):
    # Either word alone is clean. The pair tells, so no threshold on single words does.
    docs = spark.createDataFrame([r[:2] for r in made_up], SCHEMA)
    labels = spark.createDataFrame([(i, y) for i, _, y in made_up], "doc_id long, toxic int")
    machine = toxicity.train(docs, labels)
    rest = [(t, y) for i, t, y in made_up if zlib.crc32(str(i).encode()) % 4 == 2]
    guessed = [chance(machine, t) >= 0.3 for t, _ in rest]
    assert sum(g == bool(y) for g, (_, y) in zip(guessed, rest)) >= 0.99 * len(rest)
    assert chance(machine, "rotten islanders") > 0.5
    assert max(chance(machine, "rotten"), chance(machine, "islanders")) < 0.3
    assert np.isclose(chance(machine, made_up[0][1]), plain_score(machine, made_up[0][1]))


def test_query_learns_from_rows_that_are_not_held_out(spark, made_up):
    docs = spark.createDataFrame([r[:2] for r in made_up], SCHEMA)
    labels = [(i, y if zlib.crc32(str(i).encode()) % 4 != 2 else 1 - y) for i, _, y in made_up]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    # Labels of held-out rows are turned round: learned, they would ruin the model.
    machine = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in toxicity.toxicity(docs, machine).collect()}
    assert len(got) == len(made_up)
    held = [(got[i], y) for i, _, y in made_up if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(r.held_out for r, _ in held)
    assert sum(r.held_out for r in got.values()) == len(held)
    assert sum(r.predicted == y for r, y in held) >= 0.98 * len(held)
    assert all(np.isclose(got[i].score, plain_score(machine, t)) for i, t, _ in made_up[:50])
    again = toxicity.train(docs.repartition(7), labels)
    assert again.places == machine.places and np.allclose(again.weights, machine.weights)


def test_odd_rows_keep_their_ids_and_score(spark, made_up):
    docs = spark.createDataFrame([r[:2] for r in made_up], SCHEMA)
    labels = spark.createDataFrame([(i, y) for i, _, y in made_up], "doc_id long, toxic int")
    machine = toxicity.train(docs, labels, max_labelled=500)
    big = 9007199254740993
    odd = [(big, None), (None, ""), (big + 2, "rotten islanders"), (7, "rotten islanders"),
           (7, "rotten islanders"), (9, "x" * 1_000_000), (11, "clean " * 300_000 + "rotten islanders")]
    table = spark.createDataFrame(odd, SCHEMA).withColumn("score", F.lit("own"))
    got = toxicity.toxicity(table.coalesce(1), machine).collect()
    assert [r.doc_id for r in got] == [i for i, _ in odd]
    assert got[0].score == got[1].score and got[2].score == got[3].score == got[4].score
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert got[6].score == got[2].score  # The end of a long text counts.
    assert got[1].held_out is False


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], SCHEMA)
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    machine = toxicity.train(docs, none)
    got = toxicity.toxicity(docs, machine).collect()
    assert len({r.score for r in got}) == 1
    assert toxicity.toxicity(docs.limit(0), machine).count() == 0
    assert toxicity.train(docs.limit(0), none).places == {}
