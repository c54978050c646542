"""Packing and the URL model against plain restatements of their rules."""

from __future__ import annotations

import math
import os
import random
import re
import zlib
from collections import defaultdict

import pytest

from storeledger.llm import packing, url_filter

SF_DIR = "/root/testdata/sf0.01"
# Names that mark the hosts to block in the tables; the labelled list has none of them.
HELD_OUT = ("adult-x", "casino-win", "free-bets", "cheap-pills", "spam-farm", "ads-track")


def plain_best_fit(sizes, capacities, start_cost):
    """Every open bin is looked at for every piece: the tightest one, of equals the last used."""
    capacities = sorted(capacities)
    bins, places, left = [], {}, sum(sizes)
    clock = 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[i]
        clock += 1
        fits = [b for b in bins if b["room"] >= size and b["room"] > 0]
        if size == 0 and bins:
            places[i] = (0, bins[0]["used"])
            continue
        if fits and size > 0:
            chosen = min(fits, key=lambda b: (b["room"], -b["touched"]))
        else:
            cost = {c: math.ceil(left / c) * (c + start_cost) for c in capacities if c >= size}
            opened = min(cost, key=lambda c: (cost[c], c))
            chosen = {"no": len(bins), "room": opened, "used": 0, "touched": clock}
            bins.append(chosen)
        places[i] = (chosen["no"], chosen["used"])
        chosen["used"] += size
        chosen["room"] -= size
        chosen["touched"] = clock
        left -= size
    final = [min(c for c in capacities if c >= b["used"]) for b in bins]
    return [places[i] for i in range(len(sizes))], final


@pytest.mark.parametrize("seed", range(6))
def test_packing_equals_the_plain_way(seed):
    draw = random.Random(seed)
    capacities = sorted(draw.sample([8, 16, 32, 64, 100], k=draw.randrange(1, 5)))
    sizes = [draw.choice([0, 1, 2, 3, 5, 8, draw.randrange(capacities[-1] + 1)]) for _ in range(300)]
    cost = draw.choice([0, 1, 16])
    got = packing.best_fit(sizes, tuple(capacities), cost)
    assert got == plain_best_fit(sizes, capacities, cost)


def test_best_fit_names_the_bin_taken():
    # Bins of 10 hold 7 and 6; the 3 goes where it leaves no room, the 4 to the other.
    places, final = packing.best_fit([7, 6, 4, 3], (10,), 0)
    assert places == [(0, 0), (1, 0), (1, 6), (0, 7)] and final == [10, 10]
    # What is left decides the size that is opened, and bins shrink to what they hold.
    places, final = packing.best_fit([5, 1], (6, 12), 0)
    assert places == [(0, 0), (0, 5)] and final == [6]


def plain_buckets(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url)
    found = set()
    for part, text in (("h", m[1].lower()), ("p", m[2])):
        text = "^" + re.sub("[0-9]+", "0", text.lower()) + "$"
        for n in (3, 4, 5):
            for i in range(len(text) - n + 1):
                found.add(zlib.crc32(f"{part}{text[i : i + n]}".encode()) % (1 << 14))
    return found


def plain_model(rows, rounds, l2):
    """Gradient steps over single rows and buckets, with numbers of Python."""
    rows = [(plain_buckets(u), y) for u, y in rows]
    blocked = sum(y for _, y in rows)
    share = {1: 0.5 / max(1, blocked), 0: 0.5 / max(1, len(rows) - blocked)}
    weights, bias = defaultdict(float), 0.0
    for _ in range(rounds):
        change, total = defaultdict(float), 0.0
        for found, y in rows:
            odds = sum(weights[b] for b in found) / math.sqrt(max(1, len(found))) + bias
            wrong = (1 / (1 + math.exp(-odds)) - y) * share[y]
            total += wrong
            for b in found:
                change[b] += wrong / math.sqrt(max(1, len(found)))
        for b in {*weights, *change}:
            weights[b] -= 8.0 * (change[b] + l2 * weights[b])
        bias -= 8.0 * total
    return weights, bias


def test_url_model_equals_the_plain_way(spark):
    rows = [r for i, r in enumerate(url_filter.labelled_urls()) if i % 40 == 0]
    model = url_filter.train(spark.createDataFrame(rows, "url string, blocked int"), rounds=25)
    weights, bias = plain_model(rows, 25, 1e-4)
    assert math.isclose(model.bias, bias, rel_tol=1e-9)
    assert all(math.isclose(model.weights[b], w, rel_tol=1e-6, abs_tol=1e-12) for b, w in weights.items())
    for url, _ in rows:
        found = plain_buckets(url)
        odds = sum(weights[b] for b in found) / math.sqrt(len(found)) + bias
        assert math.isclose(model.score(*url_filter.split_url(url)), odds, rel_tol=1e-6)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables here")
def test_url_model_on_hosts_it_never_saw(spark):
    labelled = url_filter.labelled_urls()
    assert not any(name in url for url, _ in labelled for name in HELD_OUT)
    model = url_filter.train(spark.createDataFrame(labelled, "url string, blocked int"))
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").select("url").dropna().collect()
    parts = [url_filter.split_url(r.url) for r in pages]
    marked = [any(name in host for name in HELD_OUT) for host, _ in parts]
    blocked = [model.score(*p) >= 0 for p in parts]
    assert sum(m and b for m, b in zip(marked, blocked)) >= 0.85 * sum(marked) > 0
    assert sum(b and not m for m, b in zip(marked, blocked)) <= 0.01 * len(parts)
