"""Hard negatives by a vertical scan of vectors (branch and bound on decomposed scores).

Rows are dealt to shards, which hold them by dimension. For an anchor, dimensions are read
by descending size of its component; after each step a candidate's score lies between its
partial sum plus the least and plus the most that the unread dimensions can add, by the
shard's extremes of each. Candidates that cannot enter any wanted window of scores, or
not among its best, leave the bitmap; what is left at the end has its exact score.

The scan runs twice: for the best rows of the anchor's label (positives), then for the
best rows of other labels in the windows that the positives' scores open. Each time an
anchor first visits its own shard; the scores found there are floors for all others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeledger.llm.common import staged

# Components are counted in units of 1 / UNIT.
UNIT = 256
# A shard holds about so many bytes of components, and at most so many rows.
SHARD_BYTES = 8 << 20
ROWS_PER_SHARD = 16_384
# Dimensions read between two looks at the bounds.
STEP = 8
# While shards are few, tasks share a shard's anchors: each has so many of them at least.
ANCHORS_PER_TASK = 64
LEAST, MOST = -(1 << 63), (1 << 63) - 1
# Doubles hold whole numbers up to here.
EXACT = float(1 << 53)


def _whole(vector: list[float]) -> list[int]:
    """Components in units, as integers of any size."""
    return [int(x * UNIT) if abs(x) < 2.0**900 else int(x) * UNIT for x in vector]


def _clamped(score: int) -> int:
    return max(LEAST, min(MOST, score))


@dataclass
class Shard:
    """Rows by dimension: columns[d] has a component of each row, as whole numbers.

    Numbers are doubles while all sums stay exact, else Python integers.
    """

    ids: np.ndarray
    labels: np.ndarray
    columns: np.ndarray
    low: np.ndarray
    high: np.ndarray
    reach: int

    @classmethod
    def of(cls, ids: list[int], labels: list[int], vectors: list[np.ndarray]) -> Shard:
        width = max(map(len, vectors))
        reach = (int(max(np.abs(v).max(initial=0) for v in vectors)) + 1) * UNIT
        if reach < 1 << 40:
            rows = np.zeros((len(ids), width))
            for i, v in enumerate(vectors):
                rows[i, : len(v)] = v
            columns = np.ascontiguousarray(rows.T) * UNIT
        else:
            columns = np.zeros((width, len(ids)), object)
            for i, v in enumerate(vectors):
                columns[: len(v), i] = _whole(v.tolist())
        return cls(
            np.asarray(ids, np.int64), np.asarray(labels, np.int64), columns,
            columns.min(axis=1), columns.max(axis=1), reach,
        )

    def scan(
        self, anchor: np.ndarray, fit: np.ndarray, k: int, windows: list[tuple[int, int, int]]
    ) -> Iterator[tuple[int, int, int]]:
        """(window, id, score): the best k of `fit` rows in each (low, high, floor) window.

        Scores are in low..high and not below floor; ties go to smaller ids.
        """
        width = min(len(anchor), len(self.columns))
        anchor = anchor[:width]
        size = np.abs(anchor)
        most = float(size.max(initial=0)) * UNIT
        if most * self.reach * max(1, width) < EXACT and self.columns.dtype != object:
            a, columns, low, high = anchor * UNIT, self.columns, self.low, self.high
        else:
            a = np.array([*_whole(anchor.tolist()), None], object)[:-1]
            columns, low, high = (
                np.array(np.vectorize(int, otypes=[object])(x), object)
                for x in (self.columns, self.low, self.high)
            )
        order = np.argsort(-size, kind="stable")
        one, other = a * low[:width], a * high[:width]
        least, best = np.minimum(one, other)[order], np.maximum(one, other)[order]
        # What the dimensions from place i on can add, at least and at most.
        least = np.append(np.cumsum(least[::-1])[::-1], 0)
        best = np.append(np.cumsum(best[::-1])[::-1], 0)

        alive = np.nonzero(fit)[0]
        sums = np.zeros(len(alive), columns.dtype)
        floors = [max(low_w, floor) for low_w, _, floor in windows]
        for start in range(0, width, STEP):
            if not len(alive):
                return
            dims = order[start : start + STEP]
            part = columns[dims] if len(alive) == len(self.ids) else columns[dims][:, alive]
            sums = sums + a[dims] @ part
            left = min(start + STEP, width)
            lower, upper = sums + least[left], sums + best[left]
            wanted = np.zeros(len(alive), bool)
            for w, (low_w, high_w, _) in enumerate(windows):
                sure = lower[(lower >= low_w) & (upper <= high_w)]
                if len(sure) >= k:
                    floors[w] = max(floors[w], int(np.partition(sure, len(sure) - k)[len(sure) - k]))
                wanted |= (upper >= floors[w]) & (lower <= high_w)
            if not wanted.all():
                alive, sums = alive[wanted], sums[wanted]
        scores = [_clamped(int(s)) for s in sums]
        ids = self.ids[alive].tolist()
        for w, (low_w, high_w, floor) in enumerate(windows):
            found = sorted(
                (-s, i) for s, i in zip(scores, ids, strict=True)
                if low_w <= s <= high_w and s >= floor
            )
            yield from ((w, i, -s) for s, i in found[:k])


def _lists(column: pa.Array) -> Iterator[np.ndarray]:
    """The rows of a list column as arrays of their own."""
    values = column.values.to_numpy(zero_copy_only=False)
    offsets = column.offsets.to_numpy()
    for start, end in zip(offsets[:-1], offsets[1:], strict=True):
        yield values[start:end].copy()


def labelled_vectors(
    table: DataFrame, id_col: str, vector_col: str, label: Column
) -> DataFrame:
    """(vec_id, label, vector): floor(256 x) / 256 of each component; unfit rows left out."""
    x = F.col("vector")
    fit = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    # Doubles from 2^44 on have no digits below 1 / 256.
    whole = F.transform(
        x,
        lambda v: F.when(
            F.abs(v) < float(1 << 44), F.floor(v * float(UNIT)).cast("double") / float(UNIT)
        ).otherwise(v),
    )
    rows = table.select(
        F.col(id_col).cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    rows = rows.filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fit, F.lit(False))
    )
    return rows.select("vec_id", "label", whole.alias("vector"))


_WINDOWS = "array<struct<low:bigint,high:bigint,floor:bigint>>"
_FOUND = "row long, window int, vec_id long, score long"


def _searched(
    rows: DataFrame, requests: DataFrame, shards: int, lanes: int, k: int, same: bool
) -> DataFrame:
    """(row, window, vec_id, score): what each shard has for the anchors sent to it.

    `requests` are (row, vec_id, label, vector, windows, shard). Rows and anchors of a
    shard meet in a task, rows first; a task holds one shard and passes its anchors by.
    """
    if lanes > 1:
        copies = F.sequence(F.lit(0), F.lit(lanes - 1))
        rows = rows.withColumn("lane", F.explode(copies))
    else:
        rows = rows.withColumn("lane", F.lit(0))
    held = rows.select(
        "shard", "lane", F.lit(0).alias("kind"), "row", "vec_id", "label", "vector",
        F.lit(None).cast(_WINDOWS).alias("windows"),
    )
    sent = requests.select(
        "shard", F.pmod(F.xxhash64("row"), F.lit(lanes)).cast("int").alias("lane"),
        F.lit(1).alias("kind"), "row", "vec_id", "label", "vector", "windows",
    )
    passing = (
        held.unionByName(sent)
        .repartition(max(shards * lanes, 1), "shard", "lane")
        .sortWithinPartitions("shard", "lane", "kind")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, waiting, shard = None, [], None
        for batch in batches:
            found = []
            names = ("shard", "lane", "kind", "row", "vec_id", "label", "windows")
            columns = [batch.column(c).to_pylist() for c in names]
            vectors = _lists(batch.column("vector"))
            for s, lane, kind, row, vec_id, label, windows, vector in zip(
                *columns, vectors, strict=True
            ):
                if (s, lane) != place:
                    place, waiting, shard = (s, lane), [], None
                if kind == 0:
                    waiting.append((vec_id, label, vector))
                    continue
                if shard is None:
                    if not waiting:
                        continue
                    shard, waiting = Shard.of(*map(list, zip(*waiting, strict=True))), []
                fit = (shard.labels == label) if same else (shard.labels != label)
                fit &= shard.ids != vec_id
                asked = [(w["low"], w["high"], w["floor"]) for w in windows]
                found += [(row, *hit) for hit in shard.scan(vector, fit, k, asked)]
            made = [pa.array([f[i] for f in found], t) for i, t in enumerate(
                (pa.int64(), pa.int32(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(made, names=["row", "window", "vec_id", "score"])

    return passing.mapInArrow(search, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The first k of each anchor row and window, with their rank."""
    order = Window.partitionBy("row", "window").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _windowed(
    rows: DataFrame, requests: DataFrame, shards: int, lanes: int, k: int, same: bool, name: str
) -> DataFrame:
    """The first k rows of each anchor's windows over all shards."""
    own = staged(_searched(rows, requests, shards, lanes, k, same), f"{name}-own")
    if shards == 1:
        return _best(own, k)
    # A window's k-th score in one shard is a floor for the others.
    floors = (
        own.groupBy("row", "window").agg(F.min("score").alias("kth"), F.count("*").alias("n"))
        .filter(F.col("n") >= k)
        .groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("window", "kth"))).alias("kth"))
    )
    others = F.array_remove(F.sequence(F.lit(0), F.lit(shards - 1)), F.col("shard"))
    raised = F.transform(
        "windows",
        lambda w, i: F.struct(
            w["low"].alias("low"),
            w["high"].alias("high"),
            F.coalesce(F.try_element_at("kth", i), w["floor"]).alias("floor"),
        ),
    )
    further = requests.join(floors, "row", "left").select(
        "row", "vec_id", "label", "vector", raised.alias("windows"), F.explode(others).alias("shard")
    )
    rest = _searched(rows, further, shards, lanes, k, same)
    return _best(own.unionByName(staged(rest, f"{name}-others")), k)


def hard_negatives(
    table: DataFrame,
    positives: int = 5,
    negatives: int = 3,
    every: int = 50,
    low_percent: int = 50,
    high_percent: int = 95,
    label: Column | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    rows_per_shard: int | None = None,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are rows whose id is divisible by `every`. A row's score is its inner product
    with the anchor, in whole units. An anchor's positives are its first rows of the same
    label, by descending score, then smaller id; each has up to `negatives` rows of other
    labels whose score is between `low_percent` and `high_percent` of its own, in the
    same order. `label` is the label column, by default `label`.

    Rows with a null id or label, or a vector that is null or holds null or non-finite
    components, take no part. A shorter vector counts as filled up with 0. Rows that
    repeat an anchor's id are not its candidates, and anchors each. Scores beyond a long
    count as its limit. Other columns are ignored; an empty table, or one without anchors
    or labels to choose from, gives an empty result.
    """
    label = F.col("label") if label is None else label
    rows = labelled_vectors(table, id_col, vector_col, label)
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "labelled-vectors")
    facts = rows.agg(
        F.count("*").alias("n"),
        F.max(F.size("vector")).alias("width"),
        F.count_if(F.col("vec_id") % every == 0).alias("anchors"),
    ).first()
    width = max(1, facts["width"] or 1)
    per_shard = rows_per_shard or max(256, min(ROWS_PER_SHARD, SHARD_BYTES // (8 * width)))
    shards = max(1, -(-facts["n"] // per_shard))
    tasks = 2 * table.sparkSession.sparkContext.defaultParallelism
    lanes = max(1, min(tasks // shards, -(-facts["anchors"] // ANCHORS_PER_TASK)))
    # A number per row deals them, so rows that share an id or label spread.
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    anchors = rows.filter(F.col("vec_id") % every == 0)
    limits = [F.lit(x).cast("long") for x in (LEAST, MOST, LEAST)]
    whole = F.struct(*(x.alias(c) for x, c in zip(limits, ("low", "high", "floor"), strict=True)))
    first = _windowed(
        rows, anchors.withColumn("windows", F.array(whole)), shards, lanes, positives, True,
        "positives",
    )
    first = staged(first.select("row", "vec_id", "score", "rank"), "positives")

    # low * positive <= 100 * negative <= high * positive, in whole numbers.
    scaled = F.col("score").cast("decimal(20,0)")
    lowest = F.ceil(scaled * low_percent / 100).cast("decimal(22,0)")
    highest = F.floor(scaled * high_percent / 100).cast("decimal(22,0)")
    window = F.struct(
        lowest.cast("long").alias("low"), highest.cast("long").alias("high"),
        F.lit(LEAST).cast("long").alias("floor"),
    )
    open_ones = first.withColumn("of", window).filter("of.low <= of.high")
    wanted = (
        open_ones.groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "of", "vec_id", "score"))).alias("asked"))
    )
    wanted = staged(wanted, "negative-windows")
    requests = anchors.join(wanted, "row").withColumn(
        "windows", F.transform("asked", lambda w: w["of"])
    )
    hits = _windowed(rows, requests, shards, lanes, negatives, False, "negatives")
    hits = hits.select(
        "row", "window", F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"),
    )
    asked = wanted.select("row", F.posexplode("asked").alias("window", "positive"))
    named = anchors.select("row", F.col("vec_id").alias("anchor_id"))
    return hits.join(asked, ["row", "window"]).join(named, "row").select(
        "anchor_id",
        F.col("positive.vec_id").alias("positive_id"),
        "rank",
        "negative_id",
        F.col("positive.score").alias("positive_score"),
        "negative_score",
    )
