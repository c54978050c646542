"""Exact top-k search: a ball tree per shard, searched by branch and bound.

Vectors are dealt to shards by a hash of their row. Queries go in blocks of bounded size;
a block is first searched in one shard, and the k-th score found there bounds the search
of all other shards, so that whole balls fall away before any of their rows is scored.
Scores whose sums doubles can't hold are bounded by them and computed in whole numbers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storeledger.llm.common import staged
from storeledger.session import new_work_path

ROWS_PER_SHARD = 16_384
LEAF_ROWS = 128
# What one block of queries may hold, in bytes of its vectors: sent to every executor.
BLOCK_BYTES = 16 << 20
# Whole components are counted in units of 1 / UNIT.
UNIT = 256
# Doubles hold whole numbers up to here.
EXACT = float(1 << 53)
# Rows with components beyond this are scored without bounds: products could overflow.
GIANT = 2.0**400
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def _whole(vector: np.ndarray) -> list[int]:
    """The components in units, as Python integers."""
    return [int(x * UNIT) if abs(x) < GIANT else int(x) * UNIT for x in vector.tolist()]


def _score(one: list[int], other: list[int]) -> int:
    """The exact inner product; beyond a long, the long's limit."""
    return max(LEAST, min(MOST, sum(a * b for a, b in zip(one, other, strict=True))))


def _bar(floor: int) -> float:
    """A double that no score of `floor` or more is below, but for rounding."""
    return -np.inf if floor == LEAST else float(floor)


@dataclass
class BallTree:
    """Rows in tree order; nodes as arrays. A leaf's rows are order[start:end]."""

    vectors: np.ndarray
    ids: np.ndarray
    centers: list[np.ndarray] = field(default_factory=list)
    radii: list[float] = field(default_factory=list)
    spans: list[tuple[int, int]] = field(default_factory=list)
    children: list[tuple[int, int] | None] = field(default_factory=list)

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS) -> BallTree:
        """Split at the median along the line between two far points, down to leaves."""
        order = np.arange(len(ids))
        tree = cls(vectors, ids)
        todo = [(0, len(ids), -1, 0)]
        while todo:
            start, end, parent, side = todo.pop()
            rows = order[start:end]
            points = vectors[rows]
            center = points.mean(axis=0)
            away = np.sqrt(((points - center) ** 2).sum(axis=1))
            node = len(tree.radii)
            tree.centers.append(center)
            tree.radii.append(float(away.max()))
            tree.spans.append((start, end))
            tree.children.append(None)
            if parent >= 0:
                pair = list(tree.children[parent])
                pair[side] = node
                tree.children[parent] = tuple(pair)
            if end - start <= leaf_rows or away.max() == 0:
                continue
            one = points[away.argmax()]
            other = points[((points - one) ** 2).sum(axis=1).argmax()]
            along = points @ (one - other)
            middle = (end - start) // 2
            order[start:end] = rows[np.argpartition(along, middle, kind="introselect")]
            tree.children[node] = (-1, -1)
            todo += [(start, start + middle, node, 0), (start + middle, end, node, 1)]
        tree.vectors, tree.ids = vectors[order], ids[order]
        return tree

    def search(
        self, queries: np.ndarray, own_ids: np.ndarray, k: int, least: np.ndarray
    ) -> Iterator[tuple[int, int, int]]:
        """(query, id, score): candidates for each query's k best, never below `least`.

        Nodes are visited by their upper bound, q.center + |q| * radius; the search of
        a query ends when the best bound left is below its current k-th score.
        """
        centers, radii = np.array(self.centers), np.array(self.radii)
        norms = np.sqrt((queries**2).sum(axis=1))
        lengths = np.sqrt((self.vectors**2).sum(axis=1))
        # A little above the bound, so that rounding can't hide an equal score.
        bounds = (queries @ centers.T + norms[:, None] * radii) * 1.0
        bounds += 1e-9 * (np.abs(bounds) + norms[:, None] * (1 + np.abs(centers).max())) + 1e-9
        bounds *= UNIT * UNIT
        for q in range(len(queries)):
            bound, own, best = bounds[q], own_ids[q], []  # best: (score, -id), worst first
            floor, ints = int(least[q]), None
            bar = _bar(floor)
            heap = [(-bound[0], 0)]
            while heap:
                upper, node = heapq.heappop(heap)
                if -upper < bar:
                    break
                if self.children[node] is not None:
                    for child in self.children[node]:
                        if bound[child] >= bar:
                            heapq.heappush(heap, (-min(-upper, bound[child]), child))
                    continue
                start, end = self.spans[node]
                scores = (self.vectors[start:end] @ queries[q]) * (UNIT * UNIT)
                # No partial sum exceeds the product of the lengths, so these are exact.
                reach = norms[q] * lengths[start:end] * (UNIT * UNIT)
                exact = reach < EXACT / 2
                near = np.where(exact, scores, scores + 1e-12 * len(queries[q]) * reach)
                for i in np.nonzero(near >= bar - 1e-15 * abs(bar) if floor != LEAST else near >= bar)[0]:
                    vec_id = int(self.ids[start + i])
                    if vec_id == own:
                        continue
                    if exact[i]:
                        score = int(scores[i])
                    else:
                        ints = ints or _whole(queries[q])
                        score = _score(_whole(self.vectors[start + i]), ints)
                    item = (score, -vec_id)
                    if score < floor:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, item)
                    elif item > best[0]:
                        heapq.heapreplace(best, item)
                    if len(best) == k and best[0][0] > floor:
                        floor = best[0][0]
                        bar = _bar(floor)
            yield from ((q, -neg, score) for score, neg in best)


def whole_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) with floor(256 * x) / 256 of each component; unfit vectors left out."""
    x = F.col("_vector")
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
        F.col(vector_col).cast("array<double>").alias("_vector"),
    )
    rows = rows.filter(F.col("vec_id").isNotNull() & F.coalesce(fit, F.lit(False)))
    return rows.select("vec_id", whole.alias("vector"))


def _matrix(vectors, width: int) -> np.ndarray:
    """Rows as doubles, shorter ones filled with 0."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def top_k(
    table: DataFrame,
    k: int = 5,
    every: int = 50,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    rows_per_shard: int = ROWS_PER_SHARD,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best inner products, exactly.

    Queries: rows whose id is divisible by `every`; candidates: every row with another
    id. Ties go to the smaller id. Vectors that are null, or hold null or non-finite
    components, and rows with a null id take no part. A shorter vector counts as filled
    up with 0. Rows that repeat an id are candidates each, and queries each under the
    same query_id. Scores beyond a long count as the long's limit. An empty table, or one without
    queries, gives an empty result; fewer candidates than k give fewer rows.
    """
    spark = table.sparkSession
    rows = whole_vectors(table, id_col, vector_col)
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    facts = rows.agg(
        F.count("*").alias("n"),
        F.max(F.size("vector")).alias("width"),
        F.count_if(F.col("vec_id") % every == 0).alias("queries"),
    ).first()
    width = max(1, facts["width"] or 1)
    shards = max(1, -(-facts["n"] // rows_per_shard))
    blocks = -(-facts["queries"] // max(1, block_bytes // (8 * width)))
    # A number per row decides the shard, so rows that share an id spread too.
    shard = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")
    indexed = staged(rows.withColumn("shard", shard).repartition("shard"), "vector-shards")
    block = F.pmod(F.xxhash64("row", F.lit("block")), F.lit(blocks)) if blocks else None
    schema = "block int, query int, query_id long, vec_id long, score long"
    path = new_work_path(spark, "llm-topk")
    spark.createDataFrame([], schema).write.parquet(path)

    # One block after the other; what a block finds is written before the next begins.
    for number in range(blocks):
        chosen = (
            rows.filter(F.col("vec_id") % every == 0).filter(block == number).orderBy("row")
        ).toPandas()
        if chosen.empty:
            continue
        ids = chosen["vec_id"].to_numpy(dtype=np.int64)
        sent = spark.sparkContext.broadcast((ids, _matrix(chosen["vector"].tolist(), width)))
        first = staged(
            _search_shards(indexed.filter("shard = 0"), sent, None, number, k, width, schema),
            "topk-first",
        )
        # The k-th score of each query so far; at most a number per query of the block.
        kth = (
            first.groupBy("query")
            .agg(F.min("score").alias("kth"), F.count("*").alias("n"))
            .filter(F.col("n") == k)
        ).toPandas()
        least = np.full(len(ids), LEAST, np.int64)
        least[kth["query"].to_numpy(dtype=np.int64)] = kth["kth"]
        floor = spark.sparkContext.broadcast(least)
        rest = _search_shards(indexed.filter("shard > 0"), sent, floor, number, k, width, schema)
        first.unionByName(rest).write.mode("append").parquet(path)

    best = Window.partitionBy("block", "query").orderBy(F.col("score").desc(), "vec_id")
    return (
        spark.read.schema(schema)
        .parquet(path)
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _search_shards(shards: DataFrame, sent, floor, number: int, k: int, width: int, schema: str):
    """Each shard's candidates for the queries sent, none below the floor of its query."""

    def search(group: pd.DataFrame) -> pd.DataFrame:
        ids, vectors = sent.value
        least = np.full(len(ids), LEAST, np.int64) if floor is None else floor.value
        own, rows = group["vec_id"].to_numpy(), _matrix(group["vector"].tolist(), width)
        hits = list(_search(own, rows, ids, vectors, k, least))
        out = pd.DataFrame(hits, columns=["query", "vec_id", "score"], dtype="int64")
        out.insert(0, "block", number)
        out.insert(2, "query_id", ids[out["query"]])
        return out

    return shards.groupBy("shard").applyInPandas(search, schema)


def _search(
    own: np.ndarray, rows: np.ndarray, ids: np.ndarray, queries: np.ndarray, k: int, least: np.ndarray
) -> Iterator[tuple[int, int, int]]:
    """(query, id, score) from a tree, and one by one for rows and queries of giant size."""
    giant_row = (np.abs(rows) > GIANT).any(axis=1)
    giant_query = (np.abs(queries) > GIANT).any(axis=1)
    usual = np.nonzero(~giant_query)[0]
    if len(usual) and not giant_row.all():
        tree = BallTree.build(own[~giant_row], rows[~giant_row])
        for q, vec_id, score in tree.search(queries[usual], ids[usual], k, least[usual]):
            yield int(usual[q]), vec_id, score
    giants = np.nonzero(giant_row)[0]
    for q in range(len(queries)) if len(giants) else np.nonzero(giant_query)[0]:
        ints = _whole(queries[q])
        scored = (
            (_score(_whole(rows[r]), ints), -int(own[r]))
            for r in (range(len(rows)) if giant_query[q] else giants)
            if own[r] != ids[q]
        )
        for score, neg in heapq.nlargest(k, scored):
            if score >= least[q]:
                yield int(q), -neg, score
