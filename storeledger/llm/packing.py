"""Best-fit packing of documents into bins of several permitted sequence lengths."""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.llm.common import staged

# Permitted sequence lengths in words, with the cost of a bin of each: its length, and a
# fixed price for starting it.
CAPACITIES = (512, 1024, 2048, 4096, 8192)
START_COST = 16
ROWS_PER_SHARD = 50_000
_PLACED = ("piece", "piece_start", "length", "shard", "bin", "offset", "capacity")


def best_fit(
    sizes: list[int], capacities: tuple[int, ...] = CAPACITIES, start_cost: int = START_COST
) -> tuple[list[tuple[int, int]], list[int]]:
    """Place pieces, longest first: (bin, offset) of each piece, and each bin's capacity.

    A piece goes where the least room is left after it. If no open bin has room, the bin
    size that costs least for what is still to be placed is opened: the cost of as many
    bins of that size as the rest of the pieces would fill, over those that the piece
    fits into. In the end each bin shrinks to the smallest size that holds its contents.
    """
    capacities = tuple(sorted(capacities))
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    left = sum(sizes)
    places: list[tuple[int, int]] = [(0, 0)] * len(sizes)
    used: list[int] = []
    room: list[int] = []  # Room left, ascending; free[r] are the bins with that room.
    free: dict[int, list[int]] = {}
    size_of: list[int] = []
    for i in order:
        size = sizes[i]
        at = bisect_left(room, size)
        if at < len(room) and size > 0:
            r = room[at]
            b = free[r].pop()
            if not free[r]:
                room.pop(at)
                del free[r]
        elif size == 0 and used:
            b = 0
            places[i] = (b, used[b])
            continue
        else:
            fitting = [c for c in capacities if c >= size]
            cost = min(fitting, key=lambda c: (-(-left // c) * (c + start_cost), c))
            b = len(used)
            used.append(0)
            size_of.append(cost)
        places[i] = (b, used[b])
        used[b] += size
        left -= size
        r = size_of[b] - used[b]
        if r > 0:
            if r not in free:
                insort(room, r)
                free[r] = []
            free[r].append(b)
    final = [next(c for c in capacities if c >= u) for u in used]
    return places, final


def pieces_of(
    docs: DataFrame, size: Column, capacities: tuple[int, ...] = CAPACITIES, id_col: str = "doc_id"
) -> DataFrame:
    """(doc_id, piece, piece_start, length): documents cut at the largest capacity."""
    top = max(capacities)
    rows = docs.select(F.col(id_col).alias("_id"), size.cast("long").alias("_size"))
    last = F.greatest(F.lit(0), F.floor((F.col("_size") - 1) / top))
    return rows.select(
        "_id", "_size", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece")
    ).select(
        F.col("_id").alias(id_col),
        "piece",
        (F.col("piece") * top).alias("piece_start"),
        F.least(F.lit(top).cast("long"), F.col("_size") - F.col("piece") * top).alias("length"),
    )


def pack(
    docs: DataFrame,
    size: Column,
    capacities: tuple[int, ...] = CAPACITIES,
    start_cost: int = START_COST,
    rows_per_shard: int = ROWS_PER_SHARD,
    id_col: str = "doc_id",
) -> DataFrame:
    """One row per piece: doc_id, piece, piece_start, length, shard, bin, offset, capacity.

    Pieces are dealt by a hash over shards of some `rows_per_shard` rows, and each shard
    is packed by one task; a shard wastes at most a few bins, and no key decides where
    rows go, so a source or length that most rows share spreads like any other. A size
    of null or 0 takes a place of length 0. Repeated rows are packed each; a null id is
    passed through; an empty table gives an empty result. Longer documents than the
    largest capacity are cut into pieces that fill bins of their own, and a rest.
    """
    pieces = staged(pieces_of(docs, F.coalesce(size, F.lit(0)), capacities, id_col), "pieces")
    shards = max(1, -(-pieces.count() // rows_per_shard))
    kind = docs.schema[id_col].dataType.simpleString()

    def place(group: pa.Table) -> pa.Table:
        # Ids stay in Arrow, so they are neither rounded nor made floats beside a null.
        order = pc.sort_indices(
            group,
            [("length", "descending"), (id_col, "ascending"), ("piece", "ascending")],
            null_placement="at_end",
        )
        group = group.take(order)
        places, final = best_fit(group["length"].to_pylist(), capacities, start_cost)
        made = {
            "bin": [b for b, _ in places],
            "offset": [o for _, o in places],
            "capacity": [final[b] for b, _ in places],
        }
        for name, values in made.items():
            group = group.append_column(name, pa.array(values, pa.int64()))
        return group.select([id_col, *_PLACED])

    keyed = pieces.withColumn(
        "shard", F.pmod(F.xxhash64(id_col, "piece", "length"), F.lit(shards)).cast("long")
    )
    fields = ", ".join(f"{name} long" for name in _PLACED)
    return keyed.groupBy("shard").applyInArrow(place, f"`{id_col}` {kind}, {fields}")
