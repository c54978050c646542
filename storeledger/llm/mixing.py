"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeledger.llm.common import staged

WEIGHTS = (1, 2, 3)
MAX_PASSES = 3
BLOCK_TOKENS = 1024
# Slots are ranked inside chunks of so many, then chunks are summed up.
SLOTS_PER_CHUNK = 65_536
GOLDEN = (math.sqrt(5) - 1) / 2


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_passes: int = MAX_PASSES
) -> DataFrame:
    """(source_no, source, source_size, target) from (source, size) rows.

    Sources in code-point order, null last, take the weights in turn. All targets add
    up to the sizes' total; none exceeds `max_passes` times its source's size, and what
    is over is shared again by weight. Sorted by size per weight, the sources that stop
    are the first ones, so running sums find them without a loop.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    totals = totals.withColumn("source_no", F.row_number().over(in_order).cast("long") - 1)
    given = F.array(*[F.lit(int(w)) for w in weights])
    totals = totals.withColumn(
        "weight", F.get(given, (F.col("source_no") % len(weights)).cast("int")).cast("long")
    )
    by_fill = Window.orderBy(F.col("source_size") / F.col("weight"), "source_no")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    cap = F.col("source_size") * max_passes
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    totals = totals.withColumns({"left": left, "rest": F.sum("weight").over(onward)})
    # The source stops at its cap if its share of what is left is above it.
    stops = F.col("weight") * F.col("left") > cap * F.col("rest")
    totals = totals.withColumn("stops", stops)
    free_left = F.first(F.when(~F.col("stops"), F.col("left")), ignorenulls=True)
    free_rest = F.first(F.when(~F.col("stops"), F.col("rest")), ignorenulls=True)
    whole = by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    share = (F.col("weight") * free_left.over(whole)).cast("double") / free_rest.over(whole)
    target = F.when(F.col("stops"), cap.cast("double")).otherwise(share)
    return totals.select("source_no", "source", "source_size", target.alias("target"))


def laid_out(docs: DataFrame, order: Column) -> DataFrame:
    """Add `start`: where each row's tokens begin in its source's shuffled stream.

    Rows (source_no, size, ...) are ordered by a hash; sums run over 4,096 ranges of the
    hash per source first, then inside each range, so no task orders a whole source.
    """
    rows = docs.withColumn("_order", order)
    rows = rows.withColumn("_range", F.substring("_order", 1, 3))
    ranges = rows.groupBy("source_no", "_range").agg(F.sum("size").alias("_tokens"))
    earlier = (
        Window.partitionBy("source_no").orderBy("_range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranges = ranges.select(
        "source_no", "_range", F.coalesce(F.sum("_tokens").over(earlier), F.lit(0)).alias("_base")
    )
    inside = (
        Window.partitionBy("source_no", "_range")
        .orderBy("_order", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = rows.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(ranges, ["source_no", "_range"])
    return rows.withColumn("start", (F.col("_base") + F.col("_inside")).cast("long")).drop(
        "_order", "_range", "_base", "_inside"
    )


def golden_step(n: int) -> int:
    """The step nearest n * golden ratio that shares no divisor with n."""
    near = max(1, round(n * GOLDEN))
    for away in range(n + 1):
        for step in (near - away, near + away):
            if 1 <= step and math.gcd(step, n) == 1:
                return step % n or 1
    return 1


def schedule(sources: DataFrame) -> DataFrame:
    """(slot, source_no, block): which block of which source each slot of the mix holds.

    `sources` has (source_no, blocks). Slot n stands at the golden-ratio point
    (n * step mod N) / N, a lattice that meets each of the N points once; the point
    falls into a source's share of the cumulative weights, and the rank of the slot
    among its source's slots is the block. Every source so gets exactly its blocks.
    """
    sources = sources.filter(F.col("blocks") > 0)
    total = int(sources.agg(F.sum("blocks")).first()[0] or 0)
    step = golden_step(total) if total else 1
    back = pow(step, -1, total) if total > 1 else 0
    # Products are taken in two halves, so that they fit a long for N below 2^38.
    high, low = F.shiftright("point", 19), F.col("point").bitwiseAND((1 << 19) - 1)
    modulus = max(1, total)
    slot = (high * F.lit((back << 19) % modulus) + low * F.lit(back)) % F.lit(modulus)
    before = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    chunks = F.floor((F.col("blocks") - 1) / SLOTS_PER_CHUNK)
    points = (
        sources.withColumn("low", F.coalesce(F.sum("blocks").over(before), F.lit(0)))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), chunks)))
        .repartition("source_no", "chunk")
        .select(
            "source_no",
            F.explode(
                F.sequence(
                    F.col("low") + F.col("chunk") * SLOTS_PER_CHUNK,
                    F.col("low")
                    + F.least(F.col("blocks"), (F.col("chunk") + 1) * SLOTS_PER_CHUNK)
                    - 1,
                )
            ).alias("point"),
        )
    )
    slots = points.select("source_no", slot.alias("slot"))
    slots = slots.withColumn("_chunk", F.floor(F.col("slot") / SLOTS_PER_CHUNK))
    counts = slots.groupBy("source_no", "_chunk").agg(F.count("*").alias("_n"))
    earlier = (
        Window.partitionBy("source_no").orderBy("_chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    counts = counts.select(
        "source_no", "_chunk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base")
    )
    inside = Window.partitionBy("source_no", "_chunk").orderBy("slot")
    rank = F.row_number().over(inside) - 1
    return (
        slots.withColumn("_rank", rank)
        .join(counts.hint("merge"), ["source_no", "_chunk"])
        .select("slot", "source_no", (F.col("_base") + F.col("_rank")).alias("block"))
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_passes: int = MAX_PASSES,
    block_tokens: int = BLOCK_TOKENS,
    carried: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Mix (doc_id, source, size) rows: (rows with their source's target, pieces of the mix).

    The rows get source_no, source_size, target and start. Pieces: slot, source_no,
    start (of the row), size, take_pass, block, from_token, to_token; a row's tokens
    are cut at block ends only, and a source stops at the whole part of its target.
    `carried` names further columns that the rows keep.

    Sizes of null or 0 take no part; a null source is a source. Repeated rows each have
    a place in their source's stream. The order is by md5 of doc_id, so reruns agree.
    Sources are few beside documents: their table is ordered in one task. Slots and
    sums grow with the documents, though their exploded plans look small: they are
    joined by shuffle at every size, never broadcast.
    """
    rows = docs.select(
        "doc_id", "source", F.coalesce(F.col("size"), F.lit(0)).cast("long").alias("size"), *carried
    )
    rows = staged(rows, "mix-sizes")  # Sizes are counted from the texts once.
    targets = staged(source_targets(rows, weights, max_passes), "mix-targets")
    rows = rows.join(targets, rows["source"].eqNullSafe(targets["source"]), "left").select(
        "doc_id", rows["source"], "size", "source_no", "source_size", "target", *carried
    )
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = staged(laid_out(rows, order), "mix-rows")
    quota = F.floor("target").cast("long")
    plan = targets.select("source_no", F.ceil(quota / block_tokens).cast("long").alias("blocks"))
    slots = schedule(plan)
    passes = F.sequence(F.lit(0), F.lit(max_passes - 1))
    size, start = F.col("size"), F.col("start")
    taken = (
        rows.filter(size > 0)
        .withColumn("take_pass", F.explode(passes))
        .withColumn("from_token", start + F.col("take_pass") * F.col("source_size"))
        .withColumn("to_token", F.least(F.col("from_token") + size, quota))
        .filter(F.col("to_token") > F.col("from_token"))
    )
    first = F.floor(F.col("from_token") / block_tokens)
    last = F.floor((F.col("to_token") - 1) / block_tokens)
    pieces = taken.withColumn("block", F.explode(F.sequence(first, last)))
    edge = F.col("block") * block_tokens
    pieces = pieces.select(
        "doc_id", "source_no", "start", "size", "take_pass", "block",
        F.greatest("from_token", edge).alias("from_token"),
        F.least("to_token", edge + block_tokens).alias("to_token"),
    )
    return rows, pieces.join(slots.hint("merge"), ["source_no", "block"])


def words_taken(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_passes: int = MAX_PASSES,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, first_slot) of each (doc_id, source, size).

    `taken` counts the words of the row that the mix holds, repeats included; `first_slot`
    is the first slot of the schedule that holds some of them, null if none does. See `mix`
    for nulls and repeated rows; an empty table gives an empty result.
    """
    rows, pieces = mix(docs, weights, max_passes, block_tokens)
    # A row with words is known by its source and its start in the source's stream.
    sums = pieces.groupBy("source_no", "start").agg(
        F.sum(F.col("to_token") - F.col("from_token")).alias("taken"),
        F.min("slot").alias("first_slot"),
    )
    key = F.when(F.col("size") > 0, F.col("start"))
    rows = rows.withColumn("start", key)
    return rows.join(sums.hint("merge"), ["source_no", "start"], "left").select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        "first_slot",
    )


def documents_taken(
    docs: DataFrame,
    size: Column,
    weights: Sequence[int] = WEIGHTS,
    max_passes: int = MAX_PASSES,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """The rows of `docs` in the mix, whole, once for each pass that takes their first word.

    They come in the order of the schedule, by the slot that holds that word, so every
    stretch of the result mixes the sources near their weights. A source's words come
    near its target, to within one document. Columns stay as they are; rows without words
    are not taken. Needs doc_id and source columns.
    """
    columns = docs.columns
    # A number per row, written down, tells rows that repeat an id apart.
    numbered = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_whole"),
        "doc_id", "source", size.alias("size"), F.monotonically_increasing_id().alias("_row"),
    )
    numbered = staged(numbered, "numbered")
    rows, pieces = mix(
        numbered.drop("_whole"), weights, max_passes, block_tokens, carried=["_row"]
    )
    first = F.col("start") + F.col("take_pass") * F.col("source_size")
    sizes = rows.select("source_no", "source_size").distinct()
    takes = (
        pieces.join(sizes, "source_no")
        .filter(F.col("from_token") == first)
        .select("source_no", "start", "slot", "from_token")
    )
    taken = (
        rows.filter("size > 0")
        .join(takes.hint("merge"), ["source_no", "start"])
        .select("_row", "slot", "from_token")
    )
    mixed = numbered.select("_row", "_whole").join(taken.hint("merge"), "_row")
    return mixed.orderBy("slot", "from_token").select("_whole.*")
