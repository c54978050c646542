"""Conversation structure repair by block tables in the manner of the Four Russians.

The cheapest edits that turn a conversation's roles into an optional system turn and
pairs of user and assistant turns are a shortest path through four states. The cost of
finishing from each state, less the least of them, is one of few vectors; so for every
block of a fixed number of symbols and every vector behind it, the vector before it is
looked up in a table made once. Blocks are read from the end to the front by lookup, and
expanded again, from each block's own end backward, to write down the edits from the
front: where several are cheapest, the smallest letter is taken, which is the smallest
string.

A conversation may be longer than a task should hold. It is cut into segments; a segment
is summed up as what it does to every vector and state, and these sums are composed level
by level, so no group ever holds more than a fixed number of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeledger.llm.common import staged

# Costs of the edits, and of keeping a truncated turn.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# States: nothing yet, after system, after user, after assistant. What may come next, and
# where it leads; a pair is complete in states 0 and 3.
ROLES = ("user", "user", "assistant", "user")
AFTER = (2, 2, 3, 2)
KEPT = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}
STATES = 4
# Symbols: initials s, u, a and others, the same truncated, and turns that have to go.
SYMBOLS, GONE = 9, 8
INITIALS = "sua"
BLOCK = 4
SEGMENT_ROWS = 4_096
FAN_IN = 1_024
# A row's sign: the class of its initial plus four times its fault.
SOUND, CUT_OFF, BLANK, DUPLICATE = range(4)
LEGAL = {(0, 1), (1, 2), (2, 1)}


@dataclass(frozen=True)
class Tables:
    """Vectors of the cost to finish, by number, and what symbols and blocks make of them."""

    vectors: list[tuple[int, ...]]
    letters: dict[tuple[int, int, int], tuple[str, int, int]]
    before: list[np.ndarray]  # per length: vector before a block, by vector behind it
    cost: list[np.ndarray]
    state: list[np.ndarray]  # per length: state behind a block, by vector, block and state

    @property
    def end(self) -> int:
        """The vector at the end of a conversation."""
        return 0


def _ends(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of what may be done with a turn in a state."""
    found = [("D", DELETE, state)]
    if symbol != GONE:
        role, extra = symbol % 4, TRUNCATED * (symbol // 4)
        if (state, role) in KEPT:
            found.append(("K", extra, KEPT[state, role]))
        found.append(("R", REROLE + extra, AFTER[state]))
    return found


def _with_inserts(costs: list[int]) -> list[int]:
    """Costs to finish from each state when turns may also be inserted first."""
    for _ in range(STATES):
        costs = [min(c, INSERT + costs[AFTER[q]]) for q, c in enumerate(costs)]
    return costs


def _normal(costs: list[int]) -> tuple[tuple[int, ...], int]:
    least = min(costs)
    return tuple(c - least for c in costs), least


@lru_cache(maxsize=4)
def tables(block: int = BLOCK) -> Tables:
    """The tables for blocks of up to `block` symbols."""
    far = 1_000
    last, _ = _normal(_with_inserts([0, far, far, 0]))
    vectors, step = [last], {}
    for number, vector in enumerate(vectors):  # Grows while new vectors turn up.
        for symbol in range(SYMBOLS):
            costs = [
                min(c + vector[to] for _, c, to in _ends(symbol, q)) for q in range(STATES)
            ]
            made, least = _normal(_with_inserts(costs))
            if made not in vectors:
                vectors.append(made)
            step[number, symbol] = (vectors.index(made), least)
    letters = {}
    for (number, symbol), (made, least) in step.items():
        now, then = vectors[made], vectors[number]
        for start in range(STATES):
            q, said, spent = start, "", 0
            while True:
                options = [
                    (letter, c, to)
                    for letter, c, to in _ends(symbol, q)
                    if c + then[to] == now[q] + least
                ]
                if INSERT + now[AFTER[q]] == now[q]:
                    options.append(("I", INSERT, AFTER[q]))
                letter, c, q = min(options)
                said, spent = said + letter, spent + c
                if letter != "I":
                    break
            letters[number, symbol, start] = (said, spent, q)

    n = len(vectors)
    before = np.array([[step[v, s][0] for s in range(SYMBOLS)] for v in range(n)])
    cost = np.array([[step[v, s][1] for s in range(SYMBOLS)] for v in range(n)])
    state = np.array(
        [[[letters[v, s, q][2] for q in range(STATES)] for s in range(SYMBOLS)] for v in range(n)]
    )
    alone = (before, cost, state)
    befores, costs, states = [before], [cost], [state]
    for _ in range(1, block):
        # A block is a first symbol and a shorter block behind it.
        rest = befores[-1]
        before = alone[0][rest].transpose(0, 2, 1).reshape(n, -1)
        cost = (alone[1][rest] + costs[-1][:, :, None]).transpose(0, 2, 1).reshape(n, -1)
        first = alone[2][rest]  # vector, shorter block, symbol, state
        state = np.take_along_axis(states[-1][:, :, None, :], first, axis=3)
        state = state.transpose(0, 2, 1, 3).reshape(n, -1, STATES)
        befores.append(before)
        costs.append(cost)
        states.append(state)
    return Tables(vectors, letters, befores, costs, states)


def symbols_of(signs: str) -> np.ndarray:
    """Symbols of a string of signs."""
    sign = np.frombuffer(signs.encode("ascii"), np.uint8).astype(np.int64) - ord("A")
    return np.where(sign // 4 >= BLANK, GONE, sign)


def _blocks(symbols: np.ndarray, block: int) -> list[tuple[int, int]]:
    """(length, number) of the blocks of a run of symbols, the last one maybe shorter."""
    whole = len(symbols) - len(symbols) % block
    weights = SYMBOLS ** np.arange(block - 1, -1, -1)
    found = [(block, int(x)) for x in symbols[:whole].reshape(-1, block) @ weights]
    rest = symbols[whole:]
    if len(rest):
        found.append((len(rest), int(rest @ weights[block - len(rest) :])))
    return found


def summed_up(signs: str, made: Tables) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What a run does: vector before it and cost by vector behind, state behind by both."""
    blocks = _blocks(symbols_of(signs), len(made.before))
    n = len(made.vectors)
    vector, cost, behind = np.arange(n), np.zeros(n, np.int64), []
    for length, number in reversed(blocks):
        behind.append(vector)
        cost = cost + made.cost[length - 1][vector, number]
        vector = made.before[length - 1][vector, number]
    state = np.tile(np.arange(STATES), (n, 1))
    for (length, number), right in zip(blocks, reversed(behind), strict=True):
        state = made.state[length - 1][right[:, None], number, state]
    return vector, cost, state


def composed(
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]],
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What runs one after the other do together."""
    n = len(parts[0][0])
    vector, cost, behind = np.arange(n), np.zeros(n, np.int64), []
    for before, spent, _ in reversed(parts):
        behind.append(vector)
        cost = cost + spent[vector]
        vector = before[vector]
    state = np.tile(np.arange(STATES), (n, 1))
    for (_, _, to), right in zip(parts, reversed(behind), strict=True):
        state = to[right[:, None], state]
    return vector, cost, state


def handed_down(
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], behind: int, state: int
) -> list[tuple[int, int]]:
    """(vector behind, state before) of each run, from those of all of them together."""
    rights = []
    for before, _, _ in reversed(parts):
        rights.append(behind)
        behind = int(before[behind])
    found = []
    for (_, _, to), right in zip(parts, reversed(rights), strict=True):
        found.append((right, state))
        state = int(to[right, state])
    return found


def edits_of(signs: str, behind: int, state: int, ends: bool, made: Tables) -> tuple[str, int]:
    """The cheapest edits of a run, the smallest string of them, and their cost.

    Blocks are passed by lookup from the end to the front; then each is expanded from its
    own end backward, symbol by symbol, and its edits are read from the front.
    """
    symbols, block = symbols_of(signs), len(made.before)
    rights, vector = [], behind
    for length, number in reversed(_blocks(symbols, block)):
        rights.append(vector)
        vector = int(made.before[length - 1][vector, number])
    said, spent = [], 0
    for i, right in enumerate(reversed(rights)):
        part = symbols[i * block : (i + 1) * block].tolist()
        inside = [right]
        for symbol in part[:0:-1]:
            inside.append(int(made.before[0][inside[-1], symbol]))
        for symbol, then in zip(part, reversed(inside), strict=True):
            letters, cost, state = made.letters[then, symbol, state]
            said.append(letters)
            spent += cost
    while ends and state not in (0, 3):
        said.append("I")
        spent, state = spent + INSERT, AFTER[state]
    return "".join(said), spent


# --- Damage and faults, as columns ----------------------------------------------------------

_WORD_CHAR = r"[^\x20\x09-\x0D]"


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after damage by crc32 of `conv_id:turn` over 20.

    A row is dropped (0), loses its text (1) or its marks (2), is repeated (3) or becomes
    a user's (4). Nulls count as one space, in the key as in role and text.
    """
    space = F.lit(" ")

    def said(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), space)

    fate = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    rows = conversations.select(
        "conv_id", "turn", said("role").alias("role"), said("text").alias("text"),
        fate.alias("_fate"),
    ).filter("_fate <> 0")
    fate, text = F.col("_fate"), F.col("text")
    return rows.select(
        "conv_id",
        "turn",
        F.when(fate == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(fate == 1, F.lit(""))
        .when(fate == 2, F.translate(text, ".!?", ""))
        .otherwise(text)
        .alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(fate == 3, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")


def _key(conv_id: Column) -> Column:
    """A text that stands for an id of any type, null or not."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit("null"))


def in_order(rows: DataFrame) -> DataFrame:
    """(key, at, turn, role, text, said): rows numbered conversation by conversation.

    Sorted by turn, nulls first, then by a hash of role and text, over all tasks: a long
    conversation is spread like any other rows. `at` has no gaps, also between tasks.
    """
    marked = rows.select(
        _key(F.col("conv_id")).alias("key"),
        F.col("turn").cast("long").alias("turn"),
        "role",
        "text",
        F.sha2(F.concat(F.length("role"), F.lit(":"), F.col("role"), F.col("text")), 256)
        .alias("said"),
        # Equal rows are spread by this number.
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["key", F.col("turn").asc_nulls_first(), "said", "row"]
    marked = staged(marked, "damaged-turns")
    ranged = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = staged(
        ranged.drop("row").withColumn("place", F.monotonically_increasing_id()), "ordered-turns"
    )
    # The upper bits of a place number the task, the lower ones its rows.
    task = F.shiftright("place", 33)
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = ranged.groupBy(task.alias("task")).agg(F.count("*").alias("n"))
    tasks = tasks.select("task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    tasks = staged(tasks, "turn-tasks")
    # One row per shuffle partition.
    numbered = ranged.withColumn("task", task).join(F.broadcast(tasks), "task")
    at = F.col("base") + F.col("place").bitwiseAND((1 << 33) - 1)
    return numbered.select("key", at.alias("at"), "turn", "role", "text", "said")


def signed(rows: DataFrame) -> DataFrame:
    """(key, at, turn, initial, fault) of ordered rows: the first fault that each row has."""
    first = (
        rows.groupBy("key", "said")
        .agg(F.min("at").alias("first"), F.max("at").alias("final"))
        .filter(F.col("first") != F.col("final"))
        .select("key", "said", "first")
    )
    # Written first, so that the join can split a text that very many rows repeat.
    first = staged(first, "repeated-turns")
    text = F.col("text")
    ending = F.regexp_extract(text, r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    initial = F.substring("role", 1, 1)
    flat = rows.select(
        "key",
        "at",
        "turn",
        "said",
        F.when(initial == "", F.lit(None)).otherwise(initial).alias("initial"),
        (~text.rlike(_WORD_CHAR)).alias("blank"),
        (~ending.isin(".", "!", "?")).alias("cut_off"),
    )
    fault = (
        F.when(F.col("blank"), BLANK)
        .when(F.col("at") > F.col("first"), DUPLICATE)
        .when(F.col("cut_off"), CUT_OFF)
        .otherwise(SOUND)
    )
    role = F.coalesce(F.instr(F.lit(INITIALS), F.col("initial")), F.lit(0))
    role = F.when(role > 0, role - 1).otherwise(F.lit(3))
    return flat.join(first, ["key", "said"], "left").select(
        "key", "at", "turn", role.alias("role"), fault.alias("fault")
    )


def segments(rows: DataFrame, segment_rows: int) -> DataFrame:
    """(key, segment, signs, previous): runs of at most `segment_rows` rows of a conversation.

    `previous` is the sign of the row before the run, if the conversation has one.
    """
    sign = F.char(F.lit(ord("A")) + F.col("role") + 4 * F.col("fault"))
    own = F.floor(F.col("at") / segment_rows)
    last = F.col("at") % segment_rows == segment_rows - 1
    copies = F.array(
        F.struct(own.alias("segment"), F.lit(False).alias("led")),
        F.struct((own + 1).alias("segment"), F.lit(True).alias("led")),
    )
    parts = rows.select(
        "key", "at", sign.alias("sign"),
        F.explode(F.when(last, copies).otherwise(F.slice(copies, 1, 1))).alias("to"),
    )
    mine = F.when(~F.col("to.led"), F.struct("at", "sign"))
    found = parts.groupBy("key", F.col("to.segment").alias("segment")).agg(
        F.sort_array(F.collect_list(mine)).alias("mine"),
        F.max(F.when(F.col("to.led"), F.col("sign"))).alias("previous"),
    )
    return found.filter(F.size("mine") > 0).select(
        "key",
        "segment",
        F.get("mine", F.lit(0))["at"].alias("start"),
        F.array_join(F.transform("mine", lambda x: x["sign"]), "").alias("signs"),
        "previous",
    )


# --- Segments of one conversation, put together level by level --------------------------------

_SUM = "before array<long>, cost array<long>, state array<long>"


def _packed(parts) -> list[list[int]]:
    return [np.asarray(x).ravel().tolist() for x in parts]


def _unpacked(frame: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    return [
        (np.asarray(b), np.asarray(c), np.asarray(s).reshape(-1, STATES))
        for b, c, s in zip(frame["before"], frame["cost"], frame["state"], strict=True)
    ]


def _summaries(parts: DataFrame, block: int) -> DataFrame:
    def sum_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = tables(block)
        for batch in batches:
            sums = [_packed(summed_up(s, made)) for s in batch["signs"]]
            out = pd.DataFrame(sums, columns=["before", "cost", "state"])
            out.insert(0, "key", batch["key"].to_numpy())
            out.insert(1, "node", batch["segment"].to_numpy())
            yield out

    return parts.select("key", "segment", "signs").mapInPandas(
        sum_up, f"key string, node long, {_SUM}"
    )


def _parents(nodes: DataFrame, fan_in: int) -> DataFrame:
    def join(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node")
        sums = _packed(composed(_unpacked(group)))
        first = group.iloc[0]
        return pd.DataFrame([[first["key"], first["parent"], *sums]],
                            columns=["key", "node", "before", "cost", "state"])

    keyed = nodes.withColumn("parent", F.floor(F.col("node") / fan_in))
    return keyed.groupBy("key", "parent").applyInPandas(join, f"key string, node long, {_SUM}")


def _children(nodes: DataFrame, given: DataFrame, fan_in: int) -> DataFrame:
    """(key, node, behind, entering) of nodes, from those of their parents."""

    def hand(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node")
        top = group.iloc[0]
        found = handed_down(_unpacked(group), int(top["behind"]), int(top["entering"]))
        out = group[["key", "node"]].copy()
        out["behind"], out["entering"] = [f[0] for f in found], [f[1] for f in found]
        return out

    keyed = nodes.withColumn("parent", F.floor(F.col("node") / fan_in))
    tops = given.withColumnRenamed("node", "parent")
    return keyed.join(tops, ["key", "parent"]).groupBy("key", "parent").applyInPandas(
        hand, "key string, node long, behind long, entering long"
    )


def _boundaries(parts: DataFrame, fan_in: int, block: int) -> DataFrame:
    """(key, segment, behind, entering, ends) of the segments of long conversations."""
    end = tables(block).end
    levels = [staged(_summaries(parts, block), "segment-sums")]
    while not levels[-1].groupBy("key").count().filter("count > 1").isEmpty():
        levels.append(staged(_parents(levels[-1], fan_in), "segment-sums"))
    given = levels.pop().select(
        "key", "node", F.lit(end).cast("long").alias("behind"), F.lit(0).cast("long").alias("entering")
    )
    while levels:
        given = staged(_children(levels.pop(), given, fan_in), "segment-bounds")
    return given.withColumnRenamed("node", "segment")


def _plans(bounded: DataFrame, block: int) -> DataFrame:
    """(key, at, edits, cost, illegal) of segments with their boundaries."""

    def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = tables(block)
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                edits, cost = edits_of(
                    row.signs, int(row.behind), int(row.entering), bool(row.ends), made
                )
                roles = [(ord(c) - ord("A")) % 4 for c in (row.previous or "") + row.signs]
                illegal = sum(p not in LEGAL for p in zip(roles, roles[1:]))
                rows.append((row.key, row.start, edits, cost, illegal))
            yield pd.DataFrame(rows, columns=["key", "at", "edits", "cost", "illegal"])

    return bounded.select(
        "key", "start", "signs", "previous", "behind", "entering", "ends"
    ).mapInPandas(plan, "key string, at long, edits string, cost long, illegal long")


# --- The repaired text ---------------------------------------------------------------------------


class _Writer:
    """Hashes the repaired conversation as its edits and rows pass by."""

    def __init__(self) -> None:
        self.hash, self.edits, self.at, self.state, self.lines = hashlib.sha256(), [], 0, 0, 0
        self.open = ""

    def _line(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.lines else "") + f"{role}:{text}").encode("utf-8", "replace"))
        self.lines += 1

    def plan(self, edits: str) -> None:
        self.edits.append(edits)
        self.open, self.at = self.open[self.at :] + edits, 0

    def _inserts(self) -> None:
        while self.open.startswith("I", self.at):
            self._line(ROLES[self.state], "")
            self.state, self.at = AFTER[self.state], self.at + 1

    def row(self, role: str, text: str) -> None:
        self._inserts()
        letter, self.at = self.open[self.at], self.at + 1
        if letter == "K":
            self._line(role, text)
            self.state = KEPT[self.state, INITIALS.index(role[0])]
        elif letter == "R":
            self._line(ROLES[self.state], text)
            self.state = AFTER[self.state]

    def done(self) -> tuple[str, str]:
        self._inserts()
        return "".join(self.edits), self.hash.hexdigest()


def _written(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """(key, audit, repaired_sha256): each conversation's rows pass by in order, once.

    A hash over a conversation is a chain by its nature. Its rows come sorted from disk
    and are forgotten at once, so a long conversation takes time but no memory.
    """
    lines = rows.select("key", "at", F.lit(1).alias("kind"), "role", "text")
    edits = plans.select(
        "key", "at", F.lit(0).alias("kind"), F.lit("").alias("role"), F.col("edits").alias("text")
    )
    passing = lines.unionByName(edits).repartition("key").sortWithinPartitions("key", "at", "kind")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: list[tuple[str, str, str]]) -> pa.RecordBatch:
            columns = [pa.array(x, pa.string()) for x in zip(*found)] if found else (
                [pa.array([], pa.string())] * 3
            )
            return pa.RecordBatch.from_arrays(
                list(columns), names=["key", "audit", "repaired_sha256"]
            )

        key, writer = None, None
        for batch in batches:
            found = []
            columns = [batch.column(c).to_pylist() for c in ("key", "kind", "role", "text")]
            for mine, kind, role, text in zip(*columns, strict=True):
                if writer is None or mine != key:
                    if writer is not None:
                        found.append((key, *writer.done()))
                    key, writer = mine, _Writer()
                if kind == 0:
                    writer.plan(text)
                else:
                    writer.row(role, text)
            yield out(found)
        if writer is not None:
            yield out([(key, *writer.done())])

    return passing.select("key", "kind", "role", "text").mapInArrow(
        write, "key string, audit string, repaired_sha256 string"
    )


def repair(
    conversations: DataFrame,
    rows: DataFrame | None = None,
    segment_rows: int = SEGMENT_ROWS,
    fan_in: int = FAN_IN,
    block: int = BLOCK,
) -> DataFrame:
    """One row per conv_id: its faults, and the cheapest edits that repair its structure.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256. `rows` are the turns to judge (conv_id, turn, role, text), by default
    those of `conversations`; every conv_id of `conversations` has a result, one without
    rows zeros and empty strings. Nulls of role and text count as one space. Turns are
    ordered by number, nulls first, then by a hash of role and text; rows that repeat all
    of it are duplicates. A null conv_id is a conversation like any other; other columns
    are ignored. An empty table gives an empty result. A hot conversation is judged in
    segments of `segment_rows`; only its hash, a chain, runs in one task.
    """
    if rows is None:
        space = F.lit(" ")
        rows = conversations.select(
            "conv_id", "turn", F.coalesce("role", space).alias("role"),
            F.coalesce("text", space).alias("text"),
        )
    ordered = in_order(rows)
    flat = staged(signed(ordered), "signed-turns")
    parts = staged(segments(flat, segment_rows), "segments")
    sizes = parts.groupBy("key").agg(F.count("*").alias("n"), F.max("segment").alias("final"))
    sizes = staged(sizes.filter("n > 1").select("key", "final"), "long-conversations")
    long = parts.join(sizes, "key")
    end = F.lit(tables(block).end).cast("long")
    short = parts.join(sizes, "key", "left_anti").select(
        "*", end.alias("behind"), F.lit(0).cast("long").alias("entering"), F.lit(True).alias("ends")
    )
    if not sizes.isEmpty():
        bounds = _boundaries(long.select("key", "segment", "signs"), fan_in, block)
        long = long.join(bounds, ["key", "segment"]).withColumn(
            "ends", F.col("segment") == F.col("final")
        )
        short = short.unionByName(long.drop("final"))
    plans = staged(_plans(short, block), "edit-plans")

    turn = F.col("turn").cast("decimal(20,0)")
    span = F.max(turn) - F.min(turn) + 1 - F.count_distinct("turn")
    most = F.lit((1 << 63) - 1).cast("decimal(22,0)")
    faults = [F.count_if(F.col("fault") == f) for f in (BLANK, DUPLICATE, CUT_OFF)]
    stats = flat.groupBy("key").agg(
        F.least(F.coalesce(span, F.lit(0)), most).cast("long").alias("gaps"),
        *(n.alias(c) for n, c in zip(faults, ("blank", "duplicate", "truncated"), strict=True)),
    )
    costs = plans.groupBy("key").agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost")
    )
    named = conversations.select(_key(F.col("conv_id")).alias("key"), "conv_id").distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    facts = named.withColumn("named", F.lit(True))
    for more in (stats, costs, _written(ordered, plans)):
        facts = facts.unionByName(more, allowMissingColumns=True)
    facts = facts.groupBy("key").agg(
        F.max("named").alias("named"),
        F.max("conv_id").alias("conv_id"),
        *(F.coalesce(F.max(c), F.lit(0)).alias(c) for c in counts),
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256(b"").hexdigest()))
        .alias("repaired_sha256"),
    )
    return facts.filter("named").select("conv_id", *counts, "audit", "repaired_sha256")
