"""MinHash near-duplicates: one-permutation hashing, banded buckets, star-shaped edges.

Documents with equal shingle sets fold into classes first, and a class is one node with a
number of its own: an id may stand on rows with different texts. Each class gets a
one-permutation signature with optimal densification; bands of it are buckets. A bucket
proposes a star: its smallest node with each other member, so that edges stay linear in
its size. Stars are confirmed on full shingle sets, which also tells how each member
differs from the centre. Members that their stars left in different components are
settled by an exact bound on those differences, and what the bound can't rule out is
confirmed on full sets again. So no link between bucket mates is lost, and no group is
expanded into pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.llm.common import ascii_lower, staged, words
from storeledger.llm.components import components

# 32 bands of 5: a pair at a similarity of 0.8 misses all buckets once in 300,000 cases.
BANDS = 32
ROWS = 5
# Percent of the union that the intersection must reach.
SIMILAR = 80
# Members of one centre that a task compares with as many others.
CHUNK = 1024


@dataclass(frozen=True)
class Hashing:
    """How sets are hashed; travels to tasks as a value."""

    shingle: int
    bands: int = BANDS
    rows: int = ROWS

    @staticmethod
    def mixed(x: np.ndarray, seed: int) -> np.ndarray:
        """A 64-bit finalizer of xor-shifts and multiplications."""
        x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x1234567) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    def shingles(self, hashed_words: np.ndarray) -> np.ndarray:
        """The distinct shingles of a text's word hashes, sorted; few words are one shingle."""
        n = len(hashed_words)
        if n == 0:
            return np.empty(0, np.uint64)
        w = hashed_words.view(np.uint64)
        width = min(n, self.shingle)
        h = np.full(n - width + 1, width, np.uint64)
        for k in range(width):
            h = self.mixed(h ^ w[k : n - width + 1 + k], 1)
        return np.unique(h)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """The least hash per bin; an empty bin takes that of another, drawn by bin and try."""
        bins = self.bands * self.rows
        spread = self.mixed(shingles, 2)
        where = ((spread >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
        least = np.full(bins, np.uint64(0xFFFFFFFFFFFFFFFF))
        np.minimum.at(least, where.astype(np.int64), self.mixed(shingles, 3))
        full = np.zeros(bins, bool)
        full[where.astype(np.int64)] = True
        empty = np.nonzero(~full)[0]
        out = least.copy()
        attempt = 0
        while len(empty):
            attempt += 1
            draw = self.mixed(empty.astype(np.uint64) * np.uint64(1 << 20) + np.uint64(attempt), 4)
            source = (draw % np.uint64(bins)).astype(np.int64)
            hit = full[source]
            out[empty[hit]] = least[source[hit]]
            empty = empty[~hit]
        return out

    def band_keys(self, signature: np.ndarray) -> np.ndarray:
        table = signature.reshape(self.bands, self.rows)
        key = np.arange(self.bands, dtype=np.uint64)
        for r in range(self.rows):
            key = self.mixed(key ^ table[:, r], 5)
        return key.view(np.int64)

    def prints(self, shingles: np.ndarray) -> tuple[int, int]:
        """Two 64-bit fingerprints of a set."""
        one = int(np.sum(self.mixed(shingles, 6))) if len(shingles) else 0
        two = int(np.bitwise_xor.reduce(self.mixed(shingles, 7))) if len(shingles) else 0
        return tuple(x - (1 << 64) if x >= 1 << 63 else x for x in (one & (2**64 - 1), two))


def _word_hashes(text: Column) -> Column:
    return F.transform(words(ascii_lower(text)), lambda w: F.xxhash64(w))


def _lists(column: pa.Array) -> Iterator[np.ndarray]:
    values = column.values.to_numpy(zero_copy_only=False)
    offsets = column.offsets.to_numpy()
    for start, end in zip(offsets[:-1], offsets[1:], strict=True):
        yield values[start:end]


def signed(docs: DataFrame, hashing: Hashing) -> DataFrame:
    """(id, mark, row, n, fp1, fp2, keys) of (id, text) rows; no keys without shingles."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, one, two, keys = [], [], [], []
            for w in _lists(batch.column("hashes")):
                s = hashing.shingles(w)
                n.append(len(s))
                a, b = hashing.prints(s)
                one.append(a)
                two.append(b)
                keys.append(hashing.band_keys(hashing.signature(s)) if len(s) else [])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("id", "mark", "row")),
                    pa.array(n, pa.int64()),
                    pa.array(one, pa.int64()),
                    pa.array(two, pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["id", "mark", "row", "n", "fp1", "fp2", "keys"],
            )

    rows = docs.select(
        "id",
        F.xxhash64("text").alias("mark"),
        F.monotonically_increasing_id().alias("row"),
        _word_hashes(F.col("text")).alias("hashes"),
    )
    return rows.mapInArrow(
        sign, "id long, mark long, row long, n long, fp1 long, fp2 long, keys array<long>"
    )


def confirmed(edges: DataFrame, texts: DataFrame, hashing: Hashing) -> DataFrame:
    """(center, member, nc, nm, both, lost, added) of edges, from full shingle sets.

    lost and added are bit maps of what the member lacks of the centre and has beside
    it, of as many bits as the centre has shingles, rounded up to a power of two.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, center = None, None
        for batch in batches:
            nc, nm, both, lost, added = [], [], [], [], []
            ids = batch.column("center").to_pylist()
            pairs = zip(
                ids, _lists(batch.column("c_hashes")), _lists(batch.column("m_hashes")), strict=True
            )
            for cid, c_words, m_words in pairs:
                # Edges of a centre follow each other after the join on it.
                if last is None or cid != last[0] or len(last[1]) != len(c_words) or not (
                    np.array_equal(last[1], c_words)
                ):
                    last, center = (cid, c_words), hashing.shingles(c_words)
                member = hashing.shingles(m_words)
                at = np.searchsorted(center, member)
                at[at == len(center)] = max(0, len(center) - 1)
                shared = center[at] == member if len(center) else np.zeros(len(member), bool)
                bits = max(64, 1 << (max(1, len(center)) - 1).bit_length())
                missing = np.ones(len(center), bool)
                missing[at[shared]] = False
                nc.append(len(center))
                nm.append(len(member))
                both.append(int(shared.sum()))
                for out, part in ((lost, center[missing]), (added, member[~shared])):
                    flags = np.zeros(bits, np.uint8)
                    flags[(hashing.mixed(part, 8) & np.uint64(bits - 1)).astype(np.int64)] = 1
                    out.append(np.packbits(flags).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("center"),
                    batch.column("member"),
                    *(pa.array(x, pa.int64()) for x in (nc, nm, both)),
                    pa.array(lost, pa.binary()),
                    pa.array(added, pa.binary()),
                ],
                names=["center", "member", "nc", "nm", "both", "lost", "added"],
            )

    left = texts.select(F.col("id").alias("member"), F.col("text").alias("m_text"))
    right = texts.select(F.col("id").alias("center"), F.col("text").alias("c_text"))
    pairs = edges.join(left, "member").join(right, "center")
    return pairs.select(
        "center",
        "member",
        _word_hashes(F.col("c_text")).alias("c_hashes"),
        _word_hashes(F.col("m_text")).alias("m_hashes"),
    ).mapInArrow(
        compare,
        "center long, member long, nc long, nm long, both long, lost binary, added binary",
    )


def _is_link(similar: int) -> Column:
    union = F.col("nc") + F.col("nm") - F.col("both")
    return (100 * F.col("both") >= similar * union) & (union > 0)


def open_pairs(group: pd.DataFrame, similar: int, tentative: bool) -> list[tuple[int, int]]:
    """Pairs of a centre's members in different components that may be links.

    Of members x and y and their centre c, the intersection is at most
    |c| - |lost by either| + |added by both|; bit maps bound both sizes from the safe
    side. `tentative`: a pair that may be a link counts as one for the pairs after it.
    """
    n = len(group)
    comp = group["comp"].to_numpy().copy()
    size, both = group["nm"].to_numpy(), group["both"].to_numpy()
    ids, chunk = group["member"].to_numpy(), group["chunk"].to_numpy()
    center_size = int(group["nc"].iloc[0])
    lost, added = (
        np.frombuffer(b"".join(group[c]), np.uint64).reshape(n, -1) for c in ("lost", "added")
    )
    extra = size - both
    labels, counts = np.unique(comp, return_counts=True)
    largest = labels[counts.argmax()]
    across = group["i"].iloc[0] != group["j"].iloc[0]
    found = []
    # Pairs inside the largest component are settled; each other pair has a member outside.
    outside = np.nonzero(comp != largest)[0]
    waiting = np.zeros(n, bool)
    waiting[outside] = True
    for x in outside:
        waiting[x] = False
        other = (comp != comp[x]) & ~waiting
        if across:
            other &= chunk != chunk[x]
        y = np.nonzero(other)[0]
        y = y[100 * np.minimum(size[y], size[x]) >= similar * np.maximum(size[y], size[x])]
        if not len(y):
            continue
        kept = center_size - np.bitwise_count(lost[y] | lost[x]).sum(axis=1).astype(np.int64)
        kept = np.minimum(kept, np.minimum(both[y], both[x]))
        only_y = np.bitwise_count(added[y] & ~added[x]).sum(axis=1).astype(np.int64)
        only_x = np.bitwise_count(added[x] & ~added[y]).sum(axis=1).astype(np.int64)
        most = kept + np.minimum(extra[y] - only_y, extra[x] - only_x)
        y = y[(100 + similar) * most >= similar * (size[y] + size[x])]
        for one in y:
            if comp[one] != comp[x]:
                found.append((int(ids[x]), int(ids[one])))
                if tentative:
                    comp[comp == comp[one]] = comp[x]
    return found


def _unsettled(stars: DataFrame, labels: DataFrame, similar: int, tentative: bool) -> DataFrame:
    """(a, b): pairs under one centre that star edges left open and the bound can't exclude."""
    comp = F.coalesce("component", "member")
    rows = stars.join(labels.withColumnRenamed("id", "member"), "member", "left").withColumn(
        "comp", comp
    )
    groups = (
        rows.groupBy("center")
        .agg(F.min("comp").alias("least"), F.max("comp").alias("most"), F.count("*").alias("n"))
        .filter(F.col("least") != F.col("most"))
        .select("center", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    )
    chunk = F.pmod(F.xxhash64("member"), F.col("chunks")).cast("int")
    rows = rows.join(groups, "center").withColumn("chunk", chunk)
    # Every pair of chunks is a group of its own; a chunk goes to each pair that holds it.
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    blocks = rows.withColumn("other", other).select(
        "center", "member", "comp", "nc", "nm", "both", "lost", "added", "chunk",
        F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
    )

    def settle(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(open_pairs(group, similar, tentative), columns=["a", "b"], dtype="int64")

    return blocks.groupBy("center", "i", "j").applyInPandas(settle, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    similar: int = SIMILAR,
    id_col: str = "doc_id",
    text_col: str = "text",
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept, chosen.

    Documents are linked if the sets of their `shingle`-word runs, A-Z lower-cased,
    have an intersection of `similar` percent of their union or more; component_id is
    the smallest id that links reach, and kept marks the rows of that id: several where
    the id is repeated. `chosen` marks just one row of each component. A text of fewer
    words is one shingle; without words, or null, a text is linked with nothing. A row
    with a null id takes no part: its component is null, and it is kept and chosen. Rows
    that repeat an id are documents of their own, linked by their texts only. Other
    columns are ignored. An empty table gives an empty result.
    """
    found = _judged(docs, shingle, similar, id_col, text_col, bands, rows)
    return found.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
        F.col("kept").alias("chosen"),
    )


def kept_documents(
    docs: DataFrame,
    shingle: int = 5,
    similar: int = SIMILAR,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of `docs` that `near_duplicates` keeps, with all their columns.

    Rows are told apart by id and text; of rows that repeat both, one stays.
    """
    found = _judged(docs, shingle, similar, id_col, text_col).select("id", "mark", "n", "kept")
    found = staged(found.filter("id IS NOT NULL AND n > 0"), "judged")
    per_text = found.groupBy("id", "mark").agg(
        F.count_if("kept").alias("stays"), F.count("*").alias("rows")
    )
    gone = per_text.filter("stays = 0").select("id", "mark")
    again = staged(per_text.filter("stays > 0 AND rows > 1").select("id", "mark"), "repeated")
    # The row travels as one value: its columns may have any names.
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"),
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(text_col).alias("mark"),
    )
    # The dropped rows grow with the documents: shuffled at every size, never broadcast.
    kept = rows.join(gone.hint("merge"), ["id", "mark"], "left_anti")
    if not again.isEmpty():
        one_each = kept.join(again, ["id", "mark"], "left_semi").dropDuplicates(["id", "mark"])
        kept = kept.join(again, ["id", "mark"], "left_anti").unionByName(one_each)
    return kept.select("whole.*")


def _judged(
    docs: DataFrame,
    shingle: int,
    similar: int,
    id_col: str,
    text_col: str,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """(id, mark, n, component_id, kept) of each row; mark is a hash of its text.

    `kept` marks one row of each component.
    """
    hashing = Hashing(shingle, bands, rows)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sets = staged(signed(source, hashing), "signatures")
    marks = ["n", "fp1", "fp2"]
    # A class is a node; its head is the row of the smallest id.
    classes = (
        sets.filter("n > 0 AND id IS NOT NULL")
        .groupBy(*marks)
        .agg(F.min(F.struct("id", "mark", "row")).alias("head"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    # Written before they are joined: the join then shuffles both sides, so that a set
    # or bucket that very many documents share can be split.
    classes = staged(classes, "class-heads")
    member_keys = F.when(F.col("row") == F.col("head.row"), F.col("keys"))
    has_id = F.col("id").isNotNull()
    members = sets.join(classes, marks, "left").select(
        "id", "mark", "row", "n",
        F.when(has_id, F.col("node")).alias("node"),
        F.when(has_id, F.col("head")).alias("head"),
        member_keys.alias("keys"),
    )
    members = staged(members, "classes")

    buckets = members.filter(F.col("node").isNotNull() & F.col("keys").isNotNull()).select(
        F.explode("keys").alias("key"), F.col("node").alias("id")
    )
    centers = (
        buckets.groupBy("key")
        .agg(F.min("id").alias("center"), F.max("id").alias("last"))
        .filter(F.col("center") != F.col("last"))
        .select("key", "center")
    )
    centers = staged(centers, "bucket-heads")
    edges = (
        buckets.join(centers, "key")
        .filter(F.col("id") != F.col("center"))
        .select("center", F.col("id").alias("member"))
        .distinct()
    )
    edges = staged(edges, "stars")
    named = edges.select(F.col("center").alias("id")).unionByName(
        edges.select(F.col("member").alias("id"))
    )
    heads = classes.select(F.col("node").alias("id"), "head")
    wanted = named.distinct().join(heads, "id").select(
        F.col("head.id").alias("of"), F.col("head.mark").alias("mark"), F.col("id").alias("node")
    )
    # The nodes grow with the documents: they are shuffled at every size, never broadcast.
    # Rows that repeat an id and its text give one text.
    texts = (
        source.withColumnRenamed("id", "of")
        .withColumn("mark", F.xxhash64("text"))
        .join(wanted.hint("merge"), ["of", "mark"])
        .groupBy("of", "mark")
        .agg(F.first("node").alias("id"), F.first("text").alias("text"))
        .select("id", "text")
    )
    texts = staged(texts, "candidates")

    stars = staged(confirmed(edges, texts, hashing), "confirmed-stars")
    links = stars.filter(_is_link(similar)).select(
        F.col("center").alias("a"), F.col("member").alias("b")
    )
    labels = staged(components(links), "components")
    # Once with pairs that may be links counted as links, so that few pairs come of a
    # group whose centre is a stranger; then what that may have hidden, pair by pair.
    for tentative in (True, False):
        pairs = staged(_unsettled(stars, labels, similar, tentative), "open-pairs")
        checked = confirmed(
            pairs.select(F.col("a").alias("center"), F.col("b").alias("member")), texts, hashing
        )
        checked = staged(checked.drop("lost", "added"), "checked-pairs")
        facts = checked.agg(
            F.count_if(_is_link(similar)).alias("links"), F.count("*").alias("all")
        ).first()
        if facts["links"]:
            new = checked.filter(_is_link(similar)).select(
                F.col("center").alias("a"), F.col("member").alias("b")
            )
            known = labels.select(F.col("id").alias("a"), F.col("component").alias("b"))
            labels = staged(
                components(known.filter("a != b").unionByName(new)), "components"
            )
        if facts["links"] == facts["all"]:
            break

    # A component's head is the least of its classes' heads.
    tops = labels.join(heads, "id").groupBy("component").agg(F.min("head").alias("top"))
    tops = labels.join(staged(tops, "component-heads"), "component")
    tops = staged(tops.select(F.col("id").alias("node"), "top"), "tops")
    top = F.coalesce("top", "head")
    return members.join(tops, "node", "left").select(
        "id",
        "mark",
        "n",
        F.coalesce(top["id"], F.col("id")).alias("component_id"),
        F.coalesce(F.col("row") == top["row"], F.lit(True)).alias("kept"),
    )
