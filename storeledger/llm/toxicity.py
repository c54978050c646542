"""Toxicity by a factorization machine over hashed terms.

A term is a word or the first letters of one, hashed to a bucket. The machine scores the
set of a text's terms by a weight for each and an inner product of factors for each pair,
so it learns what two terms say together, such as an insult beside the mention of a group,
which no sum of single weights can say. It is fitted on a bounded sample of labelled rows;
all pairs of a text are summed in time linear in its terms.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.llm.common import staged

# Rows that are fitted, and terms whose weights are kept: bounds of the sample and model.
MAX_LABELLED = 20_000
MAX_TERMS = 1_024
BUCKETS = 1 << 20
FACTORS = 8
# Terms of fewer sampled texts than this are noise.
LEAST_TEXTS = 3
# A kept term's count among toxic texts is this many deviations off chance.
LEAST_SIGMAS = 6.0
PREFIXES = (4, 5, 6, 7, 8)
THRESHOLD = 0.3
WORD = re.compile(r"\w+")
# Words looked up once per task: as many as this, none longer than that.
CACHED_WORDS, CACHED_CHARS = 200_000, 64


def term_buckets(word: str) -> tuple[int, ...]:
    """The buckets of a lower-case word: the word itself, and its first letters."""
    terms = [word, *(f"^{word[:n]}" for n in PREFIXES if len(word) >= n)]
    return tuple(zlib.crc32(t.encode("utf-8", "surrogatepass")) % BUCKETS for t in terms)


def words_of(text: str | None) -> set[str]:
    """The distinct words of a whole text, lower-cased."""
    return set(WORD.findall(text.lower())) if text else set()


@dataclass(frozen=True)
class Machine:
    """A fitted machine: a place per kept bucket, its weight and its factors."""

    places: dict[int, int]
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, at: Iterable[int]) -> float:
        """The chance of label 1 for a set of places."""
        at = np.fromiter(at, np.int64)
        v = self.factors[at]
        pairs = 0.5 * float((v.sum(axis=0) ** 2 - (v**2).sum(axis=0)).sum())
        said = self.bias + float(self.weights[at].sum()) + pairs
        return float(1 / (1 + np.exp(-np.clip(said, -40, 40))))


def fit(
    texts: list[np.ndarray],
    toxic: np.ndarray,
    kept: Sequence[int] | None = None,
    factors: int = FACTORS,
    epochs: int = 20,
    batch: int = 256,
    rate: float = 0.03,
    decay: float = 1e-4,
    factor_decay: float = 1e-2,
) -> Machine:
    """A machine from the bucket sets of texts and their labels (0 or 1).

    `kept` are the buckets that take part, by default those of enough texts. Of labels
    that are all alike the machine learns that share alone.
    """
    toxic = np.asarray(toxic, dtype=float)
    rate_of_all = float((toxic.sum() + 0.5) / (len(toxic) + 1))
    bias = float(np.log(rate_of_all / (1 - rate_of_all)))
    if kept is None:
        flat = np.concatenate(texts) if texts else np.zeros(0, np.int64)
        kept = np.nonzero(np.bincount(flat, minlength=BUCKETS) >= LEAST_TEXTS)[0]
    kept = np.sort(np.asarray(kept, dtype=np.int64))
    if not len(kept) or not 0 < toxic.sum() < len(toxic):
        return Machine({}, bias, np.zeros(0), np.zeros((0, factors)))

    place = np.full(BUCKETS, -1)
    place[kept] = np.arange(len(kept))
    rows = [p[p >= 0] for p in (place[t] for t in texts)]
    draw = np.random.default_rng(7)
    w = np.zeros(len(kept), np.float32)
    v = draw.normal(0, 0.05, (len(kept), factors)).astype(np.float32)
    state = [np.zeros(1), np.zeros(1), *(np.zeros_like(x) for x in (w, w, v, v))]
    step = 0

    def moved(at: int, grad: np.ndarray) -> np.ndarray:
        """Adam's step for a gradient; moments at places `at` and `at + 1`."""
        state[at] = 0.9 * state[at] + 0.1 * grad
        state[at + 1] = 0.999 * state[at + 1] + 0.001 * grad**2
        first, second = state[at] / (1 - 0.9**step), state[at + 1] / (1 - 0.999**step)
        return rate * first / (np.sqrt(second) + 1e-8)

    for _ in range(epochs):
        order = draw.permutation(len(rows))
        for start in range(0, len(rows), batch):
            mine = order[start : start + batch]
            x = np.zeros((len(mine), len(kept)), np.float32)
            for i, r in enumerate(mine):
                x[i, rows[r]] = 1.0
            summed = x @ v
            # Terms are there or not, so squares of x are x.
            said = bias + x @ w + 0.5 * ((summed**2).sum(axis=1) - (x @ (v**2)).sum(axis=1))
            error = (1 / (1 + np.exp(-np.clip(said, -40, 40))) - toxic[mine]) / len(mine)
            error = error.astype(np.float32)
            held = x.T @ error
            step += 1
            bias -= float(moved(0, np.array([error.sum()]))[0])
            gw = held + decay * w
            gv = x.T @ (error[:, None] * summed) - held[:, None] * v + factor_decay * v
            w = w - moved(2, gw)
            v = v - moved(4, gv)
    return Machine({int(b): i for i, b in enumerate(kept)}, bias, w, v)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learned: crc32 of the id as text leaves 2 over 4."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(text) % 4 == 2


def bucketed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, at, buckets): the distinct buckets of each whole text; `at` is a hash of the row."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                sorted({b for w in words_of(text) for b in term_buckets(w)})
                for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("at"), pa.array(found, pa.list_(pa.int32()))],
                names=["id", "at", "buckets"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("at", F.xxhash64("id", "text"))
    return rows.select("id", "text", "at").mapInArrow(
        cut, f"id {kind}, at long, buckets array<int>"
    )


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_labelled: int = MAX_LABELLED,
    max_terms: int = MAX_TERMS,
    **settings,
) -> Machine:
    """Fit a machine on at most `max_labelled` labelled rows that are not held out.

    The rows are those of the smallest hashes, so reruns agree. An id labelled several
    times counts as toxic if one label says so; null ids and null labels take no part. The
    driver gets the numbers of telling terms in the sample, never texts. Without labelled rows every
    text scores alike.
    """
    known = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .filter(~held_out(id_col))
        .groupBy(F.col(id_col).alias("_of"))
        .agg(F.max((F.col(label_col) > 0).cast("int")).alias("_label"))
    )
    chosen = known.orderBy(F.xxhash64("_of"), "_of").limit(max_labelled)
    chosen = staged(chosen, "labelled")
    # At most `max_labelled` ids and labels are broadcast.
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(
        F.broadcast(chosen), F.col("_id") == F.col("_of")
    )
    sample = bucketed(rows.select("_id", "_text"), "_id", "_text")
    sample = staged(sample, "labelled-terms").dropDuplicates(["at", "id"])
    # An id may stand on very many rows: the bound holds for rows too.
    sample = sample.orderBy("at", "id").limit(max_labelled)
    sample = sample.join(F.broadcast(chosen), F.col("id") == F.col("_of"))
    sample = staged(sample.select("at", "id", "buckets", "_label"), "labelled-sample")
    kept = [r.bucket for r in telling_terms(sample, max_terms).collect()]
    mine = F.array(*[F.lit(b) for b in kept]) if kept else F.array().cast("array<int>")
    got = sample.select("at", "id", "_label", F.array_intersect("buckets", mine).alias("buckets"))
    got = got.orderBy("at", "id").toArrow()
    lists = got.column("buckets").combine_chunks()
    flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
    terms = [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return fit(terms, np.asarray(got.column("_label").to_pylist(), dtype=float), kept, **settings)


def telling_terms(sample: DataFrame, max_terms: int = MAX_TERMS) -> DataFrame:
    """(bucket) of (buckets, _label) rows: the terms whose labels are furthest off chance.

    Of a term's texts, the toxic ones are counted against the share of all texts, in
    standard deviations.
    """
    facts = sample.agg(F.avg("_label").alias("share")).first()
    share = float(facts["share"] or 0.0)
    counts = (
        sample.select(F.explode("buckets").alias("bucket"), "_label")
        .groupBy("bucket")
        .agg(F.count("*").alias("seen"), F.sum("_label").alias("hits"))
        .filter(F.col("seen") >= LEAST_TEXTS)
    )
    spread = F.sqrt(F.col("seen") * F.lit(share * (1 - share) + 1e-12))
    far = F.abs(F.col("hits") - F.col("seen") * F.lit(share)) / spread
    counts = counts.withColumn("far", far).filter(F.col("far") >= LEAST_SIGMAS)
    return counts.orderBy(F.col("far").desc(), "bucket").limit(max_terms).select("bucket")


def toxicity(
    docs: DataFrame,
    machine: Machine,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    The score depends on the whole text and on nothing else: rows with equal texts score
    alike. A null text counts as empty and has the score of a text without terms. Null
    ids are passed through and are not held out; other columns are ignored; an empty
    table gives an empty result.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, cache = machine.places, {}
        for batch in batches:
            scores = []
            for text in batch.column("text").to_pylist():
                found: set[int] = set()
                for word in words_of(text):
                    at = cache.get(word)
                    if at is None:
                        at = tuple(places[b] for b in term_buckets(word) if b in places)
                        if len(word) <= CACHED_CHARS:
                            if len(cache) >= CACHED_WORDS:
                                cache.clear()
                            cache[word] = at
                    found.update(at)
                scores.append(machine.score(sorted(found)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held"), pa.array(scores, pa.float64())],
                names=["id", "held", "score"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.col(id_col).alias("id"), held_out(id_col).alias("held"), F.col(text_col).alias("text")
    )
    scored = rows.mapInArrow(judge, f"id {kind}, held boolean, score double")
    return scored.select(
        F.col("id").alias(id_col),
        F.col("held").alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
