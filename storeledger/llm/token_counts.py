"""Token counts: an exact histogram of encoded lengths, and what it says of every limit."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storeledger.llm.common import staged

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: how the vocabulary's tokenizer cuts text before merging.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
LENGTHS_PER_BLOCK = 4096
# White space as the pattern means it, in runs that are cut out.
LONG_SPACE = re.compile(
    "[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{4096,}"
)


def encoder(vocabulary: str):
    """The tokenizer of a ranks file; a task reads the file once."""
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(made, text: str | None) -> int:
    """How many tokens a whole text has; 0 for null.

    The tokenizer's pattern goes back one character from the end of white space, which
    overflows its stack on very long runs. The pattern makes such a run one piece, but for its
    last character if text follows; so the run is cut out and merged by itself, and the
    rest is encoded as usual: the count is that of the uncut text.
    """
    if not text:
        return 0
    count, at = 0, 0
    for run in LONG_SPACE.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        count += len(made.encode_ordinary(text[at : run.start()]))
        count += len(made._encode_single_piece(text[run.start() : end]))
        at = end
    return count + len(made.encode_ordinary(text[at:]))


def token_lengths(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_tokens) of whole texts; null and empty texts have 0.

    Special tokens' strings count as ordinary text. The vocabulary file must lie on every
    machine, like any installed package.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(vocabulary)
        for batch in batches:
            sizes = [token_count(made, t) for t in batch.column("text").to_pylist()]
            # The id passes by as it is, whatever its type and size.
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64())], names=["id", "n_tokens"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(count, f"id {kind}, n_tokens long").withColumnRenamed("id", id_col)


def length_histogram(lengths: DataFrame, length_col: str = "n_tokens") -> DataFrame:
    """One row per distinct length, with sums that answer questions about any limit.

    n_tokens, n_docs; docs_from, tokens_from: documents of this length or more and
    their tokens; tokens_cut: tokens left if every text is cut at this length; docs_to:
    documents of at most this length, whose share is the length's quantile rank.

    The sums run over blocks of lengths first, then inside each block, so no task has
    more than a block of distinct lengths. Null lengths count as 0; an empty table gives
    an empty result.
    """
    size = F.coalesce(F.col(length_col), F.lit(0)).cast("long")
    counts = lengths.groupBy(size.alias("n_tokens")).agg(F.count("*").alias("n_docs"))
    counts = counts.withColumn("block", F.floor(F.col("n_tokens") / LENGTHS_PER_BLOCK))
    counts = counts.withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    counts = staged(counts, "length-counts")  # Texts are encoded once.
    blocks = counts.groupBy("block").agg(
        F.sum("n_docs").alias("block_docs"), F.sum("tokens").alias("block_tokens")
    )
    later = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy(F.lit(0))
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("block_docs").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("block_tokens").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("block_docs").over(total).alias("all_docs"),
        F.sum("block_tokens").over(total).alias("all_tokens"),
    )
    inside = (
        Window.partitionBy("block")
        .orderBy(F.col("n_tokens").desc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    docs_from = F.sum("n_docs").over(inside) + F.col("later_docs")
    tokens_from = F.sum("tokens").over(inside) + F.col("later_tokens")
    rows = counts.join(F.broadcast(blocks), "block").select(
        "n_tokens",
        "n_docs",
        docs_from.alias("docs_from"),
        tokens_from.alias("tokens_from"),
        "all_docs",
        "all_tokens",
    )
    return rows.select(
        "n_tokens",
        "n_docs",
        "docs_from",
        "tokens_from",
        (F.col("all_tokens") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from"))
        .alias("tokens_cut"),
        (F.col("all_docs") - F.col("docs_from") + F.col("n_docs")).alias("docs_to"),
        "all_docs",
        "all_tokens",
    )


def total_under_limit(histogram: DataFrame, limit: int) -> int:
    """Tokens left when every text is cut at `limit`, from the histogram alone."""
    row = histogram.agg(F.sum(F.least("n_tokens", F.lit(limit)) * F.col("n_docs"))).first()
    return int(row[0] or 0)


def length_quantile(histogram: DataFrame, q: float) -> int | None:
    """The smallest length that at least a share q of the documents do not exceed."""
    row = histogram.filter(F.col("docs_to") >= q * F.col("all_docs")).agg(F.min("n_tokens")).first()
    return row[0]
