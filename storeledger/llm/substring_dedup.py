"""Substring dedup: runs of consecutive sentences that repeat anywhere in the corpus.

Every run of `RUN` sentences is hashed, and so is every shorter run of many words; a run
that shorter hashed runs cover is left out, since they say the same. Runs are grouped by hash over all documents, and sentences under any occurrence but the
first are removed. Most runs stand once: they are counted by one hash, and only those that
may repeat are carried further. Grouping folds to a count, then to the first occurrence,
before each shuffle, so a run that a third of all documents share never meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.llm.common import staged, word_count

RUN = 3
# Words of a long passage. A run of fewer sentences counts too if it has half of them, as
# a passage may start and end inside sentences.
LONG_RUN_WORDS = 50
# A run's place is its first position times this, plus its number of sentences.
SPAN = 256
# A sentence ends after a mark and its closing quotes, before white space, or with its line.
# A run of white space is taken whole, from its first character only, so that long runs
# are passed once.
_BREAK = (
    r"(?=[\x20\x09-\x0D])(?<![\x20\x09-\x0D])"
    r"(?:(?<=[.!?…][\"'”’)\]]{0,3})[\x20\x09][\x20\x09-\x0D]*+"
    r"|[\x20\x09\x0B-\x0D]*+\n[\x20\x09-\x0D]*+)"
)


def sentences(text: Column) -> Column:
    """The sentences of a text, white space around them removed; none for null."""
    parts = F.transform(
        F.split(F.coalesce(text, F.lit("")), _BREAK), lambda s: F.btrim(s, F.lit(" \t\n\x0b\x0c\r"))
    )
    return F.filter(parts, lambda s: s != "")


def _runs(hashes: Column, sizes: Column, run: int, long_words: int) -> Column:
    """(at, n, h1, h2) of each run: `run` sentences, or fewer with half of `long_words`."""
    enough = (long_words + 1) // 2

    def one(i: Column, n: int) -> Column:
        part = [F.get(hashes, i + k) for k in range(n)]
        return F.struct(
            i.alias("at"),
            F.lit(n).alias("n"),
            F.xxhash64(F.lit(n), *part).alias("h1"),
            F.xxhash64(F.lit("second"), *reversed(part)).alias("h2"),
        )

    def starts(n: int) -> Column:
        return F.sequence(F.lit(0), F.size(hashes) - n)

    def needed(n: int):
        """Of n sentences: a run, unless the two runs of n - 1 inside it are runs too."""

        def test(i: Column) -> Column:
            sizes_here = [F.get(sizes, i + k) for k in range(n)]
            words = sum(sizes_here[1:], sizes_here[0])
            fits = F.lit(True) if n == run else words >= enough
            if n == 1:
                return fits
            inside = words - F.greatest(sizes_here[0], sizes_here[-1])
            return fits & (inside < enough)

        return test

    def of(n: int):
        return lambda i: one(i, n)

    none = F.array().cast("array<struct<at:int,n:int,h1:bigint,h2:bigint>>")
    runs = []
    for n in range(1, run + 1):
        needed_starts = F.filter(starts(n), needed(n))
        runs.append(F.when(F.size(hashes) >= n, F.transform(needed_starts, of(n))))
    return F.concat(*[F.coalesce(r, none) for r in runs])


def substring_dedup(
    docs: DataFrame,
    run: int = RUN,
    long_words: int = LONG_RUN_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_sentences, n_removed, removed, text.

    `removed` lists the positions of removed sentences; `text` is the original text if
    none was, else the kept sentences, one per line. The first occurrence of a run is
    the one with the smallest (doc_id, hash of the text, position), null ids last. Rows
    that repeat both id and text are one document and get the same result. Null and
    empty texts have no sentences and stay as they are. Other columns are ignored. An
    empty table gives an empty result.
    """
    if not 1 <= run < SPAN:
        raise ValueError(f"a run has 1 to {SPAN - 1} sentences")
    text, said = F.col("_text"), F.col("_said")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rows = rows.withColumn("_mark", F.xxhash64(text))
    runs = (
        rows.select("_id", "_mark", sentences(text).alias("_said"))
        .select(
            "_id",
            "_mark",
            F.transform(said, lambda s: F.xxhash64(s)).alias("_hashes"),
            F.transform(said, word_count).alias("_sizes"),
        )
        .select("_id", "_mark", F.explode(_runs(F.col("_hashes"), F.col("_sizes"), run, long_words)))
        # Position and length in one number: rows stay narrow.
        .select("_id", "_mark", (F.col("col.at").cast("long") * SPAN + F.col("col.n")).alias("span"),
                "col.h1", "col.h2")
    )
    runs = staged(runs, "sentence-runs")

    place = F.struct(
        F.col("_id").isNull().alias("last"), F.col("_id").alias("id"), F.col("_mark").alias("mark"),
        F.col("span").alias("span"),
    )
    # Half of the hash tells which runs may repeat; the count is all that is shuffled.
    often = runs.groupBy("h1").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h1")
    # Written first, so that each join shuffles both sides and a hot run can be split.
    often = staged(often, "repeated-hashes")
    repeats = staged(runs.join(often, "h1", "left_semi"), "repeats")
    firsts = repeats.groupBy("h1", "h2").agg(F.min(place).alias("first"))
    firsts = staged(firsts, "first-runs")
    later = repeats.withColumn("place", place).join(firsts, ["h1", "h2"])
    at = F.floor(F.col("span") / SPAN).cast("int")
    spots = later.filter(F.col("place") != F.col("first")).select(
        "_id", "_mark", F.explode(F.sequence(at, at + (F.col("span") % SPAN).cast("int") - 1))
        .alias("spot"),
    )
    # A document's list holds its own sentences only, each once.
    removed = (
        spots.groupBy("_id", "_mark")
        .agg(F.sort_array(F.collect_set("spot")).alias("_removed"))
        .withColumnsRenamed({"_id": "_of", "_mark": "_with"})
    )
    rows = rows.join(
        removed, F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_mark") == F.col("_with")), "left"
    ).select(
        "_id",
        "_text",
        sentences(text).alias("_said"),
        F.coalesce("_removed", F.array().cast("array<int>")).alias("removed"),
    )
    gone = F.size("removed")
    kept = F.array_except(F.sequence(F.lit(0), F.size(said) - 1), F.col("removed"))
    cut = F.array_join(F.transform(kept, lambda i: F.get(said, i)), "\n")
    return rows.select(
        F.col("_id").alias(id_col),
        F.size(said).cast("long").alias("n_sentences"),
        gone.cast("long").alias("n_removed"),
        "removed",
        F.when(gone == 0, text).otherwise(cut).alias("text"),
    )
