"""Quality rules: a table of thresholds compiled into one projection.

Every measure and every verdict is a built-in expression over the row's own text, so
the operator is a chain of projections: no shuffle, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.llm.common import plain_spaces, words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Common words of English, French, German and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from have in is it of on or that the this to was were "
    "which with you "
    "au aux ce dans de des du elle en est et il la le les ne nous par pas pour que qui se "
    "sur un une vous "
    "auf aus das dem den der des die ein eine er es für im ist mit nicht sich sie sind "
    "und von zu "
    "al como con del el los las lo más no para por su una y"
).split()


@dataclass(frozen=True)
class Rule:
    """Keep a document while low <= measure <= high; None leaves a side open."""

    measure: str
    low: float | None = None
    high: float | None = None


# The production table. A document is kept if it breaks no rule.
RULES = (
    Rule("mean_word_chars", low=1.5, high=15.0),
    Rule("symbol_ratio", high=0.2),
    Rule("stop_word_ratio", low=0.02),
    Rule("echo_ratio", high=0.5),
    Rule("dup_line_ratio", high=0.5),
    Rule("ellipsis_line_ratio", high=0.5),
    Rule("bullet_line_ratio", high=0.9),
)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / whole)


def _chars(text: Column, pattern: str) -> Column:
    """How many characters of a text match a class."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def _stop_forms() -> list[str]:
    """Stop words as they stand in running text: small, or with a capital."""
    return list(dict.fromkeys([*STOP_WORDS, *(x.capitalize() for x in STOP_WORDS)]))


def _pairs(hashes: Column, gap: int) -> Column:
    """A hash of each element with the one `gap` places on."""
    n = F.size(hashes) - gap
    return F.when(
        n > 0,
        F.zip_with(
            F.slice(hashes, 1, n), F.slice(hashes, gap + 1, n), lambda a, b: F.xxhash64(a, b)
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _repeat_words() -> Column:
    """Words inside windows that the text holds twice or more, from the columns of `measured`.

    Equal hashes only raise the suspicion: suspected texts compare the windows' words.
    """
    at = F.col("_repeats")
    steps = F.transform(
        F.sequence(F.lit(1), F.size(at) - 1),
        lambda k: F.least(F.lit(WINDOW), F.get(at, k) - F.get(at, k - 1)),
    )
    more = F.when(
        F.size(at) > 1, F.aggregate(steps, F.lit(0), lambda total, step: total + step)
    ).otherwise(F.lit(0))
    return F.when(F.size(at) > 0, F.lit(WINDOW) + more).otherwise(F.lit(0)).cast("long")


def measured(docs: DataFrame, carried: Column, text_col: str = "text") -> DataFrame:
    """One row per document: `carried` as _id, and every count that the rules use."""
    text = F.col("_text")
    rows = docs.select(
        carried.alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")
    ).select("_id", "_text", words(text).alias("_words"))

    w = F.col("_words")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    stop = F.filter(w, lambda x: x.isin(*_stop_forms()))
    rows = rows.select(
        "_id",
        "_words",
        F.size(w).cast("long").alias("n_words"),
        F.length(F.replace(plain_spaces(text), F.lit(" "), F.lit("")))
        .cast("long").alias("word_chars"),
        _chars(text, r"[#*$%&|<>]+").alias("n_symbols"),
        F.size(stop).cast("long").alias("n_stop_words"),
        lines.alias("_lines"),
        F.transform(w, lambda x: F.xxhash64(x)).alias("_h1"),
    )
    h1 = F.col("_h1")
    echo = F.filter(h1, lambda x, i: F.coalesce(x == F.get(h1, i - 1), F.lit(False)))
    rows = rows.withColumn("n_echo_words", F.size(echo).cast("long"))
    # Hashes of two, four and eight words in a row, each from two of half the length.
    for half in (1, 2, 4):
        rows = rows.withColumn(f"_h{2 * half}", _pairs(F.col(f"_h{half}"), half)).drop(f"_h{half}")

    line = F.col("_lines")
    rows = rows.select(
        "_id", "_words", "n_words", "word_chars", "n_symbols", "n_stop_words", "n_echo_words",
        F.size(line).cast("long").alias("n_lines"),
        (F.size(line) - F.size(F.array_distinct(line))).cast("long").alias("n_dup_lines"),
        F.size(F.filter(line, lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$")))
        .cast("long").alias("n_ellipsis_lines"),
        F.size(F.filter(line, lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•·▪◦‣]")))
        .cast("long").alias("n_bullet_lines"),
        (F.size(F.array_distinct("_h8")) < F.size("_h8")).alias("_suspect"),
    )

    # Sorted windows put equal ones side by side; only suspected texts build them.
    windows = F.when(
        F.col("_suspect"),
        F.sort_array(
            F.transform(
                F.sequence(F.lit(0), F.size(w) - WINDOW),
                lambda i: F.struct(
                    F.array_join(F.slice(w, i + 1, WINDOW), " ").alias("said"), i.alias("at")
                ),
            )
        ),
    ).otherwise(F.array().cast("array<struct<said:string,at:int>>"))
    rows = rows.withColumn("_windows", windows).drop("_words", "_suspect")
    sorted_windows = F.col("_windows")
    twice = F.filter(
        sorted_windows,
        lambda x, i: F.coalesce(x["said"] == F.get(sorted_windows, i - 1)["said"], F.lit(False))
        | F.coalesce(x["said"] == F.get(sorted_windows, i + 1)["said"], F.lit(False)),
    )
    rows = rows.withColumn("_repeats", F.sort_array(F.transform(twice, lambda x: x["at"]))).drop(
        "_windows"
    )
    counts = [c for c in rows.columns if c.startswith("n_") or c == "word_chars"]
    return rows.select("_id", *counts, _repeat_words().alias("n_repeat_words"))


def _measures() -> dict[str, Column]:
    n, lines = F.col("n_words"), F.col("n_lines")
    return {
        "mean_word_chars": _ratio(F.col("word_chars"), n),
        "symbol_ratio": _ratio(F.col("n_symbols"), n),
        "stop_word_ratio": _ratio(F.col("n_stop_words"), n),
        "echo_ratio": _ratio(F.col("n_echo_words"), n),
        "dup_line_ratio": _ratio(F.col("n_dup_lines"), lines),
        "ellipsis_line_ratio": _ratio(F.col("n_ellipsis_lines"), lines),
        "bullet_line_ratio": _ratio(F.col("n_bullet_lines"), lines),
    }


def quality_rules(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: counts, base_failed, kept, and the first rule broken.

    Null and empty texts have no words and fail the base rule. Repeated rows are judged
    each on its own; a null id is passed through; other columns of `docs` are ignored,
    so their names cannot clash. An empty table gives an empty result. A rule on a
    measure with nothing to divide by sees 0.
    """
    rows = measured(docs, F.col(id_col), text_col).withColumnRenamed("_id", id_col)
    return _judged(rows, rules)


def kept_documents(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text"
) -> DataFrame:
    """The rows of `docs` that the rules keep, with all their columns, each judged alone."""
    whole_row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = _judged(measured(docs, whole_row, text_col), rules)
    return rows.filter("kept").select("_id.*")


def _judged(rows: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Add base_failed, kept and broken_rule to measured rows."""
    measures = _measures()
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    broken = F.when(base_failed, F.lit("base"))
    for rule in rules:
        value = measures[rule.measure]
        if rule.low is not None:
            broken = broken.when(value < rule.low, F.lit(f"{rule.measure} < {rule.low}"))
        if rule.high is not None:
            broken = broken.when(value > rule.high, F.lit(f"{rule.measure} > {rule.high}"))
    # A filter on `kept` would be pushed below the projections, and each step's expression
    # copied into it as often as the next one uses it. A row number in the verdict, which
    # is never negative, holds such filters where they stand.
    kept = broken.isNull() & (F.monotonically_increasing_id() >= 0)
    return rows.withColumns({"base_failed": base_failed, "kept": kept, "broken_rule": broken})
