"""Row rules and the good/bad split.

A file is the unit of duplicate detection, and any row text may be repeated any
number of times. So equal rows of a file are folded into one row with a count
before the shuffle; the first copy is judged by the row rules, every further copy
is a duplicate. No window, and no group of copies ever meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.contract import (
    DUPLICATE_ROW,
    ERROR_CODES,
    INPUT_COLUMNS,
    PAYMENT_STATUSES,
    REQUIRED_TEXT_COLUMNS,
)
from storeledger.functions import is_blank, iso_day, na_to_null, to_number

NUMERIC_COLUMNS = ("quantity", "unit_price")

# Copies written out by one task when a row is repeated more often than this.
COPIES_PER_TASK = 1_000_000


def row_rules() -> list[tuple[str, Column]]:
    """(code, condition) pairs in report order, over typed columns."""
    rules = [(f"missing_{c}", is_blank(F.col(c))) for c in REQUIRED_TEXT_COLUMNS]
    for c in NUMERIC_COLUMNS:
        rules.append((f"missing_{c}", F.col(c).isNull()))
        rules.append((f"non_positive_{c}", F.col(c) <= 0))
    known = F.coalesce(F.lower("payment_status").isin(*PAYMENT_STATUSES), F.lit(False))
    rules.append(("invalid_payment_status", ~known))
    return rules


def typed(raw: DataFrame) -> DataFrame:
    """Null tokens to null, numbers coerced.

    The text of a field that is not a number is kept aside (`<name>_junk`), since
    two rows that differ only there are not copies of each other.
    """
    keep = [c for c in raw.columns if c not in INPUT_COLUMNS]
    texts = raw.select(*keep, *[na_to_null(c) for c in INPUT_COLUMNS])
    numbers = texts.select(
        "*", *[to_number(F.col(c)).alias(f"{c}_number") for c in NUMERIC_COLUMNS]
    )
    return numbers.select(
        *keep,
        *[F.col(f"{c}_number" if c in NUMERIC_COLUMNS else c).alias(c) for c in INPUT_COLUMNS],
        *[
            F.when(F.col(f"{c}_number").isNull(), F.col(c)).alias(f"{c}_junk")
            for c in NUMERIC_COLUMNS
        ],
    )


def error_mask() -> Column:
    """The rules a typed row breaks, one bit per code."""
    mask = F.lit(0)
    for code, broken in row_rules():
        mask = mask + F.when(broken, F.lit(_bit(code))).otherwise(F.lit(0))
    return mask


def error_text(mask: Column) -> Column:
    """The codes of a mask joined by ';', in report order."""
    return F.concat_ws(
        ";", *[F.when(mask.bitwiseAND(_bit(code)) != 0, F.lit(code)) for code in ERROR_CODES]
    )


def _bit(code: str) -> int:
    return 1 << ERROR_CODES.index(code)


def validate(
    raw: DataFrame, carry_max: tuple[str, ...] = (), staged: bool = False
) -> DataFrame:
    """One row per distinct row of a file.

    Input: `source_key` and the seven text columns. Output: `source_key`, the
    typed columns, `copies`, and `error_mask`: the rules the first copy breaks.
    The mask follows from the row but is folded as an aggregate: a filter on it
    then runs on the folded rows instead of re-evaluating every rule on raw ones.
    Where the result is staged as it is, no filter can move, so the mask is judged on
    folded rows: it is not shuffled, and the generated code of a scan of uploads stays
    short enough for the JVM to compile. Columns named in `carry_max` are folded by max.
    """
    junk = [f"{c}_junk" for c in NUMERIC_COLUMNS]
    carried = [F.max(c).alias(c) for c in carry_max]
    copies = F.count(F.lit(1)).alias("copies")
    rows = typed(raw)
    keys = ["source_key", *INPUT_COLUMNS, *junk]
    if staged:
        folded = rows.groupBy(*keys).agg(copies, *carried)
        mask = error_mask().alias("error_mask")
        return folded.select("source_key", *INPUT_COLUMNS, "copies", mask, *carry_max)
    mask = F.max("error_mask").alias("error_mask")
    judged = rows.withColumn("error_mask", error_mask())
    return judged.groupBy(*keys).agg(copies, mask, *carried).drop(*junk)


def is_good() -> Column:
    return F.col("error_mask") == 0


def good_rows(validated: DataFrame) -> DataFrame:
    """First copies that break no rule, as judged (order_date still as written)."""
    return validated.filter(is_good()).drop("error_mask", "copies")


def stored_good_rows(validated: DataFrame) -> DataFrame:
    """The storage form: seven columns, order_date as an ISO day."""
    day = iso_day(F.col("order_date"))
    return good_rows(validated).select(
        "source_key", *[(day if c == "order_date" else F.col(c)).alias(c) for c in INPUT_COLUMNS]
    )


def bad_rows(validated: DataFrame) -> DataFrame:
    """Every bad row, copies written out, with `validation_errors`."""
    first_bad = F.when(is_good(), F.lit(2)).otherwise(F.lit(1))
    return _with_errors(write_out_copies(validated, first_bad))


def validated_rows(validated: DataFrame) -> DataFrame:
    """Every row of every file with its `validation_errors` (empty for good rows)."""
    return _with_errors(write_out_copies(validated, F.lit(1)))


def _with_errors(copied: DataFrame) -> DataFrame:
    duplicate = F.when(F.col("copy") > 1, F.lit(_bit(DUPLICATE_ROW))).otherwise(F.lit(0))
    text = error_text(F.col("error_mask").bitwiseOR(duplicate))
    return copied.select("source_key", *INPUT_COLUMNS, text.alias("validation_errors"))


def write_out_copies(validated: DataFrame, first: Column) -> DataFrame:
    """One row per copy from number `first` on, numbered in `copy`.

    A row repeated beyond COPIES_PER_TASK is first cut into ranges of copies and
    the ranges are spread over the cluster, so that no task writes a hot group alone.
    """
    limit = F.lit(COPIES_PER_TASK)
    ranged = (
        validated.withColumn("_from", first.cast("bigint"))
        .filter(F.col("_from") <= F.col("copies"))
        .withColumn("_to", F.col("copies"))
    )
    few = ranged.filter(F.col("copies") <= limit)
    starts = F.sequence(F.col("_from"), F.col("_to"), limit.cast("bigint"))
    many = (
        ranged.filter(F.col("copies") > limit)
        .withColumn("_from", F.explode(starts))
        .withColumn("_to", F.least(F.col("_from") + limit - 1, F.col("_to")))
        .repartition("source_key", *INPUT_COLUMNS, "_from")
    )
    return few.unionByName(many).withColumn(
        "copy", F.explode(F.sequence(F.col("_from"), F.col("_to")))
    )


def error_profile(validated: DataFrame) -> DataFrame:
    """Rows per file and code. Counts copies without writing them out."""
    mask, further = F.col("error_mask"), F.col("copies") - 1
    # A row's own codes hold for each of its copies; the duplicate code for all but one.
    counts = F.array(
        *[
            F.struct(
                F.lit(code).alias("code"),
                (
                    further
                    if code == DUPLICATE_ROW
                    else F.when(mask.bitwiseAND(_bit(code)) != 0, F.col("copies")).otherwise(0)
                ).alias("n"),
            )
            for code in ERROR_CODES
        ]
    )
    return (
        validated.filter(~is_good() | (F.col("copies") > 1))
        .select("source_key", F.inline(counts))
        .filter("n > 0")
        .groupBy("source_key", "code")
        .agg(F.sum("n").alias("rows"))
    )
