"""Number rules: coercion, order-free sums, Python rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_INF = float("inf")

EXACT_PRODUCT = "_exact_product"
PLAIN_PRODUCT = "_plain_product"

# The number forms accepted. A cast alone would also take '1d' or hex.
# The first form cannot overflow a double; the second can.
_PLAIN_NUMBER = r"^\s*[+-]?(?:[0-9]{1,300}(?:\.[0-9]*)?|\.[0-9]+)\s*$"
_LARGE_NUMBER = r"^\s*[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$"
_INFINITY = r"^\s*[+-]?(?i:inf|infinity)\s*$"


def to_number(text: Column) -> Column:
    """Text to double; null for anything that is not a number.

    A literal too large for a double is not a number; a written infinity is.
    """
    value = text.try_cast("double")
    return (
        F.when(text.rlike(_PLAIN_NUMBER), value)
        .when(text.rlike(_LARGE_NUMBER) & (F.abs(value) < _INF), value)
        .when(text.rlike(_INFINITY), value)
    )


def with_products(rows: DataFrame, left: str, right: str) -> DataFrame:
    """Add left * right twice: as a double, and exactly as decimal.

    Both factors are taken as the decimals they were written as (six places). The
    decimal is null where a factor is infinite or has more places.
    """
    exact, plain = EXACT_PRODUCT, PLAIN_PRODUCT
    # One step per projection: the casts are costly and each result is used twice.
    cast = rows.select(
        "*",
        F.col(left).try_cast("decimal(18,6)").alias("_left"),
        F.col(right).try_cast("decimal(18,6)").alias("_right"),
    )
    as_written = (F.col("_left").cast("double") == F.col(left)) & (
        F.col("_right").cast("double") == F.col(right)
    )
    return cast.select(
        *rows.columns,
        F.when(as_written, F.col("_left") * F.col("_right")).alias(exact),
        (F.col(left) * F.col(right)).alias(plain),
    )


def product_sum() -> Column:
    """Sum over `with_products` that does not depend on the order of addition.

    The exact total of the products that have an exact form, so that retries,
    repartitioning and partial aggregation give the same result, plus the sum of
    doubles of those that have none. A total beyond 26 digits is a sum of doubles.
    """
    exact = F.try_sum(EXACT_PRODUCT)
    others = F.sum(F.when(F.col(EXACT_PRODUCT).isNull(), F.col(PLAIN_PRODUCT)))
    overflow = exact.isNull() & (F.count(EXACT_PRODUCT) > 0)
    apart = F.coalesce(exact.cast("double") + others, exact.cast("double"), others)
    return F.when(overflow, F.sum(PLAIN_PRODUCT)).otherwise(apart)


def python_round(value: Column, digits: int) -> Column:
    """Round a double as Python's round(): half to even, on the stored binary value.

    `bround` works on the shortest decimal text of the double, which misleads only
    near a tie. There the sign of (value * 10^digits - tie) decides; splitting the
    value into two short halves keeps both products exact.
    """
    scale = 10**digits
    near = F.bround(value, digits)
    tie = F.floor(value * scale) + F.lit(0.5)
    near_tie = (F.abs(value * scale - tie) < 1e-6) & (F.abs(value) < 2.0**26)
    # Upper 26 bits and the remainder (Veltkamp split); each times `scale` is exact.
    spread = value * F.lit(134217729.0)
    upper = spread - (spread - value)
    lower = value - upper
    above = (upper * scale - tie) + lower * scale
    floor = F.floor(value * scale)
    return (
        F.when(near_tie & (above > 0), (floor + 1) / F.lit(float(scale)))
        .when(near_tie & (above < 0), floor / F.lit(float(scale)))
        .otherwise(near)
    )
