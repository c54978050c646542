"""Word rules and staged tables that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.session import new_work_path

# A word is a longest run of characters other than space, tab, line feed, vertical
# tab, form feed and carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD_RUN = r"[^\x20\x09-\x0D]+"


def plain_spaces(text: Column) -> Column:
    """The text with every white-space character turned into a space; empty for null."""
    text = F.coalesce(text, F.lit(""))
    for space in SPACES[1:]:
        text = F.replace(text, F.lit(space), F.lit(" "))
    return text


def words(text: Column) -> Column:
    """The words of a text as an array; empty for null and for white space only."""
    # A one-character separator takes split()'s path without a regular expression.
    return F.array_remove(F.split(plain_spaces(text), " "), "")


def word_count(text: Column) -> Column:
    """How many words a text has, as a long; 0 for null."""
    return F.size(words(text)).cast("long")


def ascii_lower(text: Column) -> Column:
    """The text with A-Z, and no other letters, in lower case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    only_ascii = F.octet_length(text) == F.length(text)
    # lower() is much faster than translate() and says the same for ASCII texts.
    return F.when(only_ascii, F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared work folder and read it back.

    Cuts the lineage: executors lost later cost no recomputation of what led here.
    """
    spark = df.sparkSession
    path = new_work_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
