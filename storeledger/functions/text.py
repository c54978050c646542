"""Text rules: null tokens, blanks, Python list notation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from storeledger.contract import NA_TOKENS, PYTHON_WHITESPACE


_NA_LIST = ", ".join(f"'{token}'" for token in NA_TOKENS)


def na_to_null(name: str) -> Column:
    """The named text column, null where its text stands for a missing value."""
    return F.expr(f"IF(`{name}` IN ({_NA_LIST}), NULL, `{name}`)").alias(name)


def is_blank(text: Column) -> Column:
    """Null, or nothing left after stripping Unicode white space.

    Stripping from the left is enough and stops at the first other character. A text that
    begins with a visible ASCII character is told by comparing, far cheaper than stripping.
    """
    visible = (text >= "!") & (text < "\x7f")
    return text.isNull() | (~visible & (F.ltrim(text, F.lit(PYTHON_WHITESPACE)) == ""))


def python_repr(text: Column) -> Column:
    """A string in Python notation: single quotes, or double if it holds only single ones."""
    escaped = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for raw, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        escaped = F.replace(escaped, F.lit(raw), F.lit(shown))
    single_only = text.contains("'") & ~text.contains('"')
    return F.when(single_only, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
    )


def python_list(texts: Column) -> Column:
    """An array of strings in Python list notation."""
    return F.concat(F.lit("["), F.array_join(F.transform(texts, python_repr), ", "), F.lit("]"))
