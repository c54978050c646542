"""Store and file date from the name of an upload.

An upload is a file `store_<digits>_<YYYYMMDD>.csv`, or, when a large upload was
written in parallel, a folder of that name (plain, or `<column>=` in front) that
holds `part-*` files, each with its own header.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.contract import FILE_NAME_PATTERN
from storeledger.functions import python_repr


def source_key(file_path: Column) -> Column:
    """The upload a physical file belongs to: its own path, or its folder's."""
    mark = ".csv/part-"
    folder = F.regexp_replace(file_path, r"\.csv/part-[^/]*$", ".csv")
    # Scans ask for every row, so the usual path, with one such mark, is cut without a pattern.
    before, behind = F.substring_index(file_path, mark, 1), F.substring_index(file_path, mark, -1)
    usual = (F.concat(before, F.lit(mark), behind) == file_path) & ~behind.contains("/")
    folder = F.when(usual, F.concat(before, F.lit(".csv"))).otherwise(folder)
    return F.when(file_path.contains(mark), folder).otherwise(file_path)


def decoded(file_path: Column) -> Column:
    """A path of `_metadata.file_path`, which is percent-encoded, as it was written."""
    # A plus sign in such a path is a plus sign. A path without a percent sign is as written.
    written = F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))
    return F.when(file_path.contains("%"), written).otherwise(file_path)


def object_key(path: Column) -> Column:
    """The path without scheme and bucket."""
    return F.regexp_replace(path, r"^[A-Za-z0-9+.-]+:(?://[^/]*)?/+", "")


def upload_name(key: Column) -> Column:
    """Last path segment, without a partition-column prefix."""
    segment = F.substring_index(key, "/", -1)
    bare = F.regexp_replace(segment, r"^[A-Za-z_]+=", "")
    return F.when(segment.contains("="), bare).otherwise(segment)


def store_of(key: Column) -> Column:
    """The store digits, zeros kept; null if the name does not fit."""
    return _named_part(key, "$1")


def file_date_of(key: Column) -> Column:
    """YYYY-MM-DD of the file name; null if the name does not fit."""
    return _named_part(key, "$2-$3-$4")


def _named_part(key: Column, groups: str) -> Column:
    name = upload_name(key)
    return F.when(name.rlike(FILE_NAME_PATTERN), F.regexp_replace(name, FILE_NAME_PATTERN, groups))


def with_partition(rows: DataFrame) -> DataFrame:
    """Add store and date to rows of accepted uploads, whose names are known to fit.

    Cuts the name by position, which per row is far cheaper than matching it.
    """
    name = upload_name(F.col("source_key"))
    day = F.substring(name, -12, 8)
    date = F.concat_ws("-", F.substring(day, 1, 4), F.substring(day, 5, 2), F.substring(day, 7, 2))
    store = F.substring_index(F.substring_index(name, "_", 2), "_", -1)
    return rows.withColumn("store", store).withColumn("date", date)


def name_error(key: Column) -> Column:
    """Why the name is refused; null if it fits."""
    message = F.concat(
        F.lit("Filename does not match store_{id}_{YYYYMMDD}.csv: "), python_repr(upload_name(key))
    )
    return F.when(store_of(key).isNull(), message)
