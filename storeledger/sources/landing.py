"""The landing zone: store CSVs, read in two scans.

The first scan reads lines and folds them to one row per physical file: is the
text decodable, do quoted fields span lines, is the header the usual one. Only
numbers and flags are folded, so it is a hash aggregate without a sort. Header
texts are fetched for unusual files alone.

The second scan parses rows by position and maps them to column names. Files
with the usual header need no lookup; the others are joined in.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storeledger.contract import INPUT_COLUMNS
from storeledger.functions import python_list
from storeledger.plans.staging import stage, stage_files
from storeledger.operators.verdicts import NO_COLUMNS
from storeledger.sources.names import decoded, object_key, source_key

USUAL_HEADER = ",".join(INPUT_COLUMNS)
WIDTH = len(INPUT_COLUMNS)
POSITIONS = [f"p{i}" for i in range(WIDTH)]
_ROW_SCHEMA = ", ".join(f"{p} STRING" for p in [*POSITIONS, "_corrupt"])
_CSV_OPTIONS = {"quote": '"', "escape": '"', "columnNameOfCorruptRecord": "_corrupt"}


@dataclass
class Landing:
    """Where files land and which of them belong to this run.

    `arrived_by` fixes the set of files: both scans skip later arrivals.
    """

    paths: str | list[str]
    arrived_by: dt.datetime

    def _options(self, reader):
        names = "{*.csv,part-*}"
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", names)
        # A file that is removed while it is read has no rows; its upload is refused then.
        return reader.option("ignoreMissingFiles", True)

    def _known(self, rows: DataFrame) -> DataFrame:
        """CSVs, and parts of whatever name in a folder that is one upload."""
        path = F.col("_metadata.file_path")
        return rows.filter(
            (F.col("_metadata.file_modification_time") <= F.lit(self.arrived_by))
            & (path.endswith(".csv") | path.contains(".csv/part-"))
        )

    def lines(self, spark: SparkSession, end: str | None = None) -> DataFrame:
        reader = self._options(spark.read)
        return self._known((reader.option("lineSep", end) if end else reader).text(self.paths))

    def present(self, spark: SparkSession) -> DataFrame:
        """(file_path, modified_at, length) of the files there are now; none is opened."""
        files = self._known(self._options(spark.read.format("binaryFile")).load(self.paths))
        return files.select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_modification_time").alias("modified_at"),
            "length",
        )

    def of_upload(self) -> Column:
        """The upload that a listed file belongs to."""
        return object_key(source_key(decoded(F.col("file_path")))).alias("source_key")

    def rows(self, spark: SparkSession) -> DataFrame:
        """Fields by position; `_corrupt` holds the text of rows of another width."""
        reader = self._options(spark.read).schema(_ROW_SCHEMA).option("header", True)
        for option, value in _CSV_OPTIONS.items():
            reader = reader.option(option, value)
        rows = self._known(reader.option("columnPruning", False).csv(self.paths))
        return rows.select(*POSITIONS, "_corrupt", F.col("_metadata.file_path").alias("file_path"))


# --- First scan: one row per physical file --------------------------------------------


def _has_text(line: Column) -> Column:
    return F.ltrim(line, F.lit(" \t")) != ""


def _odd_quotes(line: Column) -> Column:
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    return F.when(line.contains('"'), quotes % 2 == 1).otherwise(F.lit(False))


def scan_files(spark: SparkSession, landing: Landing) -> DataFrame:
    """Per file: modification time, decodable or not, open quotes, usual header or not."""
    value, at_start = F.col("value"), F.col("block_start") == 0
    lines = landing.lines(spark).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
        F.col("_metadata.file_block_start").alias("block_start"),
        "value",
        F.monotonically_increasing_id().alias("line_id"),
    )
    first_line = F.min(F.when(at_start & _has_text(value), F.col("line_id")))
    first_usual = F.min(F.when(at_start & (value == USUAL_HEADER), F.col("line_id")))
    return lines.groupBy("file_path").agg(
        F.max("modified_at").alias("modified_at"),
        F.bool_or(~F.is_valid_utf8(value)).alias("undecodable"),
        F.bool_or(_odd_quotes(value)).alias("open_quotes"),
        F.coalesce(first_line == first_usual, F.lit(False)).alias("usual_header"),
    )


def _header_texts(spark: SparkSession, landing: Landing, unusual: DataFrame) -> DataFrame:
    """First line with text, for the files named in `unusual`."""
    lines = landing.lines(spark).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        "value",
    )

    def first_lines(part: DataFrame) -> DataFrame:
        return (
            part.filter((F.col("block_start") == 0) & _has_text(F.col("value")))
            .withColumn("line_id", F.monotonically_increasing_id())
            .groupBy("file_path")
            .agg(F.min_by("value", "line_id").alias("header"))
        )

    return stage_files(lines, unusual, "headers", first_lines)


# --- Header rules ----------------------------------------------------------------------


def header_names(header: Column) -> Column:
    """Column names of a header line: quotes removed, blanks named as pandas does."""
    fields = F.regexp_extract_all(
        F.concat(F.lit(","), header), F.lit(r',("[^"]*+(?:""[^"]*+)*+"|[^,]*)'), 1
    )

    def unquoted(field: Column) -> Column:
        inner = F.replace(F.substring(field, F.lit(2), F.length(field) - 2), F.lit('""'), F.lit('"'))
        return F.when(field.startswith('"') & field.endswith('"') & (F.length(field) > 1), inner).otherwise(field)

    plain = F.transform(fields, unquoted)
    named = F.transform(
        plain, lambda name, i: F.when(name == "", F.concat(F.lit("Unnamed: "), i)).otherwise(name)
    )

    return named


def numbered_names(headers: DataFrame) -> DataFrame:
    """(file_path, names): repeats of a name get .1, .2 and so on, as pandas names them.

    Fields are ranked as rows, so a header of very many fields takes no longer per field.
    """
    repeat = F.row_number().over(Window.partitionBy("file_path", "name").orderBy("at")) - 1
    label = F.when(repeat == 0, F.col("name")).otherwise(F.concat("name", F.lit("."), repeat))
    fields = headers.select("file_path", F.posexplode("names").alias("at", "name"))
    labels = fields.select("file_path", F.struct("at", label.alias("label")).alias("field"))
    return labels.groupBy("file_path").agg(
        F.transform(F.sort_array(F.collect_list("field")), lambda f: f["label"]).alias("names")
    )


def header_error(names: Column) -> Column:
    """The schema message for a header; null if it holds exactly the contract's columns."""
    required = F.array(*[F.lit(c) for c in INPUT_COLUMNS])
    missing = F.array_sort(F.array_except(required, names))
    extra = F.array_sort(F.array_except(names, required))
    messages = F.array_compact(
        F.array(
            F.when(F.size(missing) > 0, F.concat(F.lit("Missing columns: "), python_list(missing))),
            F.when(
                F.size(extra) > 0,
                F.concat(F.lit("Extra columns not allowed: "), python_list(extra)),
            ),
        )
    )
    return F.when(
        F.size(messages) > 0,
        F.concat(F.lit("Schema validation failed: "), python_list(messages)),
    )


def file_verdicts(spark: SparkSession, landing: Landing) -> DataFrame:
    """One staged row per physical file, with header verdict and column positions.

    `positions` gives, per contract column, its 1-based place; null for the usual
    header. `width` is the number of header fields.
    """
    scanned = stage(scan_files(spark, landing), "files")
    unusual = scanned.filter(~F.col("usual_header")).select("file_path")
    headers = numbered_names(
        _header_texts(spark, landing, unusual).select(
            "file_path", header_names(F.col("header")).alias("names")
        )
    )
    names = F.col("names")
    positions = F.array(*[F.array_position(names, c).cast("int") for c in INPUT_COLUMNS])
    no_header = ~F.col("usual_header") & names.isNull()
    verdicts = scanned.join(headers, "file_path", "left").select(
        "file_path",
        object_key(source_key(decoded(F.col("file_path")))).alias("source_key"),
        "modified_at",
        "undecodable",
        "open_quotes",
        F.when(no_header, F.lit(NO_COLUMNS)).otherwise(header_error(names)).alias("header_error"),
        F.when(names.isNotNull(), positions).alias("positions"),
        F.when(names.isNotNull(), F.size(names)).otherwise(F.lit(WIDTH)).alias("width"),
    )
    return stage(verdicts, "file-verdicts")


def changed_uploads(spark: SparkSession, landing: Landing, listed: DataFrame) -> DataFrame:
    """source_key of uploads whose files are not those that `listed` says.

    `listed` was taken before the first scan; this is called when the rows are staged. A
    file that has the same time and length at both ends was so for both scans. A file
    that came or went between makes its upload another one, too. Lengths tell a rewrite
    inside one tick of the store's clock, unless it has the same length.
    """
    columns = ["file_path", "modified_at", "length"]
    before = listed.select(*columns, F.lit(1).alias("before"), F.lit(0).alias("after"))
    now = landing.present(spark).select(*columns, F.lit(0).alias("before"), F.lit(1).alias("after"))
    both = before.unionByName(now).groupBy(*columns).agg(
        F.sum("before").alias("before"), F.sum("after").alias("after")
    )
    return both.filter(F.col("before") != F.col("after")).select(landing.of_upload()).distinct()


# --- Second scan: rows -------------------------------------------------------------------


def _field_count(text: Column) -> Column:
    """Fields of a raw CSV row: commas outside quoted fields, plus one."""
    plain = F.regexp_replace(F.concat(F.lit(","), text), r',"[^"]*+(?:""[^"]*+)*+"', ",")
    return F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit("")))


def raw_rows(spark: SparkSession, landing: Landing, verdicts: DataFrame) -> DataFrame:
    """`source_key`, the seven text columns, and `overlong` (1 for a row wider than its header).

    Rows of a file refused by its header or encoding are blanked, so that they fold
    to one row before any shuffle; they are kept only to find overlong rows.
    """
    refused = F.col("header_error").isNotNull() | F.col("undecodable")
    special = verdicts.filter(
        refused | F.col("open_quotes") | F.col("positions").isNotNull()
    ).select(
        "file_path", "open_quotes", "positions", "width", refused.alias("refused")
    )
    spanning = special.filter("open_quotes")
    by_line = _mapped(landing.rows(spark), special, spanning=False)
    spanned = _mapped(spanning_rows(spark, landing, spanning), special, spanning=True)
    return by_line.unionByName(spanned)


# --- Rows whose quoted fields span lines ----------------------------------------------------

_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'


def _ends_open(line: Column) -> Column:
    """Whether a line that begins outside quotes ends inside: a field is opened and not closed."""
    plain = F.regexp_replace(F.concat(F.lit(","), line), rf",{_QUOTED}[^,]*+", ",")
    return plain.contains(',"')


def _stays_open(line: Column) -> Column:
    """Whether a line that begins inside quotes ends inside, too."""
    closed = r'^[^"]*+(?:""[^"]*+)*+"[^,]*+'
    rest = F.regexp_replace(line, closed, "")
    reopened = F.regexp_replace(rest, rf",{_QUOTED}[^,]*+", ",").contains(',"')
    return F.when(line.rlike(closed), reopened).otherwise(F.lit(True))


def spanning_rows(spark: SparkSession, landing: Landing, files: DataFrame) -> DataFrame:
    """Rows of files whose quoted fields may span lines, each file parsed by many tasks.

    Such a file can't be cut at any line end. But a line only keeps, sets, clears or turns
    round whether a quote is open; so what each block of lines does is known without what
    stood before it, and running over the blocks of a file tells the state at each line.
    Lines between two states without an open quote are put together to a row.
    """
    value = F.col("value")
    quoted = value.contains('"')

    def marked(lines: DataFrame) -> DataFrame:
        return lines.select(
            "file_path",
            "block",
            F.monotonically_increasing_id().alias("line"),
            "value",
            F.when(quoted, _ends_open(value)).otherwise(F.lit(False)).alias("from_closed"),
            F.when(quoted, _stays_open(value)).otherwise(F.lit(True)).alias("from_open"),
        )

    # A line separator of its own keeps the other sign of a two-sign line end.
    lines = landing.lines(spark, end="\n").select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
    )
    lines = stage_files(lines, files, "spanning-lines", marked)
    fixed = F.col("from_closed") == F.col("from_open")
    turned = F.when(F.col("from_closed") & ~F.col("from_open"), 1).otherwise(0)
    lines = lines.withColumn("turned", turned).withColumn(
        "fixed", F.when(fixed, F.col("from_closed").cast("int"))
    )
    in_block = Window.partitionBy("file_path", "block").orderBy("line")
    to_here = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = F.sum("turned").over(to_here)
    lines = lines.withColumn("turns", turns)
    # The state behind a line, but for turns since a line that fixes it.
    base = F.last((F.col("fixed") + F.col("turns")) % 2, ignorenulls=True).over(to_here)
    lines = lines.withColumn("base", base)

    last = F.max_by(F.struct("base", "turns"), "line")
    blocks = lines.groupBy("file_path", "block").agg(last.alias("last"))
    earlier = (
        Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = blocks.select("file_path", "block", "last.base", "last.turns")
    blocks = blocks.withColumn(
        "before", F.coalesce(F.sum("turns").over(earlier), F.lit(0))
    ).withColumn("set", (F.col("base") + F.col("before")) % 2)
    entering = F.coalesce(F.last("set", ignorenulls=True).over(earlier), F.lit(0))
    blocks = blocks.select(
        "file_path", "block", ((entering + F.col("before")) % 2).alias("entering")
    )
    lines = lines.join(blocks, ["file_path", "block"])
    behind = (F.coalesce("base", "entering") + F.col("turns")) % 2 == 1
    lines = lines.withColumn("open_behind", behind)
    open_before = F.lag("open_behind").over(in_block)
    lines = lines.withColumn(
        "open_before", F.coalesce(open_before, F.col("entering") == 1)
    ).select("file_path", "block", "line", "value", "open_before", "open_behind")
    lines = stage(lines, "quoted-lines")

    # Lines of their own need no further look; the others are put to the row they begin.
    single = lines.filter(~F.col("open_before") & ~F.col("open_behind"))
    place = F.struct("block", "line")
    begun = F.when(~F.col("open_before"), place)
    parts = lines.filter(F.col("open_before") | F.col("open_behind"))
    parts = parts.withColumn("start", F.last(begun, ignorenulls=True).over(to_here))
    tails = parts.groupBy("file_path", "block").agg(F.max("start").alias("tail"))
    tails = tails.withColumn("carried", F.last("tail", ignorenulls=True).over(earlier))
    parts = parts.join(tails.select("file_path", "block", "carried"), ["file_path", "block"])
    texts = F.transform(
        F.sort_array(F.collect_list(F.struct("block", "line", "value"))), lambda p: p["value"]
    )
    joined = parts.groupBy("file_path", F.coalesce("start", "carried").alias("place")).agg(
        F.array_join(texts, "\n").alias("value")
    )
    rows = single.select("file_path", place.alias("place"), "value").unionByName(joined)
    rows = rows.withColumn("value", F.regexp_replace("value", r"\r\z", "")).filter(_has_text(value))
    rows = stage(rows, "spanning-rows")
    headers = rows.groupBy("file_path").agg(F.min("place").alias("header"))
    rows = rows.join(headers, "file_path").filter(F.col("place") != F.col("header"))
    fields = F.from_csv(value, _ROW_SCHEMA, {**_CSV_OPTIONS, "multiLine": "true"})
    return rows.select("file_path", fields.alias("row")).select(
        *[f"row.{p}" for p in POSITIONS], "row._corrupt", "file_path"
    )


def _mapped(rows: DataFrame, special: DataFrame, spanning: bool) -> DataFrame:
    by_place = F.array(*POSITIONS)
    joined = rows.join(special, "file_path", "left").filter(
        F.coalesce(F.col("open_quotes"), F.lit(False)) == F.lit(spanning)
    )
    columns = [
        F.when(F.col("refused"), F.lit(None))
        .when(F.col("positions").isNull(), F.col(place))
        .otherwise(F.element_at(by_place, F.col("positions")[i]))
        .alias(name)
        for i, (name, place) in enumerate(zip(INPUT_COLUMNS, POSITIONS))
    ]
    overlong = F.when(
        F.col("_corrupt").isNotNull()
        & (_field_count(F.col("_corrupt")) > F.coalesce(F.col("width"), F.lit(WIDTH))),
        F.lit(1),
    ).otherwise(F.lit(0))
    return joined.select(
        object_key(source_key(decoded(F.col("file_path")))).alias("source_key"),
        *columns,
        overlong.alias("overlong"),
    )
