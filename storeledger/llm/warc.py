"""WARC archives of pages, and capture histories merged from locally sorted index runs.

Archives are written by Spark's text sink, one record per row; with the separator that
ends every record, the files are gzipped WARC files that Spark can write to any store and
commits or repeats as a whole. Reading yields one index run per archive, sorted within
the task; runs are written out, then merged range by range with a loser tree.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storeledger.llm.common import staged
from storeledger.session import new_work_path

MIN_REVISIT_BYTES = 1000
# Captures that one task merges; what it holds at once.
CAPTURES_PER_RANGE = 50_000
RECORD_END = "\r\n\r\n"

CAPTURE_SCHEMA = (
    "archive string, position long, page_id string, url string, url_key string, "
    "captured_at string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to string"
)


def _header_safe(value: Column) -> Column:
    """A header value: control characters percent-encoded, null as empty."""
    value = F.coalesce(value.cast("string"), F.lit(""))
    for char in ("\r", "\n", "\x0b", "\x0c", "\x00", "\x85", "\u2028", "\u2029"):
        coded = "".join(f"%{b:02X}" for b in char.encode())
        value = F.replace(value, F.lit(char), F.lit(coded))
    return value


def records(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    captured_at: Column | None = None,
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
) -> DataFrame:
    """One row `value` per page: the text of its WARC record, without its end.

    Of equal payloads of `min_revisit_bytes` or more, the page with the largest id holds
    the payload, the others are revisits that refer to it. Payloads are equal if length,
    SHA-1 and a second hash are. Pages with a null id are never referred to; a group of
    only such pages, and rows that repeat the keeper's id, are responses.
    """
    if captured_at is None:
        captured_at = F.lit("2024-01-01T00:00:00Z")
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        captured_at.alias("captured_at"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    )
    html = F.col("html")
    keyed = rows.withColumns(
        {"size": F.octet_length(html), "sha1": F.sha1(html), "second": F.xxhash64(html)}
    )
    key = ["size", "sha1", "second"]
    keepers = (
        keyed.filter(F.col("size") >= min_revisit_bytes)
        .groupBy(*key)
        .agg(F.max("id").alias("keeper"), F.count("*").alias("copies"))
        .filter(F.col("copies") > 1)
        .drop("copies")
    )
    # Written first, so that the join shuffles both sides and a hot payload can be split.
    keepers = staged(keepers, "payload-keepers")
    told = keyed.join(keepers, key, "left")
    is_revisit = F.coalesce(~F.col("id").eqNullSafe(F.col("keeper")), F.lit(False)) & F.col(
        "keeper"
    ).isNotNull()
    page = _header_safe(F.col("id"))
    kept = F.when(is_revisit, F.lit("")).otherwise(html)
    head = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(is_revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), page, F.lit(">")),
        F.concat(F.lit("WARC-Date: "), _header_safe(F.col("captured_at"))),
        F.concat(F.lit("WARC-Target-URI: "), _header_safe(F.col("url"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.concat(F.lit("X-Payload-Length: "), F.col("size").cast("string")),
        F.when(
            is_revisit,
            F.concat(
                F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/"
                      "identical-payload-digest\r\nWARC-Refers-To: <urn:page:"),
                _header_safe(F.col("keeper")), F.lit(">"),
            ),
        ),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(kept).cast("string")),
    )
    return told.select(F.concat(head, F.lit(RECORD_END), kept).alias("value"))


def write_archives(record_rows: DataFrame, path: str) -> None:
    """Write records as gzipped WARC files, one per task, each made whole or not at all."""
    record_rows.write.option("lineSep", RECORD_END).option("compression", "gzip").text(path)


def parse_archive(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(position, headers, payload) of each record, by Content-Length, not by separators."""
    data = zlib.decompressobj(wbits=47)
    plain = data.decompress(content) + data.flush()
    at = 0
    while at < len(plain):
        end = plain.index(b"\r\n\r\n", at)
        lines = plain[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        start = end + 4
        stop = start + int(headers["Content-Length"])
        yield at, headers, plain[start:stop]
        if plain[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} doesn't end where it says")
        at = stop + 4


def url_key(url: str) -> str:
    """The sort key of a URL: host labels reversed, then the rest, all in lower case."""
    rest = url.split("://", 1)[-1].lower()
    cut = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    return ",".join(reversed(rest[:cut].split("."))) + ")" + (rest[cut:] or "/")


def _capture_key(row: tuple) -> tuple:
    """(url_key, captured_at, page_id, archive, position) of a row of CAPTURE_SCHEMA."""
    return row[4], row[5], row[2], row[0], row[1]


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The captures in archives: one locally sorted run per archive, `seq` its order.

    Each payload is hashed again; an archive whose digest or length is wrong fails.
    """

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                run = []
                for at, head, payload in parse_archive(content):
                    kind = head["WARC-Type"]
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(head["X-Payload-Length"])
                    if kind == "response" and (
                        len(payload) != size or hashlib.sha1(payload).hexdigest() != digest
                    ):
                        raise ValueError(f"{name}: the payload at byte {at} was changed")
                    ids = [
                        head[h][len("<urn:page:") : -1] if h in head else None
                        for h in ("WARC-Record-ID", "WARC-Refers-To")
                    ]
                    url = head["WARC-Target-URI"]
                    run.append(
                        (name, at, ids[0], url, url_key(url), head["WARC-Date"], size, digest,
                         kind, ids[1])
                    )
                run.sort(key=_capture_key)
                out = pd.DataFrame(run, columns=[c.split()[0] for c in CAPTURE_SCHEMA.split(", ")])
                out["seq"] = np.arange(len(run))
                yield out

    archives = spark.read.format("binaryFile").load(path).select("path", "content")
    return archives.mapInPandas(index, CAPTURE_SCHEMA + ", seq long")


class LoserTree:
    """Merge sorted runs: each inner node remembers the loser of its match.

    After the winner leaves, only the matches on its run's path are played again.
    """

    def __init__(self, runs: Sequence[Sequence[tuple]], key) -> None:
        self.runs, self.key = runs, key
        self.next = [0] * len(runs)
        self.heads = [key(r[0]) if r else None for r in runs]
        self.size = max(1, len(runs))
        self.losers = [0] * self.size
        self.winner = self._play(1)

    def _beats(self, a: int, b: int) -> bool:
        """Whether run a's head comes first; an empty run loses, ties go to the lower run."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def _play(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        left, right = self._play(2 * node), self._play(2 * node + 1)
        first = self._beats(left, right)
        self.losers[node] = right if first else left
        return left if first else right

    def __iter__(self) -> Iterator[tuple]:
        while self.heads and self.heads[self.winner] is not None:
            run = self.winner
            yield self.runs[run][self.next[run]]
            self.next[run] += 1
            at = self.next[run]
            self.heads[run] = self.key(self.runs[run][at]) if at < len(self.runs[run]) else None
            node = (run + self.size) // 2
            while node >= 1:
                if self._beats(self.losers[node], run):
                    self.losers[node], run = run, self.losers[node]
                node //= 2
            self.winner = run


def merge_runs(runs: DataFrame, captures_per_range: int = CAPTURES_PER_RANGE) -> DataFrame:
    """Captures in global order by (range_no, place): each URL's history stands together.

    The runs are dealt over ranges of the whole sort key, which is unique, so one URL
    with a third of all captures is split too. A task holds the slices of all runs that
    fall into its range, each still sorted, and merges them.
    """
    runs = staged(runs, "index-runs")
    ranges = max(1, -(-runs.count() // captures_per_range))
    names = [c.split()[0] for c in CAPTURE_SCHEMA.split(", ")]

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        slices: dict[str, list[pd.DataFrame]] = {}
        for batch in batches:
            for archive, part in batch.groupby("archive", sort=False):
                slices.setdefault(archive, []).append(part)
        sorted_runs = [
            list(pd.concat(s).sort_values("seq")[names].itertuples(index=False, name=None))
            for _, s in sorted(slices.items())
        ]
        merged = list(LoserTree(sorted_runs, _capture_key)) if sorted_runs else []
        out = pd.DataFrame(merged, columns=names)
        out["range_no"] = TaskContext.get().partitionId()
        out["place"] = np.arange(len(merged))
        yield out

    dealt = runs.repartitionByRange(
        ranges, "url_key", "captured_at", "page_id", "archive", "position"
    )
    return dealt.mapInPandas(merge, CAPTURE_SCHEMA + ", range_no long, place long")


def archive_captures(
    pages: DataFrame, captured_at: Column | None = None, id_col: str = "page_id"
) -> DataFrame:
    """Write pages as WARC archives, read them back, and merge their index runs.

    One row per page: page_id, payload_bytes, payload_digest, record_type, refers_to,
    url, url_key, captured_at, archive, position, range_no, place. A null html is an
    empty payload; a null url has an empty target; a null id stays null. Repeated rows
    are records of their own. Other columns are ignored. An empty table gives an empty
    result.
    """
    spark = pages.sparkSession
    path = new_work_path(spark, "llm-warc")
    write_archives(records(pages, id_col, captured_at=captured_at), path)
    merged = merge_runs(read_runs(spark, path))
    kind = pages.schema[id_col].dataType
    return merged.select(
        F.when(F.col("page_id") != "", F.col("page_id")).cast(kind).alias(id_col),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
        "url",
        "url_key",
        "captured_at",
        "archive",
        "position",
        "range_no",
        "place",
    )
