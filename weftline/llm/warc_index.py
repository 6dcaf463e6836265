"""WARC archives and a capture index made by external merging.

Pages are written as WARC 1.1 records and read back.  A record ends with CR LF CR LF, which is
also what the text writer may put after each row, so Spark's own writer makes the archives and
commits them whatever task is lost.  Each archive read gives one run of captures sorted by URL
key and timestamp.  Runs are cut at common range bounds, and each range merges its slices with
a tree of losers; ranges follow each other, so the index is in one global order.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import words as W
from weftline.llm.groups import stage
from weftline.operators.lookup import lookup_join
from weftline.session import shared_dir

RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVE_BYTES = 32 << 20
RANGE_ROWS = 20_000
MAX_BOUND_SAMPLE = 50_000
ENTRY = ("urlkey string, ts string, page_id bigint, record_type string, payload_bytes bigint, payload_digest string, "
         "refers_to bigint, archive string, at bigint")
NAMES = [part.split()[0] for part in ENTRY.split(", ")]
KEY = ("urlkey", "ts", "page_id", "archive", "at")


def capture_time(page_id: Column) -> Column:
    """Repeatable capture time for tables that have none: one second per page id."""
    return F.date_format(F.timestamp_seconds(F.lit(1_704_067_200) + F.coalesce(page_id, F.lit(0)) % 31_536_000), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def plan_records(pages: DataFrame, min_bytes: int = 1000, ts: str | None = None) -> tuple[DataFrame, int]:
    """Pages with payload facts and record type, and how many fit one archive.

    Of equal payloads of at least ``min_bytes`` bytes, rows with the largest page id are
    responses and the others revisit it.  Rows tied at that id are all responses; a null id is
    below every other, and a group without any id is all responses.
    """
    payload = F.coalesce(W.column("html").cast("string"), F.lit(""))
    when = capture_time(F.col("page_id")) if ts is None else F.date_format(W.column(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    base = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        when.alias("ts"), payload.alias("payload"))
    base = base.withColumns({"payload_bytes": F.octet_length("payload").cast("bigint"), "payload_digest": F.sha1(F.col("payload").cast("binary"))})
    facts = stage(base.select("page_id", "payload_bytes", "payload_digest"), "payload-facts")
    size = facts.agg(F.avg("payload_bytes").alias("a")).first()["a"] or 0
    winners = facts.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes").agg(
        F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n")).filter("n > 1 and top is not null").drop("n")
    rows = lookup_join(base, stage(winners, "payload-winners"), ["payload_digest", "payload_bytes"], "left")
    revisit = F.col("top").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("top")))
    rows = rows.withColumns({"record_type": F.when(revisit, "revisit").otherwise("response"),
                             "refers_to": F.when(revisit, F.col("top"))}).drop("top")
    return rows, max(1, int(ARCHIVE_BYTES // (size + 1000)))


def record_id(page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws(":", page_id.cast("string"), digest))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value; line breaks in a value are percent-encoded."""
    safe = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"\r\n{name}: "), safe), F.lit(""))


def write_archives(rows: DataFrame, path: str, per_archive: int) -> None:
    """Write the records of :func:`plan_records` as gzipped WARC files of at most ``per_archive`` records."""
    is_revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(is_revisit, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.1"), _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", record_id(F.col("page_id"), F.col("payload_digest"))),
        _header("WARC-Date", F.col("ts")), _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _header("WARC-Profile", F.when(is_revisit, F.lit(REVISIT_PROFILE))),
        _header("WARC-Refers-To", F.when(is_revisit, record_id(F.col("refers_to"), F.col("payload_digest")))),
        _header("X-Refers-To-Page", F.col("refers_to")), _header("X-Page", F.col("page_id")),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length(block)), F.lit("\r\n\r\n"))
    rows.select(F.concat(head, block).alias("value")).write.option("lineSep", RECORD_END).option(
        "maxRecordsPerFile", per_archive).text(path, compression="gzip")


def url_key(url: str | None) -> str:
    """Sort-friendly key: host labels reversed, then path and query; empty for null."""
    if not url:
        return ""
    m = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]*)(:\d+)?([^#]*)", url, re.IGNORECASE)
    if not m:
        return url.lower()
    host = m[1].lower().removeprefix("www.").split(".")
    return ",".join(reversed(host)) + (m[2] or "") + ")" + (m[3] or "/")


def records(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers in lower case, block) of each record of a gzipped archive, one at a time."""
    with gzip.open(io.BytesIO(content)) as f:
        at = 0
        while line := f.readline():
            if not line.startswith(b"WARC/"):
                raise ValueError(f"no record at {at}")
            begin, at, headers = at, at + len(line), {}
            while (line := f.readline()) not in (b"\r\n", b""):
                name, _, value = line.decode().partition(":")
                headers[name.strip().lower()] = value.strip()
                at += len(line)
            block = f.read(int(headers["content-length"]))
            if f.read(4) != b"\r\n\r\n":
                raise ValueError(f"record at {begin} has a wrong length")
            at += 2 + len(block) + 4
            yield begin, headers, block


def _entry(archive: str, at: int, headers: dict[str, str], block: bytes) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if headers["warc-type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"{archive} at {at}: payload differs from its digest")
    number = lambda k: int(headers[k]) if k in headers else None
    return (url_key(headers.get("warc-target-uri")), headers["warc-date"], number("x-page"), headers["warc-type"],
            size, digest, number("x-refers-to-page"), archive, at)


def _sort_key(e: tuple) -> tuple:
    return (e[0], e[1], e[2] is not None, e[2] or 0, e[7], e[8])


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """One sorted run of captures per archive, in the order of the rows of each file."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    W.small_batches(files, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                entries = [_entry(name.rsplit("/", 1)[-1], at, h, b) for at, h, b in records(content.as_py())]
                entries.sort(key=_sort_key)
                if entries:
                    yield pa.RecordBatch.from_pandas(pd.DataFrame(entries, columns=NAMES).astype({"page_id": "Int64", "refers_to": "Int64"}), preserve_index=False)

    runs = stage(files.mapInArrow(run, ENTRY), "runs")
    W.small_batches(files)
    return runs


class LoserTree:
    """Merges k sorted iterators; each inner node keeps the loser of its match."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs, k = runs, max(1, len(runs))
        self.heads = [next(r, None) for r in runs] or [None]
        self.losers = [0] * k
        winners = [0] * k + list(range(k))
        for node in range(k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        self.best = winners[1] if k > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and x <= y)

    def __iter__(self) -> Iterator[tuple]:
        k = len(self.heads)
        while (head := self.heads[self.best]) is not None:
            yield head
            run = self.best
            self.heads[run] = next(self.runs[run], None)
            node = (run + k) // 2
            while node:
                other = self.losers[node]
                if self._before(other, run):
                    self.losers[node], run = run, other
                node //= 2
            self.best = run


def range_bounds(runs: DataFrame, rows: int = RANGE_ROWS) -> list[tuple]:
    """Keys that cut the index into ranges of about ``rows`` captures, from a bounded sample.

    The sample shapes the ranges only; every capture is indexed.  Keys are unique, so captures
    of one URL can lie in several ranges.
    """
    n = runs.count()
    ranges = min(-(-n // rows), MAX_BOUND_SAMPLE // 20)
    if ranges < 2:
        return []
    picked = runs.select(*KEY).orderBy(F.xxhash64("archive", "at")).limit(ranges * 20).collect()
    keys = sorted((r[0], r[1], r[2] is not None, r[2] or 0, r[3], r[4]) for r in picked)
    return keys[20::20]


def merge_runs(runs: DataFrame, bounds: list[tuple]) -> DataFrame:
    """The index: every capture with ``range`` and ``place``; (range, place) is the global order."""
    packed_type = f"range int, run string, entries array<struct<{ENTRY.replace(' ', ':').replace(',:', ',')}>>"
    field_names = NAMES

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from bisect import bisect_right

        for i, batch in enumerate(batches):
            rows = [tuple(r[c] for c in field_names) for r in batch.to_pylist()]
            begin = 0
            for j in range(1, len(rows) + 1):
                # a slice ends where the run or the range does; a batch border only makes one more run
                if j == len(rows) or rows[j][7] != rows[begin][7] or bisect_right(bounds, _sort_key(rows[j])) != bisect_right(bounds, _sort_key(rows[begin])):
                    piece = rows[begin:j]
                    yield pa.RecordBatch.from_pydict({
                        "range": pa.array([bisect_right(bounds, _sort_key(piece[0]))], pa.int32()), "run": [f"{piece[0][7]}:{i}:{begin}"],
                        "entries": pa.array([[dict(zip(field_names, e)) for e in piece]], entries_kind)})
                    begin = j

    kinds = {"string": pa.string(), "bigint": pa.int64()}
    entries_kind = pa.list_(pa.struct([(p.split()[0], kinds[p.split()[1]]) for p in ENTRY.split(", ")]))

    def merge(slices: pd.DataFrame) -> pd.DataFrame:
        def run(entries):
            for e in entries:
                e = tuple(e[c] for c in field_names)
                yield _sort_key(e), e

        slices = slices.sort_values("run")
        merged = [(int(slices["range"].iloc[0]), k, *e) for k, (_, e) in enumerate(LoserTree([run(x) for x in slices["entries"]]))]
        return pd.DataFrame(merged, columns=["range", "place", *field_names]).astype({"page_id": "Int64", "refers_to": "Int64"})

    W.small_batches(runs)
    return runs.mapInArrow(cut, packed_type).groupBy("range").applyInPandas(merge, f"range int, place bigint, {ENTRY}")


def capture_index(pages: DataFrame, min_bytes: int = 1000, ts: str | None = None, path: str | None = None) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as WARC archives, read them back and index every record.

    Rows ``(range, place, urlkey, ts, page_id, record_type, payload_bytes, payload_digest,
    refers_to, archive, at)``: the position in the global order, and where the record lies.
    ``path`` keeps the archives; without it they live in the shared folder until the session ends.

    A null html is an empty payload; a null url has the empty key; a null page id is written
    without an id and comes back null.  Repeated rows are records of their own.  Line breaks
    in a URL are percent-encoded.  An empty table gives an empty index.
    """
    spark = pages.sparkSession
    if path is None:
        path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    rows, per_archive = plan_records(pages, min_bytes, ts)
    write_archives(rows, path, per_archive)
    runs = read_runs(spark, path)
    return merge_runs(runs, range_bounds(runs))
