"""WARC archives of pages, read back and merged into one ordered capture index."""

from __future__ import annotations

import base64
import bisect
import hashlib
import io
import re
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.session import work_dir

from .common import hash_sample, per_batch, staged, table

#: Fixed values of the format.
CRLF = "\r\n"
RECORD_END = CRLF + CRLF
IDENTICAL_PAYLOAD = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: Payloads of fewer bytes are never replaced by a revisit.
LEAST_PAYLOAD = 0
#: Archives are closed after this many records; a reading task holds a whole archive.
FILE_RECORDS = 500
#: Captures in one range of the ordered index, about: what a merging task holds at once.
RANGE_ROWS = 100_000
#: Capture dates of a table that has none: this second (2024-01-01T00:00:00Z) and one more per page_id.
FIRST_CAPTURE = 1_704_067_200


def base32(hex40: Column) -> Column:
    """The 32 base32 characters of 40 hex digits: 5 digits are 20 bits are 4 characters."""
    out = []
    for group in range(8):
        bits = F.conv(F.substring(hex40, 5 * group + 1, 5), 16, 10).cast("int")
        out += [F.substring(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*out)


def captures(pages: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    """(page_id, url, captured, html, payload_bytes, payload_digest, first) of every page.

    ``first`` is the smallest page_id with an equal payload (digest and length), null for
    smaller payloads and for pages without an id. The smallest ids are found by a partial
    aggregate, so a payload that a third of all pages share is one row per task.
    """
    html = F.coalesce("html", F.lit(""))
    seconds = FIRST_CAPTURE + F.coalesce(F.pmod("page_id", F.lit(10**9)), F.lit(0))
    rows = pages.select(
        F.col("page_id").cast("long"), "url", F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured"),
        html.alias("html"), F.octet_length(html).cast("long").alias("payload_bytes"), F.sha1(html).alias("sha1"),
    )
    equal = ["sha1", "payload_bytes"]
    firsts = rows.filter(F.col("payload_bytes") >= least).groupBy(*equal).agg(F.min("page_id").alias("first"))
    # the digest is spelled after the join: before it, each of its 32 characters would hash the page anew
    return rows.join(firsts, equal, "left").withColumns({
        "first": F.when(F.col("page_id").isNotNull(), F.col("first")), "payload_digest": base32(F.col("sha1")),
    })


def record(page: DataFrame) -> Column:
    """The text of a WARC record, without the two line ends that close it."""
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit(CRLF))
    revisit = F.col("first").isNotNull() & (F.col("first") != F.col("page_id"))
    # a line end inside a URL would end its header
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("payload_bytes").cast("string"), F.lit(CRLF + CRLF),
    )
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    return F.concat(
        F.lit("WARC/1.0" + CRLF),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn(F.col("page_id"))),
        line("WARC-Date", F.col("captured")),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", urn(F.col("first"))), F.lit(f"WARC-Profile: {IDENTICAL_PAYLOAD}{CRLF}"))).otherwise(F.lit("")),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"),
        line("Content-Length", length.cast("string")),
        F.lit(CRLF), http, F.when(revisit, F.lit("")).otherwise(F.col("html")),
    )


def write_archives(pages: DataFrame, path: str, least: int = LEAST_PAYLOAD, file_records: int = FILE_RECORDS) -> None:
    """Write a WARC record per page to gzip-compressed archives under ``path``.

    A WARC file of text payloads is text: records joined by two line ends. So Spark's text
    writer makes the archives, on any file system and with its commit of whole tasks.
    """
    rows = captures(pages, least)
    rows.select(record(rows).alias("value")).write.option("lineSep", RECORD_END).option("compression", "gzip").option(
        "maxRecordsPerFile", file_records
    ).text(path)


def parse_records(stream) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of the records of one uncompressed archive."""
    offset = 0
    while (line := stream.readline()):
        size = len(line)
        if line.rstrip() != b"WARC/1.0":
            raise ValueError(f"no record begins at {offset}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            size += len(line)
            name, _, value = line.decode("utf-8").rstrip("\r\n").partition(":")
            headers[name] = value.strip(" ")
        block = stream.read(int(headers["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"the record at {offset} doesn't end")
        yield offset, headers, block
        offset += size + 2 + len(block) + 4


def url_key(url: str | None) -> str:
    """The sort key of a URL: its host from the right, without www., then the rest; lower case."""
    rest = (url or "").lower().partition("://")[2].partition("#")[0]
    host, rest = re.fullmatch(r"([^/?]*)(.*)", rest, re.S).groups()
    return ",".join(reversed(host.removeprefix("www.").split("."))) + ")" + rest


def _urn(value: str | None) -> int | None:
    found = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return None if found in ("", "none") else int(found)


_INDEX = pa.schema([
    ("url_key", pa.string()), ("captured", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("archive", pa.string()), ("offset", pa.int64()),
])
INDEX_DDL = (
    "url_key string, captured string, page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, archive string, offset long"
)


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """A row per record of the archives under ``path``; the payload of revisits is null.

    payload_bytes is what the record says of the full payload (its HTTP length); a response
    whose payload has another length or digest than it says is an error.
    """
    schema = _INDEX.append(pa.field("payload", pa.binary())) if with_payload else _INDEX

    def run(batch: pa.RecordBatch):
        for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
            rows, held = [], 0
            for offset, headers, block in parse_records(io.BytesIO(zlib.decompress(content, 47)) if content else io.BytesIO()):
                head, _, payload = block.partition(b"\r\n\r\n")
                said = int(re.search(rb"(?im)^Content-Length: (\d+)", head)[1])
                digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                own = headers["WARC-Type"] == "response"
                if own and (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()) != (said, digest):
                    raise ValueError(f"{name}: the payload at {offset} is not the one it says")
                url = headers.get("WARC-Target-URI")
                row = [
                    url_key(url), headers["WARC-Date"], _urn(headers["WARC-Record-ID"]), url, headers["WARC-Type"],
                    _urn(headers.get("WARC-Refers-To")), said, digest, name, offset,
                ]
                rows.append([*row, payload if own else None] if with_payload else row)
                held += len(payload) if with_payload else 0
                if held > 1 << 24:
                    yield _batch(rows, schema)
                    rows, held = [], 0
            yield _batch(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(per_batch(run), INDEX_DDL + (", payload binary" if with_payload else ""))


def _batch(rows: Sequence[Sequence], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _order(row: Sequence) -> tuple:
    """Where a capture stands in the index: URL key, time, page (null first)."""
    return row[0], row[1], row[2] is not None, row[2] or 0


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, the winner is on top.

    After the winner gives its row, only the matches on its way up are played again, one
    comparison per level.
    """

    def __init__(self, runs: Sequence[Iterator]):
        self.runs = [iter(r) for r in runs]
        self.size = len(self.runs)
        self.head = [next(r, None) for r in self.runs]
        self.keys = [_order(h) if h is not None else None for h in self.head]
        self.losers = [-1] * self.size
        self.winner = -1
        for run in range(self.size):
            self._play(run)

    def _beats(self, a: int, b: int) -> bool:
        """Ended runs lose; equal keys keep the order of runs."""
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[b] is None and (self.keys[a] is not None or a < b)
        return (self.keys[a], a) < (self.keys[b], b)

    def _play(self, run: int) -> None:
        node = (run + self.size) // 2
        while node > 0:
            if self.losers[node] < 0:  # while the tree is filled: wait here for the opponent
                self.losers[node] = run
                return
            if self._beats(self.losers[node], run):
                self.losers[node], run = run, self.losers[node]
            node //= 2
        self.winner = run

    def __iter__(self) -> Iterator:
        while self.size and self.head[self.winner] is not None:
            run = self.winner
            yield self.head[run]
            self.head[run] = next(self.runs[run], None)
            self.keys[run] = _order(self.head[run]) if self.head[run] is not None else None
            self._play(run)


def capture_index(records: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The records in one global order by URL key, time and page: (range, position) counts it.

    Runs of records are sorted where they are read and cut at common borders; each range then
    merges its pieces of all runs with a loser tree. Borders are quantiles of about 100
    sampled keys per range and include time and page, so the history of a single URL that a
    third of all captures have is cut like any other. Null URLs have the key ``)``, null
    page_ids come first; equal records follow each other.
    """
    spark = records.sparkSession
    records = staged(records, "warc-records")
    total = records.count()
    ranges = max(-(-total // range_rows), min(total, int(spark.conf.get("spark.sql.shuffle.partitions"))), 1)
    sample = hash_sample(records.select("url_key", "captured", "page_id"), F.struct("url_key", "captured", "page_id"), 100 * ranges)
    keys = sorted(_order(r) for r in sample.collect())
    borders = sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []

    def sorted_runs(batches):
        for batch in batches:
            rows = sorted(zip(*(c.to_pylist() for c in batch.columns)), key=_order)
            places, pieces = [], []
            start = 0
            while start < len(rows):
                place = bisect.bisect_right(borders, _order(rows[start]))
                stop = len(rows) if place == len(borders) else bisect.bisect_left(rows, borders[place], lo=start, key=_order)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, _INDEX) as out:
                    out.write_batch(_batch(rows[start:stop], _INDEX))
                places.append(place)
                pieces.append(sink.getvalue().to_pybytes())
                start = stop
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(pieces, pa.binary())], ["range", "piece"])

    def rows_of(piece: bytes):
        for batch in pa.ipc.open_stream(piece):
            yield from zip(*(c.to_pylist() for c in batch.columns))

    def merged(place: int, pieces: list[bytes]):
        rows, position = [], 0
        for row in LoserTree([rows_of(p) for p in pieces]):
            rows.append((place, position, *row))
            position += 1
            if len(rows) == 10_000:
                yield _batch(rows, out_schema)
                rows = []
        yield _batch(rows, out_schema)

    out_schema = pa.schema([("range", pa.int32()), ("position", pa.int64()), *_INDEX])

    def merge(batches):
        now, pieces = None, []
        for batch in batches:
            for place, piece in zip(batch.column("range").to_pylist(), batch.column("piece").to_pylist()):
                if place != now and pieces:
                    yield from merged(now, pieces)
                    pieces = []
                now = place
                pieces.append(piece)
        if pieces:
            yield from merged(now, pieces)

    runs = records.select(*[f.name for f in _INDEX]).mapInArrow(sorted_runs, "range int, piece binary")
    lined = runs.repartition(min(ranges, 10_000), "range").sortWithinPartitions("range")
    return lined.mapInArrow(merge, "range int, position long, " + INDEX_DDL)


def archived(pages: DataFrame, least: int = LEAST_PAYLOAD, path: str | None = None) -> DataFrame:
    """Write ``pages`` as WARC archives, read them back, and return the ordered index of captures.

    A null html is an empty payload. Of pages with equal payloads of ``least`` bytes or more,
    the one with the smallest page_id is a response and the others revisit it; rows that
    repeat a page_id with its payload are all responses if it is the smallest. A page without
    an id is always a response and never referred to. A line end in a URL is percent-encoded.
    An empty table gives an empty index; other columns are ignored.
    """
    spark = pages.sparkSession
    path = path or work_dir(spark, "warc")
    write_archives(pages, path, least)
    return capture_index(read_archives(spark, path))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives say of every page: size and digest of its payload, and what it revisits."""
    index = archived(table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS n, sha1(h) AS x FROM p),
g AS (
  SELECT page_id, n, [CAST(list_sum([(strpos('0123456789abcdef', substr(x, 5 * i + j, 1)) - 1) * [65536, 4096, 256, 16, 1][j]
         FOR j IN [1, 2, 3, 4, 5]]) AS BIGINT) FOR i IN range(8)] AS v FROM d),
b AS (
  SELECT page_id, n, array_to_string([array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (y // k) % 32 + 1, 1)
         FOR k IN [32768, 1024, 32, 1]], '') FOR y IN v], '') AS digest FROM g),
f AS (SELECT page_id, n, digest, min(page_id) OVER (PARTITION BY digest, n) AS first FROM b)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""
