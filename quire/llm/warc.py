"""WARC archives: writing, reading back, and the merged capture index.

Writing: a record per page. Of the records with equal payloads of at least
``least`` bytes the one with the smallest page_id is a response, the others are
revisits that name it and hold the HTTP head only. Archives are written by
Spark's text writer, whose line separator is the end of a WARC record, so files
land wherever Spark can write, at most RECORDS records a file.

Reading: each archive is parsed by the Content-Length of its records, and the
SHA-1 of every stored payload is compared with its digest field; a difference
raises.

Index: the captures of each archive, sorted by URL key and time, are a run.
Runs are dealt out by ranges of (URL key, time, page), and a loser tree merges
the pieces of all runs that meet in a range; ranges in order are the global
capture history. A URL with very many captures spans several ranges.

Defined cases: a null html is an empty payload, a null url an empty one (then
the record has no target field); line breaks in a url are percent-coded;
repeated page_ids with one payload are all responses if theirs is the smallest;
a null page_id is written as empty and is null again when read; an empty table
gives an empty index. Other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.arrow import slices
from quire.session import scratch_path, ship_package

EOL, END = "\r\n", "\r\n\r\n"
RECORDS = 512
#: Pages carry no time of their own: page n counts as captured n seconds after this.
EPOCH = 1_577_836_800
CAPTURE = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "url string, urlkey string, captured string")
RUN = f"{CAPTURE}, run string, offset long"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str) -> str:
    """Sort key of a URL: host labels reversed, then the path and query."""
    rest = url.strip().lower().partition("://")[2] or url.strip().lower()
    rest = rest.partition("#")[0]
    host, slash, path = rest.partition("/")
    host = host.rpartition("@")[2].partition(":")[0].removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + slash + path


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        ids = batch.column("page_id").to_pylist()
        payloads = [(h or "").encode() for h in batch.column("html").to_pylist()]
        date = [datetime.fromtimestamp(EPOCH + (i or 0) % 10**9, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ") for i in ids]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), batch.column("html"),
             pa.array([len(p) for p in payloads], pa.int64()), pa.array([digest(p) for p in payloads], pa.string()),
             pa.array(date, pa.string())], ["page_id", "url", "html", "payload_bytes", "payload_digest", "date"])


def records(pages: DataFrame, least: int = 0) -> DataFrame:
    """(record): the text of one WARC record per page, without its end."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(
        _digested, "page_id long, url string, html string, payload_bytes long, payload_digest string, date string")
    firsts = (pages.select(F.col("page_id").cast("long"), F.lit("").alias("url"), F.col("html").cast("string"))
              .mapInArrow(_digested, "page_id long, url string, html string, payload_bytes long, payload_digest string, date string")
              .where(F.col("payload_bytes") >= least).groupBy(F.col("payload_digest").alias("d")).agg(F.min("page_id").alias("first")))
    rows = rows.join(firsts, F.col("payload_digest") == F.col("d"), "left")
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False))
    url = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(END))
    block = F.when(revisit, head).otherwise(F.concat(head, F.coalesce("html", F.lit(""))))
    fields = F.concat(
        F.lit(f"WARC/1.0{EOL}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{EOL}WARC-Record-ID: <urn:page:"), page, F.lit(f">{EOL}WARC-Date: "), F.col("date"),
        F.when(url != "", F.concat(F.lit(f"{EOL}WARC-Target-URI: "), url)).otherwise(""),
        F.lit(f"{EOL}WARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.when(revisit, F.concat(F.lit(f"{EOL}WARC-Refers-To: <urn:page:"), F.col("first").cast("string"),
                                 F.lit(f">{EOL}WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")))
        .otherwise(""),
        F.lit(f"{EOL}Content-Type: application/http; msgtype=response{EOL}Content-Length: "),
        F.octet_length(block).cast("string"), F.lit(END))
    return rows.select(F.concat(fields, block).alias("record"))


def write(pages: DataFrame, path: str, least: int = 0) -> None:
    records(pages, least).write.option("lineSep", END).option("maxRecordsPerFile", RECORDS).option("compression", "gzip").text(path)


def parse(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes, bytes]]:
    """(offset, fields, HTTP head, payload) of each record."""
    at = 0
    while at < len(content):
        stop = content.index(END.encode(), at)
        version, *lines = content[at:stop].decode().split(EOL)
        if version != "WARC/1.0":
            raise ValueError(f"no WARC record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines)
        begin = stop + len(END)
        finish = begin + int(fields["Content-Length"])
        if content[finish:finish + len(END)] != END.encode():
            raise ValueError(f"record at byte {at} does not end where its length says")
        head, _, payload = content[begin:finish].partition(END.encode())
        yield at, fields, head, payload
        at = finish + len(END)


def _page(uri: str | None) -> int | None:
    number = (uri or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _captures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted run of captures for each archive."""
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            rows, run = [], path.as_py().rpartition("/")[2]
            for at, fields, head, payload in parse(gzip.decompress(content.as_buffer())):
                kind = fields["WARC-Type"]
                said = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                length = int(dict(x.split(": ", 1) for x in head.decode().split(EOL)[1:])["Content-Length"])
                if kind == "response" and (digest(payload) != said or len(payload) != length):
                    raise ValueError(f"{run}, byte {at}: the payload differs from its digest")
                url = fields.get("WARC-Target-URI", "")
                rows.append((_page(fields["WARC-Record-ID"]), length, said, kind, _page(fields.get("WARC-Refers-To")),
                             url, url_key(url), "".join(c for c in fields["WARC-Date"] if c.isdigit()), run, at))
            rows.sort(key=_order)
            names = [f.split()[0] for f in RUN.split(", ")]
            kinds = [pa.int64() if f.endswith("long") else pa.string() for f in RUN.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * len(names), kinds)], names)


def _order(row: tuple) -> tuple:
    return row[6], row[7], row[0] is not None, row[0] or 0, row[8], row[9]


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives of a folder, a sorted run for each."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_captures, RUN)


class LoserTree:
    """Merges sorted runs. Inner nodes hold the loser of the match played
    there, the winner moves up; after the winner's run moves on, only the
    matches on its path are played again."""

    def __init__(self, runs: Iterable[list], key) -> None:
        self.key = key
        self.runs = [iter(r) for r in runs]
        self.width = 1
        while self.width < len(self.runs):
            self.width *= 2
        self.heads = [self._next(i) for i in range(self.width)]
        self.losers = [0] * self.width
        self.winner = self._play(1)

    def _next(self, run: int):
        row = next(self.runs[run], None) if run < len(self.runs) else None
        return (0, self.key(row), run, row) if row is not None else (1, (), run, None)

    def _play(self, node: int) -> int:
        if node >= self.width:
            return node - self.width
        a, b = self._play(2 * node), self._play(2 * node + 1)
        if self.heads[b][:3] < self.heads[a][:3]:
            a, b = b, a
        self.losers[node] = b
        return a

    def __iter__(self):
        while self.heads[self.winner][0] == 0:
            best = self.winner
            yield self.heads[best][3]
            self.heads[best] = self._next(best)
            node = (best + self.width) // 2
            while node:
                if self.heads[self.losers[node]][:3] < self.heads[best][:3]:
                    best, self.losers[node] = self.losers[node], best
                node //= 2
            self.winner = best


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs: dict[str, list] = {}
    schema = None
    for batch in batches:
        schema = batch.schema
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            runs.setdefault(row[8], []).append(row)
    if schema is None:
        return
    for run in runs.values():
        run.sort(key=_order)  # blocks of a run may arrive out of order; a sorted list costs one pass
    out: list = []
    for row in LoserTree(runs.values(), _order):
        out.append(row)
        if len(out) == 8192:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def merge_index(runs: DataFrame, partitions: int) -> DataFrame:
    """The runs in global order of (urlkey, captured, page_id), merged range by
    range."""
    dealt = runs.repartitionByRange(partitions, "urlkey", "captured", "page_id", "run", "offset")
    return dealt.mapInArrow(_merged, RUN)


def capture_history(spark: SparkSession, pages: DataFrame, least: int = 0, captures_per_range: int = 100_000) -> DataFrame:
    """Writes the pages as archives, reads them back and merges the runs."""
    ship_package(spark)
    archive, index = scratch_path(spark, "warc"), scratch_path(spark, "runs")
    write(pages, archive, least)
    read_runs(spark, archive).write.parquet(index)
    runs = spark.read.schema(RUN).parquet(index)
    return merge_index(runs, runs.count() // captures_per_range + 1)
