"""WARC archives of pages, and their capture index by an external merge.

Writing: one WARC/1.1 record per page, in gzip-compressed files.  Of pages with equal payloads of at
least ``REVISIT_BYTES`` bytes the one with the smallest id is a response,
the others are revisit records without a payload.  Spark's text writer
writes the records (every record ends with CR LF CR LF, which is its line
separator), so archives reach any store that Spark reaches and its committer
drops what a lost executor left.

Reading: records are parsed by their Content-Length and payload digests are
checked.  Each archive gives a run of captures, sorted locally by URL key,
time and page.  Range partitioning cuts all runs at the same keys; in each
range a loser tree merges the k slices, so the ranges in order are the
capture histories in global order.  A host or a URL with very many captures
is cut by time and page like any other stretch of keys.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.session import materialize, ship

REVISIT_BYTES = 100
ARCHIVE_BYTES = 32 << 20        # aimed at; archives are read whole
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URL = re.compile(r"(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^#]*)")
CAPTURE = ("run string, seq long, url_key string, captured string, page_id long, record_type string, "
           "payload_bytes long, payload_digest string, refers_to long, offset long, length long")
NAMES = [c.strip().split()[0] for c in CAPTURE.split(",")]


def url_key(url: str) -> str:
    """Host labels in reverse order, then path and query: captures of a site sort together."""
    host, rest = URL.match(url).groups()
    return ",".join(reversed(host.lower().split("."))) + ")" + (rest or "/")


def capture_time(page_id: Column) -> Column:
    """A time for pages that come without one: one second per page id."""
    return F.timestamp_seconds(F.lit(1577836800) + F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(10 ** 9)))


def write_warc(df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               time: Column | None = None) -> None:
    """A record per row under ``path``.  A null payload is empty, a null URL
    is written as none; a row with a null id is always a response; rows that
    repeat the smallest id are all responses.  Other columns are not read."""
    page = F.col(f"`{id_col}`").cast("long")
    pages = df.select(page.alias("id"), F.col(f"`{url_col}`").alias("url"), F.coalesce(f"`{payload_col}`", F.lit("")).alias("payload"),
                      F.date_format(F.coalesce(time, capture_time(page)) if time is not None else capture_time(page),
                                    "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"))
    pages = pages.withColumns({"digest": F.sha2("payload", 256), "n": F.octet_length("payload").cast("long")})
    facts = materialize(pages.select("id", "digest", "n"), "payloads")
    firsts = (facts.where(F.col("n") >= REVISIT_BYTES).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("c"))
              .where("c > 1").select(F.col("digest").alias("d"), "first"))
    mean = facts.agg(F.avg("n")).first()[0] or 0
    head = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))                  # noqa: E731
    uri = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("n").cast("string"), F.lit(END))
    revisit = F.coalesce(F.col("first") < F.col("id"), F.lit(False))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    none = F.lit("")
    record = F.concat(
        F.lit("WARC/1.1\r\n"), head("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.when(F.col("id").isNotNull(), head("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("id").cast("string"), F.lit(">")))).otherwise(none),
        F.when(F.col("url").isNotNull(), head("WARC-Target-URI", uri)).otherwise(none),
        head("WARC-Date", F.col("date")), head("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(head("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">"))),
                                 head("WARC-Profile", F.lit(PROFILE)))).otherwise(none),
        head("Content-Type", F.lit("application/http; msgtype=response")),
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END), block)
    (pages.join(firsts, F.col("digest") == F.col("d"), "left").select(record.alias("value"))
     .write.mode("overwrite").option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", max(1, int(ARCHIVE_BYTES // (mean + 600))))
     .text(path))


def records(content: memoryview) -> Iterator[tuple[int, int, dict[str, str], memoryview]]:
    """(offset, length, headers, block) of each record of an archive."""
    at, end = 0, END.encode()
    while at < len(content):
        head, size = b"", 4096
        while end not in head:
            if at + size // 2 > len(content) and size > 4096:
                raise ValueError(f"no record header at {at}")
            head, size = bytes(content[at:at + size]), size * 4
        head = head[:head.index(end)]
        first, *lines = head.decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        fields = dict(x.split(": ", 1) for x in lines)
        start = at + len(head) + 4
        stop = start + int(fields["Content-Length"])
        if bytes(content[stop:stop + 4]) != end:
            raise ValueError(f"the record at {at} doesn't end where it says")
        yield at, stop + 4 - at, fields, content[start:stop]
        at = stop + 4


def unpacked(content) -> memoryview:
    """The bytes of a gzip-compressed archive file; offsets in the index count these."""
    return memoryview(zlib.decompress(content, 31))


def page_of(urn: str | None) -> int | None:
    return int(urn[len("<urn:page:"):-1]) if urn else None


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, each archive a run in local order (CAPTURE)."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1)):
                run = []
                for at, length, f, block in records(unpacked(content.as_buffer())):
                    cut = bytes(block[:1024]).index(END.encode()) + 4
                    http = dict(x.split(": ", 1) for x in bytes(block[:cut - 4]).decode().split("\r\n")[1:])
                    digest = f["WARC-Payload-Digest"].removeprefix("sha256:")
                    n = int(http["Content-Length"])
                    if f["WARC-Type"] == "response" and (len(block) - cut != n or hashlib.sha256(block[cut:]).hexdigest() != digest):
                        raise ValueError(f"{name}: the payload at {at} doesn't match its digest")
                    run.append((url_key(f.get("WARC-Target-URI", "")), f["WARC-Date"], page_of(f.get("WARC-Record-ID")),
                                f["WARC-Type"], n, digest, page_of(f.get("WARC-Refers-To")), at, length))
                run.sort(key=capture_order)
                cols = [[name] * len(run), range(len(run)), *(zip(*run) if run else [[]] * 9)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, capture_types())], NAMES)

    files = (spark.read.format("binaryFile").load(path)
             .select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "content"))
    return files.mapInArrow(read, CAPTURE)


def capture_types() -> list[pa.DataType]:
    return [pa.string() if " string" in c else pa.int64() for c in CAPTURE.split(",")]


def capture_order(c: tuple) -> tuple:
    """URL key, time, page with null first: the order of the ranges, too."""
    return c[0], c[1], c[2] is not None, c[2] or 0


class LoserTree:
    """The smallest head of k sorted runs at a time, with one comparison per level."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs, self.k = runs, len(runs)
        self.heads = [next(r, None) for r in runs]
        self.losers = [0] * max(self.k, 1)
        self.winner = self._play(1) if self.k else 0

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and x <= y)

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        a, b = (a, b) if self._beats(a, b) else (b, a)
        self.losers[node] = b
        return a

    def __iter__(self) -> Iterator[tuple]:
        while self.k and self.heads[self.winner] is not None:
            yield self.heads[self.winner]
            w = self.winner
            self.heads[w] = next(self.runs[w], None)
            node = (w + self.k) // 2
            while node:
                if self._beats(self.losers[node], w):
                    self.losers[node], w = w, self.losers[node]
                node //= 2
            self.winner = w


def merge_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The captures of one range, merged from the slices of all runs."""
    held = list(batches)
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks()
    runs = np.unique(np.array(table.column("run").to_pylist(), dtype=object), return_inverse=True)[1]
    order = np.lexsort((table.column("seq").to_numpy(), runs))           # each run's slice in its own order
    cut = np.concatenate([[0], np.flatnonzero(np.diff(runs[order])) + 1, [len(order)]])
    key, when, page = (table.column(c).to_pylist() for c in ("url_key", "captured", "page_id"))
    heads = [((capture_order((key[i], when[i], page[i])), i) for i in order[lo:hi].tolist()) for lo, hi in zip(cut[:-1], cut[1:])]
    merged = [i for _, i in LoserTree(heads)]
    for lo in range(0, len(merged), 10_000):
        yield from table.take(pa.array(merged[lo:lo + 10_000])).combine_chunks().to_batches()


def capture_histories(spark: SparkSession, path: str) -> DataFrame:
    """(position, url_key, captured, page_id, record_type, payload_bytes,
    payload_digest, refers_to, run, offset, length): every record of the
    archives under ``path`` at its place in the global order."""
    ship(spark)
    runs = materialize(read_runs(spark, path), "capture-runs")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    merged = materialize(runs.repartitionByRange(parts, "url_key", "captured", "page_id").mapInArrow(merge_slices, CAPTURE)
                         .withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), "captures")
    before = (merged.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
              .select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n") - F.col("first")).alias("shift")))
    return (merged.join(before, "part").withColumn("position", F.col("at") + F.col("shift"))
            .select("position", "url_key", "captured", "page_id", "record_type", "payload_bytes", "payload_digest",
                    "refers_to", "run", "offset", "length"))
