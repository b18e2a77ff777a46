"""WARC archives through chunked record tables.

Writing: each task streams its records into one archive in the shared folder
and hands back the archive's path; only paths handed back by the tasks that
the job committed are read, so an attempt that died leaves nothing behind that
counts.  A record whose payload another record carries is a revisit record
with the payload's digest and the id of that record, and no payload.

Reading: each task streams archives in blocks and hands on rows of record id,
chunk number and chunk, with the number of bytes and the SHA-256 up to and
including that chunk.  No payload is ever in memory as a whole.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import keep, scratch_path, ship

#: Payload bytes in a row of the record table.
CHUNK_BYTES = 1 << 18
#: Payloads below this are never revisited.
REVISIT_BYTES = 100
#: WARC-Date of the records: fixed, so that reruns write equal archives.
DATE = datetime(2000, 1, 1, tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
RECORD_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CHUNK_ROW = ("record_id string, record_type string, page_id long, url string, refers_to long, header_digest string, "
             "chunk int, data binary, bytes_so_far long, digest_so_far string, last boolean")


def plan_records(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``page_id, url, payload, digest, refers_to`` of every page.

    Of the pages with one payload of ``revisit_bytes`` or more, the smallest
    id is the response (all rows that repeat it are), the others refer to it.
    Null html: an empty payload.  Null ids refer like others; if a payload has
    only null ids, all its records are responses.  The smallest id is a
    map-side combined minimum; the join on the digest has rows of one payload
    only on its large side, which adaptive execution may split.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    facts = rows.select("page_id", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("size"))
    # kept: a join of two shuffles can be split at a payload of very many pages
    first = keep(facts.where(F.col("size") >= revisit_bytes).groupBy("digest")
                 .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
                 .where("n > 1 and first_id is not null"), "warc-firsts")
    return rows.withColumn("digest", F.sha2("payload", 256)).join(
        first.select("digest", "first_id"), "digest", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("refers_to"))


def _safe(value: str | None) -> str:
    """A header value: no line ends."""
    return " ".join((value or "").split("\n")).replace("\r", " ")


def record_head(record_id: str, page_id: int | None, url: str | None, digest: str, size: int,
                refers_to: int | None) -> bytes:
    """Header block of a record whose block is ``size`` bytes of payload."""
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"),
              ("WARC-Record-ID", f"<urn:uuid:{record_id}>"), ("WARC-Date", DATE),
              ("WARC-Target-URI", _safe(url)), ("WARC-Payload-Digest", f"sha256:{digest}"),
              ("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(size))]
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("X-Refers-To-Page-Id", str(refers_to))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def write_warc(records: DataFrame, folder: str) -> DataFrame:
    """Write ``plan_records`` rows as archives below ``folder``; returns the
    committed ``path, records, bytes``.  An archive a task; payloads are
    written in blocks."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}.warc"
        n = total = 0
        out = None
        for b in batches:
            for page_id, url, payload, digest, refers_to in zip(
                    b["page_id"], b["url"], b["payload"], b["digest"], b["refers_to"]):
                if out is None:
                    out = fs.open_output_stream(f"{base}/{name}")
                page_id = None if pd.isna(page_id) else int(page_id)
                refers_to = None if pd.isna(refers_to) else int(refers_to)
                body = b"" if refers_to is not None else payload
                head = record_head(str(uuid.uuid5(RECORD_NAMESPACE, f"{name}/{n}")), page_id,
                                   url if isinstance(url, str) else None, digest, len(body), refers_to)
                out.write(head)
                for at in range(0, len(body), CHUNK_BYTES):
                    out.write(memoryview(body)[at:at + CHUNK_BYTES])
                out.write(b"\r\n\r\n")
                total += len(head) + len(body) + 4
                n += 1
        if out is not None:
            out.close()
            yield pd.DataFrame({"path": [f"{folder}/{name}"], "records": [n], "bytes": [total]})

    rows = records.select(F.col("page_id").cast("decimal(20,0)").cast("string").alias("page_id"), "url",
                          F.col("payload").cast("binary").alias("payload"), "digest",
                          F.col("refers_to").cast("string").alias("refers_to"))
    return keep(rows.mapInPandas(write, "path string, records long, bytes long"), "warc-archives")


class _Reader:
    """Bytes of a stream with a bounded buffer."""

    def __init__(self, stream, block: int):
        self.stream, self.block, self.buffer = stream, block, b""

    def line(self) -> bytes | None:
        while (end := self.buffer.find(b"\r\n")) < 0:
            more = self.stream.read(self.block)
            if not more:
                if self.buffer:
                    raise ValueError("archive ends inside a header")
                return None
            self.buffer += more
        out, self.buffer = self.buffer[:end], self.buffer[end + 2:]
        return out

    def take(self, n: int) -> bytes:
        """The next ``n`` bytes (``n`` is at most a block)."""
        while len(self.buffer) < n:
            more = self.stream.read(self.block)
            if not more:
                raise ValueError("archive ends inside a record")
            self.buffer += more
        out, self.buffer = self.buffer[:n], self.buffer[n:]
        return out


def read_records(stream, chunk_bytes: int = CHUNK_BYTES, with_data: bool = True) -> Iterator[tuple]:
    """Rows of the record table (``CHUNK_ROW``) of one archive.  A record
    without payload gives one row with an empty chunk."""
    src = _Reader(stream, chunk_bytes)
    while True:
        line = src.line()
        if line is None:
            return
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:20]!r}")
        head: dict[str, str] = {}
        while line := src.line():
            k, _, v = line.decode().partition(":")
            head[k.lower()] = v.strip()
        left, chunk, so_far, digest = int(head["content-length"]), 0, 0, hashlib.sha256()
        number = lambda k: int(head[k]) if k in head else None
        fixed = (head["warc-record-id"][1:-1].rpartition(":")[2], head["warc-type"], number("x-page-id"),
                 head.get("warc-target-uri"), number("x-refers-to-page-id"),
                 head.get("warc-payload-digest", "").rpartition(":")[2])
        while True:
            data = src.take(min(left, chunk_bytes))
            left -= len(data)
            so_far += len(data)
            digest.update(data)
            yield (*fixed, chunk, data if with_data else None, so_far, digest.hexdigest(), left == 0)
            chunk += 1
            if not left:
                break


def read_warc(archives: DataFrame, chunk_bytes: int = CHUNK_BYTES, with_data: bool = True) -> DataFrame:
    """The chunked record table of ``archives`` (``path``), an archive a task.
    ``with_data=False`` leaves chunks out (their digests stay)."""
    names = [x.split(" ")[0] for x in CHUNK_ROW.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path in b["path"]:
                fs, where = pafs.FileSystem.from_uri(path)
                rows, size = [], 0
                with fs.open_input_stream(where) as stream:
                    for row in read_records(stream, chunk_bytes, with_data):
                        rows.append(row)
                        size += len(row[7] or b"") + 500
                        if size >= 16 * chunk_bytes:
                            yield _frame(rows, names)
                            rows, size = [], 0
                if rows:
                    yield _frame(rows, names)

    n = max(1, archives.count())
    return archives.select("path").repartition(n).mapInPandas(read, CHUNK_ROW)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    for c in ("page_id", "refers_to"):
        out[c] = out[c].astype("Int64")
    return out


def archive_pages(pages: DataFrame, folder: str | None = None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write all pages, read the archives back: the chunked record table with
    its payloads.  An empty table gives an empty one."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return read_warc(write_warc(plan_records(pages), folder), chunk_bytes)


def record_facts(table: DataFrame) -> DataFrame:
    """From a record table one row a record: ``page_id, payload_bytes,
    payload_digest, record_type, refers_to``, taken from its chunks: the size
    is the sum of theirs, the digest of a payload of one chunk that of the
    chunk, of more chunks the running one of the last.  A record that lacks a
    chunk, or whose chunks are not what its running sizes say, has nulls.  A
    revisit's size and digest are those of the response it refers to; a revisit
    whose header digest is not that of this response has nulls."""
    size = F.octet_length("data").cast("long")
    rows = table.select("record_id", "page_id", "record_type", "refers_to", "header_digest", "chunk", "last",
                        "bytes_so_far", size.alias("size"),
                        F.when(F.col("last") & (F.col("chunk") == 0), F.sha2("data", 256)).otherwise(
                            F.col("digest_so_far")).alias("digest"))
    # the chunks of a record come from one task, so most of them meet there
    end = F.max(F.struct("chunk", "last", "bytes_so_far", "digest", "page_id", "record_type", "refers_to",
                         "header_digest")).alias("end")
    each = rows.groupBy("record_id").agg(F.count(F.lit(1)).alias("chunks"), F.sum("size").alias("size"), end)
    whole = F.col("end.last") & (F.col("chunks") == F.col("end.chunk") + 1) & (F.col("size") == F.col("end.bytes_so_far"))
    ends = each.select(
        "end.page_id", "end.record_type", "end.refers_to", "end.header_digest",
        F.when(whole, F.col("size")).alias("bytes_so_far"), F.when(whole, F.col("end.digest")).alias("digest_so_far"))
    ends = keep(ends, "warc-records")
    held = keep(ends.where("record_type = 'response' and page_id is not null")
                .groupBy(F.col("page_id").alias("of"), F.col("digest_so_far").alias("digest"))
                .agg(F.max("bytes_so_far").alias("size")), "warc-responses")
    joined = ends.join(held, (F.col("refers_to") == F.col("of")) & (F.col("header_digest") == F.col("digest")), "left")
    plain = F.col("record_type") == "response"
    return joined.select(
        "page_id", F.when(plain, F.col("bytes_so_far")).otherwise(F.col("size")).alias("payload_bytes"),
        F.when(plain, F.col("digest_so_far")).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type", "refers_to")


ship(__name__)
