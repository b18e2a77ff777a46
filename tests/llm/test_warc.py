import hashlib
import io

import pandas as pd
import pytest
from helpers import SF, same_as_sql

from salescope.llm import warc
from salescope.llm.common import scratch_path
from salescope.sources.tables import table

PAGES = "page_id long, url string, html string"


def test_same_as_sql(spark):
    same_as_sql(spark, "op5_warc_records", SF)


def test_exact_round_trip_in_chunks(spark):
    pages = table(spark, SF, "pages")
    archives = warc.write_warc(warc.plan_records(pages), scratch_path(spark, "test-warc"))
    chunks = warc.read_warc(archives, chunk_bytes=1000).toPandas()
    want = {r.page_id: (r.url, (r.html or "").encode()) for r in pages.collect()}
    assert set(chunks["page_id"]) == set(want) and chunks["record_id"].nunique() == len(want)
    assert max(map(len, chunks["data"])) <= 1000
    for page_id, c in chunks.sort_values("chunk").groupby("page_id"):
        url, body = want[page_id]
        assert list(c["chunk"]) == list(range(len(c))) and list(c["last"]) == [False] * (len(c) - 1) + [True]
        assert b"".join(map(bytes, c["data"])) == body and set(c["url"]) == {url}
        upto = b""
        for data, n, digest in zip(c["data"], c["bytes_so_far"], c["digest_so_far"]):
            upto += bytes(data)
            assert (n, digest) == (len(upto), hashlib.sha256(upto).hexdigest())
    # the archives are plain WARC files that any reader can follow
    from pyarrow import fs
    path = archives.first().path
    where, name = fs.FileSystem.from_uri(path)
    raw = where.open_input_stream(name).read()
    head, _, rest = raw.partition(b"\r\n\r\n")
    size = int(dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])[b"Content-Length"])
    assert head.startswith(b"WARC/1.1\r\n") and rest[size:size + 4] == b"\r\n\r\n"


def test_revisits_ties_and_odd_rows(spark):
    big = "é<p>line\r\n\r\nWARC/1.1\r\n</p>" * 20
    rows = [(5, "u", big), (3, "u\r\nX: y", big), (9, None, big), (3, "v", big), (None, "w", big),
            (1, "a", "short"), (2, "b", "short"), (4, "c", None), (6, "d", ""), (None, None, None),
            (None, "n", "only null ids " * 20), (None, "n", "only null ids " * 20)]
    pages = spark.createDataFrame([(*r, 1, "x") for r in rows], f"{PAGES}, digest int, payload string")
    out = warc.record_facts(warc.archive_pages(pages, chunk_bytes=64)).collect()
    assert len(out) == len(rows)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out), key=str)
    n = len(big.encode())
    want = [(5, n, sha(big), "revisit", 3), (3, n, sha(big), "response", None), (9, n, sha(big), "revisit", 3),
            (3, n, sha(big), "response", None), (None, n, sha(big), "revisit", 3),
            *[(i, 5, sha("short"), "response", None) for i in (1, 2)],
            *[(i, 0, sha(""), "response", None) for i in (4, 6, None)],
            *[(None, 280, sha("only null ids " * 20), "response", None)] * 2]
    assert got == sorted(want, key=str)
    assert warc.record_facts(warc.archive_pages(pages.limit(0))).count() == 0


def test_reader_holds_a_bounded_buffer():
    class Stream(io.BytesIO):
        most = 0

        def read(self, n=-1):
            assert 0 < n <= 4096
            return super().read(n)

    body = bytes(range(256)) * 4000
    raw = warc.record_head("r", 1, "u", "d", len(body), None) + body + b"\r\n\r\n"
    rows = list(warc.read_records(Stream(raw * 2), 4096))
    assert b"".join(r[7] for r in rows) == body * 2 and max(len(r[7]) for r in rows) == 4096
    with pytest.raises(ValueError):
        list(warc.read_records(Stream(raw[:-100]), 4096))
    assert pd.DataFrame(rows).shape[0] == 2 * -(-len(body) // 4096)


def test_facts_come_from_the_chunks(spark):
    """Without a chunk, or with another one's bytes, a record has no size and digest."""
    from pyspark.sql import functions as F
    pages = spark.createDataFrame([(1, "u", "x" * 1000), (2, "u", "y" * 2500), (3, "u", "")],
                                  "page_id long, url string, html string")
    records = warc.archive_pages(pages, chunk_bytes=1024)
    full = {r.page_id: r for r in warc.record_facts(records).collect()}
    for i, payload in ((1, "x" * 1000), (2, "y" * 2500), (3, "")):
        assert (full[i].payload_bytes, full[i].payload_digest) == (
            len(payload), hashlib.sha256(payload.encode()).hexdigest())
    lost = {r.page_id: r for r in warc.record_facts(records.where("page_id <> 2 or chunk <> 1")).collect()}
    assert (lost[2].payload_bytes, lost[2].payload_digest) == (None, None) and lost[1] == full[1]
    cut = records.withColumn("data", F.when(F.col("page_id") == 1, F.lit(b"other")).otherwise(F.col("data")))
    assert {r.page_id: r.payload_bytes for r in warc.record_facts(cut).collect()} == {1: None, 2: 2500, 3: 0}
