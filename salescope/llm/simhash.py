"""SimHash near-duplicates by multi-index hashing.

A fingerprint of 64 bits is cut into ``SEGMENTS`` segments, and each segment
has a table of the fingerprints by that segment's value.  Of two fingerprints
at most ``d`` bits apart, some segment differs in at most ``d // SEGMENTS``
bits (else all segments together would differ in more than ``d``).  So a probe
enumerates, for each segment, the Hamming ball of that radius around its own
value, fetches what the segment's table holds there, and verifies the complete
distance.

A segment value that more than ``BUCKET`` fingerprints share (a large group of
near copies) is split by the other bits: among fingerprints with such a value
in any segment, the ball of radius one over the whole code takes the table's
place.  Its keys are met by at most 65 fingerprints each, and two of them at
most two bits apart always meet: at the code between them, or at one of the
two.  A pair of which only one side is in a split bucket is found by the
probe that the other's table still answers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.llm.common import connected_components, keep, release, ship, with_row_id

SEED = 42
SEGMENTS = 2
#: Fingerprints of one segment value from which on it is split.
BUCKET = 64


def simhash(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of the word shingles of ``text`` (unsigned).

    Words are runs of non-space ASCII-lower-cased bytes.  Fewer words than
    ``shingle``: one shingle of all words.  No word, or null: 0.  Long texts
    are folded in blocks of 65,536 shingles.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    buf = b" ".join(words)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lens + 1) - 1
    starts = ends - lens
    n = max(1, len(words) - shingle + 1)
    last = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, 65536):
        part = zip(starts[at:at + 65536].tolist(), last[at:at + 65536].tolist())
        h = np.fromiter([digest(buf[s:e], SEED) for s, e in part], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    value = np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0]
    return int(value)


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", out: str = "fp") -> DataFrame:
    """``docs`` with a signed 64-bit column ``out``; other columns stay."""

    def column(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(np.array([simhash(t, shingle) for t in s], np.uint64).view(np.int64))

    column.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn(out, F.pandas_udf(column, "long")(F.col(text)))


def segment_values(fp: Column, segments: int) -> list[Column]:
    """The values of a fingerprint's segments, from the low bits up."""
    edges = [64 * i // segments for i in range(segments + 1)]
    return [F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1 if hi - lo < 64 else -1).cast("long"))
            for lo, hi in zip(edges[:-1], edges[1:])]


def segment_rows(codes: DataFrame, segments: int) -> DataFrame:
    """The tables of all segments: ``fp, segment, value``."""
    return codes.select("fp", F.posexplode(F.array(*segment_values(F.col("fp"), segments))).alias("segment", "value"))


def ball(value: Column, bits: int, radius: int) -> Column:
    """All values at most ``radius`` (0 or 1) bits from ``value``."""
    flips = [value.bitwiseXOR(F.lit(1 << b if b < 63 else -(1 << 63)).cast("long")) for b in range(bits)]
    return F.array(value, *(flips if radius else []))


def fingerprint_links(codes: DataFrame, max_bits: int = 2, segments: int = SEGMENTS,
                      bucket: int = BUCKET) -> DataFrame:
    """Links ``(a, b)`` that join every two of the distinct fingerprints
    ``fp`` whose distance is at most ``max_bits`` (0, 1 or 2): each pair that
    meets in a segment table, and in split buckets a star around the smallest
    fingerprint at a key, which keeps the reachability of all pairs without
    writing them."""
    if max_bits not in (0, 1, 2) or max_bits // segments > 1:
        raise ValueError("the segment balls here cover distances of 0 to 2 bits and radius 0 or 1")
    stored = segment_rows(codes, segments)
    full = keep(stored.groupBy("segment", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket)
                .select(F.col("segment").alias("s"), F.col("value").alias("v")), "simhash-full")
    in_full = (F.col("segment") == F.col("s")) & (F.col("value") == F.col("v"))
    table = stored.join(full, in_full, "left_anti").withColumnRenamed("fp", "other")
    bits = 64 // segments + (64 % segments > 0)  # the widest segment; a flip beyond one finds nothing
    probes = segment_rows(codes, segments).select(
        "fp", "segment", F.explode(ball(F.col("value"), bits, max_bits // segments)).alias("value"))
    met = probes.join(table, ["segment", "value"]).where("fp <> other")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= max_bits
    pairs = met.where(near).select(F.greatest("fp", "other").alias("a"), F.least("fp", "other").alias("b"))
    split = stored.join(full, in_full, "left_semi").select("fp").distinct()
    return pairs.union(_star_links(split, max_bits)).distinct()


def _star_links(codes: DataFrame, max_bits: int) -> DataFrame:
    """The links among fingerprints of split buckets, by balls of the whole code."""
    met = codes.select("fp", F.explode(ball(F.col("fp"), 64, min(max_bits, 1))).alias("code"))
    # the members of one key are each one bit from it and two bits apart; with
    # one bit allowed, only a member equal to the key may be a star's centre
    centre = F.col("fp") if max_bits == 2 else F.when(F.col("fp") == F.col("code"), F.col("fp"))
    star = met.select("fp", F.min(centre).over(Window.partitionBy("code")).alias("centre"))
    return (star.where("centre is not null and centre <> fp")
            .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("centre"))) <= max_bits)
            .select(F.greatest("fp", "centre").alias("a"), F.least("fp", "centre").alias("b")))


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 2,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Near-duplicate groups: ``(doc_id, fp, fingerprint, component_id)``, one
    row for each row of ``docs``.

    ``component_id`` is the smallest id that is reachable by links (the own id
    included).  Null and empty texts have fingerprint 0 and link as any
    other.  Rows with a null id link like others; their component is the
    smallest id other than null, or null.  Repeated rows each give a row.  An
    empty table gives an empty one; other columns of ``docs`` are not read.
    """
    prints = keep(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
                               shingle).select("doc_id", "fp"), "simhash")
    codes = keep(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-codes")
    comp = connected_components(fingerprint_links(codes.select("fp"), max_bits))
    named = codes.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component"))
    named = keep(named, "simhash-named")
    release(codes)
    lowest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_code = named.join(lowest, "component").select("fp", "component_id")
    return prints.join(by_code, "fp").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One document of each group stays: the one with the smallest id (null
    ids last), and one row of those that repeat this id.  Columns are those of
    ``docs``."""
    rows = with_row_id(docs)
    prints = keep(fingerprints(rows.select("__row", "doc_id", "text"), shingle)
                  .select("__row", "doc_id", "fp"), "simhash")
    codes = keep(prints.select("fp").distinct(), "simhash-codes")
    comp = connected_components(fingerprint_links(codes, max_bits))
    named = codes.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("component"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__row")).alias("first")
    # the first row of each fingerprint, then of each component: both sums are
    # combined map-side, so a group of any size is one row a task
    by_code = prints.groupBy("fp").agg(first)
    stay = by_code.join(named, "fp").groupBy("component").agg(F.min("first").alias("first")).select(
        F.col("first.__row").alias("__row"))
    return rows.join(stay, "__row", "left_semi").drop("__row")


ship(__name__)
