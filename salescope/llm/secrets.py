"""Secret scan with multipart credential linking.

A text is searched for parts: plain finds (assignments, access ids, hex runs),
which count by themselves, and weak candidates (long mixed runs that may be a
secret key, service endpoints), which mean nothing alone.  A scope is a
paragraph (no blank line inside).  A weak candidate is reported only if a
complementary part stands in its scope, at most ``REACH`` characters away: for
a key an access id, an assignment or an endpoint, for an endpoint an access
id, an assignment or a key.

That is an interval join: a weak candidate covers the bins of ``REACH``
characters that it touches, a complement those within ``REACH`` characters of
it; they meet on (row, scope, bin), and the distance is verified.  Spans of a
kind do not overlap, so a bin holds few and the join follows the text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import keep, ship, with_row_id

#: Characters between a weak candidate and its complement, at most.
REACH = 1000

# The plain finds, their order and least lengths.
BASE_KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII)
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

# Weak candidates.
KEY = re.compile(r"(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{32,}={0,2}(?![A-Za-z0-9+/=])")
ENDPOINT = re.compile(r"(?:https?|s3|ftp|postgres|mysql|mongodb|redis|amqp)://[^\s\"'<>]+"
                      r"|(?<![\w.-])(?:[a-z0-9-]+\.)*(?:amazonaws|azure|googleapis)\.com(?![\w-])")
KEY_BITS = 3.5
SCOPE_BREAK = re.compile(r"\n[ \t\r]*\n")

PART = "array<struct<start:bigint,rank:int,kind:string,end:bigint,scope:int>>"
RANK = {"assign": 0, "access": 1, "hex": 2, "key": 3, "endpoint": 4}


def entropy(s: str) -> float:
    """Bits a character, from the string's own frequencies."""
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in (s.count(x) for x in set(s)))


def find_parts(text: str | None) -> list[tuple[int, int, str, int, int]]:
    """All parts as (start, rank, kind, end, scope), by start and rank.
    Offsets are code points, ends exclusive.  Null: none."""
    if not text:
        return []
    low = text.lower()
    found = []
    if any(k in low for k in ("passw", "secret", "token", "api")):
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text)
                  if len(m.group(2)) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= ACCESS_LENGTH]
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    found += [(m.start(), "key", m.end()) for m in KEY.finditer(text)
              if len(set(map(str.isdigit, m.group()))) == 2 and not HEX.fullmatch(m.group())
              and entropy(m.group()) >= KEY_BITS]
    if "://" in text or ".com" in text:
        found += [(m.start(), "endpoint", m.end()) for m in ENDPOINT.finditer(text)]
    breaks = [m.start() for m in SCOPE_BREAK.finditer(text)] if found else []
    out, scope = [], 0
    for start, kind, end in sorted(found, key=lambda x: (x[0], RANK[x[1]])):
        while scope < len(breaks) and breaks[scope] < start:
            scope += 1
        out.append((start, RANK[kind], kind, end, scope))
    return out


def linked_candidates(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """The weak candidates of ``parts`` (``__row, start, rank, kind, end,
    scope``) that have a complement: not inside an access id or assignment,
    and within ``reach`` of one, or of a part of the other weak kind that does
    not hold it and is not inside it."""
    bins = lambda lo, hi: F.explode(F.sequence(F.floor(lo / reach), F.floor(hi / reach)))
    weak = parts.where(F.col("rank") >= len(BASE_KINDS)).withColumn("bin", bins(F.col("start"), F.col("end")))
    other = parts.where("kind <> 'hex'").select(
        "__row", "scope", F.col("start").alias("s"), F.col("end").alias("e"), F.col("kind").alias("by"),
        bins(F.col("start") - reach, F.col("end") + reach).alias("bin"))
    near = (F.col("start") - F.col("e") <= reach) & (F.col("s") - F.col("end") <= reach)
    inside = (F.col("s") <= F.col("start")) & (F.col("end") <= F.col("e"))
    holds = (F.col("start") <= F.col("s")) & (F.col("e") <= F.col("end"))
    plain = F.col("by").isin("assign", "access")
    met = weak.join(other, ["__row", "scope", "bin"]).where((F.col("by") != F.col("kind")) & near)
    return (met.groupBy("__row", "start", "rank", "kind", "end", "scope")
            .agg(F.max(plain & inside).alias("inner"), F.max(~inside & ~holds | plain & ~inside).alias("linked"))
            .where("linked and not inner").drop("linked", "inner"))


def scan_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, base, linked``, arrays of
    (start, rank, kind, end, scope) in order.

    ``base``: the plain finds, ``linked``: the weak candidates with a
    complementary part in their scope.  Null and empty texts give empty arrays;
    repeated rows each give a row, null ids stay null, an empty table gives an
    empty one.  Only ``doc_id`` and ``text`` are read.
    """

    def parts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = ("start", "rank", "kind", "end", "scope")
        for s in batches:
            yield pd.Series([[dict(zip(names, p)) for p in find_parts(t)] for t in s], dtype=object)

    parts.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    rows = keep(with_row_id(docs).select("__row", "doc_id", F.pandas_udf(parts, PART)("text").alias("parts")),
                "secret-parts")
    base_kind = lambda p: p["rank"] < len(BASE_KINDS)
    mixed = rows.where(F.exists("parts", lambda p: ~base_kind(p)))
    each = mixed.select("__row", F.explode("parts").alias("p")).select("__row", "p.*")
    linked = linked_candidates(each, reach).groupBy(F.col("__row").alias("__of")).agg(F.array_sort(F.collect_list(
        F.struct("start", "rank", "kind", "end", "scope"))).alias("linked"))
    return rows.join(linked, F.col("__row") == F.col("__of"), "left").select(
        "doc_id", F.filter("parts", base_kind).alias("base"),
        F.coalesce("linked", F.array().cast(PART)).alias("linked"))


ship(__name__)
