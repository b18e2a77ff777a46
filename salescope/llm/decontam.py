"""Benchmark decontamination by q-gram lemma filtering.

Texts and benchmark items are reduced to lower-cased letters and digits with
single spaces.  An item of ``n`` characters that occurs in a text with at most
``k`` edits shares at least ``n - q + 1 - k q`` of its q-grams with the text,
all within ``k + 1`` neighbouring diagonals (place in the text minus place in
the item).  Shared q-grams are counted in bands of ``2 (k + 1)`` diagonals that
overlap by half, so one band holds them all; bands with fewer are dropped, and
the regions of the others are verified by banded alignment of the whole item.

Of q-grams that very many items share (a common instruction) an item leaves
out up to half of what its bound asks for, and the bound is lowered by as many:
what is left out can't hide a match.

The q-grams of the benchmark go to every task, in blocks of at most
``BLOCK_CHARS`` characters: a larger benchmark takes more passes, never more
memory.  Documents are searched where they are; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.codes import SPACE, char_table, find, gram_hash, normalise
from salescope.llm.common import ship

Q = 10
#: Edits allowed, as a share of the item's characters.
EDIT_RATE = 0.05
#: Bound of what is sent to a task at once: characters of benchmark items.
BLOCK_CHARS = 4_000_000
#: Characters of text searched at once.
BATCH = 1 << 18
#: Shared q-grams written out at once.
HITS = 1 << 17
#: A q-gram with more places than this may be left out of the index.
COMMON = 64
SIEVE_BITS = 22
GAP = np.uint32(0)  # between texts; no item holds it


@dataclass
class Block:
    """Some benchmark items with their q-gram index."""
    ids: list
    items: list[np.ndarray]
    sizes: np.ndarray
    edits: np.ndarray
    need: np.ndarray
    table: np.ndarray
    keys: np.ndarray
    first: np.ndarray       # where a key's places begin
    item_of: np.ndarray     # places: item and offset
    offset_of: np.ndarray
    sieve: np.ndarray
    short: list[int]        # items below one q-gram

    def shared(self, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shared q-grams: start in ``line``, ascending, and key."""
        hashes = gram_hash(line, Q)
        may = np.flatnonzero(self.sieve[(hashes * _MIX) >> np.uint64(64 - SIEVE_BITS)])
        place, hit = find(self.keys, hashes[may])
        return may[hit] - Q + 1, place[hit]

    def regions(self, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bands with enough shared q-grams: item, first diagonal.

        A q-gram of many items has as many places; these are written out
        ``HITS`` at a time and counted by band.  Starts ascend, so a band that
        lies before them is complete: it is a region or is forgotten."""
        start, place = self.shared(line)
        times = self.first[place + 1] - self.first[place]
        cuts = np.searchsorted(np.cumsum(times), np.arange(HITS, int(times.sum()) + HITS, HITS), side="left") + 1
        found, keys, counts, last = [], np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        for cut in np.minimum(cuts, len(start)):
            if cut <= last:
                continue
            t = times[last:cut]
            run = np.repeat(self.first[place[last:cut]] - np.cumsum(t) + t, t)
            at = run + np.arange(int(t.sum()))
            item = self.item_of[at]
            band = (np.repeat(start[last:cut], t) - self.offset_of[at]) // (self.edits[item] + 1)
            # bands may begin before the line: shifted to stay positive
            new = np.concatenate([item * _SPAN + band + _SHIFT, item * _SPAN + band - 1 + _SHIFT])
            keys, of = np.unique(np.concatenate([keys, new]), return_inverse=True)
            counts = np.bincount(of, np.concatenate([counts, np.ones(len(new))]), len(keys)).astype(np.int64)
            last = int(cut)
            item = keys // _SPAN
            end = (keys % _SPAN - _SHIFT + 2) * (self.edits[item] + 1) + self.sizes[item]
            over = end < start[cut - 1] if last < len(start) else np.ones(len(keys), bool)
            found.append(keys[over & (counts >= self.need[item])])
            keys, counts = keys[~over], counts[~over]
        key = np.sort(np.concatenate([np.zeros(0, np.int64), *found]))
        item = key // _SPAN
        return item, (key % _SPAN - _SHIFT) * (self.edits[item] + 1)


_MIX = np.uint64(0xD6E8FEB86659FD93)
_SPAN, _SHIFT = 1 << 34, 1 << 32


def banded_alignment(item: np.ndarray, text: np.ndarray, edits: int) -> tuple[int, int, int]:
    """Fewest edits that turn ``item`` into a substring of ``text``, and the
    substring's start and end (of the first end with that count).  ``text`` is
    a band's region: the alignment may begin at each of its places and stays
    within its width.  Beyond ``edits`` the count is only known to be larger.
    """
    m, n = len(text), len(item)
    cost = np.zeros(m + 1, np.int32)
    begin = np.arange(m + 1, dtype=np.int32)
    places = np.arange(m + 1, dtype=np.int32)
    band = max(0, m - n) + 2 * edits  # a path that begins at place b keeps to b + i -/+ edits
    for i in range(n):
        lo, hi = max(0, i + 1 - edits), min(m, i + 1 + band)
        if lo > hi:
            return edits + 1, 0, 0
        new = np.full(m + 1, edits + 1 + n, np.int32)
        old = begin.copy()
        new[lo:hi + 1] = cost[lo:hi + 1] + 1
        a = max(lo, 1)
        match = cost[a - 1:hi] + (text[a - 1:hi] != item[i])
        better = match <= new[a:hi + 1]
        new[a:hi + 1] = np.where(better, match, new[a:hi + 1])
        begin[a:hi + 1] = np.where(better, old[a - 1:hi], old[a:hi + 1])
        # extra characters of the text: the best earlier cost plus the distance
        steps = new - places
        low = np.minimum.accumulate(steps)
        from_ = np.maximum.accumulate(np.where(steps == low, places, 0))
        begin = begin[from_]
        cost = low + places
        if cost[lo:hi + 1].min() > edits:
            return edits + 1, 0, 0
    end = int(cost.argmin())
    return int(cost[end]), int(begin[end]), end


def make_block(rows: list[tuple], edit_rate: float = EDIT_RATE) -> Block:
    """Index of (id, text) items; items without a letter or digit match nothing."""
    table = char_table(digits=True)
    ids, items = [], []
    for item_id, text in rows:
        codes, _, _ = normalise([text or ""], table)
        codes = codes[:-1] if len(codes) and codes[-1] == SPACE else codes
        if len(codes):
            ids.append(item_id)
            items.append(codes)
    size = np.array([len(x) for x in items], np.int64)
    # the budget is lowered where the lemma would ask for no shared q-gram
    edits = np.maximum(0, np.minimum((edit_rate * size).astype(np.int64), (size - Q) // Q))
    need = np.maximum(1, size - Q + 1 - edits * Q)
    hashes, of, offset = [], [], []
    for k, x in enumerate(items):
        if len(x) >= Q:
            h = gram_hash(x, Q)[Q - 1:]
            hashes.append(h)
            of.append(np.full(len(h), k))
            offset.append(np.arange(len(h)))
    flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    if hashes:
        of, offset = np.concatenate(of), np.concatenate(offset)
        left_out = _common_places(flat, of, need)
        need = need - np.bincount(of[left_out], minlength=len(need))
        flat, of, offset = flat[~left_out], of[~left_out], offset[~left_out]
    order = np.argsort(flat, kind="stable")
    keys, first = np.unique(flat[order], return_index=True)
    sieve = np.zeros(1 << SIEVE_BITS, bool)
    sieve[(keys * _MIX) >> np.uint64(64 - SIEVE_BITS)] = True
    none = np.zeros(0, np.int64)
    return Block(ids, items, size, edits, need, table, keys, np.append(first, len(flat)),
                 of[order] if hashes else none, offset[order] if hashes else none,
                 sieve, [k for k, x in enumerate(items) if len(x) < Q])


def _common_places(flat: np.ndarray, of: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Places that are left out of the index: of each item its most common
    q-grams (of an instruction that many items begin with), at most half of
    those that a match must share.  A match then shares so many fewer of the
    rest; the bound is lowered by them and nothing is lost."""
    _, key, number = np.unique(flat, return_inverse=True, return_counts=True)
    number = number[key]
    order = np.lexsort((-number, of))
    rank = np.arange(len(of)) - np.searchsorted(of, of[order])
    out = np.zeros(len(of), bool)
    out[order] = (number[order] > COMMON) & (rank < need[of[order]] // 2)
    return out


def search(block: Block, texts: list[str | None]) -> list[list[dict]]:
    """For each text its matches, the best place for each item: item (number
    in the block), edits, start, end (code points of the original text).
    Texts are searched in batches; a text longer than a batch piece by piece,
    each piece after the last characters before it that a match may need."""
    out: list[dict[int, dict]] = [{} for _ in texts]
    batch: list[int] = []
    total = 0
    reach = max((len(x) for x in block.items), default=0) + int(block.edits.max(initial=0)) + 1
    for i, t in enumerate(texts):
        if not t:
            continue
        if len(t) > BATCH:
            tail, tail_raw, spaced = np.zeros(0, np.uint32), np.zeros(0, np.int64), True
            for at in range(0, len(t), BATCH):
                codes, kept, _ = normalise([t[at:at + BATCH]], block.table, spaced)
                tail, tail_raw = np.concatenate([tail, codes]), np.concatenate([tail_raw, kept + at])
                _search_line(block, [i], tail, tail_raw, np.array([len(tail)]), out)
                tail, tail_raw = tail[-reach:], tail_raw[-reach:]
                spaced = not len(tail) or bool(tail[-1] == SPACE)
            continue
        batch.append(i)
        total += len(t)
        if total >= BATCH:
            _search_batch(block, texts, batch, out)
            batch, total = [], 0
    if batch:
        _search_batch(block, texts, batch, out)
    return [sorted(x.values(), key=lambda m: m["item"]) for x in out]


def _search_batch(block: Block, texts: list, batch: list[int], out: list[dict]) -> None:
    parts = [texts[i] for i in batch]
    codes, kept, lengths = normalise(parts, block.table)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    raw = kept - np.repeat(np.cumsum(sizes) - sizes, lengths)
    _search_line(block, batch, codes, raw, lengths, out)


def _search_line(block: Block, docs: list[int], codes: np.ndarray, raw: np.ndarray, lengths: np.ndarray,
                 out: list[dict]) -> None:
    """Search the normalised texts ``docs`` that lie one after another in
    ``codes``; ``raw``: where each code stands in its text."""
    at = np.arange(len(codes)) + np.repeat(np.arange(len(docs)), lengths)
    line = np.full(len(codes) + len(docs), GAP, np.uint32)
    line[at] = codes
    ends = np.cumsum(lengths + 1) - 1  # places of the gaps
    raw_at = np.zeros(len(line), np.int64)
    raw_at[at] = raw

    def note(doc: int, item: int, edits: int, start: int, end: int) -> None:
        found = {"item": int(item), "edits": int(edits), "start": int(raw_at[start]),
                 "end": int(raw_at[end - 1]) + 1}
        mine = out[docs[doc]]
        old = mine.get(found["item"])
        if old is None or (edits, found["start"]) < (old["edits"], old["start"]):
            mine[found["item"]] = found

    for item, diagonal in zip(*block.regions(line)):
        pattern, k = block.items[item], int(block.edits[item])
        lo, hi = int(diagonal), int(diagonal) + 2 * (k + 1) + len(pattern) + k
        # the text of the region's middle: a match holds it
        doc = int(np.searchsorted(ends, min(max(0, (lo + hi) // 2), len(line) - 1)))
        lo, hi = max(lo, int(ends[doc] - lengths[doc])), min(hi, int(ends[doc]))
        region = line[lo:hi]
        place = _find_codes(region, pattern)
        if place >= 0:
            note(doc, item, 0, lo + place, lo + place + len(pattern))
        elif k:
            edits, start, end = banded_alignment(pattern, region, k)
            if edits <= k and end > start:
                note(doc, item, edits, lo + start, lo + end)
    space = np.array([SPACE], np.uint32)
    for item in block.short:  # below one q-gram there is nothing to count: whole words, found as they stand
        wanted = np.concatenate([space, block.items[item], space])
        for doc in range(len(docs)):
            first = int(ends[doc] - lengths[doc])
            place = _find_codes(np.concatenate([space, line[first:ends[doc]], space]), wanted)
            if place >= 0:
                note(doc, item, 0, first + place, first + place + len(block.items[item]))


def _find_codes(where: np.ndarray, what: np.ndarray) -> int:
    """First place of ``what`` in ``where``, or -1."""
    where, what = where.tobytes(), what.tobytes()
    place = where.find(what)
    while place % 4 and place >= 0:
        place = where.find(what, place + 1)
    return place // 4 if place >= 0 else -1


def benchmark_blocks(benchmark: DataFrame, edit_rate: float = EDIT_RATE) -> Iterator[Block]:
    """The benchmark (``item_id, text``) in blocks of bounded size."""
    items = benchmark.select("item_id", "text").where("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + 2 * int(total) // BLOCK_CHARS if total > BLOCK_CHARS else 1
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) if blocks > 1 else items
        yield make_block([tuple(r) for r in part.orderBy("item_id", "text").collect()], edit_rate)


_MATCHES = "array<struct<item:int,edits:int,start:long,end:long>>"


def _with_matches(docs: DataFrame, block: Block, name: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(block)

    def column(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(search(sent.value, list(s)), dtype=object)

    column.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn(name, F.pandas_udf(column, _MATCHES)(F.col("text")))


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, edit_rate: float = EDIT_RATE) -> DataFrame:
    """``(doc_id, item_id, edits, start, end)``: every item found in every
    document (``doc_id, text``), with its best place in the original text.

    The edit budget of an item is ``edit_rate`` of its characters, less where
    the lemma needs it; items below one q-gram must occur as they are, as
    whole words.  Null and empty texts match nothing, null item texts too;
    null ids stay null; repeated rows and items each give rows.  Other columns
    are not read.  Empty tables give an empty one.
    """
    spark = docs.sparkSession
    kind = benchmark.schema["item_id"].dataType
    out = None
    for block in benchmark_blocks(benchmark, edit_rate):
        names = spark.createDataFrame([(k, x) for k, x in enumerate(block.ids)],
                                      f"item int, item_id {kind.simpleString()}")
        rows = (_with_matches(docs.select("doc_id", "text"), block, "found")
                .select("doc_id", F.explode("found").alias("m"))
                .select("doc_id", F.col("m.item").alias("item"), F.col("m.edits").alias("edits"),
                        F.col("m.start").alias("start"), F.col("m.end").alias("end"))
                .join(F.broadcast(names), "item").drop("item"))  # at most a block's items
        out = rows if out is None else out.union(rows)
    return out.select("doc_id", "item_id", "edits", "start", "end")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, edit_rate: float = EDIT_RATE) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    own = docs.columns
    for block in benchmark_blocks(benchmark, edit_rate):
        docs = _with_matches(docs, block, "__found").where(F.size("__found") == 0).select(
            *[F.col(f"`{c}`") for c in own])
    return docs


ship(__name__)
