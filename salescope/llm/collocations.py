"""Phrase collocation mining over a prefix-free parse.

Texts are cut into pieces (at punctuation and line ends) and pieces into
chunks: a chunk ends with a window of ``OVERLAP`` words whose hash is 0 modulo
``TRIGGER``, and the next chunk starts with the same window.  Where a chunk is
cut depends on the words alone, so repeated passages give repeated chunks
however they are shifted.  The distinct chunks with their parse frequencies
are the dictionary.  A phrase of up to ``OVERLAP + 1`` words belongs to the
chunk in which it starts before the closing window (``own`` words of a chunk
are starts), so each occurrence is counted in exactly one chunk, and counts
are sums over distinct chunks weighted by their frequencies.

Words are counted first, then phrases of two words, then the longer ones.  A
phrase cannot be more frequent than its parts, so only those are written whose
words (whose parts of two words, for the longer) may all be frequent.  This is
asked from a bit table of fixed size (``FILTER_BITS``) over hashes of the
frequent parts: a false answer costs rows, never counts, which are of the words
themselves.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.llm.common import keep, release, ship

MAX_WORDS = 4
OVERLAP = MAX_WORDS - 1
#: A window closes a chunk with this chance (a power of two).
TRIGGER = 16
#: Longer stretches without a trigger are cut every so many words.
LONGEST = 4096
MIN_COUNT = 30
ABSORB = 80
SCORE_SCALE = 2_000_000
FIRST = 2000
#: Bytes of text handled at a time; longer texts go piece by piece.
SEGMENT = 1 << 20
FILTER_BITS = 1 << 26
#: Candidates of a language that one task puts in order.
SORTED_BY_ONE = 100_000
#: Different phrases that a task counts before it hands them on.
FLUSH = 100_000

BREAKS = b".,;:!?\n\v\f\r"
_KIND = np.zeros(256, np.uint8)  # 0: of a word, 1: between words, 2: between pieces
_KIND[list(b" \t")] = 1
_KIND[list(BREAKS)] = 2
_ONE_SPACE = bytes.maketrans(b"\t", b" ")
_BASE = 0x9E3779B97F4A7C15 | 1
_ROOT = pow(_BASE, -1, 1 << 64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64, ``n`` at least."""
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _powers:
        _powers.clear()
        tables = []
        for b in (_BASE, _ROOT):
            t = np.ones(size, np.uint64)
            at = 1
            while at < size:  # doubling: the second half is the first times b ** at
                t[at:2 * at] = t[:at] * np.uint64(pow(b, at, 1 << 64))
                at *= 2
            tables.append(t)
        _powers[size] = tuple(tables)
    return _powers[size]


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def words_of(data: np.ndarray, edges: np.ndarray | None = None):
    """Starts, ends, hashes and pieces of the words of ``data`` (bytes).
    ``edges``: places at which another piece starts without a break."""
    kind = _KIND[data]
    word = kind == 0
    before = np.zeros(len(word), bool)
    before[1:] = word[:-1]
    after = np.zeros(len(word), bool)
    after[:-1] = word[1:]
    breaks = kind == 2
    if edges is not None and len(edges):
        before[edges[edges < len(word)]] = False
        after[edges[edges > 0] - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=sums[1:])
    hashes = _mix((sums[ends] - sums[starts]) * inverse[starts])
    if edges is None:
        piece = np.cumsum(breaks)[starts] if len(starts) else starts
    else:
        piece = np.searchsorted(edges, starts, side="right")
    return starts, ends, hashes, piece


def _longer(h: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of all its words but the last."""
    return _mix(h * np.uint64(_BASE) + last)


def phrase_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each place on (of the places that have
    them in the array)."""
    out = hashes[:max(0, len(hashes) - n + 1)]
    for k in range(1, n):
        out = _longer(out, hashes[k:k + len(out)])
    return out


def chunk_cuts(hashes: np.ndarray, piece: np.ndarray, trigger: int = TRIGGER,
               longest: int = LONGEST) -> np.ndarray:
    """The first words of all chunks: of pieces, of trigger windows, and every
    ``longest`` words from one of these to the next."""
    n = len(hashes)
    first = np.ones(n, bool)
    first[1:] = piece[1:] != piece[:-1]
    window = phrase_hashes(hashes, OVERLAP)
    hit = np.zeros(n, bool)
    hit[:len(window)] = (window & np.uint64(trigger - 1) == 0) & (piece[:len(window)] == piece[OVERLAP - 1:])
    cuts = np.flatnonzero(first | hit)
    gaps = np.diff(np.append(cuts, n))
    if len(gaps) and gaps.max() > longest:
        more = [np.arange(c + longest, c + g, longest) for c, g in zip(cuts, gaps) if g > longest]
        cuts = np.sort(np.concatenate([cuts, *more]))
    return cuts


def _chunks(buf: bytes, whole: bool, trigger: int) -> tuple[list[tuple[int, int, int]], int]:
    """(start, end, own words) of the chunks of ``buf``, words one space apart,
    and the place where the parse goes on: the end, or with ``whole`` false
    (a piece that the buffer cuts off) the last chunk's start."""
    starts, ends, hashes, piece = words_of(np.frombuffer(buf, np.uint8))
    if not len(starts):
        return [], len(buf)
    cuts = chunk_cuts(hashes, piece, trigger)
    rest = len(buf)
    nexts = np.append(cuts[1:], len(starts))
    last = np.searchsorted(piece, piece[cuts], side="right")  # one past the piece's last word
    if not whole:
        # the last chunks may go on beyond the buffer: they need their overlap
        done = nexts + OVERLAP <= len(starts)
        rest = int(starts[cuts[~done][0]]) if not done.all() else len(buf)
        cuts, nexts, last = cuts[done], nexts[done], last[done]
    end = ends[np.minimum(nexts + OVERLAP, last) - 1]
    return list(zip(starts[cuts].tolist(), end.tolist(), (nexts - cuts).tolist())), rest


def parse_text(text: bytes, trigger: int = TRIGGER, segment: int = SEGMENT) -> Iterator[tuple[bytes, int]]:
    """The chunks of one text, (words one space apart, own words), whatever its
    length: at most about ``segment`` bytes are worked on at a time."""
    pos, take = 0, segment
    while pos < len(text):
        end = pos + take
        whole = end >= len(text)
        if not whole:
            brk = max(text.rfind(b, pos + 1, end) for b in (BREAKS[i:i + 1] for i in range(len(BREAKS))))
            whole = brk > 0
            end = brk if whole else text.rfind(b" ", pos + 1, end)
            if end <= pos:  # one word fills the segment
                take *= 2
                continue
        part = text[pos:end]
        found, rest = _chunks(part, whole, trigger)
        for a, b, own in found:
            yield part[a:b], own
        take = segment if found or whole else take * 2
        pos = end if whole else pos + rest


def normal_bytes(text: str | None) -> bytes:
    """A-Z lower-cased, runs of blanks and tabs made one blank."""
    out = (text or "").encode("utf-8", "surrogatepass").lower().translate(_ONE_SPACE)
    while b"  " in out:
        out = out.replace(b"  ", b" ")
    return out


def parse_dictionary(docs: DataFrame, trigger: int = TRIGGER, text: str = "text",
                     lang: str = "lang") -> DataFrame:
    """The dictionary ``(lang, chunk, own, freq)`` of ``docs``."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for name, value in zip(batch.column("lang"), batch.column("text")):
                name, whole = name.as_py(), normal_bytes(value.as_py())
                for at in parse_text(whole, trigger):
                    seen[(name, *at)] += 1
                if len(seen) > FLUSH:
                    yield dictionary_rows(seen)
                    seen = Counter()
            if seen:
                yield dictionary_rows(seen)

    def dictionary_rows(seen: Counter) -> pa.RecordBatch:
        names, chunks, own = zip(*seen)
        return pa.record_batch({
            "lang": pa.array(names, pa.string()), "chunk": pa.array(chunks, pa.binary()).cast(pa.string()),
            "own": pa.array(own, pa.int32()), "freq": pa.array(list(seen.values()), pa.int64())})

    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text).alias("text")).where("text is not null")
    parsed = rows.mapInArrow(parse, "lang string, chunk string, own int, freq long")
    return parsed.groupBy("lang", "chunk", "own").agg(F.sum("freq").alias("freq"))


def _seeded(hashes: np.ndarray, langs: list, of_chunk: np.ndarray) -> np.ndarray:
    """Word hashes that differ by language."""
    seed = {name: np.uint64(int.from_bytes(name.encode("utf-8", "surrogatepass")[:64], "little")
                            * _BASE + len(name) & 0xFFFFFFFFFFFFFFFF) for name in set(langs)}
    return _mix(hashes ^ np.array([seed[x] for x in langs], np.uint64)[of_chunk])


def _slices(batch: pa.RecordBatch, name: str, segment: int = SEGMENT) -> Iterator[tuple]:
    """Parts of a batch of about ``segment`` bytes of the string column
    ``name`` (one row at least): the rows, their bytes together, and the places
    at which they start and end."""
    col = batch.column(name).cast(pa.large_binary())
    at = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    first = 0
    while first < len(col):
        last = max(first + 1, int(np.searchsorted(at, at[first] + segment, side="right")) - 1)
        data = memoryview(col.buffers()[2])[at[first]:at[last]].tobytes()
        yield batch.slice(first, last - first), data, at[first:last + 1] - at[first]
        first = last


def phrase_filter(frequent: DataFrame, n: int, bits: int = FILTER_BITS) -> np.ndarray:
    """A bit table of the hashes of frequent phrases of ``n`` words, as 64-bit
    words.  Set bits are gathered in the tasks; the table's size is fixed."""
    shift = np.uint64(64 - bits.bit_length() + 1)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, data, at in (part for batch in batches for part in _slices(batch, "phrase")):
            _, _, hashes, row = words_of(np.frombuffer(data, np.uint8), at[:-1])
            hashes = _seeded(hashes, b.column("lang").to_pylist(), row - 1)
            hashes = phrase_hashes(hashes, n)[np.searchsorted(row, np.arange(1, b.num_rows + 1))]
            place = (hashes >> shift).astype(np.int64)
            yield pa.record_batch({"word": pa.array(place >> 6),
                                   "bit": pa.array(np.left_shift(np.int64(1), place & 63))})

    rows = frequent.select("lang", "phrase").mapInArrow(places, "word long, bit long").groupBy("word").agg(
        F.bit_or("bit").alias("bits"))
    table = np.zeros(bits // 64, np.int64)
    got = rows.toArrow()  # at most bits / 64 rows
    table[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return table.view(np.uint64)


def count_phrases(dictionary: DataFrame, lengths: tuple, k: int, parts: np.ndarray) -> DataFrame:
    """``(key, f)`` of the phrases of ``lengths`` words all of whose parts of
    ``k`` words pass the bit table ``parts``; not yet cut at a count.  The key
    is the language, a line end and the phrase."""
    sent = dictionary.sparkSession.sparkContext.broadcast(parts)
    shift = np.uint64(64 - (len(parts) * 64).bit_length() + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen, size = sent.value, {}, 0
        for b, data, at in (part for batch in batches for part in _slices(batch, "chunk")):
            langs = b.column("lang").to_pylist()
            starts, ends, hashes, row = words_of(np.frombuffer(data, np.uint8), at[:-1])
            row = row - 1
            place = np.arange(len(row)) - np.searchsorted(row, np.arange(b.num_rows))[row]
            mine = place < b.column("own").to_numpy()[row]
            short = phrase_hashes(_seeded(hashes, langs, row), k) >> shift
            may = (table[short >> np.uint64(6)] >> (short & np.uint64(63)) & np.uint64(1)).astype(bool)
            freqs = b.column("freq").to_numpy()
            for n in lengths:
                m = max(0, len(row) - n + 1)
                ok = mine[:m] & (row[:m] == row[n - 1:])
                for j in range(n - k + 1):
                    ok &= may[j:j + m]
                i = np.flatnonzero(ok)
                for a, e, r, f in zip(starts[i].tolist(), ends[i + n - 1].tolist(), row[i].tolist(),
                                      freqs[row[i]].tolist()):
                    of = seen.setdefault((langs[r], n), {})
                    p = data[a:e]
                    of[p] = of.get(p, 0) + f
            size = sum(map(len, seen.values()))
            if size > FLUSH:
                yield from phrase_rows(seen)
                seen, size = {}, 0
        if size:
            yield from phrase_rows(seen)

    def phrase_rows(seen: dict) -> Iterator[pa.RecordBatch]:
        # one text as key (a phrase has no line end): rows half as wide to group
        for (name, n), of in seen.items():
            head = name.encode("utf-8", "surrogatepass") + b"\n"
            yield pa.record_batch({"key": pa.array([head + p for p in of], pa.binary()).cast(pa.string()),
                                   "f": pa.array(list(of.values()), pa.int64())})

    return dictionary.mapInArrow(count, "key string, f long").groupBy("key").agg(F.sum("f").alias("f"))


def _named(found: DataFrame) -> DataFrame:
    """``lang, phrase, f`` of rows by key: the phrase is what stands after the
    last line end."""
    phrase = F.substring_index("key", "\n", -1)
    lang = F.expr("substring(key, 1, length(key) - length(substring_index(key, '\n', -1)) - 1)")
    return found.select(lang.alias("lang"), phrase.alias("phrase"), "f")


def frequent_phrases(dictionary: DataFrame, min_count: int = MIN_COUNT) -> list[DataFrame]:
    """Tables ``(lang, phrase, f)`` of the phrases of 1, 2, ... ``MAX_WORDS``
    words that occur ``min_count`` times; stops after an empty one."""
    own = F.slice(F.split("chunk", " "), F.lit(1), F.col("own"))
    words = dictionary.select("lang", F.explode(own).alias("phrase"), "freq").groupBy("lang", "phrase").agg(
        F.sum("freq").alias("f"))
    out = [keep(words.where(F.col("f") >= min_count), "phrases-1")]
    # the longer ones in one pass: it costs a few rows more than a pass each
    for lengths in ((2,), tuple(range(3, MAX_WORDS + 1))):
        parts = phrase_filter(out[-1], len(out))
        if not parts.any():
            break
        counted = count_phrases(dictionary, lengths, len(out), parts).where(F.col("f") >= min_count)
        found = keep(_named(counted).withColumn("words", F.size(F.split("phrase", " "))), f"phrases-{lengths[0]}")
        out += [found.where(F.col("words") == n).select("lang", "phrase", "f") for n in lengths]
    return out


def _absorbed(tables: list[DataFrame]) -> DataFrame:
    """``(lang, phrase, most)``: the greatest count of a longer phrase around."""
    around = None
    for n, t in enumerate(tables, start=2):
        for k in range(2, n):
            words = F.split("phrase", " ")
            for at in range(n - k + 1):
                part = t.select("lang", F.array_join(F.slice(words, at + 1, k), " ").alias("phrase"), "f")
                around = part if around is None else around.union(part)
    return around.groupBy("lang", "phrase").agg(F.max("f").alias("most"))


def _best_cut(tables: list[DataFrame]) -> DataFrame:
    """Candidates with the counts and score of their lowest-scoring cut."""
    parts = [t.select("lang", F.col("phrase").alias("part"), F.col("f")) for t in tables[:-1]]
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.union(p)
    words = F.split("phrase", " ")
    cuts = None
    for n, t in enumerate(tables[1:], start=2):
        for k in range(1, n):
            c = t.select("lang", "phrase", F.col("f").alias("a"), F.lit(k).alias("k"),
                         F.array_join(F.slice(words, 1, k), " ").alias("first"),
                         F.array_join(F.slice(words, k + 1, n - k), " ").alias("rest"))
            cuts = c if cuts is None else cuts.union(c)
    left = counts.select(F.col("lang").alias("l1"), F.col("part").alias("p1"), F.col("f").alias("l"))
    right = counts.select(F.col("lang").alias("l2"), F.col("part").alias("p2"), F.col("f").alias("r"))
    met = cuts.join(left, (F.col("lang") == F.col("l1")) & (F.col("first") == F.col("p1"))).join(
        right, (F.col("lang") == F.col("l2")) & (F.col("rest") == F.col("p2")))
    wide = lambda c: f"cast({c} as decimal(20,0))"  # noqa: E731  products may pass 64 bits
    score = F.expr(f"({wide('a')} * {SCORE_SCALE}) div ({wide('l')} + {wide('r')})").cast("long")
    cut = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    return met.groupBy("lang", "phrase", "a").agg(cut.alias("cut")).select("lang", "phrase", "a", "cut.*")


def _first_of_each(rows: DataFrame, first: int, by_one: int) -> DataFrame:
    """``rank`` and the ``first`` rows of each language, in order.  A language
    with many rows is first cut to the best of each of several parts."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    while True:
        sizes = rows.groupBy(F.col("lang").alias("of")).agg(F.count(F.lit(1)).alias("size"))
        parts = F.ceil(F.col("size") / max(by_one, 4 * first)).cast("int")
        sizes = keep(sizes.select("of", parts.alias("parts")).where("parts > 1"), "phrase-parts")
        if sizes.isEmpty():
            break
        salted = rows.join(sizes, F.col("lang") == F.col("of"), "left").withColumn(
            "part", F.pmod(F.xxhash64("phrase"), F.coalesce("parts", F.lit(1))))
        best = Window.partitionBy("lang", "part").orderBy(*order)
        rows = keep(salted.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= first)
                    .drop("rank", "of", "parts", "part"), "phrase-best")
    at = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return rows.withColumn("rank", at).where(F.col("rank") <= first)


def mine_collocations(docs: DataFrame, min_count: int = MIN_COUNT, first: int = FIRST, absorb: int = ABSORB,
                      trigger: int = TRIGGER, sorted_by_one: int = SORTED_BY_ONE) -> DataFrame:
    """The ``first`` phrases of each language by score: ``lang, rank, phrase,
    a, l, r, n, score``.

    Texts are lower-cased in A-Z; null texts count as empty, null languages as
    ``und``.  Candidates are phrases of 2 to ``MAX_WORDS`` words inside pieces
    that occur ``min_count`` times or more (overlaps included) in the
    language; the score is the least of ``floor(2000000 a / (l + r))`` over
    the cuts (ties: the earliest), and candidates inside a longer one with at
    least ``absorb`` percent of their count go.  Ties: more frequent first,
    then by phrase.  Repeated rows count as often as they occur.  No text or
    no candidate: an empty table.  Only ``text`` and ``lang`` are read.
    """
    dictionary = keep(parse_dictionary(docs, trigger), "phrase-dictionary")
    tables = frequent_phrases(dictionary, min_count)
    totals = dictionary.groupBy(F.col("lang").alias("of")).agg(
        F.sum(F.col("own") * F.col("freq")).alias("n"))
    numbers: list[Column] = [F.col(c).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")]
    if len(tables) < 2:
        none = totals.where("false").select(F.col("of").alias("lang"), F.lit(0).cast("long").alias("rank"),
                                            F.lit("").alias("phrase"), *[F.lit(0).cast("long").alias(c) for c in (
                                                "a", "l", "r", "n", "score")])
        return none
    scored = _best_cut(tables)
    if len(tables) > 2:
        longer = _absorbed(tables[1:]).select(F.col("lang").alias("of"), F.col("phrase").alias("inner"), "most")
        scored = scored.join(longer, (F.col("lang") == F.col("of")) & (F.col("phrase") == F.col("inner")), "left").where(
            F.col("most").isNull() | (F.expr("cast(most as decimal(20,0)) * 100")
                                      < F.col("a").cast("decimal(20,0)") * absorb))
    scored = keep(scored.select("lang", "phrase", "a", "l", "r", "score"), "phrase-scores")
    totals = keep(totals, "phrase-totals")
    release(dictionary)
    best = _first_of_each(scored, first, sorted_by_one)
    return best.join(totals, F.col("lang") == F.col("of")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", *numbers)


ship(__name__)
