"""LM scoring with a probabilistic suffix tree.

Symbols are tokens: the words of a text and one end.  A context is up to
``DEPTH`` tokens before a symbol (the start of the text counts as a token).
Grams (a context and its next symbol) that occur ``MIN_COUNT`` times are
listed, whatever the size of the corpus, and a context with listed symbols is
kept if its own next-symbol distribution tells more than that of its suffix:
the gain in log likelihood, ``N(s)`` times the divergence of the two
distributions over the training tokens, must pay for its parameters at half the
log of the number of training tokens each (minimum description length).
Suffixes of kept contexts are kept.  Distributions are smoothed: what a
context's listed next symbols leave goes to the distribution of its suffix,
and the root is the add-0.1 unigram distribution over all words.  A symbol is
scored in the state of the longest kept suffix of what stands before it.

All counts are over all training texts and all words, so the tree grows with
the corpus.  It is cut at its first edges: all symbols (of training and scored
texts) after the same token go to one task, packed with up to ``DEPTH`` tokens before
them; it grows the branches of its contexts and scores its symbols in them, and only sums by
text leave it.  A context with more than ``HOT_ENTRIES`` symbols after it is
cut again at its next edges; the counts of its grams, like those of words without a
number, are added up by key and told to the blocks of texts that have them, so that no
task holds all symbols of a frequent context.  The tree of a small corpus of
numbered words is grown on the driver, with the same result.
"""

from __future__ import annotations

import gc
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm.codes import find
from salescope.llm.common import keep, release, ship

DEPTH = 3
#: Occurrences from which a gram is listed.
MIN_COUNT = 2
#: Training tokens up to which the tree is grown on the driver.
LOCAL_TOKENS = 1_000_000
#: Symbols after a context up to which they stay together; a context with more is hot.
HOT_ENTRIES = 1_000_000
#: Tokens of a block of texts, and symbols of a part of the tree, about.
BLOCK, PART = 1 << 19, 1 << 20
#: Shares of the tree that are grown one after the other.
WAVES = 3
#: Words with a number of their own (two bytes, two numbers are taken).
HOT_WORDS = 65_534
RARE, EDGE = 0, 65_535  # other words; the start (as context) and end (as symbol) of a text
ADD = 0.1
#: Different entries that a task gathers before it hands them on.
FLUSH, FLUSH_GRAMS = 200_000, 2_000_000
#: Tokens handled at a time.
BATCH = 1 << 18
BITS = np.uint64(16)
#: Key of the empty context.
NO_CONTEXT = 0x9E3779B97F4A7C15


def tokens(text: str | None) -> list[bytes]:
    """ASCII-lower-cased words of a text, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_counts(texts: DataFrame) -> DataFrame:
    """``(word, n)`` over all rows of ``texts`` (``text``); the number of texts
    stands at a null word.  Tasks hand on bounded parts, summed by word."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: Counter = Counter()
        n_texts = 0
        for b in batches:
            for t in b["text"]:
                words.update(tokens(t))
                if len(words) >= FLUSH:
                    yield pd.DataFrame({"word": list(words), "n": list(words.values())})
                    words.clear()
            n_texts += len(b)
        if words:
            yield pd.DataFrame({"word": list(words), "n": list(words.values())})
        if n_texts:
            yield pd.DataFrame({"word": [None], "n": [n_texts]})

    return (texts.select("text").mapInPandas(count, "word binary, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


@dataclass
class SuffixTree:
    """By depth (0 is the root and empty): kept contexts with the log of the
    weight they give to their suffix, and their listed (context, symbol) grams
    with the log of the symbol's probability over its probability at the root."""
    contexts: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0, np.uint64)])
    weights: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0)])
    grams: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0, np.uint64)])
    gains: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0)])

    def log_ratios(self, line: np.ndarray, at: np.ndarray) -> np.ndarray:
        """ln P(symbol | longest kept context) / P(symbol at the root)."""
        out = np.zeros(len(at))
        levels = []  # by depth: the places that have a kept context of it
        inside = np.arange(len(at))
        keys = np.zeros(len(at), np.uint64)
        for d in range(1, len(self.contexts)):
            keys = keys | line[at[inside] - d].astype(np.uint64) << BITS * np.uint64(d - 1)
            place, hit = find(self.contexts[d], keys)
            inside, keys, place = inside[hit], keys[hit], place[hit]
            levels.append((inside, keys, place))
        open_ = np.ones(len(at), bool)
        for d in range(len(levels), 0, -1):
            inside, keys_here, place = levels[d - 1]
            todo = open_[inside]
            inside, keys_here, place = inside[todo], keys_here[todo], place[todo]
            gram, hit = find(self.grams[d], keys_here << BITS | line[at[inside]].astype(np.uint64))
            out[inside[hit]] += self.gains[d][gram[hit]]
            out[inside[~hit]] += self.weights[d][place[~hit]]
            open_[inside[hit]] = False
        return out

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """Summed natural-log ratios of each text of word numbers, its end included."""
        line, at, sizes = symbol_line(texts)
        return np.add.reduceat(self.log_ratios(line, at), np.cumsum(sizes) - sizes)


def symbol_line(texts: list[np.ndarray], kind: type = np.uint16) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one line, each after ``DEPTH`` starts and before its end:
    (line, places of the symbols to predict, symbols of each text)."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    line = np.full(int(sizes.sum()) + DEPTH * len(texts), EDGE, kind)
    at = np.arange(int(sizes.sum())) + np.repeat(DEPTH * (1 + np.arange(len(texts))), sizes)
    last = np.cumsum(sizes) - 1
    words = np.ones(len(at), bool)
    words[last] = False
    line[at[words]] = np.concatenate(texts) if texts else np.zeros(0, kind)
    return line, at, sizes


def _batches(ids: list[bytes]) -> Iterator[list[np.ndarray]]:
    out, total = [], 0
    for x in ids:
        out.append(np.frombuffer(x, "<u2"))
        total += len(out[-1])
        if total >= BATCH:
            yield out
            out, total = [], 0
    if out:
        yield out


def gram_counts(ids: DataFrame, depth: int, shorter: np.ndarray) -> DataFrame:
    """``(gram, n)``: counts of the grams of ``depth`` context tokens and a
    symbol, over rows of ``ids`` (word numbers as bytes), where the first and
    the last ``depth`` tokens are grams listed in ``shorter`` (sorted)."""
    sent = ids.sparkSession.sparkContext.broadcast(shorter)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        low = np.uint64((1 << 16 * depth) - 1)
        gathered: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys = np.concatenate([k for k, _ in gathered])
            order = np.argsort(keys)
            keys, n = keys[order], np.concatenate([n for _, n in gathered])[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            return keys[first], np.add.reduceat(n, first)

        def hand_on() -> pd.DataFrame:
            keys, n = merged()
            gathered.clear()
            return pd.DataFrame({"gram": keys.view(np.int64), "n": n})

        for b in batches:
            for texts in _batches(list(b["ids"])):
                line, at, _ = symbol_line(texts)
                keys = line[at].astype(np.uint64)
                for d in range(1, depth + 1):
                    keys |= line[at - d].astype(np.uint64) << BITS * np.uint64(d)
                keys = keys[find(sent.value, keys >> BITS)[1]]
                keys = keys[find(sent.value, keys & low)[1]]
                if not len(keys):
                    continue
                gathered.append(np.unique(keys, return_counts=True))
                size += len(gathered[-1][0])
                if size >= FLUSH_GRAMS:
                    gathered[:] = [merged()]
                    size = len(gathered[0][0])
                    if size >= FLUSH_GRAMS // 2:
                        yield hand_on()
                        size = 0
        if gathered:
            yield hand_on()

    return (ids.select("ids").mapInPandas(count, "gram long, n long")
            .groupBy("gram").agg(F.sum("n").alias("n")))


def grow_tree(levels: list[tuple[np.ndarray, np.ndarray]], total: int, root: np.ndarray,
              sizes: list[dict[int, float]]) -> SuffixTree:
    """The tree from listed grams by depth (sorted keys and counts; depth 1
    first), the log probabilities of the symbols at the root by number, and by
    depth the counts of the contexts that may be kept."""
    tree = SuffixTree()
    price = 0.5 * np.log(max(total, 2))
    worth = [np.zeros(0, bool)]
    for d, ((grams, n), size_of) in enumerate(zip(levels, sizes), 1):
        of_gram = grams >> BITS
        ctx = np.array(sorted(size_of), np.uint64)
        size = np.array([size_of[int(c)] for c in ctx], np.float64)
        at, known = find(ctx, of_gram)
        grams, n, at = grams[known], n[known].astype(np.float64), at[known]
        listed = np.bincount(at, minlength=len(ctx))
        mass = np.bincount(at, n, minlength=len(ctx))
        weight = np.maximum(1 - mass / (size + listed + 1), 1e-12)
        # the symbol's log ratio in the suffix of its context
        line = np.array([(int(g) >> 16 * j) & 0xFFFF for g in grams for j in range(d, -1, -1)], np.uint16)
        place = np.arange(len(grams)) * (d + 1) + d
        below = tree.log_ratios(line, place) if d > 1 else np.zeros(len(grams))
        in_root = root[(grams & np.uint64(0xFFFF)).astype(np.int64)]
        p = n / (size + listed + 1)[at] + weight[at] * np.exp(below + in_root)
        ratio = np.log(p) - in_root
        gain = np.bincount(at, n * (ratio - below), minlength=len(ctx)) + (size - mass) * np.log(weight)
        worth.append((listed > 0) & (gain >= price * (listed + 1)))
        tree.contexts.append(ctx)
        tree.weights.append(np.log(weight))
        tree.grams.append(grams)
        tree.gains.append(ratio)
    for d in range(len(worth) - 1, 1, -1):
        suffix = np.unique(tree.contexts[d][worth[d]] & np.uint64((1 << 16 * (d - 1)) - 1))
        worth[d - 1] |= np.isin(tree.contexts[d - 1], suffix)
    for d in range(1, len(worth)):
        at, known = find(tree.contexts[d], tree.grams[d] >> BITS)
        stays = known & worth[d][at] if len(worth[d]) else known
        tree.grams[d], tree.gains[d] = tree.grams[d][stays], tree.gains[d][stays]
        tree.contexts[d], tree.weights[d] = tree.contexts[d][worth[d]], tree.weights[d][worth[d]]
    return tree


def fit_tree(ids: DataFrame, hot: np.ndarray, n_texts: int, total: int, root: np.ndarray,
             least: int = MIN_COUNT) -> SuffixTree:
    """The tree over training rows ``ids`` on the driver; ``hot``: counts of
    the numbered words (by number, from 1)."""
    count = {i: float(c) for i, c in enumerate(hot, 1) if c >= least}
    if n_texts >= least:
        count[EDGE] = float(n_texts)
    levels, sizes = [], []
    start = 0
    for d in range(1, DEPTH + 1):
        start = start << 16 | EDGE
        sizes.append(count)
        shorter = np.array(sorted(count), np.uint64)
        if not len(shorter):
            levels.append((np.zeros(0, np.uint64), np.zeros(0)))
            continue
        found = gram_counts(ids, d, shorter).where(F.col("n") >= least).toPandas()
        keys = found["gram"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(keys)
        keys, n = keys[order], found["n"].to_numpy(np.float64)[order]
        levels.append((keys, n))
        # what ends a text is followed by nothing; the start stands before every text
        count = {int(k): float(c) for k, c in zip(keys, n) if int(k) & 0xFFFF != EDGE}
        if n_texts >= least:
            count[start << 16 | EDGE] = float(n_texts)
    return grow_tree(levels, total, root, sizes)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def context_keys(line: np.ndarray, at: np.ndarray, depth: int) -> Iterator[np.ndarray]:
    """Keys of the contexts of 1 to ``depth`` tokens before ``at``."""
    key = np.full(len(at), NO_CONTEXT, np.uint64)
    for d in range(1, depth + 1):
        key = _mix(key + _mix(line[at - d]))
        yield key


def gram_keys(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    return _mix((context ^ np.uint64(0xD1B54A32D192ED03)) + _mix(symbol))


class _WordCodes(dict):
    """Codes of words: their number, or else a hash with the highest bit set
    (some of these are kept)."""

    def __init__(self, number: dict[bytes, int]):
        super().__init__(number)
        self.number = number

    def __missing__(self, word: bytes) -> int:
        if len(self) >= len(self.number) + FLUSH:
            self.clear()
            self.update(self.number)
        code = self[word] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little") | 1 << 63
        return code


def _numbered(codes: np.ndarray) -> np.ndarray:
    return codes <= np.uint64(EDGE)


def _codes(ids: list[bytes], cold: list[bytes]) -> list[np.ndarray]:
    """The tokens of each text as codes."""
    out = []
    for i, c in zip(ids, cold):
        t = np.frombuffer(i, "<u2").astype(np.uint64)
        if len(c):
            t[t == RARE] = np.frombuffer(c, "<u8")
        out.append(t)
    return out


def _sums(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(different keys, a place of each, number of each key among them, sums of the counts)."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(first) - 1
    return keys[first], order[first], number, *(np.bincount(number, c, int(first.sum())) for c in counts)


def _text_batches(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows ``(block, learns, ids, cold)`` block by block, as far as they come
    together: (block, line of codes, places of the symbols, whether a symbol is learned from)."""
    for b in batches:
        for block, rows in b.groupby("block", sort=False):
            line, at, sizes = symbol_line(_codes(list(rows["ids"]), list(rows["cold"])), np.uint64)
            yield int(block), line, at, np.repeat(rows["learns"].to_numpy(bool), sizes)


@dataclass
class HotContexts:
    """Contexts with more than ``HOT_ENTRIES`` symbols after them: by depth
    their sorted keys, with the number of each (its place in the lists), and by
    number the hot context that is its suffix (-1: none) and the training
    symbols after it; later the listed grams and their occurrences."""
    keys: list[np.ndarray] = field(default_factory=list)
    numbers: list[np.ndarray] = field(default_factory=list)
    suffix: list[int] = field(default_factory=list)
    size: list[float] = field(default_factory=list)
    listed: np.ndarray = field(default_factory=lambda: np.zeros(0))
    mass: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def of(self, depth: int, keys: np.ndarray) -> np.ndarray:
        """Numbers of the hot contexts with these keys (-1: not hot)."""
        if depth > len(self.keys):
            return np.full(len(keys), -1)
        place, hit = find(self.keys[depth - 1], keys)
        return np.where(hit, self.numbers[depth - 1][place] if len(self.numbers[depth - 1]) else -1, -1)


def hot_contexts(coded: DataFrame) -> HotContexts:
    """The hot contexts of the rows ``coded`` (``block, learns, ids, cold``),
    among those of numbered words: at most one in ``HOT_ENTRIES`` symbols a depth."""
    hot = HotContexts()
    for d in range(1, DEPTH + 1):

        def count(batches: Iterator[pd.DataFrame], d: int = d) -> Iterator[pd.DataFrame]:
            for _, line, at, learns in _text_batches(batches):
                for j in range(1, d + 1):
                    fits = _numbered(line[at - j]) & (line[at - j] != RARE)
                    at, learns = at[fits], learns[fits]
                suffix = np.full(len(at), -1)
                if d > 1:  # what stands before and after a hot context's ends is hot itself
                    *_, end = context_keys(line, at, d - 1)
                    *_, begin = context_keys(line, at - 1, d - 1)
                    suffix = hot.of(d - 1, end)
                    fits = (suffix >= 0) & (hot.of(d - 1, begin) >= 0)
                    at, learns, suffix = at[fits], learns[fits], suffix[fits]
                if len(at):
                    *_, keys = context_keys(line, at, d)
                    keys, first, _, n, size = _sums(keys, np.ones(len(at)), learns)
                    yield pd.DataFrame({"key": keys.view(np.int64), "suffix": suffix[first],
                                        "n": n.astype(int), "size": size.astype(int)})

        found = coded.mapInPandas(count, "key long, suffix long, n long, size long").groupBy("key").agg(
            F.min("suffix").alias("suffix"), F.sum("n").alias("n"), F.sum("size").alias("size")).where(
            F.col("n") > HOT_ENTRIES).toPandas()
        if not len(found):
            break
        keys = found["key"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(keys)
        hot.keys.append(keys[order])
        hot.numbers.append(len(hot.size) + order)
        hot.suffix += found["suffix"].tolist()
        hot.size += found["size"].astype(float).tolist()
    hot.listed, hot.mass = np.zeros(len(hot.size)), np.zeros(len(hot.size))
    return hot


def part_labels(spark: SparkSession, parts: int) -> np.ndarray:
    """A number for each of ``parts`` partitions that ``repartition`` by it deals out there."""
    rows = spark.range(parts * (20 + parts.bit_length())).groupBy(F.pmod(F.hash(F.col("id").cast("int")), F.lit(parts)).alias(
        "part")).agg(F.min("id").cast("int").alias("label")).collect()
    labels = np.zeros(parts, np.int32)
    labels[:] = rows[0].label
    for r in rows:
        labels[r.part] = r.label
    return labels


def _by_part(part: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows by their part and the bounds of the parts in it."""
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def shared_counts(coded: DataFrame, sent: Broadcast, labels: np.ndarray) -> DataFrame:
    """``(block, keys, n, hot, listed, mass)``: for each block the training
    counts of its words without a number and of the grams of its hot contexts,
    packed (absent: 0; of grams: less than ``MIN_COUNT``); and of hot contexts
    their listed grams and occurrences of these, to be summed."""
    parts = len(labels)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block, line, at, learns in _text_batches(batches):
            symbol = line[at]
            cold = ~_numbered(symbol)
            keys, hot_of, n = [symbol[cold]], [np.full(int(cold.sum()), -1)], [learns[cold]]
            for d, key in enumerate(context_keys(line, at, DEPTH), 1):
                hot_at = sent.value.of(d, key)
                there = np.flatnonzero(hot_at >= 0)
                keys.append(gram_keys(key[there], symbol[there]))
                hot_of.append(hot_at[there])
                n.append(learns[there])
            keys, first, _, n = _sums(np.concatenate(keys), np.concatenate(n))
            hot_of = np.concatenate(hot_of)[first]
            order, bounds = _by_part((_mix(keys) % np.uint64(parts)).astype(np.int64), parts)
            rows = [(int(labels[p]), block, keys[o].tobytes(), n[o].astype("<u4").tobytes(),
                     hot_of[o].astype("<i4").tobytes())
                    for p in range(parts) if len(o := order[bounds[p]:bounds[p + 1]])]
            yield pd.DataFrame(rows, columns=["part", "block", "keys", "n", "hot"])

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked = [r for b in batches for r in b.itertuples(index=False)]
        if not asked:
            return
        every, n, hot_of = (np.concatenate([np.frombuffer(getattr(r, name), kind) for r in asked])
                            for name, kind in (("keys", "<u8"), ("n", "<u4"), ("hot", "<i4")))
        _, first, place, n = _sums(every, n)
        listed = (hot_of[first] >= 0) & (n >= MIN_COUNT)
        told = (listed | (hot_of[first] < 0) & (n > 0))[place]
        n_of, start, rows = n[place], 0, []
        for r in asked:
            here = slice(start, start := start + len(r.keys) // 8)
            rows.append((r.block, every[here][told[here]].tobytes(), n_of[here][told[here]].astype("<u4").tobytes(),
                         -1, 0, 0))
        hot, _, _, count, mass = _sums(hot_of[first][listed], np.ones(int(listed.sum())), n[listed])
        rows += [(None, b"", b"", int(h), int(c), int(m)) for h, c, m in zip(hot, count, mass)]
        yield pd.DataFrame(rows, columns=["block", "keys", "n", "hot", "listed", "mass"]).astype({"block": "Int64"})

    return coded.mapInPandas(ask, "part int, block long, keys binary, n binary, hot binary").repartition(
        parts, "part").mapInPandas(answer, "block long, keys binary, n binary, hot int, listed long, mass long")


def _squeeze(x: np.ndarray) -> bytes:
    """Numbers byte by byte: first the lowest byte of all, compressed."""
    if not len(x):
        return b""
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _expand(x: bytes, kind: str, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(x, n * size, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(kind).ravel()


def _pack(codes: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Codes as two bytes each, with a bit for those that are longer, and these."""
    short = _numbered(codes)
    return _squeeze(np.where(short, codes, 0).astype("<u2")), np.packbits(~short).tobytes(), codes[~short].tobytes()


def _unpack(short: bytes, bits: bytes, long: bytes, n: int) -> np.ndarray:
    codes = _expand(short, "<u2", n).astype(np.uint64)
    if len(long):
        codes[np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)] = np.frombuffer(long, "<u8")
    return codes


#: Columns of packed symbols: their and their contexts' codes, the text of each
#: (its place in the block), whether it is learned from, the counts of
#: symbols without a number and of grams of hot contexts.
PACKED = [f"{kind}{j}" for j in range(DEPTH + 1) for kind in ("short", "bits", "long")] + [
    "text", "learns", "count", "hot_n"]


@dataclass
class Model:
    """What tasks share: counts by word number, the log of what counts at the
    root are divided by, the price of a parameter, the hot contexts."""
    counts: np.ndarray
    scale: float
    price: float
    hot: HotContexts


def symbols_of(coded: DataFrame, counts: DataFrame, sent: Broadcast, labels: np.ndarray, wave: int) -> DataFrame:
    """Every symbol of this ``wave`` that has a context, packed with those of its
    block (whose first text is ``first``) that go to the same ``part``: of a
    context that is not hot, all symbols after it.  Besides in wave 0 a row a block
    with its ``texts``, their ``base`` scores and ``known`` tokens.
    ``coded``: ``(block, __n, learns, ids, cold)``."""
    parts = len(labels)
    columns = ["part", "first", "size", "texts", "base", "known", *PACKED]

    def deal(texts: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        model: Model = sent.value
        texts = texts.sort_values("__n")
        keys = np.frombuffer(b"".join(told["keys"]), "<u8")
        n = np.frombuffer(b"".join(told["n"]), "<u4")
        keys, first = np.unique(keys, return_index=True)
        n = n[first].astype(np.int64)

        def told_n(wanted: np.ndarray) -> np.ndarray:
            place, hit = find(keys, wanted)
            return np.where(hit, n[place], 0) if len(n) else np.zeros(len(wanted), np.int64)

        line, at, sizes = symbol_line(_codes(list(texts["ids"]), list(texts["cold"])), np.uint64)
        names = texts["__n"].to_numpy(np.int64)
        learns = np.repeat(texts["learns"].to_numpy(bool), sizes)
        symbol = line[at]
        cold = ~_numbered(symbol)
        count = model.counts[np.where(cold, RARE, symbol).astype(np.int64)].astype(np.int64)
        count[cold] = told_n(symbol[cold])
        starts = np.cumsum(sizes) - sizes
        base = np.add.reduceat(np.log10(count + ADD) - model.scale / np.log(10), starts)
        known = np.add.reduceat((count > 0).astype(np.int64), starts)
        rows = [] if wave else [(int(labels[texts["block"].iloc[0] % parts]), int(names[0]), 0, names.tobytes(),
                                 base.tobytes(), known.tobytes(), *[b""] * len(PACKED))]
        # words that are not listed are in no context of the tree
        listed = line.copy()
        listed[at[count < MIN_COUNT]] = RARE
        context = [listed[at - j] for j in range(DEPTH + 1)]
        for j in range(2, DEPTH + 1):
            context[j] = np.where(context[j - 1] == RARE, RARE, context[j])
        hot, route = np.ones(len(at), bool), np.zeros(len(at), np.uint64)
        grams = []  # by depth: counts of the grams of hot contexts, -1 for others
        key = np.full(len(at), NO_CONTEXT, np.uint64)
        for d in range(1, DEPTH + 1):
            key = _mix(key + _mix(context[d]))
            ends_hot = hot & (context[d] == RARE)
            hot_of = model.hot.of(d, key)
            route[hot] = key[hot]
            hot = hot & (hot_of >= 0)
            gram = gram_keys(key, symbol)
            # of what is hot to its end all counts are known: any part may have it
            route[ends_hot] = gram[ends_hot]
            route[hot] = gram[hot]
            grams.append(np.where(hot, told_n(gram), -1) if hot.any() else np.full(len(at), -1))
        text = np.repeat((names - names[0]).astype("<u4"), sizes)
        # in the order of what they are dealt out by: what is alike lies together
        deal_by = _mix(route)
        part_of = (deal_by >> np.uint64(32)) * np.uint64(parts * WAVES) >> np.uint64(32)
        has = np.flatnonzero((context[1] != RARE) & (part_of // np.uint64(parts) == wave))
        has = has[np.argsort(deal_by[has])]
        bounds = np.searchsorted(part_of[has], wave * parts + np.arange(parts + 1))
        for p in range(parts):
            o = has[bounds[p]:bounds[p + 1]]
            if not len(o):
                continue
            symbols = [c[o] for c in context]
            hot_n = [g[o][g[o] >= 0] for g in grams]
            rows.append((int(labels[p]), int(names[0]), len(o), b"", b"", b"", *[x for c in symbols for x in _pack(c)],
                         _squeeze(text[o]), np.packbits(learns[o]).tobytes(),
                         _squeeze(count[o][~_numbered(symbols[0])].astype("<u4")),
                         np.concatenate(hot_n).astype("<u4").tobytes()))
        return pd.DataFrame(rows, columns=columns)

    kind = ", ".join(["part int, first long, size int", *[f"{c} binary" for c in columns[3:]]])
    return coded.groupBy("block").cogroup(counts.groupBy("block")).applyInPandas(deal, kind)


#: What comes of a part: packed sums of the symbols of a block's texts; or of a
#: hot context a part of the log likelihood that it gains and whether it stays for
#: a longer one's sake; or the facts of a block as they came.
OF_PART = ["first", "size", "texts", "base", "known", "text", "hots", "sums", "hot", "gain", "stays"]


def grow_and_score(symbols: DataFrame, sent: Broadcast) -> DataFrame:
    """``OF_PART`` of the packed rows of ``symbols_of``."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, facts = [], []
        for b in batches:
            for r in b.itertuples(index=False):
                if r.size:
                    rows.append(r)
                else:
                    facts.append((r.first, 0, r.texts, r.base, r.known, b"", b"", b"", -1, 0.0, False))
        facts += _part_of_tree(rows, sent.value) if rows else []
        if facts:
            yield pd.DataFrame(facts, columns=OF_PART).astype({"first": "Int64"})

    return symbols.mapInPandas(work, "first long, size int, texts binary, base binary, known binary, text binary, "
                                     "hots binary, sums binary, hot int, gain double, stays boolean")


def add_up(parts: DataFrame) -> DataFrame:
    """``(of, hot, s0 .. s<DEPTH>, base, known)`` of ``OF_PART`` with a block:
    summed natural-log ratios of the symbols of a text ``of`` by the number of
    their deepest hot context (-1: none), ``s<k>`` if the tree has k of it and its
    suffixes; base scores and known tokens in rows of their own."""
    sums = [f"s{k}" for k in range(DEPTH + 1)]

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        first = int(rows["first"].iloc[0])
        named, rows = rows[rows["size"] == 0], rows[rows["size"] > 0]
        names = np.frombuffer(b"".join(named["texts"]), "<i8")
        facts = pd.DataFrame({"of": names, "hot": -1, **dict.fromkeys(sums, 0.0), "base": np.frombuffer(
            b"".join(named["base"]), "<f8"), "known": np.frombuffer(b"".join(named["known"]), "<i8")})
        if not len(rows):
            return facts
        text, hot = (np.concatenate([_expand(x, kind, n) for x, n in zip(rows[c], rows["size"])]).astype(np.int64)
                     for c, kind in (("text", "<u4"), ("hots", "<i4")))
        values = np.concatenate([_expand(x, "<f8", n * len(sums)).reshape(len(sums), n)
                                 for x, n in zip(rows["sums"], rows["size"])], axis=1)
        key = text << 32 | hot + 1
        key, _, _, *totals = _sums(key, *values)
        return pd.concat([facts, pd.DataFrame({"of": first + (key >> 32), "hot": (key & 0xFFFFFFFF) - 1,
                                               **dict(zip(sums, totals)), "base": 0.0, "known": 0})])

    kind = ", ".join(["of long, hot int", *[f"{c} double" for c in sums], "base double, known long"])
    return parts.groupBy("first").applyInPandas(add, kind)


def _part_of_tree(rows: list, model: Model) -> list[tuple]:
    hot = model.hot
    sizes = [r.size for r in rows]
    context = [np.concatenate([_unpack(*(getattr(r, f"{kind}{j}") for kind in ("short", "bits", "long")), r.size)
                               for r in rows]) for j in range(DEPTH + 1)]
    text = np.concatenate([_expand(r.text, "<u4", r.size) for r in rows]).astype(np.int64)
    learns = np.concatenate([np.unpackbits(np.frombuffer(r.learns, np.uint8), count=n) for r, n in zip(rows, sizes)])
    learns = learns.astype(bool)
    row_of = np.repeat(np.arange(len(rows)), sizes)
    symbol = context[0]
    count = model.counts[np.where(_numbered(symbol), symbol, RARE).astype(np.int64)].astype(np.float64)
    cold = ~_numbered(symbol)
    count[cold] = np.concatenate([_expand(r.count, "<u4", k) for r, k in zip(rows, np.bincount(row_of[cold], minlength=len(rows)))])
    in_root = np.log(count + ADD) - model.scale
    told = [np.frombuffer(r.hot_n, "<u4") for r in rows]  # of each row by depth
    told_at = np.zeros(len(rows), np.int64)

    places, worth, hot_at = [], [], []
    ratios, weights = [np.zeros(len(text))], []
    parent = symbol != RARE  # symbols whose gram of the depth before is listed
    key = np.full(len(text), NO_CONTEXT, np.uint64)
    gains: list[tuple[np.ndarray, np.ndarray]] = []
    for d in range(1, DEPTH + 1):
        key = _mix(key + _mix(context[d]))
        has = context[d] != RARE
        of_hot = np.where(has, hot.of(d, key), -1)
        if d > 1:
            of_hot[hot_at[-1] < 0] = -1
        own = np.flatnonzero(has & (of_hot < 0))
        n, room, weight = np.zeros(len(text)), np.ones(len(text)), np.ones(len(text))
        place = np.full(len(text), -1)
        ctx, _, place[own], size = _sums(key[own], learns[own])
        asked = own[parent[own]]
        _, first, gram, times = _sums(gram_keys(key[asked], symbol[asked]), learns[asked])
        n[asked] = times[gram]
        listed = np.bincount(place[asked[first[times >= MIN_COUNT]]], minlength=len(ctx))
        counted = own[learns[own] & (n[own] >= MIN_COUNT)]
        mass = np.bincount(place[counted], minlength=len(ctx))
        weight_of = np.maximum(1 - mass / (size + listed + 1), 1e-12)
        room[own], weight[own] = (size + listed + 1)[place[own]], weight_of[place[own]]
        there = np.flatnonzero(of_hot >= 0)
        if len(there):
            # counts lie by row, in a row by depth
            in_row = np.bincount(row_of[there], minlength=len(rows))
            n[there] = np.concatenate([told[i][told_at[i]:told_at[i] + k] for i, k in enumerate(in_row)])
            told_at += in_row
            room_of, hot_weight = _hot_room(hot)
            room[there], weight[there] = room_of[of_hot[there]], hot_weight[of_hot[there]]
        known = parent & has & (n >= MIN_COUNT)
        ratio = np.full(len(text), np.nan)
        below = ratios[-1][known]
        ratio[known] = np.log(n[known] / room[known] + weight[known] * np.exp(below + in_root[known])) - in_root[known]
        more = np.where(known & learns, ratio - ratios[-1], 0)
        gain = np.bincount(place[own], more[own], len(ctx)) + (size - mass) * np.log(weight_of)
        worth.append((listed > 0) & (gain >= model.price * (listed + 1)))
        if len(there):
            numbers, _, _, gained = _sums(of_hot[there], more[there])
            gains.append((numbers, gained))
        places.append(place)
        hot_at.append(of_hot)
        ratios.append(ratio)
        weights.append(np.log(weight))
        parent = known
    stays: list[np.ndarray] = [np.zeros(0, np.int64)]
    for d in range(DEPTH - 1, 0, -1):
        longer = np.flatnonzero(places[d] >= 0)
        longer = longer[worth[d][places[d][longer]]]
        kept = places[d - 1][longer]
        worth[d - 1][kept[kept >= 0]] = True
        stays.append(np.unique(hot_at[d - 1][longer[kept < 0]]))
    totals = [np.zeros(len(text))]
    for d in range(DEPTH):
        in_tree = hot_at[d] >= 0
        own = np.flatnonzero(places[d] >= 0)
        in_tree[own] = worth[d][places[d][own]]
        step = np.where(np.isnan(ratios[d + 1]), totals[-1] + weights[d], ratios[d + 1])
        totals.append(np.where(in_tree, step, totals[-1]))
    levels = sum((h >= 0).astype(int) for h in hot_at)
    deepest = np.full(len(text), -1)
    for h in hot_at:
        deepest = np.where(h >= 0, h, deepest)
    out = []
    values = np.stack([np.where(levels > k, totals[k], np.where(levels == k, totals[-1], 0)) for k in range(DEPTH + 1)])
    ends = np.cumsum(sizes)
    for r, begin, end in zip(rows, ends - sizes, ends):
        key, place, _, *sums = _sums(text[begin:end] << 32 | deepest[begin:end] + 1, *values[:, begin:end])
        out.append((r.first, len(key), b"", b"", b"", _squeeze(text[begin:end][place].astype("<u4")),
                    _squeeze(deepest[begin:end][place].astype("<i4")), _squeeze(np.concatenate(sums)), -1, 0.0, False))
    blank = (None, 0, *[b""] * 6)
    out += [(*blank, int(h), float(g), False) for numbers, gained in gains for h, g in zip(numbers, gained)]
    return out + [(*blank, int(h), 0.0, True) for h in np.unique(np.concatenate(stays))]


def _hot_room(hot: HotContexts) -> tuple[np.ndarray, np.ndarray]:
    """What counts after each hot context are divided by, and the weight it gives to its suffix."""
    room = np.array(hot.size) + hot.listed + 1
    return room, np.maximum(1 - hot.mass / room, 1e-12)


def hot_levels(hot: HotContexts, facts: list, price: float) -> np.ndarray:
    """How many of a hot context and its suffixes the tree has, by number;
    ``facts``: ``(hot, gain, stays)`` summed over the parts."""
    _, weight = _hot_room(hot)
    gain = (np.array(hot.size) - hot.mass) * np.log(weight)
    kept = np.zeros(len(gain), bool)
    for r in facts:
        gain[r.hot] += r.gain
        kept[r.hot] |= r.stays
    kept |= (hot.listed > 0) & (gain >= price * (hot.listed + 1))
    for i in range(len(kept) - 1, -1, -1):  # suffixes have smaller numbers
        if kept[i] and hot.suffix[i] >= 0:
            kept[hot.suffix[i]] = True
    levels = np.zeros(len(kept), np.int64)
    for i, s in enumerate(hot.suffix):
        levels[i] = (levels[s] if s >= 0 else 0) + kept[i]
    return levels


def table_scores(coded: DataFrame, counts: np.ndarray, total: int, symbols: int, scale: float) -> DataFrame:
    """``(__of, __known, __base, __ratio)`` of each row of ``coded`` (``block, __n,
    learns, ids, cold``): known tokens, the base score and the summed natural-log
    ratios.  ``counts``: training counts by word number; ``total``: training
    tokens; ``symbols``: tokens of all rows; ``scale``: log of what counts at the root are divided by."""
    spark = coded.sparkSession
    labels = part_labels(spark, max(1, -(-symbols // (PART * WAVES))))
    hot = hot_contexts(coded) if symbols > HOT_ENTRIES else HotContexts()
    sent = spark.sparkContext.broadcast(hot)
    told = keep(shared_counts(coded, sent, labels), "tree-counts")
    _sweep(spark)
    for r in told.where("hot >= 0").groupBy("hot").agg(F.sum("listed").alias("listed"), F.sum("mass").alias("mass")).collect():
        hot.listed[r.hot], hot.mass[r.hot] = r.listed, r.mass
    price = 0.5 * float(np.log(max(total, 2)))
    model = spark.sparkContext.broadcast(Model(counts, scale, price, hot))
    sums, facts = None, []
    for wave in range(WAVES):  # one after the other: shuffled symbols take the most disk
        dealt = symbols_of(coded, told.where("hot < 0").select("block", "keys", "n"), model, labels, wave)
        done = keep(grow_and_score(dealt.repartition(len(labels), "part"), model), "tree-parts")
        if len(hot.size):
            facts += done.where("first is null").groupBy("hot").agg(F.sum("gain").alias("gain"), F.max("stays").alias(
                "stays")).collect()
        added = keep(add_up(done.where("first is not null")), "tree-scores")
        sums = added if sums is None else sums.union(added)
        release(done)
        del dealt, done
        _sweep(spark)
    release(told)
    levels = hot_levels(hot, facts, price)
    ratio = F.col("s0")
    if len(levels):
        table = spark.createDataFrame(pd.DataFrame({"hot": np.arange(-1, len(levels)), "level": [0, *levels]}))
        sums = sums.join(F.broadcast(table), "hot")
        ratio = F.array(*[f"s{k}" for k in range(DEPTH + 1)])[F.col("level").cast("int")]
    return sums.groupBy(F.col("of").alias("__of")).agg(
        F.sum("known").alias("__known"), F.sum("base").alias("__base"), F.sum(ratio).alias("__ratio"))


def _sweep(spark: SparkSession) -> None:
    """Shuffle files of plans that are done go when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def frequent(counted: DataFrame, most: int) -> Column:
    """Condition that holds for at most ``most`` of the rows with the highest
    ``n``.  Counts are binned on a fine log scale (a short histogram); rows from
    the lowest bin on with which they are no more than ``most`` are taken."""
    place = F.floor(F.log2("n") * 16)
    bins = counted.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("k")).collect()
    lowest, total = None, 0
    for r in sorted(bins, reverse=True):
        total += r.k
        if total > most:
            break
        lowest = r.bin
    return F.lit(False) if lowest is None else place >= lowest


def most_frequent(words: DataFrame, most: int) -> pd.DataFrame:
    """At most ``most`` of the words with the highest counts, in order; only
    these leave the tasks.  (Sorting with a limit would send so many rows of
    every task.)"""
    found = words.where(frequent(words, most))
    return found.select("word", "n").toPandas().sort_values(["n", "word"], ascending=[False, True])


def score_texts(docs: DataFrame, learns: str, hot_words: int = HOT_WORDS) -> DataFrame:
    """One row for each row of ``docs``: its columns but ``text``, and
    ``n_tokens, n_known, train_tokens, base_score, score`` in place of columns
    of these names.  The models learn from the rows whose boolean column
    ``learns`` is true.

    Tokens are the words and one end of each text; ``base_score`` is the
    add-0.1 unigram log10 probability of the tokens, ``score`` the tree's log10
    probability of the text.  A null text is an empty one: one token, the end.
    No training text: nothing is known, one unknown word is all there is.  Repeated rows each give a row.
    """
    spark = docs.sparkSession
    counts = keep(word_counts(docs.where(F.col(learns))), "word-counts")
    words = counts.where("word is not null")
    facts = counts.agg(F.sum(F.when(F.col("word").isNotNull(), F.col("n"))).alias("words"),
                       F.count("word").alias("different"),
                       F.sum(F.when(F.col("word").isNull(), F.col("n"))).alias("texts")).first()
    texts = facts.texts or 0
    total = (facts.words or 0) + texts
    different = facts.different + (1 if texts else 0)
    scale = float(np.log10(total + ADD * (different + 1)))
    top = most_frequent(words, min(hot_words, HOT_WORDS))
    hot_counts = top["n"].to_numpy(np.float64)
    root = np.full(EDGE + 1, np.log10(ADD) - scale)
    root[1:len(hot_counts) + 1] = np.log10(hot_counts + ADD) - scale
    root[EDGE] = np.log10(texts + ADD) - scale
    number = {bytes(w): i for i, w in enumerate(top["word"], 1)}
    numbers, roots = spark.sparkContext.broadcast(number), spark.sparkContext.broadcast(root)
    names = ("text", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    own = [c for c in docs.columns if c.lower() not in names]

    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        code, root = _WordCodes(numbers.value).__getitem__, roots.value
        block, size = TaskContext.get().partitionId() << 32, 0
        for s in batches:
            rows = []
            for t in s:
                w = tokens(t)
                codes = np.fromiter(map(code, w), np.uint64, len(w))
                numbered = _numbered(codes)
                ids = np.where(numbered, codes, RARE).astype("<u2")
                rows.append((ids.tobytes(), len(w) + 1, int(numbered.sum()), float(root[ids].sum()),
                             codes[~numbered].tobytes(), block))
                size += len(w) + 1
                if size >= BLOCK:
                    block, size = block + 1, 0
            yield pd.DataFrame(rows, columns=["ids", "tokens", "known", "base", "cold", "block"])

    encode.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    kind = "ids binary, tokens long, known long, base double, cold binary, block long"
    coded = keep(docs.select(*[F.col(f"`{c}`") for c in own], F.col(learns).alias("__learns"),
                             F.pandas_udf(encode, kind)("text").alias("__s"),
                             F.monotonically_increasing_id().alias("__n")), "tree-coded")
    _sweep(spark)
    if total <= LOCAL_TOKENS and facts.different <= len(top):
        # a word without a number is in no training text
        tree = fit_tree(coded.where("__learns").select("__s.ids"), hot_counts, texts, total, root * np.log(10))
        sent = spark.sparkContext.broadcast(tree)

        def ratio(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                sums = [sent.value.score(x) for x in _batches(list(b["ids"]))]
                yield pd.DataFrame({"__of": b["__n"], "__known": b["known"] + bool(texts),
                                    "__base": b["base"] + root[EDGE], "__ratio": np.concatenate([*sums, np.zeros(0)])})

        sums = coded.select("__n", "__s.ids", "__s.known", "__s.base").mapInPandas(
            ratio, "__of long, __known long, __base double, __ratio double")
    else:
        numbered = np.zeros(EDGE + 1)
        numbered[1:len(hot_counts) + 1], numbered[EDGE] = hot_counts, texts
        symbols = coded.agg(F.sum("__s.tokens")).first()[0] or 0
        sums = table_scores(coded.select("__s.block", "__n", F.coalesce("__learns", F.lit(False)).alias("learns"),
                                         "__s.ids", "__s.cold"), numbered, total, symbols, scale * float(np.log(10)))
    release(counts)
    _sweep(spark)
    scored = coded.select(*[F.col(f"`{c}`") for c in own], F.col("__n").alias("__text"), F.col("__s.tokens").alias("__tokens"))
    return scored.join(sums, F.col("__text") == F.col("__of")).select(
        *[F.col(f"`{c}`") for c in own], F.col("__tokens").alias("n_tokens"), F.col("__known").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), F.col("__base").alias("base_score"),
        (F.col("__base") + F.col("__ratio") / float(np.log(10))).alias("score"))


ship(__name__)
