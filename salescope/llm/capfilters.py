"""Embedding near-duplicates by spherical-cap filters.

Filter directions are a random product code: the space is turned at random and
cut into blocks, each block has a code book of random unit vectors, and a
direction is one code word of each block side by side.  A vector belongs to
every direction that it has an inner product of ``alpha`` or more with; these
are listed by decoding (partial sums of block products, best first, cut when
the best rest cannot reach ``alpha``), never by trying all directions.  Two
vectors meet if they share a direction; what meets is verified by the cosine
in double precision.

``alpha`` follows the number of vectors so that a direction holds about
``PER_FILTER`` unrelated vectors of a label.  Directions of one code are not
independent, so several codes are drawn, each with its own turn of the space,
until pairs just at the threshold (drawn at random, ``TRIALS`` of them) share
no direction in at most ``MISS`` of all cases.  A direction
with many vectors (a group of near copies) is worked off in pairs of parts of
``PART`` vectors, so that no task holds more than two parts; a pair counts only
in the first direction that it shares.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import connected_components, keep, release, ship

THRESHOLD = 0.93
PER_FILTER = 64
MISS = 0.0002
TRIALS = 20_000
#: Directions that a pair at the threshold is expected to share in one code.
SHARED = 1.0
MAX_CODES = 64
PART = 512
SEED = 20_240_501


def _cap_shares(dim: int, threshold: float, alpha: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chance that a random direction is within the cap ``alpha`` of one unit
    vector, and of both of two unit vectors at cosine ``threshold``."""
    u = np.linspace(-1, 1, 4001)
    du = u[1] - u[0]
    density = lambda d: (w := np.maximum(1 - u * u, 0) ** ((d - 3) / 2)) / (w.sum() * du)
    one, rest = density(dim), density(dim - 1)
    tail = np.append(np.cumsum(rest[::-1])[::-1] * du, 0.0)  # chance of a value from u[i] on
    single, both = [], []
    for a in np.atleast_1d(alpha):
        inside = u >= a
        single.append(float(one[inside].sum() * du))
        with np.errstate(divide="ignore", invalid="ignore"):
            least = (a - threshold * u) / (np.sqrt(1 - threshold ** 2) * np.sqrt(np.maximum(1 - u * u, 1e-12)))
        second = tail[np.clip(np.ceil((least + 1) / du), 0, len(u)).astype(int)]
        both.append(float((one[inside] * second[inside]).sum() * du))
    return np.array(single), np.array(both)


@dataclass
class ProductCode:
    alpha: float
    turn: np.ndarray            # dim x dim rotation
    cuts: list[tuple[int, int]]
    books: list[np.ndarray]     # code words x block width, norm 1 / sqrt(blocks)

    def decode(self, x: np.ndarray) -> list[np.ndarray]:
        """The directions whose cap holds each row of ``x`` (unit vectors)."""
        turned = x @ self.turn
        products = [turned[:, a:b] @ book.T for (a, b), book in zip(self.cuts, self.books)]
        orders = [np.argsort(-p, axis=1) for p in products]
        ranked = [np.take_along_axis(p, o, axis=1) for p, o in zip(products, orders)]
        return [self._list([r[i] for r in ranked], [o[i] for o in orders]) for i in range(len(x))]

    def _list(self, ranked: list[np.ndarray], order: list[np.ndarray]) -> np.ndarray:
        best_rest = np.append(np.cumsum([r[0] for r in ranked[::-1]])[::-1][1:], 0.0)
        sums, codes = np.zeros(1), np.zeros(1, np.int64)
        for r, o, rest in zip(ranked, order, best_rest):
            # of the ranked products each partial sum goes on with a prefix
            n = np.searchsorted(-r, sums - (self.alpha - rest), side="right")
            which = np.repeat(np.arange(len(sums)), n)
            at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            sums, codes = sums[which] + r[at], codes[which] * len(r) + o[at]
        return codes


def product_code(dim: int, vectors: int, threshold: float = THRESHOLD, per_filter: int = PER_FILTER,
                 shared: float = SHARED, seed: int = SEED) -> ProductCode:
    """A code for ``vectors`` vectors of a label (the largest number of any)."""
    alphas = np.linspace(0.05, 0.8, 151)
    single, both = _cap_shares(max(dim, 4), threshold, alphas)
    wanted = np.clip(per_filter / max(vectors, per_filter), 1e-9, 0.25)
    k = int(np.argmin(np.abs(np.log(np.maximum(single, 1e-30)) - np.log(wanted))))
    directions = max(16, int(np.ceil(shared / max(both[k], 1e-12))))
    blocks = 1 if dim < 8 else 2 if directions <= 1 << 20 else 3 if directions <= 1 << 30 else 4
    words = int(np.ceil(directions ** (1 / blocks)))
    rng = np.random.default_rng(seed)
    turn, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
    edges = np.linspace(0, dim, blocks + 1).astype(int)
    cuts = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
    books = []
    for a, b in cuts:
        book = rng.standard_normal((words, b - a))
        books.append(book / np.linalg.norm(book, axis=1, keepdims=True) / np.sqrt(blocks))
    return ProductCode(float(alphas[k]), turn, cuts, books)


@dataclass
class CodeFamily:
    """Independent codes; their directions are numbered one after another."""
    codes: list[ProductCode]

    def decode(self, x: np.ndarray) -> list[np.ndarray]:
        """The directions whose cap holds each row of ``x``, ascending."""
        found, first = [[] for _ in x], 0
        for code in self.codes:
            for mine, f in zip(found, code.decode(x)):
                mine.append(f + first)
            first += int(np.prod([len(b) for b in code.books]))
        return [np.sort(np.concatenate(f)) for f in found]


def code_family(dim: int, vectors: int, threshold: float = THRESHOLD, miss: float = MISS,
                trials: int = TRIALS, seed: int = SEED) -> CodeFamily:
    """Codes until at most ``miss`` of ``trials`` random pairs at the threshold
    share no direction."""
    rng = np.random.default_rng(seed - 1)
    x, side = rng.standard_normal((2, trials, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    size = np.linalg.norm(side, axis=1, keepdims=True)
    # vectors of one component have no other pair at the threshold than equal ones
    y = threshold * x + np.sqrt(1 - threshold ** 2) * side / size if dim > 1 else x.copy()
    family, apart = CodeFamily([]), np.ones(trials, bool)
    while apart.sum() > miss * trials:
        if len(family.codes) == MAX_CODES:
            raise RuntimeError(f"{MAX_CODES} codes leave {apart.mean():.3f} of the pairs apart")
        code = product_code(dim, vectors, threshold, seed=seed + len(family.codes))
        family.codes.append(code)
        at = np.flatnonzero(apart)
        apart[at] = [not len(np.intersect1d(f, g)) for f, g in zip(code.decode(x[at]), code.decode(y[at]))]
    return family


def _unit(v) -> np.ndarray | None:
    """The vector scaled to length 1 in doubles, or None if it links with nothing."""
    if v is None or not len(v):
        return None
    try:
        x = np.asarray(v, np.float64)
    except (TypeError, ValueError):
        return None
    if not np.isfinite(x).all():
        return None
    top = np.abs(x).max()
    return x / top / np.linalg.norm(x / top) if top > 0 else None


def usable_vectors(rows: DataFrame) -> DataFrame:
    """The vectors that can link, equal ones of a label once: ``node, label,
    dim, unit, first_id, copies`` and ``embedding``."""
    clean = rows.where("label is not null and embedding is not null").where(
        "size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) "
        "and abs(x) < double('infinity')) and exists(embedding, x -> x <> 0)")
    same = clean.groupBy("label", "embedding").agg(F.min("vec_id").alias("first_id"),
                                                   F.count(F.lit(1)).alias("copies"))
    return same.withColumn("dim", F.size("embedding")).withColumn("node", F.monotonically_increasing_id())


@dataclass
class _Part:
    """Vectors of one part of a direction."""
    unit: np.ndarray
    node: np.ndarray
    copies: np.ndarray
    filters: list


def _links_in(here: int, a: _Part, b: _Part, same: bool, threshold: float) -> list[tuple]:
    """Links of the direction ``here`` between the vectors ``a`` and ``b``
    (``same``: they are the same part): of each linked node the copies it links
    with and the smallest node that it reaches here, as (nodes, copies,
    reached) arrays.  A pair counts only in the first direction that its
    vectors share."""
    linked = a.unit @ b.unit.T >= threshold
    if same:
        np.fill_diagonal(linked, False)
    rows, cols = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    if not len(rows):
        return []
    # directions before this one, of the vectors that link with any
    mine = [a.filters[i][a.filters[i] < here] for i in rows]
    theirs = [b.filters[j][b.filters[j] < here] for j in cols]
    known, where = np.unique(np.concatenate([*mine, *theirs]), return_inverse=True)
    if len(known):
        def incidence(lists: list[np.ndarray], at: np.ndarray) -> np.ndarray:
            out = np.zeros((len(lists), len(known)), np.float32)
            out[np.repeat(np.arange(len(lists)), [len(x) for x in lists]), at] = 1
            return out

        split = sum(map(len, mine))
        linked[np.ix_(rows, cols)] &= incidence(mine, where[:split]) @ incidence(theirs, where[split:]).T == 0
    if not linked.any():
        return []
    low_l, low_r, top = a.node.copy(), b.node.copy(), np.iinfo(np.int64).max
    while True:  # the smallest node spreads along the links
        new_l = np.minimum(low_l, np.where(linked, low_r[None, :], top).min(axis=1))
        new_r = new_l if same else np.minimum(low_r, np.where(linked, new_l[:, None], top).min(axis=0))
        if (new_l == low_l).all() and (new_r == low_r).all():
            break
        low_l, low_r = new_l, new_r
    out = []
    for part, hit, copies, low in ((a, linked, b.copies, low_l), *([] if same else [(b, linked.T, a.copies, low_r)])):
        n = hit.astype(np.int64) @ copies
        out.append((part.node[n > 0], n[n > 0], low[n > 0]))
    return out


_KEY = ["label", "filter", "lo", "hi"]


def _groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Consecutive rows of one key, from batches of rows sorted by it."""
    rest = None
    for b in batches:
        b = b if rest is None else pd.concat([rest, b], ignore_index=True)
        change = np.flatnonzero((b[_KEY].to_numpy()[1:] != b[_KEY].to_numpy()[:-1]).any(axis=1)) + 1
        first = 0
        for at in change:
            yield b.iloc[first:at]
            first = at
        rest = b.iloc[first:]
    if rest is not None and len(rest):
        yield rest


def cap_links(nodes: DataFrame, code: CodeFamily, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Of kept ``usable_vectors`` of one dimension: ``(node, linked)``, copies
    linked with, and links ``(a, b)`` that join what is linked."""
    sent = nodes.sparkSession.sparkContext.broadcast(code)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 4096):
                part = b.iloc[at:at + 4096]
                units = np.stack([_unit(v) for v in part["embedding"]])
                yield pd.DataFrame({"node": part["node"].to_numpy(), "label": part["label"].to_numpy(),
                                    "copies": part["copies"].to_numpy(), "unit": list(units),
                                    "filters": sent.value.decode(units)})

    label = nodes.schema["label"].dataType.simpleString()
    decoded = keep(nodes.select("node", "label", "copies", "embedding").mapInPandas(
        decode, f"node long, label {label}, copies long, unit array<double>, filters array<long>"), "cap-decoded")
    met = decoded.select("node", "label", F.explode("filters").alias("filter"))
    # directions with many vectors are worked off in parts (a short table)
    split = keep(met.groupBy(F.col("label").alias("l"), F.col("filter").alias("f")).agg(F.count(F.lit(1)).alias("n"))
                 .where(F.col("n") > PART).select("l", "f", F.ceil(F.col("n") / PART).cast("int").alias("p")),
                 "cap-parts")
    members = decoded.withColumn("filter", F.explode("filters")).join(
        split, (F.col("label") == F.col("l")) & (F.col("filter") == F.col("f")), "left")
    parts = F.coalesce("p", F.lit(1))
    pairs = members.withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), parts - 1)))
    pairs = pairs.withColumn("lo", F.least("part", "other")).withColumn("hi", F.greatest("part", "other"))

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: list[tuple] = []
        for g in _groups(batches):
            if len(g) < 2:
                continue
            here, lo, hi = int(g["filter"].iloc[0]), g["lo"].iloc[0], g["hi"].iloc[0]
            every = _Part(np.stack(g["unit"].to_list()), g["node"].to_numpy(np.int64),
                          g["copies"].to_numpy(np.int64), [np.asarray(f) for f in g["filters"]])
            if lo == hi:
                found += _links_in(here, every, every, True, threshold)
            else:
                first = np.flatnonzero(g["part"].to_numpy() == lo)
                rest = np.flatnonzero(g["part"].to_numpy() != lo)
                if len(first) and len(rest):
                    a, b = [_Part(every.unit[i], every.node[i], every.copies[i], [every.filters[j] for j in i])
                            for i in (first, rest)]
                    found += _links_in(here, a, b, False, threshold)
            if sum(len(x[0]) for x in found) > 50_000:
                yield _link_rows(found)
                found = []
        if found:
            yield _link_rows(found)

    columns = [*_KEY, "part", "node", "copies", "unit", "filters"]
    dealt = pairs.select(*columns).repartition(*_KEY).sortWithinPartitions(*_KEY)
    found = keep(dealt.mapInPandas(links, "node long, n long, to long"), "cap-links")
    release(decoded)
    edges = found.select(F.col("node").alias("a"), F.col("to").alias("b")).where("a <> b").distinct()
    return found.groupBy("node").agg(F.sum("n").alias("linked")), edges


def _link_rows(found: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame({name: np.concatenate([x[i] for x in found]) for i, name in enumerate(("node", "n", "to"))})


def near_vectors(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row for each row of
    ``rows`` (``vec_id, embedding, label``).

    Vectors link if their labels are equal and not null, they have the same
    number of components and their cosine is ``threshold`` or more.  Null,
    zero and empty vectors and those with a null or non-finite component link
    with nothing.  Repeated rows are vectors of their own and link.
    ``component_id`` is the smallest id reached (null ids only if there is no
    other), ``kept`` whether it is the own id (a null id is not).  An empty
    table gives an empty one; other columns are not read.
    """
    rows = rows.select("vec_id", "embedding", "label")
    nodes = keep(usable_vectors(rows), "cap-nodes")
    dims = [r.dim for r in nodes.select("dim").distinct().limit(1001).collect()]
    if len(dims) > 1000:
        raise ValueError("vectors of more than 1000 different lengths")
    linked = edges = None
    for dim in sorted(dims):
        some = nodes.where(F.col("dim") == dim)
        largest = some.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        n, e = cap_links(some, code_family(dim, largest, threshold), threshold)
        linked, edges = (n, e) if linked is None else (linked.union(n), edges.union(e))
    if linked is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias(
            "component_id"), F.col("vec_id").isNotNull().alias("kept"))
    comp = connected_components(edges)
    named = nodes.join(comp.withColumnRenamed("node", "__node"), F.col("node") == F.col("__node"), "left").select(
        "node", "label", "embedding", "first_id", "copies", F.coalesce("component", "node").alias("component"))
    lowest = named.groupBy("component").agg(F.min("first_id").alias("low"))
    named = named.join(lowest, "component").join(linked.withColumnRenamed("node", "__node"),
                                                 F.col("node") == F.col("__node"), "left").select(
        F.col("label").alias("__label"), F.col("embedding").alias("__embedding"), "low",
        (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("links"))
    out = rows.join(named, (F.col("label") == F.col("__label")) & (F.col("embedding") == F.col("__embedding")), "left")
    component = F.when(F.col("links").isNull(), F.col("vec_id")).otherwise(F.col("low")).cast("long")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


ship(__name__)
