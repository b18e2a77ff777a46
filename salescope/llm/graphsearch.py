"""Nearest neighbours by inner product from hierarchical navigable small-world
graphs, one a shard.

Distinct vectors are dealt to shards of about ``SHARD`` by a hash.  A task
turns its shard into a graph (``build_graph``): levels drawn at random, each
node linked at each of its levels to neighbours that a beam search over the
graph so far finds, thinned so that links point in different directions.
Nodes are inserted many at a time; what is inserted together also sees each
other.  A graph is kept as one row of flat arrays (``GRAPH``).  Queries are
packed into rows of ``QUERY_BLOCK``, meet each shard's graph once, descend its
levels by beam search, and the best of all shards are merged.

Largest inner product is made a nearest-neighbour problem on the sphere:
vectors are divided by the shard's greatest length and get one more component
that fills them up to length 1 (0 for a query), which keeps the order.  The
search runs in single precision; the score of everything found is the inner
product of the original vectors in double precision.

Of equal vectors a graph has one node with the smallest ids; more than the
wanted number of them can never be in a result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescope.llm.common import keep, release, ship

TOP = 20
#: Distinct vectors of a shard (a task holds one shard).
SHARD = 8192
#: Links of a node on each level above the lowest, which has twice as many.
LINKS = 16
#: Candidates kept while a node is inserted and while a query is searched.
BUILD_BEAM, SEARCH_BEAM = 64, 160
#: Nodes inserted at a time, queries searched at a time and queries in a row.
INSERT, SEARCH, QUERY_BLOCK = 256, 256, 2048
#: Candidates of the beam whose links are followed in one step.
STEP = 4
SEED = 20_250_117

GRAPH = ("dim int, shard int, vectors array<double>, ids array<long>, named array<boolean>, id_starts array<int>, "
         "entry int, links array<int>, level_starts array<int>, level_nodes array<int>, level_links array<int>")


@dataclass
class Graph:
    x: np.ndarray               # nodes x (dim + 1), unit length, single precision
    links: list[np.ndarray]     # by level: nodes x links of the level, -1 where there is none
    entry: int


def on_sphere(vectors: np.ndarray, length: float) -> np.ndarray:
    """Vectors over ``length`` (not above it), filled up to length 1."""
    scaled = vectors / length
    rest = np.sqrt(np.maximum(1 - (scaled * scaled).sum(axis=1, keepdims=True), 0))
    return np.concatenate([scaled, rest], axis=1).astype(np.float32)


def lengths(vectors: np.ndarray) -> np.ndarray:
    """Euclidean lengths, without overflow on the way."""
    top = np.abs(vectors).max(axis=1, keepdims=True)
    top[top == 0] = 1
    return top[:, 0] * np.sqrt(((vectors / top) ** 2).sum(axis=1))


def beam(x: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray,
         width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each query the ``width`` best nodes met and their likeness, best
    first (-1 and -inf where fewer were met).  ``entries``: nodes to start at,
    -1 for none; every query has one."""
    n, b = len(x), len(queries)
    seen = np.zeros((b, n + 1), bool)
    seen[:, n] = True
    out_ids = np.full((b, width), -1, np.int64)
    out_sims = np.full((b, width), -np.inf, np.float32)
    row = np.arange(b)  # the query of each row that is still searched
    ids = np.full((b, width), -1, np.int64)
    sims = np.full((b, width), -np.inf, np.float32)
    closed = np.ones((b, width), bool)
    new = entries
    while True:
        new = np.sort(new, axis=1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
        at, col = np.nonzero(~seen[row[:, None], new])
        node = new[at, col]
        seen[row[at], node] = True
        fresh = np.full(new.shape, -np.inf, np.float32)
        fresh[at, col] = np.einsum("ij,ij->i", x[node], queries[row[at]])
        fresh_ids = np.where(fresh > -np.inf, new, -1)
        every, likeness = np.concatenate([ids, fresh_ids], axis=1), np.concatenate([sims, fresh], axis=1)
        shut = np.concatenate([closed, fresh_ids < 0], axis=1)
        best = np.argpartition(-likeness, width - 1, axis=1)[:, :width]
        ids, sims = np.take_along_axis(every, best, 1), np.take_along_axis(likeness, best, 1)
        closed = np.take_along_axis(shut, best, 1)
        ended = closed.all(axis=1)
        if ended.any():
            out_ids[row[ended]], out_sims[row[ended]] = ids[ended], sims[ended]
            go = ~ended
            row, ids, sims, closed = row[go], ids[go], sims[go], closed[go]
            if not len(row):
                break
        step = min(STEP, width)
        nexts = np.argpartition(np.where(closed, np.inf, -sims), step - 1, axis=1)[:, :step]
        chosen = np.where(np.take_along_axis(closed, nexts, 1), -1, np.take_along_axis(ids, nexts, 1))
        np.put_along_axis(closed, nexts, True, 1)
        new = np.where(chosen[:, :, None] < 0, -1, links[chosen]).reshape(len(row), -1).astype(np.int64)
    order = np.argsort(-out_sims, axis=1, kind="stable")
    return np.take_along_axis(out_ids, order, 1), np.take_along_axis(out_sims, order, 1)


def thin(x: np.ndarray, own: np.ndarray, cand: np.ndarray, keep_n: int) -> np.ndarray:
    """Links of the nodes ``own`` among their candidates (-1: none): the next
    best that is nearer to the node than to any link taken before, and what is
    left over by likeness if there is room."""
    n, k = cand.shape
    vec = x[cand]
    to_own = np.einsum("nkd,nd->nk", vec, x[own])
    to_own[cand < 0] = -np.inf
    order = np.argsort(-to_own, axis=1, kind="stable")
    cand, to_own = np.take_along_axis(cand, order, 1), np.take_along_axis(to_own, order, 1)
    vec = np.take_along_axis(vec, order[:, :, None], 1)
    among = vec @ vec.transpose(0, 2, 1)
    taken, blocked = np.zeros((n, k), bool), cand < 0
    count = np.zeros(n, int)
    for j in range(k):
        take = ~blocked[:, j] & (count < keep_n)
        taken[:, j] = take
        count += take
        blocked |= take[:, None] & (among[:, j] > to_own)
    # those taken come first, then the rest, each by likeness
    rank = np.argsort(np.where(cand < 0, 2, np.where(taken, 0, 1)), axis=1, kind="stable")[:, :keep_n]
    out = np.take_along_axis(cand, rank, 1)
    return np.pad(out, ((0, 0), (0, keep_n - out.shape[1])), constant_values=-1)


def _link_back(x: np.ndarray, links: np.ndarray, own: np.ndarray, chosen: np.ndarray) -> None:
    """Add each node of ``own`` to the lists of its links; a list that
    overflows is thinned."""
    room = links.shape[1]
    src, dst = np.repeat(own, chosen.shape[1]), chosen.ravel()
    src, dst = src[dst >= 0], dst[dst >= 0]
    order = np.argsort(dst, kind="stable")
    src, dst = src[order], dst[order]
    nodes, first, number = np.unique(dst, return_index=True, return_counts=True)
    place = np.arange(len(dst)) - np.repeat(first, number)
    for lo in range(0, len(nodes), 512):
        some = slice(lo, min(lo + 512, len(nodes)))
        part = slice(first[lo], first[some.stop] if some.stop < len(nodes) else len(dst))
        added = np.full((some.stop - lo, number[some].max()), -1, np.int64)
        added[np.repeat(np.arange(some.stop - lo), number[some]), place[part]] = src[part]
        own_links = links[nodes[some]]
        # a link may stand already (both sides were inserted together)
        added[(added[:, :, None] == own_links[:, None, :]).any(axis=2)] = -1
        both = np.concatenate([own_links, added], axis=1)
        both = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)
        full = (both >= 0).sum(axis=1) > room
        fits = both[~full][:, :room]
        links[nodes[some][~full]] = fits
        if full.any():
            over, at = both[full], nodes[some][full]
            if over.shape[1] > 2 * room:  # the nearest of very many
                like = np.einsum("nkd,nd->nk", x[over], x[at])
                like[over < 0] = -np.inf
                over = np.take_along_axis(over, np.argpartition(-like, 2 * room, axis=1)[:, :2 * room], 1)
            links[at] = thin(x, at, over, room)


def build_graph(x: np.ndarray, n_links: int = LINKS, width: int = BUILD_BEAM, insert: int = INSERT,
                seed: int = SEED) -> Graph:
    """A graph over the unit vectors ``x``; the same for the same rows."""
    n = len(x)
    rng = np.random.default_rng(seed)
    level = np.floor(-np.log(1 - rng.random(n)) / np.log(n_links)).astype(int)
    order = rng.permutation(n)
    links = [np.full((n, 2 * n_links if at == 0 else n_links), -1, np.int64) for at in range(level.max(initial=0) + 1)]
    entry, top, done = int(order[0]), int(level[order[0]]), 0
    while done < n:
        # as many as are in already, so that most of what is near is found by the graph
        batch = order[done:done + max(1, min(insert, done))]
        near = np.full((len(batch), 1), entry)
        for at in range(len(links) - 1, -1, -1):
            mine = np.flatnonzero(level[batch] >= at)
            if done and at <= top:
                found, _ = beam(x, links[at], x[batch], near, width if at == 0 or len(mine) else 8)
                near = found[:, :8]
            else:
                found = np.full((len(batch), 1), -1)
            if not len(mine):
                continue
            own = batch[mine]
            # those inserted together: the nearest by all pairs of the batch
            like = x[own] @ x[own].T
            np.fill_diagonal(like, -np.inf)
            k = min(2 * n_links, len(own))
            mates = np.argpartition(-like, k - 1, axis=1)[:, :k]
            mates = np.where(np.take_along_axis(like, mates, 1) == -np.inf, -1, own[mates])
            chosen = thin(x, own, np.concatenate([found[mine], mates], axis=1), n_links)
            links[at][own, :n_links] = chosen
            _link_back(x, links[at], own, chosen)
        high = batch[np.argmax(level[batch])]
        if level[high] > top:
            entry, top = int(high), int(level[high])
        done += len(batch)
    return Graph(x, links, entry)


def search_graph(graph: Graph, queries: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` best nodes found for each query, best first, -1: none."""
    near = np.full((len(queries), 1), graph.entry)
    for links in graph.links[:0:-1]:
        near = beam(graph.x, links, queries, near, 8)[0]
    return beam(graph.x, graph.links[0], queries, near, width)[0]


def _graph_row(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The graph of one shard as a row of flat arrays."""
    vectors = np.stack([np.asarray(v, np.float64) for v in rows["vector"]])
    order = np.lexsort(vectors.T[::-1])  # whatever the order in which the rows came
    vectors = vectors[order]
    listed = [rows["ids"].iloc[i] for i in order]
    flags = [rows["named"].iloc[i] for i in order]
    graph = build_graph(on_sphere(vectors, lengths(vectors).max()))
    nodes = [np.flatnonzero((links >= 0).any(axis=1)) for links in graph.links[1:]]
    flat = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts]).astype(np.int32)
    return pd.DataFrame([{
        "dim": key[0], "shard": key[1], "vectors": vectors.ravel(),
        "ids": np.concatenate(listed), "named": np.concatenate(flags),
        "id_starts": flat([np.cumsum([0, *map(len, listed)])]), "entry": graph.entry,
        "links": graph.links[0].ravel().astype(np.int32),
        "level_starts": flat([np.cumsum([0, *map(len, nodes)])]), "level_nodes": flat(nodes),
        "level_links": flat([links[at].ravel() for links, at in zip(graph.links[1:], nodes)])}])


def graph_of(row) -> tuple[np.ndarray, Graph]:
    """The original vectors and the graph of a ``GRAPH`` row."""
    vectors = np.asarray(row.vectors, np.float64).reshape(-1, row.dim)
    n = len(vectors)
    links = [np.asarray(row.links, np.int64).reshape(n, -1)]
    starts, nodes = np.asarray(row.level_starts), np.asarray(row.level_nodes)
    flat = np.asarray(row.level_links, np.int64).reshape(len(nodes), -1) if len(nodes) else None
    for a, b in zip(starts[:-1], starts[1:]):
        level = np.full((n, flat.shape[1] if flat is not None else 1), -1, np.int64)
        if b > a:
            level[nodes[a:b]] = flat[a:b]
        links.append(level)
    return vectors, Graph(on_sphere(vectors, lengths(vectors).max()), links, int(row.entry))


def _best_of(row, top: int, width: int) -> Iterator[pd.DataFrame]:
    """The ``top`` of one shard for each query of a packed row."""
    vectors, graph = graph_of(row)
    starts, ids = np.asarray(row.id_starts), np.asarray(row.ids)
    named = np.asarray(row.named, bool)
    asked = np.asarray(row.q_vectors, np.float64).reshape(-1, row.dim)
    number, own = np.asarray(row.q_numbers), np.asarray(row.q_ids)
    for lo in range(0, len(asked), SEARCH):
        q = asked[lo:lo + SEARCH]
        turned = np.concatenate([q / lengths(q)[:, None], np.zeros((len(q), 1))], axis=1).astype(np.float32)
        found = search_graph(graph, turned, max(width, top + 1))
        # one row a found node, scored on the original vectors
        at, col = np.nonzero(found >= 0)
        node = found[at, col]
        score = (vectors[node] * q[at]).sum(axis=1)
        same = (vectors[node] == q[at]).all(axis=1)
        # one row an id of each node, without the query itself
        n_ids = starts[node + 1] - starts[node]
        of = np.repeat(np.arange(len(node)), n_ids)
        place = starts[node][of] + np.arange(len(of)) - np.repeat(np.cumsum(n_ids) - n_ids, n_ids)
        vec_id, known = ids[place], named[place]
        self_ = same[of] & known & (vec_id == own[lo + at[of]])
        once = np.zeros(len(of), bool)  # of rows that repeat the query one goes
        hits = np.flatnonzero(self_)
        once[hits[np.unique(at[of][hits], return_index=True)[1]]] = True
        keep_ = ~once
        at_q, vec_id, known, sc = at[of][keep_], vec_id[keep_], known[keep_], score[of][keep_]
        order = np.lexsort((vec_id, ~known, -sc, at_q))
        at_q, vec_id, known, sc = at_q[order], vec_id[order], known[order], sc[order]
        begin = np.searchsorted(at_q, np.arange(len(q)))
        first = np.arange(len(at_q)) - begin[at_q] < top
        found_ids = pd.array(vec_id[first], "Int64")
        found_ids[~known[first]] = pd.NA
        yield pd.DataFrame({"number": number[lo + at_q[first]], "vec_id": found_ids, "score": sc[first]})


def usable(rows: DataFrame, dim: str = "dim") -> DataFrame:
    """Rows whose vector has a direction: not null, not empty, not zero, no
    null or non-finite component."""
    return rows.where("embedding is not null").where(
        "size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) "
        "and abs(x) < double('infinity')) and exists(embedding, x -> x <> 0)").withColumn(dim, F.size("embedding"))


def build_index(rows: DataFrame, top: int = TOP, shard: int = SHARD) -> DataFrame:
    """The kept ``GRAPH`` rows of ``rows`` (``vec_id, embedding``)."""
    clean = usable(rows.select("vec_id", "embedding"))
    # of equal vectors the smallest ids; cut before the shuffle, so that a
    # vector with very many copies is top + 1 rows a task
    low = Window.partitionBy("embedding").orderBy(F.col("vec_id").asc_nulls_last())
    few = clean.withColumn("copy", F.row_number().over(low)).where(F.col("copy") <= top + 1)
    listed = F.array_sort(F.collect_list(F.struct(F.col("vec_id").isNull().alias("unnamed"), "vec_id")))
    nodes = few.groupBy("embedding").agg(F.first("dim").alias("dim"), listed.alias("listed"))
    nodes = keep(nodes.select(
        "dim", F.col("embedding").cast("array<double>").alias("vector"),
        F.transform("listed", lambda s: F.coalesce(s["vec_id"], F.lit(0)).cast("long")).alias("ids"),
        F.transform("listed", lambda s: ~s["unnamed"]).alias("named")), "graph-nodes")
    shards = max(1, -(-nodes.count() // shard))
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int"))
    graphs = keep(dealt.groupBy("dim", "shard").applyInPandas(_graph_row, GRAPH), "graphs")
    release(nodes)
    return graphs


def search_index(graphs: DataFrame, queries: DataFrame, top: int = TOP, width: int = SEARCH_BEAM) -> DataFrame:
    """``query_id, rank, vec_id, score`` of ``queries`` (``vec_id, embedding``)."""
    shards = graphs.agg(F.coalesce(F.max("shard"), F.lit(-1))).first()[0] + 1
    asked = keep(usable(queries.select("vec_id", "embedding")).select(
        F.monotonically_increasing_id().alias("number"), "vec_id", "dim",
        F.col("embedding").cast("array<double>").alias("vector")), "graph-queries")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for dim, of in b.groupby("dim"):
                for lo in range(0, len(of), QUERY_BLOCK):
                    some = of.iloc[lo:lo + QUERY_BLOCK]
                    yield pd.DataFrame([{"q_dim": dim, "q_numbers": some["number"].to_numpy(np.int64),
                                         "q_ids": some["vec_id"].to_numpy(np.int64),
                                         "q_vectors": np.concatenate(some["vector"].to_list())}])

    blocks = asked.where("vec_id is not null").mapInPandas(
        pack, "q_dim int, q_numbers array<long>, q_ids array<long>, q_vectors array<double>")
    each = blocks.withColumn("q_shard", F.explode(F.sequence(F.lit(0), F.lit(max(shards, 1) - 1))))
    met = each.join(graphs, (F.col("q_dim") == F.col("dim")) & (F.col("q_shard") == F.col("shard")))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for row in b.itertuples(index=False):
                yield from _best_of(row, top, width)

    found = met.drop("q_dim", "q_shard").mapInPandas(search, "number long, vec_id long, score double")
    # the best of all shards; Spark cuts each task's share to ``top`` before the shuffle
    best = Window.partitionBy("number").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    names = asked.select(F.col("number").alias("of"), F.col("vec_id").alias("query_id"))
    return ranked.join(names, F.col("number") == F.col("of")).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest_neighbours(rows: DataFrame, queries: DataFrame, top: int = TOP, shard: int = SHARD,
                       width: int = SEARCH_BEAM) -> DataFrame:
    """``query_id, rank, vec_id, score``: of each row of ``queries`` its
    ``top`` nearest rows found in ``rows`` by inner product (both ``vec_id,
    embedding``), nearest first, ties to the smaller id; all, if fewer.

    Null, empty and zero vectors and those with a null or non-finite component
    take no part on either side; only vectors with as many components as the
    query's are compared.  A query's own row (its id and vector) is no
    candidate; a row that repeats it is one, and repeated queries are answered
    each.  Queries with a null id are not answered; candidates with a null id
    come last in ties.  Empty tables give an empty one; other columns are not
    read.  What is found is approximate (recall is tested, at least 0.9).
    """
    return search_index(build_index(rows, top, shard), queries, top, width)


ship(__name__)
