"""Centroid clustering in JVM expressions.

Vectors are turned into whole numbers, ``floor(scale * x)``, so that every
distance and every mean is exact and a rerun gives the same bytes.  The
centroids of a round stand in the plan as one literal array of structs
(number, components): ``zip_with`` and ``aggregate`` give the squared distance
to each, ``array_min`` of (distance, number) the nearest one, ties to the
smaller number.  New centroids are column sums by cluster, one sum a
component, combined map-side: a task hands on at most a row a cluster, however
many vectors a cluster holds.  Only ``clusters x components`` numbers reach
the driver, whatever the table's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import keep, release

CLUSTERS = 40
ROUNDS = 5
COMPONENTS = 64
SCALE = 256
#: Components go to the nearest whole number of this range, so that no squared
#: distance passes 64 bits: (2 * LARGEST) ** 2 * COMPONENTS is below 2 ** 63.
LARGEST = 1 << 27


def whole_vector(embedding: Column, components: int = COMPONENTS, scale: int = SCALE,
                 largest: int = LARGEST) -> Column:
    """The components as integers; null unless there are exactly
    ``components``, none of them null or not finite."""
    x = embedding.cast("array<double>")
    usable = (F.size(x) == components) & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    # bounded before the cast: floor of a huge double has no long
    one = lambda v: F.floor(F.least(F.greatest(v * scale, F.lit(-float(largest))),
                                    F.lit(float(largest)))).cast("int")
    return F.when(usable, F.transform(x, one))


def _literal(centroids: list[list[int]]) -> Column:
    """The centroids as one constant: array<struct<number, components>>."""
    return F.array(*[F.struct(F.lit(i).alias("cluster"), F.array(*[F.lit(int(v)) for v in c]).alias("at"))
                     for i, c in enumerate(centroids)])


def nearest(vector: Column, centroids: list[list[int]]) -> Column:
    """(distance, cluster) of the nearest centroid, ties to the smaller number."""
    squared = lambda at: F.aggregate(
        F.zip_with(vector, at, lambda a, b: (a.cast("long") - b) * (a.cast("long") - b)),
        F.lit(0).cast("long"), lambda total, d: total + d)
    return F.array_min(F.transform(_literal(centroids), lambda c: F.struct(
        squared(c["at"]).alias("distance"), c["cluster"].alias("cluster"))))


def first_centroids(vectors: DataFrame, clusters: int, round_name: str) -> list[list[int]]:
    """The vectors of the ``clusters`` smallest SHA-256 of ``<round_name>:<id>``
    in the order of the hash; of equal hashes the smaller vector first."""
    key = F.sha2(F.concat(F.lit(f"{round_name}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("key"), "whole").orderBy("key", "whole").limit(clusters).collect()
    return [list(r.whole) for r in rows]


def next_centroids(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Componentwise floor of the means; an empty cluster's centroid stays."""
    near = vectors.select("whole", nearest(F.col("whole"), centroids)["cluster"].alias("cluster"))
    parts = near.select("cluster", *[F.col("whole")[i].alias(f"c{i}") for i in range(len(centroids[0]))])
    sums = parts.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[
        F.sum(f"c{i}").alias(f"c{i}") for i in range(len(centroids[0]))])
    out = list(centroids)
    for r in sums.collect():  # a row a cluster
        out[r.cluster] = [r[f"c{i}"] // r.n for i in range(len(centroids[0]))]
    return out


def cluster_vectors(rows: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS,
                    components: int = COMPONENTS, scale: int = SCALE, seed: str = "2") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256``, one row for each usable row of ``rows`` (``vec_id,
    embedding``).

    Rows whose vector is null, has another number of components or a null or
    non-finite one are left out.  Repeated rows each give a row and each count
    in the means.  A null id counts as the empty text where centroids are
    drawn.  Fewer vectors than ``clusters``: as many centroids as vectors;
    none: an empty table.  Components beyond ``LARGEST / scale`` count as that;
    an inertia that passes 64 bits is null.  Other columns are not read.
    """
    vectors = keep(rows.select("vec_id", whole_vector(F.col("embedding"), components, scale).alias("whole"))
                   .where("whole is not null"), "centroid-vectors")
    centroids = first_centroids(vectors, clusters, seed)
    if not centroids:
        return vectors.select("vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in (
            "distance", "cluster_inertia", "inertia")], F.lit("").alias("centroid_sha256"))
    for _ in range(rounds):
        centroids = next_centroids(vectors, centroids)
    near = keep(vectors.select("vec_id", nearest(F.col("whole"), centroids).alias("near"))
                .select("vec_id", "near.cluster", "near.distance"), "centroid-nearest")
    release(vectors)
    # one row a cluster, at most ``clusters``; decimals: a sum may pass 64 bits
    wide = F.sum(F.col("distance").cast("decimal(20,0)"))
    sums = {r.cluster: int(r.total) for r in near.groupBy("cluster").agg(wide.alias("total")).collect()}
    fits = lambda n: n if n < 1 << 63 else None
    facts = near.sparkSession.createDataFrame(
        [(c, fits(n), fits(sum(sums.values())), _digest(centroids[c])) for c, n in sorted(sums.items())],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return near.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _digest(centroid: list[int]) -> str:
    from hashlib import sha256
    return sha256(",".join(map(str, centroid)).encode()).hexdigest()
