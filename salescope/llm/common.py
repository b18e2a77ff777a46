"""Shared helpers of the training-data operators: kept tables, text rules,
shipping of worker code, connected components."""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.session import checkpoint_dir

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ship(module: str) -> None:
    """Send the functions of ``module`` to Python workers by value, so that
    executors need not have the package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder of the session."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.  Later plans
    see fixed rows (row ids stay as they are when a task is run again) and a
    lost executor costs a re-read, not a recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept._kept_path = path
    return kept


def release(df: DataFrame) -> None:
    """Delete a kept table that no later plan reads."""
    path = getattr(df, "_kept_path", None)
    if path is None:
        return
    sc = df.sparkSession.sparkContext
    hadoop_path = sc._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, ASCII_UPPER, ASCII_LOWER)


def word_count(c: Column) -> Column:
    """Number of words; null counts as 0."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def with_row_id(df: DataFrame, name: str = "__row") -> DataFrame:
    """``df`` with a row id that is the same in every plan and after a lost
    executor: a struct of the file's hash and the row's index in its file.
    Rows that do not come straight from files are written once first."""
    try:
        return df.select("*", F.struct(F.xxhash64("_metadata.file_path").alias("f"),
                                       F.col("_metadata.row_index").alias("i")).alias(name))
    except AnalysisException:
        return keep(df.withColumn(name, F.struct(F.lit(0).cast("long").alias("f"),
                                                 F.monotonically_increasing_id().alias("i"))), "rows")


def id_crc(doc_id: Column) -> Column:
    """CRC-32 of the id as text (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Components of an undirected graph given as long pairs ``(a, b)``.

    Alternates the large-star and small-star steps of Kiveris et al. (2014):
    every step is a map-side combined minimum by node and an equi-join, so a
    node with very many links costs one partial row a task and a join side
    that adaptive execution may split.  Each round is written to the shared
    folder; the round before it is deleted.  Returns ``(node, component)``
    for every node with a link to another, ``component`` being the smallest
    node reached.  No edges: an empty table.
    """
    cur = keep(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
               .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
               .distinct(), "cc")
    state = None
    for _ in range(max_rounds):
        both = cur.select("a", "b").union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # the minima are kept: a join of two shuffles can be split where a node
        # has very many links, one with an aggregate of the same rows cannot
        low = keep(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "cc-low")
        large = keep(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .where("a <> b").distinct(), "cc-large")
        # a large star leaves a node with few smaller neighbours: one a centre
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        nxt = keep(large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "cc")
        row = nxt.agg(F.count(F.lit(1)).alias("n"), F.sum(F.hash("a", "b").cast("long")).alias("h"),
                      F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        for old in (cur, low, large):
            release(old)
        cur, before, state = nxt, state, tuple(row)
        if state == before or row.n == 0:
            break
    else:
        raise RuntimeError("components did not settle")
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        cur.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


ship(__name__)
