"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target of words.  ``target / source size`` says how many
whole copies are taken of every document of the source; the words that are
left of the target go to a sample with unequal probabilities.  A document's
inclusion probability is in proportion to its size, ``p = min(1, c size)``,
with the ``c`` for which the expected words are those left: documents for
which ``p`` would pass 1 are certain, and what they would have had above it is
shared again among the others until none is above.  For the sample documents
are ranked by ``(u / (1 - u)) / (p / (1 - p))``, the odds of a random number
that belongs to the document over its inclusion odds (0 for certain ones), and
the first in rank are taken as long as their words fit in what the target has
left.  The gap that is left goes, in further rounds, to the next in rank that
fit in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.llm.common import keep, release, with_row_id, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CEILING = 2
ROUNDS = 3
#: Rank buckets of a source: prefix sums go over buckets first, and only the
#: documents of the bucket that holds the cut are put in order.
BUCKETS = 65_536
#: The bucket of certain documents, before all others.
CERTAIN = -1
#: Rank odds over 1 + odds when nothing has been taken.
NONE_TAKEN = -1.0


def random_number(doc_id: Column, text: Column) -> Column:
    """A number inside (0, 1) that belongs to a document: 52 bits of the MD5
    of its id and its text's MD5."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"),
                   F.md5(F.coalesce(text, F.lit(""))))
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def sized(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with ``__size`` (words), ``__u`` and ``__source``."""
    return docs.select("*", word_count(F.col(text)).alias("__size"),
                       random_number(F.col(doc_id), F.col(text)).alias("__u"),
                       F.col(source).alias("__source"))


def source_targets(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, ceiling: int = CEILING) -> DataFrame:
    """``(__source, __source_size, __target)``, one row a source.

    Weights go round the sources by code point, null last.  The target is
    ``min(ceiling x size, level x weight)``: the excess of sources at their
    ceiling is shared again by weight until none is above.  In the order of
    ceiling over weight the level is the greatest of (total - ceilings before)
    / (weights not before).  The windows go over one row a source.
    """
    sizes = rows.groupBy("__source").agg(F.sum("__size").alias("__source_size"))
    at = F.row_number().over(Window.orderBy(F.col("__source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = sizes.withColumn("__at", at).withColumn(
        "__weight", F.element_at(cycle, (F.col("__at") % len(weights) + 1).cast("int"))).withColumn(
        "__ceiling", F.col("__source_size") * ceiling)
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("__ceiling") / F.col("__weight"), "__at").rowsBetween(
        Window.unboundedPreceding, -1)
    level = ((F.sum("__source_size").over(everything) * F.lit(share)
              - F.coalesce(F.sum("__ceiling").over(before), F.lit(0)))
             / (F.sum("__weight").over(everything) - F.coalesce(F.sum("__weight").over(before), F.lit(0))))
    return (ranked.withColumn("__level", level)
            .withColumn("__level", F.max("__level").over(everything))
            .select("__source", "__source_size",
                    F.least(F.col("__ceiling").cast("double"),
                            F.col("__level") * F.col("__weight")).alias("__target")))


def _copies(state: DataFrame) -> DataFrame:
    """Whole copies and the words left to the sample."""
    ratio = F.when(F.col("__source_size") > 0, F.col("__target") / F.col("__source_size")).otherwise(F.lit(0.0))
    return (state.withColumn("__whole", F.floor(ratio))
            .withColumn("__gap1", F.col("__target") - F.col("__whole") * F.col("__source_size")))


def with_inclusion(rows: DataFrame, state: DataFrame) -> DataFrame:
    """``state`` with ``__c``: the inclusion probability of a document is
    ``min(1, __c size)``.

    Works on one row a source and size.  With the sizes above ``s`` certain, the
    others share ``(gap - words of the certain) / (sum of their squares)``; the
    greatest ``s`` whose documents then stay at 1 or below is the right one.
    """
    sizes = rows.where("__size > 0").groupBy("__source", "__size").agg(F.count(F.lit(1)).alias("__n"))
    down = Window.partitionBy("__source").orderBy(F.desc("__size")).rowsBetween(Window.unboundedPreceding, -1)
    up = Window.partitionBy("__source").orderBy("__size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    words = (F.col("__n") * F.col("__size")).cast("decimal(38,0)")
    sums = sizes.withColumn("__larger", F.coalesce(F.sum(words).over(down), F.lit(0)).cast("double")).withColumn(
        "__squares", F.sum((words * F.col("__size")).cast("decimal(38,0)")).over(up).cast("double"))
    s = state.select(F.col("__source").alias("__key"), "__gap1")
    share = (F.col("__gap1") - F.col("__larger")) / F.col("__squares")
    fit = sums.join(s, F.col("__source").eqNullSafe(F.col("__key"))).withColumn("__c", share).where(
        F.col("__c") * F.col("__size") <= 1)
    found = fit.groupBy(F.col("__source").alias("__key")).agg(F.max_by("__c", "__size").alias("__c"))
    return state.join(found, F.col("__source").eqNullSafe(F.col("__key")), "left").drop("__key").withColumn(
        "__c", F.coalesce("__c", F.lit(0.0)))


def inclusion() -> Column:
    """A document's inclusion probability."""
    return F.least(F.col("__c") * F.col("__size"), F.lit(1.0))


def _rank() -> Column:
    """Pareto rank of a document, as rank / (1 + rank), below 1; 0 if certain,
    null if it can't be taken."""
    p = inclusion()
    odds = (F.col("__u") / (1 - F.col("__u"))) / (p / (1 - p))
    return F.when(p >= 1, F.lit(0.0)).when(p > 0, odds / (1 + odds))


def _taken_in(r: int) -> Column:
    """Up to the cut, of rows with the cut's rank up to the cut's row (all
    without one)."""
    cut, row = F.col(f"__cut{r}"), F.col(f"__cutrow{r}")
    upto = (F.col("__rank") < cut) | (F.col("__rank") == cut) & (row.isNull() | (F.col("__row") <= row))
    return (F.col("__size") <= F.col(f"__gap{r}")) & upto


def _left_after(r: int) -> Column:
    left = F.col("__rank").isNotNull()
    for i in range(1, r + 1):
        left = left & ~_taken_in(i)
    return left


def _with_state(rows: DataFrame, state: DataFrame) -> DataFrame:
    s = state.withColumnRenamed("__source", "__key")
    return rows.join(s, F.col("__source").eqNullSafe(F.col("__key"))).drop("__key").withColumn("__rank", _rank())


def mixing_plan(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, ceiling: int = CEILING,
                rounds: int = ROUNDS) -> DataFrame:
    """The cuts of every source, one row a source, from ``sized`` rows.

    A round sums words by (source, rank bucket), combined map-side, finds the
    bucket in which the gap ends by a window over at most ``BUCKETS`` rows a
    source, and orders only that bucket's documents (1 in ``BUCKETS`` of the
    source, the hot one too; the words of certain documents always fit).
    """
    state = keep(with_inclusion(rows, _copies(source_targets(rows, weights, share, ceiling))), "mix-state")
    for r in range(1, rounds + 1):
        bucket = F.when(F.col("__rank") == 0, F.lit(CERTAIN)).otherwise(F.floor(F.col("__rank") * BUCKETS))
        open_ = (_with_state(rows, state).where(_left_after(r - 1) & (F.col("__size") <= F.col(f"__gap{r}")))
                 .select("__source", "__size", "__rank", "__row", f"__gap{r}", bucket.alias("__bucket")))
        by_bucket = open_.groupBy("__source", "__bucket", f"__gap{r}").agg(F.sum("__size").alias("__words"))
        run = Window.partitionBy("__source").orderBy("__bucket")
        sums = by_bucket.withColumn("__sum", F.sum("__words").over(run))
        # the first bucket beyond the gap, or none if all fit
        at = sums.groupBy(F.col("__source").alias("__key")).agg(
            F.coalesce(F.min(F.when(F.col("__sum") > F.col(f"__gap{r}"), F.col("__bucket"))),
                       F.lit(BUCKETS)).alias("__at"),
            F.coalesce(F.max(F.when(F.col("__sum") <= F.col(f"__gap{r}"), F.col("__sum"))),
                       F.lit(0)).alias("__before"))
        same = F.col("__source").eqNullSafe(F.col("__key"))
        in_cut = open_.join(at, same & (F.col("__bucket") == F.col("__at")))
        order = Window.partitionBy("__source").orderBy("__rank", "__row").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        fits = (in_cut.withColumn("__sum", F.col("__before") + F.sum("__size").over(order))
                .where(F.col("__sum") <= F.col(f"__gap{r}"))
                .groupBy(F.col("__source").alias("__fit")).agg(
                    F.max(F.struct("__rank", "__row")).alias("__top"), F.max("__sum").alias("__used")))
        nxt = state.join(at, same, "left").drop("__key")
        nxt = nxt.join(fits, F.col("__source").eqNullSafe(F.col("__fit")), "left").drop("__fit")
        # all of the buckets before the cut are in: their ranks end at its lower edge
        edge = F.when(F.col("__at") > CERTAIN, F.greatest(F.col("__at") / F.lit(BUCKETS) - F.lit(2.0 ** -53),
                                                          F.lit(0.0))).otherwise(NONE_TAKEN)
        old, state = state, keep(
            nxt.withColumn(f"__cut{r}", F.coalesce("__top.__rank", edge, F.lit(NONE_TAKEN)))
            .withColumn(f"__cutrow{r}", F.col("__top.__row"))
            .withColumn(f"__gap{r + 1}", F.col(f"__gap{r}") - F.coalesce("__used", "__before", F.lit(0)))
            .drop("__at", "__before", "__top", "__used"), "mix-state")
        release(old)
    return state


def apply_mix(rows: DataFrame, state: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``sized`` rows with ``__copies`` (0, 1 or more) and their source's state."""
    extra = F.lit(0)
    for r in range(rounds, 0, -1):
        extra = F.when(_taken_in(r), 1).otherwise(extra)
    extra = F.when(F.col("__rank").isNotNull(), extra).otherwise(0)
    return _with_state(rows, state).withColumn("__copies", (F.col("__whole") + extra).cast("long"))


def mix_sources(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, ceiling: int = CEILING) -> DataFrame:
    """All documents with ``size, source_size, target, inclusion, copies,
    taken`` in place of columns of the same names; ``inclusion`` is the
    probability of a copy beyond the whole ones.

    Null or empty text: size 0, taken 0.  A null source is a source of its
    own, the last.  Documents with equal id and text have one rank and are
    taken in the order of their rows.  A source without words has target 0.
    An empty table gives an empty one.  Reruns agree: all randomness is a hash
    of id and text.
    """
    rows = sized(with_row_id(docs))
    narrow = keep(rows.select("__row", "__source", "__size", "__u"), "mix-sizes")
    out = apply_mix(rows, mixing_plan(narrow, weights, share, ceiling))
    names = {"size": "__size", "source_size": "__source_size", "target": "__target", "copies": "__copies"}
    own = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in (*names, "taken", "inclusion")]
    return out.select(*own, *[F.col(v).alias(k) for k, v in names.items()], inclusion().alias("inclusion"),
                      (F.col("__copies") * F.col("__size")).alias("taken"))
