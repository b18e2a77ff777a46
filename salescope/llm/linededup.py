"""Line dedup: later copies of repeated runs of lines are deleted.

The lines of a document, blank ones left out, are a sequence of line ids.
Distributed prefix doubling ranks all suffixes of all sequences by their first
1, 2, 4, ... lines: the rank of a suffix by ``2h`` lines is the order of the
pair (its rank by ``h``, the rank by ``h`` of the suffix ``h`` lines on).  A
suffix whose first ``h`` lines occur once is in no repeat of that length and
leaves.  Suffixes whose common prefix has ``n`` lines form an interval of the
suffix array of lcp value ``n``; with ``h`` the largest power of two in ``n``
such an interval is known by two ranks: that of the suffix by ``h`` lines and
that of the suffix ``n - h`` lines on.

A repeat counts if it has at least ``min_words`` words.  A line is deleted if a
repeated run that holds it begins at an earlier place too.  Every such run is
the union of the shortest runs of ``min_words`` words that start or end at one
of its lines, so the intervals of just these lengths (two for each line) give
the maximal runs; and as each line has a word, no such length is over
``min_words``, which ends the doubling after ``log2(min_words)`` rounds at the
latest, however long documents are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.llm.common import WORD, keep, release, with_row_id

MIN_WORDS = 50


def _place() -> Column:
    """Where a suffix starts, in reading order (null ids last)."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "seq")


def _lines(rows: DataFrame) -> DataFrame:
    """One row a line that has a word: (row, doc_id, seq, line, words, h1, h2)."""
    numbered = F.filter(F.transform(F.split("text", "\n"), lambda l, i: F.struct(
        i.alias("line"), F.btrim(l, F.lit(" \t\n\x0b\x0c\r")).alias("content"))), lambda x: x["content"] != "")
    one = rows.where("text is not null").select(
        F.col("__row").alias("row"), "doc_id", F.posexplode(numbered).alias("seq", "x"))
    return one.select("row", "doc_id", "seq", F.col("x.line").alias("line"),
                      F.regexp_count(F.col("x.content"), F.lit(WORD)).alias("words"),
                      F.xxhash64("x.content").alias("h1"),
                      F.xxhash64(F.lit(1), F.col("x.content")).alias("h2"))


def _ranks(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Order-keeping ranks of the pairs that occur more than once.  Counting is
    combined map-side; the range partitions of the different pairs are in
    order and so are the ids of their sorted rows."""
    again = pairs.groupBy(a, b).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(a, b)
    return keep(again.repartitionByRange(a, b).sortWithinPartitions(a, b)
                .withColumn("rank", F.monotonically_increasing_id()), "line-ranks")


def _islands(lines: DataFrame, min_words: int) -> DataFrame:
    """Stretches of repeated lines with ``min_words`` words or more, as arrays:
    ``r`` rank, ``ln`` line number, ``f`` / ``b`` lines in the shortest run of
    that many words that starts / ends at a line (null: there is none)."""
    rows = lines.withColumn("island", F.col("seq") - F.row_number().over(
        Window.partitionBy("row").orderBy("seq")))
    inside = Window.partitionBy("row", "island")
    rows = rows.withColumn("e", F.sum("words").over(inside.orderBy("seq"))).withColumn(
        "s", F.col("e") - F.col("words")).withColumn("total", F.sum("words").over(inside))
    rows = rows.where(F.col("total") >= min_words)
    n = F.count(F.lit(1))
    rows = rows.withColumn("f", F.when(F.col("s") + min_words <= F.col("total"),
                                       n.over(inside.orderBy("s").rangeBetween(0, min_words - 1)))).withColumn(
        "b", F.when(F.col("e") >= min_words, n.over(inside.orderBy("e").rangeBetween(1 - min_words, 0))))
    cells = rows.groupBy("row", "island").agg(
        F.first("doc_id").alias("doc_id"),
        F.array_sort(F.collect_list(F.struct("seq", "rank", "line", "f", "b"))).alias("x"))
    return cells.select("row", "island", "doc_id", F.col("x.seq")[0].alias("at"), F.col("x.rank").alias("r"),
                        F.col("x.line").alias("ln"), F.col("x.f").alias("f"), F.col("x.b").alias("b"))


def _intervals(d: DataFrame, h: int) -> DataFrame:
    """The shortest runs of h to 2h - 1 lines whose both ranks by h lines are
    known: the members of the lcp intervals of these lengths."""

    def kind(name: str, length: str, first: str) -> DataFrame:
        cells = F.expr(f"""filter(transform(sequence(0, size(r) - 1), i -> named_struct(
            'i', {first}, 'n', {length}[i], 'k1', get(r, {first}), 'k2', get(r, {first} + {length}[i] - {h}))),
            x -> x.n >= {h} and x.n < {2 * h} and x.k1 is not null and x.k2 is not null)""")
        return d.select("row", "doc_id", "at", "ln", F.explode(cells).alias("x")).select(
            "row", "doc_id", (F.col("at") + F.col("x.i")).alias("seq"), F.col("x.n").alias("n"),
            F.expr("ln[x.i]").alias("from_line"), F.expr("ln[x.i + x.n - 1]").alias("to_line"),
            F.lit(name).alias("kind"), F.lit(h).alias("h"), F.col("x.k1").alias("k1"), F.col("x.k2").alias("k2"))

    return kind("start", "f", "i").union(kind("end", "b", "coalesce(i - b[i] + 1, i)"))


def _double(d: DataFrame, h: int) -> DataFrame:
    """Ranks by 2h lines from ranks by h lines."""
    cells = F.expr(f"transform(sequence(0, size(r) - 1), i -> named_struct("
                   f"'i', i, 'p', r[i], 'q', if(i + {h} < size(r), r[i + {h}], null)))")
    pairs = d.select("row", "island", F.explode(cells).alias("x")).select(
        "row", "island", F.col("x.i").alias("i"), F.col("x.p").alias("p"), F.col("x.q").alias("q"))
    live = pairs.where("p is not null and q is not null")
    ranked = live.join(_ranks(live, "p", "q"), ["p", "q"]).select("row", "island", "i", "rank")
    # the places without a rank are filled in again, so that arrays keep their offsets
    r = ranked.groupBy("row", "island").agg(F.collect_list(F.struct("i", "rank")).alias("known"))
    grown = d.drop("r").join(r, ["row", "island"])
    gaps = F.array_sort(F.concat(
        F.col("known"),
        F.transform(F.array_except(F.sequence(F.lit(0), F.size("ln") - 1), F.col("known.i")),
                    lambda i: F.struct(i.alias("i"), F.lit(None).cast("long").alias("rank")))))
    return grown.withColumn("r", gaps["rank"]).drop("known")


def repeated_runs(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The maximal runs of lines to delete: ``(row, from_line, to_line,
    first_doc_id)``, line numbers from 0 and inclusive, from rows with ``__row,
    doc_id, text``.  ``first_doc_id``: the smallest of the documents that the
    run's pieces stand in first."""
    lines = keep(_lines(rows), "lines")
    named = lines.join(_ranks(lines, "h1", "h2"), ["h1", "h2"])
    d = keep(_islands(named, min_words), "line-islands")
    release(lines)
    found, h = [], 1
    while True:
        found.append(_intervals(d, h))
        longer = d.where(F.expr(f"exists(f, n -> n >= {2 * h}) or exists(b, n -> n >= {2 * h})"))
        if h * 2 > min_words or longer.isEmpty():
            break
        d, h = keep(_double(longer, h), "line-islands"), h * 2
    runs = keep(reduce(DataFrame.union, found), "line-runs")
    key = ["kind", "h", "n", "k1", "k2"]
    # kept, so that both sides of the join below are shuffles of their own and
    # a run that stands in very many places can be split
    first = keep(runs.groupBy(*key).agg(F.min(_place()).alias("first"), F.count(F.lit(1)).alias("times"))
                 .where("times > 1").drop("times"), "line-firsts")
    later = runs.join(first, key).where(
        ~((F.col("row") == F.col("first.row")) & (F.col("seq") == F.col("first.seq")))).select(
        "row", "seq", (F.col("seq") + F.col("n") - 1).alias("end"), "from_line", "to_line",
        F.col("first.doc_id").alias("first_doc_id"))
    # overlapping and adjacent pieces become one run; at most two pieces a line
    order = Window.partitionBy("row").orderBy("seq", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    merged = later.withColumn("new", F.coalesce((F.col("seq") > reach + 1).cast("int"), F.lit(1)))
    merged = merged.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return merged.groupBy("row", "run").agg(
        F.min("from_line").alias("from_line"), F.max("to_line").alias("to_line"),
        F.min("first_doc_id").alias("first_doc_id")).drop("run")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, runs: str = "removed_runs",
                lines: str = "removed_lines") -> DataFrame:
    """``docs`` with the later copies of repeated runs taken out of ``text``,
    and the columns ``runs`` (array of ``from_line, to_line, first_doc_id``) and
    ``lines`` (number) in place of columns of these names.

    Lines end at ``\\n``; white space at a line's ends does not count when
    lines are compared.  Blank lines are in no run of their own; those inside
    a deleted run go with it.  The copy that stays is the first by (doc_id,
    null last; row; line), also within one document.  Null text stays null,
    empty text stays empty, an empty table stays empty.  Repeated rows are
    copies: one keeps its lines.  Only ``doc_id`` and ``text`` are read; other
    columns pass through.
    """
    rows = with_row_id(docs)
    found = repeated_runs(rows.select("__row", "doc_id", "text"), min_words)
    by_row = found.groupBy(F.col("row").alias("__of")).agg(F.array_sort(F.collect_list(F.struct(
        "from_line", "to_line", "first_doc_id"))).alias("__runs"))
    joined = rows.join(by_row, F.col("__row") == F.col("__of"), "left")
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda _, i: ~F.exists(
        F.col("__runs"), lambda r: (r["from_line"] <= i) & (i <= r["to_line"]))), "\n")
    removed = F.aggregate("__runs", F.lit(0), lambda n, r: n + r["to_line"] - r["from_line"] + 1)
    own = [F.when(F.col("__runs").isNull(), F.col("text")).otherwise(kept).alias("text")
           if c == "text" else F.col(f"`{c}`")
           for c in docs.columns if c.lower() not in (runs.lower(), lines.lower())]
    return joined.select(*own, F.coalesce("__runs", F.array()).alias(runs),
                         F.coalesce(removed, F.lit(0)).alias(lines))
