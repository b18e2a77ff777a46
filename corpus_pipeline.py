"""A training-corpus pipeline over ``documents``: language ID, line dedup,
SimHash near-dedup, benchmark decontamination, mixing sources.

Each stage takes (spark, docs, sf_dir), works on all that the stage before
kept, and returns a DataFrame that is written as Parquet and read again as the
next one's ``docs``.  All but the last return the columns of ``docs``; the rows
that stay carry all of them, also other columns than those of ``documents``.

In every stage an empty table gives an empty one, repeated rows are rows of
their own unless the stage says otherwise, and columns with names that the
operators use for their results are neither read nor changed (the last stage
replaces those that it returns).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm import decontam, langid, linededup, mixing, simhash
from salescope.llm.common import keep
from salescope.sources.tables import table


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with confidence; the models learn from
    all labelled documents.  Null and empty texts and those without a letter go
    too; a null ``lang`` or id decides nothing, and rows that repeat are judged
    alike.  Very long texts are read whole, piece by piece."""
    model = langid.fit_languages(docs)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return langid.identify(docs, model, "__language").where("__language.accepted").select(*columns)


def delete_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines are deleted; documents of which
    nothing is left go.  ``n_chars`` follows the text.  Null and empty texts
    have no line to delete and stay as they are; of rows that repeat the first
    keeps its lines (ids in order, null ids last)."""
    out = linededup.dedup_lines(docs, runs="__runs_out", lines="__lines_out")
    left = (F.col("__lines_out") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    chars = F.when(F.col("__lines_out") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return out.where(left).withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType)).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints that links of at most two
    bits join: the one with the smallest id (null ids last), of rows that repeat
    it one.  Texts without a word have fingerprint 0 and are one group."""
    return simhash.drop_near_duplicates(docs, shingle=3, max_bits=2)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item (within the edit
    budget).  Null and empty texts hold none and stay; null items match
    nothing; rows that repeat go or stay together."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with ``copies`` and ``taken``.  Texts
    without a word are never taken as a copy beyond the whole ones; a null
    source is a source of its own; rows that repeat are taken one by one."""
    return mixing.mix_sources(docs).where("copies > 0")


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", delete_repeated_lines),
    ("simhash_near_dedup", keep_one_of_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("source_mixing", mix_to_target_weights),
]

#: Language models cannot be trained in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
