"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm import (
    capfilters,
    centroids,
    collocations,
    decontam,
    graphsearch,
    langid,
    licenses,
    linededup,
    mixing,
    secrets,
    simhash,
    suffixtree,
    warc,
)
from salescope.llm.common import id_crc
from salescope.sources.tables import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.pmod(id_crc(F.col("doc_id")), F.lit(3)) == 1, F.lit(False))
    model = langid.fit_languages(docs.where(~held_out))
    return langid.identify(docs, model).select(
        "doc_id", held_out.alias("held_out"), F.col("language.lang_pred").alias("lang_pred"),
        F.col("language.score").alias("score"), F.col("language.cross_entropy").alias("cross_entropy"),
        F.col("language.accepted").alias("accepted"))


def op2_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


def op3_benchmark_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.pmod(id_crc(F.col("doc_id")), F.lit(10)) == 0, F.lit(False))
    docs = docs.withColumn("held_out", held_out).withColumn("learns", ~F.col("held_out"))
    return suffixtree.score_texts(docs, "learns").select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.record_facts(warc.archive_pages(table(spark, sf_dir, "pages")))


def op6_credential_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    listed = lambda c: F.array_join(F.transform(c, lambda p: F.concat_ws(
        ":", p["kind"], p["start"].cast("string"), p["end"].cast("string"))), ",")
    of = lambda kind: F.size(F.filter("base", lambda p: p["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[of(k).alias(f"n_{k}") for k in secrets.BASE_KINDS],
        F.sha2(listed("base"), 256).alias("base_sha256"),
        listed(F.array_sort(F.concat("base", "linked"))).alias("spans"),
        F.size("linked").cast("long").alias("n_linked"))


def op7_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=2).select(
        "doc_id", "fingerprint", "component_id")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = linededup.dedup_lines(docs)
    runs = F.array_join(F.transform("removed_runs", lambda r: F.concat_ws(
        "-", r["from_line"].cast("string"), r["to_line"].cast("string"))), ",")
    return out.select("doc_id", "text", F.col("removed_lines").cast("long").alias("removed_lines"),
                      runs.alias("removed_runs"))


def op9_cap_filter_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capfilters.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    base = F.array_sort(F.array_distinct("places.label"))
    labels = F.array_sort(F.array_distinct(F.concat(base, "matches.label", "block_matches.label")))
    best = F.array_max(F.concat("matches.containment", "block_matches.containment"))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").alias("first_word"), F.array_max("places.start").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_collocations(table(spark, sf_dir, "documents"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return graphsearch.nearest_neighbours(rows, rows.where("vec_id % 20 = 0"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    from salescope.llm import sql
    import corpus_pipeline
    built = [op1_language_id, op2_pareto_mix, op3_benchmark_matches, op4_suffix_tree_scores, op5_warc_records,
             op6_credential_spans, op7_simhash_groups, op8_line_dedup, op9_cap_filter_links, op10_license_scan,
             op11_collocations, op12_centroid_clusters, op13_nearest_neighbours]
    out = {f.__name__: (f, sql.ORACLE.get(f.__name__)) for f in built}
    out["pipeline"] = (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)
    return out
