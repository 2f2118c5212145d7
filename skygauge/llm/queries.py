"""One registered query for each operator, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from skygauge.llm import (chat_format, check_sql, common, decontam, filter_audit, hnsw, lm_scoring, packing, pii,
                          repeats, simhash, token_counts, toxicity, url_filter, variants)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marginal log10 probability of every text over all segmentations, beside a word unigram base."""
    return lm_scoring.score(_table(spark, sf_dir, "documents"))


def op2_pack_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids as pieces of sequences of at most 2048."""
    return packing.pack(_table(spark, sf_dir, "documents"))


def op3_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule or learned verdict of every page's URL."""
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op4_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every encoded length as context limit the documents and tokens within and beyond."""
    lengths = token_counts.encoded_lengths(_table(spark, sf_dir, "documents"))
    return token_counts.limit_table(token_counts.histogram(lengths))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and places of personal data in every text."""
    found = pii.find(_table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base_spans", pii.of_kind(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.span_text(F.col("base_spans")), 256).alias("base_sha256"),
                        pii.span_text(F.col("spans")).alias("spans"))


def op6_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every text and the component of its near copies."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every text loses if strings of 400 bytes that also start elsewhere are removed."""
    return repeats.digest(repeats.repeated_spans(_table(spark, sf_dir, "documents")))


def op8_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every text, learned from two thirds of the labels."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.train(docs, toxicity.learning_rows(labels))
    held_out = (toxicity.id_remainder("doc_id", 3) == 1).alias("held_out")
    return toxicity.classify(docs, model).select("doc_id", held_out, "score", "predicted", "lang_threshold", "rejected")


def op9_benchmark_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where documents hold passages of benchmark items, replaced tokens allowed."""
    found = decontam.overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "doc_start", "doc_end", "n_equal")


def op10_hnsw_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    vectors = _table(spark, sf_dir, "embeddings")
    return hnsw.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op11_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every repeated word of seven letters and more with its near words, its form and the root of its forms."""
    runs = variants.letter_runs(_table(spark, sf_dir, "documents"), shortest=7)
    words = common.materialized(variants.vocabulary(variants.with_slips(runs)))
    return variants.spelling_groups(words)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes from every source, in all orders of them."""
    counts = filter_audit.mask_counts(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return filter_audit.audit(counts)


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that consists of control strings, formatted and read back."""
    said = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(
        F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(own)
    parts = F.array(chat_format.text_part(common.whole_text())).alias("parts")
    back = chat_format.read_back(chat_format.format_conversations(rows.select("conv_id", "turn", "role", parts)))
    told = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "expanded_tokens")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_lattice_score, op2_pack_vectors, op3_url_verdicts, op4_token_lengths, op5_personal_data, op6_simhash_pivots,
    op7_repeated_bytes, op8_toxicity_cnn, op9_benchmark_overlaps, op10_hnsw_neighbours, op11_spelling_groups,
    op12_filter_audit, op13_chat_format)}

#: The other methods can't be written as one SQL statement; tests hold them against brute force.
CHECK_SQL: dict[str, str] = {"op12_filter_audit": check_sql.FILTER_AUDIT, "op13_chat_format": check_sql.CHAT_FORMAT}
