"""The registered queries: each operator over its whole table, in the form its contract asks for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import (
    cross_entropy,
    exact_dedup,
    imatch,
    language,
    minhash,
    mixing,
    packing,
    pii,
    repair,
    sharding,
    spelling,
    superkmers,
    toxicity,
)
from tideline.llm.common import bucket_of_id, stage, table

PACKING_VOCABULARY = "word_bpe_49k.json"


def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return taken.select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def packing_vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(PACKING_VOCABULARY))


def op2_sum_of_squares_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), packing_vocabulary())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copy_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op6_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superkmers.without_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


def op7_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(bucket_of_id("doc_id", 5) == 0, F.lit(False))
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = toxicity.with_toxicity(docs, model)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op8_minhash_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs).drop("digest")


def op4_compression_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(bucket_of_id("doc_id", 3) == 1, F.lit(False))
    found = language.with_language(docs.drop("lang"), language.train(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


def op9_disclosure_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    counts = ("n_email", "n_ip", "n_card", "n_phone")
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.joined("base"), 256).alias("base_sha256"),
        pii.joined("spans").alias("spans"),
    )


def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.next_document_likeness(table(spark, sf_dir, "documents"))


# Ids of labelled documents are sent to all tasks up to so many: 16 MB.
SENT_IDS = 2_000_000


def op10_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target is what `labels.quality` calls good."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    good = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id").distinct()
    good = stage(good.withColumn("is_good", F.lit(True)), "lm-good")
    labelled = docs.join(F.broadcast(good) if good.count() <= SENT_IDS else good, "doc_id", "left")
    scored = cross_entropy.score(labelled, F.col("is_good"))
    return scored.select("doc_id", "n_tokens", "target_loss", "background_loss", "score")


def op11_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shards(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    rows = repair.damaged(conversations)
    return repair.with_digests(rows, repair.audits(rows, conversations))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(spelling.count_words(table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_pareto_mix": op1_pareto_mix,
    "op2_sum_of_squares_pack": op2_sum_of_squares_pack,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_compression_language": op4_compression_language,
    "op5_imatch": op5_imatch,
    "op6_super_kmers": op6_super_kmers,
    "op7_compression_toxicity": op7_compression_toxicity,
    "op8_minhash_hamming": op8_minhash_hamming,
    "op9_disclosure_pii": op9_disclosure_pii,
    "op10_cross_entropy": op10_cross_entropy,
    "op11_feistel_shards": op11_feistel_shards,
    "op12_turn_repair": op12_turn_repair,
    "op13_spelling_variants": op13_spelling_variants,
}
