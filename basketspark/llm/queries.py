"""The operators as queries over the given tables, with production parameters, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketspark.llm import decontaminate, hard_negatives, language_id, language_model, licences, near_duplicates, neighbours, packing, phrases, quality, sharding, token_files, warc
from basketspark.llm.common import id_remainder, new_folder, table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 near-equal shards by vector bin packing."""
    out = sharding.sharded_documents(table(spark, sf_dir, "documents", "doc_id", "text"), 40)
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return out.select("doc_id", "size", "text_crc32", law, F.col("shard").cast("int"), F.col("slot").cast("long"), grown, "tokens")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in any document."""
    return decontaminate.contained_items(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20, among all others."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0, 20)


def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document, learned from those whose id's crc32 leaves another remainder than 2 by 7."""
    held_out = id_remainder(F.col("doc_id"), 7) == 2
    out = language_model.score_documents(table(spark, sf_dir, "documents", "doc_id", "text"), ~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents tokenised and packed into sequences of 2048."""
    return packing.packed_documents(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document."""
    return quality.scored_documents(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality"))


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence texts and notices in all documents."""
    return licences.scan(table(spark, sf_dir, "documents", "doc_id", "text"), licences.known_texts(spark))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back."""
    out = warc.archive_round_trip(table(spark, sf_dir, "pages", "page_id", "url", "html"), new_folder(spark, "warc"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on two-word shingles."""
    return near_duplicates.near_duplicate_classes(table(spark, sf_dir, "documents", "doc_id", "text"), words=2, percent=80)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded into id files and read back."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    files = token_files.write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), new_folder(spark, "ids"), end_id=2)
    out = token_files.read_token_files(files)
    return out.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those whose id's crc32 leaves another remainder than 1 by 3."""
    held_out = id_remainder(F.col("doc_id"), 3) == 1
    out = language_id.identified(table(spark, sf_dir, "documents", "doc_id", "text", "lang"), ~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits", "accepted")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of two and three words of every language."""
    return phrases.collocations(table(spark, sf_dir, "documents", "lang", "text"), least=10, share=50, first=2000)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every vector whose id is divisible by 100."""
    rows = table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_sharding, op2_decontamination, op3_neighbours, op4_language_model, op5_packing, op6_quality, op7_licences, op8_warc, op9_near_duplicates, op10_token_files, op11_language_id, op12_phrases, op13_hard_negatives)
}

ORACLES: dict[str, str] = {
    "op2_decontamination": decontaminate.contained_sql(),
    "op7_licences": licences.scan_sql(),
    "op12_phrases": phrases.collocations_sql(),
    "op13_hard_negatives": hard_negatives.hard_negatives_sql(),
}
