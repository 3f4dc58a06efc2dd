"""One query for each operator of this subpackage, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import chunked_bpe, langid, merkle, ordinal, packing, quality_rules, simhash, token_counts, tokenfile, warc
from tessera.llm.common import table

BYTE_BPE, WORD_BPE, PIECE_BPE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
SEQUENCE, TOKEN_LIMIT = 2048, 4096


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), BYTE_BPE, SEQUENCE, end_id=0)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = tokenfile.write_token_files(table(spark, sf_dir, "documents"), WORD_BPE, end_id=1)
    n_tokens = (F.length("ids") / 4).cast("long")
    return tokenfile.read_token_files(manifest).select("doc_id", "start", n_tokens.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op4_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = chunked_bpe.encode_documents(table(spark, sf_dir, "documents"), BYTE_BPE)
    decoded = chunked_bpe.decode_documents(encoded, BYTE_BPE)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), PIECE_BPE)
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def op7_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.fingerprint_edits(table(spark, sf_dir, "documents"))
    edited = F.sha2("edited_text", 256).alias("edited_sha256")
    return found.select("doc_id", "n_chars", edited, "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op8_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archive(spark, warc.write_archive(table(spark, sf_dir, "pages"), min_bytes=0))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    found = langid.identify(docs, langid.train(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ordinal.score_documents(docs, ordinal.train(docs, table(spark, sf_dir, "labels")))


def queries() -> dict:
    found = {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}
    return dict(sorted(found.items(), key=lambda kv: int(kv[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    return {"op6_quality_rules": quality_rules.ORACLE, "op7_merkle_fingerprints": merkle.ORACLE, "op8_warc_archive": warc.ORACLE}
