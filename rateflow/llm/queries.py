"""The registered queries of the training-data operators: each applies its operator to whole tables."""

import public_tokenizers
from pyspark.sql import functions as F

from rateflow.llm import (
    decontaminate, divergence, fingerprints, language, lexical, line_dedup, maxscore, pieces, pii, simhash, substrings,
    token_counts, toxicity)


def _table(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def _packed(ids):
    """Ids as little-endian unsigned 32-bit integers, one after the other."""
    @F.pandas_udf("binary")
    def pack(values):
        return values.map(lambda x: x.astype("<u4").tobytes())
    return pack(ids)


def op1_line_dedup(spark, d):
    kept = line_dedup.dedup_lines(_table(spark, d, "documents"))
    return kept.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_substring_dedup(spark, d):
    return substrings.near_duplicate_passages(_table(spark, d, "documents"))


def op3_toxicity(spark, d):
    docs = _table(spark, d, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    scored = toxicity.score(docs, toxicity.train(docs, _table(spark, d, "labels"), ~held_out))
    return scored.select("row.doc_id", "score").select(
        "doc_id", F.coalesce(held_out, F.lit(True)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_language_id(spark, d):
    docs = _table(spark, d, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    found = language.label_documents(docs, language.train(docs, ~held_out))
    return found.select("row.doc_id", "lang_pred", "score").select(
        "doc_id", F.coalesce(held_out, F.lit(True)).alias("held_out"), "lang_pred", "score")


def op5_fingerprints(spark, d):
    return fingerprints.fingerprint_edits(_table(spark, d, "documents"))


def op6_sentencepiece(spark, d):
    coded = pieces.encode_and_decode(_table(spark, d, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select(
        "row.doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(_packed("ids"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_personal_data(spark, d):
    return pii.digest(pii.find_personal_data(_table(spark, d, "documents")))


def op8_decontaminate(spark, d):
    found = decontaminate.find_hits(_table(spark, d, "documents"), _table(spark, d, "benchmark"))
    return found.select(
        "row.doc_id", "n_words", decontaminate.n_hit().alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"))


def op9_token_counts(spark, d):
    counted = token_counts.count_tokens(_table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op10_simhash_near_dedup(spark, d):
    return simhash.near_duplicates(_table(spark, d, "documents"))


def op11_top_k_search(spark, d):
    vectors = _table(spark, d, "embeddings")
    return maxscore.top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op12_ranked_search(spark, d):
    return lexical.rank_documents(_table(spark, d, "documents"), _table(spark, d, "benchmark"))


def op13_source_divergence(spark, d):
    return divergence.audit(_table(spark, d, "documents"))


ALL = {f.__name__: f for f in [
    op1_line_dedup, op2_substring_dedup, op3_toxicity, op4_language_id, op5_fingerprints, op6_sentencepiece, op7_personal_data, op8_decontaminate, op9_token_counts, op10_simhash_near_dedup,
    op11_top_k_search, op12_ranked_search, op13_source_divergence]}
