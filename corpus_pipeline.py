"""The training-data pipeline: stages that each take and, but for the last, return the columns of documents.

Every stage works on all that its predecessor kept. Language models are learned from the labelled rows among the
documents at hand; the sample's bounds are parameters of language.train.
"""

import public_tokenizers
from pyspark.sql import functions as F

from rateflow.llm import decontaminate, language, line_dedup, pieces, simhash
from rateflow.llm.common import column, stored

#: A text whose words are spread over languages more evenly than this has no main language.
LEAST_SHARE = 0.4


def identify_language(spark, docs, sf_dir):
    """Documents whose text has a main language: those without a letter, or without a share of LEAST_SHARE, go.

    If no row has a language to learn from, all documents with a letter stay.
    """
    model = language.train(docs, F.lit(True))
    if not model.languages:
        return docs.where(column("text").rlike(r"\p{L}"))
    labelled = language.label_documents(docs, model)
    return labelled.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SHARE)).select("row.*")


def drop_repeated_lines(spark, docs, sf_dir):
    """Texts without the lines that an earlier document holds; n_chars follows."""
    return line_dedup.replaced(line_dedup.dedup_lines(docs))


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each class of fingerprints, the one with the smallest id."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark, docs, sf_dir):
    """Documents of which at least a twentieth of the words is inside benchmark windows go; all others stay whole."""
    return decontaminate.without_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark, docs, sf_dir):
    """All columns, with the text as it is decoded from its tokens, then token_ids and n_tokens."""
    coded = pieces.encode_and_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    kept = [c for c in docs.columns if c not in ("token_ids", "n_tokens")]
    columns = [F.col("decoded").alias(c) if c == "text" else column("row").getField(c).alias(c) for c in kept]
    return coded.select(*columns, F.col("ids").alias("token_ids"), F.size("ids").cast("bigint").alias("n_tokens"))


STAGES = [
    ("language", identify_language), ("line_dedup", drop_repeated_lines), ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated), ("encoding", encode)]
#: SQL can express neither the language model nor fingerprints nor the encoding; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over documents; each result is stored and read again by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
