"""From documents to tokens in five stages, each a table that the next one reads.

Language ID rejects texts without any letter, near duplicates leave one
document of each group, personal data is replaced by its kind, sources are
mixed to target weights by repeating documents, and what is left is encoded.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amihan.llm import byte_bpe, lang_id, mixing, near_dedup, pii
from amihan.llm.common import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
RANKS = "byte_bpe_50k.tiktoken"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters; a missing label becomes the predicted one, ``und`` if no language could be learned."""
    # Without labels to learn from, every text is unknown.
    spoken = (F.col("lang_pred") != lang_id.UNKNOWN) | F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    found = lang_id.with_language(docs).where(spoken)
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked at a similarity of 0.8: of its smallest id, and of that id's rows the least with a text.

    Rows that repeat an id are one document.  Rows without an id take a key
    from their text, after all ids below 2 ** 62; different texts stay apart.
    """
    own = F.shiftrightunsigned(F.xxhash64("text"), 2).bitwiseOR(F.lit(1 << 62))
    keyed = docs.withColumn("__key", F.coalesce(F.col("doc_id").cast("long"), own))
    gone = near_dedup.near_duplicates(keyed, id_col="__key").where(~F.col("kept")).select(F.col("doc_id").alias("__key")).distinct()
    digest = F.when(F.col("doc_id").isNull(), F.sha2(F.col("text").cast("binary"), 256))
    # Combined before the shuffle, so many copies of one row are no hot key.
    rows = keyed.join(gone, "__key", "left_anti").groupBy("__key", F.col("doc_id").isNull(), digest)
    least = rows.agg(F.min(F.struct(F.col("text").isNull().alias("none"), *COLUMNS)).alias("least"))
    return least.select(*(F.col(f"least.{c}").alias(c) for c in COLUMNS))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind, and their new lengths."""
    clean = pii.redact(pii.find_spans(docs, spans_col="spans"))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy, in random order; sources weigh as the square root of their size."""
    return mixing.mix_sources(docs).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of each copy."""
    coded = byte_bpe.encode_texts(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", hide_personal_data),
    ("source_mix", mix_sources),
    ("tokens", encode),
]

#: Similarity by hashes and the tokens have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; every stage but the last is stored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
