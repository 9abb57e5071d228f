"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns what the next one reads: all that it keeps,
with the columns of ``documents``; the last returns the packed pieces. ``run`` writes every
stage's result as Parquet below ``spark.checkpoint.dir`` and reads it again, so a lost executor
costs one stage's tasks and no stage is computed twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.llm import line_dedup, mixing, packing, quality_votes, simhash
from layerkit.llm.common import once, stored, table, words_of
from layerkit.llm.tokens import public_tokenizer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base check and that the weighed votes find good."""
    judged = quality_votes.judged(docs)
    return judged.filter(F.col(judged.columns[-1])["kept"]).select(*docs.columns)


def line_chunk_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated chunks of lines; documents left without a word go."""
    left = line_dedup.remove_repeated_chunks(docs).select(*docs.columns)
    left = once(left, "text", F.col("text")).select(*docs.columns)  # filter and length read it too
    left = left.filter(F.length(F.translate("text", " \t\n\u000b\f\r", "")) > 0)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: shingles of 4 words, at most 4 bits apart."""
    return simhash.one_of_each(docs, distance=4, shingle=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; richer vocabulary is drawn first."""
    words = words_of(F.col("text"))
    variety = F.size(F.array_distinct(words)) / F.size(words)
    mixed = mixing.mix(docs, F.size(words), 0.5 + variety)
    copies = F.col(mixed.columns[-1])["copies"]
    repeated = mixed.withColumn(mixed.columns[-1], F.explode(F.array_repeat(F.lit(1), copies)))
    return repeated.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their places in sequences."""
    pieces = packing.token_pieces(docs, public_tokenizer("byte_bpe_50k.json"))
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(stored(pieces, "pieces"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_chunk_dedup", line_chunk_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Votes, fingerprints and token ids have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
