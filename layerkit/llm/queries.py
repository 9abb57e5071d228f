"""Registered queries of this subpackage: one per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import run_dir
from . import (
    chat_format,
    hamming_topk,
    kd_shards,
    line_dedup,
    link_trust,
    mixing,
    packing,
    prefix_trie,
    quality_votes,
    secret_scan,
    simhash,
    token_files,
    turn_repair,
)
from .common import stored, table, words_of
from .tokens import public_tokenizer


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of at most 2048 tokens."""
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), public_tokenizer("byte_bpe_50k.json"))
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(stored(pieces, "pieces"))


def op2_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest codes of every 50th vector."""
    return hamming_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the multi-line chunks that an earlier document (or line) has."""
    d = line_dedup.remove_repeated_chunks(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "text", "dedup.*")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret candidates of every document with the forest's verdict."""
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mix takes every document, sources weighing 5, 2, 1 in turn."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.size(words_of(text)).alias("words"), F.md5(text).alias("text_md5"),
    )
    # texts are read once; labels join the narrow rows
    weighted = stored(docs, "mix-docs").join(
        mixing.label_quality(table(spark, sf_dir, "labels")), F.col("doc_id") == F.col("label_id"), "left",
    )
    d = mixing.mix(weighted, F.col("words"), F.col("label_weight"), text_col="text_md5", keep=["doc_id"])
    return d.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken", "mix.copies")


def op6_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base check and verdict of every document; the labelled ones anchor the estimate."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    q = quality_votes.judged(table(spark, sf_dir, "documents"), keep=["doc_id"], labels=labels)
    f = F.col("quality.features")
    return q.select(
        "doc_id", *[f[c].alias(c) for c in quality_votes.BASE], "quality.base_failed", "quality.kept",
        F.col("quality.good").alias("p_good"),
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    d = simhash.near_duplicates(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return d.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as Arrow files of token sequences, and read back."""
    docs = table(spark, sf_dir, "documents")
    files = token_files.write_token_files(docs, run_dir(spark, "token-files"), public_tokenizer("word_bpe_49k.json"))
    back = token_files.read_token_files(files, docs.schema["doc_id"].dataType)
    return back.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op9_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in 16 shards of near equal bytes."""
    d = kd_shards.shards(table(spark, sf_dir, "documents"), n_shards=16)
    return d.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


def op10_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page."""
    return link_trust.judge(table(spark, sf_dir, "pages")).drop("trust", "distrust")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired digest of every conversation, damaged first."""
    return turn_repair.repaired_summary(table(spark, sf_dir, "conversations"))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations formatted, written, and read back."""
    turns = chat_format.with_probe(table(spark, sf_dir, "conversations"))
    formatted = chat_format.format_turns(turns, chat_format.text_part(F.col("text")))
    return chat_format.digests(stored(formatted, "formatted"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of the rebuilt conversations."""
    turns, convs = prefix_trie.regrafted(prefix_trie.numbered(table(spark, sf_dir, "conversations")))
    return prefix_trie.trie(turns, convs)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_pack": op1_pack,
        "op2_hamming_topk": op2_hamming_topk,
        "op3_line_dedup": op3_line_dedup,
        "op4_secret_scan": op4_secret_scan,
        "op5_mix": op5_mix,
        "op6_quality_votes": op6_quality_votes,
        "op7_simhash": op7_simhash,
        "op8_token_files": op8_token_files,
        "op9_kd_shards": op9_kd_shards,
        "op10_link_trust": op10_link_trust,
        "op11_turn_repair": op11_turn_repair,
        "op12_chat_format": op12_chat_format,
        "op13_prefix_trie": op13_prefix_trie,
    }


def oracle_sql() -> dict[str, str]:
    found = {
        "op2_hamming_topk": hamming_topk.oracle_sql(),
        "op3_line_dedup": line_dedup.oracle_sql(),
        "op5_mix": mixing.oracle_sql(),
        "op10_link_trust": link_trust.oracle_sql(),
        "op12_chat_format": chat_format.oracle_sql(),
        "op13_prefix_trie": prefix_trie.oracle_sql(),
    }
    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
