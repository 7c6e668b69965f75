"""The registered queries of the operators: thin, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import ann, bpe, conversations, decontam, interactions, lines, mixing, paragraphs, quality, sharding, simhash, suffixes, warc
from .shared import table

#: Rank file of the tokenizer that op9 and the pipeline use.
RANK_FILE = "byte_bpe_50k.tiktoken"
#: What op9 lets a worker remember: it runs alone, so more than by default.
BPE_STATES = 300_000
BPE_WORDS = 300_000


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return ann.search(rows, rows.where("vec_id % 20 = 0"), k=20)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_table(table(spark, sf_dir, "documents"), shards=40)


def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.report(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.report(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.page_report(table(spark, sf_dir, "pages"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path(RANK_FILE))
    docs = table(spark, sf_dir, "documents")
    return bpe.roundtrip_digests(docs, ranks, public_tokenizers.PATTERN, max_states=BPE_STATES, max_words=BPE_WORDS, spaces=True)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.document_mix(docs, mixing.rotating_schedule(docs))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.report(conversations.damaged(rows), rows)


def op13_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.document_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_ann": op1_ann, "op2_quality": op2_quality, "op3_sharding": op3_sharding, "op4_suffixes": op4_suffixes, "op5_simhash": op5_simhash, "op6_paragraphs": op6_paragraphs, "op7_warc": op7_warc, "op8_lines": op8_lines, "op9_bpe": op9_bpe,
    "op10_decontamination": op10_decontamination, "op11_mixing": op11_mixing, "op12_conversations": op12_conversations,
    "op13_interactions": op13_interactions,
}

ORACLE: dict[str, str] = {"op7_warc": warc.ARCHIVE_SQL, "op8_lines": lines.REPORT_SQL, "op11_mixing": mixing.MIX_SQL, "op12_conversations": conversations.REPORT_SQL, "op13_interactions": interactions.AUDIT_SQL}
