"""The corpus pipeline: stages that each call one operator of ``censuskit.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and reread as the next stage's documents; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from censuskit.llm import bpe, decontam, lines, quality, simhash
from censuskit.llm.queries import RANK_FILE
from censuskit.llm.shared import cut, table

#: Documents stay whose calibrated chance of good quality is at least this.
LEAST_QUALITY = 0.5
#: A line of a source's documents is boilerplate on more than this share of
#: them, and on this many at least: the operator's floor, the least at which a
#: share means repetition, so that small sources are held to the share, too.
LINE_RATIO = 0.1
LINE_DOCUMENTS = lines.LEAST_PAGES


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns here, from
    ``labels``, and sees the text alone. Null and empty texts score as empty ones,
    repeated rows alike; very long texts are read whole. Without labels, or
    without documents, none is rejected for its text: all score the same."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")), threshold=LEAST_QUALITY)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that are boilerplate in their source; every
    document stays, ``n_chars`` follows the text. Documents without a source keep
    all lines, null texts stay null; repeated rows count each."""
    kept = lines.drop_text_lines(docs, site="source", text="text", ratio=LINE_RATIO, least_pages=LINE_DOCUMENTS)
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest doc_id.
    Repeated rows of that doc_id, and rows without one, are one document too."""
    return simhash.representatives(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found. Null and empty texts hold
    none and stay, as do all without a benchmark; repeated rows fare alike; very
    long texts are scanned whole."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE of what is left: token counts and digests, a row for every
    row. A null text has no tokens; very long ones are encoded whole."""
    return bpe.roundtrip_digests(docs, bpe.read_ranks(public_tokenizers.path(RANK_FILE)), public_tokenizers.PATTERN, spaces=True)


STAGES = [
    ("quality", good_quality),
    ("lines", without_boilerplate),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("tokens", tokens),
]

#: A trained classifier decides what is kept, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
