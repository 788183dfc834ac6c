"""A corpus from raw documents to tokens: rules, line dedup, near-duplicate join, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it
kept; its result is written as a table before the next stage reads it.  Columns beside
those named in a stage are carried whatever they are called, and a table without rows
gives one without rows.  Texts are read whole, of any length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metriclab.llm import bpe, chunks, jaccard, mixing, quality
from metriclab.llm.scratch import written

#: Name of the public vocabulary; ``public_tokenizers`` finds its file on every executor.
VOCABULARY = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go.

    A null, empty or blank text has no words, so it goes, as does any of under 50 words.
    Each row is judged by itself: repeated rows all stay or all go.
    """
    return quality.quality_filtered(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go; so does a document of which nothing but white space is left.

    That takes null, empty and blank texts too.  The smallest ``doc_id`` keeps a chunk, null
    before all others.  ``n_chars``, where there is one, is counted anew.
    """
    left = chunks.without_repeats(docs)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left.filter(F.col("text").rlike(mixing.WORD)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: five words a shingle, similarity 0.8.

    The smallest ``doc_id`` stays.  Null, empty and blank texts link with nothing and stay;
    of rows repeated with equal key and text all stay.
    """
    return jaccard.one_of_each(docs, rules=jaccard.JaccardJoin(shingle=5, percent=80))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target draws them, none more than twice.

    A null source is a source of its own, the last.  A text without words has size 0 and takes
    nothing of a target, but is drawn like others.  Rows that are equal in key, text and source
    are ordered by a digest of all their columns, so reruns agree.
    """
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, as little-endian 32-bit integers; a null or empty text has none.

    One row for each row of ``docs``, repeated ones as well; only the columns named here are kept.
    """
    import public_tokenizers

    rows = bpe.encoded(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path(VOCABULARY))
    return rows.select("doc_id", "lang", "source", (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"), "token_ids")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("mixing", mix_sources),
    ("encoding", encode),
]
#: Shingle links, chunk boundaries and BPE merges are not expressible in SQL; a brute-force version tests them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
