"""The queries of this subpackage and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, chunks, htmltext, jaccard, manifest, mixing, periodic, quality, repeats, spans, topk, units, vectors


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with the public byte-level vocabulary and decoded again."""
    import public_tokenizers

    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted, and read back from the formatted text."""
    own = spark.range(2).select(
        chat.F.lit(-7).cast("long").alias("conv_id"), chat.F.col("id").alias("turn"),
        chat.F.when(chat.F.col("id") == 0, "user").otherwise("assistant").alias("role"), chat.F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.digests(chat.chat_formatted(chat.as_log(rows)))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spans.cut_digests(docs, repeats.repeated_spans(docs)).drop("spans")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.with_quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.drop("text")


def op5_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.with_components(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def _listed(found: DataFrame) -> DataFrame:
    """``found`` with its spans as text: start-end,start-end."""
    place = lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))
    return found.withColumn("spans", F.concat_ws(",", F.transform("spans", place)))


def op6_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of whole sentences and lines with 25 words that stood earlier go; ``spans`` lists the removed offsets."""
    return _listed(units.unit_digests(table(spark, sf_dir, "documents").select("doc_id", "text")))


def line_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``op6_unit_dedup``, with single lines of ten words as units."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spans.cut_digests(docs, units.repeated_units(docs)).drop("spans")


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.with_copies(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return found.select("doc_id", "size", "source_size", "target", "copies", "taken")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.with_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _listed(spans.cut_digests(docs, chunks.repeated_chunks(docs)))


def op11_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of every fiftieth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof; those with an even checksum are verified without their newlines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    return manifest.manifest(docs, changed={"text": manifest.without_newlines(docs)})


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digests(periodic.with_runs(periodic.with_tails(table(spark, sf_dir, "documents"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_chat_format": op2_chat_format,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_vector_dedup": op5_vector_dedup,
    "op6_unit_dedup": op6_unit_dedup,
    "line_unit_dedup": line_unit_dedup,
    "op7_mix_sources": op7_mix_sources,
    "op8_html_text": op8_html_text,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_line_chunks": op10_line_chunks,
    "op11_top_k": op11_top_k,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_periodic_runs": op13_periodic_runs,
}
#: All pairs, for tables of test size; a recursive walk gives the components.
_VECTORS = """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
u AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS size FROM v),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) >= 0.9 * a.size * b.size),
r AS (SELECT vec_id AS a, vec_id AS b FROM u UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a)
SELECT c.vec_id, (SELECT count(*) FROM l WHERE l.a = c.vec_id) AS n_links, component_id, c.vec_id = component_id AS kept FROM c
"""
ORACLES: dict[str, str] = {"op2_chat_format": chat.ORACLE, "op4_quality_rules": quality.ORACLE, "op5_vector_dedup": _VECTORS, "op6_unit_dedup": units.ORACLE, "line_unit_dedup": units.LINE_ORACLE, "op7_mix_sources": mixing.ORACLE, "op9_jaccard_join": jaccard.ORACLE, "op10_line_chunks": chunks.ORACLE, "op11_top_k": topk.ORACLE, "op12_merkle_manifest": manifest.ORACLE}
