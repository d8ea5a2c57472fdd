"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from . import chunks, decontaminate, kneser_ney, language, mixture, negatives, preference, quality, repair, shards, simhash, site_lines, toxicity
from .common import table

SHARDS = 40


def op1_stratified_shards(spark, sf):
    """All documents in 40 shards that each match the mixture of sources."""
    return shards.digest(table(spark, sf, "documents"), SHARDS)


def op2_kneser_ney(spark, sf):
    """Language-model scores of all documents, by a model of those not held out."""
    return kneser_ney.digest(table(spark, sf, "documents"))


def op3_preference_pairs(spark, sf):
    """Every conversation with a reply, paired with the same conversation under another reply, as prompt and completions."""
    return preference.digest(table(spark, sf, "conversations"))


def op4_toxic_segments(spark, sf):
    """Toxicity scores of all documents."""
    return toxicity.digest(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op5_chunk_fingerprints(spark, sf):
    """Chunk fingerprints of all documents and of their edited texts."""
    return chunks.digest(table(spark, sf, "documents"))


def op6_benchmark_leaks(spark, sf):
    """All benchmark items that each document holds."""
    return decontaminate.digest(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op7_pfair_mixture(spark, sf):
    """All documents in a mixture of sources by tempered target weights."""
    return mixture.mix(table(spark, sf, "documents").select("doc_id", "source")).select("doc_id", "source", "epoch", "slot", "position")


def op8_quality_ftrl(spark, sf):
    """Quality scores of all documents."""
    return quality.digest(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op9_site_lines(spark, sf):
    """All pages without their host's boilerplate lines."""
    return site_lines.clean(table(spark, sf, "pages"))


def op10_simhash_components(spark, sf):
    """Near-duplicate classes of all documents."""
    return simhash.digest(table(spark, sf, "documents"))


def op11_language_spans(spark, sf):
    """The language of all documents, from spans of one language."""
    return language.digest(table(spark, sf, "documents"))


def op12_conversation_repair(spark, sf):
    """The cheapest repair of all conversations after damage."""
    return repair.digest(table(spark, sf, "conversations"))


def op13_hard_negatives(spark, sf):
    """Hard negatives for every positive of every anchor, among all embeddings."""
    return negatives.digest(table(spark, sf, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_stratified_shards, op2_kneser_ney, op3_preference_pairs, op4_toxic_segments, op5_chunk_fingerprints, op6_benchmark_leaks,
    op7_pfair_mixture, op8_quality_ftrl, op9_site_lines, op10_simhash_components, op11_language_spans, op12_conversation_repair,
    op13_hard_negatives,
)}
ORACLE: dict[str, str] = {"op1_stratified_shards": shards.sql(SHARDS), "op7_pfair_mixture": mixture.sql(), "op9_site_lines": site_lines.sql()}
