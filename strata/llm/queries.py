"""The registered queries opN_<name>: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import alignment, archive, attribution, chat, contents, forest, jaccard, langid, mixing, packing, repeats, simhash, trie
from strata.llm.common import prepared, staged, tables

PROBE_TEXT = "\\### Assistant: </turn> ok"


def op1_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and conversation -7 whose texts look like the template's own marks."""
    rows = tables(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE_TEXT), (-7, 1, "assistant", PROBE_TEXT)], "conv_id bigint, turn bigint, role string, text string")
    return chat.digests(chat.format_conversations(rows.unionByName(probe)))


def op2_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(tables(spark, folder, "documents"))


def op3_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Documents mixed to nine tenths of the largest entropy of sources, with as many tokens as there are."""
    mixed = mixing.mix(tables(spark, folder, "documents"), budget_part=1.0, entropy_part=0.9)
    return mixed.select("doc_id", "source", "mix_tokens", "mix_pass", "mix_block", F.col("mix_order.block").alias("block_order"),
                        F.col("mix_order.row").alias("row_order"))


def op4_warc_index(spark: SparkSession, folder: str) -> DataFrame:
    read = archive.round_trip(tables(spark, folder, "pages"), least_bytes=0)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_token_attribution(spark: SparkSession, folder: str) -> DataFrame:
    return attribution.attribute_tokens(tables(spark, folder, "documents"))


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = tables(spark, folder, "documents")
    found = langid.identify(docs.select("doc_id", "text"), langid.train(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints and likenesses of all documents; for ids divisible by 20 also how many documents are within the radius (n_near)."""
    found = staged(simhash.edited_neighbours(tables(spark, folder, "documents")))
    found = simhash.with_near(found, F.col("doc_id") % 20 == 0)
    return found.select("doc_id", "n_chars", "edited_sha256", simhash.hexadecimal(F.col("own")).alias("fingerprint"),
                        simhash.hexadecimal(F.col("edited")).alias("edited_fingerprint"),
                        simhash.likeness(F.col("own"), F.col("edited")).alias("near_edited"),
                        simhash.likeness(F.col("own"), F.col("next")).alias("near_next"), "n_near")


def op8_hash_forest(spark: SparkSession, folder: str) -> DataFrame:
    vectors = tables(spark, folder, "embeddings")
    return forest.Forest(vectors).search(vectors.where("vec_id % 50 = 0"), k=5)


def op9_ffd_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(tables(spark, folder, "documents"), capacity=1024)


def op10_repeat_removal(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(tables(spark, folder, "documents"))


def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.nodes(tables(spark, folder, "conversations"))


def op12_alignment_counts(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(tables(spark, folder, "documents"))


def op13_content_sort(spark: SparkSession, folder: str) -> DataFrame:
    return contents.exact_copies(tables(spark, folder, "documents"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_chat_formatting, op2_ngram_jaccard_join, op3_source_mixing, op4_warc_index, op5_token_attribution, op6_language_id, op7_simhash,
             op8_hash_forest, op9_ffd_packing, op10_repeat_removal, op11_conversation_trie, op12_alignment_counts, op13_content_sort)
    return {f.__name__: (lambda spark, folder, f=f: f(prepared(spark), folder)) for f in found}
