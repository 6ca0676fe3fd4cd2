"""Registered queries of the training-data operators: name -> builder over (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (
    bit_packing,
    bm25_decontam,
    crf_language,
    digest_cache,
    feistel_pii,
    kd_shards,
    mincut_extract,
    partenum_join,
    phrase_mining,
    piece_trie,
    spelling_variants,
    substring_dedup,
    suffix_repeats,
)
from .oracles import OP6_SQL, OP7_SQL, OP10_SQL, OP11_SQL, OP12_SQL, OP13_SQL
from .textbatch import table


def op1_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each whole document, learned where crc32(doc_id) mod 4 is not 2."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = crf_language.fit(docs, ~held_out)
    found = crf_language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "language.lang_pred", "language.score",
                        "language.n_words", "language.n_switches")


def op2_bm25_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with each benchmark item that it holds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = bm25_decontam.find(docs, table(spark, sf_dir, "benchmark"))
    return (held.select("doc_id", F.explode("held").alias("m"))
            .select("doc_id", "m.item_id", "m.score", F.col("m.question").alias("question_overlap"),
                    F.col("m.answer").alias("answer_overlap")))


def op3_bit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of each whole document, written as packed blocks and read back."""
    path = scratch_path(spark, "packed-ids")
    bit_packing.write(table(spark, sf_dir, "documents"), path)
    return bit_packing.digests(spark, path)


def op4_mincut_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each whole page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return (mincut_extract.extract(pages, mincut_extract.fit(pages))
            .select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars")))


PII_SETTING = "spark.ledgerflow.pseudonymSecret"  # Spark's redaction hides settings of such a name in its logs
PII_KEY = b"corpus pseudonyms"  # of sessions without the setting: a known key, with which pseudonyms can be undone


def pii_key(spark: SparkSession) -> bytes:
    """The key of the pseudonyms: the session's setting, or PII_KEY."""
    return (spark.conf.get(PII_SETTING, None) or PII_KEY.decode()).encode()


def op5_feistel_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each whole document with pseudonyms for its personal data."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (feistel_pii.pseudonymise(docs, pii_key(spark))
            .select("doc_id", "masked.text", "masked.n_found", F.concat_ws(",", "masked.kinds").alias("kinds")))


def op6_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of each document, by a k-d tree over its metadata."""
    return (kd_shards.shard(table(spark, sf_dir, "documents"), 16)
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))


def op7_partenum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles of each whole document and the component of its links."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return partenum_join.join(docs).select("doc_id", "n_shingles", "component_id")


def op8_piece_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of each whole document, and whether they decode to its text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (piece_trie.encode(docs)
            .select("doc_id", F.size("pieces.ids").cast("long").alias("n_pieces"), "pieces.ids_crc32", "pieces.round_trip"))


CACHE_SETTING = "spark.ledgerflow.tokenCache"


def op9_digest_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each whole document, by way of a cache of counts by content digest.

    The cache is the folder that the session's setting spark.ledgerflow.tokenCache names (a shared one), which
    later runs find again; without the setting each run has an empty one of its own.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (digest_cache.count_tokens(docs, digest_cache.open_cache(spark, spark.conf.get(CACHE_SETTING, None)))
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit")))


def op10_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures of each whole document and the verdict on its repeated passages."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (suffix_repeats.judge(docs)
            .select("doc_id", "rules.n_words", "rules.word_chars", "rules.n_symbols", "rules.n_dup_lines",
                    "rules.n_repeat_words", "rules.base_failed", "rules.kept"))


def op11_toivonen_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocated phrases of each language."""
    return phrase_mining.collocations(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))


def op12_doubling_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each whole document and what is left without repeated windows of 20 words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.dedup(docs).select("doc_id", "dedup.n_words", "dedup.n_removed", "dedup.kept_sha256")


def op13_pivotal_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each word of the documents with its more frequent form and the form's last root."""
    return spelling_variants.group(table(spark, sf_dir, "documents").select("doc_id", "text"))


_QUERIES = {f.__name__: f for f in (
    op1_crf_language, op2_bm25_decontam, op3_bit_packing, op4_mincut_extract, op5_feistel_pii, op6_kd_shards, op7_partenum_join,
    op8_piece_trie, op9_digest_cache, op10_suffix_repeats, op11_toivonen_phrases, op12_doubling_dedup, op13_pivotal_variants)}
_ORACLES = {"op6_kd_shards": OP6_SQL, "op7_partenum_join": OP7_SQL, "op10_suffix_repeats": OP10_SQL, "op11_toivonen_phrases": OP11_SQL,
            "op12_doubling_dedup": OP12_SQL, "op13_pivotal_variants": OP13_SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in _ORACLES.items() if v is not None}
