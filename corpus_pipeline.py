"""Corpus pipeline over the documents table: each stage works on what the one before has kept.

Stages take (spark, docs, sf_dir).  All but the last return the columns of ``docs``:

    language_id     rows whose text has no known language, or none with a share of MIN_SCORE, go
    ngram_jaccard   of each group of near copies the row of the smallest id stays (rows without an id come
                    last, ties go by a hash of the text); rows that share an id are judged by their own
                    texts; of rows of one id and text one stays
    decontaminate   rows that hold a benchmark item go
    pii             personal data becomes pseudonyms; n_chars is counted anew
    sentencepiece   doc_id, lang, source, the ids of the text's pieces, their number and checksum, and
                    whether they decode to the text

Defined results: an empty table passes through all stages; null and empty texts have no language and
go in the first.  Other columns pass through all stages but the last.  Language ID and pieces can't be
told in SQL, so ORACLE_SQL is None; tests hold run() against the stages done by brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import bm25_decontam, crf_language, feistel_pii, partenum_join, piece_trie
from ledgerflow.llm.components import stored
from ledgerflow.llm.registry import pii_key
from ledgerflow.llm.textbatch import small_batches, table

MIN_SCORE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = crf_language.identify(docs, crf_language.fit(docs), out="__language")
    return (found.where((F.col("__language.lang_pred") != crf_language.UNKNOWN) & (F.col("__language.score") >= MIN_SCORE))
            .select(*docs.columns))


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with a key __node of their own: the id where no other row has it, or a number below all ids from id and text.

    Of rows of one id and text, one is left.
    """
    several = stored(docs.groupBy("doc_id").count().where("doc_id is null or count > 1").select(F.col("doc_id").alias("__shared")), "shared")
    alike = F.col("doc_id").eqNullSafe(F.col("__shared"))
    one = docs.join(several, alike, "left_anti").withColumn("__node", F.col("doc_id"))
    low = F.lit(-(1 << 62)) - F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2)
    more = docs.join(several, alike, "left_semi").withColumn("__node", low).dropDuplicates(["__node"])
    return one.union(more)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    keyed = _keyed(docs)
    joined = partenum_join.join(keyed.select("__node", "doc_id", "text"), id_col="__node")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "__node")
    members = stored(joined.select("__node", "doc_id", "component_id"), "members")
    first = members.groupBy("component_id").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    gone = stored(members.join(first, "component_id").where(F.col("first.__node") != F.col("__node")).select("__node"), "gone")
    return keyed.join(gone, "__node", "left_anti").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    held = bm25_decontam.find(docs, table(spark, sf_dir, "benchmark"), out="__held")
    return held.where(F.size("__held") == 0).select(*docs.columns)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    masked = feistel_pii.pseudonymise(docs, pii_key(spark), out="__masked")
    own = {"text": F.col("__masked.text").alias("text"), "n_chars": F.length("__masked.text").cast("long").alias("n_chars")}
    return masked.select(*[own.get(c, F.col(c)) for c in docs.columns])


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    coded = piece_trie.encode(docs.select("doc_id", "lang", "source", "text"), out="__pieces")
    return coded.select("doc_id", "lang", "source", "__pieces.ids", F.size("__pieces.ids").cast("long").alias("n_pieces"),
                        "__pieces.ids_crc32", "__pieces.round_trip")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id), ("ngram_jaccard", ngram_jaccard), ("decontaminate", decontaminate),
    ("pii", pii), ("sentencepiece", sentencepiece)]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each is stored and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
