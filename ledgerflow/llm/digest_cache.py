"""Token counts by way of a cache keyed by content and tokenizer digests.

A text's content is normalised (runs of ASCII white space become one space, ends are trimmed;
the tokenizer drops white space, so counts don't change) and digested by SHA-256; the tokenizer's
version is the SHA-256 of its file.  Counts are looked up in the cache table by both digests; each
distinct content that misses is encoded once, and its count is appended to the table.

The tokenizer of this operator splits at white space before it merges, so a text's count is the sum
over its words; words met before in the same worker are not encoded again.  Texts that hold a
special string of the tokenizer or a control character that counts as white space in Python alone
go to the library whole.

Defined results: null and empty texts have 0 bytes and 0 tokens.  Repeated rows each get a row.
The columns n_bytes and n_tokens replace columns of those names; other columns pass through.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .components import stored
from .idstore import IdStore
from .textbatch import few, spans_of_size, strings, worker_cache

TOKENIZER = "word_bpe_49k.json"
SCHEMA = "digest binary, tokenizer string, n_tokens long"
PIECE = 1 << 21          # characters of text at a time


@dataclass(frozen=True)
class Cache:
    """A Parquet table (digest, tokenizer, n_tokens), append only."""

    path: str

    def read(self, spark: SparkSession, tokenizer: str) -> DataFrame:
        """One row for each digest, also where two runs have appended the same content."""
        return (spark.read.schema(SCHEMA).parquet(self.path).where(F.col("tokenizer") == tokenizer)
                .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))


def open_cache(spark: SparkSession, path: str | None = None) -> Cache:
    """The cache at ``path``, created if need be; without a path a new one in the shared folder."""
    path = path or scratch_path(spark, "token-counts")
    spark.createDataFrame([], SCHEMA).write.mode("append").parquet(path)
    return Cache(path)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def version_of(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def content_digest(text: Column) -> Column:
    normal = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t\n\x0B\f\r]+", " "))
    return F.unhex(F.sha2(normal, 256))


# The tokenizer takes runs of letters and runs of signs by themselves (but for apostrophes).
_LETTERS, _SIGNS = "A-Za-zÀ-ÖØ-öø-ÿ", r".,!?;:%#&$*|\"()=+@/<>\[\]{}-"
PART = re.compile(f"[{_LETTERS}]+|[{_SIGNS}]+")
PLAIN = re.compile(f"[{_LETTERS}{_SIGNS}]+")


class Counter:
    """Counts tokens as the library does, remembering words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = ["\x1c", "\x1d", "\x1e", "\x1f", *special]
        self.parts = IdStore(self._count_parts, counts_only=True)
        self.words = IdStore(self._count_words, counts_only=True)

    def _library(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _count_parts(self, parts: list[str]) -> tuple[None, np.ndarray]:
        """Tokens of each part: parts are encoded in a row, and a token's place tells its part."""
        out = np.zeros(len(parts), np.int64)
        for a, b in spans_of_size([len(w) + 1 for w in parts], 1 << 16):
            got = self.tokenizer.encode(" ".join(parts[a:b]), add_special_tokens=False).offsets
            at = np.fromiter((x for x, _ in got), np.int64, len(got))
            ends = np.cumsum(np.fromiter((len(w) + 1 for w in parts[a:b]), np.int64, b - a))
            out[a:b] = np.bincount(np.searchsorted(ends, at, side="right"), minlength=b - a)
        return None, out

    def _count_words(self, words: list[str]) -> tuple[None, np.ndarray]:
        """Plain words are cut where the tokenizer cuts them, in lower case; their parts recur more often."""
        return None, self.parts.counts_of([PART.findall(w.lower()) if PLAIN.fullmatch(w) else [w] for w in words])

    def count(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        for a, b in spans_of_size([len(x) for x in texts], PIECE):
            whole = [any(map(x.__contains__, self.whole)) for x in texts[a:b]]
            out[a:b] = self.words.counts_of([[] if w else x.split() for w, x in zip(whole, texts[a:b])])
            for i in np.flatnonzero(whole):
                out[a + i] = self._library(texts[a + i])
        return out


def counter(path: str) -> Counter:
    held = worker_cache("counts")
    if path not in held:
        held[path] = Counter(path)
    return held[path]


def count_tokens(docs: DataFrame, cache: Cache, text_col: str = "text", path: str | None = None) -> DataFrame:
    """All rows with n_bytes and n_tokens; appends what the cache lacked."""
    spark = docs.sparkSession
    path = path or tokenizer_path()
    version = version_of(path)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))

    @F.pandas_udf("long")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in batches:
            yield pd.Series(counter(path).count(strings(column)))

    keyed = docs.drop("n_bytes", "n_tokens").withColumn("__digest", content_digest(F.col(text_col)))
    # Contents of several rows are found first; of the texts, only theirs are shuffled.
    shared = few(stored(keyed.groupBy("__digest").count().where("count > 1").select("__digest"), "shared"))
    known = few(stored(cache.read(spark, version).select(F.col("digest").alias("__digest")), "known"))
    contents = keyed.select("__digest", text.alias("content")).join(known, "__digest", "left_anti")
    once = contents.join(shared, "__digest", "left_anti")
    several = contents.join(shared, "__digest", "left_semi").groupBy("__digest").agg(F.first("content").alias("content"))
    (once.unionByName(several)
     .select(F.col("__digest").alias("digest"), F.lit(version).alias("tokenizer"), encoded("content").alias("n_tokens"))
     .write.mode("append").parquet(cache.path))
    counts = cache.read(spark, version).withColumnRenamed("digest", "__digest")
    return (keyed.withColumn("n_bytes", F.octet_length(text).cast("long")).join(counts, "__digest", "left")
            .drop("__digest"))
