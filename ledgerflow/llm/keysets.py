"""Fixed-size helpers for keys that are too many to send to every task, or too hot for one.

``KeySet``: a bit for each of 2^27 hash values, 16 MB of memory at any size of the data, and less on the way
and on disk while few are set.  A key that was put in is always found; others are found by chance, more often
the fuller it is, so it only spares work: whoever asks it must stay right when it says yes to a key that was
never put in.

``hot_keys`` / ``dealt``: keys that hold more than 1 / (4 x partitions) of the counted rows number at most
4 x partitions, so they can be broadcast at any size; their rows are dealt over several tasks.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 27


class _Bits:
    """The bits of a KeySet, packed where they are written: the driver and each executor keep a file of a broadcast."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def __reduce__(self):
        return _Bits.unpacked, (zlib.compress(self.words.data, 1),)

    @staticmethod
    def unpacked(packed: bytes) -> _Bits:
        return _Bits(np.frombuffer(zlib.decompress(packed, bufsize=1 << (BITS - 3)), np.uint8))


class KeySet:
    """Broadcast bits of 64-bit keys; ``has`` tests a numpy array of keys."""

    def __init__(self, bits):
        self._bits = bits

    def has(self, keys: np.ndarray) -> np.ndarray:
        bit = (keys & np.uint64((1 << BITS) - 1)).astype(np.int64)
        return (self._bits.value.words[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1

    @staticmethod
    def of(spark: SparkSession, keys: DataFrame, key: str, more: KeySet | None = None) -> KeySet:
        """The keys of a long column, and those of ``more``; at most 2^12 rows of 4 KB reach the driver."""
        bit = F.col(key).bitwiseAND((1 << BITS) - 1)
        rows = (keys.select(bit.alias("b"))
                .groupBy(F.shiftright("b", 15).cast("int").alias("part"))
                .agg(F.bitmap_construct_agg(F.col("b").bitwiseAND((1 << 15) - 1)).alias("bits")))
        words = np.zeros(1 << (BITS - 3), np.uint8) if more is None else more._bits.value.words.copy()
        for part, bits in rows.toLocalIterator():
            words[part << 12:(part + 1) << 12] |= np.frombuffer(bits, np.uint8)
        return KeySet(spark.sparkContext.broadcast(_Bits(words)))

    def release(self) -> None:
        """Frees memory and files everywhere; for sets that no plan still to be run asks."""
        self._bits.destroy()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(counted: DataFrame, keys: list[str], n: str) -> DataFrame:
    """(keys, __salts) of the keys with more than 1 / (4 x partitions) of all rows: 4 x partitions at most."""
    spark = counted.sparkSession
    limit = max((counted.agg(F.sum(n)).first()[0] or 0) / (4 * partitions(spark)), 1.0)
    return counted.where(F.col(n) > limit).select(*keys, F.ceil(F.col(n) / limit).cast("int").alias("__salts"))


def dealt(rows: DataFrame, keys: list[str], hot: DataFrame, by: list[str]) -> DataFrame:
    """Rows with a column __salt: hot keys are dealt by the hash of ``by``, others have 0."""
    return (rows.join(F.broadcast(hot), keys, "left")
            .withColumn("__salt", F.pmod(F.xxhash64(*by), F.coalesce("__salts", F.lit(1))).cast("int")).drop("__salts"))


def copied(rows: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    """Each row once for each __salt of its key, to meet the rows that ``dealt`` has dealt."""
    return (rows.join(F.broadcast(hot), keys, "left")
            .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1))).drop("__salts"))
