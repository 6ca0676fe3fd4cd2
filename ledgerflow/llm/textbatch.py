"""Small helpers that the text operators share: batches of bounded size, tables, scratch folders."""

from __future__ import annotations

from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

if TYPE_CHECKING:  # tasks that only see Arrow batches don't load pandas
    import pandas as pd

# White space of the word rule `[^\x20\x09-\x0D]+`.
WORD = r"[^\x20\x09-\x0D]+"


def small_batches(spark: SparkSession) -> None:
    """Texts are large rows: let Arrow batches hold 8 MB of them at most, on either side of a Python task."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_HELD: dict[str, dict] = {}


def worker_cache(kind: str) -> dict:
    """What this Python worker remembers for tasks of one kind; what it held for others is dropped."""
    for other in [k for k in _HELD if k != kind]:
        del _HELD[other]
    return _HELD.setdefault(kind, {})


FEW_ROWS = 500_000       # narrow rows (a key of up to 32 bytes) sent to all executors at most


def few(rows: DataFrame) -> DataFrame:
    """Marked for broadcast where a count shows that they are few; joined by shuffle otherwise."""
    return F.broadcast(rows) if rows.count() <= FEW_ROWS else rows


def strings(column: pd.Series) -> list[str]:
    """Python strings of a text column; null becomes the empty string."""
    return ["" if x is None or x != x else x for x in column.tolist()]


def spans_of_size(sizes: list[int] | np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Cut rows 0..n into runs [a, b) whose sizes add up to at most ``most``; a larger row is alone."""
    a, total = 0, 0
    for i, n in enumerate(sizes):
        if i > a and total + n > most:
            yield a, i
            a, total = i, 0
        total += n
    if a < len(sizes):
        yield a, len(sizes)


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most ``most`` bytes of text; a longer text is alone."""
    yield from (batch.slice(a, b - a) for a, b in spans_of_size(
        np.nan_to_num(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)), most))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of each (start, length), one after another."""
    lengths = lengths.astype(np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    begin = np.cumsum(lengths) - lengths
    return np.repeat(starts.astype(np.int64) - begin, lengths) + np.arange(total, dtype=np.int64)


def odd_numbers(n: int) -> np.ndarray:
    """Well mixed odd 64-bit numbers, as multipliers of hashed sums."""
    z = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z ^ (z >> np.uint64(31))) | np.uint64(1)
