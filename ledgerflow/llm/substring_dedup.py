"""Removal of repeated word windows: windows of a few words first, and twice as long ones where those repeat.

A window is ``words`` consecutive words of one text; a word is a run of other bytes than the six ASCII
white spaces.  A word goes if a window that covers it has the same words as one that starts earlier (in
a smaller id, or before it in the same text); all windows are judged on the input.

The ladder goes from about five words by doubling up to ``words`` (5, 10, 20).  At each length but the
last, a window of ``words`` words is told by its anchor, the part of that length with the least hash:
equal windows have equal anchors.  Anchors are counted over all texts; at the next length only windows
go on whose anchor occurs twice or more, until none are left or the ladder ends.  (Longer windows than
``words`` cover no word that those of ``words`` don't.)  What repeats at one length is told to the next
by a KeySet, which never says no to a repeated anchor; the windows that reach the last step are compared
by 128 bits (hash of the anchor and of the window).  They are dealt by their anchor's hash; those of hot
anchors (a passage in very many texts) are combined before the shuffle and dealt over several tasks.
Texts are shuffled only where a KeySet of documents doesn't rule out that words go.

Defined results: null, empty and short texts keep all words; a null id counts as the largest; rows of
one id and text are one document and each gets its result, different texts of one id are ordered by a
hash of the text; other columns, also of clashing names, are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import stored
from .keysets import KeySet, copied, dealt, hot_keys
from .textbatch import slices, small_batches
from .wordhash import WHITE, Words, cut, mixed, text_bytes

WORDS = 20
SHORTEST = 5

_PIECE = 1 << 20          # bytes of text looked at together
_STEP = np.uint64(0x9FB21C651E98DF25)
_ANCHORS = pa.schema([("hash", pa.int64())])
_WINDOWS = pa.schema([("anchor", pa.int64()), ("id", pa.int64()), ("digest", pa.int64()), ("start", pa.int32()),
                      ("hashes", pa.list_(pa.int64()))])


def ladder(words: int, shortest: int = SHORTEST) -> list[int]:
    """Window lengths, each at most twice the one before; the last is ``words``."""
    out = [words]
    while out[0] >= 2 * shortest:
        out.insert(0, (out[0] + 1) // 2)
    return out


class _Windows:
    """Hashes of the windows of a batch, and their anchors."""

    def __init__(self, words: Words, length: int):
        self.words, self.length = words, length
        self.n = len(words.hash)
        self.whole = np.flatnonzero(words.first[words.row + 1] - np.arange(self.n) >= length) if self.n else np.zeros(0, np.int64)

    def hashed(self, length: int) -> np.ndarray:
        """Hash of the ``length`` words from each word on, whatever text they are in."""
        h, out = self.words.hash, np.zeros(max(self.n - length + 1, 0), np.uint64)
        for i in range(length):
            out = out * _STEP + h[i:i + len(out)]
        return mixed(out)

    def anchors(self, length: int, hashed: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """The place of the first least hash of ``length`` words in each of the windows ``whole``."""
        room = self.length - length + 1
        least, place = hashed, np.arange(len(hashed))
        span = 1
        while 2 * span <= room:  # least hash of span places from each on, doubling span
            least, place = _lesser(least[:-span], place[:-span], least[span:], place[span:])
            span *= 2
        a, b = whole, whole + room - span
        return np.where(least[b] < least[a], place[b], place[a])


def _lesser(a: np.ndarray, pa_: np.ndarray, b: np.ndarray, pb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    second = b < a
    return np.where(second, b, a), np.where(second, pb, pa_)


def _candidates(w: _Windows, steps: list[tuple[int, KeySet]]) -> np.ndarray:
    """Windows whose anchors repeat at all lengths so far."""
    whole = w.whole
    for length, repeated in steps:
        if not len(whole):
            break
        hashed = w.hashed(length)
        whole = whole[repeated.has(hashed[w.anchors(length, hashed, whole)])]
    return whole


def _anchors(docs: DataFrame, words: int, length: int, steps: list[tuple[int, KeySet]]) -> DataFrame:
    """Anchors of ``length`` words of the windows that are left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, "text", _PIECE)):
            w = _Windows(cut(*text_bytes(batch.column("text")), WHITE), words)
            whole = _candidates(w, steps)
            if len(whole):
                hashed = w.hashed(length)
                yield pa.record_batch([hashed[np.unique(w.anchors(length, hashed, whole))].view(np.int64)], schema=_ANCHORS)
    return docs.select("text").mapInArrow(run, "hash long")


def _windows(docs: DataFrame, words: int, steps: list[tuple[int, KeySet]]) -> DataFrame:
    """Rows (anchor, id, digest, start, hashes): windows that are left, those of one anchor in one row."""
    length = steps[-1][0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, "text", _PIECE)):
            w = _Windows(cut(*text_bytes(batch.column("text")), WHITE), words)
            whole = _candidates(w, steps)
            if not len(whole):
                continue
            hashed = w.hashed(length)
            anchor = w.anchors(length, hashed, whole)
            head = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1] + 1)]))
            row = w.words.row[whole[head]]
            lists = pa.ListArray.from_arrays(np.append(head, len(whole)).astype(np.int32), w.hashed(words)[whole].view(np.int64))
            out = [pa.array(hashed[anchor[head]].view(np.int64)), batch.column("id").take(pa.array(row)),
                   batch.column("digest").take(pa.array(row)), pa.array((whole[head] - w.words.first[row]).astype(np.int32)), lists]
            for i in range(0, len(head), 50_000):
                yield pa.record_batch([c.slice(i, 50_000) for c in out], schema=_WINDOWS)
    return docs.select("id", "digest", "text").mapInArrow(run, "anchor long, id long, digest long, start int, hashes array<long>")


def repeats(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(id, digest, starts): of each document, windows of which an equal one starts earlier.

    ``docs`` has id, digest and text.  A document's starts are gathered in one row, as its text is.
    """
    spark = docs.sparkSession
    steps: list[tuple[int, KeySet]] = []
    hot = None
    for length in ladder(words)[:-1] or [words]:
        counted = stored(_anchors(docs, words, length, steps).groupBy("hash").agg(F.count("*").alias("n"))
                         .where("n > 1"), "anchors")
        hot = hot_keys(counted, ["hash"], "n").withColumnRenamed("hash", "anchor")
        steps.append((length, KeySet.of(spark, counted, "hash")))
        if counted.isEmpty():
            break  # no candidates survive
    found = _windows(docs, words, steps)
    each = F.posexplode("hashes").alias("i", "hash")
    place, key = F.struct("id", "digest", "start"), ["anchor", "hash"]

    calm = found.join(F.broadcast(hot), "anchor", "left_anti")
    calm = (calm.repartition("anchor").select("anchor", "id", "digest", F.col("start").alias("s"), each)
            .select("anchor", "hash", "id", "digest", (F.col("s") + F.col("i")).alias("start"))
            .select("id", "digest", "start", F.expr("min(struct(id, digest, start)) over (partition by anchor, hash)").alias("first")))

    many = (found.join(F.broadcast(hot), "anchor", "left_semi").select("anchor", "id", "digest", F.col("start").alias("s"), each)
            .select("anchor", "hash", "id", "digest", (F.col("s") + F.col("i")).alias("start")))
    firsts = stored(many.groupBy("anchor", "hash").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1"), "firsts")
    hot_windows = hot_keys(firsts, key, "n")
    many = (dealt(many, key, hot_windows, ["id", "digest"]).join(copied(firsts.drop("n"), key, hot_windows), [*key, "__salt"])
            .select("id", "digest", "start", "first"))

    return (calm.where(place > F.col("first")).select("id", "digest", "start")
            .union(many.where(place > F.col("first")).select("id", "digest", "start"))
            .groupBy("id", "digest").agg(F.collect_set("start").alias("starts")))


def _keep(words: int):
    """Arrow batches with a column __starts: words outside those windows, their digest and counts as ``__out``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, "text", _PIECE)):
            texts, starts = batch.column("text").cast(pa.large_binary()), batch.column("__starts")
            n_words, n_removed, kept = [], [], []
            for i in range(len(batch)):
                parts = (texts[i].as_py() or b"").split()
                n_words.append(len(parts))
                if starts[i].is_valid:
                    at, mark = starts[i].values.to_numpy(), np.zeros(len(parts) + 1, np.int64)
                    np.add.at(mark, at, 1)
                    np.add.at(mark, at + words, -1)
                    parts = list(compress(parts, (np.cumsum(mark)[:-1] == 0).tolist()))
                n_removed.append(n_words[-1] - len(parts))
                kept.append(b" ".join(parts))
            result = pa.StructArray.from_arrays(
                [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), pa.array(kept, pa.binary()).cast(pa.string())],
                [f.name for f in RESULT.fields])
            names = [n for n in batch.schema.names if n != "__starts"]
            yield pa.record_batch([*[batch.column(n) for n in names], result], names=[*names, "__out"])
    return run


RESULT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                       T.StructField("kept_sha256", T.StringType()), T.StructField("kept", T.StringType())])


def dedup(docs: DataFrame, words: int = WORDS, out: str = "dedup") -> DataFrame:
    """``docs`` with a struct ``out`` of n_words, n_removed, kept_sha256 and kept (the words left, joined by one space)."""
    spark = docs.sparkSession
    small_batches(spark)
    keyed = (docs.withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)))
             .withColumn("__digest", F.xxhash64(F.coalesce("text", F.lit("")))))
    found = stored(repeats(keyed.select(F.col("__id").alias("id"), F.col("__digest").alias("digest"), "text"), words), "repeats")
    changed = KeySet.of(spark, found.select(F.xxhash64("id", "digest").alias("key")), "key")

    def chosen(wanted: bool):
        """Rows of documents that may change, or the others; a task has one Python worker for all it does."""
        keep = _keep(words)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                may = changed.has(batch.column("__key").to_numpy(zero_copy_only=False).view(np.uint64))
                some = batch.filter(pa.array(may == wanted)).drop_columns(["__key"])
                if len(some) and wanted:
                    yield some
                elif len(some):
                    none = pa.nulls(len(some), pa.list_(pa.int32()))
                    yield from keep([pa.record_batch([*some.columns, none], names=[*some.schema.names, "__starts"])])
        return run

    asked = keyed.withColumn("__key", F.xxhash64("__id", "__digest"))
    starts = found.select(F.col("id").alias("__id"), F.col("digest").alias("__digest"), F.col("starts").alias("__starts"))
    schema = T.StructType([*docs.schema.fields, T.StructField("__out", RESULT)])
    same = asked.select(*docs.columns, "__key").mapInArrow(chosen(False), schema)
    rest = asked.mapInArrow(chosen(True), keyed.schema).join(starts, ["__id", "__digest"], "left")
    done = same.union(rest.select(*docs.columns, "__starts").mapInArrow(_keep(words), schema))
    return done.select(*[c for c in docs.columns if c != out], F.col("__out").alias(out))
