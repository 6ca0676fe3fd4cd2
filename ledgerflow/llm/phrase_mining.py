"""Collocated phrases of each language by Toivonen's method: a sample proposes, full passes count exactly.

Texts (ASCII letters in lower case) are cut into pieces at `.,;:!?` and line ends, pieces into words at
spaces and tabs; a phrase is up to four words in a row within a piece.

A sample of the documents (a share of 1 / SAMPLE, chosen by hash) proposes the phrases that it holds
SAMPLE_LEAST times or more.  The full pass counts, exactly and over all documents, every phrase whose parts
without its last and without its first word are both proposed: that is each proposed phrase whose parts
are proposed, and the negative border (phrases not proposed whose parts are; for single words, all words).
A phrase that occurs often enough without being proposed is a failure of the border: it becomes proposed,
and the next pass counts the phrases that have come into reach by it.  When a pass finds no failure, all
frequent phrases have been counted: both parts of a frequent phrase are frequent, so proposed by then.

The proposed set is a KeySet of fixed size.  A phrase that it takes for proposed by chance only means that
more is counted, and nothing is counted twice: a pass leaves out what was within reach before.  These
passes count 64-bit hashes of phrases; two phrases of one hash only make a count too large.  So a last pass
counts the phrases of frequent hashes by their own characters.  A batch's phrases are added up before
they are shuffled.

Defined results: null and empty texts have no words; a null language is `und`; rows of one id count
each; an empty table gives no phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import stored
from .keysets import KeySet, copied, dealt, hot_keys
from .textbatch import ragged, slices, small_batches
from .wordhash import byte_table, cut, mixed, seed, text_bytes

LONGEST = 4
LEAST = 30                # occurrences of a candidate
SAMPLE = 16               # one document of so many
SAMPLE_LEAST = 2          # occurrences in the sample that propose
TOP = 2000
UNKNOWN = "und"

_BREAKS = byte_table(b".,;:!?\n\v\f\r")
_OUTSIDE = _BREAKS | byte_table(b" \t")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0x9FB21C651E98DF25)
_HASHES = pa.schema([("k", pa.int32()), ("hash", pa.int64()), ("n", pa.int64())])
_COUNTS = pa.schema([("lang", pa.string()), ("k", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])
_PIECE = 2 << 20          # bytes of text looked at together


class _Phrases:
    """Words of a batch, with hashes that hold the language, and where phrases of k words begin."""

    def __init__(self, batch: pa.RecordBatch):
        data, bounds = text_bytes(batch.column("text"))
        self.words = w = cut(_LOWER[data], bounds, _OUTSIDE)
        self.langs = batch.column("lang").dictionary_encode()
        self.lang = self.langs.indices.to_numpy(zero_copy_only=False)[w.row]
        seeds = np.array([seed(x) for x in self.langs.dictionary.to_pylist()], np.uint64)
        self.single = mixed(w.hash ^ seeds[self.lang]) if len(w.hash) else w.hash
        self.next = np.diff(w.row) == 0                                # the next word is in the same piece
        at, byte = np.arange(len(w.end) - 1) if len(w.end) else w.end, w.end[:-1]
        for _ in range(3):                                             # bytes between the two, one after another
            near = byte < w.start[at + 1]
            at, byte = at[near], byte[near]
            self.next[at[_BREAKS[w.data[byte]]]] = False
            byte = byte + 1
        breaks = np.flatnonzero(_BREAKS[w.data]) if len(at) else at    # longer gaps
        self.next[at[np.searchsorted(breaks, byte) < np.searchsorted(breaks, w.start[at + 1])]] = False

    def levels(self, proposed: KeySet | None, before: KeySet | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(k, starts, hashes) of phrases both of whose parts are proposed (None: any), but were not before."""
        starts, hashed = np.arange(len(self.single)), self.single
        yield 1, starts[:0] if before else starts, hashed[:0] if before else hashed
        old = np.ones(len(starts), bool)          # of the starts: within reach before
        for k in range(2, LONGEST + 1):
            ok = np.ones(len(starts), bool) if proposed is None else proposed.has(hashed)
            was = old & before.has(hashed) if before else old
            starts, hashed, was = starts[ok], hashed[ok], was[ok]
            pair = np.flatnonzero((np.diff(starts) == 1) & self.next[starts[:-1] + k - 2]) if len(starts) else starts
            starts, old = starts[pair], was[pair] & was[pair + 1] if len(pair) else pair.astype(bool)
            hashed = mixed(hashed[pair] * _STEP + self.single[starts + k - 1])
            yield (k, starts, hashed) if before is None else (k, starts[~old], hashed[~old])


def _tally(hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the hashes, where each distinct one begins in it, and how many there are of it."""
    order = np.argsort(hashed)
    heads = np.flatnonzero(np.concatenate([[True], np.diff(hashed[order]) != 0])) if len(hashed) else order
    return order, heads, np.diff(np.append(heads, len(hashed)))


def _hash_counts(docs: DataFrame, proposed: KeySet | None, before: KeySet | None, most: int = LONGEST) -> DataFrame:
    """(k, hash, n) of phrases within reach of ``proposed`` and not of ``before``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, "text", _PIECE)):
            for k, _, hashed in _Phrases(batch).levels(proposed, before):
                if k <= most and len(hashed):
                    order, heads, n = _tally(hashed)
                    yield pa.record_batch([np.full(len(heads), k, np.int32), hashed[order[heads]].view(np.int64), n], schema=_HASHES)
    return (docs.select("lang", "text").mapInArrow(run, "k int, hash long, n long")
            .groupBy("k", "hash").agg(F.sum("n").alias("n")))


def _exact_counts(docs: DataFrame, wanted: KeySet) -> DataFrame:
    """(lang, k, phrase, n) of phrases of wanted hashes, counted by their characters; for each language a
    row of k = 0 with the number of words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, "text", _PIECE)):
            p = _Phrases(batch)
            n = np.bincount(p.lang, minlength=len(p.langs.dictionary))
            yield pa.record_batch([p.langs.dictionary, np.zeros(len(n), np.int32), pa.array([""] * len(n), pa.string()),
                                   n.astype(np.int64)], schema=_COUNTS)
            for k, starts, hashed in p.levels(wanted):
                ok = wanted.has(hashed)
                yield from _phrase_rows(p, k, starts[ok], hashed[ok])
    return (docs.select("lang", "text").mapInArrow(run, "lang string, k int, phrase string, n long")
            .groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n")))


def _phrase_rows(p: _Phrases, k: int, starts: np.ndarray, hashed: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Distinct phrases of a batch with their numbers.  Phrases of one hash have the same words but for
    chance; a second hash, of their words in another order of steps, shows chance, and then all go out singly."""
    order, heads, n = _tally(hashed)
    sums = _sums(p, k, starts)[order]
    if (sums != np.repeat(sums[heads], n)).any():
        heads, n = np.arange(len(starts)), np.ones(len(starts), np.int64)
    at = starts[order[heads]]
    text, bounds = _joined(p, k, at)
    lang = pa.DictionaryArray.from_arrays(pa.array(p.lang[at].astype(np.int32)), p.langs.dictionary).cast(pa.string())
    if len(at):
        phrase = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(text)])
        yield pa.record_batch([lang, np.full(len(at), k, np.int32), phrase.cast(pa.string()), n], schema=_COUNTS)


def _sums(p: _Phrases, k: int, starts: np.ndarray) -> np.ndarray:
    w, out = p.words, p.lang[starts].astype(np.uint64)
    for i in reversed(range(k)):
        out = mixed(out * _STEP + w.hash[starts + i] + (w.end - w.start)[starts + i].astype(np.uint64))
    return out


def _joined(p: _Phrases, k: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the phrases, words joined by one space, and where each begins."""
    w = p.words
    each = (starts[:, None] + np.arange(k)).ravel()
    n = (w.end - w.start)[each] + 1
    data = w.data[np.minimum(ragged(w.start[each], n), len(w.data) - 1)] if len(each) else np.zeros(0, np.uint8)
    ends = np.cumsum(n)
    data[ends - 1] = 32
    bounds = np.concatenate([[0], ends[k - 1::k]])
    keep = np.ones(len(data), bool)
    keep[bounds[1:] - 1] = False      # no space behind a phrase
    return data[keep], bounds - np.arange(len(bounds))


def frequent(docs: DataFrame, least: int = LEAST, sample: int = SAMPLE) -> DataFrame:
    """(lang, k, phrase, n) of the phrases with ``least`` occurrences, and of k = 0, the words of each language."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"),
                       (F.pmod(F.xxhash64("doc_id", "text"), F.lit(sample)) == 0).alias("chosen"))
    sampled = _hash_counts(rows.where("chosen"), None, None, LONGEST - 1)
    proposed, before, found = KeySet.of(spark, sampled.where(F.col("n") >= SAMPLE_LEAST), "hash"), None, None
    while True:
        new = stored(_hash_counts(rows, proposed, before).where(F.col("n") >= least), "phrases")
        _release(before)
        old, found = found, KeySet.of(spark, new, "hash", found)
        _release(old)
        failures = new.where(_unproposed(proposed)("hash") & (F.col("k") < LONGEST)).select("hash")
        if failures.isEmpty():
            _release(proposed)
            counts = stored(_exact_counts(rows, found).where((F.col("n") >= least) | (F.col("k") == 0)), "phrases")
            _release(found)
            return counts
        before, proposed = proposed, KeySet.of(spark, failures, "hash", proposed)


def _release(keys: KeySet | None) -> None:
    if keys is not None:
        keys.release()


def _unproposed(proposed: KeySet):
    @F.arrow_udf("boolean")
    def unproposed(key: pa.Array) -> pa.Array:
        return pa.array(~proposed.has(key.to_numpy(zero_copy_only=False).view(np.uint64)))
    return unproposed


def _part(first: bool, size):
    """The first ``size`` words of a phrase, or those behind them."""
    words = F.split("phrase", " ")
    return F.array_join(F.slice(words, 1, size) if first else F.slice(words, size + 1, F.col("k") - size), " ")


def _with_count(rows: DataFrame, part: str, out: str, counts: DataFrame) -> DataFrame:
    """The number of occurrences of a part; parts of very many phrases are dealt over several tasks."""
    key = ["lang", part]
    hot = hot_keys(rows.groupBy(*key).agg(F.count("*").alias("__n")), key, "__n")
    numbers = counts.select("lang", F.col("phrase").alias(part), F.col("n").alias(out))
    return dealt(rows, key, hot, ["phrase"]).join(copied(numbers, key, hot), [*key, "__salt"]).drop("__salt")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, sample: int = SAMPLE) -> DataFrame:
    """The first ``top`` phrases of each language by score, ties by occurrences and by the phrase."""
    small_batches(docs.sparkSession)
    found = frequent(docs, least, sample)
    words = found.where("k = 0").groupBy("lang").agg(F.sum("n").alias("n"))     # one row for each language
    counts = found.where("k > 0")
    candidates = counts.where("k > 1").withColumnRenamed("n", "a")

    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = stored(cuts.withColumns({"head": _part(True, F.col("cut")), "rest": _part(False, F.col("cut"))}), "cuts")
    cuts = _with_count(_with_count(cuts, "head", "l", counts), "rest", "r", counts)
    exact = "decimal(38,0)"
    cuts = cuts.withColumn("score", F.expr(f"(cast(2000000 as {exact}) * cast(a as decimal(20,0))) div cast(l + r as {exact})"))
    scored = (cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min_by(F.struct("l", "r", "score"), F.struct("score", "cut")).alias("c"))
              .select("lang", "phrase", "a", "c.l", "c.r", "c.score"))

    inner = (candidates.where("k > 2").select("lang", F.col("a").alias("longer"), "k", F.split("phrase", " ").alias("w"))
             .withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1)))
             .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)))
             .select("lang", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("phrase"), "longer")
             .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    kept = (scored.join(inner, ["lang", "phrase"], "left")
            .where("longer is null or cast(100 as decimal(20,0)) * longer < cast(80 as decimal(20,0)) * a").drop("longer"))

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    first = kept.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    ranked = (first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
              .where(F.col("rank") <= top))
    return (ranked.join(words, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")))
