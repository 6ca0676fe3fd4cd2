"""Spelling variants: words one edit apart, found by pivotal bigrams, each pointing to its far more frequent form.

Words.  Runs of letters (ASCII and U+00C0 to U+00FF, ASCII in lower case) of whole texts; where 31 divides
the CRC-32 of `<id>:<run>`, the code point at that number modulo the length is taken out.  Distinct
results of MIN_LENGTH code points with MIN_COUNT occurrences are the words.

Near words (one code point inserted, deleted or replaced).  A word's bigrams are ordered by how often they
are in the vocabulary, the rarest first; its prefix holds the first three and all that rank equal to the
third.  Of these, dynamic programming picks the two pivots: bigrams that don't overlap, of the least
frequency together (the first at its distance from the start, the second at its distance from the end).  One edit leaves one of two disjoint bigrams whole: the first pivot, and all before
it, if the edit is behind it; otherwise the second, and all behind it.  Take the word whose prefix ends
earlier in the order (either, if both end alike): its pivot ranks within the other's prefix.  So words meet
where a pivot of one is among the prefix bigrams of the other, at the same distance from the start with the
same letters before it, or from the end with the same behind it, and lengths at most one apart (the position
limits).  They are verified by the bits of their letters and by edit distance in the join.  The table of
bigrams has 90 x 90 x 16 places at most.  Keys with many words are dealt over several tasks.

Defined results: null and empty texts have no words; a null id counts as an empty string; rows of one id
count each; an empty table has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import stored
from .keysets import copied, dealt, hot_keys
from .textbatch import small_batches

MIN_LENGTH = 7
MIN_COUNT = 2
DAMAGE = 31               # one run of so many loses a code point
RATIO = 10                # a form is so many times as frequent as its variant
EDITS = 1
GRAM = 2

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_INDEX = pa.schema([("word", pa.string()), ("n", pa.int64()), ("bits", pa.int64()), ("last", pa.int32()), ("len", pa.int32()),
                    ("gram", pa.int32()), ("pos", pa.int32()), ("pivot", pa.int32())])


def words(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts."""
    low = F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER)
    runs = docs.select(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":")).alias("id"),
                       F.explode(F.regexp_extract_all(low, F.lit(f"[a-zÀ-ÿ]{{{MIN_LENGTH},}}"), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("id", "run").cast("binary"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    cut = F.concat(F.expr("substring(run, 1, at)"), F.expr("substring(run, at + 2)"))
    return (runs.withColumn("h", h).withColumn("at", at)
            .select(F.when(F.col("h") % DAMAGE == 0, cut).otherwise(F.col("run")).alias("word"))
            .where(F.length("word") >= MIN_LENGTH)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT))


def _code_points(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of the words as small numbers, one word after another, and each word's length."""
    points = np.frombuffer("".join(batch).encode("utf-32-le"), np.uint32).astype(np.int64)
    return np.where(points < 128, points - 97, points - 0xC0 + 26), np.array([len(w) for w in batch], np.int64)


LETTERS = 26 + 64


def _grams(batch: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, place and code of each bigram."""
    letters, n = _code_points(batch)
    who = np.repeat(np.arange(len(batch)), n)
    inner = np.flatnonzero(who[:-1] == who[1:])
    begin = np.cumsum(n) - n
    return who[inner], inner - begin[who[inner]], letters[inner] * LETTERS + letters[inner + 1]


PLACES = 16               # places from the start and from the end that are told apart; the last stands for all further ones


def gram_counts(vocabulary: DataFrame) -> np.ndarray:
    """How often each of the 90 x 90 bigrams occurs in the vocabulary, by place from the start [0] and from the end [1]."""
    shape = (2, LETTERS * LETTERS, PLACES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * LETTERS * LETTERS * PLACES, np.int64)
        for batch in batches:
            who, pos, gram = _grams(batch.column("word").to_pylist())
            for cell in _cells(who, pos, gram):
                total += np.bincount(cell, minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.record_batch([some.astype(np.int32), total[some]], names=["cell", "n"])
    found = vocabulary.select("word").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(shape, np.int64)
    for cell, n in found.toLocalIterator():   # 2 x 129,600 rows at most
        out.flat[cell] = n
    return out


def _cells(who: np.ndarray, pos: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the table of counts of bigrams, of each word in order: by distance from the start and from the end."""
    ends = pos[np.searchsorted(who, who, "right") - 1] - pos
    return (gram * PLACES + np.minimum(pos, PLACES - 1),
            (LETTERS * LETTERS + gram) * PLACES + np.minimum(ends, PLACES - 1))


def pivots(places: np.ndarray, costs: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    """For rows of ``sizes`` bigrams in order of place: marks len(costs) that don't overlap, of the least cost together.

    costs[j] holds what each would cost as the j-th; best[j][i] is the least cost of j + 1 of which i is the last.
    """
    rows, width = places.shape
    far = np.int64(2**62)
    inside = np.arange(width) < sizes[:, None]
    best = [np.where(inside, costs[0], far)]
    back = []
    for cost in costs[1:]:
        now, come = np.full((rows, width), far), np.zeros((rows, width), np.int64)
        least, which = np.full(rows, far), np.zeros(rows, np.int64)    # over bigrams that end before the next begins
        done = np.zeros(rows, np.int64)
        for i in range(width):
            for _step in range(GRAM):     # of GRAM bigrams in a row, at most GRAM - 1 overlap the next
                open_ = (done < i) & (places[np.arange(rows), done] + GRAM <= places[:, i])
                value = best[-1][np.arange(rows), done]
                better = open_ & (value < least)
                least, which = np.where(better, value, least), np.where(better, done, which)
                done = done + open_
            now[:, i] = np.where(inside[:, i] & (least < far), least + cost[:, i], far)
            come[:, i] = which
        best.append(now)
        back.append(come)
    mark = np.zeros((rows, width), bool)
    at = best[-1].argmin(1)
    mark[np.arange(rows), at] = True
    for come in reversed(back):
        at = come[np.arange(rows), at]
        mark[np.arange(rows), at] = True
    return mark


def index(vocabulary: DataFrame, counts: np.ndarray) -> DataFrame:
    """A row for each bigram of each word's prefix: (word, n, bits, last, len, gram, pos, pivot); pivots are 1 and 2, others 0."""
    total = counts[0].sum(1)
    rank = np.empty(len(total), np.int64)
    rank[np.lexsort((np.arange(len(total)), total))] = np.arange(len(total))
    first = GRAM * EDITS + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, len(whole), 20_000):
                batch = whole.slice(a, 20_000)
                names = batch.column("word").to_pylist()
                who, pos, gram = _grams(names)
                cells = _cells(who, pos, gram)
                ranked = rank[gram]
                by_rank = np.lexsort((ranked, who))
                heads = np.searchsorted(who, np.arange(len(names)))
                last = ranked[by_rank][heads + first - 1]
                inside = np.flatnonzero(ranked <= last[who])
                who, pos, gram, ranked = who[inside], pos[inside], gram[inside], ranked[inside]
                sizes = np.bincount(who, minlength=len(names))
                column = np.arange(len(who)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                places, *costs = np.zeros((3, len(names), sizes.max()), np.int64)
                places[who, column] = pos
                for cost, cell in zip(costs, cells):
                    cost[who, column] = counts.ravel()[cell[inside]]
                mark = pivots(places, costs, sizes)
                mark = (mark * np.cumsum(mark, 1))[who, column]
                letters, n = _code_points(names)
                bits = np.zeros(len(names), np.uint64)
                np.bitwise_xor.at(bits, np.repeat(np.arange(len(names)), n), np.uint64(1) << (letters % 64).astype(np.uint64))
                at = pa.array(who)
                yield pa.record_batch(
                    [batch.column("word").take(at), batch.column("n").take(at), pa.array(bits[who].view(np.int64)),
                     pa.array(last[who].astype(np.int32)), pa.array(n[who].astype(np.int32)), pa.array(ranked.astype(np.int32)),
                     pa.array(pos.astype(np.int32)), pa.array(mark.astype(np.int32))], schema=_INDEX)
    return vocabulary.select("word", "n").mapInArrow(
        run, "word string, n long, bits long, last int, len int, gram int, pos int, pivot int")


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(word, near, near_n): each pair of near words, in both directions, once."""
    if vocabulary.isEmpty():
        return vocabulary.select("word", F.col("word").alias("near"), F.col("n").alias("near_n"))
    rows = stored(index(vocabulary, gram_counts(vocabulary)), "grams")
    head, tail = F.expr("substring(word, 1, pos + 2)"), F.expr("substring(word, pos + 1)")

    def key(side: str, part, length):
        return F.xxhash64(F.lit(side), part, length)

    held = rows.select(F.col("word").alias("b"), F.col("n").alias("bn"), F.col("bits").alias("bbits"), F.col("last").alias("blast"),
                       F.explode(F.array(key("head", head, F.col("len")), key("tail", tail, F.col("len")))).alias("key"))
    asking = (rows.where("pivot > 0")
              .select("*", F.explode(F.array(*[(F.col("len") + d).alias("x") for d in (-1, 0, 1)])).alias("other"))
              .select(F.col("word").alias("a"), F.col("n").alias("an"), F.col("bits").alias("abits"), F.col("last").alias("alast"),
                      F.when(F.col("pivot") == 1, key("head", head, F.col("other"))).otherwise(key("tail", tail, F.col("other"))).alias("key")))
    hot = hot_keys(held.groupBy("key").agg(F.count("*").alias("c")), ["key"], "c")
    # one replaced letter changes two bits of letters at most, an inserted or deleted one changes one
    close = (F.col("alast") <= F.col("blast")) & (F.bit_count(F.col("abits").bitwiseXOR(F.col("bbits"))) <= 2)
    on = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("key", "__salt")]
    met = (copied(asking, ["key"], hot).alias("x").join(dealt(held, ["key"], hot, ["b"]).alias("y"), on)
           .where(close & (F.levenshtein("a", "b", EDITS) == 1)).select("a", "an", "b", "bn"))
    return (met.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("bn").alias("near_n"))
            .union(met.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("an").alias("near_n")))
            .groupBy("word", "near").agg(F.first("near_n").alias("near_n")))


def group(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word."""
    small_batches(docs.sparkSession)
    vocabulary = stored(words(docs), "vocabulary")
    near = (near_pairs(vocabulary).groupBy("word")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("most")))
    found = stored(vocabulary.join(near, "word", "left")
                   .withColumn("form_n", F.when(-F.col("most.less") >= RATIO * F.col("n"), -F.col("most.less")))
                   .select("word", F.when(F.col("form_n").isNotNull(), F.col("most.near")).alias("form"), "n",
                           F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"), "forms")
    # Each form is RATIO times as frequent as the word before it: chains are short, and halve in every round.
    roots = found.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = roots.join(onward, "root", "left")
        if step.where("next is not null").isEmpty():
            break
        roots = stored(step.select("word", F.coalesce("next", "root").alias("root")), "roots")
    return (found.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
