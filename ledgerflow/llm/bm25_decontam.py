"""Benchmark decontamination: BM25 over an inverted index of test items, with block-max pruning.

Index.  Words are runs of letters and digits of the lower-cased text.  An item's score for a passage
is BM25 over the passage's distinct words, divided by the item's score for itself, so that a passage
that holds the item has score 1 and one threshold fits items of any length.  Items are put in blocks
of ``BLOCK`` (in order of their rarest words, so that blocks are alike); the index holds for each word
its items with their impacts, and its blocks with the largest impact in each.

Queries.  Each text is cut into cells of as many words as the longest item has, and each two
neighbouring cells are a passage, so an item's copy lies within one.  For all passages of a batch at
once: words in over an eighth of the items only add their largest impact to every block's bound; the
block lists of the others add up to the blocks' bounds; blocks under the threshold are passed over;
items of the other blocks are scored in full.  All items at or above the threshold are retrieved.

Verification.  An item's question is its text up to the last question mark, or else its first three
quarters; its answer is the rest.  Both are compared as shingles of five words with the passage; an
item is held where ``question_share`` of the one and ``answer_share`` of the other occur.  Columns
``question`` and ``answer`` of the items are used where there are any.

Many items are taken in parts of ``ITEMS`` at most, so what a task holds doesn't grow with the table;
word statistics are those of all items.

Defined results: null and empty texts hold nothing; items without words are left out.  A text's match
with an item is the passage of the highest score; items are listed by id.  Repeated rows get the same
result; repeated items are listed each.  The column ``out`` is replaced; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textbatch import odd_numbers, ragged, spans_of_size, strings, worker_cache
from .wordhash import whole_hash

K1, B = 1.2, 0.75
BLOCK = 8                # items of a block
ITEMS = 20_000           # items of a part of the index
SHINGLE = 5
PIECE = 1 << 20          # characters of text at a time
ROOM = 1 << 22           # sums of a batch: passages x blocks at most
MATCH = "array<struct<item_id:long,score:double,question:double,answer:double>>"

_ODD = odd_numbers(256)
_M = np.uint64(0xD6E8FEB86659FD93)
_KIND: np.ndarray | None = None


def _is_word_char() -> np.ndarray:
    """Whether a code point is a letter or a digit, for all code points."""
    global _KIND
    if _KIND is None:
        flags = np.zeros(0x110000, bool)
        for a, b in ((0, 0xD800), (0xE000, 0x110000)):
            flags[a:b] = [chr(c).isalnum() for c in range(a, b)]
        _KIND = flags
    return _KIND


def word_hashes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of the lower-cased text."""
    raw = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    inside = _is_word_char()[raw]
    flips = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    start, length = flips[0::2], flips[1::2] - flips[0::2]
    if not len(start):
        return np.zeros(0, np.uint64), start
    at = np.flatnonzero(inside)
    place = at - np.repeat(start, length)
    h = np.add.reduceat(raw[at].astype(np.uint64) * _ODD[place & 255], np.cumsum(length) - length)
    h = (h ^ (h >> np.uint64(31))) * _M + length.astype(np.uint64)
    for i in np.flatnonzero(length > 256).tolist():
        h[i] = whole_hash(raw[start[i]:start[i] + length[i]].tobytes())
    return h ^ (h >> np.uint64(29)), start


def shingles(h: np.ndarray) -> np.ndarray:
    """Distinct hashed runs of SHINGLE words; a shorter text is one run."""
    if not len(h):
        return h
    n, k = max(1, len(h) - SHINGLE + 1), min(SHINGLE, len(h))
    total = np.full(n, k, np.uint64)
    for j in range(k):
        total += (h[j:j + n] ^ (h[j:j + n] >> np.uint64(17))) * _ODD[j + 7]
    return np.unique(total)


@dataclass
class Lists:
    """For each term a list of (place, value), end to end."""

    first: np.ndarray
    many: np.ndarray
    place: np.ndarray
    value: np.ndarray

    @staticmethod
    def of(term: np.ndarray, place: np.ndarray, value: np.ndarray, terms: int) -> "Lists":
        order = np.lexsort((place, term))
        many = np.bincount(term, minlength=terms)
        return Lists(np.cumsum(many) - many, many, place[order], value[order])

    def spread(self, owner: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(owner, place, value) of the lists of these terms."""
        n = self.many[term]
        at = ragged(self.first[term], n)
        return np.repeat(owner, n), self.place[at], self.value[at]


@dataclass
class Index:
    item_ids: list[int]
    questions: list[np.ndarray]     # shingles
    answers: list[np.ndarray]
    words: np.ndarray               # sorted hashes
    ceiling: np.ndarray             # of each word: the largest impact
    common: np.ndarray              # of each word: in over an eighth of the items
    blocks: Lists                   # of each word: its largest impact in each block of items
    items: Lists                    # of each word: its postings, block after block
    run_first: np.ndarray           # of each entry of blocks: where its postings begin in items
    run_many: np.ndarray
    longest: int                    # words of the longest item

    def postings_of(self, owner: np.ndarray, term: np.ndarray, is_open: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(owner, item, value) of the postings in open blocks; those of closed blocks are skipped unread."""
        many = self.blocks.many[term]
        entry, owner = ragged(self.blocks.first[term], many), np.repeat(owner, many)
        ok = is_open[owner, self.blocks.place[entry]]
        entry, owner = entry[ok], owner[ok]
        at = ragged(self.run_first[entry], self.run_many[entry])
        return np.repeat(owner, self.run_many[entry]), self.items.place[at], self.items.value[at]


def question_and_answer(text: str, question: str | None, answer: str | None) -> tuple[np.ndarray, np.ndarray]:
    if question and answer:
        return shingles(word_hashes(question)[0]), shingles(word_hashes(answer)[0])
    h, start = word_hashes(text)
    mark = text.rfind("?")
    cut = int(np.searchsorted(start, mark)) if mark >= 0 else 0
    if not 0 < cut < len(h):
        cut = max(1, len(h) * 3 // 4)
    return shingles(h[:cut]), shingles(h[cut:])


def build(rows: list[tuple[int, str, str | None, str | None]], documents: dict[int, int], total: int, mean: float) -> Index:
    """Index of items (id, text, question, answer); ``documents`` has the items of each word among all ``total``."""
    found = [(i, t, q, a, word_hashes(t)[0]) for i, t, q, a in rows]
    found = [x for x in found if len(x[4])]
    rarest = {n: min(zip((documents.get(w, 1) for w in x[4].tolist()), x[4].tolist())) for n, x in enumerate(found)}
    found = [found[n] for n in sorted(range(len(found)), key=lambda n: (rarest[n], found[n][0]))]
    words = np.unique(np.concatenate([x[4] for x in found])) if found else np.zeros(0, np.uint64)
    df = np.array([documents.get(w, 1) for w in words.tolist()], np.float64)
    idf = np.log1p((total - df + 0.5) / (df + 0.5))
    term, place, value = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    for n, x in enumerate(found):
        w, tf = np.unique(x[4], return_counts=True)
        t = np.searchsorted(words, w)
        impact = idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(x[4]) / mean))
        term.append(t)
        place.append(np.full(len(t), n))
        value.append(impact / impact.sum())
    term, place, value = np.concatenate(term), np.concatenate(place), np.concatenate(value)
    ceiling = np.zeros(len(words))
    np.maximum.at(ceiling, term, value)
    n_blocks = -(-max(1, len(found)) // BLOCK)
    key, back = np.unique(term * n_blocks + place // BLOCK, return_inverse=True)
    most = np.zeros(len(key))
    np.maximum.at(most, back, value)
    runs = np.bincount(back, minlength=len(key))
    pairs = [question_and_answer(x[1], x[2], x[3]) for x in found]
    return Index([x[0] for x in found], [q for q, _ in pairs], [a for _, a in pairs], words, ceiling, df > total / 8,
                 Lists.of(key // n_blocks, key % n_blocks, most, len(words)),
                 Lists.of(term, place, value, len(words)), np.cumsum(runs) - runs, runs, max((len(x[4]) for x in found), default=1))


def _distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    return keys[np.concatenate(([True], keys[1:] != keys[:-1]))]


def retrieve(index: Index, word: np.ndarray, cell: np.ndarray, window_of: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, item, score) of all items at or above ``least``.

    ``word``, ``cell``: a known word's number and its cell; ``window_of``: for each cell its windows (two
    columns, -1 for none).
    """
    if not len(word):
        return cell, word, np.zeros(0)
    n_words, n_blocks, n_items = len(index.words), -(-len(index.item_ids) // BLOCK), len(index.item_ids)
    key = _distinct(cell * n_words + word)
    cell, word = key // n_words, key % n_words
    both = window_of[cell]
    key = _distinct(np.concatenate([both[:, k][both[:, k] >= 0] * n_words + word[both[:, k] >= 0] for k in (0, 1)]))
    window, word = key // n_words, key % n_words
    out = []
    edges = np.append(np.flatnonzero(np.diff(window, prepend=-1)), len(window))
    step = max(1, ROOM // max(1, n_blocks * BLOCK))
    for lo in range(0, len(edges) - 1, step):
        part = slice(edges[lo], edges[min(lo + step, len(edges) - 1)])
        base = window[part.start]
        own, term = window[part] - base, word[part]
        n = int(own[-1]) + 1
        # Bounds of the blocks: lists of the rarer words, and the ceilings of the common ones.
        often = index.common[term]
        floor = np.bincount(own[often], index.ceiling[term[often]], minlength=n)
        o, block, v = index.blocks.spread(own[~often], term[~often])
        bound = np.bincount(o * n_blocks + block, v, minlength=n * n_blocks).reshape(n, n_blocks) + floor[:, None]
        open_block = bound >= least - 1e-9
        live = open_block.any(axis=1)
        if not live.any():
            continue
        sel = live[own]
        o, item, v = index.postings_of(own[sel], term[sel], open_block)
        score = np.bincount(o * n_items + item, v, minlength=n * n_items)
        hit = np.flatnonzero(score >= least)
        out.append((hit // n_items + base, hit % n_items, score[hit]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*out))


def matches(texts: list[str], index: Index, least: float, question_share: float, answer_share: float) -> list[list[dict]]:
    """The items that each text holds."""
    found: list[dict[int, dict]] = [{} for _ in texts]
    for a, b in spans_of_size([len(x) for x in texts], PIECE) if len(index.words) else ():
        h, start = word_hashes("\n".join(texts[a:b]))
        if not len(h):
            continue
        ends = np.cumsum([len(x.lower()) + 1 for x in texts[a:b]])
        doc = np.searchsorted(ends, start, side="right")
        begin = np.flatnonzero(np.diff(doc, prepend=-1))
        size = np.diff(np.append(begin, len(doc)))
        cells = -(-size // index.longest)
        first_cell = np.cumsum(cells) - cells
        number = np.arange(len(h)) - np.repeat(begin, size)
        cell = np.repeat(first_cell, size) + number // index.longest
        # Window w is cells w and w + 1 of one text; the last cell begins one where it is alone.
        n = int(cells.sum())
        last = np.zeros(n, bool)
        last[first_cell + cells - 1] = True
        alone = np.repeat(cells == 1, cells)
        begins = ~last | alone
        window_of = np.stack([np.where(begins, np.arange(n), -1),
                              np.where(np.arange(n) > np.repeat(first_cell, cells), np.arange(n) - 1, -1)], axis=1)
        at = np.minimum(np.searchsorted(index.words, h), len(index.words) - 1)
        known = index.words[at] == h
        cell_begin = np.flatnonzero(np.diff(cell, prepend=-1))
        for w, item, score in zip(*retrieve(index, at[known], cell[known], window_of, least)):
            lo = cell_begin[w]
            d = doc[lo]
            row = int(np.searchsorted(begin, lo, side="right")) - 1
            passage = h[lo:min(lo + 2 * index.longest, begin[row] + size[row])]
            here = shingles(passage)
            q, r = _share(index.questions[item], here, passage), _share(index.answers[item], here, passage)
            if q >= question_share and r >= answer_share:
                best = found[a + d].get(int(item))
                if best is None or best["score"] < score:
                    found[a + d][int(item)] = {"item_id": index.item_ids[item], "score": float(min(score, 1.0)),
                                               "question": q, "answer": r}
    return [sorted(x.values(), key=lambda m: m["item_id"]) for x in found]


def _share(of: np.ndarray, within: np.ndarray, words: np.ndarray) -> float:
    """Share of shingles that occur; a part of under five words (one short run) must occur in a row."""
    if not len(of):
        return 1.0
    if len(of) == 1:
        for k in range(1, SHINGLE):
            if len(words) >= k and of[0] in _runs(words, k):
                return 1.0
    return float(np.isin(of, within, assume_unique=True).mean())


def _runs(h: np.ndarray, k: int) -> np.ndarray:
    n = len(h) - k + 1
    total = np.full(n, k, np.uint64)
    for j in range(k):
        total += (h[j:j + n] ^ (h[j:j + n] >> np.uint64(17))) * _ODD[j + 7]
    return total


def _holder(sent: Broadcast, least: float, question_share: float, answer_share: float) -> Callable[[Column], Column]:
    @F.pandas_udf(MATCH)
    def held(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        worker_cache("benchmark")
        for column in batches:
            yield pd.Series(matches(strings(column), sent.value, least, question_share, answer_share))

    return held


def find(docs: DataFrame, items: DataFrame, text_col: str = "text", out: str = "held", least: float = 0.5,
         question_share: float = 0.75, answer_share: float = 0.5) -> DataFrame:
    """All rows with the column ``out``: the items that the text holds (see MATCH)."""
    spark = docs.sparkSession

    def column(name: str):
        return F.col(name).cast("string") if name in items.columns else F.lit(None).cast("string")

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(column("text"), F.concat_ws(" ", column("question"), column("answer"))).alias("text"),
                        column("question").alias("question"), column("answer").alias("answer"))

    @F.pandas_udf("array<long>")
    def words(texts: pd.Series) -> pd.Series:
        return pd.Series([word_hashes(x)[0].view(np.int64).tolist() for x in strings(texts)])

    hashed = rows.select("*", words("text").alias("words")).where(F.size("words") > 0)
    total, length = hashed.agg(F.count("*"), F.coalesce(F.avg(F.size("words")), F.lit(1.0))).first()
    parts = -(-total // ITEMS)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(parts, 1)))
    df = hashed.select(F.explode(F.array_distinct("words")).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    result = docs.drop(out)
    names = []
    for p in range(parts):
        mine = hashed.where(part == p)
        # At most about ITEMS items and their words come to the driver at a time.
        listed = [(r.item_id, r.text, r.question, r.answer) for r in mine.collect()]
        terms = mine.select(F.explode("words").alias("w")).distinct()
        documents = {r.w & 0xFFFFFFFFFFFFFFFF: r.n for r in df.join(terms, "w").collect()}
        sent = spark.sparkContext.broadcast(build(listed, documents, total, length))
        names.append(f"__held{p}")
        result = result.withColumn(names[-1], _holder(sent, least, question_share, answer_share)(F.col(text_col).cast("string")))
    every = F.array_sort(F.concat(*[F.col(n) for n in names])) if names else F.lit(None).cast(MATCH)
    return result.withColumn(out, F.coalesce(every, F.array().cast(MATCH))).drop(*names)
