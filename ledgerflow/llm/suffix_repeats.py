"""Quality rules on repetition: suffix arrays and longest-common-prefix intervals of each text.

The words of a text (runs of other than ASCII white space) form a sequence.  Its suffixes are
sorted by prefix doubling, many texts side by side: a text's number is part of its first sort key,
so suffixes of different texts never meet.  The longest common prefix of neighbours in the order
gives, for each word, the longest passage that starts there and occurs elsewhere in the text: the
width of its deepest LCP interval.  Prefixes are taken in text order: where the words before two
neighbours are equal too, the prefix is one shorter than the word before has, so only the others are
compared word by word (n log n words in all), and memory stays in proportion to the text.  The spans of all repeated passages of ``min_words`` words or
more are united; a text is kept when it passes the base rules, the united spans cover at most
``max_covered`` per cent of its words, and no repeated passage is longer than ``max_longest`` words.

Defined results: text null, empty or of white space alone: no words, base_failed true.  Occurrences
may overlap.  A repeated row gets the same result.  The result is one struct column, which replaces
a column of its name; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbatch import spans_of_size, strings

RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, covered_words long, longest_repeat long, kept boolean")
WINDOW = 8               # words of the base rule's windows
PIECE = 1 << 20          # characters of text at a time
COMPARED = 1 << 16       # words of neighbours compared at a time
_SPACE = " \t\n\v\f\r"
_SYMBOLS = "#*$%&|<>"


def longest_repeats(words: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """For each word, the length of the longest passage from there that occurs twice in its text.

    ``words``: numbers of words, text after text; ``begin``: the first word of each (non-empty) text.
    """
    n = len(words)
    doc = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, n)))
    end = np.append(begin[1:], n)[doc]
    key = doc * (int(words.max()) + 1) + words
    rank = np.empty(n, np.int64)
    active, h = np.arange(n), 1
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    base = np.arange(n)
    while True:
        # Groups of equal keys; a group's rank is the place of its first member.
        new = np.concatenate(([True], sorted_key[1:] != sorted_key[:-1]))
        head = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        rank[active[order]] = base[head]
        same = np.zeros(len(order), bool)
        same[1:] = ~new[1:]
        same[:-1] |= ~new[1:]
        if not same.any():
            break
        active, base = active[order][same], base[same]
        follow = active + h
        second = np.where(follow < end[active], rank[np.minimum(follow, n - 1)] + 1, 0)
        key = rank[active] * (n + 1) + second
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        h *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    before = np.empty(n, np.int64)  # the suffix before each one in the order
    before[suffixes[1:]] = suffixes[:-1]
    before[suffixes[0]] = suffixes[0]
    lcp = common_prefixes(words, doc, end, before)
    best = lcp.copy()
    np.maximum.at(best, before, lcp)
    return best


def common_prefixes(words: np.ndarray, doc: np.ndarray, end: np.ndarray, before: np.ndarray) -> np.ndarray:
    """For each suffix its common prefix with the suffix ``before`` it; 0 for the first of a text."""
    at = np.arange(len(words))
    alone = doc[before] != doc
    alone[before == at] = True
    # Equal words in front of both: the prefix is one shorter than that of the suffix that starts there.
    follows = ~alone & (at > 0) & (before > 0)
    follows &= (doc[at - 1] == doc) & (doc[before - 1] == doc) & (words[at - 1] == words[before - 1])
    lcp = np.zeros(len(words), np.int64)
    i, step = np.flatnonzero(~follows & ~alone), 1
    while len(i):
        # The next ``step`` words of each pair that agreed so far, a bounded number of words at a time.
        goes_on = []
        for lo in range(0, len(i), max(1, COMPARED // step)):
            p = i[lo:lo + max(1, COMPARED // step)]
            x, y = p + lcp[p], before[p] + lcp[p]
            room = np.minimum(np.minimum(end[p] - x, end[p] - y), step)
            place = np.arange(int(room.max(initial=0)))
            same = words[np.minimum(x[:, None] + place, len(words) - 1)] == words[np.minimum(y[:, None] + place, len(words) - 1)]
            same &= place < room[:, None]
            more = np.logical_and.accumulate(same, axis=1).sum(axis=1)
            lcp[p] += more
            goes_on.append(p[(more == step)])
        i, step = np.concatenate(goes_on), min(2 * step, COMPARED)
    # Along a run of suffixes that follow the one before, the prefix loses one word each time.
    head = np.maximum.accumulate(np.where(follows, 0, at))
    return np.where(alone, 0, lcp[head] - (at - head))


def covered(repeat: np.ndarray, least: int, width: np.ndarray | int) -> np.ndarray:
    """Marks words in the union of [p, p + width) over places p whose repeat is ``least`` or longer."""
    n = len(repeat)
    at = np.flatnonzero(repeat >= least)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + (width if isinstance(width, int) else width[at]), -1)
    return np.cumsum(edge[:-1]) > 0


def measure(texts: list[str], min_words: int, max_covered: int, max_longest: int) -> pd.DataFrame:
    rows = len(texts)
    out = {c: np.zeros(rows, np.int64) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                 "n_repeat_words", "covered_words", "longest_repeat")}
    for lo, hi in spans_of_size([len(x) for x in texts], PIECE):
        numbers: dict[bytes, int] = {}
        words, sizes = [], []
        for i in range(lo, hi):
            text = texts[i]
            found = text.encode("utf-8", "replace").split()
            words += [numbers.setdefault(w, len(numbers)) for w in found]
            sizes.append(len(found))
            out["word_chars"][i] = len(text) - sum(map(text.count, _SPACE))
            out["n_symbols"][i] = sum(map(text.count, _SYMBOLS))
            if "\n" in text:
                lines = [x for x in text.split("\n") if x.strip(_SPACE)]
                out["n_dup_lines"][i] = len(lines) - len(set(lines))
        size = np.array(sizes, np.int64)
        out["n_words"][lo:hi] = size
        full = np.flatnonzero(size)
        if not len(full):
            continue
        begin = (np.cumsum(size) - size)[full]
        repeat = longest_repeats(np.array(words, np.int64), begin)
        for name, marks in (("n_repeat_words", covered(repeat, WINDOW, WINDOW)),
                            ("covered_words", covered(repeat, min_words, repeat))):
            out[name][lo + full] = np.add.reduceat(marks.astype(np.int64), begin)
        out["longest_repeat"][lo + full] = np.maximum.reduceat(repeat, begin)
    frame = pd.DataFrame(out)
    frame["base_failed"] = (frame.n_words < 20) | (100 * frame.n_repeat_words > 30 * frame.n_words)
    frame["kept"] = (~frame.base_failed & (100 * frame.covered_words <= max_covered * frame.n_words)
                     & (frame.longest_repeat <= max_longest))
    return frame[["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                  "covered_words", "longest_repeat", "kept"]]


def judge(docs: DataFrame, text_col: str = "text", out: str = "rules", min_words: int = 5,
          max_covered: int = 30, max_longest: int = 100) -> DataFrame:
    """All rows with the struct column ``out`` (see RESULT)."""

    @F.pandas_udf(RESULT)
    def rules(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for column in batches:
            yield measure(strings(column), min_words, max_covered, max_longest)

    return docs.withColumn(out, rules(F.col(text_col).cast("string")))
