"""Language identification of code-switched text by a linear-chain conditional random field.

A word is a run of letters of the lower-cased text.  Its features are hashed into tables of
weights: prefixes and suffixes of one to three letters, bigrams and trigrams with word ends, and
the whole word (the lexicon).  A matrix of learned transitions scores the change of language from
one word to the next.  Forward-backward gives each word's probability of each language; a text's
language is the one with the largest mean probability, weighted by letters, and that mean is its
score.

Training: a bounded sample of labelled rows (``docs_per_label`` rows of each language, of each a
span of ``span_chars`` characters at a hashed place) is cut into short runs of words that are
shuffled into mixed sequences, so that the transitions are learned from switches of language.

Defined results: text null, empty or without a letter: language ``und``, score 0.  A repeated row
gets the same result.  Languages of equal mean: the first in sorted order.  No labelled row: every
text is ``und``.  The result is one struct column, which replaces a column of its name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .textbatch import odd_numbers, spans_of_size, strings, worker_cache

UNKNOWN = "und"
RESULT = "lang_pred string, score double, n_words long, n_switches long"

HASH_BITS = 16           # buckets of each table of weights: 2 ** HASH_BITS
SEQUENCE = 64            # words of a training sequence
CHUNK = 64               # words of a chunk in forward-backward
PIECE = 1 << 19          # characters whose features are computed at a time
GROUP = 4096             # chunks of forward-backward at a time

_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xC2B2AE3D27D4EB4F)
_M3 = np.uint64(0x165667B19E3779F9)
_M4 = np.uint64(0xD6E8FEB86659FD93)
_ODD = odd_numbers(64)


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray      # (tables, 2 ** HASH_BITS, labels) float32
    transitions: np.ndarray  # (labels, labels) float32


TABLES = 4  # trigram, bigram, affix, lexicon


def _is_letter() -> np.ndarray:
    """Whether a code point is a letter, for all code points."""
    global _LETTER
    if _LETTER is None:
        flags = np.zeros(0x110000, bool)
        chars = np.arange(0x110000)
        for a, b in ((0, 0xD800), (0xE000, 0x110000)):
            flags[a:b] = [chr(c).isalpha() for c in chars[a:b].tolist()]
        _LETTER = flags
    return _LETTER


_LETTER: np.ndarray | None = None


def _bucket(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _M4
    return (h >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def word_features(text: str) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
    """Words of a lower-cased text as (start, length), and the features of each.

    A feature set is (table, place, bucket): ``place`` has the word's number for each bucket and
    doesn't fall.
    """
    raw = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    letter = _is_letter()[raw]
    flips = np.flatnonzero(np.diff(np.concatenate(([0], letter.view(np.int8), [0]))))
    start, stop = flips[0::2], flips[1::2]
    if not len(start):
        return start, start, []
    length = stop - start
    c = np.where(letter, raw, 0).astype(np.uint64)
    at = np.flatnonzero(letter)
    word = np.repeat(np.arange(len(start)), length)
    place = at - np.repeat(start, length)
    one = c[at]
    two = np.where(place >= 1, c[np.maximum(at - 1, 0)], 0)
    three = np.where(place >= 2, c[np.maximum(at - 2, 0)], 0)
    bi = (one * _M1) ^ (two * _M2)
    tri = bi ^ (three * _M3)
    # The affixes: up to three letters from each end, told apart by a salt.
    numbers = np.arange(len(start))
    affix, owner = [], []
    pre = np.zeros(len(start), np.uint64)
    post = np.zeros(len(start), np.uint64)
    for k in range(3):
        has = length > k
        salt = np.uint64(k + 1)
        pre = np.where(has, (pre + c[np.minimum(start + k, stop - 1)] + salt) * _M2, pre)
        post = np.where(has, (post + c[np.maximum(stop - 1 - k, start)] + salt) * _M3, post)
        affix += [pre, post ^ _M1]
        owner += [numbers, numbers]
    affix_h = np.stack(affix, axis=1).ravel()
    owner_h = np.stack(owner, axis=1).ravel()
    lexicon = np.add.reduceat(c[at] * _ODD[place & 63], np.cumsum(length) - length) + length.astype(np.uint64)
    return start, length, [
        (0, word, _bucket(tri)), (1, word, _bucket(bi)),
        (2, owner_h, _bucket(affix_h)), (3, numbers, _bucket(lexicon * _M2)),
    ]


def _scores(n_words: int, features, weights: np.ndarray) -> np.ndarray:
    out = np.zeros((n_words, weights.shape[2]), np.float32)
    for tab, place, bucket in features:
        first = np.flatnonzero(np.diff(place, prepend=-1))
        out += np.add.reduceat(weights[tab][bucket], first, axis=0)
    return out


def emissions(text: str, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and score of each label for the words of a lower-cased text, by pieces of bounded size."""
    starts, lengths, scores, at = [], [], [], 0
    while at < len(text):
        end = min(len(text), at + PIECE)
        while end < len(text) and end > at + PIECE // 2 and text[end - 1].isalpha():
            end -= 1
        s, n, feats = word_features(text[at:end])
        if len(s):
            starts.append(s + at)
            lengths.append(n)
            scores.append(_scores(len(s), feats, weights))
        at = end
    if not starts:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros((0, weights.shape[2]), np.float32)
    return np.concatenate(starts), np.concatenate(lengths), np.concatenate(scores)


def posteriors(scores: np.ndarray, begin: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Probabilities of each label for each word, by forward-backward along each sequence.

    ``begin``: the first word of each sequence (none is empty).  Sequences are cut into chunks; one
    pass multiplies each chunk's matrices, one carries messages along the chunks of a sequence, and
    one finishes all chunks side by side.  The result is that of one pass word by word.
    """
    n, k = scores.shape
    psi = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float32)
    move = np.exp(transitions - transitions.max()).astype(np.float32)
    sizes = np.diff(np.append(begin, n))
    chunks_of = -(-sizes // CHUNK)
    seq = np.repeat(np.arange(len(begin)), chunks_of)
    number = np.arange(len(seq)) - np.repeat(np.cumsum(chunks_of) - chunks_of, chunks_of)
    first = begin[seq] + number * CHUNK
    length = np.minimum(CHUNK, sizes[seq] - number * CHUNK)
    order = np.argsort(-length, kind="stable")
    uniform = np.full(k, 1 / k, np.float32)
    before = np.tile(uniform, (len(seq), 1))      # message into each chunk
    after = np.ones((len(seq), k), np.float32)    # message back into each chunk
    if chunks_of.max() > 1:
        whole = np.empty((len(seq), k, k), np.float32)
        for g in range(0, len(seq), GROUP):
            sel = order[g:g + GROUP]
            r = np.tile(np.eye(k, dtype=np.float32), (len(sel), 1, 1))
            left = length[sel]
            for t in range(int(left[0])):
                m = int(np.searchsorted(-left, -t, side="left"))
                x = (r[:m].reshape(-1, k) @ move).reshape(m, k, k) * psi[first[sel[:m]] + t][:, None, :]
                r[:m] = x / x.sum(axis=(1, 2), keepdims=True)
            whole[sel] = r
        # Chunk by chunk, all sequences at once.
        head = np.cumsum(chunks_of) - chunks_of
        longest = np.argsort(-chunks_of, kind="stable")
        left = chunks_of[longest]
        for i in range(int(left[0]) - 1):
            at = head[longest[:int(np.searchsorted(-left, -(i + 1), side="left"))]] + i
            x = np.einsum("ni,nij->nj", before[at], whole[at])
            before[at + 1] = x / x.sum(axis=1, keepdims=True)
        for i in range(int(left[0]) - 1, 0, -1):
            at = head[longest[:int(np.searchsorted(-left, -i, side="left"))]] + i
            x = np.einsum("nij,nj->ni", whole[at], after[at])
            after[at - 1] = x / x.sum(axis=1, keepdims=True)
    out = np.empty((n, k), np.float32)
    for g in range(0, len(seq), GROUP):
        sel = order[g:g + GROUP]
        left = length[sel]
        a = before[sel]
        top = int(left[0])
        live = [int(np.searchsorted(-left, -t, side="left")) for t in range(top)]
        alphas = np.empty((top, len(sel), k), np.float32)
        for t in range(top):
            m = live[t]
            x = (a[:m] @ move) * psi[first[sel[:m]] + t]
            a = x / x.sum(axis=1, keepdims=True)
            alphas[t, :m] = a
        b = after[sel].copy()
        for t in range(top - 1, -1, -1):
            m = live[t]
            at = first[sel[:m]] + t
            x = alphas[t, :m] * b[:m]
            out[at] = x / x.sum(axis=1, keepdims=True)
            x = (psi[at] * b[:m]) @ move.T
            b[:m] = x / x.sum(axis=1, keepdims=True)
    return out


def expected_pairs(scores: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Expected number of each (label, next label) over the training sequences (all but a last short one)."""
    k = scores.shape[1]
    psi = np.exp(scores - scores.max(axis=1, keepdims=True))
    psi = psi[:len(psi) // SEQUENCE * SEQUENCE].reshape(-1, SEQUENCE, k)
    move = np.exp(transitions - transitions.max())
    alpha = np.empty_like(psi)
    a = np.full((len(psi), k), 1 / k)
    for t in range(SEQUENCE):
        a = (a @ move) * psi[:, t]
        a /= a.sum(axis=1, keepdims=True)
        alpha[:, t] = a
    out = np.zeros((k, k))
    b = np.ones((len(psi), k))
    for t in range(SEQUENCE - 1, 0, -1):
        both = alpha[:, t - 1, :, None] * move * (psi[:, t] * b)[:, None, :]
        out += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        b = (psi[:, t] * b) @ move.T
        b /= b.sum(axis=1, keepdims=True)
    return out


def train(spans: list[tuple[str, str]], rounds: int = 60, seed: int = 1) -> Model:
    """Fit weights and transitions to (label, span) by gradient steps on the likelihood."""
    labels = sorted({lab for lab, _ in spans})
    k, size = len(labels), 1 << HASH_BITS
    empty = Model(labels, np.zeros((TABLES, size, max(k, 1)), np.float32), np.zeros((max(k, 1), max(k, 1)), np.float32))
    if not labels:
        return empty
    of = {lab: i for i, lab in enumerate(labels)}
    rng = np.random.default_rng(seed)
    # Runs of 4 to 32 words of one span, shuffled: neighbours differ in language.
    runs, parts, gold_of, n_words = [], [[] for _ in range(TABLES)], [], 0
    for lab, span in sorted(spans):
        start, _, feats = word_features(span.lower())
        for tab, place, bucket in feats:
            parts[tab].append((place + n_words, bucket))
        gold_of.append(np.full(len(start), of[lab]))
        at = 0
        while at < len(start):
            m = int(rng.integers(4, 33))
            runs.append(np.arange(n_words + at, n_words + min(at + m, len(start))))
            at += m
        n_words += len(start)
    if not runs:
        return empty
    rng.shuffle(runs)
    order = np.concatenate(runs)
    gold = np.concatenate(gold_of)[order]
    feats = [(tab, np.concatenate([p for p, _ in x]), np.concatenate([b for _, b in x])) for tab, x in enumerate(parts)]
    begin = np.arange(0, n_words, SEQUENCE)
    inside = np.arange(1, n_words // SEQUENCE * SEQUENCE)
    inside = inside[inside % SEQUENCE != 0]
    pair = np.zeros((k, k))
    np.add.at(pair, (gold[inside - 1], gold[inside]), 1)
    hot = np.eye(k, dtype=np.float32)[gold]
    w, tr = np.zeros((TABLES, size, k), np.float32), np.zeros((k, k), np.float32)
    square, square_t = np.full_like(w, 1e-6), np.full_like(tr, 1e-6)
    for _ in range(rounds):
        s = _scores(n_words, feats, w)[order]
        post = posteriors(s, begin, tr)
        back = np.empty_like(post)
        back[order] = post - hot
        for tab, place, bucket in feats:
            grad = np.stack([np.bincount(bucket, weights=back[place, j], minlength=size) for j in range(k)], axis=1)
            grad = (grad / len(begin) + 1e-4 * w[tab]).astype(np.float32)
            square[tab] += grad * grad
            w[tab] -= 0.15 * grad / np.sqrt(square[tab])
        grad_t = ((expected_pairs(s, tr) - pair) / len(begin) + 1e-3 * tr).astype(np.float32)
        square_t += grad_t * grad_t
        tr -= 0.05 * grad_t / np.sqrt(square_t)
    return Model(labels, w, tr)


def training_spans(docs: DataFrame, use: Column, id_col: str, text_col: str, lang_col: str,
                   docs_per_label: int, span_chars: int) -> list[tuple[str, str]]:
    """The bounded sample: of each label the rows of smallest hash, of each row one hashed span."""
    h = F.xxhash64(F.lit("crf"), F.col(id_col), F.col(text_col))
    room = F.greatest(F.length(text_col) - F.lit(span_chars), F.lit(0)) + 1
    picked = (docs.where(use & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
              .select(F.col(lang_col).alias("label"), h.alias("h"),
                      F.substring(F.col(text_col), (F.pmod(F.abs(h % 1000003), room) + 1).cast("int"),
                                  F.lit(span_chars)).alias("span"))
              .withColumn("salt", F.pmod("h", F.lit(64)))
              # Ranked within parts of a label first: no task gets a label's rows of all tasks.
              .withColumn("r", F.row_number().over(Window.partitionBy("label", "salt").orderBy("h", "span")))
              .where(F.col("r") <= docs_per_label)
              .withColumn("r", F.row_number().over(Window.partitionBy("label").orderBy("h", "span")))
              .where(F.col("r") <= docs_per_label).select("label", "span"))
    return [(r.label, r.span) for r in picked.collect()]


def fit(docs: DataFrame, use: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", docs_per_label: int = 300, span_chars: int = 600) -> Model:
    """Train on the sample; its bound is labels x docs_per_label x span_chars characters."""
    spans = training_spans(docs, F.lit(True) if use is None else use, id_col, text_col, lang_col,
                           docs_per_label, span_chars)
    return train(spans)


def label_texts(texts: list[str], model: Model) -> pd.DataFrame:
    """Language, score, words and switches of each text."""
    lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
    words, switches = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for a, b in spans_of_size([len(x) for x in texts], PIECE) if model.labels else ():
        lowered = [x.lower() for x in texts[a:b]]  # may be longer than the text
        joined = "\n".join(lowered)
        start, length, scores = emissions(joined, model.weights)
        if not len(start):
            continue
        ends = np.cumsum([len(x) + 1 for x in lowered])
        doc = np.searchsorted(ends, start, side="right")
        begin = np.flatnonzero(np.diff(doc, prepend=-1))
        post = posteriors(scores, begin, model.transitions)
        mass = np.add.reduceat(post * length[:, None].astype(np.float64), begin, axis=0)
        mean = mass / np.add.reduceat(length, begin)[:, None]
        best = post.argmax(axis=1)
        change = np.concatenate(([0], best[1:] != best[:-1])).astype(np.int64)
        change[begin] = 0
        who = a + doc[begin]
        top = mean.argmax(axis=1)
        score[who] = np.clip(mean[np.arange(len(top)), top], 0, 1)
        words[who] = np.diff(np.append(begin, len(doc)))
        switches[who] = np.add.reduceat(change, begin)
        for i, t in zip(who.tolist(), top.tolist()):
            lang[i] = model.labels[t]
    return pd.DataFrame({"lang_pred": lang, "score": score, "n_words": words, "n_switches": switches})


def identify(docs: DataFrame, model: Model, text_col: str = "text", out: str = "language") -> DataFrame:
    """All rows with the struct column ``out`` (see RESULT)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # labels x 2 ** 18 weights

    @F.pandas_udf(RESULT)
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        worker_cache("language")
        for column in batches:
            yield label_texts(strings(column), sent.value)

    return docs.withColumn(out, label(F.col(text_col).cast("string")))
