"""SentencePiece encoding and decoding: a forward pass over a trie of distinct marked words.

A text is marked as the model does (a mark for each space, one in front) and cut into marked words:
no piece holds a mark after another character, so words are encoded one by one.  A word is cut further
between characters that stand side by side in no piece.  The distinct parts that a worker hasn't met
yet are sorted and walked as a trie, depth first: a state for each prefix is kept on a stack, and a
part begins with the states of the prefix that it shares with the part before.

The given model is a merge (BPE) model.  A Viterbi pass that maximises the sum of scores gives other
pieces than such a model, so the forward state is the one that its merges define: a sequence of
pieces is the model's encoding exactly when each two neighbours are what the merges make of those two
alone.  Hence each prefix has one last piece: the piece that ends there and goes with the last piece
of the prefix before it.  That needs distinct scores; only runs of marks have equal ones, and words
that begin with more than one mark are merged step by step.

Characters without a piece become byte pieces.  Decoding joins pieces, turns marks into spaces, drops
the one in front, and reads byte pieces as UTF-8.

Defined results: null encodes to null, the empty text to no ids, no ids decode to the empty text.
A mark character in a text decodes to a space, as in the model.  Control pieces decode to nothing.
Byte pieces that aren't UTF-8 decode to replacement characters.  Columns of the result's name are
replaced; other columns pass through.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .idstore import UNITS_KEPT, HashedStore, IdStore
from .textbatch import odd_numbers, ragged, spans_of_size, strings, worker_cache
from .wordhash import whole_hash

MODEL = "piece_bpe_32k.model"
MARK = "▁"
PAIRS_KEPT = 200_000     # pairs of pieces whose verdict a worker remembers
PIECE = 1 << 19          # characters of text at a time
_PLACES = odd_numbers(1 << 16)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def model_path(name: str = MODEL) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Pieces:
    """The vocabulary of a merge model, and both directions."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.piece = [model.id_to_piece(i) for i in range(n)]
        self.unknown = model.unk_id()
        self.byte = {int(self.piece[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.id = {self.piece[i]: i for i in plain}
        self.score = {self.piece[i]: model.get_score(i) for i in plain}
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("a piece holds a mark after another character: words can't be encoded one by one")
        ranked = [s for p, s in self.score.items() if len(p) > 1 and p.strip(MARK)]
        if len(set(ranked)) < len(ranked):
            raise ValueError("pieces of equal score: a prefix may have more than one last piece")
        self.pairs: dict[int, bool] = {}
        # Pieces that the merges make; others never occur.
        self.made = {p: i for p, i in self.id.items() if len(p) == 1 or self.merge(p) == [p]}
        if not {c for p in self.id if len(p) > 1 for c in p} <= self.id.keys():
            raise ValueError("a piece holds a character that is no piece")
        # The longest piece that ends with two given characters.
        self.reach: dict[str, int] = {}
        for p in self.made:
            self.reach[p[-2:]] = max(self.reach.get(p[-2:], 1), len(p))
        # Characters side by side in some piece; merges never cross between others.
        self.beside = {p[i:i + 2] for p in self.id for i in range(len(p) - 1)}
        self.bytes_of = [p.replace(MARK, " ").encode("utf-8") for p in self.piece]
        for value, i in self.byte.items():
            self.bytes_of[i] = bytes([value])
        for i in range(n):
            if model.is_control(i):
                self.bytes_of[i] = b""
        self.bytes_of[self.unknown] = " ⁇ ".encode()
        self.parts = IdStore(self.encode_parts, kept=UNITS_KEPT // 4)
        self.words = IdStore(self.encode_words, kept=UNITS_KEPT // 4)
        self.plain = HashedStore(self.encode_words)
        # Between which ASCII characters a word can be cut before anything else is known of it.
        self.apart = np.zeros((256, 256), bool)
        for a in range(33, 127):
            for b in range(33, 127):
                self.apart[a, b] = chr(a) + chr(b) not in self.beside
        self.lines = not any("\n" in p for p in self.id)

    def merge(self, word: str) -> list[str]:
        """The model's merges, step by step: the best-scored pair of neighbours first, leftmost of equals."""
        parts, score = list(word), self.score.get
        pairs = [score(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best, at = None, -1
            for i, s in enumerate(pairs):
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = score(parts[at - 1] + parts[at])
            if at < len(pairs):
                pairs[at] = score(parts[at] + parts[at + 1])

    def goes(self, key: int, left: str, right: str) -> bool:
        """Whether the merges leave these two pieces side by side."""
        if len(self.pairs) > PAIRS_KEPT:
            self.pairs.clear()
        verdict = self.pairs[key] = self.merge(left + right) == [left, right]
        return verdict

    def walk(self, parts: list[str]) -> Iterator[list[int]]:
        """The ids of each of the sorted parts; states of shared prefixes are used again.

        Each character of a part of two or more is a piece, as no other character stands beside one.
        """
        last: list[int] = [-1]      # last[i]: the last piece of the prefix of i characters
        size: list[int] = [0]       # its length
        before = ""
        ids, reach, pairs, piece_of = self.made, self.reach, self.pairs, self.piece
        for part in parts:
            shared = 0
            for a, b in zip(before, part):
                if a != b:
                    break
                shared += 1
            del last[shared + 1:], size[shared + 1:]
            for end in range(shared + 1, len(part) + 1):
                # From the longest piece that ends here to the single character.
                start = max(0, end - reach.get(part[max(end - 2, 0):end], 1))
                while True:
                    i = ids.get(part[start:end])
                    if i is not None:
                        left = last[start]
                        if left < 0:
                            break
                        key = left << 20 | i
                        verdict = pairs.get(key)
                        if verdict or (verdict is None and self.goes(key, piece_of[left], piece_of[i])):
                            break
                    start += 1
                last.append(i)
                size.append(end - start)
            before = part
            out, end = [], len(part)
            while end:
                out.append(last[end])
                end -= size[end]
            yield out[::-1]

    def ids(self, pieces: list[str]) -> list[int]:
        out: list[int] = []
        for p in pieces:
            i = self.id.get(p)
            if i is not None:
                out.append(i)
            elif self.byte:
                out += [self.byte[b] for b in p.encode("utf-8", "replace")]
            else:
                out.append(self.unknown)
        return out

    def encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Parts of one character by the vocabulary, with more than one mark by merges, others by the walk."""
        walked = sorted(p for p in parts if len(p) > 1 and not p.startswith(MARK * 2))
        found = dict(zip(walked, self.walk(walked)))
        each = [found[p] if p in found else self.ids(self.merge(p)) for p in parts]
        return np.array([i for x in each for i in x], np.int32), np.array([len(x) for x in each], np.int64)

    def cut(self, word: str) -> list[str]:
        """A word's parts: cut between characters that stand side by side in no piece."""
        beside, out, at = self.beside, [], 0
        for i in range(1, len(word)):
            if word[i - 1:i + 1] not in beside:
                out.append(word[at:i])
                at = i
        out.append(word[at:])
        return out

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.parts.ids_of([self.cut(w) for w in words])

    def split(self, text: str) -> list[str]:
        """Marked words of a text."""
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        if MARK * 2 in marked or marked[-1] == MARK:
            return re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", marked)
        return [MARK + x for x in marked[1:].split(MARK)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each has."""
        if not texts:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        raw = [x.encode("utf-8", "replace") if self.lines and MARK not in x and "\0" not in x else b" " for x in texts]
        joined, simple, start, length, marked, owner = self._plain_words(raw)
        ids, many = self._encode_plain(joined, start, length, marked)
        sizes = np.bincount(owner, many, minlength=len(texts)).astype(np.int64)
        other = np.flatnonzero(~simple)
        if not len(other):
            return ids, sizes
        got, sizes_of = self.words.ids_of([self.split(texts[i]) for i in other])
        parts = np.split(ids, np.cumsum(sizes)[:-1])
        for i, x in zip(other, np.split(got, np.cumsum(sizes_of)[:-1])):
            parts[i] = x
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)

    def _plain_words(self, raw: list[bytes]):
        """Texts joined, whether each is simple, and the words of those: start, length, mark, text's number.

        A simple text has single spaces, none at its ends or beside a line end, and no line end first.
        Its words are cut at spaces, line ends and between ASCII characters that no piece holds side by side.
        """
        joined = b"\0".join(raw) + b"\0"
        c = np.frombuffer(joined, np.uint8)
        before = np.concatenate(([np.uint8(0)], c[:-1]))
        after = np.append(c[1:], np.uint8(0))
        ends = np.cumsum([len(x) + 1 for x in raw])
        bad = (c == 32) & ((after == 32) | (after == 10) | (after == 0) | (before == 0) | (before == 10))
        bad |= (c == 10) & (before == 0)
        simple = np.ones(len(raw), bool)
        simple[np.searchsorted(ends, np.flatnonzero(bad), side="right")] = False
        gap = (c == 32) | (c == 0)
        begins = ~gap & ((before == 32) | (before == 0) | (before == 10) | (c == 10) | self.apart[before, c])
        start = np.flatnonzero(begins)
        stop = np.minimum(np.append(start[1:], len(c)), len(c))
        # A word ends before a gap.
        gaps = np.flatnonzero(gap)
        stop = np.minimum(stop, gaps[np.minimum(np.searchsorted(gaps, start), len(gaps) - 1)])
        text = np.searchsorted(ends, start, side="right")
        keep = simple[text]
        start, stop, text = start[keep], stop[keep], text[keep]
        return joined, simple, start, stop - start, (before[start] == 32) | (before[start] == 0), text

    def _encode_plain(self, joined: bytes, start: np.ndarray, length: np.ndarray, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        at = ragged(start, length)
        begin = np.cumsum(length) - length
        place = np.arange(len(at)) - np.repeat(begin, length)
        h = np.add.reduceat(np.frombuffer(joined, np.uint8)[at].astype(np.uint64) * _PLACES[place & 0xFFFF], begin)
        h = (h ^ (h >> np.uint64(31))) * _MIX + (2 * length + marked).astype(np.uint64)
        for i in np.flatnonzero(length > len(_PLACES)).tolist():
            h[i] = whole_hash(joined[start[i]:start[i] + length[i]]) + np.uint64(marked[i])

        def texts(which: np.ndarray) -> list[str]:
            return [(MARK if m else "") + joined[a:b].decode("utf-8")
                    for a, b, m in zip(start[which].tolist(), (start + length)[which].tolist(), marked[which].tolist())]

        return self.plain.ids_of(h, texts)

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


def pieces(path: str) -> Pieces:
    held = worker_cache("pieces")
    if path not in held:
        held[path] = Pieces(path)
    return held[path]


def encode(docs: DataFrame, text_col: str = "text", out: str = "pieces", model: str | None = None) -> DataFrame:
    """All rows with the struct column ``out``: ids, the checksum of them as 32-bit integers, and
    whether they decode to the text (made in the same pass)."""
    path = model or model_path()

    @F.pandas_udf("ids array<int>, ids_crc32 long, round_trip boolean")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        p = pieces(path)
        for column in batches:
            texts = strings(column)
            # Results leave by pieces, so that ids of few texts are held at a time.
            for a, b in spans_of_size([len(x) for x in texts], PIECE):
                flat, sizes = p.encode(texts[a:b])
                ids = np.split(flat, np.cumsum(sizes)[:-1])
                yield pd.DataFrame({"ids": ids, "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in ids],
                                    "round_trip": [p.decode(x.tolist()) == t for x, t in zip(ids, texts[a:b])]})

    text = F.col(text_col).cast("string")
    # A null text has null fields; the column itself is never null.
    fields = ("ids", "ids_crc32", "round_trip")
    return docs.withColumn(out, encoded(text)).withColumn(
        out, F.struct(*[F.when(text.isNotNull(), F.col(f"{out}.{f}")).alias(f) for f in fields]))


def decode(rows: DataFrame, ids_col: str = "ids", out: str = "decoded", model: str | None = None) -> DataFrame:
    """All rows with the string column ``out``, made of the array column ``ids_col``."""
    path = model or model_path()

    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in batches:
            yield pd.Series([None if x is None else pieces(path).decode(x.tolist()) for x in column.tolist()], dtype=object)

    return rows.withColumn(out, decoded(F.col(ids_col)))
