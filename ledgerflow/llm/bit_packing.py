"""Token ids in fixed-width packed blocks, with offsets for random access.

A text is encoded by the byte-level tokenizer, without special tokens; the end id follows.  Texts
are laid out in ascending order of their id (nulls first; equal ids by a hash of the text): the rows
are dealt into ranges of the id, and each range is written by one task as blocks.  A block holds
whole texts, at least ``BLOCK_IDS`` ids but for the last of a range, each id in as many bits as the
largest id of the vocabulary needs.  Files are Parquet, so they go to any store that Spark reaches:

    part, block        number of the range, and of the block in it
    first_id, n_ids    place of the block's first id in its range, and its ids
    width, packed      bits of an id, and the ids: id i lies at bit i * width, low bits first
    doc_ids, doc_sizes the texts of the block in order, and the ids of each

``offsets`` gives each range's place in the whole, from the table's narrow columns alone.

Defined results: null and empty texts have the end id alone.  A null id is kept and comes first.
Repeated rows are all written.  An empty table gives an empty file.  Other columns are left out.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .idstore import HashedStore, IdStore
from .textbatch import odd_numbers, ragged, spans_of_size, worker_cache
from .wordhash import whole_hash

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
BLOCK_IDS = 1 << 16
PIECE = 1 << 20          # characters of text at a time
BLOCKS = ("part int, block int, first_id long, n_ids long, width int, packed binary, "
          "doc_ids array<long>, doc_sizes array<long>")
DIGESTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def width_of(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids in ``width`` bits each (at most 32), low bits first."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    out = []
    for a in range(0, len(ids), BLOCK_IDS):  # a multiple of eight ids fills whole bytes
        bits = np.unpackbits(ids[a:a + BLOCK_IDS].astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
        out.append(np.packbits(bits[:, :width], bitorder="little").tobytes())
    return b"".join(out)


def unpack(packed: bytes, width: int, start: int, n: int) -> np.ndarray:
    """Ids start .. start + n, without reading those before."""
    first, last = start * width // 8, -(-(start + n) * width // 8)
    piece = packed[first:last] + b"\0" * 8
    words = np.ndarray((len(piece) - 7,), "<u8", piece, strides=(1,))  # eight bytes from each byte on
    bit = np.arange(start, start + n, dtype=np.int64) * width - first * 8
    return ((words[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)).astype(np.uint32)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


# Letters, signs without apostrophe, and single line ends: the tokenizer takes runs of the first two
# and a line end by itself, with the space before letters.
_LETTERS, _SIGNS = "A-Za-zÀ-ÖØ-öø-ÿ", r".,!?;:%#&$*|\"()=+@/<>\[\]{}-"
PART = re.compile(f" ?[{_LETTERS}]+|[{_SIGNS}]+|\n")
_ODD = [" " + c for c in " \t\n\v\f\r\x85\xa0"]
PLAIN = re.compile(f"(?: ?[{_LETTERS}]+|[{_SIGNS}]+|(?<!\n)\n(?!\n))+")


# Kinds of bytes in plain texts; apostrophes aren't, as the tokenizer cuts some letters off behind them.
_NONE, _LETTER, _DIGIT, _SIGN, _SPACE, _LINE, _END = range(7)
_KIND = np.full(256, _NONE, np.uint8)
_KIND[[*range(65, 91), *range(97, 123), 0xC3]] = _LETTER
_KIND[list(b"0123456789")] = _DIGIT
_KIND[list(b".,!?;:%#&$*|\"()=+@/<>[]{}-_~^`\\")] = _SIGN
_KIND[[32, 10, 0]] = _SPACE, _LINE, _END
_PLACES = odd_numbers(1 << 16)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def plain_parts(raw: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts joined, whether each is plain, and the parts of all: start, length and text's number.

    A plain text holds ASCII and Latin-1 letters, digits, signs, single spaces each before another
    kind, and single line ends.  Its parts are those that the tokenizer cuts: runs of letters, of digits
    or of signs, each with the space before it, and line ends.
    """
    joined = b"\0".join(raw) + b"\0"
    c = np.frombuffer(joined, np.uint8)
    kind = _KIND[c]
    lead = np.flatnonzero(c == 0xC3)
    follow = c[lead + 1]
    letter = (follow >= 0x80) & (follow <= 0xBF) & (follow != 0x97) & (follow != 0xB7)
    kind[lead[letter] + 1] = _LETTER
    kind[lead[~letter]] = _NONE
    ends = np.cumsum([len(x) + 1 for x in raw])
    after = np.append(kind[1:], _END)
    bad = kind == _NONE
    bad |= (kind == _SPACE) & ((after == _SPACE) | (after == _LINE) | (after == _END))
    bad |= (kind == _LINE) & (after == _LINE)
    inner = np.flatnonzero(kind == _END)
    bad[inner[~np.isin(inner, ends - 1)]] = True  # a zero byte of a text's own
    plain = np.ones(len(raw), bool)
    plain[np.searchsorted(ends, np.flatnonzero(bad), side="right")] = False
    first = np.flatnonzero(np.diff(kind, prepend=np.uint8(255)))
    length = np.diff(np.append(first, len(c)))
    run = kind[first]
    spaced = np.concatenate(([False], run[:-1] == _SPACE)) & (run != _LINE)
    keep = (run != _SPACE) & (run != _END)
    start, length = (first - spaced)[keep], (length + spaced)[keep]
    text = np.searchsorted(ends, start, side="right")
    keep = plain[text]
    return joined, plain, start[keep], length[keep], text[keep]


class ByteEncoder:
    """Ids as the library gives them, remembering what it has met.

    Plain texts are cut into parts in numpy.  In others the tokenizer cuts before each space that is
    followed by another character than white space, whatever surrounds it; those units are encoded one
    by one.  Texts that hold a special string or a control character that counts as white space in Python
    alone go to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        special = self.tokenizer.get_added_tokens_decoder()
        self.whole = ["\x1c", "\x1d", "\x1e", "\x1f", *(t.content for t in special.values())]
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.n_bytes = np.zeros(self.vocabulary, np.int64)  # a byte-level piece has a character for each byte
        for piece, i in self.tokenizer.get_vocab().items():
            self.n_bytes[i] = len(piece)
        self.odd = re.compile(r" (?=\s|$)")
        self.hashed = HashedStore(self._encode_parts)
        self.parts = IdStore(self._encode_parts)
        self.store = IdStore(self._encode_units)

    def _library(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)

    def _encode_row(self, row: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of strings that stay apart when they are encoded end to end, and how many each has."""
        got = self._library("".join(row))
        ends = np.cumsum([len(u.encode("utf-8")) for u in row])
        cut = np.searchsorted(np.cumsum(self.n_bytes[got]), ends, side="left") + 1
        return got, np.diff(cut, prepend=0)

    def _encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Parts that begin with a space stay apart in a row, others with a line end after each."""
        spaced = [i for i, u in enumerate(parts) if u[:1] == " "]
        plain = [i for i, u in enumerate(parts) if u[:1] != " " and u != "\n" and PLAIN.fullmatch(u)]
        alone = sorted(set(range(len(parts))).difference(spaced, plain))
        ids, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for a, b in spans_of_size([len(parts[i]) for i in spaced], 1 << 16):
            got, size = self._encode_row([parts[i] for i in spaced[a:b]])
            ids.append(got)
            sizes.append(size)
        for a, b in spans_of_size([len(parts[i]) + 1 for i in plain], 1 << 16):
            got, size = self._encode_row([x for i in plain[a:b] for x in (parts[i], "\n")])
            ids.append(got[ragged((np.cumsum(size) - size)[::2], size[::2])])
            sizes.append(size[::2])
        for i in alone:
            ids.append(self._library(parts[i]))
            sizes.append(np.array([len(ids[-1])], np.int64))
        size = np.concatenate(sizes)
        back = np.argsort(np.array(spaced + plain + alone, np.int64))
        start = np.cumsum(size) - size
        return np.concatenate(ids)[ragged(start[back], size[back])], size[back]

    def _encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Plain units are cut where the tokenizer cuts them; their parts recur more often."""
        texts = [u[1:] if u[:1] == " " else " " + u for u in units]
        return self.parts.ids_of([PART.findall(u) if PLAIN.fullmatch(u) else [u] for u in texts])

    def _units(self, text: str) -> list[str]:
        """A text's units: without the space in front, and the first, which has none, with one."""
        units = re.split(r" (?=\S)", text) if self._odd(text) else text.split(" ")
        units[0] = " " + units[0]
        return units

    def _odd(self, text: str) -> bool:
        """Whether white space or nothing follows a space."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.odd.search(text) is not None
        return text[-1:] == " " or any(map(text.__contains__, _ODD))

    def _whole(self, text: str) -> bool:
        return any(map(text.__contains__, self.whole))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each has."""
        if not texts:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        whole = np.array([self._whole(x) for x in texts])
        raw = [b"" if w else x.encode("utf-8", "replace") for w, x in zip(whole, texts)]
        joined, plain, start, length, owner = plain_parts(raw)
        ids, many = self._encode_plain(joined, start, length)
        sizes = np.bincount(owner, many, minlength=len(texts)).astype(np.int64)
        other = np.flatnonzero(~plain | whole)
        if not len(other):
            return ids, sizes
        units, sizes_of = self.store.ids_of([[] if whole[i] else self._units(texts[i]) for i in other])
        parts = np.split(ids, np.cumsum(sizes)[:-1])
        for i, got in zip(other, np.split(units, np.cumsum(sizes_of)[:-1])):
            parts[i] = self._library(texts[i]) if whole[i] else got
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)

    def _encode_plain(self, joined: bytes, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        at = ragged(start, length)
        begin = np.cumsum(length) - length
        place = np.arange(len(at)) - np.repeat(begin, length)
        h = np.add.reduceat(np.frombuffer(joined, np.uint8)[at].astype(np.uint64) * _PLACES[place & 0xFFFF], begin)
        h = (h ^ (h >> np.uint64(31))) * _MIX + length.astype(np.uint64)
        for i in np.flatnonzero(length > len(_PLACES)).tolist():
            h[i] = whole_hash(joined[start[i]:start[i] + length[i]])

        def texts(which: np.ndarray) -> list[str]:
            return [joined[a:b].decode("utf-8") for a, b in zip(start[which].tolist(), (start + length)[which].tolist())]

        return self.hashed.ids_of(h, texts)


def encoder(path: str) -> ByteEncoder:
    held = worker_cache("byte pieces")
    if path not in held:
        held[path] = ByteEncoder(path)
    return held[path]


_BLOCK_TYPE = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int64()),
                         ("width", pa.int32()), ("packed", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
                         ("doc_sizes", pa.list_(pa.int64()))])
_DIGEST_TYPE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def write(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
          tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Encode all rows and write them as packed blocks to ``path``."""
    tokenizer = tokenizer or tokenizer_path()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        width = width_of(enc.vocabulary)
        part, number, first = TaskContext.get().partitionId(), 0, 0
        ids, docs_in, sizes_in, held = [], [], [], 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{
                "part": part, "block": number, "first_id": first, "n_ids": held, "width": width,
                "packed": pack(np.concatenate(ids), width), "doc_ids": docs_in, "doc_sizes": sizes_in}], _BLOCK_TYPE)

        for batch in batches:
            keys = batch.column(0).to_pylist()
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for a, b in spans_of_size([len(x) for x in texts], PIECE):
                got, sizes = enc.encode(texts[a:b])
                at = 0
                for key, n in zip(keys[a:b], sizes.tolist()):
                    ids += [got[at:at + n], np.array([end_id], np.int32)]
                    at += n
                    docs_in.append(key)
                    sizes_in.append(n + 1)
                    held += n + 1
                    if held >= BLOCK_IDS:
                        yield block()
                        number, first = number + 1, first + held
                        ids, docs_in, sizes_in, held = [], [], [], 0
        if docs_in:
            yield block()

    text = F.col(text_col).cast("string")
    key = F.col(id_col).cast("long")
    # Ranges are cut by id, then by hash and row, so that one id with many rows can be split.
    (docs.select(key.alias("k"), text.alias("t"))
     .withColumn("h", F.xxhash64("t")).withColumn("r", F.monotonically_increasing_id())
     .repartitionByRange(F.col("k").asc_nulls_first(), "h", "r")
     .sortWithinPartitions(F.col("k").asc_nulls_first(), "h", "r")
     .select("k", "t").mapInArrow(blocks, BLOCKS).write.parquet(path))


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(path)


def offsets(blocks: DataFrame) -> DataFrame:
    """Each range's first place in the whole (part, offset); one row for each task that wrote."""
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))


def digests(spark: SparkSession, path: str) -> DataFrame:
    """What the files hold: for each text its place, size and the checksum of its ids."""
    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = {n: batch.column(i)[row].as_py() for i, n in enumerate(batch.schema.names)}
                sizes = np.array(one["doc_sizes"], np.int64)
                ids = unpack(one["packed"], one["width"], 0, one["n_ids"]).astype("<u4")
                view, ends = memoryview(ids).cast("B"), np.cumsum(sizes) * 4
                crc = [zlib.crc32(view[a:b]) for a, b in zip((ends - sizes * 4).tolist(), ends.tolist())]
                start = one["first_id"] + one["offset"] + np.cumsum(sizes) - sizes
                yield pa.RecordBatch.from_arrays([pa.array(one["doc_ids"], pa.int64()), pa.array(start, pa.int64()),
                                                  pa.array(sizes, pa.int64()), pa.array(crc, pa.int64())],
                                                 schema=_DIGEST_TYPE)

    blocks = read_blocks(spark, path)
    # One row for each task that wrote: small enough to send to all, however much they wrote.
    placed = blocks.join(F.broadcast(offsets(blocks)), "part")
    return placed.mapInArrow(unpacked, DIGESTS)


def read_ids(spark: SparkSession, path: str, start: int, n: int) -> np.ndarray:
    """Ids start .. start + n of the whole, from the blocks that hold them alone."""
    blocks = read_blocks(spark, path)
    at = F.col("first_id") + F.col("offset")
    rows = (blocks.join(F.broadcast(offsets(blocks)), "part")
            .where((at < start + n) & (at + F.col("n_ids") > start))
            .select(at.alias("at"), "n_ids", "width", "packed").orderBy("at").collect())
    parts = [unpack(bytes(r.packed), r.width, max(start - r.at, 0), min(r.n_ids, start + n - r.at) - max(start - r.at, 0))
             for r in rows]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)
