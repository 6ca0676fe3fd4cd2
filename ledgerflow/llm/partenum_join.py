"""Jaccard join of word shingles by PartEnum signatures, and the components of its links.

A document's set holds the distinct shingles of five words (ASCII letters in lower case); a shorter
text is one shingle.  Sets link when 100 * intersection >= 75 * union, that is when they differ in at
most (s + t) / 7 shingles, for sizes s and t.

Signatures.  Sizes fall into bands [2^b, 2^(b+1)); a set takes part in its own band and, where a
partner can be smaller than that, in the one below.  Within a band the domain of shingles is cut by
hash into parts (0.6 * 2^b of them in the band of 64 down to 0.4 * 2^b from 512 on), and each part into
three cells.  A part's signatures are what a set holds of two of its cells, for each of the three
choices of two.  A part with one differing cell keeps one signature, and with k differing shingles in
all some part has at most one.  Counted over all parts (``kept``), sets that differ in k shingles share
at least 3 * parts - 2 * k signatures, or 2 * parts - k where k is larger than the parts.  So each set
gives all its signatures but as many less one, those last in an order that depends on a signature's
content alone (without common shingles first, then larger ones, then by hash; empty ones at the end):
the first that both sets hold is among those that both give.  Which shingles are common is taken from a
bounded sample; it only orders.  A set gives empty signatures, which unlike sets share, only with a
probability estimated below 1e-10 (over 6.5 standard deviations in every band, by a normal approximation).
In bands under 64, where such parts would be mostly empty, each shingle is a part and a cell of its own:
k + 1 of them, in the same order.

Candidates.  Rows (signature, id) are dealt and sorted by signature; a pass over each part pairs the
members of small groups, and those of larger groups with the group's first member.  A set's sketch
(how many shingles fall into each hashed class) rules out pairs whose counts alone differ by more than
a link allows; the others are verified on whole sets.  Larger groups that still hold more than one
component give the next members as further first ones, round by round, until each pair across
components has been seen.  So no link between components is lost, and groups of near copies cost one
pair for each member.

Equal texts are one class throughout, represented by its smallest id.

Defined results: null and empty texts, and texts without words, have no shingles and link with
nothing, also not with each other: the component is the own id.  A row without id takes the component
of its text's class; where no row of that text has an id it is not in the join (n_shingles 0, component
null).  An id stands for one text: rows that share an id but not the text need keys of their own first,
as the pipeline gives them.  Other columns pass through; n_shingles and component_id are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .components import components, stored
from .keysets import copied, dealt, hot_keys
from .textbatch import odd_numbers, spans_of_size, worker_cache
from .wordhash import whole_hash

SHINGLE = 5              # words
SMALL_BAND = 64          # below, each shingle is a part of its own
CELLS = 3                # second-level cells of a part; signatures leave out one
PARTS = {6: 38, 7: 58, 8: 108}  # first-level parts, by band; two fifths of 2^band above
SMALL_GROUP = 4          # members of a signature's group that are all paired at once
LEADERS = 256            # members of a larger group outside its main component, in each later round
SAMPLE = 20_000          # documents of the sample that tells common shingles
COMMON_LEAST = 4         # documents of the sample from which on a shingle is common
COMMON_MOST = 1_000_000  # common shingles that are told at most (the order of others is by size)
MOST_CLASSES = 4096      # counters of a sketch
AT_ONCE = 512            # members compared with the first ones of their group at a time
BROADCAST_IDS = 500_000  # ids sent to all executors at most (8 MB); more are joined by shuffle
PIECE = 1 << 18          # characters of text at a time

_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_ODD = odd_numbers(SHINGLE)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


_PLACES = odd_numbers(1 << 16)
_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint64)


def _word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of UTF-8 bytes, ASCII letters in lower case."""
    inside = ~_SPACE[raw]
    flips = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    start, length = flips[0::2], flips[1::2] - flips[0::2]
    if not len(start):
        return np.zeros(0, np.uint64), start
    at = np.flatnonzero(inside)
    place = at - np.repeat(start, length)
    h = np.add.reduceat(_LOWER[raw[at]] * _PLACES[place & 0xFFFF], np.cumsum(length) - length)
    h = mix(h + length.astype(np.uint64))
    for i in np.flatnonzero(length > len(_PLACES)).tolist():
        h[i] = whole_hash(_LOWER[raw[start[i]:start[i] + length[i]]].astype(np.uint8).tobytes())
    return h, start


def shingle_sets(texts: list[str]) -> Iterator[np.ndarray]:
    """For each text its distinct shingles as sorted 64-bit hashes."""
    worker_cache("shingles")  # nothing is held: drops what other tasks did
    for a, b in spans_of_size([len(x) for x in texts], PIECE):
        raw = [x.encode("utf-8", "replace") for x in texts[a:b]]
        h, start = _word_hashes(np.frombuffer(b"\n".join(raw), np.uint8))
        many = np.diff(np.searchsorted(start, np.cumsum([0] + [len(x) + 1 for x in raw])))
        runs = np.full(max(0, len(h) - SHINGLE + 1), SHINGLE, np.uint64)
        for j in range(SHINGLE):
            runs += h[j:j + len(runs)] * _ODD[j]
        runs = mix(runs)
        at = 0
        for n in many.tolist():
            if n >= SHINGLE:
                yield np.unique(runs[at:at + n - SHINGLE + 1])
            elif n:
                yield mix(np.array([n], np.uint64) + (h[at:at + n] * _ODD[:n]).sum(dtype=np.uint64))
            else:
                yield h[:0]
            at += n


def signatures(items: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The signatures of a set (sorted hashes); ``common``: sorted hashes of common shingles."""
    s = len(items)
    if not s:
        return np.zeros(0, np.uint64)
    band = s.bit_length() - 1
    low = 1 << band
    out = [_band_signatures(items, band, (s + 4 * s // 3) // 7, common)]
    if 4 * (low - 1) >= 3 * s:
        out.append(_band_signatures(items, band - 1, (s + low - 1) // 7, common))
    return np.concatenate(out)


def kept(parts: int, differ: int) -> int:
    """How many of its signatures, the first ones, a set gives to meet all sets with ``differ`` other shingles.

    One differing cell of a part takes two of its three signatures, a second one the third.
    """
    shared = CELLS * parts - 2 * differ if differ <= parts else 2 * parts - differ
    return CELLS * parts - shared + 1


def _band_signatures(items: np.ndarray, band: int, differ: int, common: np.ndarray) -> np.ndarray:
    rare = np.ones(len(items), bool)
    if len(common):
        at = np.minimum(np.searchsorted(common, items), len(common) - 1)
        rare = common[at] != items
    salt = (np.array([band + 1], np.uint64) * _ODD[0])[0]
    content = mix(items ^ salt)
    if 1 << band < SMALL_BAND:
        return content[np.lexsort((content, ~rare))[:differ + 1]]
    parts = PARTS.get(band, 2 * (1 << band) // 5)
    cell = (mix(items + salt) % np.uint64(CELLS * parts)).astype(np.int64)
    held = np.zeros(CELLS * parts, np.uint64)
    np.add.at(held, cell, content)
    size, rare = (_others(np.bincount(c, minlength=CELLS * parts)) for c in (cell, cell[rare]))
    content = mix(_others(held) + np.arange(1, CELLS * parts + 1, dtype=np.uint64) * _ODD[1] + salt)
    rank = ((rare == 0).astype(np.uint64) << np.uint64(63)) | ((127 - np.minimum(size, 127)).astype(np.uint64) << np.uint64(56))
    rank |= content >> np.uint64(8)
    most = kept(parts, differ)
    return content[np.argpartition(rank, most - 1)[:most]]


def _others(cells: np.ndarray) -> np.ndarray:
    """For each cell the sum of its part's other cells."""
    whole = cells.reshape(-1, CELLS)
    return (whole.sum(axis=1, dtype=cells.dtype, keepdims=True) - whole).ravel()


def _texts(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def common_shingles(docs: DataFrame, rows: int) -> np.ndarray:
    """Sorted hashes of shingles in COMMON_LEAST documents of a hashed sample of about SAMPLE."""
    share = max(1, rows // SAMPLE)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = _texts(batch.column(0))
            for a, b in spans_of_size([len(x) for x in text], PIECE):
                found = np.concatenate(list(shingle_sets(text[a:b])))
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["h"])

    sample = docs.where(F.pmod(F.xxhash64("id", F.lit("common")), F.lit(share)) == 0).select("text")
    top = (sample.mapInArrow(hashes, "h long").groupBy("h").count().where(F.col("count") >= COMMON_LEAST)
           .orderBy(F.desc("count"), "h").limit(COMMON_MOST).select("h").toArrow())
    return np.sort(top.column("h").to_numpy().view(np.uint64))


def sketch(items: np.ndarray) -> bytes:
    """How many shingles fall into each of a number of hashed classes, up to 255; more classes for larger sets."""
    if not len(items):
        return b""
    classes = min(MOST_CLASSES, max(16, 1 << max(0, len(items).bit_length() - 1)))
    counts = np.bincount((items >> np.uint64(8)).astype(np.int64) & (classes - 1), minlength=classes)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def may_link(x: bytes, y: bytes, size_x: int, size_y: int) -> bool:
    """False only where the counts alone differ by more than linked sets can."""
    one, two = [np.frombuffer(x, np.uint8)], [np.frombuffer(y, np.uint8)]
    return bool(_may_link(one, np.array([size_x]), two, np.array([size_y]))[0, 0])


def _folded(sketches: list[np.ndarray], classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Sketches (of one length) with fewer classes, and which of them can't be: a count that stopped
    can't be added up."""
    m = np.stack(sketches).astype(np.int16)
    full = (m == 255).any(axis=1)
    if m.shape[1] > classes:
        m = np.minimum(m.reshape(len(m), -1, classes).sum(axis=1), 255).astype(np.int16)
    return m, full


def _may_link(xs: list[np.ndarray], size_x: np.ndarray, ys: list[np.ndarray], size_y: np.ndarray) -> np.ndarray:
    """For each x and y whether their sketches don't rule out a link."""
    out = np.ones((len(xs), len(ys)), bool)
    len_x, len_y = np.array([len(x) for x in xs]), np.array([len(y) for y in ys])
    for a in np.unique(len_x):
        for b in np.unique(len_y):
            i, j = np.flatnonzero(len_x == a), np.flatnonzero(len_y == b)
            p, p_full = _folded([xs[k] for k in i], min(a, b))
            q, q_full = _folded([ys[k] for k in j], min(a, b))
            apart = np.stack([np.abs(q - row).sum(axis=1, dtype=np.int64) for row in p])
            ok = 7 * apart <= size_x[i][:, None] + size_y[j][None, :]
            out[np.ix_(i, j)] = ok | ((p_full[:, None] | q_full[None, :]) & (a != b))
    return out


# kind 0: an id, its size and sketch; 1: a pair of a small group; 2: a larger group's first member and another.
_FOUND = pa.schema([("kind", pa.int32()), ("sig", pa.int64()), ("a", pa.int64()), ("b", pa.int64()),
                    ("size_a", pa.int32()), ("size_b", pa.int32()), ("sketch", pa.binary())])
FOUND = "kind int, sig long, a long, b long, size_a int, size_b int, sketch binary"


def _signature_rows(texts: DataFrame, common: np.ndarray) -> DataFrame:
    sent = texts.sparkSession.sparkContext.broadcast(common)  # at most COMMON_MOST hashes

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, text = batch.column(0).to_numpy(zero_copy_only=False), _texts(batch.column(1))
            for a, b in spans_of_size([len(x) for x in text], PIECE):
                sigs, owner, sizes, sketches = [], [], [], []
                for i, items in zip(range(a, b), shingle_sets(text[a:b])):
                    # One more row tells the size; it travels by a hash of the id.
                    got = np.append(signatures(items, sent.value), mix(ids[i:i + 1].astype(np.int64).view(np.uint64)))
                    sigs.append(got)
                    owner.append(np.full(len(got), ids[i], np.int64))
                    size = np.full(len(got), len(items), np.int32)
                    size[-1] = -1 - size[-1]
                    sizes.append(size)
                    sketches += [None] * (len(got) - 1) + [sketch(items)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)),
                                                  pa.array(np.concatenate(owner)), pa.array(np.concatenate(sizes)),
                                                  pa.array(sketches, pa.binary())], ["sig", "id", "size", "sketch"])

    return texts.select("id", "text").mapInArrow(rows, "sig long, id long, size int, sketch binary")


def _pair_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates of rows (sig, id, size) sorted by sig and id; keeps one group's start between batches."""
    held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)]
    open_large = False       # the held row is the first member of a larger group that goes on

    def found(kind: int, sig, a, b, size_a, size_b, sketches=None) -> pa.RecordBatch:
        sketches = pa.nulls(len(a), pa.binary()) if sketches is None else sketches
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)),
                                           *map(pa.array, (sig, a, b, size_a, size_b)), sketches], schema=_FOUND)

    def pairs(sig, ids, size, large_first: bool) -> Iterator[pa.RecordBatch]:
        new = np.concatenate(([True], sig[1:] != sig[:-1]))
        first = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        many = np.diff(np.append(first, len(sig)))
        large = many > SMALL_GROUP
        large[0] |= large_first
        for d in range(1, min(SMALL_GROUP, len(sig))):
            i = np.flatnonzero((group[:-d] == group[d:]) & ~large[group[:-d]])
            if len(i):
                yield found(1, sig[i], ids[i], ids[i + d], size[i], size[i + d])
        i = np.flatnonzero(large[group] & ~new)
        if len(i):
            j = first[group[i]]
            yield found(2, sig[i], ids[j], ids[i], size[j], size[i])

    for batch in batches:
        sig, ids, size = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        told = size < 0
        if told.any():
            zero = np.zeros(int(told.sum()), np.int64)
            yield found(0, zero, ids[told], zero, -1 - size[told], zero.astype(np.int32), batch.column(3).filter(pa.array(told)))
            sig, ids, size = sig[~told], ids[~told], size[~told]
        sig, ids, size = (np.concatenate(x) for x in zip(held, (sig, ids, size)))
        if not len(sig):
            continue
        again = np.zeros(len(sig), bool)
        again[1:] = (sig[1:] == sig[:-1]) & (ids[1:] == ids[:-1])
        sig, ids, size = sig[~again], ids[~again], size[~again]
        tail = int(np.searchsorted(sig, sig[-1], side="left"))  # sorted, so the last group starts here
        if tail:
            yield from pairs(sig[:tail], ids[:tail], size[:tail], open_large)
            open_large = False
        if len(sig) - tail > SMALL_GROUP or open_large:
            yield from pairs(sig[tail:], ids[tail:], size[tail:], True)
            # Only the first member stays; a repeated last id is a repeated pair, which does no harm.
            open_large, keep = True, [tail]
        else:
            keep = list(range(tail, len(sig)))
        held = [x[keep] for x in (sig, ids, size)]
    if len(held[0]) and not open_large:
        yield from pairs(*held, False)


def _only(rows: DataFrame, ids: DataFrame, how: str, on: list[str]) -> DataFrame:
    """Semi or anti join; the ids go to all executors where a count shows that they are few."""
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, on, how)


def _near(a: str = "size_a", b: str = "size_b") -> Column:
    return (4 * F.least(a, b).cast("long") >= 3 * F.greatest(a, b).cast("long"))


def verified(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of ids whose whole sets link; the pairs are stored ones."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = _texts(batch.column(1))
            for a, b in spans_of_size([len(x) for x in text], PIECE):
                sets = [x.tobytes() for x in shingle_sets(text[a:b])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(sets, pa.binary())], ["id", "items"])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(p) > len(q):
                    p, q = q, p
                both = int((q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p).sum()) if len(p) else 0
                keep.append(both > 0 and 100 * both >= 75 * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sets = stored(_only(texts.select("id", "text"), ids, "left_semi", ["id"]).mapInArrow(packed, "id long, items binary"), "sets")
    one = sets.select(F.col("id").alias("a"), F.col("items").alias("items_a"))
    two = sets.select(F.col("id").alias("b"), F.col("items").alias("items_b"))
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "items_a", "items_b")
    return joined.mapInArrow(linked, "a long, b long")


def plausible(pairs: DataFrame, told: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sketches don't rule out a link."""
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size_a, size_b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            keep = [may_link(x.as_py(), y.as_py(), m, n) for x, y, m, n in zip(batch.column(4), batch.column(5), size_a, size_b)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one, two = (told.select(F.col("a").alias(c), F.col("size_a").alias(f"n{c}"), F.col("sketch").alias(f"s{c}")) for c in "ab")
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "sa", "sb")
    return stored(joined.mapInArrow(kept, "a long, b long"), "plausible")


def _against(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The plausible partners of each group's first rows (lead 0) among its other members (lead 1), of
    rows sorted by group and lead: (id, packed ids).  Keeps one group's first rows."""
    current, ids, sizes, comps, sketches = None, [], [], [], []
    for batch in batches:
        sig, lead, who, size, comp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        drawn = [np.frombuffer(x, np.uint8) for x in batch.column(5).to_pylist()]
        at = 0
        while at < len(sig):
            if sig[at] != current:
                current, ids, sizes, comps, sketches = sig[at], [], [], [], []
            end = at + int(np.searchsorted(sig[at:], current, side="right"))
            first = at + int(np.searchsorted(lead[at:end], 1))
            ids += who[at:first].tolist()
            sizes += size[at:first].tolist()
            comps += comp[at:first].tolist()
            sketches += drawn[at:first]
            for lo in range(first, end, AT_ONCE) if ids else ():
                part = slice(lo, min(lo + AT_ONCE, end))
                n, m = np.array(sizes, np.int64), size[part].astype(np.int64)
                ok = _may_link(sketches, n, drawn[part], m)
                ok &= (np.array(comps)[:, None] != comp[part][None, :])
                ok &= 4 * np.minimum(n[:, None], m[None, :]) >= 3 * np.maximum(n[:, None], m[None, :])
                some = np.flatnonzero(ok.any(axis=1))
                if len(some):
                    partners = [who[part][ok[i]].astype(np.int64).tobytes() for i in some]
                    yield pa.RecordBatch.from_arrays([pa.array(np.array(ids, np.int64)[some]), pa.array(partners, pa.binary())],
                                                     ["id", "partners"])
            at = end


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct pairs (a, b) of rows (id, packed ids) sorted by id; keeps one id's partners."""
    current, held = None, []

    def pairs() -> pa.RecordBatch:
        y = np.unique(np.concatenate(held))
        x = np.full(len(y), current, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

    for batch in batches:
        for x, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if x != current and held:
                yield pairs()
                held = []
            current = x
            held.append(np.frombuffer(packed, np.int64))
    if held:
        yield pairs()


def link(texts: DataFrame, found: DataFrame) -> DataFrame:
    """Components of all links, from what the signatures found."""
    told = found.where("kind = 0").dropDuplicates(["a"])
    first = found.where(F.col("kind") > 0).where(_near()).select("a", "b").distinct()
    links = stored(verified(texts, plausible(first, told)), "links")
    labels = components(links)
    # Members of larger groups, their first ones done.
    drawn = told.select(F.col("a").alias("id"), "sketch")
    members = found.where(F.col("kind") == 2).select("sig", F.col("b").alias("id"), F.col("size_b").alias("size"))
    while True:
        placed = members.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
        mixed = placed.groupBy("sig").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("sig")
        members = stored(placed.join(mixed, "sig", "left_semi"), "members")
        if not members.take(1):
            return labels
        # Members outside the group's main component are compared with all of other components; one that
        # has been is done with this group, and a group of one component is.
        main = (members.groupBy("sig", "component").agg(F.count("*").alias("n"))
                .groupBy("sig").agg(F.max_by("component", F.struct("n", "component")).alias("main")))
        rank = F.row_number().over(Window.partitionBy("sig").orderBy("id"))
        lead = stored(members.join(main, "sig").where("component <> main").withColumn("r", rank).where(F.col("r") <= LEADERS)
                      .select("sig", "id", "size", "component"), "leaders")
        # A hot group's members are dealt over tasks, and its few leaders go to each of those.
        hot = stored(hot_keys(members.groupBy("sig").agg(F.count("*").alias("n")), ["sig"], "n"), "hot")
        rows = (dealt(members, ["sig"], hot, ["id"]).select("sig", "__salt", "id", "size", "component", F.lit(1).alias("lead"))
                .unionByName(copied(lead, ["sig"], hot).withColumn("lead", F.lit(0))).join(drawn, "id")
                .select(F.xxhash64("sig", "__salt").alias("group"), "lead", "id", "size", "component", "sketch"))
        partners = (rows.repartition("group").sortWithinPartitions("group", "lead", "id")
                    .mapInArrow(_against, "id long, partners binary"))
        pairs = (partners.repartition("id").sortWithinPartitions("id")
                 .mapInArrow(_merged, "a long, b long").distinct())
        new = stored(verified(texts, stored(pairs, "plausible")), "links")
        if new.take(1):
            links = links.union(new)
            labels = components(links)
        members = members.select("sig", "id", "size").join(lead.select("sig", "id"), ["sig", "id"], "left_anti")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows with n_shingles and component_id."""
    docs = docs.drop("n_shingles", "component_id")
    key, text = F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    digest = F.unhex(F.sha2(text, 256))
    rows = stored(docs.select(key.alias("id"), digest.alias("digest")), "digests")
    classes = stored(rows.groupBy("digest").agg(F.min("id").alias("class"), F.count("*").alias("n")), "classes")
    total, several = classes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).first()
    whole = docs.select(key.alias("id"), digest.alias("digest"), text.alias("text"))
    if several <= BROADCAST_IDS:
        # Few rows repeat a text: all executors know them.
        repeated = (rows.join(classes.where("n > 1"), "digest").where("id is null or id <> class").select("digest", "id").distinct())
        texts = whole.join(F.broadcast(repeated), (whole.digest == repeated.digest) & whole.id.eqNullSafe(repeated.id),
                           "left_anti").where("id is not null").select("id", "text")
    else:
        texts = (whole.groupBy("digest").agg(F.min("id").alias("id"), F.first("text").alias("text"))
                 .where("id is not null").select("id", "text"))
    common = common_shingles(texts, total)
    sorted_rows = _signature_rows(texts, common).repartition("sig").sortWithinPartitions("sig", "id")
    found = stored(sorted_rows.mapInArrow(_pair_up, FOUND), "found")
    labels = link(texts, found)
    sizes = found.where("kind = 0").groupBy("a").agg(F.max("size_a").cast("long").alias("n_shingles")).withColumnRenamed("a", "id")
    done = stored(classes.select("digest", F.col("class").alias("id")).join(sizes, "id", "left").join(labels, "id", "left")
                  .select(F.col("digest").alias("__digest"), F.col("id").alias("__class"), "n_shingles",
                          F.coalesce("component", "id").alias("component_id")), "result")
    out = docs.withColumn("__digest", digest).join(done, "__digest", "left")
    empty = F.coalesce(F.col("n_shingles"), F.lit(0)) == 0
    return (out.withColumn("component_id", F.when(empty, key).otherwise(F.col("component_id")))
            .withColumn("n_shingles", F.coalesce("n_shingles", F.lit(0))).drop("__digest", "__class"))
