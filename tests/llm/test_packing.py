import zlib

import numpy as np
import pytest

from ledgerflow.llm import bit_packing as bp
from ledgerflow.session import scratch_path

from . import cases

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("width", [1, 3, 8, 13, 16, 17, 24, 31, 32])
def test_round_trip_and_random_access(width):
    ids = np.random.default_rng(width).integers(0, 2 ** width, 70_001, dtype=np.uint64).astype(np.uint32)
    packed = bp.pack(ids, width)
    assert len(packed) == -(-len(ids) * width // 8)
    assert (bp.unpack(packed, width, 0, len(ids)) == ids).all()
    for start, n in ((0, 1), (12_345, 678), (70_000, 1), (5, 0)):
        assert (bp.unpack(packed, width, start, n) == ids[start:start + n]).all()


def test_least_width():
    assert [bp.width_of(n) for n in (1, 2, 3, 256, 257, 50_257)] == [1, 1, 2, 8, 9, 16]


ODD = ["", " ", "  ", "\n", " a\x1cb", "x<|endoftext|>y", "  two  spaces ", " \n x", " a\n\n b\n", "日本語 テスト", "don't I'LL 's",
       "12345 ١٢٣", "a b c᠎d", "tab\t b \t c", "a \r\n b", "x　 y \u0085z", "A.B\nC\n\nD\n", "a'b,c\"d", "\x00 \x00a"]


def test_ids_are_the_librarys():
    enc = bp.ByteEncoder(bp.tokenizer_path())
    for _ in range(2):
        ids, sizes = enc.encode(ODD)
        want = [enc.tokenizer.encode(x, add_special_tokens=False).ids for x in ODD]
        assert sizes.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


def test_forgetting_keeps_ids(monkeypatch):
    import pyarrow.parquet as pq
    texts = [x or "" for x in pq.read_table(f"{SF}/documents.parquet").column("text").to_pylist()][:80]
    enc = bp.ByteEncoder(bp.tokenizer_path())
    enc.store.kept = enc.parts.kept = 500
    for a in range(0, 80, 20):
        ids, _ = enc.encode(texts[a:a + 20])
        assert ids.tolist() == [i for x in texts[a:a + 20] for i in enc.tokenizer.encode(x, add_special_tokens=False).ids]


def test_what_a_worker_remembers_is_bounded_in_characters(monkeypatch):
    from ledgerflow.llm import idstore
    monkeypatch.setattr(idstore, "CHARS_KEPT", 20_000, raising=False)
    monkeypatch.setattr(idstore, "IDS_KEPT", 20_000, raising=False)
    enc, rng = bp.ByteEncoder(bp.tokenizer_path()), np.random.default_rng(3)
    for _ in range(40):
        texts = ["".join(rng.choice(list(letters), 2000)) for letters in ("日本語中文字漢検索", "abcdefghij")]  # one unit each
        texts.append("日 again")
        ids, _ = enc.encode(texts)
        assert ids.tolist() == [i for x in texts for i in enc.tokenizer.encode(x, add_special_tokens=False).ids]
        for store in (enc.store, enc.parts):
            assert sum(map(len, store.known)) <= 20_000 + 3000
            assert len(store.flat) <= 3 * (20_000 + 3000) + 100
        assert len(enc.hashed.flat) <= 20_000 + 3000
    assert " again" in enc.parts.known or "again" in enc.store.known


def _want(rows, key):
    enc = bp.ByteEncoder(bp.tokenizer_path())
    out, at = [], 0
    for r in sorted(rows, key=key):
        ids = enc.tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        out.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_files_hold_all_ids_in_order(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    monkeypatch.setattr(bp, "BLOCK_IDS", 1 << 12)
    path = scratch_path(spark, "test-packed")
    bp.write(docs, path)
    got = sorted(tuple(r) for r in bp.digests(spark, path).collect())
    want = _want(docs.collect(), lambda r: r.doc_id)
    assert got == want
    enc = bp.ByteEncoder(bp.tokenizer_path())
    every = [i for r in sorted(docs.collect(), key=lambda r: r.doc_id)
             for i in enc.tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]]
    for start, n in ((0, 10), (5000, 9000), (len(every) - 3, 3)):
        assert bp.read_ids(spark, path, start, n).tolist() == every[start:start + n]


def test_cases(spark):
    path = scratch_path(spark, "test-packed")
    bp.write(cases.rows(spark), path)
    rows = sorted((r.start, r.doc_id, r.n_tokens) for r in bp.digests(spark, path).collect())
    assert len(rows) == len(cases.TEXTS) + 3
    assert [r[0] for r in rows] == [0, *np.cumsum([r[2] for r in rows])[:-1].tolist()]
    ids = [r[1] for r in rows]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    path = scratch_path(spark, "test-packed")
    bp.write(cases.empty(spark), path)
    assert bp.digests(spark, path).count() == 0
