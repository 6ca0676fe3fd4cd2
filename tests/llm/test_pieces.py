import random
import zlib

import numpy as np
import pytest
import sentencepiece

from ledgerflow.llm import piece_trie as pt

from . import cases

ODD = ["a  b", "  a", " a", "a ", "a\nb", "a\n b", "\n", "", "   ", "ＡＢＣ ﬁ", "a\tb", "é", "​foo", "日本🎉", "<s> hi</s>", "a\r\nb",
       "<0x0A>", "x▁y", "\x00a", " ﻿b", "▁", "▁▁a ▁", "\n\n\n", "  \n  x", "hello" * 50, "a" * 19, ".....,,,,;;;;====----", "   a    b     c"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pt.model_path())


def test_ids_and_texts_are_the_librarys(library):
    rng = random.Random(3)
    signs = "abcdefghijklmnopqrst  \n.,éñ日🎉ethion"
    texts = ODD + ["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(1500)]
    p = pt.Pieces(pt.model_path())
    ids, sizes = p.encode(texts)
    for text, mine in zip(texts, np.split(ids, np.cumsum(sizes)[:-1])):
        assert mine.tolist() == library.encode(text), text
        assert p.decode(mine.tolist()) == library.decode(mine.tolist())


def test_walk_uses_shared_prefixes_and_equals_merges():
    p = pt.Pieces(pt.model_path())
    words = sorted({"▁inter", "▁internal", "▁international", "▁internet", "▁into", "ing", "ings", "tion", "tional"})
    assert [[p.piece[i] for i in x] for x in p.walk(words)] == [p.merge(w) for w in words]


def test_supplied_documents_round_trip(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    coded = pt.encode(docs).select("doc_id", "text", "pieces.*")
    for r in pt.decode(coded).collect():
        assert list(r.ids) == library.encode(r.text) and r.decoded == r.text
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())


def test_forgetting_keeps_ids(library, spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    p = pt.Pieces(pt.model_path())
    p.words.kept = p.parts.kept = 300
    for a in range(0, 60, 15):
        assert p.encode(texts[a:a + 15])[0].tolist() == [i for x in texts[a:a + 15] for i in library.encode(x)]


def test_cases(spark, library):
    rows = pt.decode(pt.encode(cases.rows(spark)).select("doc_id", "text", "pieces.ids")).collect()
    assert len(rows) == len(cases.TEXTS) + 3
    for r in rows:
        assert r.ids is None if r.text is None else list(r.ids) == library.encode(r.text)
        assert r.decoded == r.text
    assert pt.encode(cases.empty(spark)).count() == 0
