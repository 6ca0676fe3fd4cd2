"""Words longer than the tables of multipliers: those that swap halves stay apart."""

import sentencepiece
from tokenizers import Tokenizer

from ledgerflow.llm import bit_packing, bm25_decontam, partenum_join, piece_trie

SWAPPED = ["a" * 65536 + "b" * 65536, "b" * 65536 + "a" * 65536]


def test_byte_pieces():
    library = Tokenizer.from_file(bit_packing.tokenizer_path())
    ids, sizes = bit_packing.ByteEncoder(bit_packing.tokenizer_path()).encode(SWAPPED)
    assert ids.tolist() == [i for x in SWAPPED for i in library.encode(x, add_special_tokens=False).ids] and len(sizes) == 2


def test_pieces():
    library = sentencepiece.SentencePieceProcessor(model_file=piece_trie.model_path())
    held = piece_trie.Pieces(piece_trie.model_path())
    ids, sizes = held.encode(SWAPPED)
    ids = ids.tolist()
    parts = [ids[:sizes[0]], ids[sizes[0]:]]
    assert parts == [library.encode(x) for x in SWAPPED]
    assert [held.decode(x) for x in parts] == SWAPPED


def test_shingles(spark):
    a, b = partenum_join.shingle_sets(SWAPPED)
    assert a.tolist() != b.tolist()
    docs = spark.createDataFrame(list(enumerate(SWAPPED)), "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in partenum_join.join(docs).collect()} == {(0, 0), (1, 1)}


def test_words_of_items():
    a, b = (bm25_decontam.word_hashes(x)[0] for x in ("a" * 256 + "b" * 256, "b" * 256 + "a" * 256))
    assert len(a) == len(b) == 1 and a[0] != b[0]
