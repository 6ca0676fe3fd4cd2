import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import crf_language as crf

from . import cases

SF = "/root/testdata/sf0.01"


def _by_enumeration(scores, transitions):
    """Posteriors of one sequence by summing over all labellings, from a uniform state before it."""
    n, k = scores.shape
    out = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        first = np.log(np.exp(transitions)[:, path[0]].mean())
        w = np.exp(first + sum(scores[i, s] for i, s in enumerate(path))
                   + sum(transitions[a, b] for a, b in zip(path, path[1:])))
        for i, s in enumerate(path):
            out[i, s] += w
    return out / out.sum(axis=1, keepdims=True)


def test_posteriors_equal_enumeration():
    rng = np.random.default_rng(1)
    tr = rng.normal(size=(3, 3)).astype(np.float32)
    sizes = [1, 6, 2, 7]
    scores = rng.normal(size=(sum(sizes), 3)).astype(np.float32)
    begin = np.cumsum([0, *sizes[:-1]])
    got = crf.posteriors(scores, begin, tr)
    want = np.concatenate([_by_enumeration(scores[a:a + n], tr) for a, n in zip(begin, sizes)])
    assert np.allclose(got, want, atol=1e-5)


def test_chunks_equal_one_pass(monkeypatch):
    rng = np.random.default_rng(2)
    tr = rng.normal(size=(4, 4)).astype(np.float32)
    scores = rng.normal(size=(700, 4)).astype(np.float32)
    begin = np.array([0, 1, 65, 130, 400])
    cut = crf.posteriors(scores, begin, tr)
    monkeypatch.setattr(crf, "CHUNK", 10_000)
    assert np.allclose(cut, crf.posteriors(scores, begin, tr), atol=1e-4)


def test_expected_pairs_of_independent_words():
    scores = np.zeros((crf.SEQUENCE, 2), np.float32)
    got = crf.expected_pairs(scores, np.zeros((2, 2), np.float32))
    assert np.allclose(got, (crf.SEQUENCE - 1) / 4)


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return crf.fit(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)
    found = crf.identify(docs, model).select("lang", "language.lang_pred", "language.score").collect()
    assert len(found) > 200
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.98
    assert all(0 <= r.score <= 1 for r in found)


def test_code_switching_is_seen(model):
    docs = dict(crf_spans())
    mixed = docs["en"] + " " + docs["fr"]
    r = crf.label_texts([docs["en"], mixed], model)
    assert r.n_switches[1] >= 1 and r.score[1] < r.score[0]


def crf_spans():
    import pyarrow.parquet as pq
    t = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    return [(lang, next(d["text"] for d in t if d["lang"] == lang and 500 < len(d["text"]) < 900)) for lang in ("en", "fr")]


def test_cases(spark, model):
    rows = crf.identify(cases.rows(spark), model).collect()
    assert len(rows) == len(cases.TEXTS) + 3
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.language.lang_pred == "und") == (not letters)
        assert 0 <= r.language.score <= 1
    assert crf.identify(cases.empty(spark), model).count() == 0


def test_no_labels(spark):
    m = crf.fit(cases.rows(spark).withColumn("lang", F.lit(None).cast("string")))
    assert m.labels == []
    assert {r.language.lang_pred for r in crf.identify(cases.rows(spark), m).collect()} == {"und"}


def test_long_text_by_pieces_equals_whole(model, monkeypatch):
    text = cases.LONG[:60_000]
    whole = crf.label_texts([text], model)
    monkeypatch.setattr(crf, "PIECE", 1000)
    cut = crf.label_texts([text], model)
    assert whole.lang_pred[0] == cut.lang_pred[0] and abs(whole.score[0] - cut.score[0]) < 1e-3
    assert whole.n_words[0] == cut.n_words[0]


@pytest.mark.parametrize("text", ["a", "é", " b", "ab", "日"])
def test_very_short_texts(model, text):
    assert crf.label_texts([text], model).lang_pred[0] in model.labels


def test_letters_that_grow_in_lower_case(model, monkeypatch):
    texts = ["\u0130\u0130\u0130\u0130\u0130\u0130 a", "12 34", *[t for _, t in crf_spans()], "\u0130stanbul \u0130zmir \u0130" * 9, "--", "the end of it"]
    for piece in (crf.PIECE, 64):
        monkeypatch.setattr(crf, "PIECE", piece)
        together = crf.label_texts(texts, model)
        for i, text in enumerate(texts):
            alone = crf.label_texts([text], model).iloc[0]
            row = together.iloc[i]
            assert (row.lang_pred, row.n_words, row.n_switches) == (alone.lang_pred, alone.n_words, alone.n_switches)
            assert abs(row.score - alone.score) < 1e-4
    assert together.lang_pred[1] == together.lang_pred[5] == "und"
