import re

import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline as cp
from ledgerflow.llm import crf_language, feistel_pii, piece_trie
from ledgerflow.llm.registry import PII_KEY
from ledgerflow.llm.textbatch import strings

from . import cases
from .test_join import _brute

SF = "/root/testdata/sf0.001"


def _shingles(text):
    w = re.findall(r"[^\W_]+", text.lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def test_run_equals_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.orderBy("doc_id").toPandas()
    found = crf_language.label_texts(strings(rows.text), crf_language.fit(docs))
    rows = rows[(found.lang_pred != "und") & (found.score >= cp.MIN_SCORE)]
    group = {i: c for i, _, c in _brute(list(zip(rows.doc_id.tolist(), rows.text.tolist())))}
    rows = rows[[group[i] == i for i in rows.doc_id]]
    items = [_shingles(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = rows[[not any(len(s & _shingles(t)) >= 0.75 * len(s) for s in items) for t in rows.text]]
    masker, library = feistel_pii.Masker(PII_KEY), sentencepiece.SentencePieceProcessor(model_file=piece_trie.model_path())
    want = {i: library.encode(masker.mask(t)[0]) for i, t in zip(rows.doc_id.tolist(), rows.text.tolist())}
    got = cp.run(spark, SF).collect()
    assert {r.doc_id: list(r.ids) for r in got} == want and len(got) == len(want)
    assert all(r.round_trip and r.n_pieces == len(r.ids) for r in got)
    assert len(want) < docs.count()


def test_stage_names_and_columns(spark):
    assert [n for n, _ in cp.STAGES] == ["language_id", "ngram_jaccard", "decontaminate", "pii", "sentencepiece"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("extra", F.lit(1))
    for _, stage in cp.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


@pytest.fixture(scope="module")
def edge(spark):
    return (cases.rows(spark).withColumn("lang", F.lit("en")).withColumn("source", F.lit(None).cast("string"))
            .withColumn("n_chars", F.length("text").cast("long")))


def test_near_copies_of_shared_and_missing_ids(spark):
    a = " ".join(f"a{i}" for i in range(60))
    b = " ".join(f"b{i}" for i in range(60))
    rows = [(1, a), (2, a), (2, b), (None, a + " more"), (None, "c d e f g h"), (None, "c d e f g h"), (2, b), (7, b + " end"), (9, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for _ in range(2):
        kept = sorted((r.doc_id or -1, r.text) for r in cp.ngram_jaccard(spark, docs.repartition(3), SF).collect())
        assert kept == [(-1, "c d e f g h"), (1, a), (2, b), (9, "")]


def test_cases(spark, edge):
    out = cp.language_id(spark, edge, SF)
    assert all(any(c.isalpha() for c in r.text) for r in out.collect()) and out.count() > 0
    kept = cp.ngram_jaccard(spark, edge, SF).collect()
    pairs = [(r.doc_id, r.text) for r in kept]
    assert len(pairs) == len(set(pairs))
    assert sum(r.text == "One two three." for r in kept) == 1
    assert cp.decontaminate(spark, edge, SF).count() == edge.count()
    assert cp.pii(spark, edge, SF).count() == edge.count()
    assert cp.sentencepiece(spark, edge, SF).count() == edge.count()
    none = edge.limit(0)
    assert all(stage(spark, none, SF).count() == 0 for _, stage in cp.STAGES)
