import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerflow.llm import digest_cache as dc

from . import cases

ODD = ["", " a\x1cb", "x<|endoftext|>y", "ΟΔΟΣ ὈΔΥΣΣΕΎΣ", "İstanbul", "á ́b", "日本語 テスト", "🎉🎉 don't I'LL", "12345 ١٢٣", "a b c᠎d", "‍",
       "ÀÉ.ß-x'S", "á é", "[x](y) {z}"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(dc.tokenizer_path())
    return lambda x: len(t.encode(x or "", add_special_tokens=False).ids)


def test_counts_are_the_librarys(library, spark):
    texts = ODD + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(100).collect()]
    c = dc.Counter(dc.tokenizer_path())
    c.words.kept = c.parts.kept = 400
    for _ in range(2):
        assert c.count(texts).tolist() == [library(x) for x in texts]


def test_cache_gets_each_content_once(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    cache = dc.open_cache(spark)
    held = lambda: spark.read.parquet(cache.path).count()
    contents = docs.select(dc.content_digest(docs.text).alias("d")).distinct().count()
    dc.count_tokens(docs.where("doc_id < 50"), cache)
    some = held()
    assert 0 < some < contents
    rows = dc.count_tokens(docs, cache).collect()
    assert held() == contents
    dc.count_tokens(docs, cache)
    assert held() == contents
    assert all(r.n_tokens == library(r.text) and r.n_bytes == len(r.text.encode()) for r in rows) and len(rows) == docs.count()
    assert dc.open_cache(spark, cache.path).read(spark, "another version").count() == 0


def test_shuffled_way(spark, library, monkeypatch):
    from ledgerflow.llm import textbatch
    monkeypatch.setattr(textbatch, "FEW_ROWS", 0)
    rows = dc.count_tokens(cases.rows(spark), dc.open_cache(spark)).collect()
    assert len(rows) == len(cases.TEXTS) + 3 and all(r.n_tokens == library(r.text) for r in rows)


def test_cases(spark, library):
    rows = dc.count_tokens(cases.rows(spark), dc.open_cache(spark)).collect()
    assert len(rows) == len(cases.TEXTS) + 3
    assert all(r.n_tokens == library(r.text) and r.n_bytes == len((r.text or "").encode()) for r in rows)
    assert dc.count_tokens(cases.empty(spark), dc.open_cache(spark)).count() == 0


def test_registered_query_finds_what_an_earlier_run_stored(spark, library, tmp_dir, monkeypatch):
    """Through the setting: the second run encodes nothing, and gives the same counts."""
    from ledgerflow.llm import registry
    sf, path = "/root/testdata/sf0.001", f"{tmp_dir}/token-counts"
    spark.conf.set(registry.CACHE_SETTING, path)
    try:
        first = sorted(map(tuple, registry.op9_digest_cache(spark, sf).collect()))
        held = spark.read.parquet(path).count()
        second = sorted(map(tuple, registry.op9_digest_cache(spark, sf).collect()))
        assert second == first and held > 0 and spark.read.parquet(path).count() == held
        # What the counts are joined to is the cache: a stored count that is changed shows.
        rows = spark.read.parquet(path).withColumn("n_tokens", F.lit(5000).cast("long"))
        changed = f"{tmp_dir}/changed"
        rows.write.parquet(changed)
        spark.conf.set(registry.CACHE_SETTING, changed)
        assert {r.n_tokens for r in registry.op9_digest_cache(spark, sf).collect()} == {5000}
    finally:
        spark.conf.unset(registry.CACHE_SETTING)
