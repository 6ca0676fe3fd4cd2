"""Phrases of each language: against counters over all phrases."""

import os
import pickle
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerflow.llm import phrase_mining as pm
from ledgerflow.llm.keysets import BITS, KeySet

from . import cases

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows):
    f, n = {}, Counter()
    for lang, text in rows:
        c = f.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            c.update(tuple(w[i:i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    return f, n


def brute(rows, least, top):
    f, n = counted(rows)
    out = []
    for lang, c in f.items():
        candidates = {p: a for p, a in c.items() if a >= least and len(p) > 1}
        longer = Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i:i + k]] = max(longer[p[i:i + k]], a)
        scored = []
        for p, a in candidates.items():
            if 100 * longer[p] < 80 * a:
                score, _, l, r = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        for i, (score, a, p, l, r) in enumerate(sorted(scored)[:top]):
            out.append((lang, i + 1, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def random_rows(seed, n=400):
    r = random.Random(seed)
    words = ["Of", "the", "É", "time", "a" * 40, "b" * 300, "New", "York", "city", "x", "y,", "z.", "w\x1cv", "日本"]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = []
    for _ in range(n):
        text = r.choices(words, weights, k=r.randrange(40))
        if r.random() < 0.2:
            text += ["new", "york", "city", "hall"] * r.randrange(1, 4)
        rows.append((r.choice(["en", "fr", None, "en"]), r.choice([" ", "  ", " \t", "\n", "     "]).join(text)))
    return rows


@pytest.mark.parametrize("least, top, sample, seed", [(5, 2000, 16, 1), (3, 7, 2, 2), (30, 50, 1000, 3)])
def test_equals_brute_force(spark, least, top, sample, seed):
    """Also with a sample that proposes nothing: border failures then lead the passes."""
    rows = random_rows(seed)
    docs = spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], "doc_id long, lang string, text string").repartition(3)
    got = sorted(tuple(r) for r in pm.collocations(docs, least, top, sample).collect())
    assert got == brute(rows, least, top) and got


def test_all_frequent_phrases_are_counted(spark):
    rows = random_rows(5)
    docs = spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], "doc_id long, lang string, text string")
    got = {(r.lang, r.phrase): r.n for r in pm.frequent(docs, 4).where("k > 0").collect()}
    f, _ = counted(rows)
    assert got == {(g, " ".join(p)): a for g, c in f.items() for p, a in c.items() if a >= 4}


def test_phrases_of_one_hash_are_counted_apart(spark, monkeypatch):
    """Where hashes of different phrases are the same, the last pass still counts characters."""
    import pyarrow as pa
    batch = pa.record_batch([pa.array(["a b a b c"]), pa.array(["en"])], names=["text", "lang"])
    p = pm._Phrases(batch)
    k, starts, hashed = next(iter(p.levels(None)))
    rows = [r for b in pm._phrase_rows(p, k, starts, np.zeros_like(hashed)) for r in b.to_pylist()]
    total = Counter()
    for r in rows:
        total[r["phrase"]] += r["n"]
    assert total == {"a": 2, "b": 2, "c": 1}


def test_scores_beyond_64_bits(spark, monkeypatch):
    rows = [("en", 1, "a", 9 * 10**18), ("en", 1, "b", 3), ("en", 2, "a b", 8 * 10**18), ("en", 0, "", 5)]
    table = spark.createDataFrame(rows, "lang string, k int, phrase string, n long")
    monkeypatch.setattr(pm, "frequent", lambda *a: table)
    got = pm.collocations(table).collect()
    assert [(r.phrase, r.score) for r in got] == [("a b", 2000000 * 8 * 10**18 // (9 * 10**18 + 3))]


def test_cases(spark):
    docs = cases.rows(spark).withColumnRenamed("language", "lang")
    got = [tuple(r) for r in pm.collocations(docs, 2).collect()]
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert sorted(got) == brute(rows, 2, pm.TOP)
    assert pm.collocations(cases.empty(spark).withColumnRenamed("language", "lang")).count() == 0
    gap = [("en", "a" + " " * 100_000 + "b" + " " * 50 + "." + " " * 50 + "c")] * 3
    far = pm.collocations(spark.createDataFrame([(i, *x) for i, x in enumerate(gap)], "doc_id long, lang string, text string"), 2)
    assert [r.phrase for r in far.collect()] == ["a b"]


def test_key_sets_take_disk_by_what_they_hold(spark, monkeypatch):
    """Each broadcast leaves a file in the driver's folder and in that of each executor."""
    sizes, sent = [], spark.sparkContext.broadcast

    def broadcast(value):
        out = sent(value)
        sizes.append(os.path.getsize(out._path))
        return out

    monkeypatch.setattr(spark.sparkContext, "broadcast", broadcast)
    docs = spark.createDataFrame([(i, "en", "new york city is big . red wine") for i in range(60)], "doc_id long, lang string, text string")
    assert {r["phrase"] for r in pm.frequent(docs).where("k = 3").collect()} == {"new york city", "york city is", "city is big"}
    assert sizes and max(sizes) < 200_000      # 16 MB each, before


def test_key_sets_keep_all_keys(spark):
    keys = np.random.default_rng(5).integers(-(1 << 63), (1 << 63) - 1, 20_000)
    rows = [(int(k),) for k in keys]
    first = KeySet.of(spark, spark.createDataFrame(rows[:10_000], "k long"), "k")
    both = KeySet.of(spark, spark.createDataFrame(rows[10_000:], "k long"), "k", first)
    first.release()
    again = pickle.loads(pickle.dumps(both._bits.value)).words
    assert both.has(keys.view(np.uint64)).all() and (again == both._bits.value.words).all() and len(again) == 1 << (BITS - 3)
    assert not both.has(np.arange(100_000, dtype=np.uint64)).all()
