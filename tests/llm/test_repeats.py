import random
import tracemalloc

import duckdb
import numpy as np

from ledgerflow.llm import registry, suffix_repeats as sr

from . import cases

SF = "/root/testdata/sf0.001"


def _brute(words):
    out = []
    for i in range(len(words)):
        best = 0
        for j in range(len(words)):
            n = 0
            while i != j and i + n < len(words) and j + n < len(words) and words[i + n] == words[j + n]:
                n += 1
            best = max(best, n)
        out.append(best)
    return out


def test_longest_repeats_equal_brute_force():
    rng = random.Random(1)
    for _ in range(150):
        docs = [[rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(rng.randrange(1, 30))] for _ in range(rng.randrange(1, 6))]
        begin = np.cumsum([0, *map(len, docs)])[:-1]
        assert sr.longest_repeats(np.array(sum(docs, [])), begin).tolist() == sum(map(_brute, docs), [])


def test_longest_repeats_of_regular_texts(monkeypatch):
    monkeypatch.setattr(sr, "COMPARED", 8)
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 200:
        fib.append(fib[-1] + fib[-2])
    for docs in ([[0, 1] * 100], [[7] * 150, [7] * 40], [fib[-1], fib[-2]], [list(range(60)) * 3, list(range(60))]):
        begin = np.cumsum([0, *map(len, docs)])[:-1]
        assert sr.longest_repeats(np.array(sum(docs, [])), begin).tolist() == sum(map(_brute, docs), [])


def test_memory_in_proportion_to_the_text():
    words = np.tile([0, 1], 200_000)
    tracemalloc.start()
    got = sr.longest_repeats(words, np.array([0]))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got[0] == len(words) - 2 and most < 170 * len(words)  # bytes a word, 8 of them the word itself


def test_rules():
    words = [f"w{i}" for i in range(100)]
    passage = " ".join(words[:40])
    r = sr.measure([" ".join(words), " ".join(words) + " " + passage, " ".join(words[:10]), "one two " * 60], 5, 30, 100)
    assert r.kept.tolist() == [True, False, False, False]
    assert r.covered_words.tolist()[:2] == [0, 80] and r.longest_repeat.tolist()[:2] == [0, 40]
    assert r.base_failed.tolist() == [False, True, True, True]
    r = sr.measure([" ".join(words) + " " + passage], 5, 60, 39)
    assert not r.kept[0]


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(registry.oracle_sql()["op10_suffix_repeats"]).fetchall()
    assert sorted(map(tuple, registry.op10_suffix_repeats(spark, SF).collect())) == sorted(want)


def test_cases(spark):
    rows = sr.judge(cases.rows(spark)).collect()
    assert len(rows) == len(cases.TEXTS) + 3
    for r in rows:
        text = r.text or ""
        assert r.rules.n_words == len([w for w in text.encode().split()])
        assert r.rules.word_chars == sum(c not in " \t\n\v\f\r" for c in text)
    lines = next(r.rules for r in rows if (r.text or "").startswith("The same line"))
    assert lines.n_dup_lines == 29 and lines.base_failed and not lines.kept
    assert sr.judge(cases.empty(spark)).count() == 0
