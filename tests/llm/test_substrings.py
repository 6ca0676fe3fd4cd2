"""Repeated windows of words: against all windows in a dictionary."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from ledgerflow.llm import substring_dedup as sd
from ledgerflow.llm import wordhash

from . import cases


def brute(rows, words):
    """rows of (id, text) in order; a result for each distinct one."""
    seen, out = set(), {}
    for key in rows:
        w = (key[1] or "").encode().split()
        gone = [False] * len(w)
        for s in range(len(w) - words + 1):
            window = tuple(w[s:s + words])
            if window in seen:
                gone[s:s + words] = [True] * words
            seen.add(window)
        kept = b" ".join(a for a, g in zip(w, gone) if not g)
        out[key] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest(), kept.decode())
    return out


def test_ladder():
    assert sd.ladder(20) == [5, 10, 20] and sd.ladder(50) == [7, 13, 25, 50] and sd.ladder(3) == [3]
    assert all(b <= 2 * a for n in range(1, 300) for a, b in zip(sd.ladder(n), sd.ladder(n)[1:]))


@pytest.mark.parametrize("words, vocabulary, seed", [(20, 300, 1), (6, 40, 2), (3, 12, 3), (11, 60, 4)])
def test_equals_brute_force(spark, words, vocabulary, seed):
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(vocabulary)}" + "é" * r.randrange(2)
    passages = [[word() for _ in range(words + r.randrange(30))] for _ in range(4)]
    rows = []
    for i in range(160):
        text = [word() for _ in range(r.randrange(60))]
        for _ in range(r.randrange(3)):
            at = r.randrange(len(text) + 1)
            text[at:at] = passages[min(r.randrange(6), 3)]
        rows.append((i, r.choice([" ", "\n", " \t"]).join(text)))
    rows += [(200 + i, rows[7][1]) for i in range(60)]                  # copies: hot anchors
    rows += [(300, " ".join(["same"] * (3 * words)))]                   # a text that repeats itself
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.dedup.n_words, r.dedup.n_removed, r.dedup.kept_sha256, r.dedup.kept) for r in sd.dedup(docs, words).collect()}
    want = brute(rows, words)
    assert got == {k[0]: v for k, v in want.items()}
    assert got[300][1] == 3 * words - 1 if words > 1 else True


def test_first_occurrence_stays(spark):
    text = " ".join(f"t{i}" for i in range(50))
    rows = [(9, text), (3, "before " + text), (5, text + " behind"), (3, "before " + text)]
    got = sorted((r.doc_id, r.dedup.n_removed, r.dedup.kept) for r in sd.dedup(
        spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(3, 0, "before " + text), (3, 0, "before " + text), (5, 50, "behind"), (9, 50, "")]


def test_nulls_and_shared_ids(spark):
    text = " ".join(f"t{i}" for i in range(30))
    rows = [(None, text), (4, "x " + text), (4, "y " + text), (None, None), (1, ""), (None, text)]
    got = [(r.doc_id, r.text, r.dedup.n_removed) for r in sd.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(n for i, t, n in got if i == 4) == [0, 30]             # one of the two texts of id 4 is the first
    assert [n for i, t, n in got if i is None and t] == [30, 30] and len(got) == 6


def test_cases(spark):
    docs = cases.rows(spark).withColumnRenamed("held", "dedup")
    rows = sd.dedup(docs).collect()
    assert len(rows) == len(cases.TEXTS) + 3 and "extra" in rows[0].asDict() and rows[0].dedup is not None
    by_text = {r.text: r.dedup for r in rows}
    assert by_text[None].n_words == by_text[""].n_words == 0 and by_text[""].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert by_text["x" * 5000].n_removed == 0 and by_text["The same line\n" * 30].n_words == 90
    want = brute([(0, cases.LONG)], sd.WORDS)[0, cases.LONG]
    assert (by_text[cases.LONG].n_removed, by_text[cases.LONG].kept_sha256) == want[1:3]
    assert sd.dedup(cases.empty(spark)).count() == 0


def test_hashes_of_long_words_tell_their_halves():
    a, b = "a" * 65536, "b" * 65536
    texts = [a + b, b + a, a + b, "x" * 32, "x" * 33, "x" * 32 + "\0"]
    data, bounds = wordhash.text_bytes(pa.array(texts))
    w = wordhash.cut(data, bounds, wordhash.WHITE)
    assert w.row.tolist() == list(range(6)) and w.hash[0] == w.hash[2] and len(np.unique(w.hash)) == 5
