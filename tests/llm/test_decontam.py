import collections
import math
import re

import numpy as np
import pytest

from ledgerflow.llm import bm25_decontam as dec

from . import cases

SF = "/root/testdata/sf0.001"


def _words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def _brute(texts, items, least):
    """All (text, item) whose best passage scores ``least`` or more, word by word."""
    listed = {i: _words(t) for i, t in items if _words(t)}
    df = collections.Counter(w for x in listed.values() for w in set(x))
    n, mean = len(listed), np.mean([len(x) for x in listed.values()])
    weight = {}
    for i, x in listed.items():
        tf = collections.Counter(x)
        w = {t: math.log1p((n - df[t] + .5) / (df[t] + .5)) * f * 2.2 / (f + 1.2 * (.25 + .75 * len(x) / mean)) for t, f in tf.items()}
        weight[i] = {t: v / sum(w.values()) for t, v in w.items()}
    longest = max(map(len, listed.values()))
    found = set()
    for d, text in enumerate(texts):
        w = _words(text)
        for a in range(0, max(1, len(w) - longest) if len(w) > longest else 1, longest):
            passage = set(w[a:a + 2 * longest])
            found |= {(d, i) for i in listed if sum(v for t, v in weight[i].items() if t in passage) >= least}
    return found


def _index(items):
    rows = [(i, t, None, None) for i, t in items]
    hashes = [dec.word_hashes(t)[0] for _, t in items]
    hashes = [h for h in hashes if len(h)]
    df = collections.Counter(w for h in hashes for w in set(h.tolist()))
    return dec.build(rows, df, len(hashes), float(np.mean([len(h) for h in hashes])))


def _tables():
    import pyarrow.parquet as pq
    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    items = [(r["item_id"], r["text"]) for r in pq.read_table("/root/testdata/sf0.01/benchmark.parquet").to_pylist()]
    return [d["text"] for d in docs], items


@pytest.mark.parametrize("least", [0.35, 0.5])
def test_retrieval_equals_brute_force(least):
    texts, items = _tables()
    texts = texts[:120] + [items[3][1] + " " + items[5][1], "x " + items[7][1][:80]]
    found = dec.matches(texts, _index(items), least, 0.0, 0.0)
    got = {(d, m["item_id"]) for d, ms in enumerate(found) for m in ms}
    assert got == _brute(texts, items, least)


def test_postings_of_closed_blocks_are_skipped(monkeypatch):
    """Items of words of their own, many blocks of them: a passage with one item reads few postings, and finds it."""
    items = [(i, " ".join(f"w{i}x{j} common{j}" for j in range(12))) for i in range(600)]
    monkeypatch.setattr(dec, "BLOCK", 8)
    index, read = _index(items), []
    postings_of = dec.Index.postings_of

    def counted(self, *args):
        got = postings_of(self, *args)
        read.append(len(got[1]))
        return got
    monkeypatch.setattr(dec.Index, "postings_of", counted)
    texts = [items[77][1], " ".join(f"common{j}" for j in range(12)), "nothing of it"]
    found = dec.matches(texts, index, 0.5, 0.0, 0.0)
    assert [[m["item_id"] for m in f] for f in found] == [[77], [], []]
    whole = sum(int(index.items.many[np.searchsorted(index.words, h)].sum()) for h in (dec.word_hashes(texts[0])[0],))
    assert 0 < sum(read) < whole / 20
    assert (np.repeat(np.arange(len(index.run_many)), index.run_many) == np.repeat(
        np.arange(len(index.run_many)), np.diff(np.append(index.run_first, len(index.items.place))))).all()


def test_verification():
    texts, items = _tables()
    item = items[9][1]
    words = item.split()
    held = dec.matches([item.upper(), " ".join(words[:len(words) // 2]), "more. " * 200 + item + " more." * 300, texts[0]],
                       _index(items), 0.5, 0.75, 0.5)
    assert [bool(x) for x in held[:3]] == [True, False, True]
    assert held[0][0]["item_id"] == items[9][0] and held[0][0]["score"] > 0.99


def test_question_and_answer_parts():
    index = dec.build([(1, "What is the capital of the far northern island? It is the town of Vik", None, None)],
                      {}, 1, 15.0)
    text = "we ask what is the capital of the far northern island it is the town of vik and so on"
    assert dec.matches([text], index, 0.5, 0.75, 0.5)[0]
    assert not dec.matches([text.replace("it is the town of vik", "nobody knows")], index, 0.3, 0.75, 0.5)[0]


def test_query_equals_shingle_containment(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    def shingles(t):
        w = _words(t)
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    want = {(d.doc_id, i.item_id) for d in docs.collect() for i in items.collect()
            if len(shingles(i.text) & shingles(d.text)) >= 0.75 * len(shingles(i.text))}
    def got():
        return {(r.doc_id, m.item_id) for r in dec.find(docs, items).collect() for m in r.held}
    assert got() == want
    monkeypatch.setattr(dec, "ITEMS", 7)  # several parts of the index
    assert got() == want


def test_cases(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven"), (1, "one two three four five six seven"),
                                   (None, "a"), (2, None), (3, "")], "item_id long, text string")
    rows = dec.find(cases.rows(spark), items).collect()
    assert len(rows) == len(cases.TEXTS) + 3
    assert all(r.held == [] for r in rows if not r.text)
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r.held == [] for r in dec.find(cases.rows(spark), none).collect())
    assert dec.find(cases.empty(spark), items).count() == 0
