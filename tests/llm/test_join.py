import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import components, partenum_join as pj

from . import cases

SF = "/root/testdata/sf0.001"


def _shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def _brute(rows):
    """(id, shingles, component) of rows (id, text) without null or repeated ids."""
    sets = {i: _shingles(t) for i, t in rows}
    top = {i: i for i in sets}
    def find(i):
        while top[i] != i:
            i = top[i]
        return i
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return {(i, len(s), find(i)) for i, s in sets.items()}


def _family(rng, n_words, copies, edits):
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(n_words)]
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
        out.append(" ".join(w).upper() if rng.random() < 0.3 else " \n ".join(w))
    return out


def _texts(seed):
    rng = random.Random(seed)
    texts = [t for n, c, e in ((30, 25, 3), (120, 30, 7), (260, 6, 16), (5, 5, 1), (4, 4, 1), (700, 4, 40)) for t in _family(rng, n, c, e)]
    # A chain: each links with the next alone.  A passage that many others share.
    chain = [f"c{i}" for i in range(160)]
    texts += [" ".join(chain[i * 8:i * 8 + 100]) for i in range(7)]
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [" ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(40)) + " " + passage for _ in range(40)]
    texts += texts[:10] + ["", "  ", "\t", "same", "same", "Same"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed,small,leaders", [(1, pj.SMALL_GROUP, pj.LEADERS), (2, 2, 1), (3, 3, 4)])
def test_equals_brute_force(spark, monkeypatch, seed, small, leaders):
    monkeypatch.setattr(pj, "SMALL_GROUP", small)
    monkeypatch.setattr(pj, "LEADERS", leaders)
    rows = _texts(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in pj.join(docs).collect()}
    assert got == _brute(rows)


def test_supplied_documents_equal_brute_force(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = _brute([(r.doc_id, r.text) for r in docs.collect()])
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in pj.join(docs).collect()} == want
    monkeypatch.setattr(pj, "BROADCAST_IDS", 0)  # the shuffled way
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in pj.join(docs).collect()} == want


def test_linked_sets_share_a_signature():
    rng, met = np.random.default_rng(5), 0
    for _ in range(600):
        s = int(rng.choice([1, 2, 3, 5, 8, 20, 63, 64, 70, 127, 128, 150, 300, 700]))
        a = np.unique(rng.integers(0, 2 ** 63, s, dtype=np.int64).view(np.uint64))
        keep = len(a) - int(rng.integers(0, len(a) // 4 + 1))
        more = (4 * keep - 3 * len(a)) // 3
        if more < 0:
            continue
        b = np.unique(np.concatenate([rng.permutation(a)[:keep], rng.integers(0, 2 ** 63, more, dtype=np.int64).view(np.uint64)]))
        common = np.sort(rng.permutation(a)[:int(rng.integers(0, len(a) + 1))])
        assert len(np.intersect1d(pj.signatures(a, common), pj.signatures(b, common)))
        assert pj.may_link(pj.sketch(a), pj.sketch(b), len(a), len(b))
        met += 1
    assert met > 400


def test_kept_signatures_equal_enumeration():
    for parts in range(1, 5):
        for differ in range(2 * parts):
            shared = min(sum((3 - d) * (2 - d) // 2 for d in ds) for ds in itertools.product(range(4), repeat=parts) if sum(ds) <= differ)
            assert pj.kept(parts, differ) == 3 * parts - shared + 1


@pytest.mark.parametrize("s", [64, 65, 100, 127, 128, 180, 255, 256, 400, 511, 512, 1000, 5000])
def test_signatures_of_two_cells(s):
    rng = np.random.default_rng(s)
    none = np.zeros(0, np.uint64)
    for _ in range(20):
        a = np.unique(rng.integers(0, 2 ** 63, s, dtype=np.int64).view(np.uint64))
        sigs = pj.signatures(a, none)
        assert len(set(sigs.tolist())) == len(sigs)
        # Unlike sets share nothing, so no signature is empty.
        b = np.unique(rng.integers(0, 2 ** 63, s, dtype=np.int64).view(np.uint64))
        assert not len(np.intersect1d(sigs, pj.signatures(b, none)))


@pytest.mark.parametrize("step", [1, 3, 17, 1000])
def test_pairs_of_sorted_rows(step):
    rng = random.Random(step)
    rows = sorted((rng.randrange(12), rng.randrange(40), 50) for _ in range(300))
    table = pa.table({"sig": pa.array([r[0] for r in rows], pa.int64()), "id": pa.array([r[1] for r in rows], pa.int64()),
                      "size": pa.array([r[2] for r in rows], pa.int32()), "sketch": pa.nulls(len(rows), pa.binary())})
    got, large = set(), {}
    for b in pj._pair_up(iter(table.to_batches(max_chunksize=step))):
        for r in b.to_pylist():
            got.add((r["sig"], r["a"], r["b"]))
            large.setdefault(r["sig"], set()).add(r["kind"])
    groups = {}
    for s, i, _ in rows:
        groups.setdefault(s, set()).add(i)
    for s, ids in groups.items():
        ids = sorted(ids)
        first = {(s, ids[0], i) for i in ids[1:]}
        mine = {(g, a, b) for g, a, b in got if g == s and a != b}
        every = {(s, a, b) for n, a in enumerate(ids) for b in ids[n + 1:]}
        assert first <= mine <= every
        assert mine == every or 2 in large[s]


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (4, 5), (9, 8), (8, 10), (20, 21), (21, 20), (30, 30)] + [(100 + i, 101 + i) for i in range(40)]
    got = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    want = {i: 1 for i in range(2, 6)} | {9: 8, 10: 8, 21: 20} | {i: 100 for i in range(101, 141)}
    assert got == want
    assert components.components(components.no_links(spark)).count() == 0


def test_cases(spark):
    rows = pj.join(cases.rows(spark).withColumn("component_id", F.lit("old"))).collect()
    assert len(rows) == len(cases.TEXTS) + 3
    for r in rows:
        assert r.n_shingles == len(_shingles(r.text))
        if not r.n_shingles:
            assert r.component_id == r.doc_id
    same = {r.component_id for r in rows if r.text == "One two three."}
    assert len(same) == 1 and None not in same  # also the row without id
    assert pj.join(cases.empty(spark)).count() == 0
