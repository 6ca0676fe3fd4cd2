"""Spelling variants: against all pairs of words by their patterns."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerflow.llm import spelling_variants as sv

from . import cases

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    c = Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            c[w] += len(w) >= 7
    c = {w: n for w, n in c.items() if n >= 2}
    patterns = defaultdict(set)
    for w in c:
        for i in range(len(w) + 1):
            patterns[w[:i] + "*" + w[i:]].add(w)
            patterns[w[:i] + "*" + w[i + 1:]].add(w)
    form, near = {}, {}
    for w in c:
        near[w] = set().union(*(patterns[w[:i] + "*" + w[i + d:]] for i in range(len(w) + 1) for d in (0, 1))) - {w}
        best = min(near[w], key=lambda x: (-c[x], x), default=None)
        if best and c[best] >= 10 * c[w]:
            form[w] = best
    out = set()
    for w, n in c.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), c[form[w]] if w in form else None))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("seed, letters", [(1, "ab"), (2, "abcé"), (3, "etaoinshr÷ÿ")])
def test_equals_brute_force(spark, seed, letters):
    r = random.Random(seed)
    words = ["".join(r.choices(letters, k=r.randrange(5, 12))) for _ in range(60)]
    for w in list(words):                       # near words of the first ones
        i = r.randrange(len(w) + 1)
        words.append(w[:i] + r.choice(letters) + w[i + r.randrange(2):])
    weights = [3.0 ** -(i % 9) for i in range(len(words))]
    rows = [(i, " ".join(w.upper() if r.random() < 0.1 and w.isascii() else w for w in r.choices(words, weights, k=80))) for i in range(120)]
    got = sv.group(frame(spark, rows).repartition(3)).collect()
    assert {tuple(x) for x in got} == brute(rows) and len(got) == len(brute(rows))


def test_chains_lead_to_the_root(spark):
    chain = ["abcdefgh", "abcdefg", "abcdefgx", "abcdefxx"]
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(zip(chain, (4000, 300, 30, 2)))]
    got = {r.word: (r.form, r.root, r.n, r.form_n) for r in sv.group(frame(spark, rows)).collect()}
    assert got == {x[0]: (x[1], x[2], x[3], x[5]) for x in brute(rows)}
    assert got["abcdefxx"][1] == got["abcdefgx"][1] == "abcdefgh" != got["abcdefxx"][0]


def test_pivots_are_the_cheapest_disjoint():
    r = random.Random(4)
    for _ in range(200):
        n = r.randrange(3, 8)
        places = sorted(r.sample(range(12), n))
        costs = [[r.randrange(20) for _ in range(n)] for _ in range(2)]
        pairs = [(costs[0][i] + costs[1][j], i, j) for i, j in itertools.combinations(range(n), 2) if places[j] - places[i] >= 2]
        mark = sv.pivots(np.array([places]), [np.array([c]) for c in costs], np.array([n]))[0]
        i, j = np.flatnonzero(mark)
        assert places[j] - places[i] >= 2 and costs[0][i] + costs[1][j] == min(pairs)[0]


def test_cases(spark):
    docs = cases.rows(spark)
    extra = spark.createDataFrame([(None, "Überraschung überraschung Überraschung"), (7, "z" * 30_000 + " " + "z" * 30_000)], "doc_id long, text string")
    docs = docs.unionByName(extra, allowMissingColumns=True)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    small = [(i, t) for i, t in rows if not t or "zzz" not in t]
    got = {tuple(r) for r in sv.group(docs).collect()}
    assert {x for x in got if "zzz" not in x[0]} == brute(small) and any(len(x[0]) >= 29_999 for x in got)
    assert sv.group(cases.empty(spark)).count() == 0
