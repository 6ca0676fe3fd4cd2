import collections
import hashlib
import zlib

from pyspark.sql import functions as F

from ledgerflow.llm import kd_shards as kd

from . import cases

SF = "/root/testdata/sf0.001"


def _laws(rows, shards, most):
    size, slots = collections.Counter({s: 0 for s in range(shards)}), collections.defaultdict(list)
    for r in rows:
        size[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert set(size) == set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    mean = sum(size.values()) / shards
    assert all(abs(v - mean) <= most for v in size.values()), (mean, size)


def test_near_equal_bytes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for n in (1, 3, 7, 16):
        rows = kd.shard(docs, n).collect()
        assert len(rows) == docs.count()
        _laws(rows, n, max(r["size"] for r in rows))
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    assert all(r["size"] == len(texts[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) for r in rows)


def i_first(group, i):
    return group[0] == i


def _brute(points, shards, first=0):
    """The same tree over rows (size, places, tie) in memory."""
    if shards == 1 or not points:
        return {p[3]: first for p in points}
    wide = [max(p[1][d] for p in points) - min(p[1][d] for p in points) for d in range(len(points[0][1]))]
    dim = wide.index(max(wide))
    points = sorted(points, key=lambda p: (p[1][dim], p[2]))
    half, whole = shards // 2, sum(p[0] for p in points) / shards / 100
    target, total, cut = sum(p[0] for p in points) * half / shards, 0, 0
    for cut, p in enumerate(points):  # noqa: B007
        group = [i for i, q in enumerate(points) if (q[1][dim], q[2][0]) == (p[1][dim], p[2][0])]
        size = sum(points[i][0] for i in group)
        if i_first(group, cut) and len(group) > 1 and size <= whole and total + size >= target:
            cut = group[-1] + 1 if abs(total + size - target) < abs(total - target) else group[0]
            break
        if total + p[0] >= target:
            cut += abs(total + p[0] - target) < abs(total - target)
            break
        total += p[0]
    return _brute(points[:cut], half, first) | _brute(points[cut:], shards - half, first + half)


def test_equals_a_tree_in_memory(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    rows = docs.collect()
    bits = lambda t, n: int(hashlib.md5(t.encode()).hexdigest()[:-(-n // 4)], 16) >> (-n % 4)
    source = {t: min(r.source for r in rows if r.text == t) for t in {r.text for r in rows}}
    ends = {c: (min(r[c] for r in rows), max(r[c] for r in rows)) for c in ("n_chars",)}
    def scaled(c, v):
        lo, hi = ends[c]
        return int((v - lo) * float((1 << 20) - 1) / (hi - lo))
    points = [(len(r.text.encode()) + 1, [scaled("n_chars", r.n_chars), bits(source[r.text], 20), bits(r.lang, 20)],
               (bits(r.text, 24), bits(str(r.doc_id), 15)), r.doc_id) for r in rows]
    assert {r.doc_id: r.shard for r in kd.shard(docs, 16).collect()} == _brute(points, 16)


def test_groups_stay_whole_unless_they_are_large(spark):
    """Copies in several sources: small groups lie in one shard, a group of half the bytes is cut, bytes stay near."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 1400, F.lit("the same " * 5)).otherwise(
        F.concat(F.lit("text "), F.floor(F.col("id") / 3).cast("string"), F.lit(" and more of it, at length."))).alias("text"), F.lit("en").alias("lang"),
        F.concat(F.lit("s"), (F.col("id") % 7).cast("string")).alias("source")).withColumn("n_chars", F.length("text"))
    rows = kd.shard(docs, 8).collect()
    _laws(rows, 8, sum(r["size"] for r in rows) / 8 * 0.04)
    texts, shards = {r.doc_id: r.text for r in docs.collect()}, collections.defaultdict(set)
    for r in rows:
        shards[texts[r.doc_id]].add(r.shard)
    split = [t for t, s in shards.items() if len(s) > 1]
    assert split == ["the same " * 5] and len(shards) > 500


def test_one_text_holding_most_rows_is_split(spark):
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 400, "same text").otherwise(
        F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"),
        F.lit(9).alias("n_chars"))
    _laws(kd.shard(docs, 16).collect(), 16, 20)


def test_repeated_rows_of_one_id_are_split(spark):
    docs = spark.range(800).select(F.lit(7).alias("doc_id"), F.lit("same").alias("text"), F.lit("en").alias("lang"),
                                   F.lit("s").alias("source"), F.lit(4).alias("n_chars"))
    rows = kd.shard(docs, 4).collect()
    _laws(rows, 4, 5 * 80)  # rows of one key stay together: a sixteenth of them


def test_cases(spark):
    docs = (cases.rows(spark).withColumn("n_chars", F.length("text")).withColumn("source", F.lit(None).cast("string"))
            .withColumn("lang", F.lit("en")).withColumn("shard", F.lit("old")).withColumn("size", F.lit("old")))
    rows = kd.shard(docs, 4).collect()
    assert len(rows) == len(cases.TEXTS) + 3
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows))) for s in range(4))
    assert any(r["size"] == 1 and r.text_crc32 == 0 for r in rows)
    assert kd.shard(docs.limit(0), 4).count() == 0


def test_no_python_in_the_plan(spark):
    plan = kd.shard(spark.read.parquet(f"{SF}/documents.parquet"), 4)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
