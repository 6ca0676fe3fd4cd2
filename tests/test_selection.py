"""Exact-k selection, ranks and the binned interval draw against brute force."""
import pytest
from pyspark.sql import functions as F

from ledgerflow.functions.uniform import hash52
from ledgerflow.operators import selection


def _frame(spark, n):
    return (spark.range(0, n, numPartitions=6).withColumnRenamed("id", "trans_id")
            .withColumn("copy_no", (F.col("trans_id") % 2).cast("bigint"))
            .withColumn("h", hash52("t", "trans_id", "copy_no")))


@pytest.mark.parametrize("n,k", [(1000, 1), (1000, 37), (1000, 999), (1000, 1000), (1000, 5000),
                                 (3000, 1500)])
def test_exact_k_matches_sorting(spark, n, k):
    df = _frame(spark, n)
    sel = selection.exact_k(df, k, "h", ["trans_id", "copy_no"], bits=4)
    got = sorted(r["trans_id"] for r in df.where(sel.predicate()).collect())
    rows = sorted(df.collect(), key=lambda r: (r["h"], r["trans_id"], r["copy_no"]))
    assert got == sorted(r["trans_id"] for r in rows[:k])


@pytest.mark.parametrize("bits,cut_rows,k", [(1, 5, 700), (2, 1, 1), (1, 100, 1999), (3, 10, 2000), (1, 0, 1234)])
def test_large_cut_buckets_are_refined(spark, bits, cut_rows, k):
    """Few first buckets of many rows each, ties of one hash among them: the same rows as by sorting."""
    df = _frame(spark, 2000).withColumn("h", F.when(F.col("trans_id") % 5 == 0, F.lit(2**51 + 12345)).otherwise(F.col("h")))
    sel = selection.exact_k(df, k, "h", ["trans_id", "copy_no"], bits=bits, cut_rows=cut_rows)
    got = sorted(r["trans_id"] for r in df.where(sel.predicate()).collect())
    rows = sorted(df.collect(), key=lambda r: (r["h"], r["trans_id"], r["copy_no"]))
    assert got == sorted(r["trans_id"] for r in rows[:k])
    ranked = selection.ranked(spark, df.where(sel.predicate()), sel).collect()
    assert [r["trans_id"] for r in sorted(ranked, key=lambda r: r["rank"])] == [r["trans_id"] for r in rows[:k]]


def test_refinement_reads_few_rows_in_one_task(spark):
    df = _frame(spark, 3000)
    plans = {0: (0, 1500, [], 1500, 3000)}
    cut = selection._refined(df, [(1500, "h", ["trans_id"])], plans, 0, 20)[0]
    assert cut.rows <= 20 and cut.bits == selection.REFINE_BITS
    inside = df.where(F.shiftright("h", 52 - cut.bits) == cut.bucket).count()
    below = df.where(F.shiftright("h", 52 - cut.bits) < cut.bucket).count()
    assert inside == cut.rows and below + cut.rank == 1500


def test_ranks_are_consecutive_in_hash_order(spark):
    df = _frame(spark, 2000)
    sel = selection.exact_k(df, 321, "h", ["trans_id", "copy_no"], bits=5)
    ranked = selection.ranked(spark, df.where(sel.predicate()), sel).collect()
    by_rank = [r["trans_id"] for r in sorted(ranked, key=lambda r: r["rank"])]
    expect = [r["trans_id"] for r in sorted(df.collect(), key=lambda r: (r["h"], r["trans_id"]))[:321]]
    assert by_rank == expect
    assert sorted(r["rank"] for r in ranked) == list(range(1, 322))


def test_interval_draw_matches_search(spark):
    import bisect
    counts = [5, 1, 300, 2, 2, 90]   # a hot interval covers many bins
    lo, acc = [], 0
    for c in counts:
        lo.append(acc)
        acc += c
    iv = spark.createDataFrame([(i, lo[i], lo[i] + c) for i, c in enumerate(counts)],
                               "account_id long, cum_lo long, cum_hi long")
    draws = spark.range(0, acc).withColumnRenamed("id", "r")
    got = {r["r"]: r["account_id"] for r in
           selection.interval_draw(draws, "r", iv, "cum_lo", "cum_hi", acc, len(counts),
                                   payload=["account_id"]).collect()}
    assert len(got) == acc
    for r, a in got.items():
        assert a == bisect.bisect_right(lo, r) - 1


def test_prefix_intervals_cover_range(spark):
    counts = spark.createDataFrame([(i, (i * 7) % 5 + 1) for i in range(500)], "account_id long, n long")
    out = selection.prefix_intervals(spark, counts, "n", ["account_id"], bits=6).collect()
    spans = sorted((r["cum_lo"], r["cum_hi"]) for r in out)
    assert spans[0][0] == 0
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert spans[-1][1] == sum((i * 7) % 5 + 1 for i in range(500))


def test_interval_draw_hot_interval_is_chunked(spark):
    import bisect
    counts = [1, 9000, 3, 2]     # one interval holds nearly all mass -> thousands of bins
    lo, acc = [], 0
    for c in counts:
        lo.append(acc)
        acc += c
    iv = spark.createDataFrame([(i, lo[i], lo[i] + c) for i, c in enumerate(counts)],
                               "account_id long, cum_lo long, cum_hi long")
    draws = spark.range(0, acc).withColumnRenamed("id", "r")
    # n_intervals is passed large so the bin width is 1 and the hot interval spans 9000 bins.
    got = selection.interval_draw(draws, "r", iv, "cum_lo", "cum_hi", acc, acc,
                                  payload=["account_id"]).collect()
    assert len(got) == acc
    assert all(r["account_id"] == bisect.bisect_right(lo, r["r"]) - 1 for r in got)


def test_many_intervals_are_not_in_every_task(spark, monkeypatch):
    """Two million intervals were broadcast, and each task held them all."""
    n = 120_000
    iv = spark.range(n).select(F.col("id").alias("account_id"), F.col("id").alias("cum_lo"), (F.col("id") + 1).alias("cum_hi"))
    draws = spark.range(0, n, 7).select((F.col("id") * 31 % n).alias("r"))
    monkeypatch.setattr(selection, "TASK_ROWS", 10_000)
    got = selection.interval_draw(draws, "r", iv, "cum_lo", "cum_hi", n, n, payload=["account_id"], n_draws=n // 7 + 1)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan and plan.count("RepartitionByExpression") >= 2 and "], 25" in plan
    assert got.where("r <> account_id").count() == 0 and got.count() == draws.count()


def test_rows_of_a_task_do_not_grow(spark, monkeypatch):
    monkeypatch.setattr(selection, "TASK_ROWS", 1000)
    rows = spark.range(20_000)
    assert selection.dealt_over(rows, 20_000, "id").rdd.getNumPartitions() == 20
    assert selection.dealt_over(rows, 10, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_rows_are_reconciled_in_tasks_of_bounded_rows(spark, monkeypatch):
    """The staged rows and the join of audit and findings took the session's number of partitions at any size."""
    from ledgerflow.plans import synth_queries

    from .conftest import SMALL
    monkeypatch.setattr(selection, "TASK_ROWS", 100)
    dealt = []
    deal = selection.dealt_over
    monkeypatch.setattr(selection, "dealt_over", lambda df, n, *cols: dealt.append((n, cols)) or deal(df, n, *cols))
    out = synth_queries.reconcile_rows(spark, SMALL)
    assert [c for _, c in dealt if "trans_id" in c] == [("trans_id",)] * 2 + [("dataset", "kind", "trans_id", "copy_no")] * 2
    assert out.where("outcome = 'found and audited' and kind = 'duplicate'").count() == 2
