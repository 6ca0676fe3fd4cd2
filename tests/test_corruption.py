"""Corruption (CR-1 ... CR-5): exact counts, independence, audit, determinism."""
import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import corrupt


@pytest.fixture(scope="module")
def clean(spark):
    rows = [(i, [100, 200, 300, 400][i % 4], 990101, "PRIJEM", ["VKLAD", "SIPO"][i % 2],
             10.0 + (i * 13) % 990, None, ["SIPO", None, ""][i % 3], None, None)
            for i in range(1, 1001)]
    return spark.createDataFrame(
        rows, "trans_id long, account_id long, date long, type string, operation string, "
              "amount double, balance double, k_symbol string, bank string, account string")


def _run(spark, df, n, rates, seed=42):
    return corrupt.corrupt(spark, df, n, 400, rates, seed, "dev")


def test_exact_counts_and_rows(spark, clean):
    c = _run(spark, clean, 1000, {"duplicate": 0.02, "referential": 0.02, "missing": 0.03})
    audit = {r["kind"]: r["count"] for r in c.audit.groupBy("kind").count().collect()}
    assert audit == {"duplicate": 20, "referential_violation": 20, "missing_value": 30}
    assert c.rows.count() == 1020
    dup_ids = [r["trans_id"] for r in c.audit.where("kind = 'duplicate'").collect()]
    counts = c.rows.where(F.col("trans_id").isin(dup_ids)).groupBy("trans_id").count().collect()
    assert all(r["count"] == 2 for r in counts) and len(counts) == 20


def test_fake_ids_unique_consecutive_and_not_real(spark, clean):
    c = _run(spark, clean, 1000, {"duplicate": 0.02, "referential": 0.05, "missing": 0.03})
    fakes = sorted(int(r["new_value"]) for r in c.audit.where("kind = 'referential_violation'").collect())
    assert fakes == list(range(400 + 100000, 400 + 100000 + 50))
    assert not set(fakes) & {100, 200, 300, 400}


def test_only_k_symbol_is_nulled(spark, clean):
    c = _run(spark, clean, 1000, {"duplicate": 0.0, "referential": 0.0, "missing": 0.5})
    f = c.flagged.where("is_missing").collect()
    assert len(f) == 500
    assert all(r["k_symbol"] is None for r in f)
    assert all(r["amount"] is not None and r["trans_id"] is not None for r in f)


def test_rate_zero_still_injects_one(spark, clean):
    c = _run(spark, clean, 1000, {"duplicate": 0.0, "referential": 0.0, "missing": 0.0})
    assert c.audit.count() == 3 and c.rows.count() == 1001


def test_one_row_input(spark, clean):
    one = clean.limit(1)
    c = _run(spark, one, 1, {})
    assert c.rows.count() == 2


def test_inexact_double_product():
    assert corrupt.k_of(100, 0.29) == 28


def test_same_seed_same_choice_any_partitioning(spark, clean):
    rates = {"duplicate": 0.02, "referential": 0.02, "missing": 0.03}
    a = _run(spark, clean.repartition(7), 1000, rates).audit.collect()
    b = _run(spark, clean.coalesce(1), 1000, rates).audit.collect()
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)
    c = _run(spark, clean, 1000, rates, seed=1).audit.collect()
    assert sorted(map(tuple, a), key=str) != sorted(map(tuple, c), key=str)
