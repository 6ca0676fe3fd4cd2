"""Stream-table join in DataFrame form (J-5 ... J-7, F-11), fixtures of the reference tests."""
import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import enrich

TRANS_SCHEMA = ("trans_id long, account_id long, date long, type string, operation string, "
                "amount double, balance double, k_symbol string, __op string, __lsn long, "
                "__source_ts_ms long")
PROFILE_SCHEMA = ("account_id long, client_id long, birth_number long, account_frequency string, "
                  "district_name string, district_region string, avg_salary double")


def sample_transaction(**kw):
    row = dict(trans_id=1001, account_id=42, date=930101, type="PRIJEM", operation="VKLAD",
               amount=700.0, balance=700.0, k_symbol="", __op="c", __lsn=123456,
               __source_ts_ms=1700000000000)
    row.update(kw)
    return row


def profile_rows():
    return [(42, 501, 700101, "POPLATEK MESICNE", "Hl.m. Praha", "Prague", 12541.0),
            (0, 7, 700101, "POPLATEK TYDNE", "X", "Y", 1.0)]


def _route(spark, trans_rows):
    cols = [c.split()[0] for c in TRANS_SCHEMA.split(", ")]
    t = spark.createDataFrame([tuple(r[c] for c in cols) for r in trans_rows], TRANS_SCHEMA)
    p = spark.createDataFrame(profile_rows(), PROFILE_SCHEMA)
    return enrich.route(t, p)


def test_enriched_record_merges_fields(spark):
    out = enrich.enriched(_route(spark, [sample_transaction()])).collect()
    assert len(out) == 1
    r = out[0].asDict()
    assert r["client_id"] == 501 and r["birth_number"] == 700101
    assert r["district_name"] == "Hl.m. Praha" and r["district_region"] == "Prague"
    assert r["avg_salary"] == 12541.0 and r["account_frequency"] == "POPLATEK MESICNE"
    assert r["__op"] == "c" and r["__lsn"] == 123456 and r["__source_ts_ms"] == 1700000000000
    assert r["__enriched"] is True
    assert len(r) == 18 and "bank" not in r


@pytest.mark.parametrize("account,reason", [(None, "missing_account_id"),
                                            (999, "referential_violation")])
def test_dead_letter_reasons(spark, account, reason):
    routed = _route(spark, [sample_transaction(account_id=account)])
    assert enrich.enriched(routed).count() == 0
    dl = enrich.dead_letters(routed).collect()
    assert len(dl) == 1 and dl[0]["dlq_reason"] == reason
    assert dl[0]["trans_id"] == 1001
    assert dl[0]["original_transaction"]["amount"] == 700.0


def test_account_id_zero_is_valid(spark):
    routed = _route(spark, [sample_transaction(account_id=0)])
    assert enrich.enriched(routed).count() == 1


def test_exactly_one_output_per_record(spark):
    rows = [sample_transaction(trans_id=i, account_id=a)
            for i, a in enumerate([42, None, 999, 0, 42, None])]
    routed = _route(spark, rows)
    e, d = enrich.enriched(routed), enrich.dead_letters(routed)
    assert e.count() + d.count() == len(rows)
    assert e.join(d, "trans_id").count() == 0
    m = routed.agg(*enrich.metric_columns()).first()
    assert (m["processed"], m["enriched"], m["dlq"], m["dlq_missing_account"]) == (6, 3, 3, 2)


def test_delete_is_passed_through(spark):
    routed = _route(spark, [sample_transaction(__op="d")])
    assert enrich.enriched(routed).first()["__op"] == "d"


def test_dlq_by_reason(spark):
    rows = [sample_transaction(trans_id=i, account_id=a) for i, a in enumerate([None, None, 5])]
    got = {r["dlq_reason"]: r["records"] for r in
           enrich.dlq_by_reason(enrich.dead_letters(_route(spark, rows))).collect()}
    assert got == {"missing_account_id": 2, "referential_violation": 1}


def test_null_keys_keep_their_fields(spark):
    routed = _route(spark, [sample_transaction(account_id=None, trans_id=7)])
    row = routed.where(F.col("account_id").isNull()).first()
    assert row["trans_id"] == 7 and row["client_id"] is None
