"""Profile hops (J-1 ... J-3, J-6, J-7) and the mart (J-4, F-8) on hand-written rows."""
import datetime as dt

from ledgerflow.operators import mart, staging
from ledgerflow.operators import profile as profile_ops


def _tables(spark):
    accounts = spark.createDataFrame(
        [(1, 10, "POPLATEK MESICNE", 930101), (2, 10, "POPLATEK TYDNE", 930101),
         (3, 11, "POPLATEK MESICNE", 1017), (4, 12, "POPLATEK MESICNE", 930101),
         (5, 10, "POPLATEK MESICNE", 930101), (0, 0, "POPLATEK MESICNE", 930101)],
        "account_id long, district_id long, frequency string, date long")
    dispositions = spark.createDataFrame(
        [(1, 100, 1, "OWNER"), (2, 200, 2, "DISPONENT"),   # account 2: only DISPONENT
         (3, 300, 3, "OWNER"),                              # client 300 missing
         (4, 400, 4, "OWNER"),                              # client 400 in a missing district
         (5, 500, 5, "OWNER"), (6, 0, 0, "OWNER")],
        "disp_id long, client_id long, account_id long, type string")
    clients = spark.createDataFrame(
        [(100, 700101, 10), (200, 755502, 10), (400, 706213, 99), (500, 700101, None),
         (0, 700101, 0)],
        "client_id long, birth_number long, district_id long")
    districts = spark.createDataFrame(
        [(10, "A", "R1", 100, 8000.0, 1.0, 2.0, 5, 6), (0, "Zero", "R0", 1, 0.0, 1.0, 2.0, 1, 1)],
        "district_id long, name string, region string, num_inhabitants long, avg_salary double, "
        "unemployment_rate_95 double, unemployment_rate_96 double, num_crimes_95 long, "
        "num_crimes_96 long")
    return (staging.stage_account(accounts), staging.stage_disposition(dispositions),
            staging.stage_client(clients), staging.stage_district(districts))


def test_batch_profile_hops(spark):
    a, d, c, dist = _tables(spark)
    prof = {r["account_id"]: r for r in profile_ops.customer_profile(a, d, c, dist).collect()}
    assert set(prof) == {1, 4, 5, 0}          # no OWNER (2) and missing client (3) drop out
    assert prof[1]["district_name"] == "A" and prof[1]["gender"] == "M"
    assert prof[4]["district_name"] is None   # client district missing: left join keeps row
    assert prof[5]["district_name"] is None   # batch: no fallback to the account's district
    assert prof[0]["district_name"] == "Zero"
    assert prof[1]["birth_date"] == dt.date(1970, 1, 1)


def test_stream_profile_falls_back_only_on_null(spark):
    a, d, c, dist = _tables(spark)
    prof = {r["account_id"]: r for r in profile_ops.stream_profile(a, d, c, dist).collect()}
    assert prof[5]["district_name"] == "A"    # NULL client district -> account's district 10
    assert prof[0]["district_name"] == "Zero"  # id 0 is a valid key, no fallback


def test_mart_ratio_guarded(spark):
    a, d, c, dist = _tables(spark)
    prof = profile_ops.customer_profile(a, d, c, dist)
    trans = staging.stage_trans(spark.createDataFrame(
        [(1, 1, 101, "PRIJEM", "VKLAD", 800.0, None, "", None, None, 0),
         (2, 0, 930101, "VYDAJ", None, 5.0, 1.0, "SIPO", None, None, 0),
         (3, 9, 930101, "VYDAJ", None, 5.0, 1.0, " ", None, None, 0),
         (1, 2, 101, "PRIJEM", "VKLAD", 1.0, None, None, None, None, 1)],
        "trans_id long, account_id long, date long, type string, operation string, amount double, "
        "balance double, k_symbol string, bank string, account string, ingest_seq long"))
    rows = {r["trans_id"]: r for r in mart.enriched_transactions(trans, prof).collect()}
    assert set(rows) == {1, 2}                         # 3 has no profile
    assert rows[1]["amount_to_avg_salary_ratio"] == 0.1
    assert rows[1]["account_id"] == 1                  # first copy wins
    assert rows[1]["k_symbol"] is None                 # '' -> NULL
    assert rows[1]["transaction_date"] == dt.date(2000, 1, 1)
    assert rows[2]["amount_to_avg_salary_ratio"] is None  # avg_salary 0
    counts = mart.mart_counts(trans, prof).first()
    assert (counts["staged_rows"], counts["mart_rows"], counts["excluded_rows"]) == (3, 2, 1)
    assert [r["k_symbol"] for r in trans.where("trans_id = 3").collect()] == [" "]
