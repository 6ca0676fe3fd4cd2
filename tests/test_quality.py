"""Data-quality runner (DQ-1 ... DQ-4, J-10, FL-5)."""
from pyspark.sql import functions as F

from ledgerflow.operators import quality
from ledgerflow.operators.quality import Rule
from ledgerflow.plans.quality_queries import check_tables

from .conftest import SMALL


def test_declared_suite_on_supplied_data(spark):
    res = quality.run_checks(check_tables(spark, SMALL), quality.DECLARED_RULES)
    rows = res.collect()
    assert len(rows) == 31
    status = {}
    for r in rows:
        status[r["status"]] = status.get(r["status"], 0) + 1
    assert status == {"PASS": 30, "WARN": 1}
    warn = [r for r in rows if r["status"] == "WARN"][0]
    assert warn["test"].startswith("relationships_stg_trans_account_id") and warn["failures"] > 0


def test_rule_semantics(spark):
    df = spark.createDataFrame([(1, "M"), (1, "X"), (2, "X"), (None, "Y"), (None, None)],
                               "k long, g string")
    parent = spark.createDataFrame([(1,)], "k long")
    rules = [Rule("not_null", "t", "k"), Rule("unique", "t", "k"),
             Rule("accepted_values", "t", "g", values=("M", "F")),
             Rule("relationships", "t", "k", "warn", to_table="p", to_column="k")]
    got = {r["test"]: (r["failures"], r["status"]) for r in
           quality.run_checks({"t": df, "p": parent}, rules).collect()}
    assert got["not_null_t_k"] == (2, "ERROR")
    assert got["unique_t_k"] == (1, "ERROR")              # NULLs ignored, value 1 twice
    assert got["accepted_values_t_g"] == (2, "ERROR")     # distinct X, Y; NULL excluded
    assert got["relationships_t_k__p_k"] == (1, "WARN")  # child rows without parent


def test_domain_split(spark):
    df = spark.createDataFrame(
        [(1, 5, 930101, "PRIJEM", 1.0), (2, 5, 991332, "PRIJEM", 1.0), (3, 5, 930101, "X", 1.0),
         (4, None, 930101, "VYDAJ", -1.0), (5, 5, 1234567, "VYBER", 1.0)],
        "trans_id long, account_id long, date long, type string, amount double")
    ok, bad = quality.split_domain(df, quality.trans_domain_rules())
    assert [r["trans_id"] for r in ok.collect()] == [1]
    reasons = {r["trans_id"]: r["reject_reason"] for r in bad.collect()}
    assert reasons == {2: "date_parses", 3: "type_in_domain", 4: "account_id_not_null",
                       5: "date_in_range"}
    counts = {r["rule"]: r["rejected_rows"] for r in
              quality.domain_reject_counts("trans", df, quality.trans_domain_rules()).collect()}
    assert counts["amount_non_negative"] == 1 and counts["date_parses"] == 2


def test_foreign_keys_reject_missing_parents(spark):
    res = {r["test"]: (r["failures"], r["status"]) for r in
           quality.run_checks(check_tables(spark, SMALL), quality.FOREIGN_KEY_RULES).collect()}
    assert len(res) == 4
    tables = check_tables(spark, SMALL)
    # Accounts in the dropped district 24 and dispositions of dropped accounts fail.
    n_acc = tables["account"].where(F.col("district_id") == 24).count()
    assert res["relationships_account_district_id__district_district_id"] == (n_acc, "ERROR")
    n_disp = tables["disposition"].join(tables["account"], "account_id", "left_anti").count()
    assert res["relationships_disposition_account_id__account_account_id"][0] == n_disp > 0
    assert res["relationships_disposition_client_id__client_client_id"] == (0, "PASS")


def test_a_failed_error_test_fails_the_run(spark):
    import pytest
    from ledgerflow.operators import quality
    from ledgerflow.schemas import DQ_RESULT
    rows = [("a", "t", "c", "error", 0, "PASS"), ("b", "t", "c", "warn", 3, "WARN")]
    assert quality.require_passing(spark.createDataFrame(rows, DQ_RESULT)).count() == 2
    with pytest.raises(quality.ChecksFailed, match="c1: 2"):
        quality.require_passing(spark.createDataFrame([*rows, ("c1", "t", "c", "error", 2, "ERROR")], DQ_RESULT))


def test_failing_rows_are_as_many_as_the_test_counts(spark):
    from ledgerflow.operators import quality
    from ledgerflow.operators.quality import Rule
    child = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "z"), (3, "a")], "k long, v string")
    tables = {"child": child, "parent": spark.createDataFrame([(1,), (2,)], "k long")}
    rules = {Rule("not_null", "child", "v"): 1, Rule("unique", "child", "k"): 2, Rule("accepted_values", "child", "v", values=("a", "b")): 1,
             Rule("relationships", "child", "k", to_table="parent", to_column="k"): 1}
    for rule, n in rules.items():
        got = quality.failing_rows(tables, rule)
        assert got.count() == n and sorted(got.columns) == ["k", "v"], rule
