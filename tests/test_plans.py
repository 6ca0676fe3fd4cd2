"""Plan shape and skew: no query plans a cross product or a nested-loop join,
the dedupe is limited map-side, scans are pruned, and a hot key (a third of all
rows) gives the same result when AQE splits its partition."""
import contextlib
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerflow.operators import enrich, mart
from ledgerflow.operators import profile as profile_ops
from ledgerflow.operators import staging

from .conftest import SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_cross_or_nested_loop_join(spark, name):
    plan = _plan(entry.queries()[name](spark, SMALL))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name} plans a {bad}"


def test_flagship_dedupe_is_limited_map_side_and_scans_pruned(spark):
    plan = _plan(entry.entry(spark))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    # The customer scan for the profile reads only the columns it needs.
    schemas = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    assert schemas and all("c_acctbal" not in s for s in schemas)


SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextlib.contextmanager
def _conf(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _hot_tables(spark):
    n = 3000
    trans = spark.createDataFrame(
        [(i, 1 if i % 3 == 0 else 2 + i % 100, 930101, "PRIJEM", "VKLAD", float(i), None, "",
          None, None, 0) for i in range(n)],
        "trans_id long, account_id long, date long, type string, operation string, amount double, "
        "balance double, k_symbol string, bank string, account string, ingest_seq long")
    accounts = spark.createDataFrame([(a, 1, "POPLATEK MESICNE", 930101) for a in range(1, 102)],
                                     "account_id long, district_id long, frequency string, date long")
    disp = spark.createDataFrame([(a, a, a, "OWNER") for a in range(1, 102)],
                                 "disp_id long, client_id long, account_id long, type string")
    clients = spark.createDataFrame([(a, 700101, 1) for a in range(1, 102)],
                                    "client_id long, birth_number long, district_id long")
    districts = spark.createDataFrame([(1, "A", "R", 1, 9000.0, 1.0, 1.0, 1, 1)],
                                      "district_id long, name string, region string, "
                                      "num_inhabitants long, avg_salary double, "
                                      "unemployment_rate_95 double, unemployment_rate_96 double, "
                                      "num_crimes_95 long, num_crimes_96 long")
    return (trans, staging.stage_account(accounts), staging.stage_disposition(disp),
            staging.stage_client(clients), staging.stage_district(districts))


def test_hot_account_same_result_with_skew_split(spark):
    trans, a, d, c, dist = _hot_tables(spark)

    def run():
        prof = profile_ops.customer_profile(a, d, c, dist)
        fact = mart.enriched_transactions(staging.stage_trans(trans), prof)
        sprof = profile_ops.stream_profile(a, d, c, dist)
        routed = enrich.route(trans.drop("ingest_seq").withColumn("__op", F.lit("c"))
                              .withColumn("__lsn", F.col("trans_id"))
                              .withColumn("__source_ts_ms", F.lit(0).cast("bigint")), sprof)
        return (sorted(map(tuple, fact.collect())),
                sorted(map(tuple, enrich.enriched(routed).collect())))

    plain = run()
    with _conf(spark, SKEW_CONF):
        skewed = run()
    assert plain == skewed
    assert len(plain[0]) == 3000 and sum(1 for r in plain[0] if r[1] == 1) == 1000
