"""Adapter: the supplied TPC-H-like tables shaped like the banking model.

Every definition is a pure per-row formula over a scan (no shuffle except the
tiny nation x region join), so each raw table grows linearly with its source:

* ``district``    <- nation x region (district 24 dropped: a district miss)
* ``account``     <- customer (key % 50 = 49 dropped: orphan transactions)
* ``client``      <- customer
* ``disposition`` <- customer (OWNER unless key % 97 = 96; DISPONENT for key % 5 = 0)
* ``trans``       <- orders, plus a differing second copy of key % 50 = 0
* ``cdc_trans``   <- events (change log of transactions)
* ``cdc_client`` / ``cdc_disposition`` <- events (change logs of profile rows)

The DuckDB oracle (``ledgerflow.plans.oracle``) writes the same formulas in SQL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import operation_key, type_of_operation
from ..functions.dates import to_yymmdd

# Adapter constants.
DROPPED_DISTRICT = 24
ZERO_SALARY_DISTRICT = 7
NULL_CRIMES_DISTRICT = 13
ORPHAN_ACCOUNT_MOD, ORPHAN_ACCOUNT_REM = 50, 49
NO_OWNER_MOD, NO_OWNER_REM = 97, 96
DISPONENT_MOD = 5
DUPLICATE_MOD = 50
SPACE_KSYMBOL_MOD, SPACE_KSYMBOL_REM = 1000, 1
NULL_BALANCE_MOD, NULL_BALANCE_REM = 10, 7
FAKE_STREAM_ACCOUNT = 900000

# Segment -> account frequency; priority -> operation.
FREQUENCY_BY_SEGMENT = {
    "HOUSEHOLD": "POPLATEK PO OBRATU",
    "BUILDING": "POPLATEK TYDNE",
}
DEFAULT_FREQUENCY = "POPLATEK MESICNE"
OPERATION_BY_PRIORITY = {
    "1-URGENT": "VKLAD",
    "2-HIGH": "PREVOD Z UCTU",
    "3-MEDIUM": "PREVOD NA UCET",
    "4-NOT SPECIFIED": "VYBER KARTOU",
}
# '5-LOW': odd order keys -> 'VYBER', even -> NULL operation.
TRANSFER_OPERATIONS = ["PREVOD Z UCTU", "PREVOD NA UCET"]
# Event type -> CDC operation code.
OP_BY_EVENT = {"signup": "c", "view": "r", "click": "u", "purchase": "u", "error": "d"}

TABLES = ["region", "nation", "customer", "orders", "events"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(col: Column, mapping: dict[str, str], default: Column) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == F.lit(k), F.lit(v)) if expr is None
                else expr.when(col == F.lit(k), F.lit(v)))
    return expr.otherwise(default)


def raw_district(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    i = F.col("n_nationkey").cast("bigint")
    return (
        n.join(r, n.n_regionkey == r.r_regionkey, "left")
        .where(F.col("n_nationkey") != DROPPED_DISTRICT)
        .select(
            i.alias("district_id"),
            F.col("n_name").alias("name"),
            F.col("r_name").alias("region"),
            (F.lit(50000) + F.lit(7919) * i).alias("num_inhabitants"),
            (i % 7 * 10).alias("num_municipalities_lt_499"),
            (i % 5 * 4).alias("num_municipalities_500_1999"),
            (i % 3 + 1).alias("num_municipalities_2000_9999"),
            (i % 2).alias("num_municipalities_gt_10000"),
            (i % 9 + 1).alias("num_cities"),
            (F.lit(40.0) + F.lit(2.5) * i).alias("ratio_urban"),
            F.when(i == ZERO_SALARY_DISTRICT, F.lit(0.0))
             .otherwise(F.lit(8000.0) + F.lit(137.0) * i).alias("avg_salary"),
            (F.lit(0.25) * (i % 12)).alias("unemployment_rate_95"),
            (F.lit(0.25) * (i % 12) + F.lit(0.5)).alias("unemployment_rate_96"),
            (F.lit(100.0) + i).alias("num_entrepreneurs_per_1000"),
            F.when(i == NULL_CRIMES_DISTRICT, F.lit(None).cast("bigint"))
             .otherwise(F.lit(1000) + F.lit(53) * i).alias("num_crimes_95"),
            (F.lit(1100) + F.lit(59) * i).alias("num_crimes_96"),
        )
    )


def raw_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey").cast("bigint")
    return (
        c.where(k % ORPHAN_ACCOUNT_MOD != ORPHAN_ACCOUNT_REM)
        .select(
            k.alias("account_id"),
            (k * 7 % 25).alias("district_id"),
            _case(F.col("c_mktsegment"), FREQUENCY_BY_SEGMENT, F.lit(DEFAULT_FREQUENCY)).alias("frequency"),
            ((F.lit(93) + k % 5) * 10000 + (k % 12 + 1) * 100 + k % 28 + 1).alias("date"),
        )
    )


def birth_number_formula(k: Column) -> Column:
    return (F.lit(20) + k % 60) * 10000 + (k % 12 + 1 + (k % 2) * 50) * 100 + k % 28 + 1


def raw_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey").cast("bigint")
    return c.select(
        k.alias("client_id"),
        birth_number_formula(k).alias("birth_number"),
        F.col("c_nationkey").cast("bigint").alias("district_id"),
    )


def raw_disposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey").cast("bigint")
    owners = c.where(k % NO_OWNER_MOD != NO_OWNER_REM).select(
        (k * 2).alias("disp_id"), k.alias("client_id"), k.alias("account_id"),
        F.lit("OWNER").alias("type"))
    disponents = c.where(k % DISPONENT_MOD == 0).select(
        (k * 2 + 1).alias("disp_id"), F.greatest(k - 1, F.lit(0).cast("bigint")).alias("client_id"),
        k.alias("account_id"), F.lit("DISPONENT").alias("type"))
    return owners.unionByName(disponents)


def _trans_columns(o: DataFrame, copy: bool) -> DataFrame:
    key = F.col("o_orderkey").cast("bigint")
    low = F.when(key % 2 == 1, F.lit("VYBER")).otherwise(F.lit(None).cast("string"))
    op = _case(F.col("o_orderpriority"), OPERATION_BY_PRIORITY, low)
    is_transfer = op.isin(*TRANSFER_OPERATIONS)
    k_symbol = (F.when(key % SPACE_KSYMBOL_MOD == SPACE_KSYMBOL_REM, F.lit(" "))
                .when(F.col("o_orderstatus") == "F", F.lit("SIPO"))
                .when(F.col("o_orderstatus") == "O", F.lit(""))
                .otherwise(F.lit(None).cast("string")))
    account = F.col("o_custkey").cast("bigint")
    if copy:
        account = account + 1
        k_symbol = F.lit(None).cast("string")
    return o.select(
        key.alias("trans_id"),
        account.alias("account_id"),
        to_yymmdd(F.col("o_orderdate")).alias("date"),
        type_of_operation(operation_key(op)).alias("type"),
        op.alias("operation"),
        F.col("o_totalprice").cast("double").alias("amount"),
        F.when(key % NULL_BALANCE_MOD == NULL_BALANCE_REM, F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice") * F.lit(2.0)).alias("balance"),
        k_symbol.alias("k_symbol"),
        F.when(is_transfer, F.element_at(F.array(F.lit("AB"), F.lit("CD"), F.lit("EF")),
                                         (key % 3 + 1).cast("int")))
         .alias("bank"),
        F.when(is_transfer, (F.col("o_custkey").cast("bigint") * 1000 + 17).cast("string"))
         .alias("account"),
        F.lit(1 if copy else 0).cast("bigint").alias("ingest_seq"),
    )


def raw_trans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with an ``ingest_seq`` (0 = first arrival, 1 = a later copy)."""
    o = read_table(spark, sf_dir, "orders")
    first = _trans_columns(o, copy=False)
    again = _trans_columns(o.where(F.col("o_orderkey") % DUPLICATE_MOD == 0), copy=True)
    return first.unionByName(again)


def _ts_ms(ts: Column) -> Column:
    """Milliseconds since the epoch of a wall-clock (NTZ) timestamp, independent of
    the session time zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, ts.cast("timestamp_ntz")) / 1000


def cdc_trans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattened CDC records of transactions (SRC-7 shape), from ``events``."""
    e = read_table(spark, sf_dir, "events")
    return events_as_cdc_trans(e)


def events_as_cdc_trans(e: DataFrame) -> DataFrame:
    eid = F.col("event_id").cast("bigint")
    user = F.col("user_id").cast("bigint")
    account = (F.when(eid % 100 == 0, F.lit(None).cast("bigint"))
               .when(eid % 50 == 1, user + FAKE_STREAM_ACCOUNT)
               .otherwise(user))
    op = _case(F.col("event_type"), OP_BY_EVENT, F.lit("c"))
    return e.select(
        eid.alias("trans_id"),
        account.alias("account_id"),
        to_yymmdd(F.col("ts")).alias("date"),
        F.lit("PRIJEM").alias("type"),
        F.lit("VKLAD").alias("operation"),
        F.col("value").cast("double").alias("amount"),
        F.lit(None).cast("double").alias("balance"),
        F.when(eid % 3 == 0, F.lit("SIPO")).otherwise(F.lit("")).alias("k_symbol"),
        F.lit(None).cast("string").alias("bank"),
        F.lit(None).cast("string").alias("account"),
        op.alias("__op"),
        F.lit("trans").alias("__table"),
        eid.alias("__lsn"),
        F.floor(_ts_ms(F.col("ts"))).cast("bigint").alias("__source_ts_ms"),
        F.when(op == "d", F.lit("true")).otherwise(F.lit("false")).alias("__deleted"),
    )


def cdc_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log of clients: key user_id, lsn event_id, district event_id % 25."""
    e = read_table(spark, sf_dir, "events")
    eid = F.col("event_id").cast("bigint")
    k = F.col("user_id").cast("bigint")
    deleted = eid % 40 == 3
    return e.select(
        k.alias("client_id"),
        birth_number_formula(k).alias("birth_number"),
        (eid % 25).alias("district_id"),
        F.when(deleted, F.lit("d")).otherwise(F.when(eid % 7 == 0, F.lit("c")).otherwise(F.lit("u"))).alias("__op"),
        eid.alias("__lsn"),
        F.floor(_ts_ms(F.col("ts"))).cast("bigint").alias("__source_ts_ms"),
        F.when(deleted, F.lit("true")).otherwise(F.lit("false")).alias("__deleted"),
    )


def cdc_disposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log of dispositions: key disp_id = 3 * user_id + event_id % 2 (several per account),
    type flips to DISPONENT on every 7th event, deletes on event_id % 45 = 4."""
    e = read_table(spark, sf_dir, "events")
    eid = F.col("event_id").cast("bigint")
    u = F.col("user_id").cast("bigint")
    deleted = eid % 45 == 4
    return e.select(
        (u * 3 + eid % 2).alias("disp_id"),
        u.alias("client_id"),
        (u % 60).alias("account_id"),
        F.when(eid % 7 == 0, F.lit("DISPONENT")).otherwise(F.lit("OWNER")).alias("type"),
        F.when(deleted, F.lit("d")).otherwise(F.lit("u")).alias("__op"),
        eid.alias("__lsn"),
        F.floor(_ts_ms(F.col("ts"))).cast("bigint").alias("__source_ts_ms"),
        F.when(deleted, F.lit("true")).otherwise(F.lit("false")).alias("__deleted"),
    )


@dataclass
class RawTables:
    district: DataFrame
    account: DataFrame
    client: DataFrame
    disposition: DataFrame
    trans: DataFrame


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    return RawTables(
        district=raw_district(spark, sf_dir),
        account=raw_account(spark, sf_dir),
        client=raw_client(spark, sf_dir),
        disposition=raw_disposition(spark, sf_dir),
        trans=raw_trans(spark, sf_dir),
    )
