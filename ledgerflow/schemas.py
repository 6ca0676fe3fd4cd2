"""Explicit schemas for the five source tables, file layouts and outputs.

Ids are LongType throughout (fake orphan ids start at max + 100,000); money is
DoubleType so that row-level ratios stay plain doubles.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, I, S, D, DT, B = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.DateType(), T.BooleanType()


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# The tables' columns and types, the change records' and the outputs' fields.
DISTRICT = _struct(
    ("district_id", L, False), ("name", S, False), ("region", S, True),
    ("num_inhabitants", L, True),
    ("num_municipalities_lt_499", L, True), ("num_municipalities_500_1999", L, True),
    ("num_municipalities_2000_9999", L, True), ("num_municipalities_gt_10000", L, True),
    ("num_cities", L, True), ("ratio_urban", D, True), ("avg_salary", D, True),
    ("unemployment_rate_95", D, True), ("unemployment_rate_96", D, True),
    ("num_entrepreneurs_per_1000", D, True), ("num_crimes_95", L, True), ("num_crimes_96", L, True),
)

ACCOUNT = _struct(("account_id", L, False), ("district_id", L, False),
                  ("frequency", S, False), ("date", L, False))

CLIENT = _struct(("client_id", L, False), ("birth_number", L, False), ("district_id", L, False))

DISPOSITION = _struct(("disp_id", L, False), ("client_id", L, False),
                      ("account_id", L, False), ("type", S, False))

# Canonical column order of the transaction table.
TRANS = _struct(
    ("trans_id", L, False), ("account_id", L, True), ("date", L, False), ("type", S, False),
    ("operation", S, True), ("amount", D, False), ("balance", D, True), ("k_symbol", S, True),
    ("bank", S, True), ("account", S, True),
)
TRANS_COLUMNS = [f.name for f in TRANS.fields]

# File layout of the load-test CSV (k_symbol before balance); bound by position.
TRANS_LOADTEST_LAYOUT = ["trans_id", "account_id", "date", "type", "operation", "amount",
                         "k_symbol", "balance", "bank", "account"]


def layout_schema(columns: list[str], base: T.StructType = TRANS) -> T.StructType:
    """Schema for a file whose columns come in ``columns`` order (SRC-2)."""
    by_name = {f.name: f for f in base.fields}
    return T.StructType([T.StructField(c, by_name[c].dataType, True) for c in columns])


# CDC after-image of a transaction (decimals arrive as doubles).
CDC_TRANS = _struct(
    ("trans_id", L, True), ("account_id", L, True), ("date", L, True), ("type", S, True),
    ("operation", S, True), ("amount", D, True), ("balance", D, True), ("k_symbol", S, True),
    ("bank", S, True), ("account", S, True),
    ("__op", S, True), ("__table", S, True), ("__lsn", L, True), ("__source_ts_ms", L, True),
    ("__deleted", S, True),
)

# Union of the four profile tables' after-images, routed by topic suffix.
CDC_PROFILE = _struct(
    ("account_id", L, True), ("client_id", L, True), ("disp_id", L, True), ("district_id", L, True),
    ("birth_number", L, True), ("frequency", S, True), ("date", L, True), ("type", S, True),
    ("name", S, True), ("region", S, True), ("avg_salary", D, True), ("num_inhabitants", L, True),
    ("__op", S, True), ("__table", S, True), ("__lsn", L, True), ("__source_ts_ms", L, True),
    ("__deleted", S, True),
)

ENRICHED_FIELDS = [
    "trans_id", "account_id", "date", "type", "operation", "amount", "balance", "k_symbol",
    "client_id", "birth_number", "account_frequency", "district_name", "district_region",
    "avg_salary", "__op", "__lsn", "__source_ts_ms", "__enriched",
]

# Profile tables, their keys, and the columns of their change records.
STATE_KEYS = {"account": "account_id", "client": "client_id", "disposition": "disp_id",
              "district": "district_id"}
STATE_COLUMNS = {
    "account": ["account_id", "district_id", "frequency", "date"],
    "client": ["client_id", "birth_number", "district_id"],
    "disposition": ["disp_id", "client_id", "account_id", "type"],
    "district": ["district_id", "name", "region", "avg_salary", "num_inhabitants"],
}

DQ_RESULT = _struct(("test", S, False), ("table_name", S, False), ("column_name", S, True),
                    ("severity", S, False), ("failures", L, False), ("status", S, False))
