"""DuckDB SQL that states each registered query independently of Spark.

The supplied tables are pre-registered views in the checking engine; the
adapter (``ledgerflow.sources.testdata``) is restated here as CTEs with the
same formulas, so each oracle string is self-contained.
"""

from __future__ import annotations

import math

from ..functions.codes import MISSING_OPERATION, TYPE_BY_OPERATION
from ..sources import testdata as td


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case(col: str, mapping: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN {col} = {_sql_str(k)} THEN {_sql_str(v)}" for k, v in mapping.items())
    return f"CASE {whens} ELSE {default} END"


def type_of_operation_sql(op_key: str) -> str:
    return _case(op_key, TYPE_BY_OPERATION, "NULL")


def yymmdd_sql(ts: str) -> str:
    return f"CAST(strftime(CAST({ts} AS DATE), '%y%m%d') AS BIGINT)"


def parse_yyyymmdd(text: str) -> str:
    return f"CAST(strptime({text}, '%Y%m%d') AS DATE)"


def pad6(x: str) -> str:
    return f"lpad(CAST({x} AS VARCHAR), 6, '0')"


def trans_date_sql(x: str) -> str:
    p = pad6(x)
    return parse_yyyymmdd(f"(CASE WHEN {p} LIKE '0%' THEN '20' ELSE '19' END) || {p}")


def account_date_sql(x: str) -> str:
    p = pad6(x)
    return parse_yyyymmdd(f"(CASE WHEN {p} LIKE '9%' THEN '19' ELSE '20' END) || {p}")


def female_sql(b: str) -> str:
    return f"(({b}) % 10000) / 100 > 50"


def birth_date_sql(b: str) -> str:
    plain = f"(CASE WHEN {female_sql(b)} THEN {b} - 5000 ELSE {b} END)"
    return parse_yyyymmdd(f"'19' || {pad6(plain)}")


def hash52_sql(salt: str, *keys: str) -> str:
    text = " || ':' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"CAST(('0x' || substr(md5({_sql_str(salt + ':')} || {text}), 1, 13)) AS BIGINT)"


def uniform_sql(salt: str, *keys: str) -> str:
    return f"(CAST({hash52_sql(salt, *keys)} AS DOUBLE) / {float(2 ** 52)!r})"


def uniform_open_sql(salt: str, *keys: str) -> str:
    return f"((CAST({hash52_sql(salt, *keys)} AS DOUBLE) + 1.0) / {float(2 ** 52 + 1)!r})"


def uniform_int_sql(salt: str, bound: str, *keys: str) -> str:
    return f"CAST(floor({uniform_sql(salt, *keys)} * CAST({bound} AS DOUBLE)) AS BIGINT)"


def normal_sql(salt: str, *keys: str) -> str:
    u1 = uniform_open_sql(salt + ":u1", *keys)
    u2 = uniform_sql(salt + ":u2", *keys)
    return f"(sqrt(-2.0 * ln({u1})) * cos({2.0 * math.pi!r} * {u2}))"


def bucket_sql(bits: int, *keys: str, salt: str = "bucket") -> str:
    return f"({hash52_sql(salt, *keys)} >> {52 - bits})"


def round_half_up_sql(x: str, digits: int) -> str:
    scale = float(10 ** digits)
    return f"(floor(({x}) * {scale!r} + 0.5) / {scale!r})"


# --------------------------------------------------------------------------
# Adapter CTEs
# --------------------------------------------------------------------------

def _trans_select(copy: bool) -> str:
    low = "CASE WHEN o_orderkey % 2 = 1 THEN 'VYBER' ELSE NULL END"
    op = _case("o_orderpriority", td.OPERATION_BY_PRIORITY, low)
    transfer = f"({op}) IN ({', '.join(_sql_str(x) for x in td.TRANSFER_OPERATIONS)})"
    k_symbol = (f"CASE WHEN o_orderkey % {td.SPACE_KSYMBOL_MOD} = {td.SPACE_KSYMBOL_REM} THEN ' ' "
                "WHEN o_orderstatus = 'F' THEN 'SIPO' WHEN o_orderstatus = 'O' THEN '' ELSE NULL END")
    account = "CAST(o_custkey AS BIGINT)"
    if copy:
        account += " + 1"
        k_symbol = "CAST(NULL AS VARCHAR)"
    return f"""SELECT CAST(o_orderkey AS BIGINT) AS trans_id,
        {account} AS account_id,
        {yymmdd_sql('o_orderdate')} AS date,
        {type_of_operation_sql(f"coalesce({op}, {_sql_str(MISSING_OPERATION)})")} AS type,
        {op} AS operation,
        CAST(o_totalprice AS DOUBLE) AS amount,
        CASE WHEN o_orderkey % {td.NULL_BALANCE_MOD} = {td.NULL_BALANCE_REM} THEN NULL
             ELSE o_totalprice * 2.0 END AS balance,
        {k_symbol} AS k_symbol,
        CASE WHEN {transfer} THEN (['AB', 'CD', 'EF'])[CAST(o_orderkey % 3 + 1 AS INTEGER)] END AS bank,
        CASE WHEN {transfer} THEN CAST(CAST(o_custkey AS BIGINT) * 1000 + 17 AS VARCHAR) END AS account,
        CAST({1 if copy else 0} AS BIGINT) AS ingest_seq
      FROM orders"""


def _ts_ms(ts: str) -> str:
    return f"CAST(floor(epoch_us(CAST({ts} AS TIMESTAMP)) / 1000) AS BIGINT)"


def _birth_number(k: str) -> str:
    return f"((20 + {k} % 60) * 10000 + ({k} % 12 + 1 + ({k} % 2) * 50) * 100 + {k} % 28 + 1)"


ADAPTER = {
    "raw_district": f"""
      SELECT CAST(n_nationkey AS BIGINT) AS district_id, n_name AS name, r_name AS region,
        50000 + 7919 * CAST(n_nationkey AS BIGINT) AS num_inhabitants,
        CAST(n_nationkey AS BIGINT) % 7 * 10 AS num_municipalities_lt_499,
        CAST(n_nationkey AS BIGINT) % 5 * 4 AS num_municipalities_500_1999,
        CAST(n_nationkey AS BIGINT) % 3 + 1 AS num_municipalities_2000_9999,
        CAST(n_nationkey AS BIGINT) % 2 AS num_municipalities_gt_10000,
        CAST(n_nationkey AS BIGINT) % 9 + 1 AS num_cities,
        40.0::DOUBLE + 2.5::DOUBLE * n_nationkey AS ratio_urban,
        CASE WHEN n_nationkey = {td.ZERO_SALARY_DISTRICT} THEN 0.0::DOUBLE
             ELSE 8000.0::DOUBLE + 137.0::DOUBLE * n_nationkey END AS avg_salary,
        0.25::DOUBLE * (n_nationkey % 12) AS unemployment_rate_95,
        0.25::DOUBLE * (n_nationkey % 12) + 0.5::DOUBLE AS unemployment_rate_96,
        100.0::DOUBLE + n_nationkey AS num_entrepreneurs_per_1000,
        CASE WHEN n_nationkey = {td.NULL_CRIMES_DISTRICT} THEN NULL
             ELSE 1000 + 53 * CAST(n_nationkey AS BIGINT) END AS num_crimes_95,
        1100 + 59 * CAST(n_nationkey AS BIGINT) AS num_crimes_96
      FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
      WHERE n_nationkey <> {td.DROPPED_DISTRICT}""",
    "raw_account": f"""
      SELECT CAST(c_custkey AS BIGINT) AS account_id,
        CAST(c_custkey AS BIGINT) * 7 % 25 AS district_id,
        {_case('c_mktsegment', td.FREQUENCY_BY_SEGMENT, _sql_str(td.DEFAULT_FREQUENCY))} AS frequency,
        (93 + CAST(c_custkey AS BIGINT) % 5) * 10000 + (CAST(c_custkey AS BIGINT) % 12 + 1) * 100
          + CAST(c_custkey AS BIGINT) % 28 + 1 AS date
      FROM customer WHERE c_custkey % {td.ORPHAN_ACCOUNT_MOD} <> {td.ORPHAN_ACCOUNT_REM}""",
    "raw_client": f"""
      SELECT CAST(c_custkey AS BIGINT) AS client_id,
        {_birth_number('CAST(c_custkey AS BIGINT)')} AS birth_number,
        CAST(c_nationkey AS BIGINT) AS district_id
      FROM customer""",
    "raw_disposition": f"""
      SELECT CAST(c_custkey AS BIGINT) * 2 AS disp_id, CAST(c_custkey AS BIGINT) AS client_id,
        CAST(c_custkey AS BIGINT) AS account_id, 'OWNER' AS type
      FROM customer WHERE c_custkey % {td.NO_OWNER_MOD} <> {td.NO_OWNER_REM}
      UNION ALL
      SELECT CAST(c_custkey AS BIGINT) * 2 + 1, greatest(CAST(c_custkey AS BIGINT) - 1, 0),
        CAST(c_custkey AS BIGINT), 'DISPONENT'
      FROM customer WHERE c_custkey % {td.DISPONENT_MOD} = 0""",
    "raw_trans": f"""
      {_trans_select(False)}
      UNION ALL
      {_trans_select(True)} WHERE o_orderkey % {td.DUPLICATE_MOD} = 0""",
    "cdc_trans_log": f"""
      SELECT CAST(event_id AS BIGINT) AS trans_id,
        CASE WHEN event_id % 100 = 0 THEN NULL
             WHEN event_id % 50 = 1 THEN CAST(user_id AS BIGINT) + {td.FAKE_STREAM_ACCOUNT}
             ELSE CAST(user_id AS BIGINT) END AS account_id,
        {yymmdd_sql('ts')} AS date, 'PRIJEM' AS type, 'VKLAD' AS operation,
        CAST(value AS DOUBLE) AS amount, CAST(NULL AS DOUBLE) AS balance,
        CASE WHEN event_id % 3 = 0 THEN 'SIPO' ELSE '' END AS k_symbol,
        CAST(NULL AS VARCHAR) AS bank, CAST(NULL AS VARCHAR) AS account,
        {_case('event_type', td.OP_BY_EVENT, "'c'")} AS __op, 'trans' AS __table,
        CAST(event_id AS BIGINT) AS __lsn, {_ts_ms('ts')} AS __source_ts_ms,
        CASE WHEN ({_case('event_type', td.OP_BY_EVENT, "'c'")}) = 'd' THEN 'true' ELSE 'false' END AS __deleted
      FROM events""",
    "cdc_client_log": f"""
      SELECT CAST(user_id AS BIGINT) AS client_id,
        {_birth_number('CAST(user_id AS BIGINT)')} AS birth_number,
        CAST(event_id AS BIGINT) % 25 AS district_id,
        CASE WHEN event_id % 40 = 3 THEN 'd' WHEN event_id % 7 = 0 THEN 'c' ELSE 'u' END AS __op,
        CAST(event_id AS BIGINT) AS __lsn, {_ts_ms('ts')} AS __source_ts_ms,
        CASE WHEN event_id % 40 = 3 THEN 'true' ELSE 'false' END AS __deleted
      FROM events""",
    "cdc_disposition_log": f"""
      SELECT CAST(user_id AS BIGINT) * 3 + CAST(event_id AS BIGINT) % 2 AS disp_id,
        CAST(user_id AS BIGINT) AS client_id, CAST(user_id AS BIGINT) % 60 AS account_id,
        CASE WHEN event_id % 7 = 0 THEN 'DISPONENT' ELSE 'OWNER' END AS type,
        CASE WHEN event_id % 45 = 4 THEN 'd' ELSE 'u' END AS __op,
        CAST(event_id AS BIGINT) AS __lsn, {_ts_ms('ts')} AS __source_ts_ms,
        CASE WHEN event_id % 45 = 4 THEN 'true' ELSE 'false' END AS __deleted
      FROM events""",
}

STAGING = {
    "stg_trans": f"""
      SELECT trans_id, account_id, {trans_date_sql('date')} AS transaction_date,
        type AS transaction_type, operation, amount, balance,
        nullif(k_symbol, '') AS k_symbol, bank, account AS counterpart_account
      FROM (SELECT *, row_number() OVER (PARTITION BY trans_id ORDER BY ingest_seq) AS rn
            FROM raw_trans) WHERE rn = 1""",
    "stg_account": f"""
      SELECT account_id, district_id, frequency, {account_date_sql('date')} AS account_open_date
      FROM raw_account""",
    "stg_client": f"""
      SELECT client_id, district_id, birth_number,
        CASE WHEN {female_sql('birth_number')} THEN 'F' ELSE 'M' END AS gender,
        {birth_date_sql('birth_number')} AS birth_date,
        CAST(1998 - year({birth_date_sql('birth_number')}) AS BIGINT) AS age_at_end_of_dataset
      FROM raw_client""",
    "stg_disposition": """
      SELECT disp_id, client_id, account_id, type AS disposition_type FROM raw_disposition""",
    "stg_district": """
      SELECT district_id, name AS district_name, region, num_inhabitants, avg_salary,
        unemployment_rate_95, unemployment_rate_96, num_crimes_95, num_crimes_96
      FROM raw_district""",
    # Hop 1: the client that owns an account.  Hop 2: that client.  Hop 3: the client's district, where there is one.
    "owner_of_account": """
      SELECT account_id, client_id FROM stg_disposition WHERE disposition_type = 'OWNER'""",
    "owning_client": """
      SELECT owner_of_account.account_id, stg_client.* FROM stg_client INNER JOIN owner_of_account USING (client_id)""",
    "customer_profile": """
      SELECT account_id, acc.district_id AS account_district_id, frequency, account_open_date, client_id, gender, birth_date,
        age_at_end_of_dataset, own.district_id AS client_district_id, home.* EXCLUDE (district_id)
      FROM owning_client own INNER JOIN stg_account acc USING (account_id)
      LEFT OUTER JOIN stg_district home ON home.district_id = own.district_id""",
    "fct_enriched_transactions": """
      SELECT t.trans_id, t.account_id, t.transaction_date, t.transaction_type, t.operation,
        t.amount, t.balance, t.k_symbol, p.client_id, p.gender, p.birth_date,
        p.age_at_end_of_dataset, p.frequency AS account_frequency, p.account_open_date,
        p.district_name, p.region, p.avg_salary, p.unemployment_rate_96,
        t.amount / nullif(p.avg_salary, 0) AS amount_to_avg_salary_ratio
      FROM stg_trans t JOIN customer_profile p ON t.account_id = p.account_id""",
}


def with_base(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the adapter + staging CTEs (unused ones cost nothing)."""
    ctes = {**ADAPTER, **STAGING, **(extra or {})}
    parts = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items())
    return f"WITH {parts}\n{body}"
