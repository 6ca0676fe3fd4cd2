"""CDC compaction queries (ST-1, ST-2, A-7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cdc
from ..schemas import STATE_KEYS
from ..sources import cdc as cdc_src
from ..sources import testdata as td
from . import oracle as O
from .catalog import register

_LATEST_CLIENT_SQL = O.with_base("""
    SELECT client_id, birth_number, district_id, __op, __lsn, __source_ts_ms, __deleted
    FROM (SELECT *, row_number() OVER (PARTITION BY client_id
                                       ORDER BY __lsn DESC, __source_ts_ms DESC) AS rn
          FROM cdc_client_log WHERE client_id IS NOT NULL)
    WHERE rn = 1 AND NOT (__deleted = 'true' OR __op = 'd')""")


@register("cdc_latest_client", _LATEST_CLIENT_SQL)
def cdc_latest_client(spark, sf_dir):
    return cdc.compact(td.cdc_client(spark, sf_dir), "client_id")


_OWNER_SQL = O.with_base("""
    SELECT account_id, client_id, disp_id, __lsn FROM (
      SELECT *, row_number() OVER (PARTITION BY account_id
                                   ORDER BY __lsn DESC, __source_ts_ms DESC, disp_id DESC) AS rn2
      FROM (SELECT *, row_number() OVER (PARTITION BY disp_id
                                         ORDER BY __lsn DESC, __source_ts_ms DESC) AS rn
            FROM cdc_disposition_log WHERE disp_id IS NOT NULL)
      WHERE rn = 1 AND NOT (__deleted = 'true' OR __op = 'd') AND type = 'OWNER')
    WHERE rn2 = 1""")


@register("cdc_owner_link", _OWNER_SQL)
def cdc_owner_link(spark, sf_dir):
    return cdc.owner_links(td.cdc_disposition(spark, sf_dir))


def _counts_sql(name: str, log: str, key: str) -> str:
    return f"""
    SELECT '{name}' AS table_name, CAST(sum(n) AS BIGINT) AS log_rows,
      CAST(count(*) FILTER (WHERE k IS NOT NULL) AS BIGINT) AS keys_seen,
      CAST(count(*) FILTER (WHERE k IS NOT NULL AND NOT gone) AS BIGINT) AS live_rows,
      CAST(count(*) FILTER (WHERE k IS NOT NULL AND gone) AS BIGINT) AS tombstones
    FROM (SELECT {key} AS k, count(*) AS n,
            arg_max(__deleted = 'true' OR __op = 'd', (__lsn, __source_ts_ms)) AS gone
          FROM {log} GROUP BY {key})"""


@register("cdc_state_counts", O.with_base(
    _counts_sql("client", "cdc_client_log", "client_id") + "\nUNION ALL\n"
    + _counts_sql("disposition", "cdc_disposition_log", "disp_id") + "\nUNION ALL\n"
    + _counts_sql("trans", "cdc_trans_log", "trans_id") + "".join(
        f"\nUNION ALL\nSELECT '{t}', CAST(count(*) AS BIGINT), CAST(count(*) AS BIGINT), CAST(count(*) AS BIGINT), "
        f"CAST(0 AS BIGINT) FROM raw_{t}" for t in ("account", "district"))))
def cdc_state_counts(spark, sf_dir):
    """A-7 for all tables: change logs, and the snapshot of those that have no other changes here."""
    raw = td.raw_tables(spark, sf_dir)
    snapshot = cdc_src.snapshot_changes({"account": raw.account, "district": raw.district})
    counts = _log_counts(spark, sf_dir)
    for t in ("account", "district"):
        counts = counts.unionByName(cdc.state_counts(t, snapshot.where(F.col("__table") == t), STATE_KEYS[t]))
    return counts


def _log_counts(spark, sf_dir):
    return (cdc.state_counts("client", td.cdc_client(spark, sf_dir), "client_id")
            .unionByName(cdc.state_counts("disposition", td.cdc_disposition(spark, sf_dir), "disp_id"))
            .unionByName(cdc.state_counts("trans", td.cdc_trans(spark, sf_dir), "trans_id")))

