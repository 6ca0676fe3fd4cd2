"""Driver contract: entry() runs, every query is registered, and a sample of
queries equals its DuckDB oracle on the smallest supplied tables."""
import math
import re

import duckdb
import pytest

import __spark_entry__ as entry

from .conftest import SMALL

TABLES = ["region", "nation", "customer", "orders", "events"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "amount_to_avg_salary_ratio" in df.columns


EXPECTED_QUERIES = [
    "cdc_envelope",
    "cdc_latest_client",
    "cdc_owner_link",
    "cdc_state_counts",
    "corrupt_audit_summary",
    "corrupt_duplicates",
    "corrupt_missing",
    "corrupt_orphans",
    "corrupted_transactions",
    "csv_round_trip",
    "customer_profile",
    "dlq_by_reason",
    "dlq_json",
    "dlq_rerun",
    "domain_split",
    "dq_accepted_values",
    "dq_dirty_rejects",
    "dq_dirty_rules",
    "dq_domain_rejects",
    "dq_foreign_keys",
    "dq_not_null",
    "dq_relationships",
    "dq_summary",
    "dq_unique",
    "enrich_batch",
    "enriched_json",
    "fct_enriched_transactions",
    "fit_account_weights",
    "fit_dirty_scalars",
    "fit_from_csv",
    "fit_k_symbol",
    "fit_operation",
    "fit_scalars",
    "full_refresh_load",
    "full_refresh_switch",
    "idempotent_append",
    "load_audit",
    "manifest_missing_sample",
    "manifest_summary",
    "mart_catalog",
    "mart_counts",
    "mart_materialized",
    "profile_district_fallback",
    "profile_topics_routed",
    "reconcile_corruption",
    "reconcile_quality",
    "reconcile_rows",
    "stage_account",
    "stage_client",
    "stage_disposition",
    "stage_district",
    "stage_trans",
    "stream_deduplicated",
    "stream_dlq",
    "stream_end_to_end",
    "stream_enriched",
    "stream_gate",
    "stream_listener_metrics",
    "stream_metrics",
    "stream_profile_state",
    "stream_recovery",
    "stream_replay",
    "synth_export_round_trip",
    "synth_transactions",
    "trans_excluded",
]


def test_every_query_is_registered_with_an_oracle():
    # The training-data queries (op<N>_..., pipeline) are optional and have tests of their own.
    own = [n for n in entry.queries() if not re.match(r"op\d+_|pipeline$", n)]
    oracles = [n for n in entry.oracle_sql() if not re.match(r"op\d+_|pipeline$", n)]
    assert sorted(own) == EXPECTED_QUERIES
    assert sorted(oracles) == EXPECTED_QUERIES


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return None if v is None else str(v)


@pytest.mark.parametrize("name", ["fct_enriched_transactions", "customer_profile", "dq_summary",
                                  "cdc_owner_link", "fit_operation", "synth_transactions",
                                  "corrupt_orphans", "stream_enriched",
                                  "reconcile_quality", "load_audit", "reconcile_rows", "fit_from_csv", "full_refresh_switch",
                                  "mart_catalog", "stream_gate", "stream_recovery", "stream_deduplicated",
                                  "stream_listener_metrics"])
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    cur = con.execute(entry.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    df = entry.queries()[name](spark, SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(d_cols)

    def canon(cols, rows):
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=str)
    assert canon(df.columns, s_rows) == canon(d_cols, d_rows)


def test_entry_without_the_optional_modules():
    """The library and its queries work where the training-data subpackage isn't installed."""
    import subprocess
    import sys
    code = ("import sys; sys.modules['ledgerflow.llm'] = None; sys.modules['corpus_pipeline'] = None; "
            "import __spark_entry__ as e; n = sorted(e.queries()); assert n == sorted(e.oracle_sql()), n; print(len(n))")
    root = entry.__file__.rsplit("/", 1)[0]
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0 and int(out.stdout) == len(EXPECTED_QUERIES), out.stderr
