"""Batch build queries: staging, profile, mart and its counts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import mart, staging
from ..session import scratch_path
from ..operators import profile as profile_ops
from ..sources import testdata as td
from . import oracle as O
from .catalog import register, staged


@register("fct_enriched_transactions", O.with_base("SELECT * FROM fct_enriched_transactions"))
def fct_enriched_transactions(spark, sf_dir):
    return mart.fct_enriched_transactions(td.raw_tables(spark, sf_dir))


@register("stage_trans", O.with_base("SELECT * FROM stg_trans"))
def stage_trans(spark, sf_dir):
    return staging.stage_trans(td.raw_trans(spark, sf_dir))


@register("stage_account", O.with_base("SELECT * FROM stg_account"))
def stage_account(spark, sf_dir):
    return staging.stage_account(td.raw_account(spark, sf_dir))


@register("stage_client", O.with_base("SELECT * FROM stg_client"))
def stage_client(spark, sf_dir):
    return staging.stage_client(td.raw_client(spark, sf_dir))


@register("stage_disposition", O.with_base("SELECT * FROM stg_disposition"))
def stage_disposition(spark, sf_dir):
    return staging.stage_disposition(td.raw_disposition(spark, sf_dir))


@register("stage_district", O.with_base("SELECT * FROM stg_district"))
def stage_district(spark, sf_dir):
    return staging.stage_district(td.raw_district(spark, sf_dir))


@register("customer_profile", O.with_base("SELECT * FROM customer_profile"))
def customer_profile(spark, sf_dir):
    st = staged(spark, sf_dir)
    return profile_ops.customer_profile(st.account, st.disposition, st.client, st.district)


@register("mart_counts", O.with_base("""
    SELECT CAST(count(*) AS BIGINT) AS staged_rows,
      CAST(count(*) FILTER (WHERE p.account_id IS NOT NULL) AS BIGINT) AS mart_rows,
      CAST(count(*) FILTER (WHERE p.account_id IS NULL) AS BIGINT) AS excluded_rows,
      CAST(count(*) FILTER (WHERE p.account_id IS NULL AND t.account_id IS NULL) AS BIGINT)
        AS excluded_null_account
    FROM stg_trans t LEFT JOIN customer_profile p ON t.account_id = p.account_id"""))
def mart_counts(spark, sf_dir):
    st = staged(spark, sf_dir)
    return mart.mart_counts(st.trans, mart.profile_of(st))


@register("trans_excluded", O.with_base("""
    SELECT t.* FROM stg_trans t
    WHERE NOT EXISTS (SELECT 1 FROM customer_profile p WHERE p.account_id = t.account_id)"""))
def trans_excluded(spark, sf_dir):
    st = staged(spark, sf_dir)
    return mart.excluded_transactions(st.trans, mart.profile_of(st))


@register("mart_materialized", O.with_base(
    "SELECT *, strftime(transaction_date, '%Y-%m') AS transaction_month "
    "FROM fct_enriched_transactions"))
def mart_materialized(spark, sf_dir):
    """SNK-6: the mart written as a month-partitioned table and read back."""
    path = scratch_path(spark, "mart")
    mart.write_mart(mart.fct_enriched_transactions(td.raw_tables(spark, sf_dir)), path)
    back = spark.read.option("basePath", path).parquet(path)
    return back.select(*mart.MART_COLUMNS, back["transaction_month"].cast("string"))


MONTH_AGAIN = "1997-03"


@register("mart_catalog", O.with_base(f"""
    SELECT f.account_id, p.district_name, CAST(count(*) AS BIGINT) AS transactions, max(f.amount) AS largest,
      CAST(count(*) FILTER (WHERE strftime(f.transaction_date, '%Y-%m') = '{MONTH_AGAIN}') AS BIGINT) AS in_month
    FROM fct_enriched_transactions f JOIN customer_profile p ON p.account_id = f.account_id
    GROUP BY f.account_id, p.district_name"""))
def mart_catalog(spark, sf_dir):
    """SNK-6 as catalog objects: views for staging and profile; the mart is a table partitioned by month and bucketed by
    account, first without one month, which is then put in by dynamic partition overwrite (twice: it replaces itself).
    The join with the profile, bucketed alike, needs no exchange of either side."""
    name = f"ledgerflow_{uuid.uuid4().hex[:12]}"
    st = staged(spark, sf_dir)
    mart.create_views(st, mart.profile_of(st), f"{name}_")
    fact = mart.fct_enriched_transactions(td.raw_tables(spark, sf_dir))
    month = F.date_format("transaction_date", "yyyy-MM") == MONTH_AGAIN
    mart.save_mart(fact.where(~month), f"{name}_mart", scratch_path(spark, "mart-table"))
    for _ in range(2):
        mart.replace_months(fact.where(month), f"{name}_mart")
    mart.save_bucketed(spark.table(f"{name}_customer_profile"), f"{name}_profile", scratch_path(spark, "profile-table"))
    joined = spark.table(f"{name}_mart").join(spark.table(f"{name}_profile").select("account_id", F.col("district_name").alias("district")),
                                              "account_id")
    return (joined.groupBy("account_id", F.col("district").alias("district_name"))
            .agg(F.count("*").alias("transactions"), F.max("amount").alias("largest"),
                 F.count_if(F.col("transaction_month") == MONTH_AGAIN).alias("in_month")))
