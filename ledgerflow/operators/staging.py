"""Staging models: dedupe, rename, prune and decode (W-1, P-1, F-1 ... F-7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes, dates


def dedupe_first(df: DataFrame, key: str | list[str], order: list[str] | None = None) -> DataFrame:
    """W-1: keep one row per key, the first by ``order`` (first-wins).

    ``row_number() = 1`` lets Catalyst insert a partial ``WindowGroupLimit``
    before the shuffle, so only the first row per key and map task is shuffled.
    Without an order column the survivor is an arbitrary but fixed copy (the
    reference leaves it arbitrary).
    """
    keys = [key] if isinstance(key, str) else list(key)
    # Ties (no order column, or equal order values) are broken by a hash of the
    # whole row, so a retried task picks the same survivor (deterministic plan).
    row_hash = F.xxhash64(*[F.col(c) for c in df.columns])
    order_cols = [F.col(c) for c in (order or [])] + [row_hash]
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return (df.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).drop("_rn"))


def stage_trans(raw: DataFrame, strict: bool = True) -> DataFrame:
    order = ["ingest_seq"] if "ingest_seq" in raw.columns else None
    deduped = dedupe_first(raw, "trans_id", order)
    return deduped.select(
        F.col("trans_id").cast("bigint").alias("trans_id"),
        F.col("account_id").cast("bigint").alias("account_id"),
        dates.transaction_date("date", strict).alias("transaction_date"),
        F.col("type").alias("transaction_type"),
        F.col("operation"),
        F.col("amount").cast("double").alias("amount"),
        F.col("balance").cast("double").alias("balance"),
        codes.empty_to_null("k_symbol").alias("k_symbol"),
        F.col("bank"),
        F.col("account").alias("counterpart_account"),
    )


def stage_account(raw: DataFrame, strict: bool = True) -> DataFrame:
    return raw.select(
        F.col("account_id").cast("bigint").alias("account_id"),
        F.col("district_id").cast("bigint").alias("district_id"),
        F.col("frequency"),
        dates.account_open_date("date", strict).alias("account_open_date"),
    )


def stage_client(raw: DataFrame, strict: bool = True) -> DataFrame:
    born = raw.select(
        F.col("client_id").cast("bigint").alias("client_id"),
        F.col("district_id").cast("bigint").alias("district_id"),
        F.col("birth_number").cast("bigint").alias("birth_number"),
        dates.gender("birth_number").alias("gender"),
        dates.birth_date("birth_number", strict).alias("birth_date"),
    )
    # Age derives from the decoded date once (no repeated decoding).
    return born.withColumn("age_at_end_of_dataset", dates.age_at_end_of_dataset("birth_date"))


def stage_disposition(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("disp_id").cast("bigint").alias("disp_id"),
        F.col("client_id").cast("bigint").alias("client_id"),
        F.col("account_id").cast("bigint").alias("account_id"),
        F.col("type").alias("disposition_type"),
    )


def stage_district(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("district_id").cast("bigint").alias("district_id"),
        F.col("name").alias("district_name"),
        F.col("region"),
        F.col("num_inhabitants").cast("bigint").alias("num_inhabitants"),
        F.col("avg_salary").cast("double").alias("avg_salary"),
        F.col("unemployment_rate_95").cast("double").alias("unemployment_rate_95"),
        F.col("unemployment_rate_96").cast("double").alias("unemployment_rate_96"),
        F.col("num_crimes_95").cast("bigint").alias("num_crimes_95"),
        F.col("num_crimes_96").cast("bigint").alias("num_crimes_96"),
    )
