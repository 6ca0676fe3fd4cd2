"""Enriched fact table (J-4, P-3, F-8) and its counts (A-8, J-8)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import guarded_ratio
from . import profile as profile_ops
from . import staging

MART_COLUMNS = [
    "trans_id", "account_id", "transaction_date", "transaction_type", "operation", "amount",
    "balance", "k_symbol", "client_id", "gender", "birth_date", "age_at_end_of_dataset",
    "account_frequency", "account_open_date", "district_name", "region", "avg_salary",
    "unemployment_rate_96", "amount_to_avg_salary_ratio",
]


@dataclass
class StagedTables:
    trans: DataFrame
    account: DataFrame
    client: DataFrame
    disposition: DataFrame
    district: DataFrame


def stage_all(raw) -> StagedTables:
    return StagedTables(
        trans=staging.stage_trans(raw.trans),
        account=staging.stage_account(raw.account),
        client=staging.stage_client(raw.client),
        disposition=staging.stage_disposition(raw.disposition),
        district=staging.stage_district(raw.district),
    )


def profile_of(st: StagedTables) -> DataFrame:
    return profile_ops.customer_profile(st.account, st.disposition, st.client, st.district)


def enriched_transactions(trans: DataFrame, profile: DataFrame) -> DataFrame:
    """Inner join on account_id: transactions without a profile are excluded by design.

    The fact side is shuffled once on account_id (after the trans_id dedupe
    shuffle); AQE splits a hot account's partition (skew join) and replaces the
    join by a broadcast only when the profile's measured size is small.
    """
    p = profile.select(
        "account_id", "client_id", "gender", "birth_date", "age_at_end_of_dataset",
        F.col("frequency").alias("account_frequency"), "account_open_date",
        "district_name", "region", "avg_salary", "unemployment_rate_96")
    t = trans.select("trans_id", "account_id", "transaction_date", "transaction_type",
                     "operation", "amount", "balance", "k_symbol")
    return (t.join(p, "account_id", "inner")
            .withColumn("amount_to_avg_salary_ratio", guarded_ratio("amount", "avg_salary"))
            .select(*MART_COLUMNS))


def fct_enriched_transactions(raw) -> DataFrame:
    st = stage_all(raw)
    return enriched_transactions(st.trans, profile_of(st))


def excluded_transactions(trans: DataFrame, profile: DataFrame) -> DataFrame:
    """J-8 / A-8: staged transactions that the mart drops (no profile for the account)."""
    # Rows without an account never have a profile; in the join they would all go to one task.
    with_key = trans.where(F.col("account_id").isNotNull())
    return (with_key.join(profile.select("account_id"), "account_id", "left_anti")
            .unionByName(trans.where(F.col("account_id").isNull())))


def mart_counts(trans: DataFrame, profile: DataFrame) -> DataFrame:
    """One row: staged, enriched and excluded row counts (A-8, J-8).

    Fact rows are counted per account first (map-side combine), so the join
    runs over distinct accounts instead of transactions and a hot account is
    one row; profile multiplicity per account is kept, so ``mart_rows`` equals
    the inner join's row count.
    """
    per_account = trans.groupBy("account_id").agg(F.count(F.lit(1)).alias("n"))
    matches = profile.groupBy("account_id").agg(F.count(F.lit(1)).alias("m"))
    joined = per_account.join(matches, "account_id", "left")
    zero = F.lit(0).cast("bigint")
    return joined.agg(
        F.coalesce(F.sum("n"), zero).cast("bigint").alias("staged_rows"),
        F.coalesce(F.sum(F.col("n") * F.coalesce(F.col("m"), zero)), zero).cast("bigint")
         .alias("mart_rows"),
        F.coalesce(F.sum(F.when(F.col("m").isNull(), F.col("n"))), zero).cast("bigint")
         .alias("excluded_rows"),
        F.coalesce(F.sum(F.when(F.col("m").isNull() & F.col("account_id").isNull(), F.col("n"))),
                   zero).cast("bigint").alias("excluded_null_account"),
    )


def with_month(fact: DataFrame) -> DataFrame:
    return fact.withColumn("transaction_month", F.date_format("transaction_date", "yyyy-MM"))


def write_mart(fact: DataFrame, path: str, max_records_per_file: int = 5_000_000) -> None:
    """SNK-6: full rebuild of the mart, partitioned by transaction month.

    ``rebalance`` by month deals each month's rows to few tasks, so a month has few
    files; AQE splits a month that is large, so a busy one does not become one task.
    ``maxRecordsPerFile`` bounds file sizes.
    """
    (with_month(fact).hint("rebalance", "transaction_month")
     .write.mode("overwrite").partitionBy("transaction_month")
     .option("maxRecordsPerFile", max_records_per_file).parquet(path))


# Buckets of the catalog tables; size it so that a bucket of a month is a file of some hundred MB.
BUCKETS = 8


def save_bucketed(df: DataFrame, table: str, path: str, buckets: int = BUCKETS, partition: str | None = None) -> None:
    """A catalog table bucketed and sorted by ``account_id``: joins and groupings by account need no exchange.

    Rows are dealt by bucket first, so each bucket (of a month) is one file.
    """
    writer = df.repartition(buckets, "account_id").write.mode("overwrite").option("path", path)
    if partition is not None:
        writer = writer.partitionBy(partition)
    writer.bucketBy(buckets, "account_id").sortBy("account_id").saveAsTable(table)


def save_mart(fact: DataFrame, table: str, path: str, buckets: int = BUCKETS) -> None:
    """SNK-6: the mart as a catalog table, partitioned by month and bucketed by account."""
    save_bucketed(with_month(fact), table, path, buckets, "transaction_month")


def replace_months(fact: DataFrame, table: str, buckets: int = BUCKETS) -> None:
    """Overwrite the months that ``fact`` has, and no others, in the catalog table (dynamic partition overwrite)."""
    spark, setting = fact.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    rows = with_month(fact).select(*spark.table(table).columns).repartition(buckets, "account_id")
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")  # an insert takes it from the session only
    try:
        rows.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(setting, before)


def create_views(tables: StagedTables, profile: DataFrame, prefix: str = "") -> list[str]:
    """SNK-6: staging and intermediate models as views: nothing is stored, each reader's columns are pruned."""
    views = {f"{prefix}stg_{t}": getattr(tables, t) for t in ("trans", "account", "client", "disposition", "district")}
    views[f"{prefix}customer_profile"] = profile
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
