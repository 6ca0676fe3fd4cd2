"""Customer profile: account x OWNER disposition x client, left x district
(J-1 ... J-3, J-6, J-7, FL-1, P-2).

All four inputs are dimension-sized.  Joins are declared plainly; AQE turns a
side into a broadcast only when its measured shuffle size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold`` and otherwise keeps the
sort-merge join, so nothing unbounded is ever broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def customer_profile(accounts: DataFrame, dispositions: DataFrame, clients: DataFrame,
                     districts: DataFrame, district_fallback: bool = False) -> DataFrame:
    """Inputs are the staged tables.

    ``district_fallback`` (stream semantics, J-7): use the account's district
    when the client's district is NULL.  Only NULL falls back; id 0 is a valid
    key (declared deviation Q-5).  Batch semantics (default) join on the
    client's district only.
    """
    a = accounts.select(
        "account_id",
        F.col("district_id").alias("account_district_id"),
        "frequency", "account_open_date")
    owners = (dispositions.where(F.col("disposition_type") == "OWNER")
              .select("account_id", "client_id"))
    c = clients.select(
        "client_id", "gender", "birth_date", "age_at_end_of_dataset",
        F.col("district_id").alias("client_district_id"))
    d = districts.select(
        F.col("district_id").alias("_district_id"), "district_name", "region",
        "num_inhabitants", "avg_salary", "unemployment_rate_95", "unemployment_rate_96",
        "num_crimes_95", "num_crimes_96")

    joined = a.join(owners, "account_id", "inner").join(c, "client_id", "inner")
    district_key = (F.coalesce(F.col("client_district_id"), F.col("account_district_id"))
                    if district_fallback else F.col("client_district_id"))
    joined = joined.join(d, district_key == F.col("_district_id"), "left")
    return joined.select(
        "account_id", "account_district_id", "frequency", "account_open_date",
        "client_id", "gender", "birth_date", "age_at_end_of_dataset", "client_district_id",
        "district_name", "region", "num_inhabitants", "avg_salary",
        "unemployment_rate_95", "unemployment_rate_96", "num_crimes_95", "num_crimes_96",
    )


def stream_profile(accounts: DataFrame, dispositions: DataFrame, clients: DataFrame,
                   districts: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Profile in the stream record's shape (P-5 / J-6 with fallback): one row for each account, or
    for each of the accounts in ``keys``, which cut accounts and dispositions down first.

    An account with several OWNER dispositions has the owner of the newest one (the greatest
    ``disp_id``), so a transaction is enriched once."""
    if keys is not None:
        accounts, dispositions = (x.join(keys.select("account_id"), "account_id", "left_semi") for x in (accounts, dispositions))
    a = accounts.select("account_id", F.col("district_id").alias("account_district_id"),
                        F.col("frequency").alias("account_frequency"))
    owners = (dispositions.where(F.col("disposition_type") == "OWNER")
              .groupBy("account_id").agg(F.max_by("client_id", F.struct("disp_id", "client_id")).alias("client_id")))
    c = clients.select("client_id", "birth_number", F.col("district_id").alias("client_district_id"))
    d = districts.select(F.col("district_id").alias("_district_id"), "district_name",
                         F.col("region").alias("district_region"), "avg_salary")
    joined = a.join(owners, "account_id", "inner").join(c, "client_id", "inner")
    key = F.coalesce(F.col("client_district_id"), F.col("account_district_id"))
    return (joined.join(d, key == F.col("_district_id"), "left")
            .select("account_id", "client_id", "birth_number", "client_district_id",
                    "account_district_id", "account_frequency", "district_name",
                    "district_region", "avg_salary"))
