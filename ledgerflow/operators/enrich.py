"""Stream-table enrichment in DataFrame form (J-5 ... J-7, F-11, P-4, A-6, A-9).

``route`` attaches the current profile to each transaction and sets
``dlq_reason`` for the ones that cannot be enriched; ``enriched`` and
``dead_letters`` project the two outputs, so exactly one side holds each row.

Rows whose ``account_id`` is NULL never take part in the join: in a shuffled
join every NULL key would hash to one partition, which is a hot spot when many
records miss the key.  They are routed straight to the dead letters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import REASON_MISSING_ACCOUNT, REASON_UNREADABLE, dlq_reason
from ..schemas import ENRICHED_FIELDS

# Column that holds the text of a message that could not be parsed.
UNREADABLE = "__unreadable"
PROFILE_FIELDS = ["client_id", "birth_number", "account_frequency", "district_name",
                  "district_region", "avg_salary"]


def route(trans: DataFrame, profile: DataFrame) -> DataFrame:
    """All transaction columns + profile fields + ``dlq_reason`` (NULL = enriched)."""
    p = profile.select("account_id", *PROFILE_FIELDS)
    with_key = trans.where(F.col("account_id").isNotNull())
    no_key = trans.where(F.col("account_id").isNull())
    joined = with_key.join(p, "account_id", "left")
    missing = no_key.select("*", *[F.lit(None).cast(p.schema[c].dataType).alias(c)
                                   for c in PROFILE_FIELDS])
    both = joined.unionByName(missing)
    reason = dlq_reason("account_id", "client_id")
    if UNREADABLE in trans.columns:
        reason = F.when(F.col(UNREADABLE).isNotNull(), F.lit(REASON_UNREADABLE)).otherwise(reason)
    return both.withColumn("dlq_reason", reason)


def enriched(routed: DataFrame) -> DataFrame:
    """P-4: the 18-field enriched record."""
    out = routed.where(F.col("dlq_reason").isNull()).withColumn("__enriched", F.lit(True))
    return out.select(*ENRICHED_FIELDS)


def original_columns(routed: DataFrame) -> list[str]:
    profile = set(PROFILE_FIELDS) | {"dlq_reason"}
    return [c for c in routed.columns if c not in profile]


def dead_letters(routed: DataFrame, nested: bool = True) -> DataFrame:
    """DLQ record: reason, key fields and the original transaction.

    ``nested=True`` keeps ``original_transaction`` as a struct (the sink form);
    ``nested=False`` flattens it to ``orig_<field>`` columns (the compare form).
    """
    orig = original_columns(routed)
    dl = routed.where(F.col("dlq_reason").isNotNull())
    if nested:
        return dl.select(F.struct(*orig).alias("original_transaction"), "dlq_reason",
                         "trans_id", "account_id", "__source_ts_ms")
    return dl.select("dlq_reason", "trans_id", "account_id", "__source_ts_ms",
                     *[F.col(c).alias(f"orig_{c}") for c in orig])


def metric_columns():
    """A-6 counters over routed rows (usable in ``observe`` and ``agg``)."""
    return [
        F.count(F.lit(1)).alias("processed"),
        F.count_if(F.col("dlq_reason").isNull()).alias("enriched"),
        F.count_if(F.col("dlq_reason").isNotNull()).alias("dlq"),
        F.count_if(F.col("dlq_reason") == F.lit(REASON_MISSING_ACCOUNT)).alias("dlq_missing_account"),
    ]


def dlq_by_reason(dead: DataFrame) -> DataFrame:
    """A-9: dead letters per reason."""
    return dead.groupBy("dlq_reason").agg(F.count(F.lit(1)).cast("bigint").alias("records"))


def rerun_dead_letters(dead: DataFrame, profile: DataFrame) -> DataFrame:
    """ST-7: route the original transactions of stored dead letters again, e.g.
    after a late profile has arrived; returns routed rows (enriched or still dead)."""
    return route(dead.select("original_transaction.*"), profile)
