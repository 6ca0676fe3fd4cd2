"""Deliberate corruption with an exact audit (CR-1 ... CR-6, O-1 ... O-3, A-10).

Three independent errors on a clean synthetic set of n rows:

1. duplicate: k = max(1, floor(n * rate)) rows copied verbatim (``copy_no`` 1);
2. referential: k rows of the post-duplicate set get unique fake account ids
   ``fake_base + rank - 1`` (fake_base = max real account + 100,000);
3. missing: ``k_symbol`` set to NULL on k rows of the post-duplicate set.

k always uses the pre-duplicate n and double arithmetic (floor(100 * 0.29) is
28).  Each choice is ``selection.exact_k`` over its own hash of
``(seed, data set, kind, trans_id, copy_no)``, so one row may carry several
errors and results do not depend on partitioning.  The corrupted rows and the
audit come from one flagged table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.uniform import hash52
from ..schemas import TRANS_COLUMNS
from ..session import scratch_path
from . import selection

# Default rates and the fake-id offset.
DEFAULT_RATES = {"duplicate": 0.02, "referential": 0.02, "missing": 0.03}
FAKE_ID_OFFSET = 100_000
KINDS = ["duplicate", "referential_violation", "missing_value"]


def k_of(n: int, rate: float) -> int:
    """max(1, floor(n * rate)) in double arithmetic (rate 0 still gives 1)."""
    return max(1, int(math.floor(float(n) * float(rate))))


@dataclass
class Corrupted:
    rows: DataFrame        # canonical trans columns + copy_no
    audit: DataFrame       # (dataset, kind, trans_id, copy_no, field, old_value, new_value)
    flagged: DataFrame     # rows with flags and original values (for reconciliation)
    summary: dict          # counts: n, k per kind, rows after


def corrupt(spark: SparkSession, clean: DataFrame, n: int, max_real_account: int,
            rates: dict | None = None, seed: int = 42, dataset: str = "dev",
            kinds: list[str] | None = None) -> Corrupted:
    """Corrupt a clean set of ``n`` rows; ``kinds`` (default all) limits the work to these errors.

    The rows and all hashes that decide, of a row and of its possible copy, are computed once and
    stored as a columnar table: histograms and cuts then read single columns of it.
    """
    rates = {**DEFAULT_RATES, **(rates or {})}
    kinds = KINDS if kinds is None else kinds
    salt = f"{seed}:{dataset}"
    k_dup = k_of(n, rates["duplicate"])
    k_ref = k_of(n, rates["referential"])
    k_mis = k_of(n, rates["missing"])
    fake_base = int(max_real_account) + FAKE_ID_OFFSET

    hashes = {"_h_dup": hash52(f"{salt}:dup", "trans_id")}
    for name, wanted in (("ref", "referential_violation"), ("mis", "missing_value")):
        if wanted in kinds:
            for c in (0, 1):
                hashes[f"_h_{name}{c}"] = hash52(f"{salt}:{name}", F.col("trans_id"), F.lit(c).cast("bigint"))
    path = scratch_path(spark, f"clean-{dataset}")
    clean.select(*TRANS_COLUMNS, *[h.alias(c) for c, h in hashes.items()]).write.parquet(path)
    base = spark.read.parquet(path)
    dup_sel = selection.exact_k(base, k_dup, "_h_dup", ["trans_id"], n_rows=n)
    drawn = [name for name in ("ref", "mis") if f"_h_{name}0" in hashes]

    def version(rows: DataFrame, copy_no: int) -> DataFrame:
        return rows.select(*TRANS_COLUMNS, F.lit(copy_no).cast("bigint").alias("copy_no"),
                           *[F.col(f"_h_{x}{copy_no}").alias(f"_h_{x}") for x in drawn])

    # O-1: bag append of the copies.
    post = version(base, 0).unionByName(version(base.where(dup_sel.predicate()), 1))
    n_post = n + min(k_dup, n)
    ks = {"ref": k_ref, "mis": k_mis}
    selected = dict(zip(drawn, selection.exact_k_many(
        post, [(ks[x], f"_h_{x}", ["trans_id", "copy_no"]) for x in drawn], n_rows=n_post)))

    def is_selected(name: str):
        return selected[name].predicate() if name in selected else F.lit(False)

    flagged = (post.withColumn("is_orphan", is_selected("ref"))
               .withColumn("is_missing", is_selected("mis"))
               .withColumn("is_copy", F.col("copy_no") == 1))
    no_fake = flagged.withColumn("fake_account_id", F.lit(None).cast("bigint"))
    if "ref" in selected:
        # CR-2: consecutive fake ids for the orphan rows only (two disjoint branches).
        orphans = selection.ranked(spark, flagged.where(F.col("is_orphan")), selected["ref"], "_rank")
        orphans = orphans.withColumn("fake_account_id", F.lit(fake_base) + F.col("_rank") - 1).drop("_rank")
        flagged = orphans.unionByName(no_fake.where(~F.col("is_orphan")))
    else:
        flagged = no_fake
    flagged = (flagged
               .withColumn("original_account_id", F.col("account_id"))
               .withColumn("original_k_symbol", F.col("k_symbol"))
               .withColumn("account_id", F.coalesce(F.col("fake_account_id"), F.col("account_id")))
               .withColumn("k_symbol", F.when(F.col("is_missing"), F.lit(None).cast("string"))
                           .otherwise(F.col("k_symbol")))
               .drop(*[f"_h_{x}" for x in drawn])
               .withColumn("dataset", F.lit(dataset)))
    # Stored once: the rows, the audit and all counts read columns of it.
    stored = scratch_path(spark, f"flagged-{dataset}")
    flagged.write.parquet(stored)
    flagged = spark.read.schema(flagged.schema).parquet(stored)

    rows = flagged.select(*TRANS_COLUMNS, "copy_no")
    audit = audit_of(flagged)
    summary = {"dataset": dataset, "rows_before": n, "rows_after": n + min(k_dup, n),
               "duplicate": k_dup, "referential_violation": k_ref, "missing_value": k_mis,
               "fake_base": fake_base, "rates": rates}
    return Corrupted(rows, audit, flagged, summary)


def audit_of(flagged: DataFrame) -> DataFrame:
    """CR-5: one audit row per injected error, built in one pass (explode)."""
    s = F.lit(None).cast("string")
    entries = F.array(
        F.when(F.col("is_copy"), F.struct(F.lit("duplicate").alias("kind"), s.alias("field"),
                                          s.alias("old_value"), s.alias("new_value"))),
        F.when(F.col("is_orphan"), F.struct(
            F.lit("referential_violation").alias("kind"), F.lit("account_id").alias("field"),
            F.col("original_account_id").cast("string").alias("old_value"),
            F.col("fake_account_id").cast("string").alias("new_value"))),
        F.when(F.col("is_missing"), F.struct(
            F.lit("missing_value").alias("kind"), F.lit("k_symbol").alias("field"),
            F.col("original_k_symbol").alias("old_value"), s.alias("new_value"))),
    )
    return (flagged.select("dataset", "trans_id", "copy_no", F.explode(entries).alias("e"))
            .where(F.col("e").isNotNull())
            .select("dataset", "e.kind", "trans_id", "copy_no", "e.field", "e.old_value",
                    "e.new_value"))


def audit_summary(audit: DataFrame, summaries: list[dict]) -> DataFrame:
    """A-10: per data set and kind: rate, planned count, audited count, rows before/after."""
    spark = audit.sparkSession
    plan_rows = [(s["dataset"], kind, float(s["rates"][{"duplicate": "duplicate",
                                                          "referential_violation": "referential",
                                                          "missing_value": "missing"}[kind]]),
                  int(s[kind]), int(s["rows_before"]), int(s["rows_after"]))
                 for s in summaries for kind in KINDS]
    planned = spark.createDataFrame(
        plan_rows, "dataset string, kind string, rate double, planned long, rows_before long, "
                   "rows_after long")
    counted = audit.groupBy("dataset", "kind").agg(F.count(F.lit(1)).cast("bigint").alias("audited"))
    return planned.join(counted, ["dataset", "kind"], "left").select(
        "dataset", "kind", "rate", "planned",
        F.coalesce(F.col("audited"), F.lit(0).cast("bigint")).alias("audited"),
        "rows_before", "rows_after")


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# Size of the manifest's sample of original k_symbol values.
MANIFEST_SAMPLE = 20


def missing_value_sample(audit: DataFrame, datasets: list[str], size: int = MANIFEST_SAMPLE
                         ) -> DataFrame:
    """O-2: the first ``size`` missing-value entries (by trans_id, copy_no) with
    their original k_symbol, per data set -- a distributed top-k, not a sort."""
    parts = [audit.where((F.col("kind") == "missing_value") & (F.col("dataset") == ds))
             .orderBy("trans_id", "copy_no").limit(size)
             .select("dataset", "trans_id", "copy_no", F.col("old_value").alias("original_k_symbol"))
             for ds in sorted(datasets)]
    return union_all(parts)
