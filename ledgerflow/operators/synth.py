"""Fit and sample synthetic transactions (SY-1 ... SY-8, A-1 ... A-5, FL-2, F-9, F-13).

Fitting is a handful of aggregations over one scan; sampling is a
``spark.range`` expression plan where every random value is a hash uniform of
``(seed, data set, purpose, trans_id)``, so output does not depend on
partitioning and is reproducible after executor loss.

Categorical draws use integer cumulative counts (exact in any engine):
operation by a CASE built from the fitted operation table (at most one row per
known operation, checked), k_symbol by an equi-join on operation plus interval
test, account by the binned interval join of ``selection.interval_draw``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.dates import to_yymmdd
from ..functions.uniform import standard_normal, uniform_int
from ..session import scratch_path
from . import selection

# Synthetic period (start day and length in days).
SYNTHETIC_START = "1999-01-01"
SYNTHETIC_DURATION_DAYS = 365 * 6
# Default seed; data set sizes are derived from the data (dataset_sizes).
DEFAULT_SEED = 42
ACCOUNT_BUCKET_BITS = 12
# Columns of the transactions that the fit reads.
FIT_COLUMNS = ["trans_id", "account_id", "date", "operation", "amount", "k_symbol"]


def _round6(x: Column) -> Column:
    return codes.round_half_up(x, 6)


def fit_operation(trans: DataFrame) -> DataFrame:
    """A-1 + A-2 over rows with amount > 0, with integer cumulative bounds."""
    fit = trans.where(F.col("amount") > 0).withColumn("op_key", codes.operation_key("operation"))
    per_op = fit.groupBy("op_key").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        _round6(F.avg(F.log(F.col("amount")))).alias("log_mean"),
        _round6(F.stddev_pop(F.log(F.col("amount")))).alias("log_std"),
        F.min("amount").cast("double").alias("amount_min"),
        F.max("amount").cast("double").alias("amount_max"),
    )
    # At most one row per known operation: the window below runs over <= 6 rows.
    w_all = Window.partitionBy(F.lit(1))
    w_run = Window.partitionBy(F.lit(1)).orderBy("op_key").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return per_op.select(
        "op_key", "n",
        (F.col("n").cast("double") / F.sum("n").over(w_all).cast("double")).alias("probability"),
        codes.type_of_operation("op_key").alias("type"),
        "log_mean", "log_std", "amount_min", "amount_max",
        (F.sum("n").over(w_run) - F.col("n")).cast("bigint").alias("cum_lo"),
        F.sum("n").over(w_run).cast("bigint").alias("cum_hi"),
    )


def fit_k_symbol(trans: DataFrame) -> DataFrame:
    """A-3: P(k_symbol | operation), NULL and '' are distinct categories."""
    fit = trans.where(F.col("amount") > 0).withColumn("op_key", codes.operation_key("operation"))
    per = fit.groupBy("op_key", "k_symbol").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    # Windows partitioned by operation (few, small groups of k_symbol values).
    w_op = Window.partitionBy("op_key")
    w_run = Window.partitionBy("op_key").orderBy(F.col("k_symbol").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return per.select(
        "op_key", "k_symbol", "n",
        (F.col("n").cast("double") / F.sum("n").over(w_op).cast("double")).alias("share"),
        (F.sum("n").over(w_run) - F.col("n")).cast("bigint").alias("cum_lo"),
        F.sum("n").over(w_run).cast("bigint").alias("cum_hi"),
    )


def fit_account_weights(spark: SparkSession, trans: DataFrame, total_rows: int | None = None,
                        bits: int = ACCOUNT_BUCKET_BITS) -> DataFrame:
    """A-4 over all rows: activity count and weight per account, plus cumulative
    [cum_lo, cum_hi) in (hash bucket, account_id) order, computed distributed."""
    keyed = trans.where(F.col("account_id").isNotNull())
    counts = keyed.groupBy("account_id").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    if total_rows is None:
        # Stored, so that the input is counted once for the total and the sums.
        path = scratch_path(spark, "account-counts")
        counts.write.parquet(path)
        counts = spark.read.parquet(path)
        total_rows = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    with_cum = selection.prefix_intervals(spark, counts, "n", ["account_id"], bits=bits)
    return with_cum.select(
        "account_id", "n", "bucket", "cum_lo", "cum_hi",
        (F.col("n").cast("double") / F.lit(float(max(total_rows, 1)))).alias("weight"))


def fit_scalars(trans: DataFrame) -> DataFrame:
    """A-5 (+ FL-2 drop count): one row of scalars, integer order for dates."""
    return trans.agg(
        F.max("trans_id").cast("bigint").alias("max_trans_id"),
        F.min("date").cast("bigint").alias("date_min"),
        F.max("date").cast("bigint").alias("date_max"),
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.count_if(F.col("amount") > 0).cast("bigint").alias("fit_rows"),
        F.count_if(~(F.col("amount") > 0) | F.col("amount").isNull()).cast("bigint")
         .alias("dropped_rows"),
        F.count_if(F.col("account_id").isNotNull()).cast("bigint").alias("account_rows"),
        F.count_distinct("account_id").cast("bigint").alias("accounts"),
        F.max("account_id").cast("bigint").alias("max_account_id"),
    )


@dataclass
class FitTables:
    """The fitted model: four small tables plus their scalars."""
    operations: DataFrame
    k_symbols: DataFrame
    accounts: DataFrame
    scalars: dict

    @property
    def fit_rows(self) -> int:
        return int(self.scalars["fit_rows"])


def fit(spark: SparkSession, trans: DataFrame) -> FitTables:
    """SY-1: fit all four distributions.

    The (deduplicated) input is persisted for the duration of the fit so its
    shuffle runs once for the four aggregations; the fitted tables are small
    and are written to the shared work folder, so later draws read them
    instead of recomputing them from the transactions.
    """
    src = trans.select(*FIT_COLUMNS).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        scalars = fit_scalars(src).collect()[0].asDict()
        root = scratch_path(spark, "fit")
        fit_account_weights(spark, src, total_rows=int(scalars["account_rows"])) \
            .write.mode("overwrite").parquet(f"{root}/accounts")
        fit_operation(src).write.mode("overwrite").parquet(f"{root}/operations")
        fit_k_symbol(src).write.mode("overwrite").parquet(f"{root}/k_symbols")
    finally:
        src.unpersist()
    return FitTables(spark.read.parquet(f"{root}/operations"),
                     spark.read.parquet(f"{root}/k_symbols"),
                     spark.read.parquet(f"{root}/accounts"), scalars)


def sample(spark: SparkSession, model: FitTables, n: int, start_id: int, seed: int = DEFAULT_SEED,
           dataset: str = "dev", num_partitions: int | None = None) -> DataFrame:
    """SY-2 ... SY-7: n rows with trans_id start_id .. start_id + n - 1."""
    salt = f"{seed}:{dataset}"
    ops = model.operations.limit(len(codes.TYPE_BY_OPERATION) + 1).collect()
    if len(ops) > len(codes.TYPE_BY_OPERATION):
        raise ValueError("operation table larger than the known operation set")
    unknown = [r["op_key"] for r in ops if r["type"] is None]
    if unknown:  # F-10: an operation without a known type is an error
        raise ValueError(f"operations without a known type: {unknown}")
    total = sum(int(r["n"]) for r in ops)
    parts = num_partitions or max(spark.sparkContext.defaultParallelism, n // 2_000_000 + 1)
    ids = spark.range(start_id, start_id + n, numPartitions=parts).withColumnRenamed("id", "trans_id")

    # SY-3: operation from its integer cumulative bounds (<= 6 rows, a CASE).
    r_op = uniform_int(f"{salt}:op", total, "trans_id")
    op_key = None
    for r in ops:
        cond = (r_op >= F.lit(r["cum_lo"])) & (r_op < F.lit(r["cum_hi"]))
        op_key = F.when(cond, F.lit(r["op_key"])) if op_key is None else op_key.when(cond, F.lit(r["op_key"]))
    # Per-operation parameters by an equi-join on the (<= 6-row, checked) fitted table.
    params = model.operations.select(
        "op_key", F.col("n").alias("_n_op"), F.col("log_mean").alias("_mu"),
        F.col("log_std").alias("_sigma"), F.col("amount_min").alias("_amt_lo"),
        F.col("amount_max").alias("_amt_hi"))
    base = ids.withColumn("op_key", op_key).join(F.broadcast(params), "op_key", "inner")
    n_op = F.col("_n_op")

    # SY-4: k_symbol | operation -- equi-join on op_key + interval test.
    k_tab = model.k_symbols.select("op_key", "k_symbol", "cum_lo", "cum_hi")
    n_k = k_tab.count()
    with_k = selection.interval_draw(
        base.withColumn("_rk", uniform_int(f"{salt}:ks", n_op, "trans_id")),
        "_rk", k_tab, "cum_lo", "cum_hi", total=max(total, 1), n_intervals=max(n_k, 1),
        group_cols=["op_key"], payload=["k_symbol"], n_draws=n)

    # SY-5: account weighted by activity -- binned interval join.
    acc_total = int(model.scalars["account_rows"])
    n_acc = int(model.scalars["accounts"])
    with_acc = selection.interval_draw(
        with_k.withColumn("_ra", uniform_int(f"{salt}:acc", acc_total, "trans_id")),
        "_ra", model.accounts.select("account_id", "cum_lo", "cum_hi"), "cum_lo", "cum_hi",
        total=max(acc_total, 1), n_intervals=max(n_acc, 1), payload=["account_id"], n_draws=n)

    # SY-6, SY-7: date and conditional log-normal amount.
    day = uniform_int(f"{salt}:date", SYNTHETIC_DURATION_DAYS, "trans_id")
    d = F.date_add(F.lit(SYNTHETIC_START).cast("date"), day.cast("int"))
    z = standard_normal(f"{salt}:amt", "trans_id")
    amount = codes.clipped_lognormal(F.col("_mu"), F.col("_sigma"), z, F.col("_amt_lo"), F.col("_amt_hi"))
    return with_acc.select(
        "trans_id", "account_id",
        to_yymmdd(d).alias("date"),
        codes.type_of_operation("op_key").alias("type"),
        codes.operation_from_key("op_key").alias("operation"),
        amount.alias("amount"),
        F.lit(None).cast("double").alias("balance"),
        "k_symbol",
        F.lit(None).cast("string").alias("bank"),
        F.lit(None).cast("string").alias("account"),
    )


def dataset_sizes(real_rows: int) -> dict[str, int]:
    """SY-8: dev ~ a tenth of the real rows, load test ~ as many as the real rows
    (the reference's 100,000 / 1,000,000 next to 1,056,320 real rows)."""
    return {"dev": max(1, real_rows // 10), "loadtest": max(1, real_rows)}
