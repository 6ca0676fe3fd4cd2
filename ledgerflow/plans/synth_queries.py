"""Fit -> sample -> corrupt -> audit -> reconcile queries (SY, CR, A-1 ... A-5, A-10).

The fit input is the real transaction table (first-wins deduplicated, raw
columns).  Two synthetic sets are drawn: ``dev`` (a tenth of the real rows) and
``loadtest`` (as many as the real rows), with adjacent id ranges after the
largest real id, so the work grows with the supplied tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import MISSING_OPERATION
from ..operators import corrupt as corrupt_ops
from ..operators import enrich, mart, quality, selection, staging, synth
from ..operators import profile as profile_ops
from ..operators.quality import Rule
from ..schemas import TRANS_COLUMNS
from ..session import scratch_path, work_dir
from ..sources import delimited
from ..sources import testdata as td
from . import oracle as O
from .catalog import register
from .stream_queries import PROFILE_CTE

SEED = synth.DEFAULT_SEED
DATASETS = ["dev", "loadtest"]
RATES = corrupt_ops.DEFAULT_RATES


def fit_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = td.raw_trans(spark, sf_dir)
    return staging.dedupe_first(raw, "trans_id", ["ingest_seq"]).select(*TRANS_COLUMNS)


@dataclass
class SynthRun:
    model: synth.FitTables
    sizes: dict
    starts: dict
    clean: dict
    corrupted: dict


def synthesize(spark: SparkSession, sf_dir: str, with_corruption: bool = True,
               datasets: list[str] | None = None, kinds: list[str] | None = None) -> SynthRun:
    """Fit once, then draw (and corrupt) the requested data sets (default: both), with the
    requested kinds of errors (default: all).  Id ranges do not depend on which sets are drawn."""
    work_dir(spark)  # checkpoint folder (the cluster's, or a local one in tests)
    wanted = datasets or DATASETS
    model = synth.fit(spark, fit_input(spark, sf_dir))
    sizes = synth.dataset_sizes(int(model.scalars["rows"]))
    starts, nxt = {}, int(model.scalars["max_trans_id"]) + 1
    for ds in DATASETS:
        starts[ds] = nxt
        nxt += sizes[ds]
    clean, corrupted = {}, {}
    for ds in wanted:
        clean[ds] = synth.sample(spark, model, sizes[ds], starts[ds], SEED, ds)
        if with_corruption:
            corrupted[ds] = corrupt_ops.corrupt(
                spark, clean[ds], sizes[ds], int(model.scalars["max_account_id"]), RATES, SEED, ds, kinds)
    return SynthRun(model, sizes, starts, clean, corrupted)


# --------------------------------------------------------------------------
# Oracle SQL
# --------------------------------------------------------------------------

_FIT_CTES = {
    "fit_in": """
      SELECT trans_id, account_id, date, type, operation, amount, balance, k_symbol, bank, account
      FROM (SELECT *, row_number() OVER (PARTITION BY trans_id ORDER BY ingest_seq) AS rn
            FROM raw_trans) WHERE rn = 1""",
    "fit_op": f"""
      SELECT op_key, n, CAST(n AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE) AS probability,
        {O.type_of_operation_sql('op_key')} AS type, log_mean, log_std, amount_min, amount_max,
        CAST(sum(n) OVER (ORDER BY op_key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n
             AS BIGINT) AS cum_lo,
        CAST(sum(n) OVER (ORDER BY op_key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
             AS BIGINT) AS cum_hi
      FROM (SELECT coalesce(operation, '{MISSING_OPERATION}') AS op_key, CAST(count(*) AS BIGINT) AS n,
              {O.round_half_up_sql('avg(ln(amount))', 6)} AS log_mean,
              {O.round_half_up_sql('stddev_pop(ln(amount))', 6)} AS log_std,
              CAST(min(amount) AS DOUBLE) AS amount_min, CAST(max(amount) AS DOUBLE) AS amount_max
            FROM fit_in WHERE amount > 0 GROUP BY 1)""",
    "fit_ks": f"""
      SELECT op_key, k_symbol, n,
        CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY op_key) AS DOUBLE) AS share,
        CAST(sum(n) OVER (PARTITION BY op_key ORDER BY k_symbol NULLS FIRST
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS BIGINT) AS cum_lo,
        CAST(sum(n) OVER (PARTITION BY op_key ORDER BY k_symbol NULLS FIRST
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_hi
      FROM (SELECT coalesce(operation, '{MISSING_OPERATION}') AS op_key, k_symbol,
              CAST(count(*) AS BIGINT) AS n
            FROM fit_in WHERE amount > 0 GROUP BY 1, 2)""",
    "fit_sc": """
      SELECT CAST(max(trans_id) AS BIGINT) AS max_trans_id, CAST(min(date) AS BIGINT) AS date_min,
        CAST(max(date) AS BIGINT) AS date_max, CAST(count(*) AS BIGINT) AS rows,
        CAST(count(*) FILTER (WHERE amount > 0) AS BIGINT) AS fit_rows,
        CAST(count(*) FILTER (WHERE NOT (amount > 0) OR amount IS NULL) AS BIGINT) AS dropped_rows,
        CAST(count(*) FILTER (WHERE account_id IS NOT NULL) AS BIGINT) AS account_rows,
        CAST(count(DISTINCT account_id) AS BIGINT) AS accounts,
        CAST(max(account_id) AS BIGINT) AS max_account_id
      FROM fit_in""",
    "fit_acc": f"""
      SELECT account_id, n, bucket, cum_hi - n AS cum_lo, cum_hi,
        CAST(n AS DOUBLE) / CAST((SELECT account_rows FROM fit_sc) AS DOUBLE) AS weight
      FROM (SELECT account_id, n, bucket,
              CAST(sum(n) OVER (ORDER BY bucket, account_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_hi
            FROM (SELECT account_id, CAST(count(*) AS BIGINT) AS n,
                    {O.bucket_sql(synth.ACCOUNT_BUCKET_BITS, 'account_id')} AS bucket
                  FROM fit_in WHERE account_id IS NOT NULL GROUP BY account_id))""",
    "sizes": """
      SELECT 'dev' AS dataset, greatest(1, rows // 10) AS n, max_trans_id + 1 AS start_id FROM fit_sc
      UNION ALL
      SELECT 'loadtest', greatest(1, rows), max_trans_id + 1 + greatest(1, rows // 10) FROM fit_sc""",
}


def _k_sql(n: str, rate: float) -> str:
    return f"greatest(1, CAST(floor(CAST({n} AS DOUBLE) * CAST({rate!r} AS DOUBLE)) AS BIGINT))"


def _synth_ctes(ds: str) -> dict:
    salt = f"{SEED}:{ds}"
    ids = f"ids_{ds}"
    z = O.normal_sql(f"{salt}:amt", "i.trans_id")
    amount = O.round_half_up_sql(
        f"greatest(o.amount_min, least(o.amount_max, exp(o.log_mean + o.log_std * {z})))", 2)
    day = O.uniform_int_sql(f"{salt}:date", str(synth.SYNTHETIC_DURATION_DAYS), "i.trans_id")
    r_op = O.uniform_int_sql(f"{salt}:op", "(SELECT sum(n) FROM fit_op)", "i.trans_id")
    r_k = O.uniform_int_sql(f"{salt}:ks", "o.n", "i.trans_id")
    r_a = O.uniform_int_sql(f"{salt}:acc", "(SELECT account_rows FROM fit_sc)", "i.trans_id")
    fake_base = f"((SELECT max_account_id FROM fit_sc) + {corrupt_ops.FAKE_ID_OFFSET})"
    n = f"(SELECT n FROM sizes WHERE dataset = '{ds}')"
    cols = ", ".join(TRANS_COLUMNS)
    return {
        ids: f"SELECT unnest(range(start_id, start_id + n)) AS trans_id FROM sizes WHERE dataset = '{ds}'",
        f"draw_{ds}": f"""
          SELECT i.trans_id, o.op_key, o.n AS op_n, {r_k} AS rk, {r_a} AS ra,
            {O.yymmdd_sql(f"DATE '{synth.SYNTHETIC_START}' + CAST({day} AS INTEGER)")} AS date,
            {amount} AS amount
          FROM {ids} i JOIN fit_op o ON {r_op} >= o.cum_lo AND {r_op} < o.cum_hi""",
        f"clean_{ds}": f"""
          SELECT d.trans_id, a.account_id, d.date, {O.type_of_operation_sql('d.op_key')} AS type,
            nullif(d.op_key, '{MISSING_OPERATION}') AS operation, d.amount,
            CAST(NULL AS DOUBLE) AS balance, k.k_symbol, CAST(NULL AS VARCHAR) AS bank,
            CAST(NULL AS VARCHAR) AS account
          FROM draw_{ds} d
          JOIN fit_ks k ON k.op_key = d.op_key AND d.rk >= k.cum_lo AND d.rk < k.cum_hi
          JOIN fit_acc a ON d.ra >= a.cum_lo AND d.ra < a.cum_hi""",
        f"dup_{ds}": f"""
          SELECT {cols} FROM (SELECT *, row_number() OVER (
              ORDER BY {O.hash52_sql(f'{salt}:dup', 'trans_id')}, trans_id) AS rn FROM clean_{ds})
          WHERE rn <= {_k_sql(n, RATES['duplicate'])}""",
        f"post_{ds}": f"""
          SELECT {cols}, CAST(0 AS BIGINT) AS copy_no FROM clean_{ds}
          UNION ALL SELECT {cols}, CAST(1 AS BIGINT) FROM dup_{ds}""",
        f"flag_{ds}": f"""
          SELECT *, is_orphan_rn <= {_k_sql(n, RATES['referential'])} AS is_orphan,
            is_missing_rn <= {_k_sql(n, RATES['missing'])} AS is_missing,
            copy_no = 1 AS is_copy
          FROM (SELECT *,
              row_number() OVER (ORDER BY {O.hash52_sql(f'{salt}:ref', 'trans_id', 'copy_no')},
                                 trans_id, copy_no) AS is_orphan_rn,
              row_number() OVER (ORDER BY {O.hash52_sql(f'{salt}:mis', 'trans_id', 'copy_no')},
                                 trans_id, copy_no) AS is_missing_rn
            FROM post_{ds})""",
        f"corrupt_{ds}": f"""
          SELECT '{ds}' AS dataset, trans_id,
            CASE WHEN is_orphan THEN {fake_base} + is_orphan_rn - 1 ELSE account_id END AS account_id,
            date, type, operation, amount, balance,
            CASE WHEN is_missing THEN NULL ELSE k_symbol END AS k_symbol, bank, account, copy_no,
            account_id AS original_account_id, k_symbol AS original_k_symbol,
            CASE WHEN is_orphan THEN {fake_base} + is_orphan_rn - 1 END AS fake_account_id,
            is_orphan, is_missing, is_copy, {fake_base} AS fake_base
          FROM flag_{ds}""",
    }


def _all_ctes() -> dict:
    ctes = dict(_FIT_CTES)
    for ds in DATASETS:
        ctes.update(_synth_ctes(ds))
    ctes["clean_all"] = " UNION ALL ".join(
        f"SELECT '{ds}' AS dataset, * FROM clean_{ds}" for ds in DATASETS)
    ctes["corrupt_all"] = " UNION ALL ".join(f"SELECT * FROM corrupt_{ds}" for ds in DATASETS)
    ctes["audit_all"] = """
      SELECT dataset, 'duplicate' AS kind, trans_id, copy_no, CAST(NULL AS VARCHAR) AS field,
        CAST(NULL AS VARCHAR) AS old_value, CAST(NULL AS VARCHAR) AS new_value
      FROM corrupt_all WHERE is_copy
      UNION ALL
      SELECT dataset, 'referential_violation', trans_id, copy_no, 'account_id',
        CAST(original_account_id AS VARCHAR), CAST(fake_account_id AS VARCHAR)
      FROM corrupt_all WHERE is_orphan
      UNION ALL
      SELECT dataset, 'missing_value', trans_id, copy_no, 'k_symbol', original_k_symbol, NULL
      FROM corrupt_all WHERE is_missing"""
    return ctes


def _sql(body: str) -> str:
    return O.with_base(body, _all_ctes())


# --------------------------------------------------------------------------
# Registered queries
# --------------------------------------------------------------------------

@register("fit_operation", _sql("SELECT * FROM fit_op"))
def fit_operation(spark, sf_dir):
    return synth.fit_operation(fit_input(spark, sf_dir))


@register("fit_k_symbol", _sql("SELECT * FROM fit_ks"))
def fit_k_symbol(spark, sf_dir):
    return synth.fit_k_symbol(fit_input(spark, sf_dir))


@register("fit_account_weights", _sql("SELECT * FROM fit_acc"))
def fit_account_weights(spark, sf_dir):
    return synth.fit_account_weights(spark, fit_input(spark, sf_dir))


@register("fit_scalars", _sql("SELECT * FROM fit_sc"))
def fit_scalars(spark, sf_dir):
    return synth.fit_scalars(fit_input(spark, sf_dir))


@register("synth_transactions", _sql("SELECT * FROM clean_all"))
def synth_transactions(spark, sf_dir):
    run = synthesize(spark, sf_dir, with_corruption=False)
    return corrupt_ops.union_all([run.clean[ds].withColumn("dataset", F.lit(ds)) for ds in DATASETS])


_CORRUPT_COLS = ["dataset", *TRANS_COLUMNS, "copy_no"]


@register("corrupted_transactions", _sql(f"SELECT {', '.join(_CORRUPT_COLS)} FROM corrupt_all"))
def corrupted_transactions(spark, sf_dir):
    run = synthesize(spark, sf_dir)
    return corrupt_ops.union_all([run.corrupted[ds].flagged.select(*_CORRUPT_COLS)
                                  for ds in DATASETS])


def _audit(spark, sf_dir, kind: str) -> DataFrame:
    run = synthesize(spark, sf_dir, kinds=[kind])
    return corrupt_ops.union_all([run.corrupted[ds].audit for ds in DATASETS])


@register("corrupt_duplicates", _sql("SELECT * FROM audit_all WHERE kind = 'duplicate'"))
def corrupt_duplicates(spark, sf_dir):
    return _audit(spark, sf_dir, "duplicate").where(F.col("kind") == "duplicate")


@register("corrupt_orphans", _sql("SELECT * FROM audit_all WHERE kind = 'referential_violation'"))
def corrupt_orphans(spark, sf_dir):
    return _audit(spark, sf_dir, "referential_violation").where(F.col("kind") == "referential_violation")


@register("corrupt_missing", _sql("SELECT * FROM audit_all WHERE kind = 'missing_value'"))
def corrupt_missing(spark, sf_dir):
    return _audit(spark, sf_dir, "missing_value").where(F.col("kind") == "missing_value")


def _planned_sql() -> str:
    parts = []
    for ds in DATASETS:
        n = f"(SELECT n FROM sizes WHERE dataset = '{ds}')"
        for kind, rk in (("duplicate", "duplicate"), ("referential_violation", "referential"),
                         ("missing_value", "missing")):
            parts.append(
                f"SELECT '{ds}' AS dataset, '{kind}' AS kind, CAST({RATES[rk]!r} AS DOUBLE) AS rate, "
                f"{_k_sql(n, RATES[rk])} AS planned, {n} AS rows_before, "
                f"{n} + least({_k_sql(n, RATES['duplicate'])}, {n}) AS rows_after")
    return " UNION ALL ".join(parts)


@register("corrupt_audit_summary", _sql(f"""
    SELECT p.dataset, p.kind, p.rate, p.planned, CAST(coalesce(a.audited, 0) AS BIGINT) AS audited,
      p.rows_before, p.rows_after
    FROM ({_planned_sql()}) p
    LEFT JOIN (SELECT dataset, kind, CAST(count(*) AS BIGINT) AS audited FROM audit_all
               GROUP BY 1, 2) a ON a.dataset = p.dataset AND a.kind = p.kind"""))
def corrupt_audit_summary(spark, sf_dir):
    run = synthesize(spark, sf_dir)
    audit = corrupt_ops.union_all([run.corrupted[ds].audit for ds in DATASETS])
    return corrupt_ops.audit_summary(audit, [run.corrupted[ds].summary for ds in DATASETS])


@register("manifest_summary", _sql(f"""
    SELECT dataset, CAST({SEED} AS BIGINT) AS random_seed, n AS target_rows, n AS rows_before,
      n + least({_k_sql('n', RATES['duplicate'])}, n) AS rows_after,
      {_k_sql('n', RATES['duplicate'])} AS duplicate_count,
      {_k_sql('n', RATES['referential'])} AS referential_violation_count,
      {_k_sql('n', RATES['missing'])} AS missing_value_count,
      start_id AS first_trans_id, start_id + n - 1 AS last_trans_id
    FROM sizes"""))
def manifest_summary(spark, sf_dir):
    """SNK-8: the summary as it is written, counted on the written audit and rows, and read back."""
    run = synthesize(spark, sf_dir)
    paths = export_manifest(run, scratch_path(spark, "manifest"))
    return spark.read.schema(MANIFEST_SUMMARY).json(paths["summary"]).drop("generated_at")


@register("reconcile_corruption", _sql("""
    SELECT dataset, check_name, expected, observed,
      CASE WHEN expected = observed THEN 'MATCH' ELSE 'MISMATCH' END AS status
    FROM (
      SELECT c.dataset, 'rows_added_by_duplicates' AS check_name,
        (SELECT count(*) FROM audit_all a WHERE a.dataset = c.dataset AND kind = 'duplicate') AS expected,
        count(*) - count(*) FILTER (WHERE copy_no = 0) AS observed
      FROM corrupt_all c GROUP BY c.dataset
      UNION ALL
      SELECT c.dataset, 'duplicated_ids',
        (SELECT count(*) FROM audit_all a WHERE a.dataset = c.dataset AND kind = 'duplicate'),
        (SELECT count(*) FROM (SELECT trans_id FROM corrupt_all x WHERE x.dataset = c.dataset
                               GROUP BY trans_id HAVING count(*) > 1))
      FROM corrupt_all c GROUP BY c.dataset
      UNION ALL
      SELECT c.dataset, 'fake_accounts',
        (SELECT count(*) FROM audit_all a WHERE a.dataset = c.dataset AND kind = 'referential_violation'),
        count(*) FILTER (WHERE account_id >= fake_base)
      FROM corrupt_all c GROUP BY c.dataset
      UNION ALL
      SELECT c.dataset, 'fake_accounts_after_dedupe',
        (SELECT count(*) FROM audit_all a WHERE a.dataset = c.dataset
           AND kind = 'referential_violation' AND copy_no = 0),
        count(*) FILTER (WHERE account_id >= fake_base AND copy_no = 0)
      FROM corrupt_all c GROUP BY c.dataset
      UNION ALL
      SELECT c.dataset, 'k_symbol_nulled',
        (SELECT count(*) FROM audit_all a WHERE a.dataset = c.dataset
           AND kind = 'missing_value' AND old_value IS NOT NULL),
        count(*) FILTER (WHERE k_symbol IS NULL) - count(*) FILTER (WHERE original_k_symbol IS NULL)
      FROM corrupt_all c GROUP BY c.dataset)"""))
def reconcile_corruption(spark, sf_dir):
    run = synthesize(spark, sf_dir)
    parts = [reconcile(run.corrupted[ds]) for ds in DATASETS]
    return corrupt_ops.union_all(parts)


def reconcile(c: corrupt_ops.Corrupted) -> DataFrame:
    """CR-6: audited counts against what the data and the load path show.

    Two jobs: one aggregation over the audit and the flagged rows together, and
    one grouping by trans_id that yields both the duplicated ids and the copy a
    first-wins load keeps (``min_by`` on copy_no, no window).
    """
    fake_base = int(c.summary["fake_base"])
    ds = c.summary["dataset"]
    audit = c.audit.select(F.lit("audit").alias("_src"), "kind", "copy_no", "old_value",
                           F.lit(None).cast("bigint").alias("account_id"),
                           F.lit(None).cast("string").alias("k_symbol"),
                           F.lit(None).cast("string").alias("original_k_symbol"))
    data = c.flagged.select(F.lit("data").alias("_src"), F.lit(None).cast("string").alias("kind"),
                            "copy_no", F.lit(None).cast("string").alias("old_value"),
                            "account_id", "k_symbol", "original_k_symbol")
    a, d = F.col("_src") == "audit", F.col("_src") == "data"
    counts = audit.unionByName(data).agg(
        F.count_if(a & (F.col("kind") == "duplicate")).alias("dup"),
        F.count_if(a & (F.col("kind") == "referential_violation")).alias("ref"),
        F.count_if(a & (F.col("kind") == "referential_violation") & (F.col("copy_no") == 0))
         .alias("ref0"),
        F.count_if(a & (F.col("kind") == "missing_value") & F.col("old_value").isNotNull())
         .alias("mis"),
        F.count_if(d & (F.col("copy_no") != 0)).alias("added"),
        F.count_if(d & (F.col("account_id") >= fake_base)).alias("fake"),
        F.count_if(d & F.col("k_symbol").isNull()).alias("null_now"),
        F.count_if(d & F.col("original_k_symbol").isNull()).alias("null_before"),
    ).collect()[0]
    per_id = c.rows.groupBy("trans_id").agg(
        F.count(F.lit(1)).alias("n"),
        # The load path keeps the first copy (first-wins, as the insert-if-absent load).
        F.min_by("account_id", "copy_no").alias("kept_account"))
    ids = per_id.agg(F.count_if(F.col("n") > 1).alias("dup_ids"),
                     F.count_if(F.col("kept_account") >= fake_base).alias("fake_after")).collect()[0]
    checks = [
        ("rows_added_by_duplicates", counts["dup"], counts["added"]),
        ("duplicated_ids", counts["dup"], ids["dup_ids"]),
        ("fake_accounts", counts["ref"], counts["fake"]),
        ("fake_accounts_after_dedupe", counts["ref0"], ids["fake_after"]),
        ("k_symbol_nulled", counts["mis"], counts["null_now"] - counts["null_before"]),
    ]
    spark = c.rows.sparkSession
    rows = [(ds, name, int(e), int(o), "MATCH" if int(e) == int(o) else "MISMATCH")
            for name, e, o in checks]
    return spark.createDataFrame(
        rows, "dataset string, check_name string, expected long, observed long, status string")


def export(run: SynthRun, root: str) -> dict[str, str]:
    """SNK-7 + SNK-8: both corrupted sets as ';' CSV (load-test layout) and the
    manifest: the row-level audit (Parquet) plus one JSON summary row per set."""
    spark = next(iter(run.corrupted.values())).rows.sparkSession
    paths = {}
    for ds in DATASETS:
        paths[ds] = f"{root}/trans_{ds}.csv"
        delimited.write_delimited(run.corrupted[ds].rows, paths[ds], "trans_loadtest")
    return {**paths, **export_manifest(run, root)}


MANIFEST_SUMMARY = ("dataset string, random_seed long, target_rows long, rows_before long, rows_after long, "
                    "duplicate_count long, referential_violation_count long, missing_value_count long, "
                    "first_trans_id long, last_trans_id long, generated_at string")


def export_manifest(run: SynthRun, root: str) -> dict[str, str]:
    """SNK-8: the row-level audit as Parquet, and one JSON summary row per set with the counts of the
    written audit and of the rows."""
    spark = next(iter(run.corrupted.values())).rows.sparkSession
    paths = {"audit": f"{root}/manifest/audit", "summary": f"{root}/manifest/summary"}
    audit = corrupt_ops.union_all([run.corrupted[ds].audit for ds in DATASETS])
    audit.write.mode("overwrite").partitionBy("dataset").parquet(paths["audit"])
    kinds = spark.read.parquet(paths["audit"]).groupBy("dataset").agg(
        *[F.count_if(F.col("kind") == k).alias(f"{k}_count") for k in corrupt_ops.KINDS])
    rows = corrupt_ops.union_all([run.corrupted[ds].flagged.select("dataset", "trans_id", "copy_no") for ds in DATASETS])
    sizes = rows.groupBy("dataset").agg(
        F.count_if(F.col("copy_no") == 0).alias("rows_before"), F.count(F.lit(1)).alias("rows_after"),
        F.min("trans_id").alias("first_trans_id"), F.max("trans_id").alias("last_trans_id"))
    asked = spark.createDataFrame([(ds, SEED, run.sizes[ds]) for ds in DATASETS], "dataset string, random_seed long, target_rows long")
    (asked.join(sizes, "dataset", "left").join(kinds, "dataset", "left")
     .withColumn("generated_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))
     .coalesce(1).write.mode("overwrite").json(paths["summary"]))
    return paths


@register("synth_export_round_trip", _sql(
    "SELECT dataset, " + ", ".join(TRANS_COLUMNS) + " FROM corrupt_all"))
def synth_export_round_trip(spark, sf_dir):
    """Export both corrupted sets and the manifest, then read the CSVs back."""
    run = synthesize(spark, sf_dir)
    paths = export(run, scratch_path(spark, "synth-export"))
    return corrupt_ops.union_all([
        delimited.read_delimited(spark, paths[ds], "trans_loadtest").withColumn("dataset", F.lit(ds))
        for ds in DATASETS])


@register("manifest_missing_sample", _sql(f"""
    SELECT dataset, trans_id, copy_no, original_k_symbol FROM (
      SELECT dataset, trans_id, copy_no, old_value AS original_k_symbol,
        row_number() OVER (PARTITION BY dataset ORDER BY trans_id, copy_no) AS rn
      FROM audit_all WHERE kind = 'missing_value')
    WHERE rn <= {corrupt_ops.MANIFEST_SAMPLE}"""))
def manifest_missing_sample(spark, sf_dir):
    """O-2: the manifest keeps the original k_symbol of the first 20 nulled rows."""
    return corrupt_ops.missing_value_sample(_audit(spark, sf_dir, "missing_value"), DATASETS)


_QUALITY_CHECKS = [Rule("unique", "corrupted", "trans_id"),
                   Rule("relationships", "corrupted", "account_id", "warn", to_table="account", to_column="account_id"),
                   Rule("not_null", "corrupted", "k_symbol")]


@register("reconcile_quality", O.with_base(f"""
    SELECT dataset, check_name, CAST(expected AS BIGINT) AS expected, CAST(observed AS BIGINT) AS observed,
      CASE WHEN expected = observed THEN 'MATCH' ELSE 'MISMATCH' END AS status
    FROM (
      SELECT dataset, 'unique_trans_id' AS check_name, sum(CAST(is_copy AS INT)) AS expected,
        (SELECT count(*) FROM (SELECT trans_id FROM corrupt_all x WHERE x.dataset = c.dataset
                               GROUP BY trans_id HAVING count(*) > 1)) AS observed
      FROM corrupt_all c GROUP BY dataset
      UNION ALL
      SELECT dataset, 'account_relationship',
        count(*) FILTER (WHERE is_orphan OR original_account_id NOT IN (SELECT account_id FROM raw_account)),
        count(*) FILTER (WHERE account_id NOT IN (SELECT account_id FROM raw_account))
      FROM corrupt_all GROUP BY dataset
      UNION ALL
      SELECT dataset, 'dead_letters',
        count(*) FILTER (WHERE is_orphan OR original_account_id NOT IN (SELECT account_id FROM stream_profile)),
        count(*) FILTER (WHERE account_id NOT IN (SELECT account_id FROM stream_profile))
      FROM corrupt_all GROUP BY dataset
      UNION ALL
      SELECT dataset, 'k_symbol_not_null',
        count(*) FILTER (WHERE original_k_symbol IS NULL OR is_missing), count(*) FILTER (WHERE k_symbol IS NULL)
      FROM corrupt_all GROUP BY dataset)""", {**_all_ctes(), **PROFILE_CTE}))
def reconcile_quality(spark, sf_dir):
    """CR-6: the data tests and the stream's routing, run on the corrupted sets, find what the audit
    says, and besides only what the uncorrupted rows would have failed already (rows drawn for accounts
    that are orphans in the fit input, k_symbol values that were NULL)."""
    run = synthesize(spark, sf_dir)
    raw = td.raw_tables(spark, sf_dir)
    staged = mart.stage_all(raw)
    profile = profile_ops.stream_profile(staged.account, staged.disposition, staged.client, staged.district)
    accounts, profiled = raw.account.select("account_id").distinct(), profile.select("account_id")
    rows = []
    for ds in DATASETS:
        data = run.corrupted[ds].flagged
        found = {r["test"]: r["failures"] for r in quality.run_checks(
            {"corrupted": data, "account": raw.account}, _QUALITY_CHECKS).collect()}
        test = [r.name for r in _QUALITY_CHECKS]
        audited = data.agg(F.count_if("is_copy").alias("dup"), F.count_if("is_orphan").alias("ref"),
                           F.count_if(F.col("is_missing") | F.col("original_k_symbol").isNull()).alias("null")).first()
        # What the rows that weren't made orphans fail by themselves: counted by account first.
        own = data.where(~F.col("is_orphan")).groupBy("original_account_id").count().withColumnRenamed("original_account_id", "account_id")
        baseline = [own.join(k, "account_id", "left_anti").agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0] for k in (accounts, profiled)]
        dead = enrich.route(data, profile).where(F.col("dlq_reason").isNotNull()).count()
        checks = [("unique_trans_id", audited["dup"], found[test[0]]), ("account_relationship", audited["ref"] + baseline[0], found[test[1]]),
                  ("dead_letters", audited["ref"] + baseline[1], dead), ("k_symbol_not_null", audited["null"], found[test[2]])]
        rows += [(ds, n, int(e), int(o), "MATCH" if int(e) == int(o) else "MISMATCH") for n, e, o in checks]
    return spark.createDataFrame(rows, "dataset string, check_name string, expected long, observed long, status string")


_ROW_RULES = {"duplicate": Rule("unique", "staged", "trans_id"), "missing_value": Rule("not_null", "loaded", "k_symbol")}


@register("reconcile_rows", O.with_base("""
    SELECT coalesce(a.dataset, f.dataset) AS dataset, coalesce(a.kind, f.kind) AS kind,
      CASE WHEN f.trans_id IS NULL THEN 'audited only' WHEN a.trans_id IS NULL THEN 'found only' ELSE 'found and audited' END AS outcome,
      CAST(count(*) AS BIGINT) AS rows
    FROM audit_all a FULL JOIN (
      SELECT dataset, 'duplicate' AS kind, trans_id, copy_no FROM corrupt_all c
      WHERE (SELECT count(*) FROM corrupt_all x WHERE x.dataset = c.dataset AND x.trans_id = c.trans_id) > 1
      UNION ALL
      SELECT dataset, 'referential_violation', trans_id, copy_no FROM corrupt_all
      WHERE copy_no = 0 AND account_id NOT IN (SELECT account_id FROM stream_profile)
      UNION ALL
      SELECT dataset, 'missing_value', trans_id, copy_no FROM corrupt_all WHERE copy_no = 0 AND k_symbol IS NULL) f
      ON f.dataset = a.dataset AND f.kind = a.kind AND f.trans_id = a.trans_id AND f.copy_no = a.copy_no
    GROUP BY 1, 2, 3""", {**_all_ctes(), **PROFILE_CTE}))
def reconcile_rows(spark, sf_dir):
    """CR-6 by rows: the audit and what the tests and the dead letters found, joined on the row.

    Uniqueness is tested on the staged rows, the rest on the loaded ones (the first copy of each id), as the load
    leaves them; so errors of copies that the load drops are audited only, and rows that fail without having been
    corrupted (originals of copies, accounts that are orphans already, values that were NULL) are found only."""
    run, raw = synthesize(spark, sf_dir), td.raw_tables(spark, sf_dir)
    st = mart.stage_all(raw)
    profile = profile_ops.stream_profile(st.account, st.disposition, st.client, st.district)
    key = ["dataset", "kind", "trans_id", "copy_no"]
    found, audit = [], []
    for ds in DATASETS:
        rows = selection.dealt_over(run.corrupted[ds].rows, run.corrupted[ds].summary["rows_after"], "trans_id")
        loaded = staging.dedupe_first(rows, "trans_id", ["copy_no"])
        failing = {k: quality.failing_rows({"staged": rows, "loaded": loaded}, r) for k, r in _ROW_RULES.items()}
        failing["referential_violation"] = enrich.route(loaded, profile).where(F.col("dlq_reason").isNotNull())
        found += [df.select(F.lit(ds).alias("dataset"), F.lit(k).alias("kind"), "trans_id", "copy_no") for k, df in failing.items()]
        audit.append(run.corrupted[ds].audit.select(*key))
    a = corrupt_ops.union_all(audit).withColumn("audited", F.lit(True))
    f = corrupt_ops.union_all(found).withColumn("found", F.lit(True))
    outcome = (F.when(F.col("found").isNull(), "audited only").when(F.col("audited").isNull(), "found only")
               .otherwise("found and audited"))
    n = sum(run.corrupted[ds].summary["rows_after"] for ds in DATASETS)
    a, f = selection.dealt_over(a, n, *key), selection.dealt_over(f, n, *key)
    return (a.join(f, key, "full").groupBy("dataset", "kind", outcome.alias("outcome"))
            .agg(F.count(F.lit(1)).alias("rows")))
