"""Load and file queries: CSV round trip, idempotent append, full refresh."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import load, synth
from ..schemas import TRANS_COLUMNS
from ..session import scratch_path
from ..sources import delimited
from ..sources import testdata as td
from . import oracle as O
from .catalog import register
from .synth_queries import _sql as synth_sql
from .synth_queries import DATASETS, fit_input, synthesize

_COLS = ", ".join(TRANS_COLUMNS)


@register("csv_round_trip", O.with_base(f"SELECT {_COLS} FROM raw_trans"))
def csv_round_trip(spark, sf_dir):
    """SNK-7 then SRC-1/SRC-2: write the transactions in the load-test layout
    (k_symbol before balance), read them back by position, canonical order."""
    path = scratch_path(spark, "trans-csv")
    delimited.write_delimited(td.raw_trans(spark, sf_dir), path, "trans_loadtest")
    return delimited.read_delimited(spark, path, "trans_loadtest")


def _staged_load(spark, sf_dir):
    """The stored target (all real transactions, once each) and the staging table: both corrupted
    sets, copies included, then a replay of every real transaction, as a retried load delivers it."""
    target, staging = scratch_path(spark, "trans"), scratch_path(spark, "trans-staging")
    fit_input(spark, sf_dir).write.parquet(target)
    run = synthesize(spark, sf_dir)
    parts = [run.corrupted[ds].rows.select(*TRANS_COLUMNS, F.lit(i).alias("src"), F.col("copy_no").alias("seq"))
             for i, ds in enumerate(DATASETS)]
    parts.append(td.raw_trans(spark, sf_dir).select(*TRANS_COLUMNS, F.lit(len(parts)).alias("src"),
                                                    F.col("ingest_seq").alias("seq")))
    for part in parts:
        part.write.mode("append").parquet(staging)
    return target, spark.read.parquet(staging)


_STAGED_SQL = f"""
    SELECT {_COLS}, 0 AS src, copy_no AS seq FROM corrupt_dev
    UNION ALL SELECT {_COLS}, 1, copy_no FROM corrupt_loadtest
    UNION ALL SELECT {_COLS}, 2, ingest_seq FROM raw_trans"""
_INSERTED_SQL = f"""
    SELECT {_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY trans_id ORDER BY src, seq) AS rn
                         FROM ({_STAGED_SQL})) b
    WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM fit_in t WHERE t.trans_id = b.trans_id)"""


@register("idempotent_append", synth_sql(f"SELECT {_COLS} FROM fit_in UNION ALL {_INSERTED_SQL}"))
def idempotent_append(spark, sf_dir):
    """SNK-4: the stored table after the same load has run twice."""
    target, staging = _staged_load(spark, sf_dir)
    for _ in range(2):
        load.append_if_absent(spark, target, staging, "trans_id", ["src", "seq"])
    return spark.read.parquet(target).select(*TRANS_COLUMNS)


@register("load_audit", synth_sql(f"""
    SELECT * FROM (WITH c AS (SELECT (SELECT count(*) FROM fit_in) AS before, (SELECT count(*) FROM ({_STAGED_SQL})) AS staged,
                      (SELECT count(*) FROM ({_INSERTED_SQL})) AS added)
    SELECT CAST(1 AS BIGINT) AS run, CAST(before AS BIGINT) AS rows_before, CAST(staged AS BIGINT) AS staging_rows,
      CAST(added AS BIGINT) AS inserted_rows, CAST(before + added AS BIGINT) AS rows_after FROM c
    UNION ALL
    SELECT 2, before + added, staged, 0, before + added FROM c)"""))
def load_audit(spark, sf_dir):
    """SNK-5: counts of the stored table before and after each of two runs of the same load."""
    target, staging = _staged_load(spark, sf_dir)
    runs = [load.append_if_absent(spark, target, staging, "trans_id", ["src", "seq"])
            .select(F.lit(i).cast("bigint").alias("run"), "*") for i in (1, 2)]
    return runs[0].unionByName(runs[1])


@register("full_refresh_load", O.with_base("""
    SELECT 'district' AS table_name, CAST(count(*) AS BIGINT) AS loaded_rows,
      CAST(0 AS BIGINT) AS rejected_rows FROM raw_district
    UNION ALL
    SELECT 'account', CAST(count(*) FILTER (WHERE ok) AS BIGINT),
      CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT)
    FROM (SELECT a.*, (a.district_id IS NULL OR EXISTS (SELECT 1 FROM raw_district d
           WHERE d.district_id = a.district_id)) AS ok FROM raw_account a)
    UNION ALL
    SELECT 'client', CAST(count(*) FILTER (WHERE ok) AS BIGINT),
      CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT)
    FROM (SELECT c.*, (c.district_id IS NULL OR EXISTS (SELECT 1 FROM raw_district d
           WHERE d.district_id = c.district_id)) AS ok FROM raw_client c)
    UNION ALL
    SELECT 'disposition', CAST(count(*) FILTER (WHERE ok) AS BIGINT),
      CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT)
    FROM (SELECT x.*,
            (x.client_id IS NULL OR EXISTS (SELECT 1 FROM raw_client c
               WHERE c.client_id = x.client_id AND (c.district_id IS NULL OR EXISTS
                 (SELECT 1 FROM raw_district d WHERE d.district_id = c.district_id))))
            AND (x.account_id IS NULL OR EXISTS (SELECT 1 FROM raw_account a
               WHERE a.account_id = x.account_id AND (a.district_id IS NULL OR EXISTS
                 (SELECT 1 FROM raw_district d WHERE d.district_id = a.district_id)))) AS ok
          FROM raw_disposition x)
    UNION ALL
    SELECT 'trans', CAST(count(*) AS BIGINT), CAST(0 AS BIGINT) FROM raw_trans"""))
def full_refresh_load(spark, sf_dir):
    """SNK-3 + J-10: truncate-and-reload every table in dependency order; rows
    whose parent was not loaded are rejected (counts per table)."""
    raw = td.raw_tables(spark, sf_dir)
    root = scratch_path(spark, "full-refresh")

    def write(name, df):
        df.write.mode("overwrite").parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    tables = {"district": raw.district, "account": raw.account, "client": raw.client,
              "disposition": raw.disposition, "trans": raw.trans.drop("ingest_seq")}
    _, counts = load.full_refresh(tables, write)
    return counts


@register("fit_from_csv", synth_sql("""
    SELECT op_key, CAST(count(*) AS BIGINT) AS n, CAST(min(amount) AS DOUBLE) AS amount_min, CAST(max(amount) AS DOUBLE) AS amount_max,
      CAST((SELECT count(*) FROM fit_in WHERE trans_id % 97 IN (5, 6)) AS BIGINT) AS bad_lines,
      CAST((SELECT count(*) FROM fit_in WHERE trans_id % 97 NOT IN (5, 6)) AS BIGINT) AS good_lines,
      CAST((SELECT count(DISTINCT account_id) FROM fit_in WHERE trans_id % 97 NOT IN (5, 6)) AS BIGINT) AS accounts
    FROM (SELECT *, coalesce(operation, '__MISSING__') AS op_key FROM fit_in WHERE amount > 0 AND trans_id % 97 NOT IN (5, 6))
    GROUP BY op_key"""))
def fit_from_csv(spark, sf_dir):
    """SRC-3: the fit from a file with broken lines (a field of another type; too few fields): those are counted and
    kept apart, and the rest is fitted."""
    path, layout = scratch_path(spark, "trans-broken-csv"), delimited.FILE_LAYOUTS["trans"]
    rows = fit_input(spark, sf_dir)
    part = F.col("trans_id") % 97
    delimited.write_delimited(rows.where(~part.isin(5, 6)), path, "trans")
    text = rows.select(*[F.col(c).cast("string").alias(c) if c != "trans_id" else F.col(c) for c in layout])
    options = {"sep": delimited.SEPARATOR, "header": "true"}
    text.where(part == 5).withColumn("amount", F.lit("n/a")).write.mode("append").options(**options).csv(path)
    text.where(part == 6).select(*layout[:3]).write.mode("append").options(**options).csv(path)
    good, bad = delimited.read_with_rejects(spark, path, "trans")
    model = synth.fit(spark, good)
    return model.operations.select("op_key", "n", "amount_min", "amount_max", F.lit(bad.count()).cast("long").alias("bad_lines"),
                                   F.lit(int(model.scalars["rows"])).cast("long").alias("good_lines"),
                                   F.lit(int(model.scalars["accounts"])).cast("long").alias("accounts"))


@register("full_refresh_switch", O.with_base("""
    SELECT step, table_name, CAST(n AS BIGINT) AS rows FROM (
      SELECT unnest(['after the first', 'after the broken one']) AS step, 'client' AS table_name, (SELECT count(*) FROM raw_client WHERE client_id % 2 = 0) AS n
      UNION ALL SELECT unnest(['after the first', 'after the broken one']), 'district', (SELECT count(*) FROM raw_district)
      UNION ALL SELECT 'after the whole one', 'client', (SELECT count(*) FROM raw_client WHERE district_id IN (SELECT district_id FROM raw_district))
      UNION ALL SELECT 'after the whole one', 'district', (SELECT count(*) FROM raw_district)
      UNION ALL SELECT 'after the whole one', 'trans', (SELECT count(*) FROM raw_trans))"""))
def full_refresh_switch(spark, sf_dir):
    """SNK-3 as one switch: what a reader sees after a first load, after one that broke between its tables, and after a
    whole one.  The second never shows, though its district table was written."""
    raw = td.raw_tables(spark, sf_dir)
    store = load.LoadedTables(scratch_path(spark, "loads"))
    seen = []

    def look(step):
        for name, df in store.read(spark).items():
            seen.append((step, name, df.count()))

    no_district = raw.client.where("client_id % 2 = 0").withColumn("district_id", F.lit(None).cast("long"))
    store.refresh({"district": raw.district, "client": no_district}, 1)
    look("after the first")

    def broken(loaded):
        raise RuntimeError("the load is broken")
    try:
        store.refresh({"district": raw.district.where("district_id < 3"), "client": raw.client}, 2, check=broken)
    except RuntimeError:
        look("after the broken one")
    store.refresh({"district": raw.district, "client": raw.client, "trans": raw.trans.drop("ingest_seq")}, 3)
    look("after the whole one")
    return spark.createDataFrame(seen, "step string, table_name string, rows long")
