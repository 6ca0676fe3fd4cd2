"""Loading: idempotent append and full refresh with key checks (SNK-3 ... SNK-5, J-9, J-10).

``insert_if_absent`` is the set-based form of "COPY into an unconstrained
staging table, then INSERT ... ON CONFLICT DO NOTHING": first-wins dedupe of
the batch on the key (W-1), then a left-anti join against the target's keys.
Re-running it with the same batch inserts nothing, so a retried load is safe.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .staging import dedupe_first


def insert_if_absent(target_keys: DataFrame, batch: DataFrame, key: str,
                     order: list[str] | None = None) -> DataFrame:
    """Rows of ``batch`` to append: first copy per key, key not yet in the target."""
    first = dedupe_first(batch, key, order)
    return first.join(target_keys.select(key), key, "left_anti")


def append_if_absent(spark: SparkSession, path: str, batch: DataFrame, key: str,
                     order: list[str] | None = None) -> DataFrame:
    """SNK-4 + SNK-5: append to the stored table at ``path`` what it doesn't hold yet.

    Returns one row: rows of the table before, rows of the batch, rows of the table
    after, and the difference as inserted rows.  All are counted on what is stored,
    before and after the load; a second run of the same batch inserts nothing.
    """
    target = spark.read.parquet(path)
    before = target.count()
    seen = Observation()
    insert_if_absent(target, batch.observe(seen, F.count(F.lit(1)).alias("n")), key, order).select(
        *target.columns).write.mode("append").parquet(path)
    after = spark.read.parquet(path).count()
    return spark.createDataFrame([(before, int(seen.get["n"]), after - before, after)],
                                 "rows_before long, staging_rows long, inserted_rows long, rows_after long")


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


# Load order and the declared foreign keys.
LOAD_ORDER = ["district", "account", "client", "disposition", "trans"]
FOREIGN_KEYS = {
    "district": [],
    "account": [ForeignKey("district_id", "district", "district_id")],
    "client": [ForeignKey("district_id", "district", "district_id")],
    "disposition": [ForeignKey("client_id", "client", "client_id"),
                    ForeignKey("account_id", "account", "account_id")],
    "trans": [],  # trans.account_id deliberately has no foreign key
}


def tag_keys(table: DataFrame, fks: list[ForeignKey], loaded: dict[str, DataFrame]) -> DataFrame:
    """Add ``_ok``: every non-NULL foreign key has a parent among the loaded rows.

    One left join per key against the parent's distinct keys (dimension-sized;
    AQE broadcasts it when small and splits a hot key's partition otherwise).
    """
    tagged = table.withColumn("_ok", F.lit(True))
    for fk in fks:
        parents = (loaded[fk.parent].select(F.col(fk.parent_column).alias("_pk")).distinct()
                   .withColumn("_hit", F.lit(True)))
        tagged = (tagged.join(parents, F.col(fk.column) == F.col("_pk"), "left")
                  .withColumn("_ok", F.col("_ok") & (F.col(fk.column).isNull()
                                                      | F.col("_hit").isNotNull()))
                  .drop("_pk", "_hit"))
    return tagged


@dataclass
class LoadedTables:
    """SNK-3 as one switch: every load goes to a folder of its own, and a one-row file written last names it.

    Readers take the newest named load, so they see the five tables of one whole load, also while another
    one runs or after it has failed.
    """
    root: str

    def refresh(self, tables: dict[str, DataFrame], load_id: int, check=None) -> DataFrame:
        """Write all tables of a load, check them, then publish it; returns the counts of each table."""
        def write(name: str, df: DataFrame) -> DataFrame:
            path = f"{self.root}/load-{load_id}/{name}"
            df.write.mode("overwrite").parquet(path)
            return df.sparkSession.read.schema(df.schema).parquet(path)
        loaded, counts = full_refresh(tables, write)
        if check is not None:
            check(loaded)
        spark = counts.sparkSession
        (spark.createDataFrame([(load_id, sorted(loaded))], "load_id long, tables array<string>").coalesce(1)
         .write.mode("overwrite").json(f"{self.root}/_published/load={load_id}"))
        return counts

    def read(self, spark: SparkSession) -> dict[str, DataFrame]:
        """The tables of the newest published load; none before the first."""
        try:
            last = (spark.read.schema("load_id long, tables array<string>").json(f"{self.root}/_published")
                    .agg(F.max_by("tables", "load_id").alias("tables"), F.max("load_id").alias("load_id")).first())
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        return {t: spark.read.parquet(f"{self.root}/load-{last.load_id}/{t}") for t in last.tables}

    def create_views(self, spark: SparkSession, prefix: str = "") -> list[str]:
        """Views of the newest load, replaced one after another by names that all point into one folder."""
        tables = self.read(spark)
        for name, df in tables.items():
            df.createOrReplaceTempView(f"{prefix}{name}")
        return sorted(tables)


def full_refresh(tables: dict[str, DataFrame], write) -> tuple[dict[str, DataFrame], DataFrame]:
    """SNK-3: reload every table in dependency order with key checks.

    ``write(name, df) -> DataFrame`` persists a table (overwrite) and returns
    the re-read table, so children check against what was actually loaded.
    Returns the loaded tables and per-table counts (SNK-5).
    """
    loaded: dict[str, DataFrame] = {}
    counts = []
    for name in LOAD_ORDER:
        if name not in tables:
            continue
        # Both counts are taken while the accepted rows are written.
        seen = Observation()
        tagged = tag_keys(tables[name], FOREIGN_KEYS[name], loaded).observe(
            seen, F.count_if(F.col("_ok")).alias("ok"), F.count_if(~F.col("_ok")).alias("bad"))
        loaded[name] = write(name, tagged.where(F.col("_ok")).drop("_ok"))
        counts.append((name, int(seen.get["ok"]), int(seen.get["bad"])))
    spark = next(iter(tables.values())).sparkSession
    return loaded, spark.createDataFrame(counts, "table_name string, loaded_rows long, rejected_rows long")
