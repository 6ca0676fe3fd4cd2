"""Profile state from CDC streams (ST-1, ST-2, ST-4 in streaming form).

Each micro-batch is merged into the state in one Spark job: the rows of the version
before and the batch's changes, ``max_by`` per table and key over the total order of
changes, written as a new Parquet folder that is never changed afterwards.  A one-row
file then points to it, so readers see whole versions of all four tables only, and a
crash before that leaves nothing behind that is read.  A replayed batch goes on from
the version before its own and writes the same rows again.

``keyed_profile`` looks the accounts of a micro-batch up: their keys go down through the
four hops (account, owner, client, district), so what is joined is of the batch's size.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import cdc
from ..operators import profile as profile_ops
from ..schemas import CDC_PROFILE, STATE_COLUMNS, STATE_KEYS
from ..session import work_dir

# Warm-up gate defaults.
WARMUP_MIN_ACCOUNTS = 100
WARMUP_TIMEOUT_S = 120
WARMUP_POLL_S = 2

META = ["__op", "__lsn", "__source_ts_ms", "__deleted"]
STATE = T.StructType([*CDC_PROFILE.fields, *[T.StructField(c, T.LongType()) for c in cdc.TIE_BREAKERS],
                      T.StructField("__key", T.LongType())])


@dataclass
class ProfileStore:
    root: str

    def folder(self, version: int) -> str:
        return f"{self.root}/state/version-{version}"

    def versions(self, spark: SparkSession) -> list[int]:
        """Published versions in ascending order (one number for each micro-batch)."""
        try:
            rows = spark.read.schema("version long").json(f"{self.root}/_versions").distinct().collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(r.version for r in rows)

    def newest(self, spark: SparkSession) -> int | None:
        return max(self.versions(spark), default=None)

    def read_all(self, spark: SparkSession, version: int | None) -> DataFrame:
        """The latest row of every table and key, tombstones included; nothing before the first version."""
        if version is None:
            return spark.createDataFrame([], STATE)
        return spark.read.schema(STATE).parquet(self.folder(version))

    def read_live(self, spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
        """Live rows of a table in a version (the newest by default); the folder of a table is all that is read."""
        rows = self.read_all(spark, self.newest(spark) if version is None else version)
        live = rows.where((F.col("__table") == F.lit(table)) & ~cdc.is_deleted(rows))
        return live.select(*STATE_COLUMNS[table], *META)


def publish(spark: SparkSession, store: ProfileStore, batch: DataFrame, batch_id: int) -> None:
    """Merge the batch's changes into the state and publish the version ``batch_id``."""
    before = max((v for v in store.versions(spark) if v < batch_id), default=None)
    key = F.coalesce(*[F.when(F.col("__table") == t, F.col(k)) for t, k in STATE_KEYS.items() if k in batch.columns])
    columns = {f.name: F.col(f.name).cast(f.dataType) if f.name in batch.columns else F.lit(None).cast(f.dataType)
               for f in STATE.fields if f.name != "__key"}
    changes = batch.where(F.col("__table").isin(*STATE_KEYS)).select(*[c.alias(n) for n, c in columns.items()], key.alias("__key"))
    merged = cdc.latest(store.read_all(spark, before).unionByName(changes), ["__table", "__key"]).drop("__is_deleted")
    merged.write.mode("overwrite").partitionBy("__table").parquet(store.folder(batch_id))
    (spark.createDataFrame([(batch_id,)], "version long").coalesce(1)
     .write.mode("overwrite").json(f"{store.root}/_versions/batch={batch_id}"))


def make_state_writer(spark: SparkSession, store: ProfileStore):
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        publish(spark, store, batch, batch_id)
    return write_batch


def start_profile_stream(spark: SparkSession, changes: DataFrame, root: str,
                         available_now: bool = True, every: str = "1 second") -> StreamingQuery:
    """``changes``: a streaming DataFrame of routed profile changes (``__table`` set)."""
    work_dir(spark)
    w = (changes.writeStream.foreachBatch(make_state_writer(spark, ProfileStore(root)))
         .option("checkpointLocation", f"{root}/_checkpoint"))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=every)).start()


def keyed_profile(spark: SparkSession, root: str, keys: DataFrame | None, version: int | None = None
                  ) -> tuple[DataFrame, int | None]:
    """The profile of the accounts ``keys`` (all where None) in a version, the newest by default, and that version.

    All four tables are of one version.  Before the first one the profile is empty."""
    store = ProfileStore(root)
    version = store.newest(spark) if version is None else version
    rows = store.read_all(spark, version)
    live = {t: rows.where((F.col("__table") == F.lit(t)) & ~cdc.is_deleted(rows)) for t in STATE_KEYS}
    accounts, held = live["account"], live["disposition"]
    if keys is not None:
        accounts, held = (x.join(keys.select("account_id"), "account_id", "left_semi") for x in (accounts, held))
    # The newest live OWNER disposition of an account by change order, not by disp_id; one state row per disp_id.
    owners = cdc.newest_owner(held).withColumn("disposition_type", F.lit("OWNER"))
    profile = profile_ops.stream_profile(accounts, owners, live["client"], live["district"].withColumnRenamed("name", "district_name"))
    return profile, version


def load_stream_profile(spark: SparkSession, root: str) -> tuple[DataFrame, int | None]:
    """The whole profile of the newest version, and that version."""
    return keyed_profile(spark, root, None)


def live_accounts(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    return ProfileStore(root).read_live(spark, "account", version)


def profile_ready(spark: SparkSession, root: str, min_accounts: int = WARMUP_MIN_ACCOUNTS, version: int | None = None) -> bool:
    """ST-4 warm-up gate: enough live accounts to start the transaction stream."""
    return live_accounts(spark, root, version).limit(min_accounts).count() >= min_accounts


def wait_for_profile(spark: SparkSession, root: str, min_accounts: int = WARMUP_MIN_ACCOUNTS,
                     timeout_s: float = WARMUP_TIMEOUT_S, poll_s: float = WARMUP_POLL_S) -> bool:
    """ST-4: poll the state until ``min_accounts`` live accounts exist or the
    timeout passes; returns whether the gate opened (callers go on regardless:
    misses then go to the dead letters, and the metrics tell)."""
    return opening_version(spark, root, min_accounts, timeout_s, poll_s) is not None


def opening_version(spark: SparkSession, root: str, min_accounts: int = WARMUP_MIN_ACCOUNTS,
                    timeout_s: float = WARMUP_TIMEOUT_S, poll_s: float = WARMUP_POLL_S) -> int | None:
    """The first version with ``min_accounts`` live accounts, as soon as it is there; None after the timeout.

    Versions are looked at in their order, so the answer doesn't hang on how fast the profile stream works."""
    deadline, seen = time.monotonic() + timeout_s, -1
    while True:
        for version in [v for v in ProfileStore(root).versions(spark) if v > seen]:
            if profile_ready(spark, root, min_accounts, version):
                return version
            seen = version
        if time.monotonic() >= deadline:
            return None
        time.sleep(poll_s)


def wait_for_version(spark: SparkSession, root: str, version: int, alive=lambda: True, poll_s: float = 0.2) -> int | None:
    """``version`` once it is published; the newest one if its stream ends before."""
    while True:
        going = alive()
        newest = ProfileStore(root).newest(spark)
        if newest is not None and newest >= version:
            return version
        if not going:
            return newest
        time.sleep(poll_s)
