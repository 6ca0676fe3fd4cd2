"""Structured Streaming enrichment with two outputs (ST-3 ... ST-7, SNK-1, SNK-2).

The transaction stream is joined, per micro-batch, with the *current* profile:
``profile_loader`` is called inside ``foreachBatch`` with the batch's distinct
account keys and gives the profile of those, from the newest profile table (a
plain stream-static join would keep the first file listing of a Parquet dimension).

Replay safety: each batch writes its enriched rows, dead letters and metrics to
``<out>/<kind>/batch_id=<n>`` with overwrite, so a batch re-run after a failure
replaces its own output instead of duplicating it; the checkpoint makes the
offsets durable.  Metrics are gathered with ``observe`` during the enriched
write, so they cost no extra pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import enrich
from ..schemas import CDC_PROFILE, CDC_TRANS, ENRICHED_FIELDS


@dataclass
class StreamOutputs:
    root: str

    @property
    def enriched(self) -> str:
        return f"{self.root}/enriched"

    @property
    def dead_letters(self) -> str:
        return f"{self.root}/dlq"

    @property
    def metrics(self) -> str:
        return f"{self.root}/metrics"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/_checkpoint"


METRICS = ("processed long, enriched long, dlq long, dlq_missing_account long, "
           "profile_version long, profile_warm boolean")


def _batch_path(base: str, batch_id: int) -> str:
    return f"{base}/batch_id={batch_id}"


class ParquetSinks:
    """Enriched rows and dead letters as Parquet under ``batch_id=<n>`` (overwrite:
    a replayed batch replaces its own output, so the file sinks are exactly-once)."""

    def __init__(self, out: StreamOutputs):
        self.out = out

    def enriched(self, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(_batch_path(self.out.enriched, batch_id))

    def dead_letters(self, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(_batch_path(self.out.dead_letters, batch_id))


class KafkaSinks:
    """Enriched rows and dead letters as JSON records on two topics (needs the
    Kafka connector on the classpath)."""

    def __init__(self, bootstrap: str, enriched_topic: str, dlq_topic: str):
        self.bootstrap, self.enriched_topic, self.dlq_topic = bootstrap, enriched_topic, dlq_topic

    def enriched(self, df: DataFrame, batch_id: int) -> None:
        from ..sources.cdc import kafka_write
        kafka_write(df, self.bootstrap, self.enriched_topic)

    def dead_letters(self, df: DataFrame, batch_id: int) -> None:
        from ..sources.cdc import kafka_write
        kafka_write(df, self.bootstrap, self.dlq_topic)


def account_keys(batch: DataFrame) -> DataFrame:
    """The distinct accounts of a micro-batch.  They go first: a left outer join can only build on the
    profile side, so the profile is cut down to them before it is put together."""
    return batch.select("account_id").where(F.col("account_id").isNotNull()).distinct()


ProfileLoader = Callable[[DataFrame, int], DataFrame | tuple[DataFrame, int | None]]


def make_batch_writer(spark: SparkSession, profile_loader: ProfileLoader,
                      out: StreamOutputs, sinks=None, warm: bool = True) -> Callable[[DataFrame, int], None]:
    """``profile_loader(keys, batch_id)`` gives the profile of these accounts, or the profile and its
    version, which the batch's metrics then carry; ``warm`` tells whether the gate had opened."""
    sinks = sinks or ParquetSinks(out)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # Keys and join both read the batch: taken from the source once, by an action of its own, since
        # stages that run side by side would each read it.
        batch = batch.persist()
        batch.count()
        loaded = profile_loader(account_keys(batch), batch_id)
        profile, version = loaded if isinstance(loaded, tuple) else (loaded, None)
        # Written to both sinks, so the join is done once.
        routed = enrich.route(batch, profile).persist()
        try:
            obs = Observation(f"enrich_{batch_id}")
            observed = routed.observe(obs, *enrich.metric_columns())
            # One pass over `observed` computes the metrics while writing enriched rows.
            sinks.enriched(enrich.enriched(observed), batch_id)
            sinks.dead_letters(
                enrich.dead_letters(routed, nested=True).withColumn(
                    "dlq_published_at",
                    F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")),
                batch_id)
            m = obs.get
            row = [(int(batch_id), int(m.get("processed", 0)), int(m.get("enriched", 0)),
                    int(m.get("dlq", 0)), int(m.get("dlq_missing_account", 0)), version, warm)]
            (spark.createDataFrame(row, f"batch_id long, {METRICS}").drop("batch_id").coalesce(1)
             .write.mode("overwrite").parquet(_batch_path(out.metrics, batch_id)))
        finally:
            routed.unpersist()
            batch.unpersist()
    return write_batch


def start_enrichment(spark: SparkSession, transactions: DataFrame,
                     profile_loader: ProfileLoader, out_root: str,
                     available_now: bool = True, sinks=None, warm: bool = True,
                     every: str = "1 second") -> StreamingQuery:
    """Start the enrichment query over a streaming DataFrame of CDC transactions.

    ``out_root`` holds the checkpoint and the per-batch metrics; ``sinks``
    (default Parquet below ``out_root``) receives enriched rows and dead letters.
    No record is filtered: deleted transactions pass (Q-3), and what can't be read
    or has no key goes to the dead letters with its reason.
    """
    out = StreamOutputs(out_root)
    writer = (transactions.writeStream.foreachBatch(make_batch_writer(spark, profile_loader, out, sinks, warm))
              .option("checkpointLocation", out.checkpoint))
    with state_on_disk(spark):
        return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)).start()


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started within keep their state in RocksDB, not as maps in executor memory, unless the session names a
    state store itself.  A stream takes the settings when it starts, and a restarted one those of its checkpoint."""
    if spark.conf.get(STATE_STORE, None) is not None:
        yield
        return
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(STATE_STORE)


def _read_batches(spark: SparkSession, path: str, empty: T.StructType) -> DataFrame:
    """What the batches wrote; a source without records has written none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], T.StructType([*empty.fields, T.StructField("batch_id", T.IntegerType())]))


def read_outputs(spark: SparkSession, out_root: str) -> dict[str, DataFrame]:
    out = StreamOutputs(out_root)
    types = {f.name: f for s in (CDC_TRANS, CDC_PROFILE) for f in s.fields}
    enriched = T.StructType([types.get(c, T.StructField(c, T.BooleanType() if c == "__enriched" else T.StringType()))
                             for c in ENRICHED_FIELDS])
    dead = T.StructType([T.StructField("original_transaction", CDC_TRANS), T.StructField("dlq_reason", T.StringType()),
                         *[types[c] for c in ("trans_id", "account_id", "__source_ts_ms")],
                         T.StructField("dlq_published_at", T.StringType())])
    return {
        "enriched": _read_batches(spark, out.enriched, enriched),
        "dead_letters": _read_batches(spark, out.dead_letters, dead),
        "metrics": _read_batches(spark, out.metrics, T.StructType.fromDDL(METRICS)),
    }


def deduplicated(transactions: DataFrame, key: str = "trans_id", event_time: str | None = None,
                 within: str | None = None) -> DataFrame:
    """ST-5: the first delivery of each key, over all micro-batches, by Spark's state store.

    Without ``within`` each key is remembered for good, so that the result is W-1's; with it (and an
    ``event_time`` column) keys are forgotten once the watermark is ``within`` past them, which bounds the
    state, and repeated deliveries must come within that time.  A NULL key is no key: those rows all pass.
    ``start_enrichment`` keeps it in RocksDB: on disk, and not in executor memory.
    """
    if within is not None:
        transactions = transactions.withWatermark(event_time, within)
    keyed, rest = transactions.where(F.col(key).isNotNull()), transactions.where(F.col(key).isNull())
    kept = keyed.dropDuplicates([key]) if within is None else keyed.dropDuplicatesWithinWatermark([key])
    return kept.union(rest)


def drained(query: StreamingQuery) -> None:
    """Wait until an ``availableNow`` query has taken all of its source, however long that takes."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def run_to_completion(spark: SparkSession, transactions: DataFrame,
                      profile_loader: ProfileLoader, out_root: str,
                      warm: bool = True) -> dict[str, DataFrame]:
    """Run with ``availableNow`` until the source is drained; return the outputs."""
    drained(start_enrichment(spark, transactions, profile_loader, out_root, available_now=True, warm=warm))
    return read_outputs(spark, out_root)
