"""CDC sources and sinks (SRC-5 ... SRC-7, SNK-1, SNK-2, F-12).

The production source is Kafka (``readStream.format("kafka")``); the envelope
is the flattened after-image with ``__op/__table/__lsn/__source_ts_ms`` and
``__deleted``.  Tests and the supplied data use file streams with the same
columns, so the parsing and routing functions are shared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cdc import drop_tombstone_messages, route_topic
from ..operators.enrich import UNREADABLE
from ..schemas import CDC_PROFILE, STATE_COLUMNS
from . import testdata as td

CDC_PROFILE_FIELDS = CDC_PROFILE.fields

# Topic names and consumer settings of the reference deployment.
TRANS_TOPIC = "cdc.public.trans"
PROFILE_TOPICS = ["cdc.public.account", "cdc.public.client", "cdc.public.disposition",
                  "cdc.public.district"]
ENRICHED_TOPIC = "transactions.events"
DLQ_TOPIC = "transactions.dlq"


def kafka_stream(spark: SparkSession, bootstrap: str, topics: list[str],
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Kafka source from the earliest offset (needs the Kafka connector on the classpath).

    ``max_offsets_per_trigger`` bounds a micro-batch, so that a long backlog is
    worked off in several; without it a batch takes all there is.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap)
              .option("subscribe", ",".join(topics))
              .option("startingOffsets", "earliest"))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return reader.load()


def parse_envelope(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """FL-3 + F-12: drop tombstones (NULL value), then decode the JSON value.

    Keeps ``topic``-derived ``__table`` when the message carries no table name,
    and the Kafka offset coordinates as tie-breakers for ordering.  A value that
    is no JSON object of this shape keeps its text in ``__unreadable`` and has no
    other field: no message is dropped, the router dead-letters it.
    """
    msgs = drop_tombstone_messages(messages)
    if "topic" in msgs.columns:
        msgs = route_topic(msgs).withColumnRenamed("__table", "_topic_table")
    extra = [c for c in ("_topic_table", "partition", "offset") if c in msgs.columns]
    text = F.col("value").cast("string")
    marked = T.StructType([*schema.fields, T.StructField(UNREADABLE, T.StringType(), True)])
    parsed = msgs.select(text.alias("_text"), F.from_json(text, marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNREADABLE})
                         .alias("r"), *extra)
    bad = F.col(f"r.{UNREADABLE}").isNotNull() | F.col("r").isNull() | ~F.ltrim("_text").startswith("{")
    out = parsed.select(*[F.when(~bad, F.col(f"r.`{f.name}`")).alias(f.name) for f in schema.fields],
                        F.when(bad, F.col("_text")).alias(UNREADABLE), *extra)
    if "_topic_table" in out.columns:
        tbl = F.coalesce(F.col("__table"), F.col("_topic_table")) if "__table" in out.columns \
            else F.col("_topic_table")
        out = out.withColumn("__table", tbl).drop("_topic_table")
    return out


def json_records(df: DataFrame, key_col: str = "trans_id") -> DataFrame:
    """SNK-1/SNK-2 payload: key = key text, value = JSON with NULL fields kept."""
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    return df.select(F.col(key_col).cast("string").alias("key"), value.alias("value"))


def kafka_sink_options(bootstrap: str, topic: str) -> dict[str, str]:
    """Producer settings matching the reference (acks=all, 3 retries)."""
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic,
            "kafka.acks": "all", "kafka.retries": "3"}


def kafka_write(df: DataFrame, bootstrap: str, topic: str, key_col: str = "trans_id") -> None:
    """SNK-1/SNK-2 batch write to Kafka (inside ``foreachBatch``): JSON value with
    NULL fields kept, key = ``key_col`` as text.  At-least-once: a replayed
    micro-batch sends its records again (consumers dedupe on the key)."""
    (json_records(df, key_col).write.format("kafka")
     .options(**kafka_sink_options(bootstrap, topic)).save())


def events_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None
                  ) -> DataFrame:
    """The supplied ``events`` table as a file stream of CDC transactions."""
    schema = td.read_table(spark, sf_dir, "events").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return td.events_as_cdc_trans(reader.parquet(sf_dir))


def parquet_stream(spark: SparkSession, path: str, schema: T.StructType,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


FILE_ROWS = 100_000


def arrivals(rows: DataFrame, order: str, count: int, path: str, files: int = 2) -> int:
    """Rows as files that arrive one after another: those of ``order`` 0 first, then 1, ...; returns files for each:
    ``files``, or more where the smallest arrival has over FILE_ROWS rows for each, since a file is one task's.

    A file stream over ``path`` that takes ``files`` at each trigger has one micro-batch for each arrival (each
    needs as many rows as files).
    """
    sizes = [r["count"] for r in rows.groupBy(F.col(order).alias("_a")).count().where(F.col("_a").between(0, count - 1)).collect()]
    files = max(files, min(sizes, default=0) // FILE_ROWS)
    for i in range(count):
        (rows.where(F.col(order) == i).drop(order).repartition(files)
         .write.mode("overwrite" if i == 0 else "append").parquet(path))
    return files


def json_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None
                ) -> DataFrame:
    """Text lines as Kafka-like messages (``value``), e.g. a captured topic dump."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.text(path)


SNAPSHOT_LSN = -1


def snapshot_changes(tables: dict[str, DataFrame]) -> DataFrame:
    """Initial snapshot of the profile tables as change records (``__op`` = 'r',
    the lowest lsn), in the routed profile-envelope shape."""
    parts = []
    for name, cols in STATE_COLUMNS.items():
        if name not in tables:
            continue
        parts.append(tables[name].select(
            *cols, F.lit("r").alias("__op"), F.lit(name).alias("__table"),
            F.lit(SNAPSHOT_LSN).cast("bigint").alias("__lsn"),
            F.lit(0).cast("bigint").alias("__source_ts_ms"), F.lit("false").alias("__deleted")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in out.columns
                        else F.lit(None).cast(f.dataType).alias(f.name)
                        for f in CDC_PROFILE_FIELDS])


def as_profile_changes(log: DataFrame, table: str) -> DataFrame:
    """A single table's change log in the routed profile-envelope shape."""
    tagged = log.withColumn("__table", F.lit(table))
    return tagged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in tagged.columns
                           else F.lit(None).cast(f.dataType).alias(f.name)
                           for f in CDC_PROFILE_FIELDS])
