"""Running metrics over the life of a stream (A-6): a listener that gathers each micro-batch's observed figures.

``arriving`` puts the counters into the stream; ``RunningMetrics`` hears of every batch's progress and of the
stop, also of a failed one, and ``table`` stores what it has heard as one row for each batch.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

OBSERVED = "arrived"
SCHEMA = "run_id string, batch_id long, processed long, missing_account long, deleted long"


def arriving(transactions: DataFrame) -> DataFrame:
    """The stream with counters of what arrives; each micro-batch must be read once (the enrichment persists it)."""
    return transactions.observe(
        OBSERVED, F.count(F.lit(1)).alias("processed"), F.count_if(F.col("account_id").isNull()).alias("missing_account"),
        F.count_if(F.col("__deleted") == "true").alias("deleted"))


class RunningMetrics(StreamingQueryListener):
    """One row for each run and batch; a batch that is run again replaces its row of the same run."""

    def __init__(self) -> None:
        self._rows: dict[tuple[str, int], tuple] = {}
        self._stopped: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _stop_of(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._stopped.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._stop_of(str(event.runId))

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(OBSERVED)
        if seen is not None and seen["processed"]:
            run, batch = str(event.progress.runId), int(event.progress.batchId)
            with self._lock:
                self._rows[run, batch] = (run, batch, int(seen["processed"]), int(seen["missing_account"]), int(seen["deleted"]))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._stop_of(str(event.runId)).set()

    def wait(self, query: StreamingQuery, timeout_s: float = 60) -> bool:
        """Until the listener has heard of the query's stop: events come some time after it."""
        return self._stop_of(str(query.runId)).wait(timeout_s)

    def table(self, spark: SparkSession, path: str) -> DataFrame:
        """What has been heard so far, stored and read again."""
        with self._lock:
            rows = sorted(self._rows.values())
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)
        return spark.read.schema(SCHEMA).parquet(path)
