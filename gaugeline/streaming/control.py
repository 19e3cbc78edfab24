"""Operating a stream: show, pause, resume, stop."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..plans.labels import batch_label


def _lag(source: dict[str, Any]) -> dict[str, Any]:
    """The source's own figures, and rows that came in faster than they were handled, a second."""
    told = dict(source["metrics"] or {})
    coming, done = source.get("inputRowsPerSecond"), source.get("processedRowsPerSecond")
    if coming is not None and done is not None:
        told["rowsPerSecondBehind"] = max(0.0, coming - done)
    return told


class StreamJob:
    """A stream that can be paused and resumed; its checkpoint keeps the offsets in between.

    ``start`` starts the query with a fixed checkpoint, for example
    ``lambda: stream_raw(spark, source, table, key, checkpoint)``.
    """

    def __init__(self, start: Callable[[], StreamingQuery], quarantine: str | None = None):
        """``quarantine`` is the table of the job's rejects, which ``show`` counts."""
        self._start = start
        self._quarantine = quarantine
        self._query: StreamingQuery | None = None
        self._stopped = False

    def resume(self) -> StreamingQuery:
        """Start, or go on after a pause or a failure, from the stored offsets."""
        if self._stopped:
            raise RuntimeError("the job was stopped for good")
        if self._query is None or not self._query.isActive:
            self._query = self._start()
        return self._query

    def pause(self) -> None:
        if self._query is not None and self._query.isActive:
            self._query.stop()

    def stop(self) -> None:
        """Pause for good."""
        self.pause()
        self._stopped = True

    def show(self) -> dict[str, Any]:
        """State, progress and lag of the last micro-batch, messages set aside so far, and the error
        that ended the query, if any. ``lag`` is what the source tells of messages not yet read: for
        a topic the offsets behind the latest."""
        query = self._query
        if query is None:
            return {"state": "NEW"}
        error = query.exception()
        state = "RUNNING" if query.isActive else "FAILED" if error else "PAUSED"
        if self._stopped:
            state = "STOPPED"
        last = query.lastProgress or {}
        return {
            "state": state,
            "message": query.status["message"],
            "batch_id": last["batchId"] if last else None,
            "input_rows": last["numInputRows"] if last else 0,
            "sources": [s["endOffset"] for s in last["sources"]] if last else [],
            "lag": [_lag(s) for s in last["sources"]] if last else [],
            "rejects": None if self._quarantine is None else self._rejects(query.name),
            "error": None if error is None else str(error),
        }

    def _rejects(self, job_key: str) -> int:
        first, last = batch_label(job_key, 0), batch_label(job_key, 10**12 - 1)
        table = SparkSession.active().table(self._quarantine)
        return table.filter(F.col("load_label").between(first, last)).count()


class History(StreamingQueryListener):
    """Keeps the progress of the session's named streams in a table: a row for each micro-batch.

    ``history = History(spark, table)``, then ``spark.streams.addListener(history)``.
    """

    def __init__(self, spark: SparkSession, table: str):
        self._spark, self._table = spark, table
        self._kept: dict[str, int] = {}
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} (run_id string, batch_id bigint, at timestamp, input_rows bigint, millis bigint, "
            "offsets string, error string, job_key string) USING parquet PARTITIONED BY (job_key)"
        )

    def _keep(self, *row: object) -> None:
        schema = self._spark.table(self._table).schema
        one = self._spark.createDataFrame([row], schema.simpleString().removeprefix("struct<").removesuffix(">").replace("at:timestamp", "at:string"))
        one.withColumn("at", F.to_timestamp("at")).coalesce(1).write.mode("append").insertInto(self._table)

    def onQueryStarted(self, event: Any) -> None:
        pass

    def onQueryProgress(self, event: Any) -> None:
        told = event.progress
        # Spark tells of waiting streams as well, and of the batch before once more.
        if told.name and told.numInputRows:
            offsets = json.dumps([s.endOffset for s in told.sources])
            self._keep(str(told.runId), told.batchId, told.timestamp, told.numInputRows, told.batchDuration, offsets, None, told.name)
            self._kept[str(told.runId)] = told.batchId

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        pass

    def settle(self, query: StreamingQuery, seconds: float = 30) -> None:
        """Wait until all that a stopped stream has done is kept: Spark tells of it a little later."""
        last = max((p["batchId"] for p in query.recentProgress if p["numInputRows"]), default=None)
        until = time.monotonic() + seconds
        while last is not None and self._kept.get(str(query.runId), -1) < last:
            if time.monotonic() > until:
                raise TimeoutError(f"no word of micro-batch {last} of {query.name}")
            time.sleep(0.1)

    def read(self) -> DataFrame:
        """One row for each micro-batch: of one that ran again, the last time."""
        order = Window.partitionBy("job_key", "batch_id").orderBy(F.desc("at"))
        rows = self._spark.table(self._table).withColumn("_n", F.row_number().over(order))
        return rows.filter("_n = 1").drop("_n")
