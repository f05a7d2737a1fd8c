"""Stream starters and the upsert behind live metrics.

Open windows are reported at once and corrected later. Each micro-batch brings sums per (window, customer) of
its own events. They are appended to a parts table; the windows they touch are summed
again and replace their rows in the metrics table, a ``KeyedLog``, so a micro-batch writes as much as it touches,
however long the history is. Both writes are keyed by batch id, so a repeated micro-batch changes nothing. The
parts table is all there is of these sums: a stream state of them would hold each row once more, in memory.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from sluicebox.contracts import serving_table
from sluicebox.operators.keys import latest_per_key
from sluicebox.sources.storage import DEFAULT_FORMAT, child_names, delete_path
from sluicebox.streaming.keyed_log import KeyedLog
from sluicebox.streaming.metrics import MEASURED, customer_sums, customer_windows, realtime_metrics, stored_window_metrics



def checkpoint_folder(root: str, job: str) -> str:
    return f"{root}/streaming/{job}"


def start_append(
    stream: DataFrame, path: str, checkpoint: str, fmt: str = DEFAULT_FORMAT, once: bool = False
) -> StreamingQuery:
    """Append a stream to a table. ``once`` drains what is there and stops."""
    writer = stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def start_closed_metrics(
    events: DataFrame, path: str, checkpoint: str, fmt: str = DEFAULT_FORMAT, once: bool = False
) -> StreamingQuery:
    """Metrics of closed windows only: each window is written once, after the watermark passes it."""
    return start_append(realtime_metrics(events), path, checkpoint, fmt, once)


@dataclass(frozen=True)
class LiveMetrics:
    """Where live metrics live: the parts table, the metrics table and an optional serving target.

    A root belongs to one stream checkpoint, since its batch ids order the changes; a new checkpoint gets a new root.
    """

    spark: SparkSession
    root: str
    serve: object = None

    @property
    def parts_path(self) -> str:
        return f"{self.root}/parts"

    @property
    def metrics(self) -> KeyedLog:
        table = serving_table("realtime_metrics")
        return KeyedLog(self.spark, f"{self.root}/metrics", table.schema, table.key, "to_date(window_start)")

    def add(self, events: DataFrame, batch_id: int) -> None:
        """Handler for ``foreachBatch`` of new events: what all batches hold of a (window, customer) is added up."""
        self._put(customer_windows(events), batch_id, customer_sums)

    def apply(self, changed: DataFrame, batch_id: int) -> None:
        """Handler for ``foreachBatch`` of changed rows of ``customer_windows`` over all events so far: the newest one counts."""
        self._put(changed, batch_id, lambda parts: latest_per_key(parts, ["window_start", "customer_id"], ["batch"]))

    def _put(self, changed: DataFrame, batch_id: int, one_per_customer: Callable[[DataFrame], DataFrame]) -> None:
        """Only the days this batch touched are listed and read."""
        flat = changed.withColumns(
            {
                "window_start": F.col("window.start"),
                "window_end": F.col("window.end"),
                "window_day": F.to_date("window.start"),
                "batch": F.lit(batch_id),
            }
        ).drop("window")
        seen = Observation(f"live-{uuid.uuid4()}")
        ends = [f("window_start").cast("string").alias(n) for f, n in ((F.min, "first"), (F.max, "last"))]
        (
            flat.observe(seen, *ends)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("window_day", "batch")
            .parquet(self.parts_path)
        )
        first, last = seen.get["first"], seen.get["last"]
        if first is None:
            return
        parts = self._parts(first[:10], last[:10]).filter(
            F.col("window_start").between(F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp"))
            & (F.col("batch") <= batch_id)
        )
        touched = parts.filter(F.col("batch") == batch_id).select("window_start").distinct()
        affected = parts.join(touched, "window_start", "left_semi")
        self.metrics.upsert(stored_window_metrics(one_per_customer(affected)), batch_id)
        if self.serve is not None:
            self.serve(self.metrics.read())

    def _parts(self, first_day: str, last_day: str) -> DataFrame:
        days = [name for name in child_names(self.spark, self.parts_path) if name.startswith("window_day=")]
        chosen = [d for d in days if first_day <= d.split("=")[1] <= last_day]
        reader = self.spark.read.option("basePath", self.parts_path)
        return reader.parquet(*[f"{self.parts_path}/{d}" for d in chosen])

    def forget_parts(self, before_day: str) -> None:
        """Drop parts of days whose windows are closed for good; the metrics keep their rows."""
        for name in child_names(self.spark, self.parts_path):
            if name.startswith("window_day=") and name.split("=")[1] < before_day:
                delete_path(self.spark, f"{self.parts_path}/{name}")

    def read(self) -> DataFrame | None:
        return self.metrics.read()


def start_live_metrics(
    events: DataFrame, live: LiveMetrics, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Live metrics, upserted per micro-batch. Only the steps behind ``events`` keep state; late rows are dropped there."""
    needed = events.select(*MEASURED)  # the others are not shuffled
    writer = needed.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(live.add)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
