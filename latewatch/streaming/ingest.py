"""ST1/ST2: Structured Streaming over the capture landing folder.

ST1 :func:`start_capture_ingest` picks up new capture files with the file
stream source (fixed schema, partition columns ``dt``/``hour``) and appends
them to the bronze table; the checkpoint makes every file land exactly once.

ST2 :func:`start_latest_state` keeps the silver build's W1 result up to date:
each micro-batch is filtered (P1-P3) and dated (P4) *before* it touches state,
merged with the stored rows of the service dates it touches only, reduced to
the newest capture per (trip_id, service_date, stop_id), and written as a new
version of just those ``service_date`` partitions.  The state has one row
per (trip, service date, stop), so a day's partition is bounded by that day's
timetable however many captures arrive; rewriting it per micro-batch costs
O(scheduled stop events of the touched days).

The state is a versioned table (:mod:`latewatch.sources.versioned`): a batch is one
commit, the state of any number of days reads as one scan, folders of batches that died go
with the next commit, and the versions at which dates were last written are the
change log that the refresh consumes (:func:`latewatch.plans.pipeline.update_from_stream`).

Replay safety: the merge is idempotent (``latest(latest(S + B) + B) ==
latest(S + B)`` with a deterministic tie-break), so a job that dies at any moment
leaves the last committed state, and the replay merges the batch again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import params, schemas
from ..operators.enrich import latest_stop_events, prepare_updates
from ..sources import versioned
from ..sources.captures import with_partitions


def capture_stream(spark: SparkSession, landing_root: str, schema=schemas.TRIP_UPDATES,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of the landing folder (``dt=/hour=`` partitions, contract schema)."""
    r = spark.readStream.schema(with_partitions(schema)).option("basePath", landing_root)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(landing_root)


def start_capture_ingest(spark: SparkSession, landing_root: str, bronze_path: str, checkpoint: str,
                         available_now: bool = True, schema=schemas.TRIP_UPDATES) -> StreamingQuery:
    """ST1: append new capture files to the bronze table (exactly once per file)."""
    w = (capture_stream(spark, landing_root, schema).writeStream.format("parquet")
         .option("checkpointLocation", checkpoint).partitionBy("dt", "hour").outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(bronze_path)


def merge_batch(batch: DataFrame, batch_id: int, state_root: str,
                tie_breakers: Sequence[str] = ("entity_id",), zone: str = params.SERVICE_ZONE) -> None:
    """ST2 body for one micro-batch (also callable directly to replay a batch)."""
    spark = batch.sparkSession
    state = versioned.latest(spark, state_root)
    fresh = prepare_updates(batch, zone, tie_breakers).persist()
    try:
        days = [r[0] for r in fresh.select("service_date").distinct().collect()]     # a few a batch
        if not days:
            return
        merged = fresh
        if state:
            touched = F.col("service_date").isin([d for d in days if d]) | (F.col("service_date").isNull() & F.lit(None in days))
            merged = versioned.read(spark, state_root, state).where(touched).select(*fresh.columns).unionByName(fresh)
        versioned.write(latest_stop_events(merged, tie_breakers), state_root, ("service_date",), present_only=True,
                        meta={"batch": batch_id}, base=state)
    finally:
        fresh.unpersist()


def start_latest_state(spark: SparkSession, landing_root: str, state_root: str, checkpoint: str,
                       tie_breakers: Sequence[str] = ("entity_id",), available_now: bool = True,
                       schema=schemas.TRIP_UPDATES,
                       max_files_per_trigger: int | None = None) -> StreamingQuery:
    """ST2: maintain the newest capture per stop event below ``state_root``."""
    def body(df: DataFrame, batch_id: int) -> None:
        merge_batch(df, batch_id, state_root, tie_breakers)
    w = (capture_stream(spark, landing_root, schema, max_files_per_trigger).writeStream
         .foreachBatch(body).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_latest_state(spark: SparkSession, state_root: str) -> DataFrame:
    """The maintained W1 table: the newest commit's."""
    state = versioned.latest(spark, state_root)
    if state is None:
        raise FileNotFoundError(f"no committed state below {state_root}")
    return versioned.read(spark, state_root, state)
