"""Loads by arrival: new files of call records are streamed into the engine, a micro-batch a load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cohortspark.plans.engine import Engine
from cohortspark.schemas import schema


def follow(engine: Engine, incoming: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Starts a stream of Parquet call records; each micro-batch is loaded once, also after a restart."""

    def load(rows: DataFrame, epoch: int) -> None:
        ids = [r[0] for r in rows.select("file_id").distinct().collect()]  # files of one micro-batch
        if ids:
            engine.load(rows, f"stream-{epoch}", ids)

    stream = engine.spark.readStream.schema(schema("calls")).parquet(incoming).writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (stream.trigger(availableNow=True) if available_now else stream).start()


def running_type_counts(calls: DataFrame) -> DataFrame:
    """Records per type and filter status of a stream, for monitoring."""
    return calls.groupBy("type", (F.coalesce("filter", F.lit(".")) == "PASS").alias("pass")).agg(F.count("*").alias("n"))
