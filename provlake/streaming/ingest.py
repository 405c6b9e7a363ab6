"""Structured Streaming: checkpointed ingest, ordered sinks, failure counters."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def files(spark: SparkSession, path: str, schema, per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if per_trigger:
        r = r.option("maxFilesPerTrigger", per_trigger)
    return r.json(path)


def dedup_ids(stream: DataFrame, key: str, event_time: str | None = None, delay: str = "7 days") -> DataFrame:
    """Exactly-once effect by id; with an event time the state is bounded by the watermark."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key]) if event_time else stream.dropDuplicates([key])


def frames_then_metadata(frames_path: str, meta_path: str):
    """A foreachBatch sink: frames are on disk before the metadata that names them; a batch that ran is not added again."""

    def sink(batch: DataFrame, epoch: int) -> None:
        # a fixed folder per batch makes a repeated batch overwrite itself
        batch.select("calc_id", F.explode("frames").alias("f")).select("calc_id", "f.*").write.mode("overwrite").parquet(f"{frames_path}/epoch={epoch}")
        batch.drop("frames").write.mode("overwrite").parquet(f"{meta_path}/epoch={epoch}")

    return sink


def start(stream: DataFrame, sink, checkpoint: str):
    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _count(limit: int):
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n = state.get[0] if state.exists else 0
        for b in batches:
            for ok in b.sort_values("seq")["ok"]:
                n = 0 if ok else n + 1
        state.update((n,))
        yield pd.DataFrame({"id": [key[0]], "failures": [n], "dead": [n >= limit]})

    return run


def failure_counts(stream: DataFrame, limit: int = 3) -> DataFrame:
    """(id, failures in a row, dead) after each batch of (id, seq, ok); a success resets."""
    return stream.groupBy("id").applyInPandasWithState(_count(limit), "id string, failures int, dead boolean", "n int", "update", GroupStateTimeout.NoTimeout)
