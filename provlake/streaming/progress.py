"""Progress of running queries, and status of files that are still written to."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

EVERY = 2_000


class Progress(StreamingQueryListener):
    """Says how many rows a query has taken, each time another ``every`` rows are full, and when it ends."""

    def __init__(self, say: Callable[[str], None] = print, every: int = EVERY) -> None:
        self.say, self.every, self.rows, self.said = say, every, {}, {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.rows[str(event.id)] = 0

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        q = str(p.id)
        self.rows[q] = self.rows.get(q, 0) + p.numInputRows
        if self.rows[q] // self.every > self.said.get(q, 0):
            self.said[q] = self.rows[q] // self.every
            self.say(f"{p.name or q}: {self.rows[q]} rows")

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.say(f"{event.id}: ended after {self.rows.pop(str(event.id), 0)} rows")


def appended(spark: SparkSession, path: str, schema: T.StructType, key: str | None = None) -> DataFrame:
    """A reader's view of files that others append to: finished files only, torn last lines left out; nothing yet is no rows."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return rows if key is None else rows.where(f"{key} is not null")
