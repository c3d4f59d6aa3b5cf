"""Running several streaming queries as one job: late rows over its life, and its end."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tickloom.schemas import struct
from tickloom.session import file_system

LATE = struct("query string, batch bigint, operator int, kind string, dropped bigint")


class LateRows(StreamingQueryListener):
    """Adds up the rows that stateful operators drop behind the watermark, in a table.

    Progress reports are kept by a query for its last hundred micro-batches only, and gone when the
    job restarts; this table holds a small file for each micro-batch that dropped rows. A file is
    named by query and micro-batch, so a repeated micro-batch counts once. ``late_rows`` reads it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.only: set[str] | None = None  # ids of the job's queries, once they are known

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if self.only is not None and str(progress.id) not in self.only:
            return
        rows = [
            {
                "query": str(progress.id),
                "batch": progress.batchId,
                "operator": number,
                "kind": operator.operatorName,
                "dropped": operator.numRowsDroppedByWatermark,
            }
            for number, operator in enumerate(progress.stateOperators)
            if operator.numRowsDroppedByWatermark > 0
        ]
        if rows:
            fs, file = file_system(self.spark, f"{self.path}/{progress.id}-{progress.batchId}.json")
            out = fs.create(file, True)
            out.write(bytearray("".join(json.dumps(row) + "\n" for row in rows).encode()))
            out.close()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """``query``, ``operator``, ``kind``, ``dropped`` and ``batches`` with drops, of a job's life."""
    fs, folder = file_system(spark, path)
    if not fs.exists(folder):
        found = spark.createDataFrame([], LATE)
    else:
        found = spark.read.schema(LATE).json(path)
    return found.groupBy("query", "operator", "kind").agg(
        F.sum("dropped").alias("dropped"), F.count("*").alias("batches")
    )


def await_all(spark: SparkSession, queries: Sequence[StreamingQuery]) -> None:
    """Waits until all queries have ended. If one fails, the others are stopped and it is raised.

    A job whose parts need one another must not go on without one of them unnoticed.
    """
    failures: list[Exception] = []
    while not failures and any(query.isActive for query in queries):
        try:
            spark.streams.awaitAnyTermination()
        except StreamingQueryException as failure:
            if any(query.exception() is not None for query in queries):
                failures.append(failure)
        spark.streams.resetTerminated()
        failures += [query.exception() for query in queries if query.exception() is not None]
    for query in queries:
        query.stop()
    if failures:
        raise failures[0]
