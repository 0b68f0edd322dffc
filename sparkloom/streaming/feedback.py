"""Continuous ingest of ratings, and debounce by processing time."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from .. import schemas
from ..operators import feedback


def ingest(spark: SparkSession, bodies: DataFrame, table: str, dead_letters: str, checkpoint: str) -> DataStreamWriter:
    """Stores valid ratings in a table and all others, with status and reason, as JSON lines in dead_letters.

    Each micro-batch is parsed once. Its rows are stored under a key of the checkpoint and the batch's number: one
    that is repeated after a failure is not stored again, and writes its own dead-letter folder anew. Bodies that
    cannot be read, lack a field or have a wrong type are 422, refused ones 400.
    """
    record, parsed = feedback.parse_requests(F.col("body"), schemas.RATING_REQUEST, schemas.RATING_DEFAULTS, schemas.RATING_REQUIRED)

    def batch(rows: DataFrame, number: int) -> None:
        read = rows.select("body", record.alias("r"), parsed.alias("status")).select("body", "status", "r.*").persist()
        detail = feedback.rating_detail(F.col("suggestion"), F.col("rating"), F.col("suggestion_type"))
        checked = read.withColumn("detail", F.when(F.col("status") == 422, "a field is missing or wrong, or the body cannot be read").otherwise(detail)).withColumn("status", F.when(F.col("status") == 422, 422).otherwise(feedback.status(detail)))
        key = f"{checkpoint}/{number}"
        spark.catalog.refreshTable(table)
        if spark.table(table).filter(F.col("request_key") == key).isEmpty():
            feedback.save(spark, checked.filter("status = 200").select(*schemas.RATING_COLUMNS, F.lit(key).alias("request_key")), table)
        checked.filter("status <> 200").select(F.to_json(F.struct("body", "status", "detail")).alias("value")).write.mode("overwrite").text(f"{dead_letters}/batch={number}")
        read.unpersist()

    return bodies.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)


class Debounce(StatefulProcessor):
    """Keeps a key's latest request and emits it when the key has been silent for wait_ms of processing time."""

    def __init__(self, wait_ms: int = 500) -> None:
        self.wait_ms = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "request long, payload string")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        held = self.last.get() if self.last.exists() else None
        for part in rows:
            top = part.loc[part["request"].idxmax()]
            if held is None or int(top["request"]) > int(held[0]):
                held = (int(top["request"]), str(top["payload"]))
        if held is not None:
            self.last.update(tuple(held))
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait_ms)
        yield from ()

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        request, payload = self.last.get()
        self.last.clear()
        yield pd.DataFrame({"key": [key[0]], "request": [request], "payload": [payload]})

    def close(self) -> None:
        pass


class Newest(StatefulProcessor):
    """Keeps the newest request of a key that has been asked; lets only its answer through, and only once it is there.

    Rows are requests (answer null) and answers; an answer to any but the newest request is stale.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "request long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        newest, answers = self.newest.get()[0] if self.newest.exists() else -1, []
        for part in rows:
            newest = max(newest, int(part["request"].max()))
            answers.append(part[part["answer"].notna()])
        self.newest.update((newest,))
        fresh = pd.concat(answers)
        fresh = fresh[(fresh["request"] == newest) & (fresh["answer"].str.strip() != "")]
        yield fresh[["key", "request", "answer"]]

    def close(self) -> None:
        pass


def without_stale(rows: DataFrame) -> DataFrame:
    """A stream (key string, request long, answer string) of requests and answers, reduced to the answers that are
    not empty and whose request was still the newest of its key when they came."""
    return rows.groupBy("key").transformWithStateInPandas(Newest(), "key string, request long, answer string", "Append", "None")


def debounced(requests: DataFrame, wait_ms: int = 500) -> DataFrame:
    """A stream (key string, request long, payload string) reduced to the last request of each burst."""
    return requests.groupBy("key").transformWithStateInPandas(Debounce(wait_ms), "key string, request long, payload string", "Append", "ProcessingTime")


def bursts(events: DataFrame, key: str, ts: str, request: str, gap: str, late: str) -> DataFrame:
    """The event-time form for streams: bursts are emitted when the watermark has passed their end."""
    timed = events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    out = timed.groupBy(key, F.session_window("_ts", gap).alias("burst")).agg(F.max(request).alias(request), F.count("*").alias("n"))
    return out.select(key, F.col("burst.end").alias("fires_at"), request, "n")
