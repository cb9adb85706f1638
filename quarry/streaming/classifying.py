"""A classifier run that goes on where it was stopped.

Tasks arrive as a stream and are grouped by their keys.  Each is asked when it arrives; what fails is asked again when its timer is due, after pauses that
double, so nothing sleeps in a task meanwhile.  A task's state is its question and how often it was asked, and is emptied but for a mark when
it is finished.  Every attempt is a row of the output as soon as its batch is committed.  A run that was killed goes on from its checkpoint: finished
tasks aren't asked again, pending ones keep their attempts and timers; only the batch that was under way is repeated, so small
batches lose little.

Each Spark task asks one request at a time, so at most ``spark.sql.shuffle.partitions`` are in flight.
"""

from __future__ import annotations

import time
import zlib
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from quarry.operators.annotate import parsed_answer
from quarry.session import ship

KEYS = ("conversation_id", "branch", "message", "part")
ATTEMPT = ["attempt", "final", "classification", "reasoning", "success", "error"]
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Asking(StatefulProcessor):
    """One task's life: asked on arrival, asked again by timers, finished with a label or after the last attempt."""

    def __init__(self, labels: Sequence[str], ask: Callable[[str], str], template: str, attempts: int, pause: float, failures: tuple[type[Exception], ...], names: Sequence[str]):
        self.labels, self.ask, self.template, self.attempts, self.pause, self.failures, self.names = tuple(labels), ask, template, attempts, pause, failures, list(names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", "question string, answer string, attempt int")
        self.finished = handle.getValueState("finished", "attempt int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for b in rows:  # a task that comes twice is one task
            first = b.iloc[0] if first is None and len(b) else first
        if first is not None and not self.finished.exists() and not self.waiting.exists():
            yield self._attempt(key, first["question"], first["answer"], 1, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.waiting.exists():
            question, answer, done = self.waiting.get()
            yield self._attempt(key, question, answer, done + 1, timerValues)

    def _attempt(self, key, question: str, answer: str, k: int, timers) -> pd.DataFrame:
        said, why, error = self.labels[-1], "", None
        try:
            got, reasoning = parsed_answer(self.ask(self.template.format(question=question, answer=answer)))
            if got in self.labels:
                said, why = got, reasoning
            else:
                error = f"not a label: {got}"
        except self.failures as e:
            error = str(e)
        final = error is None or k >= self.attempts
        if final:
            self.waiting.clear()
            self.finished.update((k,))
        else:
            self.waiting.update((question, answer, k))
            spread = 1 + zlib.crc32(f"{key}:{k}".encode()) % 1000 / 2000
            self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + int(1000 * self.pause * 2 ** (k - 1) * spread))
        return pd.DataFrame([[*key, k, final, said, why, error is None, error]], columns=[*self.names, *ATTEMPT])

    def close(self) -> None:
        pass


def attempts_of(
    tasks: DataFrame, labels: Sequence[str], ask: Callable[[str], str], *, template: str = "{question}\n\n{answer}", attempts: int = 4, pause: float = 1.0,
    failures: tuple[type[Exception], ...] = (OSError, ValueError, RuntimeError), keys: Sequence[str] = KEYS,
) -> DataFrame:
    """A stream of attempts (keys, attempt, final, classification, reasoning, success, error) from one of tasks (keys, question, answer)."""
    ship(tasks.sparkSession)
    shape = ", ".join(f"{k} {t}" for k, t in tasks.select(*keys).dtypes)
    asking = Asking(labels, ask, template, attempts, pause, failures, keys)
    kind = f"{shape}, attempt int, final boolean, classification string, reasoning string, success boolean, error string"
    return tasks.select(*keys, "question", "answer").groupBy(*keys).transformWithStateInPandas(asking, kind, "append", "processingTime")


def started(attempts: DataFrame, out: str, checkpoint: str, every: str = "1 second") -> StreamingQuery:
    """Write the attempts to ``out`` as batches finish; the checkpoint is what a later run goes on from."""
    spark = attempts.sparkSession
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)  # timers need it; the query keeps the setting it is started with
    try:
        return attempts.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(processingTime=every).start(out)
    finally:
        spark.conf.set(PROVIDER, before)


def results(attempts: DataFrame, out: str) -> DataFrame:
    """Finished tasks (keys, classification, reasoning, success, error) of the stream ``attempts``, also while the run goes on."""
    return attempts.sparkSession.read.schema(attempts.schema).parquet(out).where("final").drop("attempt", "final")


def waiting(spark: SparkSession, out: str) -> int:
    """Tasks that were asked and aren't finished."""
    row = spark.read.schema("attempt int, final boolean").parquet(out).agg(F.count_if(F.col("attempt") == 1).alias("begun"), F.count_if("final").alias("done")).head()
    return row.begun - row.done


def finish(query: StreamingQuery, out: str, *, poll: float = 0.5, patience: int = 3) -> None:
    """Wait until all tasks there are are finished, then stop: ``patience`` polls in a row without new input and without a waiting task."""
    spark, calm = SparkSession.active(), 0
    while calm < patience:
        if query.exception() is not None:
            raise query.exception()
        if not query.isActive:
            return
        last = query.lastProgress
        idle = last is not None and not last["numInputRows"] and not query.status["isDataAvailable"]
        calm = calm + 1 if idle and not waiting(spark, out) else 0
        time.sleep(poll)  # on the driver, between looks
    query.stop()
