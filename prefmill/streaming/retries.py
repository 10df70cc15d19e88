"""Retries with feedback as a stream: every row of a task's key asks for one more attempt.

The state of a task is its own messages, its seed, its last answer, that answer's issues and the number of attempts made.
It lives in the state store, so a query that was stopped goes on from its checkpoint: a task whose answer had
issues is told of them in whichever run its next row arrives. A task that succeeded, or was tried ``most`` times, answers no
further rows; its state then holds no more than that. The attempts of a task are those that
``generate.attempts`` makes of it with as many tries as it has rows, whatever the batches.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from prefmill.functions.workers import importable
from prefmill.operators.generate import GENERATED, RETRY, Complete, Settings, asked, fixed, generated

#: attempt is the number of attempts made; open tells whether there may be more.
STATE = "base string, seed bigint, text string, issues string, attempt int, open boolean"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Retries(StatefulProcessor):
    """One attempt for each input row (messages, seed) of a key, until one has no issue."""

    def __init__(self, complete: Complete, check: Callable[[str], list[str]], most: int, settings: Callable[[int, int, int], Settings], tokens: int, retry: str) -> None:
        self.complete, self.check, self.most, self.settings, self.tokens, self.retry = complete, check, most, settings, tokens, retry

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.task = handle.getValueState("task", STATE)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        held = self.task.get() if self.task.exists() else None
        base, seed, text, issues, n, more = held if held is not None else (None, None, None, "[]", 0, True)
        if not more:
            return
        out = []
        for frame in rows:
            for messages, first_seed in zip(frame["messages"], frame["seed"]):
                if not more:
                    break
                if base is None:  # the first row of a task says what it is
                    base, seed = json.dumps([{"role": m["role"], "content": m["content"]} for m in messages]), int(first_seed)
                use = self.settings(n, seed, self.tokens)
                turns = asked(json.loads(base), text, json.loads(issues), self.retry)
                text, *told = generated(self.complete(turns, use), use)
                found = self.check(text)
                out.append((key[0], n, text, found, *told))
                issues, n = json.dumps(found), n + 1
                more = bool(found) and n < self.most
        self.task.update((base, seed, text, issues, n, True) if more else ("", seed, "", "[]", n, False))
        if out:
            yield pd.DataFrame(out, columns=["id", "attempt", "text", "issues", "settings", "metrics", "receipt"])

    def close(self) -> None:
        pass


def retried(
    requests: DataFrame, complete: Complete, check: Callable[[str], list[str]], most: int = 3, settings: Callable[[int, int, int], Settings] = fixed, tokens: int = 700, retry: str = RETRY
) -> DataFrame:
    """A stream of (id, messages, seed) -> a stream of attempts (id, attempt, text, issues, settings, metrics, receipt)."""
    importable(requests.sparkSession)
    kind = dict(requests.dtypes)["id"]
    schema = T._parse_datatype_string(f"id {kind}, attempt int, text string, issues array<string>, {GENERATED}")
    work = Retries(complete, check, most, settings, tokens, retry)
    return requests.select("id", "messages", "seed").groupBy("id").transformWithStateInPandas(work, schema, "Append", "None")


def start(attempts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the attempts that what is there now asks for, then stop; the state stays in the checkpoint."""
    conf, name = attempts.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name, None)
    conf.set(name, PROVIDER)  # arbitrary state needs it; a query keeps the one it was started with
    try:
        return attempts.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    finally:
        if before is None:
            conf.unset(name)
        else:
            conf.set(name, before)


def log(spark: SparkSession, path: str, kind: str = "bigint") -> DataFrame:
    """The attempts written so far."""
    return spark.read.schema(f"id {kind}, attempt int, text string, issues array<string>, {GENERATED}").parquet(path)
