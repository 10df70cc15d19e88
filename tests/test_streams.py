"""Retries as a stream against the batch loop, stopped between any two batches."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from prefmill.operators import generate
from prefmill.plans.streams import drafting, unfinished
from prefmill.streaming import retries


def metered(messages, settings):
    return {"text": drafting(messages, settings), "metrics": {"generation_tokens": len(messages), "finish_reason": "stop"}, "receipt": {"seed": settings["seed"]}}


@pytest.mark.parametrize("cuts", [[6], [1, 1, 1, 1, 1, 1], [2, 4]])
def test_attempts_do_not_depend_on_batches(spark, tmp_path, cuts):
    # task k needs k drafts; it is asked for at 6 - k % 3 times
    turns = lambda k: [{"role": "user", "content": f"Drafts needed: {k}"}]
    tasks = [(f"t{k}", turns(k), 100 + k) for k in range(6)]
    ddl = "id string, messages array<struct<role:string,content:string>>, seed bigint"
    times = {f"t{k}": 6 - k % 3 for k in range(6)}
    left, got = dict(times), None
    for n in cuts:
        rows = [t for t in tasks for _ in range(min(n, left[t[0]]))]
        left = {i: max(0, x - n) for i, x in left.items()}
        if rows:
            spark.createDataFrame(rows, ddl).repartition(3).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(ddl).parquet(str(tmp_path / "in"))
        made = retries.retried(stream, metered, unfinished, most=4)
        retries.start(made, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = sorted(map(str, retries.log(spark, str(tmp_path / "out"), "string").collect()))
    batch = generate.attempts(spark.createDataFrame(tasks, ddl), metered, unfinished, most=4)
    tries = spark.createDataFrame(list(times.items()), "id string, n int")
    want = batch.join(tries, "id").where("attempt < n").drop("n")
    assert got == sorted(map(str, want.collect()))
    assert len(got) == 1 + 2 + 3 + 4 + 4 + 4 and want.where(F.col("attempt") == 3).count() == 3


def test_a_batch_without_requests_makes_nothing(spark, tmp_path):
    ddl = "id bigint, messages array<struct<role:string,content:string>>, seed bigint"
    spark.createDataFrame([], ddl).write.parquet(str(tmp_path / "in"))
    made = retries.retried(spark.readStream.schema(ddl).parquet(str(tmp_path / "in")), metered, unfinished)
    retries.start(made, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != retries.PROVIDER
