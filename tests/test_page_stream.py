"""Streams over the page loop and over Spark's state."""

import glob
import os
import random

import pytest
from model import CELLS, T0, loop, random_rows, sink_means, trunc_div, wide_frame
from tickfold.plans import run_incremental
from tickfold.sources import LoggedSink
from tickfold.streaming import read_stateful_runs, start_page_stream, start_stateful_runs

SCHEMA = "sensor_id int, ms bigint, v int"


def page_stream(spark, path, sink):
    schema = spark.createDataFrame([], "row_key string, " + ", ".join(f"{c} string" for c in CELLS)).schema
    start_page_stream(
        spark, f"{path}/in", schema, sink, CELLS, f"{path}/checkpoint", available_now=True, pages_per_round=2
    ).awaitTermination()


def test_page_stream_equals_the_loop(spark, tmp_path):
    rows, path, start = random_rows(31, 430, 0.7), str(tmp_path), 0
    sink = LoggedSink(f"{path}/sink")
    for end in (40, 230, 430):
        wide_frame(spark, rows[start:end]).write.mode("append").parquet(f"{path}/in")
        page_stream(spark, path, sink)
        full = end // 100 * 100
        assert sink_means(sink.records(spark)) == (loop(rows[:full]) if full else [])
        start = end
    page_stream(spark, path, sink)  # nothing new
    run_incremental(spark, spark.read.parquet(f"{path}/in"), sink, CELLS)
    assert sink_means(sink.records(spark)) == loop(rows)


def test_a_page_batch_that_runs_again_adds_nothing(spark, tmp_path):
    rows, path = random_rows(32, 250, 0.9), str(tmp_path)
    sink = LoggedSink(f"{path}/sink")
    wide_frame(spark, rows).write.mode("append").parquet(f"{path}/in")
    page_stream(spark, path, sink)
    forget_commit(path)
    page_stream(spark, path, sink)
    assert sink_means(sink.records(spark)) == loop(rows[:200])


def forget_commit(path):
    """The state of a query that died after the work of its last batch and before its commit."""
    last = max(int(os.path.basename(p)) for p in glob.glob(f"{path}/checkpoint/commits/[0-9]*"))
    for name in (f"{last}", f".{last}.crc"):
        if os.path.exists(f"{path}/checkpoint/commits/{name}"):
            os.remove(f"{path}/checkpoint/commits/{name}")


def readings(n, seed=5):
    rng = random.Random(seed)
    return [(1 if rng.random() < 0.6 else rng.randint(2, 5), T0 + i * 1000, rng.randint(-99, 99)) for i in range(n)]


def expected(rows):
    out = []
    for sensor in {r[0] for r in rows}:
        own = sorted(r for r in rows if r[0] == sensor)
        for i in range(0, len(own) - 9, 10):
            out.append((sensor, own[i + 9][1], trunc_div(sum(r[2] for r in own[i : i + 10]), 10)))
    return sorted(out)


def run(spark, path, n_files=1000):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", n_files).parquet(f"{path}/in")
    start_stateful_runs(stream, path, available_now=True).awaitTermination()
    return sorted(tuple(r) for r in read_stateful_runs(spark, path).collect())


def deliver(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/in")


@pytest.mark.parametrize("cuts", [[400], [1, 7, 150, 151, 400]])
def test_state_continues_over_restarts(spark, tmp_path, cuts):
    rows, path, start = readings(400), str(tmp_path), 0
    for end in cuts:
        shuffled = rows[start:end][::-1]  # order inside a batch is restored
        deliver(spark, path, shuffled)
        assert run(spark, path) == expected(rows[:end])
        start = end
    assert run(spark, path) == expected(rows)


def test_fifty_batches_and_a_repeated_one(spark, tmp_path):
    rows, path = readings(1000, 6), str(tmp_path)
    for i in range(0, 960, 20):
        deliver(spark, path, rows[i : i + 20])
    assert run(spark, path, n_files=1) == expected(rows[:960])  # 48 batches
    deliver(spark, path, rows[960:980])
    run(spark, path)
    forget_commit(path)
    deliver(spark, path, rows[980:])
    assert run(spark, path) == expected(rows)
    assert len(glob.glob(f"{path}/checkpoint/offsets/[0-9]*")) == 50
    assert not [p for p in os.listdir(f"{path}/means") if os.path.isdir(f"{path}/means/{p}") and p != "_spark_metadata"]


def test_nulls_take_no_part(spark, tmp_path):
    rows, path = readings(60), str(tmp_path)
    deliver(spark, path, [*rows, (None, T0, 1), (1, None, 1), (1, T0, None)])
    assert run(spark, path) == expected(rows)
