import random

import pytest
from model import T0, trunc_div
from tickfold.streaming import batch_step, count_window_step, read_runs, start_count_window

SCHEMA = "sensor_id int, ms bigint, v int"


def _readings(n=400, hot=True):
    """In time order; sensor 1 has most readings."""
    rng = random.Random(5)
    return [
        (1 if hot and rng.random() < 0.7 else rng.randint(2, 5), T0 + i * 400_000, rng.randint(-9, 99))
        for i in range(n)
    ]


def _expected(readings):
    out = []
    for sensor in {r[0] for r in readings}:
        own = sorted(r for r in readings if r[0] == sensor)
        for i in range(0, len(own) - 9, 10):
            run = own[i : i + 10]
            out.append((sensor, run[-1][1], trunc_div(sum(r[2] for r in run), 10)))
    return sorted(out)


def _deliver(spark, path, readings):
    spark.createDataFrame(readings, SCHEMA).write.mode("append").parquet(f"{path}/in")


def _run(spark, path):
    stream = spark.readStream.schema(SCHEMA).parquet(f"{path}/in")
    start_count_window(stream, path, available_now=True).awaitTermination()


def _runs(spark, path):
    return sorted(tuple(r) for r in read_runs(spark, path).collect())


@pytest.mark.parametrize("cuts", [[400], [1, 7, 150, 400]])
def test_runs_continue_over_batches_and_restarts(spark, tmp_path, cuts):
    readings, path, start = _readings(), str(tmp_path), 0
    for end in cuts:
        _deliver(spark, path, readings[start:end])
        _run(spark, path)
        assert _runs(spark, path) == _expected(readings[:end])
        start = end
    _run(spark, path)  # nothing new: nothing changes
    assert _runs(spark, path) == _expected(readings)


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    readings, path = _readings(100), str(tmp_path)
    _deliver(spark, path, readings[:60])
    _run(spark, path)
    # a batch that wrote its rows and failed before its commit
    spark.createDataFrame([(1, 1, 1, True)], "sensor_id int, ms bigint, total bigint, complete boolean") \
        .write.parquet(f"{path}/runs/batch_id=1")
    _deliver(spark, path, readings[60:])
    _run(spark, path)
    assert _runs(spark, path) == _expected(readings)


def test_a_missing_previous_batch_is_an_error(spark, tmp_path):
    batch = spark.createDataFrame(_readings(30), SCHEMA)
    with pytest.raises(Exception, match="batch_id=2"):
        batch_step(str(tmp_path))(batch, 3)


def test_stop_ends_a_polling_stream(spark, tmp_path):
    path = str(tmp_path)
    _deliver(spark, path, _readings(100))
    stream = spark.readStream.schema(SCHEMA).parquet(f"{path}/in")
    query = start_count_window(stream, path, processing_time="1 second")
    query.processAllAvailable()
    query.stop()
    assert not query.isActive
    assert _runs(spark, path) == _expected(_readings(100))


def test_step_keeps_unfinished_readings(spark):
    readings = _readings(55, hot=False)
    rows = count_window_step(spark.createDataFrame(readings, SCHEMA)).collect()
    done = sorted((r["sensor_id"], r["ms"], trunc_div(r["total"], 10)) for r in rows if r["complete"])
    assert done == _expected(readings)
    assert len(done) * 10 + sum(not r["complete"] for r in rows) == len(readings)
