import os

import pytest
from model import CELLS, T0, as_means, loop, random_rows, sink_means, wide_frame
from pyspark.sql import functions as F
from tickfold.operators import mark_sink_rows
from tickfold.plans import backfill_means, run_incremental
from tickfold.sources import (
    FileTable,
    append_new,
    high_water,
    key_after,
    key_from,
    late_rows,
    next_page_ends,
)

CASES = [(1, 0, 1.0), (2, 9, 0.5), (3, 57, 0.4), (4, 100, 0.3), (5, 157, 0.9), (6, 219, 0.35), (7, 250, 1.0)]


@pytest.fixture()
def sink(spark, tmp_path):
    return FileTable(str(tmp_path / "records")).create(spark)


@pytest.mark.parametrize("seed,n,fill", CASES)
def test_one_pass_equals_the_loop(spark, seed, n, fill):
    rows = random_rows(seed, n, fill)
    got = as_means(backfill_means(wide_frame(spark, rows), CELLS, max_parts=1 + seed % 3, ticks_per_part=1))
    assert got == loop(rows)


@pytest.mark.parametrize("seed,n,fill,pages", [(5, 157, 0.9, 1), (6, 219, 0.35, 2), (7, 250, 1.0, 5)])
def test_rounds_equal_the_loop(spark, sink, seed, n, fill, pages):
    rows = random_rows(seed, n, fill)
    report = run_incremental(
        spark, wide_frame(spark, rows), sink, CELLS, pages_per_round=pages, hwm_pad_ms=0
    )
    assert report.status == "not enough data"
    assert report.batches == -(-n // 100)
    assert sink_means(sink.read(spark)) == loop(rows)


def test_source_may_grow_between_runs(spark, sink):
    rows = random_rows(8, 230, 0.8)
    for seen in (95, 104, 230):
        run_incremental(spark, lambda s=seen: wide_frame(spark, rows[:s]), sink, CELLS, hwm_pad_ms=0)
    # 95 rows make nine runs; the five left and nine new ones are a page of 14 with one run.
    got, start = [], 0
    for seen in (95, 104, 230):
        known = [r for r in rows[:seen] if int(r["row_key"]) > start]
        got += loop(known)
        start = max(m[1] for m in got)
    assert sink_means(sink.read(spark)) == sorted(got)


def test_batch_limit_and_restart(spark, sink):
    rows = random_rows(9, 250, 1.0)
    wide = wide_frame(spark, rows)
    first = run_incremental(spark, wide, sink, CELLS, max_batches=1, hwm_pad_ms=0)
    assert (first.batches, first.status) == (1, "max batches")
    assert sink_means(sink.read(spark)) == loop(rows, batches=1)
    run_incremental(spark, wide, sink, CELLS, hwm_pad_ms=0)
    assert sink_means(sink.read(spark)) == loop(rows)


def test_stop_is_asked_before_each_round(spark, sink):
    asked = []

    def stop():
        asked.append(1)
        return len(asked) > 1

    wide = wide_frame(spark, random_rows(9, 250, 1.0))
    report = run_incremental(spark, wide, sink, CELLS, stop=stop, hwm_pad_ms=0)
    assert (report.batches, report.status) == (1, "stopped")


def test_pages_in_the_future_are_held(spark, sink):
    rows = random_rows(10, 250, 1.0)
    as_of = int(rows[150]["row_key"])
    wide = wide_frame(spark, rows)
    report = run_incremental(
        spark, wide, sink, CELLS, clock=lambda: as_of / 1000, pages_per_round=3, hwm_pad_ms=0
    )
    assert (report.batches, report.status) == (1, "held")
    run_incremental(spark, wide, sink, CELLS, hwm_pad_ms=0)
    assert sink_means(sink.read(spark)) == loop(rows)


def test_rows_that_cannot_be_written_are_counted_and_stepped_over(spark, sink, tmp_path):
    rows = [(str(T0 + i * 1000), {"temp" if i < 130 else "sensor1": "1"}) for i in range(230)]
    maps = spark.createDataFrame(rows, "row_key string, cells map<string,string>")
    schema = mark_sink_rows(backfill_means(maps, "cells")).schema
    bad = FileTable(str(tmp_path / "bad"), schema=schema).create(spark)
    report = run_incremental(spark, maps, sink, "cells", rejects=bad)
    assert (report.status, report.batches) == ("not enough data", 3)
    assert report.rejected == bad.read(spark).count() == 13
    assert len(sink_means(sink.read(spark))) == 10


@pytest.mark.parametrize("pages", [1, 2, 5])
def test_rounds_do_not_change_the_result(spark, sink, pages):
    """Ticks closer than a second, and pages that end in rows that cannot be written."""
    rows = [(str(T0 + i * 100), {"temp" if i % 100 > 90 else "sensor1": str(i)}) for i in range(330)]
    maps = spark.createDataFrame(rows, "row_key string, cells map<string,string>")
    run_incremental(spark, maps, sink, "cells", pages_per_round=pages)
    want = as_means(backfill_means(maps.where("map_contains_key(cells, 'sensor1')"), "cells"))
    got = sink_means(sink.read(spark))
    assert len(got) == 3 * 10 + 3 and got[0] == want[0]
    assert sum(v for _, _, v in got) == sum(
        sum(p[k : k + 10]) // 10
        for p in ([i for i in range(q, min(q + 100, 330)) if i % 100 <= 90] for q in (0, 100, 200, 300))
        for k in range(0, len(p), 10)
    )


def test_pages_of_broken_runs_go_one_by_one(spark, sink):
    rows = random_rows(14, 250, 1.0)
    wide = wide_frame(spark, rows)
    with pytest.raises(ValueError):
        backfill_means(wide, CELLS, page_size=57)
    with pytest.raises(ValueError):
        run_incremental(spark, wide, sink, CELLS, page_size=57, pages_per_round=2)
    run_incremental(spark, wide, sink, CELLS, page_size=57)
    assert sink_means(sink.read(spark)) == loop(rows, page=57)


def test_a_run_goes_on_from_a_position(spark, sink):
    rows = random_rows(15, 230, 0.7)
    wide = wide_frame(spark, rows)
    first = run_incremental(spark, wide, sink, CELLS, max_batches=1)
    assert first.position == int(rows[99]["row_key"])
    run_incremental(spark, wide, sink, CELLS, start_after=first.position)
    assert sink_means(sink.read(spark)) == loop(rows)


def test_numeric_keys_of_any_length(spark, sink):
    rows = [{"row_key": str(90 + i), **{c: str(i) for c in CELLS}} for i in range(60)]
    wide = wide_frame(spark, rows)
    run_incremental(spark, wide, sink, CELLS, page_size=20, key_order="numeric", pages_per_round=2)
    assert sink_means(sink.read(spark)) == as_means(backfill_means(wide, CELLS, page_size=20))


def test_next_pages_are_read_between_two_keys(spark):
    rows = random_rows(16, 300, 1.0)
    wide = wide_frame(spark, rows)
    keys = [int(r["row_key"]) for r in rows]
    for width in (None, 10, 10**9):
        got = next_page_ends(wide, keys[49], 2, 100, width)
        assert got == [(keys[149], 100), (keys[249], 100)]


def test_errors_end_the_run_and_leave_the_sink(spark, sink):
    rows = random_rows(11, 120, 1.0)
    rows[110]["sensor1"] = "abc"
    wide = wide_frame(spark, rows)
    with pytest.raises(Exception, match="not a 32-bit integer"):
        run_incremental(spark, wide, sink, CELLS, hwm_pad_ms=0)
    assert sink_means(sink.read(spark)) == loop(rows, batches=1)


def test_the_default_pad_is_that_of_the_sink(spark, sink):
    rows = [{"row_key": str(T0 + i * 100), **{c: "1" for c in CELLS}} for i in range(300)]
    wide = wide_frame(spark, rows)
    for _ in range(3):  # each run starts from the watermark of the sink
        run_incremental(spark, wide, sink, CELLS, max_batches=1)
    assert sink_means(sink.read(spark)) == as_means(backfill_means(wide, CELLS))


@pytest.mark.parametrize("precision,pad", [(1, 999), (1000, 999), (1, 0)])
def test_late_rows_are_what_a_restart_skips(spark, tmp_path, precision, pad):
    rows = [{"row_key": str(T0 + i * 130), **{c: "1" for c in CELLS}} for i in range(300)]
    wide = wide_frame(spark, rows)
    sink = FileTable(str(tmp_path / "records"), precision_ms=precision).create(spark)
    run_incremental(spark, wide, sink, CELLS, max_batches=1)
    end = T0 + 99 * 130
    kept = end // precision * precision
    ms = wide.select(F.col("row_key").cast("bigint").alias("ms"))
    late = late_rows(ms, spark.createDataFrame([(end,)], "ms bigint"), precision, pad)
    left = key_after(wide, kept, pad).count()
    assert {(r["ms"], r["hwm"]) for r in late.collect()} == {
        (t, end) for t in range(end + 130, kept + pad + 1, 130)
    }
    assert left + late.count() == 200


def test_late_rows_of_one_step(spark):
    ms = spark.createDataFrame([(T0 + i * 100,) for i in range(130)], "ms bigint")
    hwms = spark.createDataFrame([(T0 + 5200,), (T0 + 5700,)], "ms bigint")
    late = sorted((r["ms"] - T0, r["hwm"] - T0) for r in late_rows(ms, hwms).collect())
    assert late == [(t, 5200) for t in range(5300, 6000, 100)]


def test_existing_rows_are_not_appended_again(spark, sink):
    rows = random_rows(12, 100, 1.0)
    wide = wide_frame(spark, rows)
    run_incremental(spark, wide, sink, CELLS)
    before = sink.read(spark)
    assert append_new(before, before).count() == 0
    lost = FileTable(sink.path + "-part").create(spark)
    lost.append(before.where("sensor_id = 1").orderBy("date").limit(3))
    copy = lost.read(spark)
    assert append_new(before, copy).count() == before.count() - 3


def test_watermark_of_no_rows_or_no_dates_is_null(spark, sink):
    assert sink.high_water_ms(spark) is None
    sink.append(spark.createDataFrame([(None, 1.0, 1)], sink.schema))
    row = high_water(sink.read(spark)).first()
    assert (row["n_rows"], row["hwm"]) == (1, None)


def test_key_order(spark):
    df = spark.createDataFrame([("9",), ("10",)], "row_key string")
    keys = lambda d: [r[0] for r in d.collect()]
    assert keys(key_after(df, 5, 0)) == ["9"]
    assert sorted(keys(key_after(df, 5, 0, key_order="numeric"))) == ["10", "9"]
    assert keys(key_from(df, 10, key_order="numeric")) == ["10"]
    assert sorted(keys(key_after(df, None))) == ["10", "9"]
    with pytest.raises(ValueError):
        key_after(df, 5, key_order="other")


def test_source_files_are_pruned_by_key(spark, tmp_path):
    path = os.path.join(tmp_path, "wide")
    wide_frame(spark, random_rows(13, 50, 1.0)).write.parquet(path)
    plan = key_after(spark.read.parquet(path), T0)._jdf.queryExecution().executedPlan().toString()
    assert f"GreaterThan(row_key,{T0 + 999})" in plan
