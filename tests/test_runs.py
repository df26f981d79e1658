"""Small cases with known results."""

import datetime as dt
import random

import pytest
from model import CELLS, T0, as_means, wide_frame
from tickfold import operators as op
from tickfold.plans import backfill_means, page_readings


def _rows(n, cell=lambda i, c: "10" if c == "sensor1" else None):
    return [
        {"row_key": str(T0 + i * 1000), **{c: cell(i, c) for c in CELLS}} for i in range(n)
    ]


def _means(spark, rows, **options):
    return as_means(backfill_means(wide_frame(spark, rows), CELLS, **options))


def test_gate_needs_ten_rows(spark):
    assert _means(spark, _rows(9)) == []
    assert _means(spark, _rows(10)) == [(1, T0 + 9000, 10)]


def test_tail_of_57_rows_waits(spark):
    rows = _rows(57, lambda i, c: "1")
    assert len(_means(spark, rows)) == 5 * len(CELLS)
    tail = op.chunk_tail(page_readings(wide_frame(spark, rows), CELLS)).collect()
    assert [(r["n_runs"], r["n_used"], r["n_left"]) for r in tail] == [(5, 50, 7)] * len(CELLS)


def test_short_run_is_still_divided_by_ten(spark):
    rows = _rows(10, lambda i, c: "10" if c == "sensor2" or (c == "sensor1" and i < 7) else None)
    assert _means(spark, rows)[0] == (1, T0 + 6000, 7)
    assert _means(spark, rows, divisor="count")[0] == (1, T0 + 6000, 10)


def test_empty_run_has_no_row(spark):
    rows = _rows(20, lambda i, c: "10" if c == "sensor2" or (c == "sensor1" and i < 10) else None)
    assert [m for m in _means(spark, rows) if m[0] == 1] == [(1, T0 + 9000, 10)]


def test_negative_mean_truncates_to_zero(spark):
    rows = _rows(10, lambda i, c: ("-6" if i == 0 else "-1") if c == "sensor1" else None)
    assert _means(spark, rows) == [(1, T0 + 9000, -1)]
    assert _means(spark, rows, rounding="exact") == [(1, T0 + 9000, -1.5)]


def test_sum_does_not_wrap(spark):
    rows = _rows(10, lambda i, c: "2147483647" if c == "sensor1" else None)
    assert _means(spark, rows) == [(1, T0 + 9000, 2147483647)]


def test_bad_value_fails_the_job(spark):
    rows = _rows(10, lambda i, c: "3.5" if c == "sensor1" else None)
    with pytest.raises(Exception, match="not a 32-bit integer"):
        _means(spark, rows)


def test_bad_cells_may_be_left_out(spark):
    rows = _rows(11, lambda i, c: ("3.5" if i == 4 else "10") if c == "sensor1" else None)
    assert _means(spark, rows, on_error="reject") == [(1, T0 + 10000, 10)]
    maps = spark.createDataFrame(
        [(r["row_key"], {"sensor1": r["sensor1"]}) for r in rows],
        "row_key string, cells map<string,string>",
    )
    assert as_means(backfill_means(maps, "cells", on_error="reject")) == [(1, T0 + 10000, 10)]


def test_row_cut_leaves_the_last_ticks_for_every_sensor(spark):
    rows = _rows(15, lambda i, c: "10" if c == "sensor1" or (c == "sensor2" and i > 8) else None)
    assert (2, T0 + 14000, 6) in _means(spark, rows)
    assert (2, T0 + 9000, 1) in _means(spark, rows, tail_policy="row_cut")


def test_wide_and_long_runs_are_the_same(spark):
    rng = random.Random(4)
    cell = lambda i, c: str(rng.randint(-99, 99)) if c == "sensor1" or rng.random() < 0.4 else None
    wide = wide_frame(spark, _rows(157, cell)).cache()
    for policy in ("reference", "row_cut"):
        long = op.chunk_mean(page_readings(wide, CELLS), tail_policy=policy)
        assert as_means(long) == as_means(backfill_means(wide, CELLS, tail_policy=policy))
    wide.unpersist()


def test_many_columns_give_the_same_means(spark, monkeypatch):
    rng = random.Random(6)
    cell = lambda i, c: rng.choice(["7", "-8", "x", None]) if c != "sensor1" else "5"
    wide = wide_frame(spark, _rows(57, cell)).cache()
    few = as_means(backfill_means(wide, CELLS, on_error="reject"))
    monkeypatch.setattr("tickfold.plans.backfill.PACK_ABOVE", 2)
    packed = backfill_means(wide, CELLS, on_error="reject")
    assert "posexplode" in packed._jdf.queryExecution().toString()
    assert as_means(packed) == few
    with pytest.raises(Exception, match="not a 32-bit integer"):
        backfill_means(wide, CELLS).collect()
    wide.unpersist()


def test_ids_stay_text_where_they_are_no_plain_numbers(spark):
    wide = wide_frame(spark, _rows(1)).withColumnRenamed("sensor1", "sensor01")
    readings = op.unpivot_static(wide, ["sensor01", "sensor2"])
    assert [(r["sensor_id"], r["value"]) for r in readings.collect()] == [("01", "10")]


def test_unknown_options_are_refused(spark):
    for bad in ({"divisor": "x"}, {"rounding": "x"}, {"on_error": "x"}, {"tail_policy": "x"}):
        with pytest.raises(ValueError):
            backfill_means(wide_frame(spark, _rows(10)), CELLS, **bad)


def test_map_rows_give_the_same_means(spark):
    rows = _rows(40, lambda i, c: str(i) if (i + len(c)) % 3 or c == "sensor1" else None)
    maps = spark.createDataFrame(
        [(r["row_key"], {c: r[c] for c in CELLS}) for r in rows],
        "row_key string, cells map<string,string>",
    )
    assert as_means(backfill_means(maps, "cells")) == _means(spark, rows)


def test_repeated_keys_share_a_tick(spark):
    rows = _rows(10)
    doubled = wide_frame(spark, rows + rows)
    means = as_means(backfill_means(doubled, CELLS, unique_keys=False))
    assert means == [(1, T0 + 4000, 10)]  # ten of the twenty readings make the one run


def _gate_means(spark, rows):
    return spark.createDataFrame(
        [(0, p, c, s, ms, 1) for p, c, s, ms in rows],
        "part bigint, page_id bigint, chunk_idx bigint, sensor_id int, ms bigint, value bigint",
    )


def test_held_group_holds_all_later_groups(spark):
    means = _gate_means(spark, [(0, 0, 1, 10), (0, 0, 2, 90), (0, 1, 1, 20), (1, 0, 1, 30)])
    count = lambda as_of: op.release_gate(means, as_of).count()
    assert [count(5), count(89), count(90), count(1000)] == [0, 0, 4, 4]
    later = _gate_means(spark, [(0, 0, 1, 10), (0, 1, 1, 50), (0, 2, 1, 20), (1, 0, 1, 30)])
    assert op.release_gate(later, 40).count() == 1
    assert op.release_gate(later, dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)).count() == 4


def test_bad_ids_and_values_are_set_aside(spark):
    means = spark.createDataFrame(
        [("1", T0, "7"), ("temp", T0, "7"), (None, T0, "7"), ("2", T0, "x"), ("3", T0, " 5 ")],
        "sensor_id string, ms bigint, value string",
    )
    good, bad = op.split_marked(op.mark_sink_rows(means))
    assert sorted((r["sensor_id"], r["value"]) for r in good.collect()) == [(1, 7.0), (3, 5.0)]
    assert sorted(r["reason"] for r in bad.collect()) == ["bad sensor_id", "bad sensor_id", "bad value"]
    assert op.sink_shape(means).count() == 2


def test_bad_readings_are_set_aside(spark):
    readings = spark.createDataFrame(
        [(str(T0), "1", v) for v in ("3.5", " 5 ", "abc", "5")] + [("key", "1", "5")],
        "row_key string, sensor_id string, value string",
    )
    good, bad = op.split_marked(op.mark_readings(readings))
    assert [(r["ms"], r["v"]) for r in good.collect()] == [(T0, 5)]
    assert sorted(r["reason"] for r in bad.collect()) == ["bad row_key"] + ["bad value"] * 3


def test_columns_that_share_an_id_make_one_run(spark, monkeypatch):
    rows = [(str(T0 + i * 1000), "10", "20") for i in range(10)]
    wide = spark.createDataFrame(rows, "row_key string, sensor1 string, `1` string")
    want = [(1, T0 + 4000, 15)]
    assert as_means(backfill_means(wide, ["sensor1", "1"])) == want
    monkeypatch.setattr("tickfold.plans.backfill.PACK_ABOVE", 1)
    assert as_means(backfill_means(wide, ["sensor1", "1"])) == want


def test_names_with_quotes(spark):
    names = ["it's", "back`tick", "a\\b"]
    rows = [(str(T0 + i * 1000), "1", "2", "3") for i in range(10)]
    wide = spark.createDataFrame(rows, ["row_key", *names])
    got = {r["sensor_id"]: r["value"] for r in backfill_means(wide, names).collect()}
    assert got == {"it's": 1, "back`tick": 2, "a\\b": 3}
    assert op.row_arrays(wide, names).first()["readings"][0]["value"] == "3"


def test_repeated_keys_are_refused_unless_they_are_expected(spark):
    doubled = wide_frame(spark, _rows(10) + _rows(3))
    with pytest.raises(Exception, match="repeated row key"):
        backfill_means(doubled, CELLS).collect()
