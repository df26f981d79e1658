"""The sink with a log: commits, kills, restarts, rejects and held run groups."""

import os

import pytest
from model import CELLS, T0, loop, random_rows, sink_means, wide_frame
from pyspark.sql import functions as F
from tickfold.operators import mark_readings, unpivot_static
from tickfold.plans import run_incremental
from tickfold.plans import logged as logged_plan
from tickfold.sources import CommitLog, Conflict, LoggedSink, PageFinder, Snapshot, full_scan
from tickfold.sources import wide as wide_source

SCHEMA = "row_key string, " + ", ".join(f"{c} string" for c in CELLS)


@pytest.fixture()
def sink(tmp_path):
    return LoggedSink(str(tmp_path / "sink"))


def log_of(spark, tmp_path, **options):
    schema = spark.createDataFrame([], "id long").schema
    return CommitLog(str(tmp_path / "log"), {"t": schema, "u": schema}, **options)


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_commits_are_all_or_nothing(spark, tmp_path):
    log = log_of(spark, tmp_path)
    assert log.latest(spark) == Snapshot() and ids(log.read(spark, "t")) == []
    first = log.append(spark.range(3), "t", position=7)
    log.stage(spark.range(100))  # a job that died before its entry
    assert ids(log.read(spark, "t")) == [0, 1, 2]
    both = {t: log.stage(spark.range(10, 12)) for t in ("t", "u")}
    second = log.publish(spark, first, both, {"count": 2})
    assert log.latest(spark) == second and second.state == {"position": 7, "count": 2}
    assert ids(log.read(spark, "t")) == [0, 1, 2, 10, 11] and ids(log.read(spark, "u")) == [10, 11]
    assert ids(log.read(spark, "t", first)) == [0, 1, 2]
    with pytest.raises(Conflict):  # a writer that did not see the second entry
        log.publish(spark, first, {"t": log.stage(spark.range(5))}, {"position": 9})
    assert log.latest(spark) == second
    third = log.publish(spark, second, {"u": log.stage(spark.range(1))}, {}, replaced=("u",))
    assert ids(log.read(spark, "u")) == [0] and third.version == 3
    assert log.vacuum(spark) == 3
    assert ids(log.read(spark, "t")) == [0, 1, 2, 10, 11]


def test_folders_and_entries_do_not_grow(spark, tmp_path):
    log = log_of(spark, tmp_path, merge_above=4)
    for i in range(30):
        log.append(spark.range(i, i + 1), "t", last=i)
    now = log.latest(spark)
    assert len(now.folders["t"]) <= 5 and now.version == 30 and now.state == {"last": 29}
    assert ids(log.read(spark, "t")) == list(range(30))
    assert len([n for n in os.listdir(f"{log.path}/log") if n.endswith(".json")]) <= 20
    log.vacuum(spark)
    assert len(os.listdir(f"{log.path}/data")) == len(now.folders["t"])
    assert ids(log.read(spark, "t")) == list(range(30))


@pytest.mark.parametrize("seed,n,fill,pages", [(2, 9, 0.5, 1), (5, 157, 0.9, 1), (6, 319, 0.35, 2), (7, 250, 1.0, 5)])
def test_rounds_equal_the_loop(spark, sink, seed, n, fill, pages):
    rows = random_rows(seed, n, fill)
    report = run_incremental(spark, wide_frame(spark, rows), sink, CELLS, pages_per_round=pages)
    assert report.status == "not enough data"
    assert sink_means(sink.records(spark)) == loop(rows)
    again = run_incremental(spark, wide_frame(spark, rows), sink, CELLS)
    assert (again.batches, again.position) == (0, report.position)
    assert sink_means(sink.records(spark)) == loop(rows)


@pytest.mark.parametrize("step", ["stage", "_add"])
def test_a_killed_round_leaves_nothing(spark, sink, monkeypatch, step):
    rows = random_rows(21, 250, 0.8)
    wide = wide_frame(spark, rows)
    run_incremental(spark, wide, sink, CELLS, max_batches=1)
    before = sink.latest(spark)
    real = getattr(LoggedSink, step)

    def killed(self, *args):
        if step == "stage":
            real(self, *args)
        raise KeyboardInterrupt

    monkeypatch.setattr(LoggedSink, step, killed)
    with pytest.raises(KeyboardInterrupt):
        run_incremental(spark, wide, sink, CELLS)
    monkeypatch.undo()
    assert sink.latest(spark) == before
    assert sink_means(sink.records(spark)) == loop(rows, batches=1)
    run_incremental(spark, wide, sink, CELLS)
    assert sink_means(sink.records(spark)) == loop(rows)


def test_rejects_are_reported_once(spark, sink):
    """100 ticks that can be written, then 130 that can't; three runs."""
    rows = [(str(T0 + i * 1000), {"sensor1" if i < 100 else "temp": "1"}) for i in range(230)]
    maps = spark.createDataFrame(rows, "row_key string, cells map<string,string>")
    counts = []
    for _ in range(3):
        counts.append(run_incremental(spark, maps, sink, "cells").rejected)
        assert sink.read(spark, "rejects").count() == 13
    assert counts == [13, 0, 0] and sink.latest(spark).state["rejected"] == 13
    assert {r["reason"] for r in sink.read(spark, "rejects").collect()} == {"bad sensor_id"}
    assert sink.records(spark).count() == 10


@pytest.mark.parametrize("pages", [1, 3])
def test_bad_cells_are_committed_with_their_round(spark, sink, pages):
    rows = random_rows(23, 230, 0.8)
    for i in (5, 77, 101, 102, 229):
        rows[i][CELLS[i % 3]] = "3.5"
    wide = wide_frame(spark, rows)
    for batches in (1, 10, 10):
        run_incremental(
            spark, wide, sink, CELLS, pages_per_round=pages, max_batches=batches, on_error="reject"
        )
    marked = mark_readings(unpivot_static(wide, CELLS)).where("reason IS NOT NULL")
    want = sorted((r["row_key"], str(r["sensor_id"]), r["value"]) for r in marked.collect())
    got = sink.read(spark, "bad_cells")
    assert sorted((r["row_key"], r["qualifier"], r["cell"]) for r in got.collect()) == want
    assert len(want) == 5 == sink.latest(spark).state["bad_cells"]
    good = [{k: None if v == "3.5" else v for k, v in r.items()} for r in rows]
    assert sink_means(sink.records(spark)) == loop(good)


@pytest.mark.parametrize("pages", [1, 2])
def test_run_groups_leave_as_they_fall_due(spark, sink, pages):
    """A clock that stops inside pages: at every stop the sink has the groups up to the first
    that is not due, and nothing beyond the page of that one is read."""
    rows = random_rows(24, 250, 0.7)
    wide, keys = wide_frame(spark, rows), [int(r["row_key"]) for r in rows]
    everything = loop(rows)

    def groups():
        out = []
        for p in range(0, 250, 100):
            page = loop(rows[p : p + 100], batches=1)
            for g in range(10):
                own = [m for m in page if sum(1 for o in page if o[0] == m[0] and o[1] < m[1]) == g]
                if own:
                    out.append(own)
        return out

    for at in (0, 35, 36, 99, 150, 151, 249):
        now = keys[at]
        report = run_incremental(
            spark, wide, sink, CELLS, clock=lambda n=now: n / 1000, pages_per_round=pages
        )
        want = []
        for own in groups():
            if max(m[1] for m in own) > now:
                break
            want += own
        assert sink_means(sink.records(spark)) == sorted(want), at
        left = sink.read(spark, "held").count()
        assert (report.status == "held") == (left > 0)
        assert left + len(want) <= len(everything)
    run_incremental(spark, wide, sink, CELLS)
    assert sink_means(sink.records(spark)) == everything
    assert sink.read(spark, "held").count() == 0


def test_a_round_sees_one_list_of_files(spark, sink, tmp_path, monkeypatch):
    """Rows that arrive between the jobs of a round belong to the next round."""
    rows, path = random_rows(25, 260, 0.8), str(tmp_path / "wide")
    wide_frame(spark, rows[:160]).write.parquet(path)
    real, late = PageFinder.next, [rows[160:]]

    def grown(self, *args):
        found = real(self, *args)
        if late:  # smaller keys than some that were found, too
            wide_frame(spark, late.pop()).write.mode("append").parquet(path)
        return found

    monkeypatch.setattr(PageFinder, "next", grown)
    schema = spark.createDataFrame([], SCHEMA).schema
    run_incremental(spark, lambda: full_scan(spark, path, schema=schema), sink, CELLS, pages_per_round=2)
    first = loop(rows[:160])
    start = max(m[1] for m in first)
    rest = loop([r for r in rows if int(r["row_key"]) > start])
    assert sink_means(sink.records(spark)) == sorted(first + rest)


def test_a_stop_between_rounds(spark, sink):
    asked = []
    wide = wide_frame(spark, random_rows(9, 250, 1.0))
    report = run_incremental(spark, wide, sink, CELLS, stop=lambda: len(asked) > 0 or asked.append(1))
    assert (report.batches, report.status) == (1, "stopped")
    with pytest.raises(ValueError):
        run_incremental(spark, wide, sink, CELLS, page_size=57, pages_per_round=2)
    run_incremental(spark, wide, LoggedSink(sink.path + "-b"), CELLS, page_size=57)
    got = sink_means(LoggedSink(sink.path + "-b").records(spark))
    assert got == loop(random_rows(9, 250, 1.0), page=57)


def test_pages_are_looked_for_between_two_keys(spark, tmp_path, monkeypatch):
    """On sorted files with gaps no look is open at its end, and what is looked at stays in
    proportion to the pages."""
    ms, keys = T0, []
    for i in range(5000):
        ms += 10_000_000 if i % 700 == 699 else 7
        keys.append(ms)
    path = str(tmp_path / "wide")
    spark.createDataFrame([(str(k), "1") for k in keys], "row_key string, sensor1 string").repartitionByRange(
        20, "row_key"
    ).sortWithinPartitions("row_key").write.parquet(path)
    looks, real = [], wide_source.page_ends

    def seen(df, *args, **options):
        looked = wide_source.key_after(df, args[0], 0)
        looks.append((looked._jdf.queryExecution().executedPlan().toString(), looked.count()))
        return real(df, *args, **options)

    monkeypatch.setattr(wide_source, "page_ends", seen)
    df, finder, after, got, most = spark.read.parquet(path), PageFinder(), None, [], []
    while True:
        looks.clear()
        found = finder.next(df, after, 2)
        if not found:
            break
        for plan, _ in looks:
            assert "LessThanOrEqual(row_key" in plan and "GreaterThan" in plan
        most.append(sum(n for _, n in looks))
        got += found
        after = found[-1][0]
    assert got == [(keys[min(i + 99, 4999)], 100) for i in range(0, 5000, 100)]
    assert len(most) == 25 and sorted(most)[12] <= 1200


def test_pages_of_mixed_and_growing_keys(spark):
    few = spark.createDataFrame([(str(k),) for k in range(5, 60)], "row_key string")
    assert PageFinder(20, "numeric").next(few, None, 2) == [(24, 20), (44, 20)]
    assert PageFinder(20, "numeric").next(few, 44, 2) == [(59, 15)]
    text = sorted(str(k) for k in range(5, 60))
    assert PageFinder(20).next(few, None, 1) == [(int(text[19]), 20)]
    assert PageFinder().next(few.where("false"), None) == []
    finder = PageFinder(10, growing=True)
    assert finder.next(few.where("row_key BETWEEN '10' AND '14'"), None) == [(14, 5)]
    assert finder.next(few.where("row_key BETWEEN '10' AND '24'"), None) == [(19, 10)]
    assert finder.next(few.where("row_key BETWEEN '10' AND '24'"), 19) == [(24, 5)]


def test_position_of_the_log_is_not_the_newest_date(spark, sink):
    rows = random_rows(15, 230, 0.7)
    first = run_incremental(spark, wide_frame(spark, rows), sink, CELLS, max_batches=1)
    assert first.position == int(rows[99]["row_key"]) == sink.latest(spark).state["position"]
    assert sink.high_water_ms(spark) <= first.position
    assert logged_plan.release_held(spark, sink, 0) == sink.latest(spark)
    assert sink.records(spark).where(F.col("date").isNull()).count() == 0


def test_rounds_grow_while_a_backlog_lasts(spark, sink, tmp_path, monkeypatch):
    """Gaps, a repeated key and rows that are not due, which grown rounds leave to steady ones."""
    monkeypatch.setattr(logged_plan, "STEADY_ROUNDS", 2)
    rows = random_rows(11, 9_050, 0.4)
    for i, r in enumerate(rows):  # after a third a gap, and a stretch that is ten times as dense
        far = 0 if i < 3_000 else 10**9
        r["row_key"] = str(T0 + far + i * (100 if i < 6_000 else 1_000))
    wide = wide_frame(spark, rows)
    report = run_incremental(spark, wide, sink, CELLS, pages_per_round=5, max_batches=10**6)
    assert (report.batches, report.status) == (91, "not enough data")
    assert report.rounds < 13  # 19 rounds of five pages
    assert report.position == sink.latest(spark).state["position"]
    assert sink_means(sink.records(spark)) == loop(rows)

    capped = LoggedSink(str(tmp_path / "capped"))
    report = run_incremental(spark, wide, capped, CELLS, pages_per_round=5, max_batches=47)
    assert (report.batches, report.position) == (47, int(rows[4_699]["row_key"]))
    held = LoggedSink(str(tmp_path / "held"))
    now = int(rows[7_000]["row_key"])
    run_incremental(spark, wide, held, CELLS, pages_per_round=1, max_batches=10**6, clock=lambda: now / 1000)
    assert sorted(r["page_key"] for r in held.read(spark, "held").select("page_key").distinct().collect()) == [
        int(rows[7_099]["row_key"])
    ]
    run_incremental(spark, wide, held, CELLS, pages_per_round=5, max_batches=10**6)
    assert sink_means(held.records(spark)) == loop(rows)
