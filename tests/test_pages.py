import random

import pytest
from tickfold.operators import assign_pages, known_pages
from tickfold.operators.pages import (
    _bucket_start,
    _bucket_width,
    _width_of,
    hour_of,
    hour_table,
    part_table,
    slot_table,
)
from tickfold.schema import MAX_KEY_MS

T0 = 1_700_000_000_000


def _expected(keys, size):
    ticks = {ms: i for i, ms in enumerate(sorted(set(keys)))}
    n = len(ticks)
    return sorted(
        (ms, ticks[ms] // size, ticks[ms] % size, min(size, n - ticks[ms] // size * size))
        for ms in keys
    )


def _got(df):
    return sorted(tuple(r) for r in df.select("ms", "page_id", "tick_no", "n_rows").collect())


def _keys(kind, rng):
    if kind == "spread":
        return rng.sample(range(T0, T0 + 90 * 86_400_000), 700)
    if kind == "hot hour":  # most ticks in one hour, a few far away
        return list(range(T0, T0 + 900)) + rng.sample(range(T0 - 10**11, T0), 100)
    if kind == "outside the domain":
        return [-(10**14), -5, 0, 3, MAX_KEY_MS, MAX_KEY_MS + 1, 10**17, *range(T0, T0 + 60)]
    if kind == "microseconds":
        return [1000 * k for k in rng.sample(range(T0, T0 + 9 * 86_400_000), 300)]
    if kind == "decades":  # either side of zero, and where the width of a bucket changes
        ends = [10**e + i for e in (13, 14, 15, 16, 17, 18) for i in range(-6, 6)]
        far = [2**63 - 2, 2**63 - 9, 9 * 10**18, 9 * 10**18 - 1]
        return [*ends, *[-k for k in ends], *range(-9, 9), *far, *[-k for k in far]]
    if kind == "one":
        return [T0]
    return []


@pytest.mark.parametrize("kind", ["spread", "hot hour", "outside the domain", "one", "none", "microseconds", "decades"])
@pytest.mark.parametrize("max_parts", [1, 3, 131_072])
def test_pages_equal_the_sorted_list(spark, kind, max_parts):
    keys = _keys(kind, random.Random(7))
    df = spark.createDataFrame([(k,) for k in keys], "ms bigint").repartition(5)
    options = {"page_size": 10, "max_parts": max_parts, "ticks_per_part": 1, "unique": True}
    assert _got(assign_pages(df, **options)) == _expected(keys, 10)
    ticks, hours = hour_table(df, **options)
    assert part_table(ticks, hours).count() <= max_parts


def test_buckets_of_other_keys(spark):
    """Bucket numbers never fall as keys rise, and keys of 16 digits are spread as those of 13."""
    rng = random.Random(11)
    sizes = [rng.randrange(10**e) for e in range(1, 19) for _ in range(200)]
    keys = sorted({*sizes, *[-k for k in sizes], *_keys("decades", rng)})
    df = spark.createDataFrame([(k,) for k in keys], "ms bigint")
    rows = df.selectExpr("ms", f"{hour_of('ms')} AS hour").orderBy("ms").collect()
    hours = [r["hour"] for r in rows]
    assert hours == sorted(hours)
    by_bucket = df.selectExpr(f"{hour_of('ms')} AS hour", f"{_width_of('ms')} AS wide", "ms")
    placed = by_bucket.selectExpr("*", f"{_bucket_width('hour')} AS width")
    wrong = placed.selectExpr("*", f"{_bucket_start('hour')} AS start").where(
        "width <> wide OR (abs(ms) < 9000000000000000000 AND ms NOT BETWEEN start AND start + width - 1)"
    )
    assert wrong.collect() == []
    usual = spark.range(T0, T0 + 30 * 86_400_000, 600_000).selectExpr("id AS ms")
    buckets = {
        scale: hour_table(usual.selectExpr(f"ms * {scale} AS ms"), unique=True)[1].count()
        for scale in (1, 1000)
    }
    assert buckets[1000] * 10 >= buckets[1] > 100


def test_slots_of_a_burst_have_few_candidates(spark):
    burst = spark.range(T0, T0 + 200_000).selectExpr("id AS ms")
    sparse = spark.range(1, 2001).selectExpr(f"{T0} - id * 7200000 AS ms")
    df = burst.union(sparse)
    ticks, hours = hour_table(df, ticks_per_part=100, unique=True)
    parts = part_table(ticks, hours)
    slots = slot_table(parts, hours.select("hour", "slot_ms"))
    n_hours, n_parts = hours.count(), parts.count()
    assert n_parts == 2020
    assert slots.count() <= 2 * n_hours + 4 * n_parts
    assert slots.groupBy("slot").count().selectExpr("max(count)").first()[0] <= 12
    pages = assign_pages(df, ticks_per_part=100, unique=True).groupBy("page_id").count()
    assert pages.where("count = 100").count() == 2020


def test_readings_of_one_tick_share_its_page(spark):
    rng = random.Random(3)
    keys = [T0 + rng.randint(0, 400) * 60_000 for _ in range(1500)]
    df = spark.createDataFrame([(k,) for k in keys], "ms bigint")
    assert _got(assign_pages(df, page_size=25, max_parts=4, ticks_per_part=1)) == _expected(keys, 25)


def test_rows_without_a_key_are_left_out(spark):
    df = spark.createDataFrame([(T0,), (None,)], "ms bigint")
    assert _got(assign_pages(df)) == [(T0, 0, 0, 1)]


def test_columns_of_the_input_are_kept(spark):
    df = spark.createDataFrame([(T0, "x")], "ms bigint, `odd name` string")
    assert assign_pages(df).columns == ["ms", "odd name", "part", "page_id", "n_rows", "tick_no"]


def test_known_pages(spark):
    df = spark.createDataFrame([(str(T0 + i), T0 + i) for i in range(25)], "row_key string, ms bigint")
    ends = [(str(T0 + 9), 10), (str(T0 + 19), 10), (str(T0 + 24), 5)]
    assert _got(known_pages(df, ends)) == _expected(range(T0, T0 + 25), 10)
