"""The physical plans: what is shuffled, pruned and pushed down."""

import re

import pytest
from model import CELLS, random_rows, wide_frame
from tickfold import operators as op
from tickfold.operators.pages import hour_table, part_table
from tickfold.plans import backfill_means, page_readings
from tickfold.session import shared_folder
from tickfold.sources import JdbcTable, page_ends, page_per_split
from tickfold.streaming import count_window_step


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "wide")
    wide_frame(spark, random_rows(1, 300, 0.8)).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(autouse=True)
def no_automatic_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _main_path(plan):
    """Exchanges of the rows themselves: those above the bounds table's broadcast."""
    return re.findall(r"Exchange (\w+)", plan.split("BroadcastExchange")[0])


def test_cells_are_shuffled_once(wide):
    plan = _plan(backfill_means(wide, CELLS))
    assert _main_path(plan) == ["hashpartitioning"]
    assert re.search(r"Exchange hashpartitioning\(part#\d+L", plan)
    assert not re.search(r"hashpartitioning\((page_id|sensor_id)", plan)


@pytest.mark.parametrize(
    "operator", [op.page_mean, op.mean_per_ten, op.max_chunks, op.sensor_arrays, op.page_counts, op.chunk_tail]
)
def test_page_operators_add_no_shuffle(wide, operator):
    assert _main_path(_plan(operator(page_readings(wide, CELLS)))) == ["hashpartitioning"]


def test_regrouping_adds_no_shuffle(wide):
    assert _main_path(_plan(op.chunk_groups(backfill_means(wide, CELLS)))) == ["hashpartitioning"]


def test_page_bounds_read_the_key_only(wide):
    keyed = wide.selectExpr("bigint(row_key) AS ms", "*")
    key_only = {"struct<row_key:string>"}
    for df in [part_table(*hour_table(keyed, unique=True)), page_ends(wide, 5)]:
        assert set(re.findall(r"ReadSchema: (\S+)", _plan(df))) == key_only


def test_unused_cells_are_not_read(wide):
    plan = _plan(backfill_means(wide, ["sensor2"]))
    assert "struct<row_key:string,sensor2:string>" in plan
    assert "sensor3" not in plan


def test_split_pages_are_cut_before_the_shuffle(wide):
    plan = _plan(page_per_split(wide.selectExpr("substr(row_key, 1, 9) AS split", "*"), "split"))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_release_gate_has_no_join(wide):
    plan = _plan(op.release_gate(backfill_means(wide, CELLS), 10**13)).split("BroadcastExchange")[0]
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_stream_positions_are_keyed_by_sensor_and_hour(spark):
    readings = spark.createDataFrame([(1, 1, 1)], "sensor_id int, ms bigint, v int")
    plan = _plan(count_window_step(readings))
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    by_sensor = [k for k in keys if re.fullmatch(r"sensor_id#\d+, \d+", k)]
    assert len(by_sensor) == 1  # the running sum over one row per sensor and hour
    assert all("hour" in k or "run" in k for k in keys if k not in by_sensor)


def test_jdbc_watermark_is_computed_by_the_database():
    assert JdbcTable("jdbc:x", "records").high_water_query() == (
        'SELECT MAX("date") AS "hwm" FROM records'
    )
    assert JdbcTable("jdbc:x", "r", quote="`").high_water_query() == (
        "SELECT MAX(`date`) AS `hwm` FROM r"
    )


class _Session:
    """Stands for a session with the given settings."""

    def __init__(self, **conf):
        self.conf = self
        self._values = {k.replace("_", "."): v for k, v in conf.items()}

    def get(self, key, default=None):
        return self._values.get(key, default)


def test_shared_folder_follows_the_session():
    named = _Session(spark_checkpoint_dir="hdfs://shared/", spark_master="yarn")
    one, two = shared_folder(named, "a"), shared_folder(named, "a")
    assert one.startswith("hdfs://shared/a-") and one != two
    assert shared_folder(_Session(spark_master="local[2]"), "a")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Session(spark_master="yarn"), "a")


def test_part_boundaries_rank_few_keys(spark):
    """Keys are counted where they are; only those of cells where a part starts are shuffled."""
    n, per_part = 60_000, 1000
    ticks = spark.range(n).selectExpr("1700000000000 + id * 97 + (id % 3) AS ms")
    keys, hours = hour_table(ticks, unique=True, ticks_per_part=per_part)
    table = part_table(keys, hours)
    plan = _plan(table)
    assert not re.search(r"Sort \[hour#\d+L ASC NULLS FIRST, ms#", plan)
    for exchange in re.findall(r"Exchange hashpartitioning\(hour#\d+L?, cell#[^\n]*\n[^\n]*", plan):
        assert "partial_" in exchange or "Project" in exchange
    parts = sorted(tuple(r) for r in table.select("part", "lo", "hi").collect())
    ms = [r[0] for r in ticks.orderBy("ms").collect()]
    starts = ms[::per_part]
    assert [p[1] for p in parts] == starts
    assert [p[2] for p in parts[:-1]] == [s - 1 for s in starts[1:]]
