"""Plain Python models that the Spark results are compared with."""

from __future__ import annotations

import random

CELLS = ["sensor1", "sensor2", "sensor3"]
T0 = 1_700_000_000_000


def trunc_div(a: int, b: int) -> int:
    return -(-a // b) if a < 0 else a // b


def page_means(page: list[dict], run: int = 10) -> list[tuple]:
    """Means of one page: (sensor, ms, value), rows in key order."""
    groups = len(page) // run
    out = []
    for cell in CELLS:
        cells = [(int(r["row_key"]), int(r[cell])) for r in page if r[cell] is not None]
        for g in range(groups):
            part = cells[g * run : (g + 1) * run]
            if part:
                out.append((int(cell[6:]), part[-1][0], trunc_div(sum(v for _, v in part), 10)))
    return out


def loop(rows: list[dict], page: int = 100, pad: int = 0, batches: int = 10**9) -> list[tuple]:
    """Read pages after the newest written date until too few rows are left."""
    out: list[tuple] = []
    hwm = None
    rows = sorted(rows, key=lambda r: r["row_key"])
    for _ in range(batches):
        known = hwm // 1000 * 1000 + pad if hwm is not None and pad else hwm
        left = [r for r in rows if known is None or int(r["row_key"]) > known][:page]
        if len(left) < 10:
            break
        means = page_means(left)
        out += means
        hwm = max([m[1] for m in means] + ([hwm] if hwm is not None else []))
    return sorted(out)


def random_rows(seed: int, n: int, fill: float, gap: int = 5000) -> list[dict]:
    """Wide rows with random gaps and missing cells; every row has at least one cell."""
    rng = random.Random(seed)
    ms, rows = T0, []
    for _ in range(n):
        ms += rng.randint(1, gap)
        row = {c: str(rng.randint(-50, 50)) if rng.random() < fill else None for c in CELLS}
        if not any(row.values()):
            row[rng.choice(CELLS)] = str(rng.randint(-50, 50))
        rows.append({"row_key": str(ms), **row})
    return rows


def wide_frame(spark, rows: list[dict]):
    schema = "row_key string, " + ", ".join(f"{c} string" for c in CELLS)
    return spark.createDataFrame([tuple(r[c] for c in ["row_key", *CELLS]) for r in rows], schema)


def as_means(df) -> list[tuple]:
    return sorted((int(r["sensor_id"]), r["ms"], r["value"]) for r in df.collect())


def sink_means(df) -> list[tuple]:
    rows = df.selectExpr("sensor_id", "unix_millis(date) AS ms", "bigint(value) AS value").collect()
    return sorted(tuple(r) for r in rows)
