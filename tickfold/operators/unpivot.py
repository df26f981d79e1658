"""Wide rows to readings. Narrow operators: none of them shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tickfold.functions import sensor_id_of
from tickfold.schema import QUALIFIER_WORD


def quoted(name: str) -> str:
    """A column name in SQL text."""
    return "`" + name.replace("`", "``") + "`"


def column_ids(cells: Sequence[str]) -> list[str]:
    """The sensor id of each declared column; two columns may have the same."""
    return [c.replace(QUALIFIER_WORD, "") for c in cells]


def literal_ids(cells: Sequence[str]) -> list[str]:
    """SQL literals of the sensor ids: integers if all are plain numbers, else text."""
    ids = column_ids(cells)
    plain = all(i.isdecimal() and i == str(int(i)) and int(i) < 2**31 for i in ids)
    if plain:
        return ids
    return ["'" + i.replace("\\", "\\\\").replace("'", "\\'") + "'" for i in ids]


def unpivot_static(
    df: DataFrame, cells: Sequence[str], ids: Sequence[str] = ("row_key",)
) -> DataFrame:
    """One row ``ids..., sensor_id, value`` per present cell of the given columns.

    The sensor ids are known when the plan is built, so they enter it as literals and
    no text is replaced per cell.
    """
    pairs = ", ".join(f"{i}, {quoted(c)}" for i, c in zip(literal_ids(cells), cells))
    stacked = f"stack({len(cells)}, {pairs}) AS (sensor_id, value)"
    return df.selectExpr(*ids, stacked).where("value IS NOT NULL")


def pack_cells(df: DataFrame, cells: Sequence[str], ids: Sequence[str] = ("row_key",)) -> DataFrame:
    """The declared columns as one array, ``cells``.

    Above about a hundred columns Spark gives up generated code for a stage and copies
    every column at every step; an array is copied as one block.
    """
    return df.select(*ids, F.array(*[F.col(quoted(c)) for c in cells]).alias("cells"))


def unpivot_packed(
    df: DataFrame, cells: Sequence[str], ids: Sequence[str] = ("row_key",)
) -> DataFrame:
    """The result of ``unpivot_static``, from packed rows."""
    names = f"array({', '.join(literal_ids(cells))})"
    return (
        df.selectExpr(*ids, "posexplode(cells) AS (position, value)")
        .where("value IS NOT NULL")
        .selectExpr(*ids, f"get({names}, position) AS sensor_id", "value")
    )


def unpivot_map(
    df: DataFrame, cells: str = "cells", ids: Sequence[str] = ("row_key",)
) -> DataFrame:
    """The same for rows that carry any qualifiers in a ``map<string,string>``."""
    exploded = df.select(*ids, F.explode(cells).alias("qualifier", "value"))
    return exploded.where(F.col("value").isNotNull()).select(
        *ids, sensor_id_of("qualifier").alias("sensor_id"), "value"
    )


def row_arrays(df: DataFrame, cells: Sequence[str], row_key: str = "row_key") -> DataFrame:
    """Per wide row, the array of its readings in sensor order.

    The cells of a row are already together, so this is a projection and the array is
    never larger than the row it came from.
    """
    pairs = ", ".join(
        f"struct({i} AS sensor_id, {quoted(c)} AS value)" for i, c in zip(literal_ids(cells), cells)
    )
    present = F.filter(F.expr(f"array({pairs})"), lambda e: e["value"].isNotNull())
    return df.select(row_key, F.array_sort(present).alias("readings"))
