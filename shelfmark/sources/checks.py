"""Column checks made on the driver, before a plan is built."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def require(df: DataFrame, *columns: str) -> DataFrame:
    """The frame itself; an error naming the columns it lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def first_present(df: DataFrame, names: Sequence[str], needed: bool = False) -> str | None:
    """The first of several spellings of a column that the frame has."""
    found = next((n for n in names if n in df.columns), None)
    if found is None and needed:
        raise ValueError(f"none of the columns {list(names)} is present")
    return found


def column_ignoring_case(df: DataFrame, name: str) -> str:
    """The frame's spelling of a column name; of equal spellings the last one."""
    spellings = {c.lower(): c for c in df.columns}
    if name.lower() not in spellings:
        raise ValueError(f"missing column: {name}")
    return spellings[name.lower()]
