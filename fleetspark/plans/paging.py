"""Argument bounds, pages and bounded results."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspark.settings import MAX_RESULT_ROWS, RETENTION_DAYS

VEHICLE_PATTERN = r"V[0-9]{6,}"
FLEET_PATTERN = r"F[0-9]{3}"


def check_between(name: str, value: int, low: int, high: int) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or not low <= value <= high:
        raise ValueError(f"{name} must be an integer between {low} and {high}")
    return value


def check_days(days: int) -> int:
    return check_between("days", days, 1, RETENTION_DAYS)


def check_page(limit: int, offset: int, highest: int) -> None:
    check_between("limit", limit, 1, highest)
    if isinstance(offset, bool) or not isinstance(offset, int) or offset < 0:
        raise ValueError("offset must not be negative")


def check_vehicle(vehicle_id: str) -> str:
    if not re.fullmatch(VEHICLE_PATTERN, vehicle_id):
        raise ValueError("malformed vehicle id")
    return vehicle_id


def check_fleet(fleet_id: str | None) -> str | None:
    if fleet_id is not None and not re.fullmatch(FLEET_PATTERN, fleet_id):
        raise ValueError("malformed fleet id")
    return fleet_id


def distinct_ids(ids: Iterable[str]) -> list[str]:
    """Ids without repeats, in the order given."""
    return list(dict.fromkeys(ids))


def page(df: DataFrame, order: list[Column], limit: int, offset: int = 0) -> DataFrame:
    """LIMIT/OFFSET page; planned as a per-task top-k, not a full sort (T4)."""
    return df.orderBy(*order).offset(offset).limit(limit)


def page_after(df: DataFrame, keys: list[str], limit: int, after: tuple | None = None) -> DataFrame:
    """The page that follows a key, in ascending order of unique `keys` (T4).

    Unlike an offset, which sorts all it skips, the key is a predicate: of a table stored in key
    order, row groups before it are not read, however deep the page is.
    """
    if after is not None:
        if len(after) != len(keys):
            raise ValueError("a key has a value for each column")
        columns = [F.col(k) for k in keys]
        beyond = F.lit(False)
        for i in range(len(keys)):
            same = F.lit(True)
            for column, value in zip(columns[:i], after):
                same &= column == F.lit(value)
            beyond |= same & (columns[i] > F.lit(after[i]))
        # Implied for several keys, but this form alone reaches file statistics.
        df = df.where(columns[0] >= F.lit(after[0])).where(beyond)
    return df.orderBy(*keys).limit(limit)


def bounded(df: DataFrame, rows: int = MAX_RESULT_ROWS) -> DataFrame:
    """The same frame, or an error when it holds more than `rows` rows.

    Only rows + 1 rows are ever counted.
    """
    if df.limit(rows + 1).count() > rows:
        raise ValueError(f"result exceeds {rows} rows")
    return df
