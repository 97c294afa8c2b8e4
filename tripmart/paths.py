"""Where things lie: three layers under one base path, months as Hive folders."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date

PARTITION = "partition_date"
RAW, STAGING, FINAL = "raw", "staging", "final"


def _join(*parts: str | None) -> str:
    return "/".join(p for p in parts if p)


def raw_path(table: str, partition: str | None = None, file_name: str | None = None) -> str:
    return _join(RAW, table, partition and f"{PARTITION}={partition}", file_name)


def staging_path(table: str, partition: str | None = None) -> str:
    return _join(STAGING, table, partition and f"{PARTITION}={partition}")


def final_path(table: str) -> str:
    return _join(FINAL, table)


def summary_path(name: str) -> str:
    return _join("summaries", name)


def pending_path(path: str) -> str:
    """Where a table is built before it is tested and published."""
    return _join("pending", path)


def under(base: str, path: str) -> str:
    return f"{base.rstrip('/')}/{path}"


_DAY = re.compile(r"\d{4}-\d{2}-\d{2}")


def parse_months(requested: str | date | Iterable[str | date] | None) -> list[str]:
    """A list, a comma-separated text or one date; nothing given means the whole table."""
    if requested is None:
        return []
    if isinstance(requested, str):
        requested = requested.split(",")
    elif isinstance(requested, date):
        requested = [requested]
    texts = [str(item).strip() for item in requested]
    months = [text for text in texts if text]
    for month in months:
        if not _DAY.fullmatch(month):
            raise ValueError(f"months must be YYYY-MM-DD dates, got: {month}")
    return months
