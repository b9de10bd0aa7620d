"""Scans of document tables: what is still to do, pages, ranges, one row; and retries around a sink."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def find(docs: DataFrame, condition: Column | None = None, columns: list[str] | None = None, order: list[Column] | None = None, skip: int = 0, limit: int | None = None) -> DataFrame:
    """The rows of docs that condition holds for, sorted, from skip on, limit of them at most; a stated limit is the feature."""
    out = docs if condition is None else docs.where(condition)
    out = out.orderBy(*order) if order else out
    out = out.offset(skip) if skip else out
    out = out.limit(limit) if limit is not None else out
    return out.select(*columns) if columns else out


def find_one(docs: DataFrame, condition: Column, order: list[Column]) -> DataFrame:
    return find(docs, condition, order=order, limit=1)


def pending(docs: DataFrame, condition: Column, done: DataFrame, key: str, again: bool = False) -> DataFrame:
    """Documents to process: those that condition holds for and that done has not, unless they are to be done again."""
    base = docs.where(condition)
    return base if again else base.join(done.select(key).distinct(), key, "left_anti")


def page_before(docs: DataFrame, key: str, last: int | None, size: int) -> DataFrame:
    """The next page of falling keys, below the last key seen; size rows at most."""
    return find(docs, None if last is None else F.col(key) < last, order=[F.col(key).desc()], limit=size)


def id_range(docs: DataFrame, key: str, low: int, high: int, columns: list[str]) -> DataFrame:
    return docs.where(F.col(key).between(low, high)).select(key, *columns).orderBy(key)


def with_retry(write: Callable[[], None], tries: int = 3, delay: float = 1.0, factor: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> int:
    """Calls write until it succeeds, at most tries times, and gives the number of calls; waits delay, then factor times as long before each
    further one. The last error is raised. write must be idempotent."""
    for k in range(1, tries + 1):
        try:
            write()
            return k
        except Exception:
            if k == tries:
                raise
            sleep(delay * factor ** (k - 1))
    raise ValueError("tries must be at least 1")
