"""Where the tables of each layer lie, and work on many of them side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

from tidemark.contracts import GOLD
from tidemark.settings import Settings
from tidemark.sources.release import Releases
from tidemark.sources.store import Table

R = TypeVar("R")


class Lake:
    """Raw events, current state and history, star schema, releases, all below one folder."""

    def __init__(self, spark: SparkSession, settings: Settings):
        self.spark, self.settings, self.root = spark, settings, settings.lake.rstrip("/")

    def bronze(self, table: str) -> Table:
        return Table(self.spark, f"{self.root}/bronze/{table}")

    def streamed(self, table: str) -> Table:
        return Table(self.spark, f"{self.root}/bronze_cdc/{table}")

    def silver(self, table: str) -> Table:
        return Table(self.spark, f"{self.root}/silver/{table}", self.settings.buckets)

    def history(self, table: str) -> Table:
        return Table(self.spark, f"{self.root}/history/{table}")

    def gold(self, table: str) -> Table:
        return Table(self.spark, f"{self.root}/gold/{table}", self.settings.buckets)

    def lock(self) -> Table:
        return Table(self.spark, f"{self.root}/control/writer")

    def releases(self) -> Releases:
        return Releases(self.spark, f"{self.root}/control", GOLD)

    def each(self, work: Callable[[str], R], tables: Iterable[str]) -> dict[str, R]:
        """work(table) of every table, `parallel_tables` at a time; the first error is raised."""
        names = list(tables)
        target = inheritable_thread_target(self.spark)(work)
        with ThreadPoolExecutor(self.settings.parallel_tables) as pool:
            return dict(zip(names, pool.map(target, names), strict=True))


def progress(table: Table, key: str) -> int | None:
    """A whole number from 0 that a commit left behind; None without one."""
    found = table.metadata(key) if table.exists() else None
    if found is not None and (isinstance(found, bool) or not isinstance(found, int) or found < 0):
        raise ValueError(f"{table.path}: {key} is damaged: {found!r}")
    return found
