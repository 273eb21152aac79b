"""Releases: one pointer to a consistent version of every table."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.store import Conflict, Files, Table

SCHEMA_VERSION = 1


class Releases:
    """Numbered files in a folder, each written whole and never changed; the newest is the published release."""

    def __init__(self, spark: SparkSession, path: str, gold: tuple[str, ...]):
        self.spark, self.files, self.gold = spark, Files(spark, path), gold

    def checked(self, release: dict) -> dict:
        if release.get("schema_version") != SCHEMA_VERSION:
            raise ValueError("release of another schema version")
        for part in ("silver_versions", "gold_versions"):
            versions = release.get(part)
            if not isinstance(versions, dict) or any(isinstance(v, bool) or not isinstance(v, int) or v < 0 for v in versions.values()):
                raise ValueError(f"{part} must be versions by table")
        if set(release["gold_versions"]) != set(self.gold):
            raise ValueError("gold_versions must name exactly the published tables")
        return release

    def latest(self) -> dict | None:
        names = [n for n in self.files.names("releases") if n.endswith(".json") and n[0] != "."]
        return self.checked(json.loads(self.files.read("releases", names[-1]))) if names else None

    def publish(self, batch_id: str, silver: Mapping[str, int], gold: Mapping[str, int]) -> dict:
        release = self.checked({"schema_version": SCHEMA_VERSION, "batch_id": batch_id, "silver_versions": dict(silver), "gold_versions": dict(gold)})
        names = [x for x in self.files.names("releases") if x.endswith(".json") and x[0] != "."]
        n = int(names[-1].split(".")[0]) + 1 if names else 0
        if not self.files.create(json.dumps(release), "releases", f"{n:010d}.json"):
            raise Conflict("another release was published")
        return release

    def read(self, name: str, table: Table) -> DataFrame:
        """A table as the published release pins it."""
        release = self.latest()
        if not release or name not in release["gold_versions"]:
            raise ValueError(f"{name} is in no release")
        return table.read(release["gold_versions"][name])

    def advanced(self, silver: Mapping[str, int]) -> dict[str, tuple[int, int]]:
        """Tables whose version moved past the release: (from, to)."""
        known = (self.latest() or {"silver_versions": {}})["silver_versions"]
        if ahead := [t for t, v in known.items() if v > silver.get(t, -1)]:
            raise ValueError(f"release is ahead of {', '.join(sorted(ahead))}")
        return {t: (known.get(t, -1), v) for t, v in silver.items() if v > known.get(t, -1)}
