"""One batch run over the layers, under a lock, with its status and timings."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from typing import Any, TypeVar

from tidemark.plans import bronze, gold, silver, validate
from tidemark.plans.bronze import Log
from tidemark.plans.layers import Lake, progress
from tidemark.sources.control import RunStatus, table_lock

R = TypeVar("R")
MODES = ("all", "bronze", "silver", "gold")


def unchanged(lake: Lake, extracted: dict[str, bronze.Extracted]) -> bool:
    """Whether no table had events and the release stands on the current states."""
    if any(e.mode != "no_change" for e in extracted.values()):
        return False
    if any(not lake.silver(t).exists() for t in extracted):
        return False
    if any(progress(lake.silver(t), silver.DONE) != e.version for t, e in extracted.items()):
        return False
    release = lake.releases().latest()
    return release is not None and release["silver_versions"] == silver.versions(lake)


def run(lake: Lake, log: Log | None, mode: str = "all", full: bool = False, check: bool = False, batch_id: str | None = None) -> dict[str, Any]:
    """Extract, bring current states and star schema up to date, publish. Gold is built only where batch runs own it."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")
    owns = lake.settings.gold_owner == "batch"
    if mode == "gold" and not owns:
        raise ValueError("streaming owns gold")
    if log is None and mode in ("all", "bronze"):
        raise ValueError("extraction needs a log")
    name = batch_id or uuid.uuid4().hex
    status, timings = RunStatus(lake.settings.runs, name), {}
    status.set("RUNNING", mode=mode, full=full)

    def timed(step: str, work: Callable[[], R]) -> R:
        began = time.perf_counter()
        try:
            return work()
        finally:
            timings[step] = round((time.perf_counter() - began) * 1000)

    out: dict[str, Any] = {"batch_id": name}
    try:
        with table_lock(lake.lock(), name, lake.settings.lock_ttl_seconds, lake.settings.lock_wait_seconds):
            if mode in ("all", "bronze"):
                extracted = timed("bronze", lambda: bronze.extract(lake, log, name))  # type: ignore[arg-type]
                out["bronze"] = {t: {"mode": e.mode, "rows": e.rows, "cursor": e.cursor} for t, e in extracted.items()}
                if mode == "all" and not full and unchanged(lake, extracted):
                    out["no_change"] = True
            if mode in ("all", "silver") and "no_change" not in out:
                out["silver"] = {t: b.mode for t, b in timed("silver", lambda: silver.build(lake, full)).items()}
            if mode in ("all", "gold") and owns and "no_change" not in out:
                out["gold"] = timed("gold", lambda: gold.build(lake, name, full))
            if check:
                out["validation"] = timed("validation", lambda: validate.report(lake))
    except BaseException as e:
        status.set("FAILED", error=f"{type(e).__name__}: {e}", timings_ms=timings)
        raise
    status.set("SUCCEEDED", timings_ms=timings, result=out)
    return out
