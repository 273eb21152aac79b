"""Run status and locks, as files that are replaced or created whole."""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, datetime
from pathlib import Path
from typing import Any

from tidemark.sources.store import Table


class RunStatus:
    """One JSON file a run: RUNNING, then SUCCEEDED or FAILED; started_at stays."""

    def __init__(self, folder: str, run_id: str):
        self.path = Path(folder) / f"{run_id}.json"

    def set(self, status: str, **more: Any) -> None:
        if status not in ("RUNNING", "SUCCEEDED", "FAILED"):
            raise ValueError(status)
        now = datetime.now(UTC).isoformat()
        old = json.loads(self.path.read_text()) if self.path.exists() else {}
        new = old | more | {"status": status, "started_at": old.get("started_at", now), "updated_at": now}
        self.path.parent.mkdir(parents=True, exist_ok=True)
        own = self.path.with_suffix(f".{uuid.uuid4().hex}")
        own.write_text(json.dumps(new))
        os.replace(own, self.path)

    def get(self) -> dict[str, Any]:
        return json.loads(self.path.read_text())


@contextmanager
def local_lock(path: str, wait: float = 600, poll: float = 1.0) -> Iterator[None]:
    """A lock file on one machine."""
    until = time.monotonic() + wait
    while True:
        try:
            os.close(os.open(path, os.O_CREAT | os.O_EXCL | os.O_WRONLY))
            break
        except FileExistsError:
            if time.monotonic() >= until:
                raise TimeoutError(f"{path} is locked") from None
            time.sleep(poll)
    try:
        yield
    finally:
        os.unlink(path)


@contextmanager
def table_lock(table: Table, owner: str, ttl: float = 21_600, wait: float = 600, poll: float = 5.0, clock=time.time) -> Iterator[None]:  # noqa: ANN001
    """A lease file beside a table's log: free, or taken over once it has run out. It is created exclusively, and makes no commits."""
    until, files, name = time.monotonic() + wait, table.files, "lease.json"
    mine = {"owner": owner, "id": uuid.uuid4().hex, "until": clock() + ttl}

    def lease(at: str = name) -> dict[str, Any]:
        try:
            return json.loads(files.read(at))
        except Exception:
            if files.exists(at):
                raise
            return {}

    while True:
        held = lease()
        if held and held["until"] < clock():
            old = f".lease-{uuid.uuid4().hex}"
            if files.move(name, old):
                if lease(old)["id"] != held["id"]:  # another took it over in between: it keeps it
                    files.move(old, name)
                else:
                    files.delete(old)
            continue
        if not held and files.create(json.dumps(mine), name):
            break
        if time.monotonic() >= until:
            raise TimeoutError(f"{table.path} is locked by {held.get('owner')}")
        time.sleep(poll)
    try:
        yield
    finally:
        if lease().get("id") == mine["id"]:
            files.delete(name)
