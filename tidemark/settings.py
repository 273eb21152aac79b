"""Layered settings: defaults, then files in turn, then `${NAME}` and `${NAME:-default}` from the environment."""

from __future__ import annotations

import os
import re
import tomllib
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

_VARIABLE = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_]*)(?::-([^}]*))?\}")


@dataclass(frozen=True)
class Source:
    host: str = "localhost"
    port: int = 5432
    database: str = ""
    schema: str = "customer_app"
    user: str = ""
    password: str = field(default="", repr=False)
    driver: str = "org.postgresql.Driver"
    fetch_size: int = 10_000
    query_timeout_seconds: int = 300
    most_partitions: int = 4
    events_per_partition: int = 100_000
    most_events: int = 500_000
    attempts: int = 3
    delay_seconds: float = 2

    @property
    def url(self) -> str:
        return f"jdbc:postgresql://{self.host}:{self.port}/{self.database}"


@dataclass(frozen=True)
class Streaming:
    enabled: bool = False
    servers: str = ""
    topics: str = ""
    pattern: str = ""
    starting: str = "earliest"
    fail_on_loss: bool = True
    most_offsets: int = 100_000
    most_files: int = 8
    most_bytes: int = 0
    every: str = "15 seconds"
    checkpoints: str = ""
    checkpoint_version: str = "v1"
    pending_orders: int = 5000
    retry_seconds: float = 0
    retry_interval_seconds: float = 2


@dataclass(frozen=True)
class Settings:
    environment: str = "local"
    lake: str = ""
    system: str = "shop"
    timezone: str = "UTC"
    runs: str = "runs"
    gold_owner: str = "batch"
    parallel_tables: int = 4
    #: Folders that a merged table is split into by its key's hash; 0 for one. A merge rewrites the folders it touches.
    buckets: int = 0
    lock_wait_seconds: float = 600
    lock_ttl_seconds: float = 21_600
    spark: Mapping[str, str] = field(default_factory=dict)
    source: Source = field(default_factory=Source)
    streaming: Streaming = field(default_factory=Streaming)


def overlaid(base: Mapping[str, Any], over: Mapping[str, Any]) -> dict[str, Any]:
    """Tables are merged key by key; everything else is replaced."""
    out = dict(base)
    for k, v in over.items():
        out[k] = overlaid(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
    return out


def expanded(value: Any, environment: Mapping[str, str]) -> Any:
    """Text with its variables replaced; a variable without value or default is an error."""
    if isinstance(value, Mapping):
        return {k: expanded(v, environment) for k, v in value.items()}
    if isinstance(value, list):
        return [expanded(v, environment) for v in value]
    if not isinstance(value, str):
        return value

    def replaced(m: re.Match[str]) -> str:
        found = environment.get(m[1]) or m[2]
        if found is None:
            raise ValueError(f"{m[1]} is not set")
        return found

    return _VARIABLE.sub(replaced, value)


def _built(kind: type, raw: Mapping[str, Any], where: str) -> Any:
    known = {f.name: f for f in fields(kind)}
    if unknown := sorted(set(raw) - set(known)):
        raise ValueError(f"unknown settings in {where}: {', '.join(unknown)}")
    nested = {"Source": Source, "Streaming": Streaming}
    plain = {"int": int, "float": float, "str": str}
    out = {}
    for name, value in raw.items():
        t = str(known[name].type)
        if t in nested:
            out[name] = _built(nested[t], value, f"{where}.{name}")
        elif t == "bool":
            if str(value).lower() not in ("true", "false"):
                raise ValueError(f"{where}.{name} must be true or false")
            out[name] = str(value).lower() == "true"
        else:
            out[name] = plain[t](value) if t in plain else value
    return kind(**out)


def load(files: Iterable[str], environment: Mapping[str, str] | None = None, **override: Any) -> Settings:
    """Settings of TOML files, later ones over earlier ones, `override` over all."""
    raw: dict[str, Any] = {}
    for f in files:
        raw = overlaid(raw, tomllib.loads(Path(f).read_text()))
    out = _built(Settings, expanded(overlaid(raw, override), os.environ if environment is None else environment), "settings")
    if not out.lake:
        raise ValueError("lake must name a folder")
    if out.gold_owner not in ("batch", "streaming"):
        raise ValueError("gold_owner must be batch or streaming")
    if out.streaming.enabled and bool(out.streaming.topics) == bool(out.streaming.pattern):
        raise ValueError("give streaming topics or pattern")
    numbers = {"parallel_tables": out.parallel_tables, **{n: getattr(out.source, n) for n in ("most_partitions", "events_per_partition", "most_events", "attempts")}}
    if bad := sorted(n for n, v in numbers.items() if v < 1):
        raise ValueError(f"must be positive: {', '.join(bad)}")
    return out
