"""Settings: read from text, with defaults and checks across fields."""

from __future__ import annotations

import math
import socket
from dataclasses import dataclass, fields
from datetime import UTC, datetime

#: Texts that mean yes; any other text means no.
YES = ("true", "1", "yes")


def boolean(text: str | bool) -> bool:
    return text if isinstance(text, bool) else text.strip().lower() in YES


def bound_ms(value: str | int | None) -> int | None:
    """An upper bound given as epoch milliseconds or as an ISO time; empty is none."""
    if value is None or value == "":
        return None
    if isinstance(value, str) and not value.isdigit():
        at = datetime.fromisoformat(value)
        value = (at if at.tzinfo else at.replace(tzinfo=UTC)).timestamp() * 1000
    if int(value) <= 0:
        raise ValueError(f"a bound must be an ISO time or epoch ms, not {value}")
    return int(value)


def epoch_ms_error(value: object, name: str, now: int) -> str | None:
    """What is wrong with a time given by hand, if anything."""
    if isinstance(value, bool) or not isinstance(value, int | float) or not math.isfinite(value):
        return f"{name} must be given in epoch ms"
    if value < 1_000_000_000_000:
        return f"{name}={value} looks like seconds; multiply by 1000"
    return f"{name} is in the future" if value > now + 60_000 else None


def sample_budget(samples: int, budget: int, collections: int) -> int:
    """Documents to sample from each of many collections: a share of the budget, ten at least, `samples` at most."""
    return min(samples, max(10, -(-budget // max(1, collections))))


@dataclass(frozen=True)
class Config:
    run_id: str = "ledger-v1"
    chunk_docs_target: int = 2_000_000
    max_chunk_days: int = 7
    inserts_in_flight: int = 3
    lease_s: int = 600
    breaker_pct: float = 5
    breaker_consecutive: int = 3
    letters_pause_threshold: int = 1_000_000
    source_count_check: bool = True
    monitor_interval_ms: int = 900_000
    upper_bound_ms: int | None = None
    start_paused: bool = False
    unbounded_ok: bool = False
    dry_run: bool = False
    dry_run_sample_pct: float = 2
    collection_prefix: str = "docs"
    page_size: int = 10_000
    max_retries: int = 8
    retry_base_ms: int = 1_000
    retry_max_ms: int = 30_000
    backpressure: bool = True
    parts_in_partition: int = 300
    parts_in_total: int = 500
    pause_at: float = 0.70
    resume_at: float = 0.55
    poll_ms: int = 5_000
    longest_pause_ms: int = 180_000
    pod_id: str = ""


def load(env: dict[str, str]) -> Config:
    """Settings from texts named as the fields, in capitals; what is missing has its default, the pod is the host."""
    given = {}
    for f in fields(Config):
        text = env.get(f.name.upper())
        if text is None:
            continue
        given[f.name] = bound_ms(text) if f.name == "upper_bound_ms" else boolean(text) if f.type == "bool" else int(text) if f.type == "int" else float(text) if f.type == "float" else text
    config = Config(**{"pod_id": socket.gethostname(), **{k: x for k, x in given.items() if k != "pod_id" or x}})
    positive = ("chunk_docs_target", "max_chunk_days", "inserts_in_flight", "lease_s", "breaker_consecutive", "page_size", "retry_base_ms", "retry_max_ms")
    wrong = [f"{n} must be positive" for n in positive if getattr(config, n) <= 0]
    wrong += ["retry_base_ms is above retry_max_ms"] * (config.retry_base_ms > config.retry_max_ms)
    wrong += ["resume_at must be below pause_at"] * (config.backpressure and config.resume_at >= config.pause_at)
    wrong += ["breaker_pct must lie within 0 and 100"] * (not 0 <= config.breaker_pct <= 100)
    wrong += ["dry_run_sample_pct must lie within 0.1 and 5"] * (not 0.1 <= config.dry_run_sample_pct <= 5)
    if wrong:
        raise ValueError("; ".join(wrong))
    return config
