"""Progress of index builds, read from a server's list of operations."""

from __future__ import annotations

import re
from dataclasses import dataclass

#: Phases of a build by the server's words.
PHASES = (
    (r"scanning collection", 1, "scanning documents"),
    (r"external sorter|inserting keys", 3, "writing index keys"),
    (r"draining writes", 4, "applying writes made during the build"),
)
SORTING = (2, "sorting index keys (scan complete)")


@dataclass(frozen=True)
class Build:
    collection: str
    phase: int | None
    label: str
    done: int | None
    total: int | None
    pct: int | None
    shard: str | None
    shards: int = 0


def _wanted(op: dict, database: str) -> bool:
    command = op.get("command") or {}
    own = command.get("$db") or str(op.get("ns") or "").partition(".")[0]
    keyed = [list((spec.get("key") or {})) for spec in command.get("indexes") or []]
    return isinstance(command.get("createIndexes"), str) and own == database and ["cd", "_id"] in keyed


def _read(op: dict) -> tuple[tuple, Build]:
    """What orders an operation among those of its collection (a builder before a waiter, the least advanced first), and its progress."""
    said, counters = str(op.get("msg") or ""), op.get("progress")
    number, label = next(((n, t) for pattern, n, t in PHASES if re.search(pattern, said, re.I)), (None, ""))
    if number == 1 and counters is None:
        number, label = SORTING
    if number is None:
        bare = re.sub(r"^Index Build:\s*", "", said, flags=re.I)
        label = re.sub(r":\s*\d+/\d+\s+\d+%$", "", bare).strip() or "in progress"
    done, total = ((counters or {}).get(k) for k in ("done", "total"))
    total = total if total and total > 0 else None
    pct = None if done is None or total is None else min(100, int(done / total * 100 + 0.5))
    waits = counters is None and not re.match("Index Build", said, re.I)
    return (waits, number or 0, pct is None, pct or 0), Build(op["command"]["createIndexes"], number, label, done, total, pct, op.get("shard"))


def build_progress(ops: list[dict], database: str) -> list[Build]:
    """One entry for each collection whose {cd, _id} index is being built: the operation that the build waits for."""
    found: dict[str, list[tuple[tuple, Build]]] = {}
    for op in ops:
        if _wanted(op, database):
            rank, build = _read(op)
            found.setdefault(build.collection, []).append((rank, build))
    out = []
    for own in found.values():
        first = min(own, key=lambda x: x[0])[1]
        out.append(Build(**{**first.__dict__, "shards": len({b.shard for _, b in own if b.shard is not None})}))
    return out
