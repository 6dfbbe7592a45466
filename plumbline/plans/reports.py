"""What people read: the run's figures, listings and plain-text status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators import dead_letters, grid, health, ledger

BAR = 36


def bar(share: float) -> str:
    full = min(BAR, max(0, int(share * BAR)))
    return "[" + "#" * full + "." * (BAR - full) + "]"


def heartbeat(chunks: DataFrame, estimate: int, now: int) -> dict:
    """The figures of one progress line: chunks, documents, percentage below 100 until all is done, rate of the last two minutes."""
    s = ledger.summary(chunks).filter("collection is null").first()
    rate = ledger.cluster_rate(chunks, now, 120).first()
    done = s.chunks > 0 and s.chunks == chunks.filter(F.col("status").isin("done", "superseded")).count()
    pct = 100.0 if done else 0.0 if estimate <= 0 else min(99.9, int((s.docs_read or 0) / estimate * 1000 + 0.5) / 10)
    return {"chunks": s.chunks, "done": s.done, "docs_read": s.docs_read, "docs_done": s.docs_done, "docs_skipped": s.docs_skipped, "pct": pct, "docs_per_s": rate.docs_per_s, "pods": rate.pods}


def report(chunks: DataFrame, dead: DataFrame, estimate: int, now: int) -> dict:
    """Everything about a run: heartbeat, states, pods, letters, what failed, what is going on."""
    rows = lambda df: [r.asDict() for r in df.collect()]  # noqa: E731  all of them are capped or one row a state, pod or error
    return {
        **heartbeat(chunks, estimate, now),
        "states": {r.status: r.n for r in ledger.status_counts(chunks).collect()},
        "pods": rows(ledger.pod_activity(chunks).orderBy(F.desc("done"), "pod_id")),
        "letters": {r.status: r.n for r in dead_letters.by_status(dead).collect()},
        "errors": rows(dead_letters.top_errors(dead, 10)),
        "failed": rows(health.failed(chunks).select("collection", "idx", "status")),
        "active": rows(health.active(chunks, now).select("collection", "idx", "status")),
    }


def status_text(beat: dict, state: str = "running") -> str:
    share = beat["pct"] / 100
    return "\n".join([f"{state}  {bar(share)} {beat['pct']:.1f} %", f"chunks {beat['done']} of {beat['chunks']}", f"documents {beat['docs_read']:,} read, {beat['docs_done']:,} copied, {beat['docs_skipped']:,} skipped", f"{beat['docs_per_s']:,.0f} documents a second"])


def tape_slice(chunks: DataFrame, rows: int = 12, width: int = 48) -> DataFrame:
    """The part of the tape around the frontier: whole rows of `width` places, the frontier's in the middle."""
    tape = grid.frontier(chunks)
    at = tape.agg(F.coalesce(F.min(F.when(F.col("is_frontier"), F.col("position"))), F.max("position"))).first()[0]
    first = 0 if at is None else max(0, at // width - rows // 2) * width
    return tape.filter((F.col("position") >= first) & (F.col("position") < first + rows * width)).select("position", "collection", "idx", "status", "is_frontier")
