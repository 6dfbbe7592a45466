"""What an operator does to a run: bound, restore, retry, pause and resume, all through the ledger's compare-and-set."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.config import epoch_ms_error
from plumbline.operators import grid, ledger
from plumbline.sources.ledger_store import LedgerStore
from plumbline.sources.live_table import LiveTable


class RefusedError(RuntimeError):
    """The ledger doesn't allow what was asked."""


def apply_bound(store: LedgerStore, run_id: str, bound: int, now: int) -> dict[str, int]:
    """Nothing at or after the bound is copied any more: windows there go, those across it are clamped, running ones are fenced.

    The bound is stored before the windows are changed and taken back if that fails; the journal names the version before, which
    restore_bound commits again.
    """
    wrong = epoch_ms_error(bound, "bound", now)
    if wrong:
        raise RefusedError(wrong)
    if not store.mark_apply(now):
        raise RefusedError("another bound is being applied")
    try:
        base, before = store.version(), store.bound()
        own = store.read(base).filter(F.col("run_id") == run_id)
        pruned = grid.prune(own, bound)
        counts = {r.action: r["count"] for r in pruned.filter("status <> 'in_progress'").groupBy("action").count().collect()}
        if counts.get("refused"):
            raise RefusedError(f"{counts['refused']} windows at or across the bound are not pending")
        if not store.set_bound_if(before, bound):
            raise RefusedError("another bound was stored meanwhile")
        try:
            idle = pruned.filter("status <> 'in_progress' and action <> 'deleted'").withColumn("upper_cd", F.col("new_upper_cd")).drop("action", "new_upper_cd")
            held = ledger.fence_claims(own.filter("status = 'in_progress'"), bound)
            held = held.withColumn("status", F.when(F.col("fenced") == "superseded", "superseded").otherwise(F.col("status"))).withColumn("upper_cd", F.col("new_upper_cd")).withColumn("fence_gen", F.coalesce("fence_gen", F.lit(0)) + (F.col("fenced") != "keep").cast("int")).drop("fenced", "new_upper_cd")
            store.commit(base, idle.unionByName(held).unionByName(store.read(base).filter(F.col("run_id") != run_id)))
        except Exception:
            store.set_bound_if(bound, before)
            raise
        store.put("prune", {"run_id": run_id, "version": base, "before": before, "bound": bound})
        return counts
    finally:
        store.clear_apply()


def restore_bound(store: LedgerStore, run_id: str, now: int) -> bool:
    """Take the last bound back: windows that it deleted or clamped are as before; what was done since stays done."""
    _, journal = store.document("prune")
    if journal.get("run_id") != run_id or journal.get("bound") != store.bound():
        return False
    old = store.read(journal["version"]).filter(F.col("run_id") == run_id)

    def edit(chunks: DataFrame) -> DataFrame:
        keys = ["run_id", "collection", "idx"]
        cut = F.col("lower_cd").isNotNull() & ~grid.is_sentinel() & (F.col("upper_cd") > journal["bound"])
        gone = old.filter(cut).select(*keys, F.col("lower_cd").alias("_lo"), F.col("upper_cd").alias("_hi"))
        back = chunks.join(gone, keys, "left").withColumn("upper_cd", F.when(F.col("status").isin("pending", "superseded"), F.coalesce("_hi", "upper_cd")).otherwise(F.col("upper_cd"))).withColumn("status", F.when(F.col("status") == "superseded", "pending").otherwise(F.col("status")))
        missing = old.filter(cut).join(chunks.select(*keys), keys, "left_anti").withColumn("status", F.lit("pending")).withColumn("updated_at", F.lit(now).cast("long"))
        return back.drop("_lo", "_hi").unionByName(missing)

    store.change(edit)
    return store.set_bound_if(journal["bound"], journal["before"])


def retry_failed(store: LedgerStore, table: LiveTable, run_id: str, now: int) -> int:
    """Failed windows are emptied in the target and pending again, with the done sweep of their collections."""
    failed = store.read().filter((F.col("run_id") == run_id) & (F.col("status") == "failed"))
    by_name = failed.groupBy("collection").count().collect()
    if not by_name:
        return 0
    # A join with the windows: a predicate that names each of them can't be planned once they are thousands.
    windows = failed.select("collection", "idx", "lower_cd", "upper_cd")
    months = [r.month for r in grid.place_points(table.read().select("collection", "cd_ms", "month"), windows).select("month").distinct().collect()]
    if months:
        table.rewrite(lambda rows: grid.outside(rows, windows), months)
    names = sorted(r.collection for r in by_name)

    def edit(chunks: DataFrame) -> DataFrame:
        again = (F.col("run_id") == run_id) & ((F.col("status") == "failed") | (grid.is_sentinel() & (F.col("status") == "done") & F.col("collection").isin(names)))
        return chunks.select(*[F.when(again, new).otherwise(F.col(c)).alias(c) if (new := {"status": F.lit("pending"), "attempts": F.lit(0), "docs_read": F.lit(0).cast("long"), "docs_skipped": F.lit(0).cast("long"), "rows_expected": F.lit(0).cast("long"), "last_error": F.lit(None).cast("string"), "updated_at": F.lit(now).cast("long")}.get(c)) is not None else F.col(c) for c in chunks.columns])

    store.change(edit)
    return sum(r["count"] for r in by_name)


@dataclass
class State:
    """Running, paused or stopping. A pause by the transient breaker ends by itself after healthy probes; others wait for resume."""

    paused: str | None = None
    fatal: str | None = None
    stopping: bool = False
    boundary_open: bool = False
    healthy: int = 0
    log: list[str] = field(default_factory=list)

    def pause(self, reason: str) -> None:
        if self.paused is None:
            self.paused, self.healthy = reason, 0
            self.log.append(f"paused: {reason}")

    def resume(self) -> bool:
        """Refused after a fatal error, and while the boundary is undecided."""
        if self.fatal or self.boundary_open:
            return False
        self.paused = None
        self.log.append("resumed")
        return True

    def fail(self, reason: str) -> None:
        self.fatal = reason
        self.pause(f"fatal: {reason}")

    def probe(self, ok: bool, needed: int = 2) -> bool:
        """A health probe while paused; True if it ended the pause."""
        self.healthy = self.healthy + 1 if ok else 0
        return self.paused == "breaker-transient" and self.healthy >= needed and self.resume()


def rebuild_refused(running: bool, dry_run: bool, foreign_claims: int, chunks: int, force: bool) -> str | None:
    """Why a ledger may not be rebuilt now, if so."""
    reasons = [(running, "the run is going on"), (dry_run, "this is a dry run"), (foreign_claims, f"{foreign_claims} chunks are claimed by others"), (chunks and not force, "there is a ledger; force replaces it")]
    return next((text for hit, text in reasons if hit), None)
