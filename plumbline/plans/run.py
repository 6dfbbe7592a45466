"""A run: map, claim, copy, check, attach, sweep, top up. Driven by the ledger, so it resumes where it stopped.

The unit of work is a batch of claimed windows: its documents are normalised, staged and attached in a fixed number of
jobs, however many windows it has, and counted by window. A run starts with `batch` windows, and each batch without a failure makes the
next one larger, up to BATCH_DOCS documents: batches follow the logarithm of the ledger, not its length. Documents without a time of their own are swept when all windows
of their collection are done.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.identity import not_excluded, with_defaults
from plumbline.operators import grid, ledger
from plumbline.operators.normalize import insertable, normalize
from plumbline.plans.control import State
from plumbline.plans.load import promote
from plumbline.schema import ROW_COLUMNS, SENTINEL
from plumbline.sources.ledger_store import LedgerStore
from plumbline.sources.live_table import LiveTable
from plumbline.sources.shared import written

KEY = ["collection", "idx"]
#: Growth of a batch after one without failures, and the documents that it is meant to hold at most (a window holds some target_docs; never less
#: than `batch` windows). Neither decides what is copied.
GROWTH, BATCH_DOCS = 4, 4_000_000


@dataclass(frozen=True)
class Job:
    store: LedgerStore
    table: LiveTable
    run_id: str
    pod: str
    now: int
    target_docs: int = grid.TARGET_DOCS
    max_days: int = grid.MAX_DAYS
    batch: int = 256
    lease_ms: int = 600_000
    breaker: int = 3


def prepared(docs: DataFrame, identity: DataFrame, prefix: str) -> DataFrame:
    """Documents of the collections that are copied, normalised and checked, as a table: collection, row columns, skip_reason, problems, at.

    at is the document's own time, null if it has none. Collections of excluded events are left out.
    """
    named = with_defaults(docs, identity, prefix).filter(not_excluded(F.col("default_e")))
    checked = insertable(normalize(named))
    return written(checked.select("collection", "source_id", *ROW_COLUMNS, "ts_ms", "cd_ms", "skip_reason", F.size("problems").alias("problems"), F.when(~F.col("no_cd"), F.col("cd_ms")).alias("at"), "no_cd"))


def windows(docs: DataFrame, job: Job, bound: int | None) -> DataFrame:
    """Windows and sentinels of prepared documents."""
    bounds = grid.collection_bounds(docs.select("collection", F.coalesce("source_id", F.lit("")).alias("source_id"), F.col("at").alias("cd_ms")), bound)
    return grid.with_sentinels(grid.build_grid(bounds, job.target_docs, job.max_days), bounds)


def _inside(docs: DataFrame, claimed: DataFrame) -> DataFrame:
    """Prepared documents with the claimed window that holds them."""
    own = claimed.select(*KEY, "lower_cd", "upper_cd")
    placed = grid.place_points(docs.filter("at is not null"), own, "at").drop("lower_cd", "upper_cd")
    sweep = own.filter(grid.is_sentinel()).select(*KEY)
    return placed.unionByName(docs.filter("at is null").join(F.broadcast(sweep), "collection"))


def copy_batch(job: Job, docs: DataFrame, claimed: DataFrame, letters: list[DataFrame] | None = None, recount: DataFrame | None = None) -> DataFrame:
    """Copy the claimed windows; the events that the ledger then gets. recount: the source as it is after the copy, for the count guard."""
    inside = written(_inside(docs, claimed))
    good = inside.filter("skip_reason is null and problems = 0")
    name = f"{job.run_id}-{uuid.uuid4().hex}"
    job.table.stage(good, name)
    promote(job.table, name)
    bad = inside.filter("(skip_reason is not null and skip_reason <> 'already_marked_migrated') or problems > 0")
    if letters is not None:
        reason = F.when(F.col("skip_reason") == "transform_error", "transform_error").when(F.col("skip_reason").isNotNull(), "skipped").otherwise("insert_rejected")
        letters.append(bad.select(F.lit(job.run_id).alias("run_id"), *KEY, "source_id", reason.alias("reason"), F.coalesce(F.concat(F.lit("skip:"), "skip_reason"), F.lit("refused")).alias("error"), "cd_ms", "ts_ms"))
    counts = inside.groupBy(*KEY).agg(F.count("*").alias("docs_read"), F.count("skip_reason").alias("docs_skipped"), F.count_if(F.col("skip_reason").isNull() & (F.col("problems") == 0)).alias("rows_expected"))
    pair = ["collection", "_id", "cd_ms"]
    # What is live must be what was staged, row by row; rows that share a pair count as often as they were staged.
    there = job.table.read().join(good.select(*pair).distinct(), pair, "left_semi").groupBy(*pair).agg(F.count("*").alias("live"))
    short = good.groupBy(*KEY, "_id", "cd_ms").agg(F.count("*").alias("staged")).join(there, pair, "left").filter("coalesce(live, 0) < staged").groupBy(*KEY).agg(F.count("*").alias("short"))
    each = claimed.select(*KEY, "pod_id", "attempts", "lower_cd", "upper_cd").join(counts, KEY, "left").join(short, KEY, "left").fillna(0, ["docs_read", "docs_skipped", "rows_expected", "short"])
    if recount is not None:
        now = _inside(recount, claimed).groupBy(*KEY).agg(F.count("*").alias("source"))
        each = ledger.source_count_guard(each.join(now, KEY, "left").withColumn("source", F.coalesce("source", F.lit(0))).withColumn("status", F.lit("done")))
    else:
        each = each.withColumn("guard", F.lit("equal"))
    failed = (F.col("short") > 0) | (F.col("guard") == "failed")
    error = F.when(F.col("short") > 0, "rows are missing after the attach").when(F.col("guard") == "failed", "the source holds more than was read")
    return each.select(*KEY, F.when(failed, "failed").otherwise("done").alias("to_status"), "pod_id", "attempts", F.lit(None).cast("long").alias("lease_until"), "docs_read", "docs_skipped", "rows_expected", error.alias("last_error"))


def recover(job: Job) -> int:
    """Claims whose lease is over are pending again; what they staged is no folder of a manifest and goes."""
    lost = ledger.recovery_actions(job.store.read().filter(F.col("run_id") == job.run_id).withColumn("staged", F.lit(None).cast("long")), job.now)
    rows = lost.select(*KEY).collect()
    if rows:
        held = job.store.read().filter(F.col("run_id") == job.run_id).join(job.store.spark.createDataFrame(rows, "collection string, idx int"), KEY, "left_semi")
        job.store.transition(job.run_id, held.select(*KEY, F.lit("pending").alias("to_status"), "pod_id", "attempts", F.lit(None).cast("long").alias("lease_until")), job.now)
    for name in job.table.orphans([]):
        job.table.drop_staging(name)
    return len(rows)


def run(job: Job, docs: DataFrame, bound: int | None = None, state: State | None = None, letters: list[DataFrame] | None = None, most_batches: int = 10_000) -> DataFrame:
    """Copy prepared documents: map them if the run is new, add windows for what came later, work off what is pending, sweep. Returns the
    run's chunks. Called again, it goes on from the ledger; most_batches stops it early."""
    state = state or State()
    stored = job.store.bound()
    bound = bound if stored is None else stored
    if bound is not None and stored is None:
        job.store.set_bound_if(None, bound)
    recover(job)
    mapped = windows(docs, job, bound)
    if not job.store.init(job.run_id, mapped, job.now) and bound is None:
        own = job.store.read().filter(F.col("run_id") == job.run_id)
        bounds = grid.collection_bounds(docs.select("collection", F.coalesce("source_id", F.lit("")).alias("source_id"), F.col("at").alias("cd_ms")))
        fresh = grid.top_up(own, bounds, job.target_docs, job.max_days)
        # A collection whose first document without a time came after it was mapped gets its sentinel now.
        late = bounds.filter("null_cds > 0").join(own.filter(grid.is_sentinel()).select("collection"), "collection", "left_anti")
        high = own.unionByName(fresh, allowMissingColumns=True).groupBy("collection").agg(F.max("idx").alias("last"))
        extra = late.join(high, "collection", "left").select("collection", (F.coalesce("last", F.lit(-1)) + 1).alias("idx"), F.lit(SENTINEL[0]).cast("long").alias("lower_cd"), F.lit(SENTINEL[1]).cast("long").alias("upper_cd"))
        new = written(fresh.unionByName(extra))
        if not new.isEmpty():
            job.store.append(job.run_id, new, job.now)
    failures, size = 0, job.batch
    for sweep in (False, True):
        while most_batches and state.paused is None and not state.stopping:
            claimed = written(job.store.claim(job.run_id, job.pod, job.now, job.lease_ms, size, sweep))
            if claimed.isEmpty():
                break
            most_batches -= 1
            events = written(copy_batch(job, docs, claimed, letters))
            job.store.transition(job.run_id, events, job.now)
            failures = failures + 1 if not events.filter("to_status = 'failed'").isEmpty() else 0
            size = job.batch if failures else max(job.batch, min(size * GROWTH, BATCH_DOCS // job.target_docs))
            if failures >= job.breaker:
                state.pause("breaker-data")
    return job.store.read().filter(F.col("run_id") == job.run_id)


def invariants(job: Job, most: int = 5) -> DataFrame:
    """Done windows, `most` of them by chance, whose live rows aren't as many as the ledger says: (collection, idx, rows_expected, live)."""
    done = job.store.read().filter((F.col("run_id") == job.run_id) & (F.col("status") == "done") & ~grid.is_sentinel())
    picked = done.orderBy(F.xxhash64("collection", "idx", F.lit(job.now))).limit(most)
    live = grid.place_points(job.table.read().select("collection", "cd_ms"), picked.select(*KEY, "lower_cd", "upper_cd")).groupBy(*KEY).agg(F.count("*").alias("live"))
    each = picked.select(*KEY, "rows_expected").join(live, KEY, "left").fillna(0, ["live"])
    return each.filter("live <> rows_expected")


def canary(table: LiveTable, rows: DataFrame) -> bool:
    """Whether rows that are staged and attached twice are live once: a self-test on a table of its own."""
    for _ in range(2):
        name = f"canary-{uuid.uuid4().hex}"
        table.stage(rows, name)
        promote(table, name)
    return table.read().count() == rows.count()
