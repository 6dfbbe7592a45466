"""The ledger of chunks: transitions, recovery, summaries, progress. A small table; each function is one job over it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.grid import SPLIT_ATTEMPTS, SPLIT_SPAN_MS, is_sentinel
from plumbline.schema import TERMINAL

ACTIVE = ("in_progress", "written", "attaching")
OPEN = ("pending", *ACTIVE)
RECENT_DONE_MS = 120_000
FAIL_RATE_LEAST = 1000


def summary(chunks: DataFrame) -> DataFrame:
    """One row for each collection and one for the whole (collection null): chunks, done, docs_done, docs_read, open_rows, docs_skipped."""
    done = F.col("status") == "done"
    rolled = chunks.rollup("collection").agg(
        F.count("*").alias("chunks"),
        F.count_if(done).alias("done"),
        F.coalesce(F.sum(F.when(done, F.col("rows_expected"))), F.lit(0)).alias("docs_done"),
        F.coalesce(F.sum(F.when(done, F.col("docs_read"))), F.lit(0)).alias("docs_read"),
        F.coalesce(F.sum(F.when(F.col("status").isin(*OPEN, "failed"), F.col("rows_expected"))), F.lit(0)).alias("open_rows"),
        F.coalesce(F.sum("docs_skipped"), F.lit(0)).alias("docs_skipped"),
    )
    return rolled


def status_counts(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("status").agg(F.count("*").alias("n"))


def fingerprint(chunks: DataFrame) -> DataFrame:
    """One string that changes with every transition."""
    return chunks.agg(F.concat_ws(":", F.count("*").cast("string"), F.count_if(F.col("status") == "done").cast("string"), F.coalesce(F.max("updated_at"), F.lit(0)).cast("string")).alias("fingerprint"))


def pod_activity(chunks: DataFrame) -> DataFrame:
    active = F.col("status").isin(*ACTIVE)
    return chunks.filter("pod_id is not null").groupBy("pod_id").agg(F.count_if(F.col("status") == "done").alias("done"), F.count_if(active).alias("active"), F.max("updated_at").alias("last_seen"))


def active_claims(chunks: DataFrame, now: int, except_pod: str | None = None) -> DataFrame:
    """Claims under a running lease, by pod."""
    held = chunks.filter(F.col("status").isin(*ACTIVE) & (F.col("lease_until") > now))
    return (held.filter(F.col("pod_id") != except_pod) if except_pod else held).groupBy("pod_id").agg(F.count("*").alias("n"))


def cluster_rate(chunks: DataFrame, now: int, window_s: int) -> DataFrame:
    """Documents a second of chunks done in the last window_s seconds, and how many pods did them."""
    recent = chunks.filter((F.col("status") == "done") & (F.col("updated_at") >= now - 1000 * window_s))
    return recent.agg((F.coalesce(F.sum("docs_read"), F.lit(0)) / window_s).alias("docs_per_s"), F.count_distinct("pod_id").alias("pods"))


def high_water(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("collection").agg(F.max("idx").alias("max_idx"), F.coalesce(F.max(F.when(~is_sentinel(), F.col("upper_cd"))), F.lit(0)).alias("max_upper_cd"))


def listing(chunks: DataFrame, now: int) -> DataFrame:
    """Chunks worth watching: open, failed, or done within two minutes."""
    return chunks.filter(F.col("status").isin(*OPEN, "failed") | ((F.col("status") == "done") & (F.col("updated_at") >= now - RECENT_DONE_MS)))


def fail_rate(chunks: DataFrame, dead: DataFrame) -> DataFrame:
    """Refused and broken documents per document read, for chunks that read more than a thousand."""
    bad = dead.filter("reason in ('insert_rejected', 'transform_error')").groupBy("collection", F.col("chunk_idx").alias("idx")).agg(F.count("*").alias("bad"))
    return chunks.filter(F.col("docs_read") > FAIL_RATE_LEAST).join(bad, ["collection", "idx"], "left").select("collection", "idx", "docs_read", F.coalesce("bad", F.lit(0)).alias("bad"), (F.coalesce("bad", F.lit(0)) / F.col("docs_read")).alias("rate"))


def recovery_actions(chunks: DataFrame, now: int) -> DataFrame:
    """What to do with claims whose lease is over; chunks has staged (rows in its staging table, null if none)."""
    lost = chunks.filter(F.col("status").isin(*ACTIVE) & (F.coalesce("lease_until", F.lit(0)) <= now))
    action = F.when(F.col("status") == "attaching", "finish promotion").when((F.col("status") == "written") & F.col("staged").eqNullSafe(F.col("rows_expected")), "promote").otherwise("drop staging and redo")
    return lost.select("collection", "idx", "status", action.alias("action"))


def after_failure(chunks: DataFrame) -> DataFrame:
    """Failed attempts: redo, split (too many attempts and wide enough), or quarantine."""
    wide = ~is_sentinel() & (F.col("upper_cd") - F.col("lower_cd") > SPLIT_SPAN_MS)
    return chunks.withColumn("next", F.when(F.col("attempts") <= SPLIT_ATTEMPTS, "redo").when(wide, "split").otherwise("quarantine"))


def fence_claims(claimed: DataFrame, bound: int | None, apply_running: bool = False) -> DataFrame:
    """Claims after a bound was set: superseded at or after it, clamped across it; released while one is being applied."""
    if apply_running:
        return claimed.withColumn("fenced", F.lit("release")).withColumn("new_upper_cd", F.col("upper_cd"))
    if bound is None:
        return claimed.withColumn("fenced", F.lit("keep")).withColumn("new_upper_cd", F.col("upper_cd"))
    fenced = F.when(is_sentinel(), "keep").when(F.col("lower_cd") >= bound, "superseded").when(F.col("upper_cd") > bound, "clamp").otherwise("keep")
    return claimed.withColumn("fenced", fenced).withColumn("new_upper_cd", F.when(fenced == "clamp", F.lit(bound).cast("long")).otherwise(F.col("upper_cd")))


def source_count_guard(chunks: DataFrame) -> DataFrame:
    """chunks with source (a recount): failed where more was there than read; a source that shrank stays done."""
    guard = F.when(F.col("source") > F.col("docs_read"), "failed").when(F.col("source") < F.col("docs_read"), "shrank").otherwise("equal")
    return chunks.withColumn("guard", guard).withColumn("status", F.when(guard == "failed", "failed").otherwise(F.col("status")))


#: Status changes that exist: (from, to).
TRANSITIONS = (("pending", "in_progress"), ("in_progress", "written"), ("written", "attaching"), ("attaching", "done"), ("in_progress", "done"), ("in_progress", "pending"), ("written", "pending"), ("in_progress", "failed"), ("written", "failed"), ("attaching", "failed"), ("failed", "pending"), ("done", "failed"), ("done", "pending"), ("pending", "superseded"), ("in_progress", "superseded"), ("superseded", "pending"))


def apply_events(chunks: DataFrame, events: DataFrame, now: int) -> DataFrame:
    """chunks after events (collection, idx, to_status, pod_id, attempts, lease_until), at most one for each chunk.

    An event counts if its transition exists and its fence holds: the chunk is unclaimed, or claimed by the
    same pod at the same attempt, or its lease is over. A claim raises attempts.
    """
    c, e = chunks.alias("c"), events.select("collection", "idx", "to_status", F.col("pod_id").alias("e_pod"), F.col("attempts").alias("e_attempts"), F.col("lease_until").alias("e_lease")).alias("e")
    allowed = F.concat_ws(">", "status", "to_status").isin(*[f"{a}>{b}" for a, b in TRANSITIONS])
    own = F.col("pod_id").eqNullSafe(F.col("e_pod")) & F.col("c.attempts").eqNullSafe(F.col("e_attempts"))
    free = F.col("pod_id").isNull() | (F.coalesce("c.lease_until", F.lit(0)) <= now)
    taken = F.coalesce(allowed & (own | free), F.lit(False))
    claim = taken & (F.col("to_status") == "in_progress")
    ended = taken & F.col("to_status").isin("pending", *TERMINAL)
    joined = c.join(e, ["collection", "idx"], "left")
    changes = {
        "status": F.when(taken, F.col("to_status")).otherwise(F.col("status")),
        "pod_id": F.when(ended, F.lit(None)).when(taken, F.col("e_pod")).otherwise(F.col("pod_id")),
        "lease_until": F.when(ended, F.lit(None)).when(taken, F.col("e_lease")).otherwise(F.col("c.lease_until")),
        "attempts": F.when(claim, F.col("c.attempts") + 1).otherwise(F.col("c.attempts")),
        "updated_at": F.when(taken, F.lit(now)).otherwise(F.col("updated_at")),
    }
    return joined.select(*[changes[x].alias(x) if x in changes else F.col(x) for x in chunks.columns], taken.alias("applied"))


def eta(chunks: DataFrame, rate_per_s: float) -> DataFrame:
    """Per collection: chunks left, documents that they will hold (its mean, else the run's), and seconds at the rate."""
    done = F.col("status") == "done"
    by = chunks.filter(~is_sentinel()).groupBy("collection").agg(F.count_if(~F.col("status").isin(*TERMINAL)).alias("chunks_left"), F.avg(F.when(done, F.col("docs_read"))).alias("mean"), F.sum(F.when(done, F.col("docs_read"))).alias("read"), F.count_if(done).alias("n"))
    every = Window.partitionBy(F.lit(1))
    overall = F.sum("read").over(every) / F.sum("n").over(every)
    left = F.round(F.col("chunks_left") * F.coalesce("mean", overall, F.lit(0.0))).cast("long")
    return by.withColumn("docs_left", left).select("collection", "chunks_left", "docs_left", F.ceil(F.col("docs_left") / F.lit(float(rate_per_s))).alias("seconds"))


def progress_pct(read: Column, estimate: Column, completed: Column) -> Column:
    """One decimal, below 100 until the run is completed."""
    return F.when(completed, 100.0).when(estimate <= 0, 0.0).otherwise(F.least(F.lit(99.9), F.floor(read / estimate * 1000 + 0.5) / 10))


def rate_changes(samples: DataFrame, window_ms: int = 600_000, least: int = 3, least_ms: int = 10_000) -> DataFrame:
    """samples (at, docs_done): at and docs_per_s over the last window_ms, null before `least` changes over `least_ms`."""
    order = Window.orderBy("at")
    changed = samples.withColumn("step", (F.col("docs_done") > F.lag("docs_done").over(order)).cast("int"))
    near = order.rangeBetween(-window_ms, 0)
    span, first = F.col("at") - F.min("at").over(near), F.min("docs_done").over(near)
    return changed.withColumn("docs_per_s", F.when((F.coalesce(F.sum("step").over(near), F.lit(0)) >= least) & (span >= least_ms), (F.col("docs_done") - first) / span * 1000)).select("at", "docs_per_s")


def breaker(outcomes: DataFrame, limit: int = 3, parts: int = 64) -> DataFrame:
    """outcomes (seq, ok, error_class): the streak of equal failures at each, and what trips at the limit.

    Two levels: streaks within ranges of seq (bounds by approximate quantiles), then one row for each of at most `parts`
    ranges tells how long the run is that reaches into the next one.
    """
    kind = F.when(F.col("ok"), F.lit("ok")).otherwise(F.col("error_class"))
    marks = [k / parts for k in range(1, parts)] or [0.5]
    bounds = sorted(set(outcomes.select(F.percentile_approx("seq", marks, 1000)).first()[0] or [])) if parts > 1 else []
    part = F.size(F.filter(F.lit(bounds), lambda x: x < F.col("seq"))) if bounds else F.lit(0)
    order = Window.partitionBy("part").orderBy("seq")
    runs = outcomes.withColumn("kind", kind).withColumn("part", part).withColumn("new", F.coalesce((~F.lag("kind").over(order).eqNullSafe(F.col("kind"))) & (F.row_number().over(order) > 1), F.lit(False)).cast("int"))
    runs = runs.withColumn("run", F.sum("new").over(order)).withColumn("streak", F.row_number().over(Window.partitionBy("part", "run").orderBy("seq")))
    last = F.max_by(F.struct("kind", "streak", "run"), F.struct("run", "streak"))
    ends = runs.groupBy("part").agg(last.alias("last"), F.max_by(F.struct("kind"), -F.col("run")).alias("first"))
    by_part = Window.orderBy("part")
    joins = (F.col("last.run") == 0) & F.col("first.kind").eqNullSafe(F.lag("last.kind").over(by_part)) & (F.row_number().over(by_part) > 1)
    ends = ends.withColumn("chain", F.sum(F.when(joins, 0).otherwise(1)).over(by_part)).withColumn("reach", F.sum("last.streak").over(Window.partitionBy("chain").orderBy("part")))
    ends = ends.select("part", F.lag("last.kind").over(by_part).alias("kind_in"), F.coalesce(F.lag("reach").over(by_part), F.lit(0)).alias("reach_in"))
    carried = F.when((F.col("run") == 0) & F.col("kind").eqNullSafe(F.col("kind_in")), F.col("reach_in")).otherwise(0)
    runs = runs.join(F.broadcast(ends), "part").withColumn("streak", (F.col("streak") + carried).cast("int"))
    trips = ~F.col("ok") & (F.col("streak") >= limit)
    return runs.select("seq", "ok", "error_class", F.when(F.col("ok"), 0).otherwise(F.col("streak")).alias("streak"), F.when(trips, F.when(F.col("error_class") == "permanent", "breaker-data").otherwise("breaker-transient")).alias("pause"))
