"""Where one system's traffic ends and the other's begins, and whether they run in step after it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.pairs import per_bucket

MINUTE, HOUR = 60_000, 3_600_000
BAND_MINUTES, OLDEST_DAYS, SYNC_HOURS, SYNC_LEAST_MS = 30, 90, 72, 5 * MINUTE
FLANK_MS, FLANK_DOCS, ABUT_MS, AMBIGUOUS_MS = 10 * MINUTE, 25, 2 * MINUTE, 2 * MINUTE
DRIFT_LEAST, DRIFT_PCT = 100, 3


def dense_curves(old: DataFrame, new: DataFrame, low: int, high: int, step: int) -> DataFrame:
    """bucket_ms, old, new for every bucket from low's on to high; old and new: cd_ms."""
    spark = old.sparkSession
    calendar = spark.range(low - low % step, high, step).select(F.col("id").alias("bucket_ms"))
    curve = lambda df, name: per_bucket(df, step, low=low, high=high).withColumnRenamed("n", name)
    return calendar.join(curve(old, "old"), "bucket_ms", "left").join(curve(new, "new"), "bucket_ms", "left").fillna(0, ["old", "new"])


def first_gap(minutes: DataFrame) -> DataFrame:
    """from_ms and to_ms of the first run of silent minutes with old traffic before it and new traffic after it.

    The band is an hour of minutes, so its windows need no partitioning.
    """
    order = Window.orderBy("bucket_ms")
    past, ahead = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    silent = (F.col("old") == 0) & (F.col("new") == 0)
    inner = (F.row_number().over(order) > 1) & F.lead("bucket_ms").over(order).isNotNull()
    marked = minutes.withColumn("silent", silent).withColumn("opens", silent & inner & (F.coalesce(F.sum("old").over(past), F.lit(0)) > 0) & (F.coalesce(F.sum("new").over(ahead), F.lit(0)) > 0))
    # Minutes of one run share the count of lively minutes before them.
    runs = marked.withColumn("run", F.sum((~F.col("silent")).cast("int")).over(order)).filter("silent")
    each = runs.groupBy("run").agg(F.min(F.when(F.col("opens"), F.col("bucket_ms"))).alias("from_ms"), (F.max("bucket_ms") + MINUTE).alias("to_ms")).filter("from_ms is not null")
    return each.orderBy("from_ms").limit(1).select("from_ms", "to_ms")


def detect(old: DataFrame, new: DataFrame, now: int, chunks_mapped: int = 0, band_minutes: int = BAND_MINUTES) -> dict:
    """old, new: cd_ms of source and target. The verdict with status, method, bound, ambiguity and the band's minutes."""
    anchor = new.agg(F.min("cd_ms")).first()[0]
    if anchor is None:
        return {"status": "no_data", "reason": "the target is empty"}
    if chunks_mapped:
        return {"status": "refused", "reason": f"{chunks_mapped} windows are mapped already", "anchor": anchor}
    if anchor < now - OLDEST_DAYS * 24 * HOUR:
        return {"status": "refused", "reason": "the target's first row is too old to mark a start", "anchor": anchor}
    minutes = dense_curves(old, new, anchor - band_minutes * MINUTE, anchor + band_minutes * MINUTE, MINUTE)
    rows = [r.asDict() for r in minutes.orderBy("bucket_ms").collect()]  # two rows for each minute of the band
    gap = first_gap(minutes).first()
    if gap:
        return {"status": "ok", "method": "gap", "anchor": anchor, "gap": (gap.from_ms, gap.to_ms), "bound": gap.from_ms + (gap.to_ms - gap.from_ms) // 2, "ambiguous": 0, "minutes": rows}
    near = sum(r["old"] for r in rows if abs(r["bucket_ms"] - anchor) <= AMBIGUOUS_MS)
    return {"status": "ok", "method": "anchor", "anchor": anchor, "gap": None, "bound": anchor, "ambiguous": near, "minutes": rows}


@dataclass(frozen=True)
class Decision:
    apply: bool
    bound: int | None = None
    reason: str | None = None


def decide(report: dict | None, accept_anchor: bool = False) -> Decision:
    """Whether a detected boundary may be applied unattended."""
    if not report or report["status"] != "ok" or not report.get("bound"):
        return Decision(False, reason="no boundary was detected")
    if accept_anchor:
        return Decision(True, report["bound"])
    if report["method"] != "gap":
        return Decision(False, reason=f"an anchor only, with {report['ambiguous']} documents near it")
    start, end = report["gap"]
    total = lambda side, low, high: sum(m[side] for m in report["minutes"] if low <= m["bucket_ms"] < high)
    if total("old", start - FLANK_MS, start) < FLANK_DOCS or total("new", end, end + FLANK_MS) < FLANK_DOCS:
        return Decision(False, reason="too little traffic beside the gap")
    anchor = report["anchor"]
    if not start <= anchor <= end + ABUT_MS or total("old", end, anchor) > 0:
        return Decision(False, reason="the gap doesn't lead to the first row of the target")
    return Decision(True, report["bound"])


def parity(old: DataFrame, new: DataFrame, start: int, now: int, cap_hours: int = SYNC_HOURS) -> DataFrame | None:
    """Hours since start with both counts, drift_pct and flagged; None if there are too few minutes yet."""
    begin = max(start, now - cap_hours * HOUR)
    if now - begin <= SYNC_LEAST_MS:
        return None
    return flag_hours(dense_curves(old, new, begin, now, HOUR), now)


def flag_hours(curves: DataFrame, now: int) -> DataFrame:
    most = F.greatest("old", "new")
    drift = F.when(most == 0, 0.0).otherwise(F.floor(F.abs(F.col("old") - F.col("new")) / most * 1000 + 0.5) / 10)
    return curves.withColumn("drift_pct", drift).withColumn("flagged", (F.col("bucket_ms") + HOUR <= now) & (most >= DRIFT_LEAST) & (F.col("drift_pct") > DRIFT_PCT))
