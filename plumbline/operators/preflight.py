"""Checks before a run: each a name, pass, warn or fail, and why."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MINUTE = 60_000
DISK_FAIL, DISK_WARN = 0.10, 0.20


def source_facts(docs: DataFrame) -> DataFrame:
    """One row of docs (collection, at): documents, collections, newest time, documents without one."""
    return docs.agg(F.count("*").alias("docs"), F.count_distinct("collection").alias("collections"), F.max("at").alias("newest"), F.count_if(F.col("at").isNull()).alias("no_time"))


def checks(source: DataFrame, target: DataFrame, now: int, bound: int | None = None, frozen: bool | None = None, sorted_layout: bool = True, free_share: float | None = None, canary: bool | None = None, dry_run: tuple[int, int] | None = None) -> DataFrame:
    """place, name, status, detail. source: source_facts; target: rows (cd_ms). frozen: whether two probes of the source agreed; canary: whether
    a doubled write left one copy; dry_run: (sampled windows, done ones); None for what was not probed."""
    from plumbline.operators.health import recent

    facts = source.first()
    came = recent(target, now).first().n
    free = 1.0 if free_share is None else free_share
    found = [
        ("documents", "pass" if facts.docs else "fail", f"{facts.docs} documents in {facts.collections} collections"),
        ("layout", "pass" if sorted_layout else "fail", "collections are sorted by time and id" if sorted_layout else "window scans read everything"),
        ("clock", *_clock(facts.newest, now, bound)),
        ("frozen", *(("pass", "a bound is set") if bound is not None else ("pass", "not probed") if frozen is None else ("pass", "the source stands still") if frozen else ("fail", "the source is growing"))),
        ("live ingest", "pass" if came else "warn", f"{came} rows in the last 15 minutes"),
        ("no time", "warn" if facts.no_time else "pass", f"{facts.no_time} documents without a time"),
        ("disk", "fail" if free < DISK_FAIL else "warn" if free < DISK_WARN else "pass", f"{free:.0%} free"),
        ("canary", "fail" if canary is False else "pass", "a doubled write left two copies" if canary is False else "doubled writes leave one copy" if canary else "not probed"),
        ("dry run", *(("pass", "not run") if dry_run is None else ("pass" if dry_run[0] == dry_run[1] > 0 else "fail", f"{dry_run[1]} of {dry_run[0]} sampled windows are done"))),
    ]
    return source.sparkSession.createDataFrame([(i, *row) for i, row in enumerate(found)], "place int, name string, status string, detail string")


def _clock(newest: int | None, now: int, bound: int | None) -> tuple[str, str]:
    if bound is not None:
        return ("pass", "the bound lies in the past") if bound <= now - MINUTE else ("fail", "the bound is not a minute in the past")
    if newest is not None and newest > now - MINUTE:
        return "fail", "the newest document is from this minute: clocks differ, or the source is being written"
    return "pass", "the newest document is older than a minute"


def sorted_layout(docs: DataFrame) -> bool:
    """Whether the files of docs (cd_ms, source_id) are sorted by time and id: no row is smaller than the one before it in its file."""
    from pyspark.sql import Window

    order = Window.partitionBy("_file").orderBy("_row")
    at = F.struct("cd_ms", "source_id")
    marked = docs.select("cd_ms", "source_id", F.input_file_name().alias("_file"), F.monotonically_increasing_id().alias("_row"))
    return marked.withColumn("_before", F.lag(at).over(order)).filter(at < F.col("_before")).isEmpty()
