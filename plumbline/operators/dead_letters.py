"""Documents that did not land: capture, states, reports and replay. Keyed by (run_id, collection, source_id)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.values import clamp_time
from plumbline.operators.pairs import absent

KEY = ["run_id", "collection", "source_id"]
MASS_LIMIT = 1_000_000


def capture(failed: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """failed (run_id, collection, source_id, raw_doc, reason, error, cd_ms, ts_ms): new entries. What exists for a key stays;
    of several new ones the first by reason, error and text."""
    own = F.struct("reason", "error", "raw_doc", clamp_time(F.coalesce("cd_ms", "ts_ms")).alias("cd_ms"))
    fresh = failed.groupBy(*KEY).agg(F.min(own).alias("x")).select(*KEY, "x.*")
    if existing is not None:
        fresh = fresh.join(existing.select(*KEY), KEY, "left_anti")
    return fresh.select(*KEY, "raw_doc", "reason", "error", "cd_ms", F.lit(False).alias("replay_inserted"), F.lit("pending").alias("status"))


def by_status(dead: DataFrame) -> DataFrame:
    return dead.groupBy("status").agg(F.count("*").alias("n"))


def top_errors(dead: DataFrame, most: int) -> DataFrame:
    return dead.filter("status = 'pending'").groupBy("error").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "error").limit(most)


def page(dead: DataFrame, after: tuple[str, str] | None, size: int = 500) -> DataFrame:
    """The next pending entries by (source_id, collection): one id may be in several collections, so a page resumes after the pair."""
    pending = dead.filter("status = 'pending'")
    if after is not None:
        pending = pending.filter((F.col("source_id") > after[0]) | ((F.col("source_id") == after[0]) & (F.col("collection") > after[1])))
    return pending.orderBy("source_id", "collection").limit(size)


def offset_page(dead: DataFrame, size: int, skip: int) -> DataFrame:
    return dead.filter("status = 'pending'").orderBy("source_id", "collection").offset(skip).limit(size)


def waive(dead: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Pending entries among ids (all without) become waived."""
    if ids is None:
        return dead.withColumn("status", F.when(F.col("status") == "pending", "waived").otherwise(F.col("status")))
    marked = dead.join(ids.select("source_id").distinct().withColumn("_hit", F.lit(True)), "source_id", "left")
    return marked.withColumn("status", F.when(F.col("_hit") & (F.col("status") == "pending"), "waived").otherwise(F.col("status"))).select(*dead.columns)


def unresolved_among(dead: DataFrame, ids: DataFrame) -> DataFrame:
    """ids (collection, _id) that are pending or waived."""
    open_ = dead.filter(F.col("status").isin("pending", "waived")).select("collection", F.col("source_id").alias("_id"))
    return ids.join(open_, ["collection", "_id"], "left_semi")


def replay(rows: DataFrame, live: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of repaired documents: those to insert, and the pairs that are live already."""
    key = ["collection", "_id", "cd_ms"]
    return absent(rows, live, key), rows.select(*key).join(live.select(*key), key, "left_semi")


def resolve(dead: DataFrame, inserted: DataFrame, already: DataFrame, version: str) -> DataFrame:
    """dead after a replay: what landed or was there is resolved; replay_inserted tells which."""
    mark = lambda df, name: df.select("collection", F.col("_id").alias("source_id")).distinct().withColumn(name, F.lit(True))
    each = dead.join(mark(inserted, "_in"), ["collection", "source_id"], "left").join(mark(already, "_there"), ["collection", "source_id"], "left")
    hit = (F.col("status") == "pending") & (F.col("_in").isNotNull() | F.col("_there").isNotNull())
    changed = {"status": F.when(hit, "resolved").otherwise(F.col("status")), "replay_inserted": F.col("replay_inserted") | F.coalesce(hit & F.col("_in"), F.lit(False))}
    return each.select(*[changed.get(c, F.col(c)).alias(c) for c in dead.columns if c != "resolved_by_version"], F.when(hit, F.lit(version)).alias("resolved_by_version"))


def too_many(dead: DataFrame, limit: int = MASS_LIMIT) -> bool:
    return dead.filter("status = 'pending'").limit(limit).count() >= limit
