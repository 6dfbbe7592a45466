"""How the target and the source stand: sizes, pressure, recent traffic, frozen states, purges by ids."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import pairs
from plumbline.sources.files import Store
from plumbline.sources.live_table import LiveTable

RECENT_MIN = 15
ACTIVE_CAP, FAILED_CAP, LIST_CAP = 500, 200, 100


# Files


def table_files(table: LiveTable) -> DataFrame:
    """month, folder, files, bytes of what the newest manifest lists."""
    rows, found = [], table.store.sizes()
    for month, folders in table.manifest().items():
        for folder in folders:
            own = [n for path, n in found if path.startswith(f"{folder}/") and path.endswith(".parquet")]
            rows.append((month, folder, len(own), sum(own)))
    return table.spark.createDataFrame(rows, "month string, folder string, files int, bytes long")


def parts(files: DataFrame) -> DataFrame:
    """One row: files in all, in the fullest month, and folders that a rewrite would merge (months of several)."""
    by_month = files.groupBy("month").agg(F.sum("files").alias("n"), F.count("*").alias("folders"))
    return by_month.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.coalesce(F.max("n"), F.lit(0)).alias("most"), F.count_if(F.col("folders") > 1).alias("mergeable"))


def disk_space(spark: SparkSession, roots: list[str]) -> DataFrame:
    """root, bytes in all, left, and the share that is left."""
    rows = [(r, *Store(spark, r).space()) for r in roots]
    return spark.createDataFrame(rows, "root string, total long, free long").withColumn("free_share", F.try_divide("free", "total"))


@dataclass
class Pressure:
    """Backpressure with hysteresis: pause at `high` of a limit or when merging stalls, go on below `low` of both, after `longest` ms anyway."""

    limit_total: int = 500
    limit_partition: int = 300
    high: float = 0.70
    low: float = 0.55
    poll_ms: int = 5_000
    longest_ms: int = 180_000
    since: int | None = None
    sampled: int | None = None

    def share(self, total: int, most: int) -> float:
        return max(total / self.limit_total, most / self.limit_partition)

    def update(self, now: int, sample: tuple[int, int, int] | None) -> bool:
        """Whether to wait now. sample: (files in all, in the fullest partition, merges running); None if no probe answered, which counts as pressure."""
        if self.sampled is not None and now - self.sampled < self.poll_ms and self.since is None:
            return False
        self.sampled = now
        if sample is None:
            high = low = True
        else:
            total, most, merges = sample
            stalled = merges == 0 and self.share(total, most) > 0.25 and self.since is not None
            high, low = self.share(total, most) >= self.high, self.share(total, most) >= self.low or stalled
        if self.since is None:
            self.since = now if high else None
        elif not low or now - self.since >= self.longest_ms:
            self.since = None
        return self.since is not None


# Counts and states


def strict_count(table: LiveTable) -> int | None:
    """Rows of the target; None where there is no table, an error where it can't be read."""
    return table.read().count() if table.version() else None


def recent(rows: DataFrame, now: int, minutes: int = RECENT_MIN) -> DataFrame:
    """One row: rows that came within the last minutes."""
    return rows.filter(F.col("cd_ms") >= now - minutes * 60_000).agg(F.count("*").alias("n"))


def any_since(rows: DataFrame, at: int) -> bool:
    return not rows.filter(F.col("cd_ms") >= at).isEmpty()


def target_snapshot(rows: DataFrame, up_to: int) -> DataFrame:
    """One row for all of the target below a time: n and cd_sum, equal for equal contents."""
    own = rows.filter((F.col("cd_ms") >= 0) & (F.col("cd_ms") < up_to))
    return own.agg(F.count("*").alias("n"), pairs.checksum(F.col("cd_ms")).alias("cd_sum"))


def near_staged(live: DataFrame, staged: DataFrame) -> DataFrame:
    """live rows that can match staged ones: of their months, within the staged times. The bounds are one row, which the scan of a month is pruned by."""
    low, high = staged.agg(F.min("ts_ms"), F.max("ts_ms")).first()
    return live.filter(F.lit(False)) if low is None else live.filter(F.col("ts_ms").between(low, high))


def same_rows(staged: DataFrame, live: DataFrame, keys: list[str] = pairs.PAIR) -> DataFrame:
    """live rows that are staged too, looked for only where they can be."""
    return near_staged(live, staged).join(staged.select(*keys).distinct(), keys, "left_semi")


# Deletes


def zipped_pairs(ids: DataFrame) -> DataFrame:
    """ids (page, ids array, cds array) as pairs (_id, cd_ms)."""
    return ids.select(F.explode(F.arrays_zip("ids", "cds")).alias("p")).select(F.col("p.ids").alias("_id"), F.col("p.cds").alias("cd_ms"))


def without_ids(rows: DataFrame, ids: DataFrame, low: int, high: int) -> DataFrame:
    """rows after a delete of ids within [low, high)."""
    inside = pairs.in_window(F.col("cd_ms"), low, high)
    return rows.filter(~inside).unionByName(rows.filter(inside).join(ids.select("_id"), "_id", "left_anti").select(*rows.columns))


def without_source_window(rows: DataFrame, docs: DataFrame, low: int, high: int) -> DataFrame:
    """rows after a purge of the source's pairs of a window: for collections without a scope."""
    own = docs.filter(~F.col("no_cd") & pairs.in_window(F.col("cd_ms"), low, high))
    return pairs.without_pairs(rows, own, ["collection", *pairs.PAIR])


def without_sweep(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """rows after a purge of what documents without a time of their own gave."""
    return pairs.without_pairs(rows, docs.filter("no_cd"), ["collection", *pairs.PAIR])


# Listings


def active(chunks: DataFrame, now: int) -> DataFrame:
    from plumbline.operators.ledger import listing

    return listing(chunks, now).orderBy("collection", "idx").limit(ACTIVE_CAP)


def failed(chunks: DataFrame) -> DataFrame:
    return chunks.filter("status = 'failed'").orderBy("collection", "idx").limit(FAILED_CAP)


def open_counts(chunks: DataFrame) -> DataFrame:
    """One row: regular chunks that aren't at an end, and all chunks."""
    from plumbline.operators.grid import is_sentinel
    from plumbline.schema import TERMINAL

    return chunks.agg(F.count_if(~is_sentinel() & ~F.col("status").isin(*TERMINAL)).alias("open_windows"), F.count("*").alias("chunks"))


def seen_by(events: DataFrame) -> DataFrame:
    """events (key, value): the set of values of each key, in order: an append of what is absent."""
    return events.groupBy("key").agg(F.array_sort(F.collect_set("value")).alias("values"))
