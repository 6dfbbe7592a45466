"""Rows by identity and time: counts, checksums, semi and anti joins on (_id, cd), duplicates, deletes.

Pair sets are DataFrames joined by key, so any number of them is one join; Catalyst chooses broadcast or shuffle.
Scopes are a DataFrame too (collection, scope_a, scope_e, scope_n): rows are matched to their collection once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.schema import CHECKSUM_MODULUS, SNAPSHOT_MODULUS

PAIR = ["_id", "cd_ms"]


def checksum(ms: Column, modulus: int = CHECKSUM_MODULUS) -> Column:
    """Order-free checksum of times; exact, as residues of a residue sum."""
    return F.coalesce(F.pmod(F.sum(F.pmod(ms, F.lit(modulus))), F.lit(modulus)), F.lit(0)).cast("long")


def in_window(at: Column, low: int | Column, high: int | Column) -> Column:
    return (at >= low) & (at < high)


def scoped(live: DataFrame, scopes: DataFrame) -> DataFrame:
    """live with the collection whose scope holds the row (inner). A scope without n holds every n.

    Two equi-joins: all custom events of an application share e, so those are joined by (a, e, n) and never meet by e alone.
    """
    own = scopes.filter("scope_a is not null").select("collection", F.col("scope_a").alias("a"), F.col("scope_e").alias("e"), F.col("scope_n").alias("n"))
    named = live.join(own.filter("n is not null"), ["a", "e", "n"])
    return named.unionByName(live.join(own.filter("n is null").drop("n"), ["a", "e"]).select(*named.columns)).select("collection", *live.columns)


def live_pairs(rows: DataFrame, pairs: DataFrame, keys: list[str] = PAIR) -> DataFrame:
    """Distinct keys of rows that are among pairs."""
    return rows.select(*keys).join(pairs.select(*keys), keys, "left_semi").distinct()


def matching_rows(rows: DataFrame, pairs: DataFrame, keys: list[str] = PAIR) -> DataFrame:
    return rows.join(pairs.select(*keys), keys, "left_semi")


def absent(pairs: DataFrame, rows: DataFrame, keys: list[str] = PAIR) -> DataFrame:
    """pairs that no row has: what a replay may insert."""
    return pairs.join(rows.select(*keys), keys, "left_anti")


def without_pairs(rows: DataFrame, pairs: DataFrame, keys: list[str] = PAIR) -> DataFrame:
    """rows after a delete of pairs."""
    return rows.join(pairs.select(*keys), keys, "left_anti")


def without_window(rows: DataFrame, low: int, high: int, collection: str | None = None) -> DataFrame:
    """rows (with collection) after a purge of [low, high) in one collection or all."""
    gone = in_window(F.col("cd_ms"), low, high)
    return rows.filter(~(gone if collection is None else gone & (F.col("collection") == collection)))


def cds_by_id(rows: DataFrame, ids: DataFrame, low: int | None = None, high: int | None = None) -> DataFrame:
    """_id and the last cd of rows among ids within [low, high]."""
    picked = rows.join(ids.select("_id"), "_id", "left_semi")
    if low is not None:
        picked = picked.filter(F.col("cd_ms").between(low, high))
    return picked.groupBy("_id").agg(F.max("cd_ms").alias("cd_ms"))


def per_bucket(rows: DataFrame, size_ms: int, at: str = "cd_ms", low: int | None = None, high: int | None = None) -> DataFrame:
    """bucket_ms and n of rows in [low, high)."""
    if low is not None:
        rows = rows.filter(in_window(F.col(at), low, high))
    return rows.groupBy((F.col(at) - F.col(at) % size_ms).alias("bucket_ms")).agg(F.count("*").alias("n"))


def duplicate_groups(live: DataFrame, boundary_ms: int) -> DataFrame:
    """Groups of rows with one identity: copies, those before the boundary, first and last cd. The month keeps
    the key local: copies of a document share their ts."""
    month = F.date_format("ts", "yyyyMM").alias("month")
    groups = live.groupBy(month, "_id", "a", "e", "n").agg(F.count("*").alias("copies"), F.count_if(F.col("cd_ms") < boundary_ms).alias("early_copies"), F.min("cd_ms").alias("min_cd_ms"), F.max("cd_ms").alias("max_cd_ms"))
    return groups.filter("copies > 1")


def attribution() -> Column:
    copies = F.col("early_copies")
    return F.when(copies == 0, "live artifact").when(copies == 1, "cross-cutover retry").otherwise("defect")


def duplicate_totals(live: DataFrame, boundary_ms: int) -> DataFrame:
    """rows, duplicates, distinct_ids and copied_groups as one row."""
    groups = duplicate_groups(live, boundary_ms).agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"), F.coalesce(F.sum((F.col("early_copies") >= 2).cast("long")), F.lit(0)).alias("copied_groups"))
    counted = live.agg(F.count("*").alias("rows"))
    return counted.withColumn("one", F.lit(1)).join(groups.withColumn("one", F.lit(1)), "one").select("rows", "duplicates", (F.col("rows") - F.col("duplicates")).alias("distinct_ids"), "copied_groups")


def duplicate_sample(live: DataFrame, boundary_ms: int, most: int = 20) -> DataFrame:
    """The worst groups of each month, the first months' first."""
    order = Window.partitionBy("month").orderBy(F.desc("early_copies"), F.desc("copies"), "_id", "a", "e", "n")
    ranked = duplicate_groups(live, boundary_ms).withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)
    return ranked.orderBy("month", "place").limit(most)


def source_snapshot(docs: DataFrame, up_to: int | None = None) -> DataFrame:
    """docs (collection, source_id, cd_ms, ts_ms): collection, max_cd, n, cd_sum, id_sum, equal for equal contents."""
    inside = docs if up_to is None else docs.filter(F.col("cd_ms").isNull() | (F.col("cd_ms") < up_to))
    at = F.coalesce("cd_ms", "ts_ms", F.lit(0))
    bits = F.pmod(F.abs(F.xxhash64("source_id") % (1 << 62)), F.lit(SNAPSHOT_MODULUS))
    return inside.groupBy("collection").agg(F.max("cd_ms").alias("max_cd"), F.count("*").alias("n"), F.pmod(F.sum(F.pmod(at, F.lit(SNAPSHOT_MODULUS))), F.lit(CHECKSUM_MODULUS)).alias("cd_sum"), F.pmod(F.sum(bits), F.lit(CHECKSUM_MODULUS)).alias("id_sum"))


def snapshot_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """collection and change: added, removed, grew (a newer cd) or moved (count or sums)."""
    a, b = before.alias("x"), after.alias("y")
    both = a.join(b, F.col("x.collection") == F.col("y.collection"), "full")
    change = F.when(F.col("x.collection").isNull(), "added").when(F.col("y.collection").isNull(), "removed").when(F.coalesce(F.col("y.max_cd") > F.col("x.max_cd"), F.col("y.max_cd").isNotNull()), "grew")
    moved = F.lit(False)
    for c in ("n", "cd_sum", "id_sum"):
        moved = moved | ~F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}"))
    return both.select(F.coalesce("x.collection", "y.collection").alias("collection"), F.coalesce(change, F.when(moved, "moved")).alias("change")).filter("change is not null")


def same_pairs(before: DataFrame, after: DataFrame) -> bool:
    """Whether two pair sets are equal, repeated pairs included."""
    keys = [c for c in PAIR if c in before.columns]
    return before.select(*keys).exceptAll(after.select(*keys)).isEmpty() and after.select(*keys).exceptAll(before.select(*keys)).isEmpty()
