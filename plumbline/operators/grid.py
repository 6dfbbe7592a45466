"""The grid of time windows: building, clamping, splitting, claiming and joining points to windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.schema import SENTINEL

DAY_MS = 86_400_000
TARGET_DOCS, MAX_DAYS, MAX_CHUNKS = 2_000_000, 7, 50_000
SUB_CHUNKS, SPLIT_SPAN_MS, SPLIT_ATTEMPTS = 4, 60_000, 3


def _windows(bounds: DataFrame, parts: Column) -> DataFrame:
    """bounds (lower_cd, upper_cd exclusive) cut into parts; empty windows are dropped and the rest numbered."""
    span = F.col("upper_cd") - F.col("lower_cd")
    at = lambda i: (F.col("lower_cd") + F.expr("cast((cast(upper_cd - lower_cd as decimal(38,0)) * {}) div _parts as bigint)".format(i))).cast("long")
    cut = bounds.withColumn("_parts", parts.cast("long")).withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)))
    cut = cut.filter(span > 0).withColumn("_lo", at("_i")).withColumn("_hi", F.when(F.col("_i") == F.col("_parts") - 1, F.col("upper_cd")).otherwise(at("(_i + 1)")))
    return cut.filter("_hi > _lo").drop("lower_cd", "upper_cd", "_parts").withColumnRenamed("_lo", "lower_cd").withColumnRenamed("_hi", "upper_cd")


def chunk_count(span: Column, estimate: Column, target: int = TARGET_DOCS, max_days: int = MAX_DAYS) -> Column:
    return F.greatest(F.lit(1), F.least(F.lit(MAX_CHUNKS), F.greatest(F.ceil(estimate / target), F.ceil(span / (max_days * DAY_MS)))))


def build_grid(bounds: DataFrame, target: int = TARGET_DOCS, max_days: int = MAX_DAYS) -> DataFrame:
    """bounds (collection, lower, upper inclusive, estimate): collection, idx, lower_cd, upper_cd without gap or overlap."""
    base = bounds.filter("lower is not null").select("collection", F.col("lower").alias("lower_cd"), (F.col("upper") + 1).alias("upper_cd"), "estimate")
    cut = _windows(base, chunk_count(F.col("upper_cd") - F.col("lower_cd"), F.col("estimate"), target, max_days))
    order = Window.partitionBy("collection").orderBy("lower_cd")
    return cut.select("collection", (F.row_number().over(order) - 1).alias("idx"), "lower_cd", "upper_cd")


def collection_bounds(docs: DataFrame, bound: int | None = None) -> DataFrame:
    """docs (collection, source_id, cd_ms null where absent): lower, upper, estimate, null_cds and the null ids' range.

    With a bound, what is at or after it doesn't count; a collection that starts there has no window.
    """
    inside = F.col("cd_ms").isNotNull() if bound is None else F.col("cd_ms") < bound
    none = F.col("cd_ms").isNull()
    pick = lambda c, x: F.when(c, x)
    return docs.groupBy("collection").agg(
        F.min(pick(inside, F.col("cd_ms"))).alias("lower"),
        F.max(pick(inside, F.col("cd_ms"))).alias("upper"),
        F.count(pick(inside, F.lit(1))).alias("estimate"),
        F.count(pick(none, F.lit(1))).alias("null_cds"),
        F.min(pick(none, F.col("source_id"))).alias("first_null_id"),
        F.max(pick(none, F.col("source_id"))).alias("last_null_id"),
    )


def with_sentinels(grid: DataFrame, bounds: DataFrame) -> DataFrame:
    """The grid and, for each collection with documents without cd, the sentinel after its windows."""
    last = grid.groupBy("collection").agg(F.max("idx").alias("last"))
    extra = bounds.filter("null_cds > 0").join(last, "collection", "left").select("collection", (F.coalesce("last", F.lit(-1)) + 1).alias("idx"), F.lit(SENTINEL[0]).cast("long").alias("lower_cd"), F.lit(SENTINEL[1]).cast("long").alias("upper_cd"))
    return grid.select("collection", "idx", "lower_cd", "upper_cd").unionByName(extra)


def is_sentinel() -> Column:
    return (F.col("lower_cd") == SENTINEL[0]) & (F.col("upper_cd") == SENTINEL[1])


def top_up(mapped: DataFrame, bounds: DataFrame, target: int = TARGET_DOCS, max_days: int = MAX_DAYS) -> DataFrame:
    """New windows from where a collection's regular windows end to its newest document, numbered on."""
    high = mapped.groupBy("collection").agg(F.max("idx").alias("last"), F.max(F.when(~is_sentinel(), F.col("upper_cd"))).alias("end"))
    delta = bounds.filter("upper is not null").join(high, "collection", "left")
    fresh = delta.filter(F.col("end").isNull() | (F.col("upper") >= F.col("end"))).select("collection", F.coalesce("end", "lower").alias("lower"), "upper", "estimate", F.coalesce("last", F.lit(-1)).alias("last"))
    grid = build_grid(fresh.drop("last"), target, max_days)
    return grid.join(fresh.select("collection", "last"), "collection").select("collection", (F.col("idx") + F.col("last") + 1).alias("idx"), "lower_cd", "upper_cd")


def split(chunks: DataFrame, parts: int = SUB_CHUNKS) -> DataFrame:
    """chunks (collection, idx, lower_cd, upper_cd) that may be split, as sub-windows numbered by part."""
    able = chunks.filter(~is_sentinel() & (F.col("upper_cd") - F.col("lower_cd") > SPLIT_SPAN_MS)).select("collection", F.col("idx").alias("parent"), "lower_cd", "upper_cd")
    cut = _windows(able, F.lit(parts))
    return cut.select("collection", "parent", F.col("_i").cast("int").alias("part"), "lower_cd", "upper_cd")


def prune(chunks: DataFrame, bound: int) -> DataFrame:
    """chunks with action: deleted at or after the bound, clamped across it, refused if such a one isn't pending; sentinels stay."""
    beyond, across = F.col("lower_cd") >= bound, (F.col("lower_cd") < bound) & (F.col("upper_cd") > bound)
    touched = ~is_sentinel() & (beyond | across)
    action = F.when(touched & (F.col("status") != "pending"), "refused").when(touched & beyond, "deleted").when(touched, "clamped").otherwise("kept")
    return chunks.withColumn("action", action).withColumn("new_upper_cd", F.when(action == "clamped", F.lit(bound).cast("long")).otherwise(F.col("upper_cd")))


def claim_order(chunks: DataFrame) -> DataFrame:
    """Pending regular chunks with their place: collections by name, newest window first.

    The ledger is small (50,000 windows a collection at most), so one sorted task is enough.
    """
    order = Window.orderBy("collection", F.desc("idx"))
    return chunks.filter((F.col("status") == "pending") & ~is_sentinel()).withColumn("place", F.row_number().over(order))


def frontier(chunks: DataFrame) -> DataFrame:
    """The tape (all chunks in claim order) with position and whether it is the first non-terminal one."""
    from plumbline.schema import TERMINAL

    order = Window.orderBy("collection", F.desc("idx"))
    tape = chunks.withColumn("position", F.row_number().over(order) - 1)
    open_at = F.min(F.when(~F.col("status").isin(*TERMINAL), F.col("position"))).over(Window.partitionBy(F.lit(1)))
    return tape.withColumn("is_frontier", F.coalesce(F.col("position") == open_at, F.lit(False)))


def place_points(points: DataFrame, chunks: DataFrame, at: str = "cd_ms") -> DataFrame:
    """points (collection, at) joined to the window that holds them.

    A range join as an equi-join: windows are exploded over the buckets that they touch, and a point looks in its own.
    A collection's buckets are as wide as its windows on average, so its windows touch two each on average. No job runs here: widths are
    a small aggregate of the ledger within the plan.
    """
    placed, spread = _bucketed(points, chunks, at, "inner")
    return placed.join(spread, ["collection", "_bucket"]).filter((F.col(at) >= F.col("lower_cd")) & (F.col(at) < F.col("upper_cd"))).drop("_bucket")


def _bucketed(points: DataFrame, chunks: DataFrame, at: str, how: str) -> tuple[DataFrame, DataFrame]:
    """points with their bucket, and the regular windows by the buckets that they touch."""
    regular = chunks.filter(~is_sentinel())
    widths = regular.groupBy("collection").agg(F.greatest(F.lit(1), F.avg(F.col("upper_cd") - F.col("lower_cd")).cast("long")).alias("_width"))
    bucket = lambda c: F.floor(c / F.col("_width")).cast("long")
    spread = regular.join(widths, "collection").withColumn("_bucket", F.explode(F.sequence(bucket(F.col("lower_cd")), bucket(F.col("upper_cd") - 1)))).drop("_width")
    return points.join(widths, "collection", how).withColumn("_bucket", bucket(F.col(at))).drop("_width"), spread


def outside(points: DataFrame, chunks: DataFrame, at: str = "cd_ms") -> DataFrame:
    """points (collection, at) that no window holds, by the same buckets."""
    placed, spread = _bucketed(points, chunks, at, "left")
    w = spread.select(F.col("collection").alias("_in"), F.col("_bucket").alias("_at"), F.col("lower_cd").alias("_lo"), F.col("upper_cd").alias("_hi"))
    inside = (F.col("collection") == F.col("_in")) & (F.col("_bucket") == F.col("_at")) & (F.col(at) >= F.col("_lo")) & (F.col(at) < F.col("_hi"))
    return placed.join(w, inside, "left_anti").select(*points.columns)
