"""Document collections: a folder of Parquet for each, under one root, told by a name prefix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.schema import DOCUMENT
from plumbline.sources.files import Store


def discover(names: list[str], prefix: str) -> list[str]:
    """Names that start with the prefix, by code unit, the base collection first."""
    found = sorted((n for n in names if n.startswith(prefix)), key=lambda n: n.encode("utf-16-be"))
    if not found:
        raise ValueError(f"no collection starts with {prefix!r}")
    return [n for n in found if n == prefix] + [n for n in found if n != prefix]


def discovery_order(collections: DataFrame, prefix: str) -> DataFrame:
    """The same over a DataFrame (collection), with each one's place."""
    from pyspark.sql import Window

    base = F.when(F.col("collection") == prefix, 0).otherwise(1)
    named = collections.filter(F.col("collection").startswith(prefix)).distinct()
    return named.withColumn("place", F.row_number().over(Window.orderBy(base, "collection")))


def read_collections(spark: SparkSession, root: str, prefix: str) -> DataFrame:
    """All collections as one DataFrame (schema.DOCUMENT); columns that a file lacks are null, others are dropped."""
    names = discover(Store(spark, root).names(), prefix)
    parts = [spark.read.schema(DOCUMENT.replace("collection string, ", "")).parquet(f"{root}/{n}").withColumn("collection", F.lit(n)) for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_layout(docs: DataFrame, path: str) -> None:
    """Documents sorted by time and id within range partitions: the layout in which window scans skip row groups."""
    docs.repartitionByRange("cd_ms", "source_id").sortWithinPartitions("cd_ms", "source_id").write.parquet(path)


def cursors(docs: DataFrame) -> DataFrame:
    """First and last (cd_ms, source_id) of each collection."""
    at = F.when(F.col("cd_ms").isNotNull(), F.struct("cd_ms", "source_id"))
    return docs.groupBy("collection").agg(F.min(at).alias("first"), F.max(at).alias("last"))


def window_scan(docs: DataFrame, low: int, high: int, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Documents of [low, high), pruned to columns; both reach the Parquet scan."""
    picked = docs.filter((F.col("cd_ms") >= low) & (F.col("cd_ms") < high))
    return picked.select(*columns) if columns else picked


def resume(docs: DataFrame, after: tuple[int, str], high: int) -> DataFrame:
    """What follows a cursor: the document at the cursor itself is left out."""
    at = F.struct(F.col("cd_ms"), F.col("source_id"))
    return docs.filter((at > F.struct(F.lit(after[0]).cast("long").alias("cd_ms"), F.lit(after[1]).alias("source_id"))) & (F.col("cd_ms") < high))


def null_page(docs: DataFrame, after: str | None, last: str, size: int) -> DataFrame:
    """The next documents without cd by id, in (after, last]."""
    none = docs.filter(F.col("cd_ms").isNull() & (F.col("source_id") <= last))
    return (none if after is None else none.filter(F.col("source_id") > after)).orderBy("source_id").limit(size)
