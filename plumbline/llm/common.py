"""What the corpus operators share: tables, joins whose broadcast is bounded, keys of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.sources.shared import cut

#: Rows that may be broadcast: of at most a few dozen bytes each, so a few MB on each executor. Beyond, joins are shuffled.
BROADCAST_ROWS = 200_000
#: A word, as all contracts define it: a run without space, tab, LF, VT, FF or CR.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut_as_dealt(df: DataFrame) -> DataFrame:
    """df cut, so that later joins on the key by which its plan deals it move only their other side.

    A checkpoint keeps its plan's partitioning, but adaptive plans don't report one: this plan is made without.
    """
    conf = df.sparkSession.conf
    adaptive = conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return cut(df)
    finally:
        conf.set("spark.sql.adaptive.enabled", adaptive)


def cut_by(df: DataFrame, key: str, parts: int) -> DataFrame:
    """df dealt by key to `parts` tasks and cut: see cut_as_dealt."""
    return cut_as_dealt(df.repartition(parts, key))


def bounded(small: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether small (already cut, so counting is cheap) may be broadcast."""
    return small.limit(rows + 1).count() <= rows


def look_up(big: DataFrame, small: DataFrame, on: list[str], how: str = "left", rows: int = BROADCAST_ROWS) -> DataFrame:
    """Equi-join big with small: broadcast below the row bound, else a shuffled join whose hot keys AQE splits."""
    return big.join(F.broadcast(small) if bounded(small, rows) else small.hint("merge"), on, how)


def matching(big: DataFrame, keys: DataFrame, on: str, how: str = "left_semi", salts: int = 32, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Rows of big (doc_id, text, ...) whose key is in keys (left_semi; inner: with what keys has beside it) or is not (left_anti); keys: distinct and cut.

    Below the row bound the keys are broadcast and big never moves; beyond it both sides are
    shuffled on (key, salt), so the rows of a hot key spread over `salts` tasks, those without a doc_id too.
    """
    if bounded(keys, rows):
        return big.join(F.broadcast(keys), on, how)
    salted = keys.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    spread = big.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "text", F.monotonically_increasing_id()), F.lit(salts)).cast("int"))
    return spread.join(salted, [on, "_salt"], how).drop("_salt")


def whole(text: str = "text") -> Column:
    """The whole text, with null as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def row_key(text_hash: Column) -> Column:
    """A row's doc_id (null counts as a value) and a hash of its text as one key; rows with equal keys are the same document."""
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), text_hash.cast("string"))


def without(docs: DataFrame, text_hash: Column, dropped: DataFrame, repeated: DataFrame) -> DataFrame:
    """docs without the rows whose key is in dropped, and one row for each key in repeated; columns as they are.

    dropped, repeated: (_row), distinct. Of rows with one key the one with the least hash of all its columns stays;
    each task sends one candidate, so a row given millions of times is never gathered.
    """
    columns = [f"`{c}`" for c in docs.columns]
    kept = matching(docs.withColumn("_row", row_key(text_hash)), cut(dropped), "_row", "left_anti")
    repeated = cut(repeated)
    if repeated.isEmpty():
        return kept.select(*columns)
    once = matching(kept, repeated, "_row").groupBy("_row").agg(F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("_one"))
    return matching(kept, repeated, "_row", "left_anti").select(*columns).unionByName(once.select("_one.*"))


def tasks(df: DataFrame) -> int:
    """Partitions for work of df's size: those of its scan, which follow its bytes, or the session's if more."""
    return max(df.rdd.getNumPartitions(), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
