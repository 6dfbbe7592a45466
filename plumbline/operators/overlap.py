"""Overlap dedupe: copies of rows that the live stream wrote too, hour by hour, where counts prove it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators import pairs

HOUR = 3_600_000
SLACK_MOST = 5.0


def effective_slack(pct: float) -> float:
    return min(max(pct, 0.0), SLACK_MOST)


def bucket_evidence(docs: DataFrame, live: DataFrame, scopes: DataFrame, start: int, end: int, slack_pct: float = 0.0) -> DataFrame:
    """collection, bucket_ms, in_window, matched, native, verdict (safe, no-scope, no-native-evidence; null if nothing matched).

    docs: collection, _id, cd_ms, no_cd. live: rows with their collection; rows of an unscoped collection are
    matched by pair alone, so live must hold them under their collection too.
    """
    bucket = (F.col("cd_ms") - F.col("cd_ms") % HOUR).alias("bucket_ms")
    source = docs.filter(~F.col("no_cd") & pairs.in_window(F.col("cd_ms"), start, end))
    inside = live.filter(pairs.in_window(F.col("cd_ms"), start, end))
    key = ["collection", "bucket_ms"]
    counted = source.groupBy("collection", bucket).agg(F.count("*").alias("in_window"))
    matched = pairs.matching_rows(inside, source, ["collection", "_id", "cd_ms"]).groupBy("collection", bucket).agg(F.count("*").alias("matched"))
    total = inside.groupBy("collection", bucket).agg(F.count("*").alias("total"))
    none = docs.filter("no_cd").select("collection", "_id").distinct()
    sweep = inside.join(none, ["collection", "_id"], "left_semi").groupBy("collection", bucket).agg(F.count("*").alias("sweep"))
    own = scopes.select("collection", F.col("scope_a").isNotNull().alias("scoped"))
    each = counted.join(matched, key, "left").join(total, key, "left").join(sweep, key, "left").join(own, "collection", "left").fillna(0, ["matched", "total", "sweep"]).withColumn("scoped", F.coalesce("scoped", F.lit(False)))
    native = F.when(F.col("scoped"), F.col("total") - F.col("matched") - F.col("sweep")).otherwise(F.lit(-1))
    slack = F.ceil(F.col("matched") * (effective_slack(slack_pct) / 100))
    verdict = F.when(F.col("matched") == 0, F.lit(None).cast("string")).when(~F.col("scoped"), "no-scope").when((native < F.col("matched") - slack) | (native <= 0), "no-native-evidence").otherwise("safe")
    return each.select("collection", "bucket_ms", "in_window", "matched", native.cast("long").alias("native"), verdict.alias("verdict"))


def deletable(docs: DataFrame, live: DataFrame, evidence: DataFrame, start: int, end: int) -> DataFrame:
    """The observed pairs (collection, _id, cd_ms) that a dedupe of safe hours deletes."""
    safe = evidence.filter("verdict = 'safe'").select("collection", "bucket_ms")
    source = docs.filter(~F.col("no_cd") & pairs.in_window(F.col("cd_ms"), start, end)).withColumn("bucket_ms", F.col("cd_ms") - F.col("cd_ms") % HOUR).join(safe, ["collection", "bucket_ms"], "left_semi")
    return pairs.live_pairs(live, source, ["collection", "_id", "cd_ms"])


def survivors(live: DataFrame, gone: DataFrame) -> DataFrame:
    return pairs.without_pairs(live, gone, ["collection", "_id", "cd_ms"])


def totals(evidence: DataFrame, execute: bool) -> DataFrame:
    """One row: in_window, matched, deleted, unsafe."""
    safe = F.sum(F.when(F.col("verdict") == "safe", F.col("matched")).otherwise(0)) if execute else F.lit(0)
    return evidence.agg(F.coalesce(F.sum("in_window"), F.lit(0)).alias("in_window"), F.coalesce(F.sum("matched"), F.lit(0)).alias("matched"), F.coalesce(safe, F.lit(0)).cast("long").alias("deleted"), F.coalesce(F.sum(F.when(F.col("verdict") != "safe", F.col("matched"))), F.lit(0)).alias("unsafe"))
