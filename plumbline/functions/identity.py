"""Which application and event a collection stands for, and the scope of its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.schema import CUSTOM_EVENT, INTERNAL_PREFIX

#: Names of internal events.
KNOWN_EVENTS = (
    "[CLY]_view",
    "[CLY]_session",
    "[CLY]_crash",
    "[CLY]_push_action",
    "[CLY]_push_sent",
    "[CLY]_consent",
    "[CLY]_star_rating",
    "[CLY]_nps",
    "[CLY]_survey",
    "[CLY]_action",
    "[CLY]_apm_device",
    "[CLY]_apm_network",
    "[CLY]_orientation",
    "[CLY]_llm_interaction",
    "[CLY]_llm_interaction_feedback",
    "[CLY]_llm_tool_used",
    "[CLY]_llm_tool_usage_parameter",
    "[CLY]_journey_engine_start",
    "[CLY]_journey_engine_end",
    "[CLY]_content_shown",
    "[CLY]_content_interacted",
    "[CLY]_AB_E",
    "[CLY]_Event",
    "[CLY]_apm_",
    "[CLY]_cohorts",
    "[CLY]_consolidated",
    "[CLY]_consolidated_",
    "[CLY]_custom",
    "[CLY]_custom_event",
    "[CLY]_event_name",
    "[CLY]_exit",
    "[CLY]_group",
    "[CLY]_group_",
    "[CLY]_group_page_views",
    "[CLY]_journey_completed",
    "[CLY]_journey_engine",
    "[CLY]_journey_entered",
    "[CLY]_nps_shown",
    "[CLY]_property_update",
    "[CLY]_purchase",
    "[CLY]_push",
    "[CLY]_push_",
    "[CLY]_push_consent",
    "[CLY]_push_open",
    "[CLY]_push_sent_507f1f77bcf86cd799439012_no",
    "[CLY]_session0",
    "[CLY]_session2",
    "[CLY]_session_begin",
    "[CLY]_session_update",
    "[CLY]_sessions",
    "[CLY]_special",
    "[CLY]_star",
    "[CLY]_survery",
    "[CLY]_survey_shown",
    "[CLY]_true",
    "[CLY]_view_begin",
    "[CLY]_view_update",
    "[CLY]_views",
)
#: Internal events whose collections are not copied.
EXCLUDED_EVENTS = ("[CLY]_apm_device", "[CLY]_apm_network")
#: Entries of an identity map that are broadcast; larger maps are joined by shuffle.
BROADCAST_ENTRIES = 200_000


def event_hash(event: Column, app: Column) -> Column:
    return F.sha1(F.concat(event, app))


def identity_map(apps: DataFrame, events: DataFrame) -> DataFrame:
    """apps (_id), events (_id, list): hash, a, e for every app and known or custom event (last wins on equal hashes)."""
    custom = F.coalesce(F.col("list"), F.array().cast("array<string>"))
    listed = F.array_union(F.array(*[F.lit(e) for e in KNOWN_EVENTS]), custom)
    pairs = apps.select(F.col("_id").cast("string").alias("a")).distinct().join(events.select(F.col("_id").cast("string").alias("a"), "list"), "a", "left").select("a", F.explode(listed).alias("e"))
    return pairs.select(event_hash(F.col("e"), F.col("a")).alias("hash"), "a", "e").groupBy("hash").agg(F.max(F.struct("a", "e")).alias("x")).select("hash", "x.a", "x.e")


def collection_hash(name: Column, prefix: str) -> Column:
    """The 40 characters after the prefix; null for the base collection and other names."""
    rest = F.substring(name, len(prefix) + 1, 1 << 20)
    return F.when((name != prefix) & (F.length(rest) == 40), rest)


def with_defaults(docs: DataFrame, identity: DataFrame, prefix: str) -> DataFrame:
    """docs (collection, ...) with default_a and default_e of their collection."""
    side = identity.select(F.col("hash").alias("_hash"), F.col("a").alias("default_a"), F.col("e").alias("default_e"))
    if side.limit(BROADCAST_ENTRIES + 1).count() <= BROADCAST_ENTRIES:
        side = F.broadcast(side)
    return docs.withColumn("_hash", collection_hash(F.col("collection"), prefix)).join(side, "_hash", "left").drop("_hash")


def scope_of(a: Column, e: Column) -> Column:
    """struct<a, e, n> of a collection's rows: internal events have no n, custom ones are told by it."""
    internal = e.startswith(INTERNAL_PREFIX)
    return F.struct(a.alias("a"), F.when(internal, e).otherwise(F.lit(CUSTOM_EVENT)).alias("e"), F.when(~internal, e).alias("n"))


def not_excluded(e: Column) -> Column:
    return e.isNull() | ~e.isin(*EXCLUDED_EVENTS)


def in_scope(row: tuple[Column, Column, Column], scope: tuple[Column, Column, Column]) -> Column:
    """(a, e, n) of a row against those of a scope, whose n may be null for any."""
    return (row[0] == scope[0]) & (row[1] == scope[1]) & (scope[2].isNull() | (row[2] == scope[2]))
