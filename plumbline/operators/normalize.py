"""Documents to rows: one projection with a skip reason, the typed row, and what was coerced.

Rows, dead letters and reports are projections of the same DataFrame, so read = rows + skips by construction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import values as v
from plumbline.functions.sanitize import sanitized_all
from plumbline.schema import CUSTOM_EVENT, INTERNAL_PREFIX, ROW_COLUMNS, SKIP_REASONS

COERCION = "struct<rule: string, key: string, original: string, coerced: string>"
#: Objects that stand for a time or a number of two kinds: no payload, unlike longs and decimals, which are objects at run time.
NO_PAYLOAD = r'^\s*\{\s*"\$(date|numberDouble|numberInt)"'
#: Distinct (rule, key) pairs that a report keeps apart, sampled pairs, and the sample's length.
DISTINCT_CAP, SAMPLE_CAP, SAMPLE_CHARS = 10_000, 200, 100


#: Members of a segmentation that name internal events.
MEMBERS = ("name", "view", "widget_id", "group")


def event_name(e: Column, n: Column, sg: Column) -> Column:
    """struct<e, n>: custom events move their name to n; internal ones take n from their segmentation."""

    def named(m: Column) -> Column:
        name, view, widget, group = (m[i] for i in range(len(MEMBERS)))
        own = F.when(e == "[CLY]_view", name).when(e == "[CLY]_action", F.coalesce(name, view)).when(e.isin("[CLY]_nps", "[CLY]_survey", "[CLY]_star_rating"), widget).when(e == "[CLY]_crash", group)
        return F.coalesce(n, own)

    def members(parsed: Column) -> Column:
        return v.each([F.to_json(F.try_variant_get(parsed, f"$.{m}", "variant")) for m in MEMBERS], lambda t: v.as_string(v.envelope(t)))

    internal = e.startswith(INTERNAL_PREFIX)
    name = F.when(internal, e).otherwise(F.lit(CUSTOM_EVENT))
    # Only internal events without a name are looked into.
    looked = F.when(internal & n.isNull() & sg.isNotNull(), v.let(v.let(F.try_parse_json(sg), members), named))
    return F.struct(name.alias("e"), F.coalesce(n, F.when(internal, looked).otherwise(e), name).alias("n"))


def skip_reason(a: Column, e: Column, uid: Column, source_id: Column, ts: Column, migrated: Column) -> Column:
    """The first rule that fails, null if none does."""
    return F.when(migrated, "already_marked_migrated").when(a.isNull(), "missing_a").when(e.isNull(), "missing_e").when(uid.isNull(), "missing_uid").when(source_id.isNull(), "missing__id").when(ts.isNull() | (ts <= 0), "invalid_ts")


def normalize(docs: DataFrame, json_columns: tuple[str, ...] = ("up", "custom", "cmp", "sg")) -> DataFrame:
    """docs (schema.DOCUMENT, default_a, default_e) with source_id, ts_ms, cd_ms, row columns, skip_reason and coercions.

    A text that is no JSON in a payload column is a transform_error.
    """
    texts, times, numbers, payloads = ("a", "e", "n", "uid", "_id", "did", "uid_canon", "lsid"), ("ts", "lu", "cd"), ("c", "s", "dur"), ("up", "custom", "cmp", "sg")
    # Each rule stands in the plan once, for all the fields that it reads.
    typed = docs.select(
        "collection", "default_a", "default_e",
        v.each([F.col(f) for f in texts], lambda t: v.as_string(v.envelope(t))).alias("texts"),
        v.each([F.col(f) for f in times], lambda t: v.epoch_millis(v.envelope(t))).alias("times"),
        v.each([F.col(f) for f in numbers], lambda t: v.as_double(v.envelope(t))).alias("numbers"),
        *[F.when(F.ltrim(f).startswith("{") & ~F.col(f).rlike(NO_PAYLOAD), F.col(f)).alias(f"{f}_json") for f in payloads],
        F.coalesce(F.trim("migrated") == "true", F.lit(False)).alias("migrated"),
    )
    text = lambda f: F.col("texts")[texts.index(f)]
    broken = F.lit(False)
    for f in json_columns:
        broken = broken | (F.col(f"{f}_json").isNotNull() & ~F.col(f"{f}_json").rlike("NaN|Infinity") & F.try_parse_json(f"{f}_json").isNull())
    read = typed.select(
        "collection",
        F.coalesce(text("a"), "default_a").alias("a"),
        F.coalesce(text("e"), "default_e").alias("e_raw"),
        text("n").alias("n_raw"),
        text("uid").alias("uid"),
        text("_id").alias("source_id"),
        text("did").alias("did"),
        text("uid_canon").alias("uid_canon"),
        text("lsid").alias("lsid"),
        *[F.col("times")[i].alias(f"{f}_ms") for i, f in enumerate(times)],
        *[F.col("numbers")[i].alias(f"{f}_num") for i, f in enumerate(numbers)],
        *[f"{f}_json" for f in payloads],
        broken.alias("broken"),
        "migrated",
    )
    reason = skip_reason(F.col("a"), F.col("e_raw"), F.col("uid"), F.col("source_id"), F.col("ts_ms"), F.col("migrated"))
    read = read.withColumn("skip_reason", F.coalesce(reason, F.when(F.col("broken"), "transform_error"))).withColumn("name", event_name(F.col("e_raw"), F.col("n_raw"), F.col("sg_json")))
    read = read.withColumn("clean", sanitized_all({f: F.when(F.col("skip_reason").isNull(), F.col(f"{f}_json")) for f in json_columns}))
    positive = lambda c: F.when(F.col(c) > 0, v.clamp_time(F.col(c)))
    changed = lambda rule, key, a, b: F.when(a != b, F.struct(F.lit(rule).alias("rule"), F.lit(key).alias("key"), a.cast("string").alias("original"), b.cast("string").alias("coerced")))
    floor_c = F.floor(F.least(F.greatest(F.col("c_num"), F.lit(-9e18)), F.lit(9e18)))
    own = F.filter(F.array(changed("clamp_uint32", "c", floor_c, v.clamp_uint32(F.col("c_num"))), changed("clamp_datetime", "ts", F.col("ts_ms"), v.clamp_time(F.col("ts_ms")))), lambda x: x.isNotNull())
    keyed = lambda f: lambda x: F.struct(x["rule"].alias("rule"), F.lit(f).alias("key"), x["original"].alias("original"), x["coerced"].alias("coerced"))
    nested = [F.coalesce(F.transform(F.col(f"clean.{f}.coercions"), keyed(f)), F.array().cast(f"array<{COERCION}>")) for f in json_columns]
    clean = lambda f: F.coalesce(F.col(f"clean.{f}.json"), F.col(f"{f}_json")) if f in json_columns else F.col(f"{f}_json")
    ts, cd = v.clamp_time(F.col("ts_ms")), F.coalesce(positive("cd_ms"), v.clamp_time(F.col("ts_ms")))
    return read.select(
        "collection",
        "source_id",
        "skip_reason",
        F.col("source_id").alias("_id"),
        "a",
        F.col("name.e").alias("e"),
        F.col("name.n").alias("n"),
        "uid",
        "uid_canon",
        F.coalesce("did", F.lit("")).alias("did"),
        "lsid",
        F.timestamp_millis(ts).alias("ts"),
        F.coalesce(clean("up"), F.lit("{}")).alias("up"),
        clean("custom").alias("custom"),
        clean("cmp").alias("cmp"),
        F.coalesce(clean("sg"), F.lit("{}")).alias("sg"),
        v.clamp_uint32(F.col("c_num")).alias("c"),
        F.col("s_num").alias("s"),
        F.col("dur_num").alias("dur"),
        F.timestamp_millis(positive("lu_ms")).alias("lu"),
        F.timestamp_millis(cd).alias("cd"),
        ts.alias("ts_ms"),
        cd.alias("cd_ms"),
        F.col("cd_ms").isNull().alias("no_cd"),
        F.when(F.col("skip_reason").isNull(), F.concat(own, *nested)).otherwise(F.array().cast(f"array<{COERCION}>")).alias("coercions"),
    )


def rows_of(normalized: DataFrame) -> DataFrame:
    return normalized.filter("skip_reason is null").select("collection", *ROW_COLUMNS, "ts_ms", "cd_ms", "no_cd")


def skip_report(normalized: DataFrame) -> DataFrame:
    """Every reason with its count, zero included."""
    reasons = normalized.sparkSession.createDataFrame([(r,) for r in SKIP_REASONS], "skip_reason string")
    counted = normalized.filter("skip_reason is not null").groupBy("skip_reason").count()
    return reasons.join(counted, "skip_reason", "left").select("skip_reason", F.coalesce("count", F.lit(0)).alias("n"))


def skip_samples(normalized: DataFrame, most: int = 10) -> DataFrame:
    """The first skipped documents by id."""
    return normalized.filter("skip_reason is not null").select(F.coalesce("source_id", F.lit("<unknown>")).alias("source_id"), "skip_reason").orderBy("source_id", "skip_reason").limit(most)


def coercion_report(normalized: DataFrame, distinct_cap: int = DISTINCT_CAP, sample_cap: int = SAMPLE_CAP) -> DataFrame:
    """rule, key, n and a sample, most frequent first; pairs beyond the cap are summed as one."""
    each = normalized.select(F.explode("coercions").alias("c"), "source_id").select("c.rule", "c.key", F.struct("source_id", "c.original", "c.coerced").alias("sample"))
    return summarize_coercions(each, distinct_cap, sample_cap)


def summarize_coercions(each: DataFrame, distinct_cap: int = DISTINCT_CAP, sample_cap: int = SAMPLE_CAP) -> DataFrame:
    """each: (rule, key, sample struct<source_id, original, coerced>)."""
    pairs = each.groupBy("rule", "key").agg(F.count("*").alias("n"), F.min("sample").alias("sample"))
    # Pairs rank by their first document, as a scan in id order meets them.
    first = pairs.select("rule", "key", F.col("sample.source_id").alias("_at")).orderBy("_at", "rule", "key").limit(distinct_cap)
    placed = first.withColumn("rank", F.row_number().over(Window.orderBy("_at", "rule", "key"))).select("rule", "key", "rank")
    # A top-k in each task and one of their k: keys beyond the cap are never ranked.
    ranked = pairs.join(F.broadcast(placed), ["rule", "key"], "left").withColumn("rank", F.coalesce("rank", F.lit(distinct_cap + 1)))
    within = F.col("rank") <= distinct_cap
    name = lambda c, other: F.when(within, F.col(c)).otherwise(F.lit(other))
    sampled = F.when(within & (F.col("rank") <= sample_cap), F.struct(F.substring("sample.original", 1, SAMPLE_CHARS).alias("original"), F.substring("sample.coerced", 1, SAMPLE_CHARS).alias("coerced")))
    return ranked.groupBy(name("rule", "other").alias("rule"), name("key", "distinct-key-cap-reached").alias("key")).agg(F.sum("n").alias("n"), F.min(sampled["original"]).alias("original"), F.min(sampled["coerced"]).alias("coerced"))


def insertable(rows: DataFrame) -> DataFrame:
    """rows with `problems`: the columns whose values the table would refuse, in place of halving a refused batch."""
    from plumbline.schema import TIME_MAX, TIME_MIN, UINT32_MAX

    low, high = F.timestamp_millis(F.lit(TIME_MIN)), F.timestamp_millis(F.lit(TIME_MAX))
    time = lambda c: F.col(c).isNotNull() & ~F.col(c).between(low, high)
    json = lambda c: F.col(c).isNotNull() & ~F.coalesce(F.col(c).startswith("{") & F.try_parse_json(c).isNotNull(), F.lit(False))
    checks = [*[(c, F.col(c).isNull()) for c in ("_id", "a", "e", "n", "uid", "did", "ts", "cd")], *[(c, time(c)) for c in ("ts", "cd", "lu")], ("c", ~F.col("c").between(0, UINT32_MAX)), *[(c, F.isnan(c)) for c in ("s", "dur")], *[(c, json(c)) for c in ("up", "custom", "cmp", "sg")]]
    return rows.withColumn("problems", F.array_distinct(F.filter(F.array(*[F.when(bad, F.lit(c)) for c, bad in checks]), lambda x: x.isNotNull())))
