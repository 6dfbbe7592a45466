"""Does the target hold what the source holds? Recounts, checksums, identity coverage, verification, content.

Every audit is a fixed number of jobs over all windows at once: documents and rows are placed in their windows by an
equi-join and aggregated by window, instead of a query for each window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators import grid, pairs
from plumbline.schema import CHECKSUM_MODULUS

#: Windows whose identities are sampled, ids of a sample and its probes.
ID_STRIDE, ID_WINDOWS, ID_SAMPLE, ID_PROBES = 25, 300, 5000, 10
RUN_LENGTH = 25
KEY = ["collection", "idx"]
UNRESOLVED = ("pending", "waived")


def swept_rows(docs: DataFrame, live: DataFrame) -> DataFrame:
    """Distinct live pairs of documents without cd: docs and live both have collection, _id and cd_ms (for docs: derived from ts)."""
    own = docs.filter("no_cd").select("collection", "_id", "cd_ms")
    return live.select("collection", "_id", "cd_ms").join(own, ["collection", "_id", "cd_ms"], "left_semi").distinct()


def window_fingerprints(points: DataFrame, chunks: DataFrame, prefix: str) -> DataFrame:
    """collection, idx, <prefix>_n and <prefix>_sum of the points' cd_ms; windows without points are absent."""
    placed = grid.place_points(points.select("collection", "cd_ms"), chunks.select("collection", "idx", "lower_cd", "upper_cd"))
    return placed.groupBy(*KEY).agg(F.count("*").alias(f"{prefix}_n"), pairs.checksum(F.col("cd_ms")).alias(f"{prefix}_sum"))


def unresolved_by_window(dead: DataFrame, live: DataFrame, chunks: DataFrame) -> DataFrame:
    """collection, idx, unresolved: ids of pending or waived dead letters in the window that no live row there has."""
    open_ = dead.filter(F.col("status").isin(*UNRESOLVED) & F.col("cd_ms").isNotNull()).select("collection", F.col("source_id").alias("_id"), "cd_ms")
    bounds = chunks.select("collection", "idx", "lower_cd", "upper_cd")
    letters = grid.place_points(open_, bounds).select(*KEY, "_id").distinct()
    there = grid.place_points(live.select("collection", "_id", "cd_ms"), bounds).select(*KEY, "_id")
    return letters.join(there, [*KEY, "_id"], "left_anti").groupBy(*KEY).agg(F.count("*").alias("unresolved"))


def audit_windows(docs: DataFrame, live: DataFrame, dead: DataFrame, chunks: DataFrame, scopes: DataFrame) -> DataFrame:
    """Each regular window with source, live (without swept rows), sums, unresolved, status and finding.

    docs: collection, _id, cd_ms, no_cd. live: rows with their collection. scopes: collection, scope_a.
    """
    swept = window_fingerprints(swept_rows(docs, live), chunks, "swept")
    source = window_fingerprints(docs.filter("not no_cd"), chunks, "source")
    target = window_fingerprints(live, chunks, "live")
    regular = chunks.filter(~grid.is_sentinel()).select("collection", "idx", "lower_cd", "upper_cd")
    joined = regular
    for part in (source, target, swept, unresolved_by_window(dead, live, chunks)):
        joined = joined.join(part, KEY, "left")
    joined = joined.fillna(0, ["source_n", "source_sum", "live_n", "live_sum", "swept_n", "swept_sum", "unresolved"])
    joined = joined.join(scopes.select("collection", F.col("scope_a").isNotNull().alias("scoped")), "collection", "left").withColumn("scoped", F.coalesce("scoped", F.lit(False)))
    several = scopes.select("collection").distinct().limit(2).count() > 1
    unscoped = ~F.col("scoped") & F.lit(several)
    net = joined.withColumn("live", F.col("live_n") - F.col("swept_n")).withColumn("live_net_sum", F.pmod(F.col("live_sum") - F.col("swept_sum"), F.lit(CHECKSUM_MODULUS)))
    net = net.withColumn("delta", F.col("live") + F.col("unresolved") - F.col("source_n"))
    status = F.when(unscoped, "pending").when(F.col("delta") == 0, "done").when(F.col("live") == 0, "pending").otherwise("failed")
    finding = (
        F.when(unscoped | ((F.col("delta") != 0) & (F.col("live") == 0)), F.lit(None).cast("string"))
        .when(F.col("delta") > 0, "deletion drift")
        .when(F.col("delta") < 0, "mismatch")
        .when((F.col("unresolved") == 0) & (F.col("live") > 0) & (F.col("live_net_sum") != F.col("source_sum")), "checksum mismatch")
    )
    return net.withColumn("status", status).withColumn("finding", finding).withColumn("sum_delta", F.when(finding == "checksum mismatch", F.col("live_net_sum") - F.col("source_sum"))).select("collection", "idx", "lower_cd", "upper_cd", "scoped", F.col("source_n").alias("source"), "source_sum", "live", F.col("live_net_sum").alias("live_sum"), "unresolved", "status", "finding", "sum_delta")


def audit_sentinels(docs: DataFrame, live: DataFrame, dead: DataFrame) -> DataFrame:
    """Per collection with documents without cd: how many, swept, missing (not excused by a dead letter), status."""
    none = docs.filter("no_cd").select("collection", "_id").distinct()
    swept = swept_rows(docs, live).select("collection", "_id").distinct().withColumn("swept", F.lit(1))
    excused = dead.filter(F.col("status").isin(*UNRESOLVED)).select("collection", F.col("source_id").alias("_id")).distinct().withColumn("excused", F.lit(1))
    each = none.join(swept, ["collection", "_id"], "left").join(excused, ["collection", "_id"], "left")
    sums = each.groupBy("collection").agg(F.count("*").alias("null_cds"), F.count("swept").alias("swept"), F.count_if(F.col("swept").isNull() & F.col("excused").isNull()).alias("missing"))
    return sums.withColumn("status", F.when(F.col("missing") == 0, "done").when(F.col("swept") == 0, "pending").otherwise("failed"))


def rebuilt_ledger(windows: DataFrame, sentinels: DataFrame, run_id: str) -> DataFrame:
    """The ledger that the data proves: one chunk for each window and sentinel."""
    regular = windows.select("collection", "idx", "lower_cd", "upper_cd", "status", F.when(F.col("status") == "done", F.col("live")).otherwise(0).alias("rows_expected"))
    last = windows.groupBy("collection").agg(F.max("idx").alias("last"))
    extra = sentinels.join(last, "collection", "left").select("collection", (F.coalesce("last", F.lit(-1)) + 1).alias("idx"), F.lit(-1).cast("long").alias("lower_cd"), F.lit(0).cast("long").alias("upper_cd"), "status", F.when(F.col("status") == "done", F.col("swept")).otherwise(0).alias("rows_expected"))
    return regular.unionByName(extra).withColumn("run_id", F.lit(run_id)).withColumn("docs_read", F.col("rows_expected"))


def window_id_sample(docs: DataFrame, windows: DataFrame, n: int = ID_SAMPLE, probes: int = ID_PROBES) -> DataFrame:
    """collection, idx, _id: from evenly spaced probes on, the next ids by time (n in all).

    Per probe the smallest n / probes documents at or after it are wanted; a document belongs to every probe
    before it, so ranks come from one running count by window.
    """
    per = -(-n // probes)
    bounds = windows.select("collection", "idx", "lower_cd", "upper_cd")
    placed = grid.place_points(docs.filter("not no_cd").select("collection", "_id", "cd_ms"), bounds)
    reached = F.expr(f"size(filter(sequence(0, {probes - 1}), k -> cd_ms >= lower_cd + (upper_cd - lower_cd) * k div {probes}))")
    ranked = placed.withColumn("reached", reached).withColumn("rank", F.row_number().over(Window.partitionBy(*KEY).orderBy("cd_ms", "_id")))
    # Before probe k lie the documents that reached k probes or fewer: its first rank follows from ten counts.
    counts = ranked.groupBy(*KEY, "reached").agg(F.count("*").alias("n")).groupBy(*KEY).agg(F.collect_list(F.struct("reached", "n")).alias("counts"))
    firsts = counts.select(*KEY, F.expr(f"transform(sequence(0, {probes - 1}), k -> 1 + aggregate(filter(counts, c -> c.reached <= k), 0L, (s, c) -> s + c.n))").alias("firsts"))
    taken = ranked.join(firsts, KEY).filter(F.expr(f"exists(firsts, f -> rank >= f and rank < f + {per})"))
    return taken.select(*KEY, "_id").distinct()


def id_coverage(docs: DataFrame, live: DataFrame, dead: DataFrame, windows: DataFrame, stride: int = ID_STRIDE) -> DataFrame:
    """Sampled windows (every clean stride-th and all drifting ones) with sampled and missing identities."""
    clean = (F.col("idx") % stride == 0) & F.col("finding").isNull() & (F.col("status") == "done") & (F.col("live") > 0)
    chosen = windows.filter(clean | (F.col("finding") == "deletion drift") & (F.col("source") > 0))
    sample = window_id_sample(docs, chosen)
    there = grid.place_points(live.select("collection", "_id", "cd_ms"), chosen.select("collection", "idx", "lower_cd", "upper_cd")).select(*KEY, "_id").distinct().withColumn("there", F.lit(1))
    excused = dead.filter(F.col("status").isin(*UNRESOLVED)).select("collection", F.col("source_id").alias("_id")).distinct().withColumn("excused", F.lit(1))
    each = sample.join(there, [*KEY, "_id"], "left").join(excused, ["collection", "_id"], "left")
    return each.groupBy(*KEY).agg(F.count("*").alias("sampled"), F.count_if(F.col("there").isNull() & F.col("excused").isNull()).alias("missing"))


def verify(docs: DataFrame, live: DataFrame, dead: DataFrame, chunks: DataFrame, scopes: DataFrame, up_to: int | None = None) -> DataFrame:
    """Done chunks with expected and live rows, checked and mismatch. Unscoped ones among several and those past up_to aren't checked."""
    done = chunks.filter("status = 'done'")
    swept = swept_rows(docs, live)
    counted = grid.place_points(live.select("collection", "cd_ms"), done.select("collection", "idx", "lower_cd", "upper_cd")).groupBy(*KEY).agg(F.count("*").alias("live_n"))
    inside = grid.place_points(swept.select("collection", "cd_ms"), done.select("collection", "idx", "lower_cd", "upper_cd")).groupBy(*KEY).agg(F.count("*").alias("swept_n"))
    replayed = grid.place_points(dead.filter("replay_inserted and status = 'resolved' and cd_ms is not null").select("collection", "cd_ms"), done.select("collection", "idx", "lower_cd", "upper_cd")).groupBy(*KEY).agg(F.count("*").alias("replayed"))
    total = swept.groupBy("collection").agg(F.count("*").alias("swept_all"))
    several = chunks.select("collection").distinct().limit(2).count() > 1
    each = done.join(counted, KEY, "left").join(inside, KEY, "left").join(replayed, KEY, "left").join(total, "collection", "left").join(scopes.select("collection", F.col("scope_a").alias("own_scope")), "collection", "left").fillna(0, ["live_n", "swept_n", "replayed", "swept_all"])
    sentinel = grid.is_sentinel()
    past = F.lit(False) if up_to is None else ~sentinel & (F.col("upper_cd") > up_to)
    checked = F.when(sentinel, F.col("rows_expected") > 0).otherwise(~past & (F.col("own_scope").isNotNull() | F.lit(not several)))
    expected = F.when(sentinel, F.col("rows_expected")).otherwise(F.col("rows_expected") + F.col("replayed"))
    found = F.when(sentinel, F.col("swept_all")).otherwise(F.col("live_n") - F.col("swept_n"))
    bad = F.when(sentinel, found < expected).otherwise(found != expected)
    return each.select("collection", "idx", expected.alias("expected"), found.alias("live"), checked.alias("checked"), (checked & bad).alias("mismatch"))


SCALARS = ("a", "e", "n", "uid", "uid_canon", "did", "lsid", "ts", "c", "s", "dur")
PAYLOADS = ("sg", "up", "custom", "cmp")


def content_sample(docs: DataFrame, samples: int = 500, run_length: int = RUN_LENGTH) -> DataFrame:
    """Rows expected at evenly spaced probes of each collection's time, run_length documents from each on."""
    probes = max(1, -(-samples // run_length))
    span = docs.filter("not no_cd").groupBy("collection").agg(F.min("cd_ms").alias("lo"), F.max("cd_ms").alias("hi"))
    order = Window.partitionBy("collection").orderBy("cd_ms", "_id")
    ranked = docs.filter("not no_cd").withColumn("rank", F.row_number().over(order))
    points = span.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(probes - 1)))).select("collection", "k", (F.col("lo") + F.floor((F.col("k") + 0.5) / probes * (F.col("hi") - F.col("lo")))).alias("at"))
    # Where a probe lands: the documents before it are counted once, by a merge of probes and documents.
    marks = ranked.select("collection", F.col("cd_ms").alias("at"), F.lit(None).cast("int").alias("k")).unionByName(points)
    before = F.count(F.when(F.col("k").isNull(), 1)).over(Window.partitionBy("collection").orderBy("at", F.col("k").isNull()).rowsBetween(Window.unboundedPreceding, -1))
    first = marks.withColumn("first", F.coalesce(before, F.lit(0)) + 1).filter("k is not null").select("collection", F.explode(F.sequence(F.col("first"), F.col("first") + run_length - 1)).alias("rank")).distinct()
    return ranked.join(first, ["collection", "rank"]).drop("rank")


def content_diff(expected: DataFrame, live: DataFrame, dead: DataFrame) -> DataFrame:
    """collection, _id, kind (matched, different, missing, excused) and the fields that differ."""
    from plumbline.functions.values import key_set

    live_cols = [F.col(c).alias(f"l_{c}") for c in (*SCALARS, *PAYLOADS)]
    ids = expected.select("_id").distinct()
    # Copies of one pair can differ: their content decides then, so that reruns agree.
    copy = Window.partitionBy("_id").orderBy(F.desc("cd_ms"), "collection", *SCALARS, *PAYLOADS)
    one = live.join(ids, "_id", "left_semi").withColumn("place", F.row_number().over(copy)).filter("place = 1").select("_id", F.col("cd_ms").alias("l_cd_ms"), *live_cols)
    excused = dead.filter(F.col("status").isin(*UNRESOLVED)).select("collection", F.col("source_id").alias("_id")).distinct().withColumn("excused", F.lit(True))
    both = expected.join(one, "_id", "left").join(excused, ["collection", "_id"], "left")
    differs = [F.when(~F.col(c).eqNullSafe(F.col(f"l_{c}")), F.lit(c)) for c in SCALARS] + [F.when(key_set(F.col(c)) != key_set(F.col(f"l_{c}")), F.lit(f"{c}:keys")) for c in PAYLOADS]
    fields = F.filter(F.array(*differs), lambda x: x.isNotNull())
    missing = ~F.col("cd_ms").eqNullSafe(F.col("l_cd_ms"))
    kind = F.when(missing & F.coalesce("excused", F.lit(False)), "excused").when(missing, "missing").when(F.size(fields) > 0, "different").otherwise("matched")
    return both.select("collection", "_id", kind.alias("kind"), F.when(kind == "different", F.array_join(fields, ",")).alias("fields"))


def unaudited(done: DataFrame, audited: DataFrame) -> DataFrame:
    """Collections with done chunks that the audit didn't see."""
    return done.filter("status = 'done'").select("collection").distinct().join(audited.select("collection").distinct(), "collection", "left_anti")


