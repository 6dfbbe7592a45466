"""Documents, rows, target and ledger derived from the `events` table, with every rule's cases put in by modulus.

The same relations are given as SQL, so that each query over them can be compared with a plain statement.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import identity as ident
from plumbline.operators import grid
from plumbline.operators.normalize import normalize
from plumbline.operators.pairs import scoped
from plumbline.schema import TEXT_FIELDS
from plumbline.sources.shared import written

PREFIX, RUN = "docs", "run1"
#: The clock of all queries: 2024-01-20T00:00:00Z, in the middle of the events.
NOW = 1705708800000
DAY = 86_400_000
TARGET_DOCS, MAX_DAYS = 100, 7
OVERLAP = (NOW - 10 * DAY, NOW)


_tables: dict[tuple, DataFrame] = {}


def kept_once(build):
    """Write a relation as a table in the shared folder once for each application, tables' folder and arguments.

    Later queries read the columns that they need; what their plans hold is a scan, not the derivation.
    """

    @functools.wraps(build)
    def get(spark: SparkSession, sf_dir: str, *more) -> DataFrame:
        key = (build.__name__, spark.sparkContext.applicationId, sf_dir, *more)
        if key not in _tables:
            _tables[key] = written(build(spark, sf_dir, *more))
        return _tables[key]

    return get


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    e = F.when(F.col("event_type") == "view", "[CLY]_view").when(F.col("event_type") == "error", "[CLY]_crash").otherwise(F.col("event_type"))
    return raw.select("event_id", "user_id", "value", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"), F.concat(F.lit("app_"), F.col("user_id") % 3).alias("app"), e.alias("e_raw"))


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def _quoted(*parts: Column | str) -> Column:
    return F.concat(F.lit('"'), *[F.lit(p) if isinstance(p, str) else p for p in parts], F.lit('"'))


def _date(ms: Column) -> Column:
    return F.concat(F.lit('{"$date":{"$numberLong":"'), ms.cast("string"), F.lit('"}}'))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as Extended JSON text, of hashed collections and of the base one (every tenth)."""
    e, base = events(spark, sf_dir), _every(10)
    text = {
        "_id": F.when(_every(199), F.lit('"  "')).otherwise(_quoted("ev_", F.col("event_id").cast("string"))),
        "a": F.when(base & ~_every(43), _quoted(F.col("app"))),
        "e": F.when(base & ~_every(47), _quoted(F.col("e_raw"))),
        "n": F.when(_every(17), F.lit('" \\t "')).when(_every(19), F.lit('"named"')),
        "uid": F.when(_every(53), F.lit("null")).when(_every(157), F.col("user_id").cast("string")).otherwise(_quoted("u", F.col("user_id").cast("string"))),
        "did": F.when(_every(3), _quoted("d", (F.col("user_id") % 7).cast("string"))),
        "ts": F.when(_every(59), F.lit('"soon"')).when(_every(227), F.lit("5")).when(_every(229), _date(F.lit(20000000000000))).when(_every(61), F.expr("ms div 1000").cast("string")).when(_every(71), _quoted(" ", F.col("ms").cast("string"), " ")).when(_every(73), _date(F.col("ms"))).otherwise(F.col("ms").cast("string")),
        "cd": F.when(_every(211), F.lit(None)).when(_every(223), F.lit('"bad"')).otherwise(_date(F.col("ms") + (F.col("event_id") % 30) * 1000)),
        "c": F.when(_every(127), F.lit("99999999999")).otherwise((F.col("event_id") % 7).cast("string")),
        "s": F.when(_every(131), F.lit('"abc"')).when(_every(137), F.lit('{"$numberDouble":"NaN"}')).otherwise(F.col("value").cast("string")),
        "sg": F.when(_every(83), F.lit("[1]")).when(_every(29), F.lit('{"k":1}')).otherwise(F.concat(F.lit('{"name":"/p'), F.col("event_id") % 50, F.lit('","group":"g'), F.col("user_id") % 5, F.lit('"}'))),
        "up": F.when(_every(89), F.lit('{"big":52601586211929000000}')).otherwise(F.lit('{"p":"x"}')),
        "migrated": F.when(_every(67), F.lit("true")),
    }
    collection = F.when(base, F.lit(PREFIX)).otherwise(F.concat(F.lit(PREFIX), ident.event_hash(F.col("e_raw"), F.col("app"))))
    # The table is one small file: its rows are dealt to as many tasks as there are cores.
    return e.repartition(spark.sparkContext.defaultParallelism).select(collection.alias("collection"), *[text.get(f, F.lit(None)).cast("string").alias(f) for f in TEXT_FIELDS])


@kept_once
def identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The identity map of the apps and event names that occur."""
    e = events(spark, sf_dir)
    apps = e.select(F.col("app").alias("_id")).distinct()
    lists = e.filter(~F.col("e_raw").startswith("[")).groupBy(F.col("app").alias("_id")).agg(F.collect_set("e_raw").alias("list"))
    return ident.identity_map(apps, lists)


def normalizing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The normalisation itself, not its table."""
    return normalize(ident.with_defaults(documents(spark, sf_dir), identity(spark, sf_dir), PREFIX))


@kept_once
def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalizing(spark, sf_dir)


def source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """collection, _id, cd_ms, ts_ms, no_cd of every document that has a time at all."""
    return normalized(spark, sf_dir).filter("cd_ms is not null").select("collection", F.coalesce("_id", F.lit("?")).alias("_id"), "cd_ms", "ts_ms", "no_cd")


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalized(spark, sf_dir).filter("skip_reason is null").withColumn("num", F.substring("_id", 4, 20).try_cast("long"))


def _copies(good: DataFrame) -> DataFrame:
    """The target: rows that were lost, doubled, retried later or changed, and rows of the live stream."""
    n = F.col("num")
    kept = good.filter(n % 97 != 0).withColumn("uid", F.when(n % 107 == 0, "wrong").otherwise(F.col("uid")))
    again = good.filter(n % 101 == 0)
    later = good.filter(n % 103 == 0).withColumn("cd_ms", F.col("cd_ms") + 40 * DAY)
    native = good.filter(n % 5 == 1).withColumn("_id", F.concat(F.lit("nat_"), n)).withColumn("cd_ms", F.col("cd_ms") + 1)
    return kept.unionByName(again).unionByName(later).unionByName(native).withColumn("cd", F.timestamp_millis("cd_ms"))


def target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _copies(rows(spark, sf_dir)).drop("collection")


@kept_once
def scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """collection, scope_a, scope_e, scope_n; the base collection has none."""
    names = events(spark, sf_dir).select("app", "e_raw").distinct()
    scope = ident.scope_of(F.col("app"), F.col("e_raw"))
    own = names.select(F.concat(F.lit(PREFIX), ident.event_hash(F.col("e_raw"), F.col("app"))).alias("collection"), scope["a"].alias("scope_a"), scope["e"].alias("scope_e"), scope["n"].alias("scope_n"))
    return own.unionByName(spark.createDataFrame([(PREFIX, None, None, None)], own.schema))


@kept_once
def live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target rows under the collection whose scope they are in."""
    return scoped(target(spark, sf_dir), scopes(spark, sf_dir))


def bounds(spark: SparkSession, sf_dir: str, bound: int | None = None) -> DataFrame:
    docs = source(spark, sf_dir).select("collection", F.col("_id").alias("source_id"), F.when(~F.col("no_cd"), F.col("cd_ms")).alias("cd_ms"))
    return grid.collection_bounds(docs, bound)


@kept_once
def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger: grid and sentinels with states by modulus."""
    b = bounds(spark, sf_dir)
    g = grid.with_sentinels(grid.build_grid(b, TARGET_DOCS, MAX_DAYS), b)
    k = F.col("idx") % 11
    status = F.when(k == 3, "failed").when(k == 5, "pending").when(k == 7, "in_progress").when(k == 8, "written").when(k == 9, "attaching").otherwise("done")
    held = status.isin("in_progress", "written", "attaching")
    read = (F.col("upper_cd") - F.col("lower_cd")) % 3000
    return g.select(
        F.lit(RUN).alias("run_id"), "collection", F.col("idx").cast("int").alias("idx"), "lower_cd", "upper_cd", status.alias("status"),
        F.when(held | (status == "done"), F.concat(F.lit("pod"), F.col("idx") % 3)).alias("pod_id"),
        F.when(held, F.lit(NOW) + (F.col("idx") % 2 * 2 - 1) * 60_000).cast("long").alias("lease_until"),
        (F.col("idx") % 6).cast("int").alias("attempts"), F.when(status.isin("done", "written"), read).otherwise(0).cast("long").alias("docs_read"),
        F.when(status == "done", F.col("idx") % 4).otherwise(0).cast("long").alias("docs_skipped"), F.when(status.isin("done", "written"), read - F.when(status == "done", F.col("idx") % 4).otherwise(0)).otherwise(0).cast("long").alias("rows_expected"),
        (F.lit(NOW) - F.col("idx") * 30_000).cast("long").alias("updated_at"),
    )


@kept_once
def dead(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters: skipped documents but those already marked, and some refused rows, with states by modulus of the id."""
    n = F.coalesce(F.regexp_extract("source_id", r"(\d+)", 1).try_cast("long"), F.lit(0))
    skipped = normalized(spark, sf_dir).filter("skip_reason is not null and skip_reason <> 'already_marked_migrated'")
    status = F.when(n % 3 == 0, "pending").when(n % 3 == 1, "waived").otherwise("resolved")
    letters = skipped.select(F.lit(RUN).alias("run_id"), "collection", F.coalesce("source_id", F.lit("?")).alias("source_id"), F.lit("skipped").alias("reason"), F.concat(F.lit("skip:"), "skip_reason").alias("error"), "cd_ms", ((n % 3 == 2) & (n % 2 == 0)).alias("replay_inserted"), status.alias("status"))
    # Some of the rows that the target lost were refused.
    m = F.col("num")
    lost = rows(spark, sf_dir).filter(m % 194 == 0)
    state = F.when(m % 3 == 0, "pending").when(m % 3 == 1, "waived").otherwise("resolved")
    return letters.unionByName(lost.select(F.lit(RUN).alias("run_id"), "collection", F.col("_id").alias("source_id"), F.lit("insert_rejected").alias("reason"), F.lit("refused:c").alias("error"), "cd_ms", ((m % 3 == 2) & (m % 2 == 0)).alias("replay_inserted"), state.alias("status")))


_SQL = f"""
ev AS (
    SELECT event_id AS i, user_id AS u, value, epoch_us(ts) // 1000 AS ms, 'app_' || (user_id % 3) AS app,
           CASE event_type WHEN 'view' THEN '[CLY]_view' WHEN 'error' THEN '[CLY]_crash' ELSE event_type END AS e_raw FROM events),
typed AS (
    SELECT *, CASE WHEN i % 10 = 0 THEN '{PREFIX}' ELSE '{PREFIX}' || sha1(e_raw || app) END AS collection,
        CASE WHEN i % 199 <> 0 THEN 'ev_' || i END AS _id,
        CASE WHEN i % 10 <> 0 OR i % 43 <> 0 THEN app END AS a,
        CASE WHEN i % 10 <> 0 OR i % 47 <> 0 THEN e_raw END AS e_in,
        CASE WHEN i % 17 = 0 THEN NULL WHEN i % 19 = 0 THEN 'named' END AS n_raw,
        CASE WHEN i % 53 = 0 THEN NULL WHEN i % 157 = 0 THEN CAST(u AS VARCHAR) ELSE 'u' || u END AS uid,
        CASE WHEN i % 3 = 0 THEN 'd' || (u % 7) ELSE '' END AS did,
        CASE WHEN i % 59 = 0 OR i % 227 = 0 THEN NULL WHEN i % 229 = 0 THEN 20000000000000 WHEN i % 61 = 0 THEN ms // 1000 * 1000 ELSE ms END AS ts_in,
        CASE WHEN i % 211 = 0 OR i % 223 = 0 THEN NULL ELSE ms + i % 30 * 1000 END AS cd_in,
        CASE WHEN i % 127 = 0 THEN 4294967295 ELSE i % 7 END AS c,
        CASE WHEN i % 131 = 0 OR i % 137 = 0 THEN 0.0 ELSE value END AS s,
        CASE WHEN i % 83 = 0 THEN '{{}}' WHEN i % 29 = 0 THEN '{{"k":1}}' ELSE '{{"name":"/p' || (i % 50) || '","group":"g' || (u % 5) || '"}}' END AS sg,
        CASE WHEN i % 83 <> 0 AND i % 29 <> 0 THEN '/p' || (i % 50) END AS sg_name, CASE WHEN i % 83 <> 0 AND i % 29 <> 0 THEN 'g' || (u % 5) END AS sg_group,
        CASE WHEN i % 89 = 0 THEN '{{"big":"52601586211929000000"}}' ELSE '{{"p":"x"}}' END AS up
    FROM ev),
norm AS (
    SELECT *, CASE WHEN i % 67 = 0 THEN 'already_marked_migrated' WHEN a IS NULL THEN 'missing_a' WHEN e_in IS NULL THEN 'missing_e' WHEN uid IS NULL THEN 'missing_uid'
            WHEN _id IS NULL THEN 'missing__id' WHEN ts_in IS NULL THEN 'invalid_ts' END AS skip_reason,
        CASE WHEN e_in LIKE '[CLY]%' THEN e_in ELSE '[CLY]_custom' END AS e,
        coalesce(n_raw, CASE WHEN e_in = '[CLY]_view' THEN sg_name WHEN e_in = '[CLY]_crash' THEN sg_group ELSE e_in END, e_in) AS n,
        CASE WHEN ts_in IS NOT NULL THEN least(ts_in, 10413791999999) END AS ts_ms, coalesce(cd_in, CASE WHEN ts_in IS NOT NULL THEN least(ts_in, 10413791999999) END) AS cd_ms, cd_in IS NULL AS no_cd
    FROM typed),
source AS (SELECT collection, coalesce(_id, '?') AS _id, cd_ms, ts_ms, no_cd FROM norm WHERE cd_ms IS NOT NULL),
good AS (SELECT * FROM norm WHERE skip_reason IS NULL),
target AS (
    SELECT _id, a, e, n, CASE WHEN i % 107 = 0 THEN 'wrong' ELSE uid END AS uid, did, ts_ms, cd_ms, c, s, sg, up, i FROM good WHERE i % 97 <> 0
    UNION ALL SELECT _id, a, e, n, uid, did, ts_ms, cd_ms, c, s, sg, up, i FROM good WHERE i % 101 = 0
    UNION ALL SELECT _id, a, e, n, uid, did, ts_ms, cd_ms + {40 * DAY}, c, s, sg, up, i FROM good WHERE i % 103 = 0
    UNION ALL SELECT 'nat_' || i, a, e, n, uid, did, ts_ms, cd_ms + 1, c, s, sg, up, i FROM good WHERE i % 5 = 1),
scopes AS (
    SELECT DISTINCT '{PREFIX}' || sha1(e_raw || app) AS collection, app AS scope_a, CASE WHEN e_raw LIKE '[CLY]%' THEN e_raw ELSE '[CLY]_custom' END AS scope_e,
           CASE WHEN e_raw NOT LIKE '[CLY]%' THEN e_raw END AS scope_n FROM ev
    UNION ALL SELECT '{PREFIX}', NULL, NULL, NULL),
live AS (SELECT s.collection, t.* FROM target t JOIN scopes s ON t.a = s.scope_a AND t.e = s.scope_e AND (s.scope_n IS NULL OR t.n = s.scope_n)),
bounds AS (
    SELECT collection, min(cd_ms) FILTER (NOT no_cd) AS lower, max(cd_ms) FILTER (NOT no_cd) AS upper, count(*) FILTER (NOT no_cd) AS estimate, count(*) FILTER (no_cd) AS null_cds,
           min(_id) FILTER (no_cd) AS first_null_id, max(_id) FILTER (no_cd) AS last_null_id FROM source GROUP BY collection),
parts AS (
    SELECT *, upper + 1 - lower AS span, greatest(1, least(50000, greatest((estimate + {TARGET_DOCS - 1}) // {TARGET_DOCS}, (upper + {MAX_DAYS * DAY} - lower) // {MAX_DAYS * DAY}))) AS k FROM bounds WHERE lower IS NOT NULL),
cut AS (
    SELECT collection, lower + span * j // k AS lower_cd, CASE WHEN j = k - 1 THEN upper + 1 ELSE lower + span * (j + 1) // k END AS upper_cd FROM parts, unnest(range(0, k)) t(j)),
grid AS (SELECT collection, row_number() OVER (PARTITION BY collection ORDER BY lower_cd) - 1 AS idx, CAST(lower_cd AS BIGINT) AS lower_cd, CAST(upper_cd AS BIGINT) AS upper_cd FROM cut WHERE upper_cd > lower_cd),
placed AS (
    SELECT * FROM grid UNION ALL
    SELECT b.collection, coalesce(max(g.idx), -1) + 1, -1, 0 FROM bounds b LEFT JOIN grid g ON b.collection = g.collection WHERE b.null_cds > 0 GROUP BY b.collection),
stated AS (
    SELECT *, CASE idx % 11 WHEN 3 THEN 'failed' WHEN 5 THEN 'pending' WHEN 7 THEN 'in_progress' WHEN 8 THEN 'written' WHEN 9 THEN 'attaching' ELSE 'done' END AS status, (upper_cd - lower_cd) % 3000 AS r FROM placed),
chunks AS (
    SELECT '{RUN}' AS run_id, collection, CAST(idx AS INTEGER) AS idx, lower_cd, upper_cd, status,
        CASE WHEN status NOT IN ('failed', 'pending') THEN 'pod' || (idx % 3) END AS pod_id,
        CASE WHEN status IN ('in_progress', 'written', 'attaching') THEN {NOW} + (idx % 2 * 2 - 1) * 60000 END AS lease_until,
        CAST(idx % 6 AS INTEGER) AS attempts, CASE WHEN status IN ('done', 'written') THEN r ELSE 0 END AS docs_read, CASE WHEN status = 'done' THEN idx % 4 ELSE 0 END AS docs_skipped,
        CASE WHEN status = 'done' THEN r - idx % 4 WHEN status = 'written' THEN r ELSE 0 END AS rows_expected, {NOW} - idx * 30000 AS updated_at FROM stated),
dead AS (
    SELECT '{RUN}' AS run_id, collection, coalesce(_id, '?') AS source_id, 'skipped' AS reason, 'skip:' || skip_reason AS error, cd_ms,
        (CASE WHEN _id IS NULL THEN 0 ELSE i END) % 6 = 2 AS replay_inserted,
        CASE (CASE WHEN _id IS NULL THEN 0 ELSE i END) % 3 WHEN 0 THEN 'pending' WHEN 1 THEN 'waived' ELSE 'resolved' END AS status
    FROM norm WHERE skip_reason IS NOT NULL AND skip_reason <> 'already_marked_migrated'
    UNION ALL SELECT '{RUN}', collection, _id, 'insert_rejected', 'refused:c', cd_ms, i % 6 = 2, CASE i % 3 WHEN 0 THEN 'pending' WHEN 1 THEN 'waived' ELSE 'resolved' END FROM good WHERE i % 194 = 0)
"""


def sql(body: str, *more: str) -> str:
    """A statement over the derived relations; more: further "name AS (...)" relations."""
    return "WITH " + ", ".join([_SQL.strip(), *more]) + " " + body.strip()
