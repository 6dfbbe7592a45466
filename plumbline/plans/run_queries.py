"""Queries over runs through the ledger and the live table, and over the smaller operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import config
from plumbline.functions import identity as ident
from plumbline.functions import values as v
from plumbline.operators import audit, dead_letters, grid, health, ledger, normalize, pairs, preflight
from plumbline.plans import control, load, reports
from plumbline.plans import derived as d
from plumbline.plans import run as runs
from plumbline.plans.derived import DAY, NOW, PREFIX
from plumbline.plans.queries import _AUDIT, query
from plumbline.sources import collections as coll
from plumbline.sources.ledger_store import LedgerStore
from plumbline.sources.live_table import LiveTable
from plumbline.sources.shared import folder, written

HOUR = 3_600_000


# Runs


def _job(spark, **options) -> runs.Job:
    root = f"{folder(spark)}/run-{uuid.uuid4().hex}"
    return runs.Job(LedgerStore(spark, f"{root}/ledger"), LiveTable(spark, f"{root}/live"), d.RUN, "pod1", NOW, d.TARGET_DOCS, d.MAX_DAYS, **options)


@d.kept_once
def _prepared(spark, sf_dir) -> DataFrame:
    return runs.prepared(d.documents(spark, sf_dir), d.identity(spark, sf_dir), PREFIX)


#: What a whole run records, window by window: the grid, and a sentinel for each collection with documents without a time of their own.
_TALLY = (
    "untimed AS (SELECT collection, count(*) AS n FROM norm WHERE cd_in IS NULL GROUP BY 1)",
    "mapped AS (SELECT collection, CAST(idx AS INTEGER) AS idx, lower_cd, upper_cd FROM grid UNION ALL SELECT u.collection, CAST(coalesce((SELECT max(g.idx) FROM grid g WHERE g.collection = u.collection), -1) + 1 AS INTEGER), -1, 0 FROM untimed u)",
    """tally AS (SELECT g.collection, g.idx, count(x.i) AS docs_read, count(x.skip_reason) AS docs_skipped, count(x.i) - count(x.skip_reason) AS rows_expected
        FROM mapped g LEFT JOIN norm x ON x.collection = g.collection AND CASE WHEN g.lower_cd = -1 THEN x.cd_in IS NULL ELSE x.cd_in >= g.lower_cd AND x.cd_in < g.upper_cd END GROUP BY ALL)""",
)
_LIVE = "SELECT collection, count(*) AS n, CAST(sum(cd_ms % 1000003) AS BIGINT) AS residue FROM good GROUP BY 1"


def _live(job: runs.Job) -> DataFrame:
    return job.table.read().groupBy("collection").agg(F.count("*").alias("n"), F.sum(F.col("cd_ms") % 1000003).alias("residue"))


@query("SELECT collection, idx, 'done' AS status, docs_read, docs_skipped, rows_expected FROM tally", *_TALLY)
def run_ledger(spark, sf_dir):
    """A whole run: mapped, claimed, copied, checked, attached, swept; the ledger that it leaves."""
    done = runs.run(_job(spark), _prepared(spark, sf_dir))
    return done.select("collection", "idx", "status", "docs_read", "docs_skipped", "rows_expected")


@query(_LIVE)
def run_resumed(spark, sf_dir):
    """A run that stops after a few windows, loses a claim, and is started again: every row is live once."""
    job, docs = _job(spark, batch=30), _prepared(spark, sf_dir)
    runs.run(job, docs, most_batches=2)
    written(job.store.claim(d.RUN, "lost", NOW - HOUR, 1000, 5))
    runs.run(job, docs)
    return _live(job)


@query(_LIVE)
def run_topped_up(spark, sf_dir):
    """A run over what had come by a time, and a second one after the rest came."""
    job, docs = _job(spark), _prepared(spark, sf_dir)
    runs.run(job, docs.filter(F.col("at").isNull() | (F.col("at") < NOW - DAY)))
    runs.run(job, docs)
    return _live(job)


@query(f"SELECT collection, count(*) AS n, CAST(sum(cd_ms % 1000003) AS BIGINT) AS residue FROM good WHERE cd_in IS NULL OR cd_in < {NOW} GROUP BY 1")
def run_bounded(spark, sf_dir):
    """A run up to a bound: nothing at or after it is copied, now or by a later start."""
    job, docs = _job(spark), _prepared(spark, sf_dir)
    runs.run(job, docs, bound=NOW)
    runs.run(job, docs)
    return _live(job)


@query(f"SELECT collection, idx, lower_cd, CASE WHEN lower_cd = -1 THEN upper_cd ELSE least(upper_cd, {NOW}) END AS upper_cd FROM mapped WHERE lower_cd = -1 OR lower_cd < {NOW}", *_TALLY)
def bound_applied(spark, sf_dir):
    job = _job(spark)
    job.store.init(d.RUN, runs.windows(_prepared(spark, sf_dir), job, None), NOW)
    control.apply_bound(job.store, d.RUN, NOW, NOW)
    return job.store.read().select("collection", "idx", "lower_cd", "upper_cd")


@query("SELECT collection, idx, lower_cd, upper_cd, 'pending' AS status FROM mapped", *_TALLY)
def bound_restored(spark, sf_dir):
    job = _job(spark)
    job.store.init(d.RUN, runs.windows(_prepared(spark, sf_dir), job, None), NOW)
    control.apply_bound(job.store, d.RUN, NOW, NOW)
    control.restore_bound(job.store, d.RUN, NOW)
    return job.store.read().select("collection", "idx", "lower_cd", "upper_cd", "status")


@query(_LIVE)
def failed_windows_retried(spark, sf_dir):
    """Windows that failed with half of their rows live are emptied and copied again."""
    job, docs = _job(spark), _prepared(spark, sf_dir)
    done = runs.run(job, docs)
    worn = written(done.filter(~grid.is_sentinel() & (F.col("idx") % 3 == 1)))
    gone = grid.place_points(job.table.read().select("collection", "_id", "cd_ms").filter(F.xxhash64("_id") % 2 == 0), worn.select("collection", "idx", "lower_cd", "upper_cd"))
    job.table.delete_pairs(written(gone.select("collection", "_id", "cd_ms")))
    job.store.transition(d.RUN, worn.select("collection", "idx", F.lit("failed").alias("to_status"), "pod_id", "attempts", F.lit(None).cast("long").alias("lease_until")), NOW)
    control.retry_failed(job.store, job.table, d.RUN, NOW)
    runs.run(job, docs)
    return _live(job)


@query("SELECT collection, count(*) AS n, count(*) AS estimate FROM source GROUP BY 1")
def estimates_merged(spark, sf_dir):
    """Estimates are frozen at the first mapping and grow by what a top-up adds."""
    store = _job(spark).store
    sizes = {r.collection: r["count"] for r in d.source(spark, sf_dir).groupBy("collection").count().collect()}
    store.merge_estimates({c: n // 2 for c, n in sizes.items()})
    store.merge_estimates({c: 7 for c in sizes})
    merged = store.merge_estimates({c: n - n // 2 for c, n in sizes.items()}, add=True)
    return spark.createDataFrame([(c, n, merged[c]) for c, n in sizes.items()], "collection string, n long, estimate long")


@query(f"""SELECT place, name, status FROM (VALUES (0, 'documents', CASE WHEN (SELECT count(*) FROM source) > 0 THEN 'pass' ELSE 'fail' END), (1, 'layout', 'pass'), (2, 'clock', CASE WHEN (SELECT max(cd_ms) FROM source WHERE NOT no_cd) > {NOW - 60_000} THEN 'fail' ELSE 'pass' END),
    (3, 'frozen', 'fail'), (4, 'live ingest', CASE WHEN (SELECT count(*) FROM target WHERE cd_ms >= {NOW - 900_000}) > 0 THEN 'pass' ELSE 'warn' END), (5, 'no time', CASE WHEN (SELECT count(*) FROM source WHERE no_cd) > 0 THEN 'warn' ELSE 'pass' END),
    (6, 'disk', 'warn'), (7, 'canary', 'pass'), (8, 'dry run', 'fail')) t(place, name, status)""")
def preflight_checks(spark, sf_dir):
    docs = d.source(spark, sf_dir).select("collection", F.when(~F.col("no_cd"), F.col("cd_ms")).alias("at"))
    rows = d.rows(spark, sf_dir).limit(50).select("collection", *normalize.ROW_COLUMNS, "ts_ms", "cd_ms")
    twice = runs.canary(LiveTable(spark, f"{folder(spark)}/canary-{uuid.uuid4().hex}"), written(rows))
    out = preflight.checks(preflight.source_facts(docs), d.target(spark, sf_dir), NOW, frozen=False, free_share=0.15, canary=twice, dry_run=(4, 3))
    return out.select("place", "name", "status")


# Smaller operators


@query(f"SELECT a, count(*) AS n FROM (SELECT DISTINCT app AS a FROM ev) apps, (SELECT unnest([{', '.join(repr(e) for e in ident.KNOWN_EVENTS)}, 'click', 'purchase', 'signup']) AS e) WHERE e NOT IN ({', '.join(repr(e) for e in ident.EXCLUDED_EVENTS)}) GROUP BY 1")
def copied_events(spark, sf_dir):
    """Events of each application whose collections are copied at all."""
    return d.identity(spark, sf_dir).filter(ident.not_excluded(F.col("e"))).groupBy("a").agg(F.count("*").alias("n"))


@query("SELECT collection, _id AS source_id FROM source WHERE no_cd AND _id > 'ev_3' AND _id <= 'ev_8' ORDER BY _id, collection LIMIT 25")
def null_page(spark, sf_dir):
    docs = d.source(spark, sf_dir).select("collection", F.col("_id").alias("source_id"), F.when(~F.col("no_cd"), F.col("cd_ms")).alias("cd_ms"))
    return coll.null_page(docs, "ev_3", "ev_8", 25).select("collection", "source_id")


@query(f"SELECT collection, idx, status FROM chunks WHERE status IN ('pending', 'in_progress', 'written', 'attaching', 'failed') OR status = 'done' AND updated_at >= {NOW - 120_000} ORDER BY collection, idx LIMIT 500")
def chunks_active(spark, sf_dir):
    return health.active(d.chunks(spark, sf_dir), NOW).select("collection", "idx", "status")


@query("SELECT collection, idx FROM chunks WHERE status = 'failed' ORDER BY collection, idx LIMIT 200")
def chunks_failed(spark, sf_dir):
    return health.failed(d.chunks(spark, sf_dir)).select("collection", "idx")


@query("SELECT count(*) FILTER (lower_cd <> -1 AND status NOT IN ('done', 'failed', 'superseded')) AS open_windows, count(*) AS chunks FROM chunks")
def chunks_open(spark, sf_dir):
    return health.open_counts(d.chunks(spark, sf_dir))


@query(
    "SELECT position, collection, idx, is_frontier FROM slice_, at_ WHERE position >= first_ AND position < first_ + 96",
    "tape_ AS (SELECT *, row_number() OVER (ORDER BY collection, idx DESC) - 1 AS position FROM chunks)",
    "front AS (SELECT min(position) AS f FROM tape_ WHERE status NOT IN ('done', 'failed', 'superseded'))",
    "at_ AS (SELECT greatest(0, coalesce(f, (SELECT max(position) FROM tape_)) // 48 - 1) * 48 AS first_ FROM front)",
    "slice_ AS (SELECT tape_.*, position IS NOT DISTINCT FROM (SELECT f FROM front) AS is_frontier FROM tape_)",
)
def frontier_slice(spark, sf_dir):
    return reports.tape_slice(d.chunks(spark, sf_dir), rows=2).select("position", "collection", "idx", "is_frontier")


@query("SELECT DISTINCT collection, _id FROM source s WHERE EXISTS (SELECT 1 FROM dead x WHERE x.collection = s.collection AND x.source_id = s._id AND x.status IN ('pending', 'waived'))")
def unresolved_ids(spark, sf_dir):
    return dead_letters.unresolved_among(d.dead(spark, sf_dir), d.source(spark, sf_dir).select("collection", "_id").distinct())


@query("SELECT collection, source_id, min(error) AS error, 'pending' AS status FROM dead z WHERE status <> 'resolved' GROUP BY ALL HAVING NOT bool_or(EXISTS (SELECT 1 FROM dead y WHERE y.collection = z.collection AND y.source_id = z.source_id AND y.status = 'resolved'))")
def dlq_captured(spark, sf_dir):
    """Letters given twice, some of which are there already: one for each key that is new."""
    dead = d.dead(spark, sf_dir).withColumn("raw_doc", F.lit(None).cast("string")).withColumn("ts_ms", F.col("cd_ms"))
    new = dead.filter("status <> 'resolved'")
    return dead_letters.capture(new.unionByName(new), dead.filter("status = 'resolved'")).select("collection", "source_id", "error", "status")


@query("SELECT collection, source_id, CASE WHEN status = 'pending' AND reason = 'insert_rejected' THEN 'resolved' ELSE status END AS status, replay_inserted OR status = 'pending' AND reason = 'insert_rejected' AS replay_inserted FROM dead")
def dlq_resolved(spark, sf_dir):
    """A replay of refused rows: those that the target lacks go in, and their letters are resolved."""
    dead = d.dead(spark, sf_dir)
    pick = dead.filter("status = 'pending' and reason = 'insert_rejected'").select("collection", F.col("source_id").alias("_id"))
    absent, there = dead_letters.replay(d.rows(spark, sf_dir).join(pick, ["collection", "_id"], "left_semi"), d.live(spark, sf_dir))
    return dead_letters.resolve(dead, absent, there, "v2").select("collection", "source_id", "status", "replay_inserted")


@query("SELECT count(*) FILTER (status = 'pending') >= 10 AS too_many FROM dead")
def dlq_guard(spark, sf_dir):
    return spark.createDataFrame([(dead_letters.too_many(d.dead(spark, sf_dir), 10),)], "too_many boolean")


@query(
    "SELECT t AS \"at\", CASE WHEN steps >= 3 AND t - first_at >= 10000 THEN CAST(docs_done - first_done AS DOUBLE) / (t - first_at) * 1000 END AS docs_per_s FROM (SELECT t, docs_done, coalesce(sum(step) OVER w, 0) AS steps, min(t) OVER w AS first_at, min(docs_done) OVER w AS first_done FROM stepped WINDOW w AS (ORDER BY t RANGE BETWEEN 600000 PRECEDING AND CURRENT ROW))",
    f"samples AS (SELECT {NOW} + i * 4000 AS t, i // 3 * 100 AS docs_done FROM ev)",
    "stepped AS (SELECT *, CASE WHEN docs_done > lag(docs_done) OVER (ORDER BY t) THEN 1 WHEN lag(docs_done) OVER (ORDER BY t) IS NULL THEN NULL ELSE 0 END AS step FROM samples)",
)
def rate_of_progress(spark, sf_dir):
    e = d.events(spark, sf_dir).select((F.lit(NOW) + F.col("event_id") * 4000).alias("at"), (F.floor(F.col("event_id") / 3) * 100).alias("docs_done"))
    return ledger.rate_changes(e)


@query("SELECT collection, CASE WHEN read >= estimate THEN 100.0 ELSE least(99.9, floor(read / estimate * 1000 + 0.5) / 10) END AS pct FROM (SELECT collection, count(*) AS estimate, count(*) FILTER (i % 3 = 0 OR collection = 'docs') AS read FROM typed GROUP BY 1)")
def progress_by_collection(spark, sf_dir):
    ids = F.regexp_extract("_id", r"ev_(\d+)", 1).try_cast("long")
    each = d.documents(spark, sf_dir).groupBy("collection").agg(F.count("*").alias("estimate"), F.count_if(F.col("collection") == PREFIX).alias("all_"), F.count("*").alias("n"), F.count_if(F.coalesce(ids % 3 == 0, F.lit(False))).alias("third"))
    events = d.events(spark, sf_dir)
    own = F.when(F.col("event_id") % 10 == 0, F.lit(PREFIX)).otherwise(F.concat(F.lit(PREFIX), ident.event_hash(F.col("e_raw"), F.col("app"))))
    read = events.groupBy(own.alias("collection")).agg(F.count_if((F.col("event_id") % 3 == 0) | (own == PREFIX)).alias("read"))
    return each.join(read, "collection").select("collection", ledger.progress_pct(F.col("read"), F.col("estimate"), F.col("read") >= F.col("estimate")).alias("pct"))


@query("SELECT g.collection, CAST(g.idx AS INTEGER) AS idx, count(*) AS read, count(x.skip_reason) AS skipped, 0 AS refused FROM norm x JOIN grid g ON x.collection = g.collection AND x.cd_ms >= g.lower_cd AND x.cd_ms < g.upper_cd WHERE g.idx % 5 = 0 GROUP BY ALL")
def dry_run_sample(spark, sf_dir):
    docs = ident.with_defaults(d.documents(spark, sf_dir), d.identity(spark, sf_dir), PREFIX)
    return load.dry_run(docs, grid.build_grid(d.bounds(spark, sf_dir), d.TARGET_DOCS, d.MAX_DAYS), 20)


@query(f"SELECT collection, _id, cd_ms FROM live l WHERE NOT EXISTS (SELECT 1 FROM source s WHERE NOT s.no_cd AND s.cd_ms >= {NOW - DAY} AND s.cd_ms < {NOW} AND s.collection = l.collection AND s._id = l._id AND s.cd_ms = l.cd_ms)")
def source_window_purge(spark, sf_dir):
    return health.without_source_window(d.live(spark, sf_dir), d.source(spark, sf_dir), NOW - DAY, NOW).select("collection", "_id", "cd_ms")


@query("SELECT collection, _id, cd_ms FROM live l WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.no_cd AND s.collection = l.collection AND s._id = l._id AND s.cd_ms = l.cd_ms)")
def sweep_purge(spark, sf_dir):
    return health.without_sweep(d.live(spark, sf_dir), d.source(spark, sf_dir)).select("collection", "_id", "cd_ms")


@query(f"SELECT collection, _id, cd_ms FROM live WHERE NOT (cd_ms >= {NOW - 2 * DAY} AND cd_ms < {NOW} AND _id IN (SELECT _id FROM source WHERE no_cd OR c_ % 2 = 0))".replace("c_ % 2 = 0", "cd_ms % 2 = 0"))
def ids_window_purge(spark, sf_dir):
    ids = d.source(spark, sf_dir).filter("no_cd or cd_ms % 2 = 0")
    return health.without_ids(d.live(spark, sf_dir), ids, NOW - 2 * DAY, NOW).select("collection", "_id", "cd_ms")


@query("SELECT _id, cd_ms FROM source")
def zipped_pairs(spark, sf_dir):
    """Pages of ids and times, taken apart into pairs again."""
    pages = d.source(spark, sf_dir).groupBy("collection", F.pmod(F.xxhash64("_id"), F.lit(50)).alias("page")).agg(F.collect_list(F.struct("_id", "cd_ms")).alias("p"))
    return health.zipped_pairs(pages.select("page", F.col("p._id").alias("ids"), F.col("p.cd_ms").alias("cds")))


@query(f"SELECT count(*) AS n, CAST(coalesce(sum(cd_ms % 4294967296) % 4294967296, 0) AS BIGINT) AS cd_sum FROM target WHERE cd_ms >= 0 AND cd_ms < {NOW}")
def target_snapshot(spark, sf_dir):
    return health.target_snapshot(d.target(spark, sf_dir), NOW)


@query(f"SELECT count(*) AS n, count(*) > 0 AS found FROM target WHERE cd_ms >= {NOW - 900_000}")
def recent_rows(spark, sf_dir):
    rows = d.target(spark, sf_dir)
    return health.recent(rows, NOW).withColumn("found", F.lit(health.any_since(rows, NOW - 900_000)))


@query(f"SELECT t._id, t.cd_ms, count(*) AS n FROM target t WHERE EXISTS (SELECT 1 FROM good g WHERE g.ts_ms >= {NOW - 3 * DAY} AND g.ts_ms < {NOW} AND g._id = t._id AND g.cd_ms = t.cd_ms) GROUP BY ALL")
def staged_matches(spark, sf_dir):
    staged = d.rows(spark, sf_dir).filter((F.col("ts_ms") >= NOW - 3 * DAY) & (F.col("ts_ms") < NOW))
    return health.same_rows(staged, d.target(spark, sf_dir)).groupBy("_id", "cd_ms").agg(F.count("*").alias("n"))


@query("SELECT _id, CASE WHEN i % 13 = 0 THEN 'c' WHEN i % 17 = 0 THEN 'uid' WHEN i % 19 = 0 THEN 's' WHEN i % 23 = 0 THEN 'up' WHEN i % 29 = 0 THEN 'ts,cd' END AS problems FROM good WHERE i % 13 = 0 OR i % 17 = 0 OR i % 19 = 0 OR i % 23 = 0 OR i % 29 = 0")
def insert_refusals(spark, sf_dir):
    """Rows made wrong in one column: exactly they would be refused, and for that column."""
    n = F.col("num")
    only = lambda k, *before: (n % k == 0) & ~F.greatest(F.lit(False), *[n % b == 0 for b in before], F.lit(False))
    late = F.timestamp_millis(F.lit(99_999_999_999_999))
    worn = d.rows(spark, sf_dir).withColumns({
        "c": F.when(n % 13 == 0, F.lit(-1).cast("long")).otherwise(F.col("c")),
        "uid": F.when(~only(17, 13), F.col("uid")),
        "s": F.when(only(19, 13, 17), F.lit(float("nan"))).otherwise(F.col("s")),
        "up": F.when(only(23, 13, 17, 19), F.lit("[1]")).otherwise(F.col("up")),
        "ts": F.when(only(29, 13, 17, 19, 23), late).otherwise(F.col("ts")),
        "cd": F.when(only(29, 13, 17, 19, 23), late).otherwise(F.col("cd")),
    })
    return normalize.insertable(worn).filter("size(problems) > 0").select("_id", F.array_join("problems", ",").alias("problems"))


@query("SELECT collection, _id, coalesce(n_raw, CASE WHEN trim(did) <> '' THEN did END, uid, '-') AS label FROM source_rows", "source_rows AS (SELECT * FROM norm WHERE _id IS NOT NULL)")
def first_texts(spark, sf_dir):
    docs = d.documents(spark, sf_dir)
    text = lambda c: v.as_string(v.envelope(F.col(c)))
    return docs.select("collection", text("_id").alias("_id"), v.first_non_blank(text("n"), text("did"), text("uid"), F.lit("-")).alias("label")).filter("_id is not null")


@query("SELECT collection, coalesce(cd_in, 0) AS cursor_ms, count(*) AS n FROM typed GROUP BY ALL")
def cursor_times(spark, sf_dir):
    times = d.documents(spark, sf_dir).select("collection", v.cursor_millis(v.envelope(F.col("cd"))).alias("cursor_ms"))
    return times.groupBy("collection", "cursor_ms").agg(F.count("*").alias("n"))


@query("SELECT collection AS key, list_sort(list(DISTINCT month)) AS values FROM (SELECT collection, strftime(make_timestamp(ts_ms * 1000), '%Y%m') AS month FROM good) GROUP BY 1")
def months_seen(spark, sf_dir):
    return health.seen_by(d.rows(spark, sf_dir).select(F.col("collection").alias("key"), v.month_of(F.col("ts")).alias("value")))


@query("SELECT true AS same, (SELECT count(*) FROM (SELECT 1 FROM good GROUP BY _id, cd_ms)) = 0 AS empty")
def same_pair_sets(spark, sf_dir):
    rows = d.rows(spark, sf_dir)
    same = pairs.same_pairs(rows, rows.repartition(3)) and not pairs.same_pairs(rows, d.target(spark, sf_dir))
    return spark.createDataFrame([(same, rows.isEmpty())], "same boolean, empty boolean")


@query(
    f"SELECT collection, least({{n}}, greatest(10, (400 + k - 1) // k)) AS budget FROM (SELECT DISTINCT collection FROM source), (SELECT count(DISTINCT collection) AS k FROM source)".replace("{n}", "100")
)
def sample_budgets(spark, sf_dir):
    names = d.source(spark, sf_dir).select("collection").distinct()
    return names.withColumn("budget", F.lit(config.sample_budget(100, 400, names.count())).cast("long"))


@query(
    "SELECT collection, idx, count(DISTINCT _id) AS sampled FROM ranked_ r WHERE EXISTS (SELECT 1 FROM firsts_ f WHERE f.collection = r.collection AND f.idx = r.idx AND r.rank >= f.first AND r.rank < f.first + 4) GROUP BY ALL",
    "ranked_ AS (SELECT g.collection, CAST(g.idx AS INTEGER) AS idx, g.lower_cd, g.upper_cd, s._id, s.cd_ms, row_number() OVER (PARTITION BY g.collection, g.idx ORDER BY s.cd_ms, s._id) AS rank FROM source s JOIN grid g ON s.collection = g.collection AND s.cd_ms >= g.lower_cd AND s.cd_ms < g.upper_cd WHERE NOT s.no_cd)",
    "firsts_ AS (SELECT collection, idx, k, count(*) FILTER (cd_ms < lower_cd + (upper_cd - lower_cd) * k // 5) + 1 AS first FROM ranked_, unnest(range(0, 5)) t(k) GROUP BY ALL)",
)
def window_samples(spark, sf_dir):
    """Twenty ids of each window by five probes: windows hold about a hundred, so it is a sample."""
    windows = d.chunks(spark, sf_dir).filter(~grid.is_sentinel())
    return audit.window_id_sample(d.source(spark, sf_dir), windows, 20, 5).groupBy("collection", "idx").agg(F.count("*").alias("sampled"))


@query(
    """SELECT (SELECT count(*) FROM checked WHERE bad) AS verify_mismatches, (SELECT count(*) FROM dup WHERE early_copies >= 2) AS copied_duplicates, (SELECT count(*) FROM audited WHERE finding = 'mismatch') AS window_mismatches,
        (SELECT count(*) FROM compared WHERE kind = 'missing') AS content_missing, (SELECT count(*) FROM compared WHERE kind = 'different') AS content_different, (SELECT count(*) FROM compared WHERE kind <> 'excused') AS content_sampled,
        (SELECT count(*) FROM (SELECT collection FROM chunks GROUP BY 1 HAVING count(*) FILTER (status = 'done') > 0) WHERE collection NOT IN (SELECT collection FROM source)) AS unaudited, 'FAIL' AS verdict""",
    *_AUDIT,
    f"dup AS (SELECT _id, a, e, n, count(*) FILTER (cd_ms < {NOW}) AS early_copies FROM target GROUP BY strftime(make_timestamp(ts_ms * 1000), '%Y%m'), _id, a, e, n HAVING count(*) > 1)",
    *[f"{name} AS (SELECT c.collection, c.idx, count(*) AS n FROM chunks c JOIN {t} x ON x.collection = c.collection AND x.cd_ms >= c.lower_cd AND x.cd_ms < c.upper_cd WHERE c.lower_cd <> -1 {w} GROUP BY ALL)" for name, t, w in (("vl", "live", ""), ("vw", "swept", ""), ("vr", "dead", "AND x.replay_inserted AND x.status = 'resolved'"))],
    f"""checked AS (SELECT CASE WHEN c.lower_cd = -1 THEN c.rows_expected > 0 AND coalesce(a.n, 0) < c.rows_expected ELSE c.collection <> '{PREFIX}' AND coalesce(l.n, 0) - coalesce(w.n, 0) <> c.rows_expected + coalesce(r.n, 0) END AS bad
        FROM chunks c LEFT JOIN vl l USING (collection, idx) LEFT JOIN vw w USING (collection, idx) LEFT JOIN vr r USING (collection, idx) LEFT JOIN (SELECT collection, count(*) AS n FROM swept GROUP BY 1) a USING (collection) WHERE c.status = 'done')""",
    """compared AS (SELECT CASE WHEN l._id IS NOT NULL AND l.cd_ms = x.cd_ms THEN CASE WHEN l.uid <> x.uid THEN 'different' ELSE 'matched' END
        WHEN EXISTS (SELECT 1 FROM dead z WHERE z.collection = x.collection AND z.source_id = x._id AND z.status IN ('pending', 'waived')) THEN 'excused' ELSE 'missing' END AS kind
        FROM good x LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY _id ORDER BY cd_ms DESC, collection) AS place FROM live) l ON x._id = l._id AND l.place = 1 WHERE NOT x.no_cd)""",
)
def final_check(spark, sf_dir):
    """The check of everything at the end of a run, every fact of it, and its verdict."""
    from plumbline.operators import verdict
    from plumbline.plans.queries import _audited

    docs, live, dead, chunks, scopes = (f(spark, sf_dir) for f in (d.source, d.live, d.dead, d.chunks, d.scopes))
    windows = _audited(spark, sf_dir)
    facts = verdict.audit_facts(windows, audit.audit_sentinels(docs, live, dead), audit.id_coverage(docs, live, dead, windows))
    content = {r.kind: r["count"] for r in audit.content_diff(d.rows(spark, sf_dir).filter("not no_cd"), live, dead).groupBy("kind").count().collect()}
    states, letters = ({r.status: r.n for r in f.collect()} for f in (ledger.status_counts(chunks), dead_letters.by_status(dead)))
    before = pairs.source_snapshot(docs.select("collection", F.col("_id").alias("source_id"), F.when(~F.col("no_cd"), F.col("cd_ms")).alias("cd_ms"), F.col("ts_ms")))
    f = verdict.Facts(
        chunks=sum(states.values()), done=states.get("done", 0), failed=states.get("failed", 0), superseded=states.get("superseded", 0), pending_letters=letters.get("pending", 0), waived_letters=letters.get("waived", 0),
        verify_mismatches=audit.verify(docs, live, dead, chunks, scopes).filter("mismatch").count(), copied_duplicates=pairs.duplicate_groups(d.target(spark, sf_dir), NOW).filter("early_copies >= 2").count(),
        unaudited=[r.collection for r in audit.unaudited(chunks, docs).collect()], content_sampled=sum(n for k, n in content.items() if k != "excused"), content_missing=content.get("missing", 0), content_different=content.get("different", 0),
        source_moved=[r.collection for r in pairs.snapshot_changes(before, before).collect()], **facts,
    )
    found = verdict.judge(f)
    row = (f.verify_mismatches, f.copied_duplicates, windows.filter("finding = 'mismatch'").count(), f.content_missing, f.content_different, f.content_sampled, len(f.unaudited), found.verdict)
    return spark.createDataFrame([row], "verify_mismatches long, copied_duplicates long, window_mismatches long, content_missing long, content_different long, content_sampled long, unaudited long, verdict string")
