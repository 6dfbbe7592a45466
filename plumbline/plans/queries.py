"""One query for each group of operators over the derived relations, each with its statement in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.functions import identity as ident
from plumbline.functions import values as v
from plumbline.functions.errors import error_class
from plumbline.operators import audit, boundary, dead_letters, grid, ledger, normalize, overlap, pairs, verdict
from plumbline.plans import derived as d
from plumbline.plans.derived import DAY, NOW, OVERLAP, PREFIX, sql
from plumbline.sources import collections as coll

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
HOUR = 3_600_000


def query(statement: str | None = None, *more: str) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if statement:
            ORACLE_SQL[f.__name__] = sql(statement, *more)
        return f

    return put


# Normalisation


@query("""SELECT a, e, n, ts_ms - ts_ms % 3600000 AS hour_ms, count(*) AS n_rows, CAST(sum(cd_ms % 4294967296) % 4294967296 AS BIGINT) AS cd_sum
    FROM good GROUP BY ALL""")
def hourly_fingerprint(spark, sf_dir):
    """The flagship: documents normalised, then counted and summed for each scope and hour."""
    good = d.normalizing(spark, sf_dir).filter("skip_reason is null")
    return good.groupBy("a", "e", "n", v.bucket(F.col("ts_ms"), HOUR).alias("hour_ms")).agg(F.count("*").alias("n_rows"), pairs.checksum(F.col("cd_ms")).alias("cd_sum"))


@query("""SELECT collection, _id, a, e, n, uid, did, strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d %H:%M:%S.%g') AS ts_text, strftime(make_timestamp(cd_ms * 1000), '%Y-%m-%d %H:%M:%S.%g') AS cd_text,
    CAST(c AS BIGINT) AS c, s, sg, up FROM good""")
def normalize_rows(spark, sf_dir):
    return d.rows(spark, sf_dir).select("collection", "_id", "a", "e", "n", "uid", "did", v.format_time(F.col("ts_ms")).alias("ts_text"), v.format_time(F.col("cd_ms")).alias("cd_text"), "c", "s", "sg", "up")


@query("""SELECT r.skip_reason, count(norm.skip_reason) AS n FROM (VALUES ('already_marked_migrated'), ('missing_a'), ('missing_e'), ('missing_uid'), ('missing__id'), ('invalid_ts'), ('transform_error')) r(skip_reason)
    LEFT JOIN norm ON norm.skip_reason = r.skip_reason GROUP BY 1""")
def normalize_skips_by_reason(spark, sf_dir):
    return normalize.skip_report(d.normalized(spark, sf_dir))


@query("SELECT coalesce(_id, '<unknown>') AS source_id, skip_reason FROM norm WHERE skip_reason IS NOT NULL ORDER BY 1, 2 LIMIT 10")
def skip_samples(spark, sf_dir):
    return normalize.skip_samples(d.normalized(spark, sf_dir))


@query("""SELECT rule, key, n FROM (
    SELECT 'clamp_uint32' AS rule, 'c' AS key, count(*) AS n FROM good WHERE i % 127 = 0 UNION ALL SELECT 'clamp_datetime', 'ts', count(*) FROM good WHERE i % 229 = 0
    UNION ALL SELECT 'stringify_int64_overflow', 'up', count(*) FROM good WHERE i % 89 = 0) WHERE n > 0""")
def normalize_coercions(spark, sf_dir):
    return normalize.coercion_report(d.normalized(spark, sf_dir)).select("rule", "key", "n")


@query("SELECT collection, e, n, count(*) AS n_rows FROM good GROUP BY ALL")
def event_name_derivation(spark, sf_dir):
    return d.rows(spark, sf_dir).groupBy("collection", "e", "n").agg(F.count("*").alias("n_rows"))


@query("SELECT collection, CASE WHEN i % 59 = 0 OR i % 227 = 0 THEN -1 WHEN i % 229 = 0 THEN 20000000000000 WHEN i % 61 = 0 THEN ms // 1000 * 1000 ELSE ms END AS ts_ms, count(*) AS n FROM typed GROUP BY ALL")
def ts_heuristics(spark, sf_dir):
    times = d.documents(spark, sf_dir).select("collection", F.coalesce(v.epoch_millis(v.envelope(F.col("ts"))), F.lit(-1)).alias("ts_ms"))
    return times.groupBy("collection", "ts_ms").agg(F.count("*").alias("n"))


@query("SELECT no_cd, count(*) AS n, CAST(sum(cd_ms % 1000003) AS BIGINT) AS residue, count(*) FILTER (cd_ms = ts_ms) AS at_ts FROM good GROUP BY no_cd")
def cd_fallback(spark, sf_dir):
    return d.rows(spark, sf_dir).groupBy("no_cd").agg(F.count("*").alias("n"), F.sum(F.col("cd_ms") % 1000003).alias("residue"), F.count_if(F.col("cd_ms") == F.col("ts_ms")).alias("at_ts"))


@query("SELECT _id FROM good WHERE FALSE")
def insertability(spark, sf_dir):
    """Normalised rows that the table would refuse: none."""
    return normalize.insertable(d.rows(spark, sf_dir)).filter(F.size("problems") > 0).select("_id")


@query()
def sanitize_json(spark, sf_dir):
    """Payloads through the JSON sanitiser, with what it changed."""
    from plumbline.functions.sanitize import sanitized

    each = d.events(spark, sf_dir).select("event_id", F.concat(F.lit('{"k":['), F.when(F.col("event_id") % 2 == 0, F.lit("NaN,5.2601586211929e19")).otherwise(F.col("event_id").cast("string")), F.lit("]}")).alias("json"))
    return each.select("event_id", sanitized(F.col("json")).alias("x")).select("event_id", "x.json", F.size("x.coercions").alias("n_coerced"))


@query(
    """SELECT event_id, CASE WHEN kind <> 2 OR e IS NULL THEN plain WHEN e > 20 THEN digits[1:1] || CASE WHEN len(digits) > 1 THEN '.' || digits[2:] ELSE '' END || 'e+' || e ELSE rpad(digits, e + 1, '0') END AS text FROM split""",
    """shown AS (SELECT i AS event_id, i % 5 AS kind, CASE i % 5 WHEN 0 THEN CAST(i AS VARCHAR) WHEN 1 THEN i || '.5' WHEN 2 THEN CAST(CAST(i AS DOUBLE) * 1e19 AS VARCHAR) WHEN 3 THEN '-' || i ELSE 'NaN' END AS plain FROM ev)""",
    "split AS (SELECT *, TRY_CAST(regexp_extract(plain, 'e[+]([0-9]+)$', 1) AS INTEGER) AS e, replace(rtrim(regexp_extract(plain, '^([0-9.]+)', 1), '.0'), '.', '') AS digits FROM shown)",
)
def number_to_text(spark, sf_dir):
    """Every event's number: whole, halves, from 1e19 to far beyond 1e21, negative, and not a number."""
    i, n = F.col("event_id").cast("double"), F.col("event_id") % 5
    number = F.when(n == 0, i).when(n == 1, i + 0.5).when(n == 2, i * 1e19).when(n == 3, -i).otherwise(F.lit(float("nan")))
    return d.events(spark, sf_dir).select("event_id", v.number_text(number).alias("text"))


# Identity


@query(f"""SELECT sha1(e || a) AS hash, a, e FROM (SELECT DISTINCT app AS a FROM ev) apps,
    (SELECT unnest([{", ".join(f"'{e}'" for e in ident.KNOWN_EVENTS)}, 'click', 'purchase', 'signup']) AS e) names""")
def identity_map_sha1(spark, sf_dir):
    return d.identity(spark, sf_dir)


@query("SELECT collection, CASE WHEN i % 10 <> 0 THEN app END AS default_a, CASE WHEN i % 10 <> 0 THEN e_raw END AS default_e, count(*) AS n FROM typed GROUP BY ALL")
def identity_default_join(spark, sf_dir):
    docs = ident.with_defaults(d.documents(spark, sf_dir).select("collection"), d.identity(spark, sf_dir), PREFIX)
    return docs.groupBy("collection", "default_a", "default_e").agg(F.count("*").alias("n"))


@query("SELECT collection, scope_a, scope_e, scope_n FROM scopes")
def scope_of_collection(spark, sf_dir):
    return d.scopes(spark, sf_dir)


@query(f"SELECT collection, row_number() OVER (ORDER BY CASE WHEN collection = '{PREFIX}' THEN 0 ELSE 1 END, collection) AS place FROM (SELECT DISTINCT collection FROM typed)")
def discover_collections(spark, sf_dir):
    return coll.discovery_order(d.documents(spark, sf_dir).select("collection"), PREFIX)


@query("SELECT hash8, n FROM (SELECT substr(sha1(app), 1, 8) AS hash8, count(*) AS n FROM ev GROUP BY 1)")
def short_hashes(spark, sf_dir):
    return d.events(spark, sf_dir).groupBy(v.short_hash(F.col("app")).alias("hash8")).agg(F.count("*").alias("n"))


# Scans


@query("""SELECT collection, min(lpad(CAST(cd_ms AS VARCHAR), 15, '0') || ':' || _id) AS first_cursor, max(lpad(CAST(cd_ms AS VARCHAR), 15, '0') || ':' || _id) AS last_cursor
    FROM source WHERE NOT no_cd GROUP BY collection""")
def cursor_minmax(spark, sf_dir):
    docs = d.source(spark, sf_dir).filter("not no_cd").withColumnRenamed("_id", "source_id")
    text = lambda c: F.concat(F.lpad(F.col(f"{c}.cd_ms").cast("string"), 15, "0"), F.lit(":"), F.col(f"{c}.source_id"))
    return coll.cursors(docs).select("collection", text("first").alias("first_cursor"), text("last").alias("last_cursor"))


@query("SELECT collection, null_cds, first_null_id, last_null_id FROM bounds")
def null_cd_bounds(spark, sf_dir):
    return d.bounds(spark, sf_dir).select("collection", "null_cds", "first_null_id", "last_null_id")


@query(f"SELECT collection, _id FROM source WHERE cd_ms >= {NOW - DAY} AND cd_ms < {NOW} AND NOT no_cd")
def window_scan(spark, sf_dir):
    return coll.window_scan(d.source(spark, sf_dir).filter("not no_cd"), NOW - DAY, NOW, ("collection", "_id"))


@query(f"SELECT collection, _id, cd_ms FROM source WHERE NOT no_cd AND (cd_ms > {NOW - DAY} OR cd_ms = {NOW - DAY} AND _id > 'ev_5') AND cd_ms < {NOW}")
def cursor_resume(spark, sf_dir):
    docs = d.source(spark, sf_dir).filter("not no_cd").withColumnRenamed("_id", "source_id")
    return coll.resume(docs, (NOW - DAY, "ev_5"), NOW).select("collection", F.col("source_id").alias("_id"), "cd_ms")


@query("SELECT collection, source_id FROM dead WHERE status = 'pending' AND (source_id, collection) > ('ev_3', 'docs5') ORDER BY source_id, collection LIMIT 50")
def keyset_page(spark, sf_dir):
    return dead_letters.page(d.dead(spark, sf_dir), ("ev_3", "docs5"), 50).select("collection", "source_id")


@query("SELECT collection, source_id FROM dead WHERE status = 'pending' ORDER BY source_id, collection LIMIT 20 OFFSET 15")
def offset_page(spark, sf_dir):
    return dead_letters.offset_page(d.dead(spark, sf_dir), 20, 15).select("collection", "source_id")


# Grid


@query("SELECT collection, CAST(idx AS INTEGER) AS idx, lower_cd, upper_cd FROM grid")
def chunk_grid(spark, sf_dir):
    return grid.build_grid(d.bounds(spark, sf_dir), d.TARGET_DOCS, d.MAX_DAYS)


@query(
    "SELECT collection, CAST(row_number() OVER (PARTITION BY collection ORDER BY lo) - 1 AS INTEGER) AS idx, CAST(lo AS BIGINT) AS lower_cd, CAST(hi AS BIGINT) AS upper_cd FROM bcut WHERE hi > lo",
    f"bb AS (SELECT collection, min(cd_ms) AS lower, max(cd_ms) AS upper, count(*) AS estimate FROM source WHERE NOT no_cd AND cd_ms < {NOW} GROUP BY collection)",
    f"bp AS (SELECT *, upper + 1 - lower AS span, greatest(1, least(50000, greatest((estimate + {d.TARGET_DOCS - 1}) // {d.TARGET_DOCS}, (upper + {d.MAX_DAYS * DAY} - lower) // {d.MAX_DAYS * DAY}))) AS k FROM bb)",
    "bcut AS (SELECT collection, lower + span * j // k AS lo, CASE WHEN j = k - 1 THEN upper + 1 ELSE lower + span * (j + 1) // k END AS hi FROM bp, unnest(range(0, k)) t(j))",
)
def chunk_grid_bounded(spark, sf_dir):
    return grid.build_grid(d.bounds(spark, sf_dir, NOW), d.TARGET_DOCS, d.MAX_DAYS)


@query("SELECT collection, idx FROM chunks WHERE lower_cd = -1")
def sentinel_chunks(spark, sf_dir):
    return d.chunks(spark, sf_dir).filter(grid.is_sentinel()).select("collection", "idx")


@query("SELECT collection, idx, row_number() OVER (ORDER BY collection, idx DESC) AS place FROM chunks WHERE status = 'pending' AND lower_cd <> -1")
def claim_order(spark, sf_dir):
    return grid.claim_order(d.chunks(spark, sf_dir)).select("collection", "idx", "place")


@query(
    "SELECT collection, idx, position - 1 AS position, position IS NOT DISTINCT FROM (SELECT min(position) FROM tape WHERE status NOT IN ('done', 'failed', 'superseded')) AS is_frontier FROM tape",
    "tape AS (SELECT *, row_number() OVER (ORDER BY collection, idx DESC) AS position FROM chunks)",
)
def frontier_tape(spark, sf_dir):
    return grid.frontier(d.chunks(spark, sf_dir)).select("collection", "idx", "position", "is_frontier")


@query("""SELECT collection, idx AS parent, CAST(j AS INTEGER) AS part, CAST(lower_cd + (upper_cd - lower_cd) * j // 4 AS BIGINT) AS lower_cd, CAST(CASE WHEN j = 3 THEN upper_cd ELSE lower_cd + (upper_cd - lower_cd) * (j + 1) // 4 END AS BIGINT) AS upper_cd
    FROM chunks, unnest(range(0, 4)) t(j) WHERE lower_cd <> -1 AND upper_cd - lower_cd > 60000 AND status = 'failed'""")
def split_subchunks(spark, sf_dir):
    return grid.split(d.chunks(spark, sf_dir).filter("status = 'failed'"))


@query(f"""SELECT collection, idx, CASE WHEN lower_cd = -1 OR upper_cd <= {NOW} THEN 'kept' WHEN status <> 'pending' THEN 'refused' WHEN lower_cd >= {NOW} THEN 'deleted' ELSE 'clamped' END AS action,
    CASE WHEN lower_cd <> -1 AND upper_cd > {NOW} AND lower_cd < {NOW} AND status = 'pending' THEN {NOW} ELSE upper_cd END AS new_upper_cd FROM chunks""")
def bound_prune(spark, sf_dir):
    return grid.prune(d.chunks(spark, sf_dir), NOW).select("collection", "idx", "action", "new_upper_cd")


@query(f"""SELECT collection, idx, CASE WHEN lower_cd = -1 OR upper_cd <= {NOW} THEN 'keep' WHEN lower_cd >= {NOW} THEN 'superseded' ELSE 'clamp' END AS fenced,
    CASE WHEN lower_cd <> -1 AND lower_cd < {NOW} AND upper_cd > {NOW} THEN {NOW} ELSE upper_cd END AS new_upper_cd FROM chunks WHERE status = 'in_progress'""")
def bound_fence(spark, sf_dir):
    return ledger.fence_claims(d.chunks(spark, sf_dir).filter("status = 'in_progress'"), NOW).select("collection", "idx", "fenced", "new_upper_cd")


@query(
    """SELECT b.collection, CAST(j + m.last + 1 AS INTEGER) AS idx, CAST(m.fin + (b.upper + 1 - m.fin) * j // k AS BIGINT) AS lower_cd, CAST(CASE WHEN j = k - 1 THEN b.upper + 1 ELSE m.fin + (b.upper + 1 - m.fin) * (j + 1) // k END AS BIGINT) AS upper_cd
    FROM bounds b JOIN m ON b.collection = m.collection, LATERAL (SELECT greatest(1, greatest((b.estimate + 99) // 100, (b.upper + 604800000 - m.fin) // 604800000)) AS k) kk, LATERAL unnest(range(0, k)) t(j) WHERE b.upper >= m.fin""",
    f"m AS (SELECT collection, max(idx) AS last, max(upper_cd) AS fin FROM chunks WHERE lower_cd <> -1 AND upper_cd <= {NOW} GROUP BY collection)",
)
def top_up_windows(spark, sf_dir):
    mapped = d.chunks(spark, sf_dir).filter(~grid.is_sentinel() & (F.col("upper_cd") <= NOW))
    return grid.top_up(mapped, d.bounds(spark, sf_dir).join(mapped.select("collection").distinct(), "collection", "left_semi"), d.TARGET_DOCS, d.MAX_DAYS)


# Fingerprints and audits

_WINDOWED = "SELECT g.collection, CAST(g.idx AS INTEGER) AS idx, count(*) AS {p}_n, CAST(sum(x.cd_ms % 4294967296) % 4294967296 AS BIGINT) AS {p}_sum FROM {t} x JOIN grid g ON x.collection = g.collection AND x.cd_ms >= g.lower_cd AND x.cd_ms < g.upper_cd {w} GROUP BY ALL"


@query(_WINDOWED.format(p="source", t="source", w="WHERE NOT x.no_cd"))
def window_fingerprint_source(spark, sf_dir):
    return audit.window_fingerprints(d.source(spark, sf_dir).filter("not no_cd"), d.chunks(spark, sf_dir), "source")


@query(_WINDOWED.format(p="live", t="live", w=""))
def window_fingerprint_live(spark, sf_dir):
    return audit.window_fingerprints(d.live(spark, sf_dir), d.chunks(spark, sf_dir), "live")


_SWEPT = "swept AS (SELECT DISTINCT l.collection, l._id, l.cd_ms FROM live l JOIN source s ON l.collection = s.collection AND l._id = s._id AND l.cd_ms = s.cd_ms AND s.no_cd)"


@query(_WINDOWED.format(p="swept", t="swept", w=""), _SWEPT)
def swept_subtraction(spark, sf_dir):
    return audit.window_fingerprints(audit.swept_rows(d.source(spark, sf_dir), d.live(spark, sf_dir)), d.chunks(spark, sf_dir), "swept")


_UNRESOLVED = """unres AS (
    SELECT g.collection, g.idx, count(DISTINCT x.source_id) AS unresolved FROM dead x JOIN grid g ON x.collection = g.collection AND x.cd_ms >= g.lower_cd AND x.cd_ms < g.upper_cd
    WHERE x.status IN ('pending', 'waived') AND NOT EXISTS (SELECT 1 FROM live l WHERE l.collection = g.collection AND l._id = x.source_id AND l.cd_ms >= g.lower_cd AND l.cd_ms < g.upper_cd) GROUP BY ALL)"""


@query("SELECT collection, CAST(idx AS INTEGER) AS idx, unresolved FROM unres", _UNRESOLVED)
def dlq_window_discount(spark, sf_dir):
    return audit.unresolved_by_window(d.dead(spark, sf_dir), d.live(spark, sf_dir), d.chunks(spark, sf_dir))


_AUDIT = (
    _SWEPT,
    _UNRESOLVED,
    "fs AS (" + _WINDOWED.format(p="source", t="source", w="WHERE NOT x.no_cd") + ")",
    "fl AS (" + _WINDOWED.format(p="live", t="live", w="") + ")",
    "fw AS (" + _WINDOWED.format(p="swept", t="swept", w="") + ")",
    f"""netted AS (
        SELECT g.collection, CAST(g.idx AS INTEGER) AS idx, g.lower_cd, g.upper_cd, g.collection <> '{PREFIX}' AS scoped, coalesce(source_n, 0) AS source, coalesce(source_sum, 0) AS source_sum,
            coalesce(live_n, 0) - coalesce(swept_n, 0) AS live, ((coalesce(live_sum, 0) - coalesce(swept_sum, 0)) % 4294967296 + 4294967296) % 4294967296 AS live_sum, coalesce(unresolved, 0) AS unresolved
        FROM grid g LEFT JOIN fs USING (collection, idx) LEFT JOIN fl USING (collection, idx) LEFT JOIN fw USING (collection, idx) LEFT JOIN unres USING (collection, idx))""",
    """audited AS (
        SELECT *, CASE WHEN NOT scoped THEN 'pending' WHEN live + unresolved = source THEN 'done' WHEN live = 0 THEN 'pending' ELSE 'failed' END AS status,
            CASE WHEN NOT scoped THEN NULL WHEN live + unresolved <> source AND live = 0 THEN NULL WHEN live + unresolved > source THEN 'deletion drift' WHEN live + unresolved < source THEN 'mismatch'
                WHEN unresolved = 0 AND live > 0 AND live_sum <> source_sum THEN 'checksum mismatch' END AS finding FROM netted)""",
)


@d.kept_once
def _audited(spark, sf_dir) -> DataFrame:
    return audit.audit_windows(d.source(spark, sf_dir), d.live(spark, sf_dir), d.dead(spark, sf_dir), d.chunks(spark, sf_dir), d.scopes(spark, sf_dir))


@query("SELECT collection, idx, source, live, unresolved, scoped, status, finding FROM audited", *_AUDIT)
def source_audit_status(spark, sf_dir):
    return _audited(spark, sf_dir).select("collection", "idx", "source", "live", "unresolved", "scoped", "status", "finding")


@query("SELECT collection, idx, source, live FROM audited WHERE finding = 'deletion drift'", *_AUDIT)
def deletion_drift(spark, sf_dir):
    return _audited(spark, sf_dir).filter("finding = 'deletion drift'").select("collection", "idx", "source", "live")


@query("SELECT collection, idx, CAST(live_sum - source_sum AS BIGINT) AS sum_delta FROM audited WHERE finding = 'checksum mismatch'", *_AUDIT)
def checksum_mismatch(spark, sf_dir):
    return _audited(spark, sf_dir).filter("finding = 'checksum mismatch'").select("collection", "idx", "sum_delta")


@query("""SELECT n.collection, count(*) AS null_cds, count(w._id) AS swept, count(*) FILTER (w._id IS NULL AND x.source_id IS NULL) AS missing
    FROM (SELECT DISTINCT collection, _id FROM source WHERE no_cd) n LEFT JOIN (SELECT DISTINCT collection, _id FROM swept) w ON n.collection = w.collection AND n._id = w._id
    LEFT JOIN (SELECT DISTINCT collection, source_id FROM dead WHERE status IN ('pending', 'waived')) x ON n.collection = x.collection AND n._id = x.source_id GROUP BY n.collection""", _SWEPT)
def sentinel_audit(spark, sf_dir):
    return audit.audit_sentinels(d.source(spark, sf_dir), d.live(spark, sf_dir), d.dead(spark, sf_dir)).select("collection", "null_cds", "swept", "missing")


@query("""SELECT c.collection, c.idx, count(DISTINCT s._id) AS sampled, count(DISTINCT s._id) FILTER (NOT EXISTS (SELECT 1 FROM live l WHERE l.collection = s.collection AND l._id = s._id AND l.cd_ms >= c.lower_cd AND l.cd_ms < c.upper_cd)
        AND NOT EXISTS (SELECT 1 FROM dead x WHERE x.collection = s.collection AND x.source_id = s._id AND x.status IN ('pending', 'waived'))) AS missing
    FROM audited c JOIN (SELECT DISTINCT collection, _id, cd_ms FROM source WHERE NOT no_cd) s ON s.collection = c.collection AND s.cd_ms >= c.lower_cd AND s.cd_ms < c.upper_cd
    WHERE c.finding = 'deletion drift' AND c.source > 0 OR c.finding IS NULL AND c.status = 'done' AND c.live > 0 AND c.idx % 25 = 0 GROUP BY c.collection, c.idx""", *_AUDIT)
def id_coverage(spark, sf_dir):
    """Windows hold fewer ids here than a sample takes, so it is all of them."""
    return audit.id_coverage(d.source(spark, sf_dir), d.live(spark, sf_dir), d.dead(spark, sf_dir), _audited(spark, sf_dir))


@query("SELECT collection, idx, lower_cd, upper_cd, status, CASE WHEN status = 'done' THEN live ELSE 0 END AS rows_expected FROM audited", *_AUDIT)
def rebuilt_ledger(spark, sf_dir):
    out = audit.rebuilt_ledger(_audited(spark, sf_dir), audit.audit_sentinels(d.source(spark, sf_dir), d.live(spark, sf_dir), d.dead(spark, sf_dir)), d.RUN)
    return out.filter(~grid.is_sentinel()).select("collection", "idx", "lower_cd", "upper_cd", "status", "rows_expected")


@query(
    f"""SELECT c.collection, c.idx, CASE WHEN c.lower_cd = -1 THEN c.rows_expected ELSE c.rows_expected + coalesce(r.n, 0) END AS expected, CASE WHEN c.lower_cd = -1 THEN coalesce(a.n, 0) ELSE coalesce(l.n, 0) - coalesce(w.n, 0) END AS live,
        CASE WHEN c.lower_cd = -1 THEN c.rows_expected > 0 ELSE c.collection <> '{PREFIX}' END AS checked
    FROM chunks c LEFT JOIN vl l USING (collection, idx) LEFT JOIN vw w USING (collection, idx) LEFT JOIN vr r USING (collection, idx) LEFT JOIN (SELECT collection, count(*) AS n FROM swept GROUP BY 1) a USING (collection) WHERE c.status = 'done'""",
    _SWEPT,
    *[f"{name} AS (SELECT c.collection, c.idx, count(*) AS n FROM chunks c JOIN {t} x ON x.collection = c.collection AND x.cd_ms >= c.lower_cd AND x.cd_ms < c.upper_cd WHERE c.lower_cd <> -1 {w} GROUP BY ALL)" for name, t, w in (("vl", "live", ""), ("vw", "swept", ""), ("vr", "dead", "AND x.replay_inserted AND x.status = 'resolved'"))],
)
def verify_chunks(spark, sf_dir):
    return audit.verify(d.source(spark, sf_dir), d.live(spark, sf_dir), d.dead(spark, sf_dir), d.chunks(spark, sf_dir), d.scopes(spark, sf_dir)).select("collection", "idx", "expected", "live", "checked")


_DUP = f"dup AS (SELECT strftime(make_timestamp(ts_ms * 1000), '%Y%m') AS month, _id, a, e, n, count(*) AS copies, count(*) FILTER (cd_ms < {NOW}) AS early_copies, min(cd_ms) AS min_cd_ms, max(cd_ms) AS max_cd_ms FROM target GROUP BY ALL HAVING count(*) > 1)"


@query("SELECT month, _id, a, e, n, copies, early_copies, min_cd_ms, max_cd_ms FROM dup", _DUP)
def duplicate_groups(spark, sf_dir):
    return pairs.duplicate_groups(d.target(spark, sf_dir), NOW)


@query("SELECT _id, a, e, n, CASE early_copies WHEN 0 THEN 'live artifact' WHEN 1 THEN 'cross-cutover retry' ELSE 'defect' END AS attribution FROM dup", _DUP)
def duplicate_attribution(spark, sf_dir):
    return pairs.duplicate_groups(d.target(spark, sf_dir), NOW).select("_id", "a", "e", "n", pairs.attribution().alias("attribution"))


@query("SELECT (SELECT count(*) FROM target) AS rows, CAST(sum(copies - 1) AS BIGINT) AS duplicates, CAST((SELECT count(*) FROM target) - sum(copies - 1) AS BIGINT) AS distinct_ids, count(*) FILTER (early_copies >= 2) AS copied_groups FROM dup", _DUP)
def duplicate_totals(spark, sf_dir):
    return pairs.duplicate_totals(d.target(spark, sf_dir), NOW)


@query("SELECT month, _id, copies, early_copies FROM (SELECT *, row_number() OVER (PARTITION BY month ORDER BY early_copies DESC, copies DESC, _id, a, e, n) AS place FROM dup) WHERE place <= 20 ORDER BY month, place LIMIT 20", _DUP)
def duplicate_sample(spark, sf_dir):
    return pairs.duplicate_sample(d.target(spark, sf_dir), NOW).select("month", "_id", "copies", "early_copies")


@query("""SELECT x.collection, x._id, CASE WHEN l._id IS NOT NULL AND l.cd_ms = x.cd_ms THEN CASE WHEN l.uid <> x.uid THEN 'different' ELSE 'matched' END
        WHEN EXISTS (SELECT 1 FROM dead z WHERE z.collection = x.collection AND z.source_id = x._id AND z.status IN ('pending', 'waived')) THEN 'excused' ELSE 'missing' END AS kind,
        CASE WHEN l.cd_ms = x.cd_ms AND l.uid <> x.uid THEN 'uid' END AS fields
    FROM good x LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY _id ORDER BY cd_ms DESC, collection) AS place FROM live) l ON x._id = l._id AND l.place = 1 WHERE NOT x.no_cd""")
def content_diff(spark, sf_dir):
    """All rows with a cd of their own, against the target and the dead letters."""
    return audit.content_diff(d.rows(spark, sf_dir).filter(~F.col("no_cd")), d.live(spark, sf_dir), d.dead(spark, sf_dir))


@query(
    """SELECT r.collection, r._id FROM ranked r WHERE EXISTS (SELECT 1 FROM probes p WHERE p.collection = r.collection AND r.rank >= p.first AND r.rank < p.first + 25)""",
    "own AS (SELECT collection, _id, cd_ms FROM source WHERE NOT no_cd)",
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY collection ORDER BY cd_ms, _id) AS rank FROM own)",
    "span AS (SELECT collection, min(cd_ms) AS lo, max(cd_ms) AS hi FROM own GROUP BY 1)",
    "pts AS (SELECT collection, lo + CAST(floor((k + 0.5) / 4 * (hi - lo)) AS BIGINT) AS mark FROM span, unnest(range(0, 4)) t(k))",
    "probes AS (SELECT a.collection, a.mark, count(o._id) + 1 AS first FROM pts a LEFT JOIN own o ON o.collection = a.collection AND o.cd_ms < a.mark GROUP BY ALL)",
)
def probe_sample(spark, sf_dir):
    return audit.content_sample(d.source(spark, sf_dir), 100).select("collection", "_id")


@query("SELECT DISTINCT collection FROM chunks WHERE status = 'done' AND collection <> 'docs' AND substr(collection, 5) IN (SELECT sha1(e_raw || app) FROM ev WHERE e_raw = '[CLY]_view')")
def coverage_reconciliation(spark, sf_dir):
    chunks, names = d.chunks(spark, sf_dir), ident.with_defaults(d.chunks(spark, sf_dir).select("collection").distinct(), d.identity(spark, sf_dir), PREFIX)
    return audit.unaudited(chunks, names.filter("default_e is null or default_e <> '[CLY]_view'").select("collection"))


@query("SELECT collection, CASE WHEN old_n IS NULL THEN 'added' WHEN new_n IS NULL THEN 'removed' WHEN new_max > old_max THEN 'grew' ELSE 'moved' END AS change FROM both_ WHERE old_n IS DISTINCT FROM new_n OR old_max IS DISTINCT FROM new_max",
    f"both_ AS (SELECT collection, sum(o) AS old_n, sum(w) AS new_n, max(cd_ms) FILTER (o = 1 AND NOT no_cd) AS old_max, max(cd_ms) FILTER (w = 1 AND NOT no_cd) AS new_max FROM (SELECT collection, no_cd, cd_ms, CASE WHEN cd_ms < {NOW} THEN 1 END AS o, CASE WHEN _id <> 'ev_8' THEN 1 END AS w FROM source) GROUP BY collection)")
def source_snapshot_diff(spark, sf_dir):
    docs = d.source(spark, sf_dir).select("collection", F.col("_id").alias("source_id"), F.when(~F.col("no_cd"), F.col("cd_ms")).alias("cd_ms"), F.when(F.col("no_cd"), F.col("cd_ms")).alias("ts_ms"))
    before = docs.filter(F.coalesce("cd_ms", "ts_ms") < NOW)
    return pairs.snapshot_changes(pairs.source_snapshot(before), pairs.source_snapshot(docs.filter("source_id <> 'ev_8'")))


# Pairs


@query("SELECT DISTINCT t._id, t.cd_ms FROM target t JOIN good g ON t._id = g._id AND t.cd_ms = g.cd_ms")
def pair_semi_join(spark, sf_dir):
    return pairs.live_pairs(d.target(spark, sf_dir), d.rows(spark, sf_dir))


@query("SELECT g._id, g.cd_ms FROM good g WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t._id = g._id AND t.cd_ms = g.cd_ms)")
def pair_anti_join(spark, sf_dir):
    return pairs.absent(d.rows(spark, sf_dir), d.target(spark, sf_dir)).select("_id", "cd_ms")


@query("SELECT l.collection, count(*) AS n FROM live l JOIN (SELECT DISTINCT collection, _id, cd_ms FROM good) g ON l.collection = g.collection AND l._id = g._id AND l.cd_ms = g.cd_ms GROUP BY 1")
def pair_match_count(spark, sf_dir):
    return pairs.matching_rows(d.live(spark, sf_dir), d.rows(spark, sf_dir), ["collection", "_id", "cd_ms"]).groupBy("collection").agg(F.count("*").alias("n"))


@query("SELECT _id, max(cd_ms) AS cd_ms FROM target WHERE _id IN (SELECT _id FROM good) GROUP BY _id")
def live_cd_by_ids(spark, sf_dir):
    return pairs.cds_by_id(d.target(spark, sf_dir), d.rows(spark, sf_dir))


@query(f"SELECT collection, count(DISTINCT _id) AS ids, count(*) AS n FROM live WHERE cd_ms >= {NOW - DAY} AND cd_ms < {NOW} AND _id IN (SELECT _id FROM good) GROUP BY 1")
def distinct_ids_in_window(spark, sf_dir):
    inside = pairs.matching_rows(d.live(spark, sf_dir).filter(pairs.in_window(F.col("cd_ms"), NOW - DAY, NOW)), d.rows(spark, sf_dir), ["_id"])
    return inside.groupBy("collection").agg(F.count_distinct("_id").alias("ids"), F.count("*").alias("n"))


@query(f"SELECT cd_ms - cd_ms % 3600000 AS bucket_ms, count(*) AS n FROM target WHERE _id IN (SELECT _id FROM source WHERE no_cd) AND cd_ms >= {OVERLAP[0]} AND cd_ms < {OVERLAP[1]} GROUP BY 1")
def rows_by_hour_for_ids(spark, sf_dir):
    picked = pairs.matching_rows(d.target(spark, sf_dir), d.source(spark, sf_dir).filter("no_cd"), ["_id"])
    return pairs.per_bucket(picked, HOUR, low=OVERLAP[0], high=OVERLAP[1])


@query(f"SELECT _id, cd_ms FROM target WHERE NOT (cd_ms >= {NOW - DAY} AND cd_ms < {NOW})")
def window_purge(spark, sf_dir):
    return pairs.without_window(d.target(spark, sf_dir), NOW - DAY, NOW).select("_id", "cd_ms")


# Rates, boundary, overlap


@query(f"SELECT cd_ms - cd_ms % 60000 AS bucket_ms, count(*) AS n FROM source WHERE NOT no_cd AND cd_ms >= {NOW - DAY} AND cd_ms < {NOW} GROUP BY 1")
def rate_curve_minute(spark, sf_dir):
    return pairs.per_bucket(d.source(spark, sf_dir).filter("not no_cd"), 60_000, low=NOW - DAY, high=NOW)


@query("SELECT cd_ms - cd_ms % 3600000 AS bucket_ms, count(*) AS n FROM target GROUP BY 1")
def rate_curve_hour(spark, sf_dir):
    return pairs.per_bucket(d.target(spark, sf_dir), HOUR)


@query(
    """SELECT bucket_ms, old, new, CASE WHEN greatest(old, new) = 0 THEN 0.0 ELSE floor(abs(old - new) / greatest(old, new) * 1000 + 0.5) / 10 END AS drift_pct,
        greatest(old, new) >= 100 AND CASE WHEN greatest(old, new) = 0 THEN 0.0 ELSE floor(abs(old - new) / greatest(old, new) * 1000 + 0.5) / 10 END > 3 AS flagged FROM curves""",
    f"cal AS (SELECT unnest(range({NOW - 72 * HOUR}, {NOW}, {HOUR})) AS bucket_ms)",
    f"oc AS (SELECT cd_ms - cd_ms % {HOUR} AS bucket_ms, count(*) AS old FROM source WHERE NOT no_cd AND cd_ms >= {NOW - 72 * HOUR} AND cd_ms < {NOW} GROUP BY 1)",
    f"nc AS (SELECT cd_ms - cd_ms % {HOUR} AS bucket_ms, count(*) AS new FROM target WHERE cd_ms >= {NOW - 72 * HOUR} AND cd_ms < {NOW} GROUP BY 1)",
    "curves AS (SELECT cal.bucket_ms, coalesce(old, 0) AS old, coalesce(new, 0) AS new FROM cal LEFT JOIN oc USING (bucket_ms) LEFT JOIN nc USING (bucket_ms))",
)
def parity_hours(spark, sf_dir):
    return boundary.parity(d.source(spark, sf_dir).filter("not no_cd").select("cd_ms"), d.target(spark, sf_dir).select("cd_ms"), 0, NOW)


#: A seam for boundary detection: old traffic up to three minutes before NOW, new traffic from NOW on.
_SEAM = (
    f"old_ AS (SELECT cd_ms FROM source WHERE NOT no_cd AND cd_ms < {NOW - 180_000})",
    f"new_ AS (SELECT cd_ms FROM target WHERE cd_ms >= {NOW})",
    "anchor AS (SELECT min(cd_ms) AS anchor FROM new_)",
    "mins AS (SELECT unnest(range((anchor - 1800000) - (anchor - 1800000) % 60000, anchor + 1800000, 60000)) AS m, anchor FROM anchor)",
    "curve AS (SELECT m, anchor, (SELECT count(*) FROM old_ WHERE cd_ms - cd_ms % 60000 = m AND cd_ms >= anchor - 1800000) AS old, (SELECT count(*) FROM new_ WHERE cd_ms - cd_ms % 60000 = m AND cd_ms < anchor + 1800000) AS new FROM mins)",
    """silent AS (SELECT *, old = 0 AND new = 0 AS quiet, sum(CASE WHEN old + new > 0 THEN 1 ELSE 0 END) OVER (ORDER BY m) AS run, coalesce(sum(old) OVER (ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) > 0
        AND coalesce(sum(new) OVER (ORDER BY m ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) > 0 AND row_number() OVER (ORDER BY m) > 1 AND lead(m) OVER (ORDER BY m) IS NOT NULL AS opens FROM curve)""",
)


def _seam(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    old = d.source(spark, sf_dir).filter(~F.col("no_cd") & (F.col("cd_ms") < NOW - 180_000)).select("cd_ms")
    return old, d.target(spark, sf_dir).filter(F.col("cd_ms") >= NOW).select("cd_ms")


@query("SELECT min(m) FILTER (opens) AS from_ms, max(m) + 60000 AS to_ms FROM silent WHERE quiet GROUP BY run HAVING min(m) FILTER (opens) IS NOT NULL ORDER BY 1 LIMIT 1", *_SEAM)
def boundary_gap(spark, sf_dir):
    old, new = _seam(spark, sf_dir)
    anchor = new.agg(F.min("cd_ms")).first()[0]
    return boundary.first_gap(boundary.dense_curves(old, new, anchor - 30 * 60_000, anchor + 30 * 60_000, 60_000))


@query("SELECT max(anchor) AS anchor, CAST(coalesce(sum(old) FILTER (abs(m - anchor) <= 120000), 0) AS BIGINT) AS ambiguous, count(*) AS minutes FROM curve", *_SEAM)
def boundary_anchor_ambiguity(spark, sf_dir):
    old, new = _seam(spark, sf_dir)
    report = boundary.detect(old, new, NOW)
    near = sum(m["old"] for m in report["minutes"] if abs(m["bucket_ms"] - report["anchor"]) <= boundary.AMBIGUOUS_MS)
    return spark.createDataFrame([(report["anchor"], near, len(report["minutes"]))], "anchor long, ambiguous long, minutes long")


_EVIDENCE = (
    f"src AS (SELECT collection, _id, cd_ms, cd_ms - cd_ms % {HOUR} AS bucket_ms FROM source WHERE NOT no_cd AND cd_ms >= {OVERLAP[0]} AND cd_ms < {OVERLAP[1]})",
    f"inside AS (SELECT *, cd_ms - cd_ms % {HOUR} AS bucket_ms FROM live WHERE cd_ms >= {OVERLAP[0]} AND cd_ms < {OVERLAP[1]})",
    "iw AS (SELECT collection, bucket_ms, count(*) AS in_window FROM src GROUP BY 1, 2)",
    "mt AS (SELECT collection, bucket_ms, count(*) AS matched FROM inside i WHERE EXISTS (SELECT 1 FROM src s WHERE s.collection = i.collection AND s._id = i._id AND s.cd_ms = i.cd_ms) GROUP BY 1, 2)",
    "tt AS (SELECT collection, bucket_ms, count(*) AS total FROM inside GROUP BY 1, 2)",
    "sw AS (SELECT collection, bucket_ms, count(*) AS sweep FROM inside i WHERE EXISTS (SELECT 1 FROM source s WHERE s.no_cd AND s.collection = i.collection AND s._id = i._id) GROUP BY 1, 2)",
    f"raw_ AS (SELECT collection, bucket_ms, in_window, coalesce(matched, 0) AS matched, CASE WHEN collection = '{PREFIX}' THEN -1 ELSE coalesce(total, 0) - coalesce(matched, 0) - coalesce(sweep, 0) END AS native FROM iw LEFT JOIN mt USING (collection, bucket_ms) LEFT JOIN tt USING (collection, bucket_ms) LEFT JOIN sw USING (collection, bucket_ms))",
    f"evidence AS (SELECT *, CASE WHEN matched = 0 THEN NULL WHEN collection = '{PREFIX}' THEN 'no-scope' WHEN native < matched - ceil(matched * 0.05) OR native <= 0 THEN 'no-native-evidence' ELSE 'safe' END AS verdict FROM raw_)",
)


def _evidence(spark, sf_dir) -> DataFrame:
    return overlap.bucket_evidence(d.source(spark, sf_dir), d.live(spark, sf_dir), d.scopes(spark, sf_dir), *OVERLAP, slack_pct=9)


@query("SELECT collection, bucket_ms, in_window, matched, native, verdict FROM evidence", *_EVIDENCE)
def dedupe_bucket_evidence(spark, sf_dir):
    return _evidence(spark, sf_dir)


@query("SELECT l.collection, l._id, l.cd_ms FROM live l WHERE NOT EXISTS (SELECT 1 FROM src s JOIN evidence v ON v.collection = s.collection AND v.bucket_ms = s.bucket_ms AND v.verdict = 'safe' WHERE s.collection = l.collection AND s._id = l._id AND s.cd_ms = l.cd_ms)", *_EVIDENCE)
def dedupe_survivors(spark, sf_dir):
    gone = overlap.deletable(d.source(spark, sf_dir), d.live(spark, sf_dir), _evidence(spark, sf_dir), *OVERLAP)
    return overlap.survivors(d.live(spark, sf_dir), gone).select("collection", "_id", "cd_ms")


@query("SELECT CAST(sum(in_window) AS BIGINT) AS in_window, CAST(sum(matched) AS BIGINT) AS matched, CAST(coalesce(sum(matched) FILTER (verdict = 'safe'), 0) AS BIGINT) AS deleted, CAST(coalesce(sum(matched) FILTER (verdict <> 'safe'), 0) AS BIGINT) AS unsafe FROM evidence", *_EVIDENCE)
def dedupe_totals(spark, sf_dir):
    return overlap.totals(_evidence(spark, sf_dir), execute=True)


# Dead letters


@query("SELECT error, count(*) AS n FROM dead WHERE status = 'pending' GROUP BY 1 ORDER BY n DESC, error LIMIT 3")
def dlq_top_errors(spark, sf_dir):
    return dead_letters.top_errors(d.dead(spark, sf_dir), 3)


@query("SELECT status, count(*) AS n FROM dead GROUP BY 1")
def dlq_by_status(spark, sf_dir):
    return dead_letters.by_status(d.dead(spark, sf_dir))


@query("SELECT status, count(*) AS n FROM (SELECT CASE WHEN status = 'pending' AND source_id < 'ev_5' THEN 'waived' ELSE status END AS status FROM dead) GROUP BY 1")
def dlq_waive(spark, sf_dir):
    dead = d.dead(spark, sf_dir)
    return dead_letters.by_status(dead_letters.waive(dead, dead.filter("source_id < 'ev_5'")))


@query("SELECT collection, _id, cd_ms FROM good g WHERE NOT EXISTS (SELECT 1 FROM live l WHERE l.collection = g.collection AND l._id = g._id AND l.cd_ms = g.cd_ms)")
def dlq_replay_absent(spark, sf_dir):
    return dead_letters.replay(d.rows(spark, sf_dir), d.live(spark, sf_dir))[0].select("collection", "_id", "cd_ms")


# Ledger


@query("""SELECT collection, count(*) AS chunks, count(*) FILTER (status = 'done') AS done, CAST(coalesce(sum(rows_expected) FILTER (status = 'done'), 0) AS BIGINT) AS docs_done, CAST(coalesce(sum(docs_read) FILTER (status = 'done'), 0) AS BIGINT) AS docs_read,
    CAST(coalesce(sum(rows_expected) FILTER (status IN ('pending', 'in_progress', 'written', 'attaching', 'failed')), 0) AS BIGINT) AS open_rows, CAST(sum(docs_skipped) AS BIGINT) AS docs_skipped FROM chunks GROUP BY ROLLUP (collection)""")
def run_summary(spark, sf_dir):
    return ledger.summary(d.chunks(spark, sf_dir))


@query("SELECT status, count(*) AS n FROM chunks GROUP BY 1")
def status_counts(spark, sf_dir):
    return ledger.status_counts(d.chunks(spark, sf_dir))


@query("SELECT count(*) || ':' || count(*) FILTER (status = 'done') || ':' || max(updated_at) AS fingerprint FROM chunks")
def run_fingerprint(spark, sf_dir):
    return ledger.fingerprint(d.chunks(spark, sf_dir))


@query("SELECT pod_id, count(*) FILTER (status = 'done') AS done, count(*) FILTER (status <> 'done') AS active, max(updated_at) AS last_seen FROM chunks WHERE pod_id IS NOT NULL GROUP BY 1")
def pod_activity(spark, sf_dir):
    return ledger.pod_activity(d.chunks(spark, sf_dir))


@query(f"SELECT pod_id, count(*) AS n FROM chunks WHERE status IN ('in_progress', 'written', 'attaching') AND lease_until > {NOW} AND pod_id <> 'pod1' GROUP BY 1")
def active_claims(spark, sf_dir):
    return ledger.active_claims(d.chunks(spark, sf_dir), NOW, "pod1")


@query(f"SELECT coalesce(sum(docs_read), 0) / 120 AS docs_per_s, count(DISTINCT pod_id) AS pods FROM chunks WHERE status = 'done' AND updated_at >= {NOW - 120_000}")
def cluster_rate(spark, sf_dir):
    return ledger.cluster_rate(d.chunks(spark, sf_dir), NOW, 120)


@query("SELECT collection, max(idx) AS max_idx, coalesce(max(upper_cd) FILTER (lower_cd <> -1), 0) AS max_upper_cd FROM chunks GROUP BY 1")
def regular_high_water(spark, sf_dir):
    return ledger.high_water(d.chunks(spark, sf_dir))


@query(f"SELECT collection, idx, status, CASE WHEN status = 'attaching' THEN 'finish promotion' WHEN status = 'written' AND idx % 2 = 0 THEN 'promote' ELSE 'drop staging and redo' END AS action FROM chunks WHERE status IN ('in_progress', 'written', 'attaching') AND lease_until <= {NOW}")
def recovery_actions(spark, sf_dir):
    staged = d.chunks(spark, sf_dir).withColumn("staged", F.when(F.col("idx") % 2 == 0, F.col("rows_expected")).otherwise(F.col("rows_expected") + 1))
    return ledger.recovery_actions(staged, NOW)


@query("SELECT collection, idx, CASE WHEN attempts <= 3 THEN 'redo' WHEN lower_cd <> -1 AND upper_cd - lower_cd > 60000 THEN 'split' ELSE 'quarantine' END AS next FROM chunks WHERE status = 'failed'")
def failure_routing(spark, sf_dir):
    return ledger.after_failure(d.chunks(spark, sf_dir).filter("status = 'failed'")).select("collection", "idx", "next")


@query("SELECT c.collection, c.idx, c.docs_read, coalesce(b.bad, 0) AS bad, coalesce(b.bad, 0) / c.docs_read AS rate FROM chunks c LEFT JOIN (SELECT collection, idx, idx % 40 AS bad FROM chunks WHERE idx % 40 > 0) b ON b.collection = c.collection AND b.idx = c.idx WHERE c.docs_read > 1000")
def fail_rate(spark, sf_dir):
    bad = d.chunks(spark, sf_dir).select("collection", F.col("idx").alias("chunk_idx"), F.explode(F.sequence(F.lit(1), F.col("idx") % 40)).alias("k"), F.lit("insert_rejected").alias("reason")).filter("chunk_idx % 40 > 0")
    return ledger.fail_rate(d.chunks(spark, sf_dir), bad)


@query("SELECT collection, idx, CASE WHEN docs_read < docs_read + idx % 3 - 1 THEN 'failed' WHEN docs_read > docs_read + idx % 3 - 1 THEN 'shrank' ELSE 'equal' END AS guard FROM chunks WHERE status = 'done'")
def source_count_guard(spark, sf_dir):
    done = d.chunks(spark, sf_dir).filter("status = 'done'").withColumn("source", F.col("docs_read") + F.col("idx") % 3 - 1)
    return ledger.source_count_guard(done).select("collection", "idx", "guard")


@query(
    """SELECT collection, n_left AS chunks_left, CAST(round(n_left * coalesce(rd / nullif(n, 0), sum(rd) OVER () / sum(n) OVER (), 0)) AS BIGINT) AS docs_left FROM e""",
    "e AS (SELECT collection, count(*) FILTER (status NOT IN ('done', 'failed', 'superseded')) AS n_left, sum(docs_read) FILTER (status = 'done') AS rd, count(*) FILTER (status = 'done') AS n FROM chunks WHERE lower_cd <> -1 GROUP BY 1)",
)
def eta_per_collection(spark, sf_dir):
    return ledger.eta(d.chunks(spark, sf_dir), 50.0).select("collection", "chunks_left", "docs_left")


@query(f"SELECT collection, idx, CASE WHEN status = 'pending' THEN 'in_progress' WHEN status = 'in_progress' AND lease_until <= {NOW} THEN 'pending' ELSE status END AS status, CASE WHEN status = 'pending' THEN attempts + 1 ELSE attempts END AS attempts FROM chunks")
def ledger_events(spark, sf_dir):
    """Every pending chunk is claimed, every other active one is given back; only what its fence allows happens."""
    chunks = d.chunks(spark, sf_dir)
    to = F.when(F.col("status") == "pending", "in_progress").when(F.col("status") == "in_progress", "pending").otherwise("done")
    events = chunks.filter("status <> 'attaching'").select("collection", "idx", to.alias("to_status"), F.lit("pod9").alias("pod_id"), F.col("attempts"), F.lit(NOW + 600_000).alias("lease_until"))
    return ledger.apply_events(chunks, events, NOW).select("collection", "idx", "status", "attempts")


@query("SELECT i AS seq, CASE WHEN i % 7 = 0 THEN 'permanent' WHEN i % 7 = 1 THEN 'transient' WHEN i % 7 = 2 THEN 'permanent' ELSE 'transient' END AS error_class FROM ev")
def error_classes(spark, sf_dir):
    n = F.col("event_id") % 7
    code = F.when(n == 0, "27").when(n == 1, "ECONNRESET").when(n == 3, "243")
    said = F.when(n == 2, "Do not know how to serialize a BigInt").when(n == 1, "circular structure")
    return d.events(spark, sf_dir).select(F.col("event_id").alias("seq"), error_class(code, said).alias("error_class"))


@query(
    """SELECT seq, CASE WHEN ok THEN 0 ELSE row_number() OVER (PARTITION BY run ORDER BY seq) END AS streak, CASE WHEN NOT ok AND row_number() OVER (PARTITION BY run ORDER BY seq) >= 3 THEN CASE kind WHEN 'permanent' THEN 'breaker-data' ELSE 'breaker-transient' END END AS pause FROM runs_""",
    "outc AS (SELECT i AS seq, i % 10 < 4 AS ok, CASE WHEN i % 10 < 4 THEN 'ok' WHEN i % 20 < 10 THEN 'permanent' ELSE 'transient' END AS kind FROM ev)",
    "runs_ AS (SELECT *, sum(fresh) OVER (ORDER BY seq) AS run FROM (SELECT *, CASE WHEN kind IS NOT DISTINCT FROM lag(kind) OVER (ORDER BY seq) THEN 0 ELSE 1 END AS fresh FROM outc))",
)
def failure_breaker(spark, sf_dir):
    n = F.col("event_id")
    outcomes = d.events(spark, sf_dir).select(n.alias("seq"), (n % 10 < 4).alias("ok"), F.when(n % 20 < 10, "permanent").otherwise("transient").alias("error_class"))
    return ledger.breaker(outcomes).select("seq", "streak", "pause")


# Verdict


@query("""SELECT CASE WHEN (SELECT count(*) FROM chunks WHERE status = 'failed') + (SELECT count(*) FROM dead WHERE status = 'pending') + (SELECT count(*) FROM audited WHERE finding IN ('mismatch', 'checksum mismatch')) > 0 THEN 'FAIL' ELSE 'PASS' END AS verdict,
    (SELECT count(*) FROM audited WHERE finding = 'mismatch') + (SELECT count(*) FROM sent WHERE missing > 0 AND swept > 0) AS mismatches, (SELECT count(*) FROM audited WHERE finding = 'checksum mismatch') AS checksums, (SELECT count(*) FROM audited WHERE finding = 'deletion drift') AS drifts""",
    *_AUDIT,
    """sent AS (SELECT n.collection, count(w._id) AS swept, count(*) FILTER (w._id IS NULL AND x.source_id IS NULL) AS missing FROM (SELECT DISTINCT collection, _id FROM source WHERE no_cd) n LEFT JOIN (SELECT DISTINCT collection, _id FROM swept) w ON n.collection = w.collection AND n._id = w._id
        LEFT JOIN (SELECT DISTINCT collection, source_id FROM dead WHERE status IN ('pending', 'waived')) x ON n.collection = x.collection AND n._id = x.source_id GROUP BY n.collection)""")
def final_verdict(spark, sf_dir):
    windows = _audited(spark, sf_dir)
    sentinels = audit.audit_sentinels(d.source(spark, sf_dir), d.live(spark, sf_dir), d.dead(spark, sf_dir))
    coverage = audit.id_coverage(d.source(spark, sf_dir), d.live(spark, sf_dir), d.dead(spark, sf_dir), windows)
    found = verdict.audit_facts(windows, sentinels, coverage)
    counts = {r.status: r.n for r in ledger.status_counts(d.chunks(spark, sf_dir)).collect()}
    letters = {r.status: r.n for r in dead_letters.by_status(d.dead(spark, sf_dir)).collect()}
    facts = verdict.Facts(chunks=sum(counts.values()), done=counts.get("done", 0), failed=counts.get("failed", 0), pending_letters=letters.get("pending", 0), waived_letters=letters.get("waived", 0), **found)
    return spark.createDataFrame([(verdict.judge(facts).verdict, facts.mismatches, facts.checksum_mismatches, facts.drift_windows)], "verdict string, mismatches long, checksums long, drifts long")


@query("SELECT start, collection, n FROM (SELECT time_bucket(INTERVAL 1 DAY, ts::TIMESTAMP, TIMESTAMP '1970-01-01') AS start, event_type AS collection, count(*) AS n FROM events GROUP BY ALL) WHERE start + INTERVAL 1 DAY <= (SELECT max(ts)::TIMESTAMP - INTERVAL 10 MINUTE FROM events)")
def streaming_arrivals(spark, sf_dir):
    """Documents as a stream through event-time windows of a day; the watermark closes them, and what it closed is written to files."""
    import uuid

    from plumbline.sources.shared import folder
    from plumbline.streaming.topup import arrivals_to

    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")
    docs = stream.select(F.col("ts").cast("timestamp").alias("cd"), F.col("event_type").alias("collection"))
    path = f"{folder(spark)}/arrivals-{uuid.uuid4().hex}"
    arrivals_to(docs, f"{path}/out", f"{path}/checkpoint", "10 minutes", "1 day").awaitTermination()
    return spark.read.parquet(f"{path}/out").select("start", "collection", F.col("count").alias("n"))


@query("SELECT collection, sum(n) OVER (ORDER BY collection) AS upto FROM (SELECT collection, count(*) AS n FROM source GROUP BY 1)")
def estimates_upto(spark, sf_dir):
    """Frozen estimates of the collections and their running total."""
    sizes = d.source(spark, sf_dir).groupBy("collection").agg(F.count("*").alias("n"))
    return sizes.select("collection", F.sum("n").over(Window.orderBy("collection")).alias("upto"))


from plumbline.plans import run_queries  # noqa: E402, F401  registers its queries
