"""The ledger that persists, what an operator does to a run, settings, reports and files."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from plumbline.functions import canonical, config, index_ops
from plumbline.operators import grid, health, preflight
from plumbline.plans import control, reports, run
from plumbline.sources.collections import write_layout
from plumbline.sources.files import Store
from plumbline.sources.ledger_store import LedgerStore
from plumbline.sources.live_table import ConflictError, LiveTable
from tests.test_rules import doc, docs

NOW = 1_760_000_000_000
DAY = 86_400_000


def windows(spark, n=6, collection="c"):
    return spark.createDataFrame([(collection, i, i * 100, i * 100 + 100) for i in range(n)] + [(collection, n, -1, 0)], "collection string, idx int, lower_cd long, upper_cd long")


def test_ledger_versions(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path / "l"))
    assert store.init("r", windows(spark), NOW) and not store.init("r", windows(spark, 9), NOW)
    base = store.version()
    store.commit(base, store.read(base))
    with pytest.raises(ConflictError):
        store.commit(base, store.read(base))
    first = store.claim("r", "p1", NOW, 1000, 2)
    assert sorted((r.idx, r.status, r.attempts, r.pod_id) for r in first.collect()) == [(4, "in_progress", 1, "p1"), (5, "in_progress", 1, "p1")]
    assert store.claim("r", "p2", NOW, 1000, 9, sentinels=True).count() == 0
    events = lambda rows: spark.createDataFrame(rows, "collection string, idx int, to_status string, pod_id string, attempts int, lease_until long, docs_read long")
    store.transition("r", events([("c", 5, "done", "p1", 1, None, 7), ("c", 4, "done", "p2", 1, None, 9)]), NOW)
    now = {r.idx: (r.status, r.docs_read) for r in store.read().collect()}
    assert now[5] == ("done", 7) and now[4] == ("in_progress", 0)
    assert store.read(base).filter("status <> 'pending'").isEmpty()
    store.append("r", windows(spark, 8), NOW)
    assert sorted(r.idx for r in store.read().collect()) == [*range(9)]
    store.replace_run("r", store.read().limit(0))
    assert store.read().count() == 0


def test_documents(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path / "l"))
    assert store.set_bound_if(None, 5) and not store.set_bound_if(None, 6) and store.bound() == 5
    base = store.document("x")[0]
    assert store.put("x", {"a": 1}, base) and not store.put("x", {"a": 2}, base) and store.document("x")[1] == {"a": 1}
    assert store.first_time("start", 10) == 10 and store.first_time("start", 20) == 10
    assert store.lease("a", NOW, 100) and not store.lease("b", NOW + 50, 100) and store.lease("b", NOW + 150, 100)
    assert not store.release("a") and store.release("b") and store.lease("c", NOW, 1)
    assert store.mark_apply(NOW) and not store.mark_apply(NOW + 1) and store.apply_running(NOW + 1) and store.mark_apply(NOW + 700_000)


def test_bound_is_refused(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path / "l"))
    late = spark.createDataFrame([("c", i, NOW - (3 - i) * DAY, NOW - (2 - i) * DAY) for i in range(3)], "collection string, idx int, lower_cd long, upper_cd long")
    store.init("r", late, NOW)
    with pytest.raises(control.RefusedError, match="seconds"):
        control.apply_bound(store, "r", NOW // 1000, NOW)
    claimed = store.claim("r", "p", NOW, 1000, 1)
    store.transition("r", claimed.select("collection", "idx", F.lit("done").alias("to_status"), "pod_id", "attempts", F.lit(None).cast("long").alias("lease_until")), NOW)
    with pytest.raises(control.RefusedError, match="not pending"):
        control.apply_bound(store, "r", NOW - DAY // 2, NOW)
    assert store.bound() is None and not store.apply_running(NOW) and store.read().count() == 3


def test_bound_fences_and_restores(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path / "l"))
    late = spark.createDataFrame([("c", i, NOW - (4 - i) * DAY, NOW - (3 - i) * DAY) for i in range(4)] + [("c", 4, -1, 0)], "collection string, idx int, lower_cd long, upper_cd long")
    store.init("r", late, NOW)
    store.claim("r", "p", NOW, 1000, 1)
    bound = NOW - 5 * DAY // 2
    control.apply_bound(store, "r", bound, NOW)
    now = {r.idx: (r.status, r.upper_cd) for r in store.read().collect()}
    assert now == {0: ("pending", NOW - 3 * DAY), 1: ("pending", bound), 3: ("superseded", NOW), 4: ("pending", 0)}
    assert control.restore_bound(store, "r", NOW) and store.bound() is None
    assert {(r.idx, r.lower_cd, r.upper_cd) for r in store.read().collect()} == {(r.idx, r.lower_cd, r.upper_cd) for r in late.collect()}
    assert not control.restore_bound(store, "other", NOW)


def identity(spark):
    return spark.createDataFrame([], "hash string, a string, e string")


def test_run_stops_goes_on_and_tops_up(spark, tmp_path):
    def batch(ids, **over):
        return [doc(_id=f'"{i}"', a='"app"', e='"buy"', ts=str(NOW - 40 * DAY + 1000 * i), cd='{"$date":{"$numberLong":"%d"}}' % (NOW - 30 * DAY + DAY * i)) | over for i in ids]

    early = '{"$date":{"$numberLong":"%d"}}' % (NOW - 29 * DAY)
    given = batch(range(20)) + batch([90], cd=None) + batch([91], ts='"soon"', cd=early) + batch([92], cd=early, migrated="true")
    job = run.Job(LedgerStore(spark, str(tmp_path / "l")), LiveTable(spark, str(tmp_path / "t")), "r", "p", NOW, 5, 7, batch=2)
    prepared = lambda rows: run.prepared(docs(spark, *rows).drop("default_a", "default_e"), identity(spark), "c")
    letters, state = [], control.State()
    run.run(job, prepared(given), state=state, letters=letters, most_batches=1)
    assert job.store.read().filter("status = 'done'").count() == 2
    run.run(job, prepared(given), letters=letters)
    assert Counter(r.status for r in job.store.read().collect()) == {"done": job.store.read().count()}
    assert sorted(r._id for r in job.table.read().collect()) == sorted([*map(str, range(20)), "90"])
    assert [r.error for part in letters for r in part.collect()] == ["skip:invalid_ts"]
    more = given + batch(range(20, 25))
    run.run(job, prepared(more))
    assert job.table.read().count() == 26 and run.invariants(job, 50).isEmpty()
    job.table.delete_pairs(job.table.read().filter("_id = '3'"))
    assert [(r.live - r.rows_expected) for r in run.invariants(job, 50).collect()] == [-1]
    sums = reports.heartbeat(job.store.read(), 26, NOW)
    assert sums["pct"] == 100.0 and sums["docs_done"] == 26 and "chunks" in reports.status_text(sums)


def test_count_guard_fails_a_window(spark, tmp_path):
    rows = [doc(_id=f'"{i}"', a='"app"', e='"buy"', ts=str(NOW), cd='{"$date":{"$numberLong":"%d"}}' % (NOW - DAY + i)) for i in range(6)]
    job = run.Job(LedgerStore(spark, str(tmp_path / "l")), LiveTable(spark, str(tmp_path / "t")), "r", "p", NOW)
    all_docs = run.prepared(docs(spark, *rows).drop("default_a", "default_e"), identity(spark), "c")
    job.store.init("r", run.windows(all_docs, job, None), NOW)
    claimed = job.store.claim("r", "p", NOW, 1000, 9)
    events = run.copy_batch(job, all_docs.filter("_id <> '3'"), claimed, recount=all_docs).collect()
    assert [(e.to_status, e.docs_read, e.last_error) for e in events] == [("failed", 5, "the source holds more than was read")]


def test_state():
    s = control.State()
    s.pause("breaker-transient")
    assert not s.probe(True) and not s.probe(False) and not s.probe(True) and s.probe(True) and s.paused is None
    s.pause("breaker-data")
    assert not s.probe(True) and not s.probe(True) and s.resume()
    s.boundary_open = True
    s.pause("waiting")
    assert not s.resume()
    s.boundary_open = False
    s.fail("lost")
    assert not s.resume() and s.paused
    assert control.rebuild_refused(True, False, 0, 0, False) and control.rebuild_refused(False, False, 0, 3, False) and control.rebuild_refused(False, False, 0, 3, True) is None


def test_pressure():
    p = health.Pressure()
    assert not p.update(0, (100, 10, 1)) and not p.update(1000, (500, 300, 0))
    assert p.update(6000, (350, 10, 2)) and p.update(7000, (300, 10, 2)) and not p.update(8000, (270, 10, 2))
    assert p.update(20_000, (360, 0, 1)) and p.update(25_000, (200, 0, 0)) and not p.update(205_000, (360, 0, 1))
    assert health.Pressure().update(0, None)


def test_config():
    c = config.load({"CHUNK_DOCS_TARGET": "10", "DRY_RUN": "Yes", "UPPER_BOUND_MS": "2025-01-01T00:00:00Z", "POD_ID": "p"})
    assert (c.chunk_docs_target, c.dry_run, c.upper_bound_ms, c.pod_id, c.lease_s) == (10, True, 1735689600000, "p", 600)
    assert config.load({}).pod_id and not config.load({"BACKPRESSURE": "0"}).backpressure
    for bad in ({"RETRY_BASE_MS": "99999"}, {"RESUME_AT": "0.9"}, {"BREAKER_PCT": "101"}, {"LEASE_S": "0"}, {"UPPER_BOUND_MS": "-5"}, {"DRY_RUN_SAMPLE_PCT": "9"}):
        with pytest.raises(ValueError):
            config.load(bad)
    assert config.epoch_ms_error(NOW, "at", NOW) is None and "seconds" in config.epoch_ms_error(1_700_000_000, "at", NOW) and "future" in config.epoch_ms_error(NOW + 70_000, "at", NOW) and config.epoch_ms_error("x", "at", NOW)
    assert [config.sample_budget(500, 400, n) for n in (1, 3, 100)] == [400, 134, 10]


def test_corpus_values():
    value = {"b": {"$$t": "nan"}, "a": [{"$$t": "undef"}, {"$$t": "date", "ms": 5}], "u": {"$$t": "undef"}, "s": {"$$t": "bigstring", "c": "ab", "n": 3}, "l": {"$$t": "driverLong", "v": "9007199254740993"}, "d": {"$$t": "decimal128", "v": "1.5"}}
    assert canonical.decode(value) == {"b": {"$numberDouble": "NaN"}, "a": [None, {"$date": {"$numberLong": "5"}}], "s": "ababab", "l": 9007199254740992.0, "d": {"$numberDecimal": "1.5"}}
    with pytest.raises(ValueError):
        canonical.decode({"$$t": "other"})
    assert json.dumps(canonical.sorted_keys({"b": 1, "a": [{"d": 1, "c": 2}]})) == '{"a": [{"c": 2, "d": 1}], "b": 1}'
    assert canonical.effective_row({"_id": "x", "up": '{"b":1,"a":2}', "lu": None}) == {"_id": "x", "up": {"a": 2, "b": 1}}


def test_index_builds():
    index = [{"name": "i", "key": {"cd": 1, "_id": 1}}]
    op = lambda coll, msg="", progress=None, shard=None, db="d", keys=index: {"ns": f"{db}.x", "command": {"createIndexes": coll, "indexes": keys}, **({"msg": msg} if msg else {}), **({"progress": progress} if progress else {}), **({"shard": shard} if shard else {})}
    scan, insert = "Index Build: scanning collection", "Index Build: inserting keys from external sorter into index"
    ops = [op("a"), op("a", scan, {"done": 50, "total": 200}, "s1"), op("a", scan, {"done": 20, "total": 200}, "s2"), op("a", insert, {"done": 1, "total": 2}, "s3"), op("b", scan), op("c", "Index Build: something new: 3/9 33%", {"done": 3, "total": 0}), op("e", db="other"), op("f", keys=[{"key": {"cd": 1}}]), op("g")]
    out = {b.collection: b for b in index_ops.build_progress(ops, "d")}
    assert (out["a"].phase, out["a"].pct, out["a"].shard, out["a"].shards) == (1, 10, "s2", 3)
    assert (out["b"].phase, out["b"].label) == (2, "sorting index keys (scan complete)")
    assert (out["c"].phase, out["c"].label, out["c"].pct) == (None, "something new", None)
    assert out["g"].label == "in progress" and out.keys() == {"a", "b", "c", "g"}


def test_files(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    store.create("a/x.json", "one")
    with pytest.raises(Exception, match="exist"):
        store.create("a/x.json", "two")
    assert store.read("a/x.json") == "one" and store.names("a") == ["x.json"] and [n for n in store.names() if n.endswith(".tmp")] == []
    store.replace("a/x.json", "three")
    assert store.read("a/x.json") == "three" and store.sizes() == [("a/x.json", 5)]
    total, free = store.space()
    assert 0 < free <= total


def test_table_statistics_and_orphans(spark, tmp_path):
    table = LiveTable(spark, str(tmp_path / "t"))
    assert health.strict_count(table) is None
    good, _ = __import__("plumbline.plans.load", fromlist=["x"]).split_rows(docs(spark, *[doc(_id=f'"d{i}"', ts=str(1750000000000 + i * 40 * DAY)) for i in range(4)]))
    table.append(good)
    table.append(good.limit(1))
    table.stage(good, "left-over")
    files = health.table_files(table)
    one = health.parts(files).first()
    assert health.strict_count(table) == 5 and one.total == files.agg(F.sum("files")).first()[0] >= 5 and one.mergeable == 1
    assert table.orphans([]) == ["left-over"] and table.orphans(["left-over"]) == []
    assert {r.month: r.rows for r in table.row_counts().collect()} == {r.month: r["count"] for r in table.read().groupBy("month").count().collect()}
    assert health.disk_space(spark, [str(tmp_path)]).first().free_share > 0
    assert run.canary(LiveTable(spark, str(tmp_path / "canary")), good)


def test_layout(spark, tmp_path):
    rows = spark.range(500).select((F.hash("id") % 1000).cast("long").alias("cd_ms"), F.col("id").cast("string").alias("source_id"))
    write_layout(rows, str(tmp_path / "sorted"))
    rows.repartition(2).write.parquet(str(tmp_path / "loose"))
    assert preflight.sorted_layout(spark.read.parquet(str(tmp_path / "sorted"))) and not preflight.sorted_layout(spark.read.parquet(str(tmp_path / "loose")))


def test_pages_lose_no_letter(spark):
    from plumbline.operators import dead_letters

    dead = spark.createDataFrame([("x1", "cA"), ("x1", "cB"), ("x2", "cA")], "source_id string, collection string").withColumn("status", F.lit("pending"))
    seen, after = [], None
    while rows := dead_letters.page(dead, after, 1).collect():
        after = (rows[0].source_id, rows[0].collection)
        seen.append(after)
    assert seen == [("x1", "cA"), ("x1", "cB"), ("x2", "cA")]


def test_entry_without_the_corpus_part(monkeypatch):
    import builtins

    import __spark_entry__ as entry

    real = builtins.__import__
    monkeypatch.setattr(builtins, "__import__", lambda name, *a, **k: (_ for _ in ()).throw(ImportError(name)) if name.startswith("plumbline.llm") or name == "corpus_pipeline" else real(name, *a, **k))
    names = entry.queries()
    assert "hourly_fingerprint" in names and not any(n.startswith("op") for n in names) and entry.oracle_sql().keys() <= names.keys()


def test_points_meet_their_window(spark):
    chunks = spark.createDataFrame([("a", 0, 0, 10), ("a", 1, 10, 1000), ("b", 0, -50, 7), ("a", 2, -1, 0)], "collection string, idx int, lower_cd long, upper_cd long")
    points = spark.createDataFrame([(c, t) for c in "ab" for t in (-51, -50, -1, 0, 6, 7, 9, 10, 500, 999, 1000)], "collection string, cd_ms long")
    got = Counter((r.collection, r.cd_ms, r.idx) for r in grid.place_points(points, chunks).collect())
    want = Counter((p.collection, p.cd_ms, w.idx) for p in points.collect() for w in chunks.collect() if p.collection == w.collection and (w.lower_cd, w.upper_cd) != (-1, 0) and w.lower_cd <= p.cd_ms < w.upper_cd)
    assert got == want


def test_thousands_of_failed_windows_are_retried(spark, tmp_path):
    store, table = LedgerStore(spark, str(tmp_path / "l")), LiveTable(spark, str(tmp_path / "t"))
    n = 3000
    store.init("r", spark.range(n).selectExpr("if(id % 2 = 0, 'c', 'd') as collection", "cast(id div 2 as int) as idx", "id div 2 * 10 as lower_cd", "id div 2 * 10 + 10 as upper_cd"), NOW)
    own = store.read().withColumn("status", F.when(F.col("idx") % 5 != 0, "failed").otherwise("done"))
    store.replace_run("r", own)
    fixed = ["'[CLY]_custom' as e", "'a' as a", "'n' as n", "'u' as uid", "'' as did", "'{}' as up", "'{}' as sg", "1L as c", "0d as s", "0L as ts_ms"]
    rows = spark.range(9 * n).selectExpr("element_at(array('c', 'd', 'x'), cast(id % 3 as int) + 1) as collection", "string(id) as _id", *fixed, "timestamp_millis(0) as ts", "timestamp_millis(id div 3) as cd", "id div 3 as cd_ms")
    for c in ("uid_canon", "lsid", "custom", "cmp"):
        rows = rows.withColumn(c, F.lit(None).cast("string"))
    table.append(rows.withColumn("dur", F.lit(0.0)).withColumn("lu", F.lit(None).cast("timestamp")))
    failed = n // 5 * 4
    assert control.retry_failed(store, table, "r", NOW) == failed
    assert store.read().filter("status = 'pending'").count() == failed
    left = Counter(table.read().selectExpr("collection", "cd_ms div 10 % 5 as k").groupBy("collection", "k").count().collect())
    assert {(r.collection, r.k): r["count"] for r in left} == {**{(c, 0): 1800 for c in "cd"}, **{("x", k): 1800 for k in range(5)}}


def test_batches_grow_with_the_ledger(spark, tmp_path, monkeypatch):
    rows = [doc(_id=f'"{i}"', a='"app"', e='"buy"', ts=str(NOW - 40 * DAY), cd='{"$date":{"$numberLong":"%d"}}' % (NOW - 30 * DAY + 1000 * i)) for i in range(60)]
    job = run.Job(LedgerStore(spark, str(tmp_path / "l")), LiveTable(spark, str(tmp_path / "t")), "r", "p", NOW, 1, 7, batch=2)
    sizes, copy = [], run.copy_batch
    monkeypatch.setattr(run, "copy_batch", lambda job, docs, claimed, letters=None: sizes.append(claimed.count()) or copy(job, docs, claimed, letters))
    done = run.run(job, run.prepared(docs(spark, *rows).drop("default_a", "default_e"), identity(spark), "c"))
    assert sizes == [2, 8, 32, 18] and done.filter("status <> 'done'").isEmpty() and job.table.read().count() == 60
