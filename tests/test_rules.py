"""Rules with fixed expectations: values, normalisation, grid, boundary, loading, verdict."""

import json

import pytest
from pyspark.sql import functions as F

from plumbline.functions import errors, sanitize
from plumbline.functions import values as v
from plumbline.operators import boundary, grid, normalize, pairs, verdict
from plumbline.plans import load
from plumbline.schema import DOCUMENT, TEXT_FIELDS
from plumbline.sources.collections import discover
from plumbline.sources.live_table import LiveTable


def docs(spark, *given, a="app1", e="purchase"):
    rows = [("c1", *[g.get(f) for f in TEXT_FIELDS], a, e) for g in given]
    return spark.createDataFrame(rows, f"{DOCUMENT}, default_a string, default_e string")


def doc(**over):
    return {"_id": '"x1"', "uid": '"u1"', "ts": "1750000000000"} | over


def test_normalize_cases(spark):
    cases = [
        doc(),
        doc(_id='"x2"', ts="1750000000"),
        doc(_id='"x3"', e='"[CLY]_view"', sg='{"name":"/cart"}'),
        doc(_id='"x4"', a='"own"', e='"[CLY]_crash"', n='"prenamed"'),
        doc(_id='"x5"', c="99999999999"),
        doc(_id="42.0", ts='" 0x1979FA4F400 "', cd='{"$date":{"$numberLong":"5"}}'),
        doc(_id='"x7"', ts='"12d"'),
        doc(_id='"x8"', uid='"\\u00a0\\ufeff "'),
        doc(_id='"x9"', migrated="true"),
        doc(_id='"y1"', up="not json", sg="[1]"),
    ]
    out = {r.source_id: r for r in normalize.normalize(docs(spark, *cases)).withColumn("t", v.format_time(F.col("ts_ms"))).collect()}
    assert (out["x1"].e, out["x1"].n, out["x1"].did) == ("[CLY]_custom", "purchase", "")
    assert out["x2"].t == "2025-06-15 15:06:40.000"
    assert (out["x3"].e, out["x3"].n) == ("[CLY]_view", "/cart")
    assert (out["x4"].a, out["x4"].n) == ("own", "prenamed")
    assert out["x5"].c == 4294967295 and [(c.rule, c.key) for c in out["x5"].coercions] == [("clamp_uint32", "c")]
    assert out["42"].ts_ms == 0x1979FA4F400 and out["42"].cd_ms == 5
    assert [out[k].skip_reason for k in ("x7", "x8", "x9")] == ["invalid_ts", "missing_uid", "already_marked_migrated"]
    assert out["y1"].skip_reason is None and out["y1"].up == "{}" and out["y1"].sg == "{}"
    none = normalize.normalize(docs(spark, doc(), a=None)).first()
    assert none.skip_reason == "missing_a"


def test_sanitize_numbers():
    text = '{"a":[NaN,-Infinity,5.2601586211929e19,-9.3e18,9.2e18,1e21,9.2e25,42],"l":{"$numberLong":"7"}}'
    out, found = sanitize.sanitize(text)
    assert json.loads(out)["a"] == ["NaN", "-Infinity", "52601586211929000000", "-9300000000000000000", 9.2e18, 1e21, 9.2e25, 42]
    assert json.loads(out)["l"] == "7" and len(found) == 5
    assert sanitize.sanitize('{"b": 1.50}') == ('{"b": 1.50}', [])


def test_number_text(spark):
    numbers = [0.0, -0.0, 42.0, 1.5, 1e20, 5.26e19, 1e21, 1.5e-7, 1e-6, -123.456, float("nan"), float("-inf"), 1e22, 12345678.9]
    texts = ["0", "0", "42", "1.5", "100000000000000000000", "52600000000000000000", "1e+21", "1.5e-7", "0.000001", "-123.456", "NaN", "-Infinity", "1e+22", "12345678.9"]
    rows = spark.createDataFrame(list(enumerate(numbers)), "i int, x double").select("i", v.number_text(F.col("x")).alias("t")).collect()
    assert [r.t for r in sorted(rows)] == texts


def test_coercion_cap(spark):
    each = spark.range(10_050).select(F.lit("r").alias("rule"), F.col("id").cast("string").alias("key"), F.struct(F.lpad(F.col("id").cast("string"), 6, "0").alias("source_id"), F.lit("o").alias("original"), F.lit("c").alias("coerced")).alias("sample"))
    out = normalize.summarize_coercions(each)
    assert out.count() == 10_001 and out.filter("rule = 'other'").first().n == 50


@pytest.mark.parametrize("lower,upper,estimate", [(0, 0, 1), (1000, 1000 + 30 * grid.DAY_MS, 10), (5, 77, 1_000), (1_700_000_000_000, 1_700_500_000_000, 12_345)])
def test_grid_covers(spark, lower, upper, estimate):
    bounds = spark.createDataFrame([("c", lower, upper, estimate)], "collection string, lower long, upper long, estimate long")
    rows = sorted(grid.build_grid(bounds, 100, 7).collect(), key=lambda r: r.idx)
    assert rows[0].lower_cd == lower and rows[-1].upper_cd == upper + 1
    assert all(a.upper_cd == b.lower_cd for a, b in zip(rows, rows[1:], strict=False)) and all(r.upper_cd > r.lower_cd for r in rows)


def minutes(per_before, per_after, gap, anchor, extra=()):
    rows = [{"bucket_ms": m * 60_000, "old": per_before if m < gap[0] else 0, "new": per_after if m >= gap[1] else 0} for m in range(60)]
    for m in extra:
        rows[m]["old"] = 1
    bound = (gap[0] + gap[1]) * 30_000
    return {"status": "ok", "method": "gap", "anchor": anchor * 60_000, "gap": (gap[0] * 60_000, gap[1] * 60_000), "bound": bound, "ambiguous": 0, "minutes": rows}


def test_auto_apply():
    good = minutes(5, 4, (20, 22), 22)
    assert boundary.decide(good).bound == 21 * 60_000
    for bad in (minutes(1, 1, (20, 22), 22), minutes(5, 4, (20, 22), 30), minutes(5, 4, (20, 22), 24, (22, 23)), good | {"method": "anchor"}):
        assert not boundary.decide(bad).apply and boundary.decide(bad, accept_anchor=True).apply
    assert not boundary.decide({"status": "refused"}, True).apply and not boundary.decide(None, True).apply


def test_errors_and_retry():
    assert errors.classify("27") == "permanent" and errors.classify("ECONNRESET", "circular structure") == "transient" and errors.classify(None, "Do not know how to serialize") == "permanent"
    seen = []

    def action():
        seen.append(1)
        raise ValueError("down")

    with pytest.raises(ValueError):
        errors.Retry(max_retries=2).run(action, sleep=lambda s: None)
    assert len(seen) == 3


def test_verdicts():
    ok = verdict.Facts(chunks=3, done=3, content_sampled=5)
    assert verdict.judge(ok).verdict == "PASS"
    assert verdict.judge(verdict.Facts(chunks=3, done=3, deep=False)).verdict == "PASS_WITH_NOTES"
    for bad in ({"failed": 1}, {"pending_letters": 1}, {"checksum_mismatches": 1}, {"unaudited": ["x"]}, {"lease_lost": True}):
        assert verdict.judge(verdict.Facts(**({"chunks": 3, "done": 2 if "failed" in bad else 3} | bad))).verdict == "FAIL"
    assert "verdict: PASS" in verdict.render(verdict.judge(ok))


def test_discover():
    assert discover(["docsb", "x", "docs", "docsA"], "docs") == ["docs", "docsA", "docsb"]
    with pytest.raises(ValueError):
        discover(["x"], "docs")


def test_load_promote_heal(spark, tmp_path):
    table = LiveTable(spark, str(tmp_path / "live"))
    batch = [doc(_id=f'"d{i}"', ts=str(1750000000000 + i * 86_400_000 * 10)) for i in range(9)] + [doc(_id='"bad"', ts='"soon"')]
    tally, bad = load.load_chunk(table, docs(spark, *batch), "run-c1-0-1")
    assert (tally.read, tally.skipped, tally.staged, tally.method) == (10, 1, 9, "attach") and bad.first().error == "skip:invalid_ts"
    again, _ = load.load_chunk(table, docs(spark, *batch), "run-c1-0-2")
    assert again.method == "recorded" and table.read().count() == 9
    table.delete_pairs(table.read().filter("_id = 'd0'"))
    assert table.read().count() == 8
    twice = [doc(_id='"d0"'), doc(_id='"d0b"', ts="1750000000001")]
    table.append(table.read().limit(0))
    healed, _ = load.load_chunk(table, docs(spark, *twice, *batch[1:3]), "run-c1-0-3")
    assert healed.method in ("heal", "attach") and table.read().groupBy("_id").count().filter("count > 1").isEmpty()
    before = table.version()
    table.delete_window("c1", 0, 1 << 50)
    assert table.read().count() == 0 and table.read(before).count() == 10


def test_snapshot_changes(spark):
    a = spark.createDataFrame([("c", "x", 5, 5), ("d", "y", 6, 6)], "collection string, source_id string, cd_ms long, ts_ms long")
    b = spark.createDataFrame([("c", "z", 5, 5), ("e", "y", 6, 6)], a.schema)
    out = {r.collection: r.change for r in pairs.snapshot_changes(pairs.source_snapshot(a), pairs.source_snapshot(b)).collect()}
    assert out == {"c": "moved", "d": "removed", "e": "added"}


def test_breaker_over_all(spark, tmp_path):
    import random

    from plumbline.operators import ledger
    from plumbline.plans.queries import QUERIES

    def brute(rows):
        out, n, before = {}, 0, None
        for seq, ok, cls in rows:
            kind = "ok" if ok else cls
            n, before = n + 1 if kind == before else 1, kind
            out[seq] = (0 if ok else n, ("breaker-data" if cls == "permanent" else "breaker-transient") if not ok and n >= 3 else None)
        return out

    rng = random.Random(5)
    rows = []
    while len(rows) < 3000:
        ok, cls = rng.random() < 0.3, rng.choice(["permanent", "transient"])
        rows += [(len(rows) + k, ok, cls) for k in range(rng.choice([1, 2, 3, 5, 400]))]
    made = spark.createDataFrame(rows, "seq long, ok boolean, error_class string").repartition(5)
    for parts in (1, 7, 64):
        assert {r.seq: (r.streak, r.pause) for r in ledger.breaker(made, parts=parts).collect()} == brute(rows)
    assert ledger.breaker(made.limit(0)).count() == 0
    ids = [r.event_id for r in spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id").orderBy("event_id").collect()]
    found = {r.seq: (r.streak, r.pause) for r in QUERIES["failure_breaker"](spark, "/root/testdata/sf0.001").collect()}
    assert max(ids) >= 500 and found == brute([(i, i % 10 < 4, "permanent" if i % 20 < 10 else "transient") for i in ids])


def test_number_to_text_all(spark):
    from decimal import Decimal

    from plumbline.plans.queries import QUERIES

    def text(i):
        x = [float(i), i + 0.5, i * 1e19, -float(i), None][i % 5]
        if x is None:
            return "NaN"
        fixed = repr(x) if abs(x) >= 1e21 else format(Decimal(repr(x)), "f")
        return fixed.removesuffix(".0")

    sf = "/root/testdata/sf0.001"
    ids = [r.event_id for r in spark.read.parquet(f"{sf}/events.parquet").select("event_id").collect()]
    out = {r.event_id: r.text for r in QUERIES["number_to_text"](spark, sf).collect()}
    assert out == {i: text(i) for i in ids} and out[102] == "1.02e+21" and 0 in out


def test_content_diff_all(spark):
    from collections import Counter

    from plumbline.plans import derived as d
    from plumbline.plans.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = d.rows(spark, sf).filter("not no_cd").select("collection", "_id", "cd_ms", "uid").collect()
    best, dead = {}, {(r.collection, r.source_id) for r in d.dead(spark, sf).filter("status in ('pending', 'waived')").collect()}
    for r in d.live(spark, sf).select("_id", "cd_ms", "uid", "collection").collect():
        if r._id not in best or (-r.cd_ms, r.collection) < (-best[r._id].cd_ms, best[r._id].collection):
            best[r._id] = r
    def kind(r):
        l = best.get(r._id)
        if l is None or l.cd_ms != r.cd_ms:
            return "excused" if (r.collection, r._id) in dead else "missing"
        return "different" if l.uid != r.uid else "matched"
    out = Counter((r.collection, r._id, r.kind) for r in QUERIES["content_diff"](spark, sf).collect())
    assert out == Counter((r.collection, r._id, kind(r)) for r in rows)


def test_whole_tables(spark):
    from collections import Counter

    from plumbline.plans import derived as d
    from plumbline.plans.queries import QUERIES
    from plumbline.schema import TERMINAL

    sf = "/root/testdata/sf0.001"
    rows = d.rows(spark, sf).select("collection", "_id", "cd_ms").collect()
    ids, last = {r._id for r in rows}, {}
    for r in d.target(spark, sf).select("_id", "cd_ms").collect():
        if r._id in ids:
            last[r._id] = max(last.get(r._id, r.cd_ms), r.cd_ms)
    assert {r._id: r.cd_ms for r in QUERIES["live_cd_by_ids"](spark, sf).collect()} == last
    live = {tuple(r) for r in d.live(spark, sf).select("collection", "_id", "cd_ms").collect()}
    assert Counter(map(tuple, QUERIES["dlq_replay_absent"](spark, sf).collect())) == Counter(tuple(r) for r in rows if tuple(r) not in live)
    chunks = sorted(d.chunks(spark, sf).select("collection", "idx", "status").collect(), key=lambda r: (r.collection, -r.idx))
    frontier = next((k for k, r in enumerate(chunks) if r.status not in TERMINAL), None)
    assert {tuple(r) for r in QUERIES["frontier_tape"](spark, sf).collect()} == {(r.collection, r.idx, k, k == frontier) for k, r in enumerate(chunks)}


def test_content_diff_of_copies_that_differ(spark):
    from plumbline.operators import audit

    columns = [*audit.SCALARS, *audit.PAYLOADS]
    row = lambda uid: spark.createDataFrame([("c", "1", 5)], "collection string, _id string, cd_ms long").select("*", *[F.lit(uid if c == "uid" else "{}").alias(c) for c in columns])
    dead = spark.createDataFrame([], "collection string, source_id string, status string")
    right, wrong = row("u1"), row("wrong")
    found = [audit.content_diff(right, pair.coalesce(1), dead).collect() for pair in (right.unionByName(wrong), wrong.unionByName(right))]
    assert found[0] == found[1] and found[0][0].kind == "matched"
