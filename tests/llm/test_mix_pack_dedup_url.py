"""Brute force and edge cases for packing, exact dedup, URL rules and mixing."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from plumbline.llm import exact_dedup as dedup
from plumbline.llm import mixing, packing, queries, url_filter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, size long, fp long, bin int"
WORDS = "alpha beta gamma delta".split()


def docs(spark, rows):
    """rows: (doc_id, text, source), with further columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", s, 0, False, -1, 7, 3) for i, t, s in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def mixed(spark):
    rows = [(i, " ".join(WORDS[(i * 7 + k) % 4] for k in range(1 + i * i % 90)), f"s{i % 5}" if i % 11 else None) for i in range(300)]
    rows += [(1000 + i, "the same text", "s0") for i in range(40)]
    rows += [(2000, None, "s1"), (2001, "", "s1"), (None, "no id", "s2"), (2002, " \t\n\x0b", "s3"), (2003, "x1 #9 " * 3000, "s4"), (2004, "twice", "s4"), (2004, "twice", "s4"), (2005, "a<|endoftext|>b Ünï 東京", "s4")]
    return rows, docs(spark, rows)


def test_packing_round_trip(spark, mixed):
    rows, df = mixed
    import tokenizers

    exact = tokenizers.Tokenizer.from_file(queries.tokenizer_path())
    out = packing.pack(df, queries.tokenizer_path()).collect()
    by_doc = defaultdict(list)
    for r in out:
        assert r.length == 1 << r.bucket and r.length <= 1024 and r.offset == 0 and len(r.ids) == 4 * r.length
        by_doc[r.doc_id].append(r)
    assert len({r.sequence_id for r in out}) == len(out)
    times = Counter(i for i, _, _ in rows)
    for i, text, _ in rows:
        ids = [*exact.encode(text or "", add_special_tokens=False).ids, 0]
        pieces = sorted(by_doc[i], key=lambda r: r.start)
        assert {r.doc_tokens for r in pieces} == {len(ids)}
        assert sorted(r.length for r in pieces) == sorted(packing.piece_lengths(len(ids), 1024) * times[i])
        for r in pieces:
            assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.start : r.start + r.length]


def test_packing_pieces():
    for n in (1, 2, 1023, 1024, 1025, 5000):
        sizes = packing.piece_lengths(n, 1024)
        assert sum(sizes) == n and all(s & (s - 1) == 0 for s in sizes) and sizes == sorted(sizes, reverse=True)


def test_packing_empty_and_files(spark, tmp_path):
    assert packing.pack(docs(spark, []), queries.tokenizer_path()).count() == 0
    packing.write_buckets(packing.pack(docs(spark, [(1, "some words to pack here", "s")]), queries.tokenizer_path()), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.selectExpr("sum(length)").first()[0] == back.selectExpr("sum(length(ids)) div 4").first()[0] > 0


@pytest.mark.parametrize("n,k", [(1, 0), (5, 3), (1000, 20), (1000, 40)])
def test_golomb_round_trip(n, k):
    rng = np.random.default_rng(n + k)
    values = np.unique(rng.integers(0, 1 << 44, n).astype(np.uint64))
    if k == 0:
        values = np.arange(n, dtype=np.uint64) * np.uint64(3)
    k = max(k, dedup.rice_parameter(len(values), 1 << 44) - 3) if k else 0
    assert (dedup.golomb_decode(dedup.golomb_encode(values, k), len(values), k) == values).all()


@pytest.mark.parametrize("bits,rows_max", [(48, 10**6), (6, 10**6), (48, 0), (6, 0)])
def test_exact_dedup_brute_force(spark, mixed, monkeypatch, bits, rows_max):
    """Few bits make almost all rows suspects; no broadcast rows take the salted shuffle."""
    rows, df = mixed
    monkeypatch.setattr(dedup.matching, "__defaults__", ("left_semi", 4, rows_max))
    out = dedup.exact_dedup(df, bits=bits, owners=5).collect()
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[t or ""].append(i)
    want = Counter()
    for i, t, _ in rows:
        same = groups[t or ""]
        keep = max((x for x in same if x is not None), default=None)
        want[i, keep, len(same), i == keep, hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in out) == want
    left = dedup.drop_copies(df, bits=bits, owners=5)
    assert left.columns == df.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter({i for i, _, _ in rows if i == max((x for x in groups[dict(((a, b) for a, b, _ in rows))[i] or ""] if x is not None), default=None)})


def test_one_row_of_a_repeated_document(spark):
    """Rows given several times: one of each text stays, whatever repeats."""
    rows = [(1, "same", "a")] * 5 + [(0, "same", "b"), (None, "none", "c"), (None, "none", "d"), (None, None, "e"), (None, "", "f"), (7, "alone", "g")]
    left = dedup.drop_copies(docs(spark, rows), owners=3)
    assert Counter((r.doc_id, r.text or "") for r in left.collect()) == Counter([(1, "same"), (None, "none"), (None, ""), (7, "alone")])
    assert dedup.drop_copies(docs(spark, [])).count() == 0


def test_exact_dedup_empty(spark):
    assert dedup.exact_dedup(docs(spark, [])).count() == 0


def judge(url):
    if url is None or "://" not in url:
        return "", "", None
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    rules = [r for _, r in url_filter.DOMAIN_RULES if (host == (h := r.split("/")[0]) or host.endswith("." + h)) and path.startswith(r[len(h) :])]
    return host, path, max(rules, key=len, default=None)


def test_url_rules(spark):
    urls = [None, "", "no scheme.com/", "http://", "http://A.B.COM", "http://A.B.COM/", "https://example.com/en/x?y#z", "https://www.example.com/en/", "http://x.www.example.com/en/1", "http://notexample.com/en/", "http://a.net/es/1", "http://a.net/esp/1", "http://NET/fr/", "http://a.net/de/", "http://spam-farm.example.org/en/1", "http://cheap-pills.example.org/", "http://cheap-pills.example.com/", "http://good.org/a/track/click/1", "http://good.org/?u=http://a.net/es/1", "ftp://ü.org/\n/adserver/x", "http://example.com/en", "http://good.org/track/xclick"] * 2
    pages = spark.createDataFrame([(i, u, "<p>", "x", "y") for i, u in enumerate(urls)], "page_id long, url string, html string, host string, rule string")
    out = {r.page_id: r for r in url_filter.filter_urls(pages).collect()}
    assert len(out) == len(urls)
    blocked = {i for i, u in enumerate(urls) if u and ("spam-farm" in u or "pills.example.org" in u or "/track/click" in u or "adserver" in u)}
    verdicts = {r: v for v, r in url_filter.DOMAIN_RULES}
    for i, u in enumerate(urls):
        host, path, rule = judge(u)
        assert (out[i].host, out[i].path, out[i].rule) == (host, path, rule), u
        assert out[i].verdict == verdicts.get(rule, "block" if i in blocked else "allow"), u
    assert url_filter.filter_urls(pages.limit(0)).count() == 0


def test_url_long_and_hot(spark):
    """A url of a million bytes, one that half of the pages share, and pages without any."""
    long = "http://a.example.org/" + "x" * 1_000_000 + "/track/click"
    urls = ["http://hot.example.com/en/a"] * 500 + [long, long[:-5]] + [None] * 300
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = {r.page_id: (r.rule, r.verdict, r.pattern) for r in url_filter.filter_urls(pages).collect()}
    assert len(out) == len(urls) and all(out[i] == ("example.com/en/", "block", None) for i in range(500))
    assert out[500] == (None, "block", "tracker path") and out[501] == (None, "allow", None) and out[502] == (None, "allow", None)


def targets(sizes):
    """Targets by repeated resharing."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    total, done = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in done]
        share = (total - sum(done.values())) / max(1, sum(weight[s] for s in free))
        over = [s for s in free if share * weight[s] > 3 * sizes[s]]
        if not over:
            return {s: done.get(s, share * weight[s]) for s in order}
        done |= {s: 3.0 * sizes[s] for s in over}


def test_mixing_brute_force(spark, mixed):
    rows, df = mixed
    out = mixing.mix(df).collect()
    sizes, sources = Counter(), {}
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    for i, t, s in rows:
        sizes[s] += size(t)
        sources[i] = s
    want, taken = targets(sizes), Counter()
    assert Counter((r.doc_id, r.size) for r in out) == Counter((i, size(t)) for i, t, _ in rows)
    for r in out:
        s = sources[r.doc_id]
        assert r.source == s and r.source_size == sizes[s] and math.isclose(r.target, want[s], rel_tol=1e-9, abs_tol=1e-6)
        assert r.taken in {r.size * k for k in range(4)} and abs(r.epochs - want[s] / max(1, sizes[s])) < 1 + 1e-9
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(size(t) for i, t, x in rows if x == s)
    again = mixing.mix(df.repartition(7)).collect()
    assert Counter(tuple(r) for r in out) == Counter(tuple(r) for r in again)
    copies = mixing.apply_mix(df)
    assert copies.columns == df.columns
    assert Counter(r.doc_id for r in copies.collect()) == Counter({k: v for k, v in sum((Counter({r.doc_id: r.epochs}) for r in out), Counter()).items() if v})


@pytest.mark.parametrize("bins", [(64, 4096), (1, 2)])
def test_mixing_against_a_plain_sort(spark, monkeypatch, bins):
    """Qualities from 0.01 to 1: which documents are taken, by sorting each source's keys and summing, with wide steps too."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(mixing, "FIRST_BINS", bins[0])
    monkeypatch.setattr(mixing, "SECOND_BINS", bins[1])
    rows = [(i, "w " * (1 + i * 7 % 23), [None, "", "a", "b", "c"][i % 5 if i % 3 else 2]) for i in range(2000)] + [(5000, "again and again", "a")] * 300
    quality = F.element_at(F.array(F.lit(0.01), F.lit(0.1), F.lit(0.5), F.lit(1.0)), (F.coalesce("doc_id", F.lit(0)) % 4 + 1).cast("int"))
    df = docs(spark, rows)
    spots = {(r.doc_id, r.source): r["_spot"] for r in mixing.keyed(df, quality).select("doc_id", "source", "_spot").collect()}
    sizes, total = Counter(), Counter()
    for i, t, s in rows:
        sizes[s] += len(t.split())
    want, expected = targets(sizes), {}
    for s in sizes:
        epochs = min(3, math.floor(want[s] / sizes[s]))
        budget, end, last = want[s] - epochs * sizes[s], 0, None
        total = Counter()
        for i, t, x in rows:
            if x == s:
                total[spots[i, s]] += len(t.split())
        for spot in sorted(total):
            n, end = total[spot], end + total[spot]
            if end - budget < budget - (end - n):
                last = spot
            else:
                break
        for i, _, x in rows:
            if x == s:
                expected[i, s] = epochs + (budget > 0 and last is not None and spots[i, s] <= last)
    out = mixing.mix(df, quality).collect()
    assert {(r.doc_id, r.source): r.epochs for r in out} == expected and len(out) == len(rows)
    shares = Counter(r.doc_id % 4 for r in out if r.epochs > 0 and r.source == "a")
    assert shares[3] > shares[0]


def test_mixing_bins_hold_few(spark):
    """Whatever the quality, no first step of a source's keys holds much of it."""
    from pyspark.sql import functions as F

    df = docs(spark, [(i, f"text {i}", "a") for i in range(4000)])
    for q in (0.01, 0.1, 1.0):
        most = mixing.keyed(df, F.lit(q)).groupBy("_spot.bin").count().agg(F.max("count")).first()[0]
        assert most < 0.02 * 4000


def test_apply_mix_null_and_empty_source(spark):
    """One document in the null and in the empty source: each is taken as often as its own source says, by the broadcast and the shuffled plan."""
    df = docs(spark, [(1, "a b c", ""), (1, "a b c", None), (2, "d e f g h i j k l", "z")])
    want = Counter({(r.doc_id, r.source): r.epochs for r in mixing.mix(df).collect() if r.epochs})
    assert len({r for r in want.values()}) and Counter((r.doc_id, r.source) for r in mixing.apply_mix(df).collect()) == want


def test_mix_shuffles_no_text(spark):
    """Documents are decided where they are: the plan of apply_mix has no exchange but broadcasts."""
    plan = mixing.apply_mix(docs(spark, [(i, "some text here", f"s{i % 3}") for i in range(50)]).coalesce(2))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_mixing_weights_bias(spark):
    """Documents of a higher quality weight are taken more often."""
    from pyspark.sql import functions as F

    rows = [(i, "w " * 10, "b" if i < 1000 else "a") for i in range(1500)]
    out = mixing.mix(docs(spark, rows), quality=F.when(F.col("doc_id") % 2 == 0, 5.0).otherwise(0.5), weights=(2, 1)).filter("source = 'b'").collect()
    good = sum(r.epochs for r in out if r.doc_id % 2 == 0)
    bad = sum(r.epochs for r in out if r.doc_id % 2)
    assert good > 1.5 * bad


def test_mixing_degenerate(spark):
    assert mixing.mix(docs(spark, [])).count() == 0
    out = mixing.mix(docs(spark, [(1, None, None), (2, "", "s")])).collect()
    assert [(r.size, r.target, r.taken) for r in out] == [(0, 0.0, 0)] * 2
    one = mixing.mix(docs(spark, [(1, "a b c", "s")])).first()
    assert (one.target, one.taken) == (3.0, 3)


def test_crc(spark):
    from pyspark.sql import functions as F

    ids = np.array([1, 2, 50256], "<u4").tobytes()
    assert spark.range(1).select(F.crc32(F.lit(bytearray(ids)))).first()[0] == zlib.crc32(ids)
