"""Brute force and edge cases for quality rules, toxicity, licence scan and WARC audit."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import license_digest, license_texts, quality_rules, toxicity, warc_audit

SCHEMA = "doc_id long, text string, lang string, source string, kept boolean, score double, grp string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, False, -1.0, "g") for i, t, lang, s in rows], SCHEMA).repartition(3)


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n


EDGES = [None, "", " \n\t\x0b ", "one", "a b", "a b c a b c", "x x x x", "#*$ <b>|%&", "é\nü\n\né\n \né", "  a b", "same line\nsame line \nsame line", "\n".join(["a b c d e f g h"] * 12), "long " * 400 + "end"]


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))


def test_text_counts(spark):
    rng = random.Random(1)
    rows = [(i, t, "en", "s") for i, t in enumerate(EDGES + [" ".join(rng.choice("abcd") for _ in range(k)) for k in range(80)])]
    out = quality_rules.judge(docs(spark, rows)).collect()
    assert {r.doc_id: tuple(r)[1:7] for r in out} == {i: counts(t) for i, t, _, _ in rows}


def test_outliers(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randint(60, 300)), "en" if i % 2 else "fr", f"s{i % 3}") for i in range(900)]
    junk = [(2000 + i, " ".join(w + "%%%" for w in prose(rng, 100).split()), "en", f"s{i % 3}") for i in range(40)]
    few = [(3000 + i, prose(rng, 80), None, None) for i in range(5)]
    out = {r.doc_id: r for r in quality_rules.judge(docs(spark, rows + junk + few)).collect()}
    assert not any(out[i].kept for i, *_ in junk)
    assert all(out[i].kept for i, *_ in rows + few)
    again = {r.doc_id: r for r in quality_rules.judge(docs(spark, few + junk + rows).repartition(5)).collect()}
    assert out == again


def test_each_rate_rejects_alone(spark):
    rng = random.Random(12)
    clean = [(i, "\n".join(prose(rng, 10) for _ in range(rng.randint(6, 30))), "en", "s") for i in range(400)]
    rows = []
    for i in range(20):
        words = prose(rng, 120).split()
        rows.append((1000 + i, " ".join(words + words[:30]), "en", "s"))
        rows.append((2000 + i, "\n".join(prose(rng, 3) if k % 5 in (0, 2, 4) else "kept going" for k in range(60)), "en", "s"))
        dirty = prose(rng, 200).split()
        rows.append((3000 + i, " ".join(w[:-1] + "%" if k % 3 == 0 else w for k, w in enumerate(dirty)), "en", "s"))
    out = {r.doc_id: r for r in quality_rules.judge(docs(spark, clean + rows)).collect()}
    assert not any(out[i].base_failed or out[i].kept for i, *_ in rows)
    assert all(out[i].n_symbols < 0.12 * out[i].word_chars for i, *_ in rows)
    assert sum(out[i].kept for i, *_ in clean) >= 398


def squared(x, r):
    z = x - [r[f"m{i}"] for i in range(4)]
    inverse = np.array([[r[f"p{max(i, j)}{min(i, j)}"] for j in range(4)] for i in range(4)])
    return np.einsum("ni,ij,nj->n", z, inverse, z)


def bin_median(x, r):
    bins = np.sort(np.minimum(np.floor(np.log1p(np.maximum(squared(x, r), 0)) * 64), 1023))
    return bins[int(np.ceil(0.5 * len(x))) - 1]


def mcd(x, floor, share=0.75, steps=20):
    """The estimate of one group in numpy: mean, inverse covariance and scale of the start whose subset has the least determinant."""
    f = np.diag((np.array(floor) * 256) ** 2)
    q = [np.sort(x, axis=0)[int(np.ceil(p * len(x))) - 1] for p in (0.25, 0.5, 0.75)]
    found = []
    for k, (mean, inverse) in enumerate([(q[1].astype(float), np.diag(1 / (((q[2] - q[0]) / 1.349) ** 2 + np.diag(f)))), (x.mean(0), np.linalg.inv(np.cov(x.T, bias=True) + f))]):
        for _ in range(steps):
            d = np.einsum("ni,ij,nj->n", x - mean, inverse, x - mean)
            bins = np.minimum(np.floor(np.log1p(np.maximum(d, 0)) * 64), 1023)
            inside = x[bins <= np.sort(bins)[int(np.ceil(share * len(x))) - 1]]
            mean, cov = inside.mean(0), np.cov(inside.T, bias=True) + f
            inverse = np.linalg.inv(cov)
        found.append((round(float(np.linalg.slogdet(cov)[1]), 9), k, mean, inverse))
    _, _, mean, inverse = min(found, key=lambda r: r[:2])
    d = np.einsum("ni,ij,nj->n", x - mean, inverse, x - mean)
    bins = np.sort(np.minimum(np.floor(np.log1p(np.maximum(d, 0)) * 64), 1023))
    return mean, inverse, min(1.0, quality_rules.CHI2_MEDIAN / np.expm1((bins[int(np.ceil(0.5 * len(x))) - 1] + 0.5) / 64))


def test_kept_brute_force(spark):
    """Every verdict over several groups, some of them pooled, against an estimate in numpy."""
    rng = random.Random(21)
    rows = []
    for i in range(700):
        words = prose(rng, rng.randint(55, 160)).split()
        if rng.random() < 0.1:
            words += words[: rng.randint(1, 40)]
        if rng.random() < 0.1:
            words = [w + "%" if rng.random() < 0.2 else w for w in words]
        lines, at = [], 0
        while at < len(words):
            n = rng.randint(4, 12)
            lines.append(" ".join(words[at : at + n]))
            at += n
        rows.append((i, "\n".join(lines + lines[: rng.choice([0, 0, 0, 0, 1, 3])]), rng.choice(["en", "en", "fr", None]), rng.choice(["a"] * 6 + ["b", "c", None])))
    rows += [(1000 + i, "\n".join(prose(rng, 9) for _ in range(9)), "xx", f"s{i}") for i in range(9)] + [(2000, None, "en", "a"), (2001, "", "en", "zz")]
    out = {r.doc_id: r for r in quality_rules.judge(docs(spark, rows)).collect()}
    vectors, groups = {}, {}
    for i, t, lang, source in rows:
        n, chars, symbols, dup, rep, _ = counts(t)
        lines = len([x for x in (t or "").split("\n") if x.strip()])
        angle = lambda a, b: np.arcsin(np.sqrt(min(1.0, a / max(b, 1))))
        if n:
            vectors[i] = [int(np.floor(v * 256 + 0.5)) for v in (np.log((chars + 1) / (n + 1)), angle(symbols, chars), angle(dup, lines), angle(rep, n))]
            groups.setdefault((lang, source), []).append(i)
    pools = {}
    for (lang, source), ids in groups.items():
        pools.setdefault(("both", lang, source) if len(ids) >= 50 else ("lang", lang), []).extend(ids)
    final = {}
    for k, ids in pools.items():
        final.setdefault(k if len(ids) >= 50 else "rest", []).extend(ids)
    assert "rest" in final and any(k[0] == "lang" for k in final) and sum(k[0] == "both" for k in final) >= 2
    near = 0
    for ids in final.values():
        x = np.array([vectors[i] for i in ids])
        mean, inverse, scale = mcd(x, quality_rules.FLOOR)
        for i, d in zip(ids, scale * np.einsum("ni,ij,nj->n", x - mean, inverse, x - mean), strict=True):
            near += abs(d - quality_rules.CHI2_999) < 1e-6
            assert np.isclose(out[i].distance, d, atol=1e-6)
            assert out[i].kept == (not out[i].base_failed and d <= quality_rules.CHI2_999)
    assert not near and 0 < sum(not r.kept for r in out.values()) < len(rows) / 2
    assert not out[2000].kept and out[2000].distance is None and not out[2001].kept


def test_repeats_are_decided_by_words(spark, monkeypatch):
    """Windows whose hashes all collide: the counts stay right."""
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(k)), "en", "s") for i, k in enumerate([0, 1, 3, 4, 30, 60, 200])] + [(90, prose(rng, 5000) + " x y z " + prose(rng, 20) + " x y z", "en", "s")]
    real = quality_rules.F.expr
    monkeypatch.setattr(quality_rules.F, "expr", lambda s: real(s.replace("xxhash64(_words[i], _words[i + 1], _words[i + 2])", "xxhash64(length(_words[i]))")))
    out = quality_rules.text_counts(docs(spark, rows)).collect()
    assert {r.doc_id: r.n_repeat_words for r in out} == {i: counts_of_repeats(t) for i, t, _, _ in rows}


def counts_of_repeats(text):
    words = text.split()
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    return len({j for i, w in enumerate(windows) if w in often for j in range(i, i + 3)})


def test_drop_rejected(spark):
    """The stage's form keeps what judge keeps, with all columns, those with clashing names too."""
    rng = random.Random(22)
    rows = [(i, prose(rng, 80) if i % 7 else " ".join([prose(rng, 30)] * 4), "en", None if i % 5 else "a") for i in range(150)] + [(400, None, None, None), (401, "", "en", "a"), (402, prose(rng, 30000), "en", "a")]
    df = spark.createDataFrame([(i, t, lang, s, 1, 2, "m", {"k": 1}) for i, t, lang, s in rows], "doc_id long, text string, lang string, source string, n_words long, x0 long, grp string, extra map<string, int>")
    left = quality_rules.drop_rejected(df)
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(r.doc_id for r in quality_rules.judge(df).collect() if r.kept)
    assert left.filter("n_words = 1 and x0 = 2 and grp = 'm' and extra['k'] = 1").count() == left.count() > 100
    assert quality_rules.drop_rejected(df.limit(0)).count() == 0


def test_mcd_moments(spark):
    """One group's estimate equals the same steps in numpy."""
    rng = np.random.default_rng(3)
    x = np.rint(np.vstack([rng.normal(0, 40, (300, 4)), rng.normal(900, 20, (60, 4))])).astype(int)
    rows = spark.createDataFrame([("g", *map(int, r)) for r in x], "grp string, x0 long, x1 long, x2 long, x3 long").repartition(4)
    got = quality_rules.robust_estimates(rows, 0.75, 4, (0.05,) * 4).first()
    assert all(np.isclose(got["scale"], s) for s in [min(1, quality_rules.CHI2_MEDIAN / np.expm1((bin_median(x, got) + 0.5) / 64))])
    results = []
    q = np.array([[np.sort(x[:, i])[int(np.ceil(p * len(x))) - 1] for i in range(4)] for p in (0.25, 0.5, 0.75)])
    floor = (0.05 * 256) ** 2
    starts = [(q[1].astype(float), np.diag(1 / (((q[2] - q[0]) / 1.349) ** 2 + floor))), (x.mean(0), np.linalg.inv(np.cov(x.T, bias=True) + floor * np.eye(4)))]
    for mean, inverse in starts:
        for _ in range(4):
            z = x - mean
            bins = np.minimum(np.floor(np.log1p(np.einsum("ni,ij,nj->n", z, inverse, z)) * 64), 1023)
            inside = x[bins <= np.sort(bins)[int(np.ceil(0.75 * len(x))) - 1]]
            mean, cov = inside.mean(0), np.cov(inside.T, bias=True) + floor * np.eye(4)
            inverse = np.linalg.inv(cov)
        results.append((np.linalg.slogdet(cov)[1], mean, inverse))
    _, mean, inverse = min(results, key=lambda r: r[0])
    assert np.allclose([got[f"m{i}"] for i in range(4)], mean)
    assert np.allclose([got[f"p{i}{j}"] for i in range(4) for j in range(i + 1)], [inverse[i, j] for i in range(4) for j in range(i + 1)])
    assert abs(mean).max() < 30


def test_quality_empty(spark):
    assert quality_rules.judge(docs(spark, [])).count() == 0


@pytest.fixture(scope="module")
def insults():
    rng = random.Random(4)
    bad = ["zorgblat", "quimfex", "vrudnok"]
    clean = [prose(rng, rng.randint(30, 400)) for _ in range(400)]
    toxic = []
    for _ in range(120):
        words = prose(rng, rng.randint(30, 400)).split()
        for _ in range(3):
            words.insert(rng.randint(0, len(words)), rng.choice(bad))
        toxic.append(" ".join(words))
    return clean, toxic


def test_toxicity_held_out(spark, insults):
    clean, toxic = insults
    rows = [(i, t, "en", "s") for i, t in enumerate(clean + toxic)] + [(9000, None, "en", "s"), (9001, "", "en", "s"), (9002, "", "en", "s"), (None, clean[0], "en", "s"), (9003, "ordinary words " * 20000 + "zorgblat quimfex vrudnok", "en", "s")]
    df = docs(spark, rows)
    labels = spark.createDataFrame([(i, int(i >= len(clean))) for i in range(len(clean + toxic))] + [(3, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(df, labels.filter(~toxicity.held_out()))
    assert b"zorgblat" in model.toxic and b"zorgblat" not in model.ordinary
    out = {r.doc_id: r for r in toxicity.score(df, model).withColumn("held_out", toxicity.held_out()).collect()}
    tested = [i for i in range(len(clean + toxic)) if out[i].held_out]
    assert len(tested) > 60
    assert sum(out[i].predicted == (i >= len(clean)) for i in tested) >= 0.97 * len(tested)
    assert out[9000].score == out[9001].score == out[9002].score < 0.5 and out[9003].predicted == 1
    assert all(0 <= r.score <= 1 for r in out.values()) and len(out) == len(rows)


def test_toxicity_by_plain_python(spark, insults):
    """Lengths, features and scores window by window, one compression at a time."""
    import zstandard

    clean, toxic = insults
    model = toxicity.fit_texts([t.encode() for t in toxic[:60]], [t.encode() for t in clean[:200]])
    texts = [*clean[200:230], *toxic[60:80], "", None, "ZORGBLAT " * 30, "é" * 100]
    got = {r.doc_id: r.score for r in toxicity.score(docs(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]), model).collect()}
    fixed = zstandard.ZstdCompressionParameters(window_log=17, chain_log=16, hash_log=16, search_log=4, min_match=5, target_length=0, strategy=zstandard.STRATEGY_GREEDY, write_content_size=False, write_checksum=False, write_dict_id=False)
    pair = [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(c, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=fixed) for c in (model.ordinary, model.toxic)]
    for i, t in enumerate(texts):
        data, saved = (t or "").lower().encode(), []
        for k in range(0, max(1, len(data) - 16), 32):
            window = toxicity.PAD + data[k : k + 48].ljust(48, b"\0")
            saved.append(len(pair[0].compress(window)) - len(pair[1].compress(window)))
        features = [min(max(0, *saved, 0), 12), math.log1p(sum(s >= 3 for s in saved)), math.log(len(saved))]
        want = 1 / (1 + math.exp(-max(-30, min(30, model.weights[0] + sum(w * f for w, f in zip(model.weights[1:], features, strict=True))))))
        assert math.isclose(got[i], want, rel_tol=1e-9), (i, t)


def test_toxicity_dictionaries(insults):
    """Both hold the content that zstandard trained on windows of all ordinary texts, however far in they lie."""
    clean, toxic = ([t.encode() for t in x] for x in insults)
    late = [c + b" seldomseen phrase " + c[:20] for c in clean]
    plain, both = toxicity.train_dictionaries(toxic, late)
    assert both.startswith(plain) and b"seldomseen" in plain and b"zorgblat" in both[len(plain) :]
    assert len(plain) <= toxicity.ORDINARY_BYTES + len(toxicity.PAD) + 1


def test_toxicity_windows_in_parts(insults, monkeypatch):
    clean, toxic = insults
    model = toxicity.fit_texts([t.encode() for t in toxic[:60]], [t.encode() for t in clean[:200]])
    pair = tuple(map(toxicity._compressor, (model.ordinary, model.toxic)))
    texts = [t.encode() for t in clean[200:220] + toxic[60:70]]
    whole = toxicity.evidence(texts, pair)
    monkeypatch.setattr(toxicity, "CHUNK_WINDOWS", 7)
    assert (toxicity.evidence(texts, pair) == whole).all()


def test_toxicity_largest_label_counts(spark, insults):
    clean, toxic = insults
    df = docs(spark, [(i, t, "en", "s") for i, t in enumerate(clean[:100] + toxic[:40])])
    once = [(i, int(i >= 100)) for i in range(140)]
    schema = "doc_id long, toxic int"
    assert toxicity.fit(df, spark.createDataFrame(once, schema)) == toxicity.fit(df, spark.createDataFrame(once + [(i, 0) for i in range(100, 140)] + once[:9], schema))


def test_toxicity_strings_without_cap():
    rng = random.Random(13)
    ordinary = [prose(rng, 8).encode() for _ in range(6000)]
    marks = ["".join(rng.choice("klmnopqrstuvwxyz") for _ in range(9)).encode() for _ in range(200)]
    toxic = [prose(rng, 5).encode() + b" " + m + b" " + prose(rng, 5).encode() for m in marks for _ in range(5)]
    found = toxicity.marking_strings(toxic, ordinary)
    assert all(any(m[k : k + 5] in s for s in found for k in range(5)) for m in marks)


def test_toxicity_without_labels(spark):
    df = docs(spark, [(1, "some text", "en", "s"), (2, None, "en", "s")])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(df, none)
    assert [r.score for r in toxicity.score(df, model).collect()] == [0.0, 0.0]
    assert toxicity.score(df.limit(0), model).count() == 0


def test_windows_cover_text():
    for n in (0, 1, 47, 48, 49, 80, 81, 1000):
        starts = toxicity.window_starts(n)
        assert starts[0] == 0 and starts[-1] + toxicity.WINDOW >= n and (len(starts) == 1 or starts[-2] + toxicity.WINDOW < n)


def test_license_scan(spark):
    mit = license_texts.MIT.replace("Copyright (c) <year> <copyright holders>", "Copyright (c) 2019 A. N. Author\n© 2020 Another\nAll rights reserved.")
    changed = re.sub(r"\s+", "\n", mit.split("\n\n", 1)[1].split("\n\n", 1)[1].upper()).replace(".", " ;")
    rows = [(1, mit, "en", "s"), (2, mit.replace("sublicense", "sublicence"), "en", "s"), (3, license_texts.ISC, "en", "s"), (4, None, "en", "s"), (5, "", "en", "s"), (6, mit + " more", "en", "s"), (7, "MIT License\n" + changed, "en", "s"), (7, "x " * 50000, "en", "s"), (8, license_texts.KNOWN["BSD-3-Clause"].replace("\n\n", "\r\n\r\n"), "en", "s")]
    out = [(r.doc_id, r.license) for r in license_digest.scan(docs(spark, rows)).collect()]
    assert sorted(out, key=str) == sorted([(1, "MIT"), (2, "MIT"), (3, "ISC"), (4, None), (5, None), (6, None), (7, "MIT"), (7, None), (8, "BSD-3-Clause")], key=str)
    assert license_digest.scan(docs(spark, [])).count() == 0


def test_license_whole_texts(spark):
    """Every known text is found when its case, breaks, punctuation and spellings change, none when a word does."""
    known = license_texts.KNOWN
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0"} < known.keys()
    worn = lambda t: t.upper().replace(" LICENSE ", " Licence ").replace(" ", " \t").replace("\n", "\r\n").replace(",", ";")
    rows = [(k, t, "en", "s") for k, t in enumerate(known.values())] + [(100 + k, worn(t), "en", "s") for k, t in enumerate(known.values())] + [(200 + k, t + " and no more", "en", "s") for k, t in enumerate(known.values())]
    out = {r.doc_id: r.license for r in license_digest.scan(docs(spark, rows)).collect()}
    names = list(known)
    assert [out[k] for k in range(len(names))] == names and all(out[200 + k] is None for k in range(len(names)))
    assert not [n for k, n in enumerate(names) if out[100 + k] != n]


def test_license_phrases_and_ties(spark):
    rows = [(1, "sub-license sub-licenses per cent per cent non-commercial copyright owner copyright owners", "en", "s"), (2, "sublicense sublicenses percent percent noncommercial copyright holder copyright holders", "en", "s"), (3, "word " * 200_000, "en", "s")]
    texts = {"b": "Sublicense, sub-licenses: percent per cent; noncommercial copyright holder copyright holders", "a": "SUBLICENSE sublicenses percent percent noncommercial copyright owner copyright owners", "long": "word " * 200_000}
    assert {r.doc_id: r.license for r in license_digest.scan(docs(spark, rows), texts).collect()} == {1: "a", 2: "a", 3: "long"}


def test_license_digest_value(spark):
    got = license_digest.scan(docs(spark, [(1, "  The LICENCE: don't!\nCopyright 1999 me\n(c) 2001 x\ncopyright law stays", "en", "s")])).first().digest
    assert got == hashlib.sha256(b"the license don t copyright law stays").hexdigest()


def records(spark, rows):
    """(file, offset, record), with further columns whose names clash with the operator's own."""
    return spark.createDataFrame([(f, o, r, "x", 1) for f, o, r in rows], "file string, offset long, record binary, digest string, node long")


@pytest.mark.parametrize("fanout,files,gap", [(2, 1, 1), (4, 3, 700), (64, 40, 1), (64, 2, 10**9)])
def test_merkle_audit(spark, fanout, files, gap):
    """Hundreds of records in several files, equal offsets in different ones, dense and sparse; every tenth damaged."""
    rng = random.Random(fanout)
    base = {(f"f{k % files}", k // files * gap + rng.randrange(gap)): f"record {k}".encode() for k in range(600)}
    worn, want = dict(base), {}
    for place in rng.sample(sorted(base), 60):
        kind = rng.choice(["missing", "corrupt", "extra"])
        want[place if kind != "extra" else (place[0], place[1] + 7 * gap * 600)] = kind
        if kind == "missing":
            del worn[place]
        elif kind == "corrupt":
            worn[place] += b"?"
        else:
            worn[place[0], place[1] + 7 * gap * 600] = b"new"
    rows = lambda d: [(f, o, bytearray(v)) for (f, o), v in d.items()]
    out = {(r.file, r.offset): r for r in warc_audit.audit(records(spark, rows(base)), records(spark, rows(worn)).repartition(5), fanout).collect()}
    assert {k: r.status for k, r in out.items()} == want
    sha = lambda d, k: hashlib.sha256(d[k]).hexdigest() if k in d else None
    assert all((r.primary_sha256, r.replica_sha256) == (sha(base, k), sha(worn, k)) for k, r in out.items())
    assert warc_audit.audit(records(spark, rows(base)).repartition(5), records(spark, rows(base)), fanout).count() == 0


def test_merkle_levels(spark):
    """Sparse byte offsets: each level is smaller than the one below, and there is one root."""
    rows = [(f"f{k % 30}", k * 54321, bytearray(b"r%d" % k)) for k in range(900)]
    bottom = warc_audit.leaves(records(spark, rows))
    sizes = [t.count() for t in warc_audit.tree(bottom, warc_audit.steps(bottom, bottom, 8))]
    assert sizes[0] == 900 and sizes[1] < 400 and sizes[-1] == 1 and sizes == sorted(sizes, reverse=True)


def test_merkle_edges(spark):
    none = records(spark, [])
    one = records(spark, [(None, None, bytearray(b"a")), ("f", 3, bytearray(b"x")), ("f", 3, bytearray(b"x")), ("f", 3, None), ("g", 3, bytearray(b"y" * 1_000_000))])
    two = records(spark, [(None, None, bytearray(b"a")), ("f", 3, bytearray(b"x")), ("f", 3, None), ("g", 3, bytearray(b"y" * 1_000_000))])
    assert warc_audit.audit(none, none).count() == 0
    assert [(r.file, r.offset, r.status) for r in warc_audit.audit(one, two).collect()] == [("f", 3, "corrupt")]
    assert sorted((r.file, r.offset, r.status) for r in warc_audit.audit(one, none).collect()) == [("", -1, "missing"), ("f", 3, "missing"), ("g", 3, "missing")]


def test_warc_record(spark):
    got = spark.createDataFrame([("http://a", "<p>é</p>")], "u string, h string").select(warc_audit.warc_record(F.col("u"), F.col("h"))).first()[0]
    assert bytes(got) == "WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: http://a\r\nContent-Type: text/html\r\nContent-Length: 9\r\n\r\n<p>é</p>\r\n\r\n".encode()


def test_settled_groups_take_no_more_steps(spark, monkeypatch):
    rng = np.random.default_rng(5)
    vectors = [("still", 3, 0, 0, 0)] * 60 + [("moving", *map(int, x)) for x in np.concatenate([rng.normal(400, 30, (150, 4)), rng.normal(300, 90, (150, 4))])]
    rows = spark.createDataFrame(vectors, "grp string, x0 long, x1 long, x2 long, x3 long").cache()
    steps, precision = [], quality_rules._precision
    monkeypatch.setattr(quality_rules, "_precision", lambda sums, floor: steps.append({r.grp for r in sums.collect()}) or precision(sums, floor))
    out = quality_rules.robust_estimates(rows, 0.75, 20, quality_rules.FLOOR).collect()
    # The first is the plain start.
    assert steps[1] == {"still", "moving"} and steps[-1] == {"moving"} and len(out) == 2
