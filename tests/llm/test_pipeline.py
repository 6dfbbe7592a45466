"""The pipeline's stages against brute force, each on its own input, and run() against the stages."""

import random
from collections import Counter, defaultdict

import numpy as np

from plumbline.llm.queries import tokenizer_path
from tests.llm.test_mix_pack_dedup_url import targets
from tests.llm.test_near_dedup import brute, changed
from tests.llm.test_quality_toxicity_license_warc import counts, prose


def table(tmp_path, spark):
    rng = random.Random(8)
    rows = []
    for i in range(120):
        base = prose(rng, rng.randint(60, 200))
        rows.append((i, base, "en", f"s{i % 4}", len(base)))
        if i % 3 == 0:
            rows.append((1000 + i, base, "en", f"s{i % 4}", len(base)))
        if i % 4 == 0:
            rows.append((2000 + i, changed(rng, base, 2), "en", f"s{i % 3}", len(base)))
    junk = [(3000 + i, " ".join(w + "%%%" for w in prose(rng, 100).split()), "en", "s0", 1) for i in range(5)]
    short = [(4000 + i, t, None, None, None) for i, t in enumerate([None, "", "too short", "again and again " * 40])]
    spark.createDataFrame(rows + junk + short, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    return junk, short


def test_stages_and_run(spark, tmp_path):
    import tokenizers

    import corpus_pipeline as pipeline

    junk, short = table(tmp_path, spark)
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, steps = docs.columns, [docs.collect()]
    for k, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"out{k}"))
        docs = spark.read.parquet(str(tmp_path / f"out{k}"))
        assert k == len(pipeline.STAGES) - 1 or docs.columns == columns
        steps.append(docs.collect())
    raw, good, unique, alone, mixed, packed = steps
    gone = {r[0] for r in junk + short}
    assert {r.doc_id for r in good} == {r.doc_id for r in raw} - gone
    assert not any(counts(r.text)[5] for r in good)
    largest = defaultdict(int)
    for r in good:
        largest[r.text] = max(largest[r.text], r.doc_id)
    assert sorted(r.doc_id for r in unique) == sorted(largest.values())
    assert sorted(r.doc_id for r in alone) == sorted(d for d, _, c in brute([(r.doc_id, r.text) for r in unique]) if d == c)
    sizes, taken = Counter(), Counter()
    for r in alone:
        sizes[r.source] += len(r.text.split())
    times = Counter(r.doc_id for r in mixed)
    for r in alone:
        taken[r.source] += times[r.doc_id] * len(r.text.split())
    assert all(abs(taken[s] - t) <= 200 for s, t in targets(sizes).items()) and max(times.values()) <= 3
    exact, texts = tokenizers.Tokenizer.from_file(tokenizer_path()), {r.doc_id: r.text for r in alone}
    found = defaultdict(Counter)
    for p in packed:
        ids = [*exact.encode(texts[p.doc_id], add_special_tokens=False).ids, 0]
        assert np.frombuffer(p.ids, "<u4").tolist() == ids[p.start : p.start + p.length]
        found[p.doc_id][p.start, p.length] += 1
    assert found.keys() == times.keys()
    for d, pieces in found.items():
        assert set(pieces.values()) == {times[d]} and sum(n for _, n in pieces) == len([*exact.encode(texts[d], add_special_tokens=False).ids, 0])
    whole = pipeline.run(spark, str(tmp_path)).collect()
    key = lambda p: (p.doc_id, p.start, p.length, bytes(p.ids))
    assert Counter(map(key, whole)) == Counter(map(key, packed))


def test_stages_on_odd_tables(spark, tmp_path):
    """Each stage on an empty table, and on one with nulls, repeated rows, a very long text and columns of clashing names."""
    import corpus_pipeline as pipeline

    rng = random.Random(9)
    base = [(i, prose(rng, 70), "en", ["a", "", None][i % 3], i) for i in range(60)]
    odd = [(None, None, None, None, None), (None, base[0][1], "en", "a", 1), (None, base[0][1], "en", "a", 1), (500, "", "", "", 0), (501, prose(rng, 60_000), "en", "a", 1), *[base[3]] * 4, (None, " \n\t", None, None, None)]
    clash = "kept boolean, size long, _row string, grp string, label long, ids binary, epochs long, bin int"
    rows = [(*r, False, -1, "r", "g", 3, b"x", 9, 2) for r in base + odd]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {clash}").repartition(3)
    for name, stage in pipeline.STAGES:
        none = stage(spark, docs.limit(0), str(tmp_path))
        assert none.count() == 0, name
        out = stage(spark, docs, str(tmp_path))
        if name == "packing":
            assert out.select("doc_id").distinct().count() == 63
            continue
        assert out.columns == docs.columns == none.columns, name
        left = Counter(r.doc_id for r in out.collect())
        if name == "quality rules":
            assert left == Counter(r[0] for r in rows if r[1] and r[1].strip())
        elif name == "exact dedup":
            assert left == Counter([*range(60), 500, 501, None])
        elif name == "near dedup":
            assert left[3] == 1 and left[501] == 1 and left[None] == 2 and left[500] == 1 and sum(left.values()) == 64
        else:
            assert left[3] % 5 == 0 and set(left) <= {r[0] for r in rows}
