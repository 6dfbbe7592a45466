"""Suffix dedup against brute force, and its parts."""

import random
from collections import Counter

import numpy as np
import pytest

from plumbline.llm import suffix_dedup as sd
from plumbline.sources.shared import cut
from tests.llm.test_near_dedup import shuffles

SCHEMA = "doc_id long, text string, lang string, source string, block long, kept boolean, removed int"


def docs(spark, rows, parts=4):
    return spark.createDataFrame([(i, t, "en", "s", 5, True, 1) for i, t in rows], SCHEMA).repartition(parts)


def brute(rows, length=50):
    first = {}
    data = [((1 << 63) - 1 if i is None else i, i, (t or "").encode()) for i, t in rows]
    for key, _, b in data:
        for s in range(len(b) - length + 1):
            x = b[s : s + length]
            first[x] = min(first.get(x, key), key)
    out = Counter()
    for key, i, b in data:
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            if first[b[s : s + length]] < key:
                gone[s : s + length] = [True] * length
        runs, at = [], 0
        while at < len(b):
            if gone[at]:
                e = at
                while e < len(b) and gone[e]:
                    e += 1
                runs.append((at, e))
                at = e
            at += 1
        out[i, len(b), tuple(runs), bytes(x for x, g in zip(b, gone, strict=True) if not g)] += 1
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé \n") for _ in range(rng.randint(1, 7))) for _ in range(40)]
    text = lambda k: " ".join(rng.choice(words) for _ in range(k))
    passages = [text(rng.randint(8, 60)) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [text(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            cutoff = rng.randint(0, max(0, len(p) - 40))
            parts += [p if rng.random() < 0.5 else p[cutoff : cutoff + rng.randint(45, 120)], text(rng.randint(0, 10))]
        rows.append((i * 3 % 61, "".join(parts)))
    rows += [(100 + i, rows[5][1]) for i in range(5)] + [(7, rows[9][1]), (7, rows[9][1]), (None, rows[5][1]), (None, passages[0] * 3), (200, None), (201, ""), (202, "a" * 49), (203, "a" * 50), (204, "a" * 300), (205, "b" + "a" * 120 + "c"), (206, "ab" * 100), (207, "\x00" * 80), (208, "\x00" * 60 + "x"), (209, passages[1] * 200), (210, "é" * 30), (211, "xé" + "é" * 29)]
    return rows


def got(df):
    return Counter((r.doc_id, r.n_bytes, tuple((x.start, x.end) for x in r.removed), bytes(r.kept)) for r in df.collect())


@pytest.mark.parametrize("seed,hot", [(1, 256), (2, 1), (3, 3)])
def test_brute_force(spark, seed, hot):
    rows = corpus(seed)
    assert got(sd.remove_repeats(docs(spark, rows), owners=3, hot_blocks=hot)) == brute(rows)


def test_brute_force_often(spark):
    """Anchors that are hot because several blocks hold them often."""
    rows = corpus(5) + [(400 + i, corpus(5)[9][1] + "tail %d" % i) for i in range(8)]
    assert got(sd.remove_repeats(docs(spark, rows, 8), owners=5, many=1)) == brute(rows)


def test_hot_strings_by_salted_join(spark):
    """A passage in every block: its strings are reduced in two levels, and nothing collects a string's places."""
    passage = "the passage that all documents of all blocks share, word by word, to its very end. "
    rows = [(i, f"{i} own words " * 3 + passage + f" and {i} more") for i in range(64)]
    out = sd.remove_repeats(docs(spark, rows, 16), hot_blocks=4)
    assert got(out) == brute(rows)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min(least" in plan and "salt" in plan


def test_equal_hashes_are_told_apart_by_bytes(spark, monkeypatch):
    """Where the hash of contexts has few values, their bytes decide."""
    real = sd._row_hash
    monkeypatch.setattr(sd, "_row_hash", lambda rows, *more: real(rows, *more) % np.uint64(3))
    rng = np.random.default_rng(3)
    rows = rng.integers(97, 99, (200, 4)).astype(np.uint8)
    keys, lo = [rng.integers(0, 4, 200)], rng.integers(0, 2, 200)
    order, new = sd._sorted_equal(keys, rows, lo)
    classes = (np.cumsum(new) - 1).tolist()
    seen = {}
    for c, i in zip(classes, order.tolist(), strict=True):
        assert seen.setdefault((int(keys[0][i]), bytes(rows[i]), int(lo[i])), c) == c
    assert len(seen) == classes[-1] + 1 and (np.diff(keys[0][order]) >= 0).all()
    assert sd._sorted_equal([], np.empty((0, 8), np.uint8))[1].tolist() == []
    texts = corpus(6)
    assert got(sd.remove_repeats(docs(spark, texts), owners=2)) == brute(texts)


def test_owners_follow_the_input(spark, tmp_path):
    """Owners are at least as many as the scan's partitions, which follow its bytes."""
    rows = corpus(7)
    docs(spark, rows, 24).write.parquet(str(tmp_path / "d"))
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        df = spark.read.parquet(str(tmp_path / "d"))
        assert sd.owners_of(df) >= 24 and got(sd.remove_repeats(df)) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_blocks_stay_in_place(spark):
    """Texts are dealt once: the passes after it shuffle what comes back, not the blocks."""
    rows = corpus(4)
    out = sd.remove_repeats(docs(spark, rows, 7))
    plan = out._jdf.queryExecution().executedPlan().toString()
    kept, _, side = plan.partition("ShuffledHashJoin")[2].partition("Exchange")
    assert "Scan ExistingRDD" in kept and side
    assert got(out) == brute(rows)


def test_empty(spark):
    assert sd.remove_repeats(docs(spark, [])).count() == 0
    assert got(sd.remove_repeats(docs(spark, [(1, None), (2, "short")]))) == brute([(1, None), (2, "short")])


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(0, [2, 3, 4, 256, 1, 30][seed], 400).astype(np.uint8)
    depth = [8, 20, 50, 50, 50, 9][seed]
    order = sd.suffix_array(text, depth)
    data = text.tobytes() + b"\0" * (depth + 8)
    prefixes = [data[i : i + depth] for i in order]
    assert sorted(order.tolist()) == list(range(400)) and prefixes == sorted(prefixes)
    same = sd.same_prefix(text, order, depth)
    assert same.tolist() == [k > 0 and prefixes[k] == prefixes[k - 1] for k in range(400)]


def test_anchors_are_the_same_in_every_document():
    rng = np.random.default_rng(9)
    text = rng.integers(97, 100, 3000).astype(np.uint8)
    ends = np.array([700, 749, 1500, 1500, 3000])
    places, hashes = sd.anchors(text, ends)
    known = dict(zip(places.tolist(), hashes.tolist(), strict=True))
    for s, e in zip([0, *ends[:-1]], ends, strict=True):
        alone = sd.anchors(text[s:e], np.array([e - s]))
        assert {int(p) + s: int(h) for p, h in zip(*alone, strict=True)} == {p: h for p, h in known.items() if s <= p < e}
        for start in range(s, e - 49):
            assert any(p in known for p in range(start, start + 31))


def test_united():
    doc, first, end = sd._united(*(np.array(x) for x in ([2, 1, 1, 1, 2], [0, 60, 0, 55, 50], [50, 110, 50, 105, 90])))
    assert list(zip(doc.tolist(), first.tolist(), end.tolist(), strict=True)) == [(1, 0, 50), (1, 55, 110), (2, 0, 90)]


def test_hot_anchors_with_many_contexts(spark, monkeypatch):
    """Contexts of an anchor that are too many to be sorted at a time are compared string by string, with the same result."""
    rows = corpus(4)
    assert got(sd.remove_repeats(docs(spark, rows, 8), owners=3, hot_blocks=2)) == brute(rows)
    monkeypatch.setattr(sd, "SORT_ROWS", 3)
    assert got(sd.remove_repeats(docs(spark, rows, 8), owners=3, hot_blocks=2)) == brute(rows)


def test_blocks_send_contexts_of_hot_anchors(spark):
    """A context of a hot anchor is one row, not one for each of its strings: disk followed these where blocks are many (F1)."""
    passage = "the passage that all documents of all blocks share, word by word, to its very end. "
    rows = [(i, f"{i} own words " * 3 + passage + f" and {i} more") for i in range(64)]
    given = cut(docs(spark, rows, 16))
    sent = lambda hot: sum(n for _, n in shuffles(spark, lambda: sd.remove_repeats(given, owners=4, hot_blocks=hot).collect()))
    assert sent(4) < sent(1 << 20) + 16 * 6 * 20
