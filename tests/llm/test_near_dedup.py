"""Near dedup against brute force, its parts, and its recall."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from plumbline.llm import graph, near_dedup
from plumbline.sources.shared import cut

SCHEMA = "doc_id long, text string, lang string, source string, key long, grp long, label string, text_hash string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 5, 6, "x", "y") for i, t in rows], SCHEMA).repartition(4)


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """(doc_id, n_shingles, component) by comparing all sets."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        r = find(i)
        ids = [x for x in (least.get(r), doc_id) if x is not None]
        least[r] = min(ids) if ids else None
    return Counter((d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


def word(rng):
    return "".join(rng.choice("abcdefghijklmnop") for _ in range(6))


def changed(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = word(rng)
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    passage = " ".join(word(rng) for _ in range(30))
    rows = []
    for g in range(25):
        base = " ".join(word(rng) for _ in range(rng.randint(60, 200)))
        rows += [(1000 * g + k, changed(rng, base, rng.randint(0, 6)) + (" " + passage if g % 2 else "")) for k in range(rng.randint(1, 8))]
        rows.append((1000 * g + 500, base.upper().replace(" ", "\n\t")))
    chain = " ".join(word(rng) for _ in range(100))
    for k in range(20):
        rows.append((90000 + k, chain))
        words = chain.split()
        words[3 * k % 100 : 3 * k % 100 + 2] = [word(rng), word(rng)]
        chain = " ".join(words)
    short = ["a", "a b", "a b c d", "A b c D", "a b c d e", "a b c d e f", "é é é é é", "É é é é é", "x " * 40, "x " * 60]
    rows += [(200 + i, t) for i, t in enumerate(short)]
    rows += [(300, None), (301, ""), (302, " \n"), (None, rows[0][1]), (None, "null only text of some words"), (None, "null only text of some words"), (400, "twice given row here now"), (400, "twice given row here now"), (401, " ".join(word(rng) for _ in range(20000)))]
    return rows


@pytest.mark.parametrize("options", [{}, {"node_limit": 3, "cluster_limit": 3}, {"node_limit": 5, "max_depth": 0}, {"node_limit": 2, "max_depth": 1, "cluster_limit": 4}])
def test_brute_force(spark, corpus, options):
    out = near_dedup.near_duplicates(docs(spark, corpus), **options).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute(corpus)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_drop(spark, corpus):
    """One row of each component, also where rows share its least doc_id with one text or with several."""
    rng = random.Random(6)
    base = " ".join(word(rng) for _ in range(80))
    more = corpus + [(700, base), (700, changed(rng, base, 1)), (700, base), (701, changed(rng, base, 1)), (702, " "), (702, " ")]
    df = docs(spark, more)
    left = near_dedup.drop_near_copies(df)
    assert left.columns == df.columns
    wordless = [d for d, t in more if not (t or "").strip()]
    assert Counter(r.doc_id for r in left.collect()) == Counter([*{d for d, n, c in brute(more) if d == c and n}, *wordless])


def test_empty(spark):
    assert near_dedup.near_duplicates(docs(spark, [])).count() == 0


def test_shingle_sets_and_tokens():
    a = near_dedup.shingle_set("The quick\x0bbrown fox  jumps over")
    assert len(a) == 2 and (a == near_dedup.shingle_set(" the QUICK brown\nfox jumps over ")).all()
    assert len(near_dedup.shingle_set("a b c")) == 1 and (near_dedup.shingle_set("a b c") != near_dedup.shingle_set("a b")).all()
    assert len(near_dedup.shingle_set("w " * 100)) == 1 and len(near_dedup.shingle_set("\x00 ")) == 1
    rng = np.random.default_rng(1)
    for part in (0.5, 0.75, 0.9):
        x = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
        common = int(2 * part / (1 + part) * 1000)
        pair = np.unique(x[:1000]), np.unique(np.concatenate([x[:common], x[1000 : 2000 - common]]))
        equal = (near_dedup.minwise_tokens(pair[0]) == near_dedup.minwise_tokens(pair[1])).mean()
        assert abs(equal - part) < 0.17


def test_exact_threshold():
    a = np.arange(100, dtype=np.uint64)
    assert near_dedup.alike(a[:75], a) and not near_dedup.alike(a[:74], a) and near_dedup.alike(a[:7], a[1:8]) and not near_dedup.alike(a[:6], a[1:7])


def test_recall_of_borderline_pairs(spark):
    """Pairs just above the threshold, 300 of them: at most one may be missed."""
    rng = random.Random(6)
    rows = []
    for g in range(300):
        base = " ".join(word(rng) for _ in range(200))
        while True:
            other = changed(rng, base, rng.randint(4, 6))
            a, b = shingles(base), shingles(other)
            if 0.75 <= len(a & b) / len(a | b) < 0.82:
                break
        rows += [(2 * g, base), (2 * g + 1, other)]
    out = near_dedup.near_duplicates(docs(spark, rows)).collect()
    assert sum(r.component_id == r.doc_id - 1 for r in out if r.doc_id % 2) >= 299


def test_components(spark):
    rng = random.Random(7)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(300)] + [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(150)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    out = {r.v: r.label for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {v: find(v) for e in edges if e[0] != e[1] for v in e}


def test_sketches_travel_two_coordinates_to_a_byte():
    import pyarrow as pa

    tokens = np.random.default_rng(3).integers(0, 1 << 32, (2, near_dedup.COORDS)).astype("<u4")
    tokens[1, ::3] = tokens[0, ::3]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([t.tobytes() for t in tokens], pa.binary())], ["key", "tokens"])
    sketches = next(near_dedup._sketches(iter([batch]))).column("sketch")
    assert [len(s.as_py()) for s in sketches] == [near_dedup.COORDS // 2] * 2
    a, b = near_dedup._coords(sketches)
    low = tokens & 0xF
    assert (a == b).sum() == (low[0] == low[1]).sum() >= (tokens[0] == tokens[1]).sum() and sorted(a) == sorted(low[0])


def shuffles(spark, work):
    """(bytes, rows) that each stage of work writes for a shuffle."""
    store = spark.sparkContext._jsc.sc().statusStore()
    listed = lambda: store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    before = {listed().apply(i).stageId() for i in range(listed().size())}
    work()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    stages = listed()
    new = [s for s in map(stages.apply, range(stages.size())) if s.stageId() not in before]
    return [(s.shuffleWriteBytes(), s.shuffleWriteRecords()) for s in new if s.shuffleWriteRecords()]


def test_tokens_move_once(spark):
    """Large nodes branch by the tokens of their classes, 512 bytes each, where these are."""
    rng = random.Random(12)
    passage = " ".join(word(rng) for _ in range(30))
    rows = [(i, " ".join(word(rng) for _ in range(300)) + " " + passage) for i in range(150)]
    given = cut(docs(spark, rows))
    written = shuffles(spark, lambda: near_dedup.near_duplicates(given, node_limit=3).count())
    assert sum(b > 400 * r for b, r in written if r >= 50) == 1, written


def test_texts_of_one_id_are_read_by_class(spark):
    """Of rows that share an id, null or not, only those of a cluster's class count for it."""
    rng = random.Random(13)
    base = " ".join(word(rng) for _ in range(80))
    rows = [(i, changed(rng, base, 2)) for i in (None, None, 7, 7, 7, 9)] + [(i, " ".join(word(rng) for _ in range(60))) for i in (None, 7, 9)]
    got = near_dedup.near_duplicates(docs(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows)
