"""MinHash near-dedup by a chosen-path set similarity join.

1. Each text becomes its set of 5-word shingles (64-bit hashes), a class key (a hash of the set), and for
   each of 128 hash functions the minwise token. Equal sets are one class from here on.
2. Trees: at its root each tree selects one minwise token, and a class goes to the node of that token. A
   node with more than `node_limit` classes selects `branches` further tokens, and its classes branch by
   them, down to `max_depth`. `trees` is set by the target recall: at similarity 0.75 a tree joins a
   pair with probability 0.75 if its node is small and still 0.66 after any number of branchings, so 12 trees miss
   2 in 10^6 at worst.
3. A small node is compared exhaustively, by sketches (four bits of each token): pairs of which 60 % agree
   (four standard deviations below 75 %; bits that agree by chance only add candidates) are candidates. A node emits only a spanning forest of them.
4. The forests' components are clusters. Only the texts of clusters with two classes or more are read again, one text
   for a class, and within a cluster candidates are confirmed on the full sets, each pair not yet connected.
5. The confirmed links' components are the result.

Tokens move once, to their class: it stays where it is dealt, and all later joins on its key move only their other side. The
sketches of full sets are taken from the texts again.

A node or cluster over its limit is never gathered: all its classes are compared with one pivot; those that are not
alike it are compared with all classes of the group, in blocks of pairs of bounded size. That is exact:
two classes that both link to the pivot are connected already.

Defined cases: null and empty texts have no shingles and are alone; of fewer than five words the whole sequence is
one shingle; null doc_ids are components of their own doc_id only if no other row is linked; repeated rows are one class;
an empty table gives no rows; extra columns are ignored. Set keys are 64-bit: in 5e10 different texts some 70 pairs share one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import cut_as_dealt, matching, row_key, whole, without
from plumbline.llm.graph import components
from plumbline.sources.shared import cut

WIDTH, SIMILAR, COORDS = 5, 75, 128
#: Sketch coordinates that must agree for a candidate.
LEAST_EQUAL = 77
#: Shingles that count as one class in the size of a cluster, so that long texts can't fill a task.
MEAN_SHINGLES = 4096
#: A doc_id that stands for null inside: larger than any other.
NULL_ID = (1 << 63) - 1

_U = np.uint64
_ODD = np.random.default_rng(20240607).integers(0, 1 << 63, WIDTH + 2, dtype=np.uint64) * _U(2) + _U(1)
_MUL = np.random.default_rng(20240608).integers(0, 1 << 31, COORDS, dtype=np.uint64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = np.random.default_rng(20240609).integers(0, 1 << 32, COORDS, dtype=np.uint64).astype(np.uint32)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """Powers of the base and of its inverse mod 2^64, as many as the longest text so far needs."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(cls.up):
            size = 1 << max(16, n.bit_length())
            cls.up, cls.down = (np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size, b)])) for b in (_BASE, _INVERSE))
        return cls.up, cls.down


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    a = np.frombuffer((text or "").encode("utf-8", "replace").translate(_LOWER), np.uint8)
    if not len(a):
        return np.empty(0, np.uint64)
    edges = np.diff(np.concatenate([[False], ~_SPACE[a], [False]]).astype(np.int8))
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(start):
        return np.empty(0, np.uint64)
    up, down = _Powers.of(len(a))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(a.astype(np.uint64) * up[: len(a)], dtype=np.uint64)])
    words = _mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * _ODD[WIDTH])
    n = len(words)
    if n < WIDTH:
        return _mix(np.array([(words * _ODD[:n]).sum(dtype=np.uint64)], np.uint64) + np.array([n], np.uint64) * _ODD[WIDTH + 1])
    return np.unique(_mix(sum((words[k : n - WIDTH + 1 + k] * _ODD[k] for k in range(WIDTH)), np.zeros(n - WIDTH + 1, np.uint64))))


def minwise_tokens(shingles: np.ndarray) -> np.ndarray:
    """For each hash function the shingle with the least value, as 32 bits of its hash."""
    x = (shingles >> _U(32)).astype(np.uint32)
    step = max(1, (1 << 18) // len(x))
    first = np.concatenate([(_MUL[k : k + step, None] * x + _ADD[k : k + step, None]).argmin(axis=1) for k in range(0, COORDS, step)])
    return (_mix(shingles[first]) & _U(0xFFFFFFFF)).astype(np.uint32)


def _key(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, keys, tokens = [], [], []
        for text in batch.column(2):
            s = shingle_set(text.as_py())
            sizes.append(len(s))
            keys.append(_key(s) if len(s) else None)
            tokens.append(minwise_tokens(s).tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), pa.array(tokens, pa.binary())], ["doc_id", "text_hash", "n_shingles", "key", "tokens"])


def _fixed(column: pa.Array, width: int, kind) -> np.ndarray:
    """A binary column whose values all have `width` items, as a matrix."""
    if not len(column):
        return np.empty((0, width), kind)
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def _packed(tokens: np.ndarray) -> pa.Array:
    """Sketches of rows of tokens."""
    low = (tokens & 0xF).astype(np.uint8)
    return pa.array([r.tobytes() for r in low[:, ::2] | low[:, 1::2] << 4], pa.binary())


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), _packed(_fixed(batch.column(1), COORDS, "<u4"))], ["key", "sketch"])


def _coords(sketches: pa.Array) -> np.ndarray:
    """A column of sketches as a matrix of their coordinates. They travel two to a byte: sketches are most of what is shuffled."""
    packed = _fixed(sketches, COORDS // 2, np.uint8)
    return np.concatenate([packed & 0xF, packed >> 4], axis=1)


def _child(node: np.ndarray, coord: np.ndarray, token: np.ndarray) -> np.ndarray:
    return _mix(_mix(node ^ _mix(coord.astype(np.uint64) + _U(1))) + token.astype(np.uint64))


def _roots(trees: int):
    """Each class's first node in each tree: (key, node). Trees select different coordinates as long as there are any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.random.default_rng(7).permutation(COORDS)
        picked = np.array([order[t % COORDS] for t in range(trees)])
        root = _mix(np.arange(trees, dtype=np.uint64) + _U(11))
        for batch in batches:
            tokens = _fixed(batch.column(1), COORDS, "<u4")
            nodes = _child(root[None, :], picked[None, :], tokens[:, picked])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), trees)), pa.array(nodes.ravel().view(np.int64))], ["key", "node"])

    return run


def _branch(branches: int):
    """(key, node, tokens) to the children of the node: those of the coordinates whose hash with the node is least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, node = _fixed(batch.column(2), COORDS, "<u4"), batch.column(1).to_numpy().view(np.uint64)
            rank = _mix(node[:, None] + np.arange(1, COORDS + 1, dtype=np.uint64) * _ODD[0])
            coord = np.argpartition(rank, branches, axis=1)[:, :branches] if len(node) else np.empty((0, branches), int)
            children = _child(node[:, None], coord, np.take_along_axis(tokens, coord, axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), branches)), pa.array(children.ravel().view(np.int64))], ["key", "node"])

    return run


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the sets' similarity is at least SIMILAR percent."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < SIMILAR * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    common = int((large[at] == small).sum())
    return 100 * common >= SIMILAR * (len(a) + len(b) - common)


def link(keys: np.ndarray, sketches: np.ndarray, sets: list[np.ndarray] | None, sides: np.ndarray | None) -> list[tuple[int, int]]:
    """Star edges (least key, key) of the components among keys; without sets by sketches alone. sides: only pairs with a 1."""
    m = len(keys)
    parent = list(range(m))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    left = m
    for i in range(m - 1):
        if left == 1:
            break
        near = np.flatnonzero((sketches[i + 1 :] == sketches[i]).sum(axis=1) >= LEAST_EQUAL) + i + 1
        for j in near.tolist():
            if sides is not None and not (sides[i] or sides[j]):
                continue
            a, b = find(i), find(j)
            if a != b and (keys[i] == keys[j] or sets is None or alike(sets[i], sets[j])):
                parent[max(a, b)] = min(a, b)
                left -= 1
    least: dict[int, int] = {}
    for i in range(m):
        r = find(i)
        least[r] = min(least.get(r, int(keys[i])), int(keys[i]))
    return [(least[find(i)], int(keys[i])) for i in range(m) if int(keys[i]) != least[find(i)]]


def _link_sorted(exact: bool, sided: bool):
    """Rows (grp, key, sketch, side[, shingles]) sorted by grp to edges (a, b), a group at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def work(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(parts).combine_chunks()
            if not table.num_rows:
                return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, ["a", "b"])
            grp, keys, sides = (table.column(c).to_numpy() for c in ("grp", "key", "side"))
            sketches = _coords(table.column("sketch").chunk(0))
            cuts = np.flatnonzero(np.diff(grp)) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(grp)]])
            edges: list[tuple[int, int]] = []
            size = ends - starts
            if not exact and not sided:  # pairs, by far the most, all at once
                first = starts[size == 2]
                same = (sketches[first] == sketches[first + 1]).sum(axis=1) >= LEAST_EQUAL
                edges += zip(keys[first[same]].tolist(), keys[first[same] + 1].tolist(), strict=True)
                starts, ends = starts[size > 2], ends[size > 2]
            column = table.column("shingles").chunk(0) if exact else None
            for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
                if e - s > 1:
                    sets = [np.frombuffer(x.as_py(), np.uint64) for x in column[s:e]] if exact else None
                    edges += link(keys[s:e], sketches[s:e], sets, sides[s:e] if sided else None)
            a, b = zip(*edges, strict=True) if edges else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            grp = batch.column(0).to_numpy()
            last = int(np.flatnonzero(grp == grp[-1])[0])
            if last == 0:  # the batch is one group, perhaps the one held
                if held and held[-1].column(0)[-1].as_py() != int(grp[0]):
                    yield work(held)
                    held = []
                held.append(batch)
                continue
            held.append(batch.slice(0, last))
            yield work(held)
            held = [batch.slice(last)]
        if held:
            yield work(held)

    return run


def _near_pivot(exact: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = (_coords(batch.column("sketch")) == _coords(batch.column("pivot_sketch"))).sum(axis=1) >= LEAST_EQUAL
            if exact:
                for i in np.flatnonzero(near).tolist():
                    near[i] = alike(*(np.frombuffer(batch.column(c)[i].as_py(), np.uint64) for c in ("shingles", "pivot_shingles")))
            near |= batch.column("key").to_numpy() == batch.column("pivot_key").to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column("grp"), batch.column("key"), batch.column("pivot_key"), pa.array(near)], ["grp", "key", "pivot_key", "near"])

    return run


def _linked(entries: DataFrame, exact: bool, sided: bool) -> DataFrame:
    columns = ["grp", "key", "sketch", "side", *(["shingles"] if exact else [])]
    dealt = entries.select(*columns).repartition("grp").sortWithinPartitions("grp", "key")
    return dealt.mapInArrow(_link_sorted(exact, sided), "a long, b long")


def link_groups(entries: DataFrame, sizes: DataFrame, limit: int, exact: bool) -> DataFrame:
    """Edges (a, b) that connect what is alike within each group of entries (grp, key, sketch[, shingles]); sizes (grp, n): cut."""
    entries = entries.withColumn("side", F.lit(0))
    big = cut(sizes.filter(F.col("n") > limit).select("grp", F.ceil(F.col("n") / limit).cast("int").alias("parts")))
    if big.isEmpty():
        return _linked(entries, exact, False)
    small = _linked(entries.join(big, "grp", "left_anti"), exact, False)
    payload = ["sketch", *(["shingles"] if exact else [])]
    members = entries.join(big, "grp")
    pivots = cut(members.groupBy("grp").agg(F.min(F.struct("key", *payload)).alias("p")).select("grp", F.col("p.key").alias("pivot_key"), *[F.col(f"p.{c}").alias(f"pivot_{c}") for c in payload]))
    judged = cut(members.join(pivots, "grp").mapInArrow(_near_pivot(exact), "grp long, key long, pivot_key long, near boolean"))
    stars = judged.filter("near and key <> pivot_key").select(F.col("pivot_key").alias("a"), F.col("key").alias("b"))
    rest = cut(judged.groupBy("grp").agg(F.count("*").alias("n"), F.count(F.when(~F.col("near"), 1)).alias("r")).filter("r > 0"))
    if rest.isEmpty():
        return small.unionByName(stars)
    blocks = rest.join(big, "grp").select("grp", F.col("parts").alias("cols"), F.ceil(F.col("r") / F.col("n") * F.col("parts")).cast("int").alias("rows"))
    both = members.drop("side", "parts").join(judged.select("grp", "key", "near"), ["grp", "key"]).join(blocks, "grp")
    row, col = F.pmod(F.xxhash64("key"), F.col("rows")), F.pmod(F.xxhash64("key"), F.col("cols"))
    across = both.filter("not near").withColumn("at", F.explode(F.sequence(F.lit(0), F.col("cols") - 1))).withColumn("grp", F.xxhash64("grp", row.cast("long"), F.col("at").cast("long"))).withColumn("side", F.lit(1))
    down = both.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("rows") - 1))).withColumn("grp", F.xxhash64("grp", F.col("at").cast("long"), col.cast("long"))).withColumn("side", F.lit(0))
    dealt = across.select("grp", "key", "side", *payload).unionByName(down.select("grp", "key", "side", *payload))
    return small.unionByName(stars).unionByName(_linked(dealt, exact, True))


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, key, grp) to (grp, key, sketch, shingles) where the key is that of the text's set."""
    for batch in batches:
        grps, keys, tokens, sets = [], [], [], []
        for text, key, grp in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            s = shingle_set(text.as_py())
            if len(s) and _key(s) == key:
                grps.append(grp)
                keys.append(key)
                tokens.append(minwise_tokens(s))
                sets.append(s.tobytes())
        sketches = _packed(np.array(tokens, np.uint32).reshape(len(tokens), COORDS))
        yield pa.RecordBatch.from_arrays([pa.array(grps, pa.int64()), pa.array(keys, pa.int64()), sketches, pa.array(sets, pa.binary())], ["grp", "key", "sketch", "shingles"])


def _nodes(classes: DataFrame, trees: int, branches: int, max_depth: int, node_limit: int) -> tuple[DataFrame, DataFrame]:
    """Entries (grp, key) of all nodes that are compared, and their sizes (grp, n)."""
    entries = classes.select("key", "tokens").mapInArrow(_roots(trees), "key long, node long")
    found = []
    for depth in range(max_depth + 1):
        counted = entries.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1")
        placed = cut(entries.join(counted, "node"))
        if depth == max_depth:
            found.append(placed)
            break
        found.append(placed.filter(F.col("n") <= node_limit))
        large = placed.filter(F.col("n") > node_limit)
        if large.isEmpty():
            break
        entries = large.select("key", "node").join(classes.select("key", "tokens"), "key").select("key", "node", "tokens").mapInArrow(_branch(branches), "key long, node long")
    nodes = found[0]
    for more in found[1:]:
        nodes = nodes.unionByName(more)
    nodes = nodes.withColumnRenamed("node", "grp")
    return nodes.select("grp", "key"), nodes.filter(F.col("n") > node_limit).select("grp", "n").distinct()


def near_duplicates(docs: DataFrame, trees: int = 12, branches: int = 2, max_depth: int = 3, node_limit: int = 2000, cluster_limit: int = 2000) -> DataFrame:
    """One row for each document: doc_id, text_hash, n_shingles, component_id, kept, label (equal within a component; null without words)."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(whole()).alias("text_hash"), whole().alias("text"))
    described = cut(base.mapInArrow(_describe, "doc_id long, text_hash long, n_shingles long, key long, tokens binary"))
    rows = described.select("doc_id", "text_hash", "n_shingles", "key")
    order = F.coalesce("doc_id", F.lit(NULL_ID))
    firsts = described.filter("key is not null").groupBy("key").agg(F.min(F.struct(order.alias("id"), "text_hash")).alias("first"), F.first("n_shingles").alias("n_shingles"), F.first("tokens").alias("tokens"))
    classes = cut_as_dealt(firsts.select("key", F.col("first.id").alias("first_id"), F.xxhash64("first.id", "first.text_hash").alias("first_row"), "n_shingles", "tokens"))
    sketches = classes.select("key", "tokens").mapInArrow(_sketches, "key long, sketch binary")

    nodes, large = _nodes(classes, trees, branches, max_depth, node_limit)
    candidates = cut(link_groups(nodes.join(sketches, "key"), large, node_limit, exact=False))
    clusters = components(candidates)

    members = cut(clusters.withColumnRenamed("v", "key").withColumnRenamed("label", "grp").join(classes.select("key", "first_row", "n_shingles"), "key"))
    rows_read = base.withColumn("doc_id", order).withColumn("_row", F.xxhash64("doc_id", "text_hash"))
    texts = matching(rows_read, members.select(F.col("first_row").alias("_row"), "key", "grp"), "_row", "inner")
    sets = texts.select("text", "key", "grp").mapInArrow(_full_sets, "grp long, key long, sketch binary, shingles binary")
    # A cluster's size: its classes, or its shingles in units of MEAN_SHINGLES if they are many.
    sizes = cut(members.groupBy("grp").agg(F.greatest(F.count("*"), F.ceil(F.sum("n_shingles") / MEAN_SHINGLES)).alias("n")))
    links = components(cut(link_groups(sets, sizes, cluster_limit, exact=True)))

    named = classes.select("key", "first_id").join(links.withColumnRenamed("v", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    firsts = named.groupBy("label").agg(F.min("first_id").alias("component"))
    labelled = named.select("key", "label").join(firsts, "label").select("key", "label", "component")
    out = rows.join(labelled, "key", "left")
    component = F.when(F.col("component").isNull(), F.col("doc_id")).when(F.col("component") != NULL_ID, F.col("component"))
    return out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "label")


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """docs with one row of each component, columns as they are: that with the least doc_id, and of rows that share it one.

    Documents without words are linked with nothing and all stay.
    """
    judged = cut(near_duplicates(docs, **options).filter("label is not null").select(row_key(F.col("text_hash")).alias("_row"), "label", "kept"))
    several = cut(judged.filter("kept").groupBy("label").agg(F.count("*").alias("n"), F.min("_row").alias("_first")).filter("n > 1"))
    others = judged.filter("kept").join(several, "label").filter("_row <> _first")
    dropped = judged.filter("not kept").select("_row").unionByName(others.select("_row")).distinct()
    return without(docs, F.xxhash64(whole()), dropped, several.select(F.col("_first").alias("_row")))
