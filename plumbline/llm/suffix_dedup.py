"""Suffix-array dedup of byte strings that repeat across documents.

A byte is removed if a string of `length` bytes that covers it also starts in a document with a smaller doc_id.

1. Documents are packed into blocks of some MB (compressed, dealt once by block, cut): the unit of all passes. Later
   passes join what comes back to the blocks in place; only hashes, contexts and verdicts move.
2. Every string of `length` bytes holds an anchor: the GRAM-byte gram with the least hash among its grams, the same one
   wherever the string occurs. Blocks send their anchors' fingerprints to owners as Golomb-coded lists and
   receive bitmaps of those that are in two documents, and of hot ones (in very many blocks, or very often in several).
3. For each shared anchor the block sends its contexts, all strings through the anchor, with the least document of each to
   the anchor's owner. Equal contexts of a block, compared by their bytes, travel once; places stay in the block.
4. An owner lays the different contexts of its anchors end to end and sorts their suffixes in two stages: those smaller than
   their successor directly, the others induced by bucket scans. Adjacent suffixes with `length` common bytes
   are one string. For each context the block gets back the least document that has it, and which part of it is in
   a document smaller than that.
5. A hot anchor's contexts are reduced on their own in two levels, by bytes: each task sends one row for a context with its least
   document, however often it occurs. What is left, each different context once, is dealt by anchor, and its suffixes are sorted as
   above. Only the contexts of an anchor that has more than are sorted at a time are taken apart into their strings, of which each
   task again sends one row with the least document. What comes back to the blocks is joined on (context, salt). So no owner gathers
   a hot passage.
6. The block finds its contexts again and judges each place by its own document: the intervals are united and cut from the texts.

Owners follow the input's bytes (OWNER_BYTES each) and a task holds one owner's contexts at a time: of an anchor that isn't hot
at most HOT_BLOCKS * MANY and those of three blocks.

Defined cases: null text is empty; texts shorter than `length` lose nothing; a null doc_id counts as larger than any other; rows
that share a doc_id don't remove each other's bytes; an empty table gives no rows; extra columns are ignored. HOT_BLOCKS, MANY
and OWNER_BYTES change where strings meet, not the result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import cut_by, look_up, tasks
from plumbline.llm.exact_dedup import golomb_decode, golomb_encode, rice_parameter
from plumbline.sources.shared import cut, free_shuffles, written

LENGTH, GRAM, BITS = 50, 20, 48
BLOCK_BYTES, STEP_BYTES = 4 << 20, 1 << 20
#: Contexts that are taken from a block's text at a time.
STEP_ROWS = 1 << 14
#: An anchor is hot from so many blocks on, or if MANY_BLOCKS blocks hold it MANY times.
HOT_BLOCKS, MANY, MANY_BLOCKS = 256, 4096, 4
#: Input for each owner, and salts among which a hot context's verdict is dealt.
OWNER_BYTES, SALTS = 4 << 20, 16
#: Text of different contexts whose suffixes are sorted at a time.
SORT_BYTES = 2 << 20
SORT_ROWS = SORT_BYTES // (2 * LENGTH - GRAM + 1)
NULL_ID = (1 << 63) - 1

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_ODD = np.random.default_rng(20240701).integers(0, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)


def _pack(*things) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(things, protocol=5))


def _unpack(data: bytes) -> tuple:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(29))


# Suffixes


def _words(text: np.ndarray) -> np.ndarray:
    """At each place its next 8 bytes as a big-endian number (zeros after the end)."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(text), np.uint64)
    for k in range(8):
        out = out << _U(8) | padded[k : k + len(text)]
    return out


def _offsets(depth: int) -> list[int]:
    """Places of words that cover depth bytes."""
    return [*range(0, max(1, depth - 7), 8), *([depth - 8] if depth > 8 and depth % 8 else [])]


def suffix_array(text: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Suffixes of text (uint8) in the order of their first `depth` bytes at least, sorted in two stages."""
    n = len(text)
    if n == 0:
        return np.empty(0, np.int64)
    # A suffix is smaller than its successor if the first byte that differs from the next one is smaller.
    differs = np.append(text[:-1] != text[1:], True)
    turn = np.where(differs, np.arange(n), n)
    turn = np.minimum.accumulate(turn[::-1])[::-1]
    smaller = (turn < n - 1) & (text[turn] < text[np.minimum(turn + 1, n - 1)])
    # First stage: the smaller ones are sorted directly.
    own = np.flatnonzero(smaller)
    words = np.concatenate([_words(text), np.zeros(depth + 8, np.uint64)])
    order = own[np.lexsort([words[own + k] for k in reversed(_offsets(depth))])]
    # Second stage: within a first byte's bucket the others come first, and scanning the buckets in order places them.
    sizes, below = np.bincount(text, minlength=256), np.bincount(text[~smaller], minlength=256)
    first = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(n, np.int64)
    heads = first[:-1].copy()
    firsts = text[order]
    split = np.searchsorted(firsts, np.arange(257))

    def induce(found: np.ndarray) -> None:
        before = found - 1
        before = before[before >= 0]
        before = before[~smaller[before]]
        if len(before):
            letters = text[before]
            before = before[np.argsort(letters, kind="stable")]
            counts = np.bincount(letters, minlength=256)
            at = 0
            for c in np.flatnonzero(counts).tolist():
                out[heads[c] : heads[c] + counts[c]] = before[at : at + counts[c]]
                heads[c] += counts[c]
                at += counts[c]

    induce(np.array([n]))
    for c in np.flatnonzero(sizes).tolist():
        done = first[c]
        while done < heads[c]:
            begin, done = done, heads[c]
            induce(out[begin:done])
        out[first[c] + below[c] : first[c + 1]] = order[split[c] : split[c + 1]]
        induce(order[split[c] : split[c + 1]])
    return out


def same_prefix(text: np.ndarray, order: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Whether each suffix in order shares `length` bytes with the one before it."""
    words = np.concatenate([_words(text), np.zeros(length + 8, np.uint64)])
    same = np.zeros(len(order), bool)
    alive = np.arange(1, len(order))
    for k in _offsets(length):
        alive = alive[words[order[alive] + k] == words[order[alive - 1] + k]]
    same[alive] = True
    return same


def marked_intervals(contexts: list[np.ndarray], docs: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For each context of a document (first, end) of its strings that occur in a context of a smaller document; (0, 0) if none."""
    sizes = np.array([len(c) for c in contexts])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    text = np.concatenate([x for c in contexts for x in (c, np.zeros(1, np.uint8))])
    owner = np.repeat(np.arange(len(contexts)), sizes + 1)
    order = suffix_array(text, length)
    strings = np.cumsum(~same_prefix(text, order, length)) - 1
    inside = order + length <= (starts + sizes)[owner[order]]
    order, strings = order[inside], strings[inside]
    least = np.full(strings[-1] + 1 if len(strings) else 0, NULL_ID)
    np.minimum.at(least, strings, docs[owner[order]])
    marked = order[docs[owner[order]] > least[strings]]
    first, end = np.full(len(contexts), len(text)), np.zeros(len(contexts), np.int64)
    np.minimum.at(first, owner[marked], marked)
    np.maximum.at(end, owner[marked], marked + length)
    return np.where((end > 0)[:, None], np.stack([first - starts, end - starts], axis=1), 0)


# Blocks and anchors


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, texts, size = [], [], 0

    def block() -> pa.RecordBatch:
        known = np.array([i is not None for i in ids])
        data = _pack(np.array([NULL_ID if i is None else i for i in ids], np.int64), known, np.array([len(t) for t in texts], np.int64), b"".join(texts))
        return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["docs"])

    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids.append(i)
            texts.append((text.as_py() or "").encode("utf-8", "replace"))
            size += len(texts[-1])
            if size >= BLOCK_BYTES:
                yield block()
                ids, texts, size = [], [], 0
    if ids:
        yield block()


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """best over each width neighbours, in log2(width) steps."""
    step = 1
    while 2 * step <= width:
        x = best(x[:-step], x[step:])
        step *= 2
    return best(x[: len(x) - (width - step)], x[width - step :]) if width > step else x


def anchors(text: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Places and gram hashes of the anchors of all strings of `length` bytes within the documents that end at `ends`."""
    width = length - gram + 1
    if len(text) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    up, down = _powers(len(text) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((text.astype(np.uint64) + _U(1)) * up[: len(text)], dtype=np.uint64)])
    hashes = _mix((total[gram:] - total[:-gram]) * down[: len(text) - gram + 1]) | _U(1)
    least = _sliding(hashes, width, np.minimum)
    # A window that leaves its document chooses nothing.
    for e in ends[ends < len(text)].tolist():
        least[max(0, e - length + 1) : e] = 0
    none = np.zeros(width - 1, np.uint64)
    chosen = _sliding(np.concatenate([none, least, none]), width, np.maximum)
    places = np.flatnonzero(hashes == chosen[: len(hashes)])
    return places, hashes[places]


_table: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_table.get("up", ())) < n:
        size = 1 << max(21, n.bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            _table[name] = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size, base, np.uint64)]))
    return _table["up"], _table["down"]


class _Block:
    """A block's documents with their anchors: fp, place (in the block's text) and doc (ordinal), in the order of the text."""

    def __init__(self, data: bytes):
        self.ids, self.known, self.sizes, text = _unpack(data)
        self.text = np.frombuffer(text, np.uint8)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes

    def find(self) -> None:
        fps, places, first = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0
        while first < len(self.ids):
            base = self.starts[first]
            last = max(first + 1, int(np.searchsorted(self.ends, base + STEP_BYTES)))
            at, h = anchors(self.text[base : self.ends[last - 1]], self.ends[first:last] - base)
            places.append(at + base)
            fps.append(h >> _U(64 - BITS))
            first = last
        self.fp, self.place = np.concatenate(fps), np.concatenate(places)
        self.doc = np.searchsorted(self.ends, self.place, side="right")


def _messages(owners: int, many: int):
    step = -(-(1 << BITS) // owners)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                b = _Block(data.as_py())
                b.find()
                order = np.lexsort([b.doc, b.fp])
                fps, first = np.unique(b.fp[order], return_index=True)
                if not len(fps):
                    continue
                docs, ends = b.doc[order], np.append(first[1:], len(order))
                twice, often = docs[first] != docs[ends - 1], ends - first >= many
                cuts = np.searchsorted(fps, np.arange(1, owners, dtype=np.uint64) * _U(step))
                rows = []
                for owner, (f, t, o) in enumerate(zip(np.split(fps, cuts), np.split(twice, cuts), np.split(often, cuts), strict=True)):
                    if len(f):
                        k = rice_parameter(len(f), step)
                        rows.append((name, owner, len(f), k, golomb_encode(f - _U(owner * step), k), np.packbits(t).tobytes(), np.packbits(o).tobytes() if o.any() else b""))
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["block", "owner", "n", "k", "coded", "twice", "often"])

    return run


def _bits(data: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Bitmaps one after the other; an empty one has no bit set."""
    return np.concatenate([np.unpackbits(np.frombuffer(d, np.uint8))[:n].astype(bool) if d else np.zeros(n, bool) for d, n in zip(data, sizes, strict=True)])


def _decide(hot_blocks: int):
    """An owner's messages to bitmaps of the fingerprints that are in two documents, and of the hot ones."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = pdf.n.to_numpy()
        values, where, counts = np.unique(np.concatenate([golomb_decode(d, n, k) for d, n, k in zip(pdf.coded, sizes, pdf.k, strict=True)]), return_inverse=True, return_counts=True)
        shared = counts > 1
        shared[where[_bits(pdf.twice, sizes)]] = True
        often = np.bincount(where[_bits(pdf.often, sizes)], minlength=len(values))
        hot = shared & ((counts >= hot_blocks) | (often >= MANY_BLOCKS))
        cuts = np.cumsum(sizes)[:-1]
        bitmaps = ([np.packbits(b).tobytes() if b.any() else b"" for b in np.split(x[where], cuts)] for x in (shared, hot))
        return pd.DataFrame(dict(zip(("block", "owner", "n", "shared", "hot"), (pdf.block, pdf.owner, pdf.n, *bitmaps), strict=True)))

    return run


# Contexts


def _inside(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Which bytes of context rows (LENGTH - GRAM before the anchor, LENGTH from it on) belong to the context."""
    along = np.arange(-(LENGTH - GRAM), LENGTH)
    return (along >= -lo.astype(np.int64)[:, None]) & (along < hi.astype(np.int64)[:, None])


def _context_rows(b: _Block, place: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Bytes from lo before to hi after each place, zeros elsewhere."""
    along = np.arange(-(LENGTH - GRAM), LENGTH)
    out = np.empty((len(place), len(along)), np.uint8)
    for k in range(0, len(place), STEP_ROWS):
        own = slice(k, k + STEP_ROWS)
        out[own] = b.text[np.clip(place[own, None] + along, 0, len(b.text) - 1)] * _inside(lo[own], hi[own])
    return out


def _row_hash(rows: np.ndarray, *more: np.ndarray) -> np.ndarray:
    padded = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    padded[:, : rows.shape[1]] = rows
    words = padded.view(np.uint64)
    total = np.zeros(len(rows), np.uint64)
    for k in range(words.shape[1]):
        total = _mix(total ^ words[:, k] * _ODD[k])
    for k, m in enumerate(more):
        total = _mix(total + m.astype(np.uint64) * _ODD[40 + k])
    return total


def _words_of(rows: np.ndarray) -> np.ndarray:
    padded = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    padded[:, : rows.shape[1]] = rows
    return padded.view(np.uint64)


def _sorted_equal(keys: list[np.ndarray], rows: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by keys (the first is the major one) in which equal rows are adjacent, and where a new one starts.

    Rows are sorted by a hash and neighbours compared by their bytes; if a hash ever has two values, the bytes are sorted.
    """
    same = _row_hash(rows, *more)
    order = np.lexsort([same, *reversed(keys)])
    changes = lambda x: x[order[1:]] != x[order[:-1]]
    differs = np.zeros(max(0, len(order) - 1), bool)
    for k in keys:
        differs |= changes(k)
    apart = changes(rows).any(axis=1)
    for m in more:
        apart |= changes(m)
    if (apart & ~differs & ~changes(same)).any():
        order = np.lexsort([*more, *_words_of(rows).T, *reversed(keys)])
        differs[:] = False
        for k in keys:
            differs |= changes(k)
        apart = changes(rows).any(axis=1)
        for m in more:
            apart |= changes(m)
    return order, np.append(np.ones(min(1, len(order)), bool), differs | apart)


def _states(b: _Block, flags: list[dict]) -> np.ndarray:
    """Of each anchor: 1 if it is in two documents, 2 if it is hot too, else 0."""
    own = sorted(flags, key=lambda f: f["owner"])
    shared, hot = (_bits([f[c] for f in own], np.array([f["n"] for f in own])) for c in ("shared", "hot"))
    return np.where(shared, np.where(hot, 2, 1), 0)[np.unique(b.fp, return_inverse=True)[1]]


class _Contexts:
    """A block's contexts around the anchors of one state, in the order of their owners: `order` are the places of
    contexts, `new` says where a different one starts, `edges` are those of the owners."""

    def __init__(self, b: _Block, state: np.ndarray, owners: int, kind: int = 1):
        left = LENGTH - GRAM
        at = np.flatnonzero(state == kind)
        self.place, self.doc = b.place[at], b.doc[at]
        lo, hi = np.minimum(left, self.place - b.starts[self.doc]), np.minimum(LENGTH, b.ends[self.doc] - self.place)
        # A string that also holds a neighbour with a smaller hash chose that one.
        if len(b.place) > 1:
            before, after = np.maximum(at - 1, 0), np.minimum(at + 1, len(b.place) - 1)
            smaller = lambda other: (b.fp[other] < b.fp[at]) & (b.doc[other] == self.doc)
            lo = np.where(smaller(before), np.minimum(lo, self.place - b.place[before] - 1), lo)
            hi = np.where(smaller(after), np.minimum(hi, b.place[after] - self.place + GRAM - 1), hi)
        self.lo, self.hi = lo, hi
        self.rows = _context_rows(b, self.place, lo, hi)
        key = _row_hash(self.rows[:, left : left + GRAM])
        owner = (_mix(key * _ODD[50]) >> _U(33)).astype(np.int64) % owners
        self.order, self.new = _sorted_equal([owner, key], self.rows, lo, hi)
        self.edges = np.searchsorted(owner[self.order], np.arange(owners + 1))


    def copied(self, b: _Block, docs: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """doc, first and end of each place that goes. Of each different context: docs, the least document that has it, and
        spans, the part that is in a smaller one still."""
        which, members = np.cumsum(self.new) - 1, self.order
        begin = (self.place - self.lo - b.starts[self.doc])[members]
        copy = b.ids[self.doc[members]] > docs[which]
        first = np.where(copy, begin, begin + spans[which, 0])
        return self.doc[members], first, np.where(copy, begin + (self.lo + self.hi)[members], begin + spans[which, 1])


def _contexts(owners: int):
    """Blocks with their bitmaps to messages (owner, block, contexts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data, flags in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                b = _Block(data.as_py())
                b.find()
                c = _Contexts(b, _states(b, flags.as_py()), owners)
                out = []
                for o in np.flatnonzero(np.diff(c.edges)).tolist():
                    members, heads = c.order[c.edges[o] : c.edges[o + 1]], c.new[c.edges[o] : c.edges[o + 1]]
                    first = members[heads]
                    least = np.minimum.reduceat(b.ids[c.doc[members]], np.flatnonzero(heads))
                    text = c.rows[first][_inside(c.lo[first], c.hi[first])].tobytes()
                    out.append((o, name, _pack(text, c.lo[first].astype(np.uint8), c.hi[first].astype(np.uint8), least)))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), pa.binary()), strict=True)], ["owner", "block", "contexts"])

    return run


def _hot_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with their bitmaps to the different contexts of hot anchors: (block, i, context, least, most), documents by id."""
    left = LENGTH - GRAM
    for batch in batches:
        for name, data, flags in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            b = _Block(data.as_py())
            b.find()
            c = _Contexts(b, _states(b, flags.as_py()), 1, 2)
            heads, ids = np.flatnonzero(c.new), b.ids[c.doc[c.order]]
            if len(heads):
                first = c.order[heads]
                texts = [bytes((lo, hi)) + row[left - lo : left + hi].tobytes() for lo, hi, row in zip(c.lo[first].tolist(), c.hi[first].tolist(), c.rows[first], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(heads), name)), pa.array(np.arange(len(heads), dtype=np.int32)), pa.array(texts, pa.binary()), pa.array(np.minimum.reduceat(ids, heads)), pa.array(np.maximum.reduceat(ids, heads))], ["block", "i", "context", "least", "most"])


def _hot_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different contexts (anchor, context, least) sorted by anchor to (context, first, end): the strings that are in a smaller document."""
    held: list[tuple] = []

    def work(rows: list[tuple]) -> pa.RecordBatch:
        anchor = np.array([r[0] for r in rows], np.int64)
        same = anchor[1:] == anchor[:-1]
        own = np.flatnonzero(np.append(False, same) | np.append(same, False)).tolist()
        spans = marked_intervals([np.frombuffer(rows[k][1], np.uint8)[2:] for k in own], np.array([rows[k][2] for k in own])) if own else np.empty((0, 2), np.int64)
        found = [(rows[k][1], first, end) for k, (first, end) in zip(own, spans.tolist(), strict=True) if end]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found, strict=True) if found else ((),) * 3, (pa.binary(), pa.int32(), pa.int32()), strict=True)], ["context", "first", "end"])

    for batch in batches:
        held += zip(*[c.to_pylist() for c in batch.columns], strict=True)
        if len(held) >= SORT_ROWS:
            k = len(held) - 1
            while k and held[k - 1][0] == held[-1][0]:
                k -= 1
            if k:
                yield work(held[:k])
                held = held[k:]
    if held:
        yield work(held)


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts (c, context, least) to their strings: (c, at, string, least)."""
    for batch in batches:
        texts = [x[2:] for x in batch.column(1).to_pylist()]
        counts = np.array([len(t) - LENGTH + 1 for t in texts], np.int64)
        strings = [t[k : k + LENGTH] for t in texts for k in range(len(t) - LENGTH + 1)]
        at = np.arange(len(strings)) - np.repeat(np.cumsum(counts) - counts, counts)
        c, least = (pa.array(np.repeat(batch.column(k).to_numpy(), counts)) for k in (0, 2))
        yield pa.RecordBatch.from_arrays([c, pa.array(at.astype(np.int32)), pa.array(strings, pa.binary()), least], ["c", "at", "string", "least"])


def _judge(messages: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
    """An owner's messages (block, contexts) to (block, verdicts): for each context the least document that has it, and the
    first and the end of its strings that are in a smaller one."""
    read = [_unpack(m) for _, m in messages]
    lo, hi, least = (np.concatenate([r[k] for r in read]) for k in (1, 2, 3))
    rows = np.zeros((len(lo), 2 * LENGTH - GRAM), np.uint8)
    rows[_inside(lo, hi)] = np.frombuffer(b"".join(r[0] for r in read), np.uint8)
    left = LENGTH - GRAM
    key = _row_hash(rows[:, left : left + GRAM])
    # Equal contexts of all blocks become one; its document is the least of theirs.
    order, new = _sorted_equal([key], rows, lo, hi)
    context = np.empty(len(key), np.int64)
    context[order] = np.cumsum(new) - 1
    heads, docs = order[new], np.minimum.reduceat(least[order], np.flatnonzero(new))
    spans = np.zeros((len(heads), 2), np.int64)
    # Only anchors with different contexts have something to sort.
    keys = key[heads]
    begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    size = np.diff(np.append(begin, len(keys)))
    several = np.flatnonzero(np.repeat(size, size) > 1)
    at = 0
    while at < len(several):
        to = min(len(several), at + max(1, SORT_BYTES // (rows.shape[1] + 1)))
        while to < len(several) and keys[several[to]] == keys[several[to - 1]]:
            to += 1
        own = several[at:to]
        texts = [rows[heads[i], left - int(lo[heads[i]]) : left + int(hi[heads[i]])] for i in own]
        spans[own] = marked_intervals(texts, docs[own])
        at = to
    for (block, _), c in zip(messages, np.split(context, np.cumsum([len(r[1]) for r in read])[:-1]), strict=True):
        yield block, _pack(docs[c], spans[c].astype(np.uint8))


def _united(doc: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals as maximal runs, in order."""
    if not len(doc):
        return doc, first, end
    order = np.lexsort([first, doc])
    doc, first, end = doc[order], first[order], end[order]
    # On one line, a document's intervals can't touch the next one's.
    shift = np.cumsum(np.append(0, doc[1:] != doc[:-1])) * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + shift)
    new = np.flatnonzero(np.append(True, first[1:] + shift[1:] > reach[:-1]))
    return doc[new], first[new], (reach - shift)[np.append(new[1:], len(doc)) - 1]


def _judge_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (owner, block, contexts) sorted by owner, an owner at a time, to (block, owner, verdicts)."""
    now, held = None, []

    def work() -> pa.RecordBatch:
        blocks, verdicts = zip(*_judge(held), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array([now] * len(blocks), pa.int32()), pa.array(verdicts, pa.binary())], ["block", "owner", "verdicts"])

    for batch in batches:
        for owner, block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            if owner != now and held:
                yield work()
                held = []
            now = owner
            held.append((block, data.as_py()))
    if held:
        yield work()


def _marks(b: _Block, flags: list[dict], verdicts: list[dict], firsts: list[dict], owners: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc, first and end (from the document's start) of what goes. firsts: (i, least, first, end) of hot contexts of which something may go."""
    b.find()
    state = _states(b, flags)
    c = _Contexts(b, state, owners)
    found = [(np.empty(0, np.int64),) * 3]
    if verdicts:
        docs, spans = (np.concatenate(x) for x in zip(*[_unpack(v["verdicts"]) for v in sorted(verdicts, key=lambda v: v["owner"])], strict=True))
        found.append(c.copied(b, docs, spans))
    if firsts:
        h = _Contexts(b, state, 1, 2)
        docs, spans = np.full(int(h.new.sum()), NULL_ID), np.zeros((int(h.new.sum()), 2), np.int64)
        at = [f["i"] for f in firsts]
        docs[at], spans[at] = [f["least"] for f in firsts], [(f["first"], f["end"]) for f in firsts]
        found.append(h.copied(b, docs, spans))
    doc, first, end = (np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True))
    keep = end > first
    return _united(doc[keep], first[keep], end[keep])


def _cut_texts(owners: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, flags, verdicts, firsts in zip(*batch.columns, strict=True):
                b = _Block(data.as_py())
                verdicts, firsts = verdicts.as_py() or [], firsts.as_py() or []
                if verdicts or firsts:
                    doc, first, end = _marks(b, flags.as_py(), verdicts, firsts, owners)
                else:
                    doc = first = end = np.empty(0, np.int64)
                gone = np.zeros(len(b.text) + 1, np.int8)
                gone[b.starts[doc] + first] += 1
                np.add.at(gone, b.starts[doc] + end, -1)
                keep = np.cumsum(gone[:-1], dtype=np.int8) == 0
                left = np.concatenate([[0], np.cumsum(keep)])
                text = b.text[keep].tobytes()
                counts = np.bincount(doc, minlength=len(b.ids))
                edges = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                runs = pa.StructArray.from_arrays([pa.array(first), pa.array(end)], ["start", "end"])
                kept = pa.array([text[left[s] : left[e]] for s, e in zip(b.starts, b.ends, strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(b.ids, mask=~b.known), pa.array(b.sizes), pa.ListArray.from_arrays(edges, runs), kept], ["doc_id", "n_bytes", "removed", "kept"])

    return run


def owners_of(docs: DataFrame) -> int:
    """Owners for docs: as many for each partition of its scan as OWNER_BYTES go into one."""
    conf = docs.sparkSession.conf.get("spark.sql.files.maxPartitionBytes")
    scanned = docs.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(conf)
    return tasks(docs) * max(1, -(-scanned // OWNER_BYTES))


def remove_repeats(docs: DataFrame, owners: int | None = None, hot_blocks: int = HOT_BLOCKS, many: int = MANY) -> DataFrame:
    """One row for each document: doc_id, n_bytes, removed (maximal runs of start and end), kept (the bytes left)."""
    # A block's rows follow from its partition's, in whatever order they come: a lost task makes the same blocks again.
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").sortWithinPartitions("doc_id", F.xxhash64("text"))
    parts, owners = tasks(ordered), owners or owners_of(ordered)
    packed = ordered.mapInArrow(_blocks, "docs binary")
    blocks = cut_by(packed.withColumn("block", F.monotonically_increasing_id()), "block", parts).select("block", "docs")
    free_shuffles(docs.sparkSession)
    sent = blocks.mapInArrow(_messages(owners, many), "block long, owner int, n int, k int, coded binary, twice binary, often binary")
    told = sent.groupBy("owner").applyInPandas(_decide(hot_blocks), "block long, owner int, n int, shared binary, hot binary")
    flags = cut_by(told.groupBy("block").agg(F.collect_list(F.struct("owner", "n", "shared", "hot")).alias("flags")), "block", parts)
    free_shuffles(docs.sparkSession)
    flagged = blocks.join(flags.hint("shuffle_hash"), "block", "left").select("block", "docs", F.coalesce("flags", F.array().cast("array<struct<owner: int, n: int, shared: binary, hot: binary>>")).alias("flags"))
    asked = flagged.filter("size(flags) > 0")
    contexts = asked.mapInArrow(_contexts(owners), "owner int, block long, contexts binary")
    judged = contexts.repartitionById(parts, F.pmod("owner", F.lit(parts))).sortWithinPartitions("owner").mapInArrow(_judge_sorted, "block long, owner int, verdicts binary")
    verdicts = judged.repartition(parts, "block").groupBy("block").agg(F.collect_list(F.struct("owner", "verdicts")).alias("verdicts"))
    kinds = "doc_id long, n_bytes long, removed array<struct<start: long, end: long>>, kept binary"
    both, hot = flagged.join(verdicts.hint("shuffle_hash"), "block", "left"), "exists(flags, f -> length(f.hot) > 0)"
    if flags.filter(hot).isEmpty():
        both = both.withColumn("firsts", F.expr("cast(array() as array<struct<i: int, least: long, first: int, end: int>>)"))
    else:
        both = both.join(_first_documents(asked.filter(hot), parts).hint("shuffle_hash"), "block", "left")
    return both.select("docs", "flags", "verdicts", "firsts").mapInArrow(_cut_texts(owners), kinds)


#: The anchor's gram in a hot context (bytes before it, bytes from it on, text), by its hash: one more context of another gram does no harm.
ANCHOR = f"xxhash64(substring(context, 3 + cast(conv(hex(substring(context, 1, 1)), 16, 10) as int), {GRAM}))"


def _first_documents(hot_blocks: DataFrame, parts: int) -> DataFrame:
    """block, firsts: of its different hot contexts of which something may go the least document that has it, and the part that is in a
    smaller one still. Tasks combine equal contexts, then equal strings before the shuffle; a context comes back at most once to a block."""
    found = written(hot_blocks.mapInArrow(_hot_contexts, "block long, i int, context binary, least long, most long"))
    salted = found.withColumn("salt", F.pmod("block", F.lit(SALTS)).cast("int"))
    # in_salts: the salts that a context has, as bits. Its verdict goes to no other.
    contexts = salted.withColumn("bit", F.expr("shiftleft(1, salt)")).groupBy("context").agg(F.min("least").alias("least"), F.bit_or("bit").alias("in_salts")).withColumn("anchor", F.expr(ANCHOR))
    large = cut(contexts.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > SORT_ROWS).select("anchor"))
    none_large = large.isEmpty()
    small = contexts if none_large else contexts.join(large, "anchor", "left_anti")
    spans = small.select("anchor", "context", "least").repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_hot_spans, "context binary, first int, end int")
    if not none_large:
        named = cut(contexts.join(large, "anchor").select("context", "least", F.monotonically_increasing_id().alias("c")))
        strings = named.select("c", "context", "least").mapInArrow(_strings, "c long, at int, string binary, least long")
        shared = cut(strings.groupBy("string").agg(F.min("least").alias("smaller"), F.max("least").alias("largest")).filter("smaller < largest").select("string", "smaller"))
        marked = look_up(strings, shared, ["string"], "inner").filter("smaller < least").groupBy("c").agg(F.min("at").alias("first"), (F.max("at") + LENGTH).alias("end"))
        spans = spans.unionByName(named.select("c", "context").join(marked, "c").select("context", "first", "end"))
    none = F.lit(0)
    verdicts = contexts.join(spans, "context", "left").select("context", F.col("least").alias("all"), F.coalesce("first", none).alias("first"), F.coalesce("end", none).alias("end"), F.expr(f"explode(filter(sequence(0, {SALTS - 1}), s -> getbit(in_salts, s) = 1))").alias("salt"))
    back = salted.select("block", "i", "context", "most", "salt").join(verdicts, ["context", "salt"]).filter("most > all or end > 0")
    return back.select("block", F.struct("i", F.col("all").alias("least"), "first", "end").alias("x")).repartition(parts, "block").groupBy("block").agg(F.collect_list("x").alias("firsts"))
