"""Toxicity by compression distance.

Two zstandard dictionaries are built from labelled text, one of ordinary and one of toxic text. A text is cut into overlapping
byte windows, each is compressed with both, and the difference of the two lengths is the window's evidence. A
document's largest difference and its number of windows above the threshold are calibrated to a score by logistic regression.

The ordinary dictionary is trained by zstandard (`train_dictionary`) on windows of all sampled ordinary texts. The toxic one
holds the same content, so that ordinary text saves as much with either, and after it, nearest the window, the content
chosen from the toxic texts: 5-byte grams far commoner (by documents) in toxic than in ordinary text, a cover of
the toxic documents chosen greedily among them, each then grown to the string around it. Their number
has no cap of its own: choosing ends with the first gram that adds less than `gain` of the toxic documents.
That choice replaces zstandard's own training on the toxic side: a toxic text is ordinary but for a few words, which
`train_dictionary` doesn't tell from the rest (the README has the figures).

Every window starts with the same pad, which both dictionaries hold, so that zstandard never falls back to
storing a window and a match always shows in the length. Calibration uses dictionaries that were
trained without the document at hand (two folds).

Fitting uses a bounded sample (`max_toxic`, `max_ordinary` documents, `max_bytes` of text); scoring reads
every whole text. Defined cases: null and empty texts score as a text with no evidence; without labelled
rows of both kinds every score is 0; of several labels for one document the largest counts; repeated rows get equal scores;
a very long text is scored some windows at a time; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import whole

WINDOW, STRIDE, GRAM = 48, 32, 5
#: Bytes that a window must save with the toxic dictionary to count as a hit.
HIT_BYTES = 3
#: Bytes of the ordinary dictionary, and of the windows that it is trained on: evenly spread over all sampled texts.
ORDINARY_BYTES, TRAIN_BYTES = 8192, 8 << 20
#: What both dictionaries and every window start with: control bytes that text hardly holds.
PAD = bytes(range(1, 9)) + bytes(range(14, 30))
#: Text scored at a time in a task, unless one text is longer, and windows compressed at a time.
CHUNK_BYTES, CHUNK_WINDOWS = 4 << 20, 1 << 16


@dataclass(frozen=True)
class Model:
    ordinary: bytes = b""
    toxic: bytes = b""
    weights: tuple[float, ...] = ()


def _encode(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace")


def _grams(data: bytes) -> np.ndarray:
    """The big-endian value of each GRAM bytes."""
    a = np.frombuffer(data, np.uint8).astype(np.uint64)
    out = np.zeros(max(0, len(a) - GRAM + 1), np.uint64)
    for k in range(GRAM):
        out = out << np.uint64(8) | a[k : k + len(out)]
    return out


def _document_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate([np.unique(_grams(t)) for t in texts]), return_counts=True)


def _look_up(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Places of values in the sorted table; -1 where missing."""
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return np.where(table[at] == values, at, -1)


def _log_likelihood(k: np.ndarray, n: int, p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-12, 1 - 1e-12)
    return k * np.log(p) + (n - k) * np.log1p(-p)


def marking_strings(toxic: list[bytes], ordinary: list[bytes], odds: float = 15, least: float = 15, gain: float = 0.002) -> list[bytes]:
    """Strings that mark toxic texts, most frequent first.

    odds: how many times commoner a gram is among toxic documents; least: its log-likelihood ratio;
    gain: the share of the toxic documents that another gram must add, those with chosen grams counting 0.4 for each.
    """
    n1, n0 = len(toxic), len(ordinary)
    grams, in_toxic = _document_counts(toxic)
    others, in_ordinary = _document_counts(ordinary)
    if not len(grams):
        return []
    at = _look_up(others, grams) if len(others) else np.full(len(grams), -1)
    there = np.where(at >= 0, in_ordinary[at] if len(others) else 0, 0)
    both = (in_toxic + there) / (n1 + n0)
    ratio = 2 * (_log_likelihood(in_toxic, n1, in_toxic / n1) + _log_likelihood(there, n0, there / n0) - _log_likelihood(in_toxic, n1, both) - _log_likelihood(there, n0, both))
    picked = (in_toxic / n1 > odds * (there + 0.5) / (n0 + 1)) & (in_toxic >= 3) & (ratio > least)
    table, count = grams[picked], in_toxic[picked]
    if not len(table):
        return []
    held = [np.unique(x[x >= 0]) for x in (_look_up(table, _grams(t)) for t in toxic)]
    doc, gram = np.repeat(np.arange(n1), [len(h) for h in held]), np.concatenate(held)
    need, chosen = np.ones(n1), []
    while True:
        gains = np.bincount(gram, weights=need[doc], minlength=len(table))
        gains[chosen] = 0
        best = int(gains.argmax())
        if gains[best] < max(1.0, gain * n1):
            break
        chosen.append(best)
        need[doc[gram == best]] *= 0.4
    found: Counter[bytes] = Counter()
    for text in toxic:
        ids = _look_up(table, _grams(text))
        for place in np.flatnonzero(np.isin(ids, chosen)):
            enough = 0.4 * count[ids[place]]
            first = last = int(place)
            while first > 0 and place - first < 12 and ids[first - 1] >= 0 and count[ids[first - 1]] >= enough:
                first -= 1
            while last + 1 < len(ids) and last - place < 12 and ids[last + 1] >= 0 and count[ids[last + 1]] >= enough:
                last += 1
            found[text[first : last + GRAM]] += 1
    kept: list[bytes] = []
    for string, n in sorted(found.items(), key=lambda x: (-x[1], x[0])):
        if n < 2:
            break
        if n >= 0.25 * max((found[k] for k in kept if k in string), default=0):
            kept.append(string)
    return kept


def ordinary_dictionary(texts: list[bytes]) -> bytes:
    """A dictionary of ORDINARY_BYTES trained on the texts' windows; where they are few, the texts themselves."""
    total = sum(map(len, texts))
    if total < 8 * ORDINARY_BYTES:
        return b" ".join(texts)
    step = WINDOW * max(1, -(-total // TRAIN_BYTES))
    samples = [t[k : k + WINDOW] for t in texts for k in range(0, len(t), step)]
    return zstandard.train_dictionary(ORDINARY_BYTES, samples, k=WINDOW, d=6).as_bytes()


def train_dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    """Contents of the ordinary dictionary and of the toxic one, each with the pad."""
    plain = ordinary_dictionary(ordinary) + PAD + b"\0"
    return plain, plain + b"".join(s + b"\0" for s in reversed(marking_strings(toxic, ordinary)))


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    fixed = zstandard.ZstdCompressionParameters(window_log=17, chain_log=16, hash_log=16, search_log=4, min_match=5, target_length=0, strategy=zstandard.STRATEGY_GREEDY, write_content_size=False, write_checksum=False, write_dict_id=False)
    trained = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    trained.precompute_compress(compression_params=fixed)
    return zstandard.ZstdCompressor(dict_data=trained, compression_params=fixed)


def window_starts(n: int) -> np.ndarray:
    """Starts of overlapping windows that cover n bytes; one for a short or empty text."""
    return np.arange(0, max(1, n - WINDOW + STRIDE), STRIDE)


def evidence(texts: list[bytes], compressors: tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]) -> np.ndarray:
    """For each text: the largest saving of a window (0 to 12), log(1 + hits), log(windows)."""
    starts = [window_starts(len(t)) for t in texts]
    counts = np.array([len(s) for s in starts])
    owner = np.repeat(np.arange(len(texts)), counts)
    base = np.cumsum([0, *[len(t) + WINDOW for t in texts]])[:-1]
    data = np.frombuffer(b"".join(t + b"\0" * WINDOW for t in texts), np.uint8)
    at = np.concatenate(starts) + base[owner]
    most, hits = np.zeros(len(texts), np.int64), np.zeros(len(texts))
    for k in range(0, len(at), CHUNK_WINDOWS):
        own = owner[k : k + CHUNK_WINDOWS]
        windows = np.empty((len(own), len(PAD) + WINDOW), np.uint8)
        windows[:, : len(PAD)] = np.frombuffer(PAD, np.uint8)
        windows[:, len(PAD) :] = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[at[k : k + CHUNK_WINDOWS]]
        places = np.empty((len(own), 2), "<u8")
        places[:, 0] = np.arange(len(own)) * windows.shape[1]
        places[:, 1] = windows.shape[1]
        buffer = zstandard.BufferWithSegments(windows.tobytes(), places.tobytes())
        plain, toxic = (np.fromiter(map(len, c.multi_compress_to_buffer(buffer)), np.int64, len(own)) for c in compressors)
        np.maximum.at(most, own, plain - toxic)
        hits += np.bincount(own, weights=plain - toxic >= HIT_BYTES, minlength=len(texts))
    return np.stack([np.minimum(most, 12), np.log1p(hits), np.log(counts)], axis=1)


def _features_in_chunks(texts: list[bytes], compressors) -> np.ndarray:
    out, chunk, size = [np.empty((0, 3))], [], 0
    for t in texts:
        chunk.append(t)
        size += len(t)
        if size >= CHUNK_BYTES:
            out.append(evidence(chunk, compressors))
            chunk, size = [], 0
    if chunk:
        out.append(evidence(chunk, compressors))
    return np.concatenate(out)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Weights of a ridge logistic regression (bias first), by Newton steps."""
    x = np.hstack([np.ones((len(x), 1)), x])
    keep = np.diag([1e-3] + [ridge] * (x.shape[1] - 1))
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + keep, x.T @ (weight * (p - y)) + keep @ w)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in w)


def fit_texts(toxic: list[bytes], ordinary: list[bytes], prior: float | None = None) -> Model:
    """prior: the share of toxic rows among all labelled ones, if the sample's is another."""
    if not toxic or not ordinary:
        return Model()
    x, y = [], []
    for fold in (0, 1):
        train = [[t for i, t in enumerate(texts) if i % 2 != fold or len(texts) == 1] for texts in (toxic, ordinary)]
        pair = tuple(_compressor(c) for c in train_dictionaries(*train))
        for label, texts in ((1, toxic), (0, ordinary)):
            own = texts[fold::2]
            x.append(_features_in_chunks(own, pair))
            y.append(np.full(len(own), label))
    x, y = np.concatenate(x), np.concatenate(y)
    share = len(toxic) / (len(toxic) + len(ordinary))
    prior = share if prior is None else prior
    weight = np.where(y == 1, prior / share, (1 - prior) / (1 - share))
    return Model(*train_dictionaries(toxic, ordinary), _logistic(x, y, weight))


def fit(docs: DataFrame, labels: DataFrame, max_toxic: int = 1500, max_ordinary: int = 3000, max_bytes: int = 24 << 20) -> Model:
    """labels: (doc_id, toxic); the sample is the first of each kind in the order of a hash of doc_id."""
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    texts: dict[int, list[bytes]] = {}
    for label, most in ((1, max_toxic), (0, max_ordinary)):
        picked = known.filter(F.col("toxic") == label).select("doc_id", F.xxhash64("doc_id").alias("order")).orderBy("order", "doc_id").limit(most)
        sample = docs.select("doc_id", whole().alias("text")).join(F.broadcast(picked), "doc_id").orderBy("order", "doc_id", "text").select("text")
        own, size = [], 0
        for row in sample.toLocalIterator():
            own.append(_encode(row.text))
            size += len(own[-1])
            if size >= max_bytes:
                break
        texts[label] = own
    total = counts.get(0, 0) + counts.get(1, 0)
    return fit_texts(texts[1], texts[0], counts.get(1, 0) / total if total else None)


def _scorer(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = (_compressor(model.ordinary), _compressor(model.toxic)) if model.weights else None
        for batch in batches:
            texts = [_encode(t.as_py()) for t in batch.column(1)]
            if pair is None or not texts:
                score = np.zeros(len(texts))
            else:
                score = 1 / (1 + np.exp(-np.clip(model.weights[0] + _features_in_chunks(texts, pair) @ np.array(model.weights[1:]), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row for each document: doc_id, score, predicted."""
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scorer(model), "doc_id long, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def held_out() -> Column:
    """Whether a document is kept from training: crc32 of doc_id as text is a multiple of 5."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(5)) == 0
