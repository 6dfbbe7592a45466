"""Packing by power-of-two decomposition.

Each document becomes ids plus one end id and is cut into pieces whose lengths are the binary digits of
its length (as many of `max_len` as fit, then each smaller power of two at most once). A piece is a
sequence of its own: pieces of equal length form a bucket, a training batch is drawn from one bucket,
so there is no padding and no sequence crosses documents. Nothing is shuffled; each text is read once.

Defined cases: null and empty texts give the end id alone (one piece of length 1); repeated rows and
repeated or null doc_ids give pieces of their own; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECES = "doc_id long, start long, length long, doc_tokens long, bucket int, ids binary"
#: Ids held before a batch is handed on.
CHUNK_IDS = 1 << 20


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones as themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=4)
def encoder(path: str):
    """text -> ids, equal to `tokenizers` with add_special_tokens=False.

    A byte-level BPE file whose merges are numbered in order is also a rank table; tiktoken merges by ranks
    several times faster, so it takes the texts without special strings if it agrees on the probes. If it
    doesn't, or tiktoken is absent, `tokenizers` takes all texts: slower, with the same ids.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tokenizers

    exact = tokenizers.Tokenizer.from_file(path)
    slow = lambda text: exact.encode(text, add_special_tokens=False).ids
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    vocab = model.get("vocab")
    specials = [t["content"] for t in spec.get("added_tokens", [])]
    if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer") or any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)):
        return slow
    try:
        import tiktoken
    except ImportError:
        return slow
    letters = _byte_letters()
    ranks = {bytes(letters[ch] for ch in word): i for word, i in vocab.items() if word not in specials}
    # Fixed value: the published split pattern of byte-level BPE.
    split = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    fast = tiktoken.Encoding("byte-level", pat_str=split, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    probes = ["", " ", "It's  a\ttest\n\n of 12½ things, naïve Straße 東京 \U0001f600!", "'LL x'll\r\n\x0b end ", "a" * 300]
    if any(fast(p) != slow(p) for p in probes):
        return slow
    return lambda text: slow(text) if any(s in text for s in specials) else fast(text)


def piece_lengths(n: int, max_len: int) -> list[int]:
    """n as max_len, max_len, ... and then its smaller binary digits, largest first."""
    return [max_len] * (n // max_len) + [1 << k for k in range(max_len.bit_length() - 2, -1, -1) if n % max_len >> k & 1]


def _pieces(path: str, end_id: int, max_len: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        ids, rows, held = [], [], 0

        def hand_on() -> pa.RecordBatch:
            doc, start, length, total = (np.array(c) for c in zip(*[r[1:] for r in rows], strict=True))
            offsets = np.zeros(len(rows) + 1, np.int32)
            np.cumsum(length * 4, out=offsets[1:])
            data = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.concatenate(ids).tobytes())])
            names = pa.array([r[0] for r in rows], pa.int64())
            cols = [names, pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(total, pa.int64()), pa.array(np.log2(length).astype(np.int32)), data]
            return pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "length", "doc_tokens", "bucket", "ids"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.array([*encode(text.as_py() or ""), end_id], dtype="<u4")
                at = 0
                for size in piece_lengths(len(own), max_len):
                    rows.append((doc_id, 0, at, size, len(own)))
                    at += size
                ids.append(own)
                held += len(own)
                if held >= CHUNK_IDS:
                    yield hand_on()
                    ids, rows, held = [], [], 0
        if rows:
            yield hand_on()

    return run


def pack(docs: DataFrame, tokenizer_path: str, max_len: int = 1024, end_id: int = 0) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, bucket, ids as little-endian uint32, sequence_id, offset).

    bucket is log2 of the length. sequence_id is unique: the partition's number and the row's place in it.
    """
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    pieces = docs.select("doc_id", "text").mapInArrow(_pieces(tokenizer_path, end_id, max_len), PIECES)
    return pieces.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """The packed corpus, one folder for each length, for loaders that batch equal lengths."""
    pieces.select("bucket", "sequence_id", "doc_id", "start", "length", "ids").write.partitionBy("bucket").parquet(path)
