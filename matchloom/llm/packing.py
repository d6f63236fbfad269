"""Packing along a space-filling curve.

Every document's tokens are hashed into a vector that random signs project to a few dimensions. Its place in that space
gives a Hilbert key; documents are range-sorted by the key, so that neighbours on the curve are near in content, and
each range is cut into sequences in that order. Only the end of a range isn't a full sequence; it is cut into
sequences whose lengths are powers of two, so nothing is padded.

Defined results. A null or empty text is the end id alone. Equal texts have equal keys and are ordered by id; a range
bound may lie between them, so many copies don't meet in one task. Repeated rows are packed each. Extra columns are not
read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import batch_settings, give_back, hold, lean, partitions
from matchloom.llm.word_tokens import encoder
from matchloom.storage import materialize

DIMENSIONS, BITS = 4, 15


def project(ids: np.ndarray, ends: np.ndarray, dimensions: int = DIMENSIONS, seed: int = 7) -> np.ndarray:
    """Documents' token ids, end to end -> numbers in [0, 1) of that many dimensions.

    A token's vector is a hash: one sign for each dimension and 64 buckets, which random signs then project; as both
    are linear, each token has one pseudo-random number in each dimension. Sums of n of them, over sqrt(n), are about
    normal, and a logistic curve makes them even.
    """
    np.seterr(over="ignore")  # hashes wrap round
    table = np.arange(int(ids.max(initial=0)) + 1, dtype=np.uint64)
    out = np.empty((len(ends), dimensions))
    starts = np.concatenate([[0], ends[:-1]])
    for d in range(dimensions):
        mixed = (table + np.uint64(seed + 1)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(d + 1) * np.uint64(0xD1B54A32D192ED03)
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        signs = ((mixed >> np.uint64(33)) & np.uint64(1)).astype(np.float32) * 2 - 1
        sums = np.add.reduceat(signs[ids], starts, dtype=np.float64) if len(ids) else np.zeros(len(ends))
        out[:, d] = 1 / (1 + np.exp(-1.702 * sums / np.sqrt(np.maximum(ends - starts, 1))))
    return out


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position on the Hilbert curve of points in [0, 1)^d. d * bits is at most 62.

    The transposed form of the curve: undo the excess turns of each level, Gray-decode, then interleave the bits.
    """
    x = np.minimum((points * (1 << bits)).astype(np.int64), (1 << bits) - 1).T.copy()
    n = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for i in range(n):
            on = (x[i] & level) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
        level >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn, level = np.zeros_like(x[0]), 1 << (bits - 1)
    while level > 1:
        turn ^= np.where((x[n - 1] & level) != 0, level - 1, 0)
        level >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def _tokenise(path: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("words", encoder.cache_clear)
        encode = encoder(path)
        for batch in batches:
            ids, ends = encode(batch.column("text"), end_id)
            keys = hilbert(project(ids, ends))
            flat = pa.py_buffer(ids.astype("<u2" if ids.max(initial=0) < 65536 else "<u4").tobytes())
            width = 2 if ids.max(initial=0) < 65536 else 4
            offsets = np.concatenate([[0], ends]).astype(np.int32) * width
            packed = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), flat])
            lengths = pa.array(np.diff(np.concatenate([[0], ends])), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(keys), lengths, pa.array([width] * len(ends), pa.int32()), packed], ["doc_id", "key", "doc_tokens", "width", "ids"])
            # A task has few batches, and what one of them freed would stay with the worker beside its words.
            del ids, ends, keys, flat, offsets, packed, lengths
            give_back()

    return run


def _cut(length: int, ranges: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pieces of the documents of one range, in its order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place, sequence, filled = TaskContext.get().partitionId(), 0, 0
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        held: list[tuple] = []  # pieces of the sequence that isn't full yet

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            columns = zip(*rows) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            done: list[tuple] = []
            ids_of = batch.column("ids")
            for doc, tokens, width, at in zip(batch.column("doc_id").to_pylist(), batch.column("doc_tokens").to_pylist(), batch.column("width").to_pylist(), range(len(batch))):
                ids = np.frombuffer(ids_of[at].as_buffer(), "<u2" if width == 2 else "<u4").astype("<u4")
                start = 0
                while start < tokens:
                    size = min(tokens - start, length - filled)
                    held.append((doc, start, size, ids[start : start + size].tobytes(), tokens, sequence * ranges + place, filled))
                    start, filled = start + size, filled + size
                    if filled == length:
                        done += held
                        held, filled, sequence = [], 0, sequence + 1
                if len(done) >= 2000:
                    yield batch_of(done)
                    done = []
            yield batch_of(done)
        # The rest: sequences of falling powers of two.
        last: list[tuple] = []
        bounds, at = [], 0
        for power in range(length.bit_length() - 1, -1, -1):
            if filled >> power & 1:
                bounds.append((at, at + (1 << power)))
                at += 1 << power
        for doc, start, size, ids, tokens, _, offset in held:
            for number, (low, high) in enumerate(bounds):
                a, b = max(low, offset), min(high, offset + size)
                if a < b:
                    last.append((doc, start + a - offset, b - a, ids[4 * (a - offset) : 4 * (b - offset)], tokens, (sequence + number) * ranges + place, a - low))
        yield batch_of(last)

    return run


def pack(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 1, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    ``length`` is a power of two. ``tokenizer``: path of a vocabulary file, there on every executor. Tokens are
    written once; sampling the ranges and sorting then read them. sequence_id is unique, not gapless: it numbers the
    sequences of a range in steps of the number of ranges.
    """
    if length & (length - 1):
        raise ValueError("length must be a power of two")
    spark = docs.sparkSession
    batch_settings(spark)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    tokens = materialize(rows.mapInArrow(lean(_tokenise(tokenizer, end_id), "words"), "doc_id long, key long, doc_tokens long, width int, ids binary"), "tokens")
    ranges = partitions(spark)
    ordered = tokens.repartitionByRange(ranges, "key", "doc_id").sortWithinPartitions("key", "doc_id", "doc_tokens", "ids")
    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return ordered.mapInArrow(lean(_cut(length, 1 << 20)), schema)
