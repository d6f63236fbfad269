"""Fingerprints of texts by order MinHash, which are sensitive to edit distance.

The k-mers of a text (k code points each) are numbered by occurrence, so that repeats count. Each of several random orders
selects the few smallest numbered k-mers; these are put back into the order of the text and hashed as one tuple. Two
texts agree in a tuple only if they share these k-mers and have them in the same order, so the share of equal tuples
falls with the edit distance, also where a mere set of k-mers would not see that passages were moved.

Defined results. A null or empty text has the empty fingerprint; two empty ones are alike (1), an empty one and another are
not (0). A text shorter than k is one k-mer. Equal texts have equal fingerprints. ``compare_next`` orders rows by falling
id, rows without id last, rows that share an id by a hash of their texts, then the texts; repeated rows are compared each,
and a table of one row has itself as the next. Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.llm.common import batch_settings, partitions
from matchloom.storage import materialize

Batches = Iterator[pa.RecordBatch]
K, TUPLE, ORDERS = 8, 2, 32
ODD = np.uint64(0x9E3779B97F4A7C15)
# Numbered k-mers that are put into all orders at once; bounds memory, results don't depend on it.
CHUNK = 4096


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xCF1BBCDCB7A56463)
    return x ^ (x >> np.uint64(32))


class OrderMinHash:
    """Fingerprints with ``orders`` tuples of ``size`` k-mers; 32 bits of each tuple's hash as hexadecimal digits."""

    def __init__(self, k: int = K, size: int = TUPLE, orders: int = ORDERS, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.k, self.size = k, size
        self.weights = rng.integers(0, 1 << 63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.a = rng.integers(0, 1 << 31, (orders, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.b = rng.integers(0, 1 << 32, (orders, 1), dtype=np.uint32)

    def kmers(self, text: str) -> np.ndarray:
        """Hashes of the k-mers in text order."""
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        if not len(points):
            return np.zeros(0, np.uint64)
        values = _mix(points.astype(np.uint64) + np.uint64(1))
        if len(values) < self.k:
            values = np.concatenate([values, np.zeros(self.k - len(values), np.uint64)])
        out = np.zeros(len(values) - self.k + 1, np.uint64)
        for j, weight in enumerate(self.weights):
            out += values[j : j + len(out)] * weight
        return _mix(out)

    @staticmethod
    def numbered(kmers: np.ndarray) -> np.ndarray:
        """Hashes of the k-mers with the number of occurrences before each.

        One sort of the hashes' high bits, with the places in the low ones, brings occurrences together in text order.
        """
        n = len(kmers)
        low = np.uint64((1 << max(1, (n - 1).bit_length())) - 1)
        keys = np.sort((kmers & ~low) | np.arange(n, dtype=np.uint64))
        starts = np.flatnonzero(np.concatenate([[True], (keys[1:] | low) != (keys[:-1] | low)]))
        number = np.empty(n, np.uint64)
        number[(keys & low).astype(np.int64)] = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
        return _mix(kmers + number * ODD)

    def chosen(self, numbered: np.ndarray) -> np.ndarray:
        """Places of the smallest numbered k-mers of each order, in text order."""
        short = (numbered ^ (numbered >> np.uint64(32))).astype(np.uint32)
        rows = np.arange(len(self.a))
        values, places = [], []
        for at in range(0, len(short), CHUNK):
            ranks = short[at : at + CHUNK] * self.a + self.b
            for _ in range(min(self.size, ranks.shape[1])):
                least = ranks.argmin(axis=1)
                values.append(ranks[rows, least])
                places.append(least + at)
                ranks[rows, least] = 0xFFFFFFFF
        place = np.stack(places, axis=1)
        if place.shape[1] > self.size:
            best = np.argsort(np.stack(values, axis=1), axis=1, kind="stable")[:, : self.size]
            place = np.take_along_axis(place, best, axis=1)
        return np.sort(place, axis=1)

    def fingerprint(self, text: str | None) -> str:
        if not text:
            return ""
        kmers = self.kmers(text)
        state = np.zeros(len(self.a), np.uint64)
        for column in self.chosen(self.numbered(kmers)).T:
            state = _mix(state * ODD + kmers[column] + np.uint64(1))
        return (state >> np.uint64(32)).astype(">u4").tobytes().hex()


def alike(one: str, other: str) -> float:
    """Share of equal tuples."""
    if not one or not other:
        return float(one == other)
    return sum(one[i : i + 8] == other[i : i + 8] for i in range(0, len(one), 8)) / (len(one) // 8)


def likeness(one: Column, other: Column, orders: int = ORDERS) -> Column:
    """The same for two columns of fingerprints."""
    same = F.filter(F.sequence(F.lit(0), F.lit(orders - 1)), lambda i: F.substr(one, i * 8 + 1, F.lit(8)) == F.substr(other, i * 8 + 1, F.lit(8)))
    return F.when((one == "") | (other == ""), (one == other).cast("double")).otherwise(F.size(same) / F.lit(float(orders)))


def fingerprint(k: int = K, size: int = TUPLE, orders: int = ORDERS) -> Callable[[Column], Column]:
    """Column function text -> fingerprint."""

    @F.arrow_udf("string")
    def of(texts: pa.Array) -> pa.Array:
        maker = OrderMinHash(k, size, orders)
        return pa.array([maker.fingerprint(t) for t in texts.to_pylist()], pa.string())

    return of


def mixed_end(text: str, other: str) -> str:
    """The last third of a text replaced by as much of the start of another."""
    third = len(text) // 3
    return text[: len(text) - third] + other[:third]


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
NAMES = [field.split()[0] for field in RESULT.split(", ")]
TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _row(maker: OrderMinHash, edit: Callable[[str, str], str], id_: int | None, text: str, mark: str, other: str, other_mark: str) -> tuple:
    edited = edit(text, other)
    edited_mark = maker.fingerprint(edited)
    digest = hashlib.sha256(edited.encode()).hexdigest()
    return id_, len(text), digest, mark, edited_mark, alike(mark, edited_mark), alike(mark, other_mark)


def _arrow(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)


def _follow(parameters: tuple[int, int, int], edit: Callable[[str, str], str]) -> Callable[[Batches], Batches]:
    """Results of the rows of a range but the last one, whose successor is in another; both its ends are passed on."""
    names, types = ["part", "first", "text", *NAMES], [pa.int32(), pa.bool_(), pa.string(), *TYPES]

    def run(batches: Batches) -> Batches:
        from pyspark import TaskContext

        part, maker, held = TaskContext.get().partitionId(), OrderMinHash(*parameters), None
        nothing = (None,) * (len(NAMES) - 1)
        for batch in batches:
            out = []
            for id_, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                mark = maker.fingerprint(text)
                if held is None:
                    out.append((part, True, text, id_, *nothing))
                else:
                    out.append((None, None, None, *_row(maker, edit, *held, text, mark)))
                held = (id_, text, mark)
            yield _arrow(out, names, types)
        if held is not None:
            yield _arrow([(part, False, held[1], held[0], *nothing)], names, types)

    return run


def _close(parameters: tuple[int, int, int], edit: Callable[[str, str], str]) -> Callable[[Batches], Batches]:
    """Results of the last rows of the ranges."""

    def run(batches: Batches) -> Batches:
        maker = OrderMinHash(*parameters)
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "other")))
            yield _arrow([_row(maker, edit, id_, text, maker.fingerprint(text), other, maker.fingerprint(other)) for id_, text, other in rows], NAMES, TYPES)

    return run


def compare_next(
    docs: DataFrame,
    edit: Callable[[str, str], str] = mixed_end,
    id_column: str = "doc_id",
    text_column: str = "text",
    k: int = K,
    size: int = TUPLE,
    orders: int = ORDERS,
) -> DataFrame:
    """Each text's fingerprint, likeness to its edited form and to the next text by falling id; after the last comes the first.

    Rows are range-partitioned, so texts are shuffled once and each range reads on from row to row. Only the first and
    last row of each range are written with their texts, to close the gaps between ranges.
    """
    spark = docs.sparkSession
    batch_settings(spark)
    parameters = (k, size, orders)
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie")]
    ranges = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order, "text").select("doc_id", "text")
    read = materialize(ranges.mapInArrow(_follow(parameters, edit), f"part int, first boolean, text string, {RESULT}"), "ranges")
    inner = read.where("part IS NULL").select(*NAMES)
    # Two rows a range: what comes after its last row is the first one of the next range that has any.
    ends = read.where("part IS NOT NULL")
    first, last = ends.where("first").select("part", F.col("text").alias("other")), ends.where("NOT first").select("part", "doc_id", "text")
    following = first.select("part", F.lead("part").over(Window.orderBy("part")).alias("next"), F.min("part").over(Window.partitionBy()).alias("top"))
    following = following.select(F.col("part").alias("here"), F.coalesce("next", "top").alias("next"))
    pairs = last.join(following, F.col("part") == F.col("here")).select("doc_id", "text", "next").join(first, F.col("next") == F.col("part"))
    return inner.union(pairs.select("doc_id", "text", "other").mapInArrow(_close(parameters, edit), RESULT))
