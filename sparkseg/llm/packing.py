"""Packing documents into containers along a space-filling curve."""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sparkseg.llm.sampling import drawn
from sparkseg.llm.tokenizer import BATCH, FOLDER, VOCABULARY, broadcast_model, encoder
from sparkseg.session import checkpointed

CAPACITY = 2048
#: Hash buckets of a document's vector, dimensions it is projected to, bits of each on the curve.
BUCKETS, DIMENSIONS, BITS = 1024, 4, 10
#: Documents on which the projection is fitted: those of the least hashes of the key.
SAMPLE = 2000
#: Neighbours that are packed together, largest first, and places of the curve over which a container stays open.
WINDOW, SPAN = 64, 512
#: Cells of the curve whose items are counted, as bits, and about how many items are packed one after another.
CELL_BITS, RUN_ITEMS = 15, 10_000


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position on the Hilbert curve of each row of whole numbers below ``2 ** bits``.

    The transposed form of the curve (Skilling, 2004), all rows at once.
    """
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where(x[n - 1] & q, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


_ANY_AXES = np.random.default_rng(7).standard_normal((DIMENSIONS, BUCKETS))


def _vectors(counts: np.ndarray) -> np.ndarray:
    weight = np.sqrt(counts.astype(np.float64))
    length = np.linalg.norm(weight, axis=1, keepdims=True)
    return weight / np.where(length > 0, length, 1)


class Projection:
    """The directions in which hashed vectors differ most, and even steps along each."""

    def __init__(self, counts: np.ndarray):
        """Principal axes of a sample of documents; fixed ones where it has too few different texts."""
        x = _vectors(counts.reshape(-1, BUCKETS))
        self.mean = x.mean(axis=0) if len(x) else np.zeros(BUCKETS)
        apart = x - self.mean
        axes = np.linalg.eigh(apart.T @ apart + 1e-9 * _ANY_AXES.T @ _ANY_AXES)[1].T[: -DIMENSIONS - 1 : -1]
        # either direction is as good: the one whose greatest part is positive
        self.axes = axes.T * np.sign(axes[np.arange(DIMENSIONS), np.abs(axes).argmax(axis=1)])
        at = self.at(counts.reshape(-1, BUCKETS))
        steps = np.linspace(0, 1, (1 << BITS) + 1)[1:-1]
        self.edges = np.quantile(at, steps, axis=0) if len(at) else np.zeros((len(steps), DIMENSIONS))

    def at(self, counts: np.ndarray) -> np.ndarray:
        return np.round((_vectors(counts) - self.mean) @ self.axes, 9)

    def keys(self, counts: np.ndarray) -> np.ndarray:
        """Places on the curve of documents, given by their counts in the hash buckets."""
        at = self.at(counts)
        return hilbert_keys(np.stack([np.searchsorted(self.edges[:, j], at[:, j]) for j in range(DIMENSIONS)], axis=1))


def _packed(ids: bytes) -> int:
    """Number of ids and their hash bucket in one number."""
    return len(ids) // 4 * BUCKETS + zlib.crc32(ids) % BUCKETS


def _counted(units: list[int]) -> tuple[int, np.ndarray]:
    """Tokens of a text and counts in the hash buckets, from its units as ``_packed`` gives them."""
    each = np.array(units, dtype=np.int64)
    return int((each // BUCKETS).sum()), np.bincount(each % BUCKETS, minlength=BUCKETS)


def fitted(df: DataFrame, key: str = "doc_id", text: str = "text", folder: str = FOLDER, vocabulary: str = VOCABULARY, sample: int = SAMPLE) -> Projection:
    """The projection of a sample of the documents that have text, 4 KB of counts each."""
    model = broadcast_model(df.sparkSession, folder, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = encoder(model, "sizes", _packed).units
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                counts = [_counted(units(t))[1].astype(np.float32).tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, type=pa.binary())], names=["h", "counts"])

    rows = drawn(df.select(key, text), key, sample, lambda rows: rows.where(F.length(text) > 0).select("h", text).mapInArrow(run, "h bigint, counts binary"))
    return Projection(np.array([np.frombuffer(r["counts"], dtype=np.float32) for r in rows]).reshape(-1, BUCKETS))


def sized(df: DataFrame, key: str = "doc_id", text: str = "text", folder: str = FOLDER, vocabulary: str = VOCABULARY) -> DataFrame:
    """Rows (key, tokens, curve) of all rows: the size in tokens and the place on the curve.

    Null and empty texts have no tokens.
    """
    spark = df.sparkSession
    model = broadcast_model(spark, folder, vocabulary)
    projection = spark.sparkContext.broadcast(fitted(df, key, text, folder, vocabulary))
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = encoder(model, "sizes", _packed).units
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                tokens, counts = np.zeros(part.num_rows, dtype=np.int64), np.zeros((part.num_rows, BUCKETS))
                for i, t in enumerate(part.column(1).to_pylist()):
                    if t:
                        tokens[i], counts[i] = _counted(units(t))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(tokens), pa.array(projection.value.keys(counts))], names=[key, "tokens", "curve"])

    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, tokens bigint, curve bigint")


def runs_of(counts: list[tuple[int, int]], most: int = RUN_ITEMS) -> list[tuple[int, int, int]]:
    """For each cell (number, items) of the curve, in order, the first of its runs and their number.

    Cells of few items share a run with their neighbours; one of more than ``most`` has runs of its own.
    """
    out, run, held = [], 0, 0
    for cell, n in sorted(counts):
        if held and held + n > most:
            run, held = run + 1, 0
        own = max(1, math.ceil(n / most))
        out.append((cell, run, own))
        held += n
        if own > 1:
            run, held = run + own, 0
    return out


class Shelf:
    """Open containers by free space; an item goes where it leaves least free."""

    def __init__(self, capacity: int, span: int = SPAN):
        self.capacity, self.span = capacity, span
        self.free: list[tuple[int, int, int]] = []
        self.made = 0

    def close(self, last: int) -> None:
        """No more into containers that ``last``, a place on the curve, is ``span`` or more ahead of."""
        self.free = [f for f in self.free if last - f[2] < self.span]

    def put(self, size: int, place: int) -> int:
        """Number of the container that takes an item of a place on the curve."""
        i = bisect_left(self.free, (size, -1, -1))
        if i < len(self.free):
            left, box, first = self.free.pop(i)
        else:
            left, box, first = self.capacity, self.made, place
            self.made += 1
        if left > size or not size:
            insort(self.free, (left - size, box, min(first, place)))
        return box


def pack(df: DataFrame, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text", folder: str = FOLDER, vocabulary: str = VOCABULARY, window: int = WINDOW, span: int = SPAN) -> DataFrame:
    """Rows (container, key, piece, first, tokens): which tokens of which row lie in which container.

    A row of at most ``capacity`` tokens lies in one container; a longer one is cut into full
    pieces, a container each, and a rest that is packed like any other item. Rows without tokens
    take no space in some container. Repeated rows and null keys are items of their own; further
    columns are ignored; an empty table gives an empty table.

    Containers hold neighbours: the rows of one lie less than ``span`` places apart in the order of the
    curve. The items of each cell of the curve, at most ``2 ** CELL_BITS`` numbers, decide
    where the curve is cut into runs of about ``RUN_ITEMS``; a cell of more, as of many copies of one text,
    is spread over runs by hash. Runs, and so containers, depend on the rows alone and not on the cluster.
    A task takes a run in order, packs each window of neighbours largest first, best fit, and
    closes what the curve has left behind, so it holds at most ``span`` open containers. Sizes are
    written once, as the cells are counted before the items are moved.
    """
    if capacity < 1:
        raise ValueError("the capacity must be positive")
    if not 0 < window <= span:
        raise ValueError("the window must be positive and within the span")
    spark = df.sparkSession
    items = checkpointed(sized(df, key, text, folder, vocabulary)).withColumn("__cell", F.shiftright("curve", DIMENSIONS * BITS - CELL_BITS))
    counts = [(r["__cell"], r["count"]) for r in items.groupBy("__cell").count().collect()]
    runs = spark.createDataFrame(runs_of(counts), "__at bigint, __first bigint, __own bigint")
    field = items.schema[key]
    of_key = to_arrow_schema(T.StructType([field])).field(0).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, shelf, waiting, seen = None, Shelf(capacity, span), [], 0

        def place(some: list[tuple]) -> pa.RecordBatch:
            nonlocal seen
            base, out = now << 40, []
            shelf.close(seen + len(some) - 1)
            for i, size in some:
                whole, rest = divmod(size, capacity)
                for p in range(whole):
                    out.append((base + shelf.made, i, p, p * capacity, capacity, seen))
                    shelf.made += 1
                if rest or not whole:
                    out.append((None, i, whole, whole * capacity, rest, seen))
                seen += 1
            out.sort(key=lambda r: -r[4])
            boxed = [r if r[0] is not None else (base + shelf.put(r[4], r[5]), *r[1:]) for r in out]
            types = [pa.int64(), of_key, pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in boxed], type=t) for k, t in enumerate(types)], names=["container", key, "piece", "first", "tokens"])

        for b in batches:
            for number, i, size in zip(*[c.to_pylist() for c in b.columns]):
                if number != now:
                    if waiting:
                        yield place(waiting)
                    now, shelf, waiting, seen = number, Shelf(capacity, span), [], 0
                waiting.append((i, size))
                if len(waiting) == window:
                    yield place(waiting)
                    waiting = []
        if waiting:
            yield place(waiting)

    number = F.col("__first") + F.pmod(F.xxhash64(key, "tokens"), F.col("__own"))
    placed = items.join(F.broadcast(runs), F.col("__cell") == F.col("__at")).withColumn("__run", number)
    order = ["__run", "curve", key, "tokens"]
    sorted_items = placed.repartition("__run").sortWithinPartitions(*order).select("__run", key, "tokens")
    return sorted_items.mapInArrow(run, f"container bigint, `{key}` {field.dataType.simpleString()}, piece bigint, first bigint, tokens bigint")


def fill(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Rows (container, items, tokens, unused) of each container."""
    return packed.groupBy("container").agg(F.count("*").alias("items"), F.sum("tokens").alias("tokens")).withColumn("unused", F.lit(capacity) - F.col("tokens"))
