"""Best-fit packing of documents into sequences of a fixed number of tokens.

Best-fit decreasing over the whole corpus.  Lengths are at most the capacity,
so the corpus enters the algorithm as one count per length.  Open bins live in
a segment tree over remaining capacities; the tightest capacity that holds a
length is found in logarithmic time, and all documents of that length that
go to bins of that capacity are placed at once.  The result is a short table
of placements (bounded by the capacity, not by the corpus), and every document
finds its place there by its length and its number among equal lengths.

Defined cases: a null text is an empty one and has just the end id.  Rows with
one doc_id are separate documents, numbered when the pieces are written.
Other columns are never read.  An empty table gives no sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..plans.joins import checked_broadcast
from .common import text_or_empty, written
from .tokens import encoder, in_chunks, vocabulary

CAPACITY = 2048
RANK_ROWS = 100_000  # equal lengths are numbered in parts of about so many


class OpenBins:
    """Runs of bins by remaining capacity, under a segment tree that finds the tightest non-empty one."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.size)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _mark(self, remaining: int) -> None:
        i = remaining + self.size
        self.any[i] = bool(self.runs[remaining])
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def add(self, remaining: int, first: int, n: int) -> None:
        """``n`` bins numbered from ``first`` have this capacity left."""
        self.runs[remaining].append((first, n))
        self._mark(remaining)

    def take(self, remaining: int) -> tuple[int, int]:
        run = self.runs[remaining].pop()
        self._mark(remaining)
        return run

    def tightest(self, length: int) -> int | None:
        """The least remaining capacity of at least ``length`` that some bin has."""
        i = length + self.size
        if self.any[i]:
            return length
        while i > 1:  # climb until a right-hand neighbour has bins, then go down its left side
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return None


def best_fit_decreasing(counts: Mapping[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """``(placements, bins)`` for ``counts`` items of each length (1 to ``capacity``).

    A placement (length, first_rank, per_bin, first_bin, offset) says: the
    items of this length from number ``first_rank`` on go ``per_bin`` to a
    bin, to bins from ``first_bin`` on, from ``offset`` on.
    """
    bins, placed, opened = OpenBins(capacity), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = bins.tightest(length)
            if room is None:
                room = capacity
                needed = -(-left // (capacity // length))
                bins.add(capacity, opened, needed)
                opened += needed
            first, n = bins.take(room)
            per_bin = room // length  # a bin that took one is now the tightest, until it is full
            full = min(n, left // per_bin)
            if full:
                placed.append((length, rank, per_bin, first, capacity - room))
                bins.add(room - per_bin * length, first, full)
                rank, left = rank + full * per_bin, left - full * per_bin
            if full < n and left:  # the last items fill one more bin in part
                placed.append((length, rank, per_bin, first + full, capacity - room))
                bins.add(room - left * length, first + full, 1)
                full, left = full + 1, 0
            if full < n:
                bins.add(room, first + full, n - full)
    return np.array(placed, np.int64).reshape(-1, 5), opened


def _pieces(path: str, end_id: int, capacity: int):
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            texts, doc_ids = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            for a, b in in_chunks(texts):
                rows = []
                for doc_id, raw in zip(doc_ids[a:b], e.encode(texts[a:b])):
                    ids = np.append(np.frombuffer(raw, e.dtype), end_id).astype("<u4")
                    cuts = [0, *range(len(ids) % capacity or capacity, len(ids), capacity), len(ids)]
                    rows += [(doc_id, i, x, y - x, zlib.crc32(ids[x:y])) for i, (x, y) in enumerate(zip(cuts, cuts[1:]))]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: whole documents, cut only beyond the capacity (first piece short)."""
    docs = docs.select("doc_id", text_or_empty(F.col("text")).alias("text"))
    return docs.mapInArrow(_pieces(tokenizer_path, end_id, capacity),
                           "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack(items: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """``items`` plus ``sequence_id`` and ``offset`` (``items`` must have neither, nor names that begin with __pack)."""
    rows = written(items.withColumn("__pack_row", F.monotonically_increasing_id()), "pieces")
    counts = {r[0]: r[1] for r in rows.groupBy(length).agg(F.count(F.lit(1))).collect()}  # at most `capacity` rows
    # Equal lengths are numbered part by part, in as many parts as their number asks for.
    n_parts = F.lit([-(-counts.get(x, 0) // RANK_ROWS) for x in range(capacity + 1)]).cast("array<int>")
    rows = rows.withColumn("__pack_part", F.pmod(F.xxhash64("__pack_row"), F.get(n_parts, F.col(length).cast("int"))))
    parts = rows.groupBy(length, "__pack_part").agg(F.count(F.lit(1)).alias("__pack_n"))
    upto = Window.partitionBy(length).orderBy("__pack_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = written(parts.withColumn("__pack_before", F.sum("__pack_n").over(upto) - F.col("__pack_n")), "length_counts")
    table, _ = best_fit_decreasing(counts, capacity)
    shared = items.sparkSession.sparkContext.broadcast(table)
    in_part = Window.partitionBy(length, "__pack_part").orderBy("__pack_row")
    ranked = rows.withColumn("__pack_nth", F.row_number().over(in_part) - 1).join(
        checked_broadcast(parts.drop("__pack_n")), [length, "__pack_part"])
    ranked = ranked.withColumn("__pack_rank", F.col("__pack_before") + F.col("__pack_nth"))
    ranked = ranked.select(*items.columns, "__pack_rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Placements in order of (length, first_rank), as one sorted key.
        t = shared.value
        t = t[np.lexsort((t[:, 1], t[:, 0]))]
        span = np.int64(1) << 48
        keys = t[:, 0] * span + t[:, 1]
        for batch in batches:
            lengths, rank = (np.asarray(batch.column(c)) for c in (length, "__pack_rank"))
            at = t[np.searchsorted(keys, lengths.astype(np.int64) * span + rank, "right") - 1]
            nth, per_bin = rank - at[:, 1], at[:, 2]
            sequence, offset = at[:, 3] + nth // per_bin, at[:, 4] + nth % per_bin * lengths
            out = batch.drop_columns(["__pack_rank"])
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[*out.schema.names, "sequence_id", "offset"])

    places = [StructField("sequence_id", LongType()), StructField("offset", LongType())]
    return ranked.mapInArrow(place, StructType([*items.schema.fields, *places]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(pieces(docs, vocabulary("byte_bpe_50k.json"), end_id=0))
