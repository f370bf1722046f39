"""Token-ID files: whole texts as ids in ascending doc_id order, coded by ``rans`` in sections.

A folder holds two Parquet tables (so any store Spark writes to will do):
``sections``, whose files in the order of their names hold all ids in order,
and ``manifest``, which says of each section how many ids of the whole come
before it.  ``sections`` has one row a section: the documents' ids and lengths, one frequency table, and the
blocks with their checkpoints and checksums.  A section holds about
``SECTION`` ids, so a task's memory does not grow with the data (one document
is never cut between sections).  Sections are numbered through their bucket;
buckets are contiguous stretches of the doc_id order, so no step sorts or
gathers the whole corpus.  Neighbouring buckets go to a task, as many as make up an equal share of the bytes.

Defined cases: a null text is an empty one; a document always has its end id.
Rows with one doc_id follow each other by text hash, null doc_ids come last,
repeated rows are separate documents.  Other columns are never read.  An empty
table makes files without sections.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from . import rans
from .common import order_buckets, text_or_empty
from .tokens import encoder, in_chunks, vocabulary

SECTION = 1 << 21
SECTIONS = (
    "r int, sub bigint, first bigint, n_tokens bigint, doc_ids array<bigint>, lengths array<bigint>, "
    "symbols binary, freqs binary, "
    "blocks array<struct<n:int,words:binary,states:binary,places:binary,crc32:bigint>>"
)
_SECTIONS = pa.schema([
    ("r", pa.int32()), ("sub", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
    ("symbols", pa.binary()), ("freqs", pa.binary()),
    ("blocks", pa.list_(pa.struct([("n", pa.int32()), ("words", pa.binary()), ("states", pa.binary()),
                                   ("places", pa.binary()), ("crc32", pa.int64())]))),
])


def _tokenise(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in in_chunks(texts):
                ids = pa.array(e.encode(texts[a:b]), pa.binary())
                rest = batch.slice(a, b - a).drop_columns(["text"])
                yield pa.RecordBatch.from_arrays([*rest.columns, ids], names=[*rest.schema.names, "ids"])

    return run


def _to_sections(dtype: str, end_id: int | None, section: int):
    """Rows ``(r, sub, doc_id, ids)``, ordered within each bucket, to section rows."""
    end = np.array([] if end_id is None else [end_id], dtype).tobytes()
    width = np.dtype(dtype).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, first, docs, parts, held = None, 0, [], [], 0

        def section_row():
            ids = np.frombuffer(b"".join(parts), dtype)
            symbols, freqs, blocks = rans.encode(ids) if len(ids) else (np.empty(0, "<u4"), np.empty(0, "<u4"), [])
            return pa.RecordBatch.from_pylist([{
                "r": bucket[0], "sub": bucket[1], "first": first, "n_tokens": len(ids),
                "doc_ids": docs, "lengths": [len(p) // width for p in parts],
                "symbols": symbols.astype("<u4").tobytes(), "freqs": freqs.astype("<u4").tobytes(),
                "blocks": [b._asdict() for b in blocks],
            }], _SECTIONS)

        for batch in batches:
            for r, sub, doc_id, ids in zip(*(batch.column(c).to_pylist() for c in ("r", "sub", "doc_id", "ids"))):
                if docs and (held >= section or bucket != (r, sub)):
                    yield section_row()
                    first, docs, parts, held = first + held, [], [], 0
                if bucket != (r, sub):
                    bucket, first = (r, sub), 0
                docs.append(doc_id)
                parts.append(ids + end)
                held += len(parts[-1]) // width
        if docs:
            yield section_row()

    return run


def _from_sections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Section rows to ``(r, sub, doc_id, start, ids)``, ``start`` counted within the bucket."""
    for batch in batches:
        for row in batch.to_pylist():
            blocks = [rans.Block(**b) for b in row["blocks"]]
            ids = rans.decode(np.frombuffer(row["symbols"], "<u4"), np.frombuffer(row["freqs"], "<u4"), blocks)
            lengths = np.array(row["lengths"], np.int64)
            begins = np.cumsum(lengths) - lengths
            raw = ids.astype("<u4").tobytes()
            n = len(lengths)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["r"]] * n, pa.int32()), pa.array([row["sub"]] * n, pa.int64()),
                 pa.array(row["doc_ids"], pa.int64()), pa.array(begins + row["first"], pa.int64()),
                 pa.array([raw[4 * b:4 * (b + k)] for b, k in zip(begins.tolist(), lengths.tolist())], pa.binary())],
                names=["r", "sub", "doc_id", "start", "ids"])


def _tasks(buckets: list, n: int) -> list[tuple[int, int, int]]:
    """``(r, sub, task)`` of ordered ``(r, sub, bytes)`` buckets: contiguous, and near equal shares of the bytes."""
    total, before, out = sum(b["bytes"] for b in buckets) or 1, 0, []
    for b in buckets:
        out.append((b["r"], b["sub"], min(n - 1, (before + b["bytes"] // 2) * n // total)))
        before += b["bytes"]
    return out


def write_files(docs: DataFrame, tokenizer_path: str, end_id: int | None, section: int = SECTION, path: str | None = None) -> str:
    """Encode ``docs`` (doc_id, text) and write the files; returns their folder (``path``, or one of its own)."""
    spark = docs.sparkSession
    path = (path or scratch_path(spark, "token_files")).rstrip("/")
    docs = docs.select("doc_id", text_or_empty(F.col("text")).alias("text"))
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = order_buckets(docs, 3 * n).select("doc_id", "text_hash", "r", "sub", "text")  # several buckets a task even out
    # A few rows for each shuffle partition, whatever the table holds.
    buckets = docs.groupBy("r", "sub").agg(F.sum(F.octet_length("text") + 1).alias("bytes")).orderBy("r", "sub").collect()
    tasks = spark.createDataFrame(_tasks(buckets, n), "r int, sub bigint, task int")
    dtype = encoder(tokenizer_path).dtype.str
    ids = docs.mapInArrow(_tokenise(tokenizer_path), "doc_id bigint, text_hash bigint, r int, sub bigint, ids binary")
    dealt = ids.join(F.broadcast(tasks), ["r", "sub"]).repartitionById(n, F.col("task"))
    ordered = dealt.sortWithinPartitions("r", "sub", "doc_id", "text_hash")
    sections = ordered.select("r", "sub", "doc_id", "ids").mapInArrow(_to_sections(dtype, end_id, section), SECTIONS)
    sections.write.parquet(f"{path}/sections")
    found = spark.read.parquet(f"{path}/sections").select("r", "sub", "first", "n_tokens")
    totals = found.groupBy("r", "sub").agg(F.sum("n_tokens").alias("n"))
    order = Window.orderBy("r", "sub").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # over the few buckets
    begins = totals.select("r", "sub", (F.sum("n").over(order) - F.col("n")).alias("bucket_start"))
    manifest = found.join(F.broadcast(begins), ["r", "sub"]).select(
        "r", "sub", "first", "n_tokens", (F.col("bucket_start") + F.col("first")).alias("start"))
    manifest.write.parquet(f"{path}/manifest")
    return path


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, ids)`` from the files: ``ids`` little-endian 32-bit, ``start`` over all documents."""
    sections = spark.read.schema(SECTIONS).parquet(f"{path}/sections")
    manifest = spark.read.parquet(f"{path}/manifest")
    decoded = sections.mapInArrow(_from_sections, "r int, sub bigint, doc_id bigint, start bigint, ids binary")
    # One row a bucket: a fixed multiple of the number of shuffle partitions.
    begins = manifest.filter("first = 0").select("r", "sub", F.col("start").alias("bucket_start"))
    return decoded.join(F.broadcast(begins), ["r", "sub"]).select(
        "doc_id", (F.col("bucket_start") + F.col("start")).alias("start"), "ids")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    ids = read_files(spark, write_files(docs, vocabulary("word_bpe_49k.json"), end_id=2))
    return ids.select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"))
