"""Byte-level BPE encoding and decoding over contiguous rank arrays.

A word is held as two short contiguous arrays: its parts (vocabulary ids, in
place of their boundaries) and the merge rank of every adjacent pair.  The
lowest rank is found by scanning, the boundary there is deleted, and the ranks
of the two neighbours are refreshed, until no pair has a rank.  Scanning wins
on short words; a word beyond ``SCAN_BYTES`` goes by a heap of the same ranks
over a linked list, with the same result, so a megabyte without a space stays
cheap.

Defined cases: a null or empty text has no ids and decodes to ''.  The string
of a special token is that token.  Ids that do not form UTF-8 decode to U+FFFD
where they break.  Repeated rows are encoded alike.  Other columns are never
read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_or_empty
from .tokens import MAX_CACHED_UNITS, UNIT, byte_alphabet, in_chunks, vocabulary

SCAN_BYTES = 256
# Fixed value: the vocabulary's own pattern for pre-tokens.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NONE = 1 << 60  # no merge


class RankBpe:
    def __init__(self, path: str, max_units: int = MAX_CACHED_UNITS):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_alphabet()
        as_byte = {c: b for b, c in enumerate(letters)}
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.byte_id = [vocab[c] for c in letters]
        self.base = max(vocab.values()) + 1
        # (left id, right id), as one integer -> (rank, merged id)
        self.merged: dict[int, tuple[int, int]] = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.merged[vocab[a] * self.base + vocab[b]] = (rank, vocab[a + b])
        self.rank = {k: v[0] for k, v in self.merged.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.spelled: dict[int, bytes] = {i: bytes(as_byte[c] for c in s) for s, i in vocab.items() if s not in self.special}
        self.spelled |= {i: s.encode() for s, i in self.special.items()}
        self.pre_token = regex.compile(PRE_TOKEN)
        self.max_units = max_units
        self.units: dict[str, tuple[int, ...]] = {}
        self.words: dict[str, tuple[int, ...]] = {}

    def word(self, word: str) -> tuple[int, ...]:
        """Ids of one pre-token."""
        parts = [self.byte_id[b] for b in word.encode()]
        if len(parts) > SCAN_BYTES:
            return self._long_word(parts)
        rank, merged, base = self.rank.get, self.merged, self.base
        ranks = [rank(a * base + b, _NONE) for a, b in zip(parts, parts[1:])]
        while ranks:
            low = min(ranks)
            if low == _NONE:
                break
            i = ranks.index(low)
            parts[i] = part = merged[parts[i] * base + parts[i + 1]][1]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] * base + part, _NONE)
            if i < len(ranks):
                ranks[i] = rank(part * base + parts[i + 1], _NONE)
        return tuple(parts)

    def _long_word(self, parts: list[int]) -> tuple[int, ...]:
        n, base = len(parts), self.base
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(m[0], i, parts[i], parts[i + 1]) for i in range(n - 1) if (m := self.merged.get(parts[i] * base + parts[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue  # a pair that has changed since
            parts[i], parts[j] = self.merged[a * base + b][1], -1
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y < n and (m := self.merged.get(parts[x] * base + parts[y])):
                    heapq.heappush(heap, (m[0], x, parts[x], parts[y]))
        return tuple(p for p in parts if p >= 0)

    def _unit(self, unit: str) -> tuple[int, ...]:
        ids: list[int] = []
        for w in self.pre_token.findall(unit):
            got = self.words.get(w)
            if got is None:
                got = self.word(w)
                if len(self.words) >= self.max_units:
                    self.words.clear()
                if len(w) <= SCAN_BYTES:
                    self.words[w] = got
            ids += got
        return tuple(ids)

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        pieces = self.split_special.split(text) if self.split_special else [text]
        units = self.units
        for k, piece in enumerate(pieces):
            if k % 2:
                ids.append(self.special[piece])
                continue
            for u in UNIT.findall(piece):
                got = units.get(u)
                if got is None:
                    got = self._unit(u)
                    if len(units) >= self.max_units:
                        units.clear()
                    if len(u) <= SCAN_BYTES:
                        units[u] = got
                ids += got
        return ids

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", errors="replace")


_CODECS: dict[str, RankBpe] = {}


def codec(path: str) -> RankBpe:
    """This worker's codec for a vocabulary file (kept from task to task)."""
    if path not in _CODECS:
        _CODECS[path] = RankBpe(path)
    return _CODECS[path]


def _replace(batch: pa.RecordBatch, a: int, b: int, drop: str, **new: pa.Array) -> pa.RecordBatch:
    rest = batch.slice(a, b - a).drop_columns([drop])
    return pa.RecordBatch.from_arrays([*rest.columns, *new.values()], names=[*rest.schema.names, *new])


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, ids)``: every text's ids as an array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in in_chunks(texts):
                yield _replace(batch, a, b, "text", ids=pa.array([c.encode(t) for t in texts[a:b]], pa.list_(pa.int32())))

    return docs.select("doc_id", text_or_empty(F.col("text")).alias("text")).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """``(doc_id, text)`` of ``(doc_id, ids)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            texts = [c.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield _replace(batch, 0, batch.num_rows, "ids", text=pa.array(texts, pa.string()))

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Encode every text, decode its ids, and return counts and digests of both (nothing else leaves the task)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        decimal = [str(i) for i in range(max(c.spelled) + 1)]
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in batches:
            doc_ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            n, of_ids, of_text = [], [], []
            for t in texts:
                ids = c.encode(t)
                n.append(len(ids))
                of_ids.append(sha(",".join(map(decimal.__getitem__, ids))))
                of_text.append(sha(c.decode(ids)))
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(np.array(n, np.int64)), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", text_or_empty(F.col("text")).alias("text")).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digests(docs, vocabulary("byte_bpe_50k.json"))
