"""Language-model scoring by a weighted backoff automaton.

The model is a smoothed bigram model of the training documents, counted over
all of them.  Its states are the contexts (the start, and every word seen in
training) and a root.  A seen bigram is an arc with its smoothed probability;
every state has a failure arc to the root, weighted with the context's backoff
mass, and the root has an arc for every word.  One left-to-right traversal of a
text carries the state and adds up log10 probabilities.

    P(w)   = (c(w) - d) / N for a seen word;  d * V / N for the class of unseen ones
    P(w|h) = (c(hw) + m(h) * P(w)) / (c(h) + m(h))     (a prior of weight m(h) = a * c(h)^b)

Both sum to one.  N and V count training tokens and distinct ones.  The prior
weighs more after a frequent context, which goes on with more different words.
``a`` and ``b`` are the grid point that gives all training tokens the highest
likelihood, each token scored by the counts of all training documents less
itself (leave one out).

The whole model would not fit a task, and no text needs it whole.  Documents
are read into blocks, each holding its words as 64-bit hashes and its texts as
numbers into them (written once).  A block sends its sorted n-gram keys and own
counts, cut into buckets by key, through one shuffle; each bucket adds up the
counts of equal keys and returns to every block the totals of exactly the keys
it sent, in the order it sent them.  With those a block has the part of the
automaton its texts can reach.  They meet its texts twice: for its share of the
likelihood at every grid point (the shares are added up), and for the scores.
A block's and a bucket's size are bounded whatever the corpus; a frequent
n-gram is one key a block.

Defined cases: a null or empty text is just the end token.  Null doc_ids count
as training rows (the crc32 of no text).  Repeated rows count and score as
often as they occur.  Without training rows every token is unseen and every
score is 0.  Equally good grid points: the first.  Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log10

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, text_or_empty, written

MODULUS, HELD_OUT = 7, 2
BLOCK_CHARS = 4_000_000  # of text in a block (or one document)
BUCKET_TOKENS = 2_000_000  # tokens of the corpus for each bucket
DISCOUNT = 0.75
PRIORS = [(a, b) for b in (0.0, 0.5, 0.6, 0.7, 0.8, 0.9) for a in (0.5, 1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0, 128.0)]
UNIGRAMS, BIGRAMS = 0, 1
# Keys of the end token and of the start context; no word holds a space.
END, START = (xxhash.xxh64_intdigest(s) for s in (b" end", b" start"))
_U = np.uint64

BLOCKS = (
    "block bigint, doc_ids array<bigint>, held_out array<boolean>, lengths array<bigint>, words binary, tokens binary, "
    "train_tokens bigint, train_docs bigint"
)
_BLOCKS = pa.schema([
    ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())),
    ("lengths", pa.list_(pa.int64())), ("words", pa.binary()), ("tokens", pa.binary()),
    ("train_tokens", pa.int64()), ("train_docs", pa.int64()),
])
SENT = "kind int, bucket int, block bigint, keys binary, counts binary"
TOTALS = "block bigint, kind int, bucket int, totals binary, distinct_seen bigint"


def packed(values: np.ndarray) -> bytes:
    """Integers, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes, dtype: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(dtype).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys, as differences."""
    return packed(np.diff(keys, prepend=_U(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, "<u8"), dtype=np.uint64)


# ---------------------------------------------------------------- blocks
def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base, sequence = TaskContext.get().partitionId() << 32, 0
    docs: list[tuple] = []
    number: dict[bytes, int] = {}
    texts: list[np.ndarray] = []
    chars = 0

    def block() -> pa.RecordBatch:
        keys = np.fromiter((xxhash.xxh64_intdigest(w) for w in number), np.uint64, len(number))
        keys = np.append(keys, _U(END))  # the end token's number is that of no word: -1
        order = np.argsort(keys)
        place = np.empty(len(keys), np.int32)
        place[order] = np.arange(len(keys), dtype=np.int32)
        lengths = [len(t) for t in texts]
        kept = [n for n, (_, out) in zip(lengths, docs) if not out]
        return pa.RecordBatch.from_pylist([{
            "block": base + sequence, "doc_ids": [d for d, _ in docs], "held_out": [h for _, h in docs], "lengths": lengths,
            "words": packed_keys(keys[order]), "tokens": packed(place[np.concatenate(texts)].astype("<i4")),
            "train_tokens": sum(kept), "train_docs": len(kept),
        }], _BLOCKS)

    for batch in batches:
        for doc_id, out, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "held_out", "text"))):
            if docs and chars + len(text) > BLOCK_CHARS:
                yield block()
                docs, number, texts, chars, sequence = [], {}, [], 0, sequence + 1
            words = text.encode().lower().split()  # of bytes: A-Z only, and ASCII white space
            ids = [number.setdefault(w, len(number)) for w in words]
            ids.append(-1)
            texts.append(np.array(ids, np.int32))
            docs.append((doc_id, out))
            chars += len(text)
    if docs:
        yield block()


class Block:
    """A block's texts as places in its ascending word keys, and its distinct bigrams."""

    def __init__(self, row: dict):
        self.doc_ids, self.held_out = row["doc_ids"], row["held_out"]
        self.lengths = np.array(row["lengths"], np.int64)
        self.words = unpacked_keys(row["words"])
        self.tokens = unpacked(row["tokens"], "<i4").astype(np.int64)
        # The start context has the number after the last word.
        self.start = len(self.words)
        context = np.concatenate([[self.start], self.tokens[:-1]])
        context[np.cumsum(self.lengths)[:-1]] = self.start
        pair = context * (self.start + 1) + self.tokens
        training = np.repeat(~np.array(self.held_out, bool), self.lengths)
        self.word_counts = np.bincount(self.tokens[training], minlength=self.start)
        pairs, nth = np.unique(pair, return_inverse=True)
        counts = np.bincount(nth[training], minlength=len(pairs))
        keys = self._bigram_keys(*np.divmod(pairs, self.start + 1))
        order = np.argsort(keys)
        self.pairs, self.bigrams, self.bigram_counts = pairs[order], keys[order], counts[order]

    def _bigram_keys(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        of = np.append(self.words, _U(START))
        x = of[context] * _U(0x9E3779B97F4A7C15) + of[word]
        x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
        return x ^ (x >> _U(32))

    def sent(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        return (self.words, self.word_counts) if kind == UNIGRAMS else (self.bigrams, self.bigram_counts)


def _cuts(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket begins in ascending keys, and their end."""
    if bits == 0:
        return np.array([0, len(keys)])
    edges = np.arange(1 << bits, dtype=np.uint64) << _U(64 - bits)
    return np.append(np.searchsorted(keys, edges), len(keys))


def _send(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                for kind in (UNIGRAMS, BIGRAMS):
                    keys, counts = block.sent(kind)
                    cuts = _cuts(keys, bits)
                    rows = [{"kind": kind, "bucket": i, "block": row["block"], "keys": packed_keys(keys[a:b]),
                             "counts": packed(counts[a:b].astype("<u8"))}
                            for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
                    yield pa.RecordBatch.from_pylist(rows, pa.schema([
                        ("kind", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()),
                        ("counts", pa.binary())]))

    return run


def _add_up(table: pa.Table) -> pa.Table:
    """One bucket: to every block the totals of the keys it sent."""
    keys = [unpacked_keys(k) for k in table.column("keys").to_pylist()]
    counts = np.concatenate([unpacked(c, "<u8") for c in table.column("counts").to_pylist()]).astype(np.int64)
    distinct, nth = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.zeros(len(distinct), np.int64)
    np.add.at(totals, nth, counts)
    back = np.split(totals[nth].astype("<u8"), np.cumsum([len(k) for k in keys])[:-1])
    seen = np.zeros(len(keys), np.int64)
    seen[0] = np.count_nonzero(totals)
    return pa.table({
        "block": table.column("block"), "kind": table.column("kind"), "bucket": table.column("bucket"),
        "totals": pa.array([packed(t) for t in back], pa.binary()), "distinct_seen": pa.array(seen),
    })


def _totals(returned: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A block's totals of its words and of its bigrams, in the order of their keys."""
    back = sorted(zip(*(returned.column(c).to_pylist() for c in ("kind", "bucket", "totals"))))
    words, bigrams = (np.concatenate([unpacked(t, "<u8").astype(np.int64) for k, _, t in back if k == kind])
                      for kind in (UNIGRAMS, BIGRAMS))
    return words, bigrams


# ---------------------------------------------------------------- the prior
def prior_weight(seen: np.ndarray, prior: tuple[float, float]) -> np.ndarray:
    """The weight of the prior after contexts seen so often."""
    a, b = prior
    return a * np.maximum(seen, 1.0) ** b


def _left_out(n: int, v: int, docs: int, discount: float, priors: list[tuple[float, float]]):
    """A block to the log10 likelihood of its training tokens under each prior, each token left out of the counts."""

    def run(blocks: pa.Table, returned: pa.Table) -> pa.Table:
        rows = []
        for row in blocks.to_pylist():
            block = Block(row)
            words, bigrams = _totals(returned)
            own = np.flatnonzero(block.bigram_counts)
            context, word = np.divmod(block.pairs[own], block.start + 1)
            seen, nth = np.unique(np.append(words, docs)[context] - 1, return_inverse=True)
            times, c = block.bigram_counts[own].astype(float), bigrams[own] - 1.0
            p = np.where(words > 1, (words - 1 - discount) / max(n - 1, 1), discount * v / n if n else 1.0)[word]
            # log10 of (c + m * p) / (seen + m): m and the divisor depend on ``seen`` alone, so does m * p over p where c is 0.
            all_times = np.bincount(nth, times)
            again = c > 0
            alone = np.bincount(nth[~again], times[~again], len(seen))
            fixed = times[~again] @ np.log10(p[~again])
            times, c, p, nth = times[again], c[again], p[again], nth[again]
            likelihoods = []
            for prior in priors:
                m = prior_weight(seen, prior)
                # In this order what m does not change is equal to the last bit.
                shared = alone @ np.log10(m) - all_times @ np.log10(seen + m)
                likelihoods.append(float(fixed + shared + times @ np.log10(c + m[nth] * p)))
            rows.append({"likelihoods": likelihoods})
        return pa.Table.from_pylist(rows, pa.schema([("likelihoods", pa.list_(pa.float64()))]))

    return run


def fit_prior(blocks: DataFrame, totals: DataFrame, n: int, v: int, docs: int, discount: float) -> tuple[float, float]:
    """The prior of ``PRIORS`` under which the training tokens of all blocks are likeliest."""
    found = blocks.filter("train_docs > 0").groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(
        _left_out(n, v, docs, discount, PRIORS), "likelihoods array<double>")
    sums = found.agg(*[F.sum(F.col("likelihoods")[i]).alias(f"prior_{i}") for i in range(len(PRIORS))]).first()
    return PRIORS[int(np.argmax([x or 0.0 for x in sums]))]


# ---------------------------------------------------------------- the automaton
class Automaton:
    """The part of the model that a block's texts can reach."""

    def __init__(self, block: Block, words: np.ndarray, bigrams: np.ndarray, n: int, v: int, docs: int, discount: float,
                 prior: tuple[float, float]):
        unseen = discount * v / n if n else 1.0
        p = np.where(words > 0, (words - discount) / max(n, 1), unseen)
        seen = np.append(words, docs)  # of each context; an unseen one has no arcs and free failure
        self.start = block.start
        self.width = block.start + 1
        self.root: list[float] = np.log10(p).tolist()
        m = prior_weight(seen, prior)
        self.failure: list[float] = np.log10(m / (seen + m)).tolist()
        arcs = np.flatnonzero(bigrams)
        context, word = np.divmod(block.pairs[arcs], self.width)
        weight = np.log10((bigrams[arcs] + m[context] * p[word]) / (seen[context] + m[context]))
        self.arcs: dict[int, float] = dict(zip(block.pairs[arcs].tolist(), weight.tolist()))

    def traverse(self, tokens: list[int]) -> float:
        """log10 probability of a text: follow an arc, or fail to the root and go on from there."""
        arc, width, root, failure = self.arcs.get, self.width, self.root, self.failure
        state, total = self.start, 0.0
        for w in tokens:
            weight = arc(state * width + w)
            total += failure[state] + root[w] if weight is None else weight
            state = w
        return total


def _score(n: int, v: int, docs: int, discount: float, prior: tuple[float, float]):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(blocks: pa.Table, returned: pa.Table) -> pa.Table:
        rows = []
        for row in blocks.to_pylist():
            block = Block(row)
            words, bigrams = _totals(returned)
            automaton = Automaton(block, words, bigrams, n, v, docs, discount, prior)
            of_token = words[block.tokens]
            base = np.log10(of_token + 1) - log10(n + v + 1)
            begins = np.cumsum(block.lengths) - block.lengths
            known = np.add.reduceat((of_token > 0).astype(np.int64), begins)
            bases = np.add.reduceat(base, begins)
            tokens = block.tokens.tolist()
            for i, (b, k) in enumerate(zip(begins.tolist(), block.lengths.tolist())):
                rows.append((block.doc_ids[i], block.held_out[i], k, int(known[i]), n, float(bases[i]),
                             automaton.traverse(tokens[b:b + k])))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def score(docs: DataFrame, discount: float = DISCOUNT, prior: tuple[float, float] | None = None) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every text of ``docs``.

    ``prior``: ``(a, b)`` of the prior's weight (none: fitted).
    """
    texts = docs.select("doc_id", held_out(F.col("doc_id"), MODULUS, HELD_OUT).alias("held_out"),
                        text_or_empty(F.col("text")).alias("text"))
    blocks = written(texts.mapInArrow(_to_blocks, BLOCKS), "lm_blocks")
    size = blocks.agg(F.sum("train_tokens"), F.sum("train_docs"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    n, train_docs, tokens = (int(x or 0) for x in size)
    bits = max(0, (tokens // BUCKET_TOKENS).bit_length())
    sent = blocks.mapInArrow(_send(bits), SENT)
    totals = written(sent.groupBy("kind", "bucket").applyInArrow(_add_up, TOTALS), "lm_totals")
    v = int(totals.filter(F.col("kind") == UNIGRAMS).agg(F.sum("distinct_seen")).first()[0] or 0)
    prior = prior or fit_prior(blocks, totals.drop("distinct_seen"), n, v, train_docs, discount)
    return blocks.groupBy("block").cogroup(totals.drop("distinct_seen").groupBy("block")).applyInArrow(
        _score(n, v, train_docs, discount, prior),
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
