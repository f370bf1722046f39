"""The toxicity and quality queries against plain versions of their definitions, training sample and calibration included."""

import collections
import math
import re
import struct
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
import zstandard
from conftest import SF_SMALL
from tables import awkward, some_labels, write

from shopsignal.llm import quality_classifier, toxicity
from shopsignal.llm.queries import QUERIES


def is_held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 3 == 1


def training(docs, labels, label, bounds, max_chars=20_000):
    """``[(text, label, weight, for calibration)]`` of the sample, by the words of its documentation."""
    rows = [(r["doc_id"], r[label]) for r in labels if r["doc_id"] is not None and r[label] in (0, 1) and not is_held_out(r["doc_id"])]
    spark_hash = lambda i: struct.unpack("<q", struct.pack("<Q", xxhash.xxh64_intdigest(struct.pack("<q", i), 42)))[0]
    chosen = []
    for y, n in bounds.items():
        chosen += sorted({r for r in rows if r[1] == y}, key=lambda r: (spark_hash(r[0]), r[0]))[:n]
    texts = collections.defaultdict(list)
    for d in docs:
        if d["text"] is not None and len(d["text"]) <= max_chars:
            texts[d["doc_id"]].append(d["text"])
    got = [(min(texts[i], key=str.encode), y, i) for i, y in sorted(chosen) if texts[i]]
    of_class = collections.Counter(y for _, y, _ in got)
    total = collections.Counter(y for _, y in rows)
    return [(t, y, total[y] / of_class[y], zlib.crc32(f"calibration {i}".encode()) % 3 == 0) for t, y, i in got]


def logistic(figures, labels, weights, ridge=0.1):
    """``score(figures)`` of the weighted ridge logistic regression on standardised figures, by plain gradient descent."""
    x, y = np.array(figures, float), np.array(labels)
    if len(set(labels)) < 2:
        share = (np.dot(weights, y) + 0.5) / (sum(weights) + 1)
        return lambda f: share
    centre, scale = x.mean(0), x.std(0) + 1e-9
    x = np.c_[np.ones(len(x)), (x - centre) / scale]
    weights = np.array(weights) * len(weights) / sum(weights)
    w, step = np.zeros(x.shape[1]), 1 / (np.linalg.eigvalsh((x * weights[:, None]).T @ x / 4)[-1] + ridge)
    momentum = w
    for k in range(200_000):
        p = 1 / (1 + np.exp(-x @ momentum))
        new = momentum - step * (x.T @ (weights * (p - y)) + ridge * momentum)
        momentum, moved, w = new + k / (k + 3) * (new - w), np.abs(new - w).max(), new
        if moved < 1e-13:
            break
    return lambda f: 1 / (1 + math.exp(-(w[0] + np.dot(w[1:], (np.array(f) - centre) / scale))))


@pytest.fixture(scope="module", params=["sf", "awkward"])
def tables(request, tmp_path_factory):
    folder = SF_SMALL
    if request.param == "awkward":
        docs = awkward(90)
        for i, d in enumerate(docs):
            if d["text"] and i % 3 == 0:
                d["text"] = f"{d['text'][:3000]} you moron and fool ### moron {'*** ' * (i % 5)}"
        folder = write(tmp_path_factory.mktemp("classifiers"), docs, some_labels(docs))
    read = lambda t: pq.read_table(f"{folder}/{t}.parquet").to_pylist()
    return folder, read("documents"), read("labels")


def compare(spark, tables, name, threshold, score):
    folder, docs, _ = tables
    got = collections.Counter((r["doc_id"], r["held_out"], round(r["score"], 6)) for r in QUERIES[name](spark, folder).collect())
    by_text = {}
    want = collections.Counter()
    for d in docs:
        text = d["text"] or ""
        by_text[text] = by_text[text] if text in by_text else score(text)
        want[d["doc_id"], is_held_out(d["doc_id"]), round(by_text[text], 6)] += 1
    near = lambda c: sorted(((k[0] is None, k[0] or 0, k[1], k[2]), n) for k, n in c.items())
    assert len(near(got)) == len(near(want))
    for (a, n), (b, m) in zip(near(got), near(want)):
        assert a[:3] == b[:3] and n == m and abs(a[3] - b[3]) < 1e-5
    for r in QUERIES[name](spark, folder).collect():
        assert r["predicted"] == int(r["score"] >= threshold)


def test_toxicity(spark, tables):
    """Two-level Kneser-Ney models written out: continuation counts, absolute discounts, shared backoff."""
    _, docs, labels = tables
    sample = training(docs, labels, "toxic", toxicity.MAX_PER_CLASS)
    words_of = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    d = toxicity.DISCOUNT
    bigrams = [{p for t, y, _, c in sample if not c and y == k for p in zip([""] + words_of(t), words_of(t))} for k in (0, 1)]
    count = [collections.Counter(w for _, w in b) for b in bigrams]
    total = [max(1, len(b)) for b in bigrams]
    stems = [collections.Counter() for _ in (0, 1)]
    for y in (0, 1):
        for w, c in count[y].items():
            stems[y][w[:4]] += c
    freed_total = [sum(min(c, d) for c in stems[y].values()) / total[y] or 1.0 for y in (0, 1)]

    def log_likelihood(y, w):
        """log P(stem) P(word | stem); None where neither model knows the stem."""
        s = w[:4]
        both, known = stems[0][s] + stems[1][s], count[0][w] + count[1][w]
        if not both:
            return None
        p_stem = max(stems[y][s] - d, 0) / total[y] + freed_total[y] * both / (sum(total) + 1)
        freed = sum(min(c, d) for v, c in count[y].items() if v[:4] == s) / stems[y][s] if stems[y][s] else 1.0
        if max(count[0][w], count[1][w]) <= d:  # no model counts it above the discount: what the models free for it cancels
            return math.log(p_stem) + math.log(freed)
        return math.log(p_stem) + math.log(max(count[y][w] - d, 0) / max(1, stems[y][s]) + freed * known / (both + 1))

    memo = {}

    def difference(w):
        if w not in memo:
            one, zero = log_likelihood(1, w), log_likelihood(0, w)
            memo[w] = 0.0 if one is None else one - zero
        return memo[w]

    def figures(text):
        found = [difference(w) for w in words_of(text)]
        top = sorted(found)[-3:]
        return (top[-1], sum(top) / len(top), sum(found) / len(found), math.log1p(len(found))) if found else (0.0,) * 4

    rest = [(figures(t), y, w) for t, y, w, c in sample if c]
    score = logistic([f for f, _, _ in rest] or np.zeros((0, 4)), [y for _, y, _ in rest], [w for _, _, w in rest])
    compare(spark, tables, "op1_toxicity", 0.7, lambda text: score(figures(text)))


def test_quality(spark, tables):
    """Sizes of 512-byte chunks with a fresh compressor each, and the dictionaries of the documented pieces."""
    _, docs, labels = tables
    sample = training(docs, labels, "quality", quality_classifier.MAX_PER_CLASS)

    def dictionary(k):
        pieces = [raw[i:i + 2048] for t, y, _, c in sample if not c and y == k for raw in [t.encode()] for i in range(0, len(raw), 2048)]
        pieces = pieces[::max(1, math.ceil(len(pieces) / 8000))]
        try:
            return zstandard.train_dictionary(65536, pieces, level=3).as_bytes()
        except zstandard.ZstdError:
            return b"".join(pieces)[-65536:]

    held = [dictionary(1), dictionary(0)]

    def size(raw, k):
        found = zstandard.ZstdCompressionDict(held[k]) if held[k] else None
        c = zstandard.ZstdCompressor(level=3, dict_data=found, write_content_size=False, write_dict_id=False, write_checksum=False)
        return sum(len(c.compress(raw[i:i + 512])) for i in range(0, len(raw), 512))

    def figures(text):
        raw = text.encode()
        good, bad = size(raw, 0), size(raw, 1)
        return ((bad - good) / len(raw), good / len(raw)) if raw else (0.0, 0.0)

    rest = [(figures(t), y, w) for t, y, w, c in sample if c]
    score = logistic([f for f, _, _ in rest] or np.zeros((0, 2)), [y for _, y, _ in rest], [w for _, _, w in rest])
    compare(spark, tables, "op3_quality_classifier", 0.5, lambda text: score(figures(text)))
