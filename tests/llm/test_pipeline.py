"""The pipeline, stage by stage, against what each operator decides on its own; awkward and empty tables."""

import collections
import math
import os
import zlib

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import zstandard
from tables import awkward, some_labels, write
from test_edges import CLASH
from test_operators import best_fit, fingerprint
from tokenizers import Tokenizer

from shopsignal.llm import quality_classifier, quality_rules
from shopsignal.session import scratch_scope

STAGES = dict(corpus_pipeline.STAGES)


def rows(df):
    return collections.Counter(map(repr, (tuple(r) for r in df.collect())))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    docs = awkward(80)
    for i, d in enumerate(docs):  # enough bad texts to learn from
        if i % 6 == 0 and d["text"]:
            d["text"] = " ".join(f"{w}### {w}***" for w in d["text"].split()[:200])
    return write(tmp_path_factory.mktemp("pipeline"), docs, some_labels(docs), CLASH)


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "quality_classifier", "simhash_near_dedup", "best_fit_packing"]


def test_each_stage_does_its_operators_work(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns

    kept = corpus_pipeline.written(STAGES["quality_rules"](spark, docs, folder), "t1")
    assert kept.columns == columns and 0 < kept.count() < docs.count()
    good = collections.Counter(r["text"] for r in quality_rules.with_rules(docs.select("text")).filter("kept").collect())
    assert good == collections.Counter(r["text"] for r in kept.collect())

    # All rows, so that some are rejected.
    judged = STAGES["quality_classifier"](spark, docs, folder)
    assert judged.columns == columns
    model = quality_classifier.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    want = collections.Counter(t for t in (r["text"] for r in docs.collect()) if model.score([t or ""])[0] >= 0.5)
    assert want == collections.Counter(r["text"] for r in judged.collect())

    single = corpus_pipeline.written(STAGES["simhash_near_dedup"](spark, kept, folder), "t3")
    assert single.columns == columns and not rows(single) - rows(kept)
    before, after = ([(r["doc_id"], fingerprint(r["text"] or "")) for r in df.collect()] for df in (kept, single))
    group = list(range(len(before)))
    for i in range(len(before)):
        for j in range(i):
            if (before[i][1] ^ before[j][1]).bit_count() <= 3:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    best = {}
    for g, (doc_id, _) in zip(group, before):
        best[g] = min(best.get(g, (True, 0)), (doc_id is None, doc_id or 0))
    assert sorted(best.values()) == sorted((d is None, d or 0) for d, _ in after)

    packed = STAGES["best_fit_packing"](spark, single, folder).collect()
    assert {r["doc_id"] for r in packed} == {d for d, _ in after}
    assert sum(r["piece"] == 0 for r in packed) == len(after)
    held = collections.defaultdict(int)
    for r in packed:
        held[r["sequence_id"]] += r["length"]
    assert max(held.values()) <= 2048


def test_run_equals_its_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, folder), name)
    pieces = lambda df: rows(df.select("doc_id", "piece", "start", "length", "ids_crc32"))
    assert pieces(corpus_pipeline.run(spark, folder)) == pieces(docs) and docs.count()


def test_run_leaves_only_its_result_behind(spark, folder):
    with scratch_scope() as drawn:
        result = corpus_pipeline.run(spark, folder)
    left = [p for p in drawn if os.path.exists(p.removeprefix("file:")) and not p.endswith(".zip")]
    assert len(drawn) > 10 and len(left) == 1 and left[0].endswith("pipeline_best_fit_packing") and result.count()


def test_run_against_plain_versions(spark, folder):
    """The rules by their SQL, the classifier by fresh compressors, near-duplicates pair by pair, lengths by the tokenizers library."""
    docs = [dict(r, row=i) for i, r in enumerate(pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pylist())]
    con = duckdb.connect()
    con.register("documents", pa.Table.from_pylist([{"doc_id": d["row"], "text": d["text"]} for d in docs],
                                                   pa.schema([("doc_id", pa.int64()), ("text", pa.string())])))
    good = {row for row, kept in con.execute(f"select doc_id, kept from ({quality_rules.ORACLE})").fetchall() if kept}
    docs = [d for d in docs if d["row"] in good]

    model = quality_classifier.train(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    held = [zstandard.ZstdCompressionDict(x) if x else None for x in (model.good, model.bad)]

    def size(raw, k):
        c = zstandard.ZstdCompressor(level=3, dict_data=held[k], write_content_size=False, write_dict_id=False, write_checksum=False)
        return sum(len(c.compress(raw[i:i + 512])) for i in range(0, len(raw), 512))

    def is_good(text):
        raw = text.encode()
        a, b = size(raw, 0), size(raw, 1)
        f = np.array([(b - a) / len(raw), a / len(raw)])
        c = model.calibrator
        return 1 / (1 + math.exp(-(c.coefficients[0] + ((f - c.centre) / c.scale) @ c.coefficients[1:]))) >= 0.5

    docs = [d for d in docs if is_good(d["text"])]
    group, prints = list(range(len(docs))), [fingerprint(d["text"]) for d in docs]
    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 and group[i] != group[j]:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    best = {}
    for g, d in zip(group, docs):
        key = (d["doc_id"] is None, d["doc_id"] or 0)
        best.setdefault(g, []).append((key, d["text"]))
    classes = [[t for key, t in members if key == min(k for k, _ in members)] for members in best.values()]
    keys = [min(k for k, _ in members) for members in best.values()]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

    def pieces(text):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids), 2048), len(ids)]
        return [(k, x, y - x, zlib.crc32(ids[x:y].tobytes())) for k, (x, y) in enumerate(zip(cuts, cuts[1:]))]

    got = corpus_pipeline.run(spark, folder).collect()
    by_doc = collections.defaultdict(list)
    for r in got:
        by_doc[(r["doc_id"] is None, r["doc_id"] or 0)].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    want = collections.defaultdict(list)
    for key, texts in zip(keys, classes):  # rows that share the least doc_id: any of them
        options = [pieces(t) for t in set(texts)]
        chosen = [o for o in options if not collections.Counter(o) - collections.Counter(by_doc[key])]
        want[key] += (chosen or options)[0]
    assert len(docs) > 10 and len(classes) < len(docs)
    assert {k: sorted(v) for k, v in by_doc.items() if v} == {k: sorted(v) for k, v in want.items()}
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert all(sum(n for _, n in x) <= 2048 and sorted(x)[0][0] == 0 for x in sequences.values())
    assert len(sequences) == len(best_fit([r["length"] for r in got], 2048))


def test_empty_and_null_tables(spark, tmp_path):
    empty = write(tmp_path / "empty", [], [])
    assert corpus_pipeline.run(spark, empty).count() == 0
    nulls = [{"doc_id": None, "text": None, "lang": None, "source": None, "n_chars": None}] * 4
    assert corpus_pipeline.run(spark, write(tmp_path / "nulls", nulls, [])).count() == 0
    docs = spark.read.parquet(f"{tmp_path / 'nulls'}/documents.parquet")
    assert STAGES["simhash_near_dedup"](spark, docs, "").count() == 1
    assert STAGES["quality_classifier"](spark, docs, str(tmp_path / "nulls")).count() in (0, 4)
    assert STAGES["best_fit_packing"](spark, docs, "").count() == 4
