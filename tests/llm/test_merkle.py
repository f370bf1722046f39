"""Merkle manifest against a plain tree, with trees of every shape, hot sources and repeated rows."""

import hashlib
import random
import zlib

import pyarrow.parquet as pq
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from tables import awkward, write

from shopsignal.llm import merkle
from shopsignal.llm.queries import QUERIES

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def tree(digests):
    """The root, and for each leaf its steps (siblings before, after)."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for i, place in enumerate(at):
            run = place - place % 16
            paths[i].append(("".join(digests[run:place]), "".join(digests[place + 1:run + 16])))
            at[i] = place // 16
        digests = [h("".join(digests[i:i + 16])) for i in range(0, len(digests), 16)]
    return (digests[0] if digests else None), paths


def brute(rows):
    lower = lambda t: t and "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    sources = {}
    for r in rows:
        own = leaf(r, r["text"])
        hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        sources.setdefault(r["source"], []).append((r["doc_id"], own, leaf(r, lower(r["text"])) if hit else own))
    out, subroots = [], []
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        sources[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        subroots.append(tree([x[1] for x in sources[s]]))
    root, above = tree([s for s, _ in subroots])
    for s, (subroot, paths), upper in zip(order, subroots, above):
        for (doc_id, own, tampered), path in zip(sources[s], paths):
            folded = tampered
            for left, right in path + upper:
                folded = h(left + folded + right)
            out.append((doc_id, own, subroot, root, h("".join(a + b for a, b in path + upper)), folded, folded == root))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def audited(df):
    return merkle.audited(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
                          F.translate("text", merkle.UPPER, merkle.LOWER))


@pytest.mark.parametrize("where", ["sf", "awkward"])
def test_query(spark, where, tmp_path):
    folder = SF_SMALL if where == "sf" else write(tmp_path / "d", awkward())
    rows = pq.read_table(f"{folder}/documents.parquet").to_pylist()
    assert result(QUERIES["op12_merkle_manifest"](spark, folder)) == brute(rows)


def test_many_sources_and_repeated_rows(spark):
    """Null, empty and hot sources, a row that occurs 700 times, null ids; places are gapless in every tree."""
    rng = random.Random(2)
    rows = [(i, rng.choice([None, "", "a", "Ä", "hot", "hot", "hot"]), "en", i, f"Text {i}") for i in range(1500)]
    rows += [(7, "hot", None, None, "Same ROW")] * 700 + [(i, f"s{i}", "x", 1, None) for i in range(40)]
    rows += [(None, "hot", "x", None, f"No id {i}") for i in range(30)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = brute([dict(zip(SCHEMA.replace(" bigint", "").replace(" string", "").split(", "), r)) for r in rows])
    assert result(audited(df)) == want
    ranged = merkle.placed(df.select(merkle.tree_key(F.col("source")).alias("tree"), "doc_id", F.col("text").alias("digest")), "doc_id", "digest")
    places = {}
    for r in ranged.collect():
        places.setdefault(r["tree"], []).append(r["index"])
        assert r["total"] == sum(1 for x in rows if ("" if x[1] is None else "=" + x[1]) == r["tree"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_block_helpers_over_several_rounds():
    for n in (1, 2, 15, 16, 17, 255, 256, 257, 4095, 4096):
        leaves = [h(str(i)) for i in range(n)]
        levels = merkle.climb(leaves, merkle.levels_of(n))
        root, paths = tree(leaves)
        assert levels[-1] == [root] and merkle.suffixes(levels, [[]]) == paths
    assert merkle.levels_of(4097) == merkle.LEVELS
    known = {}
    leaves = [h(str(i)) for i in range(40)]
    root, paths = tree(leaves)
    assert all(merkle.fold(d, p, known) == root for d, p in zip(leaves, paths))
    assert merkle.fold(h("other"), paths[3], known) != root


def test_more_than_a_round(spark):
    """A tree of more than 4,096 leaves has messages between rounds."""
    rows = [(i, "big" if i < 5000 else f"s{i % 3}", None, None, f"Row {i}") for i in range(5200)]
    want = brute([dict(zip(("doc_id", "source", "lang", "n_chars", "text"), r)) for r in rows])
    assert result(audited(spark.createDataFrame(rows, SCHEMA))) == want


def test_stored_proofs_lead_to_the_root(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = merkle.proofs(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        value = r["leaf"]
        seen = [value]
        for left, right in r["path"]:
            value = h(left + value + right)
            seen.append(value)
        assert value == r["root"] and r["subroot"] in seen


def test_hot_source_is_spread(spark):
    """A source with two thirds of the rows is cut over the range partitions."""
    rows = [(i // 50, "hot" if i % 3 else f"s{i}", None, None, str(i)) for i in range(6000)]
    df = spark.createDataFrame(rows, SCHEMA)
    leaves = df.select(merkle.tree_key(F.col("source")).alias("tree"), "doc_id", F.col("text").alias("digest"))
    placed = merkle.placed(leaves, "doc_id", "digest").filter("tree = '=hot'")
    assert placed.agg(F.max("index")).first()[0] == 3999
    blocks = merkle._blocks(placed).groupBy("block").count().collect()
    assert len(blocks) == 1 and blocks[0]["count"] == 4000 <= merkle.BLOCK
