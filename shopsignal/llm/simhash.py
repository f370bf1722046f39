"""SimHash near-duplicates: fingerprints linked by a forest of BK-trees.

A text's fingerprint sums up the XXH64 hashes of its three-word shingles.
Fingerprints at most ``RADIUS`` bits apart are linked, and the connected
groups of links are the near-duplicate classes.

Only distinct fingerprints are searched.  Two that differ in at most
``RADIUS`` bits agree on at least one of ``RADIUS + 1`` parts of the bits (or
on ``k`` of ``RADIUS + k`` parts), so each fingerprint goes to one *shard* per
choice of parts, and no link is lost between shards.  Each shard is a BK-tree,
whose children are keyed by their Hamming distance to the parent, and a search
follows only edges within the radius.  A shard is at most ``MAX_TREE`` members;
a larger one is cut into that many trees and each of those is sent to every
part of the shard that has to search it.  A task emits a spanning forest of
the links it finds (never all pairs), and large-star / small-star rounds over
written tables join the forests.

Defined cases: a null text is an empty one; a text without words has
fingerprint zero, which links like any other.  Null doc_ids count as rows but
never name a class unless all of its rows are null (then the class id is
null).  Repeated rows share a class.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.joins import checked_broadcast, key_bucket
from .common import identified, text_or_empty, written

SHINGLE = 3
RADIUS = 3
SEED = 42
MAX_TREE = 4096  # members of one tree
SHARD_TARGET = 64  # members an even shard should have at most
FRONTIER = 1 << 21  # (searcher, node) pairs held at a time
CHUNK = 1 << 18  # members of the trees built side by side


# ---------------------------------------------------------------- fingerprints
def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text; a bit is 1 if over half of the shingle hashes have it."""
    words = text.encode("utf-8").lower().split()  # of bytes: A-Z only, and ASCII white space
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, SEED) for g in grams), "<u8")
    set_bits = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = np.unpackbits(hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += part.sum(0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a long column (the same 64 bits, signed)."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return run(text_or_empty(text))


# ---------------------------------------------------------------- trees
class Forest:
    """BK-trees built side by side: one per value of ``group`` (ascending), over distinct members of each."""

    def __init__(self, group: np.ndarray, values: np.ndarray):
        self.values = values
        n = len(values)
        first = np.ones(n, bool)
        first[1:] = group[1:] != group[:-1]
        self.root = {int(g): i for g, i in zip(group[first], np.flatnonzero(first))}
        parent = np.flatnonzero(first)[np.cumsum(first) - 1]
        waiting = np.flatnonzero(~first)
        parent = parent[waiting]
        keys, nodes = [], []
        while len(waiting):
            # Of those at one edge of one node the first becomes the child; the others go down to it.
            edge = np.bitwise_count(values[waiting] ^ values[parent]).astype(np.int64)
            key = parent * 128 + edge
            order = np.argsort(key, kind="stable")
            key, waiting = key[order], waiting[order]
            lead = np.ones(len(key), bool)
            lead[1:] = key[1:] != key[:-1]
            keys.append(key[lead])
            nodes.append(waiting[lead])
            parent = waiting[lead][np.cumsum(lead) - 1][~lead]
            waiting = waiting[~lead]
        self.keys = np.concatenate(keys) if keys else np.empty(0, np.int64)
        self.nodes = np.concatenate(nodes) if nodes else np.empty(0, np.int64)
        order = np.argsort(self.keys)
        self.keys, self.nodes = self.keys[order], self.nodes[order]

    def search(self, searchers: np.ndarray, roots: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index pairs (searcher, member) within the radius, as arrays, a bounded piece at a time."""
        waiting = [(np.arange(len(searchers)), roots)]
        while waiting:
            q, node = waiting.pop()
            if len(q) > FRONTIER // 64:
                half = len(q) // 2
                waiting += [(q[:half], node[:half]), (q[half:], node[half:])]
                continue
            d = np.bitwise_count(searchers[q] ^ self.values[node]).astype(np.int64)
            near = d <= radius
            yield q[near], node[near]
            low = np.searchsorted(self.keys, node * 128 + np.maximum(d - radius, 1))
            high = np.searchsorted(self.keys, node * 128 + d + radius, "right")
            fan = high - low
            if total := int(fan.sum()):
                at = np.repeat(low - np.cumsum(fan) + fan, fan) + np.arange(total)
                waiting.append((np.repeat(q, fan), self.nodes[at]))


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (indices of equal or smaller members) after linking a[i] with b[i]."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(label, up := label[label]):
            label = up


def _forest_links(groups: np.ndarray, fps: np.ndarray, blocks: np.ndarray, tree: np.ndarray, probe: np.ndarray,
                  radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the groups (contiguous): trees over blocks ``tree``, searched by blocks ``probe``."""
    in_tree = np.flatnonzero(blocks == tree)
    forest = Forest(groups[in_tree], fps[in_tree])
    who = np.flatnonzero(blocks == probe)
    roots = np.array([forest.root.get(int(g), -1) for g in groups[who]], np.int64)
    who, roots = who[roots >= 0], roots[roots >= 0]
    label = np.arange(len(fps))
    for q, node in forest.search(fps[who], roots, radius):
        a, b = who[q], in_tree[node]
        other = a != b
        label = _join(label, a[other], b[other])
    linked = np.flatnonzero(label != np.arange(len(fps)))
    return fps[linked], fps[label[linked]]


def _link_shards(radius: int):
    """Rows (shard, tree, probe, block, fp), ordered by the first three, to rows (a, b) of a spanning forest."""
    key = ["shard", "tree", "probe"]

    def links(part: pd.DataFrame) -> pa.RecordBatch:
        changed = (part[key].values[1:] != part[key].values[:-1]).any(1)
        group = np.concatenate([[0], np.cumsum(changed)])
        several = np.bincount(group)[group] > 1
        part, group = part[several], group[several]
        a, b = _forest_links(group, part["fp"].values.view(np.uint64), part["block"].values, part["tree"].values,
                             part["probe"].values, radius)
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            held.append(batch.to_pandas())
            if sum(map(len, held)) >= CHUNK:
                part = pd.concat(held, ignore_index=True)
                last = part[key].values
                whole = int(np.flatnonzero((last != last[-1]).any(1)).max(initial=-1)) + 1  # the last group may go on
                if whole:
                    yield links(part[:whole])
                held = [part[whole:]]
        if held and sum(map(len, held)):
            yield links(pd.concat(held, ignore_index=True))

    return run


def _shard_masks(n: int, radius: int) -> list[int]:
    """Bit masks, of which two fingerprints within the radius agree on at least one.

    Of ``radius + k`` parts of the 64 bits, ``k`` are untouched by ``radius``
    changes.  ``k`` is the least whose masks are wide enough to leave about
    ``SHARD_TARGET`` of ``n`` even fingerprints in a shard.
    """
    for k in range(1, 5):
        cuts = [round(i * 64 / (radius + k)) for i in range(radius + k + 1)]
        parts = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
        masks = [sum(chosen) for chosen in combinations(parts, k)]
        if n >> min(m.bit_count() for m in masks) <= SHARD_TARGET:
            break
    return masks


def links(fps: DataFrame, radius: int = RADIUS, max_tree: int = MAX_TREE, n: int | None = None) -> DataFrame:
    """``(a, b)``, a > b as signed or not: enough links between distinct fingerprints ``fp`` to connect every class."""
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    masks = _shard_masks(fps.count() if n is None else n, radius)
    shards = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(signed(m)))) for i, m in enumerate(masks)])
    members = fps.select("fp", F.explode(shards).alias("shard"))
    # key_bucket: the join shuffles the sizes on its own, so AQE can split a shard that many fingerprints share.
    sizes = members.groupBy("shard", key_bucket("shard")).agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > 1)
    sizes = sizes.select("shard", "size")
    blocks = F.ceil(F.col("size") / max_tree)
    members = (
        members.join(sizes, "shard")  # also drops shards of one
        .withColumn("blocks", blocks.cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("shard", F.least("block", "other").alias("tree"), F.greatest("block", "other").alias("probe"), "block", "fp")
    )
    return (
        members.repartition("shard", "tree", "probe").sortWithinPartitions("shard", "tree", "probe")
        .mapInArrow(_link_shards(radius), "a bigint, b bigint")
    )


# ---------------------------------------------------------------- classes
def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step (Kiveris et al., 2014) over edges with a > b.

    The least neighbours are grouped with ``key_bucket``, so the joins can split the hub of a huge class.
    """
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a", key_bucket("a")).agg(F.least(F.min("b"), F.col("a")).alias("m")).select("a", "m")
    # Every neighbour above a node is tied to the least node around it.
    large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.filter(F.col("a") != F.col("b")).distinct()
    least = large.groupBy("a", key_bucket("a")).agg(F.min("b").alias("m")).select("a", "m")
    # Every neighbour below a node, and the node, is tied to the least of them.
    small = large.join(least, "a").select(F.col("b").alias("x"), "m").union(least.select(F.col("a").alias("x"), "m"))
    return small.filter(F.col("x") != F.col("m")).select(F.col("x").alias("a"), F.col("m").alias("b")).distinct()


def classes(edges: DataFrame) -> DataFrame:
    """``(fp, root)`` for every fingerprint with a link: the least one of its connected class."""
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = written(edges, "simhash_edges"), None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return edges.select(F.col("a").alias("fp"), F.col("b").alias("root"))
        edges, before = written(_stars(edges), "simhash_edges"), now


def class_roots(fps: DataFrame, radius: int = RADIUS, max_tree: int = MAX_TREE) -> DataFrame:
    """``(fp, root)`` for every distinct fingerprint of ``fps`` (column ``fp``); written."""
    distinct = written(fps.select("fp").distinct(), "simhash_fps")
    linked = classes(links(distinct, radius, max_tree))
    return written(distinct.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root")), "simhash_roots")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``: the 16 hex digits and the smallest doc_id of the class."""
    rows = written(docs.select("doc_id", fingerprint_column(F.col("text"), shingle).alias("fp")), "simhash_docs")
    roots = class_roots(rows, radius)
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))  # a group of copies meets as one row a task
    by_fp = least.join(roots, "fp")
    names = by_fp.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(roots.join(names, "root").select("fp", "component_id"), "simhash_components")
    return rows.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, text: str = "text", order: str = "doc_id", shingle: int = SHINGLE,
             radius: int = RADIUS) -> DataFrame:
    """One row of every class: the smallest ``order`` value (nulls last; ties: the first by file and row), all its columns.

    Decided on narrow rows (fingerprint, order, file and row).  The rows that
    go are few numbers each; while they measure within the broadcast bounds,
    the texts are read once more and never shuffled.
    """
    docs = identified(docs, "simhash_rows")
    place = docs.metadataColumn("_metadata")
    file, row = F.xxhash64(place["file_path"]), place["row_index"]
    narrow = written(
        docs.select(fingerprint_column(F.col(f"`{text}`"), shingle).alias("fp"), F.col(f"`{order}`").isNull().alias("no_order"),
                    F.col(f"`{order}`").alias("order"), file.alias("file"), row.alias("row")), "simhash_narrow")
    narrow = narrow.select("fp", F.struct("no_order", "order", "file", "row").alias("o"))
    roots = class_roots(narrow, radius)
    # A group of copies meets as one row a task; key_bucket lets the join with all rows split it.
    first = narrow.groupBy("fp").agg(F.min("o").alias("o")).join(roots, "fp").groupBy("root").agg(F.min("o").alias("first"))
    first = roots.join(first, "root").groupBy("fp", key_bucket("fp")).agg(F.first("first").alias("first")).select("fp", "first")
    gone = narrow.join(first, "fp").filter(F.col("o") != F.col("first")).select(
        F.col("o.file").alias("__sh_file"), F.col("o.row").alias("__sh_row"))
    gone = checked_broadcast(written(gone, "simhash_gone"))
    stays = docs.join(gone, (file == F.col("__sh_file")) & (row == F.col("__sh_row")), "left_anti")
    return stays.select(*[docs[f"`{c}`"] for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs)
