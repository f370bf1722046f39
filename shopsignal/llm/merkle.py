"""Merkle dataset manifest: a hash tree over a table's rows, with a proof for each row.

Rows are leaves of one tree per source; the trees' roots, in source order, are
the leaves of one more tree.  Nodes are labelled by (round, tree, block, level,
index), children always before their parents, and processed in that order
(time-forward processing): a digest is a message to its parent, held in a
priority queue by the parent's label.  The queue's external part is the sorted
shuffle between rounds; a round climbs ``LEVELS`` levels, so its messages stay
inside a block of 16**LEVELS nodes and a task's queue holds one block's.  A
sweep in reversed label order then sends every node's proof suffix to its
children, round by round down to the leaves.

A round's output is 4,096 times smaller than its input, and is written, so
a lost executor costs the tasks it ran.  Positions come from a range
partitioning by (tree, order columns) with a row number as last tie, so
neither a source nor a row that makes up a third of the table is one task.

Defined cases: a null column is the text ``-``.  Null doc_ids come first in
their source.  Rows with one doc_id follow each other by leaf; repeated rows are
leaves of their own.  A row with a null doc_id is never tampered with.  A tree
of one node is its own root, with an empty proof.  An empty table gives an
empty result.  Other columns are never read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, fresh_name, written

FAN_OUT = 16
LEVELS = 3  # climbed in a round
BLOCK = FAN_OUT**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"  # the siblings before and after a node, from its level up
Path = list[tuple[str, str]]


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- leaves
def field_bytes(value: Column) -> Column:
    """``-`` for a null, else the length in UTF-8 bytes, a colon and the value."""
    raw = value.cast("string").cast("binary")
    return F.coalesce(F.concat(F.octet_length(raw).cast("string").cast("binary"), F.lit(b":"), raw), F.lit(b"-"))


def leaf(*fields: Column) -> Column:
    """A row's leaf: the sha256 of its fields, each with its length in front."""
    return F.sha2(F.concat(*[field_bytes(f) for f in fields]), 256)


def tree_key(source: Column) -> Column:
    """A source as a non-null text of the same order (null first, then by bytes)."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


# ---------------------------------------------------------------- positions
def placed(nodes: DataFrame, *by: str) -> DataFrame:
    """``nodes`` plus ``index`` (from 0, in the order of ``by`` within ``tree``) and ``total`` (of the tree), written.

    Rows are range-partitioned and sorted once; a tree's rows in a partition
    are neighbours there, so its first row number and count (one small row for
    each tree and partition) give every row's place.
    """
    row, part = fresh_name(nodes, "__row"), fresh_name(nodes, "__part")
    numbered = written(nodes.withColumn(row, F.monotonically_increasing_id()), "merkle_rows")
    ranged = numbered.repartitionByRange("tree", *by, row).sortWithinPartitions("tree", *by, row)
    ranged = written(
        ranged.withColumns({part: F.spark_partition_id(), row: F.monotonically_increasing_id()}), "merkle_ranged")
    runs = ranged.groupBy("tree", part).agg(F.min(row).alias("__first"), F.count(F.lit(1)).alias("__n"))
    tree = Window.partitionBy("tree")
    runs = runs.withColumns({
        "__before": F.coalesce(F.sum("__n").over(tree.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "total": F.sum("__n").over(tree),
    }).drop("__n")
    return ranged.join(runs, ["tree", part]).withColumn("index", F.col("__before") + F.col(row) - F.col("__first")).drop(
        row, part, "__before", "__first")


# ---------------------------------------------------------------- one block, in a task
def climb(leaves: list[str], levels: int) -> list[list[str]]:
    """The digests of a block, level by level, its nodes processed in label order.

    Messages (receiver's label, place, digest) wait in a priority queue until
    their receiver is the next label.
    """
    out = [leaves] + [[] for _ in range(levels)]
    if not levels:
        return out
    queue = [((1, i // FAN_OUT), i, d) for i, d in enumerate(leaves)]
    heapq.heapify(queue)
    while queue:
        label = queue[0][0]
        inputs = []
        while queue and queue[0][0] == label:
            inputs.append(heapq.heappop(queue)[2])
        level, index = label
        value = digest("".join(inputs))
        out[level].append(value)
        if level < levels:
            heapq.heappush(queue, ((level + 1, index // FAN_OUT), index, value))
    return out


def siblings(level: list[str], index: int) -> tuple[str, str]:
    run = index - index % FAN_OUT
    return "".join(level[run:index]), "".join(level[index + 1:run + FAN_OUT])


def suffixes(levels: list[list[str]], top: list[Path]) -> list[Path]:
    """Every leaf's path from the paths of the block's top nodes, in reversed label order."""
    messages = top
    for level in reversed(levels[:-1]):
        messages = [[siblings(level, i), *messages[i // FAN_OUT]] for i in range(len(level))]
    return messages


def fold(value: str, path: Path, known: dict[tuple[str, int], str]) -> str:
    """The root that a leaf and its siblings give; ``known`` keeps what was folded from a node on (by steps left)."""
    steps = []
    for i, (left, right) in enumerate(path):
        step = (value, len(path) - i)
        if step in known:
            value = known[step]
            break
        steps.append(step)
        value = digest(left + value + right)
    for step in steps:
        known[step] = value
    return value


def as_structs(paths: list[Path]) -> pa.Array:
    """Paths as a column of type ``PATH``."""
    return pa.array([[{"left": a, "right": b} for a, b in p] for p in paths],
                    pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())])))


def levels_of(total: int) -> int:
    """How many of a round's levels a tree of ``total`` nodes still has."""
    n = 0
    while total > 1 and n < LEVELS:
        total, n = -(-total // FAN_OUT), n + 1
    return n


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of one (tree, block) after the other, from batches sorted by them."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (row["tree"], row["block"]) != (held[0]["tree"], held[0]["block"]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _blocks(nodes: DataFrame) -> DataFrame:
    """Nodes (and messages, whose index is -1) with their ``block``: each block in one task, in order."""
    if "block" not in nodes.columns:
        nodes = nodes.withColumn("block", F.floor(F.col("index") / BLOCK).cast("long"))
    return nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", "index")


# ---------------------------------------------------------------- rounds
def ascend(nodes: DataFrame) -> list[DataFrame]:
    """The nodes of every round, ``(tree, index, total, digest)``; a tree's root is where its ``total`` is 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_block(batches):
            total = rows[0]["total"]
            top = climb([r["digest"] for r in rows], levels_of(total))[-1]  # one node
            yield pa.RecordBatch.from_pydict({
                "tree": [rows[0]["tree"]], "index": [rows[0]["block"]], "total": [-(-total // BLOCK)], "digest": top})

    rounds = [nodes.select("tree", "index", "total", "digest")]
    largest = rounds[0].agg(F.max("total")).first()[0] or 0
    while largest > 1:
        rest = rounds[-1].filter("total > 1")
        rounds.append(written(
            _blocks(rest).mapInArrow(run, "tree string, index bigint, total bigint, digest string"), f"merkle_round_{len(rounds)}"))
        largest = -(-largest // BLOCK)
    return rounds


Emit = Callable[[list[dict], list[Path], dict], dict[str, list]]


def descend(rounds: list[DataFrame], leaves: DataFrame, of_trees: DataFrame, emit: Emit, schema: str) -> DataFrame:
    """Proofs, from the last round down to ``leaves`` (the first round's nodes with columns of their own).

    ``of_trees`` holds ``(tree, path, carried)``: the path above each tree's root and
    a text that goes along.  ``emit`` makes the result's columns from a block's leaves, their paths and a
    message ``{"carried": ...}``; paths never leave the task unless it returns them.
    """

    def sweep(result: Emit) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in _by_block(batches):
                message, nodes = rows[0], rows[1:]
                top = [(p["left"], p["right"]) for p in message["path"]]
                levels = climb([r["digest"] for r in nodes], levels_of(nodes[0]["total"]))
                found = result(nodes, suffixes(levels, [top] * len(levels[-1])), message)
                yield pa.RecordBatch.from_pydict(found)

        return run

    def onward(nodes: list[dict], paths: list[Path], message: dict) -> dict[str, list]:
        return {"tree": [r["tree"] for r in nodes], "index": [r["index"] for r in nodes], "path": as_structs(paths),
                "carried": [message["carried"]] * len(nodes)}

    paths = None  # of the nodes one round up: (tree, index, path, carried)
    for i in range(len(rounds) - 1, -1, -1):
        finished = rounds[i].filter("total = 1").select("tree", "index").join(of_trees, "tree").select("tree", "index", "path", "carried")
        if i and paths is None:  # every tree still there has come to its root
            paths = finished
            continue
        # The message of every block: the path above its top node.
        messages = paths.withColumnRenamed("index", "block") if paths is not None else None
        if not i:  # a tree of one leaf is a block without levels
            own = finished.withColumnRenamed("index", "block")
            messages = own if messages is None else messages.unionByName(own)
        nodes = rounds[i].filter("total > 1") if i else leaves
        nodes = nodes.withColumn("block", F.floor(F.col("index") / BLOCK).cast("long"))
        rows = _blocks(nodes.unionByName(messages.withColumn("index", F.lit(-1).cast("long")), allowMissingColumns=True))
        if not i:
            return rows.mapInArrow(sweep(emit), schema)
        down = rows.mapInArrow(sweep(onward), f"tree string, index bigint, path {PATH}, carried string")
        paths = written(down.unionByName(finished), f"merkle_paths_{i}")
    raise AssertionError("ascend gives at least one round")


def one_tree(nodes: DataFrame, *by: str) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """``(leaves, rounds, roots)`` of ``nodes`` with ``tree``, ``digest`` and order columns ``by``; roots are ``(tree, digest)``."""
    leaves = written(placed(nodes, *by), "merkle_leaves")
    rounds = ascend(leaves)
    roots = rounds[0].filter("total = 1").select("tree", "digest")
    for r in rounds[1:]:
        roots = roots.unionByName(r.filter("total = 1").select("tree", "digest"))
    return leaves, rounds, written(roots, "merkle_roots")


def manifest(leaves: DataFrame, emit: Emit, schema: str) -> DataFrame:
    """The result of ``emit`` over all leaves ``(tree, digest, doc_id, ...)``; ``carried`` is subroot, space, root."""
    found, rounds, subroots = one_tree(leaves, "doc_id", "digest")
    upper = subroots.select(F.lit("").alias("tree"), "digest", F.col("tree").alias("source_tree"))
    sources, upper_rounds, root = one_tree(upper, "source_tree")
    top = root.select("tree", F.array().cast(PATH).alias("path"), F.col("digest").alias("carried"))

    def of_sources(nodes: list[dict], paths: list[Path], message: dict) -> dict[str, list]:
        return {"tree": [r["source_tree"] for r in nodes], "path": as_structs(paths),
                "carried": [f"{r['digest']} {message['carried']}" for r in nodes]}

    of_trees = written(descend(upper_rounds, sources, top, of_sources, f"tree string, path {PATH}, carried string"), "merkle_trees")
    return descend(rounds, found, of_trees, emit, schema)


def proofs(docs: DataFrame) -> DataFrame:
    """Every row's leaf, subroot, root and whole proof path (as stored with a shard of the data set)."""

    def emit(nodes: list[dict], paths: list[Path], message: dict) -> dict[str, list]:
        subroot, root = message["carried"].split(" ")
        n = len(nodes)
        return {"doc_id": pa.array([r["doc_id"] for r in nodes], pa.int64()), "leaf": [r["digest"] for r in nodes],
                "subroot": [subroot] * n, "root": [root] * n,
                "path": as_structs(paths)}

    leaves = docs.select(tree_key(F.col("source")).alias("tree"), "doc_id", leaf(*[F.col(c) for c in FIELDS]).alias("digest"))
    return manifest(leaves, emit, f"doc_id bigint, leaf string, subroot string, root string, path {PATH}")


def audited(docs: DataFrame, tampered: Column, tampered_text: Column) -> DataFrame:
    """Digests of every row's proof, and the root that its leaf (of the tampered text where ``tampered``) folds to."""

    def emit(nodes: list[dict], paths: list[Path], message: dict) -> dict[str, list]:
        subroot, root = message["carried"].split(" ")
        n, known, shas, folded = len(nodes), {}, [], []
        run, behind = None, ""
        for i, (row, path) in enumerate(zip(nodes, paths)):
            if i // FAN_OUT != run:  # all but the first pair is the same for a whole run
                run, behind = i // FAN_OUT, "".join(a + b for a, b in path[1:])
                known = {}
            shas.append(digest("".join(path[0]) + behind) if path else digest(""))
            folded.append(fold(row["tampered"] or row["digest"], path, known))
        return {"doc_id": pa.array([r["doc_id"] for r in nodes], pa.int64()), "leaf": [r["digest"] for r in nodes],
                "subroot": [subroot] * n, "root": [root] * n, "proof_sha256": shas, "folded_root": folded,
                "verified": [f == root for f in folded]}

    own, other = ([F.col(c) for c in FIELDS[:-1]] + [t] for t in (F.col("text"), tampered_text))
    leaves = docs.select(
        tree_key(F.col("source")).alias("tree"), "doc_id", leaf(*own).alias("digest"),
        F.when(tampered, leaf(*other)).alias("tampered"))
    return manifest(leaves, emit, "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, "
                                  "folded_root string, verified boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*FIELDS)
    every_fifth = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return audited(docs, every_fifth, F.translate("text", UPPER, LOWER))


SOURCE_LEVELS, TREE_LEVELS = 6, 4  # the oracle's: up to 16**6 rows a source, 16**4 sources


def _oracle() -> str:
    def length_first(expr: str) -> str:
        return f"case when {expr} is null then '-' else strlen({expr}::varchar) || ':' || {expr} end"

    def levels(prefix: str, n: int) -> list[str]:
        """Each level's nodes, and the siblings before and after each."""
        out = []
        for k in range(n):
            run = f"partition by tree, i // {FAN_OUT} order by i rows between"
            out.append(f"""{prefix}s{k} as (
  select tree, i, n, coalesce(string_agg(d, '') over ({run} unbounded preceding and 1 preceding), '') l,
         coalesce(string_agg(d, '') over ({run} 1 following and unbounded following), '') r from {prefix}{k})""")
            out.append(f"""{prefix}{k + 1} as (
  select tree, i // {FAN_OUT} i, case when n > 1 then sha256(string_agg(d, '' order by i)) else any_value(d) end d,
         (n + {FAN_OUT - 1}) // {FAN_OUT} n from {prefix}{k} group by tree, i // {FAN_OUT}, n)""")
        return out

    def up(prefix: str, n: int, first: str, source: str, tree: str) -> list[str]:
        """Proof and folded digest of each row of ``source`` through the levels of one tree."""
        out, at = [], source
        for k in range(n):
            name = f"{first}{k}"
            out.append(f"""{name} as (
  select q.* exclude (proof, fold), q.proof || s.l || s.r proof, case when s.n > 1 then sha256(s.l || q.fold || s.r) else q.fold end fold
  from {at} q join {prefix}s{k} s on s.tree = q.{tree} and s.i = q.{tree}_i // {FAN_OUT**k})""")
            at = name
        return out

    fields = " || ".join(f"({length_first(f)})" for f in FIELDS[:-1])
    small = f"translate(text, '{UPPER}', '{LOWER}')"
    crc = ("list_reduce([4294967295::ubigint] || list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::ubigint), "
           "lambda c, b: list_reduce([xor(c, b)] || [0::ubigint for k in range(8)], "
           "lambda x, k: xor(x >> 1, case when x & 1 = 1 then 3988292384::ubigint else 0::ubigint end)))")
    parts = [
        f"""rows_ as (
  select doc_id, coalesce('=' || source, '') tree, sha256({fields} || ({length_first("text")})) leaf,
         case when xor({crc}, 4294967295::ubigint) % 5 = 0 then sha256({fields} || ({length_first(small)})) end tampered
  from documents)""",
        """t0r as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 tree_i, count(*) over (partition by tree) n from rows_)""",
        "t0 as (select tree, tree_i i, leaf d, n from t0r)",
        *levels("t", SOURCE_LEVELS),
        f"""u0 as (
  select '' tree, row_number() over (order by encode(tree)) - 1 i, d, count(*) over () n, tree source_tree from t{SOURCE_LEVELS})""",
        *levels("u", TREE_LEVELS),
        """q as (
  select a.*, '' proof, coalesce(a.tampered, a.leaf) fold, '' top, u0.i top_i, u0.d subroot from t0r a join u0 on u0.source_tree = a.tree)""",
        *up("t", SOURCE_LEVELS, "v", "q", "tree"),
        *up("u", TREE_LEVELS, "w", f"v{SOURCE_LEVELS - 1}", "top"),
    ]
    return "with " + ",\n".join(parts) + f"""
select a.doc_id, a.leaf, a.subroot, r.d root, sha256(a.proof) proof_sha256, a.fold folded_root, a.fold = r.d verified
from w{TREE_LEVELS - 1} a, u{TREE_LEVELS} r"""


ORACLE = _oracle()
