"""Sharding by fixed virtual slots with a versioned slot-to-shard map.

A record hashes into one of thousands of virtual slots, and that never
changes.  Bytes are summed per slot, and a small map says which shard holds
which slot.  Version 0 of the map deals the slots out evenly; rebalancing
*edits* it (version 1, 2, ...) so that whole slots move from full shards to
empty ones until the shards' bytes are near equal.  Only the map changes, so
a rebalance moves just the slots it names.

The map has ``n_slots`` entries whatever the size of the data: that is the
bound for editing it on the driver and for broadcasting it.

A stored map is edited, not made anew: ``shard`` takes the versions stored so
far, goes on from the last of them with what the slots hold now, and returns
them with the new version behind.  A map that is still near equal is kept as it is.
Shards may be added, or taken away from the end.

Defined cases: a null text counts as 0 bytes (plus the 16 of overhead) with
the crc32 of no bytes; a null doc_id is a value like any other.  Repeated rows
are numbered, and the copy number is part of the slot hash, so even one row
that makes up a third of the table spreads over all slots; the numbers are
dealt out in runs of ``COPIES_A_RUN`` over all tasks.  Columns other than
doc_id and text are never read.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import written

N_SLOTS = 8192
ROW_OVERHEAD = 16
COPIES_A_RUN = 4096
NEAR_EQUAL = 1000  # a gap between shards of at most a thousandth of the mean stays
LAW = "bytes"
MAP_SCHEMA = "array<struct<version:int,virtual_slot:int,shard:int,first:bigint>>"


def records(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """``(doc_id, size, text_crc32, copy, virtual_slot)``: one narrow row per document.

    Equal rows meet as one row with a count (summed before the shuffle) and
    are then numbered: the count is cut into runs, the runs are dealt out to
    all tasks, and each is numbered there.  So no key's rows are ever gathered,
    and no array is longer than a run or the number of runs.
    """
    last = F.col("n") - 1
    body = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    narrow = docs.select(
        "doc_id", (F.octet_length(body) + ROW_OVERHEAD).cast("long").alias("size"), F.crc32(body).alias("text_crc32")
    )
    return (
        narrow.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / COPIES_A_RUN))))
        .repartition("doc_id", "size", "text_crc32", "run")
        .withColumn("copy", F.explode(F.sequence(F.col("run") * COPIES_A_RUN, F.least(last, (F.col("run") + 1) * COPIES_A_RUN - 1))))
        .drop("n", "run")
        .withColumn("virtual_slot",
                    F.pmod(F.xxhash64("doc_id", "size", "text_crc32", "copy"), F.lit(n_slots)).cast("int"))
    )


def slot_sizes(rows: DataFrame) -> DataFrame:
    """Bytes and rows per virtual slot (at most ``n_slots`` rows)."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def even_map(n_slots: int, n_shards: int) -> list[int]:
    """Version 0: slot ``s`` belongs to shard ``s mod n_shards``."""
    return [s % n_shards for s in range(n_slots)]


def rebalanced(mapping: Sequence[int], slot_bytes: Sequence[int], n_shards: int) -> list[int]:
    """The next version of ``mapping``, edited until shard bytes are near equal (as it is, where they are).

    Slots of shards that are no more, and of those over the mean (largest first, while over it), are freed and go, largest first, to the emptiest shard.  A
    closing pass swaps a slot of the fullest shard with one of the emptiest
    until they are near equal or nothing narrows the gap.
    """
    mapping = list(mapping)
    held: list[list[int]] = [[] for _ in range(n_shards)]
    freed = []
    for slot, shard in enumerate(mapping):
        (held[shard] if shard < n_shards else freed).append(slot)
    load = [sum(slot_bytes[s] for s in slots) for slots in held]
    mean = sum(slot_bytes) / n_shards
    if not freed and NEAR_EQUAL * (max(load) - min(load)) <= mean:
        return mapping
    for shard in range(n_shards):
        for slot in sorted(held[shard], key=lambda s: (-slot_bytes[s], s)):
            if load[shard] > mean and 0 < slot_bytes[slot]:
                if len([s for s in held[shard] if slot_bytes[s]]) == 1:
                    break
                freed.append(slot)
                held[shard].remove(slot)
                load[shard] -= slot_bytes[slot]
    heap = [(b, shard) for shard, b in enumerate(load)]
    heapq.heapify(heap)
    for slot in sorted(freed, key=lambda s: (-slot_bytes[s], s)):
        _, shard = heapq.heappop(heap)
        held[shard].append(slot)
        load[shard] += slot_bytes[slot]
        heapq.heappush(heap, (load[shard], shard))
    for _ in range(5 * n_shards):
        full, empty = max(range(n_shards), key=load.__getitem__), min(range(n_shards), key=load.__getitem__)
        gap = load[full] - load[empty]
        if NEAR_EQUAL * gap <= mean:
            break
        # A move is a swap with "nothing" (-1); the best leaves the two shards closest.
        best = min(
            ((abs(gap - 2 * (slot_bytes[a] - (slot_bytes[b] if b >= 0 else 0))), a, b)
             for a in held[full] for b in (-1, *held[empty])),
            default=(gap, -1, -1),
        )
        if best[0] >= gap:
            break
        _, a, b = best
        held[full].remove(a)
        held[empty].append(a)
        if b >= 0:
            held[empty].remove(b)
            held[full].append(b)
        moved = slot_bytes[a] - (slot_bytes[b] if b >= 0 else 0)
        load[full] -= moved
        load[empty] += moved
    for shard, slots in enumerate(held):
        for slot in slots:
            mapping[slot] = shard
    return mapping


def map_table(spark: SparkSession, versions: Mapping[int, Sequence[int]], slot_rows: Sequence[int]) -> DataFrame:
    """Versions of the map (by number) as rows, with each slot's first position in its shard."""
    entries = []
    for version, mapping in versions.items():
        filled: dict[int, int] = {}
        for slot, shard in enumerate(mapping):
            entries.append({"version": version, "virtual_slot": slot, "shard": shard, "first": filled.get(shard, 0)})
            filled[shard] = filled.get(shard, 0) + slot_rows[slot]
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(entries)), MAP_SCHEMA)))


def last_version(stored: DataFrame) -> tuple[int, list[int]]:
    """``(number, mapping)`` of the last version of a stored map (its slots are a fixed number of rows)."""
    newest = stored.agg(F.max("version")).first()[0]
    rows = stored.filter(F.col("version") == newest).select("virtual_slot", "shard").collect()
    mapping = [-1] * len(rows)
    for r in rows:
        mapping[r["virtual_slot"]] = r["shard"]
    return newest, mapping


def shard(docs: DataFrame, n_shards: int, n_slots: int = N_SLOTS, stored: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(rows, map)``: every record with its shard and gapless place there, and all stored versions of the map.

    ``stored`` is the map of an earlier call: its last version is edited, and
    it is returned with the edited one behind.  Without it version 0 deals the slots out evenly.
    """
    spark = docs.sparkSession
    rows = written(records(docs, n_slots), "shard_records")
    sizes, counts = [0] * n_slots, [0] * n_slots
    for r in slot_sizes(rows).collect():  # at most n_slots rows
        sizes[r["virtual_slot"]], counts[r["virtual_slot"]] = r["bytes"], r["rows"]
    version, mapping = (0, even_map(n_slots, n_shards)) if stored is None else last_version(stored)
    if len(mapping) != n_slots:
        raise ValueError(f"the stored map has {len(mapping)} slots, not {n_slots}; the number of slots is fixed")
    versions = {version + 1: rebalanced(mapping, sizes, n_shards)}
    if stored is None:
        versions = {0: mapping} | versions
    edited = map_table(spark, versions, counts)
    stored = written(edited if stored is None else stored.select(*edited.columns).unionByName(edited), "slot_map")
    current = stored.filter(F.col("version") == version + 1).select("virtual_slot", "shard", "first", "version")
    in_slot = Window.partitionBy("virtual_slot").orderBy("doc_id", "size", "text_crc32", "copy")
    placed = (
        rows.withColumn("place", F.row_number().over(in_slot) - 1)
        .join(F.broadcast(current), "virtual_slot")  # n_slots rows, fixed
        .select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
                (F.col("first") + F.col("place")).cast("long").alias("slot"), "virtual_slot",
                F.col("version").alias("map_version"))
    )
    return placed, stored


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    placed, _ = shard(docs, 40)
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")
