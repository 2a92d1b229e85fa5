"""Sharding by a consistent-hash ring with virtual nodes and bounded loads
(DataFrame and SQL functions only).

A document's place on the ring is the hash of its text, so that equal texts lie together. The
ring's arcs belong to virtual nodes, several per shard. Every shard has a capacity; the rows
of an arc fill the shard that owns it, what overflows continues clockwise to the next shards
that have room. With a capacity of ``ceil((1 + slack) * rows / shards)`` no shard is ever
above it; with ``slack=0`` the capacities add up to the number of rows and the shards' counts
differ by one at most.

Only counts per arc (a number fixed by ``nodes``) reach the driver, which deals them out in
two walks around the ring. Rows are ranked inside cells of an arc: ``FINE`` parts of the arc
and ``SALTS`` parts by document, so that a text that holds a third of all rows is ranked in
many tasks; the cells' offsets are sums over a table of bounded size.

Defined results: a null text has size 16 and a null checksum, and lies where its hash (the
seed) does; null ids sort first; repeated rows are rows of their own; extra columns are not
read by ``assign`` and kept by ``shard_documents``; an empty table gives an empty result.
"""

from __future__ import annotations

from hashlib import blake2b

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import pack, staged, unpack

SHARDS = 40
NODES = 32          # virtual nodes per shard
FINE, SALTS = 4, 64
OVERHEAD = 16       # bytes that a row counts beside its text


def ring(shards: int, nodes: int = NODES) -> list[tuple[int, int]]:
    """(position, shard) in ring order. A shard's positions depend on its number alone, so a
    further shard only adds positions."""
    places = {}
    for shard in range(shards):
        for node in range(nodes):
            digest = blake2b(f"shard {shard} node {node}".encode(), digest_size=8).digest()
            places.setdefault(int.from_bytes(digest, "big", signed=True), shard)
    return sorted(places.items())


def place(text: Column) -> Column:
    return F.xxhash64(text)


def deal(counts: list[int], owners: list[int], capacity: list[int]) -> list[list[tuple[int, int]]]:
    """Per arc the list of (shard, rows) in the order in which its rows are dealt out.

    First every arc fills its own shard, in ring order; then the overflow walks clockwise,
    the rows that have walked longest first. Two walks reach every shard from every arc.
    """
    room = list(capacity)
    dealt: list[list[tuple[int, int]]] = [[] for _ in counts]
    left = []
    for arc, (count, owner) in enumerate(zip(counts, owners)):
        take = min(count, room[owner])
        room[owner] -= take
        if take:
            dealt[arc].append((owner, take))
        left.append(count - take)
    walking: list[list[int]] = []
    for step in range(2 * len(counts)):
        arc = step % len(counts)
        owner = owners[arc]
        while walking and room[owner]:
            take = min(walking[0][1], room[owner])
            room[owner] -= take
            dealt[walking[0][0]].append((owner, take))
            walking[0][1] -= take
            if not walking[0][1]:
                walking.pop(0)
        if step < len(counts) and left[arc]:
            walking.append([arc, left[arc]])
        if not walking and step >= len(counts):
            break
    if walking:
        raise ValueError("the shards' capacities are below the number of rows")
    return dealt


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    if slack > 0:
        return [-int(-(1 + slack) * rows // shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def assign(rows: DataFrame, shards: int = SHARDS, nodes: int = NODES,
           slack: float = 0.0) -> DataFrame:
    """``rows`` (with ``_place`` and ``_id``) with ``_shard`` and ``_slot``."""
    spark = rows.sparkSession
    points = ring(shards, nodes)
    # the arc of a place: the first point at or after it; past the last one, the first
    width = F.lit(len(points))
    found = _first_at_or_after(F.col("_place"), [p for p, _ in points])
    at = rows.withColumn("_arc", F.when(found == width, 0).otherwise(found).cast("int"))
    at = staged(at.withColumn(
        "_fine", F.pmod(F.xxhash64("_place"), F.lit(FINE)).cast("int")).withColumn(
        "_salt", F.pmod(F.xxhash64("_id", F.lit("salt")), F.lit(SALTS)).cast("int")), "ring")
    cells = staged(at.groupBy("_arc", "_fine", "_salt").agg(F.count("*").alias("_n")), "cells")
    counts = [0] * len(points)
    for r in cells.groupBy("_arc").agg(F.sum("_n").alias("n")).collect():  # one row per arc
        counts[r["_arc"]] = r["n"]
    owners = [s for _, s in points]
    dealt = deal(counts, owners, capacities(sum(counts), shards, slack))
    slots = [0] * shards
    pieces = []
    for arc, parts in enumerate(dealt):
        start, own = 0, []
        for shard, n in parts:
            own.append((start, shard, slots[shard] - start))
            slots[shard] += n
            start += n
        if own:
            pieces.append((arc, own))
    plan = spark.createDataFrame(
        pieces, "_arc int, _pieces array<struct<start: bigint, shard: int, shift: bigint>>")
    offset = F.sum("_n").over(Window.partitionBy("_arc").orderBy("_fine", "_salt")) - F.col("_n")
    starts = cells.select("_arc", "_fine", "_salt", offset.alias("_offset"))
    rank = F.row_number().over(Window.partitionBy("_arc", "_fine", "_salt")
                               .orderBy("_place", "_id")) - 1
    piece = F.element_at(F.filter("_pieces", lambda p: p["start"] <= F.col("_rank")), -1)
    return (at.withColumn("_in_cell", rank)
            .join(starts, ["_arc", "_fine", "_salt"])
            .withColumn("_rank", F.col("_offset") + F.col("_in_cell"))
            .join(F.broadcast(plan), "_arc")  # at most one row per virtual node
            .withColumn("_piece", piece)
            .withColumn("_shard", F.col("_piece.shard"))
            .withColumn("_slot", F.col("_rank") + F.col("_piece.shift"))
            .drop("_in_cell", "_offset", "_rank", "_pieces", "_piece", "_fine", "_salt"))


def _first_at_or_after(value: Column, points: list[int]) -> Column:
    """Number of points below ``value``: two steps of at most a square root of them each."""
    step = max(1, int(len(points) ** 0.5))
    heads = F.array(*[F.lit(p) for p in points[::step]])
    all_points = F.array(*[F.lit(p) for p in points])
    block = F.greatest(F.size(F.filter(heads, lambda h: h < value)) - 1, F.lit(0)) * step
    inside = F.size(F.filter(F.slice(all_points, block + 1, step), lambda p: p < value))
    return block + inside


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD


def shard_report(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document with its shard and slot; the texts themselves are not moved."""
    rows = docs.select(F.col("doc_id").alias("_id"), place(F.col("text")).alias("_place"),
                       size_of(F.col("text")).alias("size"),
                       F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"))
    return assign(rows, shards).select(
        F.col("_id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"),
        F.col("_shard").alias("shard"), F.col("_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``docs`` with ``shard`` and ``slot`` (names of ``docs`` win: then ``shard_`` and so on)."""
    names = {}
    for name in ("shard", "slot"):
        new = name
        while new in docs.columns:
            new += "_"
        names[name] = new
    packed, row = pack(docs, "doc_id", "text")
    out = assign(packed.select(row, F.col("doc_id").alias("_id"), place(F.col("text")).alias("_place")), shards)
    return unpack(out, docs, row, **{names["shard"]: F.col("_shard"), names["slot"]: F.col("_slot")})
