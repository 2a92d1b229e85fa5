"""SimHash near-duplicates by a general pigeonhole search.

The fingerprint's 64 bits are dealt to partitions, correlated bits together. Two fingerprints
that differ in at most ``radius`` bits differ in at most ``t_i`` bits of some partition ``i``
if the thresholds satisfy ``sum (t_i + 1) = radius + 1`` (-1: the partition is not searched).
The number of partitions and their thresholds are chosen by dynamic programming on the
estimated number of candidate pairs and probes; the choice steers the plan only, every choice
finds the same links. Fingerprints probe the values within ``t_i`` bits of their own, and
candidates are verified inside the join, so that only links leave it.

Equal fingerprints are one node. Components are made of links between nodes; of a task's links
only those leave it that join two parts which its earlier links had not joined yet, so a dense
group of ``n`` fingerprints sends at most ``n - 1`` links per task and not ``n * n / 2``.

Defined results: null and empty texts have no words and fingerprint zero, which is linked like
any other; null ids are smaller than others and make a null component id; repeated rows are
linked as equal texts; extra columns are not read by ``near_duplicates`` and kept by
``one_of_each``; an empty table gives an empty result. Whole texts are read, in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import pack, ship_with_job, staged, unpack
from tablewright.llm.components import components
from tablewright.plans.lookup import lookup_join

BITS, SEED = 64, 42
SHINGLE, RADIUS = 4, 4
#: Fingerprints from which the costs are estimated.
SAMPLE = 4000
#: Relative costs of a probe (a row that is shuffled and sorted) and of a verified pair.
PROBE_COST, PAIR_COST = 1.0, 0.02
#: Fingerprints whose parts a task holds in memory; beyond, it forgets them and links them anew.
HELD_NODES = 1_000_000
#: Pieces into which the documents of one component are dealt where its smallest key joins back.
ROOT_SALTS = 16
_PIECE = 1 << 15


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint over the text's shingles, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    ends = list(accumulate(len(w) + 1 for w in words))
    flat = b" ".join(words)
    count = max(1, len(words) - width + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    starts = [0] + ends[:-1]
    last = min(width, len(words)) - 1
    for at in range(0, count, _PIECE):
        to = min(count, at + _PIECE)
        hashes = np.fromiter((digest(flat[s:e - 1], SEED) for s, e in
                              zip(starts[at:to], ends[at + last:to + last])), dtype="<u8", count=to - at)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, width: int = SHINGLE) -> Column:
    """The fingerprint as a signed 64-bit number."""
    ship_with_job()

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, width) for t in texts], dtype=np.uint64).view(np.int64))

    return of(text)


# ---- partitions and thresholds ----

def bit_groups(bits: np.ndarray, parts: int) -> list[list[int]]:
    """Deal the columns of a 0/1 matrix to ``parts`` groups of about equal width; a group starts
    with a free bit and takes the free bits that correlate most with it."""
    centred = bits - bits.mean(axis=0)
    scale = np.sqrt((centred ** 2).sum(axis=0))
    scale[scale == 0] = 1.0
    strength = np.abs((centred / scale).T @ (centred / scale))
    free = list(range(bits.shape[1]))
    groups = []
    for part in range(parts):
        width = -(-len(free) // (parts - part))
        group = [free.pop(0)]
        while len(group) < width:
            best = max(free, key=lambda b: (strength[b, group].sum(), -b))
            free.remove(best)
            group.append(best)
        groups.append(sorted(group))
    return groups


def near_share(bits: np.ndarray, group: list[int], most: int) -> list[float]:
    """Estimated share of pairs that differ in at most 0, 1, ... ``most`` bits of the group: the
    larger of the sample's own share and that of independent bits."""
    differ = 2 * bits[:, group].mean(axis=0) * (1 - bits[:, group].mean(axis=0))
    spread = np.zeros(most + 1)
    spread[0] = 1.0
    for d in differ:
        spread[1:] = spread[1:] * (1 - d) + spread[:-1] * d
        spread[0] *= 1 - d
    own = bits[:, group].astype(np.float32)
    seen = np.zeros(most + 1)
    for at in range(0, len(own), 500):
        block = own[at:at + 500]
        away = block.sum(axis=1)[:, None] + own.sum(axis=1)[None, :] - 2 * block @ own.T
        for r in range(most + 1):
            seen[r] += (away < r + 0.5).sum()
    pairs = max(len(own) * (len(own) - 1), 1)
    return [max((seen[r] - len(own)) / pairs, float(spread[: r + 1].sum())) for r in range(most + 1)]


def thresholds(costs: list[list[float]], radius: int) -> tuple[float, list[int]]:
    """The cheapest thresholds with ``sum (t_i + 1) = radius + 1``; ``costs[i][t]``."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        following: dict[int, tuple[float, list[int]]] = {}
        for used, (total, chosen) in best.items():
            for t in range(-1, radius - used + 1):
                entry = (total + (cost[t] if t >= 0 else 0.0), [*chosen, t])
                if used + t + 1 not in following or entry < following[used + t + 1]:
                    following[used + t + 1] = entry
        best = following
    return best[radius + 1]


def search_plan(sample: np.ndarray, count: int, radius: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the partitions to search, for ``count`` fingerprints."""
    bits = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)
    if not len(bits):
        return []
    plans = []
    for parts in range(1, radius + 2):
        groups = bit_groups(bits, parts)
        costs = []
        for group in groups:
            share = near_share(bits, group, radius)
            probes = list(accumulate(comb(len(group), r) for r in range(radius + 1)))
            costs.append([PROBE_COST * count * (1 + probes[t]) + PAIR_COST * share[t] * count * count / 2
                          for t in range(radius + 1)])
        total, chosen = thresholds(costs, radius)
        plans.append((total, parts, [(g, t) for g, t in zip(groups, chosen) if t >= 0]))
    return min(plans, key=lambda p: p[:2])[2]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): all pairs of different fingerprints ``_fp`` within ``radius`` bits, a < b. A
    pair can come more than once."""
    count = nodes.count()
    share = min(1.0, SAMPLE / max(count, 1))
    drawn = nodes.filter(F.pmod(F.xxhash64("_fp"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1))
    sample = np.array([r["_fp"] for r in drawn.select("_fp").limit(2 * SAMPLE).collect()], dtype=np.int64)
    index, probes = [], []
    for part, (bits, threshold) in enumerate(search_plan(sample.view(np.uint64), count, radius)):
        mask = sum(1 << b for b in bits)
        value = F.col("_fp").bitwiseAND(F.lit(_signed(mask)))
        flips = [sum(1 << b for b in chosen) for r in range(threshold + 1) for chosen in combinations(bits, r)]
        index.append(nodes.select(F.lit(part).alias("p"), value.alias("v"), F.col("_fp").alias("a")))
        # the numbers are cast and not the generator, which Spark takes only by itself
        flipped = [F.lit(_signed(f)).cast("long") for f in flips]
        probed = F.explode(F.array(*flipped)) if len(flips) > 1 else flipped[0]
        probes.append(nodes.select(F.col("_fp").alias("b"), probed.alias("_flip"), value.alias("_v"))
                      .select(F.lit(part).alias("p"), F.col("_v").bitwiseXOR(F.col("_flip")).alias("v"), "b"))
    if not index:
        return nodes.select(F.col("_fp").alias("a"), F.col("_fp").alias("b")).limit(0)
    left, right = index[0], probes[0]
    for i, p in zip(index[1:], probes[1:]):
        left, right = left.unionByName(i), right.unionByName(p)
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    # merge join: a hot value is split by the adaptive plan, and nothing is held in memory
    return left.hint("merge").join(right, (left["p"] == right["p"]) & (left["v"] == right["v"])
                                   & (F.col("a") < F.col("b")) & near).select("a", "b")


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The links that join two parts; the others repeat what the links before them say."""
    parent: dict[int, int] = {}

    def top(node: int) -> int:
        above = parent.setdefault(node, node)
        while above != node:
            parent[node] = parent[above]
            node, above = above, parent[above]
        return node

    for batch in batches:
        kept = []
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist()):
            one, other = top(a), top(b)
            if one != other:
                parent[max(one, other)] = min(one, other)
                kept.append((a, b))
        if len(parent) > HELD_NODES:
            parent.clear()
        yield pd.DataFrame(kept, columns=["a", "b"], dtype="int64")


def spanning(pairs: DataFrame) -> DataFrame:
    """Links (a, b) out of ``pairs`` that have the same components, at most one less per task than the
    task has nodes (up to ``HELD_NODES`` of them)."""
    ship_with_job()
    return pairs.mapInPandas(_forest, "a long, b long")


def classes(marked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(_fp, _first, _n): of every fingerprint of ``marked`` (a written table with ``_fp`` and ``_key``)
    the smallest ``_key`` of its component and its number of rows."""
    nodes = staged(marked.groupBy("_fp").agg(F.min("_key").alias("_least"), F.count("*").alias("_n")), "fingerprints")
    roots = staged(components(spanning(links(nodes, radius))), "roots")
    rooted = roots.withColumnRenamed("node", "_fp").join(nodes, "_fp")
    first = rooted.groupBy("root").agg(F.min("_least").alias("_first"))
    # most fingerprints of a corpus can hang on one root: its rows are dealt to several keys
    salted = first.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(ROOT_SALTS - 1))))
    linked = (roots.withColumn("_salt", F.pmod(F.xxhash64("node"), F.lit(ROOT_SALTS)).cast("int"))
              .join(salted, ["root", "_salt"]).select(F.col("node").alias("_fp"), "_first"))
    return nodes.join(linked, "_fp", "left").select("_fp", F.coalesce("_first", "_least").alias("_first"), "_n")


def near_duplicates(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document: fingerprint and the smallest id of its component."""
    marked = staged(docs.select("doc_id", fingerprint_column(F.col("text"), width).alias("_fp"))
                    .withColumn("_key", F.struct("doc_id")), "simhash")
    found = staged(classes(marked, radius).select("_fp", F.col("_first.doc_id").alias("component_id"), "_n"), "classes")
    # a third of all documents can share one fingerprint: such keys are split off by their counts
    return lookup_join(marked.drop("_key"), found, ["_fp"], "inner", count_col="_n").select(
        "doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The document with the smallest id of every component, columns as in ``docs``."""
    packed, row = pack(docs, "doc_id", "text")
    marked = staged(packed.select(row, fingerprint_column(F.col("text"), width).alias("_fp"),
                                  F.struct("doc_id", F.monotonically_increasing_id().alias("r")).alias("_key")),
                    "simhash")
    keys = staged(classes(marked.select("_fp", "_key"), radius).select(F.col("_first.r").alias("_row")).distinct(),
                  "kept")
    return unpack(marked.withColumn("_row", F.col("_key.r")).join(keys.hint("merge"), "_row", "left_semi"), docs, row)
