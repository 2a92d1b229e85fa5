"""Importance resampling towards the distribution of a target table.

Words and pairs of neighbouring words are hashed to ``BUCKETS`` buckets. A bucket's gain is the
log ratio of its smoothed shares in the target and in the corpus, in thousandths; a document's
weight is the mean gain over its features, read from an array by their buckets. With a
Gumbel number drawn from the document's id added to the weight, the documents of the highest
scores are a sample without replacement whose odds follow the weights.

The score of the last winner is found by a weighted median of medians. Blocks of the keys that
are left give their median and their size; the weighted median of these divides the keys, and a
quarter of them at least can't hold the cutoff and is discarded. Keys are a total order, so the cutoff is
exact, ties included, and nothing is sorted but the winners. What is left is written anew
whenever it fell to an eighth, so the rounds together read little more than the first.

Defined results: a null or empty text has no features, weight 0 and too few words to be drawn; a null id
draws as ``null`` and comes after all others in ties; rows that tie in score and id are ordered by a hash of
their text, equal rows anyhow, each with a rank of its own; an empty target leaves the corpus's own smoothed
distribution; an empty table gives an empty result; extra columns are kept by ``resample`` and not read.
Whole texts are counted, in pieces.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tablewright.base import unused_name
from tablewright.llm.common import pack, ship_with_job, staged, unpack

BUCKETS = 10_000
PERCENT, LEAST_WORDS, SEED = 25, 20, 7
#: Keys per block that gives a median, and keys that are few enough to be sorted at once.
BLOCK, FEW = 1 << 18, 4096
_PIECE = 1 << 20
#: Digits, letters in lower case and all bytes beyond ASCII stay, everything else is a blank.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
               for c in range(256))
_KEY = ["_k0", "_k1", "_k2", "_k3"]


def features(text: str | None) -> Iterator[tuple[np.ndarray, int]]:
    """(buckets of the features, number of words) of each piece of the text; a pair of words
    belongs to the piece that holds its second one."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_WORDS)
    at, before = 0, None
    while at < len(data):
        to = data.find(b" ", at + _PIECE)
        to = len(data) if to < 0 else to
        words = data[at:to].split()
        at = to
        if not words:
            continue
        single = [crc32(w) for w in words]
        left = single[:-1] if before is None else [before, *single[:-1]]
        pairs = [crc32(b" " + w, c) for w, c in zip(words[len(words) - len(left):], left)]
        before = single[-1]
        yield np.array(single + pairs, dtype=np.int64) % BUCKETS, len(words)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for text in batch.column(0):
            for buckets, _ in features(text.as_py()):
                total += np.bincount(buckets, minlength=BUCKETS)
    there = np.nonzero(total)[0]
    if len(there):
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(total[there])], ["bucket", "n"])


def bucket_counts(docs: DataFrame) -> np.ndarray:
    """Features per bucket over all rows."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for r in (docs.select("text").filter("text IS NOT NULL").mapInArrow(_counted, "bucket int, n long")
              .groupBy("bucket").agg(F.sum("n").alias("n")).collect()):  # one row per bucket
        counts[r["bucket"]] = r["n"]
    return counts


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    all_corpus, all_target = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_corpus / ((s + 1.0) * all_target)))
                     for s, t in zip(corpus.tolist(), target.tolist())], dtype=np.int64)


def gumbel(doc_id: int | None, seed: int) -> int:
    name = f"{seed}:{'null' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _scorer(gains: np.ndarray, seed: int):
    """Adds (words, features, weight, score) to batches whose first columns are id and text; the
    text goes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = count = total = 0
                for buckets, n in features(text.as_py()):
                    words, count, total = words + n, count + len(buckets), total + int(gains[buckets].sum())
                weight = total // count if count else 0
                found.append((words, count, weight, weight + gumbel(doc_id, seed)))
            made = np.array(found, dtype=np.int64).reshape(-1, 4)
            keep = [i for i in range(batch.num_columns) if i != 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in keep), *(pa.array(made[:, j]) for j in range(4))],
                [*(batch.schema.names[i] for i in keep), "_words", "_features", "_weight", "_score"])
    return run


def scored(docs: DataFrame, target: DataFrame, seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """A written table: ``_id``, the columns ``keep`` of ``docs``, words, features, weight, score
    and the key, ascending from the best score to the worst."""
    ship_with_job()
    gains = bucket_gains(bucket_counts(docs), bucket_counts(target))
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").alias("_text"),
                       F.xxhash64("text").alias("_hash"), *(keep or []))
    kept = rows.drop("_text")
    added = [StructField(name, LongType()) for name in ("_words", "_features", "_weight", "_score")]
    made = rows.mapInArrow(_scorer(gains, seed), StructType([*kept.schema.fields, *added]))
    return staged(made.withColumns({
        "_k0": -2 * F.col("_score") + F.col("_id").isNull().cast("long"), "_k1": F.coalesce("_id", F.lit(0)),
        "_k2": F.col("_hash"), "_k3": F.monotonically_increasing_id()}).drop("_hash"), "scored")


# ---- the cutoff ----

def compare(keys: np.ndarray, than: tuple[int, ...]) -> np.ndarray:
    """-1, 0 or 1 per row of ``keys``."""
    sign = np.zeros(len(keys), dtype=np.int8)
    for j, value in enumerate(than):
        column = keys[:, j]
        sign = np.where(sign == 0, (column > value).astype(np.int8) - (column < value).astype(np.int8), sign)
    return sign


def median(keys: np.ndarray) -> list[int]:
    order = np.lexsort(tuple(keys[:, j] for j in range(keys.shape[1] - 1, -1, -1)))
    return keys[order[(len(keys) - 1) // 2]].tolist()


def weighted_median(medians: list[tuple[tuple[int, ...], int]]) -> tuple[int, ...]:
    half, seen = sum(n for _, n in medians) / 2, 0
    for key, n in sorted(medians):
        seen += n
        if seen >= half:
            return key
    raise ValueError("no medians")


def _sides(pivot: tuple[int, ...] | None):
    """Size and median of the keys below (-1) and above (1) the pivot, by blocks; without a pivot
    all are above it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {-1: [], 1: []}
        rows: list[list[int]] = []

        def close(side: int) -> None:
            if held[side]:
                keys = np.concatenate(held[side])
                held[side] = []
                if len(keys):
                    rows.append([side, len(keys), *median(keys)])

        for batch in batches:
            keys = np.column_stack([batch.column(j).to_numpy() for j in range(len(_KEY))])
            sign = np.ones(len(keys), np.int8) if pivot is None else compare(keys, pivot)
            for side in held:
                held[side].append(keys[sign == side])
                if sum(map(len, held[side])) >= BLOCK:
                    close(side)
        for side in held:
            close(side)
        if rows:
            made = np.array(rows, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(made[:, j]) for j in range(made.shape[1])],
                                             ["side", "n", *_KEY])
    return run


def key_at_most(key: tuple[int, ...] | list[int]) -> Column:
    return F.struct(*_KEY) <= F.struct(*[F.lit(int(v)).cast("long").alias(c) for c, v in zip(_KEY, key)])


def cutoff(keys: DataFrame, wanted: int) -> tuple[int, ...]:
    """The ``wanted``-th smallest key (from 1) of a written table, which has as many rows."""
    schema = ", ".join(f"{c} long" for c in ["side", "n", *_KEY])
    left, pivot, size = keys.select(*_KEY), None, None
    low = high = None  # the answer lies above low and below high
    while True:
        part = left
        if low is not None:
            part = part.filter(~key_at_most(low))
        if high is not None:
            part = part.filter(F.struct(*_KEY) < F.struct(*[F.lit(v).cast("long").alias(c) for c, v in zip(_KEY, high)]))
        sides: dict[int, list] = {-1: [], 1: []}
        for r in part.mapInArrow(_sides(pivot), schema).collect():  # two rows per block
            sides[r["side"]].append((tuple(r[c] for c in _KEY), r["n"]))
        if pivot is None:
            chosen, remaining = 1, sum(n for _, n in sides[1])
            size = remaining
        else:
            below = sum(n for _, n in sides[-1])
            if wanted == below + 1:
                return pivot
            chosen = -1 if wanted <= below else 1
            if chosen < 0:
                high = pivot
            else:
                low, wanted = pivot, wanted - below - 1
            remaining = sum(n for _, n in sides[chosen])
            side = key_at_most(pivot)
            part = part.filter(side if chosen < 0 else ~side)
            if chosen < 0:
                part = part.filter(F.col("_k3") != pivot[3])
        if remaining <= FEW:
            return sorted(tuple(r) for r in part.collect())[wanted - 1]
        if remaining * 8 < size:
            left, size, low, high = staged(part, "keys-left"), remaining, None, None
        pivot = weighted_median(sides[chosen])


# ---- the sample ----

def drawn(table: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """A ``scored`` table with ``_rank`` (null: not drawn). The winners are sorted by ranges of the
    key, and a winner's rank is its place in its range after the sizes of the ranges before."""
    able = F.col("_words") >= least_words
    wanted = table.filter(able).count() * percent // 100
    none = F.lit(None).cast("long")
    if not wanted:
        return table.withColumn("_rank", none)
    won = able & key_at_most(cutoff(table.filter(able), wanted))
    # the number holds the range in its upper bits and the place inside of it in the 33 lower ones
    ranged = staged(table.filter(won).repartitionByRange(*_KEY).sortWithinPartitions(*_KEY)
                    .withColumn("_at", F.monotonically_increasing_id()), "winners")
    part = F.shiftright("_at", 33)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    ranked = (ranged.withColumn("_part", part).join(F.broadcast(starts), "_part")
              .withColumn("_rank", F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1))
    return ranked.select(*table.columns, "_rank").unionByName(
        table.filter(~won).withColumn("_rank", none))


def resample_report(docs: DataFrame, target: DataFrame) -> DataFrame:
    """One row per document: features, weight, score and rank."""
    return drawn(scored(docs, target)).select(
        F.col("_id").alias("doc_id"), F.col("_features").alias("n_features"), F.col("_weight").alias("weight"),
        F.col("_score").alias("score"), F.col("_rank").alias("rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             seed: int = SEED) -> DataFrame:
    """The drawn documents with the columns of ``docs`` and ``rank`` (or the first free name like it)."""
    packed, row = pack(docs, "doc_id", "text")
    table = drawn(scored(packed, target, seed, keep=[row]), percent, least_words)
    return unpack(table.filter("_rank IS NOT NULL"), docs, row, **{unused_name("rank", docs.columns): F.col("_rank")})
