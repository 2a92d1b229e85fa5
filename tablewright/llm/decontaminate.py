"""Benchmark decontamination by latent semantic retrieval.

Passages are vectors of hashed words, weighted by tf-idf. A randomised singular value
decomposition, whose products are summed per partition, gives a latent space; it is fitted to
the passages of the benchmark and of all documents. Document frequencies are counted over all
documents.

In every document, windows of about an item's length that begin every ``STEP`` words - for
items of fewer than ``SHORT`` words, windows of its length at every word - are compared with the item by the cosine in the latent space. Candidates are verified on words:
the longest common subsequence of item and window has to cover ``SURE`` of the item, or
``LIKELY`` of it if the item's answer (its last sentence) is there as well. The benchmark is a
stated query set: it is compared in blocks of ``BLOCK`` items, and no document is shuffled.

Defined results: null and empty texts match nothing; items of fewer than ``LEAST_WORDS`` words
are no evidence and match nothing; items longer than ``PART`` words are compared in parts, and
a part is enough; items with the same text match alike; repeated rows match alike; rows without
an id are matched and carry a null id; extra columns are not read by ``leaks`` and kept by
``clean``; an empty benchmark or table gives no matches. Whole texts are searched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import noted, pack, remove, ship_with_job, staged, unpack
from tablewright.llm.words import word_hashes

SLOTS = 1 << 15
SLOT_BLOCK = 1 << 10
RANK, EXTRA = 48, 16
STEP = 8
PART = 64
#: Passages whose products are summed at a time, rows of such sums that are added at once, and those of a buffer.
ADDED_PASSAGES, ADDED, BUFFER = 1 << 14, 16, 1 << 11
#: Shorter items are looked for at every word, in pieces of ``PIECE`` words of the document.
SHORT, PIECE = 16, 1 << 13
LEAST_WORDS = 5
#: Parts that are looked for in a document at a time.
TOGETHER = 32
BLOCK = 2000
COSINE = 0.55
SURE, LIKELY, ANSWERED = 0.75, 0.55, 0.8
_SENTENCE = re.compile(r"[.!?]\s+|\n+")


def slots_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64) % SLOTS


# ---- the latent space ----

def _in_passages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts to the slots of their words, sorted within each passage of ``PART`` words, two bytes a word."""
    for batch in batches:
        out = []
        for text in batch.pop("text"):
            slots = slots_of(word_hashes(text)).astype(np.uint16)
            whole = len(slots) // PART * PART
            slots[:whole].reshape(-1, PART).sort(axis=1)
            slots[whole:].sort()
            out.append(slots.tobytes())
        yield batch.assign(slots=out)


def slot_rows(texts: DataFrame) -> DataFrame:
    """Rows (text, ...) as (..., slots): null texts go. Rows that have ``slots`` already are left alone."""
    if "slots" in texts.columns:
        return texts
    kept = [f for f in texts.schema.fields if f.name != "text"]
    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in kept) + "slots binary"
    return texts.select("text", *[f.name for f in kept]).filter("text IS NOT NULL").mapInPandas(_in_passages, schema)


def few_tasks(rows: DataFrame) -> DataFrame:
    """The rows in a task per core of the session at most: what each task sums has a size of its own,
    so the sums don't grow with the number of input partitions."""
    return rows.coalesce(rows.sparkSession.sparkContext.defaultParallelism)


def _slots(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(slots of all rows one after the other, how many each row has) of a binary column."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint16), np.zeros(len(column), dtype=np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data.view(np.uint16), np.diff(offsets) // 2


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, rows = np.zeros(SLOTS, dtype=np.int64), 0
    for batch in batches:
        slots, sizes = _slots(batch.column(0))
        cells = np.repeat(np.arange(len(sizes)) * SLOTS, sizes) + slots
        cells.sort()
        seen += np.bincount(cells[np.diff(cells, prepend=-1) != 0] % SLOTS, minlength=SLOTS)
        rows += len(sizes)
    if rows:
        there = np.nonzero(seen)[0]
        yield pa.RecordBatch.from_arrays([pa.array(np.append(there, -1), pa.int32()), pa.array(np.append(seen[there], rows))],
                                         ["slot", "n"])


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """Weights of the slots, from rows with a text or with its slots."""
    counts = np.zeros(SLOTS)
    total = 0
    for r in (few_tasks(slot_rows(docs).select("slots")).mapInArrow(_document_counts, "slot int, n long")
              .groupBy("slot").agg(F.sum("n").alias("n")).collect()):  # one row per slot
        if r["slot"] < 0:
            total = r["n"]
        else:
            counts[r["slot"]] = r["n"]
    return np.log((1 + total) / (1 + counts)) + 0.1


def _passages(hashes: np.ndarray) -> list[np.ndarray]:
    return [hashes[at:at + PART] for at in range(0, max(len(hashes), 1), PART) if len(hashes[at:at + PART])]


def _added_rows(rows: np.ndarray, at: np.ndarray, out: np.ndarray) -> None:
    """Sums of ``rows[at]``, one for each row of the table ``at``. A buffer takes the rows: fresh memory
    for them costs more than the sums."""
    step = min(max(1, BUFFER // at.shape[1]), max(1, len(at)))
    held = np.empty((step * at.shape[1], rows.shape[1]), dtype=rows.dtype)
    ones = np.ones((1, at.shape[1]), dtype=rows.dtype)
    for start in range(0, len(at), step):
        own = at[start:start + step]
        taken = np.take(rows, own.ravel(), axis=0, out=held[:own.size], mode="clip")
        np.matmul(ones, taken.reshape(*own.shape, -1), out=out[start:start + step, None])


def _sums(rows: np.ndarray, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of ``rows[at]`` over neighbouring stretches of ``counts`` places, ``ADDED`` rows at a time
    until each stretch is one row. The last row is zero and fills short stretches."""
    while True:
        parts = -(-counts // ADDED)
        first = (np.cumsum(parts) - parts) * ADDED - (np.cumsum(counts) - counts)
        padded = np.full(parts.sum() * ADDED, len(rows) - 1, dtype=np.int64)
        padded[np.arange(len(at)) + np.repeat(first, counts)] = at
        out = np.zeros((len(padded) // ADDED + 1, rows.shape[1]), dtype=rows.dtype)
        _added_rows(rows, padded.reshape(-1, ADDED), out[:-1])
        if (parts == 1).all():
            return out[:-1]
        rows, at, counts = out, np.arange(len(out) - 1), parts


def _product(idf: np.ndarray, right, inner: bool = False):
    """A function of partitions (weight, slots) that sums ``A^T (A right)`` over the partition's passages,
    in blocks of slots, or with ``inner`` the small ``(A right)^T (A right)`` as one block. A passage's row of
    ``A`` is as long as its weight. ``right`` is a matrix or a broadcast one."""
    def add(total: np.ndarray, weighted: np.ndarray, slots: np.ndarray, sizes: np.ndarray, weights: np.ndarray) -> None:
        passage = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        key = passage * np.int32(SLOTS) + slots
        first = np.ones(len(key), dtype=bool)
        np.not_equal(key[1:], key[:-1], out=first[1:])  # slots are sorted in a passage
        cell = np.flatnonzero(first)
        often = np.diff(cell, append=len(slots))
        norms = np.bincount(passage[cell], weights=(often * idf[slots[cell]]) ** 2, minlength=len(sizes))
        image = np.zeros((len(sizes) + 1, weighted.shape[1]), dtype=np.float32)
        padded = np.full((len(sizes), PART), SLOTS, dtype=np.int64)
        padded[np.arange(PART) < sizes[:, None]] = slots
        _added_rows(weighted, padded, image[:-1])
        scale = (weights ** 2 / np.maximum(norms, 1e-24)).astype(np.float32)[:, None]
        if inner:
            total += image[:-1].T @ (image[:-1] * scale)
            return
        image[:-1] *= scale
        order = np.argsort(slots, kind="stable")
        counts = np.bincount(slots, minlength=SLOTS)
        there = np.nonzero(counts)[0]
        total[there] += _sums(image, passage[order], counts[there])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            weights, (slots, lengths) = batch.column(0).to_numpy(zero_copy_only=False), _slots(batch.column(1))
            if not len(slots):
                continue
            if total is None:
                matrix = getattr(right, "value", right)
                weighted = np.zeros((SLOTS + 1, matrix.shape[1]), dtype=np.float32)
                weighted[:-1] = idf[:, None] * matrix
                total = np.zeros((matrix.shape[1] if inner else SLOTS, matrix.shape[1]))
            parts = -(-lengths // PART)
            row = np.repeat(np.arange(len(lengths)), parts)
            sizes = np.minimum(lengths[row] - (np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)) * PART, PART)
            to = np.cumsum(sizes)
            for at in range(0, len(sizes), ADDED_PASSAGES):
                own = slice(at, at + ADDED_PASSAGES)
                add(total, weighted, slots[to[at] - sizes[at]:to[own][-1]], sizes[own], weights[row[own]])
        if total is not None:
            total = (total if inner else total * idf[:, None]).astype(np.float32)
            for at in range(0, len(total), SLOT_BLOCK):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at // SLOT_BLOCK], pa.int32()), pa.array([total[at:at + SLOT_BLOCK].tobytes()], pa.binary())],
                    ["block", "v"])
    return run


def _added(group: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(v, np.float32).astype(np.float64) for v in group["v"])
    return pd.DataFrame({"block": group["block"].iloc[:1], "v": [total.astype(np.float32).tobytes()]})


def _summed(rows: DataFrame, idf: np.ndarray, right: np.ndarray, inner: bool = False) -> np.ndarray:
    """``A^T (A right)``, or with ``inner`` ``(A right)^T (A right)``, for rows with a weight, and a text or its
    slots."""
    held = rows.sparkSession.sparkContext.broadcast(right)
    # a task gives a few rows of a fixed size, so a group has one row per core of the session
    blocks = (few_tasks(slot_rows(rows).select("weight", "slots"))
              .mapInArrow(_product(idf, held, inner), "block int, v binary")
              .groupBy("block").applyInPandas(_added, "block int, v binary").collect())
    held.destroy()  # all has been collected
    out = np.zeros((right.shape[1] if inner else SLOTS, right.shape[1]), dtype=np.float32)
    for r in blocks:
        own, at = np.frombuffer(r["v"], np.float32).reshape(-1, right.shape[1]), r["block"] * SLOT_BLOCK
        out[at:at + len(own)] = own
    return out


def orthonormal(rows: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the columns. Blocks of rows are reduced one by one, as a decomposition of all
    of them takes several copies in doubles."""
    out, tops = np.empty_like(rows), []
    for at in range(0, len(rows), SLOT_BLOCK):
        basis, top = np.linalg.qr(rows[at:at + SLOT_BLOCK].astype(np.float64))
        out[at:at + SLOT_BLOCK] = basis
        tops.append(top)
    turns = np.split(np.linalg.qr(np.concatenate(tops))[0], len(tops))
    for at, turn in zip(range(0, len(rows), SLOT_BLOCK), turns):
        out[at:at + SLOT_BLOCK] = out[at:at + SLOT_BLOCK] @ turn
    return out


def latent_space(docs: DataFrame, benchmark: DataFrame, idf: np.ndarray) -> np.ndarray:
    """Slots x ``RANK``: the leading right singular vectors, times the words' weights. ``docs`` has texts or
    their slots; it is read three times."""
    docs = slot_rows(docs)
    count, items = docs.count(), max(benchmark.count(), 1)
    weight = float(np.sqrt(max(1.0, count / items)))  # the items weigh as much as the documents
    rows = (docs.select("slots", F.lit(1.0).alias("weight"))
            .unionByName(slot_rows(benchmark.select("text", F.lit(weight).alias("weight")))))
    rng, blocks = np.random.default_rng(3), range(0, SLOTS, SLOT_BLOCK)
    basis = np.empty((SLOTS, RANK + EXTRA), dtype=np.float32)
    for at in blocks:
        basis[at:at + SLOT_BLOCK] = rng.normal(size=(SLOT_BLOCK, RANK + EXTRA))
    for _ in range(2):  # the range, and one power step
        basis = orthonormal(_summed(rows, idf, basis))
    values, turn = np.linalg.eigh(_summed(rows, idf, basis, True).astype(np.float64))
    turn = turn[:, np.argsort(values)[::-1][:RANK]]
    space = np.empty((SLOTS, RANK), dtype=np.float32)
    for at in blocks:
        space[at:at + SLOT_BLOCK] = basis[at:at + SLOT_BLOCK] @ turn * idf[at:at + SLOT_BLOCK, None]
    return space


# ---- items, candidates, checks ----

class Items:
    """A block of benchmark items, cut to parts, by length in steps or, if short, in words."""

    def __init__(self, rows: list[tuple[int, str]], space: np.ndarray):
        self.ids, self.words, self.answers, self.steps = [], [], [], []
        vectors = []
        for item_id, text in rows:
            hashes = word_hashes(text)
            if len(hashes) < LEAST_WORDS:
                continue
            sentences = [s for s in _SENTENCE.split(text.strip()) if len(word_hashes(s))]
            answer = word_hashes(sentences[-1]) if len(sentences) > 1 else hashes[-LEAST_WORDS:]
            parts = _passages(hashes)
            if len(parts) > 1 and len(parts[-1]) < PART // 2:
                parts[-1] = hashes[-PART:]
            for part in parts:
                self.ids.append(item_id)
                self.words.append(part.tolist())
                self.answers.append(answer.tolist())
                self.steps.append(max(1, round(len(part) / STEP)))
                vectors.append(space[slots_of(part)].sum(axis=0))
        # slots of all parts' words, one part after the other
        counts = [len(w) for w in self.words]
        self.lengths = np.array(counts, dtype=np.int64)
        self.offsets = np.cumsum([0, *counts[:-1]])
        self.slots = (slots_of(np.concatenate([np.array(w, dtype=np.uint64) for w in self.words]))
                      if self.words else np.zeros(0, dtype=np.int64))
        self.widths = np.array(self.steps, dtype=np.int64)
        self.vectors = self._unit(np.array(vectors, dtype=np.float32).reshape(len(vectors), space.shape[1]))
        #: Whether a slot is in a part, for ``TOGETHER`` parts; false but while they are looked for.
        self.member = np.zeros((SLOTS + 1) * TOGETHER, dtype=bool)
        short = self.lengths < SHORT
        answers = [len(a) for a in self.answers]
        self.answer_lengths, self.answer_offsets = np.array(answers, dtype=np.int64), np.cumsum([0, *answers[:-1]])
        self.answer_slots = (slots_of(np.concatenate([np.array(a, dtype=np.uint64) for a in self.answers]))
                             if self.answers else np.zeros(0, dtype=np.int64))
        #: Steps that a region reaches from its window's first one, and the parts by it, short ones first.
        self.reach = np.where(short, -(-(self.lengths + 2 * STEP) // STEP) + 1, self.widths + 1)
        self.by_reach = np.lexsort((self.reach, ~short))
        self.by_words = {n: self._block(np.nonzero(self.lengths == n)[0])
                         for n in sorted(set(self.lengths[short].tolist()))}

    @staticmethod
    def _unit(block: np.ndarray) -> np.ndarray:
        return block / np.maximum(np.linalg.norm(block, axis=1, keepdims=True), 1e-9)

    def _block(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return own, np.ascontiguousarray(self.vectors[own].T)


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, with the rows of the table as bits."""
    at: dict[int, int] = {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        match = row & at.get(w, 0)
        row = ((row + match) | (row - match)) & full
    return len(a) - row.bit_count()


def _near(total: np.ndarray, groups: dict, enough: np.ndarray, unit: int, offset: int = 0) -> Iterator[tuple]:
    """Windows of running sums ``total``, one per ``unit`` words, that are near one of the parts
    ``enough``; the first one begins at the word ``offset``. Groups wider than the sums are compared
    with all of them."""
    for count, (own, matrix) in groups.items():
        left = np.nonzero(enough[own])[0]
        if not len(left):
            continue
        own, matrix = own[left], matrix[:, left]
        width = min(count, len(total) - 1)
        windows = total[width:] - total[:-width]
        norms = np.maximum(np.sqrt((windows * windows).sum(axis=1)), 1e-9)
        products = windows @ matrix
        at, item = np.nonzero(products >= COSINE * norms[:, None])
        yield (own[item], offset + at * unit, np.full(len(at), width * unit), products[at, item] / norms[at])


def _running(rows: np.ndarray) -> np.ndarray:
    total = np.zeros((len(rows) + 1, rows.shape[1]), dtype=np.float32)
    np.cumsum(rows, axis=0, out=total[1:])
    return total


def possible_parts(slots: np.ndarray, items: Items, shares: np.ndarray | float = LIKELY) -> np.ndarray:
    """Whether the document has enough words of each part at all: no other part can have a common
    subsequence of that length, so no window has to be compared with it."""
    there = np.zeros(SLOTS, dtype=bool)
    there[slots] = True
    return np.add.reduceat(there[items.slots].astype(np.int64), items.offsets) >= shares * items.lengths


def needed_shares(slots: np.ndarray, items: Items) -> np.ndarray:
    """The share of each part that a window has to hold for a match: ``LIKELY`` only of parts whose answer
    the document has enough words of, too."""
    there = np.zeros(SLOTS, dtype=bool)
    there[slots] = True
    answers = np.add.reduceat(there[items.answer_slots].astype(np.int64), items.answer_offsets)
    return np.where(answers >= ANSWERED * items.answer_lengths, LIKELY, SURE)


def reached(slots: np.ndarray, items: Items, enough: np.ndarray, shares: np.ndarray | float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(short parts, parts, steps): the parts ``enough`` that have their share of words in a region. Short ones have them in a somewhat larger region; for each other part come the steps at
    which such windows begin. What is left out needs no cosine."""
    short, parts_found, steps_found = np.zeros_like(enough), [], []
    every = items.by_reach[enough[items.by_reach]]
    needs = np.ceil(shares * items.lengths).astype(np.int32)
    steps = -(-len(slots) // STEP)
    padded = np.full(steps * STEP, SLOTS, dtype=np.int64)
    padded[:len(slots)] = slots
    for start in range(0, len(every), TOGETHER):
        own = every[start:start + TOGETHER]
        lengths = items.lengths[own]
        words = np.repeat(items.offsets[own] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        words = items.slots[words] * TOGETHER + np.repeat(np.arange(len(own)), lengths)
        items.member[words] = True
        there = np.take(items.member.reshape(-1, TOGETHER), padded, axis=0)
        items.member[words] = False
        # a step's words are added as bytes of larger numbers, which eight of them don't fill
        counts = there.view(np.uint64).reshape(steps, STEP, -1).sum(axis=1).view(np.uint8).reshape(steps, -1)
        # words before each step; the first and the last row are there twice, as regions begin a step early
        # and end a step late
        before = np.zeros((steps + 3, len(own)), dtype=np.int32)
        np.cumsum(counts[:, :len(own)], axis=0, out=before[2:-1])
        before[-1] = before[-2]
        reach, needed, brief = items.reach[own], needs[own], lengths < SHORT
        ends = np.flatnonzero((np.diff(reach) != 0) | (np.diff(brief) != 0)) + 1
        for low, high in zip([0, *ends.tolist()], [*ends.tolist(), len(own)]):
            if brief[low]:
                # what begins later reaches no further
                size = min(int(reach[low]), steps)
                region = before[1 + size:-1, low:high] - before[1:steps - size + 2, low:high]
                short[own[low:high]] = (region >= needed[low:high]).any(axis=0)
            else:
                size = min(int(reach[low]) - 1, steps)
                region = before[size + 2:, low:high] - before[:steps - size + 1, low:high]
                step, part = np.nonzero(region >= needed[low:high])
                parts_found.append(own[low + part])
                steps_found.append(step)
    if not parts_found:
        return short, every[:0], every[:0]
    return short, np.concatenate(parts_found), np.concatenate(steps_found)


def candidates(hashes: np.ndarray, space: np.ndarray, items: Items, matches: bool = False) -> list[tuple]:
    """Arrays of (part, first word, words, cosine): windows that are near an item's part. With ``matches``
    those are left out that lack the words for ``check`` to take them."""
    slots, found = slots_of(hashes), []
    if not len(items.slots):
        return found
    enough, shares = possible_parts(slots, items), LIKELY
    if matches and enough.any():
        shares = needed_shares(slots, items)
        enough = possible_parts(slots, items, shares)
    if not enough.any():
        return found
    short, parts, steps = reached(slots, items, enough, shares)
    if len(parts):
        whole = len(slots) // STEP * STEP
        sums = np.empty((-(-len(slots) // STEP), space.shape[1]), dtype=space.dtype)
        _added_rows(space, slots[:whole].reshape(-1, STEP), sums[:whole // STEP])
        if whole < len(slots):
            sums[-1] = space[slots[whole:]].sum(axis=0)
        total = _running(sums)
        for at in range(0, len(parts), BUFFER):
            part, step = parts[at:at + BUFFER], steps[at:at + BUFFER]
            width = np.minimum(items.widths[part], len(sums))
            windows = total[step + width] - total[step]
            norms = np.maximum(np.sqrt((windows * windows).sum(axis=1)), 1e-9)
            products = (windows * items.vectors[part]).sum(axis=1)
            near = products >= COSINE * norms
            found.append((part[near], step[near] * STEP, width[near] * STEP, products[near] / norms[near]))
    if short.any():
        # neighbouring pieces overlap, so that every window lies in one
        for at in range(0, max(len(hashes) - SHORT, 1), PIECE):
            found += _near(_running(space[slots[at:at + PIECE + SHORT]]), items.by_words, short, 1, at)
    return found


def possible(hashes: np.ndarray, found: list[tuple], items: Items) -> list[tuple[int, int, int, float]]:
    """The candidates whose region has enough words of the part."""
    slots = slots_of(hashes)
    parts, at, width, cosine = (np.concatenate(x) for x in zip(*found))
    left = []
    for part in np.unique(parts).tolist():
        own = np.nonzero(parts == part)[0]
        start, length = items.offsets[part], items.lengths[part]
        member = np.zeros(SLOTS, dtype=bool)
        member[items.slots[start:start + length]] = True
        inside = np.concatenate([[0], np.cumsum(member[slots])])
        region = (inside[np.minimum(at[own] + width[own] + STEP, len(slots))]
                  - inside[np.maximum(at[own] - STEP, 0)])
        own = own[region >= LIKELY * length]
        left += zip(parts[own].tolist(), at[own].tolist(), width[own].tolist(), cosine[own].tolist())
    return left


def check(hashes: np.ndarray, found: list[tuple], items: Items) -> dict:
    """The best verified match per item: (share, first word, words in common, cosine, answered)."""
    best: dict = {}
    if not found:
        return best
    left = possible(hashes, found, items)
    inside = hashes.tolist() if left else []
    for part, at, width, cosine in left:
        words = items.words[part]
        first = max(0, at - STEP)
        region = inside[first:at + width + STEP]
        common = common_subsequence(words, region)
        share = common / len(words)
        if share < LIKELY:
            continue
        answer = items.answers[part]
        answered = common_subsequence(answer, inside[first:at + width + 2 * STEP + len(answer)]) >= ANSWERED * len(answer)
        if share >= SURE or answered:
            entry = (share, -first, common, cosine, answered)
            item = items.ids[part]
            if item not in best or entry > best[item]:
                best[item] = entry
    return best


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, share, common_words, first_word, cosine, answered): one row per
    document and item that it holds. ``first_word`` is where the searched region begins."""
    ship_with_job()
    spark = docs.sparkSession
    schema = ("doc_id long, item_id long, share double, common_words int, first_word int,"
              " cosine double, answered boolean")
    rows = docs.select("doc_id", "text").filter("text IS NOT NULL")
    asked = benchmark.select("item_id", "text").filter("text IS NOT NULL")
    blocks = -(-asked.count() // BLOCK)
    result = spark.createDataFrame([], schema)
    if not blocks:
        return result
    written: list[str] = []
    with noted(written):
        passages = staged(slot_rows(rows.select("text")), "passages")
    idf = inverse_frequencies(passages)
    space = latent_space(passages, asked, idf)
    remove(spark, written)  # the result doesn't read them
    held = spark.sparkContext.broadcast(space)  # SLOTS x RANK numbers, whatever the data
    for block in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        asked_rows = spark.sparkContext.broadcast([(r["item_id"], r["text"]) for r in own])  # plain data

        def run(batches: Iterator[pd.DataFrame], asked_rows=asked_rows) -> Iterator[pd.DataFrame]:
            items = Items(asked_rows.value, held.value)
            for batch in batches:
                out = []
                for doc_id, text in zip(batch["doc_id"].astype("Int64"), batch["text"]):
                    hashes = word_hashes(text)
                    if len(hashes) < LEAST_WORDS:
                        continue
                    near = candidates(hashes, held.value, items, matches=True)
                    for item, (share, first, common, cosine, answered) in check(hashes, near, items).items():
                        out.append((doc_id, item, share, common, -first, cosine, answered))
                frame = pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])
                yield frame.astype({"doc_id": "Int64", "item_id": "Int64"})

        result = result.unionByName(rows.mapInPandas(run, schema))
    return result


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, columns as in ``docs``. Equal texts share the
    verdict, so rows with null or repeated ids are told apart by their text."""
    packed, row = pack(docs, "text")
    named = packed.select(row, F.xxhash64("text").alias("_key"))
    found = leaks(docs.select(F.xxhash64("text").alias("doc_id"), "text"), benchmark)
    gone = staged(found.select(F.col("doc_id").alias("_key")).distinct(), "leaks")
    return unpack(named.join(gone, "_key", "left_anti"), docs, row)
