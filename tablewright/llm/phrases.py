"""Phrase collocations from suffix subtrees that are built by groups of word prefixes.

Texts are cut into pieces and these into words; a suffix begins at a word, ends with its piece and is cut
off after ``DEPTH`` words. All counting is by language.

1. Vertical partitioning: words are counted, then pairs of frequent words by 64-bit numbers. A prefix below
   ``LEAST`` ends there, as no phrase with it can be a candidate or a part of one. Pairs are the prefixes of
   the subtrees; two pairs of one number are counted together and share a subtree's group, no more;
   those of more than a quarter of a group's memory budget are extended to ``DEPTH`` words.
   Prefixes are dealt to groups by their hash, in as many groups as keep each one's total within the budget.
2. Each group's suffixes, combined before they are shuffled, are sorted, which gives the leaves of its
   subtree from left to right with their totals. A node's count is the sum of its leaves; nodes above an
   extended prefix get their parts from several groups.
3. Phrases of 2 to ``DEPTH`` words are cut in two at every place, looked up, scored, dropped where a longer
   candidate explains them, and ranked.

Frequent words and pairs reach the tasks as bit tables of a fixed size. A word that only seems frequent
costs a few more rows and changes no count.

Defined results: a null text is empty and counts nothing; a null language is ``und``, together with the
language of that name; repeated rows count as often as they stand there; ids and extra columns are not read;
equal scores and counts are ranked by the phrase's bytes; an empty table gives an empty result. Texts are
read whole.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import ship_with_job, staged

DEPTH, LEAST, EXPLAINED, TOP = 4, 30, 80, 2000
#: Suffixes of a group; beyond ``MOST_GROUPS`` such groups each takes its share of all suffixes.
BUDGET, MOST_GROUPS = 1 << 20, 1 << 14
#: Bits of the tables of frequent prefixes, and of the blocks in which they are put together.
BITS, BLOCK_BITS = 1 << 25, 1 << 19
#: Different phrases that a task counts before it hands them over.
HELD = 1 << 19
_SEED, _SALTS = 42, 64
#: Stands for what cuts pieces; no byte of UTF-8.
_BREAK = b"\xff"
_CUT = bytes(c + 32 if 65 <= c <= 90 else 255 if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256))
_STRETCH = 1 << 20
_COUNTS = "lang string, phrase string, n long"


def stretches(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """(lang, words) of a batch of (lang, text): the words of texts of one language with ``_BREAK`` between
    their pieces, in lists that end with a piece. Within a piece only blanks and tabs are white space. Short
    texts share a list, long ones are cut where a piece ends."""
    waiting: dict[str, list[bytes]] = defaultdict(list)
    size: dict[str, int] = defaultdict(int)

    def words(lang: str) -> Iterator[tuple[str, list[bytes]]]:
        data, at = _BREAK.join(waiting.pop(lang)) + _BREAK, 0
        del size[lang]
        while at < len(data):
            to = data.find(_BREAK, at + _STRETCH) + 1 or len(data)
            yield lang, data[at:to].replace(_BREAK, b" " + _BREAK + b" ").split()
            at = to

    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
        data = (text.as_py() or b"").translate(_CUT)
        waiting[lang].append(data)
        size[lang] += len(data) + 1
        if size[lang] >= _STRETCH:
            yield from words(lang)
    for lang in list(waiting):
        yield from words(lang)


def _number(lang: bytes, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang + b"\t" + word, _SEED)


def _joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Numbers of pairs of words, from the numbers of the words."""
    mixed = first * np.uint64(0x9E3779B97F4A7C15) + second
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def _bits_of(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return numbers % np.uint64(BITS), (numbers >> np.uint64(32)) % np.uint64(BITS)


# ---- tables of frequent prefixes ----

def _bit_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bits of words (lang, phrase) or of pairs (pair)."""
    bits = np.zeros(BITS, dtype=bool)
    for batch in batches:
        if batch.num_columns == 1:
            numbers = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        else:
            numbers = np.array([_number(lang.encode(), word.encode()) for lang, word in
                                zip(*(c.to_pylist() for c in batch.columns))], dtype=np.uint64)
        for at in _bits_of(numbers):
            bits[at] = True
    blocks = bits.reshape(-1, BLOCK_BITS)
    there = np.nonzero(blocks.any(axis=1))[0]
    for block in there:
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int32()), pa.array([np.packbits(blocks[block]).tobytes()], pa.binary())],
            ["block", "bits"])


def _joined_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, bits in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = np.frombuffer(bits.as_py(), dtype=np.uint8)
            held[block] = held[block] | own if block in held else own
    for block, bits in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([bits.tobytes()], pa.binary())],
                                         ["block", "bits"])


def bit_table(frequent: DataFrame) -> bytes:
    """``BITS`` bits, two of them set for each word (lang, phrase) or pair (pair) of a written table."""
    table = np.zeros(BITS // 8, dtype=np.uint8)
    size = BLOCK_BITS // 8
    for r in (frequent.mapInArrow(_bit_blocks, "block int, bits binary")
              .repartition("block").mapInArrow(_joined_blocks, "block int, bits binary").collect()):
        table[r["block"] * size:(r["block"] + 1) * size] = np.frombuffer(r["bits"], dtype=np.uint8)
    return table.tobytes()


class Known(dict):
    """The numbers of the words of one language that are in a bit table, 0 for all other words.
    Answers are remembered up to a bound."""

    def __init__(self, lang: str, table: bytes):
        super().__init__()
        self.lang, self.table = lang.encode(), table

    def __missing__(self, word: bytes) -> int:
        if len(self) >= HELD:
            self.clear()
        h = _number(self.lang, word) if word != _BREAK else 0
        one, two = h % BITS, (h >> 32) % BITS
        if not (self.table[one >> 3] & (128 >> (one & 7)) and self.table[two >> 3] & (128 >> (two & 7))):
            h = 0
        self[word] = h
        return h

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


# ---- counting ----

def _counter(found: Callable[[str], Callable[[list[bytes]], list[bytes]]], total: bool = False,
             numbered: bool = False):
    """Counts what ``found(lang)(words)`` lists for the words of each text, with ``total`` also the
    sum of the counts beside the empty phrase, with ``numbered`` the ``prefixes`` of what is listed.
    Beyond ``HELD`` of them, suffixes of three words and more that were met once leave first, as they
    recur least; what stays is added up over the whole task, as long as it is less than half."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)
        ways: dict[str, Callable] = {}

        def way(lang: str) -> Callable:
            if lang not in ways:
                if len(ways) >= 1000:
                    ways.clear()
                ways[lang] = found(lang)
            return ways[lang]

        def rows(rare: bool = False) -> Iterator[pa.RecordBatch]:
            for lang, counter in counts.items():
                counter.pop(_BREAK, None)
                keys = [key for key, often in counter.items() if often == 1 and key.count(b" ") > 2] if rare else list(counter)
                n = [counter.pop(key) for key in keys]
                if total and keys:
                    keys.append(b"")
                    n.append(sum(n))
                for at in range(0, len(keys), 1 << 16):
                    own = keys[at:at + (1 << 16)]
                    columns = {"lang": pa.array([lang] * len(own), pa.string()), "phrase": pa.array(own, pa.string()),
                               "n": pa.array(n[at:at + (1 << 16)], pa.int64())}
                    if numbered:
                        columns["pair"] = pa.array(way(lang).prefixes(own).view(np.int64))
                    yield pa.RecordBatch.from_pydict(columns)
            for lang in [lang for lang, counter in counts.items() if not counter]:
                del counts[lang]
            # a dict keeps the room of what has left it
            counts.update([(lang, Counter(counter)) for lang, counter in counts.items()])

        held = 0
        for batch in batches:
            for lang, words in stretches(batch):
                counter = counts[lang]
                held -= len(counter)
                counter.update(way(lang)(words))
                held += len(counter)
                if held >= HELD:
                    yield from rows(rare=True)
                    held = sum(map(len, counts.values()))
                    if held >= HELD // 2:
                        yield from rows()
                        held = 0
        yield from rows()
    return run


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, phrase, f): frequent words, and how many words there are at all beside the empty phrase."""
    every = texts.mapInArrow(_counter(lambda lang: lambda words: words, total=True), _COUNTS)
    return staged(every.groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
                  .filter((F.col("f") >= LEAST) | (F.col("phrase") == "")), "words")


def _together(numbers: np.ndarray) -> np.ndarray:
    """Whether the pairs of neighbouring words have two frequent words."""
    return (numbers[:-1] != 0) & (numbers[1:] != 0)


def _merged(numbers: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different numbers with the sums of their counts."""
    every = np.concatenate(numbers)
    order = np.argsort(every, kind="stable")
    every = every[order]
    first = np.nonzero(np.append(True, every[1:] != every[:-1]))[0]
    return every[first], np.add.reduceat(np.concatenate(n)[order], first)


def _pair_counter(words):
    """Counts pairs of frequent words by their numbers; ``words`` is the broadcast bit table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Known] = {}
        numbers: list[np.ndarray] = []
        n: list[np.ndarray] = []

        def row() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(numbers[0].view(np.int64)), pa.array(n[0])], ["pair", "n"])
            numbers.clear()
            n.clear()
            return batch

        held = 0
        for batch in batches:
            for lang, piece in stretches(batch):
                if lang not in known:
                    if len(known) >= 1000:
                        known.clear()
                    known[lang] = Known(lang, words.value)
                own = known[lang].numbers(piece)
                at = np.nonzero(_together(own))[0]
                if not len(at):
                    continue
                pairs, often = np.unique(_joined(own[at], own[at + 1]), return_counts=True)
                numbers.append(pairs)
                n.append(often.astype(np.int64))
                held += len(pairs)
                if held >= 4 * HELD:
                    numbers[:], n[:] = ([x] for x in _merged(numbers, n))
                    held = len(numbers[0])
                    if held >= 2 * HELD:
                        yield row()
                        held = 0
        if numbers:
            numbers[:], n[:] = ([x] for x in _merged(numbers, n))
            yield row()
    return run


def pair_counts(texts: DataFrame, words) -> DataFrame:
    """(pair, f): numbers of the pairs that stand ``LEAST`` times or more; ``words`` is the broadcast bit table."""
    every = texts.mapInArrow(_pair_counter(words), "pair long, n long")
    return staged(every.groupBy("pair").agg(F.sum("n").alias("f")).filter(F.col("f") >= LEAST), "pairs")


class Suffixes:
    """Cuts the suffixes that begin with a frequent pair, off at rare pairs, after ``DEPTH`` words
    and where the piece ends; a blank follows every word."""

    def __init__(self, lang: str, words: bytes, pairs: bytes):
        self.known, self.table = Known(lang, words), np.frombuffer(pairs, dtype=np.uint8)

    def __call__(self, words: list[bytes]) -> list[bytes]:
        numbers = self.known.numbers(words)
        ok = np.zeros(len(words) + DEPTH, dtype=bool)
        at = np.nonzero(_together(numbers))[0]
        there = np.ones(len(at), dtype=bool)
        for bit in _bits_of(_joined(numbers[at], numbers[at + 1])):
            there &= (self.table[bit >> np.uint64(3)] & (np.uint8(128) >> (bit & np.uint64(7)).astype(np.uint8))) != 0
        start = at[there]
        ok[start] = True
        end, more = start + 2, np.ones(len(start), dtype=bool)
        for step in range(1, DEPTH - 1):
            more &= ok[start + step]
            end += more
        text = b" ".join(words) + b" "
        place = np.zeros(len(words) + 1, dtype=np.int64)
        np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1, out=place[1:])
        return [text[i:j] for i, j in zip(place[start].tolist(), place[end].tolist())]

    def prefixes(self, cut: list[bytes]) -> np.ndarray:
        """The numbers of their first two words."""
        parts = [s.split(b" ", 2) for s in cut]
        return _joined(self.known.numbers([p[0] for p in parts]), self.known.numbers([p[1] for p in parts]))


def group_plan(pairs: DataFrame) -> tuple[int, int]:
    """(groups, largest prefix that isn't extended) for the written prefixes."""
    total = pairs.agg(F.sum("f").alias("t")).first()["t"] or 0
    budget = max(BUDGET, -(-total // MOST_GROUPS))
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(4 * tasks, -(-2 * total // budget))
    light = pairs.filter(F.col("f") <= budget // 4)
    for _ in range(8):
        load = (light.groupBy(F.pmod("pair", F.lit(groups)).alias("g")).agg(F.sum("f").alias("f"))
                .agg(F.max("f").alias("m")).first()["m"] or 0)
        if load <= budget:
            break
        groups *= 2
    return groups, budget // 4


# ---- subtrees ----

def _subtree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the nodes, from leaves (lang, suffix, extended, n) in the order of their suffixes.
    As a blank follows every word, the leaves below a node are neighbours among those of their
    language. Nodes of fewer words than an extended prefix are parts, and leave at every size."""
    paths: dict[str, list[list]] = {}   # by language the open nodes [phrase, total], two words first
    out: list[tuple[str, str, int]] = []

    def close(lang: str, path: list[list], depth: int, least: int) -> None:
        for phrase, total in path[depth:]:
            if total >= least:
                out.append((lang, phrase[:-1], total))
        del path[depth:]

    extended: dict[str, bool] = {}
    for batch in batches:
        for lang, suffix, parts, n in zip(*(batch.column(i).to_pylist() for i in range(4))):
            path = paths.get(lang)
            if path is None:
                path = paths[lang] = []
            depth = 0
            for node in path:
                if not suffix.startswith(node[0]):
                    break
                node[1] += n
                depth += 1
            if depth < len(path):
                close(lang, path, depth, 1 if extended[lang] else LEAST)
            extended[lang] = parts
            to = len(path[-1][0]) if path else suffix.index(" ") + 1
            while to < len(suffix):
                to = suffix.index(" ", to) + 1
                path.append([suffix[:to], n])
        if len(out) >= 1 << 16:
            yield _frame(out)
            out.clear()
    for lang, path in paths.items():
        close(lang, path, 0, 1 if extended[lang] else LEAST)
    yield _frame(out)


def _frame(rows: list[tuple[str, str, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()))], ["lang", "phrase", "n"])


def phrase_counts(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, f) of all words and phrases of up to ``DEPTH`` words that stand ``LEAST``
    times or more, (lang, n) of all words)."""
    ship_with_job()
    spark = texts.sparkSession
    counted = word_counts(texts)
    words, totals = counted.filter("phrase != ''"), counted.filter("phrase = ''").select("lang", F.col("f").alias("n"))
    word_bits = spark.sparkContext.broadcast(bit_table(words.select("lang", "phrase")))
    pairs = pair_counts(texts, word_bits)
    pair_bits = spark.sparkContext.broadcast(bit_table(pairs.select("pair")))
    groups, largest = group_plan(pairs)
    leaves = (texts.mapInArrow(_counter(lambda lang: Suffixes(lang, word_bits.value, pair_bits.value), numbered=True),
                               _COUNTS + ", pair long").withColumnRenamed("phrase", "suffix"))
    # extended prefixes hold a fixed share of all suffixes each, so there is a bounded number of them
    heavy = [r["pair"] for r in pairs.filter(F.col("f") > largest).collect()]
    leaves = leaves.withColumn("extended", F.col("pair").isin(heavy) if heavy else F.lit(False))
    prefix = F.when(F.col("extended"), F.xxhash64("lang", "suffix")).otherwise(F.col("pair"))
    leaves = (leaves.select("lang", "suffix", "extended", "n", F.pmod(prefix, F.lit(groups)).alias("_group"))
              .repartition("_group").drop("_group").sortWithinPartitions("suffix"))
    nodes = leaves.mapInArrow(_subtree, _COUNTS)
    found_phrases = (nodes.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).filter(F.col("f") >= LEAST))
    return staged(words.unionByName(found_phrases), "phrases"), totals


# ---- scores ----

def collocations(docs: DataFrame) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``TOP`` of every language."""
    counts, totals = phrase_counts(docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
                                   .filter("text IS NOT NULL"))
    words = F.split("phrase", " ")
    candidates = counts.withColumn("_w", words).filter("size(_w) > 1").withColumnRenamed("f", "a")
    cuts = candidates.withColumn("k", F.explode(F.expr("sequence(1, size(_w) - 1)"))).select(
        "lang", "phrase", "a", "k", F.expr("array_join(slice(_w, 1, k), ' ')").alias("_first"),
        F.expr("array_join(slice(_w, k + 1, size(_w)), ' ')").alias("_rest"))
    left = counts.select("lang", F.col("phrase").alias("_first"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("_rest"), F.col("f").alias("r"))
    # common parts are hot keys of the big side; merge joins are split where hot by the adaptive plan
    scored = (cuts.join(left.hint("merge"), ["lang", "_first"]).join(right.hint("merge"), ["lang", "_rest"])
              .withColumn("score", F.expr("(cast(a AS decimal(20, 0)) * 2000000BD) div (cast(l AS decimal(20, 0)) + r)"))
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("_cut")))
    inside = (candidates.filter("size(_w) > 2")
              .withColumn("_n", F.explode(F.expr("sequence(2, size(_w) - 1)")))
              .withColumn("_i", F.explode(F.expr("sequence(1, size(_w) - _n + 1)")))
              .groupBy("lang", F.expr("array_join(slice(_w, _i, _n), ' ')").alias("phrase"))
              .agg(F.max("a").alias("_longer")))
    kept = (scored.join(inside.hint("merge"), ["lang", "phrase"], "left")
            .filter(f"_longer IS NULL OR cast(_longer AS decimal(20, 0)) * 100BD < cast(a AS decimal(20, 0)) * {EXPLAINED}BD")
            .select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score"))
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first among a part of a language's phrases, then among the first ones of the parts
    part = F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)).alias("_part")
    some = (kept.select("*", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*best)))
            .filter(F.col("rank") <= TOP).drop("_part", "rank"))
    top = (some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
           .filter(F.col("rank") <= TOP))
    return top.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
