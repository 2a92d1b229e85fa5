"""Removal of repeated passages by rolling hashes of lines.

A text's lines are hashed, and a rolling hash over ``WINDOW`` lines is taken at every line, so
that a passage of ``WINDOW`` or more lines has the same hashes wherever it stands. Windows
whose hash occurs more than once in the corpus are compared byte by byte (they are grouped by
their text). A line goes if one of its windows stands at an earlier place - smaller document
id, then smaller line - as well: overlapping windows join to the whole run that two places have
in common, and nothing beyond it. The first place of every line stays.

Lines without a word are no passage by themselves: a window has to hold another line, and the
blank lines between two lines go with the two.

Every choice of fewer boundaries than that loses passages: one of two lines is found only if both of
its lines are boundaries.

Defined results: a null text has no lines and stays null, an empty one stays empty; documents
without an id are left as they are; repeated rows share their decisions, as they share id and
text; rows that share an id only are documents of their own, in the order of a hash of their texts; of a passage that stands twice in a document the first stays; extra columns are not read
by ``dedup_report``; an empty table gives an empty result. Lines are compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.base import unused_name
from tablewright.llm.common import ship_with_job, staged

#: Lines of the shortest passage that is found.
WINDOW = 2
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15


def windows(lines: list[str]) -> list[tuple[int, int, int]]:
    """(first line, number of lines, signed hash) of the text's windows: every ``WINDOW`` lines
    that are not all blank, and every run of blank lines with the line before and after it."""
    hashes = [xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass")) for x in lines]
    spans, before = [], None
    for i, line in enumerate(lines):
        if line and not line.isspace():
            if before is not None and i - before > WINDOW:
                spans.append((before, i + 1 - before))
            before = i
        if i + 1 >= WINDOW and before is not None and before > i - WINDOW:
            spans.append((i + 1 - WINDOW, WINDOW))
    found = []
    for first, count in spans:
        rolling = count
        for h in hashes[first:first + count]:
            rolling = (rolling * _BASE + h) & _MASK
        found.append((first, count, rolling - ((rolling >> 63) << 64)))
    return found


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(doc_id, key, first, h) for doc_id, key, text in
                zip(batch["doc_id"].astype("int64"), batch["text_key"], batch["text"])
                for first, _, h in windows(text.split("\n"))]
        yield pd.DataFrame(rows, columns=["doc_id", "text_key", "first", "hash"])


def _passages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The windows whose hash is among the document's repeated ones, with their text."""
    for batch in batches:
        rows = []
        for doc_id, key, text, repeated in zip(batch["doc_id"].astype("int64"), batch["text_key"], batch["text"],
                                               batch["repeated"]):
            lines, repeated = text.split("\n"), set(repeated)
            rows += [(doc_id, key, first, count, h, "\n".join(lines[first:first + count]))
                     for first, count, h in windows(lines) if h in repeated]
        yield pd.DataFrame(rows, columns=["doc_id", "text_key", "first", "lines", "hash", "passage"])


def _text_key() -> Column:
    return F.xxhash64("text").alias("text_key")


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, first, lines): the windows to remove, written."""
    ship_with_job()
    texts = docs.select("doc_id", _text_key(), "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
    light = staged(texts.mapInPandas(_hashed, "doc_id long, text_key long, first int, hash long"), "windows")
    place, document = F.struct("doc_id", "text_key", "first"), ["doc_id", "text_key"]
    often = staged(light.groupBy("hash").agg(F.min(place).alias("a"), F.max(place).alias("b"))
                   .filter("a < b").select("hash"), "window-hashes")
    held = staged(light.join(often.hint("merge"), "hash", "left_semi").select(*document, "hash"), "repeated")
    by_doc = held.groupBy(*document).agg(F.collect_set("hash").alias("repeated"))  # a document's own lines
    # byte comparison: equal windows are those with the same text; a hot one is summed per task first
    repeats = staged(
        texts.join(by_doc.hint("merge"), document).select(*document, "text", "repeated")
        .mapInPandas(_passages, "doc_id long, text_key long, first int, lines int, hash long, passage string")
        .withColumn("same", F.sha2("passage", 256)), "repeats")
    exact = staged(repeats.groupBy("hash", "passage").agg(
        F.count("*").alias("n"), F.min(place).alias("kept"),
        F.first("same").alias("same")).filter("n > 1").drop("passage", "n"), "exact")
    there = (repeats["hash"] == exact["hash"]) & (repeats["same"] == exact["same"])
    return staged(repeats.drop("passage").join(exact, there).filter(F.col("kept") != place)
                  .select(*document, "first", "lines").distinct(), "removed")


def _without_repeats(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` with ``text`` less the repeated passages and ``_removed``, the number of lines
    that went."""
    # windows overlap: a document's removed lines are counted once
    gone = repeated_windows(docs).groupBy("doc_id", "text_key").agg(F.array_distinct(F.flatten(F.collect_list(
        F.sequence("first", F.expr("first + lines - 1"))))).alias("_gone")).withColumn("_removed", F.size("_gone"))
    # a merge join at every size: the list of documents that lose lines grows with the corpus
    joined = docs.select(*keep, "doc_id", "text", _text_key()).join(gone.hint("merge"), ["doc_id", "text_key"], "left")
    left = F.expr(r"""
        array_join(transform(array(split(text, '\n')), ls ->
          transform(array_except(sequence(0, size(ls) - 1), _gone), i -> ls[i]))[0], '\n')""")
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(left)
    return joined.select(*keep, "doc_id", text.alias("text"), F.coalesce("_removed", F.lit(0)).alias("_removed"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated passages taken out of ``text``; all rows and columns stay. ``_removed``
    (or the first free name like it) is the number of lines that went."""
    row = "_user_row"
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias(row), "doc_id", "text")
    found = _without_repeats(packed, row)
    return found.select(*[F.col("text") if c == "text" else F.col(row).getField(c).alias(c) for c in docs.columns],
                        F.col("_removed").alias(unused_name("_removed", docs.columns)))


def dedup_report(docs: DataFrame) -> DataFrame:
    """One row per document: lines before, lines removed, size and checksum of what is left."""
    lines = F.coalesce(F.size(F.split("text", "\n")), F.lit(0))
    rows = docs.select("doc_id", "text", F.when(F.col("text").isNull(), 0).otherwise(lines).alias("n"))
    return _without_repeats(rows, "n").select(
        "doc_id", F.col("n").cast("long").alias("n_lines"), F.col("_removed").cast("long").alias("n_removed"),
        F.octet_length("text").cast("long").alias("left_bytes"),
        F.crc32(F.encode("text", "UTF-8")).alias("left_crc32"))
