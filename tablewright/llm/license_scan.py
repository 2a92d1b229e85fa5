"""License scan by ordered signature rules (DataFrame and SQL functions only).

A text is held against the rules whose keyword - a literal of all the rule's matches - it
contains. Every match is an interval of the text. A detection goes if another one with the
same or a higher priority contains its interval; of equal intervals the higher priority,
then the earlier rule stays. All of it happens inside the row, nothing is shuffled.

Base places are the places of three phrases among the text's words; they stay in any case.

Defined results: a null or empty text has no words, no labels, score 0 and null positions.
Repeated rows are scanned one by one, null ids are kept, extra columns are not read, an empty
table gives an empty result. Whole texts are scanned.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.license_rules import WEIGHT, rules

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed by the result's definition: a word before A-Z are lower-cased, and after.
_ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE_WEIGHT = 0.7


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@cache
def _rule_array() -> str:
    """The rules by keyword, so that each keyword is looked for once."""
    groups: dict[str, list[str]] = {}
    for i, r in enumerate(rules()):
        groups.setdefault(r.keyword, []).append(
            f"named_struct('l', {_quoted(r.label)}, 'p', {r.priority}, 'x', {_quoted(r.pattern)}, 'o', {i})")
    return "array(" + ", ".join(f"named_struct('k', {_quoted(k)}, 'r', array({', '.join(own)}))"
                                for k, own in groups.items()) + ")"


_HIT = "struct<b: int, e: int, p: int, o: int, l: string>"


# all matches of the rules in ``t``: begin and end in code points, priority, rule order, label
_HITS = """
flatten(transform(flatten(transform(filter({rules}, k -> contains(t, k.k)), k -> k.r)), r ->
  aggregate(
    zip_with(regexp_extract_all(t, r.x, 0), split(t, r.x), (m, g) -> named_struct('m', m, 'g', g)),
    named_struct('at', 0, 'out', cast(array() AS array<{hit}>)),
    (a, s) -> if(s.m IS NULL, a, named_struct(
      'at', a.at + length(s.g) + length(s.m),
      'out', concat(a.out, array(named_struct(
        'b', a.at + length(s.g), 'e', a.at + length(s.g) + length(s.m),
        'p', r.p, 'o', r.o, 'l', r.l))))),
    a -> a.out)))"""

# in this order a containing interval comes before what it contains
_ORDERED = """
transform(sort_array(transform({hits}, h -> named_struct(
  'b', h.b, 'w', -h.e, 'q', -h.p, 'o', h.o, 'l', h.l))),
  h -> named_struct('b', h.b, 'e', -h.w, 'p', -h.q, 'l', h.l))"""

# the furthest end so far of the detections of at least each priority
_KEPT = """
aggregate({ordered},
  named_struct('ends', array_repeat(-1, {levels}),
               'out', cast(array() AS array<struct<b: int, e: int, p: int, l: string>>)),
  (a, h) -> named_struct(
    'ends', transform(a.ends, (x, i) -> if(i + 1 <= h.p, greatest(x, h.e), x)),
    'out', if(h.e > a.ends[h.p - 1], concat(a.out, array(h)), a.out)),
  a -> a.out)"""


@cache
def _spans_sql() -> str:
    """The detections that stay, of a text in lower case that is bound to ``t``; none if null."""
    hits = _HITS.format(rules=_rule_array(), hit=_HIT)
    kept = _KEPT.format(ordered=_ORDERED.format(hits=hits), levels=max(WEIGHT))
    return f"transform(array(_lower), t -> if(t IS NULL, NULL, {kept}))[0]"


def _base(words: str) -> str:
    """Places of the phrases among the words: (start, label)."""
    return f"""
filter(transform({words}, (w, i) -> CASE
    WHEN w = 'license' AND get({words}, i - 1) = 'mit' THEN named_struct('i', i - 1, 'l', 'mit')
    WHEN w = 'license' AND get({words}, i - 1) = 'apache' THEN named_struct('i', i - 1, 'l', 'apache')
    WHEN w = 'license' AND get({words}, i - 1) = 'public' AND get({words}, i - 2) = 'general'
      THEN named_struct('i', i - 2, 'l', 'gpl') END), x -> x IS NOT NULL)"""


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_n_words``, ``_base`` (places of the phrases) and ``_spans`` (detections
    that stay: begin, end, priority, label)."""
    lower = F.translate(F.col(f"`{text}`"), UPPER, LOWER)
    # every phrase has this word, so other texts need not be cut to words
    words = (f"transform(array(array_remove(split(if(contains(_lower, 'license'), _lower, ''),"
             f" {_quoted(_BETWEEN)}), '')), ws -> {_base('ws')})[0]")
    return (docs.withColumn("_lower", lower)
            .withColumn("_n_words", F.regexp_count(
                F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(_ANY_WORD)).cast("long"))
            .withColumn("_spans", F.expr(_spans_sql())).withColumn("_base", F.expr(words))
            .drop("_lower"))


def license_report(docs: DataFrame) -> DataFrame:
    """One row per document: words, base places, labels, score."""
    best = F.coalesce(F.array_max("_spans.p"), F.lit(0))
    weight = F.element_at(F.array(F.lit(0.0), *[F.lit(WEIGHT[p]) for p in sorted(WEIGHT)]), best + 1)
    base = F.array_distinct("_base.l")
    return scan(docs.select("doc_id", "text")).withColumn(
        "_spans", F.coalesce("_spans", F.expr("cast(array() AS array<struct<b: int, e: int, p: int, l: string>>)"))
    ).select(
        "doc_id", F.col("_n_words").alias("n_words"),
        F.size("_base").cast("long").alias("n_base"),
        F.array_min("_base.i").cast("long").alias("first_word"),
        F.array_max("_base.i").cast("long").alias("last_word"),
        F.array_join(F.sort_array(base), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(base, F.array_distinct("_spans.l"))), ",").alias("labels"),
        F.greatest(weight, F.when(F.size("_base") > 0, BASE_WEIGHT).otherwise(0.0)).alias("score"),
        F.size("_spans").cast("long").alias("n_spans"))
