"""Quality rules with host-level verdicts (DataFrame and SQL functions only).

Every text is measured and held against document rules. The failures are summed by host
(``source``), the hosts' failure rates are shrunk towards the corpus by a beta prior that is
fitted to the hosts' own rates, and the verdict on the host goes back to its documents. A host's rate
is taken to be at least its posterior mean less ``SURE`` posterior deviations, so a host of few documents
needs more failures than one of many:

* ``deny``: the odds of that rate are ``DENY`` times those of the corpus; all documents of the host go,
* ``review``: they are ``REVIEW`` times those of the corpus; documents go that fail any rule,
* ``allow``: documents stay unless they fail the base rules.

A rate below ``LEAST_DENY`` or ``LEAST_REVIEW`` is no reason, however clean the rest of the corpus is.

Defined results: a null text has no words and fails the base rules; an empty one likewise.
Documents with a null source form the host "" together with those of the empty source.
Repeated rows are measured one by one. An empty table gives an empty result. Extra columns
are not read; ``apply_rules`` keeps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import lookup, pack, staged, unpack

WINDOW = 8
DENY, REVIEW = 9.0, 2.0
LEAST_DENY, LEAST_REVIEW = 0.5, 0.02
SURE = 2.0
#: Prior strengths outside of these bounds mean hosts that do not differ, or no hosts at all.
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1e6

#: Words of a text are cut once and bound to ``w``; ``h`` are the hashes of its windows. Most
#: texts repeat no half window, so the windows are hashed and sorted only where one does.
_MEASURES = r"""
transform(array(array_remove(split(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), '')), w -> named_struct(
  'n_words', cast(size(w) AS bigint),
  'word_chars', cast(length(array_join(w, '')) AS bigint),
  'n_repeat_words', if(size(w) <= {n}, 0L,
    if(transform(array(transform(sequence(0, size(w) - {half}), i -> xxhash64({half_window}))),
                 h -> size(array_distinct(h)) = size(h))[0], 0L,
      transform(array(sort_array(transform(sequence(0, size(w) - {n}),
                                           i -> named_struct('x', xxhash64({window}), 'i', i)))), s ->
        transform(array(sort_array(filter(
          transform(s, (e, k) -> if((k > 0 AND s[greatest(k - 1, 0)].x = e.x)
            OR (k + 1 < size(s) AND s[least(k + 1, size(s) - 1)].x = e.x), e.i, cast(null AS int))),
          p -> p IS NOT NULL))), p ->
          aggregate(transform(p, (a, k) ->
            if(k + 1 < size(p), least({n}, p[least(k + 1, size(p) - 1)] - a), {n})),
            0L, (total, x) -> total + x))[0])[0]))))[0]
""".format(n=WINDOW, half=WINDOW // 2,
           half_window=", ".join(f"w[i + {k}]" for k in range(WINDOW // 2)),
           window=", ".join(f"w[i + {k}]" for k in range(WINDOW)))

_LINES = r"""
transform(array(filter(split(coalesce(text, ''), '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')),
          l -> named_struct('n', size(l), 'dup', cast(size(l) - size(array_distinct(l)) AS bigint)))[0]
"""

FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words"]


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct ``_q`` of the text's measures. A repeated window is found by
    the 64-bit hashes of the windows of one text."""
    return (docs.withColumn("_w", F.expr(_MEASURES)).withColumn("_l", F.expr(_LINES))
            .withColumn("_q", F.struct(
                "_w.n_words", "_w.word_chars",
                F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[#*$%&|<>]"))
                .cast("long").alias("n_symbols"),
                F.col("_l.dup").alias("n_dup_lines"), F.col("_l.n").cast("long").alias("n_lines"),
                "_w.n_repeat_words"))
            .drop("_w", "_l"))


def base_failed() -> Column:
    return F.expr("_q.n_words < 20 OR 100 * _q.n_repeat_words > 30 * _q.n_words")


def rule_failed() -> Column:
    """The base rules, many symbols, many repeated lines, and words of unlikely length."""
    return base_failed() | F.expr(
        "10 * _q.n_symbols > 3 * _q.n_words OR 10 * _q.n_dup_lines > 3 * _q.n_lines"
        " OR _q.word_chars < 2 * _q.n_words OR _q.word_chars > 15 * _q.n_words")


def host_verdicts(measured: DataFrame) -> DataFrame:
    """(host, n, failed, rate, verdict), one row per host. Two sums by host; the prior comes
    from one row of sums over hosts."""
    hosts = staged(measured.groupBy("_host").agg(
        F.count("*").alias("n"), F.sum(F.col("_failed").cast("long")).alias("failed")), "hosts")
    corpus = hosts.agg(F.sum("n").alias("n"), F.sum("failed").alias("f")).first()
    n, f = corpus["n"] or 0, corpus["f"] or 0
    mean = f / n if n else 0.0
    spread = hosts.agg(F.sum(F.col("n") * F.pow(F.col("failed") / F.col("n") - F.lit(mean), 2))
                       .alias("v")).first()["v"]
    variance = spread / n if n else 0.0
    strength = mean * (1 - mean) / variance - 1 if variance > 0 else MOST_STRENGTH
    strength = min(max(strength, LEAST_STRENGTH), MOST_STRENGTH)
    rate = (F.lit(mean * strength) + F.col("failed")) / (F.lit(strength) + F.col("n"))
    at_least = rate - SURE * F.sqrt(rate * (1 - rate) / (F.lit(strength + 1) + F.col("n")))

    def limit(times: float, least: float) -> float:
        """The rate whose odds are so many times those of the corpus."""
        return max(least, times * mean / (1 + (times - 1) * mean))

    return hosts.withColumn("rate", rate).withColumn(
        "verdict", F.when(at_least >= limit(DENY, LEAST_DENY), "deny")
        .when(at_least >= limit(REVIEW, LEAST_REVIEW), "review").otherwise("allow"))


def judge(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (None: all) with ``_q``, ``_base``, ``_failed``, ``_host``,
    ``_rate``, ``_verdict``, ``_kept``.

    The measured rows are written once: the texts are read a single time, the sums by host
    and the final rows both come from the written table.
    """
    columns = [F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]
    measured = staged(
        measure(docs).withColumn("_base", base_failed()).withColumn("_failed", rule_failed())
        .withColumn("_host", F.coalesce("source", F.lit("")))
        .select(*columns, "_q", "_base", "_failed", "_host"), "measured")
    verdicts = staged(host_verdicts(measured).select(
        "_host", F.col("rate").alias("_rate"), F.col("verdict").alias("_verdict")), "verdicts")
    spread = F.struct("_q.word_chars", "_q.n_words", "_q.n_symbols")
    return lookup(measured, verdicts, "_host", spread).withColumn(
        "_kept", ~F.col("_base") & (F.col("_verdict") != "deny")
        & ~((F.col("_verdict") == "review") & F.col("_failed")))


def quality_report(docs: DataFrame) -> DataFrame:
    """One row per document: measures, verdicts."""
    return judge(docs.select("doc_id", "text", "source"), keep=["doc_id"]).select(
        "doc_id", *[f"_q.{c}" for c in FEATURES if c != "n_lines"],
        F.col("_base").alias("base_failed"), F.col("_kept").alias("kept"),
        F.col("_verdict").alias("host_verdict"))


def apply_rules(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with the columns of ``docs``."""
    packed, row = pack(docs, "text", "source")
    return unpack(judge(packed, keep=[row]).filter("_kept"), docs, row)
