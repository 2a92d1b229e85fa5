"""Mixing documents to target weights of soft domains (DataFrame and SQL functions and
Spark's own ML stages only; no Python on the executors).

A classifier is fitted to the labelled table: hashed words of the text against the domain
``clean``, ``poor`` or ``toxic``. It gives every document a posterior over the domains. The
rates ``r_i >= 0`` minimise

    sum_d (sum_i t_i r_i p_id / T - w_d)^2 / s_d  +  RIDGE * sum_i t_i (r_i - 1)^2 / T

with tokens ``t``, their total ``T``, targets ``w`` and present shares ``s``, by projected
gradient steps on the rates, scaled by the second moments of the domains. Every step moves all rates
along the posteriors and cuts them off at zero, so a document's rate is ``max(0, 1 + u p_i)`` with one
number ``u_d`` per domain; no rate is stored in between. A step's gradient and moments are sums over
one pass of a written table, and a few steps bring the gradient to zero.

Defined results: a null or empty text has no tokens and the posterior of the intercept;
documents without a label only get posteriors; repeated labels of a document count once, the
worst one; of labelled documents that share an id one is learned from; no labels give the single domain
``clean``; a domain without labelled documents drops out and the targets are scaled to the others; repeated rows have rates of their own; an empty table
gives an empty result; extra columns are kept by ``mix`` and not read otherwise.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import pack, staged, unpack

DOMAINS = ["clean", "poor", "toxic"]
TARGETS = {"clean": 0.85, "poor": 0.10, "toxic": 0.05}
#: The classifier is fitted to at most about this many labelled documents, the same number of every
#: domain as far as there are so many, chosen by a hash of their id and weighted by the share that was
#: drawn. Everything else covers all documents.
FIT_ROWS, FIT_TASKS = 20_000, 8
SLOTS = 1 << 12
RIDGE = 1e-3
STEPS, TOLERANCE = 40, 1e-7


def domain(quality: Column, toxic: Column) -> Column:
    return F.when(toxic == 1, "toxic").when(quality == 0, "poor").when(quality == 1, "clean")


def _words(text: str = "text") -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(f"`{text}`"), F.lit(""))), r"\s+"), "")


def _features(docs: DataFrame) -> DataFrame:
    """``docs`` with word counts hashed to slots and brought to length 1."""
    counted = HashingTF(inputCol="_words", outputCol="_tf", numFeatures=SLOTS).transform(docs)
    return Normalizer(inputCol="_tf", outputCol="_x").transform(counted)


def _labelled(labels: DataFrame) -> DataFrame:
    """(doc_id, _y), one row per document; ``_y`` counts up from the best domain."""
    rank = F.array_position(F.array(*[F.lit(d) for d in DOMAINS]),
                            domain(F.col("quality"), F.col("toxic"))) - 1
    return (labels.select("doc_id", rank.cast("double").alias("_y"))
            .filter("doc_id IS NOT NULL AND _y IS NOT NULL").groupBy("doc_id")
            .agg(F.max("_y").alias("_y")))


def with_posteriors(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with ``_tokens`` and ``_p`` (one probability per domain), and the domains."""
    ids = docs.select("doc_id").filter("doc_id IS NOT NULL").distinct()
    known = staged(_labelled(labels).join(ids, "doc_id", "left_semi").coalesce(FIT_TASKS), "mix-labels")
    present = {int(r["_y"]): r["count"] for r in known.groupBy("_y").count().collect()}
    domains = [DOMAINS[y] for y in sorted(present)] or DOMAINS[:1]
    if len(domains) == 1:
        return docs.withColumn("_tokens", F.size(_words()).cast("long")).withColumn(
            "_p", F.array(F.lit(1.0))), domains
    shares = [min(1.0, FIT_ROWS / len(present) / present[y]) for y in sorted(present)]
    place = F.array_position(F.array(*[F.lit(float(y)) for y in sorted(present)]), F.col("_y")).cast("int")
    share = F.element_at(F.array(*[F.lit(v) for v in shares]), place)
    # a domain has a labelled document at least, and the one of the smallest draw is always taken
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    least = known.groupBy("_y").agg(F.min(draw).alias("_least"))
    chosen = (known.join(F.broadcast(least), "_y").filter((draw < share) | (draw == F.col("_least")))  # three rows at most
              .select("doc_id", (place - 1).cast("double").alias("_y"), (1 / share).alias("_weight")))
    rows = staged(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # FIT_ROWS small rows
                  .groupBy("doc_id", "_y", "_weight").agg(F.min("text").alias("text")).withColumn("_words", _words())
                  .select("_words", "_y", "_weight").coalesce(FIT_TASKS), "mix-fit")
    model = LogisticRegression(featuresCol="_x", labelCol="_y", weightCol="_weight", probabilityCol="_prob",
                               rawPredictionCol="_raw", predictionCol="_pred", maxIter=30,
                               regParam=1e-4, family="multinomial").fit(_features(rows))
    scored = model.transform(_features(docs.withColumn("_words", _words())))
    return (scored.withColumn("_tokens", F.size("_words").cast("long"))
            .withColumn("_p", vector_to_array("_prob"))
            .drop("_words", "_tf", "_x", "_prob", "_raw", "_pred")), domains


def rate(u: list[float]) -> Column:
    """A document's rate from its posterior ``_p``."""
    return F.greatest(F.lit(0.0), sum((F.lit(float(v)) * F.col("_p")[d] for d, v in enumerate(u)), F.lit(1.0)))


def fit_rates(table: DataFrame, domains: list[str], targets: dict[str, float]) -> tuple[list[float], float]:
    """(the number per domain that gives the rates, what is left of the gradient); ``table`` is
    written and has ``_tokens`` and ``_p``."""
    n = len(domains)
    wanted = [max(targets.get(d, 0.0), 0.0) for d in domains]
    scale = sum(wanted) or 1.0
    wanted = np.array([w / scale for w in wanted])
    pairs = [(d, e) for d in range(n) for e in range(d, n)]

    def sums(u: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Shares of the domains at these rates, and second moments of the rows with a positive rate."""
        r, p = rate(u.tolist()), [F.col("_p")[d] for d in range(n)]
        row = table.agg(
            F.sum("_tokens").alias("total"), *[F.sum(F.col("_tokens") * r * p[d]).alias(f"s{d}") for d in range(n)],
            *[F.sum(F.when(r > 0, F.col("_tokens") * p[d] * p[e])).alias(f"m{d}_{e}") for d, e in pairs]).first()
        if not row["total"]:
            return None
        moments = np.zeros((n, n))
        for d, e in pairs:
            moments[d, e] = moments[e, d] = (row[f"m{d}_{e}"] or 0.0) / row["total"]
        return np.array([(row[f"s{d}"] or 0.0) / row["total"] for d in range(n)]), moments

    u = np.zeros(n)
    first = sums(u)
    if first is None:
        return u.tolist(), 0.0
    present = np.maximum(first[0], 1e-3)
    now, moments = first

    def gradient(at: np.ndarray, shares: np.ndarray) -> np.ndarray:
        return RIDGE * present * at + shares - wanted

    g = gradient(u, now)
    for _ in range(STEPS):
        if np.abs(g).max() < TOLERANCE:
            break
        move = np.linalg.solve(RIDGE * np.diag(present) + moments, -g)
        for part in (1.0, 0.5, 0.25, 0.1):   # a shorter step where the full one leads away
            found = sums(u + part * move)
            next_g = gradient(u + part * move, found[0])
            if np.abs(next_g).max() < np.abs(g).max():
                break
        u, (now, moments), g = u + part * move, found, next_g
    return u.tolist(), float(np.abs(g).max())


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None,
          keep: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """The columns ``keep`` of ``docs`` with ``_tokens``, ``_p`` and ``_rate``."""
    scored, domains = with_posteriors(docs, labels)
    columns = [F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]
    table = staged(scored.select(*columns, "_tokens", "_p"), "mix")
    u, _ = fit_rates(table, domains, TARGETS if targets is None else targets)
    return table.withColumn("_rate", rate(u)), domains


def copies(r: Column, *ids: Column) -> Column:
    """Whole copies of a document: the rate, rounded up or down by a hash of the document."""
    draw = F.pmod(F.xxhash64(*ids, F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(r) + (draw < r - F.floor(r)).cast("long")).cast("int")


def mixing_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: tokens, posterior, rate, copies."""
    table, domains = mixed(docs.select("doc_id", "text"), labels, keep=["doc_id"])
    p = [(F.col("_p")[domains.index(d)] if d in domains else F.lit(0.0)).alias(f"p_{d}")
         for d in DOMAINS]
    return table.select("doc_id", F.col("_tokens").alias("tokens"), *p, F.col("_rate").alias("rate"),
                        copies(F.col("_rate"), F.col("doc_id"), F.col("_tokens")).alias("copies"))


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """The mixed corpus: every document as often as its copies say, columns as in ``docs``."""
    packed, row = pack(docs, "doc_id", "text")
    table, _ = mixed(packed, labels, targets, keep=[row, "doc_id"])
    times = copies(F.col("_rate"), F.col("doc_id"), F.col("_tokens"))
    return unpack(table.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), times))), docs, row)
