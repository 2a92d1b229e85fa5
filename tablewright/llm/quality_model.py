"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

A text is a vector of statistics (``STATISTICS``), standardised over the whole corpus. Random
Fourier features approximate a Gaussian kernel over them. The normal equations of a ridge
regression on the labels are summed per partition and then over partitions; the solved scores
are calibrated by isotonic regression on labelled rows that the regression has not seen.

Learned from are the labelled rows that are not held out: those with remainder 1 to 3 for the
regression, those with remainder 4 for the calibration. All of them are used.

Defined results: null and empty texts have the statistics zero and a score like any other
text; labels that are null, repeated labels of a document (the lowest counts), and labels of
documents without an id or a row do no harm; without labels of both classes every score is the
share of good labels (0.5 without labels). Repeated rows are scored one by one, extra columns
are not read, an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import held_out, shared, ship_with_job, staged

STATISTICS = ["log_chars", "log_words", "word_length", "word_length_spread", "distinct_words",
              "adjacent_repeats", "top_word", "short_words", "upper", "digits", "symbols", "bars",
              "exclamations", "stops", "commas", "not_ascii", "line_length", "repeated_lines"]
FEATURES = 256
SEED = 7
RIDGE = 1e-3
BINS = 400
LOW, HIGH = -0.5, 1.5
THRESHOLD = 0.3


def statistics(text: str | None) -> list[float]:
    text = text or ""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, chars = len(words), len(text)
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=n)
    seen = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8), minlength=256)
    letters = max(int(raw[65:91].sum() + raw[97:123].sum() + raw[192:].sum()), 1)
    return [
        float(np.log1p(chars)), float(np.log1p(n)), float(lengths.mean()), float(lengths.std()),
        len(seen) / n, sum(a == b for a, b in zip(words, words[1:])) / n, max(seen.values()) / n,
        float((lengths <= 3).mean()), raw[65:91].sum() / letters, raw[48:58].sum() / chars,
        sum(int(raw[ord(c)]) for c in "#$%&*<>") / n, raw[124] / n, raw[33] / n, raw[46] / n, raw[44] / n,
        raw[192:].sum() / chars, float(np.log1p(chars / max(len(lines), 1))),
        1 - len(set(lines)) / max(len(lines), 1)]


def _measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"),
                            "x": [statistics(t) for t in batch["text"]]})


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, x), written once; the texts are read a single time."""
    ship_with_job()
    return staged(docs.select("doc_id", "text").mapInPandas(_measure, "doc_id long, x array<double>"),
                  "statistics")


class Kernel:
    """The feature map: standardisation and random Fourier features, with a constant."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray):
        self.mean, self.scale = mean, scale
        draw = np.random.default_rng(SEED)
        self.weights = draw.normal(size=(len(mean), FEATURES)) / np.sqrt(len(mean))
        self.phase = draw.uniform(0, 2 * np.pi, FEATURES)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        waves = np.sqrt(2 / FEATURES) * np.cos(z @ self.weights + self.phase)
        return np.hstack([waves, np.ones((len(x), 1))])


def isotonic(counts: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Non-decreasing share of good labels per bin, by pooling neighbours that violate the
    order; bins without labels take the values between those of their neighbours."""
    used = np.nonzero(counts)[0]
    pools: list[list[float]] = []  # (labels, good labels, bins)
    for b in used:
        pools.append([counts[b], good[b], 1])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            n, g, k = pools.pop()
            pools[-1] = [pools[-1][0] + n, pools[-1][1] + g, pools[-1][2] + k]
    values = np.concatenate([[g / n] * int(k) for n, g, k in pools])
    return np.interp(np.arange(len(counts)), used, values)


class QualityModel:
    def __init__(self, kernel, weights, curve):
        self.kernel, self.weights, self.curve = kernel, weights, curve

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.kernel(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.curve)
        at = np.clip((self.raw(x) - LOW) / (HIGH - LOW), 0, 1) * (BINS - 1)
        return np.clip(np.interp(at, np.arange(BINS), self.curve), 0, 1)


def _matrix(values: pd.Series) -> np.ndarray:
    return np.array(values.tolist(), dtype=np.float64).reshape(len(values), len(STATISTICS))


def fit(table: DataFrame, labels: DataFrame) -> QualityModel:
    """Learn from the written statistics ``table`` and the labels (doc_id, quality)."""
    ship_with_job()
    width = range(len(STATISTICS))
    row = table.agg(*[F.avg(F.col("x")[i]).alias(f"m{i}") for i in width],
                    *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in width]).first()
    kernel = Kernel(np.array([row[f"m{i}"] or 0.0 for i in width]),
                    np.array([row[f"s{i}"] or 1.0 for i in width]))
    known = (labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id")
             .agg(F.min("quality").cast("double").alias("y")))
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    rows = staged(table.join(known, "doc_id").withColumn("part", part.cast("int"))
                  .filter("part != 0").select("x", "y", "part"), "labelled")
    classes = rows.agg(F.min("y").alias("a"), F.max("y").alias("b"), F.avg("y").alias("m")).first()
    if classes["a"] is None or classes["a"] == classes["b"]:
        return QualityModel(kernel, None, 0.5 if classes["m"] is None else float(classes["m"]))

    def normal_equations(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            z = kernel(_matrix(batch["x"]))
            block = z.T @ np.hstack([z, batch["y"].to_numpy()[:, None]])
            total = block if total is None else total + block
        if total is not None:
            yield pd.DataFrame({"i": np.arange(len(total)), "v": list(total)})

    def added(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": group["i"].iloc[:1], "v": [np.sum(group["v"].tolist(), axis=0)]})

    # one row of the system per partition and feature; a group has a row per partition
    fitting = rows.filter("part != 4")
    if fitting.isEmpty():
        fitting = rows
    system = (fitting.select("x", "y").mapInPandas(normal_equations, "i int, v array<double>")
              .groupBy("i").applyInPandas(added, "i int, v array<double>").toPandas().sort_values("i"))
    whole = np.array(system["v"].tolist())
    size = len(whole)
    count = whole[-1, size - 1]
    weights = np.linalg.solve(whole[:, :size] + RIDGE * count * np.eye(size) / FEATURES, whole[:, size])

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, good = np.zeros(BINS), np.zeros(BINS)
        for batch in batches:
            raw = kernel(_matrix(batch["x"])) @ weights
            at = np.rint(np.clip((raw - LOW) / (HIGH - LOW), 0, 1) * (BINS - 1)).astype(int)
            n += np.bincount(at, minlength=BINS)
            good += np.bincount(at, weights=batch["y"], minlength=BINS)
        yield pd.DataFrame({"bin": np.arange(BINS), "n": n, "good": good})

    calibration = rows.filter("part = 4")
    if calibration.isEmpty():
        calibration = rows
    bins = (calibration.select("x", "y").mapInPandas(binned, "bin int, n double, good double")
            .groupBy("bin").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
            .toPandas().sort_values("bin"))
    return QualityModel(kernel, weights, isotonic(bins["n"].to_numpy(), bins["good"].to_numpy()))


def predict(table: DataFrame, model: QualityModel) -> DataFrame:
    ship_with_job()
    held = shared(table.sparkSession, model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = held()
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"),
                                    "score": known.score(_matrix(batch["x"]))})

    return table.mapInPandas(run, "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: score and prediction."""
    table = measured(docs)
    return predict(table, fit(table, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
