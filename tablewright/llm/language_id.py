"""Language identification by nearest centroids.

A text is the vector of its hashed byte n-grams (letters only, in lower case), weighted by
tf-idf and brought to length 1. Every language has several centroids, found by spherical
k-means among its training vectors. A text belongs to the language of its nearest centroid by
cosine; it is rejected (``rejected``, lower score) if it is further away from that centroid
than nearly all training texts were from theirs.

Document frequencies are counted over all training rows. The centroids are fitted on the
driver to at most about ``FIT_ROWS`` training rows, dealt evenly to the languages and chosen by
a hash of the id.

Defined results: a null text and a text without a letter give ``und`` with score 0, and so
does every text if nothing could be learned. Rows without a language or an id are never
learned from; rows without an id count as held out. Repeated rows are predicted one by one,
ties go to the language that sorts first, extra columns are not read, an empty table gives an
empty result. Whole texts are read, in pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import held_out, shared, ship_with_job

SLOTS = 1 << 12
FIT_ROWS = 2000
CENTROIDS = 4
ROUNDS = 12
#: A text is rejected below this quantile of the training cosines of its centroid.
REJECT_QUANTILE = 0.002
TEMPERATURE = 0.05
_PIECE = 1 << 20
_LETTER = re.compile(r"[^\W\d_]")
# A-Z in lower case, other ASCII than letters to a blank, bytes of longer characters as they are
_FOLD = np.array([c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32
                  for c in range(256)], dtype=np.uint32)


def gram_counts(text: str) -> np.ndarray:
    """Counts of the hashed bigrams and trigrams of the text's bytes."""
    data = (" " + text + " ").lower().encode("utf-8", "surrogatepass")
    counts = np.zeros(SLOTS, dtype=np.int64)
    for at in range(0, len(data), _PIECE):
        b = _FOLD[np.frombuffer(data[at:at + _PIECE + 2], dtype=np.uint8)]
        two = b[:-1] * np.uint32(257) + b[1:]
        three = two[:-1] * np.uint32(263) + b[2:]
        for grams, plain in ((two[:_PIECE], (b[:-1] != 32) & (b[1:] != 32)),
                             (three[:_PIECE], b[1:-1] != 32)):
            slots = (grams * np.uint32(2654435761)) >> np.uint32(20)
            counts += np.bincount(slots[plain[: len(slots)]], minlength=SLOTS)
    return counts


def vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    return v / max(np.sqrt((v * v).sum()), 1e-12)


def _document_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen, rows = np.zeros(SLOTS, dtype=np.int64), 0
    for batch in batches:
        for text in batch["text"]:
            seen += gram_counts(text) > 0
            rows += 1
    if rows:
        yield pd.DataFrame({"slot": np.arange(SLOTS + 1), "n": np.append(seen, rows)})


def cluster(rows: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from centres that lie far apart: centroids and, for each, the cosine
    below which a text is rejected."""
    centres = [rows.mean(axis=0)]
    nearest = rows @ centres[0]
    for _ in range(min(count, len(rows)) - 1):
        centres.append(rows[int(nearest.argmin())])
        nearest = np.maximum(nearest, rows @ centres[-1])
    centre = np.array(centres)
    for _ in range(ROUNDS):
        own = (rows @ centre.T).argmax(axis=1)
        # an empty cluster keeps its centre
        centre = np.array([rows[own == c].mean(axis=0) if (own == c).any() else centre[c]
                           for c in range(len(centre))])
        centre /= np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-12)
    cosines = rows @ centre.T
    own = cosines.argmax(axis=1)
    least = [np.quantile(cosines[own == c, c], REJECT_QUANTILE) if (own == c).any() else 1.0
             for c in range(len(centre))]
    return centre, np.array(least)


class Centroids:
    """What was learned: inverse document frequencies, centroids, their languages and limits."""

    def __init__(self, idf, centres, langs, limits):
        self.idf, self.centres, self.langs, self.limits = idf, centres, langs, limits
        self.names = sorted(set(langs))
        self.member = np.array([[lang == name for lang in langs] for name in self.names])

    def predict(self, text: str | None) -> tuple[str, float, float, bool]:
        if text is None or not self.names or not _LETTER.search(text):
            return "und", 0.0, 0.0, True
        cosines = self.centres @ vector(gram_counts(text), self.idf)
        best = np.where(self.member, cosines[None, :], -1.0)
        by_lang = best.max(axis=1)
        lang = int(by_lang.argmax())
        weights = np.exp((by_lang - by_lang.max()) / TEMPERATURE)
        near = int(best[lang].argmax())
        rejected = bool(cosines[near] < self.limits[near])
        score = float(weights[lang] / weights.sum()) * (0.5 if rejected else 1.0)
        return self.names[lang], min(max(score, 0.0), 1.0), float(cosines[near]), rejected


def fit(docs: DataFrame) -> Centroids:
    """Learn from ``text`` and ``lang`` of the rows that are not held out."""
    ship_with_job()
    known = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    langs = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    seen = np.zeros(SLOTS + 1)
    for r in (known.select("text").mapInPandas(_document_counts, "slot int, n long")
              .groupBy("slot").agg(F.sum("n").alias("n")).collect()):  # one row per slot
        seen[r["slot"]] = r["n"]
    idf = np.log((1 + seen[-1]) / (1 + seen[:-1])) + 1
    if not langs:
        return Centroids(idf, np.zeros((0, SLOTS)), [], np.zeros(0))
    quota = max(1, FIT_ROWS // len(langs))
    share = F.lit(0.0)
    for lang, count in langs.items():
        share = F.when(F.col("lang") == lang, min(1.0, quota / count)).otherwise(share)
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 20)) / float(1 << 20)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [vector(gram_counts(t), idf).astype(np.float32).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"lang": batch["lang"], "v": made})

    rows = known.filter(draw < share).select("lang", "text").mapInPandas(
        vectors, "lang string, v binary").toPandas()  # about FIT_ROWS rows
    centres, names, limits = [], [], []
    for lang, group in sorted(rows.groupby("lang")):
        found, least = cluster(np.stack([np.frombuffer(v, np.float32) for v in group["v"]])
                               .astype(np.float64), CENTROIDS)
        centres.append(found)
        limits.append(least)
        names += [lang] * len(found)
    if not centres:
        return Centroids(idf, np.zeros((0, SLOTS)), [], np.zeros(0))
    return Centroids(idf, np.concatenate(centres), names, np.concatenate(limits))


def predict(docs: DataFrame, model: Centroids) -> DataFrame:
    """``doc_id`` and the predictions, for every row of ``docs``."""
    ship_with_job()
    held = shared(docs.sparkSession, model)  # a few vectors per language

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = held()
        for batch in batches:
            found = [known.predict(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"),
                                "lang_pred": [f[0] for f in found], "score": [f[1] for f in found],
                                "cosine": [f[2] for f in found], "rejected": [f[3] for f in found]})

    return docs.select("doc_id", "text").mapInPandas(
        run, "doc_id long, lang_pred string, score double, cosine double, rejected boolean")


def language_report(docs: DataFrame) -> DataFrame:
    found = predict(docs, fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score",
                        "rejected", "cosine")
