"""The corpus pipeline, stage by stage, against brute force on the smallest tables."""

import re
from collections import Counter, defaultdict

import pytest
import xxhash

import corpus_pipeline
from tablewright.llm import decontaminate, mixing, quality_rules, sharding
from tablewright.llm.words import word_hashes


@pytest.fixture(scope="module")
def outputs(spark, sf, tmp_path_factory):
    """Rows of ``documents`` and of every stage, each stage's result written and read again."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, found = docs.columns, [docs.collect()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        found.append(docs.collect())
    return found


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def measures(text):
    words, lines = spaced(text), [x for x in (text or "").split("\n") if spaced(x)]
    windows, covered = defaultdict(list), set()
    for i in range(len(words) - 7):
        windows[tuple(words[i:i + 8])].append(i)
    for places in windows.values():
        if len(places) > 1:
            covered.update(i + k for i in places for k in range(8))
    n, chars = len(words), sum(map(len, words))
    base = n < 20 or 100 * len(covered) > 30 * n
    symbols, repeated = len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines))
    return base, base or 10 * symbols > 3 * n or 10 * repeated > 3 * len(lines) or chars < 2 * n or chars > 15 * n


def test_quality_stage(outputs):
    rows = [(r["doc_id"], r["source"] or "", *measures(r["text"])) for r in outputs[0]]
    n, failed = Counter(r[1] for r in rows), Counter(r[1] for r in rows if r[3])
    mean = sum(failed.values()) / len(rows)
    variance = sum(n[h] * (failed[h] / n[h] - mean) ** 2 for h in n) / len(rows)
    strength = mean * (1 - mean) / variance - 1 if variance > 0 else quality_rules.MOST_STRENGTH
    strength = min(max(strength, quality_rules.LEAST_STRENGTH), quality_rules.MOST_STRENGTH)
    least = {}
    for h in n:
        rate = (mean * strength + failed[h]) / (strength + n[h])
        least[h] = rate - quality_rules.SURE * (rate * (1 - rate) / (strength + 1 + n[h])) ** 0.5
    deny, review = (max(floor, k * mean / (1 + (k - 1) * mean)) for k, floor in
                    ((quality_rules.DENY, quality_rules.LEAST_DENY), (quality_rules.REVIEW, quality_rules.LEAST_REVIEW)))
    kept = [i for i, h, base, bad in rows if not base and least[h] < deny and not (bad and least[h] >= review)]
    assert sorted(r["doc_id"] for r in outputs[1]) == sorted(kept) and kept


def fingerprint(text):
    words = spaced("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if words and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicate_stage(outputs):
    rows = [(r["doc_id"], fingerprint(r["text"])) for r in outputs[1]]
    root = {i: i for i, _ in rows}
    changed = True
    while changed:
        changed = False
        for i, p in rows:
            for j, q in rows:
                if root[j] < root[i] and (p ^ q).bit_count() <= 4:
                    root[i], changed = root[j], True
    assert sorted(r["doc_id"] for r in outputs[2]) == sorted(set(root.values()))


def test_decontamination_stage(spark, sf, outputs):
    """Documents that hold a whole item go; those without an item's words in order stay."""
    items = []
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        words = word_hashes(r["text"]).tolist()
        if len(words) >= decontaminate.LEAST_WORDS:
            items += [words[at:at + decontaminate.PART] for at in range(0, len(words), decontaminate.PART)]
    left = {r["doc_id"] for r in outputs[3]}
    seen = Counter()
    for r in outputs[2]:
        words = word_hashes(r["text"]).tolist()
        there = set(words)
        whole = near = False
        for item in items:
            if len(there & set(item)) < decontaminate.LIKELY * len(set(item)) * 0.5:
                continue
            whole = whole or len(item) > 9 and any(words[i:i + len(item)] == item for i in range(len(words)))
            near = near or decontaminate.common_subsequence(item, words) >= decontaminate.LIKELY * len(item)
        if whole or not near:
            seen[whole] += 1
            assert (r["doc_id"] in left) == (not whole)
    assert seen[True] and seen[False] > len(left) / 2


def test_mixing_stage(spark, sf, outputs):
    """A document comes as often as its rate, rounded up or down, and the targets are met."""
    docs = spark.createDataFrame(outputs[3], spark.read.parquet(f"{sf}/documents.parquet").schema)
    table, domains = mixing.mixed(docs, spark.read.parquet(f"{sf}/labels.parquet"), corpus_pipeline.TARGETS)
    rows = [(r["doc_id"], r["_tokens"], r["_p"], r["_rate"]) for r in table.collect()]
    total = sum(t for _, t, _, _ in rows)
    for d, domain in enumerate(domains):
        share = sum(t * r * p[d] for _, t, p, r in rows) / total
        assert abs(share - corpus_pipeline.TARGETS[domain]) < 0.02
    times = Counter(r["doc_id"] for r in outputs[4])
    assert set(times) <= {i for i, *_ in rows}
    assert all(int(r) <= times[i] <= int(r) + 1 for i, _, _, r in rows)
    assert all(times[i] for i, _, p, _ in rows if p[0] > 0.999)   # clean text stays; the target of poor text is none
    assert len(times) > 0.75 * len(rows)


def test_sharding_stage(outputs):
    shards = defaultdict(list)
    for r in outputs[5]:
        shards[r["shard"]].append(r["slot"])
    assert sum(map(len, shards.values())) == len(outputs[4])
    sizes = [len(shards[s]) for s in range(sharding.SHARDS)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in shards.values())
    assert Counter(r["doc_id"] for r in outputs[5]) == Counter(r["doc_id"] for r in outputs[4])


def test_an_earlier_result_outlives_a_later_run(spark, sf):
    first = corpus_pipeline.run(spark, sf)
    assert corpus_pipeline.run(spark, sf).count() == first.count() > 0
