"""Cases that break operators which are right on tidy tables: shuffled inputs, shared ids, rare
domains, hosts that differ, columns with the names of an operator's own, executors without the library."""

import hashlib
import os
import random
import subprocess
import sys
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import (
    components, decontaminate, importance, line_dedup, mixing, quality_rules, secret_scan, sharding, simhash,
    warc,
)
from tablewright.llm.words import word_hashes

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
CLEAN = ("this is a plain sentence of many different words that tells about nothing at all, goes on for a while,"
         " and then ends quietly with number {}")


# ---- archives of shuffled tables ----

@pytest.mark.parametrize("shuffle", ["repartition", "distinct", "ids"])
def test_every_payload_has_its_response(spark, shuffle):
    rng = random.Random(2)
    bodies = ["".join(rng.choice("abcdef <p>é") for _ in range(rng.choice([30, 1500]))) for _ in range(40)]
    rows = [(i, f"http://h/{i}", bodies[i % 40]) for i in range(160)] + [(None, "http://n", bodies[3]), (7, "http://again", bodies[7])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    if shuffle == "repartition":
        pages = pages.repartition(5)
    elif shuffle == "distinct":
        pages = pages.unionByName(pages).distinct()
    else:
        pages = pages.withColumn("page_id", F.lit(5).cast("long")).repartition(7)
        rows = [(5, u, h) for _, u, h in rows]
    found = warc.capture_report(pages).collect()
    members = defaultdict(list)
    for page_id, _, html in rows:
        members[hashlib.sha1(html.encode()).hexdigest(), len(html.encode())].append(page_id)
    assert len(found) == len(rows)
    for (digest, size), ids in members.items():
        own = [r for r in found if r["payload_digest"] == digest]
        assert Counter(r["page_id"] for r in own) == Counter(ids) and {r["payload_bytes"] for r in own} == {size}
        kept = [r["page_id"] for r in own if r["record_type"] == "response"]
        last = max(i for i in ids if i is not None)
        assert kept == [last] if size >= 1000 else len(kept) == len(ids)
        assert all(r["refers_to"] == (last if r["record_type"] == "revisit" else None) for r in own)


# ---- lines of documents that share an id ----

def test_line_dedup_of_shared_ids(spark):
    passage = [f"passage line {k} with words" for k in range(3)]
    one = ["first of its own", *passage, "one ends"]
    two = ["second of its own", "has", "other", "lines", "here"]
    three = [*passage, "three ends"]
    rows = [(2, "\n".join(one)), (2, "\n".join(two)), (5, "\n".join(three)), (5, "\n".join(three))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = Counter((r["doc_id"], r["text"], r["_removed"]) for r in line_dedup.remove_repeats(df).collect())
    assert left == Counter({(2, "\n".join(one), 0): 1, (2, "\n".join(two), 0): 1, (5, "three ends", 3): 2})


# ---- hosts ----

def test_hosts_of_all_three_verdicts(spark):
    bad = "### $$$ %%% &&& ||| odd {} " + " ".join(f"w{i}" for i in range(19))
    rows = []
    for host, n, failures in (("good", 900, 9), ("fair", 900, 20), ("poor", 300, 120), ("worst", 300, 290), ("tiny", 2, 2)):
        rows += [(len(rows) + i, (bad if i < failures else CLEAN + " and so on").format(i), host) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    judged = quality_rules.judge(docs).select("doc_id", "text", "source", "_verdict", "_base", "_failed", "_kept").collect()
    verdicts = {r["source"]: r["_verdict"] for r in judged}
    assert verdicts == {"good": "allow", "fair": "allow", "poor": "review", "worst": "deny", "tiny": "allow"}
    for r in judged:
        fate = {"allow": not r["_base"], "review": not r["_failed"], "deny": False}[r["_verdict"]]
        assert r["_kept"] == fate
    # the same text stays on one host and goes on another
    assert {r["_kept"] for r in judged if r["text"].startswith("#") and not r["_base"]} == {True, False}
    assert {r["_kept"] for r in judged if r["text"].startswith("this")} == {True, False}
    none = quality_rules.judge(docs.filter("source = 'good' AND text LIKE 'this%'")).select("_verdict").distinct().collect()
    assert [r["_verdict"] for r in none] == ["allow"]


# ---- mixing ----

def test_a_rare_domain_stays(spark):
    words = {"clean": "calm clear sound", "poor": "junk spam noise", "toxic": "vile foul nasty"}
    rows = [(i, (words["clean"] if i % 2 else words["poor"]) + f" t{i % 9}") for i in range(6000)]
    rows += [(6000 + i, words["toxic"] + f" t{i}") for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int("junk" not in t), int("vile" in t)) for i, t in rows] + [(7000, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    before = mixing.FIT_ROWS
    mixing.FIT_ROWS = 60     # far fewer than there are labels: two of 6002 are toxic
    try:
        table, domains = mixing.mixed(docs, labels)
        found = table.collect()
    finally:
        mixing.FIT_ROWS = before
    assert domains == mixing.DOMAINS
    assert all(r["_p"][2] > 0.5 for r in found if "vile" in r["text"])


def test_mixing_totals(spark, sf):
    """The expected tokens of every domain match the targets; no rate is below zero."""
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = mixing.mixing_report(docs, labels).collect()
    total = sum(r["tokens"] for r in rows)
    for d, wanted in mixing.TARGETS.items():
        share = sum(r["tokens"] * r["rate"] * r[f"p_{d}"] for r in rows) / total
        assert abs(share - wanted) < 0.005
    assert min(r["rate"] for r in rows) >= 0
    left = mixing.fit_rates(mixing.mixed(docs, labels)[0], mixing.DOMAINS, {"clean": 0.2, "poor": 0.8})[1]
    assert left < mixing.TOLERANCE   # far targets too: toxic text gets the rate zero


# ---- columns of the user ----

OWN = ["_p", "_tokens", "_words", "_x", "_rate", "_copy", "_q", "_w", "_l", "_host", "_failed", "_kept", "_fp", "_key",
       "_row", "_id", "_rank", "_place", "_arc", "_shard", "_slot", "_gone", "_removed", "_text", "_hash", "_score", "doc.id",
       "text_key", "rank", "n"]


@pytest.fixture(scope="module")
def crowded(spark):
    rows = [(i, CLEAN.format(i % 12) + "\nline", f"h{i % 3}", *[f"{c} {i}" for c in OWN]) for i in range(24)]
    fields = ", ".join(["doc_id long", "text string", "source string", *[f"`{c}` string" for c in OWN]])
    return spark.createDataFrame(rows, fields)


@pytest.mark.parametrize("name", ["rules", "copies", "benchmark", "mix", "shards", "lines", "sample", "secrets"])
def test_own_columns_survive(spark, crowded, name):
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 5 == 0)) for i in range(24)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "a text that is in no document of this table at all")], "item_id long, text string")
    out = {"rules": lambda: quality_rules.apply_rules(crowded), "copies": lambda: simhash.one_of_each(crowded),
           "benchmark": lambda: decontaminate.clean(crowded, bench), "mix": lambda: mixing.mix(crowded, labels),
           "shards": lambda: sharding.shard_documents(crowded, 4), "lines": lambda: line_dedup.remove_repeats(crowded),
           "sample": lambda: importance.resample(crowded, bench, least_words=5),
           "secrets": lambda: secret_scan.with_findings(crowded)}[name]()
    assert out.columns[:len(crowded.columns)] == crowded.columns
    rows = out.collect()
    assert rows
    for r in rows:
        assert [r[c] for c in OWN] == [f"{c} {r['doc_id']}" for c in OWN]


# ---- decontamination ----

def test_paraphrases_are_found(spark):
    """Items with a tenth to a quarter of their words replaced, in long documents: recall of what
    the word checks accept by brute force over all windows."""
    rng = random.Random(11)
    vocabulary = [f"word{i}" for i in range(3000)]
    items = [[rng.choice(vocabulary) for _ in range(rng.choice([12, 24, 40, 64]))] for _ in range(40)]
    rows, expected = [], set()
    for i in range(240):
        item = i % 40
        changed = [rng.choice(vocabulary) if rng.random() < (0.1, 0.2, 0.24)[i % 3] else w for w in items[item]]
        filler = [rng.choice(vocabulary) for _ in range(200)]
        at = rng.randrange(200)
        words = filler[:at] + changed + filler[at:]
        rows.append((i, " ".join(words)))
        own = word_hashes(" ".join(items[item])).tolist()
        if decontaminate.common_subsequence(own, word_hashes(" ".join(changed)).tolist()) >= decontaminate.SURE * len(own):
            expected.add((i, item))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect()}
    assert len(expected) > 150 and len(expected & found) >= 0.95 * len(expected)
    assert all(item == doc % 40 for doc, item in found)


# ---- components ----

def test_components_against_brute_force(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 200)]
    links += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)]
    root = {x: x for link in links for x in link}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed = changed or root[a] != low or root[b] != low
            root[a] = root[b] = low
    df = spark.createDataFrame(links, "a long, b long")
    found = {r["node"]: r["root"] for r in components.components(df).collect()}
    assert found == {x: r for x, r in root.items() if x in found}
    assert set(root) - set(found) == {x for x in root if all(a == b for a, b in links if x in (a, b))}
    assert components.components(df.limit(0)).collect() == []


# ---- executors without the library ----

ALONE = """
import os, sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
from tablewright.llm.queries import QUERIES
for name in ("op1_decontaminate", "op2_language_id", "op3_quality_classifier", "op11_importance_resampling", "op13_phrase_mining"):
    print(name, QUERIES[name](spark, {sf!r}).count())
"""


def test_executors_need_no_library(sf, tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", ALONE.format(repo=REPO, sf=sf)], env=env, cwd=tmp_path,
                          capture_output=True, text=True, timeout=400)
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.count("op") >= 5


# ---- the latent space ----

def test_latent_space_is_fitted_to_all_documents(spark, monkeypatch):
    docs = spark.range(6000).selectExpr("id AS doc_id", "concat('one two three four five w', id) AS text")
    bench = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    read, summed = [], decontaminate._summed
    monkeypatch.setattr(decontaminate, "_summed", lambda rows, *a: read.append(rows.count()) or summed(rows, *a))
    space = decontaminate.latent_space(docs, bench, np.ones(decontaminate.SLOTS))
    assert read == [6001] * 3 and space.shape == (decontaminate.SLOTS, decontaminate.RANK)


def test_summed_products_against_a_matrix(spark):
    rng = np.random.default_rng(5)
    texts = ["", " ".join(f"w{i}" for i in rng.integers(0, 50, 150)), "a b a"] * 3
    idf, right = rng.random(decontaminate.SLOTS) + 0.1, rng.normal(size=(decontaminate.SLOTS, 4)).astype(np.float32)
    expected = np.zeros(right.shape)
    for text in texts:
        for passage in decontaminate._passages(word_hashes(text)):
            row = np.bincount(decontaminate.slots_of(passage), minlength=decontaminate.SLOTS) * idf
            row *= 2.0 / np.linalg.norm(row)
            expected += np.outer(row, row @ right)
    rows = spark.createDataFrame([(t, 2.0) for t in texts], "text string, weight double")
    assert np.allclose(decontaminate._summed(rows, idf, right), expected, atol=1e-4)


def test_last_pass_over_passages_only_sums_small_products(spark):
    rng = np.random.default_rng(6)
    rows = spark.createDataFrame([(" ".join(f"w{i}" for i in rng.integers(0, 90, 150)), 2.0) for _ in range(9)],
                                 "text string, weight double")
    idf, right = rng.random(decontaminate.SLOTS) + 0.1, rng.normal(size=(decontaminate.SLOTS, 4)).astype(np.float32)
    expected = right.T @ decontaminate._summed(rows, idf, right)
    small = decontaminate._summed(rows, idf, right, True)
    assert small.shape == (4, 4) and np.allclose(small, expected, rtol=1e-4)


def test_fitting_the_latent_space_takes_few_copies_on_the_driver(spark):
    """A copy of the space in doubles takes 17 MB; the driver holds some in single precision."""
    docs = spark.range(50).selectExpr("id AS doc_id", "concat('one two three four five w', id) AS text")
    bench = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    tracemalloc.start()
    try:
        space = decontaminate.latent_space(docs, bench, np.ones(decontaminate.SLOTS))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert np.isfinite(space).all() and peak < 45e6
    assert np.allclose(decontaminate.orthonormal(space).T @ decontaminate.orthonormal(space),
                       np.eye(decontaminate.RANK), atol=1e-4)


def test_sums_of_passages_come_from_a_task_per_core(spark):
    """Each task hands over sums of a fixed size, so their number may not grow with the input's partitions."""
    texts = [f"a b c w{i} w{i % 7}" for i in range(300)]
    rows = spark.createDataFrame([(t, 1.0) for t in texts], "text string, weight double").repartition(60)
    idf, right = np.ones(decontaminate.SLOTS), np.ones((decontaminate.SLOTS, 2), np.float32)
    few = decontaminate.few_tasks(decontaminate.slot_rows(rows).select("weight", "slots"))
    given = few.mapInArrow(decontaminate._product(idf, right), "block int, v binary")
    assert given.count() <= spark.sparkContext.defaultParallelism * (decontaminate.SLOTS // decontaminate.SLOT_BLOCK)


def test_windows_without_enough_words_are_the_only_ones_left_out():
    """Against a search that compares every window of every part."""
    rng = np.random.default_rng(11)
    space = rng.normal(size=(decontaminate.SLOTS, decontaminate.RANK)).astype(np.float32)
    word = lambda n: " ".join(f"w{i}" for i in rng.integers(0, 60, n))
    items = decontaminate.Items([(i, word(n)) for i, n in enumerate((7, 15, 16, 40, 64, 130) * 8)], space)
    step, found_any = decontaminate.STEP, False
    for n in (5, 9, 16, 63, 200, 700):
        hashes = word_hashes(word(n) + " " + " ".join(f"v{i}" for i in range(n % 5)))
        slots = decontaminate.slots_of(hashes)
        found = decontaminate.candidates(hashes, space, items)
        got = {(p, at) for p, at, _, _ in (decontaminate.possible(hashes, found, items) if found else [])}
        expected = set()
        for part, length in enumerate(items.lengths.tolist()):
            own = decontaminate.slots_of(np.array(items.words[part], dtype=np.uint64))
            vector = space[own].sum(axis=0)
            brief = length < decontaminate.SHORT
            width = min(length, len(slots)) if brief else min(items.steps[part], -(-len(slots) // step)) * step
            last = len(slots) - width if brief else max(0, -(-len(slots) // step) * step - width)
            for at in range(0, last + 1, 1 if brief else step):
                window = space[slots[at:at + width]].sum(axis=0)
                cosine = window @ vector / np.linalg.norm(window) / np.linalg.norm(vector)
                region = np.isin(slots[max(0, at - step):at + width + step], own).sum()
                if (cosine >= decontaminate.COSINE and region >= decontaminate.LIKELY * length
                        and np.isin(own, slots).sum() >= decontaminate.LIKELY * length):
                    expected.add((part, at))
        assert got == expected
        found_any = found_any or len(got) > 0
    assert found_any


def test_documents_without_an_answer_need_more_words_and_lose_no_match():
    rng = np.random.default_rng(12)
    space = rng.normal(size=(decontaminate.SLOTS, decontaminate.RANK)).astype(np.float32)
    bodies = [[f"b{i}x{j}" for j in range(n)] for i, n in enumerate((6, 12, 20, 40, 90))]
    items = decontaminate.Items([(i, " ".join(b) + f". a{i}p a{i}q a{i}r a{i}s a{i}t") for i, b in enumerate(bodies)], space)
    verdicts, left_out = set(), 0
    for i, body in enumerate(bodies):
        for share in (0.4, 0.6, 0.8, 1.0):
            for answer in ("", f"a{i}p a{i}q", f"a{i}p a{i}q a{i}r a{i}t"):
                hashes = word_hashes(" ".join([*"uvwxyz" * 7, *body[:int(share * len(body))], answer, *"klmno" * 6]))
                every = decontaminate.candidates(hashes, space, items)
                some = decontaminate.candidates(hashes, space, items, matches=True)
                matches = decontaminate.check(hashes, every, items)
                assert decontaminate.check(hashes, some, items) == matches
                verdicts.add(bool(matches))
                left_out += sum(len(f[0]) for f in every) - sum(len(f[0]) for f in some)
    assert verdicts == {True, False} and left_out > 0
