"""The corpus operators against brute force on small tables, with the odd cases of each."""

import hashlib
import re
import zlib

import pytest
import xxhash

from tablewright.llm import (
    decontaminate, language_id, license_rules, license_scan, line_dedup, mixing, quality_model, quality_rules,
    sharding, simhash, warc,
)
from tablewright.plans import lookup

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho".split()
PROSE = [" ".join(WORDS[(i * k + i) % len(WORDS)] + str(i * k % 7) for i in range(60)) for k in range(1, 7)]
REPEATED = "one two three four five six seven eight nine ten"
TEXTS = [None, "", " \n\t ", *PROSE, PROSE[0], PROSE[1].replace(WORDS[3], "changed", 1),
         " ".join([REPEATED] * 5), "loud ### $$$ " * 20, "line a\nline b\nline a\n\nline b",
         "Released under the MIT License.\nApache License, Version 2.0", "12 34 !!", "x " * 9000, "über é ñ"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, shard int, _id long"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i % 7 == 6 else "en", None if i % 5 == 4 else f"s{i % 3}", 0, "clash", 1, 2)
            for i, t in enumerate(TEXTS)]
    rows += [(None, "no id here", "en", "s0", 0, None, None, None), rows[3]]  # and a repeated row
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, None if i == 4 else 0, "extra") for i in range(18)] + [(3, 0, 1, ""), (None, 1, 0, ""), (99, 1, 0, "")]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, source string")


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_quality_measures(docs, empty):
    found = rows_of(quality_rules.quality_report(docs))
    assert len(found) == docs.count()
    for r in found:
        text = TEXTS[r["doc_id"]] if r["doc_id"] is not None else "no id here"
        words = spaced(text)
        seen, covered = {}, set()
        for i in range(len(words) - 7):
            seen.setdefault(tuple(words[i:i + 8]), []).append(i)
        for places in seen.values():
            if len(places) > 1:
                covered.update(i + k for i in places for k in range(8))
        lines = [x for x in (text or "").split("\n") if spaced(x)]
        assert r["n_words"] == len(words) and r["word_chars"] == sum(map(len, words))
        assert r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text or ""))
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["n_repeat_words"] == len(covered)
        assert r["base_failed"] == (len(words) < 20 or 100 * len(covered) > 30 * len(words))
        assert not (r["base_failed"] and r["kept"])
    assert not rows_of(quality_rules.quality_report(empty))


def test_quality_rules_keep_columns(docs):
    kept = quality_rules.apply_rules(docs)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in rows_of(kept)}
    assert {3, 4, 5} <= ids and not ids & {0, 1, 2, 11, 12}


def test_license_scan(docs, empty):
    phrases = [(("mit", "license"), "mit"), (("apache", "license"), "apache"),
               (("general", "public", "license"), "gpl")]
    for r in rows_of(license_scan.license_report(docs)):
        text = TEXTS[r["doc_id"]] if r["doc_id"] is not None else "no id here"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [(i, label) for p, label in phrases for i in range(len(words)) if tuple(words[i:i + len(p)]) == p]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert r["first_word"] == min((i for i, _ in places), default=None)
        assert r["last_word"] == max((i for i, _ in places), default=None)
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert not rows_of(license_scan.license_report(empty))


def test_license_containment(spark):
    text = "GNU General Public License, version 3. SPDX-License-Identifier: MIT"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = license_scan.scan(df).first()["_spans"]
    # the family's plain name lies inside of the versioned one and goes
    assert [(s["l"], s["b"]) for s in spans] == [("gpl-3.0", 0), ("mit", text.index("SPDX"))]


def example(parsed, pick, blank):
    """A text that the parsed pattern matches; ``pick`` chooses among alternatives and repeats."""
    out = ""
    for kind, arg in parsed:
        kind = str(kind)
        if kind in ("LITERAL", "NOT_LITERAL"):
            out += chr(arg) if kind == "LITERAL" else "x"
        elif kind == "IN":
            if str(arg[0][0]) == "CATEGORY":
                out += {"CATEGORY_SPACE": blank, "CATEGORY_DIGIT": "1"}.get(str(arg[0][1]), "x")
            else:
                out += chr(arg[0][1][0] if str(arg[0][0]) == "RANGE" else arg[0][1])
        elif kind in ("MAX_REPEAT", "MIN_REPEAT"):
            least, most, inner = arg
            piece = example(inner, pick, blank)
            space = piece.isspace() or piece.startswith(blank)
            out += piece * (1 if space and most > 1 and least < 2 else least if pick % 2 else min(most, max(least, 1)))
        elif kind == "SUBPATTERN":
            out += example(arg[-1], pick, blank)
        elif kind == "BRANCH":
            out += example(arg[1][pick % len(arg[1])], pick, blank)
    return out


def test_license_rules_alone(spark):
    """Every rule finds its own examples, bare and wrapped, with nothing else in the text."""
    rows = []
    for rule in license_rules.rules():
        for pick in range(6):
            for blank in (" ", "\n", " \n  "):
                text = example(re._parser.parse(rule.pattern), pick, blank)
                if re.fullmatch(rule.pattern, text):
                    rows.append((rule.pattern, rule.keyword, text))
    assert {r[0] for r in rows} == {r.pattern for r in license_rules.rules()}
    assert all(keyword in text for _, keyword, text in rows)
    rows += [("", "", t) for t in (
        "CC BY-SA 4.0", "BSD-3-Clause", "cc0 1.0 universal", "wtfpl", "mit no attribution",
        "proprietary and confidential", "Permission is hereby granted, free of charge", "do what the fuck you\nwant",
        "as published by the Free Software Foundation", "affero general\npublic license version 3")]
    df = spark.createDataFrame([(i, r[2]) for i, r in enumerate(rows)], "doc_id long, text string")
    for r in license_scan.scan(df).collect():
        # its own match, or one that contains it
        assert any(s["b"] == 0 and s["e"] == len(r["text"]) for s in r["_spans"]) or not rows[r["doc_id"]][0], r
        assert r["_spans"], r


def test_license_sentences_wrapped(spark):
    """Sentences are found across line ends and the comment marks of the next line."""
    sentences = [("Permission is hereby granted, free of charge", "mit"),
                 ("as published by the Free Software Foundation", "gpl"),
                 ("released into the public domain", "public-domain"), ("All rights reserved", "all-rights-reserved"),
                 ("Redistribution and use in source and binary forms", "bsd"),
                 ("GNU General Public License", "gpl"), ("Mozilla Public License version 2.0", "mpl-2.0"),
                 ("you may not use this file except in compliance with the License", "apache-2.0"),
                 ("neither may be used to endorse or promote products derived from this software", "bsd-3-clause")]
    rows = [(label, mark, " ".join(words[:at]) + mark + " ".join(words[at:]))
            for sentence, label in sentences for words in [sentence.split()]
            for mark in ("\n", "\r\n", "\n * ", "\n# ", "\n // ", " \n;; ", "\n-- ") for at in range(1, len(words))]
    # words around what a rule matches may be cut off in any way
    df = spark.createDataFrame([(i, r[2]) for i, r in enumerate(rows)], "doc_id long, text string")
    for r in license_scan.scan(df).collect():
        assert rows[r["doc_id"]][0] in [s["l"] for s in r["_spans"]], r
    apart = spark.createDataFrame([(1, "all the rights are reserved"), (2, "general * public / license"),
                                   (3, "released into the domain")], "doc_id long, text string")
    assert not any(r["_spans"] for r in license_scan.scan(apart).collect())


def brute_fingerprint(text, width=4):
    words = spaced("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + width]).encode(), 42)
              for i in range(max(1, len(words) - width + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("small", [True, False])
def test_simhash_components(docs, empty, monkeypatch, small):
    if not small:
        monkeypatch.setattr(lookup, "BROADCAST_ROWS", 2)
    found = rows_of(simhash.near_duplicates(docs))
    prints = [int(r["fingerprint"], 16) for r in found]
    for r, p in zip(found, prints):
        assert p == brute_fingerprint(TEXTS[r["doc_id"]] if r["doc_id"] is not None else "no id here")
    group = list(range(len(found)))
    for _ in found:
        for i, p in enumerate(prints):
            for j, q in enumerate(prints):
                if (p ^ q).bit_count() <= 4:
                    group[i] = group[j] = min(group[i], group[j])
    for i, r in enumerate(found):
        ids = [found[j]["doc_id"] for j in range(len(found)) if group[j] == group[i]]
        assert r["component_id"] == (None if None in ids else min(ids))
    assert not rows_of(simhash.near_duplicates(empty))
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(group))


def test_pigeonhole_finds_every_link(spark):
    import random
    draw = random.Random(5)
    prints = [draw.getrandbits(64) for _ in range(60)]
    prints += [p ^ sum(1 << b for b in draw.sample(range(64), k)) for p in prints for k in (1, 3, 4, 5)]
    signed = [p - (1 << 64) if p >> 63 else p for p in set(prints)]
    nodes = spark.createDataFrame([(p,) for p in signed], "_fp long")
    found = {(r["a"], r["b"]) for r in simhash.links(nodes).collect()}
    mask = (1 << 64) - 1
    assert found == {(a, b) for a in signed for b in signed
                     if a < b and ((a ^ b) & mask).bit_count() <= 4}
    cost, chosen = simhash.thresholds([[1, 5, 9, 20, 40]] * 3, 4)
    assert sum(t + 1 for t in chosen) == 5 and cost == 11


@pytest.mark.parametrize("widths", [[(16, 0), (16, 1), (16, 0), (16, 0)], [(32, 1), (32, 2)], [(21, 1), (21, -1), (22, 2)]])
def test_links_of_plans_that_flip_bits(spark, monkeypatch, widths):
    """Plans of tables with millions of fingerprints: some values are probed within one or two bits."""
    import random
    draw = random.Random(6)
    prints = [draw.getrandbits(64) for _ in range(60)]
    prints += [p ^ sum(1 << b for b in draw.sample(range(64), k)) for p in prints for k in (1, 3, 4, 5)]
    signed = [p - (1 << 64) if p >> 63 else p for p in set(prints)]
    plan, at = [], 0
    for width, threshold in widths:
        plan += [(list(range(at, at + width)), threshold)] if threshold >= 0 else []
        at += width
    monkeypatch.setattr(simhash, "search_plan", lambda *given: plan)
    found = {(r["a"], r["b"]) for r in simhash.links(spark.createDataFrame([(p,) for p in signed], "_fp long")).collect()}
    mask = (1 << 64) - 1
    assert found == {(a, b) for a in signed for b in signed
                     if a < b and ((a ^ b) & mask).bit_count() <= 4}


@pytest.mark.parametrize("held", [1_000_000, 5])
def test_dense_groups_send_few_links(spark, monkeypatch, held):
    """700 fingerprints within 4 bits of a centre, and a chain; pairs within a group are far more than its rows."""
    import random
    monkeypatch.setattr(simhash, "HELD_NODES", held)
    draw = random.Random(9)
    dense = {0x0F0F ^ sum(1 << b for b in draw.sample(range(64), k)) for k in (1, 2) for _ in range(350)}
    chain = {(1 << 62) | ((1 << 56) - 1 - ((1 << k) - 1)) for k in range(0, 56, 4)}
    alone = {draw.getrandbits(62) | (1 << 63) for _ in range(20)}
    signed = [p - (1 << 64) if p >> 63 else p for p in dense | chain | alone]
    marked = spark.createDataFrame([(p,) for p in signed], "_fp long").selectExpr("_fp", "struct(_fp as k) as _key")
    pairs = simhash.links(marked.select("_fp")).coalesce(2).cache()
    few = simhash.spanning(pairs).collect()
    assert {(r["a"], r["b"]) for r in few} <= {(r["a"], r["b"]) for r in pairs.collect()}
    if held > len(signed):
        assert len(few) <= 2 * len(signed) < pairs.count() / 4
    found = {r["_fp"]: r["_first"]["k"] for r in simhash.classes(marked).collect()}
    linked = [(r["a"], r["b"]) for r in pairs.collect()]
    group, before = {p: p for p in signed}, {}
    while group != before:
        before = dict(group)
        for a, b in linked:
            group[a] = group[b] = min(group[a], group[b])
    assert found == group


def test_ring(docs, empty):
    found = rows_of(sharding.shard_report(docs, 4))
    counts = [sum(r["shard"] == s for r in found) for s in range(4)]
    assert sum(counts) == docs.count() and max(counts) - min(counts) <= 1
    for s in range(4):
        assert sorted(r["slot"] for r in found if r["shard"] == s) == list(range(counts[s]))
    for r in found:
        if r["doc_id"] is not None:
            data = None if TEXTS[r["doc_id"]] is None else TEXTS[r["doc_id"]].encode()
            assert r["size"] == len(data or b"") + 16
            assert r["text_crc32"] == (None if data is None else zlib.crc32(data))
    assert not rows_of(sharding.shard_report(empty))
    assert sharding.shard_documents(docs, 4).columns == [*docs.columns, "shard_", "slot"]


def test_bounded_loads_overflow_clockwise():
    assert sharding.deal([9, 1, 0], [0, 1, 2], [4, 4, 4]) == [[(0, 4), (1, 3), (2, 2)], [(1, 1)], []]
    with pytest.raises(ValueError):
        sharding.deal([9], [0], [4])


def test_mixing_reaches_targets(docs, labels, empty):
    found = rows_of(mixing.mixing_report(docs, labels))
    assert len(found) == docs.count() and all(r["rate"] >= 0 for r in found)
    assert all(abs(r["p_clean"] + r["p_poor"] + r["p_toxic"] - 1) < 1e-6 for r in found)
    assert not rows_of(mixing.mixing_report(empty, labels))
    alone = rows_of(mixing.mixing_report(docs, labels.limit(0)))
    assert all(abs(r["rate"] - 1) < 1e-6 and r["copies"] == 1 for r in alone)
    assert mixing.mix(docs, labels).columns == docs.columns


def test_line_dedup(spark, empty):
    passage = "\n".join(f"shared line number {i}" for i in range(30))
    rows = [(1, f"own start one\n{passage}\nend"), (2, f"another\nstart\n{passage}"), (2, f"another\nstart\n{passage}"),
            (3, None), (4, ""), (5, "single"), (None, passage)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = sorted((str(r["doc_id"]), r["text"] or "", r["_removed"]) for r in line_dedup.remove_repeats(df).collect())
    by_id = {i: (t, n) for i, t, n in left}
    assert by_id["1"] == (rows[0][1], 0) and by_id["None"] == (passage, 0) and by_id["5"][0] == "single"
    gone, start = by_id["2"][1], by_id["2"][0]
    assert gone > 15 and start.startswith("another\nstart") and len(start.split("\n")) + gone == 32
    assert not rows_of(line_dedup.dedup_report(empty))
    assert len(rows_of(line_dedup.dedup_report(df))) == len(rows)


def test_line_dedup_finds_every_short_passage(spark):
    """Planted passages of 2 to 6 lines: exactly the lines of brute force go."""
    rows = []
    for i in range(60):
        passage = [f"passage {i} line {k} " + " ".join(WORDS[(i + k + j) % len(WORDS)] for j in range(28))
                   for k in range(2 + i % 5)]
        for copy in range(2):
            own = [f"own line {i} {copy} {k}" for k in range(6)]
            rows.append((2 * i + copy, own[:1 + i % 4] + passage + own[1 + i % 4:]))
    rows += [(900, ["", "", "", "once"]), (901, ["other", "", "", ""]), (902, ["a", "", "", "", "b", "x"]),
             (903, ["y", "a", "", "", "", "b"]), (904, ["p", "q", "r"]), (905, ["q", "r", "s"]), (906, ["p", "q", "r", "s"])]
    first, expected = {}, {}
    for i, lines in sorted(rows):
        gone = set()
        for at in range(len(lines)):
            for to in range(at + 2, len(lines) + 1):
                part = tuple(lines[at:to])
                if any(part) and (i, at) != first.setdefault(part, (i, at)):
                    gone.update(range(at, to))
        expected[i] = ("\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone))
    df = spark.createDataFrame([(i, "\n".join(lines)) for i, lines in rows], "doc_id long, text string")
    assert {r["doc_id"]: (r["text"], r["_removed"]) for r in line_dedup.remove_repeats(df).collect()} == expected
    assert all(expected[2 * i + 1][1] == 2 + i % 5 and expected[2 * i][1] == 0 for i in range(60))
    assert {line for _, lines in rows for line in lines} == {x for t, _ in expected.values() for x in t.split("\n")}


def test_decontamination(spark, empty):
    items = [(1, PROSE[2]), (2, "the quick brown fox jumps over nine lazy dogs today. The answer is forty two."),
             (3, None), (4, "tiny item")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    para = "the quick red fox jumps over nine lazy dogs now. the answer is forty two."
    rows = [(10, PROSE[4] + " " + PROSE[2] + " " + PROSE[5]), (11, PROSE[0] + " " + para), (12, PROSE[3]),
            (13, None), (14, ""), (None, PROSE[2]), (15, "tiny item and other words")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(df, bench).collect()}
    assert found == {(10, 1), (11, 2), (None, 1)}
    kept = decontaminate.clean(df, bench)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {12, 13, 14, 15}
    assert not decontaminate.leaks(df, bench.limit(0)).count()
    assert not decontaminate.leaks(empty, bench).count()


def test_decontamination_finds_short_items_at_every_offset(spark):
    """Whole copies of items of 5 to 15 words, and an answered item of which 57% is there."""
    items = [(n, " ".join(f"{WORDS[(n + k) % len(WORDS)]}{n}" for k in range(n))) for n in range(5, 16)]
    question = [f"ask{k}" for k in range(16)]
    items.append((90, " ".join(question) + ". " + " ".join(f"reply{k}" for k in range(5))))
    rows = [(100 * n + at, " ".join([f"filler{(at * 31 + j * 7) % 97}" for j in range(40 + at)] + [t] + ["after"] * 9 + PROSE[:1]))
            for n, t in items if n < 90 for at in range(8)]
    # 7 and 5 of 21 words in their order, the answer whole, among words of every document
    rows.append((9000, " ".join(PROSE[0].split()[:8] + question[:7] + [f"reply{k}" for k in range(5)] + PROSE[0].split()[:20])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(
        df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert found >= {(i, i // 100) for i, _ in rows}
    assert all(item == doc // 100 for doc, item in found)


def test_language(spark, docs, empty, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    found = language_id.language_report(table).join(table.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert found.filter("lang = lang_pred").count() >= 0.9 * found.count()
    odd = {r["doc_id"]: r for r in rows_of(language_id.language_report(docs))}
    assert len(odd) == len(TEXTS) + 1 and all(0 <= r["score"] <= 1 for r in odd.values())
    assert all(odd[i]["lang_pred"] == "und" for i, t in enumerate(TEXTS)
               if t is None or not any(c.isalpha() for c in t))
    assert odd[3]["lang_pred"] == "en" and not rows_of(language_id.language_report(empty))


def test_quality_model(spark, docs, labels, empty, sf):
    known = spark.read.parquet(f"{sf}/labels.parquet")
    scored = quality_model.quality_scores(spark.read.parquet(f"{sf}/documents.parquet"), known)
    both = scored.join(known, "doc_id").filter("held_out")
    share = both.agg({"quality": "avg"}).first()[0]   # what a constant gets
    assert both.filter("predicted = quality").count() > max(0.9, share) * both.count()
    odd = rows_of(quality_model.quality_scores(docs, labels))
    assert len(odd) == docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    assert not rows_of(quality_model.quality_scores(empty, labels))
    assert {r["score"] for r in rows_of(quality_model.quality_scores(docs, labels.limit(0)))} == {0.5}


def test_warc(spark):
    big, small = "<p>é WARC/1.1\r\n\r\nx</p>" * 80, "short"
    rows = [(1, "http://a.example/x y", big), (2, "http://b.example", big), (3, None, small), (4, "u", small),
            (5, "u", None), (None, "u", "z"), (4, "u", small)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = sorted(rows_of(warc.capture_report(pages)), key=lambda r: str(r["page_id"]))
    assert len(found) == len(rows)
    by_id = {r["page_id"]: r for r in found}
    assert (by_id[1]["record_type"], by_id[1]["refers_to"]) == ("revisit", 2)
    assert by_id[2]["record_type"] == by_id[3]["record_type"] == by_id[4]["record_type"] == "response"
    for page_id, _, html in rows:
        data = (html or "").encode()
        assert by_id[page_id]["payload_bytes"] == len(data)
        assert by_id[page_id]["payload_digest"] == hashlib.sha1(data).hexdigest()
    assert not rows_of(warc.capture_report(pages.limit(0)))
