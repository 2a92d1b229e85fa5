"""Secrets in texts: fixed patterns, and literals that are assigned to sensitive names.

Base patterns are searched over the whole text, leftmost first and without overlaps per kind: ``assign``
(a sensitive word, an assignment sign and a value), ``access`` (access key ids) and ``hex`` (long runs).

The method reads source and configuration syntax. A text is cut into strings, names and signs; from these
come pairs of a target name and an expression: ``name = "a" + 'b'``, ``"name": "value"``, ``NAME=value``,
``x["name"] = y``, ``f(name="value")``, ``<name>value</name>``, ``scheme://user:value@host``. An expression
of names is replaced by what these were bound to above it, so that a literal bound to a harmless name is
found once it flows into a sensitive one. A literal's score is its target's sensitivity (words of the name,
less for words such as ``public`` or ``path``) times its own (length, entropy, kinds of characters; nothing
for placeholders); from ``LEAST_SCORE`` on its content is a finding of kind ``named``.

Positions are code points, ends exclusive; an ``assign`` finding is the whole match. Findings are ordered by
start, then ``assign``, ``access``, ``hex``, ``named``, then end.

Defined results: null and empty texts have no findings; null ids and repeated rows are rows of their own;
where two targets claim a literal the higher score, then the smaller name, stays; extra columns are not read, and
kept by ``with_findings`` and ``redact``; an empty table gives an empty result. Texts are read whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from tablewright.base import unused_name
from tablewright.llm.common import pack, ship_with_job, unpack

KINDS = ["assign", "access", "hex", "named"]
LEAST_SCORE = 0.5
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 12, 18, 16
_FLAGS = re.ASCII | re.IGNORECASE
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", _FLAGS)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(f"[0-9a-f]{{{HEX_LENGTH},}}")  # a shorter run is dropped as a whole, so nothing else starts in it
_ASSIGNED = [b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"]

#: How sensitive a target is that has the word, or the two words side by side.
WORDS = {"password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 1.0, "pass": 0.8, "secret": 1.0, "token": 0.9,
         "apikey": 0.9, "credential": 0.9, "credentials": 0.9, "authorization": 0.9, "bearer": 0.8, "auth": 0.8,
         "privatekey": 1.0, "accesskey": 0.9, "cookie": 0.6, "salt": 0.6, "signature": 0.6}
PAIRS = {("api", "key"): 0.9, ("access", "key"): 0.9, ("private", "key"): 1.0, ("signing", "key"): 0.9,
         ("encryption", "key"): 0.9, ("master", "key"): 0.9, ("shared", "key"): 0.8, ("account", "key"): 0.8}
#: Words that make a name harmless: it tells about a secret.
ABOUT = {"public", "id", "name", "path", "file", "dir", "url", "uri", "length", "len", "size", "count", "type", "field",
         "label", "expires", "expiry", "ttl", "min", "max", "regex", "pattern", "hint", "placeholder", "prompt",
         "policy", "column", "header", "env", "var", "timeout"}
ABOUT_FACTOR = 0.3
_STEMS = [b"pass", b"pwd", b"secret", b"token", b"key", b"cred", b"auth", b"bearer", b"cookie", b"salt", b"signature",
          b"://"]
_PLACEHOLDER = re.compile(r"(?i)x{4,}|\*{3,}|\.{3,}|change.?me|example|placeholder|your[_-]|dummy|redacted|"
                          r"^(?:none|null|true|false|undefined)$|^[$%<{#].*[>}%]?$|^(.)\1*$")

_TOKEN = re.compile(r"""
    (?P<url>[a-z][a-z0-9+.-]*://[^\s:/@"'`]*:(?P<userpass>[^\s@/"'`]+)@)
  | (?<![A-Za-z0-9_])[rRbBuUfF]{0,2}(?: "(?P<s1>(?:[^"\\\n]|\\.)*)" | '(?P<s2>(?:[^'\\\n]|\\.)*)' | `(?P<s3>[^`\n]*)` )
  | <(?P<tag>[A-Za-z_][\w.-]*)>(?P<inner>[^<>\s]+)</(?P=tag)>
  | (?P<name>[A-Za-z_$][\w$]*(?:[.-][\w$]+)*)
  | (?P<sign>:=|=>|===?|!==?|<=|>=|::|[=:+\[\](),;{}])
  | (?P<line>\n)
""", re.VERBOSE | re.ASCII)
_BARE = re.compile(r"""[^\s"'`,;(){}<>\[\]]+""")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_BINDS, _COMPARES = {"=", ":=", ":", "=>"}, {"==", "==="}
_SCHEMES = {"bearer", "basic", "token"}
#: Calls whose text argument says where a value is read from, and calls that set what they name.
_READS = re.compile(r"(?i)get|env|read|load|input|prompt|find|fetch|look|param|config")
_SETS = re.compile(r"(?i)(?:.*\.)?(?:set|with)")


def base_findings(text: str, low: bytes) -> Iterator[tuple[str, int, int]]:
    if any(word in low for word in _ASSIGNED):
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_LENGTH:
                yield "assign", m.start(), m.end()
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= ACCESS_LENGTH:
                yield "access", m.start(), m.end()
    for m in _HEX.finditer(text):
        yield "hex", m.start(), m.end()


# ---- names and literals ----

def sensitivity(name: str) -> float:
    words = [w.lower() for w in _PART.findall(name)]
    found = max([WORDS.get(w, 0.0) for w in words] + [PAIRS.get(p, 0.0) for p in zip(words, words[1:])], default=0.0)
    return found * ABOUT_FACTOR if any(w in ABOUT for w in words) else found


def strength(value: str, quoted: bool) -> float:
    """How much a literal looks like a secret, 0 to 1."""
    size = len(value)
    if size < 6 or any(c.isspace() for c in value) or _PLACEHOLDER.search(value):
        return 0.0
    kinds = [any(c.islower() for c in value), any(c.isupper() for c in value), any(c.isdigit() for c in value),
             any(not c.isalnum() for c in value)]
    if not quoted and not (kinds[2] and sum(kinds) > 1):
        return 0.0  # a bare word is rather prose, or a name
    entropy = -sum(n / size * math.log2(n / size) for n in Counter(value).values())
    return 0.4 * min(1.0, size / 12) + 0.4 * min(1.0, entropy / 3.0) + 0.2 * min(1.0, sum(kinds) / 2)


# ---- pairs of names and literals ----

class _Reader:
    """Reads assignments from left to right and remembers what names are bound to."""

    def __init__(self, text: str):
        self.text = text
        self.tokens = list(_TOKEN.finditer(text))
        self.bound: dict[str, list[tuple[int, int, bool]]] = {}

    def sign(self, i: int) -> str | None:
        return self.tokens[i]["sign"] if 0 <= i < len(self.tokens) else None

    def string(self, i: int) -> tuple[int, int] | None:
        if 0 <= i < len(self.tokens):
            for group in ("s1", "s2", "s3"):
                if self.tokens[i][group] is not None:
                    return self.tokens[i].span(group)
        return None

    def target(self, i: int) -> str | None:
        """The name that the sign ``i`` assigns to."""
        if i and self.tokens[i - 1]["name"]:
            return self.tokens[i - 1]["name"]
        at = self.string(i - 2 if self.sign(i - 1) == "]" else i - 1)
        return self.text[at[0]:at[1]] if at else None

    def value(self, i: int) -> list[tuple[int, int, bool]]:
        """(start, end, quoted) of the literals that the expression from token ``i`` on is made of."""
        found: list[tuple[int, int, bool]] = []
        while i < len(self.tokens):
            token, span = self.tokens[i], self.string(i)
            if span:
                found.append((*span, True))
            elif token["name"] in self.bound and self.sign(i + 1) != "(":
                found += self.bound[token["name"]]
            elif token["name"] and self.sign(i + 1) == "(" and self.tokens[i + 1].start() == token.end():
                inner = self.string(i + 2)   # a call with one string, such as decode("...")
                if inner and self.sign(i + 3) == ")" and not _READS.search(token["name"]):
                    found.append((*inner, True))
                    i += 3
                else:
                    break
            else:
                break
            if self.sign(i + 1) == "+":
                i += 2
            elif span and self.string(i + 1):
                i += 1
            else:
                break
        return found

    def bare(self, i: int) -> list[tuple[int, int, bool]]:
        """The value without quotes after the sign ``i``, on its line."""
        at = self.tokens[i].end()
        for _ in range(2):
            while at < len(self.text) and self.text[at] in " \t":
                at += 1
            m = _BARE.match(self.text, at)
            if not m:
                return []
            if m.group().lower() not in _SCHEMES:
                return [(m.start(), m.end(), False)] if self.text[m.end():m.end() + 1] != "(" else []
            at = m.end()
        return []

    def pairs(self) -> Iterator[tuple[str, list[tuple[int, int, bool]]]]:
        for i, token in enumerate(self.tokens):
            if token["url"]:
                yield "password", [(*token.span("userpass"), True)]
            elif token["tag"]:
                yield token["tag"], [(*token.span("inner"), True)]
            elif token["sign"] == "(" and i and self.tokens[i - 1]["name"] and _SETS.match(self.tokens[i - 1]["name"]):
                yield self.tokens[i - 1]["name"], self.value(i + 1)
            elif token["sign"] in _BINDS or token["sign"] in _COMPARES:
                name = self.target(i)
                if name:
                    literals = self.value(i + 1) or self.bare(i)
                    if literals and token["sign"] in _BINDS:
                        if name not in self.bound or literals[0][2]:
                            self.bound[name] = literals
                    yield name, literals


def named_findings(text: str, low: bytes) -> dict[tuple[int, int], tuple[float, str]]:
    """(start, end) of the literals that flow into sensitive names, with score and name."""
    found: dict[tuple[int, int], tuple[float, str]] = {}
    if not any(stem in low for stem in _STEMS):
        return found
    for name, literals in _Reader(text).pairs():
        weight = sensitivity(name)
        if not weight or not literals:
            continue
        whole = "".join(text[a:b] for a, b, _ in literals)
        score = round(weight * strength(whole, all(quoted for *_, quoted in literals)), 6)
        if score < LEAST_SCORE:
            continue
        for a, b, _ in literals:
            if a < b:
                held = found.get((a, b))
                if held is None or (-score, name) < (-held[0], held[1]):
                    found[a, b] = (score, name)
    return found


def scan(text: str | None) -> list[dict]:
    """The findings of one text in order."""
    text = text or ""
    low = text.encode("utf-8", "surrogatepass").lower()
    rows = [(kind, a, b, None, None) for kind, a, b in base_findings(text, low)]
    rows += [("named", a, b, name, score) for (a, b), (score, name) in named_findings(text, low).items()]
    rows.sort(key=lambda r: (r[1], KINDS.index(r[0]), r[2]))
    return [{"kind": k, "start": a, "end": b, "name": n, "score": s} for k, a, b, n, s in rows]


# ---- tables ----

_FINDINGS = "array<struct<kind: string, start: bigint, end: bigint, name: string, score: double>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()),
                             ("score", pa.float64())]))


def _scanner(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([scan(t.as_py()) for t in batch.column(0)], type=_ARROW)
            keep = range(0 if keep_text else 1, batch.num_columns)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), found],
                                             [*(batch.schema.names[i] for i in keep), "_found"])
    return run


def _found(rows: DataFrame, keep_text: bool = False) -> DataFrame:
    """``rows`` (text first) with their findings in ``_found``."""
    ship_with_job()
    kept = rows if keep_text else rows.drop(rows.columns[0])
    found = StructField("_found", DataType.fromDDL(_FINDINGS))
    return rows.mapInArrow(_scanner(keep_text), StructType([*kept.schema.fields, found]))


def with_findings(docs: DataFrame) -> DataFrame:
    """``docs`` with ``findings`` (or the first free name like it): kind, start, end, name, score."""
    packed, row = pack(docs, "text")
    name = unused_name("findings", docs.columns)
    return unpack(_found(packed.select("text", row)), docs, row, **{name: F.col("_found")})


def redact(docs: DataFrame, mask: str = "*") -> DataFrame:
    """``docs`` with every code point of a finding replaced by ``mask``."""
    ship_with_job()

    @F.pandas_udf("string")
    def masked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: _masked(t, mask), na_action="ignore")

    return docs.withColumn("text", masked("text"))


def _masked(text: str, mask: str) -> str:
    parts, at = [], 0
    for f in scan(text):
        if f["end"] > at:
            first = max(at, f["start"])
            parts += [text[at:first], mask * (f["end"] - first)]
            at = f["end"]
    return "".join([*parts, text[at:]])


def _spans(kinds: list[str]) -> Column:
    chosen = F.filter("_found", lambda f: f["kind"].isin(kinds))
    return F.array_join(F.transform(chosen, lambda f: F.concat_ws(
        ":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """One row per document: findings per base kind, a checksum of them, and all findings."""
    def count(kind: str) -> Column:
        return F.size(F.filter("_found", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return _found(docs.select("text", "doc_id")).select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(_spans(KINDS[:3]), 256).alias("base_sha256"),
        _spans(KINDS).alias("spans"), count("named"))
