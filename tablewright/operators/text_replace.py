"""Dictionary replacement inside texts."""

from __future__ import annotations

from functools import lru_cache

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.base import HasInputCol, HasOutputCol, as_str, param, require_columns

NORMALIZERS = ("identity", "lowerCase", "upperCase")
# the rest of a word after a match: letters, decimal digits, underscore
WORD_REST = r"[\p{L}\p{Nd}_]*"


@lru_cache(maxsize=None)
def _same_after(norm: str) -> dict[str, str]:
    """Characters of the basic plane grouped by their normalized form."""
    groups: dict[str, str] = {}
    for code in range(0x10000):
        if 0xD800 <= code < 0xE000:
            continue
        ch = chr(code)
        form = ch.lower() if norm == "lowerCase" else ch.upper()
        if len(form) == 1:
            groups[form] = groups.get(form, "") + ch
    return groups


def _class(chars: str, negated: bool = False) -> str:
    inside = "".join("\\u%04x" % ord(c) if ord(c) < 0x10000 else c for c in sorted(set(chars)))
    return f"[{'^' if negated else ''}{inside}]"


def _variants(ch: str, norm: str) -> str:
    if norm == "identity":
        return ch
    return _same_after(norm).get(normalize_key(ch, norm), ch)


def normalize_key(key: str, norm: str) -> str:
    if norm == "lowerCase":
        return "".join(c.lower() if len(c.lower()) == 1 else c for c in key)
    if norm == "upperCase":
        return "".join(c.upper() if len(c.upper()) == 1 else c for c in key)
    return key


def replace_words(text: Column, mapping: dict[str, str], norm: str = "identity") -> Column:
    """Replace keys by their values, longest key first, left to right; the rest of a word
    that a key starts is dropped.

    The text is cut into pieces by one regular expression: a key with its word rest, or the
    run of characters up to the next key. The run is possessive, so that its length costs no
    stack.
    """
    if norm not in NORMALIZERS:
        raise ValueError(f"unknown normalization {norm!r}")
    table = {normalize_key(k, norm): v for k, v in mapping.items() if k}
    if not table:
        return text
    keys = sorted(table, key=lambda k: (-len(k), k))
    spelled = ["".join(_class(_variants(c, norm)) for c in k) for k in keys]
    any_key = "(" + "|".join(spelled) + ")"
    starts = "".join(_variants(k[0], norm) for k in keys)
    pieces = F.regexp_extract_all(
        text, F.lit(f"(?s){any_key}{WORD_REST}|(?:{_class(starts, negated=True)}|(?!{any_key}).)++"),
        F.lit(0))
    values = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])

    def swap(piece: Column) -> Column:
        found = F.regexp_extract(piece, f"^{any_key}", 1)
        if norm == "lowerCase":
            found = F.lower(found)
        elif norm == "upperCase":
            found = F.upper(found)
        return F.coalesce(F.try_element_at(values, found), piece)

    return F.array_join(F.transform(pieces, swap), "")


class TextPreprocessor(HasInputCol, HasOutputCol, Transformer):
    """Stage form of :func:`replace_words`."""

    map = param("map", "map of substring match to replacement")
    normFunc = param("normFunc", "identity, lowerCase or upperCase", as_str)

    _defaults = {"map": {}, "normFunc": "identity"}

    def setNormFunc(self, value: str):
        if value not in NORMALIZERS:
            raise ValueError(f"unknown normalization {value!r}")
        return self._set(normFunc=value)

    def _transform(self, df: DataFrame) -> DataFrame:
        require_columns(df, [self.getInputCol()])
        return df.withColumn(self.getOutputCol(), replace_words(
            F.col(f"`{self.getInputCol()}`"), self.getMap(), self.getNormFunc()))
