"""Column metadata: categorical levels and the roles of label and score columns.

Everything lives under one metadata key, next to Spark ML's own attribute key, so that
Spark stages see the number of categories as well.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TAG = "engine"
# fixed values: names of the scored columns and of the two kinds
SCORES, SCORED_LABELS, SCORED_PROBABILITIES = "scores", "scored_labels", "scored_probabilities"
CLASSIFICATION, REGRESSION = "Classification", "Regression"
LABEL_ROLE, SCORES_ROLE = "TrueLabelsColumnKind", "ScoresColumnKind"
SCORED_LABELS_ROLE, PROBABILITIES_ROLE = "ScoredLabelsColumnKind", "ScoredProbabilitiesColumnKind"
# above this many levels Spark ML's attribute lists no names, only our tag has them
ATTRIBUTE_VALUES = 10_000


def _with(df: DataFrame, column: str, change) -> DataFrame:
    meta = json.loads(json.dumps(df.schema[column].metadata or {}))
    tag = meta.setdefault(TAG, {})
    change(meta, tag)
    return df.withMetadata(column, meta)


def tag_of(schema: T.StructType, column: str) -> dict:
    return (schema[column].metadata or {}).get(TAG, {})


def set_levels(df: DataFrame, column: str, levels: list, dtype: T.DataType) -> DataFrame:
    """Mark an index column as categorical with these levels (None marks the null level)."""
    known = [v for v in levels if v is not None]

    def change(meta, tag):
        tag["categorical"] = {
            "type": dtype.simpleString(), "count": len(known),
            "null_exists": len(known) != len(levels), "levels": json.dumps(known)}
        attribute = {"name": column, "type": "nominal", "num_vals": len(known)}
        if 0 < len(known) <= ATTRIBUTE_VALUES:
            attribute = {"name": column, "type": "nominal", "vals": [str(v) for v in known]}
        meta["ml_attr"] = attribute
    return _with(df, column, change)


def set_level_table(df: DataFrame, column: str, path: str, count: int, null_exists: bool,
                    dtype: T.DataType) -> DataFrame:
    """Mark an index column whose levels are too many for metadata and live in a table."""
    def change(meta, tag):
        tag["categorical"] = {"type": dtype.simpleString(), "count": count,
                              "null_exists": null_exists, "table": path}
        meta["ml_attr"] = {"name": column, "type": "nominal", "num_vals": count}
    return _with(df, column, change)


def categorical_info(schema: T.StructType, column: str) -> dict | None:
    """Dict with type, count, null_exists and levels (None when they live in a table)."""
    info = tag_of(schema, column).get("categorical")
    if info is None:
        return None
    out = dict(info)
    out["levels"] = json.loads(info["levels"]) if "levels" in info else None
    return out


def is_categorical(schema: T.StructType, column: str) -> bool:
    return categorical_info(schema, column) is not None


def get_levels(schema: T.StructType, column: str) -> list | None:
    info = categorical_info(schema, column)
    return info["levels"] if info else None


def new_model_name() -> str:
    return "score_model_" + uuid.uuid4().hex


def set_role(df: DataFrame, column: str, model: str, role: str, kind: str) -> DataFrame:
    def change(meta, tag):
        tag.setdefault("roles", {})[model] = {"role": role, "kind": kind}
    return _with(df, column, change)


def first_model(schema: T.StructType) -> str | None:
    for field in schema:
        for name in tag_of(schema, field.name).get("roles", {}):
            return name
    return None


def column_in_role(schema: T.StructType, model: str, role: str) -> str | None:
    for field in schema:
        entry = tag_of(schema, field.name).get("roles", {}).get(model)
        if entry and entry["role"] == role:
            return field.name
    return None


def score_kind(schema: T.StructType, model: str) -> str | None:
    for field in schema:
        entry = tag_of(schema, field.name).get("roles", {}).get(model)
        if entry:
            return entry["kind"]
    return None
