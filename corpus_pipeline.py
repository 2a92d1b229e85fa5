"""Corpus pipeline: quality rules, near-duplicates, decontamination, mixing, sharding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's documents. All but the last return the columns of ``docs``. As
its input is written, a later stage begins by removing what the stage before it kept in the
shared folder for the same ``sf_dir``; tables of other callers and of earlier runs' results stay.
Two runs over one ``sf_dir`` in one process must not overlap.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm import decontaminate, mixing, quality_rules, sharding, simhash
from tablewright.llm.common import noted, remove
from tablewright.plans.staging import stage_table
from tablewright.sources.tables import load_table

#: The earlier stages leave little poor text; what is left of it goes, and toxic text is thinned.
TARGETS = {"clean": 0.97, "poor": 0.0, "toxic": 0.03}

#: By ``sf_dir``, the tables that the latest stage's result reads.
_kept: dict[str, list[str]] = defaultdict(list)


def stage(fn: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """A stage after the first: ``docs`` is written, so nothing reads the tables behind it."""
    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove(spark, _kept[sf_dir])
        with noted(_kept[sf_dir]):
            return fn(spark, docs, sf_dir)
    return run_stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or their host's verdict, go."""
    _kept.pop(sf_dir, None)  # the result of an earlier run may still be read
    with noted(_kept[sf_dir]):
        return quality_rules.apply_rules(docs)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.one_of_each(docs)


@stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontaminate.clean(docs, load_table(spark, sf_dir, "benchmark"))


@stage
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the target weights ask for."""
    return mixing.mix(docs, load_table(spark, sf_dir, "labels"), TARGETS)


@stage
def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets its shard and its slot in it."""
    return sharding.shard_documents(docs)


STAGES = [("quality rules", quality), ("near-duplicates", near_duplicates),
          ("decontamination", decontamination), ("mixing", mixture), ("sharding", shards)]

#: The stages use hashes, a random projection and a fitted classifier, which SQL lacks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage_table(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
