"""What the operators of this subpackage share."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.plans.staging import new_path

#: Bytes of a table's keys, and of ``ROW_BYTES`` for the numbers beside each, up to which it is
#: broadcast; both are summed over the whole table first.
BROADCAST_BYTES, ROW_BYTES = 8 << 20, 128


def ship_with_job() -> None:
    """Functions of this subpackage travel with the tasks, so that executors need not have
    the library installed."""
    for name in list(sys.modules):
        if name.startswith("tablewright.llm."):
            cloudpickle.register_pickle_by_value(sys.modules[name])


def shared(spark: SparkSession, value) -> Callable[[], object]:
    """A function that gives ``value`` in a task. Its classes travel with it, as functions do; a
    broadcast by itself names them only."""
    held = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(held.value)


def lookup(big: DataFrame, table: DataFrame, key: str, spread: Column, salts: int = 32,
           bound: int = BROADCAST_BYTES) -> DataFrame:
    """Left join of ``table`` (one row per ``key``, written, no null keys, a few numbers beside
    the key) to ``big``.

    Up to ``bound`` measured bytes it is broadcast. Beyond, every key is dealt to ``salts``
    keys by the hash of ``spread``, so that one hot key is no single group; rows of ``big``
    without a key match nothing and are spread in the same way.
    """
    size = table.agg(F.sum(F.octet_length(F.col(key).cast("string")) + ROW_BYTES).alias("b")).first()["b"]
    if (size or 0) <= bound:
        return big.join(F.broadcast(table), key, "left")
    salted = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return (big.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
            .join(salted, [key, "_salt"], "left").drop("_salt"))


#: Where the paths of written tables are noted, innermost last; see ``noted``.
_notes: list[list[str]] = []


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    path, schema = new_path(df.sparkSession, f"llm-{label}"), df.schema
    if _notes:
        _notes[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


@contextmanager
def noted(paths: list[str]) -> Iterator[None]:
    """The paths that ``staged`` writes to inside of the block are added to ``paths``."""
    _notes.append(paths)
    try:
        yield
    finally:
        _notes.pop()


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Remove written tables and empty the list: for callers that have written all results
    which read them."""
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def pack(docs: DataFrame, *needed: str) -> tuple[DataFrame, str]:
    """The columns ``needed`` of ``docs``, and all of its columns as one struct whose name is
    returned: inside of it they can't clash with the columns that an operator adds."""
    row = "_user_row"
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row), *needed), row


def unpack(rows: DataFrame, docs: DataFrame, row: str, **added: Column) -> DataFrame:
    """The columns of ``docs`` out of the struct ``row`` of ``rows``, and ``added`` ones."""
    return rows.select(*[F.col(row).getField(c).alias(c) for c in docs.columns],
                       *[value.alias(name) for name, value in added.items()])


def held_out(doc_id: Column) -> Column:
    """The rows that no model may learn from: a fifth of the ids, and rows without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))
