"""Whole files as rows: scan, stream, subsampling, archives, files named by a column."""

from __future__ import annotations

import io
import os
import posixpath
import re
import zipfile
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from itertools import islice
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.plans.staging import stage_table

VALUE_TYPE = T.StructType([T.StructField("path", T.StringType()),
                           T.StructField("bytes", T.BinaryType())])
GRAIN = 1_000_000
# entries of an archive are handed on in batches of about this many bytes
BATCH_BYTES = 32 << 20


def _kept(path: Column, ratio: float, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.regexp_replace(path, "^file:/+", "file:/"), F.lit(seed)), F.lit(GRAIN)) < F.lit(int(round(ratio * GRAIN)))


def _check_ratio(ratio: float) -> None:
    if not 0.0 <= ratio <= 1.0:
        raise ValueError("sampleRatio must lie in [0, 1]")


#: The name of a row's file. Filters on it choose files before any of them is opened.
FILE_NAME = "_metadata.file_path"


#: Tasks of a scan of files per core of the session, at most. Spark counts every file as 4 MB at least, so
#: small files would take a task for each 32 of them.
TASKS_PER_CORE = 16
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def few_tasks(files: DataFrame) -> DataFrame:
    """The scanned rows in a number of tasks that doesn't grow with the number of files. Rows pass one by
    one, so a task holds no more than before, and nothing is shuffled."""
    return files.coalesce(TASKS_PER_CORE * files.sparkSession.sparkContext.defaultParallelism)


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Streams that run inside list the files of a batch in a few tasks, not in one each up to 10,000. The
    source reads the setting from the session at every batch; the session gets its own back afterwards."""
    before = spark.conf.get(LISTING_TASKS, None)
    spark.conf.set(LISTING_TASKS, str(TASKS_PER_CORE * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.unset(LISTING_TASKS) if before is None else spark.conf.set(LISTING_TASKS, before)


def is_zip(path: Column) -> Column:
    return F.lower(path).endswith(".zip")


def unzip(files: DataFrame) -> DataFrame:
    """(path, bytes) rows of archives to one row per file inside, path = archive/entry.

    Entries are unpacked one after the other and handed on in bounded batches. An archive, or an
    entry of it, that cannot be read makes one row with null bytes.
    """
    def rows(archive: str, content: bytes) -> Iterator[tuple[str, bytes | None]]:
        try:
            z = zipfile.ZipFile(io.BytesIO(content))
        except (zipfile.BadZipFile, NotImplementedError, ValueError):
            yield archive, None
            return
        with z:
            for item in z.infolist():
                if not item.is_dir():
                    try:
                        data = z.read(item)
                    except (zipfile.BadZipFile, zlib.error, RuntimeError, NotImplementedError, OSError, EOFError):
                        data = None
                    yield f"{archive}/{item.filename}", data

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        paths, contents, size = [], [], 0
        for batch in batches:
            for archive, content in zip(batch["path"], batch["bytes"]):
                for path, data in rows(archive, content):
                    paths.append(path)
                    contents.append(data)
                    size += len(data or b"")
                    if size >= BATCH_BYTES:
                        yield pd.DataFrame({"path": paths, "bytes": contents})
                        paths, contents, size = [], [], 0
        if paths:
            yield pd.DataFrame({"path": paths, "bytes": contents})
    return files.mapInPandas(entries, VALUE_TYPE)


def archive_entries(files: DataFrame, ratio: float, seed: int) -> DataFrame:
    """(path, bytes) of what the archives among the scanned ``files`` hold, sampled."""
    inside = unzip(files.filter(is_zip(F.col(FILE_NAME))).select("path", F.col("content").alias("bytes")))
    return inside.filter(_kept(F.col("path"), ratio, seed)) if ratio < 1.0 else inside


def _shape(files: DataFrame, ratio: float, inspect_zip: bool, seed: int) -> DataFrame:
    """Sample on the name, open archives, sample their entries, pack into ``value``. Plain files and
    archives are told apart by their names, so each file is opened by one of the two scans, if at all."""
    name = F.col(FILE_NAME)
    plain = files.filter(~is_zip(name)) if inspect_zip else files
    if ratio < 1.0:
        plain = plain.filter(_kept(name, ratio, seed))
    values = few_tasks(plain.select("path", F.col("content").alias("bytes")))
    if inspect_zip:
        values = values.unionByName(archive_entries(files, ratio, seed))
    return values.select(F.struct("path", "bytes").alias("value"))


def _same_form(name: Column) -> Column:
    """file:/a and file:///a are one name."""
    return F.regexp_replace(name, "^file:/+", "file:/")


def empty_files(files: DataFrame) -> DataFrame:
    """(path, name) of the files of length zero: names that were listed for the scan but are not in
    it. The list goes from the scan's file index into a table of the session, and no content is read."""
    spark = files.sparkSession
    listed = spark._jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(files._jdf.inputFiles())
    names = DataFrame(spark._jsparkSession.createDataset(listed, spark._jvm.org.apache.spark.sql.Encoders.STRING()),
                      spark).select(_same_form(F.col("value")).alias("name"))
    held = few_tasks(files.select(_same_form(F.col(FILE_NAME)).alias("name")))
    path = F.url_decode(F.replace("name", F.lit("+"), F.lit("%2B")))
    return names.join(held, "name", "left_anti").select(path.alias("path"), "name")


def read_binary_files(spark: SparkSession, path: str, recursive: bool = False,
                      sampleRatio: float = 1.0, inspectZip: bool = True,
                      seed: int = 0) -> DataFrame:
    """One row ``value=struct<path,bytes>`` per file below a directory or matching a glob, empty
    files with empty bytes. A sample is drawn from the names; files outside of it are not opened."""
    _check_ratio(sampleRatio)
    listed = listed_files(spark, path, recursive)
    if listed is not None and listed.count() > DRIVER_FILES:
        return _shape_listed(listed, path, sampleRatio, inspectZip, seed)
    files = (spark.read.format("binaryFile")
             .option("recursiveFileLookup", str(recursive).lower()).load(path))
    empty = empty_files(files)
    if inspectZip:
        empty = empty.filter(~is_zip(F.col("name")))   # no archive without a directory at its end
    if sampleRatio < 1.0:
        empty = empty.filter(_kept(F.col("name"), sampleRatio, seed))
    none = empty.select(F.struct("path", F.lit(b"").alias("bytes")).alias("value"))
    return _shape(files, sampleRatio, inspectZip, seed).unionByName(none)


#: Files up to which Spark's own source scans a folder. It keeps the status of every file, and a split of every
#: scan for it, on the driver; more files are listed and opened in tasks.
DRIVER_FILES = 50_000
#: Files that a task holds at a time, at most; and their bytes, but for the last.
FILES_PER_READ = 1000
ENTRY_TYPE = "path string, name string, inner string, length long, folder boolean"
_HIDDEN = re.compile(r"^(?!_metadata|_common_metadata)(_[^=]*|\..*|.*\._COPYING_)$", re.DOTALL)
_ESCAPED = re.compile(r"[^A-Za-z0-9_\-!.~'()*:@&=+$,;/\u00a1-\U0010ffff]|[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def _open_folder(path: str):
    """The store of a folder, its path there and what stands before that in the paths that Spark reports."""
    from pyarrow import fs
    if path.startswith(("/", "file:/")):
        inner = posixpath.normpath("/" + path.removeprefix("file:").lstrip("/"))
        return fs.LocalFileSystem(), inner, "file:"
    store, inner = fs.FileSystem.from_uri(path)
    return store, inner, path[:path.rindex(inner)]


def _entries(store, folder: str) -> Iterator[tuple[str, int, bool]]:
    """(path, length, whether it is a folder) of what a folder holds and Spark's sources list, one by one
    where the store can do so."""
    from pyarrow import fs
    if isinstance(store, fs.LocalFileSystem):
        with os.scandir(folder) as found:
            for entry in found:
                if not _HIDDEN.match(entry.name):
                    try:
                        inside = entry.is_dir()
                        yield entry.path, 0 if inside else entry.stat().st_size, inside
                    except FileNotFoundError:  # gone, or a link to nothing
                        pass
    else:
        for info in store.get_file_info(fs.FileSelector(folder)):
            if not _HIDDEN.match(info.base_name):
                yield info.path, info.size or 0, info.type == fs.FileType.Directory


def listed_files(spark: SparkSession, path: str, recursive: bool) -> DataFrame | None:
    """(path, name, inner, length) of the files below a folder, listed by tasks level by level - a folder by
    one - and written to the shared folder: the driver meets none of them. None where Spark's own source has
    to list: globs, single files, partitioned folders and stores that only Spark opens."""
    from pyarrow import fs
    if not isinstance(path, str) or any(c in path for c in "{}[]*?\\"):
        return None
    try:
        store, root, _ = _open_folder(path)
        if store.get_file_info(root).type != fs.FileType.Directory:
            return None
    except (OSError, ValueError):
        return None

    def entries(batches):
        import pyarrow as pa
        store, _, before = _open_folder(path)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = _entries(store, folder)
                while part := list(islice(found, 10_000)):
                    inner = [p for p, _, _ in part]
                    names = [before + _ESCAPED.sub(lambda c: quote(c.group(), safe=""), p) for p in inner]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([before + p for p in inner]), pa.array(names), pa.array(inner),
                         pa.array([n for _, n, _ in part], pa.int64()), pa.array([d for _, _, d in part], pa.bool_())],
                        names=["path", "name", "inner", "length", "folder"])

    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    level, levels = spark.createDataFrame([(root,)], "inner string"), []
    while True:
        found = stage_table(level.mapInArrow(entries, ENTRY_TYPE), "listing")
        levels.append(found.filter("NOT folder"))
        folders = found.filter("folder")
        if not recursive:
            # Spark takes folders named a=1 for a partitioned table
            return levels[0].drop("folder") if folders.filter(F.col("inner").rlike("=[^/]*$")).isEmpty() else None
        if folders.isEmpty():
            return reduce(DataFrame.unionByName, levels).drop("folder")
        level = folders.select("inner").repartition(tasks, "inner")


def _contents(files: DataFrame, path: str) -> DataFrame:
    """(path, bytes) of listed files, opened by tasks to which they are dealt by name. What Spark's source would
    not read for its length, or can't find, is an error here too."""
    spark = files.sparkSession
    longest = int(spark.conf.get("spark.sql.sources.binaryFile.maxLength", str((1 << 31) - 1)))

    def read(batches):
        import pyarrow as pa
        store, _, _ = _open_folder(path)
        for batch in batches:
            at, held, size = [], [], 0
            for i, (name, inner, length) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)))):
                if length > longest:
                    raise ValueError(f"The length of {name} is {length}, which exceeds the max length allowed: {longest}.")
                with store.open_input_stream(inner) as stream:
                    held.append(stream.read())
                at.append(name)
                size += len(held[-1])
                if size >= BATCH_BYTES or len(at) == FILES_PER_READ or i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held, pa.binary())], names=["path", "bytes"])
                    at, held, size = [], [], 0
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    return files.select("path", "inner", "length").repartition(tasks, "inner").mapInArrow(read, VALUE_TYPE)


def _shape_listed(files: DataFrame, path: str, ratio: float, inspect_zip: bool, seed: int) -> DataFrame:
    """What ``_shape`` does, of listed files. Empty ones are among them."""
    plain, archives = files, files.filter(is_zip(F.col("name")))
    inspect_zip = inspect_zip and not archives.isEmpty()
    if inspect_zip:
        plain = files.filter(~is_zip(F.col("name")))
    if ratio < 1.0:
        plain = plain.filter(_kept(F.col("name"), ratio, seed))
    values = _contents(plain, path)
    if inspect_zip:  # no archive without a directory at its end
        inside = unzip(_contents(archives.filter("length > 0"), path))
        values = values.unionByName(inside.filter(_kept(F.col("path"), ratio, seed)) if ratio < 1.0 else inside)
    return values.select(F.struct("path", "bytes").alias("value"))


BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def stream_binary_files(spark: SparkSession, path: str, recursive: bool = False,
                        sampleRatio: float = 1.0, inspectZip: bool = True, seed: int = 0,
                        maxFilesPerTrigger: int | None = None) -> DataFrame:
    """The same rows for files as they arrive. Spark's stream of files leaves out empty ones."""
    _check_ratio(sampleRatio)
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("recursiveFileLookup", str(recursive).lower()))
    if maxFilesPerTrigger:
        reader = reader.option("maxFilesPerTrigger", maxFilesPerTrigger)
    return _shape(reader.load(path), sampleRatio, inspectZip, seed)


def read_from_paths(df: DataFrame, pathCol: str, bytesCol: str = "bytes") -> DataFrame:
    """Add the content of the file named in each row; null when it cannot be read.

    Every task opens only the files of its own rows: nothing is listed, shuffled or sent
    through the driver.
    """
    schema = T.StructType(df.schema.fields + [T.StructField(bytesCol, T.BinaryType())])

    def content(path):
        from pyarrow import fs
        if path is None:
            return None
        try:
            store, inner = fs.FileSystem.from_uri(path if "://" in path or path.startswith("/")
                                                  else _local_uri(path))
            with store.open_input_stream(inner) as stream:
                return stream.read()
        except (OSError, ValueError):
            return None

    def add(batches):
        import pyarrow as pa
        for batch in batches:
            at = batch.schema.get_field_index(pathCol)
            paths = batch.column(at).to_pylist()
            # a few files at a time, so that a batch of big files stays small
            for start in range(0, len(paths), FILES_PER_BATCH):
                part = batch.slice(start, FILES_PER_BATCH)
                data = pa.array([content(p) for p in paths[start:start + FILES_PER_BATCH]],
                                pa.binary())
                yield pa.RecordBatch.from_arrays(part.columns + [data],
                                                 names=part.schema.names + [bytesCol])
    return df.mapInArrow(add, schema)


FILES_PER_BATCH = 64


def _local_uri(path: str) -> str:
    # "file:/a/b", the form Spark reports for local files
    return "file://" + path[len("file:"):] if path.startswith("file:/") else path
