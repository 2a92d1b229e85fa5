"""Image scans and streams on Spark's image source.

Spark decodes images inside its own file source only. What lies elsewhere - in archives, or at
places that rows name - is copied to files in the shared folder first, whose names hold where each
came from, and decoded from there.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.base import unused_name
from tablewright.plans.staging import ensure_folder, new_path, stage_table
from tablewright.sources.binary import (
    BINARY_FILE_SCHEMA, FILE_NAME, LISTING_TASKS, _check_ratio, _kept, archive_entries, few_listing_tasks, few_tasks,
    is_zip, read_from_paths,
)
from tablewright.sources.sinks import write_files

#: Folders to which files to decode are dealt, and files that are decoded at a time where there are more; so many
#: files a folder at least reach the driver at once.
DECODE_FOLDERS, DECODE_FILES = 256, 20_000

IMAGE_TYPE = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("height", T.IntegerType()),
    T.StructField("width", T.IntegerType()), T.StructField("type", T.IntegerType()),
    T.StructField("bytes", T.BinaryType())])


def image_struct(source: Column | str = "image") -> Column:
    """Spark's image struct renamed; bytes stay row-wise BGR, the type stays the mode code."""
    c = F.col(source) if isinstance(source, str) else source
    return F.struct(c["origin"].alias("path"), c["height"].alias("height"),
                    c["width"].alias("width"), c["mode"].alias("type"), c["data"].alias("bytes"))


def _file_name(path: Column) -> Column:
    """A file name that holds a path: its bytes in hex and an x, in parts that any file system takes."""
    return F.concat(F.regexp_replace(F.hex(F.encode(path, "UTF-8")), "(.{200})", "$1/"), F.lit("x"))


def _named_path(origin: Column, folder: str) -> Column:
    """The path that a file in one of the folders of ``folder`` was named after."""
    inside = F.regexp_extract(origin, f"/{folder.rsplit('/', 1)[1]}/\\d+/(.*)$", 1)
    return F.decode(F.unhex(F.translate(inside, "/x", "")), "UTF-8")


def _decode(spark: SparkSession, contents: DataFrame) -> DataFrame:
    """(path, bytes) rows to (path, image): copied to files, decoded, files that are no images left out.

    Spark's source keeps the status of every file on the driver. More than ``DECODE_FILES`` are decoded some
    folders at a time, and the images written to the shared folder, so that the driver forgets the files.
    """
    folder, decoded = new_path(spark, "to-decode"), new_path(spark, "decoded")
    deal = F.format_string("%03d/", F.pmod(F.xxhash64("path"), F.lit(DECODE_FOLDERS)))
    rows = contents.filter("bytes IS NOT NULL AND path IS NOT NULL").select(
        F.concat(deal, _file_name(F.col("path"))).alias("name"), "bytes")
    written = write_files(rows, folder, "name", "bytes")
    ensure_folder(spark, folder)

    def images(places) -> DataFrame:
        with few_listing_tasks(spark):
            files = few_tasks(spark.read.format("image").option("dropInvalid", True)
                              .option("recursiveFileLookup", "true").load(places))
        path = _named_path(F.col("image.origin"), folder)
        return files.select(path.alias("path"), F.struct(
            path.alias("path"), *[F.col(f"image.{a}").alias(b) for a, b in
                                  (("height", "height"), ("width", "width"), ("mode", "type"), ("data", "bytes"))]).alias("image"))

    if written <= DECODE_FILES:
        return images(folder)
    step = max(1, DECODE_FOLDERS * DECODE_FILES // written)
    for at in range(0, DECODE_FOLDERS, step):
        places = [f"{folder}/{i:03d}" for i in range(at, min(at + step, DECODE_FOLDERS))]
        for place in places:
            ensure_folder(spark, place)
        images(places).write.mode("append").parquet(decoded)
    return spark.read.schema(T.StructType([T.StructField("path", T.StringType()), T.StructField("image", IMAGE_TYPE)])).parquet(decoded)


def read_images(spark: SparkSession, path, recursive: bool = False, sampleRatio: float = 1.0,
                inspectZip: bool = True, seed: int = 0) -> DataFrame:
    """One row ``image`` per decodable file, also of those inside archives (path = archive/entry);
    other files are dropped.

    ``path`` is one path, a glob or a list. A sample is drawn from the names before files are opened.
    """
    _check_ratio(sampleRatio)
    deep = str(recursive).lower()
    files = spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", deep).load(path)
    name = F.col(FILE_NAME)
    plain = files.filter(~is_zip(name))
    if sampleRatio < 1.0:
        plain = plain.filter(_kept(name, sampleRatio, seed))
    # the source reports names in their escaped form
    at = F.url_decode(F.replace("image.origin", F.lit("+"), F.lit("%2B")))
    images = few_tasks(plain.select(image_struct().withField("path", at).alias("image")))
    if not inspectZip:
        return images
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", deep).load(path)
    if raw.filter(is_zip(name)).select("path").isEmpty():
        return images
    return images.unionByName(_decode(spark, archive_entries(raw, sampleRatio, seed)).select("image"))


def _named_images(spark: SparkSession, names: list[str], ratio: float, inspect_zip: bool, seed: int) -> DataFrame:
    """``read_images`` of files by name. The names tell archives apart, so no job looks for them and each
    kind is listed once."""
    zips = [n for n in names if n.lower().endswith(".zip")]
    plain = [n for n in names if not n.lower().endswith(".zip")]
    # a batch is bounded, so a task a core holds no more than a bounded share of it
    parts = [read_images(spark, plain, False, ratio, False, seed)
             .coalesce(spark.sparkContext.defaultParallelism)] if plain else []
    if zips and inspect_zip:
        raw = spark.read.format("binaryFile").load(zips)
        parts.append(_decode(spark, archive_entries(raw, ratio, seed)).select("image"))
    # archives that are not looked into hold no images
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], T.StructType([
        T.StructField("image", IMAGE_TYPE)]))


def read_images_from_paths(df: DataFrame, pathCol: str, root: str | None = None,
                           imageCol: str = "image") -> DataFrame:
    """Add the decoded image named by a path column; null when missing or not decodable.

    Every named file is read once, however many rows name it; no other file is opened. With
    ``root``, a directory or glob below which the files lie, they are scanned there instead,
    without a copy, which is better where most of them are named.
    """
    key = unused_name("_path", df.columns)
    if root is not None:
        found = read_images(df.sparkSession, root, recursive=True, inspectZip=False).select(
            normal_path(F.col("image.path")).alias(key), F.col("image").alias(imageCol))
        named = df.withColumn(key, normal_path(F.col(f"`{pathCol}`")))
    else:
        named = stage_table(df.withColumn(key, normal_path(F.col(f"`{pathCol}`"))), "named-images")
        paths = named.select(F.col(key).alias("path")).filter("path IS NOT NULL").distinct()
        found = _decode(df.sparkSession, read_from_paths(paths, "path")).select(
            F.col("path").alias(key), F.col("image").alias(imageCol))
    # rows without a path match nothing; a key of their own keeps them out of a single task
    own = F.concat(F.lit("?"), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("string"))
    return (named.withColumn(key, F.coalesce(key, own)).join(found.hint("merge"), key, "left")
            .select(*[F.col(f"`{c}`") for c in df.columns], F.col(f"`{imageCol}`")))


def normal_path(path: Column) -> Column:
    """file:/a, file:///a and /a name the same file."""
    return F.regexp_replace(path, "^file:/*", "/")


def stream_images(spark: SparkSession, path: str, sink: Callable[[DataFrame, int], None],
                  checkpoint: str, recursive: bool = False, sampleRatio: float = 1.0,
                  seed: int = 0, files_per_batch: int = 1000, inspectZip: bool = True, **trigger):
    """Decode image files as they arrive and hand every micro-batch to ``sink(images, id)``.

    The image source has no streaming form, so the stream carries file names and every
    micro-batch is read again as images, archives unpacked to a folder of its own. ``files_per_batch``
    bounds the list of names that the driver passes on. Returns the running query, which belongs to
    a copy of the session: its source lists a batch by few tasks, and reads that number from the session that
    made it.
    """
    _check_ratio(sampleRatio)
    own = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    own.conf.set(LISTING_TASKS, str(spark.sparkContext.defaultParallelism))
    arrivals = (own.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
                .option("recursiveFileLookup", str(recursive).lower())
                .option("maxFilesPerTrigger", files_per_batch).load(path).select("path"))

    def decode(batch: DataFrame, batch_id: int) -> None:
        names = [r["path"] for r in batch.coalesce(1).collect()]
        if names:
            sink(_named_images(batch.sparkSession, names, sampleRatio, inspectZip, seed), batch_id)

    writer = arrivals.writeStream.foreachBatch(decode).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
