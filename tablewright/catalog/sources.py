"""Queries A: scans, files, streams and sinks."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tablewright.catalog.common import (
    CHANNELS, IMAGES_SQL, SIDE, joined, pixel_values, query, table,
)
from tablewright.functions.images import to_bytes, unsigned_bytes
from tablewright.plans.staging import new_path
from tablewright.sources.binary import (
    read_binary_files, read_from_paths, stream_binary_files,
)
from tablewright.sources.export import export, to_vector_columns, to_vector_text
from tablewright.sources.images import read_images, read_images_from_paths, stream_images
from tablewright.sources.sinks import WRITERS_PER_CORE, json_payloads, stream_json, write_files
from tablewright.sources.tables import (
    Cacher, CheckpointData, load_csv, persist_to_table,
)
from tablewright.streaming.stages import memory_table, run_to_table, stream_table


@query("a1_parquet_scan", "SELECT * FROM lineitem")
def a1_parquet_scan(spark, sf):
    return table(spark, sf, "lineitem")


@query("a1_csv_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def a1_csv_scan(spark, sf):
    source = table(spark, sf, "customer")
    path = new_path(spark, "csv")
    source.write.option("header", True).option("sep", "|").csv(path)
    return load_csv(spark, path, schema=source.schema, sep="|")


def _text_name(*folder):
    return F.concat(F.col("lang"), F.lit("/"), *folder, F.col("doc_id"), F.lit(".txt"))


def _text_files(spark, sf, folder, name=None):
    """Every document as a file ``lang/doc_id.txt``, or by another name."""
    docs = table(spark, sf, "documents")
    write_files(docs.select(
        (_text_name() if name is None else name).alias("name"),
        F.encode("text", "UTF-8").alias("content")), folder, "name", "content")


def _documents(values):
    """(doc_id, bytes, text) from ``value=struct<path,bytes>`` rows."""
    return values.select(
        F.regexp_extract("value.path", r"(\d+)\.txt$", 1).cast("long").alias("doc_id"),
        F.octet_length("value.bytes").cast("long").alias("bytes"),
        F.decode("value.bytes", "UTF-8").alias("text"))


DOCUMENTS_SQL = "SELECT doc_id, CAST(octet_length(encode(text)) AS BIGINT) AS bytes, text FROM documents"


@query("a2_binary_scan", DOCUMENTS_SQL)
def a2_binary_scan(spark, sf):
    folder = new_path(spark, "files")
    _text_files(spark, sf, folder)
    return _documents(read_binary_files(spark, folder, recursive=True))


@query("a2_binary_scan_empty", """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 0 ELSE CAST(octet_length(encode(text)) AS BIGINT) END AS bytes,
       CASE WHEN doc_id % 3 = 0 THEN '' ELSE text END AS text FROM documents""")
def a2_binary_scan_empty(spark, sf):
    """Every third file has no bytes, and comes back as well."""
    folder = new_path(spark, "files")
    content = F.when(F.col("doc_id") % 3 != 0, F.encode("text", "UTF-8")).otherwise(F.lit(b""))
    write_files(table(spark, sf, "documents").select(
        F.concat(F.lit("d+ %"), F.col("lang"), F.lit("/"), F.col("doc_id"), F.lit(".txt")).alias("name"),
        content.alias("content")), folder, "name", "content")
    return _documents(read_binary_files(spark, folder, recursive=True))


@query("a3_file_subsample", """SELECT lang, CAST(count(*) AS BIGINT) AS files, true AS share_in_bounds,
       true AS contents_equal, true AS sample_repeats FROM documents GROUP BY lang""")
def a3_file_subsample(spark, sf):
    """A sample of half of the files, held against all of them: the share per folder, the contents,
    and that the same seed draws the same files again."""
    folder = new_path(spark, "files")
    _text_files(spark, sf, folder)
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")

    def drawn():
        return _documents(read_binary_files(spark, folder, recursive=True, sampleRatio=0.5, seed=7))

    both = (docs.join(drawn().select("doc_id", F.col("text").alias("found")), "doc_id", "left")
            .join(drawn().select("doc_id", F.lit(True).alias("again")), "doc_id", "left"))
    n, hits = F.count("*"), F.count("found")
    return both.groupBy("lang").agg(
        n.alias("files"),
        # within five deviations of a half
        (F.abs(hits - n / 2) <= 2.5 * F.sqrt(n)).alias("share_in_bounds"),
        F.coalesce(F.bool_and(F.col("found") == F.col("text")), F.lit(True)).alias("contents_equal"),
        F.bool_and(F.col("found").isNotNull() == F.col("again").isNotNull()).alias("sample_repeats"))


ARCHIVE_ENTRIES = 64


def _pack(batches):
    """Archives of a bounded number of the passing rows."""
    for batch in batches:
        for start in range(0, len(batch), ARCHIVE_ENTRIES):
            part = batch.iloc[start:start + ARCHIVE_ENTRIES]
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w") as z:
                for doc_id, text in zip(part["doc_id"], part["text"]):
                    z.writestr(f"{doc_id}.txt", text.encode("utf-8"))
            yield pd.DataFrame({"name": [f"part-{part['doc_id'].iloc[0]}.zip"],
                                "content": [out.getvalue()]})


@query("a4_zip_expansion", DOCUMENTS_SQL)
def a4_zip_expansion(spark, sf):
    folder = new_path(spark, "zips")
    packed = table(spark, sf, "documents").select("doc_id", "text").mapInPandas(
        _pack, "name string, content binary")
    write_files(packed, folder, "name", "content")
    return _documents(read_binary_files(spark, folder, inspectZip=True))


@query("a5_binary_stream", DOCUMENTS_SQL)
def a5_binary_stream(spark, sf):
    folder = new_path(spark, "files")
    _text_files(spark, sf, folder)
    stream = stream_binary_files(spark, folder, recursive=True)
    return _documents(run_to_table(stream, new_path(spark, "out"), new_path(spark, "progress")))


def _hex(number: int, size: int) -> str:
    return number.to_bytes(size, "little").hex()


def _bitmap_header(height: int, width: int) -> str:
    """Header of an uncompressed 24-bit bitmap stored from the top row down."""
    data = height * width * CHANNELS
    return ("424d" + _hex(54 + data, 4) + _hex(0, 4) + _hex(54, 4) + _hex(40, 4) + _hex(width, 4)
            + _hex((1 << 32) - height, 4) + _hex(1, 2) + _hex(24, 2) + _hex(0, 4) + _hex(data, 4)
            + _hex(0, 16))


def _image_files(spark, sf, folder):
    """Every embedding as a bitmap ``label/vec_id.bmp`` (rows are whole words long)."""
    e = table(spark, sf, "embeddings")
    header = F.unhex(F.lit(_bitmap_header(SIDE, SIDE)))
    write_files(e.select(
        F.concat(F.col("label"), F.lit("/"), F.col("vec_id"), F.lit(".bmp")).alias("name"),
        F.concat(header, to_bytes(pixel_values(F.col("embedding")))).alias("content")),
        folder, "name", "content")


def _pictures(images):
    return images.select(
        F.regexp_extract("image.path", r"(\d+)\.bmp$", 1).cast("long").alias("vec_id"),
        F.col("image.height").alias("height"), F.col("image.width").alias("width"),
        F.col("image.type").alias("type"),
        joined(unsigned_bytes(F.col("image.bytes"))).alias("pixels"))


PICTURES_SQL = f"""WITH {IMAGES_SQL}
SELECT vec_id, 8 AS height, 8 AS width, 16 AS type, array_to_string(px, ',') AS pixels FROM img"""


@query("a6_image_scan", PICTURES_SQL)
def a6_image_scan(spark, sf):
    folder = new_path(spark, "images")
    _image_files(spark, sf, folder)
    return _pictures(read_images(spark, folder, recursive=True))


@query("a7_image_stream", PICTURES_SQL)
def a7_image_stream(spark, sf):
    folder, out = new_path(spark, "images"), new_path(spark, "out")
    _image_files(spark, sf, folder)

    def sink(images, batch_id):
        # one folder per micro-batch: a repeated batch replaces its own rows
        images.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    stream_images(spark, folder, sink, new_path(spark, "progress"), recursive=True,
                  availableNow=True).awaitTermination()
    return _pictures(spark.read.parquet(out))


def _image_archives(spark, sf, folder):
    """Archives of the embeddings' bitmaps."""
    e = table(spark, sf, "embeddings")
    header = F.unhex(F.lit(_bitmap_header(SIDE, SIDE)))
    rows = e.select("vec_id", F.concat(header, to_bytes(pixel_values(F.col("embedding")))).alias("content"))

    def pack(batches):
        for batch in batches:
            for start in range(0, len(batch), ARCHIVE_ENTRIES):
                part = batch.iloc[start:start + ARCHIVE_ENTRIES]
                out = io.BytesIO()
                with zipfile.ZipFile(out, "w") as z:
                    for vec_id, content in zip(part["vec_id"], part["content"]):
                        z.writestr(f"in/{vec_id}.bmp", bytes(content))
                yield pd.DataFrame({"name": [f"part-{part['vec_id'].iloc[0]}.zip"], "content": [out.getvalue()]})
    write_files(rows.mapInPandas(pack, "name string, content binary"), folder, "name", "content")


@query("a6_image_zip", PICTURES_SQL)
def a6_image_zip(spark, sf):
    folder = new_path(spark, "image-zips")
    _image_archives(spark, sf, folder)
    return _pictures(read_images(spark, folder))


@query("a7_image_zip_stream", PICTURES_SQL)
def a7_image_zip_stream(spark, sf):
    folder, out = new_path(spark, "image-zips"), new_path(spark, "out")
    _image_archives(spark, sf, folder)

    def sink(images, batch_id):
        images.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    stream_images(spark, folder, sink, new_path(spark, "progress"), files_per_batch=8,
                  availableNow=True).awaitTermination()
    return _pictures(spark.read.parquet(out))


@query("a8_read_from_paths", DOCUMENTS_SQL)
def a8_read_from_paths(spark, sf):
    folder = new_path(spark, "files")
    # many folders, as tasks that make files in one wait for each other; nothing lists them
    name = _text_name(F.pmod(F.xxhash64("doc_id"), F.lit(256)), F.lit("/"))
    _text_files(spark, sf, folder, name)
    names = table(spark, sf, "documents").select("doc_id", F.concat(F.lit(folder + "/"), name).alias("path"))
    tasks = WRITERS_PER_CORE * spark.sparkContext.defaultParallelism
    read = read_from_paths(names.repartition(tasks, "path"), "path")
    return read.select("doc_id", F.octet_length("bytes").cast("long").alias("bytes"),
                       F.decode("bytes", "UTF-8").alias("text"))


@query("a8_images_from_paths", f"""WITH {IMAGES_SQL}
SELECT vec_id, label, array_to_string(px, ',') AS pixels FROM img""")
def a8_images_from_paths(spark, sf):
    folder = new_path(spark, "images")
    _image_files(spark, sf, folder)
    names = table(spark, sf, "embeddings").select("vec_id", "label", F.concat(
        F.lit(folder + "/"), F.col("label"), F.lit("/"), F.col("vec_id"), F.lit(".bmp")).alias("path"))
    read = read_images_from_paths(names, "path")
    return read.select("vec_id", "label", joined(unsigned_bytes(F.col("image.bytes"))).alias("pixels"))


@query("a9_write_files", "SELECT page_id, url, html FROM pages")
def a9_write_files(spark, sf):
    pages, folder = table(spark, sf, "pages"), new_path(spark, "pages")
    write_files(pages.select(F.concat("page_id", F.lit(".html")).alias("name"),
                             F.encode("html", "UTF-8").alias("html")), folder, "name", "html")
    back = read_binary_files(spark, folder).select(
        F.regexp_extract("value.path", r"(\d+)\.html$", 1).cast("long").alias("page_id"),
        F.decode("value.bytes", "UTF-8").alias("html"))
    return pages.select("page_id", "url").join(back, "page_id")


EVENTS_SQL = "SELECT event_id, user_id, event_type, value, props FROM events"
EVENT_ROW = "array<struct<event_id: long, user_id: long, event_type: string, value: double, props: string>>"


def _events(spark, sf):
    return table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "props")


@query("a10_json_payloads", EVENTS_SQL)
def a10_json_payloads(spark, sf):
    payloads = json_payloads(_events(spark, sf), batch_size=500)
    return payloads.select(F.inline(F.from_json("payload", EVENT_ROW)))


@query("a11_json_stream", EVENTS_SQL)
def a11_json_stream(spark, sf):
    out = new_path(spark, "payloads")
    stream = stream_table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "value", "props")

    def send(key, payload):
        # the key is the file name, so a payload that is sent again replaces itself
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(
            "file://" + out[len("file:"):] if out.startswith("file:/")
            and not out.startswith("file://") else out)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/{key}.json") as f:
            f.write(payload.encode("utf-8"))
    stream_json(stream, send, new_path(spark, "progress"), batch_size=500,
                availableNow=True).awaitTermination()
    files = read_binary_files(spark, out)
    return files.select(F.inline(F.from_json(F.decode("value.bytes", "UTF-8"), EVENT_ROW)))


@query("a12_memory_sink_sql",
       "SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY event_type")
def a12_memory_sink_sql(spark, sf):
    name = new_path(spark, "memory").rsplit("/", 1)[1].replace("-", "_")
    counts = stream_table(spark, sf, "events").groupBy("event_type").count()
    q = memory_table(counts, name, "complete")
    q.processAllAvailable()
    q.stop()
    return spark.sql(f"SELECT event_type, count AS n FROM {name}")


@query("a13_cache", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def a13_cache(spark, sf):
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    return Cacher(disable=False).transform(table(spark, sf, "orders").select(*columns))


@query("a13_checkpoint_data", "SELECT p_partkey, p_name, p_size FROM part")
def a13_checkpoint_data(spark, sf):
    kept = CheckpointData(diskIncluded=True).transform(
        table(spark, sf, "part").select("p_partkey", "p_name", "p_size"))
    return CheckpointData(removeCheckpoint=True).transform(kept)


@query("a14_persist_to_table", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def a14_persist_to_table(spark, sf):
    path = new_path(spark, "database")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    persist_to_table(table(spark, sf, "supplier"), name, "supplier")
    persist_to_table(table(spark, sf, "supplier"), name, "supplier")
    return spark.table(f"{name}.supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")


def _steps(spark, sf):
    """Embeddings in whole steps of a tenth, about a third of them zero."""
    return table(spark, sf, "embeddings").select("label", F.transform(
        "embedding", lambda x: F.floor(x.cast("double") * 10).cast("double")).alias("features"))


STEPS_SQL = """steps AS (SELECT label,
    [CAST(floor(CAST(x AS DOUBLE) * 10) AS DOUBLE) + 0.0 for x in embedding] AS f FROM embeddings)"""


@query("a15_vector_text_dense", f"""WITH {STEPS_SQL}
SELECT '|label ' || CAST(CAST(label AS DOUBLE) AS VARCHAR) || ' |features '
       || array_to_string([CAST(v AS VARCHAR) for v in f], ' ') AS value FROM steps""")
def a15_vector_text_dense(spark, sf):
    df = _steps(spark, sf).withColumn("features", array_to_vector("features"))
    return to_vector_text(df, "label", "features")


@query("a15_vector_text_sparse", f"""WITH {STEPS_SQL}
SELECT '|label ' || CAST(CAST(label AS DOUBLE) AS VARCHAR) || ' |features '
       || array_to_string([CAST(i AS VARCHAR) || ':' || CAST(f[i + 1] AS VARCHAR)
                           for i in range(len(f)) if f[i + 1] <> 0], ' ') AS value FROM steps""")
def a15_vector_text_sparse(spark, sf):
    return to_vector_text(_steps(spark, sf), "label", "features", featureForm="sparse")


@query("a16_vector_columns", f"""WITH {STEPS_SQL}
SELECT CAST(label AS BIGINT) AS label,
       CAST(len([i for i in range(len(f)) if f[i + 1] <> 0]) AS INTEGER) AS features_size,
       array_to_string([i for i in range(len(f)) if f[i + 1] <> 0], ',') AS features_indices,
       array_to_string([CAST(v AS BIGINT) for v in f if v <> 0], ',') AS features_values
FROM steps""")
def a16_vector_columns(spark, sf):
    out = to_vector_columns(_steps(spark, sf), "label", "features", featureForm="sparse")
    return out.select(F.col("label")[0].cast("long").alias("label"), "features_size",
                      joined(F.col("features_indices")).alias("features_indices"),
                      joined(F.col("features_values")).alias("features_values"))


@query("a17_export", f"""WITH {STEPS_SQL}
SELECT '|label ' || CAST(CAST(label AS DOUBLE) AS VARCHAR) || ' |features '
       || array_to_string([CAST(v AS VARCHAR) for v in f], ' ') AS value FROM steps""")
def a17_export(spark, sf):
    path = new_path(spark, "export")
    export(to_vector_text(_steps(spark, sf), "label", "features"), path, "text", partitions=2)
    return spark.read.text(path)
