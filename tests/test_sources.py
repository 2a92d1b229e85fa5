"""Files, archives, images, sinks, exports and streams."""

import io
import json
import zipfile
from collections import Counter

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tablewright.catalog import QUERIES
from tablewright.sources.binary import read_binary_files, read_from_paths
from tablewright.sources.export import export, to_vector_columns, to_vector_text
from tablewright.sources.images import read_images, read_images_from_paths
from tablewright.sources.sinks import json_payloads, sent_payloads, write_files, write_json_batches
from tablewright.sources.tables import Cacher, CheckpointData, load_csv
from tests.conftest import values


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "deep").mkdir()
    for i in range(20):
        (tmp_path / f"f{i}.txt").write_bytes(bytes([i]) * (i + 1))
    (tmp_path / "deep" / "g.txt").write_bytes(b"deep")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("in/a.txt", b"A")
        z.writestr("b.txt", b"BB")
        z.writestr("empty/", b"")
    (tmp_path / "z.zip").write_bytes(out.getvalue())
    return str(tmp_path)


def names(df):
    return sorted(r["value"]["path"].rsplit("/", 1)[1] for r in df.collect())


def test_binary_scan(spark, folder):
    plain = read_binary_files(spark, folder, inspectZip=False)
    assert plain.columns == ["value"] and plain.count() == 21
    assert len(names(read_binary_files(spark, folder))) == 22
    assert len(names(read_binary_files(spark, folder, recursive=True))) == 23
    assert names(read_binary_files(spark, folder + "/f1*.txt")) == sorted(
        ["f1.txt"] + [f"f1{i}.txt" for i in range(10)])
    found = {r["value"]["path"].split("z.zip/")[-1]: bytes(r["value"]["bytes"])
             for r in read_binary_files(spark, folder).collect() if "z.zip" in r["value"]["path"]}
    assert found == {"in/a.txt": b"A", "b.txt": b"BB"}


def test_file_subsample(spark, folder):
    def pick(ratio, seed):
        return names(read_binary_files(spark, folder, sampleRatio=ratio, seed=seed))
    assert pick(0.5, 1) == pick(0.5, 1) and pick(0.5, 1) != pick(0.5, 2)
    assert pick(0.0, 1) == [] and len(pick(1.0, 1)) == 22 and set(pick(0.3, 1)) <= set(pick(0.6, 1))
    with pytest.raises(ValueError):
        pick(1.5, 1)


def test_sampled_scan_reads_no_unused_content(spark, folder):
    df = read_binary_files(spark, folder, inspectZip=False).select("value.path")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_read_from_paths(spark, folder):
    df = spark.createDataFrame([(1, f"{folder}/f3.txt"), (2, f"file:{folder}/f4.txt"), (3, f"{folder}/no.txt"),
                                (4, None)], "id int, path string")
    got = {r["id"]: r["bytes"] for r in read_from_paths(df, "path").collect()}
    assert got == {1: bytearray([3] * 4), 2: bytearray([4] * 5), 3: None, 4: None}


def bitmap(height, width):
    def n(v, size):
        return v.to_bytes(size, "little")
    data = bytes((7 * i) % 256 for i in range(height * width * 3))
    return (b"BM" + n(54 + len(data), 4) + n(0, 4) + n(54, 4) + n(40, 4) + n(width, 4)
            + n((1 << 32) - height, 4) + n(1, 2) + n(24, 2) + n(0, 4) + n(len(data), 4) + n(0, 16) + data), data


def test_images(spark, tmp_path):
    content, data = bitmap(2, 4)
    (tmp_path / "a.bmp").write_bytes(content)
    (tmp_path / "note.txt").write_text("no image")
    rows = read_images(spark, str(tmp_path)).collect()
    assert len(rows) == 1
    image = rows[0]["image"]
    assert (image["height"], image["width"], image["type"], bytes(image["bytes"])) == (2, 4, 16, data)
    named = spark.createDataFrame([(1, f"{tmp_path}/a.bmp"), (2, f"{tmp_path}/note.txt"), (3, f"{tmp_path}/a.bmp")],
                                  "id int, path string")
    got = {r["id"]: r["image"] for r in read_images_from_paths(named, "path", str(tmp_path)).collect()}
    assert got[2] is None and bytes(got[1]["bytes"]) == data == bytes(got[3]["bytes"])


def test_empty_and_broken_files(spark, tmp_path):
    (tmp_path / "a b+c%.txt").write_bytes(b"x")
    (tmp_path / "no bytes+1%.txt").write_bytes(b"")
    (tmp_path / "broken.zip").write_bytes(b"PK no archive")
    (tmp_path / "nothing.zip").write_bytes(b"")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("good.txt", b"good")
        z.writestr("bad.txt", b"some stored bytes")
        z.writestr("empty.txt", b"")
    (tmp_path / "half.ZIP").write_bytes(out.getvalue().replace(b"some stored", b"none stored"))
    found = {r["value"]["path"].split(tmp_path.name + "/")[1]: r["value"]["bytes"]
             for r in read_binary_files(spark, str(tmp_path)).collect()}
    assert found == {"a b+c%.txt": b"x", "no bytes+1%.txt": b"", "broken.zip": None, "half.ZIP/good.txt": b"good",
                     "half.ZIP/bad.txt": None, "half.ZIP/empty.txt": b""}
    raw = {r["value"]["path"].rsplit("/", 1)[1]: r["value"]["bytes"]
           for r in read_binary_files(spark, str(tmp_path), inspectZip=False).collect()}
    assert raw["nothing.zip"] == b"" and raw["broken.zip"] == b"PK no archive" and len(raw) == 5


def test_files_outside_of_the_sample_are_not_opened(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"{i}.txt").write_bytes(b"x" * 10)
    kept = names(read_binary_files(spark, str(tmp_path), sampleRatio=0.5, seed=3))
    assert 8 < len(kept) < 32
    for i in range(40):
        if f"{i}.txt" not in kept:
            (tmp_path / f"{i}.txt").write_bytes(b"x" * 1000)   # longer than what may be opened
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "100")
    try:
        assert names(read_binary_files(spark, str(tmp_path), sampleRatio=0.5, seed=3)) == kept
        with pytest.raises(Exception, match="(?i)length"):
            read_binary_files(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_many_files_are_listed_and_opened_in_tasks(spark, tmp_path, monkeypatch):
    """The driver held the status of every file, and a split of every scan for it."""
    from tablewright.sources import binary
    odd = ["a b+c%.txt", "ü ä\u2003%20.txt", "x[1]{2}#?.txt", "q&a=1;$,@!~'()*^`|<>\".txt", "e\u0301 日本.txt", "none.txt", "_hidden.txt", ".dot",
           "_a=b.txt", "y._COPYING_", "deep/er/1.txt", "_no/2.txt", "deep/three.ZIP", "broken.zip", "empty.zip", "new\nline"]
    for i, name in enumerate(odd):
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(b"" if name in ("none.txt", "empty.zip") else b"%d" % i)
    with zipfile.ZipFile(tmp_path / "in" / "deep" / "three.ZIP", "w") as z:
        for i in range(9):
            z.writestr(f"in/{i}", b"%d" % i)
    folder, rows = str(tmp_path / "in"), {}
    monkeypatch.setattr(binary, "TASKS_PER_CORE", 1)
    for most in (50_000, 0):
        monkeypatch.setattr(binary, "DRIVER_FILES", most)
        rows[most] = [sorted((r["value"]["path"], r["value"]["bytes"] or b"", r["value"]["bytes"] is None)
                             for r in read_binary_files(spark, at, deep, ratio, zips, 5).collect())
                      for at, deep, zips, ratio in ((folder, True, True, 1.0), (f"file://{folder}/", False, False, 1.0), (folder, True, True, 0.5))]
    assert rows[0] == rows[50_000] and len(rows[0][0]) == 19
    scan = read_binary_files(spark, folder, recursive=True)
    assert not any(folder in f for f in scan.inputFiles()) and "binaryFile" not in scan._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1")
    try:
        with pytest.raises(Exception, match="(?i)length"):
            read_binary_files(spark, folder).collect()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    (tmp_path / "in" / "k=1").mkdir()
    (tmp_path / "in" / "k=1" / "p.txt").write_bytes(b"p")
    assert binary.listed_files(spark, folder, False) is None and read_binary_files(spark, folder + "/*.txt").count() > 3


def test_images_in_archives_and_by_path(spark, tmp_path):
    content, data = bitmap(2, 4)
    (tmp_path / "ü plain+%.bmp").write_bytes(content)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("in/" + "d" * 150 + "/ä b.bmp", content)
        z.writestr("../up.bmp", content)
        z.writestr("note.txt", b"no image")
    (tmp_path / "z.zip").write_bytes(out.getvalue())
    rows = [r["image"] for r in read_images(spark, str(tmp_path)).collect()]
    assert all(bytes(i["bytes"]) == data and i["height"] == 2 for i in rows)
    assert sorted(i["path"].split(tmp_path.name + "/")[1] for i in rows) == sorted(
        ["ü plain+%.bmp", "z.zip/in/" + "d" * 150 + "/ä b.bmp", "z.zip/../up.bmp"])
    assert read_images(spark, str(tmp_path), inspectZip=False).count() == 1
    assert read_images(spark, str(tmp_path), sampleRatio=0.0).count() == 0
    places = [f"{tmp_path}/ü plain+%.bmp", f"file:{tmp_path}/ü plain+%.bmp", f"{tmp_path}/none.bmp", None, None,
              f"{tmp_path}/z.zip"]
    named = spark.createDataFrame([(i, p, "own") for i, p in enumerate(places)], "id int, path string, _path string")
    found = read_images_from_paths(named, "path")
    assert found.columns == ["id", "path", "_path", "image"]
    got = {r["id"]: r["image"] for r in found.collect()}
    assert bytes(got[0]["bytes"]) == data == bytes(got[1]["bytes"]) and [got[i] for i in (2, 3, 4, 5)] == [None] * 4


def test_images_are_decoded_a_bounded_number_at_a_time(spark, tmp_path, monkeypatch):
    """All files to decode were listed on the driver at once."""
    from tablewright.sources import images as module
    content, data = bitmap(1, 4)
    for i in range(30):
        (tmp_path / f"{i}.bmp").write_bytes(content)
    (tmp_path / "note.txt").write_text("no image")
    places = [(i, f"{tmp_path}/{i}.bmp") for i in range(30)] + [(30, f"{tmp_path}/note.txt"), (31, None), (32, f"{tmp_path}/0.bmp")]
    named = spark.createDataFrame(places, "id int, path string")
    listed, reader = [], type(spark.read)
    load = reader.load
    monkeypatch.setattr(reader, "load", lambda self, path=None, *a, **k: (lambda df: listed.append(len(df.inputFiles())) or df)(load(self, path, *a, **k)))
    found = []
    for most in (20_000, 5):
        monkeypatch.setattr(module, "DECODE_FILES", most)
        listed.clear()
        found.append({r["id"]: r["image"] and (r["image"]["path"], r["image"]["height"], bytes(r["image"]["bytes"]))
                      for r in read_images_from_paths(named, "path").collect()})
    assert found[0] == found[1] and len(found[0]) == 33 and found[0][30] is None and found[0][31] is None
    assert all(found[0][i] == (f"{tmp_path}/{i % 32}.bmp", 1, data) for i in (*range(30), 32))
    assert len(listed) > 3 and sum(listed) == 31 and max(listed) < 16


def test_tasks_do_not_grow_with_the_files(spark, folder, monkeypatch):
    """Small files took a task for each 32 of them."""
    from tablewright.sources import binary
    monkeypatch.setattr(binary, "TASKS_PER_CORE", 1)
    tasks = spark.sparkContext.defaultParallelism
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1")
    try:
        plain = spark.read.format("binaryFile").load(folder)
        assert plain.rdd.getNumPartitions() > tasks
        assert binary._shape(plain, 1.0, False, 0).rdd.getNumPartitions() == tasks
        assert names(read_binary_files(spark, folder, inspectZip=False))[0] == "f0.txt"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_image_stream_lists_a_batch_once_and_in_few_tasks(spark, tmp_path, monkeypatch):
    from tablewright.catalog.sources import _bitmap_header
    from tablewright.sources import images as module
    from tablewright.sources.binary import LISTING_TASKS
    picture = bytes.fromhex(_bitmap_header(4, 4)) + bytes(48)
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(5):
        (folder / f"{i}.bmp").write_bytes(picture)
    with zipfile.ZipFile(folder / "z.zip", "w") as z:
        z.writestr("a.bmp", picture)
        z.writestr("b.txt", b"no image")
    listed, read = [], module.read_images
    monkeypatch.setattr(module, "read_images", lambda s, path, *a, **k: listed.append(path) or read(s, path, *a, **k))
    seen, tasks = [], []

    def sink(found, batch_id):
        seen.extend(r["p"] for r in found.select(F.col("image.path").alias("p")).collect())
        tasks.append(int(found.sparkSession.conf.get(LISTING_TASKS)))
    outer = spark.conf.get(LISTING_TASKS, "10000")
    module.stream_images(spark, str(folder), sink, str(tmp_path / "progress"), availableNow=True).awaitTermination()
    assert sorted(p.rsplit("/", 1)[1] for p in seen) == [*(f"{i}.bmp" for i in range(5)), "a.bmp"]
    assert [len(names_) for names_ in listed] == [5]          # plain files only
    assert tasks == [spark.sparkContext.defaultParallelism] and spark.conf.get(LISTING_TASKS, "10000") == outer


def test_image_stream_lists_arrivals_in_few_tasks(spark, tmp_path):
    """The source of the stream took a task for each file of a batch, and every batch was listed twice more."""
    from tablewright.catalog.sources import _bitmap_header
    from tablewright.sources.images import stream_images
    (tmp_path / "in").mkdir()
    for i in range(60):
        (tmp_path / "in" / f"{i}.bmp").write_bytes(bytes.fromhex(_bitmap_header(1, 1)) + bytes(4))
    tracker, seen = spark.sparkContext.statusTracker(), []
    spark.sparkContext.setJobGroup("before", "before")
    spark.range(1).count()
    first = max(tracker.getJobIdsForGroup("before")) + 1

    def sink(found, batch_id):
        seen.append(found.count())
    stream_images(spark, str(tmp_path / "in"), sink, str(tmp_path / "progress"), files_per_batch=40,
                  availableNow=True).awaitTermination()
    spark.sparkContext.setJobGroup("after", "after")
    spark.range(1).count()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [tracker.getStageInfo(s) for job in range(first, min(tracker.getJobIdsForGroup("after")))
              for s in tracker.getJobInfo(job).stageIds]
    assert sum(seen) == 60 and max(s.numTasks for s in stages if s) < 40


def test_write_files_twice(spark, tmp_path):
    df = spark.createDataFrame([("x/1.bin", bytearray(b"one")), ("2.bin", bytearray(b"")), ("3.bin", None)],
                               "name string, data binary")
    for _ in range(2):
        write_files(df, str(tmp_path / "out"), "name", "data")
    found = {str(p.relative_to(tmp_path / "out")): p.read_bytes() for p in (tmp_path / "out").rglob("*")
             if p.is_file() and not p.name.startswith(".")}
    assert found == {"x/1.bin": b"one", "2.bin": b"", "3.bin": b""}


def test_files_of_one_row_group_are_dealt_to_many_tasks(spark, tmp_path, monkeypatch):
    rows = [(i, f"text {i}", "en" if i % 3 else "fr") for i in range(400)] + [(7, "text 7", "en"), (401, "lost", None), (402, None, "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    seen, kind = [], type(spark.range(1))
    arrow = kind.mapInArrow

    def look(self, *given, **named):
        seen.append([r["count"] for r in self.groupBy(F.spark_partition_id()).count().collect()])
        return arrow(self, *given, **named)
    monkeypatch.setattr(kind, "mapInArrow", look)
    found = Counter(tuple(r) for r in QUERIES["a8_read_from_paths"](spark, str(tmp_path)).collect())
    assert found == Counter((i, len(text), text) if lang and text else (i, 0, "") if lang else (i, None, None) for i, text, lang in rows)
    assert len(seen) == 2 and all(sum(tasks) == 403 and max(tasks) < 200 for tasks in seen)


def test_payloads_are_sent_by_the_process_that_packs_them(spark):
    plan = sent_payloads(spark.range(50), lambda part, n, payload: None, 20)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") == 1


def test_json_payloads(spark, tmp_path):
    df = spark.range(0, 250, 1, 3).withColumn("t", F.concat(F.lit('quo"te '), "id"))
    out = json_payloads(df, 40).collect()
    assert all(len(json.loads(r["payload"])) == r["rows"] <= 40 for r in out)
    assert sorted(x["id"] for r in out for x in json.loads(r["payload"])) == list(range(250))
    target = str(tmp_path)

    def send(payload):
        import uuid
        with open(f"{target}/{uuid.uuid4().hex}.json", "w") as f:
            f.write(payload)
    write_json_batches(df, send, 100)
    assert spark.read.option("multiLine", True).json(target).count() == 250
    with pytest.raises(ValueError):
        json_payloads(df, 0)


def test_tables(spark, tmp_path):
    df = spark.range(5).withColumn("s", F.lit("a"))
    df.coalesce(1).write.option("header", True).option("sep", "\t").csv(str(tmp_path / "c"))
    assert values(load_csv(spark, str(tmp_path / "c"), sep="\t")) == [(i, "a") for i in range(5)]
    assert Cacher(disable=True).transform(df).storageLevel.useMemory is False
    kept = Cacher().transform(df)
    assert kept.storageLevel.useMemory and CheckpointData(removeCheckpoint=True).transform(kept).storageLevel.useMemory is False
    disk = CheckpointData(diskIncluded=True).transform(spark.range(3))
    assert disk.storageLevel.useDisk
    disk.unpersist()


def test_vector_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, Vectors.sparse(3, {1: 2.5})), (0, Vectors.dense(1.0, 0.0, -1.0))], ["y", "x"])
    assert [r[0] for r in to_vector_text(df, "y", "x").collect()] == ["|y 1.0 |x 0.0 2.5 0.0", "|y 0.0 |x 1.0 0.0 -1.0"]
    assert [r[0] for r in to_vector_text(df, "y", "x", featureForm="sparse").collect()] == [
        "|y 1.0 |x 1:2.5", "|y 0.0 |x 0:1.0 2:-1.0"]
    wide = to_vector_columns(df, "y", "x", featureForm="sparse", precision="double")
    assert wide.columns == ["x_size", "x_indices", "x_values", "y"] and [tuple(r) for r in wide.collect()] == [
        (1, [1], [2.5], [1.0]), (2, [0, 2], [1.0, -1.0], [0.0])]
    assert dict(to_vector_columns(df, "y", "x").dtypes)["x"] == "array<float>"
    for bad in ({"featureForm": "round"}, {"labelForm": "round"}):
        with pytest.raises(ValueError):
            to_vector_text(df, "y", "x", **bad)
    export(to_vector_text(df, "y", "x"), str(tmp_path / "t"), "text", 1)
    assert len(list((tmp_path / "t").glob("part-*"))) == 1
    with pytest.raises(ValueError):
        export(df, str(tmp_path / "u"), "orc")


def test_shared_folder_is_the_sessions(spark):
    from tablewright.plans import staging
    folder = staging.shared_folder(spark)
    assert folder == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
    path = staging.new_path(spark, "x")
    assert path.startswith(folder) and path != staging.new_path(spark, "x")
