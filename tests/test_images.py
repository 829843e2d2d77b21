"""Images (A4, L1, L2, E2) on PNG files written by the test with zlib."""

import os
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.joins import attach_images, zero_filled
from ledgerlens.plans.images import encode_png, image_quality, image_table, read_images
from ledgerlens.sources.readers import scan_images
from ledgerlens.sources.writers import write_files


def write_png(path, pixels: np.ndarray):
    """Minimal RGB PNG writer (8-bit, filter 0)."""
    h, w, _ = pixels.shape
    raw = b"".join(b"\x00" + pixels[y].astype(np.uint8).tobytes() for y in range(h))

    def chunk(tag, data):
        c = struct.pack(">I", len(data)) + tag + data
        return c + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)

    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0))
    png += chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
    with open(path, "wb") as f:
        f.write(png)


def make_images(folder):
    os.makedirs(folder, exist_ok=True)
    img = np.zeros((8, 10, 3), dtype=np.uint8)
    img[:, :5] = (200, 30, 30)   # left half red-ish and bright enough
    img[:, 5:] = (10, 10, 10)    # right half dark
    write_png(f"{folder}/a.png", img)
    write_png(f"{folder}/b.png", np.full((4, 4, 3), 255, dtype=np.uint8))
    with open(f"{folder}/broken.png", "wb") as f:
        f.write(b"\x89PNG\r\n\x1a\nnot really")
    with open(f"{folder}/notes.txt", "w") as f:
        f.write("ignored")


def test_scan_images(spark, tmp):
    make_images(f"{tmp}/img")
    df = scan_images(spark, f"{tmp}/img")
    assert sorted(r.file_name for r in df.collect()) == ["a.png", "b.png", "broken.png"]


def test_image_table_and_attach(spark, tmp):
    make_images(f"{tmp}/img")
    t = image_table(spark, f"{tmp}/img", size=4)
    rows = {r.file_name: r for r in t.collect()}
    assert rows["broken.png"].corrupt and rows["broken.png"].image is None
    a = np.asarray(rows["a.png"].image, dtype=np.float32).reshape(3, 4, 4)
    # left columns: red channel 200/255 normalised; RGB order (source is BGR)
    assert np.isclose(a[0, 0, 0], (200 / 255 - 0.485) / 0.229, atol=1e-5)
    assert np.isclose(a[2, 0, 0], (30 / 255 - 0.406) / 0.225, atol=1e-5)
    feats = spark.createDataFrame([("a.png",), ("missing.png",), ("broken.png",)], "file_name string")
    j = {r.file_name: r.image for r in attach_images(feats, t, height=4, width=4).collect()}
    assert j["missing.png"] == [0.0] * 48 and j["broken.png"] == [0.0] * 48 and len(j["a.png"]) == 48


def test_image_quality_otsu(spark, tmp):
    make_images(f"{tmp}/img")
    q = {r.file_name: r for r in image_quality(spark, f"{tmp}/img").collect()}
    assert q["broken.png"].corrupt and q["broken.png"].threshold is None and not q["a.png"].corrupt
    a = q["a.png"]
    gray_dark, gray_light = 10, round(0.299 * 200 + 0.587 * 30 + 0.114 * 30)
    assert gray_dark <= a.threshold < gray_light
    assert a.n_pixels == 80 and abs(a.dark_share - 0.5) < 1e-9


def test_written_files_are_whole_and_writing_again_changes_nothing(spark, tmp):
    px = np.arange(4 * 5 * 3, dtype=np.uint8).reshape(4, 5, 3)
    rows = [("p.png", 4, 5, px.tobytes()), ("short.png", 4, 5, b"abc"), ("none.png", None, None, None), (None, 4, 5, px.tobytes())]
    df = spark.createDataFrame(rows, "file_name string, height int, width int, data binary").repartition(2)
    assert write_files(encode_png(df), f"{tmp}/out") == 1 == write_files(encode_png(df), f"{tmp}/out")
    assert os.listdir(f"{tmp}/out") == ["p.png"]
    got = read_images(spark, f"{tmp}/out").first()
    assert (got.height, got.width, got.n_channels) == (4, 5, 3)
    assert (np.frombuffer(got.data, np.uint8).reshape(4, 5, 3)[:, :, ::-1] == px).all()  # BGR
    with pytest.raises(Exception, match="must not hold a slash"):
        write_files(spark.createDataFrame([("a/b", bytearray(b"x"))], "file_name string, content binary"), f"{tmp}/out")
    assert write_files(df.limit(0).select("file_name", F.col("data").alias("content")), f"{tmp}/empty") == 0


def test_missing_tensors_stay_null_until_used(spark, tmp):
    make_images(f"{tmp}/img")
    t = image_table(spark, f"{tmp}/img", size=2)
    feats = spark.createDataFrame([("a.png", 1), ("missing.png", 2), ("broken.png", 3), (None, 4), ("a.png", 5)], "file_name string, image_id int")
    j = attach_images(feats, t, height=2, width=2, fill=False)
    rows = {r.image_id: r for r in j.collect()}
    assert [rows[i].image_state for i in range(1, 6)] == ["found", "missing", "corrupt", "missing", "found"]
    assert rows[2].image is None and rows[1].image == rows[5].image
    used = {r.image_id: r.image for r in j.withColumn("image", zero_filled("image", 12)).collect()}
    assert used[2] == used[3] == used[4] == [0.0] * 12 and used[1] == rows[1].image
    plan = attach_images(feats, t)._jdf.queryExecution().optimizedPlan().toString()
    assert "0.0,0.0,0.0" not in plan and len(plan) < 20_000  # the zeros are no literal


def test_many_small_files_share_tasks(spark, tmp):
    rows = [(f"f{i:04d}.png", bytearray(f"x{i}".encode())) for i in range(600)]
    write_files(spark.createDataFrame(rows, "file_name string, content binary"), f"{tmp}/many")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        raw = spark.read.format("binaryFile").load(f"{tmp}/many")
        df = scan_images(spark, f"{tmp}/many")
        assert df.rdd.getNumPartitions() < raw.rdd.getNumPartitions() and df.count() == 600
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
