"""Images (L1, L2): decoded by Spark's ``image`` source, pixels processed per Arrow batch.

Spark decodes PNG/JPEG itself (rows of BGR bytes; undecodable files come back
with height -1 when ``dropInvalid`` is false). The pixel work that has no
built-in expression runs in ``mapInPandas`` with numpy, one image at a time
inside a partition; Otsu's threshold is then chosen with window sums over the
256-bin histograms in Spark.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import packed

# Per-channel normalisation of RGB images scaled to 0-1.
IMAGE_MEAN = (0.485, 0.456, 0.406)
IMAGE_STD = (0.229, 0.224, 0.225)
# BT.601 luma weights in 14-bit fixed point (R, G, B), as used for 8-bit gray conversion.
GRAY_WEIGHTS_Q14 = (4899, 9617, 1868)
TENSOR_ROWS = 16  # tensors held by a task at once


def png(data: bytes, height: int, width: int, level: int = 6) -> bytes:
    """An 8-bit RGB picture (height * width * 3 bytes) as a PNG file."""
    def chunk(tag: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + tag + body + struct.pack(">I", zlib.crc32(tag + body))

    row = 3 * width
    lines = b"".join(b"\0" + data[y * row:(y + 1) * row] for y in range(height))  # filter type 0 before each line
    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines, level)) + chunk(b"IEND", b"")


def encode_png(df: DataFrame, level: int = 6) -> DataFrame:
    """(file_name, content): PNG files of (file_name, height, width, data[RGB bytes]), made in Arrow batches.

    Rows whose bytes are missing or do not fill the picture get null content.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True)
            content = [png(x, h, w, level) if x is not None and h and w and len(x) == 3 * h * w else None for h, w, x in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(content, pa.binary())], names=["file_name", "content"])

    return df.select("file_name", "height", "width", "data").mapInArrow(run, "file_name string, content binary")


def read_images(spark: SparkSession, path: str, pattern: str = "*.{jpg,png}") -> DataFrame:
    """Decoded images with file names: (file_name, height, width, n_channels, data[BGR bytes])."""
    raw = packed(spark.read.format("image").option("dropInvalid", "false").option("pathGlobFilter", pattern)
                 .load(path))
    return raw.select(
        F.element_at(F.split("image.origin", "/"), -1).alias("file_name"),
        F.col("image.height").alias("height"), F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("n_channels"), F.col("image.data").alias("data"),
    )


def _to_rgb(data: bytes, h: int, w: int, c: int) -> np.ndarray | None:
    if h is None or h <= 0 or w <= 0 or c not in (1, 3, 4) or data is None or len(data) != h * w * c:
        return None
    px = np.frombuffer(data, dtype=np.uint8).reshape(h, w, c)
    if c == 1:
        return np.repeat(px, 3, axis=2)
    return px[:, :, 2::-1] if c >= 3 else px  # BGR(A) -> RGB


def _resize_nearest(img: np.ndarray, size: int) -> np.ndarray:
    h, w = img.shape[:2]
    rows = np.minimum((np.arange(size) * h / size).astype(np.int64), h - 1)
    cols = np.minimum((np.arange(size) * w / size).astype(np.int64), w - 1)
    return img[rows][:, cols]


def image_table(spark: SparkSession, path: str, size: int = 224) -> DataFrame:
    """L1: (file_name, corrupt, height, width, image) with image = normalised CHW floats of size x size.

    Unreadable files keep their row: corrupt = true and a null tensor (E2 then
    substitutes zeros). Resizing is nearest-neighbour.
    """
    mean = np.asarray(IMAGE_MEAN, dtype=np.float32).reshape(3, 1, 1)
    std = np.asarray(IMAGE_STD, dtype=np.float32).reshape(3, 1, 1)

    def tensor(data, h, w, c):
        rgb = _to_rgb(data, h, w, c)
        if rgb is None:
            return None
        x = _resize_nearest(rgb, size).astype(np.float32) / 255.0
        return ((x.transpose(2, 0, 1) - mean) / std).reshape(-1)

    def convert(batches):
        for batch in batches:
            for i in range(0, len(batch), TENSOR_ROWS):  # a few tensors at a time, not a whole batch
                pdf = batch.iloc[i:i + TENSOR_ROWS]
                tensors = [tensor(*r) for r in zip(pdf["data"], pdf["height"], pdf["width"], pdf["n_channels"])]
                yield pd.DataFrame({"file_name": pdf["file_name"], "corrupt": [t is None for t in tensors],
                                    "height": pdf["height"], "width": pdf["width"], "image": tensors})

    return read_images(spark, path).mapInPandas(
        convert, "file_name string, corrupt boolean, height int, width int, image array<float>")


def gray_histograms(spark: SparkSession, path: str) -> DataFrame:
    """256-bin gray-level histogram: (file_name, bin, count); an unreadable image is one row with null bin and count."""
    wr, wg, wb = GRAY_WEIGHTS_Q14

    def hist(batches):
        for pdf in batches:
            out = []
            for name, data, h, w, c in zip(pdf["file_name"], pdf["data"], pdf["height"], pdf["width"],
                                           pdf["n_channels"]):
                rgb = _to_rgb(data, h, w, c)
                if rgb is None:
                    out.append(pd.DataFrame({"file_name": [name], "bin": pd.array([None], "Int32"),
                                             "count": pd.array([None], "Int64")}))
                    continue
                p = rgb.astype(np.int64)
                gray = (p[:, :, 0] * wr + p[:, :, 1] * wg + p[:, :, 2] * wb + (1 << 13)) >> 14
                counts = np.bincount(gray.reshape(-1), minlength=256)[:256]
                out.append(pd.DataFrame({"file_name": name, "bin": pd.array(np.arange(256), "Int32"),
                                         "count": pd.array(counts, "Int64")}))
            if out:
                yield pd.concat(out, ignore_index=True)

    return read_images(spark, path).mapInPandas(hist, "file_name string, bin int, count long")


def otsu_threshold(hist: DataFrame) -> DataFrame:
    """Otsu threshold per image from (file_name, bin, count): the bin maximising between-class variance.

    Cumulative sums are windows over each image's 256 bins (bounded per image);
    the first maximum wins. Output: (file_name, threshold, n_pixels, dark_share).
    """
    w = Window.partitionBy("file_name").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("file_name")
    x = hist.select(
        "file_name", "bin", "count",
        F.sum("count").over(w).alias("w0"), F.sum(F.col("bin") * F.col("count")).over(w).alias("s0"),
        F.sum("count").over(whole).alias("n"), F.sum(F.col("bin") * F.col("count")).over(whole).alias("s"),
    )
    w1 = F.col("n") - F.col("w0")
    mu0 = F.col("s0") / F.col("w0")
    mu1 = (F.col("s") - F.col("s0")) / w1
    var = F.when((F.col("w0") > 0) & (w1 > 0),
                 (F.col("w0") / F.col("n")) * (w1 / F.col("n")) * (mu0 - mu1) * (mu0 - mu1)).otherwise(F.lit(0.0))
    best = x.withColumn("var", var).groupBy("file_name").agg(
        F.max_by(F.struct(F.col("bin"), (F.col("w0") / F.col("n")).alias("dark")),
                 F.struct(F.col("var"), -F.col("bin"))).alias("b"),
        F.first("n").alias("n_pixels"))
    return best.select("file_name", F.col("b.bin").alias("threshold"), "n_pixels",
                       F.col("b.dark").alias("dark_share"))


def image_quality(spark: SparkSession, path: str) -> DataFrame:
    """L2: Otsu threshold and dark-pixel share per image; unreadable files keep a row with ``corrupt`` set and nulls."""
    hist = gray_histograms(spark, path)
    good = otsu_threshold(hist.where("bin IS NOT NULL")).withColumn("corrupt", F.lit(False))
    null = F.lit(None)
    bad = hist.where("bin IS NULL").select(
        "file_name", null.cast("int").alias("threshold"), null.cast("long").alias("n_pixels"),
        null.cast("double").alias("dark_share"), F.lit(True).alias("corrupt"))
    return good.unionByName(bad)
