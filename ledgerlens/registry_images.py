"""Registered queries of the image path (A4, L1, L2, E2): pictures made from all embeddings, written as files and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import fixtures as fx
from .operators.joins import attach_images, zero_filled
from .plans.images import encode_png, image_quality, image_table
from .registry import query, rnd
from .registry_io import scratch
from .session import cut_lineage, table
from .sources import readers, writers

SIDE = 6  # of the resized pictures; the files are 8 x 8


def image_folder(spark, d: str) -> str:
    """A folder with a PNG file for each picture, some cut short, and a text file beside every hundredth."""
    path = scratch(spark, "images")
    pixels = fx.image_pixels(spark, d)
    files = encode_png(pixels, level=0).join(pixels.select("file_name", "cut"), "file_name")
    half = F.substring("content", 1, F.floor(F.octet_length("content") / 2).cast("int"))
    notes = pixels.where("vec_id % 100 = 0").select(F.regexp_replace("file_name", "png$", "txt").alias("file_name"),
                                                    F.encode("file_name", "UTF-8").alias("content"))
    writers.write_files(files.select("file_name", F.when(F.col("cut"), half).otherwise(F.col("content")).alias("content"))
                        .unionByName(notes), path)
    return path


@query("a4_scan_images")
def a4_scan_images(spark, d):
    """A4: names, lengths and pixel digests of the image files; the glob leaves the text files out."""
    files = readers.scan_images(spark, image_folder(spark, d))
    whole = F.col("length") == 268  # level 0 stores the lines at a fixed place: after signature, header and 15 bytes
    stored = F.substring("content", 49, 8 * (1 + 3 * fx.IMAGE_SIDE))
    return files.select("file_name", "length", (F.octet_length("content") == F.col("length")).alias("all_read"),
                        F.element_at(F.split("path", "/"), -1).alias("last_of_path"),
                        F.when(whole, F.sha2(stored, 256)).alias("lines_sha256"))


@query("l1_image_table")
def l1_image_table(spark, d):
    """L1: every value of every resized, normalised picture; corrupt files keep a row without values."""
    t = image_table(spark, image_folder(spark, d), size=SIDE)
    x = t.select("file_name", "corrupt", "height", "width", F.posexplode_outer("image").alias("entry", "value"))
    return rnd(x.select("file_name", "corrupt", F.when(~F.col("corrupt"), F.col("height")).alias("height"),
                        F.when(~F.col("corrupt"), F.col("width")).alias("width"), "entry", "value"), 5)


@query("l2_image_quality")
def l2_image_quality(spark, d):
    """L2: Otsu threshold and dark share of every picture; corrupt files keep a row."""
    return rnd(image_quality(spark, image_folder(spark, d)))


@query("e2_attach_images")
def e2_attach_images(spark, d):
    """The picture of every embedding row; null until it is used, then zeros where there is none."""
    images = cut_lineage(image_table(spark, image_folder(spark, d), size=SIDE))
    rows = table(spark, d, "embeddings").select("vec_id", "label", fx.image_name(F.col("vec_id")).alias("file_name"))
    j = attach_images(rows, images, height=SIDE, width=SIDE, fill=False)
    used = j.withColumn("used", zero_filled("image", 3 * SIDE * SIDE))
    return rnd(used.select("vec_id", "label", "image_state", F.col("image").isNull().alias("is_null"), F.size("used").alias("n_values"),
                           F.aggregate("used", F.lit(0.0), lambda a, x: a + x).alias("total")), 4)
