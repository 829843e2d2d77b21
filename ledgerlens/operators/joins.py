"""Key joins (E1, E2). Every join of the reference is a lookup; none is a range, theta or cross join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach_labels(features: DataFrame, labels: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Pair feature rows with labels by key (not by row position).

    Both sides can be large, so no broadcast is forced: Spark broadcasts the
    label side only when its (runtime) size is under the broadcast threshold,
    otherwise it shuffles both sides on ``key``; AQE splits a skewed key.
    """
    return features.join(labels, on=key, how=how)


def attach_images(features: DataFrame, images: DataFrame, key: str = "file_name", tensor_col: str = "image",
                  channels: int = 3, height: int = 224, width: int = 224, fill: bool = True) -> DataFrame:
    """Look up each row's image tensor by file name; adds the tensor and ``image_state``.

    ``images`` carries (key, tensor_col) with a null tensor for files that did
    not decode (see ``plans.images.image_table``), one row a key. ``image_state`` is found, corrupt (a file without
    a tensor) or missing (no file, or a null key). With ``fill`` a missing tensor becomes zeros (C*H*W floats) at once; without,
    it stays null, so that no zeros are shuffled or stored, until ``zero_filled`` is used.
    """
    there = images.select(key, tensor_col, F.lit(True).alias("_file"))
    j = features.join(there, on=key, how="left")
    state = (F.when(F.col("_file").isNull(), "missing").when(F.col(tensor_col).isNull(), "corrupt").otherwise("found"))
    j = j.withColumn("image_state", state).drop("_file")
    return j.withColumn(tensor_col, zero_filled(tensor_col, channels * height * width)) if fill else j


def zero_filled(tensor_col: str, size: int) -> Column:
    """The tensor, or ``size`` zeros where it is null; zeros are made for those rows only, never as a literal of the plan."""
    n = F.coalesce(F.size(tensor_col) * 0, F.lit(0)) + F.lit(size)  # depends on the row, so it is not folded into a constant
    return F.when(F.col(tensor_col).isNull(), F.array_repeat(F.lit(0.0).cast("float"), n)).otherwise(F.col(tensor_col))
