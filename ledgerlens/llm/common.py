"""Helpers shared by the operators: staged tables, text slices, label splits."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import ensure_checkpoint_dir

# Characters held as arrays at once by a task; a longer text is a slice of its own.
SLICE_CHARS = 500_000


def shared_path(spark: SparkSession) -> str:
    """A path of its own below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"


def staged(df: DataFrame, *, instead_of: DataFrame | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back (lineage ends there).

    ``instead_of``, a staged table that nothing will read any more, is deleted once ``df`` is written.
    """
    path = shared_path(df.sparkSession)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_at = path
    if instead_of is not None:
        drop_staged(instead_of)
    return out


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a table that ``staged`` returned; any other table is left alone."""
    at = getattr(df, "_staged_at", None)
    if at:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, dealt over at least as many partitions as the session has cores."""
    from ledgerlens.session import spread

    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def slices(batch: pa.RecordBatch, text_col: str, limit: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Row slices of ``batch`` with at most ``limit`` bytes of text each (or one row)."""
    col = batch.column(batch.schema.get_field_index(text_col))
    sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    lo, total = 0, 0
    for i, n in enumerate(sizes):
        if i > lo and total + n > limit:
            yield batch.slice(lo, i - lo)
            lo, total = i, 0
        total += int(n)
    if lo < len(sizes):
        yield batch.slice(lo)


def texts_of(batch: pa.RecordBatch, text_col: str) -> list[str]:
    """The texts of a slice; null is empty."""
    col = batch.column(batch.schema.get_field_index(text_col))
    return [t if t is not None else "" for t in col.to_pylist()]


def codepoints(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def id_remainder(id_col: str | Column, modulus: int) -> Column:
    """crc32 of the id written as text (null: the empty text), modulo ``modulus``."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.pmod(F.crc32(F.encode(F.coalesce(c.cast("string"), F.lit("")), "UTF-8")), F.lit(modulus))


def labelled_sample(labels: DataFrame, id_col: str, label_col: str, per_class: int) -> DataFrame:
    """At most ``per_class`` ids of each class 0/1, the smallest by hash: (id, label, weight).

    ``weight`` is the class's rows divided by its sampled rows, so that a model
    fitted on the sample sees the table's class shares. Null ids and labels and
    labels other than 0/1 take no part; of repeated ids the smallest label counts.
    """
    rows = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
            .where("_id IS NOT NULL AND _y IN (0, 1)").groupBy("_id").agg(F.min("_y").alias("_y")))
    rows = staged(rows)
    counts = {r["_y"]: r["n"] for r in rows.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    parts = []
    for y in (0, 1):
        n = counts.get(y, 0)
        part = (rows.where(F.col("_y") == y).orderBy(F.xxhash64(F.col("_id")), "_id").limit(per_class)
                .withColumn("_w", F.lit(n / max(1, min(n, per_class)))))
        parts.append(part)
    return parts[0].unionByName(parts[1])


def sample_rows(docs: DataFrame, id_col: str, text_col: str, sample: DataFrame) -> DataFrame:
    """Texts of the sampled ids (a bounded set, so broadcast): (_id, _y, _w, _text), one row per id.

    Of the rows of a repeated id the smallest text counts, so that a fit does not depend on their order.
    """
    d = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return d.join(F.broadcast(sample), "_id").groupBy("_id", "_y", "_w").agg(F.min("_text").alias("_text"))
