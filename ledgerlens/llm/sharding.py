"""Sharding by a permutation-filled lookup table.

Every shard prefers the slots of a prime-sized table in its own order (an offset
and a stride, both from a hash of its name; the size being prime, the order meets
every slot). Shards take turns: each claims its first free slot until the table
is full, so shares differ by one slot at most. Each row's key hashes to a slot;
the table (as many rows as slots, whatever the input) is broadcast. Adding or
removing a shard moves few other slots.

Null keys hash like the empty text; repeated rows go to one shard; extra columns
are kept by ``write_shards`` and dropped by ``place``. No shards is an error.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_SIZE = 4093  # a prime; over a hundred slots for each of up to 40 shards


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: list[str], size: int = TABLE_SIZE) -> list[int]:
    """Slot -> index of the shard that claimed it. Shards are taken in the order of their names."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be different names, at least one")
    if size < len(shards) or any(size % d == 0 for d in range(2, int(size ** 0.5) + 1)):
        raise ValueError("the table size must be a prime, at least the number of shards")
    names = sorted(shards)
    offset = [_number(f"{n}|offset") % size for n in names]
    stride = [_number(f"{n}|stride") % (size - 1) + 1 for n in names]
    table, turn = [-1] * size, [0] * len(names)
    left = size
    while left:
        for i in range(len(names)):
            slot = (offset[i] + turn[i] * stride[i]) % size
            while table[slot] >= 0:
                turn[i] += 1
                slot = (offset[i] + turn[i] * stride[i]) % size
            table[slot] = i
            turn[i] += 1
            left -= 1
            if not left:
                break
    return table


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """Slot of a key: the first 60 bits of the MD5 of its text, modulo the size."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(F.encode(text, "UTF-8")), 1, 15), 16, 10).cast("bigint"), F.lit(size))


def table_frame(spark: SparkSession, shards: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """(slot, shard) of the lookup table."""
    names = sorted(shards)
    rows = [(i, names[s]) for i, s in enumerate(lookup_table(shards, size))]
    return spark.createDataFrame(rows, "slot long, shard string")


def place(rows: DataFrame, shards: list[str], *, key_col: str = "doc_id", size: int = TABLE_SIZE,
          keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, slot, shard) and the columns ``keep`` of every row; one broadcast hash join, no shuffle."""
    keyed = rows.select(F.col(key_col).alias("_k"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(keep)])
    keyed = keyed.withColumn("slot", slot_of(F.col("_k"), size))
    table = F.broadcast(table_frame(rows.sparkSession, shards, size))
    return keyed.join(table, "slot").select(F.col("_k").alias(key_col), "slot", "shard",
                                            *[F.col(f"_c{i}").alias(c) for i, c in enumerate(keep)])


def write_shards(rows: DataFrame, shards: list[str], path: str, *, key_col: str = "doc_id",
                 size: int = TABLE_SIZE, tasks_per_shard: int = 1) -> str:
    """Write all columns of ``rows`` as Parquet, one folder ``shard=NAME`` for each shard.

    Returns the folders' column name: ``shard``, with as many ``_`` added as it takes to be no column of ``rows``.
    """
    taken = {c.lower() for c in rows.columns}
    folder = "shard"
    while folder in taken:
        folder += "_"
    names = [f"c{i}" for i in range(len(rows.columns))]  # own names: the table's can't clash with ours
    key = F.col(names[rows.columns.index(key_col)])
    table = F.broadcast(table_frame(rows.sparkSession, shards, size))
    out = rows.toDF(*names).withColumn("slot", slot_of(key, size)).join(table, "slot")
    # By the whole row, so that the rows of a repeated key are spread over the shard's tasks too.
    hashable = [n for n, f in zip(names, rows.schema.fields, strict=True) if f.dataType.typeName() not in ("map", "variant")]
    salt = F.pmod(F.xxhash64(*hashable), F.lit(tasks_per_shard))
    out = out.repartition(len(shards) * tasks_per_shard, "shard", salt).select(*names, "shard")
    out.toDF(*rows.columns, folder).write.partitionBy(folder).parquet(path)
    return folder
