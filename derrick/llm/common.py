"""Helpers shared by the operators: document keys, shared tables, packed texts."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from derrick.session import ensure_checkpoint_dir, ship_package, shuffles_dropped

#: a document's key in side tables: its id and a hash of its text, so that rows
#: with a null or repeated id are told apart (identical rows share one key)
KEY = ["doc_id", "_th"]


def documents(docs: DataFrame, *extra: str) -> DataFrame:
    """Only the columns an operator needs, plus the text hash of :data:`KEY`."""
    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("text").alias("_th"), "text", *extra)


def shared_folder(spark: SparkSession) -> str:
    """The name of a new folder for tables in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/tables-{uuid.uuid4().hex}"


def shared_table(df: DataFrame, partition_by: list[str] | None = None, folder: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder (or ``folder`` in it) and
    read it back: cuts the lineage, compressed, and survives the loss of any executor.
    The shuffles that made it go at once."""
    spark = df.sparkSession
    path = f"{folder or ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        writer = df.write.option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join that also matches null keys; the keys come from the left side."""
    renamed = right.select([F.col(c).alias(f"_r_{c}") if c in keys else F.col(c)
                            for c in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def packed_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, _th, z): texts as zstandard frames, so that a shuffle moves less.
    A null text stays null."""
    def pack(batches):
        comp = zstandard.ZstdCompressor(level=1)
        for b in batches:
            z = [None if t is None else comp.compress(t.encode())
                 for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("_th"), pa.array(z, pa.binary())],
                names=["doc_id", "_th", "z"])
    return docs.select("doc_id", "_th", "text").mapInArrow(
        pack, "doc_id long, _th long, z binary")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has it already."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = "_" + name
    return name


def smallest(df: DataFrame, order: str, n: int) -> DataFrame:
    """The ``n`` rows of smallest ``order`` (a hash; with ties, some more). Only
    numbers go through the selection, so wide rows never meet in one place."""
    cut = df.select(order).orderBy(order).limit(n).agg(F.max(order)).first()[0]
    return df.where(F.col(order) <= cut) if cut is not None else df.limit(0)


def broadcast_if_small(df: DataFrame, limit: int = 64 << 20) -> DataFrame:
    """``broadcast(df)`` if its rows hold at most ``limit`` bytes, else ``df``: 16 bytes
    a cell and the lengths of texts and binaries. ``df`` is read once for the check."""
    wide = [f.name for f in df.schema.fields if f.dataType.simpleString() in ("string", "binary")]
    held = F.count(F.lit(1)) * (16 * len(df.columns))
    for c in wide:
        held = held + F.coalesce(F.sum(F.octet_length(c)), F.lit(0))
    return F.broadcast(df) if df.agg(held).first()[0] <= limit else df


def unpack(z: bytes | None) -> bytes:
    """The UTF-8 bytes of a packed text (null: empty)."""
    return b"" if z is None else zstandard.ZstdDecompressor().decompressobj().decompress(z)


def groups_for(rows: int, per_group: int) -> int:
    """Number of hash groups so that a group holds about ``per_group`` rows."""
    return max(1, math.ceil(rows / per_group))


def hashed(col: Column | str, n: int, salt: int = 0) -> Column:
    """A stable group number 0..n-1."""
    return F.pmod(F.xxhash64(F.lit(salt), col), F.lit(n)).cast("long")


def tiled(df: DataFrame, key: str, size: DataFrame, limit: int, spread: str) -> DataFrame:
    """Split groups of over ``limit`` weight into tiles without losing a pair.

    ``size`` holds (``key``, ``weight``), one row per group. A group of weight w
    is cut by the hash of ``spread`` into k = ceil(w / limit) chunks, and every
    row goes to the k tiles (i, j), i <= j, that contain its chunk: any two rows
    of a group meet in a tile, and no tile holds more than about two chunks.
    Groups within the limit keep one tile (0, 0).
    """
    k = F.ceil(F.col("weight") / F.lit(float(limit))).cast("long")
    big = size.where(F.col("weight") > limit).select(key, k.alias("_k"))
    d = df.join(big, key, "left").withColumn("_k", F.coalesce("_k", F.lit(1).cast("long")))
    d = d.withColumn("_i", F.pmod(F.xxhash64(F.lit(7), spread), F.col("_k")))
    d = d.withColumn("_j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_k") - 1)))
    return (d.withColumn("tile_i", F.least("_i", "_j")).withColumn("tile_j", F.greatest("_i", "_j"))
            .drop("_k", "_i", "_j"))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
