"""Writers for marts. All are distributed writes; nothing is collected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from derrick.config import LakeConfig
from derrick.session import cut_lineage, default_parallelism

__all__ = ["write_partitioned_parquet", "write_csv", "write_table_replace", "create_schema",
           "write_parquet_overwrite", "show_result", "layout_for_access"]


MAX_RECORDS_PER_FILE = 5_000_000
#: bytes of a partition value per writer, before Parquet's encoding; most write tasks
TARGET_BYTES = 512 << 20
MAX_WRITERS = 100_000


def row_bytes(df: DataFrame) -> Column:
    """A row's size before encoding: text and binary by length, others by type."""
    width = F.lit(0).cast("long")
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        else:
            width = width + F.lit(8)
    return width


def write_partitioned_parquet(df: DataFrame, path: str, partition_cols: Sequence[str],
                              mode: str = "overwrite",
                              max_records_per_file: int = MAX_RECORDS_PER_FILE,
                              target_bytes: int = TARGET_BYTES) -> None:
    """Hive-style ``col=value`` folders; only the partitions present in
    ``df`` are replaced (dynamic partition overwrite), others are kept.

    The number of files follows the bytes: one aggregate adds up each partition
    value's rows (:func:`row_bytes`), and a value is dealt by row hash to
    ceil(bytes / ``target_bytes``) writers. A month with most of the rows is written by
    many tasks, a small one by one; rows equal in every column share a writer, which
    splits at ``max_records_per_file``. ``df`` is read twice.
    """
    cols = list(partition_cols)
    taken = {c.lower() for c in df.columns}
    names = []
    for name in ("_files", "_writer", *(f"_key{i}" for i in range(len(cols)))):
        while name in taken:
            name = "_" + name
        names.append(name)
    files, writer, *keys = names
    size = df.groupBy(*cols).agg(F.ceil(F.sum(row_bytes(df)) / F.lit(float(target_bytes))).cast("long").alias(files))
    size = cut_lineage(size.withColumnsRenamed(dict(zip(cols, keys))))
    total = size.agg(F.sum(F.greatest(files, F.lit(1)))).first()[0] or 1
    same = F.lit(True)
    for c, k in zip(cols, keys):
        same = same & df[c].eqNullSafe(size[k])
    dealt = df.join(size, same, "left").withColumn(
        writer, F.pmod(F.xxhash64(*[df[c] for c in df.columns]), F.greatest(F.col(files), F.lit(1))))
    out = dealt.repartition(int(min(total, MAX_WRITERS)), *cols, writer).select(*df.columns)
    (out.sortWithinPartitions(*cols).write.mode(mode)
     .option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(*cols).parquet(path))


def write_csv(df: DataFrame, path: str, single_file: bool = False,
              pandas_style: bool = True) -> None:
    """CSV with a header, one file per partition; ``single_file`` (the caller's
    choice, for marts known to be small) writes through one task.

    ``pandas_style`` writes what ``DataFrame.to_csv`` writes: booleans as
    True/False, timestamps as ``yyyy-MM-dd HH:mm:ss[.ffffff]``, NULL empty.
    """
    out = df.coalesce(1) if single_file else df
    writer = out
    if pandas_style:
        writer = out.select(*[
            F.when(F.col(f.name), F.lit("True")).when(~F.col(f.name), F.lit("False"))
            .alias(f.name) if isinstance(f.dataType, T.BooleanType) else F.col(f.name)
            for f in out.schema.fields])
    (writer.write.mode("overwrite").option("header", True)
     .option("timestampFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
     .csv(path))


def write_table_replace(df: DataFrame, name: str, cfg: LakeConfig | None = None,
                        schema: str = "mart", max_connections: int = 32,
                        batch_rows: int = 10_000) -> None:
    """Replace ``schema.name``: over JDBC when configured, else in the catalog.

    In the catalog the rows are written whole under a name of their own, then the
    tables change names: a write that fails leaves the old table as it was, and ``df``
    may read the table that it replaces. A run stopped between the two renames is put
    right by the next one. Over JDBC the table is overwritten in place. JDBC writes use at most ``max_connections`` parallel connections (Spark
    coalesces to that many partitions) and batched inserts."""
    if cfg is not None and cfg.jdbc_url:
        (df.write.mode("overwrite").format("jdbc").option("url", cfg.jdbc_url)
         .option("dbtable", f"{schema}.{name}").option("numPartitions", max_connections)
         .option("batchsize", batch_rows).options(**cfg.jdbc_properties()).save())
    else:
        spark, own = df.sparkSession, f"{schema}.{name}"
        new, old = f"{own}__new", f"{own}__old"
        if spark.catalog.tableExists(old):
            if spark.catalog.tableExists(own):
                spark.sql(f"DROP TABLE {old}")
            else:
                spark.sql(f"ALTER TABLE {old} RENAME TO {own}")
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        df.write.mode("overwrite").saveAsTable(new)
        if spark.catalog.tableExists(own):
            spark.sql(f"ALTER TABLE {own} RENAME TO {old}")
        spark.sql(f"ALTER TABLE {new} RENAME TO {own}")
        spark.sql(f"DROP TABLE IF EXISTS {old}")


def create_schema(spark: SparkSession, schema: str = "mart", location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{loc}")


def write_parquet_overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def show_result(df: DataFrame, *order: str | Column, n: int = 20) -> None:
    """Print the first ``n`` rows in ``order`` (a bounded top-n, not a collect)."""
    df.orderBy(*order).show(n, truncate=False)


def layout_for_access(df: DataFrame, path: str, keys: Sequence[str],
                      partitions: int | None = None) -> None:
    """Write ``df`` range-clustered and sorted on ``keys`` so Parquet min/max
    statistics let readers skip files and row groups for key/range filters
    (what a B-tree index on the same keys gives a database)."""
    n = partitions or max(default_parallelism(df.sparkSession), 1)
    (df.repartitionByRange(n, *[F.col(k) for k in keys])
     .sortWithinPartitions(*keys).write.mode("overwrite").parquet(path))
