"""Table reads: JDBC (partitioned), Parquet, catalog tables and literals;
seeding missing tables; renaming a table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from derrick.config import LakeConfig
from derrick.schemas import INPUTS


def scan_jdbc(spark: SparkSession, cfg: LakeConfig, table: str, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None,
              num_partitions: int = 64, fetch_size: int = 10_000) -> DataFrame:
    """Whole-table read over JDBC, split into ``num_partitions`` range reads
    on ``partition_column`` (a numeric or date column) when given."""
    reader = (spark.read.format("jdbc").option("url", cfg.jdbc_url).option("dbtable", table)
              .option("fetchsize", fetch_size))
    for k, v in cfg.jdbc_properties().items():
        reader = reader.option(k, v)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower).option("upperBound", upper)
                  .option("numPartitions", num_partitions))
    return reader.load()


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


# key each input table is split on for parallel JDBC reads
SPLIT_COLUMNS = {
    "wells": "well_id", "production": "well_id", "telemetry": "well_id",
    "well_targets": "well_id", "pump_sensors": "record_id", "pump_failures": "failure_id",
    "deliveries": "delivery_id", "drivers": "driver_id", "vehicles": "vehicle_id",
    "items": "id", "item_changes": "seq",
}


def _quote(spark: SparkSession, url: str, column: str) -> str:
    """The column quoted the way Spark's JDBC dialect for ``url`` does."""
    try:
        dialect = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)
        return dialect.quoteIdentifier(column)
    except Exception:  # noqa: BLE001  (no JVM access: standard SQL quoting)
        return '"' + column.replace('"', '""') + '"'


def _literal(value) -> str:
    """A split point as SQL: numbers plain, anything else in quotes, which databases
    compare with a date, timestamp or text column (as Spark's own pushed filters)."""
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def jdbc_splits(spark: SparkSession, cfg: LakeConfig, table: str, column: str, num_partitions: int) -> list[str]:
    """Disjoint predicates that cover ``table`` in up to ``num_partitions`` ranges of
    equal row count: the database is asked for the values at the ranges' first rows
    (one row each), for a number, date, timestamp or text key of a type
    that the database can order. NULL keys go with the first
    range; a value that fills several ranges makes one. An empty table has none."""
    # the name as the database spells it, as Spark resolves a partition column
    names = {c.lower(): c for c in scan_jdbc(spark, cfg, table).columns}
    q = _quote(spark, cfg.jdbc_url, names.get(column.lower(), column))
    n = scan_jdbc(spark, cfg, f"(SELECT COUNT({q}) AS n FROM {table}) b").first()[0]
    at = sorted({n * i // num_partitions for i in range(1, num_partitions)} - {0})
    if not at:
        return []
    parts = [f"SELECT * FROM (SELECT {q} AS p FROM {table} WHERE {q} IS NOT NULL ORDER BY {q} "
             f"OFFSET {i} ROWS FETCH NEXT 1 ROWS ONLY) s{i}" for i in at]
    rows = scan_jdbc(spark, cfg, f"({' UNION ALL '.join(parts)}) b").collect()
    points = [_literal(x) for x in sorted({r[0] for r in rows})]
    return ([f"{q} < {points[0]} OR {q} IS NULL"]
            + [f"{q} >= {lo} AND {q} < {hi}" for lo, hi in zip(points, points[1:])] + [f"{q} >= {points[-1]}"])


def scan_table(spark: SparkSession, cfg: LakeConfig, table: str, num_partitions: int = 64,
               **jdbc_kw) -> DataFrame:
    """An input table from JDBC or from ``source_root/table``, with the
    declared schema enforced (columns cast, extra columns kept).

    Over JDBC a known table is read as up to ``num_partitions`` parallel queries on
    its key, of equal row count however skewed the key is (:func:`jdbc_splits`); pass
    ``partition_column`` for another key, and ``lower``/``upper`` for ranges of equal width."""
    if cfg.jdbc_url:
        col = jdbc_kw.pop("partition_column", None) or SPLIT_COLUMNS.get(table.split(".")[-1])
        splits = jdbc_splits(spark, cfg, table, col, num_partitions) if col and "lower" not in jdbc_kw else []
        if splits:
            df = spark.read.jdbc(cfg.jdbc_url, table, predicates=splits, properties={
                "fetchsize": str(jdbc_kw.get("fetch_size", 10_000)), **cfg.jdbc_properties()})
        else:
            if "lower" in jdbc_kw:
                jdbc_kw.update(partition_column=col, num_partitions=num_partitions)
            df = scan_jdbc(spark, cfg, table, **jdbc_kw)
    else:
        df = spark.read.parquet(f"{cfg.source_root.rstrip('/')}/{table}")
    return enforce_schema(df, INPUTS.get(table.split(".")[-1]), table)


def enforce_schema(df: DataFrame, schema: T.StructType | None, table: str = "input") -> DataFrame:
    """``df`` with the declared types; a declared column that is absent is an error."""
    if schema is None:
        return df
    absent = [c for c in schema.fieldNames() if c not in df.columns]
    if absent:
        raise ValueError(f"{table} lacks the columns {', '.join(absent)}")
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    return df.select(*cols, *extra)


def scan_ordered(df: DataFrame, *order: str | Column) -> DataFrame:
    """Read with ORDER BY. Ordering is applied where results are written;
    every operator here is independent of input order."""
    return df.orderBy(*order)


def scan_mart(spark: SparkSession, name: str, cfg: LakeConfig | None = None) -> DataFrame:
    """A written mart: catalog table ``schema.name``, else its lake folder."""
    schema = cfg.mart_schema if cfg else "mart"
    if spark.catalog.tableExists(f"{schema}.{name}"):
        return spark.table(f"{schema}.{name}")
    if cfg is None or not cfg.lake_root:
        raise ValueError(f"mart {name} not found")
    return spark.read.parquet(f"{cfg.lake_root.rstrip('/')}/marts/{name}")


def scan_literal(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """In-line rows with named columns (small reference data)."""
    return spark.createDataFrame(list(rows), schema)


def ensure_tables(spark: SparkSession, tables: Sequence[str], seed_root: str,
                  database: str = "default", fmt: str = "parquet") -> list[str]:
    """Create the tables of a group from seed files unless all exist already.

    Idempotent: when every table is present nothing happens. Returns the
    names that were created.
    """
    missing = [t for t in tables if not spark.catalog.tableExists(f"{database}.{t}")]
    if not missing:
        return []
    for t in missing:
        src = spark.read.format(fmt).load(f"{seed_root.rstrip('/')}/{t}")
        enforce_schema(src, INPUTS.get(t)).write.mode("overwrite").saveAsTable(f"{database}.{t}")
    return missing


def table_alias(spark: SparkSession, old: str, new: str) -> bool:
    """``ALTER TABLE IF EXISTS old RENAME TO new``; False when ``old`` is absent."""
    if not spark.catalog.tableExists(old) or spark.catalog.tableExists(new):
        return False
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")
    return True
