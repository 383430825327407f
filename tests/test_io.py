"""Sources, sinks and the full job."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from derrick.config import LakeConfig
from derrick.sinks import writers as SK
from derrick.sources import adapters as A
from derrick.sources import tables as TB
from tests.conftest import rows


def test_partitioned_parquet_hive_layout_and_dynamic_overwrite(spark, tmp_dir):
    df = spark.createDataFrame([(2024, 1, 1.0), (2024, 2, 2.0)], "year int, month int, v double")
    path = os.path.join(tmp_dir, "daily")
    SK.write_partitioned_parquet(df, path, ["year", "month"])
    assert os.path.isdir(os.path.join(path, "year=2024", "month=1"))
    SK.write_partitioned_parquet(df.where("month = 2").withColumn("v", F.lit(9.0)), path,
                                 ["year", "month"])
    back = {(r["month"], r["v"]) for r in spark.read.parquet(path).collect()}
    assert back == {(1, 1.0), (2, 9.0)}


def test_partitioned_parquet_files_follow_the_bytes(spark, tmp_dir):
    """90 % of the rows in one month: many writers there, one file for each small month,
    however many tasks hold the input; null and clashing names are kept."""
    df = spark.range(0, 20_000, 1, 16).select(
        F.col("id").alias("v"), F.lit("x" * 92).alias("_files"),
        F.when(F.col("id") < 18_000, 1).when(F.col("id") < 19_000, 2).when(F.col("id") < 19_900, 3).alias("month"))
    path = os.path.join(tmp_dir, "sized")
    SK.write_partitioned_parquet(df, path, ["month"], target_bytes=200_000)
    n = {d: len(glob.glob(os.path.join(path, f"month={d}", "part-*"))) for d in ("1", "2", "3")}
    assert n["2"] == n["3"] == 1 and len(glob.glob(os.path.join(path, "month=__HIVE*", "part-*"))) == 1
    assert 7 <= n["1"] <= 10                                     # 1.9 MB
    assert rows(spark.read.parquet(path).select("v", "_files", "month")) == rows(df)
    SK.write_partitioned_parquet(df.limit(0), os.path.join(tmp_dir, "empty"), ["month"])


def test_csv_round_trip_single_file(spark, tmp_dir):
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b, true AS c, "
                   "TIMESTAMP_NTZ'2024-01-01 00:03:52.824425' AS t")
    path = os.path.join(tmp_dir, "m.csv")
    SK.write_csv(df, path, single_file=True)
    files = glob.glob(os.path.join(path, "part-*.csv"))
    assert len(files) == 1
    text = open(files[0]).read().splitlines()
    assert text == ["a,b,c,t", "1,,True,2024-01-01 00:03:52.824425"]


def test_table_replace_schema_alias_and_ensure(spark, tmp_dir):
    SK.create_schema(spark, "mart_t", location=os.path.join(tmp_dir, "wh"))
    df = spark.createDataFrame([(1,)], "x int")
    SK.write_table_replace(df, "t1", schema="mart_t")
    SK.write_table_replace(df.union(df), "t1", schema="mart_t")
    assert spark.table("mart_t.t1").count() == 2
    assert TB.table_alias(spark, "mart_t.t1", "mart_t.t2")
    assert not TB.table_alias(spark, "mart_t.t1", "mart_t.t3")
    seed = os.path.join(tmp_dir, "seed")
    spark.createDataFrame([(1, "w", "f", "r", "active")], TB.INPUTS["wells"]) \
        .write.parquet(os.path.join(seed, "wells"))
    spark.sql("CREATE DATABASE IF NOT EXISTS seedtest")
    assert TB.ensure_tables(spark, ["wells"], seed, database="seedtest") == ["wells"]
    assert TB.ensure_tables(spark, ["wells"], seed, database="seedtest") == []


def test_table_replace_keeps_the_old_table_until_the_new_one_is_whole(spark, tmp_dir):
    SK.create_schema(spark, "mart_a", location=os.path.join(tmp_dir, "wh"))
    names = lambda: sorted(t.name for t in spark.catalog.listTables("mart_a"))
    SK.write_table_replace(spark.range(10), "t", schema="mart_a")
    with pytest.raises(Exception, match="half-way"):
        SK.write_table_replace(spark.range(10).select(
            F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("half-way"))).alias("id")),
            "t", schema="mart_a")
    assert rows(spark.table("mart_a.t")) == [(i,) for i in range(10)]
    # a table may be replaced by what is read from it, and with other columns
    SK.write_table_replace(spark.table("mart_a.t").where("id > 7").withColumn("x", F.lit("a")), "t", schema="mart_a")
    assert rows(spark.table("mart_a.t")) == [(8, "a"), (9, "a")] and names() == ["t"]
    # stopped between the two renames: the old table comes back, then is replaced
    spark.sql("ALTER TABLE mart_a.t RENAME TO mart_a.t__old")
    with pytest.raises(Exception, match="half-way"):
        SK.write_table_replace(spark.range(1).select(F.raise_error(F.lit("half-way")).alias("id")), "t", schema="mart_a")
    assert rows(spark.table("mart_a.t")) == [(8, "a"), (9, "a")]
    SK.write_table_replace(spark.range(1), "t", schema="mart_a")
    assert rows(spark.table("mart_a.t")) == [(0,)] and names() == ["t"]


def test_layout_for_access_sorted_files(spark, tmp_dir):
    df = spark.range(1000).select((F.col("id") % 10).alias("well_id"), F.col("id").alias("v"))
    path = os.path.join(tmp_dir, "layout")
    SK.layout_for_access(df, path, ["well_id", "v"], partitions=4)
    back = spark.read.parquet(path)
    assert back.count() == 1000
    # each file covers its own well_id range (min/max statistics skip the rest)
    import pyarrow.parquet as pq
    ranges = []
    for f in sorted(glob.glob(os.path.join(path, "part-*.parquet"))):
        col = pq.read_table(f, columns=["well_id"]).column("well_id").to_pylist()
        if col:
            assert col == sorted(col)
            ranges.append((min(col), max(col)))
    ranges.sort()
    # range partitioning on (well_id, v): neighbours share at most a boundary well
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    plan = back.where("well_id = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(well_id), EqualTo(well_id,3)]" in plan


def test_lake_config_from_env(monkeypatch):
    monkeypatch.setenv("DERRICK_JDBC_URL", "jdbc:derby:memory:x")
    monkeypatch.setenv("DERRICK_JDBC_USER", "u")
    cfg = LakeConfig.from_env()
    assert cfg.jdbc_url == "jdbc:derby:memory:x" and cfg.jdbc_properties() == {"user": "u"}
    assert "secret" not in repr(cfg)


def test_scan_table_parquet_enforces_schema(spark, tmp_dir):
    root = os.path.join(tmp_dir, "src")
    spark.createDataFrame([(1, "2", "diesel")], "vehicle_id int, capacity_ton string, fuel_type string") \
        .write.parquet(os.path.join(root, "vehicles"))
    df = TB.scan_table(spark, LakeConfig(source_root=root), "vehicles")
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["bigint", "double", "string"]
    assert df.first()["capacity_ton"] == 2.0


def test_run_all_small(spark, tmp_dir):
    from derrick.plans.jobs import JobSettings, run_all
    s = JobSettings(forest_trees=3, target_forest_trees=3, classifier_trees=3, iforest_trees=10)
    marts = run_all(spark, tmp_dir, sf_dir="/root/testdata/sf0.001", settings=s)
    assert len(marts) == 19
    assert os.path.isdir(os.path.join(tmp_dir, "marts", "daily_production"))
    assert os.path.isdir(os.path.join(tmp_dir, "ml", "pump_risk_scores.csv"))


def test_jdbc_round_trip_in_process_derby(spark):
    """Table replace and partitioned read over JDBC against an in-memory
    Derby database inside this JVM (no server, no port)."""
    cfg = LakeConfig(jdbc_url="jdbc:derby:memory:derrick_test;create=true",
                     jdbc_driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    df = spark.range(1, 101).select(F.col("id").alias("well_id"),
                                    (F.col("id") * 1.5).alias("oil_ton"))
    SK.write_table_replace(df, "daily", cfg, schema="mart")
    SK.write_table_replace(df.where("well_id <= 10"), "daily", cfg, schema="mart")
    back = TB.scan_jdbc(spark, cfg, "mart.daily", partition_column="WELL_ID", lower=1, upper=100,
                        num_partitions=4)
    assert back.rdd.getNumPartitions() == 4
    assert sorted(r[0] for r in back.collect()) == list(range(1, 11))


def test_parquet_overwrite_scan_mart_and_show(spark, tmp_dir, capsys):
    df = spark.createDataFrame([("Berlin", 2.0), ("Munich", 1.0)], "city string, revenue double")
    root = os.path.join(tmp_dir, "lake")
    SK.write_parquet_overwrite(df, os.path.join(root, "marts", "top"))
    SK.write_parquet_overwrite(df.limit(1), os.path.join(root, "marts", "top"))
    cfg = LakeConfig(lake_root=root, mart_schema="no_such_schema")
    assert TB.scan_mart(spark, "top", cfg).count() == 1
    SK.show_result(df, F.col("revenue").desc())
    out = capsys.readouterr().out
    assert out.index("Berlin") < out.index("Munich")


def test_cut_lineage_checkpoints_to_shared_folder(spark):
    from derrick.session import cut_lineage, ensure_checkpoint_dir
    folder = ensure_checkpoint_dir(spark)
    assert folder and spark.sparkContext.getCheckpointDir()
    df = spark.range(100).withColumn("sq", F.col("id") * F.col("id")).where("id % 3 = 0")
    cut = cut_lineage(df)
    assert sorted(r["sq"] for r in cut.collect()) == sorted(r["sq"] for r in df.collect())
    plan = cut._jdf.queryExecution().analyzed().toString()
    assert "Range" not in plan and "LogicalRDD" in plan


def test_scan_table_jdbc_parallel_ranges(spark):
    cfg = LakeConfig(jdbc_url="jdbc:derby:memory:derrick_scan;create=true",
                     jdbc_driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    wells = spark.createDataFrame([(i, f"w{i}", "f", "r", "active") for i in range(1, 51)],
                                  TB.INPUTS["wells"])
    SK.write_table_replace(wells, "wells", cfg, schema="app")
    df = TB.scan_table(spark, cfg, "app.wells", num_partitions=5)   # split column known
    assert df.rdd.getNumPartitions() == 5
    assert sorted(r["well_id"] for r in df.collect()) == list(range(1, 51))


def test_jdbc_splits_are_even_on_skewed_date_and_text_keys(spark):
    """Ranges follow the rows, not the width of the key; NULL keys are read once."""
    cfg = LakeConfig(jdbc_url="jdbc:derby:memory:derrick_splits;create=true",
                     jdbc_driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    # 90 % of the keys in 1 % of the range, some NULL
    df = spark.range(1000).select(
        F.when(F.col("id") % 50 == 0, None).when(F.col("id") < 900, F.col("id"))
        .otherwise(F.col("id") * 100).alias("k"),
        F.expr("date_add(date'2024-01-01', cast(if(id < 900, id, id * 100) as int))").alias("d"),
        F.format_string("it's %04d", "id").alias("s"), F.lit(7).alias("same"))
    # Spark makes a text column a CLOB there, which has no order: a sized type as key
    (df.write.format("jdbc").option("url", cfg.jdbc_url).options(**cfg.jdbc_properties())
     .option("dbtable", "app.keys").option("createTableColumnTypes", "s VARCHAR(20)").save())
    want = rows(df)
    for key in ("k", "d", "s"):
        back = TB.scan_table(spark, cfg, "app.keys", num_partitions=8, partition_column=key.upper())
        sizes = [r["count"] for r in back.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert len(sizes) == 8 and max(sizes) <= 1.2 * 1000 / 8 + 20, (key, sizes)
        assert rows(back) == want
    one = TB.scan_table(spark, cfg, "app.keys", num_partitions=8, partition_column="SAME")
    assert one.count() == 1000                      # one value: nothing to split by
    SK.write_table_replace(df.limit(0), "no_rows", cfg, schema="app")
    assert TB.scan_table(spark, cfg, "app.no_rows", num_partitions=8, partition_column="K").count() == 0


def test_run_all_over_jdbc(spark, tmp_dir):
    """The batch as the original runs it: nine tables read from a database
    (in-process Derby here), marts written back as mart.* tables."""
    from derrick.plans.jobs import INPUT_TABLES, JobSettings, build_marts, write_marts
    from derrick.sources import adapters as A
    cfg = LakeConfig(jdbc_url="jdbc:derby:memory:derrick_job;create=true",
                     jdbc_driver="org.apache.derby.iapi.jdbc.AutoloadedDriver",
                     mart_schema="mart")
    for t in INPUT_TABLES:
        SK.write_table_replace(TB.enforce_schema(A.load(spark, "/root/testdata/sf0.001", t),
                                                 TB.INPUTS[t]), t, cfg, schema="app")
    cfg_app = LakeConfig(jdbc_url=cfg.jdbc_url, jdbc_driver=cfg.jdbc_driver, mart_schema="mart")
    prod = TB.scan_table(spark, cfg_app, "app.production", num_partitions=4)
    assert prod.rdd.getNumPartitions() == 4
    s = JobSettings(forest_trees=3, target_forest_trees=3, classifier_trees=3, iforest_trees=10)
    inputs = {t: TB.scan_table(spark, cfg_app, f"app.{t}", num_partitions=4) for t in INPUT_TABLES}
    marts = build_marts(inputs, s)
    write_marts(marts, tmp_dir, cfg, tables=True)
    back = TB.scan_jdbc(spark, cfg, "mart.well_kpi")
    assert back.count() == marts["well_kpi"].count() > 0


def test_absent_column_is_an_error_and_names_may_be_qualified(spark, tmp_dir):
    whole = A.load(spark, "/root/testdata/sf0.001", "production")
    with pytest.raises(ValueError, match="oil_ton"):
        TB.enforce_schema(whole.drop("oil_ton"), TB.INPUTS["production"])
    whole.drop("oil_ton").write.parquet(f"{tmp_dir}/app.production")
    with pytest.raises(ValueError, match="app.production"):
        TB.scan_table(spark, LakeConfig(source_root=tmp_dir), "app.production")


def test_partition_overwrite_leaves_the_session_as_it_is(spark, tmp_dir):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    df = spark.createDataFrame([(1, 1), (2, 2)], "a int, m int")
    SK.write_partitioned_parquet(df, f"{tmp_dir}/p", ["m"])
    SK.write_partitioned_parquet(df.where("m = 2").selectExpr("a + 5 AS a", "m"), f"{tmp_dir}/p", ["m"])
    assert rows(spark.read.parquet(f"{tmp_dir}/p").select("a", "m")) == [(1, 1), (7, 2)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
