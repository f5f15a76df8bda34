import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from probelake.operators.columns import add_literal, derive, drop_columns, project, rename_columns
from probelake.operators.filters import drop_null_rows, whitelist
from probelake.session import settings, shared_dir, sized_for, stage, staged
from probelake.sources import catalog
from probelake.sources.sinks import append_table, write_partitioned

ROWS = [(1, dt.date(2020, 1, 1)), (2, dt.date(2020, 1, 2)), (3, None)]


@pytest.fixture
def table(spark):
    return spark.createDataFrame(ROWS, "id int, bucket_date date")


def ids(spark, path):
    return {(r.id, r.bucket_date) for r in spark.read.parquet(path).collect()}


def test_null_partition_comes_back_as_null(spark, table, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(table, path, ["bucket_date"])
    assert ids(spark, path) == set(ROWS)
    assert (tmp_path / "t" / "bucket_date=__HIVE_DEFAULT_PARTITION__").is_dir()
    assert spark.read.parquet(path).schema["bucket_date"].dataType.simpleString() == "date"


def test_dynamic_overwrite_leaves_other_partitions(spark, table, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(table, path, ["bucket_date"])
    write_partitioned(table.where("id = 2").withColumn("id", F.lit(9)), path, ["bucket_date"])
    assert ids(spark, path) == {ROWS[0], (9, ROWS[1][1]), ROWS[2]}


def test_static_overwrite_replaces_all(spark, table, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(table, path, ["bucket_date"])
    write_partitioned(table.where("id = 2"), path, ["bucket_date"], overwrite="static")
    assert ids(spark, path) == {ROWS[1]}


def test_unknown_overwrite(table, tmp_path):
    with pytest.raises(ValueError):
        write_partitioned(table, str(tmp_path / "t"), ["bucket_date"], overwrite="some")


def test_append(spark, table, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        append_table(table, path, ["bucket_date"])
    assert spark.read.parquet(path).count() == 6


@pytest.mark.parametrize("partitions", [4, 3200])
def test_large_partition_is_split_and_small_ones_get_one_file(spark, tmp_path, partitions):
    """Most rows have one date; it is written by many tasks."""
    rows = spark.range(0, 300_000, 1, 8).select(
        F.expr("uuid()").alias("text"),
        F.when(F.col("id") < 290_000, "2020-01-01").otherwise(F.lit("2020-01-02")).alias("day"),
    )
    sizes = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
        "spark.sql.shuffle.partitions": str(partitions),
    }
    with settings(spark, sizes):
        write_partitioned(rows, str(tmp_path / "t"), ["day"])
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "t").glob("day=*")}
    assert files["day=2020-01-01"] >= 4 and files["day=2020-01-02"] <= 2
    assert spark.read.parquet(str(tmp_path / "t")).count() == 300_000


def test_partition_filter_prunes(spark, table, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(table, path, ["bucket_date"])
    one = spark.read.parquet(path).where(F.col("bucket_date") == dt.date(2020, 1, 2))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket_date" in plan
    assert len(one.inputFiles()) >= 1 and one.count() == 1


def test_catalog(spark, table, tmp_path):
    path, schema = str(tmp_path / "t"), f"s_{uuid.uuid4().hex}"
    write_partitioned(table, path, ["bucket_date"])
    for _ in range(2):
        catalog.create_schema(spark, schema, str(tmp_path / "schema"))
        catalog.create_table(spark, f"{schema}.t", "id int", path, ["bucket_date date"])
    assert spark.table(f"{schema}.t").isEmpty()
    catalog.repair(spark, f"{schema}.t")
    assert spark.table(f"{schema}.t").count() == 3


def test_unpartitioned_table(spark, tmp_path):
    path, schema = str(tmp_path / "t"), f"s_{uuid.uuid4().hex}"
    spark.range(3).write.parquet(path)
    catalog.create_schema(spark, schema, str(tmp_path / "schema"))
    catalog.create_table(spark, f"{schema}.t", "id bigint", path)
    assert spark.table(f"{schema}.t").count() == 3


def test_stage_is_a_table_in_the_shared_folder(spark, table):
    staged = stage(table, "x")
    assert set(map(tuple, staged.collect())) == set(ROWS)
    assert all(shared_dir(spark) in f for f in staged.inputFiles())


def test_sizes_for_the_input(spark):
    keys = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    current = lambda: [spark.conf.get(k) for k in keys]
    before = current()
    with sized_for(spark, 1000, 1000):
        assert current() == before
    with pytest.raises(ZeroDivisionError), sized_for(spark, 100 * 1024**4, 100 * 1024**4):
        assert current() == [str(100 * 1024), str(1024**3)]
        1 / 0
    assert current() == before


def test_staged_rows_go_after_the_block(spark, table):
    with staged(table, "x") as rows:
        assert rows.count() == 3
        folder = rows.inputFiles()[0].rsplit("/", 1)[0]
    assert spark.read.parquet(folder).isEmpty()


def test_shared_folder_must_be_set_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://cluster:7077"

    with pytest.raises(RuntimeError):
        shared_dir(Session())


def test_columns(spark):
    rows = spark.sql("SELECT 1 a, named_struct('b', 2) s, CAST(NULL AS struct<c: int>) n")
    assert project(rows, {"x": "s.b", "y": "n.c"}).first() == (2, None)
    assert drop_columns(rows, ["s", "nothing"]).columns == ["a", "n"]
    assert rename_columns(rows, {"t": {"a": "z", "no": "x"}}, "t").columns == ["z", "s", "n"]
    assert rename_columns(rows, {}, "t").columns == rows.columns
    assert add_literal(rows, "d", "v").first().d == "v"
    assert derive(rows, {"a": F.col("a") + 1, "e": F.col("a")}).select("a", "e").first() == (2, 1)


def test_filters(spark):
    rows = spark.createDataFrame([("a", 1), (None, 2), ("b", None)], "k string, n int")
    assert [r.n for r in whitelist(rows, "k", ["a", "c"]).collect()] == [1]
    assert [r.k for r in drop_null_rows(rows, ["k", "n", "k"]).collect()] == ["a"]
