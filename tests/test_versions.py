"""Tables with versions: switches, failures, removal, compaction, the catalog."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from probelake.operators.dedup import deduplicate_stored
from probelake.session import scratch, scratch_path, shared_dir, stage
from probelake.sources import catalog, versions
from probelake.sources.compaction import bins, compact, part_sizes
from probelake.sources.readers import read_table, table_or_none
from probelake.sources.sinks import publish, write_version


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def days(spark, rows):
    return spark.createDataFrame(rows, "id long, day string")


def ids(spark, path):
    return sorted(r.id for r in read_table(spark, path).collect())


def test_only_the_dates_of_a_write_are_replaced(spark, path):
    publish(days(spark, [(1, "a"), (2, "b"), (3, "c"), (4, None)]), path, "r", ["day"])
    publish(days(spark, [(5, "a"), (6, None)]), path, "r", ["day"], replaced=["a", "b", None])
    table = read_table(spark, path)
    assert table.columns == ["id", "day"]
    assert sorted((r.id, r.day) for r in table.where("id != 6").collect()) == [(3, "c"), (5, "a")]
    assert table.where("day IS NULL").first().id == 6
    assert "PartitionFilters: [isnotnull(day" in table.where("day = 'a'")._jdf.queryExecution().executedPlan().toString()


def test_a_whole_table_and_an_empty_one(spark, path):
    assert table_or_none(spark, path) is None
    publish(days(spark, [(1, "a"), (2, "b")]), path, "r", ["day"])
    publish(days(spark, [(3, "b")]), path, "r", ["day"])
    assert ids(spark, path) == [3]
    publish(days(spark, []), path, "r", ["day"])
    assert table_or_none(spark, path) is None
    assert table_or_none(spark, path, days(spark, []).schema).isEmpty()


def test_a_write_that_fails_before_the_switch_changes_nothing(spark, path, monkeypatch):
    publish(days(spark, [(1, "a"), (2, "b")]), path, "r", ["day"])
    reader = read_table(spark, path)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(versions, "commit", fail)
        with pytest.raises(RuntimeError):
            publish(days(spark, [(9, "a"), (9, "b"), (9, "c")]), path, "r", ["day"])
    assert ids(spark, path) == [1, 2]
    bad = days(spark, [(9, "a")]).withColumn("id", F.raise_error(F.lit("broken")).cast("long"))
    with pytest.raises(Exception, match="broken"):
        publish(bad, path, "r", ["day"])
    assert ids(spark, path) == [1, 2]
    publish(days(spark, [(3, "a")]), path, "r", ["day"], replaced=["a"])
    assert ids(spark, path) == [2, 3]
    assert sorted(r.id for r in reader.collect()) == [1, 2]  # who began before the switch reads on


def test_versions_that_no_reader_needs_go(spark, path, tmp_path):
    for i in range(5):
        publish(days(spark, [(i, "a")]), path, "r", ["day"], replaced=["a"])
    files = [f for f in (tmp_path / "table").rglob("day=a/*.parquet")]
    assert len(files) == versions.KEPT and ids(spark, path) == [4]
    assert sorted(versions.pointers(spark, path)) == [4, 5]


def test_odd_values_of_partitions(spark, path):
    odd = ["a b", "x:y", "1/2", "50%", "ü", "a=b", "{c}"]
    publish(days(spark, [(i, v) for i, v in enumerate(odd)]), path, "r", ["day"])
    publish(days(spark, [(9, "ü")]), path, "r", ["day"], replaced=["ü"])
    assert {r.day: r.id for r in read_table(spark, path).collect()} == {**{v: i for i, v in enumerate(odd)}, "ü": 9}


def crowded(spark, path, n=200, rows=50):
    """A table of two partitions in so many versions of a file each."""
    table = spark.range(n * rows).select(
        "id", F.concat(F.lit("v"), F.lpad((F.col("id") % n).cast("string"), 4, "0")).alias("version"),
        F.when(F.col("id") % (n * 3) < n, "a").otherwise("b").alias("day"),
    )
    table.repartition(8, "version").write.partitionBy("version", "day").parquet(versions.versions_path(path))
    parts = [(f"day={d}", f"v{i:04}") for i in range(n) for d in ("a", "b")]
    versions.commit(spark, path, 0, parts)
    return parts


def test_compaction_keeps_the_rows_in_few_files(spark, path):
    parts = crowded(spark, path)
    before = ids(spark, path)
    sizes = part_sizes(spark, path, parts)
    assert len(sizes) == 400 and min(sizes.values()) > 100
    target = 20_000
    new = compact(spark, path, target)
    assert ids(spark, path) == before
    for day in ("a", "b"):
        files = [p for p in read_table(spark, path).inputFiles() if f"/day={day}/" in p]
        total = sum(size for (part, _), size in sizes.items() if part == f"day={day}")
        assert 1 <= len(files) <= total / target + 1
    assert {part for part, _ in new} == {"day=a", "day=b"}
    assert compact(spark, f"{path}-none", target) == []


def test_compaction_leaves_large_files(spark, path):
    sizes = {("a", f"v{i}"): size for i, size in enumerate([500, 10, 10, 700, 90, 10])}
    assert bins(sizes, 100) == [[("a", "v1"), ("a", "v2"), ("a", "v4")]]
    assert bins({("a", "v0"): 10}, 100) == [] and bins({}, 100) == []


def test_partitions_of_the_catalog_follow_the_pointer(spark, path):
    name = f"t_{abs(hash(path))}"
    write = lambda rows, **k: publish(days(spark, rows), path, "r", ["day"], **k)
    write([(1, "a"), (2, "b"), (7, None)])
    catalog.create_table(spark, name, "id bigint", path, ["day string"])
    catalog.point(spark, name, path)
    assert sorted(r.id for r in spark.table(name).collect()) == [1, 2, 7]
    write([(3, "b"), (4, "c")], replaced=["a", "b", "c"])
    assert sorted(r.id for r in spark.table(name).collect()) == [1, 2, 7]  # until the catalog is told
    catalog.point(spark, name, path)
    assert sorted(r.id for r in spark.table(name).collect()) == [3, 4, 7]
    statements = []
    catalog_spark = type("Told", (), {"sql": lambda _, q: statements.append(q) or spark.sql(q), "catalog": spark.catalog, "read": spark.read})()
    write([(5, "c")], replaced=["c"])
    catalog.point(catalog_spark, name, path)
    assert sorted(r.id for r in spark.table(name).collect()) == [3, 5, 7]
    changes = [s for s in statements if "PARTITION (" in s]
    assert len(changes) == 1 and "'c'" in changes[0]  # only what changed
    assert not any("MSCK" in s for s in statements)
    write_version(days(spark, [(6, "c")]), path, "more", ["day"])
    n, parts = versions.current(spark, path)
    versions.commit(spark, path, n + 1, [*parts, ("day=c", "more")])
    with pytest.raises(ValueError, match="several versions"):
        catalog.point(spark, name, path)


def left(spark, folder):
    try:
        return spark.read.option("recursiveFileLookup", "true").parquet(folder).count()
    except Exception as error:  # noqa: BLE001
        assert "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER" in str(error)
        return 0


def test_intermediate_tables_go_with_their_scope(spark):
    with scratch(spark) as outer:
        table = stage(spark.range(10), "x")
        with scratch(spark) as inner:
            copies = deduplicate_stored(spark.range(5).union(spark.range(5)), "id")
            assert copies.count() == 5 and left(spark, inner) > 0
            kept = stage(spark.range(3), "y", result=True)
        assert left(spark, inner) == 0 and kept.count() == 3 and table.count() == 10
    assert left(spark, outer) == 0
    with pytest.raises(RuntimeError), scratch(spark) as failing:
        stage(spark.range(10), "z")
        raise RuntimeError
    assert left(spark, failing) == 0
    assert scratch_path(spark, "w").startswith(f"{shared_dir(spark)}/probelake/w-")


def test_dates_as_partitions(spark, path):
    rows = spark.createDataFrame([(1, dt.date(2020, 1, 1)), (2, None)], "id long, day date")
    publish(rows, path, "r", ["day"])
    publish(rows.limit(0), path, "r", ["day"], replaced=[dt.date(2020, 1, 1)])
    assert ids(spark, path) == [2]
