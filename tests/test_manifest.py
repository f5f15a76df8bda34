"""The table of landed files and the listing by prefixes."""

import pytest

from probelake.operators.landing import not_landed
from probelake.plans import ingest as plan
from probelake.plans.config import LakeConfig
from probelake.plans.ingest import ingest
from probelake.session import settings
from probelake.sources import listing, manifest, sinks
from probelake.sources.listing import list_prefixes
from probelake.sources.manifest import landed_objects, landed_table, record
from probelake.sources.readers import list_objects

NAME = "20200101T0-BR-AS1-web_connectivity-{}.json"


@pytest.fixture
def cfg(tmp_path):
    for day, n in (("2020-01-01", 3), ("2020-01-02", 1)):
        (tmp_path / "source" / day).mkdir(parents=True)
        for i in range(n):
            (tmp_path / "source" / day / NAME.format(i)).write_text("x" * (i + 1))
    return LakeConfig(str(tmp_path / "source"), str(tmp_path / "raw"), "", "", "", min_mib=1e-9)


def keys(rows):
    return sorted(r.dest_key for r in rows.collect())


def test_a_run_records_what_it_landed(spark, cfg):
    assert ingest(spark, cfg).count() == 4
    assert len(keys(spark.table(landed_table(spark, cfg.raw)))) == 4
    assert ingest(spark, cfg).isEmpty()
    listed = {(r.path, r.length) for r in list_objects(spark, cfg.raw).collect() if "_landed" not in r.path}
    assert {("file:" + r.path, r.length) for r in landed_objects(spark, cfg.raw).collect()} == listed


def test_a_copy_that_failed_half_way_is_made_again(spark, cfg, tmp_path, monkeypatch):
    copier = sinks.copier

    def failing(destination, locate=None):
        copy = copier(destination, locate)

        def run(batches):
            yield from copy(batches)
            raise RuntimeError("lost")

        return run

    with monkeypatch.context() as m:
        m.setattr(sinks, "copier", failing)
        with pytest.raises(Exception, match="lost"):
            ingest(spark, cfg)
    assert any((tmp_path / "raw").rglob("*.json"))
    assert spark.table(landed_table(spark, f"{cfg.raw}-other")).isEmpty()
    # What the lost run copied is found by the one listing that begins the table, or copied anew; nothing is twice.
    ingest(spark, cfg)
    assert len(list((tmp_path / "raw").glob("*/*.json"))) == 4
    assert len(set(keys(spark.table(landed_table(spark, cfg.raw))))) == 4


def test_a_failure_after_the_table_began(spark, cfg, tmp_path, monkeypatch):
    ingest(spark, cfg)
    (tmp_path / "source" / "2020-01-02" / NAME.format(9)).write_text("late")

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(plan, "record", fails)
        with pytest.raises(RuntimeError):
            ingest(spark, cfg)
    name = landed_table(spark, cfg.raw)
    assert len(keys(spark.table(name))) == 4  # copied, but not known as landed
    assert keys(ingest(spark, cfg)) == ["2020-01-02/" + NAME.format(9)]
    assert len(keys(spark.table(name))) == 5


def test_landed_rows_do_not_move_for_the_anti_join(spark, cfg):
    ingest(spark, cfg)
    files = spark.createDataFrame([("a",), ("2020-01-02/" + NAME.format(0),)], "dest_key string")
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        left = not_landed(files, spark.table(landed_table(spark, cfg.raw)))
        plan_text = left._jdf.queryExecution().executedPlan().toString()
        assert [r.dest_key for r in left.collect()] == ["a"]
    assert plan_text.count("Exchange") == 1 and "Bucketed: true" in plan_text


def test_a_folder_filled_before_is_listed_once(spark, cfg, tmp_path, monkeypatch):
    (tmp_path / "raw" / "2020-01-02").mkdir(parents=True)
    (tmp_path / "raw" / "2020-01-02" / NAME.format(0)).write_text("x")
    listings = []
    monkeypatch.setattr(manifest, "list_objects", lambda *a: listings.append(a) or list_objects(*a))
    assert len(keys(ingest(spark, cfg))) == 3
    assert ingest(spark, cfg).isEmpty() and len(listings) == 1


def test_a_session_without_the_catalog_entry_finds_the_table(spark, cfg):
    ingest(spark, cfg)
    spark.sql(f"DROP TABLE {landed_table(spark, cfg.raw)}")
    assert len(keys(spark.table(landed_table(spark, cfg.raw)))) == 4
    record(spark, landed_table(spark, cfg.raw), spark.createDataFrame([("k", 1)], "dest_key string, bytes long"))
    assert len(keys(spark.table(landed_table(spark, cfg.raw)))) == 5


@pytest.mark.parametrize("prefixes", [[""], ["2020-01"], ["2020-01-01", "2020-02/x"], ["a/b/2020"], ["nothing"], ["2020-01", "2020-01-0"]])
def test_prefixes_list_the_same_as_a_glob(spark, tmp_path, prefixes):
    for name in ("2020-01-01/x", "2020-01-01/deep/er/y", "2020-01-02/é z%41", "2020-02/x1", "a/b/2020-03/q", "top", "2020-01-file"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    (tmp_path / "2020-01-01" / "empty").touch()
    (tmp_path / "2020-01-01" / "_hidden").write_text("x")
    (tmp_path / "2020-01-01" / ".dot").write_text("x")
    columns = ["path", "length", "modificationTime"]
    expected = list_objects(spark, str(tmp_path), prefixes).select(columns)
    found = list_prefixes(spark, str(tmp_path), prefixes).select(columns)
    assert sorted(r.path for r in found.collect()) == sorted({r.path for r in expected.collect()})
    assert sorted(r.length for r in found.collect()) == sorted(s for _, s in {(r.path, r.length) for r in expected.collect()})
    times = {r.path: r.modificationTime for r in expected.collect()}
    assert all(abs((times[r.path] - r.modificationTime).total_seconds()) < 1 for r in found.collect())


def test_a_task_for_each_folder(spark, tmp_path):
    for i in range(7):
        (tmp_path / f"2020-01-0{i}").mkdir()
        (tmp_path / f"2020-01-0{i}" / "x").write_text("x")
    source = listing._source(f"file:{tmp_path}", ("2020-01",), None)
    places = source({}).reader(None).partitions()
    assert [len(p.folders) for p in places] == [1] * 7
    spark.dataSource.register(source)
    scan = spark.read.format("object_listing").load()
    assert scan.rdd.getNumPartitions() == 7 and "FileScan" not in scan._jdf.queryExecution().executedPlan().toString()


def test_storage_options_reach_the_file_system(monkeypatch):
    made = []
    monkeypatch.setattr(sinks.fs, "S3FileSystem", lambda **k: made.append(k) or "s3")
    locate = sinks.locator({"s3": {"access_key": "k", "region": "r"}})
    assert locate("s3a://bucket/a/b") == ("s3", "bucket/a/b") and made == [{"access_key": "k", "region": "r"}]
    assert locate("file:/a/b")[1] == "/a/b"
