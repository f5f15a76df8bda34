import json
import pathlib
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from probelake.schemas import measurement_schema, prune, trusted_fields
from probelake.sources.readers import UnsupportedFormat, date_folders, list_objects, read, read_measurements
from probelake.sources.sinks import copier, copy_objects

LINES = [
    json.dumps({"id": "1", "test_keys": {"accessible": True, "blocking": {"k": 1}, "agent": 5, "retries": "x",
                                        "body_proportion": 0.5}, "test_runtime": 1.5, "more": [1]}),
    '{"id": "2", "test_keys"',
    json.dumps({"id": "3", "test_keys": None, "options": ["a", "b"]}),
]


@pytest.fixture
def raw(tmp_path):
    for folder in ("2020-01-01", "2020-01-02/deeper"):
        (tmp_path / folder).mkdir(parents=True)
    (tmp_path / "2020-01-01" / "a.json").write_text("\n".join(LINES))
    (tmp_path / "2020-01-02" / "deeper" / "b.json").write_text('{"id": "4", "bucket_date": "2020-01-01"}')
    (tmp_path / "2020-01-02" / "c.txt").write_text('{"id": "not read"}')
    return str(tmp_path)


def test_json_scan(spark, raw):
    rows = read(spark, raw, "json")
    found = {
        r.id: r
        for r in rows.select(
            "id", "test_keys.accessible", "test_keys.blocking", "test_keys.agent", "test_keys.retries",
            "test_keys.body_proportion", "test_runtime", "options",
        ).collect()
    }
    assert found.keys() == {"1", None, "3", "4"}
    assert tuple(found["1"])[1:] == ("true", '{"k": 1}', "5", None, 0.5, 1.5, None)
    assert set(found[None]) == {None}
    assert found["3"].options == ["a", "b"]


def test_json_scan_of_pruned_schema_gives_the_same(spark, raw):
    fields = ["id", "test_keys.accessible", "test_runtime"]
    whole = read_measurements(spark, raw).select(*fields)
    narrow = read_measurements(spark, raw, schema=prune(measurement_schema(), fields)).select(*fields)
    assert sorted(map(str, whole.collect())) == sorted(map(str, narrow.collect()))


def test_folder_column_is_the_top_folder(spark, raw):
    (pathlib.Path(raw) / "top.json").write_text('{"id": "5"}')
    rows = read_measurements(spark, raw, folder_column="folder").select("folder", "id").collect()
    assert {(r.folder, r.id) for r in rows} == {
        ("2020-01-01", "1"), ("2020-01-01", None), ("2020-01-01", "3"), ("2020-01-02", "4"),
        (None, "5"),
    }


def test_folder_column_with_blanks_in_the_path(spark, tmp_path):
    folder = tmp_path / "a b%+c" / "2020-01-01"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text('{"id": "1"}')
    rows = read_measurements(spark, str(tmp_path / "a b%+c"), folder_column="folder").collect()
    assert [(r.folder, r.id) for r in rows] == [("2020-01-01", "1")]


def test_missing_and_empty_folders_give_no_rows(spark, tmp_path):
    for path in (tmp_path, tmp_path / "none"):
        rows = read_measurements(spark, str(path), folder_column="folder")
        assert rows.isEmpty() and rows.columns[-1] == "folder"
        assert list_objects(spark, str(path)).isEmpty()


@pytest.mark.parametrize("fmt", ["js", "", "JSON", "csv"])
def test_other_formats_are_refused(spark, raw, fmt):
    with pytest.raises(UnsupportedFormat):
        read(spark, raw, fmt)


def test_listing_by_prefix(spark, raw):
    names = lambda df: {r.path.rsplit("/", 1)[1] for r in df.collect()}
    assert names(list_objects(spark, raw)) == {"a.json", "b.json", "c.txt"}
    assert names(list_objects(spark, raw, ["2020-01-02"])) == {"b.json", "c.txt"}
    assert names(list_objects(spark, raw, ["2020-01-01", "2020-02"], glob="*.json")) == {"a.json"}
    assert list_objects(spark, raw, ["2021"]).isEmpty()
    assert {r.source_date for r in date_folders(list_objects(spark, raw), raw).collect()} == {
        "2020-01-01", "2020-01-02",
    }


def test_listing_large_objects_takes_few_tasks(spark, tmp_path):
    """One task per object or per 128 MB would be far more than the session has cores."""
    (tmp_path / "d").mkdir()
    for i in range(40):
        with open(tmp_path / "d" / f"{i}.json", "wb") as file:
            file.truncate(150_000_000)  # takes no space
    listed = list_objects(spark, str(tmp_path / "d"))
    assert listed.count() == 40 and {r.length for r in listed.collect()} == {150_000_000}
    assert len(listed.inputFiles()) <= 2 * spark.sparkContext.defaultParallelism


def test_prune():
    schema = prune(measurement_schema(), ["id", "test_keys.requests.response.body", "test_keys.blocking"])
    assert schema.simpleString() == (
        "struct<test_keys:struct<blocking:string,requests:array<struct<response:struct<body:string>>>>,id:string>"
    )
    with pytest.raises(ValueError):
        prune(measurement_schema(), ["nothing"])
    with pytest.raises(ValueError):
        prune(measurement_schema(), ["id.x"])


def test_measurement_schema(spark):
    schema = measurement_schema()
    assert len(schema) == 23 and len(trusted_fields()) == 23
    assert all(f.nullable for f in schema)
    headers = schema["test_keys"].dataType["control"].dataType["http_request"].dataType["headers"].dataType
    assert len(headers) == 19
    response = schema["test_keys"].dataType["requests"].dataType.elementType["response"].dataType
    assert len(response["headers"].dataType) == 18


def test_copy_is_exact_and_repeatable(spark, tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    content = bytes(range(256)) * 40_000
    (source / "x y.json").write_bytes(content)
    (source / "empty.json").write_bytes(b"")  # empty objects are not listed
    objects = list_objects(spark, str(source)).withColumn(
        "dest_key", F.concat(F.lit("d/"), F.substring_index("path", "/", -1))
    )
    for _ in range(2):
        sizes = {r.dest_key: r.bytes for r in copy_objects(objects, str(tmp_path / "target")).collect()}
        assert sizes == {"d/x y.json": len(content)}
    assert (tmp_path / "target" / "d" / "x y.json").read_bytes() == content
    assert [p.name for p in (tmp_path / "target" / "d").iterdir()] == ["x y.json"]


def test_copy_needs_no_package_on_the_executors(tmp_path):
    (tmp_path / "a.json").write_text("x")
    (tmp_path / "function").write_bytes(cloudpickle.dumps(copier(f"file:{tmp_path}/out")))
    code = (
        "import pickle, pyarrow as pa; f = pickle.load(open('function', 'rb'));"
        "b = pa.RecordBatch.from_pydict({'path': ['file:' + %r], 'dest_key': ['d/a.json']});"
        "print([r.to_pydict() for r in f(iter([b]))])"
    ) % str(tmp_path / "a.json")
    run = subprocess.run(
        [sys.executable, "-I", "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120
    )
    assert run.stdout.strip() == "[{'dest_key': ['d/a.json'], 'bytes': [1]}]", run.stderr
