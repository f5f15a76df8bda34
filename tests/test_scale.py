"""What is stored and what moves when tables grow."""

import gzip
import json

import pytest
from pyspark.sql import functions as F
from test_streaming import ids, put

from probelake.operators.dedup import deduplicate, deduplicate_stored
from probelake.plans.config import FOLDER_DATE, LakeConfig
from probelake.plans.trusted import build_trusted
from probelake.session import settings
from probelake.sources import versions
from probelake.sources.readers import list_objects, read_measurements
from probelake.streaming import incremental, state
from probelake.streaming.incremental import raw_rows, run_incremental
from probelake.verification.fixtures import write_source_objects


def test_source_objects_are_stored_once_and_compressed(spark, tmp_path):
    lines = [(json.dumps({"id": str(i), "input": "https://site.org/" * 20}), "2020-01-01", "US") for i in range(2000)]
    text = sum(len(line[0]) + 1 for line in lines)
    source = write_source_objects(spark.createDataFrame(lines, "value string, day string, country string"), str(tmp_path))
    stored = sum(f.stat().st_size for f in tmp_path.rglob("*") if f.is_file())
    assert stored < text / 5
    assert read_measurements(spark, source).select("id").distinct().count() == 2000
    assert {r.path.endswith(".json.gz") for r in list_objects(spark, source).collect()} == {True}


def test_compressed_raw_files(spark, tmp_path):
    """A batch run and a stream read compressed files beside plain ones."""
    day = tmp_path / "raw" / "2020-01-01"
    put(day, "a.json", [("1", "BR")])
    put(day, "b.json", [("2", "BR")])
    (day / "b.json.gz").write_bytes(gzip.compress((day / "b.json").read_bytes()))
    (day / "b.json").unlink()
    raw, trusted = str(tmp_path / "raw"), str(tmp_path / "trusted")
    build_trusted(spark, LakeConfig("", raw, trusted, "", str(tmp_path / "logs")), "r")
    run_incremental(spark, raw, f"{trusted}-2", str(tmp_path / "checkpoint"))
    assert ids(spark, trusted) == ids(spark, f"{trusted}-2") == ["1", "2"]


def copies(spark, path):
    """A stored table in several files, every key of every third row twice, some rows without one."""
    n = F.col("id")
    key = F.when(n % 11 != 0, F.when(n % 3 == 0, F.floor(n / 6)).otherwise(n + 100_000).cast("string"))
    rows = spark.range(20_000).select(
        key.alias("row_id"), F.when(F.floor(n / 6) % 5 != 0, (F.floor(n / 6) % 2).cast("string")).alias("folder"), F.when(n % 7 != 0, F.hash("id") % 9).alias("t"),
        F.struct(n.alias("x"), F.repeat(F.lit("x"), 50).alias("y")).alias("wide"), (n % 4).alias("piece"),
    )
    rows.repartition(3).write.partitionBy("piece").parquet(f"{path}/a table+1")
    return spark.read.parquet(f"{path}/a table+1")


@pytest.mark.parametrize("null_keys", ["collapse", "keep"])
@pytest.mark.parametrize("order", [["t"], [F.col]])
def test_many_repeated_keys_move_no_wide_row(spark, tmp_path, null_keys, order):
    stored = copies(spark, tmp_path)
    options = {"order_by": [o if isinstance(o, str) else o("t").desc() for o in order], "within": ["folder"], "null_keys": null_keys}
    found = deduplicate_stored(stored, few_keys=10, **options)
    expected = deduplicate(stored, **options)
    assert 0 < found.count() == expected.count() < stored.count()
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
    assert "Exchange hash" not in found._jdf.queryExecution().executedPlan().toString()
    beyond = deduplicate_stored(stored, few_keys=10, few_rows=100, **options)
    assert beyond.exceptAll(expected).isEmpty() and beyond.count() == expected.count()


def test_a_batch_writes_its_own_keys(spark, tmp_path, monkeypatch):
    """Not those of the batches before it in the same buckets, until a bucket has many versions; an older copy stays."""
    monkeypatch.setattr(state, "BUCKETS", 1)
    monkeypatch.setattr(state, "MANY_VERSIONS", 2)
    raw, trusted, checkpoint = (str(tmp_path / n) for n in ("raw", "trusted", "checkpoint"))
    written = []
    for i in range(3):
        rows = [(f"{i}-{k}", "BR") for k in range(3)] + [("again", "BR")]
        put(tmp_path / "raw" / "f", f"{i}.json", rows, test_start_time=f"2020-01-01 00:00:0{(i + 1) % 3}")
        run_incremental(spark, raw, trusted, checkpoint)
        keys = f"{checkpoint}.kept/keys"
        written.append(spark.read.parquet(f"{versions.versions_path(keys)}/version=batch{i}").count())
    assert written == [4, 4, 10]
    assert ids(spark, trusted) == sorted([f"{i}-{k}" for i in range(3) for k in range(3)] + ["again"])


def odd_file(folder):
    """A compressed file with a name and lines that are hard to read."""
    lines = [
        b'{"id":"1","test_keys":{"blocking":{"a": 1},"queries":[{"answers":[{"ipv4":"1"}]}]}}', b"", b" \t ", b'{"id":"2"', b"no", b"null", b"5",
        b"[]", b'[{"id":"3"},{"id": "4"}]', b'[{"id":"6"},', b"[null]", b'{"id":{"a": 1.50}}', b'{"id":NaN}', b'{"id":"\xff","input":"\xc3\xa9"}',
        b'{"id":"7"}\r{"id":"8"}', b'{"id":"9","test_runtime":"x"}', b"{}",
    ]
    folder.mkdir(parents=True)
    file = folder / "a [1] {x}+%20.json.gz"
    file.write_bytes(gzip.compress(b"\n".join(lines) + b"\n" + b"".join(b'{"id":"n%d"}\n' % i for i in range(3000))))
    return file


def test_lines_of_a_compressed_file_are_parsed_by_all_cores(spark, tmp_path, monkeypatch):
    """The rows are those of a scan of the file, in whatever piece a line is."""
    raw = f"{tmp_path}/raw"
    file = odd_file(tmp_path / "raw" / "01")
    files = spark.createDataFrame([(f"file:{file}", file.stat().st_size)], "path string, length long")
    whole = raw_rows(files, raw)
    assert whole.rdd.getNumPartitions() == 1
    monkeypatch.setattr(incremental, "DEALT_BYTES", 1)
    monkeypatch.setattr(incremental, "scratch_path", lambda *_: f"{tmp_path}/pieces")
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        dealt = raw_rows(files, raw)
    assert len(list((tmp_path / "pieces").rglob("part-*"))) > 1
    text = lambda rows: sorted(map(str, rows.collect()))
    scan = spark.read.schema(incremental._raw_schema()).option("recursiveFileLookup", "true").json(raw)
    assert text(dealt) == text(whole) and text(whole.drop(FOLDER_DATE)) == text(scan)
    assert {r[0] for r in dealt.select(FOLDER_DATE).collect()} == {"01"} and dealt.count() > 3010
