"""What a batch of an incremental run reads, and that sums and buckets give what all rows would."""

import datetime as dt
import json
import random

import pytest
from test_streaming import ids, put

from probelake.operators import quality
from probelake.plans.config import GEN_1, GEN_2, LakeConfig
from probelake.plans.trusted import build_trusted
from probelake.sources import versions
from probelake.sources.readers import read_table, table_or_none
from probelake.streaming import incremental
from probelake.streaming.incremental import run_incremental
from probelake.streaming.unique import run_unique

PLACES = ("raw", "trusted", "checkpoint", "logs")


@pytest.fixture
def places(tmp_path):
    return [str(tmp_path / n) for n in PLACES]


def test_a_batch_reads_its_own_files_and_the_buckets_of_its_keys(spark, tmp_path, places, monkeypatch):
    raw, trusted, checkpoint, logs = places
    for i in range(12):
        put(tmp_path / "raw" / "2020-01-01", f"{i:02}.json", [(f"{i}-{k}", "BR") for k in range(3)])
    run_incremental(spark, raw, trusted, checkpoint, logs, files_per_batch=1)
    put(tmp_path / "raw" / "2020-01-01", "last.json", [("last", "BR")])
    read, scanned = [], versions.read_parts
    monkeypatch.setattr(versions, "read_parts", lambda s, path, parts, *a: read.append((path, parts)) or scanned(s, path, parts, *a))
    renewed = []
    monkeypatch.setattr(incremental.Batch, "_renewed", lambda *a: renewed.append(a))
    run_incremental(spark, raw, trusted, checkpoint, logs)
    assert not renewed and len(ids(spark, trusted)) == 37
    rows = {p for path, parts in read if path.endswith("/rows") for p in parts}
    keys = {p for path, parts in read if path.endswith("/keys") for p in parts}
    assert {v for _, v in rows} == {"batch12"}  # no batch before it
    assert len({part for part, _ in keys}) == 1  # the bucket of its one key
    assert {path.rsplit("/", 1)[1] for path, _ in read} <= {"rows", "keys", "metrics", "trusted"}


def random_rows(draw, n):
    rows = []
    for _ in range(n):
        k = draw.randrange(n)
        rows.append({
            "id": draw.choice([None, str(k), str(k)]), "input": "https://site.org/", "probe_cc": draw.choice(["BR", "BR", "BR", "FR", None]),
            "measurement_start_time": draw.choice(["2020-01-01 00:00:00", "bad"] + ["2020-01-01 00:00:00"] * 6),
            "test_start_time": draw.choice([None, "2020-01-01 00:00:00", "2020-01-01 00:00:01"]),
            "probe_asn": draw.choice(["AS1"] * 15 + [None]), "probe_ip": "1.1.1.1", "test_name": "t",
            "report_id": draw.choice(["r1", "r2", None]), "bucket_date": draw.choice(["2020-01-01", "2020-01-02", None]),
            "test_runtime": float(draw.randrange(3)),
        })
    return rows


@pytest.mark.parametrize(
    "seed,generation,options",
    [(1, GEN_2, {}), (2, GEN_2, {"null_keys": "keep"}), (3, GEN_1, {"substring_match": True})],
)
def test_batches_give_what_a_run_over_all_files_gives(spark, tmp_path, places, seed, generation, options):
    raw, trusted, checkpoint, logs = places
    draw = random.Random(seed)
    for i in range(4):
        for folder in ("2020-01-01", "2020-01-02"):
            (tmp_path / "raw" / folder).mkdir(parents=True, exist_ok=True)
            text = "\n".join(map(json.dumps, random_rows(draw, draw.choice((2, 40)))))
            (tmp_path / "raw" / folder / f"{i}.json").write_text(text)
        run_incremental(spark, raw, trusted, checkpoint, logs, generation, **options)
    cfg = LakeConfig("", raw, f"{trusted}-all", "", f"{logs}-all", generation, **options)
    build_trusted(spark, cfg, "all")
    columns = ["row_id", "id", "probe_cc", "test_start_time", "report_id", "test_runtime", "probe_asn", "bucket_date"]
    found, expected = ([tuple(map(str, r)) for r in read_table(spark, t).select(columns).collect()] for t in (trusted, f"{trusted}-all"))
    assert sorted(found) == sorted(expected) and found
    last = spark.read.parquet(logs)
    last = last.where(f"run_id = '{max(r.run_id for r in last.select('run_id').distinct().collect())}'").drop("run_id")
    whole = spark.read.parquet(f"{logs}-all").drop("run_id")
    assert sorted(map(str, last.collect())) == sorted(map(str, whole.collect()))


def test_a_failure_between_state_and_table_is_made_good(spark, tmp_path, places, monkeypatch):
    raw, trusted, checkpoint, logs = places
    day = tmp_path / "raw" / "2020-01-01"
    put(day, "a.json", [("1", "BR"), ("2", "BR")])
    run_incremental(spark, raw, trusted, checkpoint, logs)
    put(day, "b.json", [("2", "BR"), ("3", "BR")])
    commit = versions.commit

    def fails(s, path, *a):
        if path == trusted:
            raise RuntimeError("lost")
        commit(s, path, *a)

    with monkeypatch.context() as m:
        m.setattr(versions, "commit", fails)
        with pytest.raises(Exception, match="lost"):
            run_incremental(spark, raw, trusted, checkpoint, logs)
    assert ids(spark, trusted) == ["1", "2"]  # the whole table as it was
    run_incremental(spark, raw, trusted, checkpoint, logs)
    assert ids(spark, trusted) == ["1", "2", "3"]


def test_folders_without_rows(spark, tmp_path, places):
    """A folder whose file is blank, and a file in no folder: nothing to check, nothing to write, no failure."""
    raw, trusted, checkpoint, logs = places
    (tmp_path / "raw" / "2020-01-01").mkdir(parents=True)
    (tmp_path / "raw" / "2020-01-01" / "blank.json").write_text("\n  \n")
    cfg = LakeConfig("", raw, trusted, "", logs)
    report = build_trusted(spark, cfg, "r1")
    assert report.count() == len(GEN_2.constraints) and report.where("constraint_status = 'Success'").isEmpty()
    assert table_or_none(spark, trusted) is None
    run_incremental(spark, raw, f"{trusted}-2", checkpoint, f"{logs}-2")
    assert table_or_none(spark, f"{trusted}-2") is None
    (tmp_path / "raw" / "2020-01-01" / "blank.json").unlink()
    put(tmp_path / "raw", "top.json", [("1", "BR")])
    assert build_trusted(spark, cfg, "r2").isEmpty()
    run_incremental(spark, raw, f"{trusted}-2", checkpoint, f"{logs}-2")
    put(tmp_path / "raw" / "2020-01-02", "good.json", [("2", "BR")], "2020-01-02")
    assert build_trusted(spark, cfg, "r3").count() == len(GEN_2.constraints)
    run_incremental(spark, raw, f"{trusted}-2", checkpoint, f"{logs}-2")
    assert ids(spark, trusted) == ids(spark, f"{trusted}-2") == ["2"]


def test_groups_without_rows_are_measured(spark):
    rows = spark.createDataFrame([("a", 1)], "g string, x int")
    groups = spark.createDataFrame([("a",), ("b",), (None,)], "g string")
    checks = [quality.has_rows(), quality.complete("x", 0.5), quality.unique("x")]
    found = {(r.g, r.constraint): r.constraint_status for r in quality.report(rows, checks, ["g"], groups=groups).collect()}
    assert len(found) == 9 and {s for (g, _), s in found.items() if g != "a"} == {"Failure"}
    assert {s for (g, _), s in found.items() if g == "a"} == {"Success"}


def test_keys_are_forgotten_as_the_stream_goes_on(spark, tmp_path):
    """Ten rows and their copies a day for eight days, remembered for two: the state stops growing."""
    raw, table, checkpoint = (str(tmp_path / n) for n in ("raw", "table", "checkpoint"))
    held = []
    for i in range(8):
        day = dt.date(2020, 1, 1) + dt.timedelta(i)
        rows = [(f"{i}-{k}", "BR") for k in range(10)]
        put(tmp_path / "raw" / "f", f"{i}.json", rows + rows, str(day), test_start_time=f"{day} 00:00:00")
        progress = run_unique(spark, raw, table, checkpoint, "2 days").lastProgress
        held.append(progress.stateOperators[0].numRowsTotal)
    assert read_table(spark, table).count() == 80
    assert max(held) <= 40 and held[-1] <= held[3]
    late = tmp_path / "raw" / "f"
    put(late, "late.json", [("0-0", "BR"), ("new", "BR")], "2020-01-01", test_start_time="2020-01-01 00:00:00")
    put(late, "no-time.json", [("x", "BR")], None, test_start_time=None, measurement_start_time=None)
    run_unique(spark, raw, table, checkpoint, "2 days")
    assert read_table(spark, table).count() == 80
