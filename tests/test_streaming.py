import json

import pytest

from probelake.plans.config import GEN_1
from probelake.sources.readers import read_table
from probelake.streaming.incremental import run_incremental


def put(folder, name, rows, day="2020-01-01", **changes):
    folder.mkdir(parents=True, exist_ok=True)
    lines = [
        json.dumps(
            {
                "id": id_, "input": "u", "measurement_start_time": "2020-01-01 00:00:00", "probe_cc": cc,
                "test_start_time": "2020-01-01 00:00:00", "probe_asn": "AS1", "probe_ip": "1.1.1.1",
                "test_name": "t", "bucket_date": day, **changes,
            }
        )
        for id_, cc in rows
    ]
    (folder / name).write_text("\n".join(lines))


def ids(spark, trusted):
    return sorted(str(r.id) for r in read_table(spark, trusted).collect())


def test_folders_are_checked_over_all_their_rows(spark, tmp_path):
    raw, trusted, checkpoint, logs = (str(tmp_path / n) for n in ("raw", "trusted", "checkpoint", "logs"))
    day = tmp_path / "raw" / "2020-01-01"
    put(day, "a.json", [("1", "BR"), ("1", "BR"), ("2", "DE")])
    put(tmp_path / "raw" / "2020-01-02", "x.json", [("7", "BR")], "2020-01-02")
    run_incremental(spark, raw, trusted, checkpoint, logs)
    assert ids(spark, trusted) == ["1", "2", "7"]
    put(day, "b.json", [("2", "DE"), ("3", "RU"), ("3", "RU"), ("4", "FR")])
    put(tmp_path / "raw", "top.json", [("9", "BR")])
    put(day, "ignored.txt", [("9", "BR")])
    run_incremental(spark, raw, trusted, checkpoint, logs)
    assert ids(spark, trusted) == ["1", "2", "3", "7"]  # the folder with FR fails its check, FR goes
    run_incremental(spark, raw, trusted, checkpoint, logs)
    assert ids(spark, trusted) == ["1", "2", "3", "7"]
    assert spark.read.parquet(logs).count() == 3 * 11  # two folders, then one again


@pytest.mark.parametrize("files_per_batch", [1, 10])
def test_batches_make_no_difference(spark, tmp_path, files_per_batch):
    """Twenty clean rows and three, one without network: together under the threshold."""
    trusted, day = str(tmp_path / "trusted"), tmp_path / "raw" / "2020-01-01"
    put(day, "a.json", [(str(i), "BR") for i in range(20)])
    put(day, "b.json", [("20", "BR"), ("21", "BR")])
    put(day, "c.json", [("22", "BR")], probe_asn=None)
    run_incremental(spark, str(tmp_path / "raw"), trusted, str(tmp_path / "c"), files_per_batch=files_per_batch)
    assert len(ids(spark, trusted)) == 23


def test_a_row_removed_once_is_judged_with_its_folder(spark, tmp_path):
    raw, trusted, checkpoint = (str(tmp_path / n) for n in ("raw", "trusted", "checkpoint"))
    day = tmp_path / "raw" / "2020-01-01"
    put(day, "a.json", [("1", "BR")])
    put(day, "b.json", [("2", "BR")], probe_asn=None)
    run_incremental(spark, raw, trusted, checkpoint)
    assert ids(spark, trusted) == ["1"]
    put(day, "c.json", [("2", "BR")], probe_asn=None)  # delivered again: still removed
    run_incremental(spark, raw, trusted, checkpoint)
    assert ids(spark, trusted) == ["1"]
    put(day, "d.json", [(str(i), "BR") for i in range(10, 40)])  # with these the folder passes
    run_incremental(spark, raw, trusted, checkpoint)
    assert len(ids(spark, trusted)) == 32


def test_a_folder_that_loses_all_its_rows(spark, tmp_path):
    raw, trusted, checkpoint = (str(tmp_path / n) for n in ("raw", "trusted", "checkpoint"))
    put(tmp_path / "raw" / "2020-01-01", "a.json", [("1", "BR")])
    put(tmp_path / "raw" / "2020-01-02", "a.json", [("2", "BR")], "2020-01-02")
    run_incremental(spark, raw, trusted, checkpoint)
    put(tmp_path / "raw" / "2020-01-02", "b.json", [("2", "BR")], "2020-01-02", test_start_time="2019-01-01 00:00:00", probe_cc="XX")
    run_incremental(spark, raw, trusted, checkpoint)
    assert ids(spark, trusted) == ["1"]  # the earlier copy wins, and its country is not allowed


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    raw, trusted, logs = (str(tmp_path / n) for n in ("raw", "trusted", "logs"))
    day = tmp_path / "raw" / "2020-01-01"
    put(day, "a.json", [("1", "BR"), (None, "BR")] + [(str(i), "BR") for i in range(10, 30)])
    for _ in range(2):  # a checkpoint that is lost, beside what the batches kept
        checkpoint = tmp_path / "checkpoint"
        run_incremental(spark, raw, trusted, str(checkpoint), logs)
        checkpoint.rename(tmp_path / f"lost{len(list(tmp_path.iterdir()))}")
        assert len(ids(spark, trusted)) == 22
        assert spark.read.parquet(logs).count() == 11


def test_first_generation_is_rebuilt_as_a_whole(spark, tmp_path):
    raw, trusted, checkpoint = (str(tmp_path / n) for n in ("raw", "trusted", "checkpoint"))
    for day in ("2020-01-01", "2020-01-02"):
        put(tmp_path / "raw" / day, "a.json", [("1", "BR")], day, input="https://site.org/")
        run_incremental(spark, raw, trusted, checkpoint, generation=GEN_1)
    assert ids(spark, trusted) == ["1"]
